"""Keyed state of the scoring stream, in the state store.

Three processors for ``transformWithState``; a batch reads and writes the state of
the keys it holds, whatever the population or the tables behind it:

* ``Arrivals``: keyed by a block of BLOCK consecutive offsets.  Its state is the set of
  offsets seen, as ranges (a block seen whole is one range), which expires once
  the broker no longer keeps its messages.  It drops redelivered messages (T6) and
  finds, for each reading, the tier of the patient's reading before it in the block;
* ``LastTier``: a map from patient to last tier (T1), keyed by one of BUCKETS hashes of
  the patient, because a key of its own costs Python more than the look-up of a
  patient in the map.  Only the first reading of a patient in each block comes here,
  with the patient's last tier in the block, so a patient with most of a batch's
  readings is one row per block.  It fills in the tier before the block (T3);
* ``Noticed``: tells when a silence was noticed.  The runs of readings that it follows
  are session windows, in the state store of Spark's own aggregate (see ``silence_stream``).

Spark hands the rows of a key to Python one at a time, so readings travel through the first
two in chunks: rows of one block, or of one bucket, in a binary cell in Arrow's stream
format.  That also keeps what pandas does not: NULL beside NaN, whole longs beside NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wardpulse.functions.news2 import tier_rank, with_news2

BLOCK = 1 << 14
#: How long a topic keeps messages as deployed; none is redelivered later.
RETENTION_MS = 3_600_000

SEEN = T.StructType([T.StructField("ranges", T.BinaryType())])
#: Keys of the tier state, and so tasks that can step it side by side.
BUCKETS = 256
PATIENT = T.StructType([T.StructField("patient_id", T.StringType())])
RANK = T.StructType([T.StructField("rank", T.IntegerType())])

#: Stands for a missing patient id, which is a patient of its own.
NOBODY = "\0"

#: Rows of one block (``key``: the block on the way to ``Arrivals``; then a bucket, or
#: below zero for rows that are done).
CHUNK = T.StructType([
    T.StructField("key", T.LongType()), T.StructField("block", T.LongType()),
    T.StructField("rows", T.BinaryType())])
#: Rows that a task gathers before it cuts them into chunks.
CHUNK_BYTES = 1 << 25
# Beside the reading a chunk holds its block and the bucket of its patient; ``_rank``: its
# tier, -1 for none; ``_prev``: the tier before it, -1 while unknown; ``_last``: the
# patient's last tier in the block.  An edge is a patient's first reading with a tier in
# the block.


def to_chunk(rows: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as stream:
        stream.write_table(rows.combine_chunks())
    return out.getvalue().to_pybytes()


def from_chunks(chunks: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(c).read_all() for c in chunks)


def cut(rows: pa.Table, by: str) -> Iterator[tuple[int, bytes]]:
    """A chunk of ``rows`` for each value of ``by``; rows keep their order."""
    rows = rows.take(pa.compute.sort_indices(rows[by])).combine_chunks()
    at = rows[by].to_numpy()
    ends = np.append(np.flatnonzero(at[1:] != at[:-1]) + 1, len(at))
    start = 0
    for end in ends.tolist():
        yield int(at[start]), to_chunk(rows.slice(start, end - start))
        start = end


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task -> chunks by block."""
    def packed(held):
        chunks = list(cut(pa.Table.from_batches(held), "_block"))
        blocks = pa.array([b for b, _ in chunks], pa.int64())
        return pa.RecordBatch.from_arrays(
            [blocks, blocks, pa.array([c for _, c in chunks], pa.binary())], names=CHUNK.names)

    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.nbytes
        if size >= CHUNK_BYTES:
            yield packed(held)
            held, size = [], 0
    if held:
        yield packed(held)


def unpack(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Chunks -> the named columns of their rows."""
    for b in batches:
        for chunk in b.column("rows"):
            for rows in pa.ipc.open_stream(chunk.as_buffer()):
                yield rows.select(names)


def pack_offsets(seen: np.ndarray) -> bytes:
    """Flags of a block's offsets -> starts and ends of the ranges that are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], seen.astype(np.int8), [0]])))
    return edges.astype("<u4").tobytes()


def unpack_offsets(ranges: bytes, size: int = BLOCK) -> np.ndarray:
    flips = np.zeros(size + 1, np.int8)
    flips[np.frombuffer(ranges, "<u4")] = 1
    return (np.cumsum(flips[:-1]) & 1).astype(bool)


def step_block(rows: pd.DataFrame) -> pd.DataFrame:
    """``prev``, ``last`` and ``edge`` of a block's rows, one per offset."""
    rows = rows.sort_values("seq", kind="stable", ignore_index=True)
    prev = np.full(len(rows), -1, np.int32)
    last, edge = prev.copy(), np.zeros(len(rows), bool)
    tiered = np.flatnonzero(rows["rank"].to_numpy() >= 0)
    by_patient = rows.loc[tiered].groupby("patient_id", sort=False, dropna=False)["rank"]
    before = by_patient.shift(1).to_numpy()
    edge[tiered] = np.isnan(before)
    prev[tiered] = np.where(edge[tiered], -1, np.nan_to_num(before, nan=-1))
    last[tiered] = by_patient.transform("last").to_numpy()
    return rows.assign(prev=prev, last=last, edge=edge)


class Arrivals(StatefulProcessor):
    def __init__(self, dedup: bool, retention_ms: int):
        self.dedup, self.retention_ms = dedup, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        if self.dedup:
            self.seen = handle.getValueState("seen", SEEN, self.retention_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        rows = from_chunks(c for r in rows for c in r["rows"])
        block = rows.select(["seq", "patient_id", "_rank"]).to_pandas().rename(columns={"_rank": "rank"})
        block["at"] = np.arange(len(block))
        if self.dedup:
            block = block.drop_duplicates("seq", ignore_index=True)
            held = self.seen.get()
            seen = unpack_offsets(held[0]) if held else np.zeros(BLOCK, bool)
            at = block["seq"].to_numpy() - int(key[0]) * BLOCK
            block = block[~seen[at]]
            if block.empty:
                return
            seen[at] = True
            self.seen.update((pack_offsets(seen),))
        block = step_block(block)
        rows = rows.take(pa.array(block["at"]))
        for name in ("prev", "last"):
            rows = rows.append_column(f"_{name}", pa.array(block[name], pa.int32()))
        edge = block["edge"].to_numpy()
        # Rows of a block go through by the block, under keys of their own.
        chunks = list(cut(rows.filter(pa.array(edge)), "_bucket")) if edge.any() else []
        if not edge.all():
            chunks.append((-1 - abs(int(key[0])), to_chunk(rows.filter(pa.array(~edge)))))
        yield pd.DataFrame({"key": [k for k, _ in chunks], "block": int(key[0]),
                            "rows": [c for _, c in chunks]})

    def close(self) -> None:
        pass


class LastTier(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tiers = handle.getMapState("last_tier", PATIENT, RANK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        if key[0] < 0:   # of a block: nothing to fill in
            yield from rows
            return
        chunks = pd.concat(list(rows), ignore_index=True).sort_values("block", ignore_index=True)
        edges = from_chunks(chunks["rows"])
        patients = edges["patient_id"].to_pandas().fillna(NOBODY)
        lasts = edges["_last"].to_pandas()
        prev = lasts.groupby(patients, sort=False).shift(1).fillna(-1).to_numpy(np.int32)
        opening, closing = ~patients.duplicated(), ~patients.duplicated(keep="last")
        held = {p: self._tier(p) for p in patients[opening].tolist()}
        prev[opening.to_numpy()] = list(held.values())
        for p, last in zip(patients[closing].tolist(), lasts[closing].tolist()):
            if held[p] != last:
                self.tiers.updateValue((p,), (last,))
        edges = edges.set_column(edges.schema.get_field_index("_prev"), "_prev", pa.array(prev))
        yield chunks[:1].assign(rows=[to_chunk(edges)])

    def _tier(self, patient: str) -> int:
        held = self.tiers.getValue((patient,))
        return -1 if held is None else int(held[0])

    def close(self) -> None:
        pass


def stepped(readings: DataFrame, dedup: bool, retention_ms: int = RETENTION_MS) -> DataFrame:
    """A stream of readings (decoded frames, good or not) -> the same with ``_prev``
    (the rank of the patient's tier before, -1: none)."""
    good = F.col("status") == "ok"
    rank = F.when(good, F.coalesce(tier_rank("news2_tier"), F.lit(-1))).otherwise(F.lit(-1))
    rows = with_news2(readings).select(
        *readings.columns, F.floor(F.col("seq") / BLOCK).cast("long").alias("_block"),
        F.pmod(F.xxhash64("patient_id"), F.lit(BUCKETS)).cast("int").alias("_bucket"),
        rank.alias("_rank"))
    blocks = rows.mapInArrow(pack_blocks, CHUNK).groupBy("key").transformWithStateInPandas(
        Arrivals(dedup, retention_ms), CHUNK, "Append", "ProcessingTime" if dedup else "None")
    done = blocks.groupBy("key").transformWithStateInPandas(LastTier(), CHUNK, "Append", "None")
    out = T.StructType([T.StructField(f.name, f.dataType) for f in readings.schema]
                       + [T.StructField("_prev", T.IntegerType())])
    return done.mapInArrow(lambda batches: unpack(batches, out.names), out)


SILENCE = T.StructType([T.StructField("patient_id", T.StringType()),
                        T.StructField("silent_since_ms", T.LongType()),
                        T.StructField("noticed_ms", T.LongType())])


def merge_runs(runs: np.ndarray, gap: int) -> np.ndarray:
    """Runs (first, last) of times, merged where no silence over ``gap`` parts them."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    last = np.maximum.accumulate(runs[:, 1])
    starts = np.flatnonzero(np.concatenate([[True], runs[1:, 0] - last[:-1] > gap]))
    return np.stack([runs[starts, 0], last[np.append(starts[1:], len(runs)) - 1]], axis=1)


class Noticed(StatefulProcessor):
    """Silences keyed by one of BUCKETS hashes of the patient -> the same with the
    watermark that settled them; no state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues
                        ) -> Iterator[pd.DataFrame]:
        for r in rows:
            yield r[["patient_id", "silent_since_ms"]].assign(
                noticed_ms=np.int64(timerValues.getCurrentWatermarkInMs()))

    def close(self) -> None:
        pass


def silence_stream(readings: DataFrame, gap_ms: int, delay: str) -> DataFrame:
    """R4 live: a row once a patient has been silent for more than ``gap_ms`` of
    event time, whether or not the patient sends again.  Times count that come at most
    ``delay`` late; a reading whose silence the watermark has settled is dropped as late."""
    # Session windows that touch are one, and one is settled when its end is the watermark:
    # 2 us beyond the gap part times in ms as "over the gap" and "behind the watermark" do.
    runs = (readings.filter(F.col("timestamp").isNotNull()).select("patient_id", "ts_ms")
            .withColumn("at", F.timestamp_millis("ts_ms")).withWatermark("at", delay)
            .groupBy("patient_id", F.session_window("at", f"{1000 * gap_ms + 2} microseconds").alias("run"))
            .agg(F.max("ts_ms").alias("silent_since_ms")))
    # Only what is settled goes through Python, many patients under one key.
    settled = runs.select(F.window_time("run").alias("at"), "patient_id", "silent_since_ms",
                          F.pmod(F.xxhash64("patient_id"), F.lit(BUCKETS)).alias("key"))
    return settled.groupBy("key").transformWithStateInPandas(
        Noticed(), SILENCE, "Append", "EventTime")
