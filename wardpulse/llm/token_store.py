"""Token-id store: concatenated ids with Elias-Fano document boundaries.

Documents are range-partitioned by id, encoded, and laid into shards of about
SHARD_IDS ids in ascending id order.  A shard is one byte image

    "WPTK" | id width | nulls | documents | ids | first doc id | section sizes
    ids, 2 or 4 bytes each | ends of documents (Elias-Fano)
    | doc ids less the first (Elias-Fano)

kept as a binary cell of a Parquet table, so that Spark's commit protocol
covers lost executors; (part, seq) orders the shards.  Offsets over the whole
store come from a running sum of shard sizes, one narrow row per shard.

Encoding works on units (white space and the visible run behind it): no match
of the byte-level pattern crosses from a visible character into a space, so a
unit's ids never depend on its neighbours.  Tasks keep a bounded table of units
already encoded.  Texts that hold an added token of the vocabulary (such as
``<|endoftext|>``) go through the library whole and get that token's id.

Defined cases: null text is empty and has just the end id; null ids sort first;
rows that repeat an id follow each other; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from wardpulse.llm import elias_fano
from wardpulse.llm.elias_fano import EliasFano
from wardpulse.llm.rows import ARROW_ROWS, KEY, arrow_batches, once_per_process, row_key, text_or_empty
from wardpulse.session import scratch_path

END_ID = 2
SHARD_IDS = 1 << 20
SHARDS_PER_FILE = 16
_HEAD = "<4sBxxxIQQqQQ"

KNOWN_UNITS = 400_000
LONGEST_KNOWN = 64
_CROSS = re.compile(r"\s ")
#: Marks that follow a letter as a pre-token of their own.
_MARKS = frozenset(".,;:!?")
_VISIBLE_SPACE = re.compile(r"(?<=\S) ")


def json_tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class UnitEncoder:
    """Ids of texts as little-endian bytes of ``width`` each.

    Units seen before come from a table of two generations: when the younger is
    full it becomes the older, and units still in use move over.  New units
    without white space inside are encoded in one stretch, each after a space;
    the ids that begin with a space tell them apart.  A mark behind letters is a
    pre-token of its own, so the letters are looked up without it."""

    def __init__(self, path: str):
        self.tok = json_tokenizer(path)
        size = self.tok.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.spaced = np.array([(self.tok.id_to_token(i) or "").startswith("\u0120")
                                for i in range(size)])
        self.marks = dict(zip(sorted(_MARKS), self._each(sorted(_MARKS))))
        self.line_end = np.frombuffer(self._each(["\n"])[0], f"<u{self.width}")[0]
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # Units are put side by side with spaces and line ends between them.
        self.by_units = not any(c.isspace() for t in self.added for c in t)
        self.bare: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _each(self, units: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, f"<u{self.width}").tobytes()
                for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]

    def _together(self, units: list[str]) -> list[bytes]:
        """Ids of plain units, each after one space."""
        if not units:
            return []
        ids = np.array(self.tok.encode_batch_fast([" " + " ".join(units)],
                                                  add_special_tokens=False)[0].ids,
                       f"<u{self.width}")
        starts = np.flatnonzero(self.spaced[ids])
        assert len(starts) == len(units)
        raw, at = ids.tobytes(), (starts * self.width).tolist()
        return [raw[x:y] for x, y in zip(at, at[1:] + [len(raw)])]

    def _units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Units of all texts, those behind a text's first without the space in
        front of them, and the place of each text's first unit."""
        mixed = [i for i, t in enumerate(texts) if t[:1] == " " or _CROSS.search(t)]
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        if mixed:  # white space before a space: cut behind visible characters only
            own = pa.array([_VISIBLE_SPACE.split(texts[i]) for i in mixed], lists.type)
            order = np.arange(len(texts))
            order[mixed] = len(texts) + np.arange(len(mixed))
            lists = pa.concat_arrays([lists, own]).take(pa.array(order))
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        return lists.flatten(), np.cumsum(sizes) - sizes

    def _bare(self, units: list[str]) -> list[bytes]:
        """Ids of units with no space in front.  Plain ones are encoded in one
        stretch between line ends, which stay tokens of their own."""
        plain = list({u for u in units if u.split() == [u]}.difference(self.bare))
        if len(self.bare) + len(plain) > KNOWN_UNITS // 4:
            self.bare = {}
            plain = list({u for u in units if u.split() == [u]})
        if plain:
            ids = np.array(self.tok.encode_batch_fast(["\n" + "\n".join(plain)],
                                                      add_special_tokens=False)[0].ids,
                           f"<u{self.width}")
            ends = np.flatnonzero(ids == self.line_end)
            assert len(ends) == len(plain)
            raw, at = ids.tobytes(), (ends * self.width).tolist()
            self.bare.update(zip(plain, (raw[x + self.width:y]
                                         for x, y in zip(at, at[1:] + [len(raw)]))))
        odd = [u for u in units if u not in self.bare]
        once = dict(zip(odd, self._each(odd))) if odd else {}
        return [self.bare[u] if u in self.bare else once[u] for u in units]

    def _look_up(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units behind a space."""
        if len(self.known) > KNOWN_UNITS:
            self.known, self.older = {}, self.known
        known = self.known
        out = list(map(known.get, units))
        missing = [i for i, x in enumerate(out) if x is None]
        plain, marked, lines, odd = set(), [], [], []
        older = self.older.get
        for i in missing:
            u = units[i]
            x = older(u)
            if x is not None:
                known[u] = x
            # Latin letters: classed alike by every version of Unicode.
            elif u[-1:] in _MARKS and u[:-1].isalpha() and u[-2] < "\u0250" and len(u) <= LONGEST_KNOWN:
                marked.append(u)
                plain.add(u[:-1])
            elif u.split() == [u]:
                plain.add(u)
            else:
                two = u.split("\n")
                if len(two) == 2 and u.split() == two:
                    lines.append((u, *two))
                    plain.add(two[0])
                else:
                    odd.append(u)
        plain = list(plain.difference(known))
        fresh = dict(zip(plain, self._together(plain)))
        known.update((u, x) for u, x in fresh.items() if len(u) <= LONGEST_KNOWN)

        def spaced(u: str) -> bytes:
            x = fresh.get(u)
            return known[u] if x is None else x

        known.update((u, spaced(u[:-1]) + self.marks[u[-1]]) for u in marked)
        end = self.line_end.tobytes()
        fresh.update((u, spaced(a) + end + x) for (u, a, _), x in
                     zip(lines, self._bare([b for _, _, b in lines])))
        fresh.update(zip(odd, self._each([" " + u for u in odd])))
        for i in missing:
            out[i] = spaced(units[i])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; one that holds an added token is encoded whole, as such a
        token is cut out before anything else."""
        whole = {i for i, t in enumerate(texts)
                 if not self.by_units or any(a in t for a in self.added)}
        if not whole:
            return self._by_units(texts)
        some = iter(self._by_units([t for i, t in enumerate(texts) if i not in whole]))
        full = iter(self._each([texts[i] for i in sorted(whole)]))
        return [next(full) if i in whole else next(some) for i in range(len(texts))]

    def _by_units(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        units, first = self._units(texts)
        coded = units.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = coded.indices.to_numpy().astype(np.int64)
        heads = self._bare(units.take(pa.array(first)).to_pylist())
        place[first] = len(words) + np.arange(len(first))
        parts = self._look_up(words) + heads
        table = np.frombuffer(b"".join(parts), f"<u{self.width}")
        size = np.array(list(map(len, parts)), np.int64) // self.width
        begin = (np.cumsum(size) - size)[place]
        size = size[place]
        at = np.cumsum(size) - size
        ids = table[np.repeat(begin - at, size) + np.arange(int(size.sum()))].tobytes()
        cuts = (np.append(at[first], int(size.sum())) * self.width).tolist()
        return [ids[x:y] for x, y in zip(cuts, cuts[1:])]


def shard_image(ids: list[bytes], width: int, doc_ids: list[int | None]) -> bytes:
    """``ids`` of each document, in order; null ids of documents come first."""
    sizes = np.array([len(x) // width for x in ids], np.int64)
    given = np.array([d for d in doc_ids if d is not None], np.int64)
    first = int(given[0]) if len(given) else 0
    ends = elias_fano.pack(np.cumsum(sizes))
    names = elias_fano.pack(given.astype(np.uint64) - np.uint64(first % (1 << 64)))
    head = struct.pack(_HEAD, b"WPTK", width, len(doc_ids) - len(given), len(ids), int(sizes.sum()),
                      first, len(ends), len(names))
    return b"".join([head, *ids, ends, names])


class Shard:
    """Reader of one image; ``span(i)`` finds a document by two selects."""

    def __init__(self, image: bytes):
        magic, width, self.nulls, self.n_docs, self.n_ids, self.first, n_ends, n_names = \
            struct.unpack_from(_HEAD, image)
        assert magic == b"WPTK"
        view, at = memoryview(image), struct.calcsize(_HEAD) + width * self.n_ids
        self.ids = np.frombuffer(image, f"<u{width}", self.n_ids, struct.calcsize(_HEAD))
        self.ends = EliasFano(view[at:at + n_ends])
        self.names = EliasFano(view[at + n_ends:at + n_ends + n_names])

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.at(i - 1) if i else 0), self.ends.at(i)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + (self.names.all() + self.first).tolist()


def _write(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_per_process(f"units {path}", lambda: UnitEncoder(path))
        end = np.asarray([end_id], f"<u{encoder.width}").tobytes()
        part, seq, ids, names, held = TaskContext.get().partitionId(), 0, [], [], 0

        def image() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                 pa.array([held // encoder.width], pa.int64()),
                 pa.array([shard_image(ids, encoder.width, names)], pa.binary())],
                names=["part", "seq", "n_ids", "image"])

        for b in batches:
            doc_ids = b.column("__id").to_pylist()
            for d, x in zip(doc_ids, encoder.encode(b.column("__text").to_pylist())):
                ids.append(x + end)
                names.append(d)
                held += len(x) + len(end)
                if held >= shard_ids * encoder.width:
                    yield image()
                    seq, ids, names, held = seq + 1, [], [], 0
        if ids:
            yield image()
    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, seq, image in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "image"))):
            s = Shard(image)
            ends = s.ends.all()
            starts = np.concatenate([[0], ends[:-1]])
            raw = memoryview(s.ids.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * s.n_docs, pa.int32()), pa.array([seq] * s.n_docs, pa.int32()),
                 pa.array(s.doc_ids(), pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(ends - starts, pa.int64()),
                 pa.array([zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(starts.tolist(), ends.tolist())],
                          pa.int64())],
                names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS,
                 path: str | None = None) -> str:
    """Write the store of ``docs`` and return its folder (under the shared
    folder unless given)."""
    spark = docs.sparkSession
    arrow_batches(spark, 2 * ARROW_ROWS)
    path = path or scratch_path(spark, "llm-tokens")
    slim = docs.select(F.col(id_col).cast("long").alias("__id"),
                       row_key(id_col, text_col).alias(KEY),
                       text_or_empty(text_col).alias("__text"))
    (slim.repartitionByRange("__id").sortWithinPartitions("__id", KEY)
     .mapInArrow(_write(tokenizer, end_id, shard_ids),
                 "part int, seq int, n_ids long, image binary")
     .write.option("maxRecordsPerFile", SHARDS_PER_FILE).parquet(path))
    return path


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document of a store: doc_id, start (ids before it in the
    whole store), n_tokens, ids_crc32."""
    shards = spark.read.parquet(path)
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(order), F.lit(0))
                           .alias("before"))
    docs = shards.select("part", "seq", "image").mapInArrow(
        _read, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(before, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
