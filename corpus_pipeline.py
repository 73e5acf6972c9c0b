"""Corpus pipeline: quality rules, exact dedup, near-dedup, mixing, tokens.

``STAGES`` are applied in order; each stage's rows are written as Parquet to
the shared folder and read back as the documents of the next one.  All but the
last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardpulse.llm.bpe import decode, encode
from wardpulse.llm.exact_dedup import drop_copies
from wardpulse.llm.mixing import draw
from wardpulse.llm.near_dedup import drop_near_copies
from wardpulse.llm.quality_rules import drop_rejected
from wardpulse.llm.queries import BPE_FILE, MIX_SEED, MIX_WEIGHTS
from wardpulse.llm.rows import shared_table
from wardpulse.sources.tables import read_table

#: Similarity from which two documents are near copies, in hundredths.
NEAR_PERCENT = 80

#: Share of the tokens kept by the mix, in thousandths.
KEEP_PERMILLE = 900


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_rejected(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs, percent=NEAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return draw(docs, MIX_WEIGHTS, KEEP_PERMILLE, MIX_SEED)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and the
    bytes that they decode to."""
    path, pattern = public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN
    return decode(encode(docs, path, pattern), path, pattern).drop("__key")


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mix_sources", mix),
    ("byte_bpe", tokens),
]

#: Quality counts, links on shingles and BPE have no SQL form; tests compare
#: ``run`` with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared_table(docs, f"stage-{name}")
    return docs
