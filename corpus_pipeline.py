"""Pipeline from documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a table that is
written and read back as the next one's ``docs``.  All but the last return the columns of
``documents``:

1. ``quality_rules`` drops documents that the strict policy rejects;
2. ``near_duplicates`` keeps one document of each group of linked ones (four words, 85 %, as ``op8``);
3. ``secret_scans`` replaces secrets in the texts and counts ``n_chars`` anew where it did;
4. ``mixing`` repeats or leaves out documents so that sources come to their target sizes;
5. ``sentence_pieces`` encodes and decodes the texts.

Nulls, empty texts and empty tables pass as the operators define; rows taken twice by the mix are
two rows, which the last stage encodes alike.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import jaccard_join, mixing, quality_rules, secrets, sentence_pieces
from ledgerlens.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: No SQL states the random draw of the mix or the merges of the encoder.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(docs.select(*COLUMNS))
    return quality_rules.apply_policy(rows, quality_rules.STRICT).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs.select(*COLUMNS))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanned = stored(secrets.scan(docs.select(*COLUMNS)), "scanned")
    rows = secrets.found(scanned, secrets.limits(scanned))
    rows = rows.withColumn("clean", secrets.redacted(F.col("text"), F.col("all_spans")))
    n_chars = F.when(F.size("all_spans") > 0, F.char_length("clean").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", n_chars).withColumn("text", F.col("clean")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(docs.select(*COLUMNS)).filter("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("mixing", mix),
    ("sentence_pieces", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
