"""A corpus pipeline: toxic documents go, near copies go, secrets are masked, sources are mixed, the rest is packed.

Every stage takes (spark, docs, folder), works on all documents that its predecessor kept, and
returns the columns of `documents`; the last returns where each piece of each document is packed. `run`
writes each stage's rows to the cluster's shared folder and reads them again, so that a stage that is lost
starts from its predecessor's table.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tramline.llm import mixing, ngram_join, packing, secrets, toxicity  # noqa: E402
from tramline.llm.common import landed, table  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near copies: shingles of five words, a similarity of 80 in 100 or more.
COPY_WORDS, COPY_PERCENT = 5, 80


def numbered_rows(docs: DataFrame) -> DataFrame:
    """The documents with `_row`, a number for every row, so that what is decided by row can be joined back.

    Landed, since a number given while reading need not be the same when read again.
    """
    return landed(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "rows")


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents scored 0.7 or more go. The model learns from `labels` and these documents; without one all stay."""
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    if model.trees is None:
        return docs.select(COLUMNS)
    scored = model.score(docs.select(*COLUMNS, F.col("text").alias("scored")).withColumnsRenamed({"text": "kept", "scored": "text"}))
    return scored.filter(F.col("score") < toxicity.TOXIC_FROM).withColumnRenamed("kept", "text").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays, null last, and of those the first.

    Documents without words are no copies and stay.
    """
    rows = numbered_rows(docs)
    classes = ngram_join.near_classes(rows, COPY_WORDS, COPY_PERCENT, row="_row")
    gone = classes.filter(F.col("row") != F.col("first_row")).select(F.col("row").alias("_row"))
    return rows.join(gone, "_row", "left_anti").select(COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Spans that look like live credentials and widely copied examples are replaced by marks."""
    return secrets.masked(docs.select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document is repeated as often as the mix takes it; documents it does not take go."""
    rows = numbered_rows(docs)
    taken = mixing.mix(rows, row="_row").filter("copies > 0").select("_row", F.col("copies").cast("int").alias("_copies"))
    return (
        rows.join(taken, "_row")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(COLUMNS)
    )


def pack_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document's pieces with the sequence and offset they are packed at."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_documents),
]

# Learned scores and iterated joins are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
