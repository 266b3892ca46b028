"""From raw documents to packed training sequences: five stages, each on what the one before kept.

Each stage is a function (spark, docs, sf_dir) that returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes each stage's rows as Parquet into the shared folder and reads them again.
Rows are matched to decisions by id; a NULL id matches itself. Of rows that repeat one id, all go or stay
together, but for copies of the same text, of which one stays. Long texts are judged whole and packed in several
pieces. Columns of any name pass through. An empty table passes through empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm import exact_dedup, language_id, packing, pii, simhash
from tontine.llm.common import read_documents, small_batches, stored

#: A text whose most likely language has a lower calibrated probability is in no language it knows.
SURE = 0.4

#: Up to so many ids (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

# The language stage learns from other rows than the calibration of op5 holds out; it judges all rows.
ORACLE_SQL = None


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a text in one of the learned languages. Texts without a letter go."""
    small_batches(spark)
    found = language_id.identify(docs)
    rejected = found.filter((F.col("lang_pred") == language_id.UNKNOWN) | (F.col("score") < SURE)).select("doc_id")
    return without(docs, rejected)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    small_batches(spark)
    found = exact_dedup.groups(docs)
    # An id that repeats with equal texts is both kept and dropped.
    both = found.groupBy("doc_id").agg(F.max("kept").alias("any"), F.min("kept").alias("all"))
    return one_of_each(without(docs, both.filter("NOT any").select("doc_id")), both.filter("any AND NOT all").select("doc_id"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near copies."""
    small_batches(spark)
    found = simhash.groups(docs)
    dropped = found.filter("doc_id <> component_id OR (doc_id IS NULL AND component_id IS NOT NULL)")
    return without(docs, dropped.select("doc_id").distinct())


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data replaced by its kind and n_chars set anew."""
    small_batches(spark)
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every text with its token ids, sequence and place."""
    small_batches(spark)
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True))


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id, NULL included, isn't in ``ids (doc_id)``."""
    name = unused(docs)
    gone = stored(ids.select(F.col("doc_id").alias(name)), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[name]), "left_anti")


def unused(docs: DataFrame) -> str:
    """A name that no column of ``docs`` has."""
    return "x" + "_" * max(map(len, docs.columns))


def one_of_each(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with one row for each different text of the ids in ``ids``."""
    name = unused(docs)
    some = ids.select(F.col("doc_id").alias(name))
    on = docs["doc_id"].cast("long").eqNullSafe(some[name])
    several = docs.join(some, on, "left_semi").withColumn(name, exact_dedup.normalised(F.coalesce("text", F.lit(""))))
    several = several.dropDuplicates(["doc_id", name]).drop(name)
    return docs.join(some, on, "left_anti").unionByName(several)


STAGES = [
    ("language_id", by_language),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
