"""Exact deduplication by content-defined chunk recipes, in built-in expressions only.

A text is cut where its words say so (a word whose hash is divisible by ``divisor`` ends a chunk), so
equal passages give equal chunks wherever they stand. Each different chunk is moved once, to check that
its 64-bit identifier stands for one text only; if two chunks ever share an identifier, all are hashed
anew with another seed. From then on documents are compared by their ordered lists of identifiers, about
one number for each sixty words, and the long texts are not moved again.

Defined results: NULL text counts as empty, empty texts are equal to each other. A group's row with the
smallest id stays; a missing id comes after all others, and of rows with the same id any single one
stays. Every input row gives one output row, however long its text; an empty table gives none. Other columns are
ignored.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import SPACE, narrow, stored

DIVISOR = 64
LONGEST = 512


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def recipe(words: Column, seed: int, divisor: int, longest: int) -> Column:
    """The chunks of a text given as words: an array of (identifier, chunk text)."""
    n = F.size(words)
    ends = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (F.pmod(F.xxhash64(F.element_at(words, i)), F.lit(divisor)) == 0) | (i == n),
    )
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.greatest(F.size(ends) - 1, F.lit(0))))
    spans = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    # A long run without a cut is divided from its own start on.
    pieces = F.flatten(
        F.transform(
            spans,
            lambda s: F.transform(
                F.sequence(s["a"], s["b"] - 1, F.lit(longest)),
                # Words are read by place: a slice inside a lambda would copy the whole array each time.
                lambda a: F.array_join(
                    F.transform(F.sequence(a, F.least(a + longest, s["b"]) - 1), lambda i: F.get(words, i)), " "
                ),
            ),
        )
    )
    return F.transform(pieces, lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("chunk_id"), c.alias("chunk")))


def recipes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, longest: int = LONGEST
) -> DataFrame:
    """(row, id, text_sha256, chunks), one row per document, with identifiers that are verified to
    stand for one chunk text each."""
    base = narrow(docs, id_col, text_col, F.monotonically_increasing_id().alias("row"))
    base = base.select("row", "id", normalised(F.col("text")).alias("text"))
    base = base.select("row", "id", "text", F.split("text", " ").alias("words"))
    for seed in itertools.count(1):
        made = stored(
            base.select(
                "row", "id", F.sha2("text", 256).alias("text_sha256"),
                recipe(F.col("words"), seed, divisor, longest).alias("chunks"),
            ),
            "recipes",
        )
        chunks = made.select(F.explode("chunks").alias("c")).select("c.chunk_id", "c.chunk")
        different = chunks.groupBy("chunk_id", "chunk").agg(F.count("*").alias("uses"))
        clashes = different.groupBy("chunk_id").agg(F.count("*").alias("texts")).filter("texts > 1")
        if clashes.isEmpty():
            return made


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR, longest: int = LONGEST
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    made = recipes(docs, id_col, text_col, divisor, longest).select(
        "row", "id", "text_sha256", F.col("chunks.chunk_id").alias("recipe")
    )
    order = F.struct(F.col("id").isNull().alias("missing"), "id", "row")
    of_group = made.groupBy("recipe").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    # Read from storage, the join is between two plain exchanges, and a large group's rows can be split.
    of_group = stored(of_group, "groups")
    return made.join(of_group, "recipe").select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )
