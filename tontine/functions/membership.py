"""Rows whose key is probably in a set, by bitmaps of a fixed size that are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bitmaps of 32,768 places each: two million places in all, 256 KB, however many keys the set has.
PAGES = 64


def _placed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """With the bitmap ``page__`` that the row's key belongs to, and its ``place__`` there."""
    hashed = F.xxhash64(*keys)
    return rows.withColumns({"page__": F.pmod(hashed, F.lit(PAGES)), "place__": F.bitmap_bit_position(F.shiftright(hashed, 8))})


def probably_in(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose ``keys`` are among those of ``wanted``, and a few others: a share of about the number of
    different wanted keys over two million. NULL equals NULL. What is kept is dealt with exactly later, mostly by a
    join, which then moves that much less. The names ``page__`` and ``place__`` are taken."""
    octets = F.transform(
        F.sequence(F.lit(1), F.length("bits__")),
        lambda i: F.conv(F.hex(F.substring(F.col("bits__"), i, F.lit(1))), 16, 10).cast("int"),
    )
    pages = (
        _placed(wanted, keys).groupBy(F.col("page__").alias("page__w"))
        .agg(F.bitmap_construct_agg("place__").alias("bits__"))
        .select("page__w", octets.alias("octets__"))
    )
    marked = _placed(rows, keys).join(F.broadcast(pages), F.col("page__") == F.col("page__w"))
    octet = F.get("octets__", F.shiftright("place__", 3).cast("int"))
    held = F.call_function("shiftright", octet, (F.col("place__") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return marked.where(held).select(*rows.columns)
