"""What filters remove alone and in any order, from sorted posting lists of the rows that fail them.

Each filter has, for each part of the corpus and each range of ids, the sorted list of the rows that fail it;
so have the labels that rows carry. Lists hold row numbers within the range, whose ids and multiplicities
are listed beside them. The lists of a part and range are merged once: the list with the smallest head
gallops (doubling steps, then bisection) to the next list's head, and what it passes is a run of rows held
by the same set of lists. The union, difference or intersection of any lists is a sum of such run sizes, so
the sizes by set of lists, summed over the ranges of a part, answer every order of the filters at once.

Equal texts are found by their SHA-256: the smallest id of each text, found by a minimum combined before
its shuffle, is laid among the rows by id, where it says which rows fail; no group of copies is joined or
gathered. Equal rows are counted before they are moved. Ranges come from Spark's range partitioning of the
ids and hold at most ``RANGE`` rows; rows without an id are dealt by the hash of their text.

Defined results: NULL texts count as empty, NULL sources as the part of empty name. Every row counts, equal
ones too. A row without an id never fails for being a copy, makes no other row one, and carries no label. Of
several labels of an id, any that holds the mark counts. Texts are read whole. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_map, as_batch, narrow, rows_of, ship, stored

#: Rows in one range of ids at most.
RANGE = 65_536

POSTINGS = "part string, ids array<long>, counts array<long>, lists array<array<int>>"

# The kinds of entries of one id, in the order in which they are read.
_LABEL, _FIRST, _ROW, _ROW_WITHOUT_ID = range(4)


class Text(NamedTuple):
    """A text as the filters see it: characters, UTF-8 bytes, and words between ASCII white space."""

    text: str
    data: bytes
    words: list[bytes]


def _without(data: bytes, chars: bytes) -> int:
    return len(data.translate(None, chars))


def few_words(t: Text) -> bool:
    return len(t.words) < 200


def few_different_words(t: Text) -> bool:
    return 100 * len(set(t.words)) < 50 * len(t.words)


def many_capitals(t: Text) -> bool:
    return 100 * (len(t.data) - _without(t.data, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")) > 2 * len(t.text)


def special_characters(t: Text) -> bool:
    return _without(t.data, b"#$%&*|") < len(t.data)


#: The filters that look at one text, by name; a last one, for copies, looks at all.
FILTERS: dict[str, Callable[[Text], bool]] = {
    "A": few_words,
    "B": few_different_words,
    "C": many_capitals,
    "D": special_characters,
}
COPIES = "E"


def failures(
    docs: DataFrame, filters: dict[str, Callable[[Text], bool]], id_col: str, text_col: str, part_col: str
) -> DataFrame:
    """``id, part, fails, digest`` of each row; bit k of ``fails`` is set if it fails the k-th filter."""
    checks = list(filters.values())

    def make(columns: dict[str, list]) -> dict[str, list]:
        fails, digests = [], []
        for text in columns["text"]:
            data = text.encode()
            seen = Text(text, data, data.split())
            fails.append(sum(1 << k for k, fails_it in enumerate(checks) if fails_it(seen)))
            digests.append(hashlib.sha256(data).digest())
        return {"id": columns["id"], "part": columns["part"], "fails": fails, "digest": digests}

    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    return arrow_map(narrow(docs, id_col, text_col, part), "id long, part string, fails int, digest binary", make)


def _by_key(rows: DataFrame, kind: int | Column, key: Column, bits: Column, *, rest: bool = False) -> DataFrame:
    none = F.lit(None)
    return rows.select(
        key.alias("key"), (F.lit(kind) if isinstance(kind, int) else kind).alias("kind"), bits.cast("int").alias("bits"),
        (F.col("digest") if "digest" in rows.columns else none.cast("binary")).alias("digest"),
        (F.col("part") if rest else none.cast("string")).alias("part"),
        (F.col("n") if rest else F.lit(1)).cast("long").alias("n"),
    )


def posting_lists(marks: DataFrame, labels: DataFrame, filters: int, marked: int, longest: int = RANGE) -> DataFrame:
    """``part, ids, counts, lists``: a row for each part and range of ids, with the ids of its rows (NULL:
    none), how many equal rows each stands for, and the sorted row numbers that each list holds: those of the
    rows that fail each of the ``filters`` and of copies, then those of each label of ``labels (id, bits)``."""
    ship(marks.sparkSession)
    rows = marks.groupBy("part", "id", "digest", "fails").agg(F.count("*").alias("n"))
    firsts = marks.groupBy("digest").agg(F.min("id").alias("id")).filter("id IS NOT NULL")
    known = labels.filter("id IS NOT NULL AND bits <> 0").groupBy("id").agg(F.bit_or("bits").alias("bits"))
    no_id = F.col("id").isNull()
    entries = (
        _by_key(
            rows, F.when(no_id, _ROW_WITHOUT_ID).otherwise(_ROW), F.when(no_id, F.xxhash64("digest")).otherwise(F.col("id")),
            F.col("fails"), rest=True,
        )
        .unionByName(_by_key(firsts, _FIRST, F.col("id"), F.lit(0)))
        .unionByName(_by_key(known, _LABEL, F.col("id"), F.col("bits")))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "kind", "part", "digest")
    )
    width = filters + 1 + marked
    wanted = marks.sparkSession.createDataFrame([], POSTINGS).schema

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[str, tuple[list, list, list[list[int]]]] = {}

        def taken() -> pa.RecordBatch:
            columns = list(zip(*lists.values(), strict=True))
            out = as_batch(dict(zip(("part", "ids", "counts", "lists"), [list(lists), *columns], strict=True)), wanted)
            lists.clear()
            return out

        size, last, label, first = 0, None, 0, set()
        for columns in rows_of(batches):
            for key, kind, bits, digest, part, n in zip(
                *(columns[c] for c in ("key", "kind", "bits", "digest", "part", "n")), strict=True
            ):
                if key != last:
                    last, label, first = key, 0, set()
                if kind == _LABEL:
                    label = bits
                elif kind == _FIRST:
                    first.add(digest)
                else:
                    if size == longest:
                        yield taken()
                        size = 0
                    size += 1
                    ids, counts, held = lists.setdefault(part, ([], [], [[] for _ in range(width)]))
                    if kind == _ROW:
                        bits |= ((digest not in first) << filters) | label << (filters + 1)
                    for k in range(width):
                        if bits >> k & 1:
                            held[k].append(len(ids))
                    ids.append(key if kind == _ROW else None)
                    counts.append(n)
        if lists:
            yield taken()

    return entries.mapInArrow(build, wanted)


def gallop(values: list[int], target: int, start: int) -> int:
    """The first place from ``start`` on whose value is ``target`` or more: steps that double, then bisection."""
    step = 1
    while start + step < len(values) and values[start + step] < target:
        step *= 2
    return bisect_left(values, target, start + step // 2, min(start + step + 1, len(values)))


def runs(lists: list[list[int]]) -> Iterator[tuple[int, list[int]]]:
    """The values of sorted lists, merged: runs of values with the set of lists (as bits) that hold them."""
    at = {k: 0 for k, values in enumerate(lists) if values}
    while at:
        heads = {k: lists[k][i] for k, i in at.items()}
        low = min(heads.values())
        held = [k for k, head in heads.items() if head == low]
        if len(held) == 1:
            (k,) = held
            values, start = lists[k], at[k]
            beyond = min((head for head in heads.values() if head != low), default=values[-1] + 1)
            at[k] = gallop(values, beyond, start)
            yield 1 << k, values[start : at[k]]
        else:
            for k in held:
                at[k] += 1
            yield sum(1 << k for k in held), [low]
        for k in held:
            if at[k] == len(lists[k]):
                del at[k]


def merged_sizes(lists: DataFrame) -> DataFrame:
    """``part, members, size``: how many rows exactly the lists in ``members`` (bits) hold."""

    def merge(columns: dict[str, list]) -> dict[str, list]:
        sizes: Counter[tuple[str, int]] = Counter()
        for part, counts, held in zip(columns["part"], columns["counts"], columns["lists"], strict=True):
            rest = sum(counts)
            for members, run in runs(held):
                size = sum(map(counts.__getitem__, run))
                sizes[part, members] += size
                rest -= size
            sizes[part, 0] += rest
        return {"part": [p for p, _ in sizes], "members": [m for _, m in sizes], "size": list(sizes.values())}

    found = arrow_map(lists.select("part", "counts", "lists"), "part string, members int, size long", merge)
    return found.groupBy("part", "members").agg(F.sum("size").alias("size"))


def in_all_orders(sizes: DataFrame, names: list[str], labels: list[str]) -> DataFrame:
    """One row for each part, order of the filters and step, from the sizes by set of lists."""
    steps = [
        {
            "filter_order": "".join(names[k] for k in order),
            "step": step,
            "own": 1 << order[step - 1],
            "before": sum(1 << k for k in order[: step - 1]),
        }
        for order in itertools.permutations(range(len(names)))
        for step in range(1, len(names) + 1)
    ]
    schema = "array<struct<filter_order:string,step:int,own:int,before:int>>"
    every = (1 << len(names)) - 1
    # At most 2 ** (filters + labels) sizes a part.
    by_part = sizes.groupBy("part").agg(F.collect_list(F.struct("members", "size")).alias("sizes"))
    rows = by_part.select("part", "sizes", F.inline(F.from_json(F.lit(json.dumps(steps)), schema)))

    def total(holds: Callable[[Column], Column], weight: Callable[[Column], Column] = lambda m: F.lit(1)) -> Column:
        return F.aggregate(
            "sizes", F.lit(0).cast("long"),
            lambda sum_, x: sum_ + F.when(holds(x["members"]), x["size"] * weight(x["members"])).otherwise(0),
        )

    def own(m: Column) -> Column:
        return m.bitwiseAND(F.col("own")) != 0

    def earlier(m: Column) -> Column:
        return m.bitwiseAND(F.col("before")) != 0

    def labelled(k: int) -> Column:
        return total(lambda m: own(m) & ~earlier(m) & (m.bitwiseAND(F.lit(1 << (len(names) + k))) != 0))

    # A row that fails k filters falls to each of them in one k-th of all orders.
    orders = F.lit(math.factorial(len(names)))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~own(m) & ~earlier(m)).alias("kept"),
        total(lambda m: own(m) & ~earlier(m)).alias("removed"),
        total(lambda m: own(m) & earlier(m)).alias("redundant"),
        total(lambda m: m.bitwiseAND(F.lit(every)) == F.col("own")).alias("unique_fails"),
        *[labelled(k).alias(name) for k, name in enumerate(labels)],
        total(own, lambda m: (orders / F.bit_count(m.bitwiseAND(F.lit(every)))).cast("long")).alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, Callable[[Text], bool]] | None = None,
    copies: str = COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``
    for every part and order of the filters; the last filter, named ``copies``, fails rows whose text a
    smaller id has. ``labels`` has ``doc_id, quality, toxic``."""
    filters = FILTERS if filters is None else filters
    marks = stored(failures(docs, filters, id_col, text_col, part_col), "failures")
    good, toxic = (F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)) for c in ("quality", "toxic"))
    known = labels.select(F.col("doc_id").cast("long").alias("id"), (good + 2 * toxic).alias("bits"))
    lists = stored(posting_lists(marks, known, len(filters), 2), "posting-lists")
    return in_all_orders(merged_sizes(lists), [*filters, copies], ["good_lost", "toxic_lost"])
