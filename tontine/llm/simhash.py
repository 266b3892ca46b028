"""Near-duplicates by SimHash fingerprints and the general pigeonhole principle.

64-bit fingerprints of word shingles are linked when few bits differ. The bits are grouped into
partitions so that correlated bits share one. For each fingerprint a threshold is dealt to each
partition (-1: not probed) by dynamic programming on the estimated number of candidates; thresholds that
sum to ``radius - partitions + 1`` miss no neighbour (Qin et al. 2018). Candidates from small buckets are
verified pair by pair.

A bucket with more than ``bucket`` members is never expanded into pairs. Its members are linked exactly by
another rule: two fingerprints that agree on the partition differ by at most 2 bits if and only if a
fingerprint within one bit of both exists, so each member announces its one-bit variants in the bucket
and is linked to the smallest member that announces the same variant. That is a fixed number of rows a
member, whatever the size of the bucket. (At radius 1 it is linked to the member that a variant is.)

Defined results: NULL and empty texts have fingerprint zero and are linked like any other. Rows with the
same id are fingerprinted each for itself. A missing id takes part, but never names a component unless
all its ids are missing (then NULL). Long texts are read whole, in blocks of shingles. An empty table gives none.
Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_map, narrow, ship, stored
from tontine.llm.components import components

PARTITIONS = 3
RADIUS = 2
BUCKET = 32


def fingerprint(text: str, words: int, block: int = 16_384) -> int:
    """SimHash of the text's word shingles, as an unsigned 64-bit number."""
    import xxhash

    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = list(map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False)))
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), block):
        hashes = np.array([h(s, 42) for s in shingles[at : at + block]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(shingles), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp``, the fingerprint as a signed long, of each row."""

    def make(columns: dict[str, list]) -> dict[str, list]:
        marks = np.array([fingerprint(t, words) for t in columns["text"]], np.uint64).view(np.int64)
        return {"id": columns["id"], "fp": marks}

    return arrow_map(narrow(docs, id_col, text_col), "id long, fp long", make)


def correlated_partitions(marks: DataFrame, count: int) -> list[list[int]]:
    """The 64 bits in ``count`` groups of nearly equal size, each grown by the bit most correlated
    with it. The correlations come from all fingerprints, summed as one 65 x 65 matrix a task."""

    def moments(batches):
        total = np.zeros((65, 65))
        for pdf in batches:
            bits = np.unpackbits(pdf["fp"].to_numpy("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            rows = np.hstack([bits.astype(np.float64), np.ones((len(bits), 1))])
            total += rows.T @ rows
        at = np.indices(total.shape).reshape(2, -1)
        yield pd.DataFrame({"i": at[0], "j": at[1], "v": total.ravel()})

    sums = marks.select("fp").mapInPandas(moments, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    matrix = np.zeros((65, 65))
    for i, j, v in sums.collect():
        matrix[i, j] = v
    n = max(matrix[64, 64], 1.0)
    mean = matrix[64, :64] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    strength = np.abs(matrix[:64, :64] / n - np.outer(mean, mean)) / np.outer(spread, spread)
    free, out = set(range(64)), []
    for k in range(count):
        size = 64 // count + (k < 64 % count)
        members = [min(free, key=lambda b: (-sum(strength[b][c] for c in free if c != b), b))]
        free -= set(members)
        while len(members) < size:
            best = min(free, key=lambda b: (-sum(strength[b][m] for m in members), b))
            members.append(best)
            free.remove(best)
        out.append(sorted(members))
    return out


def mask_of(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def thresholds(costs: np.ndarray, total: int) -> np.ndarray:
    """For each row of ``costs[row, partition, t + 1]``, the thresholds t from -1 up that sum to
    ``total`` at the least cost: dynamic programming over the partitions."""
    rows, parts, choices = costs.shape
    low, span = -parts, parts + total
    best = np.full((rows, span + 1), np.inf)
    best[:, 0] = 0.0  # the sum of the thresholds so far, less its least value, is zero
    picks = []
    for p in range(parts):
        tried = np.full((choices, rows, span + 1), np.inf)
        for t in range(choices):  # threshold t - 1 adds t to the shifted sum
            tried[t, :, t:] = best[:, : span + 1 - t] + costs[:, p, t, None]
        picks.append(tried.argmin(0))
        best = tried.min(0)
    assert low + span == total
    out, at = np.zeros((rows, parts), np.int64), np.full(rows, span)
    for p in reversed(range(parts)):
        t = picks[p][np.arange(rows), at]
        out[:, p] = t - 1
        at = at - t
    return out


def links(different: DataFrame, radius: int = RADIUS, parts: int = PARTITIONS, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links between different fingerprints at ``radius`` (2 at most) or fewer bits, enough to
    connect all that belong together."""
    if radius > 2:
        raise ValueError("buckets are linked through one-bit variants, which holds up to radius 2")
    ship(different.sparkSession)
    groups = correlated_partitions(different, parts)
    masks = [signed(mask_of(g)) for g in groups]
    widths = [len(g) for g in groups]

    # How many fingerprints share each partition's value with this one.
    own = different.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for p, m in enumerate(masks)])).alias("s"),
    ).select("fp", "s.p", "s.v")
    sizes = stored(own.groupBy("p", "v").agg(F.count("*").alias("members")), "buckets")
    counted = own.join(sizes, ["p", "v"])
    # A bit's neighbour bucket is taken to be as large as the mean bucket of its partition.
    means = {p: m for p, m in sizes.groupBy("p").agg(F.avg("members").alias("m")).collect()}
    by_mark = counted.groupBy("fp").agg(F.sort_array(F.collect_list(F.struct("p", "members"))).alias("s"))

    def choose(batches):
        for pdf in batches:
            members = np.array([[x["members"] for x in s] for s in pdf["s"]], np.float64).reshape(-1, parts)
            costs = np.zeros((len(members), parts, 3))  # thresholds -1, 0, 1
            costs[:, :, 1] = 1 + members
            for p in range(parts):
                costs[:, p, 2] = (1 + widths[p]) * (1 + means.get(p, 0.0)) + members[:, p]
            chosen = thresholds(costs, radius - parts + 1)
            yield pd.DataFrame({"fp": pdf["fp"], "t": list(chosen)})

    chosen = by_mark.mapInPandas(choose, "fp long, t array<long>")
    probes = []
    for p, group in enumerate(groups):
        v = F.col("fp").bitwiseAND(F.lit(masks[p]))
        flips = [v.bitwiseXOR(F.lit(signed(1 << b))) for b in group]
        t = F.element_at("t", p + 1)
        tried = F.when(t == 0, F.array(v)).when(t == 1, F.array(v, *flips))
        probes.append(_labelled(tried, p))
    empty = F.array().cast("array<struct<p:int,v:long>>")
    probing = stored(
        chosen.select("fp", F.explode(F.concat(*[F.coalesce(x, empty) for x in probes])).alias("s"))
        .select("fp", "s.p", "s.v")
        .join(sizes, ["p", "v"]),
        "probes",
    )
    few = probing.filter(F.col("members") <= bucket)
    candidates = few.join(own.withColumnRenamed("fp", "other"), ["p", "v"])
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius
    pairs = candidates.filter((F.col("fp") != F.col("other")) & near).select(
        F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")
    )

    # Large buckets: every member announces its variants; a probe from outside only itself.
    def announced(rows: DataFrame, variants: bool) -> DataFrame:
        of_part = None
        for p, m in enumerate(masks):
            inside = F.col("fp").bitwiseAND(F.lit(signed(~m & (2**64 - 1)))).bitwiseOR(F.col("v"))
            rest = [b for b in range(64) if b not in groups[p]] if variants else []
            keys = F.array(inside, *[inside.bitwiseXOR(F.lit(signed(1 << b))) for b in rest])
            of_part = F.when(F.col("p") == p, keys) if of_part is None else of_part.when(F.col("p") == p, keys)
        return rows.select("p", "fp", F.explode(of_part).alias("variant"))

    large = counted.filter(F.col("members") > bucket)
    outside = probing.filter((F.col("members") > bucket) & (F.col("fp").bitwiseAND(_mask(masks)) != F.col("v")))
    variants = stored(announced(large, True).unionByName(announced(outside, False)), "variants")
    if radius < 2:
        # A variant links its announcer only to the member that it is itself; radius 0 links none.
        itself = variants.filter("fp = variant").select("p", "variant")
        met = variants.filter("fp <> variant").join(itself, ["p", "variant"])
        return pairs.unionByName(met.filter(F.lit(radius == 1)).select(F.col("fp").alias("a"), F.col("variant").alias("b")))
    lowest = variants.groupBy("p", "variant").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    stars = variants.join(lowest.drop("n"), ["p", "variant"]).filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(stars)


def _labelled(values: Column, partition: int) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(partition).alias("p"), v.alias("v")))


def _mask(masks: list[int]):
    """The mask of the row's partition."""
    return F.element_at(F.array(*[F.lit(m) for m in masks]), F.col("p") + 1)


def groups(
    docs: DataFrame, words: int = 3, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    marks = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    firsts = stored(marks.groupBy("fp").agg(F.min("id").alias("first")), "different")
    roots = components(links(firsts, radius)).select(F.col("node").alias("fp"), "root")
    rooted = firsts.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(of_root, "root").select("fp", "component_id")
    return marks.join(named, "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
