"""Language model whose quantised n-gram counts live in a log-frequency Bloom filter.

A count c is kept as its level ``1 + floor(log_base(c))``; an n-gram of level q is entered q times, as
(n-gram, 1) to (n-gram, q), and its level is read back by probing upwards until a probe fails (Talbot &
Osborne 2007). The filter is cut into blocks; a key's probes all fall into its block, so blocks are built
independently, each by one task. There are as many blocks as the entries of all words, and of all pairs that
occur ``least_pairs`` times, need at the wanted rate of false positives. A filter of up to ``filter_bytes`` is
broadcast. A larger one stays where it is stored: the texts' different n-grams go to the blocks by a shuffle,
piece by piece, and their levels come back. Both ways give the same scores. Counts themselves are exact and
cover all training text; pairs are counted by 64-bit keys.

Probabilities are smoothed towards the unigram: P(w|v) = (c(vw) + strength * P(w)) / (c(v) + strength),
P(w) = (c(w) + alpha) / (N + alpha * (V + 1)), with the counts as the filter gives them.

The base score needs exact counts. Words that make up 1/``head`` or more of all training tokens (at most
``head`` of them, none over ``HEAD_BYTES`` bytes) are broadcast; all others are joined with the count table.
So neither a frequent word nor a large vocabulary meets in one task.

Defined results: NULL text counts as empty, which is one end token. Rows with the same id are scored each
for itself. A row without an id is scored, never trained on. Without training text all counts are zero and
the base probability is 1 for each token's only class, log10(0.1/0.1) = 0. Texts of any length are scored
whole, by one task each. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_map, as_batch, discard, held_out, narrow, rows_of, stored

END = "\n"  # cannot be a word: words hold no white space
ALPHA = 0.1
HEAD = 1 << 21
HEAD_BYTES = 32
BLOCK_BYTES = 1 << 16
#: Different words that a task counts at once, and rows that it hands over at once.
WORDS, ROWS = 1 << 18, 1 << 14
#: Bytes of text that are counted together, large for a better combination before the shuffle.
PIECE = 16 << 20
#: Blocks that one task holds at once when n-grams are sent to them.
TOGETHER = 16
#: Bits of a key that tell it from others in its block; the rest choose the block.
LOW_BITS = 40
LOW = np.uint64((1 << LOW_BITS) - 1)
BASE = 2.0
STRENGTH = 32.0
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x + _C1
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def word_keys(words: list[bytes]) -> np.ndarray:
    import xxhash

    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, 42) for w in words), np.uint64, len(words))


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first) + second)


class LogFrequencyFilter:
    """A blocked Bloom filter over (key, level)."""

    def __init__(self, blocks: int, hashes: int, bits: np.ndarray | None = None, first: int = 0):
        """``bits``, if given, are those of the blocks from ``first`` on."""
        self.blocks, self.hashes, self.first = blocks, hashes, np.uint64(first)
        self.bits = np.zeros(blocks * BLOCK_BYTES, np.uint8) if bits is None else bits

    @staticmethod
    def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
        return (keys >> np.uint64(LOW_BITS)) % np.uint64(blocks)

    def places(self, low: np.ndarray, level: int, probe: int) -> tuple[np.ndarray, np.ndarray]:
        """Byte and bit of one probe within the block, from the lower bits of the key."""
        h = mix(low + np.uint64((level * 0xD1B54A32D192ED03 + probe * 0x8CB92BA72F3D8DD7) % 2**64))
        at = h & np.uint64(8 * BLOCK_BYTES - 1)
        return at >> np.uint64(3), (np.uint64(1) << (at & np.uint64(7))).astype(np.uint8)

    def add(self, keys: np.ndarray, levels: np.ndarray) -> None:
        base = (self.block_of(keys, self.blocks) - self.first) * np.uint64(BLOCK_BYTES)
        low = keys & LOW
        for level in range(1, int(levels.max(initial=0)) + 1):
            some = levels >= level
            for probe in range(self.hashes):
                byte, bit = self.places(low[some], level, probe)
                np.bitwise_or.at(self.bits, (base[some] + byte).astype(np.int64), bit)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key, 0 if it isn't held."""
        return self.levels_in(self.block_of(keys, self.blocks) - self.first, keys & LOW)

    def levels_in(self, block: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The same, from the block (of those held here) and the lower bits of each key."""
        out = np.zeros(len(low), np.int64)
        left = np.arange(len(low))
        base = block * np.uint64(BLOCK_BYTES)
        level = 1
        while len(left):
            for probe in range(self.hashes):
                byte, bit = self.places(low[left], level, probe)
                left = left[(self.bits[(base[left] + byte).astype(np.int64)] & bit) > 0]
            out[left] = level
            level += 1
            if level > 64:
                break
        return out


def level_of(counts: np.ndarray, base: float = BASE) -> np.ndarray:
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(base) + 1e-9), 0).astype(np.int64)


def count_of(levels: np.ndarray, base: float = BASE) -> np.ndarray:
    """The middle of the counts that share a level; level 1 with base 2 is exactly 1."""
    low, high = base ** (levels - 1.0), np.maximum(base**levels - 1, base ** (levels - 1.0))
    return np.where(levels > 0, (np.ceil(low) + np.maximum(np.ceil(high), np.ceil(low))) / 2, 0.0)


def token_counts(base: DataFrame) -> DataFrame:
    """``word, c`` over the training rows of ``base (text, held_out)``, the end mark included. Each task counts
    its own texts, up to ``WORDS`` different words at once; then the counts are summed by word."""
    wanted = base.sparkSession.createDataFrame([], "word string, c long").schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: defaultdict[bytes, int] = defaultdict(int)

        def taken() -> Iterator[pa.RecordBatch]:
            words = list(found)
            for at in range(0, len(words), ROWS):
                part = words[at : at + ROWS]
                yield as_batch({"word": [w.decode() for w in part], "c": [found[w] for w in part]}, wanted)
            found.clear()

        for columns in rows_of(batches, 1 << 20):
            for text in columns["text"]:
                for word in text.encode().lower().split():
                    found[word] += 1
                found[END.encode()] += 1
                if len(found) >= WORDS:
                    yield from taken()
        yield from taken()

    partial = base.filter("NOT held_out").select("text").mapInArrow(count, wanted)
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def tokens_of(text: str) -> list[str]:
    return [w.decode() for w in text.encode().lower().split()] + [END]


def numbered(texts: list[str]) -> tuple[list[bytes], list[np.ndarray]]:
    """The different words of the texts, and each text as their numbers."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = []
    for text in texts:
        words = text.encode().lower().split()
        words.append(END.encode())
        ids.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    return list(number), ids


def pair_counts(base: DataFrame, parts: int, least: int) -> DataFrame:
    """``key, c`` of the pairs of words that occur ``least`` times or more. Each Arrow batch is
    counted in its task; a group sums the batches' counts of its share of the keys. ``parts`` grows with
    the number of tokens, so a group's size does not."""

    def count(columns: dict[str, list]) -> dict[str, list]:
        words, ids = numbered([t for t, out in zip(columns["text"], columns["held_out"], strict=True) if not out])
        pairs, n = np.unique(_codes(ids), return_counts=True)
        keys = word_keys(words)
        hashed = pair_keys(keys[pairs >> 32], keys[pairs & 0xFFFFFFFF])
        part = (hashed % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        out = {"part": [], "keys": [], "counts": []}
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            some = order[cuts[p] : cuts[p + 1]]
            out["part"].append(p)
            out["keys"].append(hashed[some].tobytes())
            # A batch's texts are bounded by the Arrow batch size, its counts by 32 bits.
            out["counts"].append(n[some].astype("<u2" if n[some].max() < 65536 else "<u4").tobytes())
        return out

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, "<u8") for k in pdf["keys"]])
        counts = np.concatenate(
            [np.frombuffer(c, "<u2" if len(c) * 4 == len(k) else "<u4").astype(np.int64) for k, c in zip(pdf["keys"], pdf["counts"], strict=True)]
        )
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sums = np.add.reduceat(counts, first)
        kept = sums >= least
        return pd.DataFrame({"key": keys[first][kept].view(np.int64), "c": sums[kept]})

    partial = arrow_map(base, "part int, keys binary, counts binary", count, PIECE)
    return partial.groupBy("part").applyInPandas(add, "key long, c long")


def _codes(ids: list[np.ndarray]) -> np.ndarray:
    """The pairs of all texts, in order, each as one number."""
    return np.concatenate([(t[:-1] << 32) | t[1:] for t in ids]) if ids else np.zeros(0, np.int64)


def build_filter(grams: DataFrame, error: float, base: float) -> tuple[DataFrame, int, int]:
    """The filter of all ``grams (key, c)`` as stored rows ``block, bits``, the number of its blocks, empty ones
    included, and of hashes. The driver receives a count for each level."""
    level = (1 + F.floor(F.log(F.col("c").cast("double")) / math.log(base) + 1e-9)).cast("int")
    leveled = grams.select("key", level.alias("level"))
    entries = sum(r["level"] * r["n"] for r in leveled.groupBy("level").agg(F.count("*").alias("n")).collect())
    hashes = max(1, round(-math.log2(error)))
    blocks = max(1, math.ceil(entries * hashes / math.log(2) / (8 * BLOCK_BYTES)))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        keys = pdf["key"].to_numpy(np.int64).view(np.uint64)
        made = LogFrequencyFilter(1, hashes)
        made.add(keys, pdf["level"].to_numpy(np.int64))
        return pd.DataFrame({"block": [int(key[0])], "bits": [made.bits.tobytes()]})

    block = F.pmod(F.shiftrightunsigned("key", 40), F.lit(blocks)).alias("block")
    made = leveled.select(block, "key", "level").groupBy("block").applyInPandas(build, "block long, bits binary")
    return stored(made, "filter"), blocks, hashes


def filled(rows: list, first: int, blocks: int) -> np.ndarray:
    """The bits of ``blocks`` blocks from ``first`` on; a block without a row is empty."""
    bits = np.zeros(blocks * BLOCK_BYTES, np.uint8)
    for block, own in rows:
        at = (block - first) * BLOCK_BYTES
        bits[at : at + BLOCK_BYTES] = np.frombuffer(own, np.uint8)
    return bits


def text_scores(
    ids: list[np.ndarray], back: np.ndarray, unique: np.ndarray, single: np.ndarray, joint: np.ndarray, total: int, different: int
) -> list[float]:
    """The texts' scores from the counts of their words and different pairs; ``back`` has the pair at each place."""
    chance = (single + ALPHA) / (total + ALPHA * (different + 1))
    a, b = unique >> 32, unique & 0xFFFFFFFF
    joint = np.minimum(joint, np.minimum(single[a], single[b]))
    value = np.log10((joint + STRENGTH * chance[b]) / (single[a] + STRENGTH))
    out, at = [], 0
    for t in ids:
        out.append(float(np.log10(chance[t[0]]) + value[back[at : at + len(t) - 1]].sum()))
        at += len(t) - 1
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, byte by byte: the lowest of all, then the next, of which the upper ones compress to little."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _from_planes(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0]


def _unpacked(sizes: bytes, tokens: bytes, words: bytes) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """A piece's texts as numbers, the keys of its words, its different pairs and the pair at each place."""
    ids = np.split(_from_planes(tokens).astype(np.int64), np.cumsum(np.frombuffer(sizes, "<u4"))[:-1])
    unique, back = np.unique(_codes(ids), return_inverse=True)
    return ids, np.frombuffer(words, "<u8"), unique, back


def _sent(keys: np.ndarray, unique: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The part of the filter that each key of a piece's words and pairs goes to, what is sent of it (the block's
    number in the part, and the lower bits), and the order in which they are sent."""
    every = np.r_[keys, pair_keys(keys[unique >> 32], keys[unique & 0xFFFFFFFF])]
    block = LogFrequencyFilter.block_of(every, blocks)
    part = (block // np.uint64(TOGETHER)).astype(np.int64)
    sent = (block % np.uint64(TOGETHER) << np.uint64(LOW_BITS)) | (every & LOW)
    # One sort where part and key fit in 64 bits, as they do for filters of up to 2^40 bytes.
    if blocks < TOGETHER << (64 - LOW_BITS - TOGETHER.bit_length()):
        order = np.argsort((part.view(np.uint64) << np.uint64(LOW_BITS + TOGETHER.bit_length())) | sent, kind="stable")
    else:
        order = np.lexsort((sent, part))
    return part, sent, order


def _coded(ascending: np.ndarray) -> bytes:
    """Ascending numbers of 44 bits as differences: their lower four bytes, then the upper two of each, which are
    mostly zero and vanish when the shuffle is compressed."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    return (steps & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (steps >> np.uint64(32)).astype("<u2").tobytes()


def _decoded(coded: bytes) -> np.ndarray:
    n = len(coded) // 6
    low, high = np.frombuffer(coded, "<u4", n), np.frombuffer(coded, "<u2", n, 4 * n)
    return np.cumsum(low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32), dtype=np.uint64)


def routed_scores(pieces: DataFrame, made: DataFrame, blocks: int, hashes: int, total: int, different: int) -> DataFrame:
    """``row, score`` of the texts of ``pieces (row, sizes, tokens, words)``; a piece's texts have the rows
    from its own on. No task holds more than ``TOGETHER`` blocks. The filter is removed as soon as it has answered."""

    def send(columns: dict[str, list]) -> dict[str, list]:
        out = {"part": [], "row": [], "keys": []}
        for row, *piece in zip(columns["row"], columns["sizes"], columns["tokens"], columns["words"], strict=True):
            _, keys, unique, _ = _unpacked(*piece)
            part, sent, order = _sent(keys, unique, blocks)
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
            for some in np.split(order, cuts[1:]):
                out["part"].append(int(part[some[0]]))
                out["row"].append(row)
                out["keys"].append(_coded(sent[some]))
        return out

    def look_up(key: tuple, asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        first = int(key[0]) * TOGETHER
        bits = filled(list(zip(own["block"], own["bits"], strict=True)), first, TOGETHER)
        model = LogFrequencyFilter(blocks, hashes, bits, first)
        levels = []
        for coded in asked["keys"]:
            sent = _decoded(coded)
            found = model.levels_in(sent >> np.uint64(LOW_BITS), sent & LOW).astype(np.uint8)
            levels.append(zlib.compress(found.tobytes(), 1))
        return pd.DataFrame({"row": asked["row"].astype("int64"), "part": asked["part"].astype("int64"), "levels": levels})

    def finish(key: tuple, piece: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        ids, keys, unique, back = _unpacked(*(piece[c].iloc[0] for c in ("sizes", "tokens", "words")))
        _, _, order = _sent(keys, unique, blocks)
        levels = np.zeros(len(order), np.int64)
        levels[order] = np.frombuffer(b"".join(map(zlib.decompress, got.sort_values("part")["levels"])), np.uint8)
        counts = count_of(levels)
        scores = text_scores(ids, back, unique, counts[: len(keys)], counts[len(keys) :], total, different)
        return pd.DataFrame({"row": int(key[0]) + np.arange(len(ids)), "score": scores})

    asked = arrow_map(pieces, "part long, row long, keys binary", send)
    own = made.withColumn("part", F.floor(F.col("block") / TOGETHER))
    levels = asked.groupBy("part").cogroup(own.groupBy("part")).applyInPandas(look_up, "row long, part long, levels binary")
    # Stored, so that the keys are gone from the disk before the pieces are moved, and these before the scores are.
    levels = stored(levels, "levels")
    discard(made)
    scores = pieces.groupBy("row").cogroup(levels.groupBy("row")).applyInPandas(finish, "row long, score double")
    scores = stored(scores, "scores")
    discard(levels)
    return scores


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    divisor: int = 10,
    rest: int = 0,
    filter_bytes: int = 1 << 25,
    error: float = 0.01,
    least_pairs: int = 2,
    head_size: int = HEAD,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row. Trained on
    rows whose crc32 of the id leaves another remainder than ``rest``."""
    spark = docs.sparkSession
    base = narrow(docs, id_col, text_col, held_out(id_col, divisor, rest).alias("held_out"))
    counts = stored(token_counts(base), "word-counts")
    total, different = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = counts.filter((F.col("c") * head_size >= total) & (F.octet_length("word") <= HEAD_BYTES)).collect()
    words = [r["word"] for r in top]
    head = spark.sparkContext.broadcast(
        {
            "index": {w.encode(): i for i, w in enumerate(words)},
            "c": np.array([r["c"] for r in top], np.float64),
        }
    )
    parts = max(8, -(-total // (1 << 20)))
    pairs = stored(pair_counts(base, int(parts), least_pairs), "pair-counts")
    # The same hash as word_keys: XXH64 of the bytes, seed 42.
    singles = counts.select(F.xxhash64("word").alias("key"), "c")
    made, blocks, hashes = build_filter(singles.unionByName(pairs), error, BASE)
    discard(pairs)
    routed = blocks * BLOCK_BYTES > filter_bytes
    bits = None if routed else filled(made.collect(), 0, blocks)
    if not routed:
        discard(made)
    held = spark.sparkContext.broadcast({"bits": bits})
    scale = total + ALPHA * (different + 1)

    def rate(columns: dict[str, list]) -> dict[str, list]:
        index, exact = head.value["index"], head.value["c"]
        words, ids = numbered(columns["text"])
        keys = word_keys(words)
        in_head = np.array([index.get(w, -1) for w in words], np.int64)
        known = in_head >= 0
        value = np.zeros(len(words))
        if len(exact):
            value[known] = np.log10((exact[in_head[known]] + ALPHA) / scale)
        out = {k: [] for k in ("doc_id", "held_out", "n_tokens", "head_known", "head_score", "tail")}
        for key, outside, t in zip(columns["id"], columns["held_out"], ids, strict=True):
            out["doc_id"].append(key)
            out["held_out"].append(outside)
            out["n_tokens"].append(len(t))
            out["head_known"].append(int(known[t].sum()))
            out["head_score"].append(math.fsum(value[t]))
            out["tail"].append([words[i].decode() for i in t[~known[t]].tolist()])
        if routed:
            more = [None] * (len(ids) - 1)
            out["sizes"] = [np.array([len(t) for t in ids], "<u4").tobytes(), *more]
            out["tokens"] = [_planes(np.concatenate(ids)), *more]
            out["words"] = [keys.tobytes(), *more]
            return out
        # All pairs of the batch, each different one probed once, if the filter has both its words.
        model = LogFrequencyFilter(blocks, hashes, held.value["bits"])
        single = count_of(model.levels(keys))
        unique, back = np.unique(_codes(ids), return_inverse=True)
        a, b = unique >> 32, unique & 0xFFFFFFFF
        joint = np.zeros(len(unique))
        try_these = np.flatnonzero((single[a] > 0) & (single[b] > 0))
        joint[try_these] = count_of(model.levels(pair_keys(keys[a[try_these]], keys[b[try_these]])))
        out["score"] = text_scores(ids, back, unique, single, joint, total, different)
        return out

    schema = "doc_id long, held_out boolean, n_tokens long, head_known long, head_score double, tail array<string>, "
    schema += "sizes binary, tokens binary, words binary" if routed else "score double"
    rated = stored(arrow_map(base, schema, rate).withColumn("row", F.monotonically_increasing_id()), "rated")
    if routed:
        pieces = rated.filter("sizes IS NOT NULL").select("row", "sizes", "tokens", "words")
        scores = routed_scores(pieces, made, blocks, hashes, total, different)
        rated = rated.drop("sizes", "tokens", "words")
    # The other words, each at most total / head_size times in the training text, or too long to broadcast.
    tail = rated.select("row", F.explode("tail").alias("word")).join(counts, "word", "left")
    rare = tail.groupBy("row").agg(
        F.count("c").alias("tail_known"),
        F.sum(F.log10((F.coalesce("c", F.lit(0)) + F.lit(ALPHA)) / F.lit(scale))).alias("tail_score"),
    )
    zero = F.lit(0)
    rated = rated.drop("tail").join(rare, "row", "left")
    if routed:
        rated = rated.join(scores, "row")
    return rated.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("tail_score", zero.cast("double"))).alias("base_score"),
        "score",
    )
