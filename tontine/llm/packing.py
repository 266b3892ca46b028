"""Packing of documents into sequences of bounded length: best fit, then swap-based local search.

``pieces`` turns documents into token pieces; ``pack`` places pieces in sequences. Pieces are dealt at
random into groups of bounded size, each packed in one task: best fit decreasing first, then the
emptiest sequence is given up piece by piece, by moving pieces, exchanging one for one, or two for one,
with fuller sequences. Each step moves tokens from the emptiest to a fuller sequence and so increases
the sum of squared fills; it ends when nothing fits or the lower bound is reached. A group wastes one
sequence at most beyond what its best-fit rest leaves.

Defined results: a NULL or empty text is the end mark alone, one token. Rows with the same id are packed
each for itself; a missing id is kept. Pieces of equal length are taken in the order of their rows. Long texts are
cut into full pieces, each a sequence of its own, and a rest. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_map, narrow, ship, stored
from tontine.llm.wordtokens import WordTokenizer

GROUP = 16_384
#: The emptiest sequences that also exchange among themselves, and how often at most.
EMPTIEST, EXCHANGES = 24, 400


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids`` on request) of every document's pieces."""
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(columns: dict[str, list]) -> dict[str, list]:
        encode = WordTokenizer.of(tokenizer_path)
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        for key, tokens in zip(columns["id"], encode.batch(columns["text"]), strict=True):
            tokens += end
            for at in range(0, len(tokens), step):
                part = tokens[at : at + step]
                out["doc_id"].append(key)
                out["piece"].append(at // step)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                if with_ids:
                    out["ids"].append(np.frombuffer(part, "<u4").astype("i4"))
        return out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return arrow_map(narrow(docs, id_col, text_col), schema, cut)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit decreasing. Open sequences are stacked by the room they have left; the bits of one
    number say which stacks are not empty."""
    bins: list[list[int]] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = filled >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = stacks[room].pop()
            if not stacks[room]:
                filled &= ~(1 << room)
            bins[chosen].append(item)
        else:
            room, chosen = capacity, len(bins)
            bins.append([item])
        stacks[room - size].append(chosen)
        filled |= 1 << (room - size)
    return bins


def improve(lengths: np.ndarray, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty underfull sequences by exchanges with fuller ones, emptiest first."""
    place = np.empty(len(lengths), np.int64)
    for number, members in enumerate(bins):
        place[members] = number
    room = capacity - np.bincount(place, weights=lengths, minlength=len(bins)).astype(np.int64)
    alive = np.ones(len(bins), bool)
    bound = -(-int(lengths.sum()) // capacity)

    def gained(size: int, victim: int) -> tuple[int, int] | None:
        """The item whose exchange for ``size`` tokens of the victim fills its sequence most."""
        gain = size - lengths
        gain[(gain <= 0) | (gain > room[place]) | (place == victim)] = 0
        best = int(gain.argmax()) if len(gain) else 0
        return (best, int(gain[best])) if len(gain) and gain[best] > 0 else None

    def exchange(out: list[int], back: list[int], victim: int, target: int) -> None:
        place[out], place[back] = target, victim
        moved = int(lengths[out].sum() - lengths[back].sum()) if back else int(lengths[out].sum())
        room[target] -= moved
        room[victim] += moved

    def exchange_among_emptiest() -> bool:
        """One for one or two for one between any two of the emptiest sequences, if it adds to the sum
        of squared fills."""
        few = [b for b in np.argsort(np.where(alive, -room, 1), kind="stable")[:EMPTIEST].tolist() if alive[b] and room[b] > 0]
        held = {b: np.flatnonzero(place == b) for b in few}
        for a in few:
            for b in few:
                if a == b or not len(held[a]) or not len(held[b]):
                    continue
                give, take = held[a], held[b]
                one = np.triu_indices(len(take), 1)
                sizes = np.r_[lengths[take], lengths[take[one[0]]] + lengths[take[one[1]]]]
                gain = sizes[None, :] - lengths[give][:, None]
                gain[(gain <= 0) | (gain > room[a]) | (gain <= room[a] - room[b])] = 0
                if gain.max(initial=0) > 0:
                    x, y = np.unravel_index(int(gain.argmax()), gain.shape)
                    moved = [int(take[y])] if y < len(take) else [int(take[one[i][y - len(take)]]) for i in (0, 1)]
                    exchange(moved, [int(give[x])], b, a)
                    return True
        return False

    exchanges = 0
    while alive.sum() > bound:
        victim = int(np.where(alive, room, -1).argmax())
        before = place.copy(), room.copy()
        while True:
            members = np.flatnonzero(place == victim)
            if not len(members):
                break
            members = members[np.argsort(-lengths[members], kind="stable")]
            done = False
            others = np.where(alive & (np.arange(len(room)) != victim), room, -1)
            for item in members.tolist():  # move
                fits = np.where(others >= lengths[item], others, capacity + 1)
                if fits.min() <= capacity:
                    exchange([item], [], victim, int(fits.argmin()))
                    done = True
                    break
            if done:
                continue
            for item in members.tolist():  # one for one
                if found := gained(int(lengths[item]), victim):
                    exchange([item], [found[0]], victim, int(place[found[0]]))
                    done = True
                    break
            if done:
                continue
            few = members[:24].tolist()
            for i, a in enumerate(few):  # two for one
                for b in few[i + 1 :]:
                    if found := gained(int(lengths[a] + lengths[b]), victim):
                        exchange([a, b], [found[0]], victim, int(place[found[0]]))
                        done = True
                        break
                if done:
                    break
            if not done:
                break
        if not (place == victim).any():
            alive[victim] = False
            continue
        place[:], room[:] = before
        exchanges += 1
        if exchanges > EXCHANGES or not exchange_among_emptiest():
            break
    order = np.argsort(place, kind="stable")
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)] if len(order) else []


def packed(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return improve(lengths, best_fit(lengths, capacity), capacity)


def pack(cut: DataFrame, capacity: int = 2048, group: int = GROUP) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``. A full piece is a sequence of its own; the others
    are dealt at random into groups of about ``group`` pieces."""
    ship(cut.sparkSession)
    names = cut.columns
    numbered = stored(cut.withColumn("piece_row", F.monotonically_increasing_id()), "pieces")
    whole = numbered.filter(F.col("length") >= capacity)
    rest = numbered.filter(F.col("length") < capacity)
    count = -(-rest.count() // group) or 1
    dealt = rest.select("piece_row", "length", F.pmod(F.xxhash64("piece_row"), F.lit(count)).alias("deal"))

    def place(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("piece_row").reset_index(drop=True)
        lengths = part["length"].to_numpy(np.int64)
        sequence, offset = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for number, members in enumerate(packed(lengths, capacity)):
            sizes = lengths[members]
            sequence[members] = (int(key[0]) << 32) + number
            offset[members] = np.cumsum(sizes) - sizes
        return pd.DataFrame({"piece_row": part["piece_row"], "sequence_id": sequence, "offset": offset})

    placed = dealt.groupBy("deal").applyInPandas(place, "piece_row long, sequence_id long, offset long")
    return (
        rest.join(placed, "piece_row")
        .select(*names, "sequence_id", "offset")
        .unionByName(whole.select(*names, (-1 - F.col("piece_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    )
