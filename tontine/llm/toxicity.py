"""Toxicity scores from a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The ratios come from all labelled training rows: for each hashed n-gram, in how many toxic and how many
other texts it occurs, added up in each task before the shuffle. N-grams with a clear ratio
are the features; each has its ratio as its value (Wang & Manning 2012). The weights of the logistic
regression are fitted by follow-the-regularised-leader on at most ``sample`` rows of each class; the bias then
gets the log-odds by which the drawn rows' classes differ from all rows', so the sample moves no decision.

Defined results: NULL text counts as empty and is scored by the bias alone. Labels that are neither 0 nor 1,
or belong to no document, are left out; of several labels of one id the largest counts. Without labels of both classes every
score is the share of toxic labels, or 0. Rows with the same id are scored each for itself; texts of any length are
scored whole, by one task each. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_fold, arrow_map, held_out, narrow, stored
from tontine.llm.ngrams import Ftrl, Unique, feature_ids

ORDERS = (4, 5, 6)
BITS = 20
SAMPLE = 4000
#: Up to so many labels (an id and a number each) are broadcast, so that the texts aren't shuffled; more
#: are joined by a shuffle.
BROADCAST_LABELS = 2_000_000
#: Features need this log ratio, and this many texts of their likelier class.
CLEAR = 1.0
TEXTS = 4


@dataclass
class Classifier:
    values: np.ndarray  # of each n-gram: weight times ratio
    bias: float
    unique: Unique | None = None

    def score(self, text: str) -> float:
        if self.unique is None:
            self.unique = Unique(BITS)
        z = self.bias + float(self.values[self.unique(feature_ids(text, ORDERS, BITS))].sum())
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def class_counts(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts that hold each n-gram, by class, and the number of texts of each class."""

    def count(pieces):
        total, unique, rows = np.zeros((2, 1 << BITS), np.int64), Unique(BITS), np.zeros(2, np.int64)
        for columns in pieces:
            for text, label in zip(columns["text"], columns["label"], strict=True):
                total[label, unique(feature_ids(text, ORDERS, BITS))] += 1
                rows[label] += 1
        ids = np.flatnonzero(total.any(0))
        return {"feature": np.r_[ids, -1], "clean": np.r_[total[0, ids], rows[0]], "toxic": np.r_[total[1, ids], rows[1]]}

    sums = arrow_fold(train.select("text", "label"), "feature int, clean long, toxic long", count)
    got = sums.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    feature = got["feature"].to_numpy()
    both = np.stack([got["clean"].to_numpy(), got["toxic"].to_numpy()])
    out, rows = np.zeros((2, 1 << BITS)), np.zeros(2)
    out[:, feature[feature >= 0]] = both[:, feature >= 0]
    if (feature < 0).any():
        rows = both[:, feature < 0].sum(1).astype(float)
    return out, rows


def fit(train: DataFrame, sample: int = SAMPLE, epochs: int = 4) -> Classifier:
    """``train``: rows (id, text, label) with label 0 or 1."""
    counts, rows = class_counts(train)
    if rows.min() == 0:
        share = rows[1] / rows.sum() if rows.sum() else 0.0
        return Classifier(np.zeros(1 << BITS), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))))
    smooth = (counts + 1) / (rows[:, None] + 2)
    ratio = np.log(smooth[1] / smooth[0])
    ratio[(np.abs(ratio) < CLEAR) | (counts.max(0) < TEXTS)] = 0.0
    context = train.sparkSession.sparkContext
    chosen = context.broadcast(ratio != 0)
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 1, min(1.0, 1.1 * sample / rows[1])).otherwise(min(1.0, 1.1 * sample / rows[0]))
    drawn = train.filter(draw < share).select("label", "text", draw.alias("draw"))

    def features(columns):
        unique = Unique(BITS)
        ids = [unique(feature_ids(t, ORDERS, BITS)) for t in columns["text"]]
        return {"label": columns["label"], "draw": columns["draw"], "ids": [np.sort(i[chosen.value[i]]) for i in ids]}

    got = arrow_map(drawn, "label int, draw double, ids array<int>", features).toArrow()
    labels = got["label"].to_numpy()
    data, seen = [], [0, 0]
    for i in np.argsort(got["draw"].to_numpy(), kind="stable").tolist():
        y = int(labels[i])
        if seen[y] < sample:
            seen[y] += 1
            data.append((np.asarray(got["ids"][i].values), y))
    if min(seen) == 0:
        return Classifier(np.zeros(1 << BITS), float(np.log(rows[1] / rows[0])))
    bias = 1 << BITS
    model = Ftrl(bias + 1, 2, alpha=0.3, l1=0.3, l2=0.1)
    scaled = np.r_[ratio, 1.0]
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(data)).tolist():
            ids, y = data[i]
            ids = np.r_[ids, bias]
            model.step(ids, scaled[ids], y)
    weights = model.weights()
    weights = weights[:, 1] - weights[:, 0]
    # A class drawn more sparsely than the other is as much likelier as its rows are more; 0 if all are drawn.
    prior = np.log(rows[1] / rows[0]) - np.log(seen[1] / seen[0])
    return Classifier((weights * scaled)[:bias], float(weights[bias] + prior))


def train_classifier(docs: DataFrame, labels: DataFrame, divisor: int = 5, rest: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Classifier:
    rows = narrow(docs, id_col, text_col, held_out(id_col, divisor, rest).alias("held_out"))
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out("id", divisor, rest))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    known = stored(known, "labels")
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    return fit(rows.filter("NOT held_out").drop("held_out").join(known, "id"), sample)


def score(docs: DataFrame, labels: DataFrame, divisor: int = 5, rest: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(
        train_classifier(docs, labels, divisor, rest, id_col, text_col, label_col, sample)
    )

    def rate(columns):
        scores = np.array([model.value.score(t) for t in columns["text"]])
        return {"doc_id": columns["id"], "held_out": columns["held_out"], "score": scores, "predicted": (scores >= 0.5).astype(int)}

    rows = narrow(docs, id_col, text_col, held_out(id_col, divisor, rest).alias("held_out"))
    return arrow_map(rows, "doc_id long, held_out boolean, score double, predicted int", rate)
