"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training rows, each task adding up its own before the shuffle.
The weights are fitted by follow-the-regularised-leader with an elastic net, on at most ``sample``
training rows for each language, chosen by a hash of the id and the text, in one task; a fifth of them is held
back to fit the temperature that calibrates the scores. Training sees features only, never whole texts.

Defined results: NULL text or no letter: ``und`` with score 1. Without any labelled training row all texts
with a letter are ``und`` with score 0. Rows with a NULL language or id are predicted, never learned from. Rows with
the same id are predicted each for itself; of languages that tie, the first in order of name is given. Texts are
read whole, by one task each. An empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.common import arrow_fold, arrow_map, held_out, narrow
from tontine.llm.ngrams import Ftrl, Unique, feature_ids, softmax, temperature

ORDERS = (1, 2, 3)
BITS = 16
#: Bound of the rows that weights are fitted on, for each language.
SAMPLE = 1500
UNKNOWN = "und"


@dataclass
class Identifier:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    heat: float

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tf_idf(counts, self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not has_letter(text):
            return UNKNOWN, 1.0
        if not self.languages:
            return UNKNOWN, 0.0
        ids, values = self.vector(np.bincount(feature_ids(text, ORDERS, BITS), minlength=1 << BITS))
        p = softmax(values @ self.weights[ids] / self.heat)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids = np.flatnonzero(counts)
    values = (1 + np.log(counts[ids])) * idf[ids]
    norm = np.sqrt((values**2).sum())
    return ids, values / norm if norm else values


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """How many training texts hold each feature, and their number."""

    def count(pieces):
        total, unique, rows = np.zeros(1 << BITS, np.int64), Unique(BITS), 0
        for columns in pieces:
            for text in columns["text"]:
                total[unique(feature_ids(text, ORDERS, BITS))] += 1
                rows += 1
        ids = np.flatnonzero(total)
        return {"feature": np.r_[ids, -1], "n": np.r_[total[ids], rows]}

    sums = arrow_fold(train.select("text"), "feature int, n long", count).groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << BITS)
    found = sums.toArrow()  # one row for each of 2^BITS features at most
    features, counts = found["feature"].to_numpy(), found["n"].to_numpy()
    known = features >= 0
    out[features[known]] = counts[known]
    return out, int(counts[~known].sum())


def fit(train: DataFrame, sample: int = SAMPLE, epochs: int = 3) -> Identifier:
    """``train``: rows (id, text, label) with labels."""
    frequencies, rows = document_frequencies(train)
    idf = np.log((1 + rows) / (1 + frequencies)) + 1
    sizes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Identifier([], idf, np.zeros((1 << BITS, 0)), 1.0)
    # About ``sample`` rows a language by hash: a fraction, then the bound itself.
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for la in languages for x in (la, min(1.0, 1.1 * sample / sizes[la]))])
    drawn = train.filter(draw < share[F.col("label")]).select("label", "text", draw.alias("draw"))

    def features(columns):
        out = {"label": columns["label"], "draw": columns["draw"], "ids": [], "tf": []}
        for text in columns["text"]:
            counts = np.bincount(feature_ids(text, ORDERS, BITS), minlength=1 << BITS)
            ids = np.flatnonzero(counts)
            out["ids"].append(ids)
            out["tf"].append(counts[ids])
        return out

    def learn(pieces):
        weights, heat = fitted(pieces, languages, idf, sample, epochs)
        ids = np.flatnonzero(np.abs(weights).sum(1))
        return {"feature": np.r_[ids, -1], "weights": [*weights[ids], np.array([heat])]}

    # The bounded sample is fitted in one task; the driver gets the weights that are not zero.
    drawn = arrow_map(drawn, "label string, draw double, ids array<int>, tf array<int>", features).repartition(1)
    found = arrow_fold(drawn, "feature int, weights array<double>", learn).toArrow()
    weights, heat = np.zeros((1 << BITS, len(languages))), 1.0
    for feature, row in zip(found["feature"].to_pylist(), found["weights"].to_pylist(), strict=True):
        if feature < 0:
            heat = row[0]
        else:
            weights[feature] = row
    return Identifier(languages, idf, weights, heat)


def fitted(pieces, languages: list[str], idf: np.ndarray, sample: int, epochs: int) -> tuple[np.ndarray, float]:
    """Weights and temperature from rows of features, of which the first ``sample`` a language, by draw, count."""
    rows = []
    for columns in pieces:
        for label, draw, ids, tf in zip(*(columns[c] for c in ("label", "draw", "ids", "tf")), strict=True):
            rows.append((draw, label, np.array(ids, np.int32), np.array(tf, np.int32)))
    rows.sort(key=lambda row: (row[0], row[1], row[2].tobytes(), row[3].tobytes()))
    rng = np.random.default_rng(11)
    seen, data = dict.fromkeys(languages, 0), []
    for _, label, ids, tf in rows:
        if seen[label] < sample:
            seen[label] += 1
            values = (1 + np.log(tf)) * idf[ids]
            data.append((ids, values / max(np.sqrt((values**2).sum()), 1e-12), languages.index(label)))
    back = [x for n, x in enumerate(data) if n % 5 == 4]
    fore = [x for n, x in enumerate(data) if n % 5 != 4] or data
    model = Ftrl(1 << BITS, len(languages), l1=0.01, l2=0.01)
    for _ in range(epochs):
        for i in rng.permutation(len(fore)).tolist():
            model.step(*fore[i])
    weights = model.weights()
    logits = np.array([v @ weights[i] for i, v, _ in back]).reshape(-1, len(languages))
    return weights, temperature(logits, np.array([y for *_, y in back], int))


def train_identifier(docs: DataFrame, divisor: int = 4, rest: int = 2, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE) -> Identifier:
    rows = narrow(docs, id_col, text_col, F.col(label_col).cast("string").alias("label"), held_out(id_col, divisor, rest).alias("held_out"))
    return fit(rows.filter("NOT held_out AND label IS NOT NULL").drop("held_out"), sample)


def identify(docs: DataFrame, divisor: int = 4, rest: int = 2, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(
        train_identifier(docs, divisor, rest, id_col, text_col, label_col, sample)
    )

    def predict(columns):
        results = [model.value.predict(t) for t in columns["text"]]
        return {
            "doc_id": columns["id"],
            "held_out": columns["held_out"],
            "lang_pred": [r[0] for r in results],
            "score": [r[1] for r in results],
        }

    rows = narrow(docs, id_col, text_col, held_out(id_col, divisor, rest).alias("held_out"))
    return arrow_map(rows, "doc_id long, held_out boolean, lang_pred string, score double", predict)
