"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names, for every
operator and every stage of the pipeline."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tontine.llm import (
    bloom_lm,
    collision_search,
    exact_dedup,
    language_id,
    licenses,
    packing,
    pii,
    sentencepiece_codec,
    simhash,
    toxicity,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, row string, score double, "
    "keys string, label string, held_out string, kept string"
)
LONG = " ".join(f"word{i % 977} the" for i in range(30_000))
ROWS = [
    (1, "the cat sat on the mat and the dog sat on the log", "en"),
    (2, None, "en"),
    (3, "", None),
    (None, "le chat est sur la table avec le chien", "fr"),
    (None, None, None),
    (4, "le chat est sur la table avec le chien", "fr"),
    (4, "le chat est sur la table avec le chien", "fr"),
    (5, "le chat  est sur\tla table avec le chien", "fr"),
    (6, LONG, "en"),
    (7, "x" * 200_000, "en"),
    (8, " \n\t ", "en"),
    (9, "... 123 !!", None),
    (10, "Released under the MIT License. mail a.b@c.de", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, "s", len(t or ""), 7, "r", 0.5, "k", "l", "h", "y") for i, t, lang in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (4, 0), (4, 0), (6, 0), (None, 1), (99, 1), (10, None)], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None),
        (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [-1.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0]), (20, [0.0, 2.0]),
    ]
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")


WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def operators(labels):
    return {
        "licenses": lambda d: licenses.scan(d),
        "bloom_lm": lambda d: bloom_lm.score(d, filter_bytes=1 << 18),
        "sentencepiece": lambda d: sentencepiece_codec.encode(d, PIECES),
        "language_id": lambda d: language_id.identify(d),
        "packing": lambda d: packing.pack(packing.pieces(d, WORDS)),
        "simhash": lambda d: simhash.groups(d),
        "toxicity": lambda d: toxicity.score(d, labels),
        "pii": lambda d: pii.find(d),
        "exact_dedup": lambda d: exact_dedup.groups(d),
    }


ROW_FOR_ROW = ["bloom_lm", "sentencepiece", "language_id", "simhash", "toxicity", "pii", "exact_dedup"]


@pytest.mark.parametrize("name", ROW_FOR_ROW)
def test_one_row_for_each_row(docs, labels, name):
    got = operators(labels)[name](docs).select("doc_id").collect()
    assert sorted((r.doc_id for r in got), key=lambda x: (x is None, x)) == sorted(
        (i for i, *_ in ROWS), key=lambda x: (x is None, x)
    )


@pytest.mark.parametrize("name", ["licenses", "packing", *ROW_FOR_ROW])
def test_empty_table(docs, labels, name):
    assert operators(labels)[name](docs.limit(0)).count() == 0


def test_exact_dedup_groups(docs):
    got = exact_dedup.groups(docs).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {by_id[i].keep_id for i in (4, 5)} == {4}
    assert by_id[5].group_size == 4 and by_id[1].kept
    # NULL, NULL and the empty text are one group; white space is a text of its own.
    assert by_id[2].group_size == 3 and by_id[8].group_size == 1
    assert sum(r.kept for r in got) == 8


def test_language_of_texts_without_letters(docs):
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert all((got[i].lang_pred, got[i].score) == ("und", 1.0) for i in (2, 3, 8, 9))
    assert got[None].held_out


def test_toxicity_of_empty_texts(docs, labels):
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    assert got[2].score == got[3].score
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_search_leaves_unusable_vectors_out(vectors):
    got = collision_search.nearest(vectors, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 2, 0.5), (0, 3, 2, 0.5), (0, 4, 20, 0.0), (0, 5, 8, -1.0),
        (20, 1, 2, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.0), (20, 4, 1, 0.0), (20, 5, 8, 0.0),
    ]
    assert collision_search.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_stages(spark, docs):
    """Each stage takes the table as it is; all but the last keep its columns, and what is clean stays."""
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert sorted(out.columns) == sorted(docs.columns), name
        assert 1 in [r.doc_id for r in out.select("doc_id").collect()], name
        assert stage(spark, docs.limit(0), "").count() == 0, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, "").count() >= len(ROWS) and last(spark, docs.limit(0), "").count() == 0


def test_stages_with_odd_column_names(spark, docs):
    names = ["__text", "__gone", "__some", "x", "x_", "row"]
    odd = docs.drop("row").select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns and out.filter("doc_id = 1").first()["__text"] == 0, name


def test_stage_decisions(spark, docs):
    stages = dict(corpus_pipeline.STAGES)

    def ids(df):
        return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))

    assert ids(stages["language_id"](spark, docs, ""))[:1] == [1]
    assert not {2, 3, 8, 9} & set(ids(stages["language_id"](spark, docs, "")))
    # Of the four equal French texts one row of id 4 stays; of the empty ones id 2.
    kept = ids(stages["exact_dedup"](spark, docs, ""))
    assert kept.count(4) == 1 and 5 not in kept and 2 in kept and 3 not in kept
    clean = stages["pii"](spark, docs, "").filter("doc_id = 10").first()
    assert clean.text == "Released under the MIT License. mail [EMAIL]" and clean.n_chars == len(clean.text)
