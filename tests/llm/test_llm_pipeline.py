"""The pipeline's rows against a plain version of each stage, on the smallest documents and odd ones."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from test_llm_methods import SF, linked, plain_brute, simhash_brute

import corpus_pipeline
from tontine.llm import pii, simhash
from tontine.llm.common import SMALL_BATCHES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The smallest documents with copies, near copies, junk and personal data put in."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").first()
    words = first.text.split()
    long = " ".join(f"{w} {i % 7}" for i, w in enumerate(words * 30))
    rows = [
        (9000, first.text.replace(" ", "  \n"), "en", "x", 0),
        (9001, "... 1234 ---", None, "x", 0),
        (9002, None, None, "x", 0),
        (9003, long, "en", "x", 0),
        (9004, long + " end", "en", "x", 0),
        (9005, "Write to jane.roe@mail.example.com or +1 (555) 555-1234, thank you very much", "en", "x", 0),
    ]
    path = str(tmp_path_factory.mktemp("corpus"))
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{path}/documents.parquet")
    return path


def test_pipeline(spark, folder):
    from tokenizers import Tokenizer

    got = corpus_pipeline.run(spark, folder).toPandas()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}

    # Language: what has no letter goes; every clean text here is in a learned language.
    texts = {i: t for i, t in texts.items() if t and any(map(str.isalpha, t))}
    first = {}
    for i in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    texts = {i: texts[i] for i in first.values()}
    marks = {i: simhash.signed(simhash_brute(t)) for i, t in texts.items()}
    roots = linked(set(marks.values()), 2)
    kept = {}
    for i in sorted(texts):
        kept.setdefault(roots[marks[i]], i)
    texts = {i: texts[i] for i in kept.values()}
    assert 9000 not in texts and 9004 not in texts and 9005 in texts
    clean = {i: pii.redacted(t, (base := plain_brute(t)) + pii.disguised(t, base)) for i, t in texts.items()}
    assert clean[9005] == "Write to [EMAIL] or [PHONE], thank you very much"

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = set()
    for i, t in clean.items():
        ids = np.array([*encoder.encode(t, add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            expected.add((i, at // 2048, at, len(part), zlib.crc32(part.tobytes())))
    found = got[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert set(map(tuple, found.itertuples(index=False))) == expected and len(found) == len(expected)
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048


def test_stages_pass_rows_in_small_batches(spark, tmp_path):
    """However many long texts a task reads, its Python worker gets a few megabytes at once, from every stage on."""
    path, texts = str(tmp_path / "long"), [(i, f"{i} " + "some words " * 400, "en") for i in range(3000)]
    spark.createDataFrame(texts, "doc_id long, text string, lang string").coalesce(1).write.parquet(path)
    before = {key: spark.conf.get(key) for key in SMALL_BATCHES}

    def sizes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes for b in batches])], ["n"])

    def most():
        return max(r.n for r in spark.read.parquet(path).mapInArrow(sizes, "n long").collect())

    assert most() > 8 << 20
    few = spark.createDataFrame(texts[:20], "doc_id long, text string, lang string")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, few, "")
        assert most() < 3 << 20
        for key, value in before.items():
            spark.conf.set(key, value)
