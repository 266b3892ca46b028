"""Each operator against brute force, the library it rebuilds, or held-out labels."""

import math
import pathlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tontine.llm import (
    bloom_lm,
    collision_search,
    components,
    language_id,
    licenses,
    packing,
    pii,
    queries,
    sentencepiece_codec,
    simhash,
    toxicity,
    wordtokens,
)

from tontine.llm.common import CLEANUP, stored
from tontine.session import shared_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("name", list(queries.statements()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = queries.queries()[name](spark, SF).toPandas()
    expected = con.execute(queries.statements()[name]).df()
    assert sorted(map(tuple, got[sorted(got)].itertuples(index=False))) == sorted(
        map(tuple, expected[sorted(expected)].itertuples(index=False))
    )


def license_brute(rows, templates=licenses.TEMPLATES):
    """Containment of every template in every whole text."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []
    out = []
    for i, text in rows:
        held = grams(words(text))
        for name, template in templates:
            wanted = set(grams(words(template)))
            common = wanted & set(held)
            if len(common) >= 0.8 * len(wanted):
                out.append((i, name, len(common) / len(wanted), min(map(held.index, common))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bound", [licenses.BROADCAST_KEYS, 0])
def test_licenses_anywhere_in_whole_texts(spark, monkeypatch, bound):
    """Split, repeated, long and missing texts, and more template keys than are broadcast."""
    monkeypatch.setattr(licenses, "BROADCAST_KEYS", bound)
    named = dict(licenses.TEMPLATES)
    filler = " ".join(f"w{i % 700}" for i in range(1000))
    mit, half = named["MIT"], len(named["MIT"].split()) // 2
    split = " ".join([*mit.split()[:half], filler, *mit.split()[half:]])
    rows = [
        (1, split), (1, split), (2, None), (3, ""), (4, " \n"), (None, f"{filler} {named['ISC']}"), (5, f"{filler} " * 200 + named["GPL-2.0"]),
        (6, named["MPL-2.0"] + " " + named["MPL-2.0"]), (7, " ".join(named.values())), (8, "Licensed under CC BY-SA 4.0."), (9, filler),
        (10, " ".join(mit.split()[: half // 2])),
    ]
    table = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, template string, key string, same int")
    got = licenses.scan(table)
    assert got.columns == ["doc_id", "template", "containment", "first_word"]
    assert sorted(map(tuple, got.collect()), key=repr) == license_brute(rows)
    assert {r.template for r in got.filter("doc_id = 1").collect()} == {"MIT"} and got.filter("doc_id = 1").count() == 2
    assert licenses.scan(table.limit(0)).count() == 0


def test_long_license_inside_a_text(spark):
    words = [f"w{i}" for i in range(300)]
    mit = dict(licenses.TEMPLATES)["MIT"]
    changed = mit.replace("free of charge", "at no cost").replace("merge, publish", "join, print")
    other = " ".join(mit.split()[:40])
    rows = [(1, " ".join([*words, mit, *words])), (2, " ".join([*words[:7], changed])), (3, other)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.template) for r in got) == [(1, "MIT"), (2, "MIT")]
    assert {r.doc_id: r.first_word for r in got}[1] == 300
    assert not re.search("Python|ArrowEval|Pandas", licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString())


def test_base_score(docs, texts):
    tokens = {i: bloom_lm.tokens_of(t) for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    total, different = sum(counts.values()), len(counts)
    # A small head sends most words through the join.
    for r in bloom_lm.score(docs, filter_bytes=1 << 20, head_size=300).collect():
        ws = tokens[r.doc_id]
        expected = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (different + 1))) for w in ws)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), total)
        assert r.base_score == pytest.approx(expected, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) and r.score < 0


def test_filter_holds_what_it_was_given():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    counts = rng.zipf(1.6, 20_000).clip(1, 10**6)
    levels = bloom_lm.level_of(counts)
    made = bloom_lm.LogFrequencyFilter(8, 7)
    made.add(keys, levels)
    got = made.levels(keys)
    assert (got >= levels).all() and (got > levels).mean() < 0.01
    assert (made.levels(rng.integers(0, 2**63, 20_000).astype(np.uint64)) > 0).mean() < 0.01
    low, high = bloom_lm.BASE ** (levels - 1.0), bloom_lm.BASE**levels
    assert ((counts >= low) & (counts < high)).all()
    assert (np.abs(np.log2(bloom_lm.count_of(levels) / counts)) <= 1).all()


def test_pair_counts_in_the_filter(spark):
    """A repeated pair is likelier after its first word than by itself."""
    rows = [(i, "alpha beta gamma delta " * 5) for i in range(1, 40)]
    rows += [(100, "alpha beta"), (101, "beta alpha")]
    got = {r.doc_id: r for r in bloom_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), filter_bytes=1 << 18).collect()}
    assert got[100].base_score == pytest.approx(got[101].base_score) and got[100].score > got[101].score


def test_pairs_of_rare_and_long_words_are_counted(spark):
    """Words too rare or too long to be broadcast have pairs too."""
    rare, long = "mu nu xi", f"{'u' * 40} {'v' * 40} {'w' * 40}"
    rows = [(i, "the " * 2000) for i in range(1, 20)] + [(i, text) for i in range(20, 40) for text in (rare, long)]
    rows += [(100, rare), (101, "xi nu mu"), (102, long), (103, " ".join(reversed(long.split())))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in bloom_lm.score(frame, head_size=100).collect()}
    for a, b in ((100, 101), (102, 103)):
        assert got[a].base_score == pytest.approx(got[b].base_score) and got[a].score > got[b].score + 0.1


@pytest.mark.parametrize("least,size", [(1, 1 << 25), (2, 1)])
def test_scores_match_a_plain_model(docs, texts, least, size):
    """Exact counts, quantised alike; the filter's error is so small here that nothing is found by mistake."""
    tokens = {i: bloom_lm.tokens_of(t) for i, t in texts.items()}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10]
    words = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(t, t[1:], strict=False))
    total = sum(words.values())

    def middle(count):
        low = 1 << (count.bit_length() - 1) if count else 0
        return (low + max(2 * low - 1, low)) / 2 if count else 0.0

    def chance(w):
        return (middle(words[w]) + 0.1) / (total + 0.1 * (len(words) + 1))

    for r in bloom_lm.score(docs, error=2.0**-30, least_pairs=least, filter_bytes=size).collect():
        t = tokens[r.doc_id]
        value = math.log10(chance(t[0]))
        for a, b in zip(t, t[1:], strict=False):
            c = pairs[a, b] if pairs[a, b] >= least else 0
            joint = min(middle(c), middle(words[a]), middle(words[b]))
            value += math.log10((joint + bloom_lm.STRENGTH * chance(b)) / (middle(words[a]) + bloom_lm.STRENGTH))
        assert r.score == pytest.approx(value, rel=1e-9)


def test_codes_of_sent_keys():
    rng = np.random.default_rng(3)
    for n, top in ((0, 44), (1, 44), (5, 44), (20_000, 44), (300, 8)):
        keys = np.sort(rng.integers(0, 1 << top, n, np.uint64))
        assert (bloom_lm._decoded(bloom_lm._coded(keys)) == keys).all() and len(bloom_lm._decoded(bloom_lm._coded(keys))) == n


def test_stored_tables_leave_no_shuffle_files(spark):
    tracker = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return sum(1 for f in tracker.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f and f.endswith(".data"))

    before = shuffles()
    df = spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).count()
    assert stored(df, "cleaned").count() == 97 and shuffles() <= before + 1  # the count itself shuffles
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_filter_size_changes_no_score(docs):
    """A filter too large to broadcast is asked by a shuffle; nothing is left out of it."""
    held, sent = (
        {r.doc_id: (r.score, r.base_score, r.n_known) for r in bloom_lm.score(docs, filter_bytes=size).collect()}
        for size in (1 << 25, 1)
    )
    assert held.keys() == sent.keys()
    assert all(held[i] == pytest.approx(sent[i], rel=1e-12) for i in held)


def test_planes_of_token_numbers():
    rng = np.random.default_rng(4)
    for n, top in ((0, 2), (1, 2), (9, 256), (1000, 1 << 16), (1000, 1 << 32)):
        numbers = rng.integers(0, top, n)
        assert (bloom_lm._from_planes(bloom_lm._planes(numbers)) == numbers).all()
        assert len(bloom_lm._from_planes(bloom_lm._planes(numbers))) == n


@pytest.mark.parametrize("size", [1 << 25, 1])
def test_bloom_lm_keeps_no_table_it_has_read(spark, size):
    folder = pathlib.Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    rows = [(i, f"common words {i % 7} and {i}") for i in range(300)]
    scored = bloom_lm.score(spark.createDataFrame(rows, "doc_id long, text string"), filter_bytes=size)
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.iterdir()) - before}
    assert left == {"word-counts", "rated"} | ({"scores"} if size == 1 else set())
    assert scored.count() == 300


def test_sentencepiece_parity_and_round_trip(docs, texts, spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    odd = [(9001, "  two  spaces   and ▁ marks\n\ttabs 😀 <s> </s> <0x41>"), (9002, " "), (9003, "日本語 تجربة \u0000")]
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = sentencepiece_codec.encode(rows, path)
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    everything = texts | dict(odd)
    for r in got.collect():
        assert r.ids == reference.encode(everything[r.doc_id])
        assert r.parity and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode(got, path).collect()}
    assert all(back[i] == reference.decode(reference.encode(t)) for i, t in everything.items())


def test_unigram_model():
    """A hand-made unigram model, encoded as the SentencePiece library does."""
    import struct

    import sentencepiece

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def block(number, data):
        return varint(number << 3 | 2) + varint(len(data)) + data

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [("▁", -3.0, 1), ("a", -3.5, 1), ("b", -4.0, 1), ("ab", -4.2, 1), ("▁ab", -4.9, 1), ("c", -6.0, 1), ("abc", -9.0, 1)]
    data = b"".join(block(1, block(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + varint(k)) for p, s, k in pieces)
    data += block(2, b"\x18\x01" + varint(35 << 3) + b"\x01")
    data += block(3, block(1, b"identity") + b"\x18\x01\x20\x00")
    model = sentencepiece_codec.Model.read(data)
    assert model.model_type == sentencepiece_codec.UNIGRAM and model.byte_fallback and not model.remove_extra
    made = sentencepiece_codec.rebuilt(model)
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("ab abc", "cab b", "aé b", "abababab"):
        ids = made.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False).ids
        assert ids == reference.encode(text)
        assert made.decode(ids) == text


def test_search_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = collision_search.nearest(table, F.col("vec_id") % 20 == 0, vectors_in_block=200, queries_in_block=10).toPandas()
    pdf = table.toPandas()
    ids, x = pdf["vec_id"].to_numpy(), np.stack(pdf["embedding"]).astype(float)
    right = []
    for q, found in got.groupby("query_id"):
        dots = x @ x[ids == q][0]
        dots[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -dots))[:20]]
        right.append(len(set(best) & set(found["vec_id"])) / 20)
        assert sorted(found["rank"]) == list(range(1, 21))
        assert found["score"].to_numpy() == pytest.approx([dots[ids == v][0] for v in found["vec_id"]], abs=1e-12)
    assert np.mean(right) >= 0.9


def test_language_and_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = language_id.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.filter("lang_pred = lang").count() / got.count() > 0.98
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert ((got["predicted"] == got["toxic"]).mean()) > 0.9 and got[got.toxic == 0]["predicted"].mean() < 0.03


def test_toxicity_sample_moves_no_decision(spark):
    """A capped fit on rare toxic labels predicts as the fit on all rows does."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        toxic = i % 10 == 0
        mark = "zzzzzz" if rnd.random() < (0.95 if toxic else 0.3) else "qqqqqq"
        rows.append((i, f"{mark} {' '.join(rnd.choices(['able', 'baker', 'charlie', 'delta'], k=6))}", int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    whole, capped = (
        {r.doc_id: r for r in toxicity.score(frame.drop("toxic"), frame.drop("text"), sample=n).collect()} for n in (10_000, 200)
    )
    assert np.mean([whole[i].predicted == capped[i].predicted for i in whole]) > 0.97
    assert np.mean([r.score for r in capped.values()]) < 0.15


def test_token_ids_are_those_of_the_library(texts, monkeypatch):
    """Also where texts are cut into pieces here, and where the memory starts anew."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = wordtokens.WordTokenizer(path)
    latin = [chr(c) for c in range(256)]
    rng = random.Random(5)
    odd = [a + b for a in latin for b in latin[:64] + latin[127:192:3]]
    odd += ["".join(rng.choices([*latin, *"''''sStrevemlld  "], k=20)) for _ in range(2000)]
    odd += ["", "a<|endoftext|>b", "İx Œuf ΣΣ", "H̱ é", "你 好", "don't DON'T '''s 's\xa0\xe9\x85"]
    odd += [t or "" for t in texts.values()]
    monkeypatch.setattr(wordtokens, "REMEMBERED", 5000)
    for text, ids in zip(odd, tokenizer.batch(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_pieces_of_latin_text_are_encoded_once():
    tokenizer = wordtokens.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    list(tokenizer.batch(["Word word, WORD. (word)", "word; word \xe9t\xe9 \xc9T\xc9"]))
    assert set(tokenizer.pieces) == {"word", ",", ".", "(", ")", ";", "\xe9t\xe9"} and set(tokenizer.known) == {""}
    # Another normalisation is left to the tokenizer.
    tokenizer.cuts = False
    list(tokenizer.batch(["Word word,"]))
    assert set(tokenizer.known) == {"", "Word", "word,"}


def test_packing(spark, docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(packing.pieces(docs, path), group=150).toPandas()
    encoder = Tokenizer.from_file(path)
    for key, text in texts.items():
        ids = np.array([*encoder.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = got[got.doc_id == key].sort_values("piece")
        assert own["start"].tolist() == list(range(0, len(ids), 2048))
        assert own["ids_crc32"].tolist() == [zlib.crc32(ids[s : s + 2048].tobytes()) for s in own["start"]]
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part["offset"].tolist() == (part["length"].cumsum() - part["length"]).tolist()
        assert part["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= 1.03 * got["length"].sum() / 2048 + 2


def test_local_search_empties_sequences():
    # Best fit decreasing makes 4+4, 3+3+3 and 3; an exchange of 4 for 3+3 makes room for the last.
    lengths = np.array([4, 4, 3, 3, 3, 3])
    assert len(packing.best_fit(lengths, 10)) == 3 and len(packing.packed(lengths, 10)) == 2
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(200, 900, 60)
        first, last = packing.best_fit(lengths, 2048), packing.packed(lengths, 2048)
        assert sorted(sum(last, [])) == list(range(60)) and all(lengths[b].sum() <= 2048 for b in last)
        assert len(last) <= len(first)


def simhash_brute(text):
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(marks, radius):
    """Smallest member of each component, by comparing all pairs."""
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    marks = sorted(marks)
    for i, a in enumerate(marks):
        for b in marks[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {m: find(m) for m in marks}


def test_fingerprints(docs, texts):
    got = {r.doc_id: r.fingerprint for r in simhash.groups(docs).collect()}
    assert got == {i: f"{simhash_brute(t):016x}" for i, t in texts.items()}


@pytest.mark.parametrize("bucket,radius", [(0, 2), (4, 2), (32, 2), (0, 1), (4, 1), (0, 0)])
def test_links_find_every_neighbour(spark, bucket, radius):
    """Clusters, chains and a crowded partition, with small buckets paired, large ones linked by variants."""
    rnd = random.Random(bucket)
    marks = {rnd.getrandbits(64) for _ in range(150)}
    for _ in range(6):
        seed = rnd.getrandbits(64)
        for _ in range(40):
            seed ^= 1 << rnd.randrange(64)
            if rnd.random() < 0.7:
                seed ^= 1 << rnd.randrange(64)
            marks.add(seed)
    crowd = rnd.getrandbits(64)
    marks |= {crowd ^ rnd.getrandbits(20) for _ in range(120)}
    marks |= {crowd ^ (rnd.getrandbits(6) << 40) for _ in range(40)}
    signed = [simhash.signed(m) for m in marks]
    different = spark.createDataFrame([(m,) for m in signed], "fp long")
    got = components.components(simhash.links(different, radius, bucket=bucket)).collect()
    roots = {m: m for m in signed} | {r.node: r.root for r in got}
    assert roots == linked(signed, radius)


def test_components_broadcast_nothing(spark, monkeypatch):
    plans = []
    plain = components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: (plans.append(df), plain(df, label))[1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 103), (103, 101)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {103: 100, 101: 100}
    assert len(plans) > 2 and not any("BroadcastHashJoin" in p._jdf.queryExecution().executedPlan().toString() for p in plans)


def test_thresholds():
    rng = np.random.default_rng(2)
    costs = rng.random((200, 4, 3)) * 10
    got = simhash.thresholds(costs, -1)
    options = [(a, b, c, d) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) for d in (-1, 0, 1) if a + b + c + d == -1]
    for row, chosen in zip(costs, got, strict=True):
        price = lambda t: sum(row[p, x + 1] for p, x in enumerate(t))  # noqa: E731, B023
        assert chosen.sum() == -1 and price(chosen.tolist()) == pytest.approx(min(map(price, options)))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 300)] + [(7, i) for i in range(1000, 1400)] + [(5, 5)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {i: 100 for i in range(101, 301)} | {i: 7 for i in range(1000, 1400)}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")))
                or (kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)))
                or (kind == "phone" and not 9 <= len(digits) <= 15)
            ):
                continue
            out.append((kind, *m.span()))
    return out


def test_plain_spans(texts):
    rnd = random.Random(3)
    parts = ["a", "@", ".", "1", "23", "255", "0", "-", " ", "+", "(", "b.c", "4111111111111111", "x@y.z", "00001", "é", "٣"]
    made = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(8000)]
    for text in [*made, *texts.values()]:
        assert pii.plain(text) == plain_brute(text), text


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
        ("is john at example dot com, yes", "email", "john at example dot com"),
        ("ask jоhn@exаmple.com please", "email", "jоhn@exаmple.com"),
        ("hsr.29(at)mail5.example.com", "email", "hsr.29(at)mail5.example.com"),
        ("plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
        ("no ４１" + "１" * 14 + " card", "card", "４１" + "１" * 14),
        ("ip one nine two dot one six eight dot one dot one end", "ip", "one nine two dot one six eight dot one dot one"),
    ],
)
def test_disguised_spans(text, kind, span):
    ((found, a, b),) = pii.disguised(text, pii.plain(text))
    assert (found, text[a:b]) == (kind, span)
    assert pii.redacted(text, [(found, a, b)]) == text.replace(span, f"[{kind.upper()}]")


@pytest.mark.parametrize(
    ("text", "span", "base"),
    [
        ("ask jоhn@example.com please", "jоhn@example.com", "hn@example.com"),
        ("ask joe@sub.example dot com please", "joe@sub.example dot com", "joe@sub.example"),
        ("host 192.168.1.1５ is up", "192.168.1.1５", "192.168.1.1"),
    ],
)
def test_disguised_span_around_a_plain_one(spark, text, span, base):
    """The plain span stays; the whole is added, and redaction leaves nothing of it."""
    plain = pii.plain(text)
    assert [text[a:b] for _, a, b in plain] == [base]
    ((kind, a, b),) = pii.disguised(text, plain)
    assert text[a:b] == span
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = pii.find(frame, with_text=True).collect()
    assert row.n_added == 1 and row.n_email + row.n_ip == 1
    assert row.redacted == text.replace(span, f"[{kind.upper()}]")


@pytest.mark.parametrize("last", ["ca", "pl", "ru", "jp", "br", "au", "us", "online", "xn--p1ai"])
def test_spoken_address_in_any_top_level_domain(last):
    text = f"is john at example dot {last}, yes"
    ((kind, a, b),) = pii.disguised(text, pii.plain(text))
    assert (kind, text[a:b]) == ("email", f"john at example dot {last}")


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("ping 192 dot 168 dot 0 dot 1 now", "ip", "192 dot 168 dot 0 dot 1"),
        ("adresse 10 point 0 point 0 point 255.", "ip", "10 point 0 point 0 point 255"),
        ("10.0 punkt 0.7", "ip", "10.0 punkt 0.7"),
        ("schreib an max at beispiel punkt de bitte", "email", "max at beispiel punkt de"),
        ("escribe a: ana arroba ejemplo punto es.", "email", "ana arroba ejemplo punto es"),
        ("mailto:joe%40example.com", "email", "joe%40example.com"),
        ("mail joe&#64;example&#46;com please", "email", "joe&#64;example&#46;com"),
        ("mail joe&#x40;example&period;com", "email", "joe&#x40;example&period;com"),
        ("write to john at example dot in.", "email", "john at example dot in"),
        ("write to j.doe at example dot in the evening", "email", "j.doe at example dot in"),
    ],
)
def test_marks_in_words_and_escapes(text, kind, span):
    ((found, a, b),) = pii.disguised(text, pii.plain(text))
    assert (found, text[a:b]) == (kind, span)


@pytest.mark.parametrize(
    "text",
    [
        "meet me at home dot in the park", "the point is at hand, 3 point 5 percent", "version 1 dot 2 dot 3 dot 4 dot 5",
        "300 dot 1 dot 1 dot 1", "un point de vue at large", "100% of AT&T; 5 &amp; 6", "he was at work dot to be fair",
    ],
)
def test_prose_with_marks_in_words(text):
    assert pii.disguised(text, pii.plain(text)) == []


def test_clean_texts_have_no_disguised_spans(texts):
    prose = ["we look at the dot on example.com", "one two three of them at noon", "pay at one two three", "see (at) the end [.]"]
    assert not [s for t in [*texts.values(), *prose] for s in pii.disguised(t, pii.plain(t)) if s[0] != "email"]
    assert not [s for t in prose for s in pii.disguised(t, pii.plain(t))]
