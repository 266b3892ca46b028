"""The filter audit against counting every order plainly, and the merge of posting lists by itself."""

import itertools
import random
import re

import pytest

from tontine.llm import filter_audit

SCHEMA = "doc_id long, text string, source string, id long, part string, kind int, bits int, n long, key string"
LONG = " ".join(f"word{i % 977} x" for i in range(60_000))


def few(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t)) < 200


def repeated(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    return 100 * len(set(words)) < 50 * len(words)


def capitals(t):
    return 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)


def special(t):
    return bool(re.search(r"[#$%&*|]", t))


def plain_audit(rows, labels):
    docs = [(i, t or "", s or "") for i, t, s in rows]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    marked = []
    for i, t, part in docs:
        copy = i is not None and any(j is not None and j < i and u == t for j, u, _ in docs)
        marked.append((i, part, {c for c, bad in zip("ABCDE", [few(t), repeated(t), capitals(t), special(t), copy], strict=True) if bad}))
    out = []
    for part in {p for _, p, _ in marked}:
        of_part = [(i, fails) for i, p, fails in marked if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(of_part)
            for step, name in enumerate(order, 1):
                failing = [(i, f) for i, f in of_part if name in f]
                removed = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(removed)
                lines.append((
                    part, order, step, len(left), len(removed), len(failing) - len(removed), sum(f == {name} for _, f in of_part),
                    sum(i in good for i, _ in removed), sum(i in toxic for i, _ in removed),
                ))
        out += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


def sample():
    rng = random.Random(5)
    long = " ".join(f"w{i}" for i in range(250))
    pool = [
        None, "", " \n", "short", "AB cd", "a#b", long, long + " &", "x " * 300, "X " * 300, "é" * 60 + "AB", "é" * 200 + " A$", LONG,
        long.upper(), "w " * 150 + long, "A" * 3 + " " * 147, "A" * 3 + " " * 146, " ".join(f"v{i % 100}" for i in range(200)),
        " ".join(f"v{i % 99}" for i in range(200)), "a b " * 199, "tab\tnew\nline\x0bvt\x0cff\rcr ",
    ]
    rows = [(i, rng.choice(pool), rng.choice(["s1", "s2", None, ""])) for i in rng.sample(range(-50, 1000), 150)]
    # Repeated rows and ids, rows without an id, and a third of all rows one text.
    rows += rows[:12] + [(rows[0][0], t, "s1") for t in pool[3:9]] + [(None, t, "s2") for t in pool for _ in range(2)]
    rows += [(2000 + i, "the same text", "hot") for i in range(120)] + [(7_000_000_000, "the same text", "s1")]
    rows += [(3000, "twice", "p1"), (3000, "twice", "p2"), (2999, "twice", "p2")]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, *_ in rng.choices(rows, k=150)] + [(None, 1, 1), (-1, 1, 1)]
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, s, 1, "p", 2, 3, 4, "k") for i, t, s in rows], SCHEMA).repartition(5)
    marks = [(i, q, x, "t", 9, "s") for i, q, x in labels]
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string, bits int, source string")


@pytest.mark.parametrize("longest", [filter_audit.RANGE, 7])
def test_matches_plain_count(spark, monkeypatch, longest):
    monkeypatch.setattr(filter_audit.posting_lists, "__defaults__", (longest,))
    rows, labels = sample()
    got = filter_audit.audit(*frames(spark, rows, labels))
    assert got.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    ]
    assert dict(got.dtypes)["step"] == "int" and {t for c, t in got.dtypes if c not in ("part", "filter_order", "step")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, labels)


def test_lists_are_bounded_and_sorted(spark):
    rows, labels = sample()
    docs, known = frames(spark, rows, labels)
    marks = filter_audit.failures(docs, filter_audit.FILTERS, "doc_id", "text", "source")
    lists = filter_audit.posting_lists(marks, known.selectExpr("doc_id id", "quality bits"), 4, 2, 10).collect()
    assert sum(sum(r.counts) for r in lists) == len(rows)
    for r in lists:
        assert len(r.ids) == len(r.counts) <= 10 and len(r.lists) == 7
        assert all(held == sorted(set(held)) and all(0 <= x < len(r.ids) for x in held) for held in r.lists)
        assert sorted(x for x in r.ids if x is not None) == [x for x in r.ids if x is not None]


def test_no_rows(spark):
    docs, labels = frames(spark, *sample())
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    got = filter_audit.audit(docs, labels.limit(0))
    assert got.filter("good_lost <> 0 OR toxic_lost <> 0").count() == 0 and got.count() == 600 * got.select("part").distinct().count()


def test_other_filters(spark):
    docs, labels = frames(spark, [(1, "aa", "s"), (2, "ab", "s"), (3, "aa", "s")], [(3, 1, 0)])
    got = filter_audit.audit(docs, labels, {"x": lambda t: "b" in t.text}, "y")
    assert sorted(map(tuple, got.collect())) == [
        ("s", "xy", 1, 2, 1, 0, 1, 0, 0, 2), ("s", "xy", 2, 1, 1, 0, 1, 1, 0, 2),
        ("s", "yx", 1, 2, 1, 0, 1, 1, 0, 2), ("s", "yx", 2, 1, 1, 0, 1, 0, 0, 2),
    ]


def test_galloping_merge():
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(200), rng.choice([0, 1, 5, 100]))) for _ in range(rng.randint(0, 6))]
        found = {}
        for members, run in filter_audit.runs(lists):
            assert run and not set(run) & set(found)
            found.update(dict.fromkeys(run, members))
        assert found == {x: sum(1 << k for k, held in enumerate(lists) if x in held) for x in set().union(*lists)}
    dense = [list(range(100_000)), list(range(100_000, 200_000))]
    assert [len(run) for _, run in filter_audit.runs(dense)] == [100_000, 100_000]
