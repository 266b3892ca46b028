"""Whitening against numpy and exact fractions."""

from fractions import Fraction

import numpy as np
import pytest

from tontine.llm import whitening

SCHEMA = "vec_id long, embedding array<{}>, n long, component int, id long, v string, k int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, 2, 3, "v", 4) for i, v in rows], SCHEMA.format(kind)).repartition(3)


def vectors(count=300, dims=6, seed=2):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((count, dims)) @ rng.standard_normal((dims, dims)) * 0.3 + rng.standard_normal(dims)
    return mixed.astype(np.float32)


def plain(values, count):
    """Exact sums, the covariance as fractions, and its decomposition."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in row] for row in values]
    n, dims = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(dims)]
    y = [[n * row[i] - sums[i] for i in range(dims)] for row in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(dims)] for i in range(dims)])
    values, parts = np.linalg.eigh(cov)
    order = values.argsort()[::-1][:count]
    centred = np.array([[float(Fraction(c, n)) for c in row] for row in y])
    with np.errstate(invalid="ignore", divide="ignore"):
        white = centred @ parts[:, order] / np.sqrt(values[order])
    return [sum(c * c for c in row) for row in y], white, values[order] / np.trace(cov)


def check(got, ids, values, count):
    deviation, white, explained = plain(values, count)
    rows = {}
    for r in got:
        rows.setdefault(r.vec_id, []).append(r)
    assert set(rows) == set(ids)
    found = np.zeros((len(ids), count))
    for at, i in enumerate(ids):
        mine = sorted(rows[i], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, count + 1))
        assert {(r.n, int(r.deviation_exact)) for r in mine} == {(len(ids), deviation[at])}
        assert {r.deviation for r in mine} == {deviation[at] if deviation[at] < 2**63 else None}
        assert np.allclose([r.explained for r in mine], explained, rtol=1e-10)
        found[at] = [r.whitened for r in mine]
    signs = np.sign((found * white).sum(0))
    assert np.allclose(found * signs, white, rtol=1e-8, atol=1e-9)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and abs(errors.pop() - np.abs(np.cov(found.T, bias=True) - np.eye(count)).max()) < 1e-9


@pytest.mark.parametrize("dims", [2, 6, 11])
def test_matches_plain_version(spark, dims):
    values = vectors(dims=dims)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
    got = whitening.whiten(frame(spark, rows)).collect()
    check(got, range(len(rows)), values, min(dims, 8))


def test_large_entries_stay_exact(spark):
    """Far from zero, with squares beyond 64 bits."""
    values = vectors(60, 3).astype(float) * 1e9 + 1e12
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
    got = whitening.whiten(frame(spark, rows, "double")).collect()
    deviation, _, explained = plain(values, 3)
    assert {(r.vec_id, int(r.deviation_exact), r.deviation) for r in got} == {(i, d, None) for i, d in enumerate(deviation)}
    assert np.allclose([r.explained for r in got if r.vec_id == 0], explained) and got[0].identity_error < 1e-4


def test_unusable_and_repeated_rows(spark):
    inf, nan = float("inf"), float("nan")
    good = [(i, [float(c) for c in v]) for i, v in enumerate(vectors(40, 3))]
    bad = [(90, None), (91, [nan, 1.0, 1.0]), (92, [inf, 1.0, 1.0]), (93, [None, 1.0, 1.0]), (94, [1.0]), (95, []), (96, [-inf, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    check(got, range(40), [v for _, v in good], 3)
    twice = whitening.whiten(frame(spark, [*good, good[3], (None, good[4][1])])).collect()
    assert len(twice) == 42 * 3 and {r.n for r in twice} == {42}
    same = sorted((r.component, r.whitened) for r in twice if r.vec_id == 3)
    assert same[::2] == same[1::2] and sum(r.vec_id is None for r in twice) == 3


def test_without_variance(spark):
    same = whitening.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(5)])).collect()
    assert len(same) == 10 and all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, None, 0) for r in same)
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])).collect()
    assert {r.component for r in line if r.whitened is None} == {2, 3}
    assert max(r.identity_error for r in line) < 1e-9 and max(r.explained for r in line) == pytest.approx(1)


def test_no_vectors(spark):
    table = frame(spark, [(1, None), (2, [])])
    assert whitening.whiten(table).count() == 0 and whitening.whiten(table.limit(0)).columns[:3] == ["vec_id", "component", "n"]


def test_huge_entries(spark):
    got = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "double")).collect()
    assert len(got) == 6 and got[0].identity_error < 1e-4


def test_squares_of_pair_sums():
    y = np.array([[1, -2, 3], [4, 5, -6]])
    assert whitening.squares(y) == [17, (1 - 2) ** 2 + 81, 16 + 4, 29, 1 + 1, 45]
    large = np.array([[2**40, 2**41], [-(2**40), 3]])
    assert whitening.squares(large) == [2**81, 9 * 2**80 + (3 - 2**40) ** 2, 2**82 + 9]
