import math
import random

import numpy as np
import pytest

from ledgerlens.llm import embedding_whitening as E


def brute(rows, components=16):
    """(vec_id, deviation, whitened by component), and the shares, with numpy's own covariance."""
    width = max((len(v) for _, v in rows), default=0)
    xs = [(i, [math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(a.T @ a / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in xs:
        apart = [n * c - s for c, s in zip(x, sums)]
        out.append((i, sum(d * d for d in apart), (np.array(apart) / n) @ vectors / np.sqrt(values)))
    return out, values / np.trace(a.T @ a / n), n


def got_by_row(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    return found


def vectors(n, width, seed, scale=0.3):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(width, width))
    return [(i, (r.normal(size=width) @ mix * scale).tolist()) for i in range(n)]


@pytest.mark.parametrize("n,width,components", [(300, 5, 16), (9000, 20, 16), (70, 40, 4)])
def test_equals_plain_covariance(spark, n, width, components):
    rows = vectors(n, width, 1)
    rows += [(n + i, rows[0][1]) for i in range(n // 2)]  # a third of the rows is one vector
    want, shares, size = brute(rows, components)
    df = E.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), components=components)
    found = got_by_row(df)
    assert len(found) == len(rows)
    signs = None
    for i, deviation, white in want:
        mine = [found[i][k][0] for k in sorted(found[i])]
        assert [r["n"] for r in mine] == [size] * min(width, components)
        assert {int(r["deviation"]) for r in mine} == {deviation}
        got = np.array([r["whitened"] for r in mine])
        if signs is None:
            signs = np.sign(got * white)
        assert got == pytest.approx(white * signs, rel=1e-6, abs=1e-7)
        assert [r["explained"] for r in mine] == pytest.approx(shares, rel=1e-9)
        assert mine[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("bits", [1, 7, 12, 40, 62])
def test_cross_products_are_exact(bits):
    r = random.Random(bits)
    x = np.array([[r.getrandbits(bits) for _ in range(4)] for _ in range(333)], np.int64)
    limbs = E.cross_products(iter([x[:200], x[200:]]), bits, 4)
    got = [[sum(int(limb[i, j]) << (E.LIMB * k) for k, limb in enumerate(limbs)) for j in range(4)] for i in range(4)]
    assert got == [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(4)] for i in range(4)]
    assert all((limb < 1 << E.LIMB).all() for limb in limbs[:-1])


def test_squares_of_any_size():
    for bits in (10, 40, 60):
        r = random.Random(bits)
        rows = [[r.getrandbits(bits) - (1 << (bits - 1)) for _ in range(7)] for _ in range(20)]
        assert E.squares(np.array(rows, np.int64)) == [sum(v * v for v in row) for row in rows]
    assert E.squares(np.array([[1 << 70, 3]], object)) == [(1 << 140) + 9]


def test_dropped_padded_and_repeated_rows(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.5, float("nan")]), (3, None), (4, [None, 1.0]), (5, [float("-inf"), 1.0]), (6, [-0.25]), (6, [2.0, -0.0078]), (None, [0.1, 0.2]), (7, [2.0**60, 1.0]), (8, [])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, component int")
    found = got_by_row(E.digest(df))
    assert set(found) == {1, 6, None, 8}
    kept = [(1, [0.5, 1.0]), (6, [-0.25]), (6, [2.0, -0.0078]), (None, [0.1, 0.2]), (8, [])]
    want, _, n = brute(kept)
    for i in found:
        assert sorted(r["deviation"] for r in found[i][1]) == sorted(d for j, d, _ in want if j == i)
        assert {r["n"] for r in found[i][2]} == {n}
    assert len(found[6][1]) == 2


def test_all_equal_flat_and_huge(spark):
    make = lambda rows: got_by_row(E.digest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    same = make([(i, [0.5, 2.0]) for i in range(5)])
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for v in same.values() for c in v.values() for r in c} == {(1, 0, None, None, None)}
    flat = make([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])
    assert [flat[3][k][0]["whitened"] is None for k in (1, 2, 3)] == [False, True, True]
    assert flat[3][1][0]["identity_error"] < 1e-9
    far = make([(0, [1e15, 0.0]), (1, [-1e15, 1.0]), (2, [5e14, 0.5])])
    assert far[0][1][0]["deviation"] is None  # beyond a long
    assert far[0][1][0]["identity_error"] < 1e-6


def test_empty_tables(spark):
    assert E.digest(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert E.digest(spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>")).collect() == []
