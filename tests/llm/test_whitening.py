"""Whitening against numpy's dense eigenvectors, and the parts of the FEAST search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from asterism.llm import queries, whitening


def check(rows, vectors, k=32):
    """``rows`` of the operator against a dense solution over ``vectors`` (id, entries), all valid and of one length."""
    x = np.floor(64 * np.array([v for _, v in vectors], float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    v = y.T @ y / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(k, int((values > values[0] * 1e-12).sum()))
    assert len(rows) == n * rank
    deviation = {}
    for (i, _), row in zip(vectors, x.tolist()):
        deviation.setdefault(i, []).append(sum((n * a - b) ** 2 for a, b in zip(row, s.tolist())))
    for r in rows:
        assert r["n"] == n and int(r["deviation"]) in deviation[r["vec_id"]]
        assert math.isclose(r["explained"], values[r["component"] - 1] / np.trace(v), rel_tol=1e-9)
        assert r["identity_error"] <= 1e-9
    return y @ axes[:, :rank] / np.sqrt(values[:rank])


def test_whole_table(spark):
    table = queries.table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = whitening.whiten(table).collect()
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want = check(rows, vectors)
    at = {i: k for k, (i, _) in enumerate(vectors)}
    got = np.zeros_like(want)
    for r in rows:
        got[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got * signs - want).max() < 1e-9


def test_edges(spark):
    good = [(i, [math.sin(i * 3 + 1), math.cos(i * i), i / 7]) for i in range(20)] + [(3, [9.0, 1.0, 2.0]), (None, [1.5, 2.5, -3.5])]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]), (54, [float("inf"), 1.0, 2.0]), (55, [1.0, 2.0])]
    df = (spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
          .withColumns({c: F.lit("x") for c in ("vec", "z", "n", "at", "whitened")}).repartition(5))
    rows = whitening.whiten(df).collect()
    check(rows, good)
    assert {r["vec_id"] for r in rows} == {i for i, _ in good}
    assert {r["component"] for r in rows} == {1, 2, 3}
    assert whitening.whiten(df.where("vec_id >= 50 and vec_id < 55")).collect() == []
    assert whitening.whiten(df.where("false")).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(same).collect() == []  # no spread, no component
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], "vec_id long, embedding array<float>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}
    tie = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [3.0]), (4, [5.0, 1.0])], "vec_id long, embedding array<float>")
    assert {r["vec_id"] for r in whitening.whiten(tie).collect()} == {2, 4}  # as many of either length: the longest
    with pytest.raises(Exception, match="larger than"):
        whitening.whiten(spark.createDataFrame([(1, [1e30, 2.0])], "vec_id long, embedding array<double>")).collect()


def test_deviation_beyond_a_long(spark):
    rows = whitening.whiten(spark.createDataFrame([(i, [2.0 ** 30 * i, float(i % 3)]) for i in range(50)],
                                                  "vec_id long, embedding array<double>")).collect()
    check(rows, [(i, [2.0 ** 30 * i, float(i % 3)]) for i in range(50)])


def spectra():
    r = np.random.default_rng(7)
    q = lambda d: np.linalg.qr(r.standard_normal((d, d)))[0]
    of = lambda e: (lambda b: ((b * e) @ b.T + ((b * e) @ b.T).T) / 2)(q(len(e)))
    x = r.standard_normal((500, 64))
    return {"sample": x.T @ x / 500, "identity": np.eye(40) * 7, "rank6": of(np.r_[np.arange(1.0, 7), np.zeros(34)]),
            "ties": of(np.repeat(np.arange(1.0, 17), 4)), "decay": of(10.0 ** -np.linspace(0, 9, 60)), "one": np.array([[3.0]]),
            "hot": x.T @ x / 500 * 50 + 300 * np.outer(x[0], x[0]) / (x[0] @ x[0]), "far": of(np.r_[1e6, 1e3, np.linspace(1, 1.2, 62)]),
            "cluster": of(np.r_[1 + 1e-9 * np.arange(12), np.linspace(2, 30, 40)])}


@pytest.mark.parametrize("name", sorted(spectra()))
def test_slices_hold_all_leading_eigenvalues(name):
    a = spectra()[name]
    dense = np.linalg.eigvalsh(a)[::-1]
    parts = whitening.slices(a, 32)
    rank = int((dense > dense[0] * 1e-12).sum())
    assert sum(p.count for p in parts) >= min(32, rank)
    found = []
    for p in parts:
        values, vectors = whitening.feast(a, p)
        assert len(values) == p.count == ((dense > p.low) & (dense <= p.high)).sum()
        assert np.abs(a @ vectors - vectors * values).max() < 1e-10 * dense[0]
        assert np.abs(vectors.T @ vectors - np.eye(p.count)).max() < 1e-12
        found += values.tolist()
    assert np.abs(np.array(found) - dense[:len(found)]).max() < 1e-12 * dense[0]


def test_inertia_counts_eigenvalues():
    for a in spectra().values():
        dense = np.linalg.eigvalsh(a)
        shifts = np.concatenate([(dense[1:] + dense[:-1]) / 2, [dense[0] - 1, dense[-1] + 1]])
        clear = np.abs(shifts[:, None] - dense).min(axis=1) > 1e-11 * max(1, dense[-1])
        got = whitening.inertia(whitening.tridiagonal(a), shifts)
        assert (got == (dense > shifts[:, None]).sum(axis=1))[clear].all()


def test_slices_on_spark_equal_one_solution(spark):
    a = spectra()["sample"]
    values, axes = whitening.leading_components(spark, a, 32)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:32]).max() < 1e-12
    assert np.abs(axes.T @ axes - np.eye(32)).max() < 1e-13
