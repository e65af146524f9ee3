import math

import numpy as np
import pytest

from tests.llm.helpers import SF, rows_of
from tidemark.llm import eigen, queries, whitening

RNG = np.random.default_rng(3)


def rotated(values):
    q, _ = np.linalg.qr(RNG.standard_normal((len(values), len(values))))
    return (q * values) @ q.T


MATRICES = {
    "random": rotated(RNG.random(40)),
    "falling": rotated(2.0 ** -np.arange(45)),
    "clusters": rotated(np.repeat([5.0, 3.0, 1.0], 12) + 1e-9 * RNG.random(36)),
    "equal": 7 * np.eye(20),
    "rank one": np.outer(np.arange(1.0, 11), np.arange(1.0, 11)),
    "diagonal": np.diag([1.0, 9, 3, 9, 0, 2]),
    "blocks": np.kron(np.eye(4), np.array([[2.0, 1], [1, 2]])),
    "tiny": 1e-200 * rotated(RNG.random(9)),
    "huge": 1e200 * rotated(RNG.random(9)),
    "zero": np.zeros((5, 5)),
    "one": np.array([[4.0]]),
    "two": np.array([[1.0, 2], [2, 1]]),
}


@pytest.mark.parametrize("name", MATRICES)
@pytest.mark.parametrize("share", [1.0, 0.5])
def test_eigenpairs(name, share):
    matrix = MATRICES[name]
    matrix = (matrix + matrix.T) / 2
    count = math.ceil(share * len(matrix))
    values, vectors = eigen.leading(matrix, count)
    norm = max(np.abs(matrix).max(), np.finfo(float).tiny)
    assert np.allclose(values / norm, np.linalg.eigvalsh(matrix / norm)[::-1][:count], atol=1e-13)
    assert np.abs(vectors @ vectors.T - np.eye(count)).max() < 1e-12
    residual = (matrix / norm) @ vectors.T - vectors.T * (values / norm)
    assert np.abs(residual).max() < 1e-12


def expected(rows, count=32):
    """Vectors by id, the whitened coordinates up to sign, by numpy."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([v for _, v in kept], dtype=float)).astype(int) + 1000000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    values, vectors = np.linalg.eigh(np.cov(y.T, bias=True))
    order = np.argsort(-values)[:count]
    white = y @ vectors[:, order] / np.sqrt(values[order])
    deviation = [sum((n * c - t) ** 2 for c, t in zip(row, s.tolist())) for row in x.tolist()]
    return [i for i, _ in kept], deviation, white, values[order] / values.sum()


def test_query(spark):
    rows = [(r[0], r[1]) for r in rows_of(SF, "embeddings")]
    ids, deviation, white, explained = expected(rows)
    found = queries.QUERIES["op11_whitening"](spark, SF).collect()
    assert len(found) == len(ids) * 32
    at = {i: k for k, i in enumerate(ids)}
    got = np.zeros_like(white)
    for r in found:
        assert r.n == len(ids) and r.deviation == deviation[at[r.vec_id]]
        assert math.isclose(r.explained, explained[r.component - 1], rel_tol=1e-9)
        got[at[r.vec_id], r.component - 1] = r.whitened
    assert {r.identity_error for r in found} == {found[0].identity_error}
    error = np.abs(np.cov(got.T, bias=True) - np.eye(32)).max()
    assert found[0].identity_error < 1e-9 and error < 1e-9
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got * signs - white).max() < 1e-6


def frame(spark, rows, kind="float"):
    schema = f"vec_id long, embedding array<{kind}>, deviation string, whitened int, _white int, label int"
    return spark.createDataFrame([(i, v, "d", 1, 2, 3) for i, v in rows], schema)


NAN, INF = float("nan"), float("inf")
ROWS = [
    *[(i, [float(c) for c in RNG.standard_normal(6)]) for i in range(80)],
    (None, [1.0] * 6), (5, [0.5, -0.5, 0.0, 2.0, 3.0, -1.0]), (5, [0.5, -0.5, 0.0, 2.0, 3.0, -1.0]),
    (90, None), (91, []), (92, [None] * 6), (93, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (94, [NAN] * 6), (95, [INF] + [0.0] * 5),
    (96, [1.0] * 5), (97, [1.0] * 7), (98, [1.0]),
]


def test_awkward_rows(spark):
    vectors = frame(spark, ROWS, "double")
    model = whitening.fit(vectors, 4)
    found = whitening.whiten(vectors, model).collect()
    kept = [(i, v) for i, v in ROWS if v and len(v) == 6]
    ids, deviation, white, explained = expected(kept, 4)
    assert model.n == len(ids) and sorted(map(str, ids)) == sorted(str(r.vec_id) for r in found)
    assert sorted(map(int, (r.deviation for r in found))) == sorted(deviation)
    assert np.allclose(model.values / model.trace, explained) and model.identity_error < 1e-12
    by_deviation = {d: w for d, w in zip(deviation, white)}
    for r in found:
        assert np.allclose(np.abs(r.whitened), np.abs(by_deviation[int(r.deviation)]))


def test_few_and_equal_vectors(spark):
    same = frame(spark, [(i, [1.0, 2.0]) for i in range(5)])
    model = whitening.fit(same)
    found = whitening.whiten(same, model).collect()
    assert [(r.deviation, r.whitened) for r in found] == [(0, [None, None])] * 5
    assert model.trace == 0 and model.identity_error == 0
    line = frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])
    model = whitening.fit(line)
    assert model.varies.tolist() == [True, False, False] and model.identity_error < 1e-12
    none = frame(spark, [(1, None), (2, [])])
    assert whitening.fit(none) is None and whitening.whiten(none, None).count() == 0


def test_exact_beyond_64_bits(spark):
    rows = [(i, [2.0**44 * (i % 3), float(i)]) for i in range(300)]
    vectors = frame(spark, rows, "double")
    model = whitening.fit(vectors)
    x = [[int(64 * c) + 1000000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((300 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    got = {r.vec_id: r.deviation for r in whitening.whiten(vectors, model).collect()}
    assert [got[i] for i, _ in rows] == [d if d < 10**38 else None for d in want]


def test_query_over_an_empty_table(spark, tmp_path):
    full = queries.QUERIES["op11_whitening"](spark, SF)
    frame(spark, [(1, None)]).select("vec_id", "embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    none = queries.QUERIES["op11_whitening"](spark, str(tmp_path))
    assert none.count() == 0 and none.dtypes == full.dtypes
