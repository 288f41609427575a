"""Whitening against an eigendecomposition of the exact covariance."""

import numpy as np
import pytest

from asiento.llm import whitening


def brute(vectors, wanted=whitening.COMPONENTS):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    off = (x - sums // n) - (sums % n) / n
    values, components = np.linalg.eigh(off.T @ off / n)
    values, components = values[::-1], components[:, ::-1]
    r = min(wanted, int((values > 1e-9 * values[0]).sum()))
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return off @ components[:, :r] / np.sqrt(values[:r]), values[:r] / values.sum(), deviations


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, component string, x binary")
    return whitening.whiten(df, **options).collect()


def rows_of(vectors, first=0):
    return [(first + i, [float(c) for c in v], i % 3, "a", None) for i, v in enumerate(vectors)]


def same(found, vectors, ids, wanted=whitening.COMPONENTS):
    whitened, explained, deviations = brute(vectors, wanted)
    assert len(found) == whitened.size
    at = {id_: i for i, id_ in enumerate(ids)}
    got = np.zeros(whitened.shape)
    for r in found:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(vectors) and r.deviation == deviations[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    signs = np.sign((got * whitened).sum(axis=0))
    assert np.abs(got * signs - whitened).max() < 1e-7


@pytest.mark.parametrize("dim, n", [(5, 40), (36, 200), (14, 9)])
def test_components_are_those_of_the_covariance(spark, dim, n):
    random = np.random.default_rng(dim)
    vectors = random.standard_normal((n, dim)) * np.linspace(9, 1, dim)
    same(run(spark, rows_of(vectors)), vectors, range(n))


def test_low_rank_gives_as_many_components(spark):
    random = np.random.default_rng(1)
    vectors = np.round(8 * random.standard_normal((200, 3))) @ np.round(4 * random.standard_normal((3, 24)))
    found = run(spark, rows_of(vectors))
    assert {r.component for r in found} == {1, 2, 3}
    same(found, vectors, range(200))


def test_equal_eigenvalues(spark):
    vectors = np.concatenate([np.eye(6), -np.eye(6)])  # one eigenvalue, six times
    found = run(spark, rows_of(vectors))
    assert len(found) == 12 * 6 and all(abs(r.explained - 1 / 6) < 1e-9 and r.identity_error < 1e-9 for r in found)


def test_unusable_vectors_have_no_row(spark):
    vectors = np.random.default_rng(2).standard_normal((30, 4))
    bad = [
        (100, None), (101, []), (102, [1.0, None, 0.0, 2.0]), (103, [1.0, float("nan"), 0.0, 2.0]),
        (104, [1.0, float("inf"), 0.0, 2.0]), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0, 0.0]),
    ]
    found = run(spark, [*rows_of(vectors), *((i, v, None, None, b"x") for i, v in bad)])
    same(found, vectors, range(30))


def test_repeated_and_null_ids_keep_their_rows(spark):
    vectors = np.random.default_rng(3).standard_normal((20, 3))
    rows = [(None if i < 2 else 7, v, lab, c, x) for i, (_, v, lab, c, x) in enumerate(rows_of(vectors))]
    found = run(spark, rows)
    assert sum(r.vec_id is None for r in found) == 2 * 3 and sum(r.vec_id == 7 for r in found) == 18 * 3


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_without_variance_there_are_no_rows(spark, vectors):
    assert run(spark, rows_of(vectors)) == []


def test_deviation_beyond_64_bits_is_null():
    centre = whitening.Centre(2, [1 << 50, 0])
    assert centre.deviations(np.array([[1 << 50, 0], [0, 0]])) == [None, None]
    assert whitening.Centre(2, [1 << 20, 0]).deviations(np.array([[1 << 20, 0], [0, 0]])) == [1 << 40, 1 << 40]


def test_fewer_steps_than_dimensions():
    """The bidiagonalisation stops when the wanted components are done."""
    random = np.random.default_rng(4)
    x = random.standard_normal((500, 120)) * np.append([400.0, 200, 100], np.full(117, 0.01))
    passes = []

    def multiply(q, p):
        passes.append(1)
        return x.T @ (x @ q), (x @ p).T @ (x @ q), float((x @ q) @ (x @ q))

    values, components = whitening.singular_components(multiply, 120, 3)
    _, exact, vt = np.linalg.svd(x)
    assert len(passes) < 40 and np.allclose(values, exact[:3], rtol=1e-12)
    assert np.allclose(np.abs((components * vt[:3]).sum(axis=1)), 1, atol=1e-12)
