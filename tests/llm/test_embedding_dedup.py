import numpy as np
import pytest

from asiento.llm import embedding_dedup as E


def expected(rows, threshold=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = {
        (a, b)
        for a, (_, x) in enumerate(good)
        for b, (_, y) in enumerate(good)
        if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold
    }
    label = list(range(len(good)))
    for _ in good:
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    least = {}
    for (i, _), k in zip(good, label, strict=True):
        least[k] = min(least.get(k, i), i)
    out = [(i, 0, i) for i, v in rows if not any(i == j for j, _ in good)]
    out += [(good[a][0], sum(1 for x, _ in near if x == a), least[label[a]]) for a in range(len(good))]
    return sorted(out)


def groups(seed, dim, n_groups, size, noise):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_groups):
        centre = rng.standard_normal(dim)
        out += [(centre + noise * rng.standard_normal(dim)).tolist() for _ in range(size)]
    order = rng.permutation(len(out))
    return [(int(i), out[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize(
    ("rows", "options"),
    [
        (groups(1, 16, 30, 8, 0.2), {}),
        (groups(2, 32, 3, 90, 0.3), {"per_pivot": 20, "block": 16}),
        (groups(3, 3, 40, 5, 0.3), {"per_pivot": 25, "reach": 6.0}),
    ],
)
def test_against_all_pairs(spark, rows, options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.near_vectors(df, **options).collect())
    assert got == expected(rows)


def test_odd_vectors_repeats_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]),
        (8, [2.0, 0.0]), (9, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-0.0, 1.0]), (12, [0.0, 1.0]),
    ]
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], "vec_id long, embedding array<float>, n_links int, key string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in E.near_vectors(df).collect())
    assert got == expected(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in E.near_vectors(df).collect())


def test_null_and_repeated_ids_and_empty_table(spark):
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.1]), (3, [1.0, 0.1]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = E.near_vectors(df).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in got) == [
        (0, 0, 0, False), (0, 2, 0, False), (3, 2, 3, True), (3, 2, 3, True),
    ]
    assert E.near_vectors(df.limit(0)).collect() == []


def test_estimate_is_unbiased_and_within_its_bound():
    rng = np.random.default_rng(4)
    x, y = E.unit(rng.standard_normal((3000, 64))), E.unit(rng.standard_normal((3000, 64)))
    y = E.unit(x + 0.3 * y)
    errors = []
    for seed in range(8):
        turn = E.rotation(64, seed)
        signs, factor = E.codes(y, turn)
        estimate = ((x @ turn) * signs).sum(axis=1) / np.sqrt(64) / factor
        exact = (x * y).sum(axis=1)
        assert (np.abs(estimate - exact) <= np.sqrt(1 - factor**2) / factor * np.sqrt(1 - exact**2) + 1e-9).all()
        errors.append((estimate - exact).mean())
    assert abs(np.mean(errors)) < 2e-3


@pytest.mark.parametrize(("rank", "noise"), [(3, 0.0), (6, 0.0), (8, 0.02), (12, 0.0)])
def test_no_link_is_lost_in_data_of_few_directions(spark, rank, noise):
    rng = np.random.default_rng(rank)
    v = rng.standard_normal((4000, rank)) @ rng.standard_normal((rank, 64)) + noise * rng.standard_normal((4000, 64))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    label = np.arange(len(v))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(v)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in E.near_vectors(df).collect()}
    assert got == {i: (int(near[i].sum()) - 1, int(label[i])) for i in range(len(v))}


def test_visits_are_sure_in_few_dimensions():
    rng = np.random.default_rng(1)
    assert E.effective_dimension(E.unit(rng.standard_normal((3000, 5)))) < 5.1
    assert 55 < E.effective_dimension(E.unit(rng.standard_normal((4096, 64)))) < 65
    assert E.effective_dimension(np.ones((4, 3))) == 1.0
    assert np.isclose(E.visit_share(9.0, 3.0, 0.9), np.sqrt(0.05)) and E.visit_share(64.0, 3.0, 0.9) < 0.1
