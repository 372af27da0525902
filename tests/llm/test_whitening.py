import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import whitening as H

COLUMNS = "vec_id long, embedding array<double>"


def plain(vectors, components=16):
    """n, S, eigenvalues, eigenvectors and trace by other routines, from whole-number vectors."""
    fit = np.unique(np.array(list(vectors)), axis=0)
    n, total = len(fit), [sum(int(v) for v in c) for c in fit.T]
    centred = fit - np.array([s / n for s in total])
    covariance = centred.T @ centred / n
    values, found = np.linalg.eigh(covariance)
    return n, total, values[::-1], found[:, ::-1], np.trace(covariance)


def check(rows, vectors):
    """``vectors``: whole-number vector by key."""
    n, total, values, found, trace = plain(vectors.values())
    signs = {}
    for r in rows:
        x, c = vectors[r.vec_id], r.component - 1
        assert (r.n, int(r.deviation)) == (n, sum((n * int(v) - s) ** 2 for v, s in zip(x, total)))
        assert r.explained == pytest.approx(values[c] / trace, rel=1e-9)
        w = (x - np.array([s / n for s in total])) @ found[:, c] / np.sqrt(values[c])
        if abs(w) > 1e-6:
            signs.setdefault(c, np.sign(w) * np.sign(r.whitened))
            assert r.whitened * signs[c] == pytest.approx(w, rel=1e-6, abs=1e-8)
        assert 0 <= r.identity_error < 1e-9
    return n


def test_query_equals_other_routines(spark):
    folder = "/root/testdata/sf0.001"
    rows = H._query(spark, folder).collect()
    vectors = {r.vec_id: np.floor(64 * np.array(r.embedding, float)).astype(np.int64) + H.SHIFT
               for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    check(rows, vectors)
    assert len(rows) == 16 * len(vectors)
    assert {r.component for r in rows} == set(range(1, 17))


def test_odd_vectors(spark):
    usable = {1: [0.5, 0.25, 1.0], 2: [0.5, 0.25, 1.0], 3: [2.0, -1.0, 0.0], 4: [0.0, 3.0, -7.5], 5: [9.0, 9.0, 1e9]}
    other = [(6, None), (7, [1.0, None, 2.0]), (8, [1.0, float("nan"), 2.0]), (9, [float("inf"), 0.0, 0.0]), (10, []), (11, [1.0, 2.0]),
             (12, [1e300, 0.0, 0.0])]
    rows = [(k, v) for k, v in usable.items()] + other + [(None, usable[3]), (3, usable[3])]
    wide = spark.createDataFrame([(*r, 1) for r in rows], COLUMNS + ", code int")
    found = H.whiten(wide).collect()
    vectors = {k: np.floor(64 * np.array(v)).astype(np.int64) + H.SHIFT for k, v in usable.items()}
    assert check([r for r in found if r.vec_id is not None], vectors) == 4
    # three components for each of five rows, a null key and a repeated row
    assert len(found) == 3 * 7 and {r.component for r in found} == {1, 2, 3}


def test_entries_of_very_different_size(spark):
    """An entry of 1e9 hides no component of the small ones; expected values are from Jacobi rotations with 80 digits."""
    usable = {1: [0.5, 0.25, 1.0], 3: [2.0, -1.0, 0.0], 4: [0.0, 3.0, -7.5], 5: [9.0, 9.0, 1e9]}
    found = H.whiten(spark.createDataFrame(list(usable.items()), COLUMNS)).collect()
    expected = {1: [-0.577350261876522, -0.577350264185923, -0.577350281506431, 1.73205080756888],
                2: [0.195067793911232, 1.30655350560819, -1.50162128806219, -1.14572274289727e-08],
                3: [-1.62130047520184, 0.979583896063731, 0.641716572703935, 6.43417475664481e-09]}
    assert len(found) == 12
    for component, values in expected.items():
        rows = sorted((r for r in found if r.component == component), key=lambda r: r.vec_id)
        sign = np.sign(rows[0].whitened * values[0])
        assert [r.whitened * sign for r in rows] == pytest.approx(values, rel=1e-9, abs=1e-10)
        assert rows[0].explained == pytest.approx({1: 1.0, 2: 1.3518571488344932e-17, 3: 5.3698425970136644e-19}[component], rel=1e-9, abs=0)


def test_projection_does_not_depend_on_the_rows_beside():
    generator = np.random.default_rng(3)
    model = H.Whitening(7, np.zeros(64, np.int64), [3] * 64, np.linspace(9, 1, 16), generator.normal(size=(16, 64)), 100.0)
    y = generator.integers(-500, 500, (333, 64))
    assert all(np.array_equal(model.project(y[low:low + n]), model.project(y)[low:low + n]) for low in (0, 5, 99) for n in (1, 2, 13, 64))


def test_rank_of_exact_copies():
    """Directions that the others make up add no component, at any scale of the entries."""
    for seed in range(200):
        base = np.random.default_rng(seed).integers(-9, 10, (6, 2)) * np.array([1, 10 ** (seed % 9)])
        vectors = np.hstack([base, base.sum(axis=1, keepdims=True), 3 * base])
        assert H.pivoted_cholesky((vectors.T @ vectors).astype(float)).shape[1] == np.linalg.matrix_rank(base)


def test_nothing_to_fit(spark):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = H.whiten(spark.createDataFrame(rows, COLUMNS))
        assert found.columns == columns and found.count() == 0


def test_the_layout_does_not_matter(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one, many = (sorted(H.whiten(rows.repartition(n)).drop("identity_error").collect()) for n in (1, 13))
    assert one == many


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 9), st.integers(1, 9), st.integers(0, 10 ** 6))
def test_factor_and_rotations(size, rank, seed):
    base = np.random.default_rng(seed).normal(size=(min(rank, size), size)) * np.array([10.0 ** (i % 5) for i in range(size)])
    matrix = base.T @ base
    factor = H.pivoted_cholesky(matrix)
    assert np.allclose(factor @ factor.T, matrix, rtol=1e-9, atol=1e-9 * np.trace(matrix))
    values, found = H.one_sided_jacobi(factor)
    assert np.allclose(found @ found.T, np.eye(len(found)), atol=1e-10)
    assert np.allclose((found.T * values) @ found, matrix, rtol=1e-9, atol=1e-9 * np.trace(matrix))
    assert all(a >= b for a, b in zip(values, values[1:]))


def test_products_are_exact_at_any_size():
    for most in (5, 2 ** 25, 2 ** 40, 2 ** 61):
        a = np.random.default_rng(most % 97).integers(-most, most, (50, 3))
        expected = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in a.T] for p in a.T]
        assert H._exact_product(a, a).tolist() == expected
