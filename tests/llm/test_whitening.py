import math

import numpy as np
import pytest

from tabulint.llm import QUERIES, eigen, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def matrices():
    r = np.random.default_rng(1)
    a = r.standard_normal((40, 40))
    turned = np.linalg.qr(a)[0]
    yield "random", a @ a.T
    yield "clusters", turned @ np.diag([5.0, 5, 5, 5 - 1e-9, 4, 4, *np.linspace(1, 0.1, 34)]) @ turned.T
    yield "diagonal", np.diag(np.r_[3.0, 3, 3, 1, np.zeros(10)])
    yield "parts", np.kron(np.eye(6), np.array([[2.0, 1], [1, 2]]))
    yield "zero", np.zeros((5, 5))
    yield "one", np.array([[4.0]])
    yield "two", np.array([[1.0, -2], [-2, 1]])
    yield "huge", 1e200 * (a @ a.T)
    yield "negative", -(a @ a.T)


@pytest.mark.parametrize("name,matrix", list(matrices()))
def test_leading_pairs(name, matrix):
    matrix = (matrix + matrix.T) / 2
    k = min(8, len(matrix))
    values, vectors = eigen.leading_pairs(matrix, 8)
    size = np.abs(matrix).max() or 1
    assert np.allclose(values / size, np.linalg.eigvalsh(matrix / size)[::-1][:k], atol=1e-13)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.abs(matrix / size @ vectors - vectors * (values / size)).max() < 1e-12


def test_sturm_counts_tell_how_many_values_lie_below():
    r = np.random.default_rng(2)
    d, e = r.standard_normal(30), r.standard_normal(29)
    e[[4, 11]] = 0
    full = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    at = np.linspace(-4, 4, 57)
    assert eigen.sturm_counts(d, e, at).tolist() == [(np.linalg.eigvalsh(full) < x).sum() for x in at]


def brute_force(rows, k=8):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept])
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:k]
    out = {}
    for row, (i, _) in enumerate(kept):
        deviation = sum((n * int(v) - s) ** 2 for v, s in zip(x[row], sums))
        for c, at in enumerate(order, start=1):
            score = centred[row] @ vectors[:, at] / np.sqrt(values[at])
            out[i, c] = (n, deviation, score, values[at] / np.trace(covariance))
    return out


def compare(found, expected, tolerance=1e-9):
    assert {(r.vec_id, r.component) for r in found} == set(expected) and len(found) == len(expected)
    signs = {}
    for r in found:
        n, deviation, score, share = expected[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.explained - share) <= 1e-10 * share
        if abs(score) > 1e-6:
            sign = signs.setdefault(r.component, math.copysign(1, score * r.whitened))
            assert abs(score - sign * r.whitened) < tolerance * max(1, abs(score))
        assert 0 <= r.identity_error < 1e-9
    assert len({r.identity_error for r in found}) <= 1


def test_query_equals_brute_force(llm, sf_small):
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    result = QUERIES["op13_whitening"](llm, sf_small)
    kinds = dict(result.dtypes)
    assert (kinds["component"], kinds["n"], kinds["deviation"], kinds["whitened"]) == ("int", "bigint", "bigint", "double")
    compare(result.collect(), brute_force(rows))


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)


def components(docs):
    return whitening.whitened_components(docs, whitening.fit(docs)).collect()


def test_odd_vectors(llm):
    r = np.random.default_rng(3)
    rows = [(i, r.standard_normal(5).tolist()) for i in range(60)]
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [math.nan] * 5), (103, [math.inf, 0.0, 0.0, 0.0, 0.0]), (104, []), (105, [1.0] * 4)]
    compare(components(table(llm, rows + odd)), brute_force(rows, 5))
    kept = whitening.transform(table(llm, [*rows, rows[0], (None, rows[1][1])]), whitening.fit(table(llm, rows)))
    assert kept.count() == 62 and kept.filter("vec_id IS NULL").count() == 1 and "label" in kept.columns


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]], ids=str)
def test_no_variance_no_component(llm, rows):
    docs = table(llm, rows)
    assert components(docs) == []
    assert whitening.transform(docs, whitening.fit(docs)).count() == sum(bool(v is not None) for _, v in rows)


def test_flat_directions_are_left_out(llm):
    r = np.random.default_rng(4)
    rows = [(i, [float(a), float(a), float(b), 0.5]) for i, (a, b) in enumerate(r.integers(-50, 50, (80, 2)))]
    found = components(table(llm, rows))
    assert {x.component for x in found} == {1, 2}
    compare(found, brute_force(rows, 2))


def test_large_numbers_and_names(llm):
    rows = [(i, [float(i * 1e11), float(-i * i) * 1e8]) for i in range(50)]
    docs = table(llm, rows).withColumn("deviation", whitening.F.lit("x"))
    model = whitening.fit(docs)
    got = {r.vec_id: r.deviation for r in whitening.transform(docs, model).collect()}
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert model.sums == sums
    assert {i: int(d) for i, d in got.items()} == {i: sum((50 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {r.deviation for r in components(docs)} == {None}
    with pytest.raises(Exception, match="2\\*\\*53"):
        whitening.fit(table(llm, [(1, [1e30, 0.0]), (2, [0.0, 1.0])]))
