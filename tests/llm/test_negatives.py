import math

import numpy as np
import pytest

from tabulint.llm import negatives
from tabulint.llm.negatives import F, Fields, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("low,high,size,kind", [(-160, 155, 64, float), (0, 1, 3, float), (-5, -5, 8, float), (7, 900, 64, float), (-(2**21), 2**21, 9, float), (-(2**24), 2**24, 16, object)])
def test_fields_hold_exact_products(low, high, size, kind):
    r = np.random.default_rng(1)
    fields = Fields(low, high, size)
    rows = r.integers(low, high, (2 * fields.count + 1, size), endpoint=True)
    rows[0], rows[-1] = low, high
    anchors = np.vstack([r.integers(low, high, (5, size), endpoint=True), rows[[0, -1]]])
    assert fields.number is kind and (kind is object or fields.bits * fields.count <= negatives.DOUBLE_BITS)
    packed = fields.packed(rows)
    assert packed.shape == (size, 3)
    sums = rows.sum(axis=1).astype(object if kind is object else np.int64)
    assert (fields.scores(anchors, packed, sums) == anchors @ rows.T).all()


def test_two_candidates_share_a_product_of_unit_vectors():
    assert Fields(-160, 155, 64).count == 2


def brute_force(rows, is_anchor, positives=5, negatives_=10, scale=256):
    v = {}
    whole = [x for x in rows if None not in x and all(c is not None and math.isfinite(c) for c in x[1])]
    for i, e, label in sorted(whole, key=lambda x: (x[2], x[1])):
        if len(e):
            v.setdefault(i, (label, [math.floor(scale * float(np.float32(c))) for c in e]))
    out = set()
    for a in filter(is_anchor, v):
        label, own = v[a]
        scored = sorted((-sum(x * y for x, y in zip(own, e)), i, other) for i, (other, e) in v.items())
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:positives]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives_]
            out |= {(a, p, rank, i, -s, -t) for rank, (t, i, _) in enumerate(fit, start=1)}
    return out


def mined(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return check(hard_negatives(docs, F.col("vec_id") % 10 == 0, **options))


def check(result):
    assert dict(result.dtypes)["rank"] == "int"
    found = [tuple(r) for r in result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(found) == len(set(found))
    return set(found)


def some_rows(n, size=12, hot=0):
    r = np.random.default_rng(7)
    center = r.standard_normal(size)
    rows = [(i, (center + r.standard_normal(size)).tolist(), int(r.integers(3))) for i in range(n)]
    return rows + [(n + i, rows[3][1], i % 2) for i in range(hot)]


@pytest.mark.parametrize("blocks", [1, 3], ids=["one block", "many blocks"])
def test_equals_brute_force_with_ties_and_a_hot_vector(llm, monkeypatch, blocks):
    rows = some_rows(150, hot=100)
    if blocks > 1:
        monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 9)
        monkeypatch.setattr(negatives, "STRIPE_LEAST", 30)
        monkeypatch.setattr(negatives, "GROUP_ANCHORS", 4)
        monkeypatch.setattr(negatives, "ROW_CANDIDATES", 11)
    assert mined(llm, rows) == brute_force(rows, lambda i: i % 10 == 0)


def test_odd_rows(llm):
    rows = some_rows(60)
    zero = [0.0] * 12
    odd = [(100, None, 1), (110, rows[0][1], None), (None, rows[1][1], 1), (120, [math.nan] + zero[1:], 0), (130, [None] + zero[1:], 0), (140, [-math.inf] + zero[1:], 0)]
    repeated = [rows[10], rows[10], rows[5], (20, rows[21][1], rows[20][2])]
    everything = [*rows, (150, zero, 0), (151, zero, 0), (152, zero, 1), *odd, *repeated]
    found = mined(llm, [*everything, (160, [1.0, 2.0], 1), (161, [], 1)])
    assert found == brute_force(everything, lambda i: i % 10 == 0)
    assert {r[4:] for r in found if r[0] == 150} == {(0, 0)}
    names = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS score", "3 AS block", "4 AS anchor", "5 AS row")
    assert check(hard_negatives(names, F.col("vec_id") % 10 == 0)) == brute_force(rows, lambda i: i % 10 == 0)


def test_few_rows(llm):
    assert mined(llm, []) == set()
    assert mined(llm, [(0, [1.0], 1)]) == set()
    assert mined(llm, [(0, [1.0], 1), (1, [1.0], 1)]) == set()
    assert mined(llm, [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 0)]) == {(0, 1, 1, 2, 65536, 32768)}
    assert mined(llm, [(1, [1.0], 1), (2, [0.5], 0)]) == set()


def test_wide_scores(llm):
    rows = [(i, [(v - 0.5) * 2e4 for v in e], label) for i, e, label in some_rows(40, size=4)]
    assert mined(llm, rows) == brute_force(rows, lambda i: i % 10 == 0)
    with pytest.raises(OverflowError):
        mined(llm, [(0, [1e8, 1e8], 1), (1, [1e8, -1e8], 0)])


def test_keys_are_whole_numbers(llm):
    docs = llm.createDataFrame([("a", [1.0], 1)], "vec_id string, embedding array<float>, label int")
    with pytest.raises(TypeError, match="vec_id"):
        hard_negatives(docs, F.lit(True))
