import numpy as np
import pyarrow as pa

from tabulint.llm import QUERIES, quality
from tabulint.llm.words import slices


def test_features_are_the_distinct_grams_of_each_text():
    texts = ["", "ab", "abab 12", "x x x", None]
    indicators = quality.Indicators()
    found = [x for _, d, o in slices(pa.array(texts)) for x in indicators.of(d, o)]
    assert [len(x) for x in found[:2]] == [0, 3] and len(found) == 5
    assert all(len(set(x.tolist())) == len(x) for x in found)
    alone = [next(quality.Indicators().of(d, o)) for t in texts for _, d, o in slices(pa.array([t], pa.string()))]
    assert all(set(a.tolist()) == set(b.tolist()) for a, b in zip(found, alone))


def test_dual_coordinate_descent_meets_its_optimum(monkeypatch):
    monkeypatch.setattr(quality, "PASSES", 3000)
    random = np.random.default_rng(3)
    x = random.normal(size=(80, 6))
    y = np.where(x[:, 0] + 0.3 * x[:, 1] > 0, 1.0, -1.0)
    rows, values = [np.arange(6)] * 80, list(x)
    w = quality.dual_coordinate_descent(rows, values, y, np.ones(80), 6)

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - y * (x @ w[:-1] + w[-1])).sum()

    best = loss(w)
    assert all(best <= loss(w + random.normal(scale=s, size=7)) + 1e-2 for s in (0.001, 0.01, 0.1) for _ in range(50))


def test_held_out_accuracy(llm, sf_medium):
    found = QUERIES["op7_quality"](llm, sf_medium)
    labels = llm.read.parquet(f"{sf_medium}/labels.parquet")
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert found.count() == 1000 and len(rows) > 80
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_odd_texts_and_missing_labels(odd, empty, rows):
    labels = odd.sparkSession.createDataFrame([(6, 1), (7, 1), (10, 0), (14, 0), (14, None), (None, 1)], "doc_id long, quality int")
    for model in (quality.train(odd, labels), quality.train(odd, labels.limit(0)), quality.train(odd, labels.filter("quality = 1"))):
        scored = quality.score(odd, model)
        assert scored.columns == [*odd.columns, "score"]
        assert sorted(r.doc_id for r in scored.collect()) == sorted(i for i, _ in rows)
        assert len({r.score for r in scored.filter("text = '' OR text IS NULL").collect()}) == 1
        assert quality.score(empty, model).count() == 0
