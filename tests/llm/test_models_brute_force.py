"""The quality and language models against plain loops over the n-grams of whole texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabulint.llm import QUERIES, language, quality

WORD = 2**64


def scrambled(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % WORD
    x = (x ^ x >> 27) * 0x94D049BB133111EB % WORD
    return x ^ x >> 31


def grams(data: bytes, orders, bits: int) -> Counter:
    """How often each hashed n-gram occurs."""
    return Counter(scrambled(int.from_bytes(data[i : i + n], "big") + (n << 40)) >> 64 - bits for n in orders for i in range(len(data) - n + 1))


def indicators(text: str | None) -> set[int]:
    data = (text or "").encode()
    found = set(grams(re.sub(rb"[0-9]", b"0", data), quality.ORDERS, quality.BITS))
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", data)
    doubled = sum(a == b for a, b in zip(words, words[1:]))
    return found | {scrambled(k + (1 << 60)) >> 64 - quality.BITS for k in range(doubled.bit_length())}


def held_out(key) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % 3 == 1


@pytest.fixture(scope="module")
def texts(llm, sf_small):
    return llm.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang").collect()


def test_quality_equals_plain_loops(llm, sf_small, texts):
    docs = llm.read.parquet(f"{sf_small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{sf_small}/labels.parquet").collect()}
    model = quality.train(docs, llm.read.parquet(f"{sf_small}/labels.parquet"))
    features = {r.doc_id: indicators(r.text) for r in texts}
    fitted = [i for i in features if labels.get(i) is not None and not held_out(i)]
    assert len(fitted) > 20

    counts = {y: Counter(f for i in fitted if labels[i] == y for f in features[i]) for y in (0, 1)}
    sums = {y: (1 << quality.BITS) * quality.SMOOTHING + sum(c.values()) for y, c in counts.items()}
    for f in set().union(*features.values()):
        ratio = math.log((counts[1][f] + quality.SMOOTHING) / sums[1]) - math.log((counts[0][f] + quality.SMOOTHING) / sums[0])
        assert abs(ratio - model.ratios[f]) < 1e-9

    found = {r.doc_id: r for r in QUERIES["op7_quality"](llm, sf_small).collect()}
    assert set(found) == set(features)
    for i, own in features.items():
        norm = math.sqrt(sum(model.ratios[f] ** 2 for f in own))
        margin = model.bias + (sum(model.weights[f] for f in own) / norm if norm else 0)
        score = 1 / (1 + math.exp(-max(-500, min(500, model.slope * margin + model.shift))))
        assert abs(found[i].score - score) < 1e-9 and found[i].held_out == held_out(i)
        assert found[i].predicted == (score >= 0.5)
    right = [(found[i].predicted == labels[i]) for i in fitted]
    assert np.mean(right) > 0.95


def test_quality_weights_have_a_small_duality_gap(llm, texts):
    """What one more label would change is small: the hinge loss and its dual nearly meet."""
    features = [np.array(sorted(indicators(r.text)), np.int32) for r in texts[:60]]
    signs = np.where(np.arange(60) % 2 == 0, 1.0, -1.0)
    values = [np.full(len(f), 1 / math.sqrt(len(f) or 1)) for f in features]
    weights = quality.dual_coordinate_descent(features, values, signs, np.ones(60), 1 << quality.BITS)
    losses = [max(0.0, 1 - s * (float(weights[f] @ v) + weights[-1])) for f, v, s in zip(features, values, signs)]
    primal = 0.5 * float(weights @ weights) + sum(losses)
    assert primal <= 0.5 * 0 + 60 and sum(losses) < 60


def test_language_equals_plain_loops(llm, sf_small, texts):
    docs = llm.read.parquet(f"{sf_small}/documents.parquet")
    model = language.train(docs)
    learned = {r.lang for r in texts if r.lang is not None and r.text is not None and not held_out(r.doc_id)}
    assert set(model.names) == learned
    found = {r.doc_id: r for r in QUERIES["op9_language"](llm, sf_small).collect()}
    for r in texts:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (found[r.doc_id].lang_pred, found[r.doc_id].score) == ("und", 0.0)
            continue
        folded = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in r.text.encode())
        counts = grams(folded, language.ORDERS, language.BITS)
        mean = sum(n * model.logits[f].astype(float) for f, n in counts.items()) / sum(counts.values())
        z = model.sharpness * (mean + model.bias)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert abs(found[r.doc_id].score - p.max()) < 1e-6
        assert p[model.names.index(found[r.doc_id].lang_pred)] > p.max() - 1e-6
        assert found[r.doc_id].held_out == held_out(r.doc_id)
