"""Suffix-array dedup of bytes and substring dedup of words, against brute force."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabulint.llm import repeats, substring_dedup, suffix_dedup
from tabulint.llm import induced_sorting
from tabulint.llm.induced_sorting import permuted_common_prefixes, suffix_array


def brute_bytes(rows, window=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - window + 1):
            piece = data[p : p + window]
            if piece in seen:
                gone[p : p + window] = True
            seen.add(piece)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, window=35):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    held = Counter(tuple(w[p : p + window]) for w in words.values() for p in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - window + 1):
            if held[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    return out


def thue_morse(n):
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def byte_result(docs, **options):
    found = suffix_dedup.digests(suffix_dedup.drop_repeated_bytes(docs, **options)).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}


def word_result(docs, **options):
    found = substring_dedup.digests(substring_dedup.drop_repeated_words(docs, **options)).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found}


@pytest.fixture(scope="module")
def patchwork():
    """Texts pasted together from few pieces, some periodic: repeats of all lengths, within and across texts."""
    r = random.Random(8)
    pieces = [" ".join(f"p{i}x{r.randrange(50)}" for _ in range(r.randint(5, 60))) for i in range(10)] + ["na " * 60, "abc def " * 30, "z" * 150]
    return [(i, " ".join(r.choice(pieces) for _ in range(r.randint(0, 6)))) for i in range(120)]


def test_odd_texts(odd, rows):
    assert byte_result(odd) == brute_bytes(rows)
    assert word_result(odd) == brute_words(rows)
    assert set(odd.columns) <= set(suffix_dedup.drop_repeated_bytes(odd).columns)
    assert set(odd.columns) <= set(substring_dedup.drop_repeated_words(odd).columns)


@pytest.mark.parametrize("group_bytes, hot_sample", [(1 << 23, 1 / 64), (500, 1 / 64), (500, 1.0), (1, 0.5)])
def test_patchwork(llm, patchwork, monkeypatch, group_bytes, hot_sample):
    """Also with groups counted as crowded that are not, so that single windows settle them, and names as hot, some or all."""
    monkeypatch.setattr(repeats, "HOT_SAMPLE", hot_sample)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", round(1 / hot_sample))
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", group_bytes)
    docs = llm.createDataFrame(patchwork, "doc_id long, text string").repartition(4)
    assert byte_result(docs) == brute_bytes(patchwork)
    assert word_result(docs) == brute_words(patchwork)
    assert word_result(docs, window=12) == brute_words(patchwork, 12)
    assert byte_result(docs, window=40) == brute_bytes(patchwork, 40)


def test_empty_table_null_and_repeated_keys(llm, empty):
    assert byte_result(empty) == {} and word_result(empty) == {}
    text = " ".join(f"w{i}" for i in range(60))
    docs = llm.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    assert byte_result(docs)[1][1] == 0 and byte_result(docs)[None][1] == 0
    assert word_result(docs)[1][1] == 0 and word_result(docs)[None][1] == 0
    # the repeated row counts once; another key makes it a copy
    both = docs.union(llm.createDataFrame([(2, text)], docs.schema))
    assert byte_result(both)[1][1] == 0 and byte_result(both)[2][1] == len(text)
    assert word_result(both)[1][1] == word_result(both)[2][1] == 60


def common(text, a, b):
    same = 0
    while max(a, b) + same < len(text) and text[a + same] == text[b + same]:
        same += 1
    return same


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 6)), max_size=40), st.integers(1, 4), st.sampled_from([1, 256]))
def test_suffix_arrays_equal_brute_force(runs, times, places):
    text = np.array([*[letter for letter, n in runs for _ in range(n)] * times, 0], np.uint16)
    before, induced_sorting.BUCKET_LETTERS = induced_sorting.BUCKET_LETTERS, places
    order = suffix_array(text, 8).tolist()
    induced_sorting.BUCKET_LETTERS = before
    assert order == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    shared = permuted_common_prefixes(text, np.array(order))
    assert shared[order[0]] == 0
    assert all(shared[b] == common(text, a, b) for a, b in zip(order, order[1:]))


def fibonacci(n):
    one, other = [1], [1, 2]
    while len(other) < n:
        one, other = other, other + one
    return other


@pytest.mark.parametrize("letters", [fibonacci(3000), [1 + c for c in thue_morse(2048)[0].encode()], [1, 2, 3] * 700, [3, 1, 2, 1] * 500])
def test_recursion_goes_deep(letters, monkeypatch):
    depth = []
    inner = induced_sorting.names_sorted
    monkeypatch.setattr(induced_sorting, "names_sorted", lambda names: depth.append(len(names)) or inner(names))
    text = np.array([*letters, 0], np.uint16)
    order = suffix_array(text, 256)
    spelled = text.astype(np.uint8).tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: spelled[i:])
    assert depth and all(b * 2 <= a + 1 for a, b in zip(depth, depth[1:]))


@pytest.mark.parametrize("piece", [b"a", b"ab", b"aab", b"abcab"])
def test_long_runs_are_sorted_in_a_few_steps(piece):
    text = np.r_[np.frombuffer(piece * (1_500_000 // len(piece)), np.uint8).astype(np.uint16), 0]
    started = time.monotonic()
    order = suffix_array(text, 256)
    shared = permuted_common_prefixes(text, order)[order]
    assert time.monotonic() - started < 30
    assert (np.sort(order) == np.arange(len(text))).all() and shared.max() == len(text) - 1 - len(piece)
    at = np.random.default_rng(1).integers(1, len(text) - 1, 300)
    for a, b, n in zip(order[at], order[at + 1], shared[at + 1]):
        assert a + n == len(text) - 1 or b + n == len(text) - 1 or text[a + n] < text[b + n]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_texts_that_fool_sums_modulo_powers_of_two(llm, n):
    one, other = thue_morse(n)
    words = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([*words[:17], one, *words[17:]])), (2, " ".join([*words[:17], other, *words[17:]])), (3, one), (4, other)]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert word_result(docs) == brute_words(rows) and byte_result(docs) == brute_bytes(rows)
    assert {r[1] for r in word_result(docs).values()} == {0}


def test_passage_in_a_third_of_many_documents(llm):
    r = random.Random(9)
    passage = " ".join(f"hot{i}" for i in range(70))
    rows = [(i, " ".join(f"u{r.randrange(10**7)}" for _ in range(40))) for i in range(900)]
    rows = [(i, f"{t} {passage} {t[::-1]}" if i % 3 == 0 else t) for i, t in rows]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert word_result(docs) == brute_words(rows) and byte_result(docs) == brute_bytes(rows)


def test_hot_names_meet_by_digest(llm, monkeypatch):
    """A passage between neighbours that all differ: its name is found in the sample, and no group holds its regions."""
    r = random.Random(4)
    passage = "".join(chr(r.randrange(97, 123)) for _ in range(140))
    rows = [(i, "".join(chr(r.randrange(65, 91)) for _ in range(90)) + passage + "".join(chr(r.randrange(65, 91)) for _ in range(90))) for i in range(300)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    units = repeats.Units(100, 32)

    def largest():
        found = repeats.narrow_regions(docs, units, "doc_id", repeats.hot_names(docs, units, "doc_id"))
        return max(r["count"] for r in found.groupBy("name", "kind").count().collect())

    assert largest() >= 300
    monkeypatch.setattr(repeats, "GROUP_BYTES", 100 * 50)
    monkeypatch.setattr(repeats, "HOT_SAMPLE", 0.9)
    assert largest() <= 50
    assert byte_result(docs) == brute_bytes(rows)


def test_hot_names_of_words_meet_by_digest(llm, monkeypatch):
    r = random.Random(6)
    passage = " ".join(f"hot{i}" for i in range(50))
    fresh = lambda: " ".join(f"u{r.randrange(10**8)}" for _ in range(30))
    rows = [(i, f"{fresh()} {passage} {fresh()}") for i in range(300)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    known = substring_dedup.paths(docs, 35, "doc_id")
    assert substring_dedup.hot_names(known).count() == 0 and not any(r.crowded for r in substring_dedup.grouped(known).collect())
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 30_000)
    monkeypatch.setattr(substring_dedup, "HOT_SAMPLE", 4)
    hot = {r.hot for r in substring_dedup.hot_names(known).collect()}
    assert hot and {r.name for r in substring_dedup.grouped(known).collect() if r.crowded} >= hot
    assert "hashpartitioning(name" in substring_dedup.grouped(known)._jdf.queryExecution().executedPlan().toString()
    assert word_result(docs) == brute_words(rows)


def test_every_node_of_a_subtree():
    bodies = [b"a b c a b c ", b"x a b c y ", b"q r s "]
    flags = substring_dedup.repeated_starts([5, 5, 9], np.array([4, 3, 1]), np.array([False, False, True]), bodies, 3)
    assert flags.tolist() == [True, False, False, True, False, True, False, True]
    order, shared = substring_dedup.sorted_suffixes(np.array([0, 0, 1]), np.array([0, 2, 0]), np.array([7, 256, 7, 256, 8]), 2)
    assert order.tolist() == [0, 1, 2] and shared.tolist() == [-1, 2, -1]
