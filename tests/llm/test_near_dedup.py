import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tabulint.llm import weighted_minhash as wm
from tabulint.llm import near_dedup, words
from tabulint.llm.components import components
from tabulint.llm.near_dedup import near_duplicates, one_of_each_class


def shingle_counts(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def classes(rows, threshold=0.8):
    """Connected components by exact weighted Jaccard similarity, all pairs."""
    counts = {i: shingle_counts(t) for i, t in rows if t is not None}
    words = [i for i, c in counts.items() if c]
    texts = dict(rows)
    bands = {i: [wm.group_bands(found)[0].tolist() for _, found in wm.shingles(pa.array([texts[i]]))][0] for i in words}
    copies = Counter(b for i in words for b in bands[i])
    share = {i: 1 / max(copies[b] for b in bands[i]) for i in words}
    held = Counter()
    for i in words:
        held.update(dict.fromkeys(counts[i], share[i]))
    documents = sum(share.values())
    weight = {g: min(1, max(wm.LEAST, math.log(documents / max(n, 1)) / math.log(wm.COMMON))) for g, n in held.items()}
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    texts = dict(rows)
    for a, b in itertools.combinations(sorted(counts), 2):
        x, y = counts[a], counts[b]
        shared = sum(min(x[g], y[g]) * weight[g] for g in x.keys() & y.keys())
        total = sum(n * weight[g] for c in (x, y) for g, n in c.items()) - shared
        if (total and shared / total >= threshold) or (not x and texts[a] == texts[b]):
            parent[root(max(a, b))] = root(min(a, b))
    members = defaultdict(list)
    for i, _ in rows:
        members[root(i)].append(i)
    return {i: min(m) for m in members.values() for i in m}


@pytest.fixture(scope="module")
def near_rows():
    """Chains of ever more edited copies, a hot group of copies, and unlike texts."""
    r = random.Random(2)
    out = []
    for g in range(12):
        words = [f"g{g}w{r.randrange(500)}" for _ in range(r.randint(60, 200))]
        for _ in range(r.randint(1, 8)):
            out.append(" ".join(words))
            words = list(words)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    out += [out[0]] * 60 + [f"entirely other text number {i} " + " ".join(f"z{r.randrange(10**6)}" for _ in range(40)) for i in range(40)]
    r.shuffle(out)
    return list(enumerate(out, start=1000))


def test_classes_equal_all_pairs(llm, near_rows):
    docs = llm.createDataFrame(near_rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert found == classes(near_rows)
    kept = {r.doc_id for r in one_of_each_class(docs).collect()}
    assert kept == set(classes(near_rows).values())


def test_odd_texts(odd, empty, rows):
    found = {r.doc_id: r.class_id for r in near_duplicates(odd).collect()}
    assert found == classes(rows)
    assert near_duplicates(empty).count() == 0
    kept = one_of_each_class(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == set(found.values())


def test_repeated_rows_and_null_keys(llm):
    docs = llm.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, None), (2, None), (2, None)], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.class_id)) for r in near_duplicates(docs).collect()) == [("1", "1"), ("1", "1"), ("2", "2"), ("2", "2"), ("None", "None")]
    assert sorted(str(r.doc_id) for r in one_of_each_class(docs).collect()) == ["1", "2", "None"]


def test_samples_collide_as_often_as_weights_overlap():
    r = np.random.default_rng(5)
    agree, expected = [], []
    table = np.ones((wm.SKETCH_ROWS, 1 << wm.SKETCH_BITS), np.float32)
    for _ in range(60):
        shared = [f"s{x}" for x in r.integers(1 << 40, size=60)]
        a, b = (shared[: r.integers(20, 60)] + [f"o{x}" for x in r.integers(1 << 40, size=20)] for _ in range(2))
        bands = [wm.Sampler().bands(found, wm.weights(found, table)) for _, found in wm.shingles(pa.array([" ".join(a), " ".join(b)]))][0]
        x, y = shingle_counts(" ".join(a)), shingle_counts(" ".join(b))
        j = len(x.keys() & y.keys()) / len(x.keys() | y.keys())
        agree.append((bands[0] == bands[1]).mean())
        expected.append(j**wm.ROWS)
    assert abs(np.mean(agree) - np.mean(expected)) < 0.04


def test_components_of_chains_and_stars(llm):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    found = {r.node: r.label for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 130)} == {100}


def test_near_copies_in_scripts_without_spaces(llm):
    r = random.Random(6)
    one, two = ("".join(chr(0x4E00 + r.randrange(3000)) for _ in range(200)) for _ in range(2))
    texts = [one, f"{one[:100]}。{one[100:150]}変{one[151:]}", two, f"{two}終"]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.doc_id: x.class_id for x in near_duplicates(docs).collect()} == {0: 0, 1: 0, 2: 2, 3: 2}
    column = pa.array(["naïve “quoted”—text　日本語abc¿qué?", "é", "日"])
    first, data, offsets = next(words.slices(column))
    start, end, row = words.word_bounds(data, offsets, words.not_letters(), words.character_kinds())
    found = [(int(i), bytes(data[a:b]).decode()) for a, b, i in zip(start, end, row)]
    assert found == [(0, w) for w in ("naïve", "quoted", "text", "日", "本", "語", "abc", "qué")] + [(1, "é"), (2, "日")]


@pytest.mark.parametrize("copies", [500, 1500])
def test_a_hot_group_is_spanned_by_few_links(llm, monkeypatch, copies):
    """Edited copies of one text, a third of all rows: nearly all like pairs share a class, on no more links than nodes."""
    r = random.Random(copies)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(copies):
        changed = list(words)
        changed[r.randrange(60)] = f"new{i}"
        rows.append((i, " ".join(changed)))
    rows += [(copies + i, " ".join(f"z{r.randrange(10**6)}" for _ in range(50))) for i in range(2 * copies)]
    links = []
    counted = near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda pairs: links.append(pairs.count()) or counted(pairs))
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {x.doc_id: x.class_id for x in near_duplicates(docs).collect()}
    assert sum(links) <= copies
    grams = [set(shingle_counts(t)) for _, t in rows[:500]]
    like = [(i, j) for i in range(len(grams)) for j in range(i) if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    assert len(like) > 5 * len(grams)
    assert np.mean([found[i] == found[j] for i, j in like]) >= 0.99
    assert all(found[i] == i for i in range(copies, len(rows)))


def thue_morse(n):
    """A string over two letters and its complement; a polynomial modulo a power of two does not tell them apart."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096, 8192])
def test_words_that_fool_sums_modulo_powers_of_two(llm, n):
    one, other = thue_morse(n)
    data = np.frombuffer((one + other).encode(), np.uint8)
    sums, rough = words.prefix_hash(data), words.rough_sums(words.byte_values()[data])
    ends = np.array([0, n]), np.array([n, 2 * n])
    assert len(set(words.span_hash(sums, *ends).tolist())) == 2
    assert len(set(words.rough_span(rough, *ends).tolist())) == 1
    docs = llm.createDataFrame([(1, f"a b c d {one}"), (2, f"a b c d {other}")], "doc_id long, text string")
    assert {x.class_id for x in near_duplicates(docs).collect()} == {1, 2}
