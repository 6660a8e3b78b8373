import random

import numpy as np
import pytest

from tabulint.llm import decontamination
from tabulint.llm.decontamination import GAP, MATCH, MISMATCH, align, clean_documents, leaks, places_in_common


def brute_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = MATCH if a[i - 1] == b[j - 1] else MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + GAP, h[i, j - 1] + GAP)
    return h.max()


def test_alignment_equals_brute_force():
    r = random.Random(4)
    for _ in range(200):
        a = np.array([r.randrange(4) for _ in range(r.randint(1, 12))])
        b = np.array([r.randrange(4) for _ in range(r.randint(0, 20))])
        assert align(a, b)[0] == brute_align(a, b)


@pytest.fixture(scope="module")
def planted(llm):
    r = random.Random(9)
    vocabulary = [f"word{i}" for i in range(400)] + ["the", "of", "and"] * 40
    items = [[r.choice(vocabulary) for _ in range(r.randint(20, 60))] for _ in range(30)]
    docs, truth = [], set()
    for d in range(300):
        words = [r.choice(vocabulary) for _ in range(r.randint(30, 300))]
        if d % 5 == 0:
            i = r.randrange(30)
            copy = list(items[i])
            for _ in range(len(copy) * (d % 4) // 20):  # up to 15 % edits
                at = r.randrange(len(copy))
                kind = r.randrange(3)
                if kind == 0:
                    copy[at] = "edited"
                elif kind == 1:
                    del copy[at]
                else:
                    copy.insert(at, "added")
            place = r.randint(0, len(words))
            words[place:place] = copy
            truth.add((d, i))
        docs.append((d, " ".join(words).upper() if d % 2 else ", ".join(words)))
    benchmark = [(i, " ".join(x)) for i, x in enumerate(items)] + [(90, None), (91, ""), (92, "!!"), (93, "the")]
    return (
        llm.createDataFrame(docs, "doc_id long, text string").repartition(4),
        llm.createDataFrame(benchmark, "item_id long, text string"),
        truth,
    )


def test_edited_copies_are_found_and_clean_documents_are_not(planted):
    docs, items, truth = planted
    found = {(r.doc_id, r.item_id) for r in leaks(docs, items.filter("item_id < 93")).collect()}
    assert found == truth
    kept = {r.doc_id for r in clean_documents(docs, items.filter("item_id < 93")).collect()}
    assert kept == set(range(300)) - {d for d, _ in truth}


def test_an_item_that_a_third_of_all_documents_holds(planted):
    docs, items, _ = planted
    text = items.filter("item_id = 3").first().text
    many = docs.selectExpr("doc_id", f"CASE WHEN doc_id % 3 = 0 THEN concat(text, ' ', '{text}') ELSE text END AS text")
    found = {r.doc_id for r in leaks(many, items).filter("item_id = 3").collect()}
    assert found >= {d for d in range(300) if d % 3 == 0}


def test_odd_texts_short_items_and_empty_tables(odd, empty, planted):
    _, items, _ = planted
    assert leaks(empty, items).count() == 0
    assert leaks(odd, items.limit(0)).count() == 0
    assert clean_documents(odd, items.limit(0)).count() == odd.count()
    short = odd.sparkSession.createDataFrame([(1, "one two three"), (2, "a"), (3, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in leaks(odd, short).collect()}
    assert (5, 1) in found and (3, 2) in found and not any(d in (0, 1, 2, 4) for d, _ in found)
    assert clean_documents(odd, short).columns == odd.columns


def test_all_pairs_of_the_threshold_are_found_however_a_copy_is_changed(llm):
    r = random.Random(12)
    vocabulary = [f"word{i}" for i in range(500)] + ["the", "of", "and"] * 60
    items = [[r.choice(vocabulary) for _ in range(n)] for n in [1, 2, 3, *(r.randint(1, 50) for _ in range(22))]]
    fresh = iter(range(10**6))
    changes = [
        lambda x: [w if i % 3 < 2 else f"new{next(fresh)}" for i, w in enumerate(x)],
        lambda x: [w if i % 4 < 3 else f"new{next(fresh)}" for i, w in enumerate(x)],
        lambda x: [w if i % 5 < 4 else f"new{next(fresh)}" for i, w in enumerate(x)],
        lambda x: [v for w in x for v in (w, f"new{next(fresh)}")][:-1],
        lambda x: x[: (len(x) + 1) // 2],
        lambda x: x[len(x) // 3 :],
        lambda x: [w for i, w in enumerate(x) if i % 3],
        lambda x: x,
    ]
    docs = []
    for i, item in enumerate(items):
        for change in changes:
            words = [r.choice(vocabulary) for _ in range(r.randint(0, 150))]
            place = r.randint(0, len(words))
            docs.append(words[:place] + change(item) + words[place:] + (change(item) if i % 7 == 0 else []))
    numbers = {w: n for n, w in enumerate({w for words in docs + items for w in words})}
    spelled = [[np.array([numbers[w] for w in words]) for words in texts] for texts in (docs, items)]
    scores = {(d, i): align(item, text)[0] / (MATCH * len(item)) for d, text in enumerate(spelled[0]) for i, item in enumerate(spelled[1])}
    texts = llm.createDataFrame([(d, " ".join(x)) for d, x in enumerate(docs)], "doc_id long, text string").repartition(4)
    benchmark = llm.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    for threshold in (0.5, 0.35, 0.8):
        found = {(x.doc_id, x.item_id): x.score for x in leaks(texts, benchmark, threshold=threshold).collect()}
        # an item too short to have a pair of words in every alignment has to be there whole
        whole = [places_in_common(len(item), threshold) <= 0 for item in items]
        assert found == {pair: score for pair, score in scores.items() if score >= (1 if whole[pair[1]] else threshold)}


def test_items_in_scripts_without_spaces_and_short_items_inside_longer_texts(llm):
    r = random.Random(5)
    own, other = ("".join(chr(0x4E00 + low + r.randrange(2000)) for _ in range(60)) for low in (0, 5000))
    items = llm.createDataFrame([(1, f"{own[:20]}，{own[20:40]}。"), (2, "เก็บข้อมูลไว้ที่นี่"), (3, "«zwei Wörter»")], "item_id long, text string")
    docs = [
        (1, f"{other}。{own[:20]}，{own[20:40]}、{other}"),
        (2, f"{other}{own[:9]}{other[3]}{own[10:27]}{other[5]}{own[28:40]}"),
        (3, f"{other}，{other}"),
        (4, "ก่อนหน้าเก็บข้อมูลไว้ที่นี่แล้ว"),
        (5, "Davor “zwei Wörter”, danach noch mehr"),
    ]
    found = {(x.doc_id, x.item_id): x.score for x in leaks(llm.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert set(found) == {(1, 1), (2, 1), (4, 2), (5, 3)}
    assert found[1, 1] == found[4, 2] == found[5, 3] == 1.0


def test_every_alignment_of_the_threshold_has_the_places_in_common():
    """Pairs of words in all texts of the cheapest changes: matches with others before, between and instead of words."""
    r = random.Random(3)
    tight = 0
    for _ in range(3000):
        size, threshold = r.randint(1, 24), r.choice((0.35, 0.5, 0.8))
        item = np.arange(size).astype(np.uint64)
        text, other = [], iter(range(1000, 2000))
        for word in item.tolist():
            kind = r.random()
            text += [word] if kind < 0.5 else [next(other) for _ in range(r.randint(1, 3))] + [word] if kind < 0.75 else [next(other)] if kind < 0.9 else []
        text = np.array(text, np.uint64)
        if len(text) and align(item, text)[0] >= threshold * MATCH * size:
            place, gram = decontamination.item_grams(item)
            held = np.isin(gram, decontamination.pair_grams(text)[1])
            common, needed = len(np.unique(place[held])), places_in_common(size, threshold)
            assert common >= needed or size == 1
            tight += common <= needed + 1
    assert tight > 50
    assert places_in_common(1, 0.5) <= 0 and places_in_common(2, 0.5) <= 0 and places_in_common(3, 0.5) == 1


def test_candidates_stay_few_when_items_grow(llm, monkeypatch):
    """Decoys are shuffled stretches of the documents' own words; a document with a copy is compared with few of them."""
    r = random.Random(6)
    vocabulary = [f"word{i}" for i in range(3000)]
    docs = [[r.choice(vocabulary) for _ in range(200)] for _ in range(60)]
    items = [list(docs[i][50:80]) for i in range(20)]
    texts = llm.createDataFrame([(d, " ".join(x)) for d, x in enumerate(docs)], "doc_id long, text string")

    def decoy():
        words = r.choice(docs)
        at = r.randrange(170)
        return r.sample(words[at : at + 30], 30)

    decoys = [decoy() for _ in range(4000)]
    aligned = {}
    for n in (40, 4000):
        numbered = llm.createDataFrame([(i, i, " ".join(x)) for i, x in enumerate(items + decoys[:n])], "number long, item long, text string")
        pairs = decontamination.candidates(texts, numbered).collect()
        words = [w for _, w in decontamination.rows(decontamination.pa.array([" ".join(x) for x in docs + items + decoys[:n]]))]
        compared = 0
        for p in pairs:
            item, text = words[len(docs) + p.number], words[p.k]
            place, gram = decontamination.item_grams(item)
            found = np.isin(gram, decontamination.pair_grams(text)[1])
            compared += len(np.unique(place[found])) >= places_in_common(len(item), 0.5)
        assert {(p.k, p.number) for p in pairs} >= {(i, i) for i in range(20)}
        aligned[n] = (len(pairs) / len(docs), compared / len(docs))
    assert aligned[4000][0] < 3 and aligned[4000][1] < 2
