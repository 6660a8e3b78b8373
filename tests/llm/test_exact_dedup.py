import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tabulint.llm import exact_dedup, polynomial
from tabulint.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tabulint.llm.polynomial import PRIME, Polynomial

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow(text: bytes, base: int) -> int:
    value = 0
    for byte in text:
        value = (value * base + byte + 1) % PRIME
    return value


def test_products_modulo_the_prime():
    r = random.Random(1)
    edge = [0, 1, PRIME - 1, 2**31, 2**31 - 1, 2**60, 2**32]
    a, b = (edge * 7 + [r.randrange(PRIME) for _ in range(500)] for _ in range(2))
    r.shuffle(b)
    assert polynomial.times(np.array(a, np.uint64), np.array(b, np.uint64)).tolist() == [x * y % PRIME for x, y in zip(a, b)]


def test_fingerprints_equal_the_plain_sum_and_compose():
    r = random.Random(2)
    base = r.randrange(PRIME)
    hasher = Polynomial(base)
    texts = [b"", b"a", b"\0", b"\0\0", r.randbytes(63), r.randbytes(64), r.randbytes(65), b"\xff" * polynomial.CHUNK, r.randbytes(polynomial.CHUNK + 1), b"", r.randbytes(700_001)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    found = hasher.of(data, offsets)
    assert found == [slow(t, base) for t in texts]
    text = texts[-1]
    cuts = sorted(r.randrange(len(text)) for _ in range(9))
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    assert hasher.joined((slow(p, base), len(p)) for p in parts) == (found[-1], len(text))
    middle = offsets[3:8]
    assert hasher.of(data, middle) == found[3:7]


def brute_force(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWERED)].append(i)
    out = defaultdict(int)
    for text, ids in groups.items():
        top = max(ids, key=lambda i: (i is not None, i))
        for at, i in enumerate(ids):
            out[i, top, len(ids), at == ids.index(top), hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def found(result):
    out = defaultdict(int)
    for r in result.collect():
        out[r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256] += 1
    return out


@pytest.fixture(scope="module")
def many():
    r = random.Random(3)
    texts = ["Hot Text of many", "", None, "ÄÖ only ASCII falls", "äö only ascii falls", "ABC", "abc", "x" * 3000]
    rows = [(i, r.choice([texts[0].upper(), texts[0], *texts])) for i in range(600)] + [(1000 + i, f"alone {i}") for i in range(100)]
    r.shuffle(rows)
    return rows


def table(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(4)


def test_equals_brute_force(llm, many):
    result = exact_duplicates(table(llm, many))
    assert dict(result.dtypes) == {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"}
    assert found(result) == brute_force(many)


def test_odd_texts_and_columns(odd, empty, rows):
    assert found(exact_duplicates(odd)) == brute_force(rows)
    assert exact_duplicates(empty).count() == 0
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({k[1] for k in brute_force(rows)})
    more = odd.selectExpr("*", "1 AS sha", "2 AS print", "3 AS row", "4 AS salt", "5 AS piece", "6 AS no")
    assert found(exact_duplicates(more)) == brute_force(rows)


def test_repeated_rows_null_and_string_keys(llm):
    rows = [("b", "X"), ("b", "x"), ("b", "x"), ("a", "x"), (None, "x"), (None, "y"), (None, "y"), ("c", None), ("b", "")]
    docs = table(llm, rows, "string")
    result = found(exact_duplicates(docs))
    assert {k[:4]: n for k, n in result.items()} == {
        ("b", "b", 5, True): 1, ("b", "b", 5, False): 2, ("a", "b", 5, False): 1, (None, "b", 5, False): 1,
        (None, None, 2, True): 1, (None, None, 2, False): 1, ("c", "c", 2, True): 1, ("b", "c", 2, False): 1,
    }
    assert sorted(map(str, (r.doc_id for r in drop_exact_duplicates(docs).collect()))) == ["None", "b", "c"]


def test_huge_texts_go_in_pieces(llm, monkeypatch, many):
    monkeypatch.setattr(exact_dedup, "HUGE", 100)
    monkeypatch.setattr(exact_dedup, "PIECE", 37)
    r = random.Random(4)
    long = "".join(r.choice("abC ") for _ in range(1000))
    late = long[:999] + "z"
    rows = [*many, (5000, long), (5001, long.upper()), (5002, late), (5003, long), (5003, long), (5004, late), (5005, long[:100]), (5006, long[:101])]
    assert found(exact_duplicates(table(llm, rows))) == brute_force(rows)


def test_equal_fingerprints_of_different_texts(llm, monkeypatch):
    """With every fingerprint the same, texts of one length meet; the comparison finds that they differ."""

    class Weak:
        def of(self, data, offsets):
            return [7] * (len(offsets) - 1)

        def joined(self, parts):
            return 7, sum(size for _, size in parts)

    strong = exact_dedup.polynomial
    monkeypatch.setattr(exact_dedup, "polynomial", lambda base: Weak() if base == 999 else strong(base))
    monkeypatch.setattr(exact_dedup, "HUGE", 9)
    monkeypatch.setattr(exact_dedup, "PIECE", 4)
    r = random.Random(5)
    rows = [(i, r.choice(["aaaa", "bbbb", "AAAA", "aaab", "dd", "", "long text one", "long text two", "LONG text ones"])) for i in range(300)]
    rows += [(900, "bbbb"), (901, "zzzz"), (901, "zzzz"), (901, "yyyy")]
    prints = exact_dedup.marked(table(llm, rows), "doc_id", 999, bodies=False).filter("no = 0").select("print").distinct().collect()
    assert {p.print for p in prints} == {7, None}
    assert found(exact_duplicates(table(llm, rows), base=999)) == brute_force(rows)
