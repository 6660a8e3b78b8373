import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabulint.llm import QUERIES
from tabulint.llm.cutting_stock import Knapsack, plan
from tabulint.llm.packing import SEQUENCE, encoder, pack, public_tokenizer, sequences


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_tokenizer_file(exact):
    texts = ["", " ", "a  b\n\nc", "l'été I'll 123 4567", "日本語 🙂 ​", "<|endoftext|> inside", "x" * 3000, "  \t tabs", "\x00\x01"]
    encode = encoder(*public_tokenizer())
    for text in texts:
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def check(found, texts, exact):
    ids = {i: [*exact.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    assert {r.doc_id for r in found} == set(texts)
    for i, tokens in ids.items():
        parts = sorted((r for r in found if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
        assert sum(r.length for r in parts) == len(tokens) == parts[0].doc_tokens
        for r in parts:
            assert zlib.crc32(np.array(tokens[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == list(np.cumsum([0, *[r.length for r in parts]])[:-1])
        used = sum(r.length for r in parts)
        assert 0 < used <= SEQUENCE
        padding += 0 if used & (used - 1) == 0 else SEQUENCE - used
    return padding / sum(r.length for r in found)


def test_round_trip_and_padding(llm, sf_medium, exact):
    texts = dict(llm.read.parquet(f"{sf_medium}/documents.parquet").select("doc_id", "text").collect())
    assert check(QUERIES["op8_packing"](llm, sf_medium).collect(), texts, exact) < 0.01


def test_odd_texts_and_sequences(odd, empty, rows, exact):
    packed = pack(odd, public_tokenizer())
    check(packed.collect(), dict(rows), exact)
    made = sequences(packed).collect()
    assert all(len(r.ids) == 4 * r.n_tokens for r in made)
    assert sum(r.n_tokens for r in made) == sum(r.length for r in packed.collect())
    assert pack(empty, public_tokenizer()).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 30), max_size=10))
def test_plans_hold_every_length_once(demand):
    chosen = plan(demand, 24)
    held = Counter()
    for pattern, copies in chosen:
        assert sum(x * n for x, n in pattern.items()) <= 24 and copies > 0
        for x, n in pattern.items():
            held[x] += n * copies
    assert held == Counter(demand)
    rooms = []  # first fit, longest first
    for x in sorted(Counter(demand).elements(), reverse=True):
        at = next((i for i, room in enumerate(rooms) if room >= x), None)
        if at is None:
            rooms.append(24 - x)
        else:
            rooms[at] -= x
    assert sum(copies for _, copies in chosen) <= len(rooms) + len(demand)


def test_knapsack_equals_brute_force():
    lengths, values = np.array([3, 4, 7]), np.array([0.3, 0.45, 0.75])
    best, last = Knapsack(lengths, 20).solve(values)
    for total in range(21):
        sums = [
            a * 0.3 + b * 0.45 + c * 0.75
            for a in range(8) for b in range(6) for c in range(4) if 3 * a + 4 * b + 7 * c == total
        ]
        assert best[total] == pytest.approx(max(sums)) if sums else best[total] == -np.inf
