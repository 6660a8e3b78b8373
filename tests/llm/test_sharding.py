import math
import struct
import zlib

import xxhash

from tabulint.llm.sharding import BYTES_PER_ROW, assign_shards


def draw(key, shard):
    seed = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    bits = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed) >> 12
    return (bits + 0.5) / 2.0**52


def shard_of(key, weights):
    return max((s for s, w in enumerate(weights) if w > 0), key=lambda s: (-weights[s] / math.log(draw(key, s)), -s))


def test_equals_brute_force(odd, rows):
    weights = [1.0, 2.0, 0.0, 0.5, 1.0]
    found = assign_shards(odd, weights).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    texts = dict(rows)
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + BYTES_PER_ROW, zlib.crc32(data), "key")
        assert r.shard == shard_of(r.doc_id, weights) and r.grown_shard == shard_of(r.doc_id, [*weights, 1.0])
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_shares_follow_weights_and_growth_moves_only_into_the_new_shard(llm):
    docs = llm.range(40_000).selectExpr("id AS doc_id", "'x' AS text")
    found = assign_shards(docs, [1.0, 3.0]).toPandas()
    assert abs((found["shard"] == 1).mean() - 0.75) < 0.01
    moved = found[found["shard"] != found["grown_shard"]]
    assert set(moved["grown_shard"]) == {2} and abs(len(moved) / len(found) - 0.2) < 0.01


def test_null_and_repeated_keys_and_empty_table(llm, empty):
    docs = llm.createDataFrame([(None, "a"), (None, "a"), (5, "b"), (5, "b"), (5, None)], "doc_id long, text string")
    found = assign_shards(docs, [1.0] * 3).collect()
    assert len(found) == 5 and len({(r.shard, r.slot) for r in found}) == 5
    assert len({r.shard for r in found if r.doc_id == 5}) == 1
    assert assign_shards(empty, [1.0]).count() == 0


def test_plan_has_no_python(odd):
    plan = assign_shards(odd, [1.0] * 4)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
