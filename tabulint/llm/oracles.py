"""SQL texts of the same results, where SQL can express them."""

from __future__ import annotations

# The primes of the public 64-bit xxHash, Spark's seed for it, and the CRC-32 polynomial.
PRIME = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
SEED = 42
POLYNOMIAL = 3988292384
WORD = 2**64


def times(a: str, b: int) -> str:
    return f"CAST((CAST({a} AS UHUGEINT) * {b}) % {WORD} AS UBIGINT)"


def plus(a: str, b: str) -> str:
    return f"CAST((CAST({a} AS UHUGEINT) + {b}) % {WORD} AS UBIGINT)"


def turned(a: str, bits: int) -> str:
    """``a`` with its bits turned to the left."""
    return f"({times(a, 2**bits)} + ({a} >> {64 - bits}))"


def hashed(source: str, seed: str, value: str, out: str, *, size: int) -> list[str]:
    """CTEs that add ``out`` to ``source``: the hash of a number of ``size`` bytes, from a seed column; NULL keeps the seed.

    A step each, as SQL would repeat an expression for every use of its value. The last is named ``source_out``.
    """
    one, two, three, four, five = PRIME
    number = f"CAST(CAST({value} AS HUGEINT) + CASE WHEN {value} < 0 THEN {WORD} ELSE 0 END AS UBIGINT)"
    if size == 8:
        steps = [times(number, two), times(turned("x", 31), one)]
        mix = f"xor({plus(seed, str(five + 8))}, x)"
        rest = [plus(times(turned("x", 27), one), str(four))]
    else:
        steps = [times(number, one)]
        mix = f"xor({plus(seed, str(five + 4))}, x)"
        rest = [plus(times(turned("x", 23), two), str(three))]
    steps += [mix, *rest, "xor(x, x >> 33)", times("x", two), "xor(x, x >> 29)", times("x", three), "xor(x, x >> 32)"]
    ctes, last = [], source
    for i, step in enumerate(steps):
        kept = "*" if i == 0 else "* EXCLUDE (x)"
        ctes.append(f"{source}_{out}_{i} AS (SELECT {kept}, {step} AS x FROM {last})")
        last = f"{source}_{out}_{i}"
    ctes.append(f"{source}_{out} AS (SELECT * EXCLUDE (x), CASE WHEN {value} IS NULL THEN {seed} ELSE x END AS {out} FROM {last})")
    return ctes


def sharded(shards: int, extra_bytes: int, buckets: int) -> str:
    steps = [
        # CRC-32 a byte at a time, with the table of the polynomial
        f"""crc_table AS (
  SELECT list(list_reduce(list_prepend(CAST(n AS UBIGINT), [CAST(0 AS UBIGINT) FOR k IN range(8)]),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, CAST({POLYNOMIAL} AS UBIGINT)) ELSE c >> 1 END) ORDER BY n) AS crcs
  FROM range(256) t(n))""",
        "spelt AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents)",
        f"""d AS (
  SELECT doc_id, CAST(length(h) // 2 AS BIGINT) + {extra_bytes} AS size,
    CAST(xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
      list_transform(regexp_extract_all(h, '..'), lambda b: CAST('0x' || b AS UBIGINT))),
      lambda c, b: xor(c >> 8, crcs[CAST(xor(c, b) % 256 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT)) AS BIGINT) AS text_crc32,
    CAST({SEED} AS UBIGINT) AS seed
  FROM spelt, crc_table)""",
        *hashed("d", "seed", "doc_id", "h1", size=8),
        f"draws AS (SELECT d_h1.*, CAST(s AS BIGINT) AS s FROM d_h1, range({shards + 1}) t(s))",
        *hashed("draws", "h1", "s", "h2", size=4),
        f"""best AS (
  SELECT doc_id, size, text_crc32, h1,
    CAST(arg_max(s, (h2 >> 12) * 64 + 63 - s) FILTER (WHERE s < {shards}) AS INT) AS shard,
    CAST(arg_max(s, (h2 >> 12) * 64 + 63 - s) AS INT) AS grown_shard
  FROM draws_h2 GROUP BY ALL)""",
        *hashed("best", "h1", "size", "h3", size=8),
        *hashed("best_h3", "h3", "text_crc32", "h4", size=8),
    ]
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY h4 % {buckets}, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM best_h3_h4"""


ORACLES: dict[str, str] = {
    "op3_sharding": sharded(shards=40, extra_bytes=16, buckets=1024),
    "op10_line_dedup": r"""
WITH l AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), w AS (
  SELECT doc_id, p, lines[p] || chr(10) || lines[p + 1] || chr(10) || lines[p + 2] AS win
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS p FROM l)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY win ORDER BY doc_id, p) AS n FROM w) WHERE n > 1
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS gone_at FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM later) GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(gone_at), 0) AS BIGINT) AS n_removed,
       CASE WHEN gone_at IS NULL THEN text
            ELSE coalesce(list_aggregate(list_filter(lines, lambda x, i: NOT list_contains(gone_at, i)), 'string_agg', chr(10)), '')
       END AS kept_text
FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id
""",
    "op6_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS words FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(words[p:p + 34], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS p FROM w)
), again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT doc_id, list(DISTINCT q) AS gone_at FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM again) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(gone_at), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN gone_at IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(gone_at, i)) END, ' '), '')) AS kept_sha256
FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id
""",
    "op4_suffix_dedup": r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS piece
  FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 AS BIGINT) - 99)) AS p FROM d)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY piece ORDER BY doc_id, p) AS n FROM s) WHERE n > 1
), marked AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS new FROM later
), numbered AS (
  SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked
), spans AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span
), kept AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(max(b), 0), CAST(length(any_value(h)) // 2 AS BIGINT) FROM d LEFT JOIN spans ON spans.doc_id = d.doc_id GROUP BY d.doc_id
), texts AS (
  SELECT d.doc_id, string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x) AS kept_hex FROM kept JOIN d ON d.doc_id = kept.doc_id GROUP BY d.doc_id
), sums AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(kept_hex)) AS kept_sha256
FROM d JOIN texts ON texts.doc_id = d.doc_id LEFT JOIN sums ON sums.doc_id = d.doc_id
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v AS a JOIN v AS c ON a.id % 100 = 0
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM positive AS p JOIN scored AS s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER best <= 10
""",
    "op12_exact_dedup": """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(lowered) AS text_sha256
FROM t
WINDOW same AS (PARTITION BY lowered)
""",
}
