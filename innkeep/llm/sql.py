"""SQL twins of the operators that SQL can express, for the engine of the check."""

from __future__ import annotations

# The 256 remainders of CRC-32, as the one-row table ``bytes(tab)``.
CRC_TABLE = """bytes AS (
  SELECT list(t ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END, i) AS t
    FROM range(256) r(i))
)"""

# CRC-32 of the bytes whose hexadecimal digits are ``h``.
CRC = """xor(4294967295::BIGINT, list_reduce(
    [('0x' || substr(h, (2 * k + 1)::INT, 2))::BIGINT for k in range(len(h) // 2)],
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT))"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RESAMPLE = rf"""WITH {CRC_TABLE},
said AS (
  SELECT 0 AS side, row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, coalesce(text, '') FROM benchmark
),
words AS (
  SELECT side, row_id, doc_id, regexp_extract_all(
    {LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM said
),
runs AS (
  SELECT side, row_id, list_concat(w, [w[k] || ' ' || w[k + 1] for k in range(1, len(w))]) AS f FROM words
),
features AS (SELECT side, row_id, unnest(f) AS f FROM runs),
hashed AS (
  SELECT f, {CRC} % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)), bytes
),
counted AS (SELECT side, row_id, bucket, count(*) AS n FROM features JOIN hashed USING (f) GROUP BY ALL),
sums AS (
  SELECT b AS bucket, coalesce(sum(n) FILTER (side = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 1), 0)::DOUBLE AS t
  FROM range(10000) r(b) LEFT JOIN counted ON bucket = b GROUP BY b
),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
  FROM sums
),
weighed AS (
  SELECT row_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
  FROM counted JOIN gains USING (bucket) WHERE side = 0 GROUP BY row_id
),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (row_id) WHERE side = 0
),
ranked AS (
  SELECT *, n_words >= 20 AS fit,
    row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
    25 * sum((n_words >= 20)::INT) OVER () // 100 AS k
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= k THEN place END AS rank, n_words FROM ranked
"""


def _merkle(levels: int = 12, arity: int = 8) -> str:
    """Trees of up to ``arity ** levels`` leaves: nodes and siblings level by level."""
    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda t: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", t))) + ")"

    def climb(name: str, start: str) -> list[str]:
        """Of nodes ``g, pos, h, n``: per level the nodes, and with each the run's others before and after it."""
        out = [f"{name}0 AS ({start})"]
        for k in range(levels):
            run = "PARTITION BY g, pos // {0} ORDER BY pos ROWS BETWEEN {1}"
            before = run.format(arity, "UNBOUNDED PRECEDING AND 1 PRECEDING")
            after = run.format(arity, "1 FOLLOWING AND UNBOUNDED FOLLOWING")
            out.append(
                f"{name}{k}s AS (SELECT g, pos, n, h, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({before}), '') ELSE '' END AS l, "
                f"CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER ({after}), '') ELSE '' END AS r FROM {name}{k})"
            )
            out.append(
                f"{name}{k + 1} AS (SELECT g, CASE WHEN n > 1 THEN pos // {arity} ELSE pos END AS pos, "
                f"CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, "
                f"(any_value(n) + {arity} - 1) // {arity} AS n FROM {name}{k} GROUP BY g, CASE WHEN n > 1 THEN pos // {arity} ELSE pos END)"
            )
        return out

    def walk(name: str, leaves: str) -> list[str]:
        """From ``{leaves}`` (g, pos, p siblings so far, f folded so far) up the levels of a tree."""
        out, last = [], leaves
        for k in range(levels):
            up = f"CASE WHEN s.n > 1 THEN x.pos // {arity} ELSE x.pos END"
            out.append(
                f"{name}w{k} AS (SELECT x.* REPLACE ({up} AS pos, x.p || s.l || s.r AS p, "
                f"CASE WHEN s.n > 1 THEN sha256(s.l || x.f || s.r) ELSE x.f END AS f) "
                f"FROM {last} x JOIN {name}{k}s s ON s.g = x.g AND s.pos = x.pos)"
            )
            last = f"{name}w{k}"
        return out

    hit = f"({CRC}) % 3 = 0"
    ctes = [
        CRC_TABLE,
        "docs AS (SELECT *, hex(encode(doc_id::VARCHAR)) AS h, coalesce('=' || lang, '') AS g FROM documents)",
        f"leaf AS (SELECT doc_id, g, {leaf('text')} AS leaf, "
        f"CASE WHEN {hit} THEN {leaf(LOWER.format('text'))} ELSE {leaf('text')} END AS changed FROM docs, bytes)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
        "count(*) OVER (PARTITION BY g) AS n FROM leaf)",
        *climb("a", "SELECT g, pos, leaf AS h, n FROM placed"),
        f"top AS (SELECT g AS lang, h, row_number() OVER (ORDER BY encode(g)) - 1 AS pos, count(*) OVER () AS n FROM a{levels})",
        *climb("b", "SELECT 0 AS g, pos, h, n FROM top"),
        "start AS (SELECT doc_id, g, pos, leaf, '' AS p, changed AS f FROM placed)",
        *walk("a", "start"),
        f"over AS (SELECT doc_id, leaf, p, f, top.h AS subroot, 0 AS g, top.pos AS pos FROM aw{levels - 1} w JOIN top ON top.lang = w.g)",
        *walk("b", "over"),
    ]
    return "WITH " + ",\n".join(ctes) + (
        f"\nSELECT doc_id, leaf, subroot, b{levels}.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = b{levels}.h AS verified "
        f"FROM bw{levels - 1}, b{levels}"
    )


MERKLE = _merkle()

# Vectors whose components are all there and finite, as doubles.
_FINITE = """SELECT vec_id, [x::DOUBLE for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0"""

NEAR_VECTORS = f"""WITH RECURSIVE finite AS ({_FINITE}),
usable AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS size FROM finite WHERE list_max([abs(x) for x in e]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.9
),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
named AS (SELECT a, least(a, min(b)) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN named ON named.a = vec_id LEFT JOIN counted ON counted.a = vec_id
"""

TOP_K = f"""WITH finite AS ({_FINITE}),
whole AS (SELECT vec_id, [floor(1024 * x) for x in e] AS v FROM finite),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
