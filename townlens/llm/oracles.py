"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

#: Exact top-k: quantised vectors, integer inner products, ties to the smaller id.
TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: Removal of repeated bytes: all windows of 50 bytes, as 100 hex digits, with their least documents.
REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, unnest(range(0, length(h) // 2 - 49)) AS p, unnest(list_transform(range(0, length(h) // 2 - 49), lambda p: substr(h, 2 * p + 1, 100))) AS s FROM d),
gone AS (SELECT r, p FROM (SELECT r, doc_id, p, min(doc_id) OVER (PARTITION BY s) AS least FROM w) WHERE least < doc_id),
marked AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM gone),
runs AS (
  SELECT r, min(p) AS a, max(p) + 50 AS z
  FROM (SELECT r, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS run FROM marked) GROUP BY r, run
), cuts AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS kept_from FROM runs),
rest AS (
  SELECT d.r, coalesce(string_agg(substr(h, CAST(2 * kept_from + 1 AS BIGINT), CAST(2 * (a - kept_from) AS BIGINT)), '' ORDER BY a), '') AS before_last,
    coalesce(max(z), 0) AS last, coalesce(sum(z - a), 0) AS removed, count(z) AS n
  FROM d LEFT JOIN cuts ON d.r = cuts.r GROUP BY d.r
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(removed AS BIGINT) AS n_removed, CAST(n AS BIGINT) AS n_spans,
  sha256(unhex(before_last || substr(h, CAST(2 * last + 1 AS BIGINT)))) AS kept_sha256
FROM d JOIN rest ON d.r = rest.r
"""

#: crc32 of a text's bytes: each bit of each byte in turn.
_BYTES = "list_transform(range(length(hex(encode({x}))) // 2), lambda i: CAST('0x' || substr(hex(encode({x})), 2 * i + 1, 2) AS BIGINT))"
_CRC = "xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), " + _BYTES + "), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"

#: Levels of a tree that the SQL of the manifest unrolls: enough for 2^20 rows a group.
LEVELS = 20


def _tree(name: str, leaves: str, levels: int) -> str:
    """Levels 0 to `levels` of the trees of leaves (tree, pos, h): a group of one node stays as it is."""
    out = [f"{name}0 AS (SELECT tree, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(levels):
        out.append(f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (SELECT tree, pos // 2 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h FROM {name}{k} GROUP BY tree, pos // 2))")
    return ", ".join(out)


def _climb(name: str, start: str, tree: str, levels: int, key: str, pos: str) -> str:
    """From the rows of start (with proof, now) up one tree: the siblings in order, and the hash that they fold to."""
    out, before = [], start
    for k in range(levels):
        at = f"({pos} >> {k})"
        out.append(f"{name}{k + 1} AS (SELECT a.* EXCLUDE (proof, now), a.proof || coalesce(s.h, '') AS proof, CASE WHEN t.n = 1 THEN a.now WHEN s.h IS NULL THEN sha256(a.now) WHEN {at} % 2 = 1 THEN sha256(s.h || a.now) ELSE sha256(a.now || s.h) END AS now FROM {before} a JOIN (SELECT DISTINCT tree, n FROM {tree}{k}) t ON t.tree = a.{key} LEFT JOIN {tree}{k} s ON s.tree = a.{key} AND s.pos = xor({at}, 1))")
        before = f"{name}{k + 1}"
    return ", ".join(out)


_FIELD = "coalesce(octet_length(encode(CAST({x} AS VARCHAR))) || ':' || CAST({x} AS VARCHAR), '-')"
_leaf = lambda n_chars: "sha256(" + " || ".join(_FIELD.format(x=x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"

#: Merkle manifest: leaves, trees of the groups, the tree over them, proofs and their folding after tampering.
MANIFEST = f"""
WITH d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf("n_chars")} AS leaf, CASE WHEN {_CRC.format(x="CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS shown FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos FROM d), leaves AS (SELECT tree, pos, leaf AS h FROM o),
{_tree("t", "leaves", LEVELS)},
tops AS (SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, h, tree AS lang_tree FROM t{LEVELS}),
{_tree("r", "(SELECT tree, pos, h FROM tops)", 8)},
started AS (SELECT o.*, tops.h AS subroot, '' AS top, tops.pos AS top_pos, '' AS proof, shown AS now FROM o JOIN tops ON lang_tree = o.tree),
{_climb("u", "started", "t", LEVELS, "tree", "a.pos")}, {_climb("w", f"u{LEVELS}", "r", 8, "top", "a.top_pos")}
SELECT doc_id, leaf, subroot, (SELECT h FROM r8) AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = (SELECT h FROM r8) AS verified FROM w8
"""

#: Importance resampling: word runs, their buckets, gains, noise and ranks.
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+')"
_RUNS = "w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
RESAMPLED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents), b AS (SELECT {_WORDS} AS w FROM benchmark),
f AS (SELECT r, unnest({_RUNS}) AS x FROM d), g AS (SELECT unnest({_RUNS}) AS x FROM b),
k AS (SELECT x, {_CRC.format(x="x")} % 10000 AS bucket FROM (SELECT x FROM f UNION SELECT x FROM g)),
s AS (SELECT bucket, count(*) AS s FROM f JOIN k USING (x) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM g JOIN k USING (x) GROUP BY 1),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM f) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM g) + 10000)::DOUBLE))) AS BIGINT) AS gain FROM s FULL JOIN t USING (bucket)),
m AS (SELECT r, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN k USING (x) JOIN gain USING (bucket) GROUP BY r),
c AS (SELECT doc_id, len(w) AS words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN m USING (r)),
p AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY words >= 20) AS n FROM c)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM p
"""

ORACLES = {"op7_block_topk": TOPK, "op11_importance_resampling": RESAMPLED, "op12_suffix_dedup": REPEATS, "op13_merkle_manifest": MANIFEST}
