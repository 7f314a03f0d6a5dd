"""The operators bound to the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark, sf_dir):
    from vigil.llm.near_dedup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "documents")).drop("k1", "k2")


def op2_main_text(spark, sf_dir):
    from vigil.llm.html import extract
    return extract(_table(spark, sf_dir, "pages"))


def op3_quality(spark, sf_dir):
    from vigil.llm.quality import scores
    return scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_pieces(spark, sf_dir):
    from vigil.llm.pieces import encode
    return encode(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    from vigil.llm.line_dedup import line_digest
    return line_digest(_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark, sf_dir):
    """Two runs over one ledger: an older state of the table (one language), then all of it."""
    from vigil.llm.secrets import secret_digest, update_ledger
    from vigil.session import scratch_path
    docs, ledger = _table(spark, sf_dir, "documents"), scratch_path(spark, "ledger")
    update_ledger(docs.where(F.col("lang") == "en"), ledger)
    return secret_digest(docs, ledger)


def op7_substring_dedup(spark, sf_dir):
    from vigil.llm.substring_dedup import substring_digest
    return substring_digest(_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    from vigil.llm.decontaminate import decontaminate
    return decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_embedding_dedup(spark, sf_dir):
    from vigil.llm.embedding_dedup import embedding_links
    return embedding_links(_table(spark, sf_dir, "embeddings"))


def op10_pii(spark, sf_dir):
    from vigil.llm.pii import pii_digest
    return pii_digest(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark, sf_dir):
    from vigil.llm.negatives import mine
    return mine(_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark, sf_dir):
    from vigil.llm.trie import prefix_trie, rebuilt
    return prefix_trie(rebuilt(_table(spark, sf_dir, "conversations")))


def op13_mixture(spark, sf_dir):
    from vigil.llm.mixture import mix_digest
    return mix_digest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_main_text, op3_quality, op4_pieces, op5_line_dedup, op6_secret_scan,
    op7_substring_dedup, op8_decontaminate, op9_embedding_dedup, op10_pii, op11_hard_negatives,
    op12_prefix_trie, op13_mixture)}

# fixed values: the white space trimmed from line ends, as DuckDB text
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _secret_sql() -> str:
    """Spans from the pieces between matches, kind by kind, in RE2 spelling."""
    either = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                      for w in ("password", "passwd", "secret", "token", "api_?key"))
    kinds = [  # kind, pattern, counted group, least length
        ("assign", "(?:" + either + """)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
        ("access", "AKIA[A-Z0-9]+", 0, 18),
        ("hex", "[0-9a-f]+", 0, 16),
        ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
        ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0)]
    one = " UNION ALL ".join(f"""
  SELECT doc_id, {k} AS k, '{name}' AS kind, {least} AS least,
         regexp_split_to_array(t, '{p}') AS gaps, regexp_extract_all(t, '{p}', 0) AS found,
         regexp_extract_all(t, '{p}', {g}) AS counted FROM d"""
                             for k, (name, p, g, least) in enumerate(kinds))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
pieces AS ({one}),
rows AS (SELECT doc_id, k, kind, least, unnest(range(1, len(found) + 1)) AS i, gaps, found, counted
         FROM pieces),
sized AS (SELECT doc_id, k, kind, least, i, length(gaps[i]) AS gap, length(found[i]) AS len,
                 length(counted[i]) AS counted FROM rows),
placed AS (SELECT *, CAST(sum(gap + len) OVER (PARTITION BY doc_id, k ORDER BY i) AS BIGINT) AS e
           FROM sized),
spans AS (SELECT doc_id, k, e - len AS s, kind || ':' || (e - len) || ':' || e AS span
          FROM placed WHERE counted >= least),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
         string_agg(span, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN per_doc p ON d.doc_id = p.doc_id"""


SQL = {
    "op5_line_dedup": f"""
WITH lines AS (
  SELECT d.doc_id, u.pos, u.line,
         translate(trim(u.line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
       LATERAL (SELECT unnest(d.l) AS line, unnest(range(len(d.l))) AS pos) u),
firsts AS (
  SELECT k, min(doc_id) AS holder FROM lines WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) > 1),
marked AS (
  SELECT l.doc_id, l.pos, l.line, (f.holder IS NOT NULL AND f.holder <> l.doc_id) AS gone
  FROM lines l LEFT JOIN firsts f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id""",

    "op6_secret_scan": _secret_sql(),

    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
met AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM positives p JOIN scored s USING (anchor_id)
  WHERE NOT s.alike AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM met WHERE rank <= 5""",

    # crc32, bit by bit: a byte is folded in, then eight times -1 shifts
    "op12_prefix_trie": """
WITH RECURSIVE own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
             string_split(conv_id::VARCHAR, ''), lambda c: list_concat([ascii(c)::BIGINT], list_transform(range(8), lambda k: -1::BIGINT))))),
           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT c.conv_id, o.i, 0 AS part, o.role, o.text FROM convs c JOIN own o
    ON o.conv_id = c.conv_id - c.conv_id % 100 AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, o.i, 1, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.i > c.h),
seq AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY part, i) AS d FROM turns),
members(conv_id, depth, node, parent, chars) AS (
  SELECT conv_id, 0::BIGINT, '', NULL::VARCHAR, 0::BIGINT FROM convs
  UNION ALL
  SELECT m.conv_id, s.d, md5(m.node || ':' || md5(s.role) || md5(s.text)), m.node, length(s.text)
  FROM members m JOIN seq s ON s.conv_id = m.conv_id AND s.d = m.depth + 1),
nodes AS (
  SELECT node, any_value(parent) AS parent, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs,
         any_value(chars) AS chars FROM members GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
ends AS (
  SELECT node, sha256(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id)) AS h
  FROM members m JOIN (SELECT conv_id, max(depth) AS depth FROM members GROUP BY conv_id) l
    ON m.conv_id = l.conv_id AND m.depth = l.depth GROUP BY node),
below AS (   -- a node is owned by its smallest member, which is a member of all nodes above it
  SELECT m.node, count(*) FILTER (WHERE k.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM nodes n LEFT JOIN kids k ON k.node = n.node
  JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth GROUP BY m.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, coalesce(e.h, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.node = n.node
JOIN below b ON b.node = n.node LEFT JOIN ends e ON e.node = n.node""",

    "op13_mixture": r"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5('13:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS key FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
filled AS (
  SELECT *, 2 * source_size AS cap, sum(source_size) OVER () AS words, sum(w) OVER () AS weight,
         coalesce(sum(2 * source_size) OVER before, 0) AS capped, coalesce(sum(w) OVER before, 0) AS held
  FROM sources WINDOW before AS (ORDER BY 2 * source_size / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT min_by((1.5::DOUBLE * words - capped) / (weight - held), (cap / w, rank)) AS level FROM filled
  WHERE w * ((1.5::DOUBLE * words - capped) / (weight - held)) <= cap),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, w * level) AS target FROM filled, level),
line AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, least(2 * t.source_size, CAST(round(t.target) AS BIGINT)) AS take,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id NULLS FIRST, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(begins + size, take) - begins)
            + greatest(0, least(begins + source_size + size, take) - begins - source_size)
            AS BIGINT) AS taken FROM line""",
}
