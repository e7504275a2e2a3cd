"""The registered queries of this package, each over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from listloom.llm import (
    decontaminate, infill, jaccard, licenses, mixing, packing, pages, prefixes, quality, secrets, suffixes, tokens, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A standing tokenizer; it is installed beside the libraries of every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_report(_table(spark, folder, "documents"))


def op2_passages(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.passages_report(_table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_report(_table(spark, folder, "documents"), vocabulary())


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(_table(spark, folder, "documents"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(_table(spark, folder, "documents"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secrets_report(_table(spark, folder, "documents"))


def op9_pages(spark: SparkSession, folder: str) -> DataFrame:
    return pages.pages_report(_table(spark, folder, "pages"))


def op10_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_report(_table(spark, folder, "documents"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_report(_table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


def op12_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.prefix_trie(_table(spark, folder, "conversations"))


def op13_infill(spark: SparkSession, folder: str) -> DataFrame:
    return infill.infill_report(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_mixing, op2_passages, op3_toxicity, op4_tokens, op5_licenses, op6_decontamination, op7_quality, op8_secrets,
        op9_pages, op10_jaccard, op11_packing, op12_prefixes, op13_infill,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"



def _quoted(text: str) -> str:
    escaped = text.replace("'", "''").replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '")
    return "('" + escaped.replace("\x0b", "' || chr(11) || '").replace("\x0c", "' || chr(12) || '").replace("\r", "' || chr(13) || '") + "')"


_COMMON = sorted({w for ws in quality.COMMON_WORDS.values() for w in ws})
# (kind, number, count) of each bin of the two histograms; the last of each kind takes the rest.
_BINS = [
    *[f"('char', {k}, length(t) - length(translate(t, {_quoted(c)}, '')))" for k, c in enumerate(quality.CLASSES)],
    *[f"('word', {k}, len(list_filter(w, lambda x: x = '{word}')))" for k, word in enumerate(_COMMON)],
]
_LANGUAGES = ", ".join(f"'{g}'" for g in quality.COMMON_WORDS)
_QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, CASE WHEN lang IN ({_LANGUAGES}) THEN lang ELSE 'other' END AS grp,
    coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents
),
runs AS (SELECT rid, i, array_to_string(w[i : i + 4], ' ') AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM runs) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
base AS (
  SELECT d.*, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')))) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(w) < 10 OR 100 * coalesce(n_repeat_words, 0) > 20 * len(w) AS base_failed
  FROM d LEFT JOIN covered USING (rid)
),
listed AS (
  SELECT rid, grp, base_failed, length(t) AS n_chars, n_words, unnest([{", ".join(f"{{'kind': {b.split(', ')[0][1:]}, 'k': {b.split(', ')[1]}, 'c': {b.split(', ', 2)[2][:-1]}}}" for b in _BINS)}], recursive := true)
  FROM base
),
bins AS (
  SELECT rid, grp, base_failed, kind, k, c FROM listed
  UNION ALL SELECT rid, any_value(grp), any_value(base_failed), kind, -1,
    CASE kind WHEN 'char' THEN any_value(n_chars) ELSE any_value(n_words) END - sum(c) FROM listed GROUP BY rid, kind
),
refs AS (SELECT grp, kind, k, CAST(sum(c) AS DOUBLE) AS r FROM bins WHERE NOT base_failed GROUP BY grp, kind, k),
parts AS (
  SELECT rid, kind, c / nullif(sum(c) OVER (PARTITION BY rid, kind), 0) AS p, r / nullif(sum(r) OVER (PARTITION BY rid, kind), 0) AS q
  FROM bins JOIN refs USING (grp, kind, k)
),
far AS (
  SELECT rid, kind, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS distance FROM parts WHERE p IS NOT NULL AND q IS NOT NULL GROUP BY rid, kind
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(word_chars >= {quality.CHAR_LEAST} AND c.distance > {quality.CHAR_LIMIT}, false)
    AND NOT coalesce(n_words >= {quality.WORD_LEAST} AND v.distance > {quality.WORD_LIMIT}, false) AS kept
FROM base LEFT JOIN far c ON c.rid = base.rid AND c.kind = 'char' LEFT JOIN far v ON v.rid = base.rid AND v.kind = 'word'
"""

ORACLE: dict[str, str] = {
    "op6_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))
),
h AS (SELECT rid, i, n, item FROM dw JOIN bw USING (n, win)),
c AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
t AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN t USING (rid)
""",
    "op7_quality": _QUALITY,
    "op10_jaccard": rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_SPACED_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(w[i : i + 3], ' ') AS sh
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY a.rid, b.rid),
l AS (SELECT x, y FROM p JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
reach(x, y) AS (SELECT rid, rid FROM d UNION SELECT r.x, l.y FROM reach r JOIN l ON r.y = l.x),
m AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON y = rid GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM d LEFT JOIN n USING (rid) JOIN m ON m.x = d.rid
""",
    "op12_prefixes": rf"""
WITH t AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS pos FROM t),
c AS (
  SELECT conv_id, conv_id - ((conv_id % 20) + 20) % 20 AS lead, list_reduce(
      [CAST(4294967295 AS UBIGINT)] || flatten([[CAST(ascii(x) AS UBIGINT), {", ".join(["1099511627776"] * 8)}] FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
      lambda a, x: CASE WHEN x < 1099511627776 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS UBIGINT)) ELSE a >> 1 END
    ) AS crc FROM (SELECT DISTINCT conv_id FROM t)
),
h AS (SELECT conv_id, lead, CASE WHEN lead = conv_id THEN 0 ELSE xor(crc, CAST(4294967295 AS UBIGINT)) % 4 END AS h FROM c),
u AS (
  SELECT h.conv_id, 0 AS own, pos, digest, words FROM h JOIN placed p ON p.conv_id = lead AND pos < h
  UNION ALL SELECT h.conv_id, 1, pos, digest, words FROM h JOIN placed p ON p.conv_id = h.conv_id AND pos >= h
),
r AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS k, words FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)),
m AS (SELECT conv_id, depth, k, words FROM r UNION ALL SELECT conv_id, 0, '', 0 FROM h),
e AS (SELECT conv_id, max_by(k, depth) AS k FROM m GROUP BY conv_id),
ends AS (SELECT k, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS s FROM e GROUP BY k),
n AS (SELECT k, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS own FROM m GROUP BY k),
kids AS (SELECT left(k, length(k) - 32) AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k)),
below AS (
  SELECT left(k, 32 * j) AS k, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved FROM (SELECT *, unnest(range(depth + 1)) AS j FROM v) GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  coalesce(s, sha256('')) AS ends_sha256
FROM v JOIN below USING (k) LEFT JOIN ends USING (k) LEFT JOIN n p ON v.depth > 0 AND p.k = left(v.k, length(v.k) - 32)
""",
    "op13_infill": rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
u AS (
  SELECT *, len(l) AS n, {", ".join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS UBIGINT) AS h{k + 1}" for k in range(4))} FROM d
),
c AS (SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS a, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS b FROM u),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(l[1:a], '') AS p, array_to_string(l[a + 1 : b], '') AS m, array_to_string(l[b + 1 :], '') AS s FROM c
),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS out
  FROM f
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(out) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN out
    WHEN 'psm' THEN substr(out, 4, strpos(out, '<S>') - 4) || substr(out, strpos(out, '<M>') + 3)
      || substr(out, strpos(out, '<S>') + 3, strpos(out, '<M>') - strpos(out, '<S>') - 3)
    ELSE substr(out, strpos(out, '<P>') + 3, strpos(out, '<M>') - strpos(out, '<P>') - 3) || substr(out, strpos(out, '<M>') + 3)
      || substr(out, 4, strpos(out, '<P>') - 4) END) AS restored_sha256
FROM o
""",
}
