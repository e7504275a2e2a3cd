"""Secret scans: assignments, access ids and hexadecimal runs, and weak parts that belong together.

A lone key-like text is weak evidence. It is reported only when a part that
completes it stands nearby: an access id and a secret, or a secret and the
endpoint it opens. Parts of one text are joined by intervals: they are dealt
into buckets of ``reach`` characters, each to all that its span touches, and meet those whose span, widened by the reach, touches
the same, so that a text with very many parts is not joined with itself.

Spans are in code points, end exclusive. All matches of a pattern are the gaps'
and matches' lengths added up. Texts are scanned once for all kinds; only matches are shuffled, never texts.

Cases: null and empty texts have no spans. Rows that repeat an id and a text
each get the same spans; rows that share only the id are scanned apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listloom.llm.text import same_row, with_key
from listloom.session import frozen

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_KEY = "[A-Za-z0-9+/_-]"
_MIXED = "".join(f"(?={_KEY}*[{c}])" for c in ("0-9", "a-z", "A-Z"))

# kind: (pattern, group whose length counts, least length, role). Base kinds first, in their fixed order.
# Runs are matched whole, so the least length can be part of the pattern.
KINDS = {
    "assign": (ASSIGN, 1, 8, "secret"),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16, "id"),
    "hex": (r"[0-9a-f]{32,}", 0, 32, "secret"),
    "key_id": (r"(?<![A-Z0-9])(?:ASIA|AROA|AIDA|GOOG|LTAI)[A-Z0-9]{12,}", 0, 16, "id"),
    "key_secret": (rf"(?<!{_KEY}){_MIXED}{_KEY}{{24,}}", 0, 24, "secret"),
    "endpoint": (r"(?:https?|s3|jdbc:[a-z]+|postgres|mysql|redis|mongodb)://[^\x00-\x20\"'<>]+", 0, 8, "endpoint"),
}
BASE = ("assign", "access", "hex")
# Cheap conditions without which a kind cannot match.
_NEEDS = {
    "assign": ["pass", "secret", "token", "api"],
    "endpoint": ["://"],
}
# Which roles complete a weak part of a role.
COMPLETES = {"id": ["secret"], "secret": ["id", "endpoint"], "endpoint": ["secret"]}


def _found(kind: str) -> F.Column:
    """All matches of a kind in ``text``, in order: what lies before each, its length, and that of the part that counts."""
    pattern, group, _, _ = KINDS[kind]
    if kind in _NEEDS:
        low = F.lower("text")
        hit = F.lit(False)
        for needle in _NEEDS[kind]:
            hit = hit | F.contains(low, F.lit(needle))
    else:
        hit = F.col("text").rlike(pattern)
    lengths = lambda found: F.transform(found, F.length)
    found = F.arrays_zip(
        lengths(F.split("text", pattern, -1)).alias("gap"),
        lengths(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("n"),
        lengths(F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).alias("part"),
    )
    told = lambda m, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"), m["gap"].alias("gap"), m["n"].alias("n"), m["part"].alias("part"))
    return F.when(hit, F.transform(found, told))


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, kind, rank, start, end) of all kinds' matches that are long enough, from one scan of the texts."""
    nothing = F.array().cast("array<struct<kind:string,at:int,gap:int,n:int,part:int>>")
    every = F.concat(*[F.coalesce(_found(kind), nothing) for kind in KINDS])
    rows = with_key(docs).select("doc_id", "text_key", F.explode(every).alias("m")).filter("m.n is not null")
    # Repeated rows give repeated matches.
    rows = rows.select("doc_id", "text_key", "m.*").distinct()
    upto = W.partitionBy("doc_id", "text_key", "kind").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("n")).over(upto)
    least = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[2])])
    rank = F.create_map(*[F.lit(x) for n, k in enumerate(KINDS) for x in (k, n)])
    return (
        rows.withColumn("end", end)
        .filter(F.col("part") >= least[F.col("kind")])
        .select(
            "doc_id", "text_key", "kind", rank[F.col("kind")].alias("rank"),
            (F.col("end") - F.col("n")).cast("long").alias("start"), F.col("end").cast("long").alias("end"),
        )
    )


def linked(parts: DataFrame, reach: int = 300) -> DataFrame:
    """The weak parts that have a completing part at most ``reach`` characters away and no base part over them."""
    role = F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[3])])
    parts = parts.withColumn("role", role[F.col("kind")])
    # Weak parts lie in all buckets between start and end, others show themselves to all that their span, widened by the reach, touches.
    dealt = lambda rows, by: rows.withColumn(
        "bucket", F.explode(F.sequence(F.floor((F.col("start") - by) / reach), F.floor((F.col("end") + by) / reach)))
    )
    weak = dealt(parts.filter(~F.col("kind").isin(*BASE)), 0).alias("a")
    seen = dealt(parts, reach)
    wants = F.create_map(*[x for k, v in COMPLETES.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    other = seen.alias("b")
    same = (
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        & (F.col("a.text_key") == F.col("b.text_key"))
        & (F.col("a.bucket") == F.col("b.bucket"))
    )
    gap = F.greatest(F.col("b.start") - F.col("a.end"), F.col("a.start") - F.col("b.end"))
    near = same & (gap <= reach) & (gap >= 0) & F.array_contains(wants[F.col("a.role")], F.col("b.role"))
    span = ["doc_id", "text_key", "kind", "rank", "start", "end"]
    found = weak.join(other, near, "left_semi").select(*span).distinct()
    # A span is ruled out by a base part in any of its buckets.
    found = dealt(found, 0).alias("a")
    base = dealt(parts.filter(F.col("kind").isin(*BASE)), 0).alias("b")
    over = same & (F.col("b.start") < F.col("a.end")) & (F.col("a.start") < F.col("b.end"))
    marked = found.join(base.select("doc_id", "text_key", "bucket", "start", "end").alias("b"), over, "left_outer").select(
        *[F.col(f"a.{c}") for c in span], F.col("b.start").isNotNull().alias("hit")
    )
    return marked.groupBy(*span).agg(F.max("hit").alias("hit")).filter(~F.col("hit")).drop("hit")


def find_secrets(docs: DataFrame, reach: int = 300) -> DataFrame:
    """All spans: the base kinds, and weak parts that are linked."""
    # Kept once: matches are few, while each look at them would scan the texts again.
    parts = frozen(matches(docs))
    return parts.filter(F.col("kind").isin(*BASE)).unionByName(linked(parts, reach))


def secrets_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, the digest of the base spans, and all spans."""
    label = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    spans = find_secrets(docs).select("doc_id", "text_key", "kind", F.struct("start", "rank", label.alias("label")).alias("s"))
    joined = lambda rows: F.concat_ws(",", F.transform(F.sort_array(rows), lambda x: x["label"]))
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).alias(f"n_{kind}")
    is_base = F.col("kind").isin(*BASE)
    per_doc = spans.groupBy("doc_id", "text_key").agg(
        *[count(k) for k in BASE],
        joined(F.collect_list(F.when(is_base, F.col("s")))).alias("base"),
        joined(F.collect_list("s")).alias("spans"),
    )
    base = with_key(docs).select("doc_id", "text_key")
    zero, none = F.lit(0).cast("long"), F.lit("")
    return base.join(per_doc, same_row(base, per_doc), "left").select(
        base["doc_id"],
        *[F.coalesce(per_doc[f"n_{k}"], zero).alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce(per_doc["base"], none), 256).alias("base_sha256"),
        F.coalesce(per_doc["spans"], none).alias("spans"),
    )
