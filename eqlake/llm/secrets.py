"""Operator 2: secret scans with multipart credential linking.

Base spans are found by patterns per kind (assign, access, hex). Weak parts say nothing by
themselves: names of accounts, long mixed tokens, addresses of endpoints. They are reported
only when complementary parts stand near in the same scope, a run of lines without a blank
one: an identifier when a secret is within ``REACH`` code points, a secret when an access
identifier or an account is, an endpoint when both are. Nearness is the gap between the end of
the earlier part and the start of the later one, so long parts reach as far as short ones. The
interval join is a running maximum of ends within (document, scope), linear in the number of
parts but for its sort.

All of it is DataFrame expressions. Positions come from splitting a text at its matches:
a match starts after the pieces and matches before it, a running sum over the exploded
matches. Documents without any match have nothing to explode.

Defined results: a null or empty text has no spans; the empty list is the empty string;
repeated rows are scanned each; an empty table gives no rows; extra columns are ignored.
Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind in the
order assign, access, hex, ident, token, endpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eqlake.llm.common import fix, register, table, text_of

REACH = 256

#: The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

#: kind -> (pattern, group whose length counts, least length, cheap test for texts that may match)
KINDS: dict[str, tuple[str, int, int, str]] = {
    "assign": (ASSIGN, 2, 8, r"(?i)passw|secret|token|api_?key"),
    "access": (ACCESS, 0, 16, r"AKIA[A-Z0-9]{12}"),
    # A run of 32 or more is its own leftmost match, so the bound may stand in the pattern.
    "hex": (r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
    "ident": (r"(?i)\b(?:user(?:name|_?id)?|login|account|client_?id|key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}", 0, 3, r"(?i)\b(?:user|login|account|client_?id|key_?id)[a-z_]{0,4}[\"']?\x20*[:=]"),
    "token": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{40,}", 0, 40, r"[A-Za-z0-9+/_-]{40}"),
    "endpoint": (r"(?i)\b(?:https?|jdbc:[a-z0-9]+|[a-z]+sql|mongodb|redis|amqp|s3)://[^\s\"'<>]+", 0, 8, r"://"),
}
BLANK = r"\n[\x20\t\r]*\n"
BASE = ("assign", "access", "hex")
_ORDER = {kind: i for i, kind in enumerate(KINDS)}


def _matches(text: Column, kind: str) -> Column:
    """Array of (piece before the match, match, counted group), as lengths in code points."""
    pattern, group, _, test = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    lengths = [F.transform(x, lambda v: F.length(v)) for x in (pieces, found, counted)]
    rows = F.transform(F.arrays_zip(*[x.alias(n) for x, n in zip(lengths, "pmc")]), lambda r: F.struct(F.lit(_ORDER[kind]).alias("kind"), r["p"].alias("p"), r["m"].alias("m"), r["c"].alias("c")))
    none = F.expr("cast(array() as array<struct<kind:int,p:int,m:int,c:int>>)")
    return F.when(text.rlike(test), rows).otherwise(none)


def _breaks(text: Column) -> Column:
    """Array with each blank line's distance in code points: from the end of the one before to its own end."""
    found = F.regexp_extract_all(text, F.lit(BLANK), F.lit(0))
    pieces = F.slice(F.split(text, BLANK, -1), 1, F.size(found))
    return F.zip_with(pieces, found, lambda p, m: F.length(p) + F.length(m))


def find_spans(docs: DataFrame, *, text: str = "text", reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows has row and doc_id of every document, spans row, kind (number), start, end."""
    t = F.col("t")
    base = F.concat(*[_matches(t, k) for k in BASE])
    weak = F.concat(*[_matches(t, k) for k in KINDS if k not in BASE])
    scanned = docs.select("doc_id", text_of(text).alias("t")).select("doc_id", "t", base.alias("base"))
    # Weak parts need a base secret or each other; without either kind of secret none can be reported.
    secret = (F.size("base") > 0) | t.rlike(KINDS["token"][3])
    scanned = scanned.select("doc_id", "base", F.when(secret, weak).alias("weak"), F.when(secret, _breaks(t)).alias("pieces"))
    some = F.size(F.coalesce("weak", F.expr("cast(array() as array<struct<kind:int,p:int,m:int,c:int>>)"))) > 0
    found = scanned.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.concat("base", F.when(some, F.col("weak")).otherwise(F.expr("cast(array() as array<struct<kind:int,p:int,m:int,c:int>>)"))).alias("parts"),
        F.when(some, F.col("pieces")).alias("pieces"),
    )
    found = fix(found)
    parts = found.where(F.size("parts") > 0).select("row", F.posexplode("parts").alias("k", "x")).select("row", "k", "x.*")
    order = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p") + F.col("m")).over(order)
    least = F.element_at(F.create_map(*[F.lit(v) for k, i in _ORDER.items() for v in (i, KINDS[k][2])]), F.col("kind"))
    parts = parts.withColumn("end", end).where(F.col("c") >= least).select("row", "kind", (F.col("end") - F.col("m")).alias("start"), "end")
    # Scope: how many blank lines come before, a running sum over parts and breaks together.
    breaks = found.where(F.size("pieces") > 0).select("row", F.posexplode("pieces").alias("k", "p"))
    length = F.sum("p").over(Window.partitionBy("row").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    breaks = breaks.select("row", F.lit(-1).alias("kind"), length.alias("start"), length.alias("end"))
    scope = F.sum((F.col("kind") == -1).cast("int")).over(Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.unionByName(breaks).withColumn("scope", scope).where("kind >= 0")
    # A part is near if it starts before this one's end + reach and ends after its start - reach: parts stand
    # at their starts, questions of weak parts at end + reach, and the largest end up to there decides.
    of = lambda *names: F.when(F.col("kind").isin([_ORDER[n] for n in names]), F.col("end"))
    none = F.lit(None).cast("bigint")
    stands = F.struct(F.col("start").alias("at"), F.lit(0).alias("asks"), of("assign", "hex", "token").alias("secret"), of("access", "ident").alias("id"))
    asks = F.struct((F.col("end") + reach).alias("at"), F.lit(1).alias("asks"), none.alias("secret"), none.alias("id"))
    events = parts.select("row", "scope", "kind", "start", "end", F.explode(F.array(stands, asks)).alias("e")).select("row", "scope", "kind", "start", "end", "e.*")
    before = Window.partitionBy("row", "scope").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    near = lambda c: F.coalesce(F.max(c).over(before) >= F.col("start") - reach, F.lit(False))
    parts = events.withColumn("has_secret", near("secret")).withColumn("has_ident", near("id")).where("asks = 1")
    reported = (
        (F.col("kind") < len(BASE))
        | ((F.col("kind") == _ORDER["ident"]) & F.col("has_secret"))
        | ((F.col("kind") == _ORDER["token"]) & F.col("has_ident"))
        | ((F.col("kind") == _ORDER["endpoint"]) & F.col("has_secret") & F.col("has_ident"))
    )
    return found.select("row", "doc_id"), parts.where(reported).select("row", "kind", "start", "end")


def scan(docs: DataFrame, *, text: str = "text", reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    rows, spans = find_spans(docs, text=text, reach=reach)
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
    per = spans.groupBy("row").agg(listed.alias("all"))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    found = F.coalesce("all", F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"))
    count = lambda k: F.size(F.filter("all", lambda s: s["kind"] == _ORDER[k])).cast("bigint").alias(f"n_{k}")
    return rows.join(per, "row", "left").withColumn("all", found).select(
        "doc_id", *[count(k) for k in BASE],
        F.sha2(joined(F.filter("all", lambda s: s["kind"] < len(BASE))), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"),
    )


@register("op2_secrets")
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
