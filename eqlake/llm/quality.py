"""Operator 4: quality rules whose thresholds carry a guarantee.

Base measures and rules come from the contract of the query. On top, each rule of ``RULES``
rejects a document whose measure lies above a cutoff. Cutoffs are chosen per stratum (the
language) and rule on labelled documents: along a fixed sequence from lenient to strict, a
cutoff is valid while the exact binomial test says that it rejects less than
``MAX_FALSE / number of rules`` of the good documents, at level ``CONFIDENCE_LOSS`` divided by
strata and rules (Bonferroni); the sequence stops at its first failure, which needs no further
correction. All valid cutoffs hold together with probability 1 - CONFIDENCE_LOSS. Among them
the one with the best balance of bad and good rejections is taken, the most lenient of equals.
A stratum without enough labels has no valid cutoff and rejects nothing beyond the base rules.

All of it is DataFrame expressions. A repeated three-word window is found by sorting a
document's windows; whole texts are read.

Defined results: null and empty texts have no words, fail the base rule and are not kept; a
null language is a stratum; labels other than 0 and 1 and null ids are not used; a document
labelled twice counts twice; repeated rows get equal results; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eqlake.llm.common import fix, register, table, text_of, words_of

MAX_FALSE, CONFIDENCE_LOSS, COST = 0.05, 0.05, 20.0
STEPS = 24

#: rule -> (measure over the columns below, first cutoff, factor from one cutoff to the next)
RULES: dict[str, tuple[str, float, float]] = {
    "symbols": ("n_symbols / n_words", 4.0, 0.8),
    "repeats": ("n_repeat_words / n_words", 1.0, 0.9),
    "dup_lines": ("100 * n_dup_lines / n_words", 50.0, 0.75),
    "long_words": ("word_chars / n_words", 30.0, 0.93),
    "short_words": ("n_words / word_chars", 1.0, 0.93),
}


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more: equal windows are neighbours once sorted."""
    n = F.size(words)
    shift = lambda k: F.slice(words, k, F.greatest(n - 2, F.lit(0)))
    two = F.zip_with(shift(1), shift(2), lambda a, b: F.concat(a, F.lit(" "), b))
    windows = F.zip_with(two, shift(3), lambda a, b: F.concat(a, F.lit(" "), b))
    placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

    def count(s: Column) -> Column:
        same = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
        at = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
        # Windows that overlap share words.
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")))["n"]

    return F.when(n >= 4, F.get(F.transform(F.array(placed), count), 0)).otherwise(0).cast("bigint")


def measures(docs: DataFrame, *, text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum and the base measures of every document."""
    t, w = F.col("t"), F.col("w")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.select("doc_id", F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), text_of(text).alias("t"))
    split = split.withColumn("w", words_of(t)).withColumn("lines", lines)
    out = split.select(
        "doc_id", "stratum",
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n), summed in logarithms; 1 from the mean on, where no test can pass."""
    import math

    odds, first = math.log(p) - math.log1p(-p), math.log1p(-p)
    start = F.struct((n * first).alias("term"), F.lit(0.0).alias("top"), F.lit(0.0).alias("sum"))

    def step(a: Column, i: Column) -> Column:
        # The largest term so far is kept apart, so that nothing underflows.
        top = F.when(i == 0, a["term"]).otherwise(F.greatest(a["top"], a["term"]))
        total = F.when(i == 0, F.lit(1.0)).otherwise(a["sum"] * F.exp(a["top"] - top) + F.exp(a["term"] - top))
        return F.struct((a["term"] + F.log((n - i) / (i + 1.0)) + odds).alias("term"), top.alias("top"), total.alias("sum"))

    done = F.aggregate(F.sequence(F.lit(0).cast("bigint"), k.cast("bigint")), start, step, lambda a: F.least(F.lit(1.0), F.exp(a["top"]) * a["sum"]))
    return F.when((k >= n * p) | (k >= n), F.lit(1.0)).otherwise(done)


def _value(rule: str) -> Column:
    return F.coalesce(F.expr(f"try_divide({RULES[rule][0].replace(' / ', ', ')})"), F.lit(0.0)).cast("double")


def thresholds(labelled: DataFrame) -> DataFrame:
    """Per stratum: map of rule to cutoff. ``labelled`` has stratum, quality and the measures."""
    values = F.array(*[F.struct(F.lit(r).alias("rule"), _value(r).alias("value"), F.array(*[F.lit(c * f**j) for j in range(STEPS)]).alias("cuts")) for r, (_, c, f) in RULES.items()])
    each = labelled.select("stratum", "quality", F.explode(values).alias("x")).select("stratum", "quality", "x.rule", F.size(F.filter("x.cuts", lambda c: c >= F.col("x.value"))).alias("from_step"))
    counts = each.groupBy("stratum", "rule", "from_step").agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
    per = fix(counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"), F.collect_list(F.struct("from_step", "good", "bad")).alias("steps")))
    strata = max(1, per.select("stratum").distinct().count())
    level = CONFIDENCE_LOSS / (strata * len(RULES))
    upto = lambda field, j: F.aggregate("steps", F.lit(0).cast("bigint"), lambda a, s: a + F.when(s["from_step"] <= j, s[field]).otherwise(0))
    along = F.transform(F.sequence(F.lit(0), F.lit(STEPS - 1)), lambda j: F.struct(j.alias("j"), upto("good", j).alias("good"), upto("bad", j).alias("bad")))
    tested = F.transform("along", lambda s: F.struct(s["j"].alias("j"), s["good"].alias("good"), s["bad"].alias("bad"), (binomial_cdf(s["good"], F.col("n"), MAX_FALSE / len(RULES)) <= level).alias("ok")))
    # Valid up to the first failure; then the best balance, the first of equals.
    start = F.struct(F.lit(True).alias("open"), F.lit(0.0).alias("best"), F.lit(-1).alias("j"))

    def better(a: Column, s: Column) -> Column:
        gain = s["bad"] - F.lit(COST) * s["good"]
        wins = a["open"] & s["ok"] & (gain > a["best"])
        return F.struct((a["open"] & s["ok"]).alias("open"), F.when(wins, gain).otherwise(a["best"]).alias("best"), F.when(wins, s["j"]).otherwise(a["j"]).alias("j"))

    chosen = per.withColumn("along", along).withColumn("tested", tested).select("stratum", "rule", F.aggregate("tested", start, better)["j"].alias("j"))
    cutoff = F.coalesce(*[F.when(F.col("rule") == r, F.lit(c) * F.pow(F.lit(f), F.col("j"))) for r, (_, c, f) in RULES.items()])
    return chosen.where("j >= 0").groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", cutoff))).alias("cuts"))


def apply_rules(stats: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``stats`` with kept: neither the base rules nor a chosen cutoff of the stratum reject."""
    above = [F.coalesce(_value(r) > F.element_at("cuts", F.lit(r)) * (1 + 1e-12), F.lit(False)) for r in RULES]
    rejected = above[0]
    for x in above[1:]:
        rejected = rejected | x
    return stats.join(cutoffs, "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~rejected).drop("cuts")


def judge(docs: DataFrame, labels: DataFrame, *, text: str = "text", stratum: str = "lang") -> DataFrame:
    stats = fix(measures(docs, text=text, stratum=stratum))
    known = labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    labelled = stats.where(~F.col("base_failed")).join(known, "doc_id")
    return apply_rules(stats, thresholds(labelled)).drop("stratum")


@register("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
