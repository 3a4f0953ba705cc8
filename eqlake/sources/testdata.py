"""Research panels derived from the shared test tables.

Two panels, both plain Spark aggregations of the given tables (their size grows
with the tables):

* ``events``: security = user (id padded to at least six digits, ``.SZ``), trade date =
  day of ``ts``; open/close = first/last value by ``(ts, event_id)``, high/low =
  max/min, volume = event count, amount = sum of values.
* ``lineitem``: security = supplier (``.SH``), trade date = ship day; price =
  extended price / quantity; open/close = first/last by
  ``(l_orderkey, l_linenumber, l_partkey, price)`` (the first two are not unique
  on their own), volume = sum of quantity, amount = sum of extended price.

Adjustment factors are data driven: the cumulative factor is
``(10 + running count of "corporate action" rows) / 10`` per security, and a
factor row exists only on days with at least one qualifying row, so the price
views see real left-join misses. The calendar covers every natural day between
the first and last trade date; ``weekends_closed=True`` gives a second calendar
for the missing-date and warm-up operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eqlake import schemas as S
from eqlake.session import tasks_for

PANELS = ("events", "lineitem")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of a table's files (a listing of them; 0 where there is no such table)."""
    jp = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    fs = jp.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(jp).getLength() if fs.exists(jp) else 0


def _digits(col: str, width: int):
    """The id as text, padded to at least ``width`` digits; longer ids stay whole."""
    text = F.col(col).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _code(col: str, suffix: str):
    return F.concat(_digits(col, 6), F.lit(suffix))


#: How counters are merged from one level to the next (the others are sums).
_MERGE = {"_high": F.max, "_low": F.min, "_hasf": F.max}


def _first_last(df: DataFrame, keys, order_cols, value: str, tie_lo, tie_hi, counters, final_aggs) -> DataFrame:
    """Open/close = value at the smallest/largest tuple of ``order_cols`` and a tie-breaker.

    One hash aggregate per ordering column, last column first: the lowest level groups by
    ``keys + order_cols`` and resolves the tie-breaker (``tie_lo``/``tie_hi``); each level
    above takes ``min_by``/``max_by`` over the column that the level below made unique.
    Buffers are single numbers, so every level is a HashAggregate and the columns may
    hold any number. With several ordering columns ``df`` is dealt by ``keys`` and the first
    of them, which all levels but the last share: a busy security-day stays spread over many
    tasks, and their number (by the source's size) bounds the groups that one holds.
    """
    lvl = df.groupBy(*keys, *order_cols).agg(tie_lo.alias("_lo"), tie_hi.alias("_hi"), *[c.alias(n) for n, c in counters.items()])
    for i in range(len(order_cols) - 1, 0, -1):
        merged = [_MERGE.get(c, F.sum)(c).alias(c) for c in counters]
        last = order_cols[i]
        lvl = lvl.groupBy(*keys, *order_cols[:i]).agg(F.min_by("_lo", last).alias("_lo"), F.max_by("_hi", last).alias("_hi"), *merged)
    first = order_cols[0]
    return lvl.groupBy(*keys).agg(F.min_by("_lo", first).alias("open"), F.max_by("_hi", first).alias("close"), *final_aggs)


def _daily(spark: SparkSession, sf_dir: str, panel: str) -> DataFrame:
    """One row per security-day with OHLCV plus the counters used for flags."""
    if panel == "events":
        # Ordering tuple (ts, event_id): level-1 key = ts in microseconds, tie-breaker event_id.
        e = table(spark, sf_dir, "events").select(
            "user_id", F.to_date("ts").alias("trade_date"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_k"),
            "event_id", "value", "event_type",
        )
        d = _first_last(
            e, ["user_id", "trade_date"], ["_k"], "value",
            F.min_by("value", "event_id"), F.max_by("value", "event_id"),
            {
                "_high": F.max("value"), "_low": F.min("value"), "_n": F.count(F.lit(1)),
                "_sum": F.sum("value"),
                "_flag": F.count_if(F.col("event_type") == "error"),
                "_action": F.count_if(F.col("event_type") == "signup"),
                "_hasf": F.max(F.col("event_type") != "error"),
            },
            [
                F.max("_high").alias("high"), F.min("_low").alias("low"), F.sum("_n").cast("double").alias("volume"),
                F.round(F.sum("_sum"), 2).alias("amount"), F.sum("_flag").alias("n_flag"),
                F.sum("_action").alias("n_action"), F.max("_hasf").alias("has_factor"),
            ],
        )
        return d.withColumn("ts_code", _code("user_id", ".SZ")).drop("user_id")
    if panel == "lineitem":
        # Ordering tuple (l_orderkey, l_linenumber, l_partkey), tie-breaker price.
        order = ["l_orderkey", "l_linenumber", "l_partkey"]
        li = table(spark, sf_dir, "lineitem").select(
            "l_suppkey", F.to_date("l_shipdate").alias("trade_date"), *order, "l_quantity", "l_extendedprice",
            (F.col("l_returnflag") == "A").alias("_a"), (F.col("l_returnflag") == "R").alias("_r"),
            (~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))).alias("_f"),
        )
        # The price is made from what is shuffled anyway.
        li = li.repartition(tasks_for(spark, table_bytes(spark, sf_dir, "lineitem")), "l_suppkey", "trade_date", order[0])
        li = li.withColumn("price", F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")))
        d = _first_last(
            li, ["l_suppkey", "trade_date"], order, "price", F.min("price"), F.max("price"),
            {
                "_high": F.max("price"), "_low": F.min("price"), "_qty": F.sum("l_quantity"),
                "_amt": F.sum("l_extendedprice"),
                "_flag": F.count_if("_a"),
                "_action": F.count_if("_r"),
                "_hasf": F.max("_f"),
            },
            [
                F.max("_high").alias("high"), F.min("_low").alias("low"), F.sum("_qty").alias("volume"),
                F.round(F.sum("_amt"), 2).alias("amount"), F.sum("_flag").alias("n_flag"),
                F.sum("_action").alias("n_action"), F.max("_hasf").alias("has_factor"),
            ],
        )
        return d.withColumn("ts_code", _code("l_suppkey", ".SH")).drop("l_suppkey")
    raise ValueError(f"unknown panel: {panel}")


def _daily_actions(spark: SparkSession, sf_dir: str, panel: str) -> DataFrame:
    """The factor columns of ``_daily`` from counters only. A supplier has few line items a day, so there they
    are dealt by the source's size before they are counted: counting them in the scan's tasks first
    would keep about a group for every row of a file split."""
    if panel == "events":
        security, action = _code("user_id", ".SZ"), F.col("event_type") == "signup"
        key, day, priced = "user_id", "ts", F.col("event_type") != "error"
    else:
        security, action = _code("l_suppkey", ".SH"), F.col("l_returnflag") == "R"
        key, day, priced = "l_suppkey", "l_shipdate", ~((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"))
    rows = table(spark, sf_dir, panel).select(key, F.to_date(day).alias("trade_date"), action.alias("_action"), priced.alias("_priced"))
    if panel == "lineitem":
        rows = rows.repartition(tasks_for(spark, table_bytes(spark, sf_dir, panel)), key, "trade_date")
    counted = rows.groupBy(key, "trade_date").agg(F.count_if("_action").alias("n_action"), F.max("_priced").alias("has_factor"))
    return counted.select(security.alias("ts_code"), "trade_date", "n_action", "has_factor")


def ohlcv(spark: SparkSession, sf_dir: str, panel: str = "events") -> DataFrame:
    """Processed daily bars (``ohlcv`` schema) of a panel.

    ``is_st`` marks days with two or more flag rows; ``limit_status`` applies the
    limit rule with up-limit = day high and down-limit = day low.
    """
    d = _daily(spark, sf_dir, panel)
    base = (
        F.when(F.col("close") > F.col("open"), 1).when(F.col("close") < F.col("open"), 3).otherwise(0)
    )
    status = (
        F.when(F.col("close") == F.col("low"), 4).when(F.col("close") == F.col("high"), 2).otherwise(base)
    ).cast("long")
    return d.select(
        "ts_code",
        "trade_date",
        "open",
        "high",
        "low",
        "close",
        F.lit(None).cast("double").alias("pre_close"),
        F.lit(None).cast("double").alias("change"),
        F.lit(None).cast("double").alias("pct_chg"),
        "volume",
        "amount",
        F.lit(False).alias("is_suspended"),
        (F.col("n_flag") >= 2).alias("is_st"),
        status.alias("limit_status"),
    )


def adj_factor(spark: SparkSession, sf_dir: str, panel: str = "events") -> DataFrame:
    """Cumulative adjustment factors: ``(10 + running action count) / 10``."""
    d = _daily_actions(spark, sf_dir, panel)
    w = Window.partitionBy("ts_code").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        d.withColumn("cum_action", F.sum("n_action").over(w))
        .filter("has_factor")
        .select(
            "ts_code",
            "trade_date",
            ((F.col("cum_action") + 10).cast("double") / F.lit(10.0)).alias("cumulative_factor"),
        )
    )


def trade_calendar(
    spark: SparkSession, sf_dir: str, panel: str = "events", *, weekends_closed: bool = False, exchange: str = "SSE"
) -> DataFrame:
    """``dim_trade_calendar`` rows for every day between the panel's first and last date.

    The calendar is one row per natural day (about 250 open days a year), so the
    single ordered window for ``pretrade_date`` is bounded by the date range, not
    by the data volume.
    """
    return calendar_between(_daily(spark, sf_dir, panel), weekends_closed=weekends_closed, exchange=exchange)


def calendar_between(bars: DataFrame, *, weekends_closed: bool = False, exchange: str = "SSE") -> DataFrame:
    """Calendar over every natural day between the first and last ``trade_date`` of ``bars``."""
    bounds = bars.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi")).alias("cal_date"))
    is_open = ~F.dayofweek("cal_date").isin(1, 7) if weekends_closed else F.lit(True)
    days = days.select(F.lit(exchange).alias("exchange"), "cal_date", is_open.alias("is_open"))
    w = Window.partitionBy("exchange").orderBy("cal_date").rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumn("pretrade_date", F.max(F.when(F.col("is_open"), F.col("cal_date"))).over(w)).select(
        *S.TRADE_CALENDAR_COLUMNS
    )


def securities(spark: SparkSession, sf_dir: str, panel: str = "events") -> DataFrame:
    """``dim_security`` snapshot: one row per security seen in the panel.

    ``list_status``: 'L' when traded on the last panel day, 'P' when traded on
    fewer than 10 days, else 'D'. Dates stay ``YYYYMMDD`` strings.
    """
    d = _daily(spark, sf_dir, panel)
    last_day = d.agg(F.max("trade_date").alias("last_day"))
    per = d.groupBy("ts_code").agg(
        F.min("trade_date").alias("first"), F.max("trade_date").alias("last"), F.count(F.lit(1)).alias("n_days")
    )
    # Attach the one-row "last panel day" aggregate (broadcast, equi join on a constant key).
    per = per.withColumn("_one", F.lit(1)).join(F.broadcast(last_day.withColumn("_one", F.lit(1))), "_one")
    status = (
        F.when(F.col("last") == F.col("last_day"), "L").when(F.col("n_days") < 10, "P").otherwise("D")
    )
    exch = F.when(F.col("ts_code").endswith(".SZ"), "SZSE").when(F.col("ts_code").endswith(".SH"), "SSE").otherwise("BSE")
    return per.select(
        "ts_code",
        F.substring_index("ts_code", ".", 1).alias("symbol"),
        F.concat(F.lit("security "), F.col("ts_code")).alias("name"),
        F.lit(None).cast("string").alias("area"),
        F.lit(None).cast("string").alias("industry"),
        F.lit(None).cast("string").alias("fullname"),
        F.lit(None).cast("string").alias("enname"),
        F.lit(None).cast("string").alias("cnspell"),
        F.lit("main").alias("market"),
        exch.alias("exchange"),
        F.lit("CNY").alias("curr_type"),
        status.alias("list_status"),
        F.date_format("first", "yyyyMMdd").alias("list_date"),
        F.when(status == "D", F.date_format("last", "yyyyMMdd")).alias("delist_date"),
        F.lit("N").alias("is_hs"),
        F.lit(None).cast("string").alias("act_name"),
        F.lit(None).cast("string").alias("act_ent_type"),
    )


# ---------------------------------------------------------------------------
# Raw (all-string) vendor frames derived from ``events``, for the normalisers.
# Codes get a venue by rule so that the research-universe filter has work:
# user_id % 10 == 9 -> B share on SH (900...), == 8 -> B share on SZ (200...),
# == 7 -> BJ, other even -> SZ, other odd -> SH.
# ---------------------------------------------------------------------------


def _raw_code():
    u = F.col("user_id")
    six, four = _digits("user_id", 6), _digits("user_id", 4)
    return (
        F.when(u % 10 == 9, F.concat(F.lit("900"), four, F.lit(".SH")))
        .when(u % 10 == 8, F.concat(F.lit("200"), four, F.lit(".SZ")))
        .when(u % 10 == 7, F.concat(six, F.lit(".BJ")))
        .when(u % 2 == 0, F.concat(six, F.lit(".SZ")))
        .otherwise(F.concat(six, F.lit(".SH")))
    )


def _raw_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user-day aggregates behind every raw frame, built once per session as a
    written table in the shared checkpoint folder (the "landed" raw data)."""
    from eqlake.plans.research import materialized

    return materialized(spark, sf_dir, "events-raw", "raw_daily", lambda: _raw_daily_build(spark, sf_dir))


def _raw_daily_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Same ordering tuple (ts, event_id) and two-level hash aggregation as the panels.
    e = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("d"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_k"),
        "event_id", "value", "event_type",
    )
    return _first_last(
        e, ["user_id", "d"], ["_k"], "value",
        F.min_by("value", "event_id"), F.max_by("value", "event_id"),
        {
            "_high": F.max("value"), "_low": F.min("value"), "_n": F.count(F.lit(1)),
            "_sum": F.sum("value"),
            "_err": F.count_if(F.col("event_type") == "error"),
            "_sig": F.count_if(F.col("event_type") == "signup"),
            "_pur": F.count_if(F.col("event_type") == "purchase"),
        },
        [
            F.max("_high").alias("high"), F.min("_low").alias("low"), F.sum("_n").alias("vol"),
            F.round(F.sum("_sum"), 2).alias("amount"), F.sum("_err").alias("n_error"),
            F.sum("_sig").alias("n_signup"), F.sum("_pur").alias("n_purchase"),
        ],
    ).select("user_id", "d", "open", "high", "low", "close", "vol", "amount", "n_error", "n_signup", "n_purchase")


def raw_daily_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily bars as strings (vendor layout, ``trade_date`` = ``YYYYMMDD``)."""
    r = _raw_daily(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    return r.select(
        _raw_code().alias("ts_code"),
        F.date_format("d", "yyyyMMdd").alias("trade_date"),
        s("open").alias("open"),
        s("high").alias("high"),
        s("low").alias("low"),
        s("close").alias("close"),
        F.lit("").alias("pre_close"),
        F.lit("").alias("change"),
        F.lit("").alias("pct_chg"),
        s("vol").alias("vol"),
        s("amount").alias("amount"),
    )


def raw_stock_st(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same-day ST lists: security-days with two or more error events."""
    r = _raw_daily(spark, sf_dir).filter(F.col("n_error") >= 2)
    return r.select(
        _raw_code().alias("ts_code"),
        F.lit("ST").alias("name"),
        F.date_format("d", "yyyyMMdd").alias("trade_date"),
        F.lit("S").alias("type"),
        F.lit("risk warning").alias("type_name"),
    )


def raw_stk_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily limit prices (columns start with ``trade_date``): up = high, down = low;
    security-days without a purchase event have no limit row."""
    r = _raw_daily(spark, sf_dir).filter(F.col("n_purchase") > 0)
    return r.select(
        F.date_format("d", "yyyyMMdd").alias("trade_date"),
        _raw_code().alias("ts_code"),
        F.lit("").alias("pre_close"),
        F.col("high").cast("string").alias("up_limit"),
        F.col("low").cast("string").alias("down_limit"),
    )


def raw_trade_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw calendar strings for the events days: weekends closed; exchange text is
    ' sse ' on even days of month and blank on odd days (blank -> default)."""
    d = table(spark, sf_dir, "events").select(F.to_date("ts").alias("d")).distinct()
    return d.select(
        F.when(F.dayofmonth("d") % 2 == 0, F.lit(" sse ")).otherwise(F.lit("")).alias("exchange"),
        F.date_format("d", "yyyyMMdd").alias("cal_date"),
        F.when(F.dayofweek("d").isin(1, 7), F.lit("0")).otherwise(F.lit("1")).alias("is_open"),
        F.lit("").alias("pretrade_date"),
    )


def raw_adj_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _raw_daily(spark, sf_dir)
    return r.select(
        _raw_code().alias("ts_code"),
        F.date_format("d", "yyyyMMdd").alias("trade_date"),
        ((F.col("n_signup") + 10).cast("double") / F.lit(10.0)).cast("string").alias("adj_factor"),
    )


def raw_daily_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valuation frame with vendor markers: blank ``pe`` when there is no purchase,
    negative ``volume_ratio`` when errors outnumber signups, zero share counts on
    single-event days."""
    r = _raw_daily(spark, sf_dir)
    s = lambda c: c.cast("string")
    pe = F.when(F.col("n_purchase") > 0, s(F.col("close") * F.col("n_purchase"))).otherwise(F.lit(""))
    vr = s(F.col("n_signup") - F.col("n_error"))
    shares = F.when(F.col("vol") > 1, s(F.col("vol") * 1000)).otherwise(F.lit("0"))
    return r.select(
        _raw_code().alias("ts_code"),
        F.date_format("d", "yyyyMMdd").alias("trade_date"),
        s(F.col("close")).alias("close"),
        s(F.col("vol")).alias("turnover_rate"),
        s(F.col("vol")).alias("turnover_rate_f"),
        vr.alias("volume_ratio"),
        pe.alias("pe"),
        F.when(F.col("n_error") > 0, F.lit("nan")).otherwise(pe).alias("pe_ttm"),
        s(F.col("high")).alias("pb"),
        s(F.col("low")).alias("ps"),
        F.lit("").alias("ps_ttm"),
        vr.alias("dv_ratio"),
        F.lit("").alias("dv_ttm"),
        shares.alias("total_share"),
        shares.alias("float_share"),
        shares.alias("free_share"),
        s(F.col("amount")).alias("total_mv"),
        s(F.col("amount")).alias("circ_mv"),
    )
