"""Factors day by day (PL1, F1, F5-F8): carried state instead of a warm-up window.

The state is a stored table, ``dims/factor_state``: the last rows of every security, as many as the
longest lookback needs and one more. A new day reads its own rows and the state, computes the
day's factors, stores them, and then replaces the state by one that ends with the day. The state
has some twenty rows a security, however long the history is.

A security's rows count, not calendar days, so a security that comes back after a long pause goes
on where it stopped; a run over a range gives the same if its input starts early enough.

Defined results: a day without rows stores nothing and moves the state's date on; a day may be run
again until the next one has run (the state holds one row more than is needed), after a correction
of its bars for example; another order of days is an error.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eqlake.functions.ranking import materialize
from eqlake.operators import factors as FX
from eqlake.operators import processing as PR
from eqlake.operators import repository as Q
from eqlake.operators.contracts import check_factor_output
from eqlake.plans.jobs import stored_inputs
from eqlake.sources.store import Store, prune_months

STATE = "factor_state"


def _metadatas(names: Sequence[str], version: str, registry: FX.FactorRegistry) -> list[FX.FactorMetadata]:
    if isinstance(names, str) or not names or len(set(names)) != len(names):
        raise ValueError("factor_names must be different names")
    return [registry.get(n, version) for n in names]


def _fields(metas: Sequence[FX.FactorMetadata]) -> list[str]:
    return list(dict.fromkeys(f for m in metas for f in m.required_fields))


def _last_rows(rows: DataFrame, metas: Sequence[FX.FactorMetadata], day: _dt.date) -> DataFrame:
    """The state after ``day``: the last rows of each security, and the day itself as ``as_of``."""
    keep = max(max(m.lookback_days, m.min_periods) for m in metas) + 1
    newest = Window.partitionBy("ts_code").orderBy(F.col("trade_date").desc())
    last = rows.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= keep).drop("_n", "as_of")
    return last.withColumn("as_of", F.lit(day))


def _save(store: Store, state: DataFrame, metas: Sequence[FX.FactorMetadata]) -> None:
    store.replace_dimension(STATE, state, None, ["ts_code", "trade_date", *_fields(metas), "as_of"])


def start_state(spark: SparkSession, store: Store, factor_names: Sequence[str], day: _dt.date, *, factor_version: str = "v1",
                registry: FX.FactorRegistry | None = None) -> None:
    """Build the state as of ``day`` from the stored history; the one step that reads all of it."""
    metas = _metadatas(factor_names, factor_version, registry or FX.build_default_registry())
    bars, adj, _ = stored_inputs(store)
    first = bars.agg(F.min("trade_date")).first()[0]
    if first is None or first > day:
        raise ValueError(f"no bars up to {day}")
    _save(store, _last_rows(Q.daily_panel(bars, adj, first, day, _fields(metas)), metas, day), metas)


def advance_factors(spark: SparkSession, store: Store, factor_names: Sequence[str], day: _dt.date, *, factor_version: str = "v1",
                    processor: str = "raw", registry: FX.FactorRegistry | None = None) -> int:
    """Compute and store the factors of the open day after the state's (or of that day again);
    returns the stored rows. If this stops before the state is saved, the day is simply run again."""
    registry = registry or FX.build_default_registry()
    metas = _metadatas(factor_names, factor_version, registry)
    bars, adj, cal = stored_inputs(store)
    state = store.read_dim(STATE)
    as_of = None if state is None else state.agg(F.max("as_of")).first()[0]
    if as_of is None:
        raise ValueError("no factor state: start it first")
    missing = [f for f in _fields(metas) if f not in state.columns]
    if missing:
        raise ValueError(f"the factor state lacks {missing}: start it for these factors")
    between = (F.col("exchange") == "SSE") & F.col("is_open") & (F.col("cal_date") > F.lit(as_of)) & (F.col("cal_date") <= F.lit(day))
    steps = [r[0] for r in cal.where(between).select("cal_date").orderBy("cal_date").limit(2).collect()]
    if day != as_of and steps != [day]:
        raise ValueError(f"the factor state is as of {as_of}; the next open day is {steps[0] if steps else None}, not {day}")
    today = Q.daily_panel(prune_months(bars, day, day), prune_months(adj, day, day), day, day, _fields(metas))
    columns = ["ts_code", "trade_date", *_fields(metas)]
    rows = materialize(state.where(F.col("trade_date") < F.lit(day)).select(*columns).unionByName(today.select(*columns)))
    wide = PR.observation_count(FX.compute_wide(rows, metas, registry)).where(F.col("trade_date") == F.lit(day))
    out = materialize(PR.process_long(FX.wide_to_long(wide, metas), metas, processor))
    n = out.count()
    if n:
        check_factor_output(out, day, day)
        store.write_factor_results(out)
    _save(store, _last_rows(rows, metas, day), metas)
    return n
