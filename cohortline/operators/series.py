"""Daily actor time series: merge (C5), running totals (C3), ratios (C4),
cross-source metrics (C6) and the single-day snapshot (C7).

Plan shape (see README "Plans"): all fact parts are unioned into one tall
relation and rolled up with ONE grouping on (actor_id, date); Spark aggregates
partially on the map side, so a hot actor or day is collapsed before the
shuffle. Running totals then need one more exchange on ``actor_id`` over the
*daily* rows, whose count per actor is bounded by the number of days in scope.
The reference's three windows plus two full outer joins become these two exchanges;
deals bring their own, by (login, day) and for their joins, before the merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.columns import zero_sql
from cohortline.operators.rollup import KEY, DailyPart, Measure, in_scope
from cohortline.params import Scope


# PARTITION BY actor_id ORDER BY date, all rows up to the current one.
RUNNING = "(PARTITION BY actor_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def in_days(start=None, end=None) -> Column:
    """Days of the half-open range [start, end); either side may be open."""
    return in_scope(F.col("date"), Scope.since(start, end))


def _exprs(texts: list[str]) -> list[Column]:
    """Generated columns as SQL expressions: one call to the JVM for each. All names in them are the
    library's own measure names."""
    return [F.expr(t) for t in texts]


def tall_rows(parts: list[DailyPart]) -> DataFrame:
    """All parts' rows in one relation: (actor_id, date, <measures>, <row flags>); another part's
    columns are typed NULLs. Rows without an actor are dropped (the full join would never merge
    them; the profile join drops them)."""
    tall = [part.rows.filter("actor_id IS NOT NULL").select(
                "actor_id", "date", *[m.row_value() for m in part.measures], F.expr(f"1L AS {part.flag}"))
            for part in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tall)


def merge_daily(parts: list[DailyPart]) -> DataFrame:
    """C5 as union + one grouping: (actor_id, date, <daily measures>, <row flags per part>).

    A measure is NULL on a (actor_id, date) where its part had no rows, like the
    missing side of a full outer join.
    """
    union = tall_rows(parts)
    measures = [(p, m) for p in parts for m in p.measures]
    daily = union.groupBy(*KEY).agg(*_exprs([f"{m.total(f'sum({m.name})')} AS {m.name}" for _, m in measures]
                                            + [f"count({p.flag}) AS {p.flag}" for p in parts]))
    out = [F.when(F.col(p.flag) > 0, m.post(F.col(m.name))).alias(m.name) if m.post
           else F.expr(f"CASE WHEN {p.flag} > 0 THEN {m.name} END AS {m.name}") for p, m in measures]
    return daily.select(*KEY, *out, *[p.flag for p in parts])


def running_totals(daily: DataFrame, parts: list[DailyPart]) -> DataFrame:
    """``cumulative_m`` = running SUM over the actor's days, shown on days the part has rows."""
    return daily.select("*", *_exprs([
        f"CASE WHEN {p.flag} > 0 THEN sum({m.name}) OVER {RUNNING} END AS cumulative_{m.name}"
        for p in parts for m in p.measures]))


def daily_part(part: DailyPart) -> DailyPart:
    """The part over its daily rows, for measures whose daily sum is not additive (rounded)."""
    rows = part.rows.filter("actor_id IS NOT NULL").select(*KEY, *[m.row_value() for m in part.measures])
    daily = rows.groupBy(*KEY).agg(*_exprs([f"{m.total(f'sum({m.name})')} AS {m.name}" for m in part.measures]))
    daily = daily.select(*KEY, *[m.post(F.col(m.name)).alias(m.name) if m.post else m.name for m in part.measures])
    return DailyPart(part.name, daily, [Measure(m.name, m.name, m.kind) for m in part.measures], part.ratios)


def snapshot_totals(parts: list[DailyPart], day) -> DataFrame:
    """The running totals of ``day`` only, without a window.

    Equals ``running_totals`` filtered to ``day`` (rows after ``day`` ignored): one grouping
    by actor with conditional sums, partially aggregated map side. Only a part whose daily
    sums are rounded (converted deals) is grouped by day first.
    """
    parts = [daily_part(p) if any(m.post for m in p.measures) else p for p in parts]
    daily = tall_rows(parts)
    on_day = f"date = DATE'{day.isoformat()}'"
    measures = [(p, m) for p in parts for m in p.measures]
    aggs = [f"sum(CASE WHEN {on_day} THEN {p.flag} END) AS {p.flag}" for p in parts]
    for _, m in measures:
        today = m.total(f"sum(CASE WHEN {on_day} THEN {m.name} END)")
        aggs += [f"{today} AS {m.name}", f"{m.total(f'sum({m.name})')} AS cumulative_{m.name}"]
    grouped = daily.filter(F.col("date") <= F.lit(day)).groupBy("actor_id").agg(*_exprs(aggs))
    any_row = " OR ".join(f"coalesce({p.flag}, 0) > 0" for p in parts)
    cols = [f"DATE'{day.isoformat()}' AS date", *[p.flag for p in parts]]
    for prefix in ("", "cumulative_"):
        cols += [f"CASE WHEN {p.flag} > 0 THEN {prefix}{m.name} END AS {prefix}{m.name}" for p, m in measures]
    return grouped.filter(any_row).select("actor_id", *_exprs(cols))


def ratio_columns(parts: list[DailyPart]) -> dict[str, str]:
    """C4: daily ratio and ratio of the running sums, x100, NULL on a zero denominator."""
    return {f"{prefix}{r.name}": r.sql(prefix) for p in parts for r in p.ratios for prefix in ("", "cumulative_")}


def cross_source_columns() -> dict[str, str]:
    """Cross-source ``pnl_usd`` and ``contract_count`` (each term NULL -> 0).

    ``contract_count`` adds deposits and withdrawals to the contract counts, as the
    reference computes it.
    """
    def added(zero, *names):
        return {prefix: " + ".join(f"coalesce({prefix}{n}, {zero})" for n in names) for prefix in ("", "cumulative_")}
    money = added(zero_sql(), "bo_pnl_usd", "mt5_pnl_usd")
    count = added("0", "bo_contract_count", "mt5_contract_count", "deposit_count", "withdrawal_count")
    return {f"{prefix}{name}": texts[prefix] for name, texts in (("pnl_usd", money), ("contract_count", count))
            for prefix in texts}


def finalize(df: DataFrame, parts: list[DailyPart], fill=None, cross_source=False) -> DataFrame:
    """One projection: ratios (C4), cross-source metrics (C6), column order, output types
    (money -> double, counts -> bigint) and the optional zero fill."""
    kinds = {}
    for p in parts:
        kinds.update({m.name: m.kind for m in p.measures})
        kinds.update({r.name: "ratio" for r in p.ratios})
    derived = ratio_columns(parts)
    if cross_source:
        derived.update(cross_source_columns())
        kinds.update(pnl_usd="money", contract_count="count")
    cols = []
    for n, kind in kinds.items():
        dtype = "bigint" if kind == "count" else "double"
        for c in (n, f"cumulative_{n}"):
            v = f"CAST({derived.get(c, c)} AS {dtype})"
            cols.append((v if fill is None else f"coalesce({v}, CAST({fill} AS {dtype}))") + f" AS {c}")
    return df.selectExpr("actor_id", "date", *cols)


def build_series(parts: list[DailyPart], fill=None, cross_source=False, snapshot_day=None) -> DataFrame:
    """C1 + C5 + C3 (or C7) + C4 (+ C6): the daily series of the given parts."""
    if snapshot_day is not None:
        totals = snapshot_totals(parts, snapshot_day)
    else:
        totals = running_totals(merge_daily(parts), parts)
    return finalize(totals, parts, fill=fill, cross_source=cross_source)
