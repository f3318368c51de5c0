"""Peak-to-mean demand variability with weighted roll-ups.

Input rows ("cells") carry a quantity ``q``. Over a group of cells:

* leaf form: ``all = SUM(q)``, ``variability = MAX(q) / AVG(q)``,
  ``significance = SUM(q) * MAX(q) / AVG(q)``;
* weighted form over child groups: ``all = SUM(child.all)``,
  ``significance = SUM(child.significance)``,
  ``variability = SUM(child.significance) / SUM(child.all)``.

Since ``AVG = SUM / COUNT``, ``SUM * MAX / AVG = COUNT * MAX``. Each leaf group
is therefore kept as three integers ``n = COUNT(q)``, ``m = MAX(q)``,
``a = SUM(q)``: leaf variability is ``n*m / a``, significance ``n*m``,
weighted variability ``SUM(n*m) / SUM(a)``. Integer sums do not depend on
order, there is a single exact decimal division per value, and ``(n, m, a)``
merge upward with ``(sum, max, sum)``. So every metric table comes from one
leaf aggregate per period kind (week, month); coarser leaf tables are merges
of the fine leaf, never a second pass over the cells.

Averages divide by the number of cells *present*: periods without cells are
absent, not zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods
from ..functions.rules import null_default
from ..session import cut_lineage

SC = "sales_channel"
BU = "business_unit"
SP = "shipment_point_code"
DEST = "delivery_point_name"
DIMS = (SC, BU, SP, DEST)

DATE = "shipment_date_plan"
DAY_QTY = "day_transportation_quantity"
SWEEK_QTY = "sintetic_week_transportation_quantity"
WEEK_NO, MONTH_NO, YEAR_NO, SWEEK = "week_no", "month_no", "year_no", "week_sintetic"

WEEK = (WEEK_NO,)
MONTH = (YEAR_NO, MONTH_NO)
PERIODS = {"week": WEEK, "month": MONTH}
PERIOD = "period"

RATIO_TYPE = "decimal(18,6)"


@dataclass(frozen=True)
class Metric:
    """One metric family: grouping dimensions, form and mart column stem."""

    name: str
    dims: tuple[str, ...]
    form: str  # "leaf" or "weighted"
    base: str | None  # weighted only: the leaf family it rolls up
    column: str  # mart column stem: {column}_{week|month}_variability


# In mart column order.
METRICS: tuple[Metric, ...] = (
    Metric("total", (), "weighted", "dest", "total"),
    Metric("sc", (SC,), "weighted", "dest", "sales_channel"),
    Metric("bu", (SC, BU), "weighted", "dest", "business_unit"),
    Metric("sp", (SC, BU, SP), "weighted", "dest", "shipment_point"),
    Metric("dest", (SC, BU, SP, DEST), "leaf", None, "delivery_point"),
    Metric("all_bu", (BU,), "weighted", "all_dest", "all_business_unit"),
    Metric("all_sp", (BU, SP), "weighted", "all_dest", "all_shipment_point"),
    Metric("all_dest", (BU, SP, DEST), "leaf", None, "all_delivery_point"),
    Metric("sc_bu_dest", (SC, BU, DEST), "leaf", None, "sc_bu_dest"),
    Metric("sc_dest", (SC, DEST), "leaf", None, "sc_dest"),
    Metric("bu_dest", (BU, DEST), "leaf", None, "bu_dest"),
    Metric("only_dest", (DEST,), "leaf", None, "dest"),
)
METRIC_BY_NAME = {m.name: m for m in METRICS}
MART_KEYS = (SC, BU, SP, "delivery_point", "week", "month", "year")
MART_COLUMNS = MART_KEYS + tuple(
    f"{m.column}_{p}_variability" for m in METRICS for p in ("week", "month")
)


def ratio(num, den) -> Column:
    """Exact ``num / den`` as DECIMAL(18,6) (half-up); NULL when ``den`` is 0."""
    n = (F.col(num) if isinstance(num, str) else num).cast("decimal(38,0)")
    d = (F.col(den) if isinstance(den, str) else den).cast("decimal(38,0)")
    return F.try_divide(n, d).cast(RATIO_TYPE)


# --- cells -----------------------------------------------------------------


def day_cells(
    rows: DataFrame,
    date: Column,
    dims: Mapping[str, Column],
    counted: Column,
) -> DataFrame:
    """One row per (date, dims): ``COUNT(counted)`` shipments that day.

    Rows without a date are dropped. Dimension expressions are projected
    first and grouped by name, so each rule is evaluated once per row.
    """
    projected = rows.select(
        date.alias(DATE), *[c.alias(n) for n, c in dims.items()], counted.alias("__counted")
    ).where(F.col(DATE).isNotNull())
    return projected.groupBy(DATE, *dims.keys()).agg(F.count("__counted").alias(DAY_QTY))


def with_periods(cells: DataFrame, date: str = DATE) -> DataFrame:
    """Add ISO week key, calendar month and year, and synthetic week."""
    return cells.select(
        "*",
        periods.iso_week_key(date).alias(WEEK_NO),
        periods.calendar_month(date).alias(MONTH_NO),
        periods.calendar_year(date).alias(YEAR_NO),
        periods.synthetic_week(date).alias(SWEEK),
    )


def synthetic_week_cells(cells: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Sum day cells per (year, month, synthetic week, dims); week 0 is left out."""
    return (
        cells.where(F.col(SWEEK) != 0)
        .groupBy(YEAR_NO, MONTH_NO, SWEEK, *dims)
        .agg(F.sum(DAY_QTY).alias(SWEEK_QTY))
    )


def base_rows(cells: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Distinct (year, month, week, dims) over day cells (synthetic week 0 included)."""
    return cells.select(YEAR_NO, MONTH_NO, WEEK_NO, *dims).distinct()


# --- (n, m, a) statistics ----------------------------------------------------


def leaf_stats(cells: DataFrame, period: Sequence[str], dims: Sequence[str], qty: str) -> DataFrame:
    """``n, m, a`` per (period, dims) over the cells."""
    return cells.groupBy(*period, *dims).agg(
        F.count(qty).alias("n"), F.max(qty).alias("m"), F.sum(qty).alias("a")
    )


def merge_stats(stats: DataFrame, period: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """Merge finer ``(n, m, a)`` groups into coarser ones: sum, max, sum."""
    return stats.groupBy(*period, *dims).agg(
        F.sum("n").alias("n"), F.max("m").alias("m"), F.sum("a").alias("a")
    )


def fine_stats(day: DataFrame, kind: str, dims: Sequence[str] = DIMS) -> DataFrame:
    """Finest leaf statistics for ``kind`` = ``week`` (day cells) or ``month``
    (synthetic-week cells)."""
    if kind == "week":
        return leaf_stats(day, WEEK, dims, DAY_QTY)
    return leaf_stats(synthetic_week_cells(day, dims), MONTH, dims, SWEEK_QTY)


def metric_table(fine: DataFrame, kind: str, metric: Metric) -> DataFrame:
    """One metric table: period keys, dims, ``all_qty``, ``significance``,
    ``variability`` (DECIMAL(18,6))."""
    period = PERIODS[kind]
    if metric.form == "leaf":
        st = fine if metric.dims == DIMS else merge_stats(fine, period, metric.dims)
        return st.select(
            *period,
            *metric.dims,
            F.col("a").alias("all_qty"),
            (F.col("n") * F.col("m")).alias("significance"),
            ratio(F.col("n") * F.col("m"), "a").alias("variability"),
        )
    base = METRIC_BY_NAME[metric.base]
    st = fine if base.dims == DIMS else merge_stats(fine, period, base.dims)
    agg = st.groupBy(*period, *metric.dims).agg(
        F.sum("a").alias("all_qty"), F.sum(F.col("n") * F.col("m")).alias("significance")
    )
    return agg.select("*", ratio("significance", "all_qty").alias("variability"))


def period_stats(cells: DataFrame, kind: str, dims: Sequence[str] = DIMS) -> DataFrame:
    """``fine_stats`` with a row for every (period, dims) that has day cells.

    They differ for months: combinations with days in synthetic week 0 only have ``n = a = 0`` and no ``m`` here, so
    their month's coarser metrics can be looked up by the same row.
    """
    if kind == "week":
        return fine_stats(cells, kind, dims)
    weeks = cells.groupBy(*MONTH, SWEEK, *dims).agg(F.sum(DAY_QTY).alias(SWEEK_QTY))
    counted = weeks.select(*MONTH, *dims, F.when(F.col(SWEEK) != 0, F.col(SWEEK_QTY)).alias(SWEEK_QTY))
    return leaf_stats(counted, MONTH, dims, SWEEK_QTY).withColumn("a", F.coalesce("a", F.lit(0)))


def period_name(kind: str) -> Column:
    """One text for each period of either kind, from the period's columns."""
    return F.concat(F.lit(f"{kind} "), F.concat_ws("-", *[F.col(c).cast("string") for c in PERIODS[kind]]))


def metric_lattice(cells: DataFrame) -> DataFrame:
    """(period, dims) of both kinds that have day cells, with the variabilities of all 12 families.

    The families form a lattice over the fine ``(n, m, a)`` rows, which are built once for each kind and then share a plan:

    * every leaf family holds the delivery point, so one exchange by (period, delivery point) serves all of them as
      windows that merge ``(sum, max, sum)``;
    * one aggregate to shipping points sums ``a`` and ``n * m`` for the weighted families, and for the families over
      all channels the merged leaf of each (unit, point, delivery point), counted at one of its rows;
    * the coarser levels (unit, channel, total; all points, all units) are sums of these rows, taken as windows over
      shipping-point rows after one exchange by period. A period's rows there are its combinations of channel, unit
      and shipping point, whatever the number of shipments or delivery points.

    One join then brings the weighted families back to the fine rows. Both its sides start from the exchange by
    delivery point, which Spark runs once and reuses.
    """
    fine = [period_stats(cells, kind).select(period_name(kind).alias(PERIOD), *DIMS, "n", "m", "a") for kind in PERIODS]
    leaf = fine[0].unionByName(fine[1]).repartition(PERIOD, DEST)
    merged = {"s": lambda w, _: F.coalesce(F.sum("n").over(w) * F.max("m").over(w), F.lit(0)),
              "a": lambda w, _: F.sum("dest_a").over(w)}
    leaf = leaf.withColumnRenamed("a", "dest_a").withColumn("dest_s", F.coalesce(F.col("n") * F.col("m"), F.lit(0)))
    # (period, dims) are unique, so one row of each group holds its least channel
    leaf = _windows(leaf, [("all_dest", (DEST, BU, SP))], merged | {"least": lambda w, _: F.min(SC).over(w)})

    at_one = F.col(SC).eqNullSafe(F.col("all_dest_least"))
    sums = [F.sum(f"dest_{x}").alias(f"sp_{x}") for x in "as"]
    sums += [F.sum(F.when(at_one, F.col(f"all_dest_{x}"))).alias(f"once_{x}") for x in "as"]
    points = leaf.groupBy(PERIOD, SC, BU, SP).agg(*sums).repartition(PERIOD)
    of = {"all_sp": "once", "all_bu": "once", "bu": "sp", "sc": "sp", "total": "sp"}
    points = _windows(points, [("all_sp", (BU, SP)), ("all_bu", (BU,)), ("bu", (SC, BU)), ("sc", (SC,)), ("total", ())], {
        x: lambda w, metric, x=x: F.sum(f"{of[metric]}_{x}").over(w) for x in "sa"})

    leaf = _windows(leaf, [("bu_dest", (DEST, BU)), ("only_dest", (DEST,)), ("sc_bu_dest", (DEST, SC, BU)),
                           ("sc_dest", (DEST, SC))], merged)
    wide = _same_keys(leaf, points.drop("once_a", "once_s"), [PERIOD, SC, BU, SP])
    # a NULL dimension belongs to no group that has it as a key
    value = [F.when(_present(m.dims), ratio(f"{m.name}_s", f"{m.name}_a")).alias(m.name) for m in METRICS]
    return wide.select(PERIOD, *DIMS, *value)


def _windows(df: DataFrame, families: Sequence[tuple[str, Sequence[str]]], values) -> DataFrame:
    """``df`` with ``{family}_{name}`` for each family and each of ``values``, over (period, family's dimensions).

    Families come finest first, so that those whose keys begin alike share a sort. The filter is always true (both
    sums are counts); without it Spark moves coarser windows below finer ones, where each needs a sort of its own.
    """
    for metric, dims in families:
        w = Window.partitionBy(PERIOD, *dims)
        made = {name: value(w, metric) for name, value in values.items()}
        df = df.select("*", *[c.alias(f"{metric}_{name}") for name, c in made.items() if c is not None])
        df = df.where(F.col(f"{metric}_s") >= 0)
    return df


def _present(dims: Sequence[str]) -> Column:
    return F.expr(" and ".join(f"{d} is not null" for d in dims) or "true")


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join on null-safe equal ``keys``, kept once."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    return left.join(other, F.expr(" and ".join(f"{k} <=> __{k}" for k in keys)), "left").drop(*[f"__{k}" for k in keys])


def wide_metrics(base: DataFrame, cells: DataFrame, kinds: Sequence[str] = tuple(PERIODS)) -> DataFrame:
    """``base`` (base rows of ``cells``) with the 12 variabilities of each period kind in ``kinds``.

    The lattice is read once a kind, so it is stored once.
    """
    lattice = cut_lineage(metric_lattice(cells))
    out = base
    for kind in kinds:
        named = lattice.where(F.col(PERIOD).startswith(f"{kind} ")).withColumnsRenamed(
            {m.name: f"{m.column}_{kind}_variability" for m in METRICS})
        out = _same_keys(out.withColumn(PERIOD, period_name(kind)), named, [PERIOD, *DIMS]).drop(PERIOD)
    return out


def variability_mart(day: DataFrame) -> DataFrame:
    """Wide mart rows: one per base row with all 24 variabilities.

    ``day`` are day cells with periods. Week metrics are keyed by the ISO
    week only, so a week straddling two months gives two base rows with the
    same week values; days in synthetic week 0 count for week metrics and
    base rows but not for month metrics (whose values may then be NULL).
    """
    out = wide_metrics(base_rows(day), day)
    return out.select(
        null_default(SC).alias(SC),
        null_default(BU).alias(BU),
        null_default(SP).alias(SP),
        null_default(DEST).alias("delivery_point"),
        F.col(WEEK_NO).alias("week"),
        F.col(MONTH_NO).alias("month"),
        F.col(YEAR_NO).alias("year"),
        *[F.col(c) for c in MART_COLUMNS[len(MART_KEYS):]],
    )
