import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from martline.operators import variability as V
from martline.plans import catalog
from martline.session import cut_lineage

CELL_COLS = f"{V.DATE} date, {V.SC} string, {V.BU} string, {V.SP} string, {V.DEST} string, {V.DAY_QTY} bigint"


def _cells(spark, rows):
    return V.with_periods(spark.createDataFrame(rows, CELL_COLS))


def test_peak_to_mean_leaf(spark):
    # cells 1, 2, 5 in one ISO week: all 8, variability 5 / (8/3) = 1.875, significance 15
    rows = [(dt.date(2024, 1, 15 + i), "sc", "bu", "sp", "d", q) for i, q in enumerate((1, 2, 5))]
    fine = V.fine_stats(_cells(spark, rows), "week")
    t = V.metric_table(fine, "week", V.METRIC_BY_NAME["dest"]).first()
    assert (t.all_qty, t.significance, t.variability) == (8, 15, Decimal("1.875000"))


def test_weighted_rollup(spark):
    # two destinations in one week: (1, 3) -> n*m = 6, a = 4 ; (2) -> n*m = 2, a = 2
    d = dt.date(2024, 1, 15)
    rows = [(d, "sc", "bu", "sp", "x", 1), (d + dt.timedelta(1), "sc", "bu", "sp", "x", 3),
            (d, "sc", "bu", "sp", "y", 2)]
    fine = V.fine_stats(_cells(spark, rows), "week")
    t = V.metric_table(fine, "week", V.METRIC_BY_NAME["sp"]).first()
    assert (t.all_qty, t.significance, t.variability) == (6, 8, Decimal("1.333333"))


def test_straddling_week_and_week_zero(spark):
    # 2024-01-29 .. 2024-02-04 is ISO week 2024-5; Feb 1 is synthetic week 0 in a leap February
    rows = [(dt.date(2024, 1, 30), "sc", "bu", "sp", "d", 2), (dt.date(2024, 2, 1), "sc", "bu", "sp", "d", 4)]
    mart = V.variability_mart(_cells(spark, rows)).orderBy("month").collect()
    assert [(r.year, r.month, r.week) for r in mart] == [(2024, 1, "20245"), (2024, 2, "20245")]
    assert mart[0].delivery_point_week_variability == mart[1].delivery_point_week_variability == Decimal("1.333333")
    assert mart[0].delivery_point_month_variability == Decimal("1.000000")
    assert mart[1].delivery_point_month_variability is None  # only day of that month is in week 0


def test_week_zero_row_keeps_coarse_month_metrics(spark):
    # combination A has only a week-0 day in March; B has March days in week 1:
    # A's fine month metric is NULL, its month total still exists.
    rows = [(dt.date(2023, 3, 2), "sc", "bu", "spA", "d", 3), (dt.date(2023, 3, 5), "sc", "bu", "spB", "d", 1),
            (dt.date(2023, 3, 6), "sc", "bu", "spB", "d", 2)]
    mart = {r.shipment_point_code: r for r in V.variability_mart(_cells(spark, rows)).collect()}
    assert mart["spA"].shipment_point_month_variability is None
    assert mart["spA"].total_month_variability == mart["spB"].total_month_variability is not None


def test_exact_form_matches_literal_float_chain(spark):
    """n*m/a equals MAX/AVG (leaf) and SUM(SUM*MAX/AVG)/SUM(SUM) (weighted) to 1e-6."""
    day = catalog._day(spark, "/root/testdata/sf0.001")
    q = V.DAY_QTY
    leaf = day.groupBy(V.WEEK_NO, *V.DIMS).agg(
        F.sum(q).alias("all"), (F.max(q) / F.avg(q)).alias("var"), (F.sum(q) * F.max(q) / F.avg(q)).alias("sig"))
    lit_sp = leaf.groupBy(V.WEEK_NO, V.SC, V.BU, V.SP).agg((F.sum("sig") / F.sum("all")).alias("lit"))
    ours = V.metric_table(V.fine_stats(day, "week"), "week", V.METRIC_BY_NAME["sp"])
    j = ours.join(lit_sp, [V.WEEK_NO, V.SC, V.BU, V.SP])
    assert j.count() == ours.count() > 0
    assert j.where(F.abs(F.col("variability").cast("double") - F.col("lit")) > 1e-6).count() == 0


def test_wide_mart_agrees_with_metric_tables(spark):
    """The window-based wide rows equal joining each metric table to the base rows."""
    day = catalog._day(spark, "/root/testdata/sf0.001")
    wide = V.variability_mart(day)
    base = V.base_rows(day)
    for kind in ("week", "month"):
        fine = V.fine_stats(day, kind)
        for m in V.METRICS:
            keys = list(V.PERIODS[kind]) + list(m.dims)
            t = V.metric_table(fine, kind, m).select(*keys, F.col("variability").alias("v"))
            ref = base.join(t, keys, "left").select(
                F.col(V.WEEK_NO).alias("week"), F.col(V.MONTH_NO).alias("month"), F.col(V.YEAR_NO).alias("year"),
                V.SC, V.BU, V.SP, F.col(V.DEST).alias("delivery_point"), "v")
            col = f"{m.column}_{kind}_variability"
            got = wide.select("week", "month", "year", V.SC, V.BU, V.SP, "delivery_point", F.col(col).alias("v"))
            assert ref.exceptAll(got).count() == 0 and got.exceptAll(ref).count() == 0, col


def test_lattice_reads_each_kind_once_and_joins_once(spark):
    """Without broadcast: one scan of the cells a kind, one join, one reused exchange, and few exchanges."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        day = cut_lineage(catalog._day(spark, "/root/testdata/sf0.001"))
        lattice = V.metric_lattice(day)
        lattice.collect()
        plan = lattice._jdf.queryExecution().executedPlan().toString()
        plan = plan[: plan.index("Initial Plan")]
        count = lambda name: sum(name in line for line in plan.splitlines())
        assert count("SortMergeJoin") == 1 and count("BroadcastHashJoin") == 0
        assert count("FileScan") == 2 and count("ReusedExchange") == 1
        assert count("Exchange hashpartitioning") <= 9  # the reused one is named twice
        assert count("Sort [") <= 7  # of 11 windows and a join
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_null_dimensions_belong_to_no_group(spark):
    rows = [(dt.date(2024, 1, 15), None, "bu", "sp", "d", 3), (dt.date(2024, 1, 16), "sc", "bu", "sp", "d", 1),
            (dt.date(2024, 1, 16), "sc", "bu", None, "e", 2), (dt.date(2024, 1, 17), None, "bu", "sp", "d", 1)]
    day = _cells(spark, rows)
    wide = V.variability_mart(day)
    base = V.base_rows(day)
    for kind in ("week", "month"):
        fine = V.fine_stats(day, kind)
        for m in V.METRICS:
            keys = [*V.PERIODS[kind], *m.dims]
            ref = base.join(V.metric_table(fine, kind, m).select(*keys, F.col("variability").alias("v")), keys, "left")
            got = wide.select(F.col(f"{m.column}_{kind}_variability").alias("v"))
            assert sorted(str(r.v) for r in ref.collect()) == sorted(str(r.v) for r in got.collect()), (m.name, kind)
