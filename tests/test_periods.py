import calendar
import datetime as dt


from martline.functions import periods as P


def _one(spark, d, col):
    return spark.createDataFrame([(d,)], "d date").select(col.alias("v")).first().v


def test_iso_week_key_not_padded(spark):
    for d, want in ((dt.date(2021, 1, 1), "202053"), (dt.date(2021, 1, 4), "20211"), (dt.date(2024, 12, 30), "20251")):
        assert _one(spark, d, P.iso_week_key("d")) == want


def test_synthetic_week_edges(spark):
    cases = [((2023, 1, 3), 0), ((2023, 1, 4), 1), ((2023, 4, 2), 0), ((2023, 4, 3), 1),
             ((2024, 2, 1), 0), ((2024, 2, 2), 1), ((2023, 2, 1), 1), ((2023, 1, 31), 4)]
    for (y, m, d), want in cases:
        assert _one(spark, dt.date(y, m, d), P.synthetic_week("d")) == want


def _week_by_table(d: dt.date) -> int:
    """Independent statement of the rule: the last 28 days of the month are
    weeks 1..4 of seven days; the days before them are week 0."""
    length = calendar.monthrange(d.year, d.month)[1]
    first = length - 28 + 1
    return 0 if d.day < first else (d.day - first) // 7 + 1


def test_synthetic_week_closed_form_all_days(spark):
    start, end = dt.date(1896, 1, 1), dt.date(2104, 12, 31)
    days = spark.sql(f"SELECT explode(sequence(DATE'{start}', DATE'{end}', INTERVAL 1 DAY)) AS d")
    got = {r.d: r.w for r in days.select("d", P.synthetic_week("d").alias("w")).collect()}
    assert len(got) == (end - start).days + 1
    bad = [d for d, w in got.items() if w != _week_by_table(d)]
    assert not bad, bad[:5]


def test_null_date_gives_null(spark):
    df = spark.createDataFrame([(None,)], "d date")
    row = df.select(P.synthetic_week("d").alias("w"), P.iso_week_key("d").alias("k")).first()
    assert row.w is None and row.k is None
