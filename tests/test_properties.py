"""Operators against brute force on random small inputs (ties, NULLs, tombstones)."""

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martline.operators import variability as V
from martline.operators.changes import new_or_changed
from martline.operators.versions import latest_version

SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe_int = st.one_of(st.none(), st.integers(0, 3))
version_rows = st.lists(st.tuples(st.integers(0, 3), maybe_int, st.integers(0, 1), maybe_int), max_size=25)


def _desc_nulls_last(v):
    # sort key for "descending, NULLs last" with Python's ascending sort
    return (v is None, -(v or 0))


@SETTINGS
@given(rows=version_rows)
def test_latest_version_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, tech_is_deleted int, v int")
    got = sorted(tuple(r) for r in latest_version(df, ["k"], order=("ts",)).collect())
    want = []
    for k in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == k]
        # order: ts desc nulls last, then the remaining columns (deleted, v) desc nulls last
        best = sorted(group, key=lambda r: (_desc_nulls_last(r[1]), _desc_nulls_last(r[2]), _desc_nulls_last(r[3])))[0]
        if best[2] == 0:
            want.append(best)
    assert got == sorted(want)


cand_rows = st.lists(st.tuples(st.integers(0, 5), st.sampled_from([None, "a", "b"]), st.sampled_from([None, "a", "b"])),
                     max_size=12, unique_by=lambda r: r[0])


@SETTINGS
@given(cand=cand_rows, cur=cand_rows)
def test_new_or_changed_matches_brute_force(spark, cand, cur):
    schema = "k int, a string, b string"
    got = sorted(tuple(r) for r in new_or_changed(spark.createDataFrame(cand, schema),
                                                   spark.createDataFrame(cur, schema), ["k"]).collect())
    current = {r[0]: r for r in cur}
    want = sorted(r for r in cand if r[0] not in current or current[r[0]] != r)
    assert got == want


cells = st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", "y"]), st.integers(1, 9)), min_size=1, max_size=20)


@SETTINGS
@given(rows=cells)
def test_peak_to_mean_matches_fractions(spark, rows):
    """Leaf variability = MAX/AVG and weighted = SUM(SUM*MAX/AVG)/SUM(SUM), exact, half-up to 6 places."""
    import datetime as dt

    base = dt.date(2024, 1, 15)  # ISO week 2024-3 holds days 0..6
    data = {}
    for day, dest, q in rows:
        data[(day, dest)] = data.get((day, dest), 0) + q   # one cell per (day, dest)
    cell_rows = [(base + dt.timedelta(days=day), "sc", "bu", "sp", dest, q) for (day, dest), q in data.items()]
    df = V.with_periods(spark.createDataFrame(cell_rows, f"{V.DATE} date, {V.SC} string, {V.BU} string, "
                                                         f"{V.SP} string, {V.DEST} string, {V.DAY_QTY} bigint"))
    fine = V.fine_stats(df, "week")
    leaf = {r[V.DEST]: r.variability for r in V.metric_table(fine, "week", V.METRIC_BY_NAME["dest"]).collect()}
    sp = V.metric_table(fine, "week", V.METRIC_BY_NAME["sp"]).first().variability
    q6 = Decimal("0.000001")
    sig_sum, all_sum = Fraction(0), 0
    for dest in {d for _, d in data}:
        qs = [q for (_, d), q in data.items() if d == dest]
        mean = Fraction(sum(qs), len(qs))
        var = Fraction(max(qs)) / mean
        assert leaf[dest] == (Decimal(var.numerator) / Decimal(var.denominator)).quantize(q6, ROUND_HALF_UP)
        sig_sum += sum(qs) * var
        all_sum += sum(qs)
    w = sig_sum / all_sum
    assert sp == (Decimal(w.numerator) / Decimal(w.denominator)).quantize(q6, ROUND_HALF_UP)
