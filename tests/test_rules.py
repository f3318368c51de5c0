from decimal import Decimal


from martline import constants as K
from martline.functions import rules as R


def test_sales_channel(spark):
    rows = [("03", None), ("02", "1"), ("05", "1"), ("01", "9999"), ("04", "1"), ("01", None), ("07", "1"),
            (None, "1")]
    df = spark.createDataFrame(rows, "m string, org string")
    got = [r.c for r in df.select(R.sales_channel("m", "org").alias("c")).collect()]
    assert got == [K.CHANNEL_LAST_MILE, K.CHANNEL_EXPORT, K.CHANNEL_EXPORT, K.CHANNEL_INTERNAL, K.CHANNEL_DOMESTIC,
                   K.CHANNEL_DOMESTIC, None, None]
    nd = [r.c for r in df.select(R.sales_channel("m", "org", otherwise=K.NO_DATA).alias("c")).collect()]
    assert nd[-2:] == [K.NO_DATA, K.NO_DATA]


def test_business_unit_fallback_chain(spark):
    df = spark.createDataFrame([("Named", "9002"), (None, "4103"), (None, "9004"), (None, "1234"), (None, None)],
                               "name string, org string")
    got = [r.b for r in df.select(R.business_unit("name", "org").alias("b")).collect()]
    labels = dict((codes[0], label) for codes, label in K.BUSINESS_UNIT_BY_SALES_ORG)
    assert got == ["Named", labels["9003"], labels["9004"], None, None]
    nd = [r.b for r in df.select(R.business_unit("name", "org", otherwise=K.NO_DATA).alias("b")).collect()]
    assert nd[-2:] == [K.NO_DATA, K.NO_DATA]


def test_blank_and_null_default(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "c string")
    assert [r.v for r in df.select(R.blank_default("c").alias("v")).collect()] == [K.NO_DATA, K.NO_DATA, "x"]
    assert [r.v for r in df.select(R.null_default("c").alias("v")).collect()] == ["", K.NO_DATA, "x"]


def test_to_roubles(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), "USD", Decimal("90.5"), Decimal("100")),
         (Decimal("10.00"), "EUR", Decimal("90.5"), Decimal("100")),
         (Decimal("10.00"), "RUB", None, None),
         (Decimal("10.00"), "USD", None, None),     # no rate that day
         (Decimal("10.00"), "CNY", Decimal("1"), Decimal("1"))],  # unknown currency
        "amt decimal(18,2), ccy string, usd decimal(18,6), eur decimal(18,6)")
    got = [r.v for r in df.select(R.to_roubles("amt", "ccy", "usd", "eur").cast("decimal(18,2)").alias("v")).collect()]
    assert got == [Decimal("905.00"), Decimal("1000.00"), Decimal("10.00"), None, None]


def test_leg_code_and_casts(spark):
    df = spark.createDataFrame([("A", "B", "0012345678"), (None, "B", "12")], "a string, b string, t string")
    got = df.select(R.leg_code("a", "b").alias("c"), R.to_bigint("t").alias("n")).collect()
    assert [(r.c, r.n) for r in got] == [("A_B_Auto", 12345678), (None, 12)]
    long = spark.createDataFrame([("x" * 300, "y")], "a string, b string")
    assert len(long.select(R.leg_code("a", "b").alias("c")).first().c) == 307
    bad = spark.createDataFrame([("12a",)], "t string")
    assert bad.select(R.to_bigint("t", lenient=True).alias("n")).first().n is None


def test_code_label_literal_map(spark):
    df = spark.createDataFrame([("4046", "t1"), ("XXXX", "t2"), (None, "t3")], "code string, txt string")
    got = [r.v for r in df.select(R.code_label("code", K.SHIPMENT_POINT_DASHBOARD_NAMES, "txt").alias("v")).collect()]
    assert got == [dict(K.SHIPMENT_POINT_DASHBOARD_NAMES)["4046"], "t2", "t3"]


def test_label_from_table_dedupes_mapping(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "code int, name string")
    m = spark.createDataFrame([(1, "L1"), (1, "L1b"), (2, "L2")], "k int, label string")
    out = R.label_from_table(df, "code", m, "k", "label", "lab", default="name")
    assert sorted((r.code, r.lab) for r in out.collect()) == [(1, "L1"), (2, "L2"), (3, "c")]
