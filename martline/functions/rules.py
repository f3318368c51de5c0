"""Business-rule column functions (labels, categories, defaults, currency).

Every function returns a ``Column`` built from JVM-side expressions, so the
rules stay inside whole-stage codegen wherever they are used. Each rule is
defined once here and reused by the marts and by change detection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ._util import as_col


def sales_channel(matrix_code, sales_org, otherwise: str | None = None) -> Column:
    """Tariff matrix code -> sales channel.

    Domestic matrix codes split on the sales organisation: the internal one
    means an internal transfer, any other value (NULL included) a domestic
    sale. Unknown or NULL matrix codes give ``otherwise``.
    """
    m, org = as_col(matrix_code), as_col(sales_org)
    domestic = F.when(org == K.INTERNAL_SALES_ORG, F.lit(K.CHANNEL_INTERNAL)).otherwise(
        F.lit(K.CHANNEL_DOMESTIC)
    )
    return (
        F.when(m.isin(*K.MATRIX_LAST_MILE), F.lit(K.CHANNEL_LAST_MILE))
        .when(m.isin(*K.MATRIX_EXPORT), F.lit(K.CHANNEL_EXPORT))
        .when(m.isin(*K.MATRIX_DOMESTIC), domestic)
        .otherwise(F.lit(otherwise).cast("string"))
    )


def business_unit(
    reference_name,
    sales_org,
    otherwise: str | None = None,
    fallback=K.BUSINESS_UNIT_BY_SALES_ORG,
) -> Column:
    """Reference name if present, else a label by sales organisation, else ``otherwise``."""
    org = as_col(sales_org)
    by_org = None
    for codes, label in fallback:
        cond = org.isin(*codes)
        by_org = F.when(cond, F.lit(label)) if by_org is None else by_org.when(cond, F.lit(label))
    by_org = by_org.otherwise(F.lit(otherwise).cast("string"))
    return F.coalesce(as_col(reference_name), by_org)


def blank_default(c, default: str = K.NO_DATA) -> Column:
    """``''`` or NULL -> ``default``; other values unchanged."""
    c = as_col(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(default)).otherwise(c)


def null_default(c, default: str = K.NO_DATA) -> Column:
    """NULL -> ``default`` (``NVL``)."""
    return F.coalesce(as_col(c), F.lit(default))


def to_roubles(amount, currency, rate_usd, rate_eur) -> Column:
    """Convert ``amount`` in ``currency`` to roubles with the day's rates.

    USD and EUR are multiplied by their rate (a missing rate gives NULL),
    roubles pass through, any other currency gives NULL.
    """
    amount, currency = as_col(amount), as_col(currency)
    rates = {"rate_usd": as_col(rate_usd), "rate_eur": as_col(rate_eur)}
    out = None
    for code, rate_name in K.CURRENCY_RATE_COLUMN:
        value = amount if rate_name is None else amount * rates[rate_name]
        cond = currency == F.lit(code)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out


def code_label(code, mapping: Mapping[str, str] | Iterable[tuple[str, str]], default=None) -> Column:
    """Look ``code`` up in a small fixed mapping; else ``default`` (a column).

    The mapping becomes one literal map expression, so the lookup is a
    projection: no join and no shuffle.
    """
    pairs = list(mapping.items()) if isinstance(mapping, Mapping) else list(mapping)
    lookup = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    found = F.try_element_at(lookup, as_col(code))
    return found if default is None else F.coalesce(found, as_col(default))


def label_from_table(
    df: DataFrame,
    code: str,
    mapping: DataFrame,
    map_code: str,
    map_label: str,
    out: str,
    default: str | None = None,
) -> DataFrame:
    """Add column ``out`` = label of ``df[code]`` from a mapping table.

    The mapping is deduplicated on its code (one label per code) and joined
    with a left join; the planner and AQE choose how.
    """
    m = (
        mapping.select(F.col(map_code).alias("__code"), F.col(map_label).alias("__label"))
        .groupBy("__code")
        .agg(F.min("__label").alias("__label"))
    )
    joined = df.join(m, df[code] == m["__code"], "left")
    label = F.col("__label") if default is None else F.coalesce(F.col("__label"), F.col(default))
    return joined.withColumn(out, label).drop("__code", "__label")


def leg_code(start, end, suffix: str = "Auto") -> Column:
    """Composite text key ``start_end_suffix``; NULL if any part is NULL.

    Never shortened: the code is a join key, and two long codes must not match by a prefix.
    """
    return F.concat(as_col(start), F.lit("_"), as_col(end), F.lit("_" + suffix))


def to_bigint(c, lenient: bool = False) -> Column:
    """Digits text -> BIGINT (leading zeros dropped).

    Malformed text raises under ANSI mode; ``lenient`` gives NULL instead.
    """
    c = as_col(c)
    return c.try_cast("bigint") if lenient else c.cast("bigint")
