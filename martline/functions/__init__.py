from .periods import (  # noqa: F401
    calendar_day,
    calendar_month,
    calendar_year,
    iso_week_key,
    synthetic_week,
)
from .rules import (  # noqa: F401
    blank_default,
    business_unit,
    code_label,
    label_from_table,
    leg_code,
    null_default,
    sales_channel,
    to_bigint,
    to_roubles,
)
