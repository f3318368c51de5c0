"""Business constants of the logistics marts.

Fixed values: the codes and labels below must equal the business rules of
the marts this package rebuilds, so they are stated verbatim, together and
in their natural order. Jobs accept other mappings as arguments; these are
only the defaults.
"""

# --- fixed values -----------------------------------------------------------

# Placeholder written where a dimension of the variability mart is unknown.
NO_DATA = "NO DATA"

# Tariff matrix code -> sales channel.
MATRIX_LAST_MILE = ("03",)
MATRIX_EXPORT = ("02", "05")
MATRIX_DOMESTIC = ("01", "04")
CHANNEL_LAST_MILE = "LastMile"
CHANNEL_EXPORT = "Экспорт"
CHANNEL_DOMESTIC = "РФ"
CHANNEL_INTERNAL = "Внутренние перемещения РФ"
# Sales organisation whose domestic shipments are internal transfers.
INTERNAL_SALES_ORG = "9999"

# Sales organisations -> business unit, used when the business-unit
# reference has no name for the (sales org, shipping point) pair.
BUSINESS_UNIT_BY_SALES_ORG = (
    (("9002", "4102"), "ДСК"),
    (("9003", "4103"), "ДПиОС"),
    (("9004", "4104"), "ДБП"),
)

# Currency code -> which rate column converts it to roubles
# (None = amount is already in roubles).
CURRENCY_RATE_COLUMN = (
    ("USD", "rate_usd"),
    ("EUR", "rate_eur"),
    ("RUB", None),
)

# Shipping point code -> dashboard name (else the shipping point's own text).
SHIPMENT_POINT_DASHBOARD_NAMES = (
    ("4046", "Katoen Natie Bulk Chemicals Terminals"),
    ("9121", "Сибур Тобольск"),
    ("9131", "ЗСНХ"),
    ("41AT", "SI Austria"),
    ("41BE", "SI Belgium"),
    ("41DE", "SI Germany"),
    ("41DK", "SI Denmark"),
    ("41FI", "SI Finland"),
    ("41FR", "SI France"),
    ("41GB", "SI United Kingdom"),
    ("41LT", "SI Lithuania"),
    ("41NL", "SI Netherlands"),
    ("41PL", "SI Poland"),
    ("41RO", "SI Romania"),
    ("41SE", "SI Sweden"),
    ("41SK", "SI Slovakia"),
    ("43CN", "SI CN Shanghai"),
    ("9W57", "Сибур-Нефтехим (Дзержинск)"),
)

# Name of the only data-quality rule the key checker knows.
RULE_DUPLICATE_CHECK = "dublicate_check"

# Business key of each checked mart table or view (the load time is added
# to the key by the check: versions are legal, copies within a load are not).
MART_TABLE_KEYS = (
    ("metrics_main", ("transportation_number",)),
    ("metrics_variability", ("year", "month", "week", "sales_channel", "business_unit", "shipment_point_code",
                             "delivery_point")),
    ("business_unit_ref", ("business_unit_code", "shipping_point_code")),
    ("currency_rate_ref", ("rate_date",)),
    ("delivery_point_ref", ("delivery_point_code",)),
    ("plan_norm", ("id",)),
    ("shipment_point_ref", ("shipment_point_code",)),
    ("v_metrics_main", ("transportation_number",)),
    ("v_metrics_variability", ("year", "month", "week", "sales_channel", "business_unit", "shipment_point_code",
                               "delivery_point")),
)

# --- end of fixed values ----------------------------------------------------

# Technical columns of every versioned table.
LOAD_TS = "tech_load_ts"
IS_DELETED = "tech_is_deleted"
