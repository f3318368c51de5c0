"""martline: build and check versioned logistics data marts on Spark.

Operators are DataFrame -> DataFrame functions; jobs compose them.
"""

from .operators.changes import new_or_changed  # noqa: F401
from .operators.enrich import child_total, distinct_legs, route_lead_time  # noqa: F401
from .operators.joins import first_item_join  # noqa: F401
from .operators.quality import (  # noqa: F401
    CheckedTable,
    duplicate_key_groups,
    file_duplicates,
    key_check_report,
    registry_resolver,
)
from .operators.variability import metric_table, variability_mart, wide_metrics  # noqa: F401
from .operators.versions import current_state, latest_version  # noqa: F401
from .plans.jobs import (  # noqa: F401
    load_shipment_mart,
    load_variability_mart,
    rebuild_shipment_points,
    run_file_checks,
    run_key_checks,
)
from .session import checkpoint_dir, cut_lineage, get_spark  # noqa: F401
from .sources.sinks import read_current  # noqa: F401
