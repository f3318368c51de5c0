"""First-item join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_item_join(
    header: DataFrame,
    items: DataFrame,
    on: Sequence[tuple[str, str]],
    item_no: str,
    first=1,
) -> DataFrame:
    """Left-join each header to its item number ``first``.

    The constant condition restricts the item side only: headers without
    that item are kept with NULL item columns.
    """
    right = items.where(F.col(item_no) == F.lit(first))
    cond = [header[a] == right[b] for a, b in on]
    return header.join(right, cond, "left")
