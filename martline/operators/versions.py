"""Latest-version resolution of append-only history.

A versioned table keeps every load of a business key; the newest load wins
and, if that newest load is a tombstone, the key is gone. This is one
``row_number()`` window per key. Spark plans it as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so every
map task ships at most one row per key: a key holding a third of all rows
costs one row per map partition in the exchange, not a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import IS_DELETED, LOAD_TS

_RN = "__version_rank"


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = (LOAD_TS,),
    deleted_col: str | None = IS_DELETED,
    live_value=0,
    pre: Column | str | None = None,
    post: Column | str | None = None,
    tiebreak: bool = True,
) -> DataFrame:
    """Keep the newest row per ``keys``.

    * ``order``: column names (sorted descending, NULLs last) or explicit
      sort Columns; the first row wins.
    * ``pre``: filter applied *before* ranking (pushed to the scan).
    * ``deleted_col``: tombstone test applied *after* ranking, as
      ``deleted_col = live_value``. A deleted newest version removes the key;
      an older live version never resurfaces. ``None`` disables it.
    * ``post``: any further filter after ranking (e.g. a state flag).
    * ``tiebreak``: rows tied on ``order`` are ranked by all remaining
      columns (descending, NULLs last) so the winner is repeatable. Project
      ``df`` to the needed columns first: columns in the window sort cannot
      be pruned from the scan.
    """
    if pre is not None:
        df = df.where(pre)
    sort_cols: list[Column] = []
    used = set(keys)
    for c in order:
        if isinstance(c, str):
            sort_cols.append(F.col(c).desc_nulls_last())
            used.add(c)
        else:
            sort_cols.append(c)
    if tiebreak:
        sort_cols += [F.col(c).desc_nulls_last() for c in df.columns if c not in used]
    # Partitioned by exactly the business key: the result stays
    # hash-partitioned on it, so a following join on the same key (delivery
    # by delivery number, rate by date, ...) reuses the partitioning instead
    # of shuffling the resolved table again.
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*sort_cols)
    keep = F.col(_RN) == 1
    if deleted_col is not None:
        keep = keep & (F.col(deleted_col) == F.lit(live_value))
    if post is not None:
        keep = keep & (F.expr(post) if isinstance(post, str) else post)
    return df.select("*", F.row_number().over(w).alias(_RN)).where(keep).drop(_RN)


def current_state(df: DataFrame, keys: Sequence[str], load_ts: str = LOAD_TS) -> DataFrame:
    """Current rows of a self-versioned mart (newest ``load_ts`` per key)."""
    return latest_version(df, keys, order=(load_ts,), deleted_col=None)
