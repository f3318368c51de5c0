"""New-or-changed rows of an append-only, self-versioned mart.

A candidate row is appended when its key has no current version in the
target, or when any compared value differs from the current version. The
comparison is a null-safe struct equality, not a hash: hashes collide when a
value moves between two nullable columns and differ between ``int 1`` and
``bigint 1``; ``struct(..) <=> struct(..)`` gets both right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CUR = "__cur_"
_HIT = "__cur_matched"


def new_or_changed(
    candidates: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``candidates`` that are new or changed versus ``current``.

    ``current`` holds one row per key (see ``versions.current_state``) with
    the same column names as ``candidates``. Compared columns are cast to the
    candidate types first so a narrower target type cannot make an unchanged
    row look changed. The join is a left join on ``keys`` only; the value
    test is a filter on the joined row.
    """
    cols = list(compare) if compare is not None else list(candidates.columns)
    types = {f.name: f.dataType for f in candidates.schema.fields}
    wanted = list(dict.fromkeys(list(keys) + cols))
    cur = current.select(
        *[F.col(c).cast(types[c]).alias(_CUR + c) for c in wanted],
        F.lit(True).alias(_HIT),
    )
    cond = [candidates[k] == cur[_CUR + k] for k in keys]
    joined = candidates.join(cur, cond, "left")
    same = F.struct(*[F.col(c) for c in cols]).eqNullSafe(
        F.struct(*[F.col(_CUR + c).alias(c) for c in cols])
    )
    keep = F.col(_HIT).isNull() | ~same
    return joined.where(keep).select(*[candidates[c] for c in candidates.columns])
