"""Equi-joins where missing keys match and hot keys can always be split.

Adaptive execution splits a skewed partition on either side of an inner join,
but only on the kept side of a left or right join and not at all for a full
join.  When the side that cannot be split turns out to hold a hot key, the
outer join is written as *inner join plus unmatched rows*: every part of that
can be split, and unmatched rows are found against the distinct keys of the
other side, where no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.functions.columns import col, present
from limpid.plans.fitting import planned
from limpid.plans.sizing import GB, plan_bytes

#: A side below this estimate cannot hold a partition worth splitting.
SKEW_CHECK_BYTES = 4 * GB
SKEW_SAMPLE_ROWS = 1_000_000
HOT_SHARE = 0.002


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


@planned
def has_hot_key(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> bool:
    """Whether one key holds more than ``share`` of the rows, judged on a bounded sample."""
    slim = df.select(*[present(df, k).alias(f"k{i}") for i, k in enumerate(keys)])
    rows = slim.count()
    if rows == 0:
        return False
    part = slim if rows <= SKEW_SAMPLE_ROWS else slim.sample(SKEW_SAMPLE_ROWS / rows, seed=23)
    most = part.groupBy(*slim.columns).count().agg(F.max("count"), F.sum("count")).first()
    return bool(most[1]) and most[0] > 1 and most[0] > share * most[1]


def _may_be_skewed(df: DataFrame, keys: Sequence[str]) -> bool:
    size = plan_bytes(df)
    return (size is None or size > SKEW_CHECK_BYTES) and has_hot_key(df, keys)


def _sides_to_check(how: str) -> tuple[bool, bool]:
    return how in ("right", "outer"), how in ("left", "outer")


def equi_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    output: Sequence[tuple[str, str, str]],
    *,
    split_outer: bool | None = None,
) -> DataFrame:
    """Join on ``keys``; ``output`` lists ``(side, source column, result name)``.

    ``side`` is ``"key"`` (taken from whichever side has the row), ``"left"`` or
    ``"right"``.  ``split_outer`` forces or forbids the split form; by default
    the sizes and a key sample decide.
    """
    check_left, check_right = _sides_to_check(how)
    if split_outer is None:
        split_outer = (check_left and _may_be_skewed(left, keys)) or (
            check_right and _may_be_skewed(right, keys))

    if not (split_outer and how != "inner"):
        return _joined(left, right, keys, how, output)

    out = _joined(left, right, keys, "inner", output)
    if how in ("left", "outer"):
        out = out.unionByName(_unmatched(left, right, keys, output, "left"))
    if how in ("right", "outer"):
        out = out.unionByName(_unmatched(right, left, keys, output, "right"))
    return out


def _tagged(df: DataFrame, tag: str, keys: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Rename to positional names so that both sides can share column names."""
    names = {n: f"{tag}{i}" for i, n in enumerate(df.columns)}
    return df.select(*[(present(df, n) if n in keys else col(n)).alias(names[n]) for n in df.columns]), names


def _joined(left, right, keys, how, output) -> DataFrame:
    l, ln = _tagged(left, "__l", keys)
    r, rn = _tagged(right, "__r", keys)
    condition = same_key([F.col(ln[k]) for k in keys], [F.col(rn[k]) for k in keys])
    joined = l.join(r, condition, how)
    columns = []
    for side, source, name in output:
        if side == "key":
            if how == "right":
                value = F.col(rn[source])
            elif how == "outer":
                value = F.coalesce(F.col(ln[source]), F.col(rn[source]))
            else:
                value = F.col(ln[source])
        else:
            value = F.col((ln if side == "left" else rn)[source])
        columns.append(value.alias(name))
    return joined.select(*columns)


def _unmatched(kept, other, keys, output, side) -> DataFrame:
    k, kn = _tagged(kept, "__k", keys)
    seen = other.select(*[present(other, n).alias(f"__s{i}") for i, n in enumerate(keys)]).distinct()
    condition = same_key([F.col(kn[n]) for n in keys], [F.col(c) for c in seen.columns])
    alone = k.join(seen, condition, "left_anti")
    columns = []
    for where, source, name in output:
        if where in ("key", side):
            columns.append(F.col(kn[source]).alias(name))
        else:
            columns.append(F.lit(None).cast(other.schema[source].dataType).alias(name))
    return alone.select(*columns)
