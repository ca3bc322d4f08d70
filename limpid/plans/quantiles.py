"""Exact quantiles that never gather a column in one place.

``percentile`` keeps one entry per distinct value in a single task, which large
columns do not survive.  Here the answer is closed in on instead:

1. mergeable KLL sketches, built per group of input tasks and then merged, give
   for every wanted rank an interval that should contain it;
2. while what is known to hold the rank has too many values, one aggregation
   counts exactly how many lie below and inside and sketches the inside again; an
   interval that misses its rank cuts off what it covers, and after a few misses
   the range is halved, so the rounds end whatever the sketches say;
3. the distinct values of the remaining interval are counted and the rank is
   read off.  A miss is widened to the outer interval, whose size is known.

Inputs of a few megabytes skip all that.  Only counts decide, so the answer is exact whatever the sketches say, and a
value that fills a third of the table collapses its interval at once.  No step
shuffles the column itself: every scan reads only the wanted columns and is
combined inside the map tasks.  Up to 2 * 10**6 rows it takes two jobs, beyond
that one more for each factor of some hundred.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from limpid.plans.fitting import fitted
from limpid.plans.sizing import MB, is_small

SKETCH_K = 2048
SKETCH_ERROR = 0.0015
GRID = 2000
SKETCH_GROUPS = 256
#: An interval with at most so many rows or (by a sketch) distinct values is resolved by counting them.
COUNTABLE_VALUES = 2_000_000
#: After so many intervals that missed their ranks the sketches are no longer trusted and the range is halved.
MAX_MISSES = 3
#: Columns up to this estimate hold few enough distinct values for one task.
SMALL_COLUMN_BYTES = 4 * MB


@dataclass
class _Bracket:
    """Interval [low, high] sought to contain the ranks around one quantile.

    It lies within the outer interval, which is known to contain them, to hold
    exactly ``inside`` values and to have exactly ``below`` values below it.
    """

    column: str
    position: float
    low: float
    high: float
    outer_low: float
    outer_high: float
    inside: int
    below: int = 0
    distinct: int | None = None
    misses: int = 0
    halvings: int = 0
    answer: tuple[float, float] | None = None

    @property
    def first_rank(self) -> int:
        return math.floor(self.position)

    @property
    def last_rank(self) -> int:
        return math.ceil(self.position)

    def countable(self, limit: int) -> bool:
        few = self.distinct is not None and self.distinct <= limit
        return few or self.inside <= limit or self.answer is not None

    def narrow(self, low: float, high: float, below: int, inside: int) -> None:
        """Make [low, high] the outer interval, and seek in all of it."""
        self.outer_low, self.outer_high, self.below, self.inside, self.distinct = low, high, below, inside, None
        self.low, self.high = low, high

    def halve(self) -> None:
        """Seek in the lower half: of the range and of the doubles in it by turns, so at most 128 rounds are left."""
        low, high = self.outer_low, self.outer_high
        middle = low / 2 + high / 2
        if self.halvings % 2 or not math.isfinite(middle):
            middle = _double_at((_place(low) + _place(high)) // 2)
        self.halvings += 1
        self.low, self.high = low, min(max(middle, low), math.nextafter(high, -math.inf))


def _place(value: float) -> int:
    """The place of a double in the order of all doubles."""
    bits = struct.unpack("<q", struct.pack("<d", value))[0]
    return bits if bits >= 0 else -(bits & 0x7FFF_FFFF_FFFF_FFFF)


def _double_at(place: int) -> float:
    size = struct.unpack("<d", struct.pack("<q", abs(place)))[0]
    return size if place >= 0 else -size


@fitted
def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probabilities: Sequence[float],
    *,
    countable: int | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, ``{name: [one per probability]}``.

    ``values`` maps result names to double columns of ``df``; NULL and NaN are
    ignored and a column without values gives ``None``.  Inputs of a few megabytes
    use ``percentile`` in one job unless ``countable`` asks for the intervals.
    """
    if not values:
        return {}
    slots = {f"v{i}": name for i, name in enumerate(values)}
    doubles = {s: values[n].cast("double") for s, n in slots.items()}
    narrow = df.select(*[F.when(~F.isnan(c), c).alias(s) for s, c in doubles.items()])
    if countable is None and is_small(narrow, SMALL_COLUMN_BYTES):
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        row = narrow.agg(*[F.percentile(s, wanted).alias(s) for s in slots]).first()
        return {n: list(row[s]) if row[s] is not None else [None] * len(probabilities) for s, n in slots.items()}
    found = _by_brackets(narrow, list(slots), probabilities, countable or COUNTABLE_VALUES)
    return {n: found[s] for s, n in slots.items()}


def _grid(sketch: str, size: Column) -> Column:
    """The sketch's quantiles at GRID + 1 evenly spaced shares (a bounded array)."""
    # one text literal is far cheaper to plan than thousands of number literals
    shares = F.split(F.lit(",".join(str(i / GRID) for i in range(GRID + 1))), ",").cast("array<double>")
    return F.when(size > 0, F.kll_sketch_get_quantile_double(F.col(sketch), shares))


def _edges(grid: Sequence[float], share: float) -> tuple[float, float]:
    """Grid values that should enclose the given share in spite of the sketch error."""
    low = max(0, math.floor((share - SKETCH_ERROR) * GRID))
    high = min(GRID, math.ceil((share + SKETCH_ERROR) * GRID))
    return grid[low], grid[high]


def _in_groups(narrow: DataFrame) -> GroupedData:
    """Rows grouped by input task modulo SKETCH_GROUPS: the first level of a two-level merge.

    The grouping only decides which sketches are merged first, so it need not be
    the same when a task is run again.
    """
    return narrow.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group"))


def _by_brackets(narrow, slots, probabilities, countable):
    partial, final = [], []
    for s in slots:
        partial += [
            F.count(s).alias(f"n_{s}"), F.min(s).alias(f"lo_{s}"), F.max(s).alias(f"hi_{s}"),
            F.kll_sketch_agg_double(F.col(s), F.lit(SKETCH_K)).alias(f"k_{s}"),
        ]
        final += [
            F.sum(f"n_{s}").alias(f"n_{s}"), F.min(f"lo_{s}").alias(f"lo_{s}"),
            F.max(f"hi_{s}").alias(f"hi_{s}"), F.kll_merge_agg_double(f"k_{s}").alias(f"k_{s}"),
        ]
    merged = _in_groups(narrow).agg(*partial).agg(*final)
    picks = []
    for s in slots:
        picks += [F.col(f"n_{s}"), F.col(f"lo_{s}"), F.col(f"hi_{s}"),
                  _grid(f"k_{s}", F.col(f"n_{s}")).alias(f"g_{s}")]
    first = merged.select(*picks).first()

    brackets: dict[tuple[str, int], _Bracket] = {}
    for s in slots:
        size = first[f"n_{s}"] or 0
        for i, p in enumerate(probabilities if size else []):
            low, high = _edges(first[f"g_{s}"], p)
            brackets[s, i] = _Bracket(
                s, p * (size - 1), low, high, first[f"lo_{s}"], first[f"hi_{s}"], inside=size)

    while large := [b for b in brackets.values() if not b.countable(countable)]:
        _measure(narrow, large)

    # what is left to count lies within outer intervals of a known size, so a miss can be widened to them
    while todo := [b for b in brackets.values() if b.answer is None]:
        for b, pair in zip(todo, _read_ranks(narrow, todo)):
            if pair is None:
                b.low, b.high = b.outer_low, b.outer_high
            b.answer = pair

    result: dict[str, list[float | None]] = {s: [None] * len(probabilities) for s in slots}
    for (s, i), b in brackets.items():
        left, right = b.answer
        result[s][i] = left if left == right else (
            (b.last_rank - b.position) * left + (b.position - b.first_rank) * right)
    return result


def _measure(narrow: DataFrame, brackets: list[_Bracket]) -> None:
    """Count below and inside each interval, then go on in the part of the outer one that holds the ranks.

    A miss is as exact as a hit: the counts tell on which side the ranks are, and the
    values next to the interval's ends are the answer if one rank is on either side.
    """
    partial, final = [], []
    for t, b in enumerate(brackets):
        v = F.col(b.column)
        inside = F.when(v.between(b.low, b.high), v)
        partial += [
            F.count_if(v < b.low).alias(f"below_{t}"), F.count(inside).alias(f"in_{t}"),
            F.hll_sketch_agg(F.when(inside.isNotNull(), F.xxhash64(v))).alias(f"d_{t}"),
            F.kll_sketch_agg_double(inside, F.lit(SKETCH_K)).alias(f"k_{t}"),
            *[f(F.when(c, v)).alias(f"{n}_{t}") for n, (f, c) in _ends(v, b).items()],
        ]
        final += [
            F.sum(f"below_{t}").alias(f"below_{t}"), F.sum(f"in_{t}").alias(f"in_{t}"),
            F.hll_sketch_estimate(F.hll_union_agg(f"d_{t}")).alias(f"d_{t}"),
            F.kll_merge_agg_double(f"k_{t}").alias(f"k_{t}"),
            *[f(f"{n}_{t}").alias(f"{n}_{t}") for n, (f, _) in _ends(v, b).items()],
        ]
    merged = _in_groups(narrow).agg(*partial).agg(*final)
    picks = []
    for t, b in enumerate(brackets):
        size = F.col(f"in_{t}")
        picks += [F.col(f"below_{t}"), size, F.col(f"d_{t}"), _grid(f"k_{t}", size).alias(f"g_{t}"),
                  *[F.col(f"{n}_{t}") for n in _ends(size, b)]]
    row = merged.select(*picks).first()

    for t, b in enumerate(brackets):
        below, inside = row[f"below_{t}"], row[f"in_{t}"]
        through, end = below + inside, b.below + b.inside
        if b.first_rank < below <= b.last_rank:
            b.answer = row[f"under_{t}"], row[f"from_{t}"]
        elif b.first_rank < through <= b.last_rank:
            b.answer = row[f"upto_{t}"], row[f"over_{t}"]
        elif b.last_rank < below:
            b.misses += 1
            b.narrow(b.outer_low, math.nextafter(b.low, -math.inf), b.below, below - b.below)
        elif b.first_rank >= through:
            b.misses += 1
            b.narrow(math.nextafter(b.high, math.inf), b.outer_high, through, end - through)
        else:
            b.narrow(b.low, b.high, below, inside)
            b.distinct = 1 if b.low == b.high else int(row[f"d_{t}"] * 1.1) + 1
            if b.misses < MAX_MISSES:
                b.low, b.high = _edges(row[f"g_{t}"], (b.position - below) / max(inside - 1, 1))
        if b.misses >= MAX_MISSES and b.outer_low < b.outer_high:
            b.halve()


def _ends(v: Column, b: _Bracket) -> dict[str, tuple]:
    """The values on both sides of each end of an interval."""
    return {"under": (F.max, v < b.low), "from": (F.min, v >= b.low),
            "upto": (F.max, v <= b.high), "over": (F.min, v > b.high)}


def _read_ranks(narrow: DataFrame, brackets: list[_Bracket]) -> list[tuple[float, float] | None]:
    """Values at the first and last rank of each interval, ``None`` where it misses them.

    The distinct values strictly inside are counted by a group-by: the columns are
    stacked and meet the few intervals of theirs in a broadcast join, so that a
    value is computed once however many comparisons it goes through (a filter would
    be pushed down and repeat the caller's expression in each).  Its edges,
    where a value shared by many rows usually ends up, and the stretch between
    the outer edge and the interval (under NULL, which sorts first) are plain
    conditional counts.
    """
    intervals = narrow.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(b.column).alias("slot"), F.lit(b.low).alias("low"), F.lit(b.high).alias("high"))
        for t, b in enumerate(brackets)])))
    stacked = narrow.unpivot([], sorted({b.column for b in brackets}), "slot", "v")
    # a row per wanted quantile
    near = stacked.join(F.broadcast(intervals), "slot").where((F.col("v") > F.col("low")) & (F.col("v") < F.col("high")))
    counted = near.groupBy("t", "v").agg(F.count("*").alias("n"))

    counts, entries = [], []
    for t, b in enumerate(brackets):
        v = F.col(b.column)
        parts = [(None, (v >= b.outer_low) & (v < b.low)), (b.low, v == b.low)]
        if b.high != b.low:
            parts.append((b.high, v == b.high))
        for value, condition in parts:
            name = f"n{len(counts)}"
            counts.append(F.count_if(condition).alias(name))
            entries.append(F.struct(F.lit(t).alias("t"), F.lit(value).cast("double").alias("v"), F.col(name).alias("n")))
    edges = narrow.agg(*counts).select(F.inline(F.array(*entries))).where("n > 0")
    counted = counted.unionByName(edges)
    running = Window.partitionBy("t").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ends = counted.withColumn("upto", F.sum("n").over(running))
    spots = F.array(*[
        F.struct(F.lit(b.first_rank - b.below).cast("long").alias("first"),
                 F.lit(b.last_rank - b.below).cast("long").alias("last")) for b in brackets])
    spot = F.get(spots, F.col("t"))
    picked = ends.groupBy("t").agg(
        F.coalesce(F.max(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("skipped"),
        F.max("upto").alias("through"),
        F.min(F.when(F.col("upto") > spot["first"], F.col("v"))).alias("first"),
        F.min(F.when(F.col("upto") > spot["last"], F.col("v"))).alias("last"))
    by_t = {r["t"]: r for r in picked.collect()}
    answers = []
    for t, b in enumerate(brackets):
        r = by_t.get(t)
        holds = r is not None and r["skipped"] <= b.first_rank - b.below and r["through"] > b.last_rank - b.below
        answers.append((r["first"], r["last"]) if holds else None)
    return answers
