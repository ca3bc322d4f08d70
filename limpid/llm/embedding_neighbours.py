"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Vectors are brought to length one.  A table hashes a vector by several quantised random projections; vectors in
one bucket of any table are candidates, compared first by a 64-bit sign sketch and then exactly.  Equal vectors
are one class.  Links are counted inside the components that the checked pairs make, in blocks by the angle to the
component's head: blocks of a tight group link as a whole without a comparison, far ones not at all, the others are
compared block by block, so that a large group of near copies is spread over many tasks and never listed pair by pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limpid.llm.linking import Joined, groups_of, link_by_buckets
from limpid.llm.tables import Scratch
from limpid.plans.ordering import with_series_position

COSINE = 0.9
#: Width of a projection's cells, for vectors of length one.
WIDTH = 2.0
#: Sketches of a pair at cosine 0.9 differ in 9 of 64 bits; beyond this is six deviations off.
MAX_DIFFERENT_BITS = 26
#: Share of pairs at the limit itself that some table catches; closer pairs are caught more often.
RECALL = 0.9
#: Vectors of a block when links are counted.
BLOCK = 1024
#: Angles this close to a bound are compared, whatever rounding did to them.
SLACK = 1e-6
#: Rows of a Python batch.
ROWS = 500


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection puts two vectors of that distance into one cell."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Projections of a table and number of tables.

    A table has so many projections that a vector meets about one unrelated one in its bucket, at any number of
    vectors, and there are so many tables that a pair at the limit is caught with the given probability.
    """
    projections = max(2, math.ceil(math.log(max(vectors, 2)) / -math.log(same_cell(math.sqrt(2)))))
    caught = same_cell(math.sqrt(2 - 2 * cosine)) ** projections
    return projections, max(1, math.ceil(math.log(1 - recall) / math.log(1 - caught)))


def _hashed(projections: int, tables: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for whole in batches:
            for begin in range(0, whole.num_rows, ROWS):
                part = whole.slice(begin, ROWS)
                vectors = part.column("unit").to_pylist()
                keys, infos = [], []
                for vector in vectors:
                    size = len(vector)
                    if size not in made:
                        draw = np.random.default_rng([seed, size])
                        made[size] = (draw.standard_normal((size, tables * projections)),
                                      draw.uniform(0, WIDTH, tables * projections),
                                      draw.integers(1, 1 << 62, (tables, projections), dtype=np.int64) * 2 + 1,
                                      draw.standard_normal((size, 64)))
                    lines, shifts, odd, signs = made[size]
                    x = np.asarray(vector)
                    cells = np.floor((x @ lines + shifts) / WIDTH).astype(np.int64).reshape(tables, projections)
                    with np.errstate(over="ignore"):
                        keys.append(((cells * odd).sum(axis=1) * np.int64(64) + size).astype(np.int64))
                    infos.append(int(np.packbits(x @ signs > 0).view(">i8")[0]))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(infos, pa.int64()),
                                                  pa.array(keys, pa.list_(pa.int64()))], names=["id", "info", "keys"])
    return run


def _counted(cosine: float):
    """Links inside each (component, low, high): rows come sorted by it and a group has at most two blocks."""
    def count(rows: list[tuple]):
        _, low, high = rows[0][:3]
        out = []
        for size in {len(r[6]) for r in rows}:
            alike = [r for r in rows if len(r[6]) == size]
            one = [r for r in alike if r[3] == low]
            two = one if low == high else [r for r in alike if r[3] == high]
            if not one or not two:
                continue
            near = np.array([r[6] for r in one]) @ np.array([r[6] for r in two]).T >= cosine
            if low == high:
                np.fill_diagonal(near, False)
            out += zip((r[4] for r in one), (near @ np.array([r[5] for r in two], dtype=np.int64)).tolist())
            if low != high:
                out += zip((r[4] for r in two), (near.T @ np.array([r[5] for r in one], dtype=np.int64)).tolist())
        return out

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[n] for f in found], pa.int64()) for n in (0, 1)], names=["id", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for rows in groups_of(batches, 3):
            found += count(rows)
            if len(found) > 5000:
                yield batch(found)
                found = []
        yield batch(found)
    return run


def _compare(cosine: float):
    """Compare blocks: (block, id, component, table, unit) of vectors in one bucket."""
    def compare(one: list[tuple], two: list[tuple], joined: Joined) -> Iterator[tuple[int, int]]:
        for size in {len(r[4]) for r in one} & {len(r[4]) for r in two}:
            left, right = ([r for r in part if len(r[4]) == size] for part in (one, two))
            for a, b in np.argwhere(np.array([r[4] for r in left]) @ np.array([r[4] for r in right]).T >= cosine).tolist():
                x, y = left[a], right[b]
                if joined.root(x[2]) != joined.root(y[2]):
                    joined.join(x[2], y[2])
                    yield x[1], y[1]
    return compare


def _up_to(blocks: DataFrame, ends: Column, limits: Column, copies: bool = False) -> DataFrame:
    """For every block, how many blocks of its component (or rows in them) have an end at or below the block's limit."""
    there = blocks.select("component", F.lit(None).cast("int").alias("block"), ends.alias("at"), F.lit(0).alias("turn"),
                          (F.col("copies") if copies else F.lit(1)).cast("long").alias("n"))
    asked = blocks.select("component", "block", limits.alias("at"), F.lit(1).alias("turn"), F.lit(0).cast("long").alias("n"))
    before = Window.partitionBy("component").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    return there.unionByName(asked).withColumn("n", F.sum("n").over(before)).where("turn = 1").select("component", "block", "n")


def _blocks_by_angle(groups: DataFrame, classes: DataFrame, cosine: float, block: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Members of the components in blocks by their angle to the component's head, and what each block is compared with.

    Two angles to the head bound the angle between two vectors: where they add up to no more than the limit, all
    rows of two blocks link, and where they are farther apart than it, none do.  Both are runs of blocks, known from one
    row per block; ``start`` to ``stop`` are the blocks in between, ``certain`` the rows of the ``sure`` blocks before.
    """
    limit = math.acos(max(-1.0, min(1.0, cosine)))
    heads = classes.select(F.col("id").alias("component"), F.col("unit").alias("head"))
    dot = F.aggregate(F.zip_with("unit", "head", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    turned = scratch.keep(groups.join(classes.select("id", "copies", "unit"), "id").join(heads, "component").select(
        "component", "id", "copies", "unit", angle.alias("angle")), "angles")
    place = with_series_position(turned, "component", ["angle", "id"], "place")
    members = scratch.keep(place.withColumn("block", F.expr(f"cast((place - 1) div {block} AS int)")).drop("place"), "component-blocks")
    blocks = scratch.keep(members.groupBy("component", "block").agg(
        F.min("angle").alias("low"), F.max("angle").alias("high"), F.sum("copies").alias("copies")), "blocks")
    low, high = F.col("low"), F.col("high")
    found = blocks.select("component", "block")
    for name, ends, limits, copies in (
            ("sure", high, F.lit(limit - SLACK) - high, False), ("certain", high, F.lit(limit - SLACK) - high, True),
            ("first", high, low - F.lit(limit + SLACK), False), ("stop", low, high + F.lit(limit + SLACK), False)):
        found = found.join(_up_to(blocks, ends, limits, copies).withColumnRenamed("n", name), ["component", "block"])
    counts = [F.col(c).cast("int").alias(c) for c in ("sure", "first", "stop")]
    found = found.select("component", "block", "certain", *counts).withColumn("start", F.greatest("sure", "first"))
    return members, scratch.keep(found, "ranges")


def near_vectors(df: DataFrame, id_column: str, vector_column: str, scratch: Scratch, cosine: float = COSINE,
                 recall: float = RECALL, seed: int = 11, different_bits: int | None = MAX_DIFFERENT_BITS,
                 block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: id, ``n_links`` (other rows linked directly), ``component_id``, ``kept``.

    Rows link when their vectors' cosine, in double precision, is at least ``cosine``; vectors that are missing,
    of length zero, of another dimension, or with a missing or non-finite component link with nothing.  Rows
    that repeat link with each other.  Rows are judged by their vectors, not by their ids: an id that stands on several
    vectors has a count and a component for each; ``component_id`` is the smallest id of the component's rows.  A row
    without an id keeps its vector out of all links.  Other columns are not read; an empty table gives no rows.
    ``different_bits=None`` compares all members of a bucket exactly, whatever their sketches.
    """
    vector = F.col("vector")
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    usable = (F.col("id").isNotNull() & vector.isNotNull()
              & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn("norm", F.when(usable, norm)).withColumn(
        "digest", F.when((F.col("norm") > 0) & (F.col("norm") < float("inf")),
                         F.sha2(F.concat_ws(",", vector.cast("array<string>")), 256)))
    rows = scratch.keep(rows, "rows")
    # a class is a vector with all its rows; its number stands for it, as ids can repeat
    classes = scratch.keep(
        rows.where("digest IS NOT NULL").groupBy("digest").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"),
            F.first("norm").alias("norm"))
        .select("digest", "least", "copies", F.transform("vector", lambda x: x / F.col("norm")).alias("unit"))
        .withColumn("id", F.monotonically_increasing_id()), "classes")
    projections, tables = plan(classes.count(), cosine, recall)
    hashed = classes.select("id", "unit").mapInArrow(_hashed(projections, tables, seed), "id long, info long, keys array<bigint>")
    hashed = scratch.keep(hashed, "hashed")
    buckets = hashed.select(F.posexplode("keys").alias("table", "key"), "id", "info").select(
        "table", F.xxhash64("table", "key").alias("bucket"), "id", "info")
    units = classes.select("id", "unit")

    def plausible(one: Column, two: Column) -> Column:
        return F.lit(True) if different_bits is None else F.bit_count(one.bitwiseXOR(two)) <= different_bits

    def verify(pairs: DataFrame) -> DataFrame:
        both = (pairs.join(units.toDF("a", "unit_a"), "a").join(units.toDF("b", "unit_b"), "b")
                .where("size(unit_a) = size(unit_b)"))
        dot = F.aggregate(F.zip_with("unit_a", "unit_b", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
        return both.where(dot >= cosine).select("a", "b")

    groups = link_by_buckets(buckets, plausible, verify, units, _compare(cosine), scratch)
    members, ranges = _blocks_by_angle(groups, classes, cosine, block, scratch)
    open_ = members.join(ranges.where("start < stop"), ["component", "block"]).withColumn(
        "other", F.explode(F.sequence("start", F.col("stop") - 1))).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "copies", "unit")
    key = ["component", "low", "high"]
    compared = open_.repartition(*key).sortWithinPartitions(*key).mapInArrow(_counted(cosine), "id long, links long")
    certain = members.join(ranges, ["component", "block"]).select(
        "id", (F.col("certain") - F.when(F.col("block") < F.col("sure"), F.col("copies")).otherwise(0)).alias("links"))
    counted = compared.unionByName(certain).groupBy("id").agg(F.sum("links").alias("links"))
    linked = classes.select("digest", "id", "least", "copies").join(groups, "id").join(counted, "id", "left")
    first = linked.groupBy("component").agg(F.min("least").alias("first"))
    placed = scratch.keep(linked.join(first, "component").select("digest", "first", "links", F.col("copies") - 1), "linked")
    # classes without a link to another one only link their own rows
    alone = classes.select("digest", "least", "copies").join(placed.select("digest"), "digest", "left_anti").select(
        "digest", "least", F.lit(0).cast("long"), F.col("copies") - 1)
    named = ("digest", "component_id", "links", "own")
    found = scratch.keep(placed.toDF(*named).unionByName(alone.toDF(*named)), "placed-classes")
    out = rows.select("id", "digest").join(found, "digest", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column),
                      (F.coalesce("links", F.lit(0)) + F.coalesce("own", F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
