"""Connected groups from shared buckets: candidate pairs, exact checks, components.

In a bucket every member is checked against the smallest one first.  What that links becomes one component, so
a bucket of copies costs one check per member.  Afterwards the members of buckets with several components are
compared in blocks: a task gets two blocks of a bucket, whatever the bucket's size, compares members of different
components and gives back the links that join components.  No pair that shares a bucket is left both uncompared and
unconnected, and no pairs are listed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.tables import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``id`` and ``component`` (its smallest id) of all ids in the edges (``a`` < ``b``, no nulls).

    Rounds of small and large stars: each id's links move to the smallest id linked to it, then to that id's own.
    Tables of a round are written, so a lost executor costs one step; rounds grow with the log of the longest chain.
    """
    now = scratch.keep(edges.select(F.col("b").alias("c"), F.col("a").alias("p")).distinct(), f"{name}-0")
    turn, last = 0, None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("c", "p").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last, turn = state, turn + 1
        least = scratch.keep(now.groupBy("c").agg(F.min("p").alias("m")), f"{name}-least-{turn}")
        others = now.join(least, "c").where("p <> m").select(F.col("p").alias("c"), F.col("m").alias("p"))
        small = scratch.keep(least.select("c", F.col("m").alias("p")).unionByName(others).distinct(), f"{name}-small-{turn}")
        top = scratch.keep(small.groupBy("c").agg(F.min("p").alias("m")).withColumnRenamed("c", "of"), f"{name}-top-{turn}")
        large = small.join(top, F.col("p") == F.col("of"), "left").select("c", F.coalesce("m", "p").alias("p")).distinct()
        before, now = now, scratch.keep(large, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}", f"{name}-least-{turn}", f"{name}-small-{turn}", f"{name}-top-{turn}")
    roots = now.select(F.col("p").alias("id")).distinct().withColumn("component", F.col("id"))
    return scratch.keep(now.select(F.col("c").alias("id"), F.col("p").alias("component")).unionByName(roots), f"{name}-done")


#: Members of a block.
BLOCK = 512
GROUP = ["bucket", "low", "high"]


def in_blocks(rows: DataFrame, group: str, size: int) -> DataFrame:
    """Add ``low``, ``high`` and ``block``: every pair of a group's rows (by ``id``) meets in one (low, high)."""
    counts = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))
    own = rows.join(counts, group).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return (own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
            .drop("blocks", "other"))


def groups_of(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Rows of equal first ``width`` values, from batches sorted by them."""
    group: list[tuple] = []
    for part in batches:
        for start in range(0, part.num_rows, 1000):
            for row in zip(*(c.to_pylist() for c in part.slice(start, 1000).columns)):
                if group and row[:width] != group[0][:width]:
                    yield group
                    group = []
                group.append(row)
    if group:
        yield group


class Joined:
    """Components that links have joined so far."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.above.get(x, x)) != x:
            self.above[x] = self.above.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> None:
        self.above[self.root(x)] = self.root(y)


def _block_links(compare: Callable):
    """compare(one, two, joined): linked pairs of two lists of rows whose components aren't joined yet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups_of(batches, 3):
            _, low, high = rows[0][:3]
            one = [r[3:] for r in rows if r[3] == low]
            two = one if low == high else [r[3:] for r in rows if r[3] == high]
            if one and two:
                found = [(min(p), max(p)) for p in compare(one, two, Joined())]
                yield pa.RecordBatch.from_arrays([pa.array([p[n] for p in found], pa.int64()) for n in (0, 1)], names=["a", "b"])
    return run


def link_by_buckets(buckets: DataFrame, plausible: Callable[[Column, Column], Column],
                    verify: Callable[[DataFrame], DataFrame],
                    payload: DataFrame | Callable[[DataFrame], DataFrame], compare: Callable,
                    scratch: Scratch) -> DataFrame:
    """``id`` and ``component`` of the ids that link with another one.

    ``buckets`` has ``table`` (int), ``bucket`` and ``id`` (long, not null) and ``info``, from which ``plausible`` tells
    whether two members can link at all.  ``verify`` keeps the linked ones of distinct pairs ``a``, ``b``.  ``compare``
    links two blocks of rows (block, id, component, table, then the columns of ``payload`` but ``id``); a function
    makes the payload of the ids it gets.
    """
    heads = scratch.keep(buckets.groupBy("bucket").agg(F.min(F.struct("id", "info")).alias("head"),
                                                       F.max("id").alias("other"))
                         .where("head.id <> other").drop("other"), "heads")
    members = scratch.keep(buckets.join(heads, "bucket").where("id <> head.id"), "members")
    first = members.where(plausible(F.col("info"), F.col("head.info"))).select(
        F.col("head.id").alias("a"), F.col("id").alias("b")).distinct()
    links = scratch.keep(verify(scratch.keep(first, "pairs")), "links")
    groups = components(links, scratch, "groups")

    # members but the head, which has been compared with all; buckets of one component are done
    placed = scratch.keep(members.select("table", "bucket", "id").join(groups, "id", "left")
                          .withColumn("component", F.coalesce("component", "id")), "placed")
    mixed = scratch.keep(placed.groupBy("bucket").agg(F.min("component").alias("from"), F.max("component").alias("to"))
                         .where("from <> to").select("bucket"), "mixed")
    spread = scratch.keep(in_blocks(scratch.keep(placed.join(mixed, "bucket"), "open"), "bucket", BLOCK), "spread")
    if callable(payload):
        payload = payload(spread.select("id").distinct())
    given = [c for c in payload.columns if c != "id"]
    rows = spread.join(payload, "id").select(*GROUP, "block", "id", "component", "table", *given)
    more = scratch.keep(rows.repartition(*GROUP).sortWithinPartitions(*GROUP)
                        .mapInArrow(_block_links(compare), "a long, b long").distinct(), "links-in-blocks")
    found = components(links.unionByName(more), scratch, "all") if more.take(1) else groups
    scratch.drop("heads", "members", "pairs", "placed", "mixed", "open", "spread")
    return found
