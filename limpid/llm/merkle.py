"""Merkle manifest of a table: one leaf per row, trees per group, one root, and a proof for every row.

Every level is one group-by: conditional aggregates spread the children of a parent into as many slot columns as
the fanout (the slot pivot).  Concatenating the columns and hashing gives the parent; leaving out one's own column
gives the siblings a proof needs.  On the way down each pivoted row hands its children the siblings of all levels
above, so nothing but one row per parent is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.tables import Scratch, aside
from limpid.plans.ordering import with_position, with_series_position

FANOUT = 8
#: Hexadecimal digits of a digest.
DIGITS = 64


def digest_of(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for NULL, else the bytes of the text form in UTF-8, a colon, and that form."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row's columns in the given order."""
    return digest_of(*map(framed, columns))


def _slots(digests: bool = True) -> list[Column]:
    return [F.col(f"c{s}")["digest"] if digests else F.col(f"c{s}") for s in range(FANOUT)]


def _pivoted(nodes: DataFrame) -> DataFrame:
    """One row per parent of nodes (``tree``, ``at``, ``digest`` and more): its children in slot columns, its digest.

    A node that is alone in its tree is the top of it and passes as it is.
    """
    child = F.struct("digest", *[c for c in nodes.columns if c not in ("tree", "at", "digest")])
    slot = F.pmod(F.col("at"), F.lit(FANOUT))
    spread = nodes.groupBy("tree", F.expr(f"at div {FANOUT}").alias("parent")).agg(
        *[F.max(F.when(slot == s, child)).alias(f"c{s}") for s in range(FANOUT)])
    alone = (F.col("parent") == 0) & F.col("c1").isNull()
    return spread.withColumns({
        "alone": alone, "digest": F.when(alone, F.col("c0")["digest"]).otherwise(digest_of(F.concat_ws("", *_slots())))})


def climb(nodes: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """The levels from the leaves (``tree`` string, ``at`` long gapless from 0, ``digest``) to the tops of all trees.

    Written one by one, each an eighth of the one before; there are as many as the largest tree needs.
    """
    levels, widest = [], 1
    while widest:
        levels.append(scratch.keep(_pivoted(nodes), f"{name}-{len(levels)}"))
        widest = widest // FANOUT if len(levels) > 1 else levels[0].agg(F.max("parent")).first()[0] or 0
        nodes = levels[-1].select("tree", F.col("parent").alias("at"), "digest")
    return levels


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves' columns with ``path``, the siblings of every level, and what ``tops`` (``tree``, ``path``) brings.

    A path is an array of (slot, others): the own place in the run and the concatenated digests of the run's others.
    """
    more = [c for c in tops.columns if c not in ("tree", "path")]
    paths = tops.withColumn("at", F.lit(0).cast("long"))
    for level in reversed(levels):
        slots = F.array(*[F.struct(
            F.lit(s).alias("slot"), own.alias("child"),
            F.concat_ws("", *[d for n, d in enumerate(_slots()) if n != s]).alias("others"))
            for s, own in enumerate(_slots(digests=False))])
        joined = level.drop("digest").join(paths.withColumnsRenamed({"tree": "of", "at": "is"}),
                                           (F.col("tree") == F.col("of")) & (F.col("parent") == F.col("is")))
        children = joined.select("tree", "parent", "alone", "path", *more,
                                 F.inline(F.filter(slots, lambda x: x["child"].isNotNull())))
        step = F.array(F.struct("slot", "others"))
        paths = children.select(
            "tree", (F.col("parent") * FANOUT + F.col("slot")).alias("at"), "child.*", *more,
            F.when(F.col("alone"), F.col("path")).otherwise(F.concat(step, F.col("path"))).alias("path"))
    return paths


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    def up(below: Column, x: Column) -> Column:
        cut = x["slot"] * DIGITS
        return digest_of(F.substring(x["others"], F.lit(1), cut), below, F.substr(x["others"], cut + 1))
    return F.aggregate(path, digest, up)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: x["others"]), "").cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """``rows``: the id, ``leaf``, the carried columns, ``subroot``, ``root`` and ``path`` of every row; ``root``: of the table."""

    rows: DataFrame
    subroots: DataFrame
    root: str | None


def manifest(df: DataFrame, id_column: str, group_column: str, leaf: Column, scratch: Scratch,
             carry: dict[str, Column] | None = None) -> Manifest:
    """Leaves in trees per group, ascending by id, and a tree of the groups' roots, ordered by the group's text form.

    NULL is a group of its own and comes first, as does a NULL id.  Rows with equal ids are ordered by their leaves;
    rows that repeat are leaves of their own, and as they are alike, their order among each other doesn't matter: a
    hash of their place in the written table deals them to several tasks.  A group of one row has the row's leaf as
    its root; an empty table has no root (None).  Columns that aren't named are not read.  A result column that has
    the name of the id column leaves that one the name with ``_in`` behind it.
    """
    group = F.coalesce(F.concat(F.lit("="), F.col(group_column).cast("string")), F.lit("-"))
    carry = carry or {}
    own = {f"x{n}": c for n, c in enumerate(carry.values())}
    leaves = scratch.keep(df.select(group.alias("tree"), F.col(id_column).alias("id"), leaf.alias("digest"),
                                    *[c.alias(n) for n, c in own.items()]), "leaves")
    # files and places in them are fixed once written, so recomputed tasks agree
    leaves = leaves.withColumn("tie", F.xxhash64("_metadata.file_name", "_metadata.row_index"))
    placed = with_series_position(leaves, "tree", ["id", "digest", "tie"], "at").drop("tie")
    levels = climb(placed.withColumn("at", F.col("at") - 1), scratch, "level")
    subroots = levels[-1].select("tree", "digest")
    upper = climb(with_position(subroots, "tree", "at").select(
        F.lit("").alias("tree"), (F.col("at") - 1).alias("at"), "digest", F.col("tree").alias("group")), scratch, "upper")
    first = upper[-1].select("tree", "digest").first()
    root = first["digest"] if first else None
    empty = F.array().cast("array<struct<slot:int,others:string>>")
    groups = scratch.keep(descend(upper, upper[-1].select("tree", F.col("digest").alias("root"), empty.alias("path"))).select(
        F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "groups")
    rows = descend(levels, groups)
    names = ("leaf", *carry, "subroot", "root", "path")
    rows = rows.select(F.col("id").alias(aside(id_column, names)), F.col("digest").alias("leaf"),
                       *[F.col(n).alias(c) for n, c in zip(own, carry)], "subroot", "root", "path")
    named = groups.select(F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")).alias(group_column), "subroot")
    return Manifest(rows, named, root)
