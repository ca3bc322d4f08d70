"""Near-duplicate documents by DartMinHash signatures of weighted word shingles.

Darts are thrown by hash into the region of every element: its weight wide, as high as a rank limit that lets
about k ln k + 2 k darts hit the document.  A dart belongs to one of k coordinates, and the earliest in each
makes the signature, so two documents agree in a coordinate with the probability of their weighted Jaccard
similarity.  Signatures are cut into bands; documents that share a band are compared exactly, unless their whole
signatures say that they can't be that similar.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.linking import Joined, link_by_buckets
from limpid.llm.tables import Scratch

#: Words of a shingle, and the similarity from which documents link.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares a band with probability 0.998.
BANDS, BAND_ROWS = 28, 7
#: Least share of equal coordinates of a pair that is compared exactly in a block: 3.5 deviations below 0.8.
LEAST_EQUAL = 0.7
WORD_CHARACTER = re.compile(r"\w")
ODD1, ODD2, ODD3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Documents hashed together, and darts drawn at a time.
BATCH_DOCUMENTS, MAX_DRAWS = 100, 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; wraps on overflow."""
    x = (x ^ (x >> np.uint64(30))) * ODD2
    x = (x ^ (x >> np.uint64(27))) * ODD3
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)


#: A number for every code point, and whether it belongs to words.
LETTERS = mix(np.arange(sys.maxunicode + 1, dtype=np.uint64) + ODD1)
IS_WORD = np.zeros(len(LETTERS), dtype=bool)
IS_WORD[[m.start() for m in WORD_CHARACTER.finditer("".join(map(chr, range(len(LETTERS)))))]] = True


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    inverse = np.uint64(pow(int(ODD1), -1, 1 << 64))
    return np.cumprod(np.full(size, ODD1)), np.cumprod(np.full(size, inverse))


def word_codes(text: str) -> np.ndarray:
    """A hash of every word of the text, in order: lower case, runs of letters, digits and underscores."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    within = IS_WORD[codes]
    edges = np.flatnonzero(np.diff(within, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(1 << max(16, len(codes).bit_length()))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(LETTERS[codes] * up[:len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(codes: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the runs of words and how often each occurs; one run of all words if there are fewer."""
    if not len(codes):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    size = min(size, len(codes))
    runs = np.zeros(len(codes) - size + 1, dtype=np.uint64)
    for n in range(size):
        runs = mix(runs * ODD1 + codes[n:n + len(runs)])
    return np.unique(runs, return_counts=True)


def _cells(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray):
    """Cut each element's weight at 1, 2, 4, ...: (hash, owner, low end, width, weight) of every cell it reaches."""
    out, low, width, number = [], 0.0, 1.0, np.uint64(1)
    while len(elements):
        out.append((mix(elements * ODD1 + number), owner, np.full(len(elements), low), np.full(len(elements), width), weights))
        low, width, number = (1.0, 1.0, number + np.uint64(1)) if low == 0 else (low * 2, width * 2, number + np.uint64(1))
        more = weights > low
        elements, weights, owner = elements[more], weights[more], owner[more]
    return [np.concatenate(c) for c in zip(*out)]


def signatures(documents: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """documents x k (uint64) from (distinct element hashes, positive weights); every document has an element."""
    n = len(documents)
    result, best = np.zeros(n * k, dtype=np.uint64), np.full(n * k, np.inf)
    limit = (k * np.log(k) + 2 * k) / np.array([w.sum() for _, w in documents], dtype=np.float64)
    start, todo = np.zeros(n), np.arange(n)
    while len(todo):
        cell, owner, low, width, weight = _cells(
            np.concatenate([documents[d][0] for d in todo]),
            np.concatenate([documents[d][1].astype(np.float64) for d in todo]),
            np.repeat(todo, [len(documents[d][0]) for d in todo]))
        rank, drawn = np.zeros(len(cell)), np.zeros(len(cell), dtype=np.uint64)
        while len(cell):
            expected = float(np.median((limit[owner] - rank) * width))
            step = int(np.clip(np.ceil(expected + 1), 2, max(2, MAX_DRAWS // len(cell))))
            dart = mix(cell[:, None] + (drawn[:, None] + np.arange(1, step + 1, dtype=np.uint64)) * ODD1)
            ranks = rank[:, None] + np.cumsum(-np.log(unit(dart)), axis=1) / width[:, None]
            rows, columns = np.nonzero((ranks <= limit[owner][:, None]) & (ranks > start[owner][:, None]))
            thrown, at = dart[rows, columns], ranks[rows, columns]  # those before start fell under a lower limit
            part = weight[rows] < low[rows] + width[rows]  # cells that the weight covers in part
            if part.any():
                inside = ~part
                inside[part] = low[rows[part]] + width[rows[part]] * unit(mix(thrown[part] + ODD2)) <= weight[rows[part]]
                rows, thrown, at = rows[inside], thrown[inside], at[inside]
            key = owner[rows] * k + (mix(thrown + ODD3) % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, key, at)
            won = best[key] == at
            result[key[won]] = thrown[won]
            rank, drawn = ranks[:, -1], drawn + np.uint64(step)
            live = rank <= limit[owner]
            cell, owner, low, width, weight, rank, drawn = (v[live] for v in (cell, owner, low, width, weight, rank, drawn))
        todo = np.nonzero(np.isinf(best).reshape(n, k).any(axis=1))[0]
        start[todo] = limit[todo]
        limit[todo] *= 2
    return result.reshape(n, k)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * ODD3, (len(signature), bands))
    parts = signature[:, :bands * rows].reshape(len(signature), bands, rows)
    for r in range(rows):
        out = mix(out * ODD1 + parts[:, :, r])
    return out


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: shared weight over joint weight; 0 without elements."""
    _, left, right = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(one[1][left], two[1][right]).sum())
    joint = int(one[1].sum() + two[1].sum()) - shared
    return shared / joint if joint else 0.0


def _signed(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, BATCH_DOCUMENTS):
                part = whole.slice(begin, BATCH_DOCUMENTS)
                words = [word_codes(t or "") for t in part.column("text").to_pylist()]
                found = [shingles(w) for w in words]
                used = [n for n, (e, _) in enumerate(found) if len(e)]
                hashes: list = [None] * len(found)
                short: list = [None] * len(found)
                if used:
                    signed = signatures([found[n] for n in used], bands * rows)
                    for n, row, whole_row in zip(used, band_hashes(signed, bands, rows).view(np.int64), signed):
                        hashes[n], short[n] = row, (whole_row >> np.uint64(48)).astype("<u2").tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("mark"),
                    pa.array([hashlib.md5(w.tobytes()).digest() if len(w) else None for w in words], pa.binary()),
                    pa.array([int(c.sum()) for _, c in found], pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                    names=["id", "mark", "digest", "weight", "bands", "signature"])
    return run


@lru_cache(2048)
def _known(text: str) -> tuple[np.ndarray, np.ndarray]:
    return shingles(word_codes(text))


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = zip(part.column("text_a").to_pylist(), part.column("text_b").to_pylist())
            keep = pa.array([similarity(_known(a or ""), _known(b or "")) >= threshold for a, b in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])
    return run


def _compare(bands: int, rows: int, threshold: float, least_equal: float):
    """Compare blocks: (block, id, component, table, signature, text) of documents in one bucket of band ``table``."""
    def compare(one: list[tuple], two: list[tuple], joined: Joined) -> Iterator[tuple[int, int]]:
        left, right = (np.array([np.frombuffer(r[4], dtype="<u2") for r in part]) for part in (one, two))
        earlier = slice(0, one[0][3] * rows)
        for n, row in enumerate(one):
            begin = n + 1 if one is two else 0
            equal = right[begin:] == left[n]
            share = equal.mean(axis=1)
            # a pair that shares an earlier band is compared there
            known = equal[:, earlier].reshape(len(equal), one[0][3], rows).all(axis=2).any(axis=1)
            close = np.flatnonzero((share >= least_equal) & ~known)
            for at in close[np.argsort(-share[close], kind="stable")].tolist():
                other = two[begin + at]
                if joined.root(row[2]) != joined.root(other[2]) and \
                        similarity(_known(row[5] or ""), _known(other[5] or "")) >= threshold:
                    joined.join(row[2], other[2])
                    yield row[1], other[1]
    return compare


def marked_copies(df: DataFrame, id_column: str, text_column: str, scratch: Scratch, bands: int = BANDS,
                  band_rows: int = BAND_ROWS, threshold: float = SIMILARITY, least_equal: float = LEAST_EQUAL) -> DataFrame:
    """One row per row of ``df``: ``id``, ``mark`` (MD5 of the text), ``worded``, ``component_id`` and ``kept``.

    Texts of equal words are one class; classes link, whatever their ids.  A component keeps the row of its smallest
    id, then digest of the words, then mark: rows that repeat both id and text are all marked as kept.
    """
    text = F.col(text_column)
    docs = df.select(F.col(id_column).cast("long").alias("id"), text.alias("text"),
                     F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("mark"))
    known = docs.where("id IS NOT NULL")
    signed = scratch.keep(known.mapInArrow(
        _signed(bands, band_rows),
        "id long, mark string, digest binary, weight long, bands array<bigint>, signature binary"), "signed")
    classes = scratch.keep(signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("id", "mark")).alias("rep"), F.first("weight").alias("weight"), F.first("bands").alias("bands"),
        F.first("signature").alias("signature")).withColumn("node", F.monotonically_increasing_id()), "classes")
    buckets = classes.select(F.posexplode("bands").alias("table", "bucket"), F.col("node").alias("id"), F.col("weight").alias("info"))

    def texts_of(nodes: DataFrame) -> DataFrame:
        """``id`` (the node) and ``text``, once per node, however many rows repeat it."""
        named = classes.select("node", "rep.id", "rep.mark").join(nodes.withColumnRenamed("id", "node"), "node")
        return known.join(named, ["id", "mark"]).groupBy("node").agg(F.first("text").alias("text")).withColumnRenamed("node", "id")

    def plausible(one: Column, two: Column) -> Column:
        return F.least(one, two) >= threshold * F.greatest(one, two)

    def verify(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        texts = scratch.keep(texts_of(nodes), "pair-texts")
        with_a = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        both = with_a.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        return both.select("a", "b", "text_a", "text_b").mapInArrow(_verified(threshold), "a long, b long").distinct()

    def payload(nodes: DataFrame) -> DataFrame:
        return classes.select(F.col("node").alias("id"), "signature").join(texts_of(nodes), "id")

    groups = link_by_buckets(buckets, plausible, verify, payload, _compare(bands, band_rows, threshold, least_equal), scratch)
    placed = scratch.keep(classes.select("node", "digest", "rep").join(groups.withColumnRenamed("id", "node"), "node", "left")
                          .select("digest", "rep", F.coalesce("component", "node").alias("component")), "class-components")
    first = placed.groupBy("component").agg(F.min(F.struct("rep.id", "digest", "rep.mark")).alias("first"))
    placed = scratch.keep(placed.join(first, "component").select("digest", "first"), "class-firsts")
    member = signed.select("id", "mark", "digest").join(placed, "digest", "left")
    own = F.struct("id", "digest", "mark")
    return member.select("id", "mark", F.col("digest").isNotNull().alias("worded"),
                         F.coalesce("first.id", "id").alias("component_id"),
                         (F.col("first").isNull() | (F.col("first") == own)).alias("kept")).unionByName(
        docs.where("id IS NULL").select("id", "mark", F.lit(False).alias("worded"),
                                        F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def near_duplicates(df: DataFrame, id_column: str, text_column: str, scratch: Scratch, bands: int = BANDS,
                    band_rows: int = BAND_ROWS, threshold: float = SIMILARITY, least_equal: float = LEAST_EQUAL) -> DataFrame:
    """One row per row of ``df``: its id, ``component_id`` (the smallest id of its text's component) and ``kept``.

    Documents link when the weighted Jaccard similarity of their five-word shingles (lower case, marks ignored,
    weight: occurrences) reaches the threshold.  Shorter texts count as one shingle; texts without words link
    with nothing and keep their rows.  Texts of equal words are one class before any comparison.  Ids are whole
    numbers; texts of one id are judged each by itself, so an id whose texts don't link has several components, which
    can share its number.  ``kept`` marks one text of one id per component; rows that repeat both carry it together.
    A missing id keeps its row, as no one's duplicate.  Other columns are not read; an empty table gives no rows.
    In a bucket of several components pairs whose signatures agree in less than ``least_equal`` are left out;
    with 0 all of them are compared exactly.
    """
    return marked_copies(df, id_column, text_column, scratch, bands, band_rows, threshold, least_equal).select(
        F.col("id").alias(id_column), "component_id", "kept")
