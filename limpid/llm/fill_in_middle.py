"""Fill-in-the-middle: cut a text at two line ends and write the middle last.

A text's bytes are dealt into fixed blocks.  A Fenwick tree holds the line ends and the code points of the blocks; a
binary-lifting descent finds the block in which a wanted line ends and the code points before it, and only that
block is searched for the place itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.tables import aside

#: Bytes of a block, and blocks that are counted at once.
BLOCK, SLAB = 1024, 1024
#: Bytes of texts in one batch of results.
BATCH_BYTES = 8 << 20
MARKERS = ("<P>", "<S>", "<M>")
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")


class Units:
    """Line ends and code points of a text by blocks, in a Fenwick tree; ``count`` units, the last maybe without an end."""

    def __init__(self, data: bytes, block: int = BLOCK):
        self.data, self.block = data, block
        raw = np.frombuffer(data, dtype=np.uint8)
        counts = [np.zeros((1, 2), dtype=np.int64)]
        for start in range(0, len(raw), block * SLAB):
            part = raw[start:start + block * SLAB]
            places = np.arange(0, len(part), block)
            counts.append(np.stack([np.add.reduceat((part == 10).view(np.int8), places, dtype=np.int64),
                                    np.add.reduceat(_starts(part).view(np.int8), places, dtype=np.int64)], axis=1))
        before = np.concatenate(counts).cumsum(axis=0)
        node = np.arange(len(before))
        #: node n: (line ends, code points) of the blocks it stands for, which are its lowest set bit
        self.tree = (before - before[node - (node & -node)]).tolist()
        self.ends, self.points = before[-1].tolist()
        self.count = self.ends + (len(data) > 0 and data[-1] != 10)

    def end(self, unit: int) -> tuple[int, int]:
        """Bytes and code points up to the end of a unit (from 1; 0 is the start of the text)."""
        if unit == 0:
            return 0, 0
        if unit > self.ends:
            return len(self.data), self.points
        blocks, points = 0, 0
        step = 1 << (len(self.tree) - 1).bit_length()
        while step := step >> 1:
            if blocks + step < len(self.tree) and self.tree[blocks + step][0] < unit:
                blocks += step
                unit -= self.tree[blocks][0]
                points += self.tree[blocks][1]
        start = blocks * self.block
        part = np.frombuffer(self.data, dtype=np.uint8)[start:start + self.block]
        length = int(np.flatnonzero(part == 10)[unit - 1]) + 1
        return start + length, points + int(_starts(part[:length]).sum())


def _starts(part: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (part & 0xC0) != 0x80


def draws(seed: int, key: str) -> list[int]:
    """Four numbers of 32 bits from the digest of seed and key."""
    found = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(found[n:n + 8], 16) for n in range(0, 32, 8)]


def rearranged(data: bytes, key: str, seed: int, rate: int, suffix_first: int, markers: tuple[bytes, bytes, bytes]):
    """Units, form, code points of prefix and middle, and the text rearranged."""
    units = Units(data)
    one, two, chance, order = draws(seed, key)
    if not data or chance % 100 >= rate or any(m in data for m in markers):
        return units.count, "plain", None, None, data
    low, high = sorted((one % (units.count + 1), two % (units.count + 1)))
    (a, prefix), (b, both) = units.end(low), units.end(high)
    begin, end, middle = markers
    head, tail = begin + data[:a], end + data[b:]
    form = "spm" if order % 100 < suffix_first else "psm"
    return units.count, form, prefix, both - prefix, b"".join(
        (tail, head) if form == "spm" else (head, tail)) + middle + data[a:b]


def _cut(seed: int, rate: int, suffix_first: int, markers: tuple[str, str, str]):
    marks = tuple(m.encode() for m in markers)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts, keys = whole.column("text").cast(pa.binary()), whole.column("key")
            start, made, size = 0, [], 0
            for row in range(whole.num_rows):
                made.append(rearranged(texts[row].as_py(), keys[row].as_py(), seed, rate, suffix_first, marks))
                size += len(made[-1][-1])
                if size > BATCH_BYTES or row + 1 == whole.num_rows:
                    part = whole.slice(start, row + 1 - start)
                    results = [pa.array(values, kind) for values, kind in zip(zip(*made), kinds)]
                    yield pa.RecordBatch.from_arrays([*part.columns[2:], *results], names=[*part.schema.names[2:], *RESULTS])
                    start, made, size = row + 1, [], 0
    return run


def fill_in_middle(df: DataFrame, id_column: str, text_column: str, *, seed: int = 7, rate: int = 100, suffix_first: int = 50,
                   markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """Add ``n`` (lines), ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` and ``output``.

    The id draws the two cuts among the line ends (and the start), whether the text is rearranged (``rate`` in 100)
    and whether the suffix goes first (``suffix_first`` in 100).  A missing text counts as empty; an empty text and
    one that holds a marker stay plain, with no prefix or middle.  A missing id draws as empty text; rows that
    repeat give the same result; an empty table stays empty.  Whole texts of any length are read.  A column that has
    the name of a new one goes on with ``_in`` behind its name.  Markers look like ``<x>``, which makes
    :func:`restored` exact.
    """
    if len(set(markers)) < 3 or not all(re.fullmatch(r"<[^<>]+>", m) for m in markers):
        raise ValueError("markers must be three different ones like <x>")
    own = [f"c{n}" for n in range(len(df.columns))]
    rows = df.toDF(*own)
    text, key = (F.col(own[df.columns.index(c)]) for c in (text_column, id_column))
    read = rows.select(F.coalesce(text, F.lit("")).alias("text"), F.coalesce(key.cast("string"), F.lit("")).alias("key"), *own)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    out = read.mapInArrow(_cut(seed, rate, suffix_first, markers),
                          f"{kinds}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.select(*[F.col(o).alias(aside(c, RESULTS)) for o, c in zip(own, df.columns)], *RESULTS)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from; as it holds no marker, the markers part it in one way only."""
    pieces = F.split(output, "|".join(re.escape(m) for m in markers), -1)
    return (F.when(form == "psm", F.concat(pieces[1], pieces[3], pieces[2]))
            .when(form == "spm", F.concat(pieces[2], pieces[3], pieces[1])).otherwise(output))
