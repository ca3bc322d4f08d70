"""Hierarchical packing of documents into sequences of several context sizes.

A document's ids are cut into full windows of the largest context and a rest.  Rests are routed to the smallest
context (tier) that holds them.  Each tier is packed into windows of its size: its own rests open windows, gaps
are filled with the longest fitting rests of shorter tiers, and what whole rests can't fill is filled by cutting
one.  Windows of a tier are then dealt to step groups of equal tokens, by attention cost, in a zigzag; windows that
don't make a whole group wait for the next pool, so only the last group of a tier in a task can be short.

A task packs the rows it reads, pool by pool, so no ids are shuffled, no group of rows matters and memory is
bounded by the pool and by one document.  What is left at the end of a task is cut into windows of powers of
two, so nothing is padded.  Results depend on the division of the input into tasks, not on retries.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.chunks import library_encoder

CONTEXTS = (256, 512, 1024, 2048)
#: Tokens gathered before they are packed.
POOL_TOKENS = 1 << 20
#: Tokens of a step group.
STEP_TOKENS = 1 << 16
#: Ids a task may give to its sequences and step groups.
TASK_IDS = 1 << 40
SCHEMA = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "context int, step_group long")


class Pool:
    """Rests of documents by length; each is (length, key, first token)."""

    def __init__(self, contexts: tuple[int, ...]):
        self.contexts = contexts
        self.rests: list[tuple[int, int, int]] = []
        self.windows: dict[int, list[list[tuple[int, int, int]]]] = {c: [] for c in contexts}

    def add(self, key: int, tokens: int) -> None:
        top = self.contexts[-1]
        for start in range(0, tokens - top + 1, top):
            self.windows[top].append([(top, key, start)])
        if tokens % top:
            self.rests.append((tokens % top, key, tokens - tokens % top))

    def pack(self) -> list[list[tuple[int, int, int]]]:
        """Fill windows tier by tier, longest first; returns the window that stayed open, if any."""
        self.rests.sort()
        for tier in range(len(self.contexts) - 1, -1, -1):
            size, below = self.contexts[tier], self.contexts[tier - 1] if tier else 0
            while self.rests and self.rests[-1][0] > below:
                window, gap = [self.rests[-1]], size - self.rests[-1][0]
                self.rests.pop()
                while gap and self.rests:
                    fits = bisect_right(self.rests, (gap, 1 << 62, 0))
                    if fits and (gap >= below or self.rests[fits - 1][0] == gap or fits > 1):
                        rest = self.rests.pop(fits - 1)
                    elif fits:
                        rest = self.rests.pop(0)
                    else:  # no rest is short enough: cut the shortest
                        length, key, start = self.rests.pop(0)
                        rest = (gap, key, start)
                        insort(self.rests, (length - gap, key, start + gap))
                    window.append(rest)
                    gap -= rest[0]
                if gap:
                    return [window]
                self.windows[size].append(window)
        return []


def powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut an open window into windows whose sizes are powers of two."""
    tokens, out = sum(p[0] for p in window), []
    rests = list(reversed(window))
    while tokens:
        size = 1 << (tokens.bit_length() - 1)
        tokens -= size
        part = []
        while size:
            length, key, start = rests.pop()
            if length > size:
                rests.append((length - size, key, start + size))
                length = size
            part.append((length, key, start))
            size -= length
        out.append(part)
    return out


def step_groups(costs: list[int], groups: int) -> list[int]:
    """Group numbers that give every group as many windows and nearly the same attention cost."""
    turn = np.arange(len(costs)) % (2 * groups)
    out = np.empty(len(costs), dtype=np.int64)
    out[np.argsort(-np.array(costs, dtype=np.int64), kind="stable")] = np.where(turn < groups, turn, 2 * groups - 1 - turn)
    return out.tolist()


#: A piece of a window: document, start, length, ids, tokens of the document.
Piece = tuple[object, int, int, bytes, int]


class Steps:
    """Windows by context that wait for a whole step group; ``tokens`` in a group."""

    def __init__(self, tokens: int, sequence: int, group: int):
        self.tokens, self.sequence, self.group = tokens, sequence, group
        self.waiting: dict[int, list[list[Piece]]] = {}

    def _rows(self, windows: list[list[Piece]], context: int, groups: int) -> Iterator[tuple]:
        for window, g in zip(windows, step_groups([sum(p[2] ** 2 for p in w) for w in windows], groups)):
            offset = 0
            for doc, start, length, ids, tokens in window:
                yield doc, start, length, ids, tokens, self.sequence, offset, context, self.group + g
                offset += length
            self.sequence += 1

    def add(self, context: int, windows: list[list[Piece]]) -> Iterator[tuple]:
        """Rows of the groups that are whole now."""
        waiting = self.waiting.setdefault(context, [])
        waiting += windows
        each = max(1, self.tokens // context)
        groups = len(waiting) // each
        if groups:
            self.waiting[context] = waiting[groups * each:]
            yield from self._rows(waiting[:groups * each], context, groups)
            self.group += groups

    def close(self, contexts: tuple[int, ...]) -> Iterator[tuple]:
        """Rows of what still waits: one group per tier, and one for windows of all other sizes together."""
        for context in sorted(self.waiting, reverse=True):
            yield from self._rows(self.waiting[context], context, 1)
            self.group += context in contexts and bool(self.waiting[context])
        self.waiting = {}


def _packer(name: str, kind: pa.DataType, file: str, end_id: int, contexts: tuple[int, ...], pool_tokens: int,
            step_tokens: int):
    def batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        names = [name, *(part.split()[0] for part in SCHEMA.split(", "))]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * len(kinds), kinds)], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = library_encoder(file), end_id.to_bytes(4, "little")
        first = TaskContext.get().partitionId() * TASK_IDS
        steps = Steps(step_tokens, first, first)
        docs: dict[int, tuple] = {}
        pool, tokens, n = Pool(contexts), 0, 0

        def cut(window: list[tuple[int, int, int]]) -> list[Piece]:
            return [(docs[key][0], start, length, docs[key][1][4 * start:4 * (start + length)], len(docs[key][1]) // 4)
                    for length, key, start in window]

        def placed(final: bool) -> Iterator[tuple]:
            nonlocal docs, pool, tokens
            still_open = pool.pack()
            for context, windows in pool.windows.items():
                yield from steps.add(context, [cut(w) for w in windows])
            if final:
                for window in powers_of_two(still_open[0]) if still_open else []:
                    yield from steps.add(sum(p[0] for p in window), [cut(window)])
                yield from steps.close(contexts)
            pool = Pool(contexts)
            pool.rests = [p for w in still_open for p in w]
            docs, tokens = {p[1]: docs[p[1]] for p in pool.rests}, sum(p[0] for p in pool.rests)

        def packed(final: bool) -> Iterator[pa.RecordBatch]:
            rows = placed(final)
            while found := list(islice(rows, 2000)):
                yield batch(found)

        for part in batches:
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = encode.ids(text or "") + last
                docs[n] = doc, ids
                pool.add(n, len(ids) // 4)
                n, tokens = n + 1, tokens + len(ids) // 4
                if tokens >= pool_tokens:
                    yield from packed(final=False)
        yield from packed(final=True)

    return pack


def pack_documents(df: DataFrame, id_column: str, text: Column | str, file: str, end_id: int = 1,
                   contexts: tuple[int, ...] = CONTEXTS, pool_tokens: int = POOL_TOKENS,
                   step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece of a document: its ids and its place in a sequence.

    ``file`` is a tokenizers file, ``end_id`` is put behind every document, ``contexts`` are ascending powers of
    two.  ``ids`` holds little-endian unsigned 32-bit numbers.  A missing or empty text is a document of the end
    id alone; rows that repeat are packed as often as they occur, a missing id stays missing, other columns are
    not read.  An empty table gives no rows.
    """
    if any(c & (c - 1) for c in contexts) or sorted(set(contexts)) != list(contexts):
        raise ValueError("contexts must be ascending powers of two")
    read = df.select(F.col(id_column).alias("id"), F.coalesce(text if isinstance(text, Column) else F.col(text),
                                                              F.lit("")).alias("text"))
    kind = df.schema[id_column].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    return read.mapInArrow(_packer("id", to_arrow_type(kind), file, end_id, tuple(contexts), pool_tokens, step_tokens),
                           f"id {kind.simpleString()}, {SCHEMA}").withColumnRenamed("id", id_column)
