"""Byte-level BPE: whole texts to ids by a transducer over the merges, ids back to texts by a UTF-8 stream.

Every match of the split pattern is encoded by itself (``transducer``); chunks and matches seen before come from
bounded memories.  Decoding reads ids in blocks, so a block may end inside a character: the decoder's state is
the unfinished character's bytes and how many are still due.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.chunks import Memory, SpacedChunks
from limpid.llm.transducer import Transducer

#: Ids that the decoder takes at a time.
BLOCK_IDS = 1 << 14
#: Entries of the memories for matches and chunks, which stand beside the transducer's states.
ENTRIES = 200_000


def read_ranks(file: str) -> dict[bytes, int]:
    with open(file, "rb") as f:
        return {base64.b64decode(spelling): int(rank) for spelling, rank in map(bytes.split, f)}


class RankEncoder:
    """Ids of a text by a rank file, as little-endian unsigned 32-bit bytes."""

    def __init__(self, file: str, pattern: str = PATTERN):
        self.ranks = read_ranks(file)
        self.machine = Transducer({s.decode("latin-1"): r for s, r in self.ranks.items()})
        self.pattern = regex.compile(pattern)
        self.matches = Memory(self._match, ENTRIES)
        self.ids = SpacedChunks(self._text, self._text, ENTRIES) if pattern == PATTERN else self._text

    def _match(self, match: str) -> bytes:
        spelling = match.encode()
        rank = self.ranks.get(spelling)
        return array("I", self.machine.encode(spelling.decode("latin-1")) if rank is None else (rank,)).tobytes()

    def _text(self, text: str) -> bytes:
        word = text.rstrip(",.")  # letters and then at most some marks are two matches at most
        if word[word[:1] == " ":].isalpha() and self.pattern.pattern == PATTERN:
            end = text[len(word):]
            return self.matches[word] + self.matches[end] if end else self.matches[word]
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))


class Utf8Stream:
    """Incremental UTF-8 decoding: complete characters come out, the bytes of an unfinished one wait.

    Bytes that can't be part of a character become U+FFFD, as in a decoding of everything at once.
    """

    def __init__(self):
        self.waiting = b""

    @staticmethod
    def due(tail: bytes) -> int:
        """How many of the last bytes (at most three) begin a character that isn't complete."""
        for back in range(1, min(3, len(tail)) + 1):
            byte = tail[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                needs = 2 if 0xC2 <= byte <= 0xDF else 3 if 0xE0 <= byte <= 0xEF else 4 if 0xF0 <= byte <= 0xF4 else 1
                if back >= needs:
                    return 0
                second = tail[-back + 1] if back > 1 else None
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
                return back if second is None or low <= second <= high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.waiting + data
        due = self.due(data)
        self.waiting = data[len(data) - due:]
        return data[:len(data) - due].decode("utf-8", "replace")

    def end(self) -> str:
        waiting, self.waiting = self.waiting, b""
        return waiting.decode("utf-8", "replace")


class RankDecoder:
    def __init__(self, file: str):
        self.spelling = {r: s for s, r in read_ranks(file).items()}

    def stream(self, blocks: Iterable[bytes]) -> Iterator[str]:
        """Text as it becomes complete, from blocks of ids."""
        utf8 = Utf8Stream()
        for block in blocks:
            yield utf8.feed(b"".join(map(self.spelling.__getitem__, array("I", block))))
        yield utf8.end()

    def text(self, ids: bytes) -> str:
        step = 4 * BLOCK_IDS
        return "".join(self.stream(ids[n:n + step] for n in range(0, len(ids), step)))


@lru_cache(2)
def rank_encoder(file: str, pattern: str) -> RankEncoder:
    return RankEncoder(file, pattern)


@lru_cache(2)
def rank_decoder(file: str) -> RankDecoder:
    return RankDecoder(file)


#: A pass over one column: (name, SQL type, Arrow type, how a task makes the function) per added column.
Step = tuple[str, str, pa.DataType, Callable[[], Callable]]


def _each(steps: Sequence[Step]):
    """A map over the first column; every further step takes what the one before it made.  Other columns pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = [(make(), kind) for _, _, kind, make in steps]
        for part in batches:
            for n in range(0, max(1, part.num_rows), 500):
                some = part.slice(n, 500)
                values, made = some.column(0).to_pylist(), []
                for function, kind in functions:
                    values = [None if v is None else function(v) for v in values]
                    made.append(pa.array(values, kind))
                names = [*some.schema.names, *(f"made{k}" for k in range(len(made)))]
                yield pa.RecordBatch.from_arrays([*some.columns, *made], names=names)
    return run


def _apply(df: DataFrame, source: Column, *steps: Step) -> DataFrame:
    for name, *_ in steps:
        if name in df.columns:
            raise ValueError(f"column {name} is there already")
    own = [f"c{n}" for n in range(len(df.columns))]  # names may clash with the source's or with each other
    given = df.select(source.alias("source"), *[df[c].alias(o) for c, o in zip(df.columns, own)])
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in given.schema]
    made = [f"made{k} {kind}" for k, (_, kind, _, _) in enumerate(steps)]
    out = given.mapInArrow(_each(steps), ", ".join(fields + made))
    return out.select(*[F.col(o).alias(c) for c, o in zip(df.columns, own)],
                      *[F.col(f"made{k}").alias(step[0]) for k, step in enumerate(steps)])


def _encoding(name: str, file: str, pattern: str) -> Step:
    return name, "binary", pa.binary(), lambda: rank_encoder(file, pattern).ids


def _decoding(name: str, file: str) -> Step:
    return name, "string", pa.string(), lambda: rank_decoder(file).text


def encode(df: DataFrame, text_column: str, file: str, ids_column: str = "ids", pattern: str = PATTERN) -> DataFrame:
    """Add the ids of a text as little-endian unsigned 32-bit bytes.

    A missing or empty text has no ids (empty bytes); special strings are ordinary text; repeated rows stay;
    an empty table stays empty.  All other columns pass; an existing column of the new name raises.
    """
    return _apply(df, F.coalesce(F.col(text_column), F.lit("")), _encoding(ids_column, file, pattern))


def decode(df: DataFrame, ids_column: str, file: str, text_column: str = "decoded") -> DataFrame:
    """Add the text that ids stand for; missing ids give a missing text."""
    return _apply(df, F.col(ids_column), _decoding(text_column, file))


def round_trip(df: DataFrame, text_column: str, file: str, ids_column: str = "ids", decoded_column: str = "decoded",
               pattern: str = PATTERN) -> DataFrame:
    """Add the ids of a text and the text that these ids stand for, as ``encode`` and ``decode`` would.

    One pass does both, so a task needs one Python worker and the texts are handed over once.
    """
    return _apply(df, F.coalesce(F.col(text_column), F.lit("")), _encoding(ids_column, file, pattern),
                  _decoding(decoded_column, file))
