"""Token ids of whole texts from the ids of their space-separated chunks.

No match of the byte-level pattern crosses a single space that stands between two other characters, and no
match of the word-level pattern crosses white space at all.  A text's ids are therefore the ids of its chunks
in order, and a chunk seen before costs one dictionary lookup.  Texts in which that does not hold (runs of
white space) and chunks with unusual characters go to the tokenizer whole.  Memories are emptied when full.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import regex
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

#: Entries of a memory, about 100 bytes each.
MEMORY_ENTRIES = 400_000
#: Characters that are composed and lower-cased alike everywhere.
PLAIN = re.compile(r"[\n\x20-\x7e¡-įı-ſ]+")
#: White space to Python's split() that the tokenizer's patterns take for symbols.
SEPARATORS = re.compile(r"[\x1c-\x1f]")


class Memory(dict):
    """Results of a function by argument; emptied when full."""

    def __init__(self, function, entries: int = MEMORY_ENTRIES):
        super().__init__()
        self.function, self.entries = function, entries

    def __missing__(self, key):
        if len(self) >= self.entries:
            self.clear()
        self[key] = result = self.function(key)
        return result


@lru_cache(1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else 256 onwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class SpacedChunks:
    """Ids of texts whose chunks are cut at single spaces; a chunk after the first begins with its space."""

    def __init__(self, chunk_ids, text_ids, entries: int = MEMORY_ENTRIES):
        """chunk_ids, text_ids: functions from a chunk or a whole text to its ids as little-endian bytes."""
        self.text_ids = text_ids
        self.first = Memory(lambda c: chunk_ids(c) if not c or not c[-1].isspace() else None, entries)
        self.later = Memory(lambda c: chunk_ids(" " + c) if c and not c[0].isspace() and not c[-1].isspace() else None,
                            entries)

    def __call__(self, text: str) -> bytes:
        first, *later = text.split(" ")
        if not later:
            return self.text_ids(text)
        try:
            return self.first[first] + b"".join(map(self.later.__getitem__, later))
        except TypeError:  # a chunk with None: white space next to a space
            return self.text_ids(text)


class LibraryEncoder:
    """Ids that a tokenizers file gives, without added special tokens, as little-endian unsigned 32-bit bytes."""

    def __init__(self, file: str):
        self.whole = Tokenizer.from_file(file)
        self.whole.no_truncation()
        self.whole.no_padding()
        settings = json.loads(self.whole.to_str())
        self.model, letters = self.whole.model, byte_letters()
        self.letters = {b: c for b, c in letters.items() if chr(b) != c}
        self.pieces = Memory(self._piece)
        steps = (settings["pre_tokenizer"] or {}).get("pretokenizers", [settings["pre_tokenizer"] or {}])
        normal = [n["type"] for n in (settings["normalizer"] or {}).get("normalizers", [])]
        self.lower = False
        if settings["normalizer"] is None and len(steps) == 1 and steps[0].get("use_regex") \
                and not steps[0]["add_prefix_space"]:
            self.pattern = regex.compile(PATTERN)
            self.ids = SpacedChunks(self._chunk, self._text)
        elif normal == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"] \
                and steps[0]["invert"] and steps[0]["behavior"] == "Removed":
            self.pattern, self.lower = regex.compile(steps[0]["pattern"]["Regex"]), True
            self.words = Memory(self._chunk)
            self.ids = self._words
        else:
            self.ids = self._text

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() and piece.isprintable() and " " not in piece else \
            piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not chunk.isascii() and not PLAIN.fullmatch(chunk):
            return self._text(chunk)
        word = chunk.rstrip(",.")
        if word[word[:1] == " ":].isalpha():  # letters and then at most some marks: two matches
            if self.lower:
                word, chunk = word.lower(), chunk.lower()
            end = chunk[len(word):]
            return self.pieces[word] + self.pieces[end] if end else self.pieces[word]
        if "<|" in chunk:
            return self._text(chunk)
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(chunk.lower() if self.lower else chunk)))

    def _text(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _words(self, text: str) -> bytes:
        return self._text(text) if SEPARATORS.search(text) else b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(4)
def library_encoder(file: str) -> LibraryEncoder:
    return LibraryEncoder(file)
