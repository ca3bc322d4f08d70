"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

Candidates are values assigned to key-like names and long runs of token characters.  The forest judges them by
length, character transitions, coverage by dictionary words, signs of paths and addresses, and the words around.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm import forest
from limpid.llm.labelled_findings import findings

#: Labelled findings made for training, and the share of trees from which a finding is a secret.
TRAINING_FINDINGS, IS_SECRET = 4000, 0.5
#: Parts of a long finding that are learned from.
TRAINING_PARTS = 4
REPLACEMENT = "[SECRET]"
#: Parts judged together.
PARTS = 5000
KEYS = ("passwords? passwd pwd pass[_-]?phrases? passcodes? secret[_-]?keys? secrets? tokens? api[_-]?keys? apikeys? "
        "access[_-]?keys? private[_-]?keys? signing[_-]?keys? encryption[_-]?keys? client[_-]?secrets? auth credentials? bearer").split()
#: A value behind a name, as a word or in quotes with all its blanks; some names need a sign of assignment.
ASSIGNED = re.compile(
    r"(?:(?:" + "|".join(KEYS) + r")[\"']?(?:\s{0,3}[=:]\s{0,3}|\s)|(?<![A-Za-z])(?:pass|psk)[\"']?\s{0,3}[=:]\s{0,3})"
    r"(?:(?P<quote>[\"'])(?P<quoted>[^\"'\n]{8,})(?P=quote)|[\"']?(?P<value>[^\s\"'<>,;]{8,}))"
    r"|://[^\s:@/]{1,64}:(?P<login>[^\s:@/]{6,})@", re.I)
#: Texts without any of these have no assigned values.
ROOTS = ("pass", "psk", "pwd", "secret", "token", "api", "access", "private", "signing", "encryption", "client", "auth",
         "credential", "bearer", "://")
#: Keys in their frames, private and public ones.
FRAME = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}-----")
RUN = re.compile(r"(?<![A-Za-z0-9+/=_.\-])[A-Za-z0-9+/=_.\-]{16,}")
#: Where a run goes on with a value after a name.
VALUE = re.compile(r"=+(?=[^=])")
#: Longer candidates are judged by windows of so many characters, each half over the next, and by their segments.
WINDOW = 200
SEGMENT = re.compile(r"[A-Za-z0-9+_\-]{16,}")
KEY = re.compile("|".join(KEYS), re.I)
HARMLESS = re.compile(r"commit|revision|sha|md5|checksum|digest|etag|uuid|tree|parent|hash|request|integrity|fingerprint|index", re.I)
#: What is public by its form: data in an address, digests with their name, public keys.
PUBLIC = re.compile(r"(?:;base64,|ssh-(?:rsa|dss|ed25519) |ecdsa-[a-z0-9-]{1,30} )$")
NAMED_DIGEST = re.compile(r"(?:sha(?:1|224|256|384|512)|md5)[-:]", re.I)
DUMMY = re.compile(r"example|placeholder|change|your|dummy|test|sample|replace|x{4}|\*{4}|env|null|undefined|[<${(]", re.I)
KNOWN = re.compile(r"(?:AKIA|ASIA|ghp_|gho_|github_pat_|sk-|sk_live_|rk_live_|xox[abp]-|glpat-|AIza|npm_|eyJ)")
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.I)


@lru_cache(2)
def dictionary(file: str) -> frozenset[str]:
    """Lower-case words and word parts of four letters and more in a tokenizers file."""
    with open(file, encoding="utf-8") as f:
        spelled = json.load(f)["model"]["vocab"]
    words = (w.removesuffix("</w>").lower() for w in spelled)
    return frozenset(w for w in words if 4 <= len(w) <= 12 and w.isascii() and w.isalpha())


def covered(value: str, words: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, longest first from the left."""
    value, at, hit = value.lower(), 0, 0
    while at < len(value):
        for size in range(min(12, len(value) - at), 3, -1):
            if value[at:at + size] in words:
                hit += size
                at += size
                break
        else:
            at += 1
    return hit / max(1, len(value))


def kinds_of(value: str) -> str:
    return "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "/" if c in "/." else "-"
                   for c in value)


def parts(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """What is judged of a candidate: the whole or, of a long one, parts that cover all of it."""
    if end - start <= WINDOW:
        return [(start, end)]
    step = WINDOW // 2
    out = {(a, min(a + WINDOW, end)) for a in range(start, end - step, step)}
    return sorted(out | {m.span() for m in SEGMENT.finditer(text, start, end) if m.end() - m.start() <= WINDOW})


def features(text: str, start: int, end: int, words: frozenset[str], part: tuple[int, int] | None = None) -> list[float]:
    """Numbers of a candidate, or of a part of it in the candidate's surroundings."""
    value = text[slice(*part)] if part else text[start:end]
    kinds, size = kinds_of(value), max(1, len(value))
    pairs = Counter(zip(kinds, kinds[1:]))
    steps = max(1, size - 1)
    letters = Counter(value)
    before, behind = text[max(0, start - 40):start], text[end:end + 20]
    vowels = sum(c in "aeiouyAEIOUY" for c in value)
    return [
        min(len(value), 500), *(kinds.count(k) / size for k in "aA0/-"),
        pairs["a", "a"] / steps, pairs["A", "A"] / steps, pairs["0", "0"] / steps,
        (pairs["a", "0"] + pairs["0", "a"] + pairs["A", "0"] + pairs["0", "A"]) / steps,
        pairs["a", "A"] / steps, pairs["A", "a"] / steps,
        -sum(n / size * math.log2(n / size) for n in letters.values()), len(letters) / size,
        covered(value, words), vowels / size, all(c in "0123456789abcdef" for c in value),
        value.count("/"), value.count("."), "://" in before, bool(UUID.fullmatch(value)),
        bool(KEY.search(before)), before.rstrip("\"' ")[-1:] in ("=", ":"), behind[:1] in ("\"", "'"), behind[:1] == "@",
        bool(HARMLESS.search(before[-15:])), bool(DUMMY.search(value)), bool(KNOWN.match(value)),
        bool(PUBLIC.search(before)), bool(NAMED_DIGEST.match(text, start)), text.startswith("-----BEGIN", start),
        "PRIVATE KEY-----" in text[start:start + 60], value.count(" "), "phrase" in before.lower(),
        max((len(w) for w in re.findall(r"[a-z]+|[A-Z]+", value)), default=0)]


def frames(text: str) -> list[tuple[int, int]]:
    """Keys from the line that begins them to the one that ends them; one without an end is none."""
    out, at = [], 0
    while head := FRAME.search(text, at):
        end = text.find("-----END ", head.end())
        close = text.find("-----", end + 9) if end >= 0 else -1
        if close < 0:
            break
        at = close + 5
        out.append((head.start(), at))
    return out


def _apart(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of the taken ones; both in order."""
    out, n = [], 0
    for start, end in spans:
        while n < len(taken) and taken[n][1] <= start:
            n += 1
        if n == len(taken) or taken[n][0] >= end:
            out.append((start, end))
    return out


def _outside(spans: list[tuple[int, int]], framed: list[tuple[int, int]], least: int = 6) -> list[tuple[int, int]]:
    """What lies of the spans between the frames, if it has ``least`` characters."""
    out, n = [], 0
    for start, end in spans:
        while n < len(framed) and framed[n][1] <= start:
            n += 1
        k = n
        while k < len(framed) and framed[k][0] < end:
            if framed[k][0] - start >= least:
                out.append((start, framed[k][0]))
            start = framed[k][1]
            k += 1
        if end - start >= least:
            out.append((start, end))
    return out


def candidates(text: str) -> list[tuple[int, int]]:
    """Starts and ends of candidate values, in order, without overlap; framed keys come before assigned values, these before runs.

    Runs have 16 characters and more (6 behind an ``=`` in a run), assigned values 8, values of logins in addresses 6,
    behind a user name of up to 64; shorter ones are no candidates.
    """
    spans = []
    for m in RUN.finditer(text):
        start = m.start()
        for cut in VALUE.finditer(text, *m.span()):
            if cut.end() < m.end():
                if cut.start() - start >= 16:
                    spans.append((start, cut.start()))
                start = cut.end()
        if m.end() - start >= (16 if start == m.start() else 6):
            spans.append((start, m.end()))
    lower = text.lower()
    if any(root in lower for root in ROOTS):
        given = []
        for m in ASSIGNED.finditer(text):
            start, end = m.span(m.lastgroup)
            # a name before a known form isn't part of the value
            given.append((next((c.end() for c in VALUE.finditer(text, start, end) if KNOWN.match(text, c.end(), end)), start), end))
        spans = sorted(given + _apart(spans, given))
    framed = frames(text)
    spans = sorted(framed + _outside(spans, framed)) if framed else spans
    out = []
    for start, end in spans:
        if text.startswith("-----BEGIN", start):
            out.append((start, end))
            continue
        end = start + len(text[start:end].rstrip(".-!?)"))
        if end - start >= 6:
            out.append((start, end))
    return out


@lru_cache(2)
def trained(dictionary_file: str, count: int = TRAINING_FINDINGS) -> forest.Forest:
    words = dictionary(dictionary_file)
    rows = [(t, a, b, p, secret) for t, a, b, secret in findings(count) for p in parts(t, a, b)[:TRAINING_PARTS]]
    return forest.train(np.array([features(t, a, b, words, p) for t, a, b, p, _ in rows], dtype=np.float64),
                        np.array([secret for *_, secret in rows]))


def _scanned(model: forest.Forest, file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary(file)
        for whole in batches:
            for begin in range(0, whole.num_rows, 500):
                part = whole.slice(begin, 500)
                texts = part.column("text").to_pylist()
                found = [(n, a, b) for n, t in enumerate(texts) for a, b in candidates(t or "")]
                judged = [(k, p) for k, (n, a, b) in enumerate(found) for p in parts(texts[n], a, b)]
                share = np.zeros(len(found))  # the highest of a candidate's parts, which the more parts must be the surer
                several = np.sqrt(np.bincount([k for k, _ in judged], minlength=len(found)))
                for start in range(0, len(judged), PARTS):
                    some = judged[start:start + PARTS]
                    rows = [features(texts[found[k][0]], *found[k][1:], words, p) for k, p in some]
                    np.maximum.at(share, [k for k, _ in some], model.predict(np.array(rows, dtype=np.float64)))
                share = np.maximum(1 - (1 - share) * several, 0)
                spans: list[list[dict]] = [[] for _ in texts]
                for (n, a, b), p in zip(found, share.tolist()):
                    spans[n].append({"start": a, "length": b - a, "probability": p, "secret": p >= IS_SECRET})
                clean = []
                for text, own in zip(texts, spans):
                    at, kept = 0, []
                    for s in own:
                        if s["secret"]:
                            kept += [text[at:s["start"]], REPLACEMENT]
                            at = s["start"] + s["length"]
                    clean.append("".join([*kept, text[at:]]) if kept else text)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("probability", pa.float64()),
                                           ("secret", pa.bool_())]))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(clean, pa.string()), pa.array(spans, kind)],
                    names=[*part.schema.names[1:], "clean", "findings"])
    return run


def scan(df: DataFrame, text_column: str, dictionary_file: str) -> DataFrame:
    """Add ``findings`` (start, length, probability, secret; in code points) and ``clean``, the text without secrets.

    A candidate of any length is judged as a whole or by parts that cover it.  The highest share of n parts counts for all of
    it, its distance from 1 taken square root of n times, so that long candidates aren't found for their length.
    A missing text has no findings and stays missing.  Repeated rows are scanned alike, an empty table stays
    empty, other columns pass; a column of one of the new names raises.
    """
    if {"findings", "clean"} & set(df.columns):
        raise ValueError("column findings or clean is there already")
    own = [f"c{n}" for n in range(len(df.columns))]
    read = df.select(F.col(text_column).alias("text"), *[df[c].alias(o) for c, o in zip(df.columns, own)])
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in read.schema.fields[1:])
    out = read.mapInArrow(_scanned(trained(dictionary_file), dictionary_file),
                          f"{kinds}clean string, findings array<struct<start:bigint,length:bigint,probability:double,secret:boolean>>")
    return out.select(*[F.col(o).alias(c) for c, o in zip(df.columns, own)], "findings", "clean")
