"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For every bit a binary classifier over hashed character n-grams says on
which side of it a text lies.  Loss-weighted decoding sums, for every codeword, the losses of all classifiers,
each weighted by how well it did for that language on rows it didn't learn from; the codeword with the least
loss wins.  A text whose bits lie farther from the winner than the code can correct, or whose runner-up is close,
is flagged as ambiguous.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.tables import aside

#: Labelled documents that the classifiers learn from, in all, and languages, the most frequent ones.
TRAINING_ROWS, MAX_LANGUAGES = 2400, 128
#: Hashed n-grams, and characters that are counted at once.
WIDTH, SLAB = 4096, 1 << 20
#: Up to so many languages every possible split is a bit; beyond, this many random ones per bit of the language's number.
EXHAUSTIVE, BITS_PER_BIT = 6, 12
#: A runner-up whose share is this close to the winner's makes a text ambiguous.
MARGIN = 0.2
UNKNOWN = "und"
RESULTS = ("lang_pred", "score", "runner_up", "ambiguous")
LETTER = re.compile(r"[^\W\d_]")
SPACE = 32


def _letters() -> np.ndarray:
    """Which code points are letters; those beyond the first plane are all taken as letters."""
    return np.array([chr(c).isalpha() for c in range(1 << 16)] + [True])


LETTERS = _letters()
#: Odd multipliers of the three n-gram hashes.
ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text))


def ngram_counts(text: str, width: int = WIDTH) -> np.ndarray:
    """Counts of hashed runs of one to three letters, blanks between words included, over the whole text."""
    out = np.zeros(width, dtype=np.int64)
    shift = np.uint32(32 - (width.bit_length() - 1))
    for start in range(0, len(text), SLAB):  # two letters meet again, so that no run is lost between two slabs
        part = text[max(start - 2, 0):start + SLAB].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = np.where(LETTERS[np.minimum(codes, 1 << 16)], codes, SPACE).astype(np.uint32)
        codes = codes[np.concatenate([[True], (codes[1:] != SPACE) | (codes[:-1] != SPACE)])]
        codes = np.concatenate([[SPACE], codes, [SPACE]]).astype(np.uint32)
        one = codes * ODD[0]
        two = (one[:-1] ^ (codes[1:] >> np.uint32(1))) * ODD[1] + codes[1:]
        three = (two[:-1] ^ codes[2:]) * ODD[2] + codes[2:]
        for grams in (one, two * ODD[0], three * ODD[0]):
            out += np.bincount((grams >> shift).astype(np.int64), minlength=width)
    return out


def features(texts: list[str], width: int = WIDTH) -> np.ndarray:
    """Square roots of the counts, of length one; zeros for an empty text."""
    rows = np.zeros((len(texts), width), dtype=np.float32)
    for n, text in enumerate(texts):
        if text:
            rows[n] = np.sqrt(ngram_counts(text, width))
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def codewords(languages: int, seed: int = 3) -> np.ndarray:
    """Languages x bits of -1 and 1, different for all languages, no bit constant, no two bits alike or opposite.

    Few languages get every split; more get the random code with the largest least distance of some tries.
    """
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (languages - 1))
        return np.stack([np.ones(len(splits)), *(1.0 - 2 * (splits >> k & 1) for k in range(languages - 1))])
    draw, best, least = np.random.default_rng(seed), None, -1.0
    bits = BITS_PER_BIT * (languages - 1).bit_length()
    for _ in range(50):
        code = draw.choice((-1.0, 1.0), size=(languages, bits))
        code[0] = 1.0  # a bit and its opposite are the same split
        code = np.unique(code[:, (code != 1.0).any(axis=0)], axis=1)
        apart = _distances(code, code) + np.eye(languages) * bits
        if apart.min() > least:
            best, least = code, float(apart.min())
    return best


def _distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (one.shape[1] - one @ two.T) / 2


@dataclass
class Codes:
    """Codewords of the languages, a linear classifier per bit, and the classifiers' weights for each language."""

    languages: list[str]
    code: np.ndarray  # languages x bits
    lines: np.ndarray  # features x bits
    offsets: np.ndarray  # bits
    weights: np.ndarray  # languages x bits, a distribution for each language

    def decode(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """From bit values: best and second language (numbers), the best one's share, whether it is ambiguous."""
        losses = np.logaddexp(0, -self.code[None] * values[:, None, :])
        totals = (losses * self.weights[None]).sum(axis=2) * max(self.code.shape[1], 1)
        shares = np.exp(totals.min(axis=1, keepdims=True) - totals)
        shares /= shares.sum(axis=1, keepdims=True)
        order = np.argsort(totals, axis=1, kind="stable")
        best, second = order[:, 0], order[:, min(1, len(self.languages) - 1)]
        rows = np.arange(len(values))
        apart = _distances(self.code, self.code) + np.eye(len(self.languages)) * (self.code.shape[1] + 1)
        correctable = (apart.min() - 1) // 2 if len(self.languages) > 1 else 0
        off = (np.where(values >= 0, 1.0, -1.0) != self.code[best]).sum(axis=1)
        close = (best != second) & (shares[rows, best] - shares[rows, second] < MARGIN)
        return best, second, shares[rows, best], close | (off > correctable)

    def predict(self, texts: list[str]) -> list[tuple[str, float, str | None, bool]]:
        if not self.languages:
            return [(UNKNOWN, 0.0, None, False)] * len(texts)
        best, second, share, unclear = self.decode(features(texts) @ self.lines + self.offsets)
        return [(self.languages[b], round(float(s), 6), self.languages[c] if c != b else None, bool(u)) if has_letter(t)
                else (UNKNOWN, 0.0, None, False) for t, b, c, s, u in zip(texts, best, second, share, unclear)]


def train(rows: np.ndarray, labels: list[str], rounds: int = 30, seed: int = 5) -> Codes:
    """A logistic classifier for every bit, fitted together by Adam over small batches.

    A fifth of the rows of each language only serves to weigh the classifiers.  Equal losses go to the language
    that comes first in order.
    """
    languages = sorted(set(labels))
    code = codewords(len(languages))
    number = np.array([languages.index(y) for y in labels], dtype=np.int64)
    lines, offsets = np.zeros((rows.shape[1] if len(rows) else WIDTH, code.shape[1])), np.zeros(code.shape[1])
    weights = np.full(code.shape, 1 / max(code.shape[1], 1))
    if not code.shape[1]:
        return Codes(languages, code, lines, offsets, weights)
    turn = np.zeros(len(rows), dtype=np.int64)
    for k in range(len(languages)):
        turn[number == k] = np.arange((number == k).sum())
    kept = turn % 5 == 4
    fit = np.flatnonzero(~kept)
    draw, step = np.random.default_rng(seed), 0
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (lines, offsets)]
    for at in range(rounds):
        for part in np.array_split(draw.permutation(fit), max(1, len(fit) // 64)):
            x, want = rows[part], code[number[part]]
            wrong = want / (1 + np.exp(np.clip(want * (x @ lines + offsets), -30, 30)))
            step += 1
            for value, gradient, (mean, square) in zip(
                    (lines, offsets), (x.T @ wrong / len(part) - 1e-5 * lines, wrong.mean(axis=0)), state):
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient ** 2 - square)
                value += 0.1 * (1 - at / rounds) * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    right = (np.where(rows @ lines + offsets >= 0, 1.0, -1.0) == code[number])
    for k in range(len(languages)):
        seen = right[(number == k) & kept]
        share = (seen.sum(axis=0) + 1) / (len(seen) + 2)  # a classifier that no row speaks for counts half
        weights[k] = share / share.sum()
    return Codes(languages, code, lines.astype(np.float32), offsets.astype(np.float32), weights)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of every different text of a task; as texts are drawn by ticket, there are about as many as wanted."""
    seen: set[tuple[str, int]] = set()
    for part in batches:
        keys = list(zip(part.column("lang").to_pylist(), part.column("ticket").to_pylist()))
        new = {key: n for n, key in enumerate(keys) if key not in seen}
        seen.update(new)
        texts = part.column("text")
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[n] for k in new], kind) for n, kind in ((0, pa.string()), (1, pa.int64()))]
            + [pa.array([ngram_counts(texts[n].as_py()).astype("<f4").tobytes() for n in new.values()], pa.binary())],
            names=["lang", "ticket", "counts"])


def fit(docs: DataFrame, text_column: str, lang_column: str, learn: Column, rows: int = TRAINING_ROWS,
        languages: int = MAX_LANGUAGES) -> Codes:
    """Learn from a bounded sample of the documents for which ``learn`` holds: about ``rows`` in all, evenly by language.

    Texts are drawn by a hash of language and text, so a text that repeats counts once, however often it does.
    Rows without a language or a letter teach nothing; only the ``languages`` most frequent ones are learned
    (by different texts, then by name).  What reaches the driver are ``WIDTH`` counts for each row, of whole texts.
    """
    ticket = F.xxhash64(lang_column, text_column)
    usable = docs.where(learn & F.col(lang_column).isNotNull() & F.col(text_column).rlike(r"\p{L}")).select(
        F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), ticket.alias("ticket"))
    found = usable.groupBy("lang").agg(F.approx_count_distinct("ticket").alias("texts")).orderBy(
        F.desc("texts"), "lang").limit(languages).collect()
    if not found:
        return train(np.zeros((0, WIDTH)), [])
    each = max(rows // len(found), 1)
    # a ticket is drawn if its place among 2^20 lies below the language's share
    share = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], int((1 << 20) * min(1.0, each / max(r["texts"], 1))) + 1)])
    drawn = usable.where(F.pmod(F.col("ticket"), F.lit(1 << 20)) < F.try_element_at(share, F.col("lang")))
    counted = drawn.mapInArrow(_featured, "lang string, ticket long, counts binary").groupBy("lang", "ticket").agg(
        F.min("counts").alias("counts"))
    sample = counted.orderBy(F.xxhash64("ticket", F.lit("order"))).limit(2 * rows).collect()
    sample = sorted((r["lang"], r["ticket"], r["counts"]) for r in sample)
    made = np.sqrt(np.stack([np.frombuffer(c, dtype="<f4") for *_, c in sample]))
    return train(made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9), [lang for lang, *_ in sample])


def _predicted(codes: Codes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                part = whole.slice(start, 500)
                found = list(zip(*codes.predict(part.column("text").to_pylist())))
                arrays = [pa.array(values, kind) for values, kind in
                          zip(found, (pa.string(), pa.float64(), pa.string(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *arrays], names=[*part.schema.names[1:], *RESULTS])
    return run


def identify(df: DataFrame, text_column: str, codes: Codes) -> DataFrame:
    """Add ``lang_pred``, ``score`` (the share of the winner, 0 to 1), ``runner_up`` and ``ambiguous`` for whole texts.

    A text that is missing or has no letter is ``und`` with score 0, and so is every text if no language was learned;
    with one language all others get it with score 1.  Repeated rows get the same answer, an empty table stays empty.
    A column that has the name of a new one goes on with ``_in`` behind its name.
    """
    own = [f"c{n}" for n in range(len(df.columns))]
    rows = df.toDF(*own)
    read = rows.select(F.coalesce(F.col(own[df.columns.index(text_column)]), F.lit("")).alias("text"), *own)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    out = read.mapInArrow(_predicted(codes), f"{kinds}, lang_pred string, score double, runner_up string, ambiguous boolean")
    return out.select(*[F.col(o).alias(aside(c, RESULTS)) for o, c in zip(own, df.columns)], *RESULTS)
