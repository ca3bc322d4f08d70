"""Document quality from a chain of line labels.

A linear-chain conditional random field labels every line good or bad from features of the line and of its
neighbours.  The probability that a line is good, weighted by its length, makes the document's score.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limpid.llm import crf
from limpid.llm.labelled import fold, sample

#: Labelled documents for training, at most about so many, and the lines of each: a window at a place its hash tells.
TRAINING_DOCUMENTS, TRAINING_LINES = 2500, 80
THRESHOLD = 0.3
#: Characters are counted by class; those from WIDE on are letters of other scripts.
WIDE = 0x250
OTHER, LOWER, UPPER, DIGIT, SPACE, MARK, SYMBOL, STOP = range(8)


def _classes() -> np.ndarray:
    out = np.full(WIDE + 1, OTHER, dtype=np.int64)
    for code in range(WIDE):
        c = chr(code)
        out[code] = (UPPER if c.isupper() else LOWER if c.isalpha() else DIGIT if c.isdigit() else SPACE if c.isspace()
                     else MARK if c in "!?" else SYMBOL if c in "#*$%&|<>=_~^{}[]\\/@+" else STOP if c in ".,;:'\"()-"
                     else OTHER)
    return out


CLASSES = _classes()
OWN = 14


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of every line (own, before, after, one constant) and the lines' lengths; blank lines weigh 0."""
    lines = text.split("\n")
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    number = np.cumsum(codes == 10)
    number[codes == 10] -= 1
    counts = np.bincount(number * 8 + CLASSES[np.minimum(codes, WIDE)], minlength=8 * len(lines))
    counts = counts.reshape(len(lines), 8).astype(np.float64)
    counts[:-1, SPACE] -= 1  # the line break itself
    words = np.empty((len(lines), 3))
    seen: set[str] = set()
    again = np.zeros(len(lines))
    for n, line in enumerate(lines):
        parts = line.split()
        words[n] = len(parts), len(set(parts)), sum(map(eq, parts, parts[1:]))
        if parts:
            again[n] = line in seen
            seen.add(line)
    shown = counts.sum(axis=1) - counts[:, SPACE]
    per_char, per_word = 1 / np.maximum(shown, 1), 1 / np.maximum(words[:, 0], 1)
    own = np.stack([
        *(np.minimum(counts[:, c] * per_char * scale, 2) for c, scale in
          ((UPPER, 2), (DIGIT, 3), (MARK, 8), (SYMBOL, 8), (STOP, 5), (OTHER, 3))),
        np.minimum(shown * per_word / 8, 3), np.log1p(words[:, 0]) / 4, words[:, 1] * per_word,
        words[:, 2] * per_word * 2, again, shown == 0, words[:, 0] < 5, words[:, 0] > 60], axis=1)
    out = np.zeros((len(lines), 3 * OWN + 3))
    out[:, :OWN] = own
    out[1:, OWN:2 * OWN] = own[:-1]
    out[:-1, 2 * OWN:3 * OWN] = own[1:]
    out[0, -3] = out[-1, -2] = 1
    out[:, -1] = 1
    return out, shown


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        made = []
        for order, text in zip(part.column("order").to_pylist(), part.column("text").to_pylist()):
            found = line_features(text or "")[0].astype("<f4")
            start = order % max(len(found) - TRAINING_LINES + 1, 1)
            made.append(found[start:start + TRAINING_LINES])
        yield pa.RecordBatch.from_arrays(
            [part.column("order"), part.column("label"), pa.array([len(m) for m in made], pa.int64()),
             pa.array([m.tobytes() for m in made], pa.binary())],
            names=["order", "label", "lines", "features"])


def fit(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str,
        documents: int = TRAINING_DOCUMENTS) -> crf.Chain:
    """Train on a bounded sample of the labelled documents outside the held-out fold; lines inherit the label.

    Of a document of more than ``TRAINING_LINES`` lines a window of so many is learned from, at a place that a hash
    of the id tells, with the features its lines have in the whole text; that bounds what reaches the driver.
    """
    chosen = sample(docs, labels, id_column, text_column, label_column, documents)
    rows = (chosen.select(F.xxhash64("id").alias("order"), F.col("label").cast("int").alias("label"), "text")
            .mapInArrow(_featured, "order long, label int, lines long, features binary").collect())
    rows = sorted(rows, key=lambda r: (r["order"], r["label"], r["lines"], bytes(r["features"])))
    xs = [np.frombuffer(r["features"], dtype="<f4").reshape(r["lines"], -1).astype(np.float64) for r in rows]
    if not xs:
        width = 3 * OWN + 3
        return crf.Chain(np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2))
    return crf.train(xs, [np.full(len(x), r["label"], dtype=np.int64) for x, r in zip(xs, rows)], rounds=12)


def _scored(chain: crf.Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                part = whole.slice(start, 200)
                found = [line_features(t) for t in part.column("text").to_pylist()]
                good = chain.marginals([f[0] for f in found])
                scores = [float(np.clip((m[:, 1] * w).sum() / w.sum(), 0, 1)) if w.sum() else 0.0
                          for m, (_, w) in zip(good, found)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(scores, pa.float64())],
                                                 names=[*part.schema.names[1:], "score"])
    return run


def score(df: DataFrame, text_column: str, chain: crf.Chain) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (int) for every whole text.

    A missing, empty or blank text scores 0.  Repeated rows score alike, an empty table stays empty, other
    columns pass; a column of one of the new names raises.
    """
    if {"score", "predicted"} & set(df.columns):
        raise ValueError("column score or predicted is there already")
    own = [f"c{n}" for n in range(len(df.columns))]
    read = df.select(F.coalesce(F.col(text_column), F.lit("")).alias("text"),
                     *[df[c].alias(o) for c, o in zip(df.columns, own)])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[1:])
    out = read.mapInArrow(_scored(chain), f"{kinds}, score double")
    return out.select(*[F.col(o).alias(c) for c, o in zip(df.columns, own)], "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(id_column: str):
    return fold(id_column) == 0
