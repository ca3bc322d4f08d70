"""Text statistics in Spark expressions and decision lists learned from them.

Sequential covering: a rule is grown condition by condition on two thirds of the labelled rows (highest gain of
information for the documents it covers), pruned from its end on the last third, and kept if it is precise
there; the documents it covers are then taken out and the next rule is learned.  The ordered rules become one
Spark ``CASE`` expression over the statistics, so applying them reads each document once and shuffles nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limpid.llm.labelled import sample

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Ratios that rules may test, from the counts.
FEATURES = {
    "words": "cast(n_words AS double)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
#: Labelled documents that rules are learned from, at most about so many.
TRAINING_ROWS = 6000
MAX_RULES, MAX_CONDITIONS, MAX_THRESHOLDS = 12, 4, 24
#: A rule stays if it is right this often on the pruning rows and covers so many rows in all.
MIN_PRECISION, MIN_COVERED = 0.95, 8


def _chars_in(text: str, letters: str) -> str:
    escaped = letters.replace("\\", "\\\\").replace("'", "\\'")
    return f"length({text}) - length(translate({text}, '{escaped}', ''))"


def text_statistics(df: DataFrame, text_column: str) -> DataFrame:
    """Add the counts over whole texts (all long); a missing text counts as empty.

    Words are runs without blanks; ``n_dup_lines`` counts lines with a word that equal an earlier line,
    ``n_repeat_words`` the words in three-word windows that occur twice or more.  The helper columns begin
    with ``_s_``; a column of one of the counts' names raises.
    """
    taken = {"n_words", "n_lines", "n_marks", "n_upper", "n_distinct_words", *COUNTS} & set(df.columns)
    if taken:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    out = df.withColumn("_s_text", F.coalesce(F.col(text_column), F.lit("")))
    out = out.withColumn("_s_trim", F.btrim("_s_text", F.lit(SPACES)))
    out = out.withColumns({
        "_s_words": F.when(F.col("_s_trim") == "", F.array().cast("array<string>"))
        .otherwise(F.split("_s_trim", r"[\x20\x09-\x0D]+")),
        "_s_lines": F.filter(F.split("_s_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))})
    out = out.withColumn("_s_windows", F.expr(
        "CASE WHEN size(_s_words) < 4 THEN cast(array() AS array<bigint>) ELSE transform("
        "sequence(0, size(_s_words) - 3), i -> xxhash64(_s_words[i], _s_words[i + 1], _s_words[i + 2])) END"))
    # equal windows meet by sorting (window, place); documents without any are spared it
    out = out.withColumn("_s_sorted", F.expr(
        "CASE WHEN size(array_distinct(_s_windows)) < size(_s_windows) THEN "
        "array_sort(transform(_s_windows, (w, i) -> struct(w AS w, i AS i))) END"))
    counts = {
        "n_words": F.size("_s_words").cast("long"),
        "word_chars": F.length(F.translate("_s_text", SPACES, "")).cast("long"),
        "n_symbols": F.expr(_chars_in("_s_text", SYMBOLS)).cast("long"),
        "n_marks": F.expr(_chars_in("_s_text", "!?")).cast("long"),
        "n_upper": F.expr("length(_s_text) - length(regexp_replace(_s_text, '\\\\p{Lu}+', ''))").cast("long"),
        "n_lines": F.size("_s_lines").cast("long"),
        "n_dup_lines": (F.size("_s_lines") - F.size(F.array_distinct("_s_lines"))).cast("long"),
        "n_distinct_words": F.size(F.array_distinct("_s_words")).cast("long"),
        "n_repeat_words": F.expr(
            "CASE WHEN _s_sorted IS NULL THEN 0 ELSE size(array_distinct(flatten(filter(zip_with("
            "slice(_s_sorted, 1, size(_s_sorted) - 1), slice(_s_sorted, 2, size(_s_sorted) - 1), (a, b) -> "
            "CASE WHEN a.w = b.w THEN array(a.i, a.i + 1, a.i + 2, b.i, b.i + 1, b.i + 2) END), "
            "x -> x IS NOT NULL)))) END").cast("long")}
    # a one-row generator: a filter on a count is not pushed below it, where it would repeat the work per word
    return out.select(*[df[c] for c in df.columns], F.inline(F.array(F.struct(*[e.alias(n) for n, e in counts.items()]))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def expression(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict[str, float]) -> bool:
    return all(c.holds(row) for c in rule)


def _thresholds(bad: list[float], good: list[float]) -> list[float]:
    """Middles between neighbouring values where the class changes; at even steps, with both ends, if there are many."""
    seen: dict[float, int] = {}
    for values, mark in ((bad, 1), (good, 2)):
        for v in values:
            seen[v] = seen.get(v, 0) | mark
    values = sorted(seen)
    middles = [(a + b) / 2 for a, b in zip(values, values[1:]) if seen[a] == 3 or seen[a] != seen[b]]
    if len(middles) <= MAX_THRESHOLDS:
        return middles
    return [middles[round(n * (len(middles) - 1) / (MAX_THRESHOLDS - 1))] for n in range(MAX_THRESHOLDS)]


def _grow(bad: list[dict], good: list[dict]) -> Rule:
    """Add the condition with the highest gain until no good row is covered or nothing is gained."""
    rule: Rule = ()
    while good and bad and len(rule) < MAX_CONDITIONS:
        before = math.log2(len(bad) / (len(bad) + len(good)))
        best, gain = None, 1e-9
        for feature in FEATURES:
            of_bad, of_good = [r[feature] for r in bad], [r[feature] for r in good]
            for threshold in _thresholds(of_bad, of_good):
                over = sum(v > threshold for v in of_bad), sum(v > threshold for v in of_good)
                for above, (p, n) in ((True, over), (False, (len(bad) - over[0], len(good) - over[1]))):
                    if p and p * (math.log2(p / (p + n)) - before) > gain:
                        gain = p * (math.log2(p / (p + n)) - before)
                        best = Condition(feature, above, threshold)
        if best is None:
            break
        rule = (*rule, best)
        bad, good = [r for r in bad if best.holds(r)], [r for r in good if best.holds(r)]
    return rule


def _worth(rule: Rule, rows: list[tuple[dict, bool]]) -> float:
    hit = [bad for row, bad in rows if covers(rule, row)]
    return (2 * sum(hit) - len(hit)) / max(len(hit), 1)


def learn_rules(rows: list[tuple[dict[str, float], bool]]) -> list[Rule]:
    """Ordered rules for bad documents from (features, is bad); none if one class is missing."""
    grow = [r for n, r in enumerate(rows) if n % 3]
    prune = [r for n, r in enumerate(rows) if not n % 3]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule = _grow([r for r, bad in grow if bad], [r for r, bad in grow if not bad])
        while len(rule) > 1 and _worth(rule[:-1], prune) >= _worth(rule, prune):
            rule = rule[:-1]
        hit = [bad for row, bad in prune if rule and covers(rule, row)]
        all_hit = [bad for row, bad in grow + prune if rule and covers(rule, row)]
        if len(all_hit) < MIN_COVERED or sum(all_hit) < MIN_PRECISION * len(all_hit) \
                or hit and sum(hit) < MIN_PRECISION * len(hit):
            break
        rules.append(rule)
        grow = [(r, bad) for r, bad in grow if not covers(rule, r)]
        prune = [(r, bad) for r, bad in prune if not covers(rule, r)]
    return rules


def rule_number(rules: list[Rule]) -> Column:
    """The first rule (from 1) that covers a document, or NULL: an ordered Spark conditional expression."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        condition = rule[0].expression()
        for more in rule[1:]:
            condition = condition & more.expression()
        out = F.when(condition, F.lit(number)).otherwise(out)
    return out


def fit_rules(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str,
              rows: int = TRAINING_ROWS) -> list[Rule]:
    """Learn from a bounded sample of the labelled documents (label 0 is bad) outside the held-out fold."""
    chosen = sample(docs, labels, id_column, text_column, label_column, rows)
    stats = text_statistics(chosen, "text").where(f"NOT ({BASE_FAILED})")
    found = stats.select(F.xxhash64("id").alias("order"), F.col("label") == 0,
                         *[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()]).collect()
    return learn_rules([({n: r[n] for n in FEATURES}, r[1]) for r in sorted(found)])


def judge(df: DataFrame, text_column: str, rules: list[Rule]) -> DataFrame:
    """Add the counts, ``base_failed``, ``rule`` (the first that rejects, or NULL) and ``kept``.

    A missing or empty text has no words, so it fails the base test.  Repeated rows are judged alike, an empty
    table stays empty, other columns pass; a column of one of the new names raises.
    """
    taken = {"base_failed", "rule", "kept"} & set(df.columns)
    if taken:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    stats = text_statistics(df, text_column)
    return (stats.withColumns({"base_failed": F.expr(BASE_FAILED), "rule": rule_number(rules)})
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
            .drop("n_marks", "n_upper", "n_lines", "n_distinct_words"))
