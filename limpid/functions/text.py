"""Text expressions with Python's string semantics."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove all Unicode whitespace at both ends, tabs, no-break spaces and separator controls included."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def title(text: Column) -> Column:
    """Upper case after every character that is not a letter, lower case elsewhere."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def capitalize(text: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(text.substr(F.lit(2), F.length(text))))


CASES = {"lower": F.lower, "upper": F.upper, "title": title, "capitalize": capitalize}


def java_replacement(replacement: str) -> str:
    r"""A regex replacement written with ``\1`` / ``\g<1>`` / ``\g<name>`` groups, in Java's ``$1`` form."""
    out, i = [], 0
    for m in re.finditer(r"\\g<(\w+)>|\\(\d{1,2})|\\(.)", replacement):
        out.append(_plain(replacement[i:m.start()]))
        group = m.group(1) or m.group(2)
        if group is not None:
            out.append("$" + group if group.isdigit() else "${" + group + "}")
        else:
            out.append(_plain({"n": "\n", "t": "\t", "r": "\r"}.get(m.group(3), m.group(3))))
        i = m.end()
    out.append(_plain(replacement[i:]))
    return "".join(out)


def _plain(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def java_pattern(pattern: str) -> str:
    """Named groups are the one everyday spelling that differs between the two regex dialects."""
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def matches_from_start(text: Column, pattern: str) -> Column:
    """Whether the pattern matches at the start of the text; missing text does not."""
    return F.coalesce(text.rlike("^(?:" + java_pattern(pattern) + ")"), F.lit(False))
