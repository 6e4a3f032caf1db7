"""Text rules: lengths, flags, LIKE search and the word tokeniser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chanlytics.functions._util import as_col

# A word is a run of Unicode letters, digits and underscores (Python's
# Unicode ``\w``).  Java's ``\w`` is ASCII-only, so it is spelled out.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"


def message_length(text: "Column | str") -> Column:
    """Code points of the text, NULL -> 0."""
    return F.length(F.coalesce(as_col(text), F.lit(""))).cast("int")


def contains_ci(text: "Column | str", needle: str) -> Column:
    """Case-insensitive substring test that is FALSE (not NULL) on NULL text."""
    return F.coalesce(
        F.lower(as_col(text)).contains(needle.lower()), F.lit(False))


def like_ci(text: "Column | str", query: str, literal: bool = False) -> Column:
    """``lower(text) LIKE '%query%'``.

    As in the reference the user's ``%`` and ``_`` stay wildcards, and a
    backslash makes the character after it plain (at the end of the query
    that is the closing ``%``); with ``literal=True`` the query is matched as
    plain text instead.
    """
    lowered = F.lower(as_col(text))
    q = query.lower()
    if literal:
        return lowered.contains(q)
    return lowered.like(_like_pattern("%" + q + "%"))


def _like_pattern(pattern: str) -> str:
    """The same pattern with backslashes only where Spark's LIKE allows them."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            c = "\\" + pattern[i] if pattern[i] in "%_\\" else pattern[i]
        out.append(c)
        i += 1
    return "".join(out)


def like_runs(query: str, literal: bool = False) -> list[str]:
    """The runs of plain characters that every lower-cased text holds which ``like_ci`` finds."""
    if literal:
        return [query.lower()]
    runs, pattern, i = [""], _like_pattern("%" + query.lower() + "%"), 0
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            i += 1
            runs[-1] += pattern[i]
        elif pattern[i] in "%_":
            runs.append("")
        else:
            runs[-1] += pattern[i]
        i += 1
    return [r for r in runs if r]


def tokens(lower_text: "Column | str") -> Column:
    """Array of the words of an already lower-cased text."""
    return F.regexp_extract_all(as_col(lower_text), F.lit(TOKEN_PATTERN), 0)
