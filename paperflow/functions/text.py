"""Scalar text expressions (X1, X2, X10-X19). All are built-in Spark expressions,
so they stay inside whole-stage codegen; none needs a Python UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source application's behavior.
CONTROL_CHARS = "[\\x00-\\x08\\x0b-\\x0c\\x0e-\\x1f\\x7f-\\x9f]"  # deleted by the cleaner
_CONTROL = "".join(chr(c) for c in range(0xa0) if re.match(CONTROL_CHARS, chr(c)))
TITLE_CHARS = 100      # export truncation of titles
OVERVIEW_CHARS = 200   # export truncation of overviews
BODY_CHARS = 500       # export truncation of summaries and abstract
MODEL_TEXT_CHARS = 15000  # page text passed to the model
AUTHORS_SHOWN = 3
CATEGORIES_SHOWN = 3

# Python's \s for str patterns (str.isspace), spelled out so Java needs no (?U) mode.
PY_SPACE = ("[\\t\\n\\x0b\\f\\r \\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a"
            "\\u2028\\u2029\\u202f\\u205f\\u3000]")
# The same set as literal characters, for trim(str, chars).
PY_SPACE_CHARS = ("\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200b))
                  + "\u2028\u2029\u202f\u205f\u3000")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(text) -> Column:
    """Remove leading/trailing Unicode whitespace (``str.strip()``). Plain ``trim`` only
    drops spaces; trimming a character set touches only the ends (no regex scan)."""
    return F.trim(_c(text), F.lit(PY_SPACE_CHARS))


def drop_invalid_utf8(text) -> Column:
    """Drop bytes that are not valid UTF-8 (valid strings pass through untouched)."""
    t = _c(text)
    return F.when(F.is_valid_utf8(t), t).otherwise(F.regexp_replace(F.make_valid_utf8(t), "\ufffd", ""))


def clean_text(text) -> Column:
    """Invalid UTF-8 dropped, control characters deleted, whitespace runs -> one
    space, ends stripped; NULL -> ''."""
    # One look-up per character, no regex: white space becomes ' ', and translate deletes the
    # characters that have no counterpart. Control characters go first, so those of them that
    # are white space too are deleted.
    other = "".join(c for c in PY_SPACE_CHARS if c != " " and c not in _CONTROL)
    t = F.translate(drop_invalid_utf8(text), other + _CONTROL, " " * len(other))
    t = F.when(F.contains(t, F.lit("  ")), F.regexp_replace(t, "  +", " ")).otherwise(t)
    return F.coalesce(F.trim(t), F.lit(""))


def ascii_only(text) -> Column:
    """Keep characters below code 127."""
    return F.regexp_replace(_c(text), "[^\\x00-\\x7e]", "")


def truncate_text(text, n: int) -> Column:
    """NULL/'' -> ''; longer than n characters -> first n plus '...'."""
    t = _c(text)
    return (F.when(t.isNull() | (t == ""), F.lit(""))
            .when(F.char_length(t) > n, F.concat(F.substring(t, 1, n), F.lit("...")))
            .otherwise(t))


def author_label(authors) -> Column:
    """X11: first three names joined by ', ', plus ' et al.' when there are more."""
    a = F.coalesce(_c(authors), F.array().cast("array<string>"))
    return F.concat(
        F.array_join(F.slice(a, 1, AUTHORS_SHOWN), ", "),
        F.when(F.size(a) > AUTHORS_SHOWN, F.lit(" et al.")).otherwise(F.lit("")),
    )


def category_label(names) -> Column:
    """First three names joined, no suffix."""
    a = F.coalesce(_c(names), F.array().cast("array<string>"))
    return F.array_join(F.slice(a, 1, CATEGORIES_SHOWN), ", ")


def url_tail(url) -> Column:
    """Last '/' segment of an entry id (version suffix kept)."""
    return F.replace(F.element_at(F.split(_c(url), "/"), -1), F.lit("abs/"), F.lit(""))


def join_list(arr, sep: str = "|") -> Column:
    """Arrays leave the job as one delimited string (stable across engines)."""
    return F.array_join(_c(arr), sep)


# Our own prompt wording; the six headers are the contract with the section parser.
PROMPT_TEMPLATE = (
    "Title: %s\n\nAbstract: %s\n\nPaper content (first part): %s\n\n"
    "Write six sections, each starting on its own line with its header, in this order:\n"
    "BEGINNER_TITLE:, INTERMEDIATE_TITLE:, BEGINNER_OVERVIEW:, INTERMEDIATE_OVERVIEW:, "
    "BEGINNER_SUMMARY:, INTERMEDIATE_SUMMARY:\n"
    "Titles are short; overviews are one sentence; summaries are 150-200 words, the first "
    "for a general audience and the second for technical readers."
)


def model_input(title, abstract, page_text, max_chars: int | None = None) -> Column:
    """Cleaned title and abstract plus the cleaned page text, whole unless
    ``max_chars`` (the source application sends ``MODEL_TEXT_CHARS``) cuts it."""
    body = clean_text(page_text)
    body = body if max_chars is None else F.substring(body, 1, max_chars)
    return F.format_string(PROMPT_TEMPLATE, clean_text(title), clean_text(abstract), body)
