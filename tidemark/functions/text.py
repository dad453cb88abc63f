"""String expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These patterns must stay as they are for results to match.
# Separator between an offense type and its detail ("TYPE - detail").
NAME_SEPARATOR = r"\s+\-\s+"
# URI path and URI parameter classes of the weblog parser (the common public
# URIPATH / URIPARAM definitions). The parameter part keeps its leading "?".
URI_PATH = r"((?:/[A-Za-z0-9$.+!*'(){},~:;=@#%&_\-]*)+)"
URI_PARAM = r"(\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]<>]*)?"
# Exact-match copies of indexed text are kept only up to this length.
KEYWORD_LIMIT = 256


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name_head(name: Column | str) -> Column:
    """SCL-1: part of ``NAME`` before the first `` - ``; whole name if none."""
    return F.split(_c(name), NAME_SEPARATOR).getItem(0)


def strip_whitespace(s: Column | str) -> Column:
    """SCL-3: remove every whitespace character."""
    return F.regexp_replace(_c(s), r"\s", "")


def uri_path(url: Column | str) -> Column:
    """SCL-4: first URI path in the text, NULL when there is none."""
    return F.nullif(F.regexp_extract(_c(url), URI_PATH + URI_PARAM, 1), F.lit(""))


def uri_params(url: Column | str) -> Column:
    """SCL-4: query string right after the path (with ``?``), else NULL."""
    return F.nullif(F.regexp_extract(_c(url), URI_PATH + URI_PARAM, 2), F.lit(""))


def strip_prefix(s: Column | str, prefix: str) -> Column:
    """SCL-5: drop a literal prefix; NULL when the text does not start with it."""
    s = _c(s)
    return F.when(s.startswith(prefix), F.substring(s, len(prefix) + 1, 1 << 30))


def keyword(s: Column | str, limit: int = KEYWORD_LIMIT) -> Column:
    """SCL-12: exact-match copy, only for values no longer than ``limit``."""
    s = _c(s)
    return F.when(F.length(s) <= limit, s)


def regex_group(s: Column | str, pattern: str, group: int = 1) -> Column:
    """Group of a start-anchored match, NULL when the pattern does not match.

    ``(?s)`` lets ``.`` cross carriage returns like a line-based matcher does;
    callers pass single lines, so no newline is ever inside.
    """
    # one evaluation of the pattern: the anchored match is the only one, or there is none
    found = F.regexp_extract_all(_c(s), F.lit("(?s)^" + pattern), F.lit(group))
    return F.try_element_at(found, F.lit(1))


def trim_ws(s: Column | str) -> Column:
    """Trim leading and trailing whitespace of any kind (not just blanks)."""
    return F.regexp_replace(_c(s), r"^\s+|\s+$", "")


def default_if_empty(s: Column | str, default: str) -> Column:
    """SCL-11: ``default`` for NULL or empty text."""
    return F.coalesce(F.nullif(_c(s), F.lit("")), F.lit(default))
