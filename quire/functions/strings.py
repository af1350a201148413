"""String and regular-expression column functions.

Patterns are Java regular expressions passed as literals (no SQL string
escaping). Every function returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["n_chars", "paste", "is_in", "str_detect", "str_count", "str_locate",
           "str_replace_all", "str_replace", "to_lower", "to_upper", "to_title", "str_sub",
           "str_extract_all", "str_extract", "str_trim", "str_remove", "str_remove_all",
           "str_split", "strip_suffix", "strip_prefix", "is_retweet", "strip_html"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_chars(c) -> Column:
    """G1: number of characters (code points)."""
    return F.char_length(_c(c))


def paste(*cols, sep: str = " ") -> Column:
    """Concatenate columns with a separator (NULLs skipped, as concat_ws)."""
    return F.concat_ws(sep, *[_c(c) for c in cols])


def is_in(c, values) -> Column:
    """Membership in a fixed list."""
    return _c(c).isin(list(values))


def str_detect(c, pattern: str) -> Column:
    """Does the pattern occur?"""
    return _c(c).rlike(pattern)


def str_count(c, pattern: str) -> Column:
    """Number of non-overlapping matches."""
    return F.regexp_count(_c(c), F.lit(pattern))


def str_locate(c, pattern: str) -> Column:
    """First match as ``struct(start, end)``, 1-based and inclusive; NULLs if no match."""
    start = F.regexp_instr(_c(c), F.lit(pattern))
    m = F.regexp_extract(_c(c), pattern, 0)
    has = start > 0
    return F.struct(F.when(has, start).alias("start"),
                    F.when(has, start + F.char_length(m) - 1).alias("end"))


def str_replace_all(c, pattern: str, replacement: str) -> Column:
    """Replace every match."""
    return F.regexp_replace(_c(c), pattern, replacement)


def str_replace(c, pattern: str, replacement: str) -> Column:
    """Replace the first match only."""
    return F.regexp_replace(_c(c), f"(?s)^(.*?)(?:{pattern})", f"$1{replacement}")


def to_lower(c) -> Column:
    """G8."""
    return F.lower(_c(c))


def to_upper(c) -> Column:
    """G8."""
    return F.upper(_c(c))


def to_title(c) -> Column:
    """Title case; words split at blanks (underscores are not word breaks)."""
    return F.initcap(_c(c))


def str_sub(c, start: int, end: int | None = None) -> Column:
    """Substring from ``start`` to ``end`` (1-based, inclusive; negative counts from the end)."""
    col = _c(c)
    n = F.char_length(col)
    s = F.lit(start) if start > 0 else n + F.lit(start + 1)
    if end is None:
        e = n
    else:
        e = F.lit(end) if end > 0 else n + F.lit(end + 1)
    s = F.greatest(s, F.lit(1))
    return F.when(e >= s, F.substring(col, s, e - s + 1)).otherwise(F.lit(""))


def str_extract_all(c, pattern: str, group: int = 0) -> Column:
    """All matches as an array (explode for one row per match)."""
    return F.regexp_extract_all(_c(c), F.lit(pattern), group)


def str_extract(c, pattern: str, group: int = 0) -> Column:
    """First match or NULL."""
    return F.regexp_substr(_c(c), F.lit(pattern)) if group == 0 else F.regexp_extract(_c(c), pattern, group)


def str_trim(c) -> Column:
    """Trim blanks at both ends."""
    return F.trim(_c(c))


def str_remove(c, pattern: str) -> Column:
    """Remove the first match."""
    return str_replace(c, pattern, "")


def str_remove_all(c, pattern: str) -> Column:
    """Remove every match."""
    return F.regexp_replace(_c(c), pattern, "")


def str_split(c, sep: str = " ") -> Column:
    """Split on a literal separator; empty strings are kept."""
    import re
    return F.split(_c(c), re.escape(sep), -1)


def strip_suffix(c, suffix: str = ".") -> Column:
    """Strip one trailing occurrence of ``suffix``."""
    import re
    return F.regexp_replace(_c(c), re.escape(suffix) + "$", "")


def strip_prefix(c, prefix: str) -> Column:
    """Strip a literal prefix."""
    import re
    return F.regexp_replace(_c(c), "^" + re.escape(prefix), "")


def is_retweet(c) -> Column:
    """First three characters, lower-cased, equal ``'rt '``."""
    return F.lower(F.substring(_c(c), 1, 3)) == F.lit("rt ")


# The HTML cleaning rules, applied in this order.
HTML_BLOCKS = r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>"
HTML_COMMENTS = r"(?s)<!--.*?-->"
HTML_TAGS = r"<[^>]*>"
HTML_ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " "}


def strip_html(c) -> Column:
    """I16: remove script/style blocks, comments and tags, decode the common
    entities and squeeze whitespace."""
    x = _c(c)
    x = F.regexp_replace(x, r"(?is)<script\b[^>]*>.*?</script\s*>", " ")
    x = F.regexp_replace(x, r"(?is)<style\b[^>]*>.*?</style\s*>", " ")
    x = F.regexp_replace(x, HTML_COMMENTS, " ")
    x = F.regexp_replace(x, HTML_TAGS, " ")
    for k, v in HTML_ENTITIES.items():
        x = F.replace(x, F.lit(k), F.lit(v))
    x = F.regexp_replace(x, r"\s+", " ")
    return F.trim(x)
