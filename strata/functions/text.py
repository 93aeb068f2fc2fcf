"""Text cleaning as built-in column expressions (no Python UDF).

Python's ``str.strip`` / ``\\s`` treat more characters as whitespace than
Java's ``\\s`` (NBSP, the C1 next-line, the Unicode spaces, and the ASCII
separators 0x1C-0x1F). The class below spells that set out so that the
Java regex engine and RE2 (the SQL oracle) agree with the Python rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts, in code-point order:
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
WS_CLASS = (
    "[\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
WS_RUN = WS_CLASS + "+"

# The same set as a plain string, built from the code-point ranges above, for
# ``trim(BOTH <chars> FROM x)`` (far cheaper than an anchored regex).
_WS_RANGES = [(0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
              (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
WS_CHARS = "".join(chr(c) for lo, hi in _WS_RANGES for c in range(lo, hi + 1))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ustrip(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.trim(_c(x), F.lit(WS_CHARS))


def clean(x) -> Column:
    """Collapse whitespace runs to one space, strip, empty -> null."""
    collapsed = F.regexp_replace(_c(x), WS_RUN, " ")
    return F.nullif(F.trim(collapsed), F.lit(""))


def text_value(x) -> Column:
    """Any value -> stripped text; empty -> null."""
    return F.nullif(ustrip(_c(x).cast("string")), F.lit(""))


def after_prefix(cleaned, prefix: str) -> Column:
    """Text after a case-insensitive prefix such as ``record:``; no prefix -> null.

    Takes already *cleaned* text (see ``clean``); project the cleaned value in
    its own ``select`` first so the regex work is not repeated per branch.
    """
    c = _c(cleaned)
    head = F.lower(F.substring(c, 1, len(prefix)))
    return F.when(head == prefix.lower(), ustrip(F.substring(c, len(prefix) + 1, 2147483647)))


def normalise_label(x) -> Column:
    """Label key: clean, drop trailing colons, upper-case."""
    return F.upper(F.regexp_replace(clean(x), ":+$", ""))


def remove_label(item, label) -> Column:
    """Item text with every occurrence of its label removed, then cleaned."""
    return clean(F.replace(_c(item), _c(label), F.lit("")))


def default_if_blank(x, default: str) -> Column:
    """Null or empty -> default."""
    return F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default))
