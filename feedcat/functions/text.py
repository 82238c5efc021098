"""Text scalars as native Column expressions.

Python-style ``\\s`` is Unicode-aware while Java's and RE2's ``\\s`` are
ASCII-only, so whitespace is spelled out as an explicit class that reads the
same in Java regex and RE2.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import DESCRIPTION_MAX, SLUG_MAX

# Every character str.isspace() accepts, as a regex class body.
WS_CHARS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{WS_CHARS}]"


# FIXED VALUES: named character references.
NAMED_REFERENCES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0")]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(col) -> Column:
    """Trim Unicode whitespace at both ends (NULL -> ''). A run inside the text is tried once, not from each of its characters."""
    return F.regexp_replace(F.coalesce(_c(col), F.lit("")), f"^{WS}++|(?<!{WS}){WS}++$", "")


def clean_text(col) -> Column:
    """B1: trim and collapse every whitespace run to one blank."""
    collapsed = F.regexp_replace(F.coalesce(_c(col), F.lit("")), f"{WS}+", " ")
    return F.trim(collapsed)


def is_blank(col) -> Column:
    return strip_ws(col) == ""


def slug(col, fallback: str = "", ampersand_to_and: bool = False) -> Column:
    """Catalog slug; keeps [a-z0-9], folds blanks and hyphens to one '-'."""
    v = F.lower(strip_ws(col))
    if ampersand_to_and:
        v = F.replace(v, F.lit("&"), F.lit(" and "))
    v = F.regexp_replace(v, f"[^a-z0-9{WS_CHARS}-]+", "-")
    v = F.regexp_replace(v, f"[{WS_CHARS}-]+", "-")
    v = F.regexp_replace(v, "^-+|-+$", "")
    return F.when(v == "", F.lit(fallback)).otherwise(v)


def slug_short(col, max_len: int = SLUG_MAX) -> Column:
    """Discovery slug, at most ``max_len`` characters, fallback 'feed'."""
    v = F.regexp_replace(F.lower(strip_ws(col)), "[^a-z0-9]+", "-")
    v = F.regexp_replace(v, "^-+|-+$", "")
    cut = F.regexp_replace(F.substring(v, 1, max_len), "-+$", "")
    return F.when(v == "", F.lit("feed")).otherwise(cut)


def item_description(desc, category, title, max_len: int = DESCRIPTION_MAX) -> Column:
    """Collapse, truncate past ``max_len`` to max_len-3 + '...', or default text."""
    d = strip_ws(desc)
    collapsed = F.regexp_replace(d, f"{WS}+", " ")
    cut = F.concat(F.rtrim(F.substring(collapsed, 1, max_len - 3)), F.lit("..."))
    cat = F.coalesce(F.nullif(_c(category), F.lit("")), F.lit("security"))
    default = F.concat(F.lit("Updates from "), F.coalesce(_c(title), F.lit("")),
                       F.lit(" covering "), F.lower(cat), F.lit("."))
    return (F.when(d == "", default)
            .when(F.length(collapsed) > max_len, cut)
            .otherwise(collapsed))


def md_escape(col) -> Column:
    """Markdown cell text: newline -> blank, pipe escaped, trimmed."""
    v = F.replace(F.coalesce(_c(col), F.lit("")), F.lit("\n"), F.lit(" "))
    v = F.replace(v, F.lit("|"), F.lit("\\|"))
    return strip_ws(v)


def html_escape(col) -> Column:
    """HTML text escape of & < > \" '."""
    v = F.coalesce(_c(col).cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return v


def xml_attr_escape(col) -> Column:
    """XML attribute escape of & < > \"."""
    v = F.coalesce(_c(col), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return v


def html_unescape(col) -> Column:
    """Decode decimal, hexadecimal and the common named character references, each once: the text is cut at
    every ``&``, so what a reference gives is never read again. A reference to no character gives U+FFFD."""
    v = _c(col)

    def decoded(part):
        digits = F.regexp_extract(part, "^&#[xX]?([0-9a-fA-F]+);$", 1)
        base_16 = F.lower(F.substring(part, 3, 1)) == "x"
        code = F.when(F.length(digits) > 8, F.lit(-1)).when(base_16, F.conv(digits, 16, 10).cast("long")).otherwise(digits.cast("long"))
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))
        out = F.when(part.rlike("^&#([0-9]+|[xX][0-9a-fA-F]+);$"), char)
        for ref, c in NAMED_REFERENCES:
            out = out.when(part == ref, F.lit(c))
        return out.otherwise(part)

    parts = F.regexp_extract_all(v, F.lit("&#?[0-9a-zA-Z]+;|[^&]+|&"), F.lit(0))
    return F.when(F.contains(v, F.lit("&")), F.array_join(F.transform(parts, decoded), "")).otherwise(v)


def iso_utc(col) -> Column:
    """ISO-8601 UTC text of a timestamp ('Z' suffix, microseconds)."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def display_timestamp(col) -> Column:
    """Display form of an ISO timestamp text; missing or unparseable -> 'unknown'."""
    ts = F.try_to_timestamp(strip_ws(col))
    return F.coalesce(F.date_format(ts, "MMM d, yyyy, HH:mm"), F.lit("unknown"))
