"""Tags and attributes of markup as Column expressions.

Every loop is possessive, which Java runs without recursion, and every pattern that has begun ends somewhere (at the
latest at the text's end), so a text is read once whatever is in it: no tag with very many attributes and no unclosed
tag or quote makes a pattern deep or slow.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import html_unescape

# a value is quoted, and then taken whole, or ends at white space or the tag's end
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""


def tags(text: Column, names: str, flags: str = "is") -> Column:
    """Whole tags whose names match ``names``, in document order; one that isn't closed is none."""
    tag = rf"(?{flags})<(?:{names})(?=[\s/>])(?:[^>=]++|=\s*+{VALUE})*+(?:>|\z)"
    return F.filter(F.regexp_extract_all(text, F.lit(tag), 0), lambda t: F.endswith(t, F.lit(">")))


def unquoted(value: Column) -> Column:
    """A value without the quotes around it."""
    quoted = F.substring(value, 1, 1).isin('"', "'") & (F.length(value) > 1)
    return F.when(quoted, F.substring(value, F.lit(2), F.greatest(F.length(value) - 2, F.lit(0)))).otherwise(value)


def raw_attribute(tag: Column, name: str, names: str, flags: str = "is") -> Column:
    """The value of a tag's first attribute ``name`` as written, quotes included; '' without one."""
    other = rf"[\s/]*+(?!{name}[\s/=>])[^\s/>][^\s/>=]*+(?:\s*+=\s*+{VALUE})?+"
    return F.regexp_extract(tag, rf"(?{flags})^<(?:{names})(?:{other})*+[\s/]*+{name}\s*+=\s*+({VALUE})", 1)


def attribute(tag: Column, name: str, names: str, flags: str = "is") -> Column:
    """The decoded value of a tag's first attribute ``name``; '' without one."""
    return html_unescape(unquoted(raw_attribute(tag, name, names, flags)))
