"""First element or attribute of a tag in an HTML column."""

from __future__ import annotations

import json
import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of characters in HTML, from the standard table.
_NAMES = json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"})
_REFERENCE = r"^&(?:#([0-9]{1,7})|#[xX]([0-9a-fA-F]{1,6})|([A-Za-z][A-Za-z0-9]*+));"
_LAST_CODE = 0x10FFFF
_VALUE = r"""("[^"]*+"|'[^']*+'|[^\s"'<>]++)"""


def unescape(text: Column) -> Column:
    """Numeric and named character references decoded, once; those without a semicolon stay."""
    names = F.from_json(F.lit(_NAMES), "map<string, string>")

    def decoded(piece: Column) -> Column:
        part = [F.regexp_extract(piece, _REFERENCE, k) for k in (1, 2, 3)]
        code = F.when(part[0] != "", part[0].cast("bigint")).when(
            part[1] != "", F.conv(part[1], 16, 10).cast("bigint")
        )
        known = (code > 0) & (code <= _LAST_CODE) & ~code.between(0xD800, 0xDFFF)
        char = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(
            F.try_element_at(names, part[2])
        )
        return F.when(char.isNull(), piece).otherwise(F.concat(char, F.regexp_replace(piece, _REFERENCE, "")))

    pieces = F.transform(F.split(text, "(?=&)"), decoded)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def first_element(html: Column, tag: str) -> Column:
    """Decoded content of the first element of a tag; NULL if absent or empty.

    If nothing closes the first opening tag, nothing closes a later one, so one of them is looked at,
    and from there on the text is read once. What follows the last `>` holds no whole tag and is cut
    off first, so an opening tag always finds its end.
    """
    name = re.escape(tag)
    tags = F.regexp_extract(html, r"(?s)\A.*>", 0)
    opened = F.regexp_extract(tags, rf"(?is)<{name}(?:\s[^>]*+)?>(.*)", 1)
    inner = F.regexp_extract(opened, rf"(?is)\A(.*?)</{name}\s*+>", 1)
    # As an array, so that what is found is computed once and used several times.
    return F.get(F.transform(F.filter(F.array(inner), lambda found: found != ""), unescape), F.lit(0))


def first_attribute(html: Column, tag: str, attribute: str) -> Column:
    """Decoded value of an attribute of the first such tag that has it; NULL if absent.

    The value may stand in double quotes, single quotes or none. Attributes are passed over one by
    one and never gone back to.
    """
    name, key = re.escape(tag), re.escape(attribute)
    other = rf"\s++(?!{key}\s*+=)[^\s=<>/\"']++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'<>]++))?+"
    value = F.regexp_extract(html, rf"(?is)<{name}(?:{other})*+\s++{key}\s*+=\s*+{_VALUE}", 1)
    bare = F.when(
        F.substring(value, 1, 1).isin("'", '"'), F.substring(value, F.lit(2), F.length(value) - 2)
    ).otherwise(value)
    return unescape(F.nullif(bare, F.lit("")))


def revision_id(html: Column) -> Column:
    """Newest revision on a history page: the first list item that names one."""
    return first_attribute(html, "li", "data-mw-revid").cast("long")
