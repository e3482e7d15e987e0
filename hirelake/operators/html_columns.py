"""Single fields straight from page HTML with native regex functions.

For fields that need no element nesting this avoids the Python step.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import blank_to_null, squeeze, strip

# The named entities read by `unescape`; '&amp;' comes last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ",
    "&copy;": "©", "&middot;": "·", "&amp;": "&",
}
_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"


def unescape(text: Column) -> Column:
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def inner_html(html: Column, tag: str) -> Column:
    """Content of the first element with the tag; '' when there is none."""
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)


def visible_text(fragment: Column) -> Column:
    """Text of a fragment: text nodes joined by a space, whitespace collapsed."""
    return squeeze(unescape(F.regexp_replace(F.regexp_replace(fragment, _HIDDEN, " "), "<[^>]*>", " ")))


def element_text(html: Column, tag: str) -> Column:
    """Text of the first element with the tag; empty becomes null."""
    return blank_to_null(visible_text(inner_html(html, tag)))


def attribute(html: Column, tag: str, name: str) -> Column:
    """Double-quoted attribute of the first element that has it; empty becomes null."""
    value = F.regexp_extract(html, rf'(?is)<{tag}\b[^>]*?\s{name}="([^"]*)"', 1)
    return blank_to_null(strip(unescape(value)))


def links(html: Column) -> Column:
    """Array of (href, text) of every link, in document order."""
    link = F.lit(r'(?is)<a\b[^>]*?\shref="([^"]*)"[^>]*>(.*?)</a\s*>')
    hrefs = F.transform(F.regexp_extract_all(html, link, 1), lambda h: strip(unescape(h)))
    texts = F.transform(F.regexp_extract_all(html, link, 2), visible_text)
    return F.arrays_zip(hrefs.alias("href"), texts.alias("text"))
