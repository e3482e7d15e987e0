"""Whitespace, blanks and whole-phrase matching on native string columns."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() and str.strip() count as
# whitespace, which is a superset of the regex class \s.
SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Everything but letters, digits, combining marks, '+' and '#' separates words;
# '|' is kept apart because it marks the border between two tags.
_NOT_WORD = r"[^\p{L}\p{N}\p{M}+#]+"
_NOT_WORD_OR_BORDER = r"[^\p{L}\p{N}\p{M}+#|]+"


# A whitespace run that is more than one plain space; the others would be replaced by themselves. The two
# ranges hold all whitespace and no ASCII letter, so most characters are told by them alone.
_WIDE_SPACE = rf"[[\x{{0}}-\x{{20}}\x{{85}}-\x{{3000}}]&&{SPACE}](?:{SPACE}+|(?<! ))"


def squeeze(text: Column) -> Column:
    """Collapse every whitespace run to one space and trim both ends."""
    return F.trim(F.regexp_replace(text, _WIDE_SPACE, " "))


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace, keeping the inside of the text as it is."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def null_to_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def clean_or_null(text: Column) -> Column:
    """Squeezed text; an empty result is null (board B convention)."""
    return blank_to_null(squeeze(text))


def clean_or_blank(text: Column) -> Column:
    """Squeezed text; a missing element is the empty string (board A)."""
    return null_to_blank(squeeze(text))


def first_present(*texts: Column) -> Column:
    """First candidate that is neither null nor empty after stripping."""
    return F.coalesce(*[blank_to_null(strip(t)) for t in texts])


def drop_prefix_ci(text: Column, prefix: str) -> Column:
    """Remove a leading prefix, ignoring case, and strip what follows."""
    stripped = strip(F.substr(text, F.lit(len(prefix) + 1)))
    return F.when(F.lower(text).startswith(prefix.lower()), stripped).otherwise(text)


def keyword_match(text: Column, keywords: Iterable[str]) -> Column:
    """True where the lower-cased text contains any keyword."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [lowered.contains(k.lower()) for k in keywords])


def phrase_text(text: Column) -> Column:
    """Text as ' word word ', ready for `has_phrase`; null becomes ' '."""
    words = F.trim(F.regexp_replace(F.lower(null_to_blank(text)), _NOT_WORD, " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def phrase_text_of_tags(tags: Column) -> Column:
    """Tags as ' word word | word ', so a phrase never spans two tags."""
    joined = F.lower(F.array_join(F.coalesce(tags, F.array().cast("array<string>")), "|"))
    words = F.replace(F.regexp_replace(joined, _NOT_WORD_OR_BORDER, " "), F.lit("|"), F.lit(" | "))
    return F.concat(F.lit(" "), F.regexp_replace(F.trim(words), " +", " "), F.lit(" "))


def has_phrase(padded: Column, phrases: Iterable[str]) -> Column:
    """True where a text from `phrase_text` holds one of the whole phrases."""
    return reduce(lambda a, b: a | b, [padded.contains(f" {p} ") for p in phrases])


def any_phrase(phrases: Iterable[str]) -> str:
    """The pattern that finds a text of `phrase_text` in which `has_phrase` holds for one of the phrases."""
    return " (?:" + "|".join(re.escape(p) for p in phrases) + ") "
