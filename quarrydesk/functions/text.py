"""Text expressions. All but ``strip_accents_nfkd`` stay inside the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# --- fixed values -----------------------------------------------------------
# Unicode white space plus the four ASCII separators Python also strips.
WHITE_RUN = r"(?U)[\s\x1c-\x1f]+"
# A token is two or more word characters.
TOKEN = r"[\p{L}\p{N}_]{2,}"
# Hangul syllables are numbered by lead, vowel and tail; the first tail stands for none.
FIRST_SYLLABLE, LAST_SYLLABLE = 0xAC00, 0xD7A3
FIRST_LEAD, FIRST_VOWEL, FIRST_TAIL = 0x1100, 0x1161, 0x11A7
LEADS, VOWELS, TAILS = 19, 21, 28
# ----------------------------------------------------------------------------


def normalise_text(text: Column) -> Column:
    """Strip, collapse white space to single spaces, lower-case."""
    return F.lower(F.trim(F.regexp_replace(text, WHITE_RUN, " ")))


def is_blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, WHITE_RUN, " ")) == ""


def word_count(text: Column) -> Column:
    """White-space separated words of any text."""
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0)))


def word_count_normalised(text: Column) -> Column:
    """Same count for text that ``normalise_text`` produced, without a regex."""
    gaps = F.length(text) - F.length(F.replace(text, F.lit(" ")))
    return F.when(text == "", F.lit(0)).otherwise(gaps + 1)


@lru_cache(maxsize=1)
def _decompositions() -> dict[str, str]:
    """Every character beyond ASCII, Hangul syllables aside, that compatibility decomposition without marks changes."""
    out = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or FIRST_SYLLABLE <= code <= LAST_SYLLABLE:
            continue
        char = chr(code)
        bare = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if bare != char:
            out[char] = bare
    return out


def _character_class(characters: list[str]) -> str:
    """Regex class of characters in ascending order, neighbours as ranges."""
    codes = np.array([ord(c) for c in characters])
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    return "[" + "".join(f"\\x{{{run[0]:X}}}-\\x{{{run[-1]:X}}}" for run in runs) + "]"


def _syllable_parts(char: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    place = F.ascii(char) - FIRST_SYLLABLE

    def letter(first: int, count: int, index: Column) -> Column:
        return F.substring(F.lit("".join(chr(first + k) for k in range(count))), index.cast("int") + 1, F.lit(1))
    tail = place % TAILS
    return F.concat(letter(FIRST_LEAD, LEADS, F.floor(place / (VOWELS * TAILS))),
                    letter(FIRST_VOWEL, VOWELS, F.floor(place / TAILS) % VOWELS),
                    F.when(tail == 0, F.lit("")).otherwise(letter(FIRST_TAIL + 1, TAILS - 1, tail - 1)))


def strip_accents(text: Column) -> Column:
    """Compatibility-decompose and drop marks: ``strip_accents_nfkd`` as a column expression.

    Characters that become one character or none are translated. Only texts with ligatures, fractions, syllables and the
    like, that become several, are taken apart.
    """
    table = _decompositions()
    single = sorted(table, key=lambda c: -len(table[c]))  # translate drops characters without a counterpart
    single = [c for c in single if len(table[c]) < 2]
    several = [c for c in table if len(table[c]) > 1]
    expanded = F.create_map(*[F.lit(x) for c in several for x in (c, table[c])])

    def apart(char: Column) -> Column:
        return (F.when(char < chr(0x80), char)
                 .when(char.between(chr(FIRST_SYLLABLE), chr(LAST_SYLLABLE)), _syllable_parts(char))
                 .otherwise(F.coalesce(F.try_element_at(expanded, char), char)))
    syllables = f"[\\x{{{FIRST_SYLLABLE:X}}}-\\x{{{LAST_SYLLABLE:X}}}]"
    in_parts = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), apart), "")
    # a class of many ranges is asked beyond ASCII only
    listed = rf"[[^\x00-\x7F]&&[{_character_class(several)}{syllables}]]"
    longer = F.when(text.rlike(listed), in_parts).otherwise(text)
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(longer, "".join(single), "".join(table[c] for c in single))).otherwise(text)


@F.pandas_udf(StringType())
def strip_accents_nfkd(texts: pd.Series) -> pd.Series:
    """Full decomposition (ligatures, Hangul), in Arrow batches."""
    def bare(text: str | None) -> str | None:
        if text is None or text.isascii():
            return text
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return texts.map(bare, na_action="ignore")


def tokens(text: Column, accents: bool = True) -> Column:
    """Lower-cased tokens of at least two word characters, in text order."""
    lowered = F.lower(text)
    bare = strip_accents(lowered) if accents else lowered
    return F.regexp_extract_all(bare, F.lit(TOKEN), F.lit(0))


def bigrams(token_list: Column) -> Column:
    """Adjacent tokens joined by one space; empty below two tokens."""
    pairs = F.greatest(F.size(token_list) - 1, F.lit(0))
    return F.zip_with(F.slice(token_list, F.lit(1), pairs), F.slice(token_list, F.lit(2), pairs),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def terms(token_list: Column) -> Column:
    """Unigrams followed by bigrams."""
    return F.concat(token_list, bigrams(token_list))


def shorten(text: Column, limit: int, keep: int) -> Column:
    """First ``keep`` characters and ``...`` when longer than ``limit``."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, keep), F.lit("..."))).otherwise(text)


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of the columns' values in order; each is its length and its text, a NULL has neither."""
    def shown(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[shown(c) for c in columns]), 256))
