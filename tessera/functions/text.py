"""Normalisation of names and addresses as column expressions.

The Latin path has no Python in it. Letters with marks fold through one ``translate`` whose table comes from a
rule (Unicode decomposition); only other scripts go through an Arrow function, on the rows that need it.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions import fixed

#: What separates tokens: ASCII that is neither letter nor digit, and Unicode white space.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: Letters that stand for several.
LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "þ": "th", "ł": "l", "Ł": "L", "đ": "d", "°": "deg", "º": "o"}


def _folding() -> tuple[str, str]:
    pairs = []
    for k in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(k)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            pairs.append((chr(k), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, PLAIN = _folding()


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


@F.pandas_udf(StringType())
def other_scripts(texts: pd.Series) -> pd.Series:
    """Decomposition without marks; letters and vowel signs of other scripts are spelled from the last word of their Unicode names."""

    def letter(c: str) -> str:
        if c.isascii() or unicodedata.category(c)[0] not in "LM":
            return c
        return unicodedata.name(c, c).rpartition(" ")[2].lower()

    def one(t: str) -> str:
        return "".join(letter(c) for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return texts.map(one, na_action="ignore")


def folded(c: Column) -> Column:
    """Latin letters without marks; other characters as they are."""
    out = F.translate(c, MARKED, PLAIN)
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def romanized(c: Column) -> Column:
    plain = folded(c)
    return F.when(is_ascii(c), c).when(is_ascii(plain), plain).otherwise(other_scripts(F.when(is_ascii(plain), None).otherwise(plain)))


def tokens(c: Column) -> Column:
    """Lower case; & is a word; dots, apostrophes and back quotes vanish; other ASCII punctuation separates."""
    flat = F.translate(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), ".'`", "")
    return F.filter(F.split(F.regexp_replace(flat, SEPARATORS, " "), " "), lambda t: t != "")


def _mapped(t: Column, table: dict[str, str]) -> Column:
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, t), t)


def name_fields(c: Column) -> Column:
    """Struct of name_n, name_core, name_ns, is_domain and name_non_latin."""
    low = F.lower(romanized(c))
    bare = F.when(F.contains(low, F.lit(".")), F.regexp_replace(low, fixed.DOMAIN, "$1")).otherwise(low)
    words = F.transform(tokens(bare), lambda t: _mapped(t, fixed.LEGAL))
    only = F.coalesce(F.get(words, F.lit(0)), F.lit(""))  # a name may have no word at all
    glued = (F.size(words) == 1) & (F.length(only) >= 8) & only.endswith("com")
    words = F.when(glued, F.array(F.substring(only, F.lit(1), F.length(only) - 3))).otherwise(words)
    core = F.filter(words, lambda t: ~t.isin(fixed.LEGAL_FORMS + fixed.NAME_FILLER))
    core = F.when(F.size(core) == 0, words).otherwise(core)
    return F.struct(
        F.array_join(words, " ").alias("name_n"), F.array_join(core, " ").alias("name_core"), F.array_join(core, "").alias("name_ns"),
        ((bare != low) | glued).alias("is_domain"), (~is_ascii(c)).alias("name_non_latin"),
    )


def canonical_number(t: Column) -> Column:
    """Tokens with a digit lose a glued number word and leading zeros."""
    return F.when(t.rlike(r"\d"), F.regexp_replace(F.regexp_replace(t, fixed.NUMBER_PREFIX, "$1"), fixed.LEADING_ZEROS, "$1")).otherwise(t)


def with_state_codes(c: Column) -> Column:
    """Names of states become codes, the longest name first; rows without any are left alone."""
    names = sorted(fixed.STATES, key=lambda x: (-len(x), x))
    table = F.array(*[F.struct(F.lit(rf"\b{name}\b").alias("p"), F.lit(fixed.STATES[name]).alias("code")) for name in names])
    out = F.aggregate(table, c, lambda s, x: F.regexp_replace(s, x["p"], x["code"]))
    return F.when(c.rlike(r"\b(?:" + "|".join(names) + r")\b"), out).otherwise(c)


def address_tokens(c: Column) -> Column:
    text = F.array_join(tokens(romanized(F.regexp_replace(c, fixed.NUMERO, "no "))), " ")
    text = with_state_codes(F.regexp_replace(text, fixed.ORDINAL, "$1"))
    words = F.filter(F.split(text, " "), lambda t: (t != "") & ~t.isin(fixed.ADDRESS_DROP))
    words = F.transform(words, lambda t: canonical_number(_mapped(t, fixed.ADDRESS)))
    return F.filter(words, lambda t: (t != "") & ~t.isin(fixed.ADDRESS_DROP))


def address_fields(words: Column) -> Column:
    """Struct of addr_n, addr_nums, house, postal and addr_empty, from normalised tokens."""
    numbers = F.filter(words, lambda t: t.rlike(r"\d"))
    houses = F.filter(words, lambda t: t.rlike(r"^\d"))
    postal = F.filter(words, lambda t: t.rlike(r"^(?:\d{5}|\d{6})$"))
    return F.struct(
        F.array_join(words, " ").alias("addr_n"), F.array_join(F.array_sort(F.array_distinct(numbers)), " ").alias("addr_nums"),
        F.coalesce(F.regexp_extract(F.get(houses, F.lit(0)), r"^(\d+)", 1), F.lit("")).alias("house"),
        F.array_join(F.array_sort(F.array_distinct(postal)), " ").alias("postal"), (F.size(words) == 0).alias("addr_empty"),
    )


def legal_of(name_n: Column) -> Column:
    """The distinct legal forms of a name, sorted."""
    return F.array_join(F.array_sort(F.array_intersect(F.split(name_n, " "), F.array(*map(F.lit, fixed.LEGAL_FORMS)))), " ")


def first_of(name_core: Column) -> Column:
    return F.get(F.split(name_core, " "), F.lit(0))


def state_set(addr_n: Column) -> Column:
    """State codes among the first and last alphabetic token, sorted."""
    words = F.filter(F.split(addr_n, " "), lambda t: t.rlike(r"^[a-z]+$"))
    ends = F.array(F.get(words, F.lit(0)), F.get(words, F.size(words) - 1))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(ends, lambda t: t.isin(fixed.STATE_CODES)))), " ")


def word_count(c: Column) -> Column:
    """Spaces plus one, also for empty text."""
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1


def address_word_count(c: Column) -> Column:
    return F.when(c == "", 0).otherwise(word_count(c))


def equal_or_null(a: Column, b: Column) -> Column:
    """1.0 or 0.0, null unless both are non-empty."""
    return F.when((a != "") & (b != ""), (a == b).cast("double"))


def name_words(name_n: Column) -> Column:
    """Distinct words in order, without legal forms, filler and single characters."""
    skip = fixed.LEGAL_FORMS + fixed.NAME_FILLER
    return F.array_distinct(F.filter(F.split(name_n, " "), lambda t: (F.length(t) > 1) & ~t.isin(skip)))


def address_key(addr: Column) -> Column:
    """number and first four letters of the next word that is no street word, e.g. ``12 main``; null if there is none."""
    skip = "|".join(sorted({*fixed.ADDRESS, *fixed.ADDRESS.values()}, key=lambda x: (-len(x), x)))
    pattern = rf"\b(\d+) (?:(?:{skip}) )*([a-z]{{1,4}})"
    number, word = F.regexp_extract(addr, pattern, 1), F.regexp_extract(addr, pattern, 2)
    return F.when(number != "", F.concat_ws(" ", number, word))
