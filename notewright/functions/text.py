"""Column expressions on text and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewright import constants as K


def strip(text: Column) -> Column:
    """Without white space at both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def first_character(code: Column) -> Column:
    """The chapter letter, upper-case; empty for an empty code."""
    return F.upper(F.substring(code, 1, 1))


def code_attributes(code: Column) -> dict[str, Column]:
    """The derived attributes of a code, by name."""
    c = first_character(code)
    injury = c.isin("S", "T")
    return {
        "first_character": c,
        "is_injury_code": injury,
        "is_external_cause_code": c.isin("V", "W", "X", "Y"),
        "is_symptom_code": c == "R",
        "is_z_code": c == "Z",
        "requires_7th_character": injury & (F.length(code) >= 3),
    }


def chapter_name(code: Column) -> Column:
    """The chapter of a code by its letter; null if it has none."""
    pairs = [F.lit(x) for pair in K.CHAPTERS.items() for x in pair]
    return F.create_map(*pairs)[first_character(code)]


def parse_note_type(text: Column) -> Column:
    """A note type written in any case, with blanks or dashes; an error if there is no such type."""
    name = F.translate(F.upper(text), " -", "__")
    return F.when(name.isin(*K.NOTE_TYPES), name).otherwise(F.raise_error(F.concat(F.lit("unknown note type: "), text)))


def keyword(name: Column) -> Column:
    """The first word of more than three letters that is no stop word; null if there is none."""
    words = F.filter(F.split(F.lower(name), r"(?U)\s+"), lambda w: (F.length(w) > 3) & ~w.isin(*K.KEYWORD_STOP_WORDS))
    return F.try_element_at(words, F.lit(1))


def quoted(text: Column) -> Column:
    """Text as a regular expression that matches it literally."""
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def windows_before(text: Column, word: Column, width: int) -> Column:
    """What stands before each whole-word occurrence of ``word``: up to ``width`` characters."""
    q = quoted(word)  # the look-behind comes after the word, so it is tried at its occurrences only
    pattern = F.concat(F.lit("(?s)\\b"), q, F.lit(f"\\b(?<=(^.{{0,{width - 1}}}|.{{{width}}})"), q, F.lit(")"))
    return F.regexp_extract_all(text, pattern, F.lit(1))


def token_estimate(text: Column, chars_per_token: float = 4.0) -> Column:
    """Tokens by characters: floor(length / chars_per_token) + 1."""
    return (F.floor(F.length(text) / F.lit(float(chars_per_token))) + 1).cast("long")


def json_codes(codes: Column) -> Column:
    """The assistant's answer: {"icd10_codes": [...]}, with a blank after colon and comma."""
    items = F.transform(codes, lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1))
    return F.concat(F.lit('{"icd10_codes": ['), F.array_join(items, ", "), F.lit("]}"))


def falsy_coalesce(*texts: Column) -> Column:
    """The first text that is neither null nor empty; else empty."""
    return F.coalesce(*(F.nullif(t, F.lit("")) for t in texts), F.lit(""))


def falsy_array(*arrays: Column) -> Column:
    """The first array that is neither null nor empty; else empty."""
    return F.coalesce(*(F.when(F.size(a) > 0, a) for a in arrays), F.array().cast("array<string>"))


def upper_median(values: Column) -> Column:
    """The upper middle of an array's sorted values."""
    return F.try_element_at(F.array_sort(values), (F.size(values) / 2).cast("int") + 1)
