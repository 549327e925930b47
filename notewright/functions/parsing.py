"""Reading codes from model output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewright import constants as K


def is_valid_code(code: Column) -> Column:
    """Whether a code, stripped, has the accepted format (no trailing letter)."""
    return F.coalesce(F.regexp_replace(code, r"^\s+|\s+$", "").rlike(K.CODE_FORMAT), F.lit(False))


def strict_json(text: Column) -> Column:
    """The text as one variant; null if it is no JSON text or has something after it."""
    many = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(F.size(F.try_variant_get(many, "$", "array<variant>")) == 1, F.try_variant_get(many, "$[0]", "variant"))


def _codes_of(value: Column) -> Column:
    """The list under the key, or the list itself; null if there is neither."""
    kind = F.schema_of_variant(value)
    own = F.when(kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<string>"))
    keyed = F.when(kind.startswith("OBJECT"), F.try_variant_get(value, "$.icd10_codes", "array<string>"))
    return F.coalesce(own, keyed)


def parse_codes(output: Column) -> Column:
    """Codes in a model's output, as array<string>.

    JSON of the whole text (an object with the key, or a list) is taken as it stands; else the first embedded
    object with the key that parses; else all code-like words, distinct and sorted.  A key whose value is no
    list gives an empty array, as does a null.
    """
    text = F.regexp_replace(F.coalesce(output, F.lit("")), r"^\s+|\s+$", "")
    whole = strict_json(text)
    kind = F.schema_of_variant(whole)
    has_key = kind.startswith("OBJECT") & F.try_variant_get(whole, "$.icd10_codes", "variant").isNotNull()
    direct = F.when(kind.startswith("ARRAY") | has_key, F.coalesce(_codes_of(whole), F.array().cast("array<string>")))
    inner = F.filter(F.transform(F.regexp_extract_all(text, F.lit(K.OUTPUT_JSON), F.lit(0)), lambda j: _codes_of(strict_json(j))), lambda c: c.isNotNull())
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(K.CODE_OUTPUT), F.lit(1))))
    return F.coalesce(direct, F.try_element_at(inner, F.lit(1)), words)
