"""Clinical notes: reading raw JSON, normalising fields, load policy, JSONL samples."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.functions.text import falsy_array, falsy_coalesce, strip
from notewright.sources.json_array import read_array

#: Accepted spellings of the fields.
ID_KEYS = ("note_id", "id")
TEXT_KEYS = ("clinical_text", "text", "note_text", "narrative")
CODE_KEYS = ("icd10_codes", "assigned_icd10_codes", "codes", "icd_codes")
SAMPLE_SCHEMA = "messages array<struct<role:string,content:string>>, note_id string, metadata variant"


@dataclass
class Dataset:
    """Raw notes (pos, doc) and the dataset's name."""

    name: str
    raw: DataFrame


def read_dataset(spark: SparkSession, path: str) -> Dataset:
    """The notes of a JSON array, or of an object's ``notes``, read by many tasks; ``DatasetLoadError`` for anything else.

    The name is the object's ``dataset_name``, else the file's without its extension.
    """
    found = read_array(spark, path, "notes")
    stem = re.sub(r"(?<=.)\.[^.]*$", "", path.rstrip("/").rsplit("/", 1)[-1])
    return Dataset(stem if found.name is None else found.name, found.elements.select("pos", F.parse_json("text").alias("doc")))


def read_raw_notes(spark: SparkSession, path: str) -> DataFrame:
    """(pos, doc) of ``read_dataset``."""
    return read_dataset(spark, path).raw


def normalize_notes(raw: DataFrame, profile_keys: tuple[str, ...] = ("profile",)) -> DataFrame:
    """note_id, clinical_text, icd10_codes, profile, metadata, pos from (pos, doc).

    Null, empty and missing all fall through to the next spelling.  The id falls back on the 0-based position,
    six digits wide or more.  ``profile_keys`` may name more keys, as generated_profile of produced files.
    """
    get = lambda key, kind: F.try_variant_get("doc", f"$.{key}", kind)
    note_id = falsy_coalesce(*(get(k, "string") for k in ID_KEYS))
    profile = F.coalesce(*(get(k, "string") for k in profile_keys), F.lit("unknown"))
    known = [*ID_KEYS, *TEXT_KEYS, *CODE_KEYS, "profile"]
    fields = F.map_filter(F.try_variant_get("doc", "$", "map<string,variant>"), lambda k, v: ~k.isin(*known))
    return raw.select(
        F.when(note_id == "", F.format_string("note_%06d", F.col("pos").cast("long"))).otherwise(note_id).alias("note_id"),
        falsy_coalesce(*(get(k, "string") for k in TEXT_KEYS)).alias("clinical_text"),
        falsy_array(*(get(k, "array<string>") for k in CODE_KEYS)).alias("icd10_codes"),
        profile.alias("profile"),
        F.to_variant_object(fields).alias("metadata"),
        F.col("pos").cast("long").alias("pos"),
    )


def with_error(notes: DataFrame) -> DataFrame:
    """Adds error: why a note can't be loaded, null if it can."""
    blank = strip(F.coalesce("clinical_text", F.lit(""))) == ""
    return notes.withColumn("error", F.when(blank, "clinical_text is blank").when(F.coalesce(F.size("icd10_codes"), F.lit(0)) == 0, "icd10_codes is empty"))


def load_notes(notes: DataFrame, mode: str = "failfast") -> DataFrame:
    """Notes that pass; ``failfast`` raises if any does not (naming the first ten), ``drop`` leaves them out."""
    checked = with_error(notes)
    if mode == "failfast":
        bad = checked.where(F.col("error").isNotNull())
        first = bad.orderBy("pos").select("note_id", "error").limit(10).collect()
        if first:
            more = bad.count() - len(first)
            lines = [f"{r['note_id']}: {r['error']}" for r in first] + ([f"... and {more} more"] if more else [])
            raise ValueError("notes failed to load:\n" + "\n".join(lines))
    return checked.where(F.col("error").isNull()).drop("error")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Chat samples of a JSONL file or folder."""
    return spark.read.schema(SAMPLE_SCHEMA).json(path)
