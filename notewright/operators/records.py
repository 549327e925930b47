"""Projections of a validated note (note_id, note_type, text, codes, profile, generated_at, model, validation_result)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def note_id(ts: Column, *parts: Column) -> Column:
    """note_<time>_<8 hex>, the hex from a hash of ``parts``."""
    return F.concat(F.lit("note_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit("_"), F.substring(F.sha2(F.concat_ws("-", *(p.cast("string") for p in parts)), 256), 1, 8))


def is_valid(result: str = "validation_result") -> Column:
    """A note not validated counts as valid."""
    return F.coalesce(F.col(f"{result}.is_valid"), F.lit(True))


def confidence(result: str = "validation_result") -> Column:
    """A note not validated has confidence 0."""
    return F.coalesce(F.col(f"{result}.confidence_score"), F.lit(0.0))


def serialized(notes: DataFrame) -> DataFrame:
    """The form notes are saved in; the status is VALID or INVALID."""
    return notes.select(
        "note_id",
        "note_type",
        F.col("text").alias("clinical_text"),
        F.transform("codes", lambda c: c["code"]).alias("assigned_icd10_codes"),
        F.col("codes").alias("assigned_codes_details"),
        F.when(is_valid(), "VALID").otherwise("INVALID").alias("validation_status"),
        confidence().alias("confidence_score"),
        F.col("validation_result").alias("validation_details"),
        F.col("profile").alias("generation_profile"),
        F.date_format("generated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("generated_at"),
        F.col("model").alias("generation_model"),
    )


def training_form(notes: DataFrame) -> DataFrame:
    """input, output, metadata of each note."""
    meta = F.struct("note_id", "note_type", F.col("profile").alias("profile"), confidence().alias("confidence"))
    return notes.select(F.col("text").alias("input"), F.transform("codes", lambda c: c["code"]).alias("output"), meta.alias("metadata"))


def run_counters(notes: DataFrame) -> DataFrame:
    """One row: notes_generated, notes_valid, notes_sanitized, validation_rate and sanitization_rate in per cent (0 without notes)."""
    rate = lambda c: F.coalesce(F.try_divide(c * 100.0, F.count("*")), F.lit(0.0))
    valid, cleaned = F.count_if(is_valid()), F.count_if(F.col("n_removed") > 0)
    return notes.agg(F.count("*").alias("notes_generated"), valid.alias("notes_valid"), cleaned.alias("notes_sanitized"), rate(valid).alias("validation_rate"), rate(cleaned).alias("sanitization_rate"))
