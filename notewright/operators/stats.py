"""Statistics of note sets and of generation runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distribution(notes: DataFrame, by: str = "profile", pos: str = "pos") -> DataFrame:
    """Notes and per cent of each profile, most first; ties in order of first sight."""
    counted = notes.groupBy(by).agg(F.count("*").alias("n"), F.min(pos).alias("first_pos"))
    total = counted.agg(F.sum("n").alias("total"))
    out = counted.crossJoin(F.broadcast(total))  # one row
    return out.select(by, "n", (F.col("n") * 100.0 / F.col("total")).alias("percent"), "first_pos").orderBy(F.desc("n"), "first_pos")


def code_stats(notes: DataFrame, codes: str = "icd10_codes") -> DataFrame:
    """total_codes, unique_codes, avg_codes_per_note; null without notes."""
    sizes = notes.agg(F.sum(F.size(codes)).alias("total_codes"), F.count("*").alias("n_notes"))
    unique = notes.select(F.explode(codes).alias("code")).agg(F.count_distinct("code").alias("unique_codes"))
    return sizes.crossJoin(F.broadcast(unique)).select("total_codes", "unique_codes", F.try_divide("total_codes", "n_notes").alias("avg_codes_per_note"))  # one row each


def length_stats(notes: DataFrame, text: str = "clinical_text", by: list[str] | None = None) -> DataFrame:
    """Minimum, maximum, mean and upper median of text lengths.

    The median comes from counts by length: the least length that more than half of the notes do not exceed.
    """
    keys = by or []
    counted = notes.select(*keys, F.length(text).cast("long").alias("len")).where(F.col("len").isNotNull()).groupBy(*keys, "len").agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("len", "n")))
    agg = counted.groupBy(*keys).agg(F.min("len").alias("min_chars"), F.max("len").alias("max_chars"), (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("mean_chars"), F.sum("n").alias("n_notes"), pairs.alias("p"))
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))

    def step(s, x):
        seen = s["seen"] + x["n"]
        return F.struct(seen.alias("seen"), F.coalesce(s["at"], F.when(seen > F.floor(F.col("n_notes") / 2), x["len"])).alias("at"))

    return agg.select(*keys, "n_notes", "min_chars", "max_chars", "mean_chars", F.aggregate("p", start, step)["at"].alias("median_chars"))


def generation_rates(notes: DataFrame, by: str = "profile") -> DataFrame:
    """Generated, valid and the rate in per cent, by profile."""
    valid = F.count_if(F.col("validation_result.is_valid"))
    return notes.groupBy(by).agg(F.count("*").alias("generated"), valid.alias("valid"), F.coalesce(F.try_divide(valid, F.count("*")) * 100, F.lit(0.0)).alias("valid_rate"))


def issue_histogram(notes: DataFrame, top: int = 5, pos: str = "pos") -> DataFrame:
    """The most frequent issues of invalid notes; ties in order of first sight."""
    r = "validation_result."
    issues = notes.where(~F.col(r + "is_valid")).select(pos, F.posexplode(F.concat(F.col(r + "critical_issues"), F.col(r + "warnings"))).alias("i", "issue"))
    counted = issues.groupBy("issue").agg(F.count("*").alias("n"), F.min(F.struct(pos, "i")).alias("first"))
    return counted.orderBy(F.desc("n"), "first").limit(top).select("issue", "n")


def succeeded(generated: int, target: int, share: float = 0.8) -> bool:
    """Whether a batch made enough notes."""
    return generated >= share * target
