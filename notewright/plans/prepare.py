"""Training data from notes: format, gate, split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright import constants as K
from notewright.config import PrepareSettings
from notewright.operators import chat, split, stats
from notewright.sources import notes as note_source
from notewright.sources import sinks
from notewright.sources.scratch import table


Context = list[tuple[str, Column, Column]]


def convert(notes: DataFrame, context: Context | None = None, system: str = K.SYSTEM_PROMPT) -> DataFrame:
    """Every note as a sample (note_id, profile, messages, metadata, and pos if there is one) with error: null, or why it
    can't be one, in which case messages are null.  Bad rows stay beside the good ones.

    A note needs a text and codes that are not null, and metadata (perhaps) that is an object or null.  Without ``context`` the
    lines before a note are what its metadata tells (``chat.metadata_context``); an empty list gives none.
    """
    given = F.col("metadata") if "metadata" in notes.columns else F.lit(None).cast("variant")
    if context is None:
        context = chat.metadata_context(given) if "metadata" in notes.columns else []
    error = (
        F.when(F.col("clinical_text").isNull(), "clinical_text is null")
        .when(F.col("icd10_codes").isNull(), "icd10_codes is null")
        .when(given.isNotNull() & ~F.coalesce(F.is_variant_null(given), F.lit(False)) & ~F.schema_of_variant(given).startswith("OBJECT"), "metadata is no object")
    )
    error = F.when(error.isNotNull(), F.concat(F.lit("Note "), F.coalesce(F.col("note_id").cast("string"), F.lit("None")), F.lit(": "), error))
    messages = chat.to_messages(chat.user_message(F.col("clinical_text"), context), F.col("icd10_codes"), system)
    pos = ["pos"] if "pos" in notes.columns else []
    return notes.select("note_id", "profile", F.when(error.isNull(), messages).alias("messages"), chat.sample_metadata(F.col("profile"), F.col("icd10_codes"), given).alias("metadata"), *pos, error.alias("error"))


def to_samples(notes: DataFrame, context: Context | None = None, system: str = K.SYSTEM_PROMPT) -> DataFrame:
    """Samples (note_id, profile, messages, metadata) of the notes (note_id, clinical_text, icd10_codes, profile and perhaps metadata) that ``convert`` can convert."""
    return convert(notes, context, system).where(F.col("error").isNull()).select("note_id", "profile", "messages", "metadata")


def prepare(notes: DataFrame, max_tokens: int = 1024, validation_ratio: float = 0.2, seed: int = 42, context: Context | None = None, system: str = K.SYSTEM_PROMPT) -> DataFrame:
    """Samples (note_id, profile, messages, metadata, split) of notes that pass the gate."""
    return split.stratified_split(chat.keep_valid(to_samples(notes, context, system), max_tokens), "profile", "note_id", validation_ratio, seed)


@dataclass
class Prepared:
    """What a preparation found and wrote: the dataset's name and size, notes by profile, statistics of codes and lengths, notes
    that could not be converted (note_id, error), the gate's counts and faults by note, counts by split, and the two folders."""

    name: str
    total_notes: int
    profiles: DataFrame
    codes: dict
    lengths: dict
    unconverted: DataFrame
    gate: dict
    errors: DataFrame
    sizes: dict[str, int]
    train: str
    validation: str

    def row(self) -> dict:
        """All numbers as one record."""
        sizes = {f"n_{k}": v for k, v in self.sizes.items()}
        return {"dataset_name": self.name, "total_notes": self.total_notes, **self.codes, **{k: v for k, v in self.lengths.items() if k != "n_notes"}, **self.gate, **sizes}

    def text(self) -> str:
        """The summary to print."""
        lines = [f"Dataset: {self.name}", f"Total notes: {self.total_notes}", "", "Profile distribution:"]
        lines += [f"  {r['profile']}: {r['n']} notes ({r['percent']:.1f}%)" for r in self.profiles.limit(100).collect()]
        lines += ["", *(f"{k}: {v:.2f}" if isinstance(v, float) else f"{k}: {v}" for k, v in self.row().items() if k not in ("dataset_name", "total_notes"))]
        bad = [r["error"] for r in self.unconverted.orderBy("pos").limit(6).collect()]
        return "\n".join(lines + (["", "Not converted:", *(f"  {e}" for e in bad[:5]), *(["  ..."] if len(bad) > 5 else [])] if bad else []))


def prepare_dataset(spark: SparkSession, raw_path: str, out_dir: str, mode: str = "failfast", max_tokens: int = 1024, validation_ratio: float = 0.2, seed: int = 42, context: Context | None = None) -> Prepared:
    """Raw notes to two folders of JSONL below ``out_dir``, train and validation: load, sum up, convert, gate, split, write.

    The raw file is parsed once, into a table of notes, and these are converted and gated once, into a table of samples;
    all that is reported or written is read from the two.
    """
    found = note_source.read_dataset(spark, raw_path)
    notes = table(note_source.load_notes(table(note_source.normalize_notes(found.raw), "raw-notes"), mode), "notes")
    checked = convert(notes, context)
    samples = table(checked.withColumn("errors", F.when(F.col("error").isNull(), chat.sample_errors(F.col("messages"), max_tokens))), "gated")
    converted = samples.where(F.col("error").isNull())
    parts = {"train": f"{out_dir}/train.jsonl", "validation": f"{out_dir}/validation.jsonl"}
    done = table(split.stratified_split(converted.where(F.size("errors") == 0).select("note_id", "profile", "messages", "metadata"), "profile", "note_id", validation_ratio, seed), "split")
    for name, path in parts.items():
        sinks.write_samples(done.where(F.col("split") == name), path)
    sizes = dict.fromkeys(parts, 0) | {r["split"]: r["count"] for r in done.groupBy("split").count().collect()}
    gate = converted.agg(F.count("*").alias("total_samples"), F.count_if(F.size("errors") == 0).alias("valid_samples"), F.count_if(F.size("errors") > 0).alias("invalid_samples")).head().asDict()
    faults = converted.where(F.size("errors") > 0).groupBy("note_id").agg(F.max_by("errors", "pos").alias("errors"))
    lengths = stats.length_stats(notes).head()
    lengths = lengths.asDict() if lengths else {}
    return Prepared(found.name, notes.count(), stats.distribution(notes), stats.code_stats(notes).head().asDict(), lengths, samples.where(F.col("error").isNotNull()).select("pos", "note_id", "error"), gate, faults, sizes, **parts)


def prepare_by_settings(spark: SparkSession, settings: PrepareSettings, mode: str = "failfast") -> Prepared:
    """``prepare_dataset`` with paths, length, share and seed of the settings."""
    return prepare_dataset(spark, settings.raw_data_path, settings.processed_data_dir, mode, settings.max_seq_length, settings.validation_split, settings.random_seed)
