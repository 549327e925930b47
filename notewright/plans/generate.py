"""Note generation: select codes, prompt, generate, sanitise, validate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from notewright.config import Settings
from notewright.constants import BATCH_SUCCESS, PASS_CONFIDENCE
from notewright.operators import prompting, rules, sampling, textgen
from notewright.sources.scratch import scratch_path, table


def answers(asked: DataFrame, generate: textgen.Generate = textgen.stub, note_type: str = "PROGRESS_NOTE", retry: bool = False, budget: int | None = None) -> DataFrame:
    """The model's answers to ``asked`` (note_idx, profile, codes array<struct<code, name, category_name>>): these and
    prompt, raw, raw_error and the calls made; nothing else of a note needs the model."""
    asked = asked.select("note_idx", "profile", "codes").withColumn("prompt", prompting.generation_prompt(F.lit(note_type), F.col("codes"), F.lit(None).cast("string")))
    return textgen.generate_text(asked, "prompt", "raw", textgen.with_retries(generate) if retry else generate, budget)


def notes_of_answers(made: DataFrame, validate: bool = True, threshold: float = PASS_CONFIDENCE) -> DataFrame:
    """Notes of ``answers``: note_idx, profile, prompt, codes, text, n_removed and, if ``validate``, validation_result."""
    clean = rules.sanitize(F.col("raw"), F.transform("codes", lambda c: c["code"]))
    notes = made.where(F.col("raw").isNotNull()).withColumn("_s", clean).select("note_idx", "profile", "prompt", "codes", F.col("_s.text").alias("text"), F.col("_s.removed").alias("n_removed"))
    return rules.validate(notes, threshold=threshold) if validate else notes


def notes_of_codes(asked: DataFrame, generate: textgen.Generate = textgen.stub, note_type: str = "PROGRESS_NOTE", validate: bool = True, retry: bool = False, on_error: str = "drop") -> DataFrame:
    """A note for each row of ``asked``, as ``notes_of_answers``.

    A failed generation gives no note, or, with ``on_error`` "raise", fails the query with its error; with ``retry``
    failures, and answers that are too short, are tried again first.
    """
    made = answers(asked, generate, note_type, retry)
    if on_error == "raise":
        made = made.withColumn("raw", F.coalesce("raw", F.raise_error(F.concat(F.lit("generation failed: "), F.col("raw_error"))).cast("string")))
    return notes_of_answers(made, validate)


def asked_codes(requests: DataFrame, catalog: DataFrame, profiles: DataFrame, seed: int = 42) -> DataFrame:
    """note_idx, profile and the chosen codes (array<struct<code, name, category_name>>) of requests (note_idx, profile, n_codes).

    Requests without any code are left out.
    """
    chosen = sampling.select_for_profiles(requests, catalog, profiles, seed)
    rank = F.when(F.col("part") == "primary", 0).when(F.col("part") == "comorbid", 1).otherwise(2)
    full = chosen.join(catalog.select("code", "name", "category_name"), "code").select("note_idx", F.struct(rank.alias("r"), "place", "code", "name", "category_name").alias("c"))
    codes = full.groupBy("note_idx").agg(F.array_sort(F.collect_list("c")).alias("c"))
    codes = codes.select("note_idx", F.transform("c", lambda c: F.struct(c["code"].alias("code"), c["name"].alias("name"), c["category_name"].alias("category_name"))).alias("codes"))
    return requests.select("note_idx", "profile").join(codes, "note_idx")


def generate_notes(requests: DataFrame, catalog: DataFrame, profiles: DataFrame, generate: textgen.Generate = textgen.stub, note_type: str = "PROGRESS_NOTE", seed: int = 42, validate: bool = True, retry: bool = False) -> DataFrame:
    """Notes for requests (note_idx, profile, n_codes): what ``notes_of_codes`` gives for the codes chosen.

    Requests without any code, and failed generations, give no note.
    """
    return notes_of_codes(asked_codes(requests, catalog, profiles, seed), generate, note_type, validate, retry)


def durable_answers(asked: DataFrame, path: str, generate: textgen.Generate = textgen.stub, note_type: str = "PROGRESS_NOTE", retry: bool = False, budget: int | None = None, waves: int = 4) -> DataFrame:
    """``answers`` kept in the Parquet table ``path``, by note_idx; asked again, only what has no text there is generated.

    Requests go in ``waves`` by their hash, each a job that adds its answers when it ends, so a run that breaks off
    loses one wave's calls at most.  Failed requests leave a row with their error, and are tried again by the next run.
    """
    spark = asked.sparkSession
    asked = table(asked.select("note_idx", "profile", "codes"), "asked")
    kept = answers(asked.limit(0), generate, note_type).schema
    try:
        done = spark.read.schema(kept).parquet(path)
    except AnalysisException:
        done = spark.createDataFrame([], kept)
    missing = table(asked.join(done.where(F.col("raw").isNotNull()).select("note_idx"), "note_idx", "left_anti").withColumn("_wave", F.pmod(F.xxhash64("note_idx"), F.lit(waves)).cast("int")), "missing")
    for wave in sorted(r["_wave"] for r in missing.select("_wave").distinct().collect()):
        answers(missing.where(F.col("_wave") == wave), generate, note_type, retry, budget).write.mode("append").parquet(path)
    try:
        return spark.read.schema(kept).parquet(path)
    except AnalysisException:  # nothing was asked
        return done


def batch_requests(profiles: DataFrame, per_profile: int | None = None, n_codes: int = 3) -> DataFrame:
    """Requests for each of ``profiles`` (profile): note_idx (md5 of profile and number), profile, n_codes.

    ``per_profile`` of each; without it as many as the column ``n_notes`` says.
    """
    n = F.col("n_notes") if per_profile is None else F.lit(per_profile)
    numbered = profiles.where(n > 0).select("profile", F.explode(F.sequence(F.lit(1).cast("long"), n.cast("long"))).alias("i"))
    return numbered.select(F.md5(F.concat_ws("|", "profile", F.col("i").cast("string"))).alias("note_idx"), "profile", F.lit(n_codes).alias("n_codes"))


def batch_stats(requests: DataFrame, notes: DataFrame) -> DataFrame:
    """By profile: asked, generated, valid, validation_rate (per cent); a profile whose notes all failed has zeros."""
    valid = F.col("validation_result.is_valid") if "validation_result" in notes.columns else F.lit(True)  # what was not checked counts as valid
    made = notes.groupBy("profile").agg(F.count("*").alias("generated"), F.count_if(valid).alias("valid"))
    asked = requests.groupBy("profile").agg(F.count("*").alias("asked"))
    rows = asked.join(made, "profile", "left").fillna(0, ["generated", "valid"])
    return rows.select("profile", "asked", "generated", "valid", F.coalesce(F.try_divide(F.col("valid") * 100.0, F.col("generated")), F.lit(0.0)).alias("validation_rate"))


def common_issues(notes: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent issues and warnings of invalid notes: issue, occurrences; ties by issue."""
    r = F.col("validation_result")
    issues = notes.where(~r["is_valid"]).select(F.explode(F.concat(r["critical_issues"], r["warnings"])).alias("issue"))
    return issues.groupBy("issue").agg(F.count("*").alias("occurrences")).orderBy(F.desc("occurrences"), "issue").limit(n)


def first_codes(notes: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` codes of each profile's first note (by note_idx), to look at: profile, codes."""
    least = notes.groupBy("profile").agg(F.min_by("codes", "note_idx").alias("c"))
    return least.select("profile", F.transform(F.slice("c", 1, n), lambda c: c["code"]).alias("codes"))


@dataclass
class Batch:
    """A batch's notes (a table), its requests that failed (note_idx, profile, error), statistics by profile, frequent
    issues, first codes, the counters of calls, and whether it made enough notes."""

    notes: DataFrame
    failures: DataFrame
    stats: DataFrame
    issues: DataFrame
    samples: DataFrame
    calls: DataFrame
    succeeded: bool


def run_batch(requests: DataFrame, catalog: DataFrame, profiles: DataFrame, out_dir: str, generate: textgen.Generate = textgen.stub, seed: int = 42, retry: bool = False, waves: int = 4, validate: bool = True, threshold: float = PASS_CONFIDENCE) -> Batch:
    """Notes for ``requests``, answers kept in ``out_dir``/answers; a failure costs its own note only.

    Every note is generated once: statistics, issues and the notes themselves read what was written, and a second run
    over ``out_dir`` asks only for what is missing.  The batch succeeds with four fifths of the notes asked for.
    """
    requests = table(requests, "requests")
    made = durable_answers(asked_codes(requests, catalog, profiles, seed), f"{out_dir}/answers", generate, retry=retry, waves=waves)
    own = made.join(requests.select("note_idx"), "note_idx", "left_semi")
    notes = table(notes_of_answers(own, validate, threshold), "notes")
    failed = own.where(F.col("raw").isNull()).join(notes.select("note_idx"), "note_idx", "left_anti")
    failures = failed.groupBy("note_idx", "profile").agg(F.max("raw_error").alias("error"))
    stats = batch_stats(requests, notes)
    total = stats.agg(F.sum("asked").alias("asked"), F.sum("generated").alias("generated")).head()
    enough = (total["generated"] or 0) >= BATCH_SUCCESS * (total["asked"] or 0)
    issues = common_issues(notes) if validate else notes.sparkSession.createDataFrame([], "issue string, occurrences long")
    return Batch(notes, failures, stats, issues, first_codes(notes), textgen.client_rates(own, "raw"), enough)


def multi_profile_batch(catalog: DataFrame, profiles: DataFrame, per_profile: int | None = 10, n_codes: int = 3, generate: textgen.Generate = textgen.stub, seed: int = 42, retry: bool = False, names: list[str] | None = None, out_dir: str | None = None) -> Batch:
    """``run_batch`` with ``per_profile`` notes for each of several profiles.

    ``names`` chooses among ``profiles``; they may name profiles that are not there, which are filled at random.
    Without ``out_dir`` answers are kept in a scratch folder.
    """
    spark = catalog.sparkSession
    wanted = profiles if names is None else spark.createDataFrame([(n,) for n in names], "profile string")
    return run_batch(batch_requests(wanted, per_profile, n_codes), catalog, profiles, out_dir or scratch_path(spark, "batch"), generate, seed, retry)


def batch_by_settings(settings: Settings, requests: DataFrame, catalog: DataFrame, profiles: DataFrame, generate: textgen.Generate, seed: int = 42) -> Batch:
    """``run_batch`` under the settings: codes a note (n_codes is drawn), retries and spacing of calls, the folder, and,
    where validation is on, the confidence a note needs.  ``requests`` has note_idx and profile."""
    settings.check()
    drawn = sampling.codes_per_note(requests.select("note_idx", "profile"), settings.min_codes_per_note, settings.max_codes_per_note, seed)
    client = textgen.with_retries(generate, attempts=settings.max_retries, spacing=settings.rate_limit_delay)
    return run_batch(drawn, catalog, profiles, settings.output_directory, client, seed, validate=settings.enable_validation, threshold=settings.confidence_threshold)
