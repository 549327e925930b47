"""Evaluation: pick turns, predict, parse, score."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.constants import SYSTEM_PROMPT, USER_PREFIX
from notewright.functions.parsing import parse_codes
from notewright.operators import chat, metrics, textgen
from notewright.sources import sinks


def predictions(samples: DataFrame, predict: textgen.Generate, key: str = "note_id", repeat_prefix: bool = True, template: bool = False, system: str = SYSTEM_PROMPT, max_tokens: int | None = None) -> DataFrame:
    """(index, predicted, truth) of chat samples.

    The stored user turn already has its prefix and is given it again, unless ``repeat_prefix`` is false.
    With ``template`` the model is given a system and a user turn as ChatML, cut at ``max_tokens``.
    """
    user = chat.first_content(F.col("messages"), "user")
    user = F.concat(F.lit(USER_PREFIX), user) if repeat_prefix else user
    asked = samples.select(F.col(key).alias("index"), (chat.inference_prompt(user, system, max_tokens) if template else user).alias("prompt"), parse_codes(chat.first_content(F.col("messages"), "assistant")).alias("truth"))
    said = textgen.generate_text(asked, "prompt", "output", predict)
    return said.select("index", parse_codes(F.col("output")).alias("predicted"), "truth")


@dataclass
class Report:
    """An evaluation: its pairs, per-class and per-sample results, the document of metrics and the HTML page."""

    pairs: DataFrame
    classes: DataFrame
    samples: DataFrame
    document: dict
    page: str


def report(pairs: DataFrame, top: int = 20, **metadata) -> Report:
    """The whole report of (index, predicted, truth), which is read several times: pass a table."""
    summary, classes = metrics.summary(pairs), metrics.per_class(pairs)
    return Report(pairs, classes, metrics.per_sample(pairs), sinks.metrics_document(summary, classes, **metadata), sinks.html_report(summary, metrics.top_classes(pairs, top)))


def evaluate_samples(samples: DataFrame, predict: textgen.Generate, out_dir: str, key: str = "note_id", repeat_prefix: bool = True, template: bool = True, max_tokens: int | None = 512, **metadata) -> Report:
    """Predict, parse, score and write: pairs as Parquet in ``out_dir``/pairs, metrics.json and report.html beside it.

    ``out_dir`` may be on any file system of Spark's.
    """
    spark = samples.sparkSession
    predictions(samples, predict, key, repeat_prefix, template, max_tokens=max_tokens).write.mode("overwrite").parquet(f"{out_dir}/pairs")
    made = report(spark.read.parquet(f"{out_dir}/pairs"), **metadata)
    for name, text in (("metrics.json", json.dumps(made.document, indent=2, ensure_ascii=False)), ("report.html", made.page)):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out_dir}/{name}")
    return made
