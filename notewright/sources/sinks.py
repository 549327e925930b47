"""Sinks: JSON arrays, JSONL, reports and event logs."""

from __future__ import annotations

import html
import json
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.sources.scratch import table


def _array_lines(batches):
    """Lines of one part: an item each, a comma after all but the array's last, brackets around its first and last."""
    held, first = None, True
    for b in batches:
        lines = []
        for item, begins, ends in zip(*(b.column(c).to_pylist() for c in ("item", "begins", "ends"))):
            if held is not None:
                lines.append(held[0] + ",")
            if first and begins:
                lines.append("[")
            held, first = (item, ends), False
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held[0], "]"] if held[1] else [held[0] + ","], pa.string())], ["value"])


def write_json_array(rows: DataFrame, path: str, order: str | list[str] | None = None) -> None:
    """A folder of text files that follow each other by name and together are one JSON array, nulls written.

    Rows are sorted by ``order`` by ranges, so each part is written by a task of its own; without it they keep their order
    and are written to a scratch table first.  No rows give an empty array.
    """
    if order is None:
        rows, keys = table(rows.select("*", F.monotonically_increasing_id().alias("_at")), "items"), ["_at"]
    else:
        keys = [order] if isinstance(order, str) else order
    written = [c for c in rows.columns if c != "_at"]
    keyed = rows.select(F.struct(*keys).alias("k"), F.to_json(F.struct(*written), {"ignoreNullFields": "false"}).alias("item"))
    ends = keyed.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    if ends.head()["lo"] is None:
        rows.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    by = [F.col(f"k.{c}") for c in keys]
    marked = keyed.crossJoin(F.broadcast(ends)).select("k", "item", (F.col("k") == F.col("lo")).alias("begins"), (F.col("k") == F.col("hi")).alias("ends"))  # one row
    marked.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_array_lines, "value string").write.mode("overwrite").text(path)


def save_notes(notes: DataFrame, out_dir: str, prefix: str = "clinical_notes", at: datetime | None = None) -> str:
    """Saves note records (``records.serialized``) as a JSON array by note_id, under a name stamped with the time; its path."""
    path = f"{out_dir.rstrip('/')}/{prefix}_{(at or datetime.now()):%Y%m%d_%H%M%S}.json"
    write_json_array(notes, path, "note_id")
    return path


def write_samples(samples: DataFrame, path: str) -> None:
    """JSONL of messages, note_id, metadata, in parallel files; samples without metadata get null."""
    if "metadata" not in samples.columns:
        samples = samples.withColumn("metadata", F.lit(None).cast("variant"))
    samples.select("messages", "note_id", "metadata").write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def metrics_document(summary: DataFrame, per_class: DataFrame, **metadata) -> dict:
    """The metrics as one document; ``summary`` has one row, ``per_class`` one per label."""
    doc = {"timestamp": datetime.now(timezone.utc).isoformat(), **summary.head().asDict()}
    doc["per_class"] = {r["label"]: {k: r[k] for k in ("precision", "recall", "f1")} for r in per_class.toLocalIterator()}
    return doc | ({"metadata": metadata} if metadata else {})


def save_metrics(document: dict, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(document, f, indent=2, ensure_ascii=False)


def html_report(summary: DataFrame, top_classes: DataFrame) -> str:
    """The overall metrics and the given classes as an HTML page."""
    cells = lambda values: "".join(f"<td>{html.escape(str(v))}</td>" for v in values)
    overall = "".join(f"<tr>{cells((k, f'{v:.4f}' if isinstance(v, float) else v))}</tr>" for k, v in summary.head().asDict().items())
    classes = "".join(f"<tr>{cells((r['label'], *(f'{r[k]:.3f}' for k in ('precision', 'recall', 'f1'))))}</tr>" for r in top_classes.collect())
    return f"<html><body><h1>Evaluation</h1><table>{overall}</table><h2>Classes</h2><table><tr><th>label</th><th>precision</th><th>recall</th><th>f1</th></tr>{classes}</table></body></html>"


def log_events(rows: DataFrame) -> DataFrame:
    """Event rows (ts, level, logger, message, extras map) as JSON lines: a UTC time with Z, extras beside the rest."""
    head = F.create_map(
        F.lit("timestamp"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")), F.lit("level"), F.col("level"), F.lit("logger"), F.col("logger"), F.lit("message"), F.col("message")
    )
    return rows.select(F.to_json(F.map_concat(head, F.map_filter("extras", lambda k, v: ~k.isin("timestamp", "level", "logger", "message")))).alias("value"))
