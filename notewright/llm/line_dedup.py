"""Line dedup over levelled sorted runs of line hashes.

A run is a Parquet table of (h1, h2, n_docs, max_doc), one row per line key,
sorted by the 128-bit hash within partitions.  Each batch of documents is
merge-anti-joined against the runs, which tells its new lines from the known
ones, and adds a run of its own.  Batches come with falling doc_ids, so a known
line has been held by a larger one.  When a level holds ``fanout`` runs they are
merged into one run of the next level, so a key is rewritten a logarithmic
number of times.  Everything is a Spark job; runs live in the shared folder.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.llm.common import slices, table, tidy

_STRIP = b" \t\n\x0b\x0c\r"
_RUN = "h1 long, h2 long, n_docs long, max_doc long"
#: Stands for a null doc_id: one document, smaller than any other.
_NO_ID = -(1 << 63)


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key (stripped, A-Z lower-cased); None if the key is shorter than ``min_chars``."""
    key = line.strip(_STRIP).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "surrogatepass")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """The distinct line keys of each row of ``docs``: doc_id, h1, h2."""

    @tidy("line_dedup")
    def keys(batches):
        for b in slices(batches):
            ids, found = [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if text:
                    own = {line_hash(x, min_chars) for x in text.encode("utf-8", "surrogatepass").split(b"\n")}
                    own.discard(None)
                    ids += [_NO_ID if doc_id is None else doc_id] * len(own)
                    found += own
            h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1])], ["doc_id", "h1", "h2"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(keys, "doc_id long, h1 long, h2 long")


class LineRuns:
    """The levelled runs of one corpus."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for r in runs[1:]:
            rows = rows.unionAll(r)
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def merged(self) -> DataFrame:
        """All runs as one: (h1, h2, n_docs, max_doc)."""
        return self._merged(self.runs()) if self.runs() else self.spark.createDataFrame([], _RUN)

    def new_lines(self, keys: DataFrame) -> DataFrame:
        """Merge-anti-join: the rows of ``keys`` (doc_id, h1, h2) whose line no run holds."""
        for run in self.runs():
            keys = keys.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti")
        return keys

    def append(self, keys: DataFrame) -> None:
        """Add a batch (doc_id, h1, h2) as a run of its own, then compact full levels.

        A document must come in one batch; its repeated rows count once.
        """
        once = keys.distinct()
        run = once.groupBy("h1", "h2").agg(F.count("doc_id").alias("n_docs"), F.max("doc_id").alias("max_doc"))
        self._add(0, run)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._add(level + 1, self._merged(full))
            level += 1

    def repeats(self, keys: DataFrame) -> DataFrame:
        """Take in a batch; its rows whose line an earlier batch holds, or a larger doc_id of this batch.

        Batches must come with falling doc_ids for the rest to be each line's largest holder.
        """
        first = self.new_lines(keys).groupBy("h1", "h2").agg(F.max("doc_id").alias("first"))
        again = keys.join(first, ["h1", "h2"], "left").where(F.col("first").isNull() | (F.col("doc_id") < F.col("first")))
        self.append(keys)
        return again.select("doc_id", "h1", "h2")

    def _add(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(table(run.sortWithinPartitions("h1", "h2"), f"lines-l{level}"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2) -> DataFrame:
    """Drop lines found in many documents, except in the largest doc_id holding them.

    Texts are split at \\n.  A line's key is the line stripped of white space, A-Z lower-cased.  Keys of at
    least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines except in
    the largest doc_id holding it; other lines stay, in order, joined by \\n.  One row per row of ``docs``:
    doc_id, n_lines (before), n_dropped, kept_sha256, text (what is kept; null stays null).

    Null or empty texts have one empty line.  Rows with one doc_id are one document: each row is cleaned,
    all count once.  Null ids are one document, smaller than any other.  Other columns go along in a struct
    ``rest``.
    """
    spark = docs.sparkSession
    cuts = docs.select(F.col("doc_id").cast("long").alias("doc_id")).approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
    batch = sum(((F.col("doc_id") < c).cast("int") for c in cuts), F.lit(0))
    keys = table(document_keys(docs, min_chars).withColumn("batch", batch), "line-keys", ["batch"])
    runs, again = LineRuns(spark, fanout), []
    for i in range(len(cuts) + 1):  # from the largest doc_ids down
        again.append(runs.repeats(keys.where(F.col("batch") == i).drop("batch")))
    common = runs.merged().where(F.col("n_docs") >= min_docs).select("h1", "h2")
    lost = reduce(DataFrame.unionAll, again).join(common, ["h1", "h2"])
    return drop_lines(docs, lost.select("doc_id", "h1", "h2").distinct(), min_chars)


def drop_lines(docs: DataFrame, lost: DataFrame, min_chars: int = 20) -> DataFrame:
    """Take the lines ``lost`` (doc_id, h1, h2; distinct) out of ``docs``; the columns of ``dedup_lines``.

    Other columns go along in a struct ``rest``, null if there are none.
    """
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    per_doc = lost.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("h1", "h2")).alias("lost"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest"))
    joined = rows.withColumn("_id", F.coalesce("doc_id", F.lit(_NO_ID))).join(per_doc, "_id", "left").select("doc_id", "text", "rest", "lost")

    @tidy("line_dedup")
    def clean(batches):
        for b in slices(batches):
            n_lines, n_dropped, sha, kept_text = [], [], [], []
            lost_column = b.column("lost")
            flat = lost_column.flatten()
            h = np.empty((len(flat), 2), "<i8")
            h[:, 0], h[:, 1] = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            raw, at = h.tobytes(), 0
            for text, n in zip(b.column("text").to_pylist(), lost_column.value_lengths().to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                lines = data.split(b"\n")
                n_lines.append(len(lines))
                kept = lines
                if n:
                    gone = {raw[i : i + 16] for i in range(16 * at, 16 * (at + n), 16)}
                    at += n
                    kept = [x for x in lines if line_hash(x, min_chars) not in gone]
                    data = b"\n".join(kept)
                n_dropped.append(len(lines) - len(kept))
                sha.append(hashlib.sha256(data).hexdigest())
                kept_text.append(None if text is None else data.decode("utf-8", "surrogatepass") if n else text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sha), pa.array(kept_text, pa.string()), b.column("rest")], ["doc_id", "n_lines", "n_dropped", "kept_sha256", "text", "rest"])

    schema = T.StructType.fromDDL("doc_id long, n_lines long, n_dropped long, kept_sha256 string, text string")
    return joined.mapInArrow(clean, schema.add(joined.schema["rest"]))


#: The same result in SQL.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, coalesce(doc_id, -9223372036854775808) AS k, i, ls[i] AS line,
    translate(trim(ls[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
c AS (SELECT key, max(k) AS most FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT k) >= 3)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM (SELECT l.*, c.key IS NOT NULL AND k < most AS gone FROM l LEFT JOIN c ON l.key = c.key)
GROUP BY rid, doc_id
"""
