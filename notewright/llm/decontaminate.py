"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's windows of ``window`` words; the alphabet is
the word, and a block is a pair of neighbouring words.  For each pattern length
there is one searcher: its shift table tells how far the search may jump when a
block ends at a position (the whole pattern, less the block, when no pattern
holds it), the bucket of the last block lists the patterns that may end there,
and only a direct comparison counts as an occurrence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import ascii_words, slices, table, tidy


class WuManber:
    """Patterns of one length (in words); ``scan`` yields (start, pattern) of each occurrence."""

    def __init__(self, length: int, patterns: list[tuple[bytes, ...]]):
        self.m, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for p in patterns:
            for end in range(self.block, length + 1):
                key = p[end - 1] if self.block == 1 else p[end - 2 : end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.bucket.setdefault(key, {}).setdefault(p[0], []).append(p)

    def scan(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        m, n, default, shift = self.m, len(words), self.default, self.shift
        i = m - 1
        while i < n:
            key = words[i] if self.block == 1 else (words[i - 1], words[i])
            jump = shift.get(key, default)
            if jump:
                i += jump
                continue
            start = i - m + 1
            for p in self.bucket[key].get(words[start], ()):
                if p == tuple(words[start : i + 1]):
                    yield start, p
            i += 1


def windows_of(words: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    """An item's windows: ``window`` consecutive words; an item of fewer, but not none, is one window."""
    if not words:
        return []
    if len(words) < window:
        return [tuple(words)]
    return [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """The distinct (window, item_id) of the benchmark; a window is its words with blanks between."""

    def cut(batches):
        for b in slices(batches, 100):
            ids, keys = [], []
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                found = {b" ".join(p) for p in windows_of(ascii_words(text), window)}
                keys += found
                ids += [item] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], ["window", "item_id"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(cut, "window binary, item_id long").distinct()


def _parts(benchmark: DataFrame, window: int, max_windows: int) -> Iterator[dict]:
    """The windows, cut by a Spark job, in parts of about ``max_windows``, one at least: {window: item ids}; only one is in the driver at a time."""
    rows = table(_windows(benchmark, window), "windows")
    n = max(1, -(-rows.count() // max_windows))
    if n > 1:  # a window of many items goes to several parts
        rows = rows.withColumn("part", F.pmod(F.xxhash64("window", "item_id"), F.lit(n)).cast("int"))
        rows = table(rows.repartition("part"), "window-parts", ["part"])
    for i in range(n):
        part: dict = {}
        for r in (rows.where(F.col("part") == i) if n > 1 else rows).toLocalIterator():
            part.setdefault(tuple(bytes(r["window"]).split(b" ")), set()).add(r["item_id"])
        yield part


def _in_passes(state: DataFrame, parts: Iterator[dict], search: Callable[[DataFrame, Broadcast], DataFrame], chained: int = 4) -> DataFrame:
    """``state`` searched for each part in turn.  After ``chained`` parts it is written and their broadcasts are freed, so the
    Python workers of a task and what executors hold don't grow with the benchmark."""
    held: list[Broadcast] = []
    for part in parts:
        if len(held) == chained:
            state = table(state, "searched")
            for b in held:
                b.destroy()
            held = []
        held.append(state.sparkSession.sparkContext.broadcast(part))
        state = search(state, held[-1])
    return state


def _merge(spans: list[int]) -> list[int]:
    """Union of half-open spans [a, b, a, b, ...], sorted."""
    out: list[int] = []
    for a, b in sorted(zip(spans[0::2], spans[1::2])):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_windows: int = 200_000, keep_text: bool = False) -> DataFrame:
    """Hits of benchmark windows in each whole document.

    ``docs`` has doc_id and text, ``benchmark`` has item_id and text.  One row per row of ``docs``:
    doc_id, n_words, n_hit (words inside any occurrence), n_items, items_sha256 (of the item ids, sorted
    as strings, comma-joined), contaminated (n_hit > 0), items (their ids), hit_spans (word positions
    [from, to, from, to ...)); with ``keep_text`` also text.  Null texts have no words.  Ids may be null or
    repeated: each document row is searched by itself; a repeated item id is named once; an item without
    an id still hits words but can't be named.  An empty benchmark hits nothing.  Other columns are ignored.

    The benchmark's windows are cut by a Spark job and broadcast in parts of about ``max_windows``.  A larger
    benchmark takes one narrow pass over the documents per part, each adding to the spans and items found before
    (written every few parts); the documents are not shuffled.
    """
    state = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.array().cast("array<long>").alias("hit_spans"),
        F.array().cast("array<long>").alias("items"),
    )
    state = _in_passes(state, _parts(benchmark, window, max_windows), _search)
    n_hit = F.aggregate(F.transform("hit_spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda a, x: a + x)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    out = state.withColumn("n_hit", n_hit)
    columns = ["doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items", "hit_spans"]
    return out.select(*columns, *(["text"] if keep_text else []))


def _searchers(windows) -> list[WuManber]:
    """One searcher for each length of window."""
    by_length: dict[int, list] = {}
    for p in windows:
        by_length.setdefault(len(p), []).append(p)
    return [WuManber(m, ps) for m, ps in by_length.items()]


def _search(state: DataFrame, part) -> DataFrame:
    @tidy("decontaminate")
    def search(batches):
        owners = part.value
        searchers = _searchers(owners)
        for b in slices(batches):
            all_spans, all_items, n_words = [], [], []
            for text, spans, items in zip(b.column("text").to_pylist(), b.column("hit_spans").to_pylist(), b.column("items").to_pylist()):
                words = ascii_words(text)
                found = set(items)
                for s in searchers:
                    for start, p in s.scan(words):
                        spans += [start, start + s.m]
                        found |= owners[p]
                found.discard(None)
                all_spans.append(_merge(spans) if spans else spans)
                all_items.append(sorted(found))
                n_words.append(len(words))
            longs = pa.list_(pa.int64())
            columns = [b.column("doc_id"), b.column("text"), pa.array(all_spans, longs), pa.array(all_items, longs), pa.array(n_words, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "hit_spans", "items", "n_words"])

    rows = state.select("doc_id", "text", "hit_spans", "items")
    return rows.mapInArrow(search, "doc_id long, text string, hit_spans array<long>, items array<long>, n_words long")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_windows: int = 200_000) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs; as ``contamination`` otherwise."""
    return _in_passes(docs, _parts(benchmark, window, max_windows), lambda rows, part: rows.mapInArrow(_without(part), rows.schema))


def _without(part):
    @tidy("decontaminate")
    def clean(batches):
        searchers = _searchers(part.value)
        for b in slices(batches):
            words = map(ascii_words, b.column("text").to_pylist())
            yield b.filter(pa.array([not any(next(s.scan(w), None) for s in searchers) for w in words], pa.bool_()))

    return clean


#: The same result in SQL, for small tables.
ORACLE = r"""
WITH dw AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
pos AS (
  SELECT rid, m, i, array_to_string(w[i:i + m - 1], ' ') AS p
  FROM (SELECT rid, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, lens WHERE len(w) >= m)),
hits AS (SELECT pos.rid, pos.i, pos.m, win.item_id FROM pos JOIN win ON pos.m = win.m AND pos.p = win.p),
cov AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS j FROM hits) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
