"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets.

Texts with one shingle set are one node.  Band and row counts follow from a
target recall at the threshold; nodes are shuffled on their band hashes, and
nodes that share one fall in one candidate group (by components, so no bucket
is expanded into pairs).  Inside a group all full sets are compared, in blocks
of bounded size, so the links found include all that share a band, and each is
exact.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import mix64, shingle_sets, slices, table, tidy
from notewright.llm.components import components


def banding(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach ``recall`` at ``threshold`` within ``max_hashes``."""
    best = (1, 1)
    for rows in range(1, max_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


class MinHasher:
    """Band hashes of shingle sets."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = bands * rows
        self.bands, self.rows = bands, rows
        self.xor = rng.integers(0, 2**32, n, np.uint32)
        self.odd = rng.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        least = None
        for at in range(0, len(low), 1024):
            x = (low[at : at + 1024, None] ^ self.xor) * self.odd
            x ^= x >> np.uint32(15)
            found = (x * np.uint32(0x2C1B3C6D)).min(axis=0)
            least = found if least is None else np.minimum(least, found)
        signature = least.reshape(self.bands, self.rows).astype(np.uint64)
        keys = np.arange(self.bands, dtype=np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            for j in range(self.rows):
                keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + signature[:, j])
        return keys.view(np.int64)


def _signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    @tidy("jaccard")
    def sign(batches):
        hasher = MinHasher(bands, rows)
        for b in slices(batches):
            fp, size, keys = [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), width):
                fp.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                size.append(len(s))
                keys.append(hasher(s) if len(s) else [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("md5"), pa.array(fp, pa.binary()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "md5", "fp", "size", "bands"])

    return docs.mapInArrow(sign, "doc_id long, md5 binary, fp binary, size long, bands array<long>")


def compare(sets: list[np.ndarray], left: int, threshold: Fraction) -> np.ndarray:
    """Which of ``sets[:left]`` and ``sets[left:]`` (or, if left is 0, of all) link: a symmetric boolean matrix.

    Shingles held by many sets are multiplied as a dense matrix, those held by few are counted pair by pair.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    held = np.diff(np.append(first, len(flat)))
    common = np.zeros((n, n), np.float32)
    heavy = np.flatnonzero(held > 24)
    for at in range(0, len(heavy), 1024):
        part = heavy[at : at + 1024]
        cells = np.concatenate([np.arange(first[c], first[c] + held[c]) for c in part])
        dense = np.zeros((n, len(part)), np.float32)
        dense[owner[cells], np.repeat(np.arange(len(part)), held[part])] = 1
        common += dense @ dense.T
    for h in np.unique(held[(held > 1) & (held <= 24)]):
        at = first[held == h]
        own = owner[at[:, None] + np.arange(h)]
        i, j = np.triu_indices(h, 1)
        pair, times = np.unique(own[:, i].astype(np.int64) * n + own[:, j], return_counts=True)
        a, b = pair // n, pair % n
        np.add.at(common, (a, b), times)
        np.add.at(common, (b, a), times)
    p, q = threshold.numerator, threshold.denominator
    linked = np.empty((n, n), bool)
    for at in range(0, n, 256):
        linked[at : at + 256] = common[at : at + 256].astype(np.int64) * (p + q) >= p * (size[at : at + 256, None] + size)
    np.fill_diagonal(linked, False)
    if left:
        linked[:left, :left] = False
        linked[left:, left:] = False
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first row connected with each row."""
    root = np.full(len(linked), -1)
    for start in range(len(linked)):
        if root[start] < 0:
            root[start], edge = start, [start]
            while edge:
                new = np.flatnonzero(linked[edge].any(axis=0) & (root < 0))
                root[new] = start
                edge = list(new)
    return root


def _verify(width: int, threshold: Fraction):
    def links(block: list[tuple], diagonal: bool) -> tuple[list, list, list]:
        """Rows (fp, copies, side, text) of one block, by fp -> fp, links, least linked fp."""
        block.sort(key=lambda r: (r[2], r[0]))
        left = 0 if diagonal else sum(r[2] == 0 for r in block)
        if not diagonal and left in (0, len(block)):  # the other part is empty
            return [], [], []
        linked = compare(list(shingle_sets([r[3] for r in block], width)), left, threshold)
        copies = np.array([r[1] for r in block], np.int64)
        fps = [r[0] for r in block]
        roots = _roots(linked)
        return fps, (linked @ copies).tolist(), [fps[i] for i in roots]

    @tidy("jaccard")
    def run(batches):
        key, block, out = None, [], ([], [], [])

        def flush():
            made = [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())]
            for o in out:
                o.clear()
            return pa.RecordBatch.from_arrays(made, ["fp", "links", "root"])

        for b in slices(batches):
            for row in zip(*(b.column(c).to_pylist() for c in ("root", "i", "j", "fp", "copies", "side", "text"))):
                if row[:3] != key:
                    if len(block) > 1:
                        for o, x in zip(out, links(block, key[1] == key[2])):
                            o.extend(x)
                    if len(out[0]) > 10_000:
                        yield flush()
                    key, block = row[:3], []
                block.append(row[3:])
        if len(block) > 1:
            for o, x in zip(out, links(block, key[1] == key[2])):
                o.extend(x)
        yield flush()

    return run


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    recall: float = 0.9995,
    max_hashes: int = 160,
    block_rows: int = 1024,
    block_shingles: int = 500_000,
) -> DataFrame:
    """Join documents whose sets of ``width``-word shingles have a Jaccard similarity of at least ``threshold``.

    One row per row of ``docs`` (doc_id, text): doc_id, class_id (the least doc_id of all that links connect
    with it), n_links (other rows it links to, copies included), n_copies (rows of the same shingle set).
    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; a text of fewer than ``width``
    words is one shingle.  A null text, or one without words, links to nothing and is its own class.  Rows may
    share a doc_id: each counts as a document.  A null id is never a class id while another is there.
    Other columns are ignored; an empty table gives an empty result.

    Links are exact for all pairs in one candidate group; a link is missed only if no chain of shared bands
    joins its two texts, which at the threshold has a probability of less than 1 - ``recall``.
    A task holds two blocks of a group, each of about ``block_rows`` rows or ``block_shingles`` shingles.
    """
    signed, full = _classes(docs, threshold, width, recall, max_hashes, block_rows, block_shingles)
    named = full.groupBy("root").agg(F.min("least").alias("class_id"))
    found = full.join(named, "root").select("fp", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("copies").alias("n_copies"))
    linked = signed.where(F.col("fp").isNotNull()).select("doc_id", "fp").join(found, "fp").select("doc_id", "class_id", "n_links", "n_copies")
    alone = signed.where(F.col("fp").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"))
    return linked.unionAll(alone)


def one_of_each(docs: DataFrame, threshold: float = 0.8, width: int = 5, **bounds) -> DataFrame:
    """The rows of ``docs``, all columns, without those near another: of each class the least doc_id stays.

    A null id stays only where its class has no other; of rows with that id, those of one text, once.  Texts
    without words all stay.  As ``near_duplicates`` otherwise.
    """
    signed, full = _classes(docs, threshold, width, **bounds)
    member = signed.where(F.col("fp").isNotNull()).select("doc_id", "md5", "fp").join(full.select("fp", "root"), "fp")
    best = member.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "md5")).alias("m")).select(F.col("m.doc_id").alias("best_id"), F.col("m.md5").alias("best_md5"))
    text = F.col("text").cast("string")
    worded = F.coalesce(text.rlike("[0-9A-Za-z]|[^\\x00-\\x7F]"), F.lit(False))
    marked = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(text)).alias("md5"), worded.alias("worded"))
    kept = marked.where("worded").join(best, F.col("id").eqNullSafe(F.col("best_id")) & (F.col("md5") == F.col("best_md5")), "left_semi").dropDuplicates(["id", "md5"])
    return kept.unionByName(marked.where("not worded")).select("row.*")


def _classes(docs: DataFrame, threshold: float, width: int, recall: float = 0.9995, max_hashes: int = 160, block_rows: int = 1024, block_shingles: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, md5, fp) of all documents, and their nodes (fp, copies, least, links, root)."""
    exact = Fraction(threshold).limit_denominator(10_000)
    bands, rows = banding(threshold, recall, max_hashes)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("md5", F.unhex(F.md5("text")))
    signed = table(_signatures(docs, width, bands, rows), "signatures")
    nodes = signed.where(F.col("fp").isNotNull()).groupBy("fp").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.min("md5").alias("md5"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    nodes = table(nodes, "nodes")

    banded = nodes.select("fp", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("fp").alias("root"), F.max("fp").alias("last")).where(F.col("root") != F.col("last")).select("key", "root")
    candidates = components(banded.join(shared, "key").select(F.col("fp").alias("a"), F.col("root").alias("b")))

    grouped = table(candidates.withColumnRenamed("node", "fp").join(nodes.drop("bands"), "fp"), "groups")
    parts = grouped.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / block_rows), F.ceil(F.sum("size") / block_shingles)).cast("int").alias("parts"))
    members = grouped.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # One of the texts of each node; found by its hash, as ids may be null or repeated.
    texts = docs.groupBy("md5").agg(F.first("text").alias("text")).join(members, "md5")
    pairs = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = pairs.select("root", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp", "copies", (F.col("part") > F.col("other")).cast("int").alias("side"), "text")
    blocks = pairs.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    verified = table(blocks.mapInArrow(_verify(width, exact), "fp binary, links long, root binary"), "links")

    classes = components(verified.select(F.col("fp").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "fp")
    links = verified.groupBy("fp").agg(F.sum("links").alias("links"))
    full = nodes.select("fp", "copies", "least").join(links, "fp", "left").join(classes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return signed.drop("bands", "size"), full
