"""Phrase collocation mining by dynamic itemset counting.

The corpus is dealt into a few shards that are scanned in turn, round and round.
Words are counted from the start.  A longer phrase becomes active in the step after
both its beginning and its end (one word shorter each) have reached the threshold, and
is counted for one full cycle of shards, whichever shard that begins with; lengths are
thus counted side by side, in one scan.

A phrase reaches the threshold when one shard holds its share of it (the threshold by
the number of shards, rounded up): whatever reaches it in all reaches its share
somewhere.  So no step needs the counts of another, and phrases that are rare in every
shard, which are nearly all, are forgotten after their one shuffle.  What has reached
the threshold is told to the scans by a bit filter of fixed size, to which bits are
only ever added: "active" means that a phrase passes now and did not a cycle ago.  Scans
count by the filter's bits; tasks send their counts, packed, to owners of ranges of bits.
Phrases that share a bit are counted together, which costs counting and nothing else.

An exact check follows: one more scan counts, by their words, the phrases that reached
their share.  Scans see words as hashes only, computed for a whole chunk at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import _powers, mix64, scratch_path, slices, table

#: Bytes of text as letters of pieces: A-Z lower-cased, what ends a piece as ".", a tab as a blank.
_PIECES = bytes(ord(".") if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = b"."
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Text at a time, counts that a task holds before it passes them on, and bytes of names.
_CHUNK, _COUNTS, _NAMES = 2_000_000, 2_000_000, 200_000_000
#: Bits that one owner counts: a power of two; and the most that a count is told as.
_RANGE, _ENOUGH = 20, 255
#: Filters have 2**20 bits at least and 2**30 (128 MB) at most.
_FEWEST, _MOST = 20, 30
#: Bytes of a word from which its second hash is not a sum.
_LONG = 32
#: The counts of phrases are broadcast with at most so many rows and bytes of phrases; else joined by shuffles.
_SMALL_ROWS, _SMALL_BYTES = 1_000_000, 32_000_000
#: What bytes stand for in the two hashes of a word.
_BYTES = [mix64(np.arange(256, dtype=np.uint64) + np.uint64(k)) for k in (1, 1 << 40)]


def chunks(texts: list[bytes]) -> Iterator[bytes]:
    """Texts joined, and long ones cut, where a piece ends."""
    group, size = [], 0
    for t in texts:
        t = t.translate(_PIECES)
        while len(t) > _CHUNK:
            cut = t.rfind(_END, 0, _CHUNK) + 1 or t.find(_END) + 1 or len(t)
            yield t[:cut]
            t = t[cut:]
        group.append(t)
        size += len(t)
        if size > _CHUNK:
            yield _END.join(group)
            group, size = [], 0
    if group:
        yield _END.join(group)


class BitFilter:
    """A set of hashes with one bit each; may hold more than was added."""

    def __init__(self, bits: int):
        self.bits = bits
        self.words = np.zeros(max(1, (1 << bits) >> 3), np.uint8)

    def places(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.uint32)

    def has(self, h: np.ndarray) -> np.ndarray:
        p = self.places(h)
        return (self.words[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1

    def with_bits(self, places: np.ndarray) -> BitFilter:
        out = BitFilter(self.bits)
        np.copyto(out.words, self.words)
        np.bitwise_or.at(out.words, places >> 3, (1 << (places & 7)).astype(np.uint8))
        return out


class Scan:
    """The words of a chunk of one language: their hashes, where they begin and end, and which go on to the next in one piece."""

    def __init__(self, data: bytes, lang: str):
        self.data = data
        self.seed = np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))
        buf = np.frombuffer(data, np.uint8)
        ends = np.cumsum(buf == _END[0], dtype=np.int32)
        edges = np.flatnonzero(np.diff(((buf != 32) & (buf != _END[0])).view(np.int8), prepend=0, append=0))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.joined = ends[self.starts[1:]] == ends[self.ends[:-1] - 1]
        self.hash = self._hashes(_BYTES[0])

    def _hashes(self, values: np.ndarray) -> np.ndarray:
        buf = np.frombuffer(self.data, np.uint8)
        with np.errstate(over="ignore"):
            p, q = _powers(len(buf) + 1)
            prefix = np.zeros(len(buf) + 1, np.uint64)
            np.cumsum(values[buf] * p[: len(buf)], out=prefix[1:])
            return mix64((prefix[self.ends] - prefix[self.starts]) * q[self.starts] + (self.ends - self.starts).astype(np.uint64) + self.seed)

    def other(self) -> np.ndarray:
        """A second hash of each word, independent of the first; of long words, for which texts can be made that both sums
        take for one, by their bytes one by one."""
        h = self._hashes(_BYTES[1])
        for i in np.flatnonzero(self.ends - self.starts > _LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]])
        return h

    def phrases(self, longest: int, now: BitFilter, old: BitFilter | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By size from 2 on: where phrases begin that a scan by ``now`` counts and one by ``old`` does not; and their hashes.

        A phrase is counted if its beginning and its end (one word shorter each) are counted and pass, words always being counted.
        It is not enough that both pass: they may do so by bits of others, before they are counted."""
        h, n = self.hash, len(self.hash)
        key, both = h, self.joined
        for size in range(2, longest + 1):
            reached = now.has(key) if size == 2 else reached
            before = (old.has(key) if old else np.zeros(n, bool)) if size == 2 else before
            at = np.flatnonzero(reached[:-1] & reached[1:] & both)
            if not len(at):
                return
            with np.errstate(over="ignore"):
                own = mix64(key[at] * _MULTIPLIER + h[at + size - 1])
            counted = before[at] & before[at + 1]
            yield size, at[~counted], own[~counted]
            if size < longest:
                key = np.zeros(n, np.uint64)
                key[at] = own
                reached, before, both = np.zeros(n, bool), np.zeros(n, bool), np.True_
                reached[at] = now.has(own)
                if old:
                    before[at] = counted & old.has(own)

    def named(self, at: np.ndarray, size: int, keys: np.ndarray, other: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
        """Distinct phrases of ``size`` words that begin ``at``: name, count and hash.  Two hashes tell them apart."""
        check = other[at]
        with np.errstate(over="ignore"):
            for i in range(1, size):
                check = mix64(check * _MULTIPLIER + other[at + i])
        order = np.lexsort((check, keys))
        k, c = keys[order], check[order]
        first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))) if len(k) else order
        n = np.diff(first, append=len(order))
        a, b = self.starts[at[order[first]]].tolist(), self.ends[at[order[first]] + size - 1].tolist()
        for x, y, m, h in zip(a, b, n.tolist(), k[first].tolist()):
            yield b" ".join(self.data[x:y].split()) if size > 1 else self.data[x:y], m, h


def _texts_by_lang(batches) -> Iterator[dict[str, list[bytes]]]:
    for b in slices(batches, 500):
        out: dict[str, list[bytes]] = {}
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            out.setdefault(lang, []).append(text)
        yield out


def _packed(places: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted places and their counts by owner: places within its range, and counts of a byte, which is enough for any share."""
    owner = places >> _RANGE
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else []
    rows = []
    for a, b in zip(starts, [*starts[1:], len(owner)]):
        rows.append((int(owner[a]), (places[a:b] & ((1 << _RANGE) - 1)).astype("<u4").tobytes(), np.minimum(n[a:b], _ENOUGH).astype(np.uint8).tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))], ["owner", "places", "n"])


def _reached(shard: DataFrame, longest: int, filters, words: bool, share: int) -> DataFrame:
    """(place): the filter's bits whose words, if asked for, and active phrases ``shard`` holds ``share`` times or more."""

    def run(batches):
        now, old = filters.value
        found, counts, held = [], [], 0

        def counted():
            nonlocal found, counts, held
            if found:
                places, at = np.unique(np.concatenate(found), return_inverse=True)
                yield from _packed(places, np.bincount(at, np.concatenate(counts), len(places)))
            found, counts, held = [], [], 0

        for by_lang in _texts_by_lang(batches):
            for lang, texts in by_lang.items():
                for data in chunks(texts):
                    scan = Scan(data, lang)
                    for h in ([scan.hash] if words else []) + [h for _, _, h in scan.phrases(longest, now, old)]:
                        places, n = np.unique(now.places(h), return_counts=True)
                        found.append(places)
                        counts.append(n)
                        held += len(places)
                    if held > _COUNTS:
                        yield from counted()
        yield from counted()

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << _RANGE, np.uint32)
        for places, n in zip(rows.column("places").to_pylist(), rows.column("n").to_pylist()):
            total[np.frombuffer(places, "<u4")] += np.frombuffer(n, np.uint8)
        place = np.flatnonzero(total >= share) + (rows.column("owner")[0].as_py() << _RANGE)
        return pa.table({"place": pa.array(place, pa.int64())})

    return shard.mapInArrow(run, "owner long, places binary, n binary").groupBy("owner").applyInArrow(add, "place long")


def _named(docs: DataFrame, longest: int, final, owners: int, least: int) -> DataFrame:
    """(lang, size, phrase, f): exact counts of the words and phrases that pass ``final``, from ``least`` on; of size 0 the
    number of all words.  Tasks send names and counts, packed, to owners of ranges of hashes, who add them up by name."""

    def run(batches):
        passes = final.value
        shift = 64 - owners.bit_length() + 1
        found: dict[tuple[str, int], dict[bytes, list[int]]] = {}
        held = 0

        def counted():
            nonlocal held
            for (lang, size), names in found.items():
                by_owner: dict[int, list[tuple[bytes, int]]] = {}
                for name, (n, h) in names.items():
                    by_owner.setdefault(h >> shift, []).append((name, n))
                for owner, rows in by_owner.items():
                    rows.sort()
                    packed = (owner, lang, size, zlib.compress(b"\n".join([name for name, _ in rows]), 1), zlib.compress(np.array([n for _, n in rows], "<u8").tobytes(), 1))
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(packed, (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary()))], ["owner", "lang", "size", "names", "n"])
            found.clear()
            held = 0

        def add(lang: str, size: int, rows) -> None:
            nonlocal held
            names = found.setdefault((lang, size), {})
            for name, n, h in rows:
                if name in names:
                    names[name][0] += n
                else:
                    names[name] = [n, h]
                    held += len(name) + 250  # with what a dictionary needs

        for by_lang in _texts_by_lang(batches):
            for lang, texts in by_lang.items():
                for data in chunks(texts):
                    scan = Scan(data, lang)
                    add(lang, 0, [(b"", len(scan.hash), 0)])
                    other, at = scan.other(), np.flatnonzero(passes.has(scan.hash))
                    add(lang, 1, scan.named(at, 1, scan.hash[at], other))
                    for size, at, h in scan.phrases(longest, passes):
                        own = passes.has(h)
                        add(lang, size, scan.named(at[own], size, h[own], other))
                    if held > _NAMES:
                        yield from counted()
        yield from counted()

    def total(rows: pa.Table) -> pa.Table:
        out: dict[tuple[str, int], dict[bytes, int]] = {}
        for lang, size, names, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "size", "names", "n"))):
            own = out.setdefault((lang, size), {})
            for name, m in zip(zlib.decompress(names).split(b"\n"), np.frombuffer(zlib.decompress(n), "<u8").tolist()):
                own[name] = own.get(name, 0) + m
        found = [(lang, size, name, n) for (lang, size), names in out.items() for name, n in names.items() if n >= least or size == 0]
        columns = list(zip(*found)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.int64()))], names=["lang", "size", "phrase", "f"])

    packed = docs.mapInArrow(run, "owner long, lang string, size int, names binary, n binary")
    counted = packed.groupBy("owner").applyInArrow(total, "lang string, size int, phrase binary, f long")
    return counted.select("lang", "size", F.col("phrase").cast("string").alias("phrase"), "f")


def count_phrases(docs: DataFrame, longest: int = 4, least: int = 30, shards: int = 3) -> tuple[DataFrame, DataFrame]:
    """Exact counts by dynamic itemset counting: (lang, size, phrase, f) with f >= ``least``, and (lang, n) of all words.

    ``docs`` has lang and text (binary), neither null.  A phrase's occurrences are contiguous, within pieces, overlaps included.
    """
    spark = docs.sparkSession
    if not 0 < -(-least // shards) <= _ENOUGH:
        raise ValueError(f"a shard's share of the threshold must be 1 to {_ENOUGH}")
    path = scratch_path(spark, "phrase-shards")
    dealt = docs.select("lang", "text", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    dealt = spark.read.schema("lang string, text binary, shard int").parquet(path)
    size = dealt.agg(F.sum(F.octet_length("text")).alias("size")).head()["size"] or 0
    bits = min(_MOST, max(_FEWEST, (size // 8).bit_length()))
    none = BitFilter(bits)
    filters, t = [none], 0
    while t < shards or not np.array_equal(filters[t].words, filters[t - shards].words):  # until all that is active has completed its cycle
        shared = spark.sparkContext.broadcast((filters[t], filters[t - shards] if t >= shards else none))
        shard = dealt.where(F.col("shard") == t % shards).select("lang", "text")
        reached = _reached(shard, longest, shared, t < shards, -(-least // shards))
        filters.append(filters[t].with_bits(reached.toArrow().column("place").to_numpy()))  # the filter's bits at most
        if t >= shards:
            filters[t - shards] = none  # not needed again
        shared.unpersist()
        t += 1
    final = spark.sparkContext.broadcast(filters[t])
    counts = table(_named(dealt.select("lang", "text"), longest, final, 1 << min(12, max(4, bits - 20)), least), "phrase-counts")
    final.unpersist()
    return counts.where(F.col("size") > 0), counts.where(F.col("size") == 0).select("lang", F.col("f").alias("n"))


def _with_part(cuts: DataFrame, counts: DataFrame, part: str, name: str, small: bool) -> DataFrame:
    """Adds the count of the phrase in column ``part``.  Where counts are too many to be broadcast, a word that very many
    candidates begin or end with makes a large partition, which adaptive execution splits."""
    found = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(name))
    return cuts.join(F.broadcast(found) if small else found, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).drop("_lang", "_part")


def score_candidates(counts: DataFrame, scale: int = 2_000_000) -> DataFrame:
    """Candidates (phrases of two words or more) at their lowest-scoring cut: lang, phrase, size, a, l, r, score, k."""
    row = counts.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase")).alias("size")).head()
    small = row["n"] <= _SMALL_ROWS and (row["size"] or 0) <= _SMALL_BYTES
    words = F.split("phrase", " ")
    cand = counts.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))
    cuts = cand.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("rest"))
    cuts = _with_part(_with_part(cuts, counts, "first", "l", small), counts, "rest", "r", small)
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * CAST({scale} AS DECIMAL(10,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    return best.select("lang", "phrase", "size", "a", "c.l", "c.r", "c.score", "c.k")


def contained(counts: DataFrame) -> DataFrame:
    """(lang, phrase, f): of every phrase of two words or more inside longer candidates, the largest count of these."""
    words = F.split("phrase", " ")
    longer = counts.where(F.col("size") > 2).select("lang", "f", "size", words.alias("w"))
    inner = longer.withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    return inner.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("f"))


def mine_phrases(docs: DataFrame, longest: int = 4, least: int = 30, top: int | None = 2000, share: int = 80, scale: int = 2_000_000, shards: int = 3) -> DataFrame:
    """Collocations of ``docs`` (text, lang): lang, rank, phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, fall into pieces at ``.,;:!?`` and line ends, and these into words at blanks and tabs.
    Candidates are phrases of 2 to ``longest`` words that occur ``least`` times or more in a language.  Each is
    scored at the cut into two parts where floor(scale * a / (l + r)) is lowest (the first of equal ones).  A
    candidate goes if a longer one holds it and occurs at least ``share`` per cent as often.  Of each language the
    first ``top`` (None: all) by score, then count, both falling, then phrase by its bytes.

    A null language is ``und``; null and empty texts have no words.  Repeated rows count each.  An empty table, or
    one without candidates, gives no rows.  A piece is held whole in a task, texts otherwise in parts.  Other columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    counts, words = count_phrases(rows.where(F.col("text").isNotNull()), longest, least, shards)
    inside = contained(counts).select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("longer"))
    kept = score_candidates(counts, scale).join(inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
    kept = kept.where(F.expr(f"longer IS NULL OR CAST(longer AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {int(share)}"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "l", "r", "score", F.row_number().over(order).alias("rank"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same result in SQL.
ORACLE = r"""
WITH p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, m, ws[i : i + m - 1] AS ph FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, range(1, 5) t(m) WHERE len(ws) >= m)),
f AS (SELECT lang, m, ph, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, ph, f AS a FROM f WHERE m > 1 AND f >= 30),
k AS (SELECT lang, m, ph, a, k, ph[1 : k] AS x, ph[k + 1 : m] AS y FROM c, range(1, 4) t(k) WHERE k < m),
s AS (SELECT k.lang, k.m, k.ph, a, k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.ph = k.x JOIN f y ON y.lang = k.lang AND y.ph = k.y),
b AS (SELECT lang, m, ph, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS b FROM s GROUP BY ALL),
i AS (SELECT lang, ph, max(a) AS longer FROM (SELECT lang, a, ph[i : i + j - 1] AS ph FROM (SELECT lang, a, m, ph, j, unnest(range(1, m - j + 2)) AS i FROM c, range(2, 4) t(j) WHERE j < m)) GROUP BY ALL),
o AS (SELECT b.lang, array_to_string(b.ph, ' ') AS phrase, a, b.l AS l, b.r AS r, b.score AS score FROM b LEFT JOIN i ON i.lang = b.lang AND i.ph = b.ph
  WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""
