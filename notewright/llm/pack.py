"""Best-fit packing with Martello-Toth dominance reduction.

Only the number of pieces of each length decides how they are packed, so the
plan is made on that histogram (at most ``capacity`` rows however many
documents there are).  The reduction fixes sets that provably dominate every
other choice for the longest piece left; best-fit decreasing packs the rest.
The plan says, for each length, which ranks go to which sequences; pieces are
ranked and placed in parallel.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notewright.llm.common import kept, slices, table, tidy

CAPACITY = 2048


class _Sizes:
    """A multiset of lengths: sorted distinct lengths and their counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = {w: n for w, n in counts.items() if n}
        self.keys = sorted(self.count)

    def take(self, w: int, n: int) -> None:
        self.count[w] -= n
        if not self.count[w]:
            del self.count[w]
            self.keys.pop(bisect_left(self.keys, w))

    def add(self, w: int) -> None:
        if w not in self.count:
            insort(self.keys, w)
        self.count[w] = self.count.get(w, 0) + 1

    def largest(self, most: int) -> int:
        """The largest length of at most ``most``; 0 if none."""
        i = bisect_right(self.keys, most)
        return self.keys[i - 1] if i else 0

    def smallest(self, n: int) -> list[int]:
        out: list[int] = []
        for w in self.keys:
            out += [w] * min(self.count[w], n - len(out))
            if len(out) == n:
                break
        return out


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sequences fixed by dominance as (lengths, times), and the counts that remain.

    For the longest piece left, j, with room r beside it: nothing fits, so {j} is fixed; the largest fitting
    piece k fills r exactly, or no two pieces fit in r together, so {j, k} dominates every set holding j; or
    no three fit and no fitting pair is larger than k, so {j, k} dominates again.  Otherwise j is left over.
    """
    sizes, fixed, changed = _Sizes(counts), [], True
    while changed:
        changed = False
        for j in sorted(sizes.count, reverse=True):
            while sizes.count.get(j):
                sizes.take(j, 1)  # j itself; what stays are the other pieces
                k, more = sizes.largest(capacity - j), sizes.count.get(j, 0)
                if k and not _dominates(sizes, capacity - j, k):
                    sizes.add(j)
                    break
                n = 1 + (more if not k else (more - 1) // 2 if k == j else min(more, sizes.count[k] - 1))
                if n > 1:
                    sizes.take(j, n - 1)
                if k:
                    sizes.take(k, n)
                fixed.append(((j, k) if k else (j,), n))
                changed = True
    return fixed, sizes.count


def _dominates(sizes: _Sizes, room: int, k: int) -> bool:
    """Whether the largest fitting piece k is as good in ``room`` as any other set of ``sizes``."""
    low = sizes.smallest(3)
    if k == room or len(low) < 2 or low[0] + low[1] > room:
        return True
    return (len(low) < 3 or sum(low) > room) and _best_pair(sizes, room) <= k


def _best_pair(sizes: _Sizes, room: int) -> int:
    """The largest sum of two pieces that fit in ``room`` together; 0 if none do."""
    best = 0
    for x in sizes.keys:
        if 2 * x > room:
            break
        y = sizes.largest(room - x)
        if y > x or y == x and sizes.count[x] > 1:
            best = max(best, x + y)
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (lengths in order of placing, times)."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(room: int, held: tuple[int, ...], times: int) -> None:
        if not times:
            return
        if not room:
            done.append((held, times))
        else:
            if room not in open_by_room:
                open_by_room[room] = []
                insort(rooms, room)
            open_by_room[room].append((held, times))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            i = bisect_left(rooms, w)
            if i < len(rooms):
                room = rooms[i]
                held, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(i)
            else:
                room, held, times = capacity, (), -(-n // (capacity // w))
            each = room // w  # the fullest fitting sequence stays the fullest until it is full for w
            full = min(times, n // each)
            put(room - each * w, held + (w,) * each, full)
            n -= full * each
            times -= full
            if times and n:
                put(room - n * w, held + (w,) * n, 1)
                n, times = 0, times - 1
            put(room, held, times if held else 0)
    return done + [x for group in open_by_room.values() for x in group]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where each piece goes, as intervals sorted by (length, first rank).

    Of a length, ranks from ``first`` on go to sequences ``sequence``, ``sequence + 1``, ... at ``offset``.
    """
    fixed, left = reduce_by_dominance({w: n for w, n in counts.items() if 0 < w <= capacity}, capacity)
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for held, times in fixed + best_fit_decreasing(left, capacity):
        offset = 0
        for w in held:
            rows.append((w, used.get(w, 0), sequence, offset))
            used[w] = used.get(w, 0) + times
            offset += w
        sequence += times
    rows.sort()
    names = ("length", "first", "sequence", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)} | {"sequences": np.array(sequence)}


class ChunkEncoder:
    """Identifiers of whole texts by the tokenizers library, as little-endian bytes.

    The tokenizer drops white space and never joins across it, so a text is encoded blank-separated chunk
    by chunk.  A chunk of letters, or of letters and closing punctuation, is two pre-tokens at most; letters
    not met before go to the library in one call, and bounded caches keep what it says.  Words of a-z need
    no normalizing and hold no pattern but letters, so for them the library skips both.
    """

    CLOSING = ".,;:!?|%$&*"

    def __init__(self, path: str, chunks: int = 500_000, words: int = 600_000):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = self.plain = Tokenizer.from_file(path)
        suffix = spec["model"].get("end_of_word_suffix")
        closes = [t.endswith(suffix) for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])] if suffix else []
        self.closes = np.array(closes, bool)
        if suffix and self._plain_for_letters(spec):
            self.plain = Tokenizer.from_file(path)
            self.plain.normalizer = None
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.max_chunks, self.max_words = chunks, words

    @staticmethod
    def _plain_for_letters(spec: dict) -> bool:
        """Whether normalizing leaves words of a-z alone, and runs of letters are split off whole, then taken as bytes."""
        normal = (spec["normalizer"] or {}).get("normalizers", [])
        pieces = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        return {n["type"] for n in normal} <= {"NFC", "Lowercase", "Replace"} and all(n["pattern"] == {"Regex": r"\s+"} for n in normal if n["type"] == "Replace") and [p["type"] for p in pieces] == ["Split", "ByteLevel"] and r"|[\p{L}]+|" in pieces[0]["pattern"].get("Regex", "") and not pieces[1]["use_regex"] and not pieces[1]["add_prefix_space"]

    def _learn(self, words: list[str], tokenizer) -> None:
        """Encode words of letters only, all in one text; each must be one pre-token of it."""
        if not words:
            return
        text = " ".join(words)
        if len(self.closes):
            found = tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
        else:
            found = tokenizer.encode(text, add_special_tokens=False)
            ids, of = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
            ends = np.append(np.flatnonzero(np.diff(of)) + 1, len(of)).tolist() if len(of) else []
        if len(ends) == len(words):
            raw, at = ids.tobytes(), 0
            for w, end in zip(words, ends):
                self.words[w] = raw[4 * at : 4 * end]
                at = end
        else:
            self._one_by_one(words, self.words)

    def _one_by_one(self, texts: list[str], into: dict[str, bytes]) -> None:
        for t, e in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            into[t] = np.array(e.ids, "<u4").tobytes()

    def _fill(self, new: set[str]) -> None:
        """Put chunks into the cache."""
        chunks, words, later, odd = self.chunks, self.words, [], []
        for c in new:
            core = c.rstrip(self.CLOSING)
            word = core.lower()
            if not word.isalpha() or not core.isalpha():
                odd.append(c)
                continue
            word, tail = word if core.isascii() else core, c[len(core) :]
            ids, end = words.get(word), words.get(tail) if tail else b""
            if ids is None or end is None:
                later.append((c, word, tail))
            else:
                chunks[c] = ids + end if tail else ids
        unknown = {w for _, w, _ in later}.difference(words)
        self._learn([w for w in unknown if w.isascii()], self.plain)
        self._learn([w for w in unknown if not w.isascii()], self.tokenizer)
        self._one_by_one(list({t for _, _, t in later if t}.difference(words)), words)
        self._one_by_one(odd, chunks)
        for c, word, tail in later:
            chunks[c] = words[word] + words[tail] if tail else words[word]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for at in range(0, len(texts), 512):
            split = [t.replace("\n", " ").split(" ") if t else [] for t in texts[at : at + 512]]
            if len(self.chunks) > self.max_chunks:
                self.chunks.clear()
            if len(self.words) > self.max_words:
                self.words.clear()
            chunks = self.chunks
            found = [list(map(chunks.get, s)) for s in split]
            lacking = [i for i, f in enumerate(found) if None in f]
            new = {c for i in lacking for c, f in zip(split[i], found[i]) if f is None}
            if new:
                self._fill(new)
                for i in lacking:
                    found[i] = [chunks[c] if f is None else f for c, f in zip(split[i], found[i])]
            out += map(b"".join, found)
            for c in [c for c in new if len(c) > 64]:
                del chunks[c]
                self.words.pop(c, None)
        return out


def encoder(path: str) -> ChunkEncoder:
    """The encoder of a file, kept by the Python worker until another operator's task comes."""
    encoders = kept("pack")
    if path not in encoders:
        encoders[path] = ChunkEncoder(path)
    return encoders[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Documents as token pieces: doc_id, piece, start, length, ids_crc32, ids (little-endian unsigned 32-bit).

    A document is its identifiers, then 0.  Only a longer one than ``capacity`` is cut.  A null text is empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    @tidy("pack")
    def cut(batches):
        e = encoder(tokenizer_path)
        for b in slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), e.encode(b.column("text").to_pylist())):
                ids += b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, v in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), part)):
                        column.append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


def best_fit_pack(pieces: DataFrame, capacity: int = CAPACITY, rows_per_group: int = 200_000) -> DataFrame:
    """Add sequence_id and offset to the rows of ``pieces`` (doc_id, piece, length, ...).

    The driver sees the histogram of lengths only.  Pieces of a length are ranked within salted groups, as
    many as keep a group near ``rows_per_group`` if all had one length; a group's first rank is a running
    sum over the groups' counts.  Equal ids, null ids and repeated rows are packed like any others.  Lengths
    must be 1 to ``capacity``.  An empty input gives an empty result.  ``pieces`` is read twice: pass a table.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    shared = spark.sparkContext.broadcast(plan(counts, capacity))
    salts = 32 + sum(counts.values()) // rows_per_group
    names = pieces.columns
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int"))
    running = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy("length", "_salt").count().select("length", "_salt", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("_start"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*names)))
    ranked = ranked.join(starts, ["length", "_salt"]).select(*names, (F.col("_start") + F.col("_rank") - 1).alias("_rank"))

    @tidy("pack")
    def place(batches):
        at = shared.value
        span = int(at["first"].max(initial=0)) + 2
        keys = at["length"] * span + at["first"]
        for b in slices(batches):
            w, rank = (b.column(n).to_numpy(zero_copy_only=False) for n in ("length", "_rank"))
            i = np.searchsorted(keys, w * span + np.minimum(rank, span - 1), side="right") - 1
            columns = [*(b.column(n) for n in names), pa.array(at["sequence"][i] + rank - at["first"][i]), pa.array(at["offset"][i])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """All documents packed into sequences of at most ``capacity`` tokens.

    doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.  Null texts are empty
    (one piece holding the closing 0); ids may be null or repeated; other columns are ignored.
    """
    pieces = table(token_pieces(docs, tokenizer_path, capacity).drop("ids"), "pieces")
    return best_fit_pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences' identifiers: sequence_id, length, ids.  ``packed`` must still have the ids column.

    A sequence holds at most the capacity, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
