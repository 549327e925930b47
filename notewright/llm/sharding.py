"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many virtual nodes at hashed places of a ring; a key belongs to
the shard of the next node clockwise.  A shard has a capacity: keys that overflow
a full one continue clockwise to the next shard with room.  So loads are balanced
by construction, and when a shard is added only keys near its nodes, and what
overflows differently, move.

Keys between two nodes (an arc) meet the shards in one order, so loads are decided
on counts by arc, a table of fixed size, and cut into segments of the ring.  What
is left for Spark is each row's place along the ring: a count by cell of the ring,
and a numbering inside each cell.  Texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import mix64, slices, table

#: The ring's length; places are 62-bit, so that they are longs.
RING = 1 << 62
#: A numbering task has at most about so many rows, or a ``_MAX_CELLS``th of all where that is more.
_CELL_ROWS, _MAX_CELLS = 100_000, 32_768


def node_places(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted places of all virtual nodes, and the shard of each.  A shard's nodes don't depend on the number of shards."""
    found = sorted((xxhash.xxh3_64_intdigest(f"{s}/{v}".encode()) % RING, s) for s in range(shards) for v in range(nodes))
    return np.array([p for p, _ in found], np.int64), np.array([s for _, s in found], np.int64)


def key_places(ids: np.ndarray) -> np.ndarray:
    """The places of integer keys on the ring."""
    with np.errstate(over="ignore"):
        return (mix64(mix64(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(2)).astype(np.int64)


def arcs_of(places: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """The arc of each place: the number of the next node at or after it; past the last node the ring begins again."""
    return np.searchsorted(nodes, places, side="left") % len(nodes)


def walks(owner: np.ndarray) -> list[list[int]]:
    """For each arc the distinct shards in clockwise order, its own first."""
    n, count = len(owner), len(set(owner.tolist()))
    out = []
    for a in range(n):
        seen: dict[int, None] = {}
        for i in range(n):
            seen.setdefault(int(owner[(a + i) % n]))
            if len(seen) == count:
                break
        out.append(list(seen))
    return out


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """What each shard may hold: floor((1 + slack) * total / shards) and, if ``slack`` is 0, the remainder one by one."""
    if slack < 0:
        raise ValueError("slack must not be negative")
    if slack:
        return [-(-max(total, int(total * (1 + slack))) // shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def place_arcs(loads: Sequence[int], walk: Sequence[Sequence[int]], room: Sequence[int]) -> list[list[tuple[int, int]]]:
    """By arc, the (shard, load) it is dealt, in the order of its keys.

    First all arcs load their own shards, in order round the ring, as long as there is room; then what overflowed
    goes one shard on, all arcs at once, and so on, until nothing is left.  ``room`` must add up to the loads at least.
    """
    room, left = list(room), list(loads)
    out: list[list[tuple[int, int]]] = [[] for _ in loads]
    for step in range(max((len(w) for w in walk), default=0)):
        for a, n in enumerate(left):
            if n and step < len(walk[a]):
                s = walk[a][step]
                taken = min(n, room[s])
                if taken:
                    out[a].append((s, taken))
                    room[s] -= taken
                    left[a] -= taken
    if any(left):
        raise ValueError("the shards have no room for all keys")
    return out


@dataclass
class Ring:
    """A ring of ``shards`` with ``nodes`` virtual nodes each."""

    shards: int
    nodes: int

    def __post_init__(self):
        if self.shards < 1 or self.nodes < 1:
            raise ValueError("a ring needs a shard and a node")
        self.places, self.owner = node_places(self.shards, self.nodes)

    def home(self, ids: np.ndarray) -> np.ndarray:
        """The shard of each key where no load is bounded."""
        return self.owner[arcs_of(key_places(ids), self.places)]


def _keyed(docs: DataFrame, ring: Ring, parts: int) -> DataFrame:
    """doc_id, size, text_crc32, place, cell (arc * parts + part of the arc), row; a null id is a key of its own."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    nodes = ring.places
    length = np.diff(np.append(nodes, nodes[0] + RING))
    length = np.roll(length, 1)  # an arc ends at its node

    def run(batches):
        for b in slices(batches, 10_000):
            place = key_places(b.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False))
            arc = arcs_of(place, nodes)
            along = (place - nodes[arc - 1]) % RING  # from the node before
            part = np.minimum(along // (length[arc] // parts + 1), parts - 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "size", "text_crc32", "row")), pa.array(along), pa.array(arc * parts + part)], ["doc_id", "size", "text_crc32", "row", "place", "cell"])

    return rows.mapInArrow(run, "doc_id long, size long, text_crc32 long, row long, place long, cell long")


def _numbered(keyed: DataFrame, cells: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The rows with n and w: how many rows, and what size, go before each on the ring; also both totals by cell.

    Rows are ordered by cell, place, id and checksum.  A cell with very many rows, as one key has that repeats, is
    numbered in several tasks, by row; such rows are alike but for their order.
    """
    spark = keyed.sparkSession
    first = {r["cell"]: r["n"] for r in keyed.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a number of cells that parameters set
    most = max(_CELL_ROWS, -(-sum(first.values()) // _MAX_CELLS))
    split = spark.sparkContext.broadcast({c: -(-n // most) for c, n in first.items() if n > most})

    def salt(batches):
        for b in batches:
            ways = np.array([split.value.get(c, 1) for c in b.column("cell").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(b.column("row").to_numpy() % ways)], [*b.schema.names, "salt"])

    salted = keyed if not split.value else keyed.mapInArrow(salt, ", ".join(f"{c} {t}" for c, t in keyed.dtypes) + ", salt long")
    salted = salted if split.value else salted.withColumn("salt", F.lit(0).cast("long"))
    found = salted.groupBy("cell", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("w")).collect()  # at most twice _MAX_CELLS more
    rows, sizes = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
    ways = 1 + max((r["salt"] for r in found), default=0)
    keys, before, n, w = [], [], 0, 0
    for r in sorted(found):
        keys.append(r["cell"] * ways + r["salt"])
        before.append((n, w))
        n, w = n + r["n"], w + r["w"]
        rows[r["cell"]] += r["n"]
        sizes[r["cell"]] += r["w"]
    shared = spark.sparkContext.broadcast((np.array(keys, np.int64), np.array(before, np.int64).reshape(-1, 2)))
    order = Window.partitionBy("cell", "salt").orderBy("place", "doc_id", "text_crc32", "row")
    own = salted.withColumn("own_n", F.row_number().over(order) - 1).withColumn("own_w", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))

    def add(batches):
        keys, before = shared.value
        for b in batches:
            at = before[np.searchsorted(keys, b.column("cell").to_numpy() * ways + b.column("salt").to_numpy())]
            columns = [b.column(c) for c in ("doc_id", "size", "text_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at[:, 0] + b.column("own_n").to_numpy()), pa.array(at[:, 1] + b.column("own_w").to_numpy())], ["doc_id", "size", "text_crc32", "n", "w"])

    return own.mapInArrow(add, "doc_id long, size long, text_crc32 long, n long, w long"), rows, sizes


def segments(ring: Ring, loads: np.ndarray, slack: float | None) -> tuple[np.ndarray, np.ndarray]:
    """The ring cut into stretches of one shard each, by load: where each begins, and its shard.  No bound if ``slack`` is None."""
    walk = walks(ring.owner)
    room = [int(loads.sum())] * ring.shards if slack is None else capacities(int(loads.sum()), ring.shards, slack)
    starts, owner, at = [], [], 0
    for dealt in place_arcs(loads.tolist(), walk, room):
        for s, load in dealt:
            starts.append(at)
            owner.append(s)
            at += load
    return np.array(starts, np.int64), np.array(owner, np.int64)


def shard_documents(docs: DataFrame, shards: int = 16, law: str = "rows", nodes: int = 128, slack: float = 0.0, parts: int = 8) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) in ``shards`` shards: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``law`` says what is bounded: ``rows`` or ``bytes`` (UTF-8 bytes of the text and one more, ``size``), by
    floor or ceiling of the mean, times 1 + ``slack``; or nothing (``key``: the id and the number of shards alone
    decide).  Without slack numbers of rows are at most one apart; bytes differ from the mean by a few of the largest texts.
    More slack means that fewer keys overflow, and that fewer move when a shard is added.  ``slot`` numbers a shard's rows
    from 0 without gaps, in ring order.  ``grown_shard`` is the shard with one more of them (law ``key``; else null).

    Null texts count as empty.  Null ids are one key.  Repeated ids are rows of one place, in order of checksum; a
    key that repeats very often is numbered by several tasks.  Equal texts are not kept together.  An empty table
    gives no rows.  Other columns are ignored.  The driver sees counts by cell of the ring: ``shards`` x ``nodes`` x
    ``parts`` of them, and no more than ``_MAX_CELLS`` besides.
    """
    if law not in ("rows", "bytes", "key"):
        raise ValueError(f"unknown law: {law}")
    ring = Ring(shards, nodes)
    keyed = table(_keyed(docs, ring, parts), "ring-keys")
    rows, n, w = _numbered(keyed, shards * nodes * parts)
    by_arc = (n if law != "bytes" else w).reshape(-1, parts).sum(axis=1)
    starts, owner = segments(ring, by_arc, None if law == "key" else slack)
    grown = Ring(shards + 1, nodes)

    def deal(batches):
        for b in batches:
            at = np.searchsorted(starts, b.column("n" if law != "bytes" else "w").to_numpy(), side="right") - 1
            moved = pa.nulls(b.num_rows, pa.int32())
            if law == "key":
                moved = pa.array(grown.home(b.column("doc_id").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "size", "text_crc32", "n")), pa.array(at), pa.array(owner[at].astype(np.int32)), moved], ["doc_id", "size", "text_crc32", "n", "segment", "shard", "grown_shard"])

    if not len(starts):
        return docs.sparkSession.createDataFrame([], "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
    dealt = table(rows.mapInArrow(deal, "doc_id long, size long, text_crc32 long, n long, segment long, shard int, grown_shard int"), "dealt")
    filled = dealt.groupBy("segment").agg(F.min("n").alias("first"), F.count("*").alias("rows"), F.first("shard").alias("shard")).collect()  # a stretch each
    slots, used = np.zeros(len(starts), np.int64), dict.fromkeys(range(shards), 0)
    for r in sorted(filled):
        slots[r["segment"]] = used[r["shard"]] - r["first"]
        used[r["shard"]] += r["rows"]

    def number(batches):
        for b in batches:
            slot = pa.array(slots[b.column("segment").to_numpy()] + b.column("n").to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "size", "text_crc32", "shard", "grown_shard")), slot], ["doc_id", "size", "text_crc32", "shard", "grown_shard", "slot"])

    out = dealt.mapInArrow(number, "doc_id long, size long, text_crc32 long, shard int, grown_shard int, slot long")
    return out.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", "grown_shard")

