"""Language-model scores by online logistic context mixing.

A text is its tokens, then an end.  A token that training holds often is one
symbol; any other is an escape, then its bytes and a blank.  A symbol is a path
of bits in a Huffman tree (one of words, one of bytes), and each bit is
predicted by several models: the tree's own counts, and hashed contexts of the
words, or of the bytes of the word, before it.  A hashed slot's counts of zeros
and ones over the whole training corpus are a state, whose log odds come from
what followed that state in training.  The log odds are combined by weights that
a gate chooses (how deep the bit lies, how well its contexts are known); while a
text is read, each gate's weights are refined block by block from the bits
already coded.  The total of code lengths is the text's log probability: bits
per byte, or log10 as asked.

What the contexts hold: every distinct (context, symbol) pair of the training
texts is counted exactly, pre-aggregated in tasks and merged by owners, each of
a range of contexts; an owner turns its pairs into counts of bits.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import _powers, keep_freed_memory, mix64, slices, table

BLANK = 32  # no token holds a blank, so it ends a spelled one
SYMBOL_BITS = 18
MAX_WORDS = (1 << SYMBOL_BITS) - 512  # symbols of the word tree; other tokens are spelled
TABLES = 3  # of words: the word before, the two before, their last letters; of bytes: the last three, the last five, the word so far
LEVELS = 16
GROUP_BYTES = 200_000  # word numbers of the texts that are laid out together
STATES = 32
NEAR = 5  # steps of a path whose slots lie together, in 2**NEAR in a row: a cache line or two


def slot_bits(n_bytes: int, most: int = 30) -> int:
    """Slots of a word context, as a power of two, for ``n_bytes`` of training text.

    They grow as the text's square root, as vocabularies do: 2**23 for 100 MB, 2**27 for 50 GB; ``most`` bounds
    a task's memory (a slot is two bytes while weights are fitted, then one).  A byte context has a quarter of them.
    """
    return max(12, min(most, int(23.5 + 0.5 * math.log2(max(1, n_bytes) / 2**27))))


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, A-Z lower-cased, as UTF-8, without the texts' ends; where each text's begin (and the last's end)."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, bounds = words.flatten(), words.offsets.to_numpy().astype(np.int64)
    kept = pc.greater(pc.binary_length(flat), 0)  # blanks at a text's ends leave empty ones
    return flat.filter(kept).cast(pa.binary()), np.concatenate(([0], np.cumsum(kept.to_numpy(zero_copy_only=False))))[bounds - bounds[0]]


# Symbols and their bits


class Code:
    """Huffman codes of words (symbols from 0, the escape last of them) and of the 256 bytes (the symbols after).

    By symbol: where its path starts, its length, its bits from the highest down, its rank among its tree's leaves in
    the order of paths (``leaves`` leads back).  By step of all paths, as bits of a number from the lowest up: the
    node's name (32 bits), the bit taken there (1), how deep it lies (2: 0, 1, or 2 for more), the log odds of a one by
    the tree's counts (6: sixteenths above -2).  Tasks get the two trees and derive the rest.
    """

    def __init__(self, *trees: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.trees = trees
        parts = [np.concatenate(p) for p in zip(*(_paths(*t, salt) for t, salt in zip(trees, (77, 1 << 40))))]
        self.length, self.path, self.node = parts
        self.start = np.cumsum(self.length) - self.length
        self.escape = (len(trees[0][0]) + 1) // 2 - 1
        self.leaves = [np.argsort(self.path[: self.escape + 1]), np.argsort(self.path[self.escape + 1 :])]
        self.rank = np.concatenate([np.argsort(x) for x in self.leaves]).astype(np.uint64)

    def __reduce__(self):
        return Code, self.trees


TREE_ODDS = (np.arange(64) / 16 - 2).astype(np.float32)


def _tree(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman tree over positive weights, leaves first: each node's parent, its side, its level of log odds."""
    n = len(weights)
    parent, side = [0] * (2 * n - 1), [0] * (2 * n - 1)
    heap = [(int(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    pair = np.ones((2, 2 * n - 1))
    for node in range(n, 2 * n - 1):
        x, y = heapq.heappop(heap), heapq.heappop(heap)
        parent[x[1]] = parent[y[1]] = node
        side[y[1]] = 1
        pair[0, node], pair[1, node] = x[0], y[0]
        heapq.heappush(heap, (x[0] + y[0], node))
    level = np.clip(np.round(16 * np.log(pair[1] / pair[0])) + 32, 0, 63)
    return np.array(parent, np.int32), np.array(side, np.int8), level.astype(np.int8)


def _names(parent: np.ndarray, side: np.ndarray, salt: int) -> np.ndarray:
    """The nodes' names (32 bits): a hash of the node ``NEAR`` levels or fewer up where its group begins, then its place there."""
    depth = np.zeros(len(parent), np.int64)
    node, at = np.arange(len(parent) - 1), parent[:-1]
    while len(node):
        depth[node] += 1
        below = at != len(parent) - 1
        node, at = node[below], parent[at[below]]
    order = np.argsort(depth, kind="stable")
    cut = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    group = (mix64(np.arange(len(parent), dtype=np.uint64) + np.uint64(salt)) >> np.uint64(32)).astype(np.int64) >> NEAR << NEAR
    place = np.ones(len(parent), np.int64)
    for d in range(1, int(depth.max()) + 1):
        if d % NEAR:
            node = order[cut[d] : cut[d + 1]]
            group[node] = group[parent[node]]
            place[node] = 2 * place[parent[node]] + side[node]
    return group | place


def _paths(parent: np.ndarray, side: np.ndarray, level: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths and paths of a tree's leaves, and their steps."""
    root = len(parent) - 1
    n = (len(parent) + 1) // 2
    leaf, at, found = np.arange(n), np.arange(n), []
    length, path = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    while len(leaf):
        found.append((leaf, parent[at], side[at]))
        length[leaf] += 1
        at = parent[at]
        leaf, at = leaf[at != root], at[at != root]
    start = np.cumsum(length) - length
    step = np.zeros(length.sum(), np.int64)
    name = _names(parent, side, salt) | level.astype(np.int64) << 35
    for up, (leaf, above, taken) in enumerate(found):
        place = length[leaf] - 1 - up
        step[start[leaf] + place] = name[above] | taken.astype(np.int64) << 32 | np.minimum(place, 2) << 33
        path[leaf] |= taken.astype(np.uint64) << (63 - place).astype(np.uint64)
    return length, path, step


def make_code(words: np.ndarray, spelled: np.ndarray) -> Code:
    """The code of words' counts (the escape's last) and of the spelled bytes' counts; each counts once more."""
    return Code(_tree(words + 1), _tree(spelled + 1))


@dataclass(frozen=True)
class Layout:
    """Where a context's bits are: 2**``bits`` slots in all, 2**``own`` of them an owner's; contexts are hashes of ``bits`` + 4."""

    bits: int
    own: int

    def hashed(self, context: np.ndarray) -> np.ndarray:
        """Contexts (64 bits, any) as hashes; the highest bits say which owner's they are."""
        return mix64(context) >> np.uint64(60 - self.bits)

    def first(self, hashed: np.ndarray) -> np.ndarray:
        """A context's slots, before the nodes' names are mixed into the owner's bits."""
        hashed = hashed.astype(np.int64)
        return hashed >> (4 + self.own) << self.own | hashed & ((1 << self.own) - 1)


def layouts(n_bytes: int) -> list[Layout]:
    """The tables' layouts: an owner for about 8 MB of text."""
    bits, owners = slot_bits(n_bytes), round(math.log2(max(1, n_bytes) / 2**23))
    own = max(10, min(18, bits - max(0, owners)))
    return [Layout(bits, min(bits, own))] * TABLES + [Layout(max(10, bits - 2), min(max(10, bits - 2), own))] * TABLES


def endings(words: list[bytes]) -> np.ndarray:
    """The last two bytes of each word as a number; then that of the escape."""
    return np.array([int.from_bytes(w[-2:]) + 1 for w in words] + [0], np.uint64)


def word_contexts(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Contexts (64 bits) of each word: the word before, the two before, the last two letters of both.

    ``begins`` is where texts begin; ``ends`` has words' endings.
    """
    before, two, last, third = (np.zeros(len(ids), np.uint64) for _ in range(4))
    before[1:] = ids[:-1] + 2
    before[begins] = 1
    two[1:] = before[:-1]
    two[begins] = 0
    last[1:] = ends.take(ids[:-1])
    last[begins] = 1 << 20
    third[1:] = last[:-1]
    third[begins] = 0
    return [before + np.uint64(1 << 60), (before << np.uint64(20) | two) + np.uint64(1 << 61), (last << np.uint64(21) | third) + np.uint64(1 << 62)]


def byte_contexts(buf: np.ndarray) -> list[np.ndarray]:
    """Contexts (64 bits) of each byte of spelled words: the word's last three bytes, its last five, all so far."""
    n = len(buf)
    with np.errstate(over="ignore"):
        p, q = _powers(n + 1)
        opens = np.zeros(n, np.int64)
        opens[1:] = np.where(buf[:-1] == BLANK, np.arange(1, n), 0)
        np.maximum.accumulate(opens, out=opens)
        inside = np.arange(n) - opens
        b, last = buf.astype(np.uint64), np.zeros(n, np.uint64)
        out = []
        for back in range(1, 6):
            last[back:] |= np.where(inside[back:] >= back, b[:-back] << np.uint64(8 * back), np.uint64(0))
            if back in (3, 5):
                out.append(last + np.uint64(back))
        prefix = np.zeros(n, np.uint64)
        np.cumsum((mix64(b + np.uint64(1)) * p[:n])[:-1], out=prefix[1:])
        out.append(mix64((prefix - prefix[opens]) * q[opens]) + inside.astype(np.uint64))
        return out


# Counts


class Pairs:
    """Counts of (context's hash, rank of the symbol) keys of one table: sorted, merged as they come.

    An entry is a key above its count; a count too large for its bits takes several entries.
    """

    def __init__(self, layout: Layout):
        self.room = np.uint64(64 - SYMBOL_BITS - 4 - layout.bits)
        self.runs: list[np.ndarray] = []

    def entries(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        most = (1 << int(self.room)) - 1
        if len(counts) and counts.max() > most:
            times = -(-counts // most)
            last = np.cumsum(times) - 1
            keys, split = np.repeat(keys, times), np.full(times.sum(), most)
            split[last] = counts - (times - 1) * most
            counts = split
        return keys << self.room | counts.astype(np.uint64)

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        """Keys in any order, each once or ``counts`` times."""
        new = self._summed(keys << self.room | np.uint64(1) if counts is None else self.entries(keys, counts))
        while self.runs and len(self.runs[-1]) <= 2 * len(new):
            new = self._summed(np.concatenate((self.runs.pop(), new)))
        self.runs.append(new)

    def _summed(self, entries: np.ndarray) -> np.ndarray:
        return self.entries(*self._totals(np.sort(entries)))

    def _totals(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = entries >> self.room, (entries & ((np.uint64(1) << self.room) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1])))
        return keys[first], np.add.reduceat(counts, first) if len(first) else counts

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """All keys, sorted, and their counts; then it is empty."""
        runs = self.runs or [np.zeros(0, np.uint64)]
        out = self._totals(runs[0] if len(runs) == 1 else np.sort(np.concatenate(runs)))
        self.runs.clear()
        return out


PAIRS = "at int, owner int, salt int, keys binary, counts binary"


def _planes(x: np.ndarray, pack) -> bytes:
    return pack(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), 8).T).tobytes())


def _unplanes(raw: bytes, unpack) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpack(raw), np.uint8).reshape(8, -1).T).view(np.uint64)[:, 0]


def pack_pairs(at: int, layout: Layout, salt: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and counts as a row for each owner: differences of keys and counts, by planes of bytes."""
    pack = zstandard.ZstdCompressor(level=1).compress
    owner = (keys >> np.uint64(SYMBOL_BITS + 4 + layout.own)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), owner[1:] != owner[:-1])))
    rows = [(int(owner[a]), _planes(np.diff(keys[a:b], prepend=np.uint64(0)), pack), _planes(counts[a:b], pack)) for a, b in zip(cut, [*cut[1:], len(keys)])]
    own, packed, times = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array([at] * len(rows), pa.int32()), pa.array(own, pa.int32()), pa.array([salt] * len(rows), pa.int32()), pa.array(packed, pa.binary()), pa.array(times, pa.binary())],
        ["at", "owner", "salt", "keys", "counts"],
    )


def _unpack_pairs(batches: Iterator[pa.RecordBatch], held: list[Layout]) -> tuple[int, int, Pairs]:
    """The table and owner of a group of packed rows, and its pairs."""
    unpack, pairs, at, owner, waiting, size = zstandard.ZstdDecompressor().decompress, None, 0, 0, [], 0

    def flush():
        if waiting:
            pairs.add(*map(np.concatenate, zip(*waiting)))
            waiting.clear()

    for b in batches:
        for r in b.to_pylist():
            at, owner = r["at"], r["owner"]
            pairs = pairs or Pairs(held[at])
            waiting.append((np.cumsum(_unplanes(r["keys"], unpack), dtype=np.uint64), _unplanes(r["counts"], unpack).astype(np.int64)))
            size += len(waiting[-1][0])
            if size > 2_000_000:
                flush()
                size = 0
    flush()
    return at, owner, pairs


def bit_counts(keys: np.ndarray, counts: np.ndarray, code: Code, tree: int, layout: Layout, most: int = 200_000) -> np.ndarray:
    """Zeros and ones of an owner's slots from its pairs, ``most`` of them at a time: each step of a pair's path counts as often as the pair."""
    mask = (1 << layout.own) - 1
    total = np.zeros(2 << layout.own)
    for i in range(0, len(keys), most):
        key = keys[i : i + most]
        symbol = code.leaves[tree].take((key & np.uint64((1 << SYMBOL_BITS) - 1)).astype(np.int64)) + tree * (code.escape + 1)
        n_bits, step = steps(code, symbol)
        node = code.node.take(step)
        slot = np.repeat(layout.first(key >> np.uint64(SYMBOL_BITS)) & mask, n_bits)
        slot ^= node & mask
        slot |= (node >> 32 & 1) << layout.own
        total += np.bincount(slot, np.repeat(counts[i : i + most].astype(float), n_bits), len(total))
    return total.reshape(2, -1)


def packed_counts(total: np.ndarray) -> np.ndarray:
    """Zeros and ones as two bytes of a number: scaled down, where one is over 255, so that neither gets lost."""
    most = np.maximum(total.max(axis=0), 1)
    small = np.ceil(total * np.minimum(1, 255 / most)).astype(np.uint16)
    return small[1] << np.uint16(8) | small[0]


def _states() -> tuple[np.ndarray, np.ndarray]:
    """The state of each packed pair of counts; and, by bit, that of the pair without one such bit."""
    zeros, ones = np.meshgrid(np.arange(256), np.arange(256))
    zeros, ones = zeros.ravel(), ones.ravel()  # index: ones << 8 | zeros
    n = zeros + ones
    sure = np.searchsorted([1, 2, 3, 5, 9, 17], n, side="right")  # 1 to 6
    odds = np.clip(np.round(2 * np.log((ones + 0.4) / (zeros + 0.4))) + 9, 0, 18)
    state = np.where(n == 0, 0, np.where(ones == 0, sure, np.where(zeros == 0, 6 + sure, 13 + odds))).astype(np.uint8)
    whole = np.maximum(zeros, ones) < 255  # not scaled down
    index = np.arange(1 << 16)
    return state, np.concatenate((state[index - ((zeros > 0) & whole)], state[index - 256 * ((ones > 0) & whole)]))


STATE, STATE_WITHOUT = _states()

#: What a gate sees of a state: never met, one side once or twice, one side more often, both sides.
KIND = np.array([0] + 2 * [1, 1, 2, 2, 2, 2] + [3] * (STATES - 13), np.uint8)
KINDS = 4


# Bits and their mixing


@dataclass
class Stream:
    """One tree's side of the model: its tables (packed counts, states once it is fitted), the states' log odds by
    table, weights by gate and input (the tree's own log odds first)."""

    first_symbol: int
    layout: Layout
    tables: list[np.ndarray]
    odds: np.ndarray | None = None
    weights: np.ndarray | None = None

    def __getstate__(self):
        pack = zstandard.ZstdCompressor(level=1).compress
        return self.__dict__ | {"tables": [(t.dtype.str, pack(np.ascontiguousarray(t))) for t in self.tables]}

    def __setstate__(self, state):
        unpack = zstandard.ZstdDecompressor().decompress
        self.__dict__ = state | {"tables": [np.frombuffer(unpack(raw), kind) for kind, raw in state["tables"]]}


GATES = 3 * KINDS**TABLES
CELLS = 3 * LEVELS * STATES**TABLES * 2


def steps(code: Code, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of symbols (numbered through both trees) in a row: how many bits each has; where all bits' steps are."""
    n_bits = code.length.take(symbols)
    step = np.repeat(code.start.take(symbols) - (np.cumsum(n_bits) - n_bits), n_bits)
    step += np.arange(len(step))
    return n_bits, step


def layout_bits(code: Code, stream: Stream, symbols: np.ndarray, contexts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of symbols in a row: how many bits each has; the nodes of all bits; what each table holds for every bit."""
    n_bits, step = steps(code, symbols + stream.first_symbol)
    node = code.node.take(step)
    name = node & ((1 << stream.layout.own) - 1)
    held = []
    for rows, context in zip(stream.tables, contexts):
        slot = np.repeat(stream.layout.first(stream.layout.hashed(context)), n_bits)
        slot ^= name
        held.append(rows.take(slot))
    return n_bits, node, held


#: The kinds of each triple of states, as one number.
KINDS_OF = np.zeros(1, np.int64)
for _ in range(TABLES):
    KINDS_OF = np.add.outer(KINDS_OF * KINDS, KIND.astype(np.int64)).ravel()
KINDS_OF = KINDS_OF.astype(np.uint8)


def cells(node: np.ndarray, counts: list[np.ndarray]) -> np.ndarray:
    """The cell of each bit: depth, level of the tree's log odds, states without the bit itself, bit."""
    cell = (node >> 33 & 3) * LEVELS
    cell |= node >> 37
    bit = node >> 32 & 1
    without = bit << 16
    for held in counts:
        cell <<= 5
        cell |= STATE_WITHOUT.take(without | held)
    cell <<= 1
    cell |= bit
    return cell


RIDGE = 2.0


def fit(counted: np.ndarray, stream: Stream, passes: int = 30) -> None:
    """Set the states' log odds and the gates' weights of ``stream`` from how often each cell occurs in all training bits.

    A state's log odds are those of the bits that followed it; the weights are the ridge-penalised optimum of
    each gate, by Newton steps on the cells.
    """
    shape = (3, LEVELS, *[STATES] * TABLES, 2)
    cube = counted.reshape(shape)
    stream.odds = np.zeros((TABLES, STATES), np.float32)
    for i in range(TABLES):
        seen = cube.sum(axis=tuple(j for j in range(len(shape) - 1) if j != 2 + i))
        stream.odds[i] = np.log((seen[:, 1] + 0.5) / (seen[:, 0] + 0.5))
    at = np.flatnonzero(cube.reshape(-1, 2).any(axis=1))
    zeros, ones = cube.reshape(-1, 2)[at].T.astype(float)
    index = np.unravel_index(at, shape[:-1])
    x = np.stack([(index[1] * 4 + 1.5) / 16 - 2, *(stream.odds[i][index[2 + i]] for i in range(TABLES))])
    gate = index[0].copy()
    for i in range(TABLES):
        gate = gate * KINDS + KIND[index[2 + i]]
    start = np.array([1.0] + [0.0] * TABLES)
    stream.weights = np.tile(start, (GATES, 1))
    for g in range(GATES):
        own = gate == g
        xs, n, y = x[:, own], (zeros + ones)[own], ones[own]
        for _ in range(passes if own.any() else 0):
            w = stream.weights[g]
            p = 1 / (1 + np.exp(-np.clip(w @ xs, -30, 30)))
            pull = xs @ (y - n * p) - RIDGE * (w - start)
            move = np.linalg.solve((xs * (n * p * (1 - p))) @ xs.T + RIDGE * np.eye(len(w)), pull)
            stream.weights[g] += np.clip(move, -1, 1)
            if float(pull @ move) <= 1e-9 * max(1.0, n.sum()):
                break


BLOCKS = np.concatenate(([0], np.cumsum([8, 16, 32, 64, 128, 256])))


def block_of(place: np.ndarray) -> np.ndarray:
    """The block of a text's symbols: 8, then 16 and so on up to 256, then always 512."""
    early = np.searchsorted(BLOCKS, place, side="right") - 1
    return np.where(place < BLOCKS[-1], early, len(BLOCKS) - 1 + (place - BLOCKS[-1]) // 512)


def code_lengths(code: Code, stream: Stream, symbols: np.ndarray, contexts: list[np.ndarray], sizes: np.ndarray, rate: float = 4.0, calm: float = 60.0) -> np.ndarray:
    """Nats of each text's symbols, ``sizes`` of them in turn; a text's weights are refined after each of its blocks.

    All texts go a block at a time together.  A block's bits are brought into the order of gates and texts, where those
    of one weight set lie in a row.
    """
    n = len(sizes)
    text = np.repeat(np.arange(n), sizes)
    block = block_of(np.arange(len(symbols)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    order = np.argsort(block, kind="stable")
    bounds = np.searchsorted(block[order], np.arange(int(block.max()) + 2)).tolist() if len(symbols) else [0]
    symbols, text, contexts = symbols[order], text[order], [c[order] for c in contexts]
    held = np.repeat(stream.weights.astype(np.float32), n, axis=0)  # by gate and text
    odds = np.stack(np.broadcast_arrays(0, *(o.reshape(-1, *[1] * (TABLES - 1 - k)) for k, o in enumerate(stream.odds))), axis=-1)
    odds = np.ascontiguousarray(odds.reshape(-1, 1 + TABLES), np.float32)  # by triple of states, the tree's place first
    seen, total = np.zeros(n * GATES), np.zeros(n)
    for at, to in _runs(bounds):
        i, j = bounds[at], bounds[to]
        n_bits, node, states = layout_bits(code, stream, symbols[i:j], [c[i:j] for c in contexts])
        cell = states[0].astype(np.uint16)
        for s in states[1:]:
            cell <<= 5
            cell |= s
        gate = (node >> 33 & 3).astype(np.uint8)
        gate *= np.uint8(KINDS**TABLES)
        gate += KINDS_OF.take(cell)
        packed = gate.astype(np.int64)  # the weight set, the level of the tree's log odds, the bit, the states
        packed *= n
        packed += np.repeat(text[i:j], n_bits)
        packed <<= 22
        packed |= (node >> 35) << 16 | (node >> 32 & 1) << 15
        packed |= cell
        ends = np.concatenate(([0], np.cumsum(n_bits)))[np.array(bounds[at : to + 1]) - i].tolist()
        for a, b in zip(ends[:-1], ends[1:]):
            own = packed[a:b].take(np.argsort(gate[a:b], kind="stable"))  # sets of weights in a row
            low = own.astype(np.int32)
            own >>= 22
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            times = np.diff(first, append=len(own))
            own = own[first]
            x = odds.take(low & 0x7FFF, axis=0)
            x[:, 0] = TREE_ODDS.take(low >> 16 & 63)
            low >>= 14
            low &= 2
            sign = np.float32(1) - low  # -1 where the bit is 1
            now = held.take(own, axis=0)
            parts = np.repeat(now, times, axis=0)
            parts *= x
            z = parts[:, 0] + parts[:, 1]
            for k in range(2, 1 + TABLES):
                z += parts[:, k]
            z *= sign
            np.minimum(z, 60, out=z)
            np.exp(z, out=z)
            lost = z + np.float32(1)
            total += np.bincount(own % n, np.add.reduceat(np.log(lost), first), n)
            if to + 1 < len(bounds) or b < ends[-1]:
                z /= lost
                z *= sign
                seen[own] += times
                slow = rate / (calm + seen[own])
                for k in range(1 + TABLES):
                    now[:, k] -= slow * np.add.reduceat(z * x[:, k], first)
                held[own] = now
    return total


def _runs(bounds: list[int], most: int = 10_000) -> Iterator[tuple[int, int]]:
    """Blocks (from, to) that are laid out together: about ``most`` symbols, or one block."""
    at = 0
    for to in range(1, len(bounds)):
        if to + 1 == len(bounds) or bounds[to + 1] - bounds[at] > most:
            yield at, to
            at = to


@dataclass
class Model:
    code: Code
    ends: np.ndarray
    words: Stream
    spelled: Stream

    def streams(self, ids: list[np.ndarray], spelled: list[bytes]):
        """For some texts, each stream with its symbols, their contexts and each text's number of them."""
        sizes = np.array([len(x) for x in ids])
        symbols = np.concatenate(ids)
        yield self.words, symbols, word_contexts(symbols, np.cumsum(sizes) - sizes, self.ends), sizes
        sizes = np.array([len(x) for x in spelled])
        if sizes.sum():
            buf = np.frombuffer(b"".join(spelled), np.uint8)
            yield self.spelled, buf.astype(np.int64), byte_contexts(buf), sizes

    def log10(self, ids: list[np.ndarray], spelled: list[bytes]) -> np.ndarray:
        """Log10 probability of each text."""
        return -sum(code_lengths(self.code, *s) for s in self.streams(ids, spelled)) / math.log(10)


# The job


def _batches(batches: Iterator[pa.RecordBatch], column: str, most: int, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``rows``, cut where the bytes of ``column`` exceed ``most``; no value is cut."""
    for b in slices(batches, rows):
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)) // most
        cut = np.flatnonzero(np.diff(size, prepend=-1, append=-1))
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield b.slice(i, j - i)


def _token_counts(training: DataFrame) -> DataFrame:
    """Counts of the tokens, the end as the empty one: (token, n)."""

    def count(batches):
        seen, size, texts = [], 0, 0

        def rows():
            found = pc.value_counts(pa.chunked_array(seen, pa.binary()))
            seen.clear()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["token", "n"])

        for b in _batches(batches, "text", 1_000_000):
            seen.append(tokens(b.column("text"))[0])
            size += seen[-1].nbytes
            texts += b.num_rows
            if size > 64_000_000:
                yield rows()
                size = 0
        yield rows()
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([texts], pa.int64())], ["token", "n"])

    return training.select("text").mapInArrow(count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _binary(data: bytes, bounds: np.ndarray) -> pa.Array:
    """Values that lie in a row in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


ENCODED = "row long, doc_id long, trains boolean, scored boolean, n_tokens long, known long, part double, size long, ids binary, spelled binary"


def _encode(docs: DataFrame, words: dict[bytes, int], logs: np.ndarray) -> DataFrame:
    """Each text (doc_id, text, trains, scored) as words' numbers and the other tokens' bytes, with sums over its common tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((pa.array(list(words), pa.binary()), logs, words[b""]))

    def encode(batches):
        known, logs, end = shared.value
        escape, row = len(known), TaskContext.get().partitionId() << 40
        for b in _batches(batches, "text", 4_000_000, 5000):
            found, bounds = tokens(b.column("text"))
            number = pc.fill_null(pc.index_in(found, known), escape)
            first = bounds[:-1] + np.arange(b.num_rows)  # an end follows each text
            n_tokens = np.diff(bounds) + 1
            last = first + n_tokens - 1
            ids = np.full(len(found) + b.num_rows, end, np.int32)
            inner = np.ones(len(ids), bool)
            inner[last] = False
            ids[inner] = number.to_numpy()
            other = ids == escape
            spelled = pc.binary_join_element_wise(found.filter(pa.array(other[inner])), b"", b" ")  # a blank ends each
            rare = np.concatenate(([0], np.cumsum(other)))[np.append(first, len(ids))]
            length = np.zeros(len(ids), np.int64)
            length[inner] = pc.binary_length(found).to_numpy()
            size = np.add.reduceat(length, first) + n_tokens - 1 + (n_tokens == 1)
            spelled_at = np.concatenate(([0], np.cumsum(pc.binary_length(spelled).to_numpy())))[rare]
            columns = [
                np.arange(row, row + b.num_rows),
                b.column("doc_id"),
                b.column("trains"),
                b.column("scored"),
                n_tokens,
                n_tokens - np.diff(rare),
                np.add.reduceat(logs.take(ids), first),
                size,
                _binary(ids.tobytes(), 4 * np.append(first, len(ids))),
                _binary(b"".join(spelled.to_pylist()), spelled_at),
            ]
            row += b.num_rows
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["row", "doc_id", "trains", "scored", "n_tokens", "known", "part", "size", "ids", "spelled"])

    return docs.mapInArrow(encode, ENCODED)


def _word_pairs(encoded: DataFrame, code: Code, ends: np.ndarray, held: list[Layout], salts: int, most: int = 4_000_000) -> DataFrame:
    """Packed (context, word) counts of all training texts."""
    shared = encoded.sparkSession.sparkContext.broadcast((code.rank[: code.escape + 1], ends))

    def count(batches):
        keep_freed_memory()
        rank, ends = shared.value
        salt = TaskContext.get().partitionId() % salts
        waiting, size = [[] for _ in range(TABLES)], 0

        def flush():
            for at, (layout, w) in enumerate(zip(held, waiting)):
                if w:
                    pairs = Pairs(layout)
                    pairs.add(np.concatenate(w))
                    w.clear()
                    yield pack_pairs(at, layout, salt, *pairs.all())

        for b in _batches(batches, "ids", 1_000_000):
            ids = [np.frombuffer(x, np.int32) for x in b.column("ids").to_pylist()]
            sizes = np.array([len(x) for x in ids])
            symbols = np.concatenate(ids)
            ranks = rank.take(symbols)
            for layout, w, context in zip(held, waiting, word_contexts(symbols, np.cumsum(sizes) - sizes, ends)):
                w.append(layout.hashed(context) << np.uint64(SYMBOL_BITS) | ranks)
            size += len(symbols)
            if size > most:
                yield from flush()
                size = 0
        yield from flush()

    return encoded.where("trains").select("ids").mapInArrow(count, PAIRS)


def _byte_pairs(counts: DataFrame, words: dict[bytes, int], code: Code, held: list[Layout], salts: int) -> DataFrame:
    """Packed (context, byte) counts of all tokens that are spelled, each as often as training holds it."""
    shared, rank = counts.sparkSession.sparkContext.broadcast(words), code.rank[code.escape + 1 :]

    def count(batches):
        salt = TaskContext.get().partitionId() % salts
        total = [Pairs(layout) for layout in held[TABLES:]]
        for b in slices(batches, 50_000):
            other = [(t, n) for t, n in zip(b.column("token").to_pylist(), b.column("n").to_pylist()) if t not in shared.value]
            if other:
                buf = np.frombuffer(b"".join([t + b" " for t, _ in other]), np.uint8)
                times = np.repeat(np.array([n for _, n in other]), [len(t) + 1 for t, _ in other])
                for layout, pairs, context in zip(held[TABLES:], total, byte_contexts(buf)):
                    pairs.add(layout.hashed(context) << np.uint64(SYMBOL_BITS) | rank.take(buf), times)
        for at, (layout, pairs) in enumerate(zip(held[TABLES:], total)):
            yield pack_pairs(TABLES + at, layout, salt, *pairs.all())

    return counts.mapInArrow(count, PAIRS)


def _tables(pairs: DataFrame, code: Code, held: list[Layout], salts: int) -> list[np.ndarray]:
    """The tables' packed counts: pairs are merged by salted groups first where ``salts`` is over 1, then by owner."""
    shared = pairs.sparkSession.sparkContext.broadcast(code)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, _, own = _unpack_pairs(batches, held)
        yield pack_pairs(at, held[at], 0, *own.all())

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed_memory()
        at, owner, own = _unpack_pairs(batches, held)
        counts = zstandard.ZstdCompressor(level=1).compress(packed_counts(bit_counts(*own.all(), shared.value, at // TABLES, held[at])).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([owner], pa.int32()), pa.array([counts], pa.binary())], ["at", "owner", "counts"])

    if salts > 1:
        pairs = pairs.groupBy("at", "owner", "salt").applyInArrow(merge, PAIRS)
    closed = pairs.groupBy("at", "owner").applyInArrow(close, "at int, owner int, counts binary")
    out = [np.zeros(1 << h.bits, np.uint16) for h in held]
    unpack = zstandard.ZstdDecompressor().decompress
    for b in closed.toArrow().to_batches(max_chunksize=100):  # two bytes a slot at most
        for r in b.to_pylist():
            own = np.frombuffer(unpack(r["counts"]), np.uint16)
            out[r["at"]][r["owner"] * len(own) : (r["owner"] + 1) * len(own)] = own
    return out


def _histograms(encoded: DataFrame, model: Model, part: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """The histograms of all bits of all training texts, whole, by stream."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    schema = "at int, counts binary"

    def packed(rows):
        pack = zstandard.ZstdCompressor(level=1).compress
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([pack(r[1].tobytes()) for r in rows], pa.binary())], ["at", "counts"])

    def count(batches):
        keep_freed_memory()
        model = shared.value
        both = (model.words, model.spelled)
        total, waiting, size = [np.zeros(CELLS, np.int64) for _ in both], [[], []], [0, 0]

        def flush(i):
            if waiting[i]:
                total[i] += np.bincount(np.concatenate(waiting[i]), minlength=len(total[i]))
                waiting[i], size[i] = [], 0

        for b in _batches(batches, "ids", GROUP_BYTES):
            ids = [np.frombuffer(x, np.int32) for x in b.column("ids").to_pylist()]
            for i, (stream, symbols, contexts, _) in enumerate(model.streams(ids, b.column("spelled").to_pylist())):
                waiting[i].append(cells(*layout_bits(model.code, stream, symbols, contexts)[1:]))
                size[i] += len(waiting[i][-1])
                if size[i] > 4_000_000:
                    flush(i)
        flush(0)
        flush(1)
        flat = np.concatenate(total)
        own = [(at // part, flat[at : at + part]) for at in range(0, len(flat), part)]
        yield packed([r for r in own if r[1].any()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, total, at = zstandard.ZstdDecompressor().decompress, 0, None
        for b in batches:
            for r in b.to_pylist():
                at, total = r["at"], total + np.frombuffer(unpack(r["counts"]), np.int64)
        yield packed([(at, total)])

    out = np.zeros(2 * CELLS, np.int64)
    unpack = zstandard.ZstdDecompressor().decompress
    for r in encoded.where("trains").select("ids", "spelled").mapInArrow(count, schema).groupBy("at").applyInArrow(add, schema).collect():  # a row for each part
        own = np.frombuffer(unpack(r["counts"]), np.int64)
        out[r["at"] * part : r["at"] * part + len(own)] = own
    shared.unpersist()
    return out[:CELLS], out[CELLS:]


@dataclass
class Trained:
    encoded: DataFrame
    counts: DataFrame  # (token, n)
    total: int
    distinct: int
    model: Model


def train(docs: DataFrame, max_words: int = MAX_WORDS) -> Trained:
    """Learn from all rows of ``docs`` (doc_id, text, trains, scored) that train.

    Counts and weights cover every such text, whole.  The word tree holds at most ``max_words`` tokens, of two
    occurrences at least; the others are spelled, and their exact counts stay a table.
    """
    counts = table(_token_counts(docs.where("trains")), "tokens")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct"), F.coalesce(F.sum(F.col("n") * (F.length("token") + 1)), F.lit(0)).alias("bytes")).head()
    most = counts.where("n > 1 or token = x''").orderBy(F.desc("n"), "token").limit(max_words - 1).toArrow()
    common = dict(zip(most.column("token").to_pylist(), most.column("n").to_pylist()))
    end = common.setdefault(b"", 0)
    words = {t: i for i, t in enumerate(common)}
    n = np.array([*common.values(), 0], np.int64)
    n[-1] = size["total"] - n.sum()
    logs = np.log10(n + 1.0)
    logs[-1] = 0
    if not end:
        logs[words[b""]] = 0
    encoded = table(_encode(docs, words, logs), "encoded")
    held = layouts(size["bytes"])
    salts = 1 + size["bytes"] // (1 << 32)
    code = make_code(n, _spelled_bytes(counts, words))
    ends = endings(list(words))
    pairs = _word_pairs(encoded, code, ends, held, salts).unionByName(_byte_pairs(counts, words, code, held, salts))
    tables = _tables(pairs, code, held, salts)
    model = Model(code, ends, Stream(0, held[0], tables[:TABLES]), Stream(code.escape + 1, held[-1], tables[TABLES:]))
    for stream, counted in zip((model.words, model.spelled), _histograms(encoded, model)):
        fit(counted, stream)
        stream.tables = [STATE.take(t) for t in stream.tables]
    return Trained(encoded, counts, size["total"], size["distinct"], model)


def _spelled_bytes(counts: DataFrame, words: dict[bytes, int]) -> np.ndarray:
    """How often each byte occurs in spelled tokens, with the blank that ends each."""
    shared = counts.sparkSession.sparkContext.broadcast(words)

    def count(batches):
        total = np.zeros(256)
        for b in slices(batches, 50_000):
            other = [(t, n) for t, n in zip(b.column("token").to_pylist(), b.column("n").to_pylist()) if t not in shared.value]
            buf = np.frombuffer(b"".join([t + b" " for t, _ in other]), np.uint8)
            total += np.bincount(buf, np.repeat(np.array([n for _, n in other], float), [len(t) + 1 for t, _ in other]), 256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256), pa.int32()), pa.array(total.astype(np.int64))], ["byte", "n"])

    out = np.zeros(256, np.int64)
    for r in counts.mapInArrow(count, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():  # 256 rows
        out[r["byte"]] = r["n"]
    return out


def lm_scores(docs: DataFrame, training: DataFrame | Column) -> DataFrame:
    """Score all rows of ``docs`` (doc_id, text) under a model of ``training``: the same columns, or a condition on ``docs``.

    doc_id, n_tokens (words and the end), n_known (those in training), train_tokens, base_score (log10 by
    add-one unigrams), score (log10 by context mixing), bits_per_byte (of the lower-cased, blank-joined text
    and its end).  A null text is empty: the end alone.  Ids may be null or repeated; each row is scored by
    itself.  An empty training table gives the predictions of untrained trees.  Other columns are ignored.
    """
    spark = docs.sparkSession
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if isinstance(training, Column):
        rows = docs.select(*columns, F.coalesce(training, F.lit(False)).alias("trains"), F.lit(True).alias("scored"))
    else:
        rows = docs.select(*columns, F.lit(False).alias("trains"), F.lit(True).alias("scored")).unionByName(training.select(*columns, F.lit(True).alias("trains"), F.lit(False).alias("scored")))
    known = train(rows)
    shared = spark.sparkContext.broadcast(known.model)

    def score(batches):
        keep_freed_memory()
        model = shared.value
        for b in _batches(batches, "ids", GROUP_BYTES):
            scores = model.log10([np.frombuffer(x, np.int32) for x in b.column("ids").to_pylist()], b.column("spelled").to_pylist())
            bits = -scores / math.log10(2) / np.array(b.column("size").to_pylist())
            kept = ["row", "doc_id", "n_tokens", "known", "part"]
            yield pa.RecordBatch.from_arrays([*map(b.column, kept), pa.array(scores), pa.array(bits)], [*kept, "score", "bits_per_byte"])

    encoded = known.encoded.where("scored")
    scored = encoded.select("row", "doc_id", "n_tokens", "known", "part", "size", "ids", "spelled").mapInArrow(score, "row long, doc_id long, n_tokens long, known long, part double, score double, bits_per_byte double")
    rare = encoded.select("row", F.explode(F.split(F.col("spelled").cast("string"), " ")).alias("token")).where("token <> ''").select("row", F.col("token").cast("binary").alias("token"))
    more = rare.join(known.counts, "token").groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("logs"))
    below = math.log10(known.total + known.distinct + 1)
    return scored.join(more, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("logs", F.lit(0.0)) - F.col("n_tokens") * below).alias("base_score"),
        "score",
        "bits_per_byte",
    )
