"""Token counts by heap-and-linked-list byte-pair merging.

A text is split as the tokenizer splits it, each piece becomes a linked list of
its bytes, and a heap of adjacent pairs is popped lowest rank first (leftmost
first among equals).  Only the number of merges matters: tokens = initial
symbols - merges, so no identifiers are emitted.
"""

from __future__ import annotations

import json
import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import slices

#: Fixed values of the tokenizer's split pattern; white space is listed, as libraries differ on control characters.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPLIT_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
_CUT = re.compile(rf" (?=[^{_SPACE}])")
_IRREGULAR = re.compile(rf" (?:[{_SPACE}]|\Z)|\A ")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies, by its public rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class BpeCounter:
    """Counts tokens of texts under one tokenizer file; keeps a bounded cache of pieces."""

    def __init__(self, path: str, cache_size: int = 600_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.byte_ids = [vocab[c] for c in byte_symbols()]
        self.merges = {vocab[a] << 17 | vocab[b]: rank << 17 | vocab[a + b] for rank, (a, b) in enumerate(spec["model"]["merges"])}
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.special_mark = special[0][:2] if special else None
        self.pieces = regex.compile(SPLIT_PATTERN)
        self.cache: dict[str, int] = {}
        self.cache_size = cache_size

    def piece(self, piece: str) -> int:
        """Tokens of one piece."""
        ids = self.byte_ids
        symbol = [ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        n = len(symbol)
        if n < 2:
            return n
        merges = self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get(symbol[i] << 17 | symbol[i + 1])
            if found is not None:
                heap.append((found >> 17) << 32 | i)
        heapify(heap)
        count = n
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            if symbol[i] < 0 or j >= n:
                continue
            found = merges.get(symbol[i] << 17 | symbol[j])
            if found is None or found >> 17 != top >> 32:
                continue  # the pair that was queued here is gone
            symbol[i] = found & 0x1FFFF
            symbol[j] = -1
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get(symbol[i] << 17 | symbol[k])
                if found is not None:
                    heappush(heap, (found >> 17) << 32 | i)
            h = before[i]
            if h >= 0:
                found = merges.get(symbol[h] << 17 | symbol[i])
                if found is not None:
                    heappush(heap, (found >> 17) << 32 | h)
        return count

    def _chunk(self, chunk: str) -> int:
        cache, total = self.cache, 0
        pieces = self.pieces.findall(chunk)
        for p in pieces:
            found = cache.get(p)
            if found is None:
                found = self.piece(p)
                if len(pieces) > 1 and len(p) <= 64:
                    cache[p] = found
            total += found
        if len(chunk) <= 64:
            cache[chunk] = total
        return total

    def _plain(self, text: str) -> int:
        # A blank before a non-blank always opens a piece, so the text may be cut there.
        first, *rest = _CUT.split(text) if _IRREGULAR.search(text) else text.split(" ")
        total, get = self._chunk(first) if first else 0, self.cache.get
        for word in rest:
            chunk = " " + word
            found = get(chunk)
            total += self._chunk(chunk) if found is None else found
        if len(self.cache) > self.cache_size:
            self.cache.clear()
        return total

    def count(self, text: str | None) -> int:
        """Tokens of a whole text; each special string inside it is one token."""
        if not text:
            return 0
        if self.special is None or self.special_mark not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)


_COUNTERS: dict[str, BpeCounter] = {}


def counter(path: str) -> BpeCounter:
    """The counter of a file, kept by the Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = BpeCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, tokenizer_path: str, max_tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > max_tokens).

    A null text counts as empty (0 bytes, 0 tokens).  Ids may be null or repeated; each row is counted
    by itself, in one narrow pass without a shuffle.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches):
        c = counter(tokenizer_path)
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            n = [c.count(t) for t in texts]
            size = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > max_tokens for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
