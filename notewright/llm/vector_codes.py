"""Vector codes by active-entry Lloyd iterations.

Vectors are cut into parts, each with a codebook of its own, and a vector's code
is the nearest entry of each part.  The rows keep, part by part, the entry they
have and the exact distance to it.  In a later round a part whose entry did not
move compares only the entries that did move with that distance; a part whose
entry moved is scanned against the whole codebook.  The outcome is that of a full
scan, ties going to the lower index, for a fraction of the work as entries settle.

All arithmetic is on whole numbers: float64 where every sum is below 2**53, else
int64, else Python's own.  A round is one narrow pass that writes its rows, and
sums by entry, which Spark adds up; the driver holds codebooks only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import slices, table

_LONG = 2**63 - 1
#: Sums are added up by Spark in pieces of so many bits, so that no sum of longs can overflow.
_LIMB = 31
#: With at most so many labels their sums are broadcast.
_MAX_LABELS = 1_000_000


def _exact_kind(most: int, width: int) -> type:
    """What holds the squared distance of two parts whose components are at most ``most`` in size."""
    top = 4 * max(1, width) * most * most
    return np.float64 if top < 2**53 else np.int64 if top < 2**63 else object


def _whole(x: float, scale: int) -> int:
    """floor(scale * x), also where the product is beyond a double."""
    return math.floor(x * scale) if abs(x) < 2.0**53 else int(x) * scale


def integer_parts(vectors: Sequence[Sequence[float]], parts: int, width: int, scale: int, kind: type) -> np.ndarray:
    """floor(scale * x) of each component, by vector, part and place; what a vector lacks is 0."""
    out = np.zeros((len(vectors), parts * width), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = [_whole(x, scale) for x in v] if kind is object else np.floor(np.asarray(v, np.float64) * scale)
    return out.reshape(len(vectors), parts, width)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries."""
    if x.dtype == object:
        return np.array([[sum((a - b) ** 2 for a, b in zip(r, e)) for e in entries] for r in x], object).reshape(len(x), len(entries))
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)


def assign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray | None = None, near: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row of ``x`` and its distance; ties go to the lower index.

    ``code`` and ``near`` are those of the round before, after which the entries ``moved`` (a mask) moved.
    """
    if code is None:
        rescan = np.ones(len(x), bool)
        code, near = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
    else:
        rescan, code, near = moved[code], code.copy(), near.copy()
    if rescan.any():
        d = distances(x[rescan], entries)
        code[rescan] = best = d.argmin(axis=1)  # the first of equal ones
        near[rescan] = d[np.arange(len(d)), best]
    stay, active = np.flatnonzero(~rescan), np.flatnonzero(moved)
    if len(stay) and len(active):
        d = distances(x[stay], entries[active])
        best = d.argmin(axis=1)
        found, entry = d[np.arange(len(d)), best], active[best]
        better = (found < near[stay]) | (found == near[stay]) & (entry < code[stay])
        code[stay[better]], near[stay[better]] = entry[better], found[better]
    return code, near


def _limbs(n: int) -> list[int]:
    """A whole number in pieces of ``_LIMB`` bits, lowest first, with the number's sign."""
    sign, n, out = (-1 if n < 0 else 1), abs(n), []
    while n:
        out.append(sign * (n & (1 << _LIMB) - 1))
        n >>= _LIMB
    return out


def _floats(values: pa.Array) -> list:
    """Rows of a list column; as arrays where they are of one length."""
    flat, sizes = values.flatten().to_numpy(zero_copy_only=False), values.value_lengths().to_numpy(zero_copy_only=False)
    return list(flat.reshape(len(sizes), -1)) if len(sizes) and sizes[0] and (sizes == sizes[0]).all() else values.to_pylist()


def _stored(near: np.ndarray) -> pa.Array:
    """Distances (rows by parts) as text, which holds whole numbers of any size."""
    return pa.array([",".join(map(str, r)) for r in (near.astype(np.int64) if near.dtype == np.float64 else near).tolist()], pa.string())


class Codebooks:
    """Entries by part, entry and place, and which moved last; small enough for every task."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.moved = np.ones(entries.shape[:2], bool)

    def replaced(self, found: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Each entry becomes floor(sum / count) of ``found`` (by part and entry); one that is not there stays."""
        out = Codebooks(self.entries.copy())
        for (p, e), (n, sums) in found.items():
            out.entries[p, e] = [s // n for s in sums]
        out.moved = np.array([[tuple(a) != tuple(b) for a, b in zip(x, y)] for x, y in zip(out.entries, self.entries)], bool).reshape(out.moved.shape)
        return out

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, label, e of the rows whose vector is not null and holds finite components only."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("e"))
    fine = F.forall("e", lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col("e").isNotNull() & fine)


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """Codes of ``vectors`` (vec_id, embedding, label): vec_id, code, error, label_error, codebooks_sha256, full_scans.

    Rows whose vector is null, or holds a null or non-finite component, are dropped.  Each component becomes
    floor(scale * x).  A vector is cut into ``parts`` equal parts; if lengths differ, or are no multiple of
    ``parts``, it counts as having zeros at its end, up to the longest.  Codebooks start as the parts of the
    ``entries`` (256 at most) smallest vec_ids (of repeated ids the smaller vector first, null ids last), fewer if
    there are fewer rows.  ``code`` has two hex digits a part, ``error`` is the sum of squared distances,
    ``label_error`` its sum over equal labels (null labels together); either is the largest long where it is
    beyond one.  ``full_scans`` counts the parts of the row that the last round scanned fully.  Repeated rows
    count each; an empty table gives no rows.  Other columns are ignored.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    spark = vectors.sparkSession
    rows = table(usable(vectors), "vectors")
    size = rows.agg(F.max(F.size("e")).alias("dim"), F.max(F.aggregate("e", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))).alias("most")).head()
    if size["dim"] is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string, full_scans int")
    width = -(-size["dim"] // parts)
    kind = _exact_kind(_whole(size["most"], scale) + 1, width)
    first = rows.select("vec_id", "e").orderBy(F.col("vec_id").asc_nulls_last(), "e").limit(entries).collect()
    books = Codebooks(integer_parts([r["e"] for r in first], parts, width, scale, kind).transpose(1, 0, 2).copy())
    state = rows.select("*", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("string").alias("near"), F.lit(0).cast("long").alias("error"), F.lit(0).alias("full_scans"))
    for i in range(rounds + 1):
        state = table(_assigned(state, books, parts, width, scale, kind), f"codes-{i}")
        if i < rounds:
            books = books.replaced(_entry_sums(state, books, parts, width, scale, kind))
    coded = state.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error", "full_scans")
    most = F.lit(_LONG).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    sums = table(sums, "label-errors").withColumnRenamed("label", "_label")
    if sums.count() <= _MAX_LABELS:
        joined = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("_label")))
    else:  # copies of the sums, so that the rows of one label go to several tasks
        salted = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
        joined = coded.withColumn("_row", F.pmod(F.xxhash64("vec_id", "code"), F.lit(16))).join(salted, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_row") == F.col("_salt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"), "full_scans")


def _assigned(state: DataFrame, books: Codebooks, parts: int, width: int, scale: int, kind: type) -> DataFrame:
    """The rows with the code and the distance of each part under ``books``."""
    shared = state.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        for b in slices(batches, 2048):
            if not b.num_rows:
                continue
            x = integer_parts(_floats(b.column("e")), parts, width, scale, kind)
            old = b.column("codes").to_pylist()
            known = old[0] is not None  # all rows or none have codes
            code = np.zeros((len(x), parts), np.uint8)
            near = np.zeros((len(x), parts), kind)
            full = np.full(len(x), 0 if known else parts, np.int32)
            if known:
                before = np.frombuffer(b"".join(old), np.uint8).reshape(-1, parts).astype(np.int64)
                said = [r.split(",") for r in b.column("near").to_pylist()]
                last = np.array([[int(d) for d in r] for r in said], object).astype(kind)
            for p in range(parts):
                given = (before[:, p], last[:, p]) if known else (None, None)
                code[:, p], near[:, p] = assign(np.ascontiguousarray(x[:, p]), books.entries[p], books.moved[p], *given)
                if known:
                    full += books.moved[p][before[:, p]]
            error = [min(_LONG, int(d)) for d in near.sum(axis=1)]
            raw = code.tobytes()
            codes = pa.array([raw[i : i + parts] for i in range(0, len(raw), parts)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), b.column("e"), codes, _stored(near), pa.array(error, pa.int64()), pa.array(full)], ["vec_id", "label", "e", "codes", "near", "error", "full_scans"])

    return state.mapInArrow(run, state.schema)


def _entry_sums(state: DataFrame, books: Codebooks, parts: int, width: int, scale: int, kind: type) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """By part and entry: the number of parts there, and the sums of their components.  At most parts x entries of them."""

    def run(batches):
        shape = books.entries.shape
        n, total = np.zeros(shape[:2], np.int64), np.zeros(shape, object if kind is object else np.int64)
        for b in slices(batches, 2048):
            if b.num_rows:
                x = integer_parts(_floats(b.column("e")), parts, width, scale, kind)
                code = np.frombuffer(b"".join(b.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
                for p in range(parts):
                    n[p] += np.bincount(code[:, p], minlength=shape[1])
                    np.add.at(total[p], code[:, p], x[:, p] if kind is object else x[:, p].astype(np.int64))
        out = [(p, e, -1, 0, int(n[p, e])) for p, e in zip(*np.nonzero(n))]
        out += [(p, e, i, k, v) for p, e in zip(*np.nonzero(n)) for i, s in enumerate(total[p, e].tolist()) for k, v in enumerate(_limbs(s))]
        columns = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array([int(v) for v in c], pa.int64()) for c in columns], ["part", "entry", "place", "limb", "value"])

    added = state.select("e", "codes").mapInArrow(run, "part long, entry long, place long, limb long, value long").groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value"))
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in added.collect():
        n, sums = out.get((r["part"], r["entry"]), (0, [0] * width))
        if r["place"] < 0:
            n += r["value"]
        else:
            sums[r["place"]] += r["value"] << (_LIMB * r["limb"])
        out[r["part"], r["entry"]] = (n, sums)
    return out


def oracle(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The same result in SQL: the rounds written out one after the other."""
    ctes = [
        f"""v AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"x AS (SELECT rid, p, e[p * (len(e) // {parts}) + 1 : (p + 1) * (len(e) // {parts})] AS x FROM v, range({parts}) t(p))",
        f"c0 AS (SELECT p, rid - 1 AS k, x AS c FROM x WHERE rid <= {entries})",
    ]
    for i in range(rounds + 1):
        ctes.append(f"d{i} AS (SELECT rid, p, min({{'d': CAST(coalesce(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 0) AS BIGINT), 'k': k}}) AS a FROM x JOIN c{i} USING (p) GROUP BY rid, p)")
        if i < rounds:
            ctes.append(f"s{i} AS (SELECT p, k, i, sum(v) AS s, count(*) AS n FROM (SELECT p, a.k AS k, unnest(x) AS v, unnest(range(len(x))) AS i FROM x JOIN d{i} USING (rid, p)) GROUP BY ALL)")
            ctes.append(f"m{i} AS (SELECT p, k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{i} GROUP BY p, k)")
            ctes.append(f"c{i + 1} AS (SELECT p, k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (p, k))")
    last = rounds
    ctes.append(f"w AS (SELECT rid, string_agg(format('{{:02x}}', a.k), '' ORDER BY p) AS code, CAST(sum(a.d) AS BIGINT) AS error FROM d{last} GROUP BY rid)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{last})")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN w USING (rid), h"
