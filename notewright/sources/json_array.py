"""One JSON array, however large, read by many tasks.

Spark's text reader splits the file into byte ranges of records that end with a
closing brace.  A record may begin inside a string, at any depth; a first pass sums
up each range for both cases (does it begin inside a string, or not), and the
summaries, put together in the order of the file, tell where each range really
begins: inside a string or not, how deep, at which element.  A second pass cuts the
elements.  Those that lie across ranges come as fragments and are joined.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from notewright.errors import DatasetLoadError

_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|["{}\[\],]', re.DOTALL)
_REST_OF_STRING = re.compile(r'(?:[^"\\]|\\.)*+"', re.DOTALL)
_SUMMARY = "path string, start long, head string, inside_outside boolean, depth_outside int, commas_outside map<int,long>, inside_inside boolean, depth_inside int, commas_inside map<int,long>"
_MEMBERS = "path string, start long, carried long, own long, opened int, last int, name string"
_CUT = "pos long, part long, whole boolean, text string"
Place = tuple[str, int]


@dataclass
class Walk:
    """Goes through records, keeping whether a string is open, and the depth (from where it began)."""

    inside: bool
    depth: int = 0
    begun: str = ""  # what is known of the string that is open, if it lies one deep

    def over(self, text: str) -> Iterator[tuple[str, int, int]]:
        """Brackets, commas and whole strings of the next record; ``depth`` is that after an opening bracket, before a closing one."""
        at = 0
        if self.inside:
            m = _REST_OF_STRING.match(text)
            self.begun += (text if m is None else m.group()) if self.begun else ""
            if m is None:
                return
            self.inside, at = False, m.end()
            if self.begun:
                yield self.begun, 0, 0
                self.begun = ""
        for m in _TOKEN.finditer(text, at):
            token, a, b = m.group(), m.start(), m.end()
            if token == '"':
                self.inside, self.begun = True, text[a:] if self.depth == 1 else ""
                return
            if token in "{[":
                self.depth += 1
            yield token, a, b
            if token in "]}":
                self.depth -= 1


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Place, Iterator[str]]]:
    """The records of each byte range; a range must be read to its end before the next."""
    rows = ((p, s, v) for b in batches for p, s, v in zip(*(b.column(c).to_pylist() for c in ("path", "start", "value"))))
    row = next(rows, None)
    while row is not None:
        place = row[:2]

        def records():
            nonlocal row
            while row is not None and row[:2] == place:
                value = row[2]
                row = next(rows, None)
                yield value

        yield place, records()


def _closed(records: Iterator[str], last: bool) -> Iterator[str]:
    """Records with the brace that ended them; the last of a file has none."""
    held = next(records, None)
    for r in records:
        yield held + "}"
        held = r
    if held is not None:
        yield held if last else held + "}"


def _summaries(batches):
    for place, records in _ranges(batches):
        walks, commas, head = (Walk(False), Walk(True)), (Counter(), Counter()), ""
        first = True
        for r in records:
            if not first:
                r = "}" + r  # the brace that ended the record before
            first = False
            head = head or r.lstrip()[:1]
            for w, c in zip(walks, commas):
                for token, _, _ in w.over(r):
                    if token == ",":
                        c[w.depth] += 1
        row = [*place, head]
        for w, c in zip(walks, commas):
            row += [w.inside, w.depth, list(c.items())]
        types = [pa.string(), pa.int64(), pa.string()] + [pa.bool_(), pa.int32(), pa.map_(pa.int32(), pa.int64())] * 2
        names = [f.split()[0] for f in _SUMMARY.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)


@dataclass
class Start:
    """Where a range begins: inside a string, at what depth, in which array (0: another, 1: the one asked for), at which element."""

    part: int
    last: bool
    inside: bool
    depth: int
    array: int = 1
    element: int = 0


def _members(starts: dict[Place, Start], key: str, name_key: str):
    """Pass over an object: commas two deep in the array open at the start and in that of ``key``, and what is open at the end."""

    def run(batches):
        for place, records in _ranges(batches):
            s = starts[place]
            walk, carried, own, opened, last, said, name = Walk(s.inside, s.depth), 0, 0, 0, -1, None, None
            for r in _closed(records, s.last):
                for token, _, _ in walk.over(r):
                    if token[0] == '"':
                        if walk.depth == 1:
                            name = json.loads(token) if said == name_key else name
                            said = json.loads(token)
                    elif token == "," and walk.depth == 1:
                        said = None
                    elif token in "{[" and walk.depth == 2:
                        last = int(token == "[" and said == key)
                        opened += last
                    elif token == "," and walk.depth == 2:
                        carried, own = carried + (last < 0), own + (last == 1)
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*place, carried, own, opened, last, name), types)], [f.split()[0] for f in _MEMBERS.split(", ")])

    return run


def _cut(starts: dict[Place, Start], base: int, key: str | None):
    """Pass that cuts elements: whole ones, and fragments of those that go across the ends of ranges."""

    def run(batches):
        for place, records in _ranges(batches):
            s = starts[place]
            walk, array, element, said, since = Walk(s.inside, s.depth), s.array, s.element, None, not (s.depth >= base and s.array)
            rows: list[tuple] = []
            held: list[str] = []  # of the element that is open
            for r in _closed(records, s.last):
                at = 0 if walk.depth >= base and array else None
                for token, a, b in walk.over(r):
                    if token[0] == '"':
                        said = json.loads(token) if key and walk.depth == 1 else said
                    elif token in "{[" and walk.depth == base:
                        array = int(key is None or token == "[" and said == key)
                        at, since = b if array else None, True
                    elif array and walk.depth == base and token in ",]":
                        held.append(r[at:a])
                        rows.append((element, s.part, since, "".join(held)))
                        held, at, since = [], b, True
                        if token == ",":
                            element += 1
                        else:
                            at = None
                if at is not None:
                    held.append(r[at:])
                if len(rows) > 1000:
                    yield _batch(rows)
                    rows = []
            if held:
                rows.append((element, s.part, False, "".join(held)))
            if rows:
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.bool_(), pa.string()))], ["pos", "part", "whole", "text"])


@dataclass
class JsonArray:
    """Elements (pos, text) of an array; whether it is the member of an object, and that object's name, if any."""

    elements: DataFrame
    in_object: bool
    name: str | None


def read_array(spark: SparkSession, path: str, key: str | None = None, name_key: str = "dataset_name") -> JsonArray:
    """The elements of the JSON array in ``path`` (a file, or a folder whose files follow each other by name).

    With ``key`` the text may also be an object, whose member of that name is the array.  ``DatasetLoadError`` if
    there is no such file, or it holds something else, or ends too early.  Elements are not parsed here.  The driver
    sees a summary of each byte range (``spark.sql.files.maxPartitionBytes``).  A name that holds a brace and
    lies across two ranges is not seen.
    """
    try:
        lines = spark.read.option("lineSep", "}").text(path)
    except AnalysisException as e:
        raise DatasetLoadError("not found", path=path) from e
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    found = sorted(lines.mapInArrow(_summaries, _SUMMARY).collect(), key=lambda r: (r["path"], r["start"]))
    head = next((r["head"] for r in found if r["head"]), "")
    if head not in ("[", "{") or head == "{" and key is None:
        raise DatasetLoadError("expected a JSON array" + (f", or an object with {key}" if key else ""), path=path)
    last = {r["path"]: r["start"] for r in found}
    starts, inside, depth, commas = {}, False, 0, []
    for i, r in enumerate(found):
        place = (r["path"], r["start"])
        kind = "inside" if inside else "outside"
        starts[place] = Start(i, last[r["path"]] == r["start"], inside, depth)
        commas.append({depth + d: n for d, n in r[f"commas_{kind}"].items()})
        inside, depth = r[f"inside_{kind}"], depth + r[f"depth_{kind}"]
        if not starts[place].last and not inside:
            depth -= 1  # the brace that ends the range
    name, base = None, 1
    if head == "{":
        base, members = 2, {(r["path"], r["start"]): r for r in lines.mapInArrow(_members(starts, key, name_key), _MEMBERS).collect()}
        if sum(r["opened"] for r in members.values()) != 1:
            raise DatasetLoadError(f"expected an object with one array {key}", path=path)
        array = commas = 0
        for place, s in starts.items():
            s.array, s.element = array, commas
            r = members[place]
            commas += r["own"] + (r["carried"] if array else 0)
            array = array if r["last"] < 0 else r["last"]
            name = r["name"] or name
        total, at_end = commas, 1  # the last brace of a file can't be seen
    else:
        total = 0
        for s, c in zip(starts.values(), commas):
            s.element, total = total, total + c.get(1, 0)
        at_end = 0
    if inside or depth not in (at_end, 0):
        raise DatasetLoadError("the text ends too early, or goes on after its end", path=path)
    cut = lines.mapInArrow(_cut(starts, base, key if base == 2 else None), _CUT)
    if len(starts) > 1:
        parts = cut.where(~F.col("whole")).groupBy("pos").agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("p"))
        cut = cut.where("whole").select("pos", "text").unionAll(parts.select("pos", F.array_join("p.text", "").alias("text")))
    cut = cut.select("pos", F.regexp_replace("text", r"^\s+|\s+$", "").alias("text"))
    return JsonArray(cut if total else cut.where("text <> ''"), base == 2, name)
