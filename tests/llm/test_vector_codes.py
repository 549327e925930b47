import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from notewright.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, parts, entries, rounds, scale):
    """Lloyd by full scans over whole numbers; rows as (vec_id, vector, label)."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = max((len(v) for _, v, _ in kept), default=0)
    width = -(-dim // parts)
    whole = lambda x: math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale
    cut = lambda v: [([whole(x) for x in v] + [0] * (parts * width))[: parts * width][p * width : (p + 1) * width] for p in range(parts)]
    xs = [cut(v) for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))[:entries]
    books = [[xs[r][p] for r in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for i in range(rounds + 1):
        near = [[min((dist(x[p], c), k) for k, c in enumerate(books[p])) for p in range(parts)] for x in xs]
        if i < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    own = [x[p] for x, n in zip(xs, near) if n[p][1] == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    cap = lambda n: min(n, 2**63 - 1)
    errors = [cap(sum(d for d, _ in n)) for n in near]
    by_label = {}
    for (_, _, lab), e in zip(kept, errors):
        by_label[lab] = by_label.get(lab, 0) + e
    return sorted(((i, "".join(f"{k:02x}" for _, k in n), e, cap(by_label[lab]), sha) for (i, _, lab), n, e in zip(kept, near, errors)), key=str)


def got(spark, rows, **given):
    out = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), **given)
    return sorted((tuple(r)[:5] for r in out.collect()), key=str)


def test_codes_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], rng.choice([None, 0, 1])) for i in range(300)]
    given = {"parts": 4, "entries": 16, "rounds": 4, "scale": 1024}
    assert got(spark, rows, **given) == brute(rows, **given)


def test_codes_of_odd_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (3, None, 1), (2, [None, 1.0], 1), (9, [inf, 1.0], 1), (8, [nan, 1.0], 1), (None, [0.5, -0.25], None), (7, [], None), (1, [0.3, 0.3, 0.3, 0.3, 0.3], 2), (6, [-0.0001, 0.0], 1)]
    given = {"parts": 4, "entries": 3, "rounds": 3, "scale": 1024}
    assert got(spark, rows, **given) == brute(rows, **given) and len(got(spark, rows, **given)) == 6


@pytest.mark.parametrize("size", [1.0, 1e9, 1e30, 1e300])
def test_codes_are_exact_at_any_size(spark, size):
    rng = random.Random(5)
    rows = [(i, [size * rng.choice([-1, 0, 0.5, 1, 1.0000000001]) for _ in range(4)], i % 2) for i in range(60)]
    given = {"parts": 2, "entries": 5, "rounds": 4, "scale": 1024}
    assert got(spark, rows, **given) == brute(rows, **given)


def test_codes_of_nothing(spark):
    assert got(spark, []) == [] and got(spark, [(1, None, 1)]) == []
    assert [r[1:4] for r in got(spark, [(1, [], 1)])] == [("00000000", 0, 0)]


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, [0.5] * 4, 1, "a", 2, 3)], SCHEMA + ", e string, code int, near int")
    assert vector_codes.compress(rows).count() == 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-4, 4), min_size=2, max_size=2), min_size=1, max_size=40), st.lists(st.lists(st.integers(-4, 4), min_size=2, max_size=2), min_size=1, max_size=9), st.data())
def test_active_entries_decide_as_a_full_scan(rows, before, data):
    """After any entries moved, the stored distances and the moved entries give what a scan of all gives."""
    x, old = np.array(rows, float), np.array(before, float)
    new = np.array([data.draw(st.sampled_from([tuple(e), (0, 0), (1, -1)])) for e in before], float)
    moved = (old != new).any(axis=1)
    code, near = vector_codes.assign(x, old, np.ones(len(old), bool))
    fast, full = vector_codes.assign(x, new, moved, code, near), vector_codes.assign(x, new, np.ones(len(new), bool))
    assert fast[0].tolist() == full[0].tolist() and fast[1].tolist() == full[1].tolist()


def test_settled_parts_are_not_scanned(spark):
    """Two far groups settle at once: the last round scans nothing fully."""
    rows = [(i, [float(i % 2) * 100 + i % 3 * 0.001] * 4, 0) for i in range(60)]
    assert {r["full_scans"] for r in vector_codes.compress(spark.createDataFrame(rows, SCHEMA), entries=2).collect()} == {0}
