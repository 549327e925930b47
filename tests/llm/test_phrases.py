import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from notewright.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n long, rank int, phrase string, size int, shard int, h long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, "p", 3, 4, 5) for i, (lang, t) in enumerate(rows)], SCHEMA)


def brute(rows, longest, least, top, share=80, scale=2_000_000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in cand.items():
        if any(lg == lang and len(q) > len(w) and 100 * b >= share * a and any(q[i : i + len(w)] == w for i in range(len(q))) for (lg, q), b in cand.items()):
            continue
        score, _, left, right = min((scale * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1))


def mined(spark, rows, **given):
    return sorted(tuple(r) for r in phrases.mine_phrases(frame(spark, rows), **given).collect())


def corpus(n, seed=2):
    """Few words, so that phrases of all lengths repeat; clear favourites, late beginners and all kinds of ends."""
    rng = random.Random(seed)
    words = ["The", "of", "und", "É", "naïve", "x", "y'z", "漢字", "a-b", " ", "\x1c", "Q"]
    out = []
    for i in range(n):
        own = words[: 4 + i * len(words) // n]
        text = "".join(rng.choice(own) + rng.choice([" "] * 9 + ["\t", "  ", ". ", ",", "\n", "\r\n", ";", "!?", ":\x0b"]) for _ in range(rng.randrange(40)))
        out.append((rng.choice(["en", "en", "en", None, "de", ""]), text))
    return out + [("en", None), ("en", ""), ("de", " \t . ,")]


@pytest.mark.parametrize("longest,least,top,shards", [(4, 5, 50, 4), (3, 3, None, 2), (4, 12, 2000, 3), (2, 5, 10, 1), (5, 8, 2000, 4)])
def test_phrases_by_brute_force(spark, longest, least, top, shards):
    rows = corpus(160)
    got = mined(spark, rows, longest=longest, least=least, top=top, shards=shards)
    assert got == brute(rows, longest, least, top) and got


def test_full_filters_and_small_buffers_change_nothing(spark, monkeypatch):
    """A filter that passes almost everything, buffers of a few words, and joins by shuffles: the same counts."""
    rows = corpus(120, 5)
    want = brute(rows, 4, 6, 2000)
    for name, value in (("_FEWEST", 6), ("_MOST", 6), ("_CHUNK", 50), ("_NAMES", 50), ("_COUNTS", 10), ("_SMALL_ROWS", 0)):
        monkeypatch.setattr(phrases, name, value)
    docs = frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts, words = phrases.count_phrases(docs, 4, 6, 4)
    assert mined(spark, rows, least=6) == want and counts.count() and words.count()


def test_phrases_in_ties_copies_and_long_texts(spark):
    rows = [("en", "alpha beta. Gamma delta")] * 40 + [("en", "alpha beta gamma " * 30_000), ("en", "w" * 300_000), (None, "no no no no no")] * 10
    assert mined(spark, rows) == brute(rows, 4, 30, 2000)


def test_phrases_of_nothing(spark):
    assert mined(spark, []) == [] and mined(spark, [("en", None), (None, "")]) == [] and mined(spark, [("en", "a b c")]) == []


def test_phrases_are_counted_for_one_cycle(spark):
    """A scan counts what passes now and did not a cycle ago; all lengths at once."""
    rows = [("en", "a b c d e")] * 12 + [("en", "f g")] * 3 + [("en", "x y z")] * 12
    none, full = phrases.BitFilter(10), phrases.BitFilter(10)
    full.words[:] = 255

    def at(now, old):
        return [(size, at.tolist()) for size, at, _ in phrases.Scan(b"a b c.d e f g", "en").phrases(4, now, old)]

    assert at(full, none) == at(full, None) == [(2, [0, 1, 3, 4, 5]), (3, [0, 3, 4]), (4, [3])]
    assert [x for _, x in at(full, full)] == [[], [], []] and at(none, none) == []
    assert mined(spark, rows, least=10, shards=3) == brute(rows, 4, 10, 2000)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aB. \t\n,é", max_size=60), st.integers(1, 3))
def test_scan_finds_words_and_phrases(text, size):
    """Words, the ends of pieces, and distinct phrases with their counts, whatever blanks are between words."""
    data = text.encode().translate(phrases._PIECES)
    scan = phrases.Scan(data, "en")
    words = [[w for w in p.split()] for p in data.split(b".")]
    assert [data[a:b] for a, b in zip(scan.starts.tolist(), scan.ends.tolist())] == [w for p in words for w in p]
    full = phrases.BitFilter(8)
    full.words[:] = 255
    found = [(1, np.arange(len(scan.hash)), scan.hash), *scan.phrases(3, full)]
    got = {name: n for m, at, h in found if m == size for name, n, _ in scan.named(at, m, h, scan.other())}
    assert got == Counter(b" ".join(p[i : i + size]) for p in words for i in range(len(p) - size + 1))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB. \t\n,é", max_size=30), max_size=8), st.integers(1, 12))
def test_chunks_lose_nothing(texts, size):
    raw = [t.encode() for t in texts]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(phrases, "_CHUNK", size)
        got = [w for c in phrases.chunks(raw) for p in c.split(b".") for w in [p.split()] if w]
    assert sorted(got) == sorted(w for t in raw for p in t.translate(phrases._PIECES).split(b".") for w in [p.split()] if w)  # short texts may come later


def test_counts_are_packed_whole():
    """Owners get every place once, with counts of up to a byte."""
    places, n = np.array([1, 5, 2**20 - 1, 2**20, 7 * 2**20 + 3], np.uint32), np.array([1, 300, 2, 3, 4])
    rows = [r for b in phrases._packed(places, n) for r in b.to_pylist()]
    got = [(r["owner"] * 2**20 + int(p), int(c)) for r in rows for p, c in zip(np.frombuffer(r["places"], "<u4"), np.frombuffer(r["n"], np.uint8))]
    assert got == [(1, 1), (5, 255), (2**20 - 1, 2), (2**20, 3), (7 * 2**20 + 3, 4)] and list(phrases._packed(places[:0], n[:0])) == []


def test_a_scan_counts_what_its_filter_adds():
    """Whatever bits phrases share: a scan counts what one by the new filter alone counts, but for what one by the old alone counted."""
    rng = np.random.default_rng(3)
    data = b" ".join(b"w%d" % i if i % 17 else b"." for i in rng.integers(0, 60, 800).tolist())
    scan = phrases.Scan(data, "en")
    for bits in (5, 6, 7, 8, 9) * 8:
        none = phrases.BitFilter(bits)
        old = none.with_bits(rng.integers(0, 1 << bits, (1 << bits) // 2))
        now = old.with_bits(rng.integers(0, 1 << bits, (1 << bits) // 4))
        every, before, got = ({(size, i) for size, at, _ in scan.phrases(4, *f) for i in at.tolist()} for f in ((now,), (old,), (now, old)))
        assert got == every - before


def test_long_words_of_equal_sums_are_told_apart(spark):
    """Thue-Morse words: sums of bytes times powers of any odd number agree."""
    one = "a"
    for _ in range(11):
        one += one.translate(str.maketrans("ab", "ba"))
    rows = [("en", f"x {one} y")] * 31 + [("en", f"x {one.translate(str.maketrans('ab', 'ba'))} y")] * 33
    assert mined(spark, rows) == brute(rows, 4, 30, 2000)
