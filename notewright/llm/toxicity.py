"""Toxicity scores by noisy-channel deobfuscation.

A token that hides letters (leetspeak, separators, repetition), or several
neighbouring tokens that blanks cut a word into, become a lattice of the characters
they may stand for, blanks among them; Viterbi decoding under a character trigram
model restores it, and the restored text is scored by word and word-beginning
features learned from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import mix64, slices, table, tidy

#: What a character may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiouh",
}
_SEPARATORS = frozenset(".,-_~*'’·:;/\\|=+^`\"!?()[]{}<>#%&​‌‍­")
_EDGE = re.compile(r"^[^\w@$!|+(€£¡*#]+|[^\w]+$", re.UNICODE)
_LEAD = re.compile(r"^[^\w@$!|+(€£¡*#]+", re.UNICODE)
_PIECES = re.compile(r"[^\W\d_]+", re.UNICODE)
_RUN = re.compile(r"(.)\1*", re.DOTALL)
_LONG_RUN = re.compile(r"(.)\1\1", re.DOTALL)
_DOUBLE = re.compile(r"(.)\1", re.DOTALL)
_BYTE_RUN = re.compile(rb"(.)\1+", re.DOTALL)
LM_BITS = 18
#: Letters that one disguise may stand for count as one when words cut by blanks are looked for.
_ALIKE = {"l": "i", "g": "b"}
_OUTLINE = bytes(ord(_ALIKE.get(c := LEET.get(chr(b), chr(b).lower())[0], c)) if b < 128 and chr(b) not in "*#" else b for b in range(256))
_DROPPED = bytes(b for b in range(128) if not chr(b).isalnum() and (chr(b) not in LEET or chr(b) in "*#"))
BEGIN, END = 2, 3


def _slots(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64((a.astype(np.uint64) << np.uint64(42)) ^ (b.astype(np.uint64) << np.uint64(21)) ^ c.astype(np.uint64)) >> np.uint64(64 - LM_BITS)


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed counts of character trigrams, and of their first two, over the words of lower-cased texts."""
    words: Counter = Counter()
    for t in texts:
        words.update(_PIECES.findall(t))
    codes = np.frombuffer("".join([f"\x02\x02{w}\x03" for w in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    times = np.repeat(np.array(list(words.values()), np.int64), [len(w) + 3 for w in words])  # a word's trigrams count as often as it
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    ok = (c != BEGIN) & (b != END) & (a != END)
    a, b, c, n = a[ok], b[ok], c[ok], times[2:][ok]
    size = 1 << LM_BITS
    return tuple(np.bincount(_slots(a, b, x).astype(np.int64), n, size).astype(np.int64) for x in (c, np.zeros_like(c)))


class CharModel:
    """Character trigrams from hashed counts; those of known words are mixed in."""

    def __init__(self, tri: np.ndarray, bi: np.ndarray, words: dict[str, int], share: float = 0.5):
        own_tri, own_bi = trigram_counts([w for w, n in words.items() for _ in range(min(n, 50))]) if words else (0 * tri, 0 * bi)
        weight = share * max(1, tri.sum()) / max(1, own_tri.sum())
        self.tri, self.bi = tri + weight * own_tri, bi + weight * own_bi
        self.cache: dict[tuple[int, int, int], float] = {}

    def log_prob(self, a: int, b: int, c: int) -> float:
        found = self.cache.get((a, b, c))
        if found is None:
            x, y, z = (np.array([v]) for v in (a, b, c))
            n, m = self.tri[int(_slots(x, y, z)[0])], self.bi[int(_slots(x, y, 0 * z)[0])]
            found = self.cache[a, b, c] = math.log((n + 0.1) / (max(n, m) + 5.0))
        return found


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of one character in ``token``: the strings it may stand for, with their log weights."""
    out = []
    for run in _RUN.finditer(token):
        c, n = run.group(1), len(run.group(0))
        ways: list[tuple[str, float]] = []
        if c.isalpha():
            ways = [(c, 0.0)] if n == 1 else [(c + c, 0.0), (c, -1.5)] if n == 2 else [(c, -0.5), (c + c, -0.5)]
        for x in LEET.get(c, ""):
            ways += [(x, -1.0)] if n == 1 else [(x, -1.5), (x + x, -1.0)]
        if c in _SEPARATORS or c in "_ " or not ways:
            ways.append(("", -1.0 if c in _SEPARATORS or c == " " else -4.0))
        out.append(ways)
    return out


def readings(token: str, model: CharModel, least: int) -> list[str]:
    """The most likely reading of each beginning of ``token`` of ``least`` characters or more that ends with a run:
    Viterbi over the lattice, states are the last two characters."""
    states: dict[tuple[int, int], tuple[float, object]] = {(BEGIN, BEGIN): (0.0, None)}
    found = []
    for run, ways in zip(_RUN.finditer(token), lattice(token)):
        new: dict = {}
        for (a, b), (score, back) in states.items():
            for text, weight in ways:
                x, y, s, link = a, b, score + weight, back
                for c in text:
                    s += model.log_prob(x, y, ord(c))
                    x, y, link = y, ord(c), (link, c)
                if (x, y) not in new or s > new[x, y][0]:
                    new[x, y] = (s, link)
        states = new
        if run.end() >= least:
            _, link = max(((s + model.log_prob(a, b, END), link) for (a, b), (s, link) in states.items()), key=lambda r: r[0])
            out = []
            while link:
                link, c = link
                out.append(c)
            found.append("".join(reversed(out)))
    return found


def outline(text: str) -> bytes:
    """A lower-cased text as letters only: disguises as a letter they stand for, blanks and marks left out, runs drawn together."""
    for sign in "€£¡":
        if sign in text:
            text = text.replace(sign, LEET[sign])
    return _BYTE_RUN.sub(rb"\1", text.encode("utf-8", "surrogatepass").translate(_OUTLINE, _DROPPED))


def restore(token: str, model: CharModel) -> str:
    """The most likely reading of ``token``."""
    return readings(token, model, len(token))[-1] if token else ""


def word_features(word: str) -> list[str]:
    """The whole word (``=word``) and its beginnings of 4 to 8 letters."""
    return ["=" + word, *(word[:n] for n in range(4, min(len(word), 8) + 1))]


def text_features(text: str) -> set[str]:
    """Features of a text as it stands, nothing restored."""
    return {f for w in set(_PIECES.findall(text.lower())) if len(w) > 2 for f in word_features(w)}


def feature_contexts(text: str, wanted) -> set[tuple[str, str]]:
    """The features of ``wanted`` in a text, each with the words beside it; copies of a passage show the same."""
    words = ["", *_PIECES.findall(text.lower()), ""]
    return {(f, f"{words[i - 1]} {words[i + 1]}") for i, w in enumerate(words) if len(w) > 2 for f in word_features(w) if f in wanted}


@dataclass
class Scorer:
    """Logits of texts with a feature, the logit without any, and the character model."""

    weights: dict[str, float]
    base: float
    model: CharModel

    def __post_init__(self):
        self.cache: dict[str, tuple[str, ...]] = {}
        self.beginners: set[str] = set()  # tokens of the cache whose outline begins a known word's
        self.stems = {f.lstrip("=") for f in self.weights}
        self.leads = {w[:n] for w in self.stems for n in range(1, len(w) + 1)}
        self.three = {w[:3] for w in self.stems}
        self.stands: dict[str, tuple[str, bool]] = {}
        self.whole = [f[1:] for f in self.weights if f[0] == "=" and len(f) > 4]
        words = {f.lstrip("=") for f in self.weights if len(f.lstrip("=")) > 4} | set(self.whole)
        self.outlines = {outline(w) for w in words if len(outline(w)) > 3}
        self.begun = {o[:n] for o in self.outlines for n in range(1, len(o) + 1)}
        self.idle = {c for c in map(chr, range(128)) if outline(c) and outline(c) not in self.begun}

    def _hits(self, word: str) -> list[str]:
        """The strongest feature of a word, if it has any."""
        found = [f for f in word_features(word) if f in self.weights] if len(word) > 2 and word[:3] in self.three else []
        return [max(found, key=lambda f: (self.weights[f], f))] if found else []

    def may_hit(self, token: str) -> bool:
        """Whether a reading of ``token``, likely or not, begins with a known word or beginning: without, none has a feature."""
        ends = {""}
        for run in _RUN.finditer(token):
            c = run.group(1)
            if c not in self.stands:
                if len(self.stands) > 10_000:
                    self.stands.clear()
                letters = (c if c.isalpha() else "") + LEET.get(c, "")
                self.stands[c] = letters, c in _SEPARATORS or c in "_ " or not letters
            letters, dropped = self.stands[c]
            more = run.end() - run.start() > 1
            new = set(ends) if dropped else set()
            for e in ends:
                for x in letters:
                    for longer in (e + x, e + x + x) if more else (e + x,):
                        if longer in self.leads:
                            if longer in self.stems:
                                return True
                            new.add(longer)
            if not new:
                return False
            ends = new
        return False

    def token(self, token: str) -> tuple[str, ...]:
        """Features of a lower-cased token, as it stands and restored."""
        if token.isalpha() and not _DOUBLE.search(token):
            return tuple(self._hits(token))
        core = _EDGE.sub("", token)
        tail = _LEAD.sub("", token)[len(core) :]
        while tail and tail[-1] not in LEET:
            tail = tail[:-1]
        plain = core.isalpha() and not _LONG_RUN.search(core)
        found = self._hits(core) if plain else [f for p in _PIECES.findall(core) for f in self._hits(p)]
        if (tail or not plain or (not found and _DOUBLE.search(core))) and any(c.isalpha() for c in core) and self.may_hit(core + tail):
            for word in readings(core + tail, self.model, len(core)):
                found += self._hits(word)
        return tuple(found)

    def spaced(self, letters: str) -> list[str]:
        """Features of letters that stood alone, one after the other."""
        word = restore(letters, self.model)
        return self._hits(word) + ["=" + w for w in self.whole if w in word]

    def cut_up(self, tokens: list[str], beginners: set[str]) -> list[str]:
        """Features of words that blanks cut into several tokens, whole tokens each, the first one of ``beginners``: the lattice
        of such a window, blanks among its characters, is decoded where its outline is a known word's."""
        found, outlines = [], {}

        def of(t: str) -> bytes:
            if t not in outlines:
                outlines[t] = outline(t)
            return outlines[t]

        for i, t in enumerate(tokens[:-1]):
            if t not in beginners:
                continue
            o = of(t)
            for j in range(i + 1, len(tokens)):
                x = of(tokens[j])
                o += x[1:] if x[:1] == o[-1:] else x  # the outline of both
                if o in self.outlines:
                    window = " ".join(tokens[i : j + 1])
                    word = restore(_EDGE.sub("", window), self.model)
                    found += self._hits(word) + ["=" + w for w in self.whole if w == word]
                if o not in self.begun:
                    break
        return found

    def features(self, text: str | None) -> set[str]:
        tokens = text.lower().split() if text else []
        found, cache, distinct, long = set(), self.cache, set(tokens), set()
        for t in distinct:
            hits = cache.get(t)
            if hits is None:
                hits = self.token(t)
                begins = t[0] not in self.idle and outline(t) in self.begun
                if len(t) <= 40:
                    cache[t] = hits
                    if begins:
                        self.beginners.add(t)
                elif begins:
                    long.add(t)
            if hits:
                found.update(hits)
        run: list[int] = []
        for i in [i for i, t in enumerate(tokens) if len(t) == 1] + [-1]:
            if run and i == run[-1] + 1:
                run.append(i)
            else:
                if len(run) >= 4:
                    found.update(self.spaced("".join(tokens[j] for j in run)))
                run = [i]
        if not found and tokens:
            beginners = (self.beginners & distinct) | long
            if beginners:
                found.update(self.cut_up(tokens, beginners))
        if len(cache) > 200_000:
            cache.clear()
            self.beginners.clear()
        return found

    def score(self, text: str | None) -> float:
        found = sorted((self.weights[f] for f in self.features(text)), reverse=True)
        z = found[0] + 0.2 * sum(found[1:]) if found else self.base
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def held_out(doc_id, modulus: int):
    """Whether crc32 of the id as text leaves 2; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus == 2


def choose_features(positives: list[set[tuple[str, str]]], stats: dict[str, tuple[int, int]], sure: int = 6, least: int = 3) -> dict[str, float]:
    """Logits of the features that mark a text.

    ``positives`` has the (feature, context) pairs of each positive text, ``stats`` each feature's numbers of
    positive and negative texts.  A feature seen in ``sure`` contexts marks.  Positives then unexplained are
    covered one feature at a time, the one in most contexts first, down to ``least``; ties go to the longer.
    Of beginnings that say the same, only the longest stays.
    """

    def contexts(rows) -> dict[str, set[str]]:
        out: dict[str, set[str]] = {}
        for row in rows:
            for f, c in row:
                out.setdefault(f, set()).add(c)
        return out

    support = {f: len(c) for f, c in contexts(positives).items()}
    chosen = {f for f, n in support.items() if n >= sure and stats[f][1] <= 0.02 * n}
    rest = [row for row in positives if not any(f in chosen for f, _ in row)]
    while rest:
        left = contexts(rest)
        best = max(left, key=lambda f: (len(left[f]) - 2 * stats[f][1], len(f), f), default=None)
        if best is None or len(left[best]) - 2 * stats[best][1] < least:
            break
        chosen.add(best)
        rest = [row for row in rest if not any(f == best for f, _ in row)]
    letters = {f.lstrip("="): support[f] for f in sorted(chosen, reverse=True)}
    extended = {w[:n] for w, support_of_longer in letters.items() for n in range(4, len(w)) if support_of_longer >= 0.95 * letters.get(w[:n], support_of_longer + 1)}
    return {f: min(7.0, math.log((support[f] + 0.5) / (stats[f][1] + 0.5))) for f in chosen if f.lstrip("=") not in extended}


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> Scorer:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), held-out ids left aside.

    The character model counts the words of all documents.  The features come from at most ``max_labelled``
    labelled documents, those of the smallest hash of doc_id; texts that are equal count once.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    @tidy("toxicity")
    def trigrams(batches):
        tri = bi = np.zeros(1 << LM_BITS, np.int64)
        for b in slices(batches):
            texts, size = [], 0
            for t in b.column("text").to_pylist():
                texts.append((t or "").lower())
                size += len(texts[-1])
                if size > 1_000_000:
                    x, y = trigram_counts(texts)
                    tri, bi, texts, size = tri + x, bi + y, [], 0
            x, y = trigram_counts(texts)
            tri, bi = tri + x, bi + y
        slot = np.flatnonzero(tri + bi)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(tri[slot]), pa.array(bi[slot])], ["slot", "tri", "bi"])

    counted = rows.select("text").mapInArrow(trigrams, "slot long, tri long, bi long").groupBy("slot").agg(F.sum("tri").alias("tri"), F.sum("bi").alias("bi"))
    tri, bi = np.zeros(1 << LM_BITS), np.zeros(1 << LM_BITS)
    found = counted.toArrow()  # at most 2**LM_BITS rows
    slot = found.column("slot").to_numpy()
    tri[slot], bi[slot] = found.column("tri").to_numpy(), found.column("bi").to_numpy()

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id", 4))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample = rows.join(F.broadcast(known), "doc_id").where(F.col("text").isNotNull())
    sample = table(sample.groupBy("text").agg(F.max("toxic").alias("toxic")), "labelled")

    @tidy("toxicity")
    def count(batches):
        seen: Counter = Counter()
        bad: Counter = Counter()
        for b in slices(batches):
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                (bad if toxic else seen).update(text_features(text))
        names = list(bad)  # a feature of no toxic document here is counted where it has one
        names += [f for f in seen if f not in bad]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([bad[f] for f in names], pa.int64()), pa.array([seen[f] for f in names], pa.int64())], ["feature", "pos", "neg"])

    stats = sample.mapInArrow(count, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    stats = {r["feature"]: (r["pos"], r["neg"]) for r in stats.where("pos >= 3 and neg <= 0.05 * pos").collect()}
    shared = spark.sparkContext.broadcast(stats)

    @tidy("toxicity")
    def keep(batches):
        for b in slices(batches):
            pairs = [sorted(feature_contexts(t, shared.value)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": b.column("toxic"), "features": [[f for f, _ in p] for p in pairs], "contexts": [[c for _, c in p] for p in pairs]}, schema=kept)

    kept = pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.string())), ("contexts", pa.list_(pa.string()))])
    rows = sample.mapInArrow(keep, "toxic int, features array<string>, contexts array<string>").collect()  # at most max_labelled
    weights = choose_features([set(zip(r["features"], r["contexts"])) for r in rows if r["toxic"]], stats)
    plain = [r["toxic"] for r in rows if not any(f in weights for f in r["features"])]
    rate = (sum(plain) + 0.05) / (len(plain) + 1.0)
    lexicon = {f.lstrip("="): stats[f][0] for f in weights}
    return Scorer(weights, math.log(rate / (1 - rate)), CharModel(tri, bi, lexicon))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 20_000) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Null and empty texts score as texts without any sign.  Ids may be null or repeated; labels that are null,
    or not 0 or 1, are ignored, and of several for one id the largest counts.  Without labels all texts get
    one low score.  Other columns are ignored.
    """
    scorer = train(docs, labels, max_labelled)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.base, scorer.model))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", 4).alias("held_out"), F.col("text").cast("string").alias("text"))

    @tidy("toxicity")
    def score(batches):
        s = Scorer(*shared.value)
        for b in slices(batches):
            scores = [s.score(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(scores, pa.float64()), pa.array([int(x >= threshold) for x in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = 20_000) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; as ``toxicity_scores`` otherwise."""
    scorer = train(docs, labels, max_labelled)
    shared = docs.sparkSession.sparkContext.broadcast((scorer.weights, scorer.base, scorer.model))

    @tidy("toxicity")
    def clean(batches):
        s = Scorer(*shared.value)
        for b in slices(batches):
            yield b.filter(pa.array([s.score(t) < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
