"""Quality classifier by co-training of two views.

One classifier sees a document's text only, the other its page metadata only
(language, source, stated size).  Over some rounds each labels all
unlabelled documents it is sure of for the other, if labelled documents it was not
fitted on bear it out; a view that does no better with what it is given stays as it
was.  The two, calibrated on those documents, are combined to score all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import slices, table

SHAPES, WORDS, ENDS, SOURCES, LANGS, SIZES = 96, 128, 64, 48, 16, 24
_HASHED = (SHAPES, WORDS, ENDS, ENDS)
TEXT_WIDTH, META_WIDTH = sum(_HASHED) + 8, LANGS + SOURCES + SIZES + 2
_SHAPE = ((re.compile(r"[^\W\d_a-zA-Z]"), "a"), (re.compile(r"[a-z]+"), "a"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1"))


def token_shape(token: str) -> str:
    """Letters, capitals, digits and marks, with runs drawn together."""
    core, end = (token[:-1], token[-1]) if token[-1] in ".,;:!?" else (token, "")
    if core.isascii() and core.isalpha():  # the usual words, without patterns
        if core.islower():
            return "a" + end
        if core[0].isupper() and core[1:].islower():
            return "Aa" + end
    for pattern, mark in _SHAPE:
        token = pattern.sub(mark, token)
    return token


_STARTS = np.cumsum([0, *_HASHED]).tolist()


def token_buckets(token: str) -> list[int]:
    """Buckets of a token: of its shape, of the lower-cased word, and of its first and last three characters."""
    low = token.lower()
    return [at + zlib.crc32(x.encode("utf-8", "surrogatepass")) % n for at, n, x in zip(_STARTS, _HASHED, (token_shape(token)[:12], low, low[:3], low[-3:]))]


class _Tokens(dict):
    """Numbers tokens as they come; ``buckets`` has those of the newest."""

    def __init__(self):
        super().__init__()
        self.buckets: list[list[int]] = []

    def __missing__(self, token: str) -> int:
        self[token] = at = len(self)
        self.buckets.append(token_buckets(token))
        return at


@dataclass
class Views:
    """Turns documents into their two feature vectors; keeps a bounded cache of tokens' buckets."""

    cache: _Tokens = field(default_factory=_Tokens)
    known: np.ndarray = field(default_factory=lambda: np.zeros((1024, len(_HASHED)), np.int64))  # by number, with room for more
    n_known: int = 0

    def text(self, text: str | None) -> np.ndarray:
        """Content: shapes, words, beginnings and ends of tokens (as shares), variety, repetition, lengths, layout of lines."""
        out = np.zeros(TEXT_WIDTH, np.float32)
        tokens = text.split() if text else []
        if tokens:
            ids = np.fromiter(map(self.cache.__getitem__, tokens), np.int64, len(tokens))
            if self.cache.buckets:
                more = self.n_known + len(self.cache.buckets)
                if more > len(self.known):
                    self.known = np.concatenate((self.known[: self.n_known], np.zeros((2 * more, len(_HASHED)), np.int64)))
                self.known[self.n_known : more] = self.cache.buckets
                self.n_known = more
                self.cache.buckets.clear()
            n = len(tokens)
            used, times = np.unique(ids, return_counts=True)
            for column in self.known[used].T:
                out[: TEXT_WIDTH - 8] += np.bincount(column, times, TEXT_WIDTH - 8).astype(np.float32)
            out[: TEXT_WIDTH - 8] /= n
            distinct = set(tokens)
            again = int((ids[1:] == ids[:-1]).sum())
            letters = sum(map(len, tokens))
            lines = text.count("\n") + 1
            layout = (math.log1p(lines) / 3, math.log1p(len(text) / lines) / 5)
            out[TEXT_WIDTH - 8 :] = (len(distinct) / n, again / n, min(letters / n, 50) / 10, math.log1p(n) / 5, max(map(len, distinct)) > 40, len(distinct) / math.sqrt(n) / 10, *layout)
            if len(self.cache) > 300_000:
                self.cache, self.n_known = _Tokens(), 0
        return out

    @staticmethod
    def meta(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
        """Page metadata: language, source, stated size; nothing of the text itself."""
        out = np.zeros(META_WIDTH, np.float32)
        out[zlib.crc32((lang or "").encode("utf-8", "surrogatepass")) % LANGS] = 1
        out[LANGS + zlib.crc32((source or "").encode("utf-8", "surrogatepass")) % SOURCES] = 1
        size = max(n_chars or 0, 0)
        out[LANGS + SOURCES + min(size.bit_length(), SIZES - 1)] = 1
        out[LANGS + SOURCES + SIZES :] = (math.log1p(size) / 5, n_chars is None)
        return out


@dataclass
class Logistic:
    """Logistic regression with a ridge penalty, by Newton steps that lower the penalised loss, or are halved."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    ridge: float = 1.0

    @staticmethod
    def at_zero(moments: np.ndarray, ridge: float = 1.0, prior: np.ndarray | float = 1.0) -> Logistic:
        """Nothing learned yet, features scaled by the moments of all rows, and again by ``prior``: what is large there counts less."""
        n = (len(moments) - 1) // 2
        mean = moments[1 : 1 + n] / moments[0]
        return Logistic(np.zeros(n + 1), mean, (np.sqrt(np.maximum(moments[1 + n :] / moments[0] - mean * mean, 0)) + 1e-3) * prior, ridge)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, prior: np.ndarray | float = 1.0) -> Logistic:
        out = Logistic.at_zero(_moments(x), ridge, prior)
        return out if fit_all({"": out}, lambda f: {"": f("", x, y)}) else out

    def sums(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """What rows add to the loss, its gradient and Hessian at these weights, as one vector."""
        z = np.concatenate(((x - self.mean) / self.scale, np.ones((len(x), 1))), axis=1)
        said = z @ self.weights
        p = 1 / (1 + np.exp(-np.clip(said, -500, 500)))
        loss = np.logaddexp(0, np.where(y > 0, -said, said)).sum()
        return np.concatenate(([loss], z.T @ (y - p), ((z * (p * (1 - p))[:, None]).T @ z).ravel()))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -20, 20) @ self.weights[:-1] + self.weights[-1]

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        """The mean loss of rows."""
        z = self.logit(x)
        return float(np.logaddexp(0, np.where(y > 0, -z, z)).mean())


def fit_all(models: dict[str, Logistic], gather: Callable[[Callable], dict[str, np.ndarray]], most: int = 40, near: float = 1e-3) -> bool:
    """Fits several models side by side; ``gather`` sums f(name, x, y) over each one's rows.  Whether all converged.

    A step that raises the penalised loss is taken back and halved, so a fit never ends worse than it began.
    """
    keep = {v: np.append(np.full(len(m.weights) - 1, m.ridge), 1e-3) for v, m in models.items()}
    best: dict[str, tuple] = {}  # weights, loss, step to try
    open_ = set(models)
    for _ in range(most):
        total = gather(lambda v, x, y: models[v].sums(x, y) if v in open_ else np.zeros(1))
        for v in sorted(open_):
            m, n = models[v], len(models[v].weights)
            loss = total[v][0] + 0.5 * keep[v] @ (m.weights * m.weights)
            if v in best and not loss <= best[v][1] + 1e-9 * abs(best[v][1]):
                w, before, step = best[v]
                best[v] = (w, before, step / 2)
                if np.abs(step).max() < near:
                    m.weights = w
                    open_.discard(v)
                else:
                    m.weights = w + step / 2
                continue
            gradient, hessian = total[v][1 : 1 + n] - keep[v] * m.weights, total[v][1 + n :].reshape(n, n) + np.diag(keep[v])
            step = np.linalg.solve(hessian, gradient)
            best[v] = (m.weights, loss, step)
            if np.abs(step).max() < near or gradient @ step < 1e-6 * max(1.0, loss):
                open_.discard(v)
            else:
                m.weights = m.weights + step
        if not open_:
            return True
    for v in open_:
        models[v].weights = best[v][0]
    return False


@dataclass
class CoTrained:
    text: Logistic
    meta: Logistic
    combined: Logistic
    exchanged: dict[str, int]

    def logit(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return self.combined.logit(_both(self.text, self.meta, text, meta))


def _both(text_model: Logistic, meta_model: Logistic, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
    return np.stack((np.clip(text_model.logit(text), -15, 15), np.clip(meta_model.logit(meta), -15, 15)), axis=1)


def _moments(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([len(x)], x.sum(axis=0), (x * x).sum(axis=0)))


def cutoffs(z: np.ndarray, y: np.ndarray, sure: float, least: int = 10) -> tuple[float, float]:
    """The logits up to which, and from which on, a view may label: its probability, calibrated on labelled rows that it was
    not fitted on, is at least ``sure``, and of those rows at least ``least`` lie there, with labels that bear it out: their
    share right is above the share of their label by half of what is missing to 1.  Else infinite: the view abstains."""
    model, far = Logistic.fit(np.clip(z, -15, 15)[:, None], y, ridge=0.1), math.log(sure / (1 - sure))
    slope = model.weights[0] / model.scale[0]
    if slope <= 0:
        return -math.inf, math.inf
    middle = model.mean[0] - model.weights[1] / slope
    low, high = min(middle - far / slope, -far), max(middle + far / slope, far)
    skilled = lambda rows, label: rows.sum() >= least and (y[rows] == label).mean() >= ((y == label).mean() + 1) / 2
    return low if skilled(z <= low, 0) else -math.inf, high if skilled(z >= high, 1) else math.inf


def newly_labelled(history: list[tuple], text: np.ndarray, meta: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By view, the pool rows that the other has labelled for it in the last round for the first time, and the labels.

    ``history`` has the models of each round, and the cutoffs of each view.
    """
    out = {}
    for v, other, x in (("text", "meta", meta), ("meta", "text", text)):
        done, now, label = np.zeros(len(x), bool), np.zeros(len(x), bool), np.zeros(len(x))
        for models, cut in history:
            z = models[other].logit(x)
            done |= now
            now = (z <= cut[other][0]) | (z >= cut[other][1])
            label = (z > 0).astype(np.float64)
        rows = np.flatnonzero(now & ~done)
        out[v] = (rows, label[rows])
    return out


class MemoryPool:
    """Unlabelled rows in memory, and the labels that views have been given."""

    def __init__(self, text: np.ndarray, meta: np.ndarray):
        self.x, self.given = {"text": text, "meta": meta}, {"text": [], "meta": []}

    def exchange(self, history: list[tuple]) -> dict[str, int]:
        """Adds what the last round labels; how many rows by view."""
        found = newly_labelled(history, self.x["text"], self.x["meta"])
        for v, (rows, y) in found.items():
            self.given[v].append((self.x[v][rows], y))
        return {v: len(y) for v, (_, y) in found.items()}

    def gather(self, f: Callable) -> dict[str, np.ndarray]:
        """By view, the sum of f(view, x, y) over the rows it was given."""
        return {v: sum((f(v, x, y) for x, y in given), f(v, self.x[v][:0], np.zeros(0))) for v, given in self.given.items()}


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool, rounds: int = 3, sure: float = 0.97) -> CoTrained | None:
    """Fit both views on labelled rows, then, round by round, also on all that the other, when ``sure``, labels in the pool.

    Every third labelled row only calibrates and combines.  A view takes a round's labels for good only if, fitted with
    them, it does not do worse on those rows; else it stays as it was.  None if the labels are all alike.
    """
    part = np.arange(len(y)) % 3 == 0
    if len(set(y[~part])) < 2 or len(set(y[part])) < 2:
        return None
    own, test = {"text": text[~part], "meta": meta[~part]}, {"text": text[part], "meta": meta[part]}
    models = {v: Logistic.fit(x, y[~part], prior=prior(v, x.shape[1])) for v, x in own.items()}
    history: list[tuple] = []
    exchanged = {"text": 0, "meta": 0}
    for _ in range(rounds):
        history.append((models, {v: cutoffs(models[v].logit(x), y[part], sure) for v, x in test.items()}))
        fresh = pool.exchange(history)
        if sum(fresh.values()) <= 0.001 * sum(exchanged.values()):
            break
        exchanged = {v: n + fresh[v] for v, n in exchanged.items()}
        moments = pool.gather(lambda v, x, y: _moments(x))
        tried = {v: Logistic.at_zero(moments[v] + _moments(own[v]), prior=prior(v, own[v].shape[1])) for v in own if exchanged[v]}
        y_own = y[~part]
        converged = fit_all(tried, lambda f: {v: s + f(v, own[v], y_own) for v, s in pool.gather(lambda v, x, y: f(v, x, y) if v in tried else np.zeros(1)).items() if v in tried})
        better = {v: m for v, m in tried.items() if converged and m.loss(test[v], y[part]) <= models[v].loss(test[v], y[part])}
        models = models | better
        if not better:
            break
    logits = _both(models["text"], models["meta"], test["text"], test["meta"])
    combined = Logistic.fit(logits, y[part], ridge=0.1)
    for i in np.flatnonzero(combined.weights[:-1] < 0):  # a view that points the wrong way is left out
        logits[:, i] = 0
        combined = Logistic.fit(logits, y[part], ridge=0.1)
        combined.weights[i] = 0
    return CoTrained(models["text"], models["meta"], combined, exchanged)


def prior(view: str, width: int) -> np.ndarray | float:
    """Single words, beginnings and ends count a fifth of shapes and layout until the labels say otherwise."""
    if view != "text" or width != TEXT_WIDTH:
        return 1.0
    out = np.ones(width)
    out[SHAPES : TEXT_WIDTH - 8] = 5.0
    return out


class TablePool:
    """A table of unlabelled rows (both views as bytes of 32-bit floats), and tables of the labels that views have been given."""

    def __init__(self, pool: DataFrame):
        self.pool, self.given = pool, []

    def exchange(self, history: list[tuple]) -> dict[str, int]:
        def run(batches):
            for b in slices(batches):
                raw = {v: b.column(f"{v}_view") for v in ("text", "meta")}
                views = [np.frombuffer(b"".join(c.to_pylist()), np.float32).reshape(b.num_rows, -1).astype(np.float64) for c in raw.values()]
                for v, (rows, y) in newly_labelled(history, *views).items():
                    yield pa.RecordBatch.from_arrays([pa.array([v] * len(rows), pa.string()), raw[v].take(pa.array(rows)), pa.array(y)], ["view", "x", "y"])

        fresh = table(self.pool.select("text_view", "meta_view").mapInArrow(run, "view string, x binary, y double"), "given")
        self.given.append(fresh)
        return {"text": 0, "meta": 0} | {r["view"]: r["count"] for r in fresh.groupBy("view").count().collect()}

    def gather(self, f: Callable) -> dict[str, np.ndarray]:
        """Sums in tasks, then in a few."""
        width = {"text": TEXT_WIDTH, "meta": META_WIDTH}

        def run(batches):
            total = {v: f(v, np.zeros((0, n)), np.zeros(0)) for v, n in width.items()}
            for b in slices(batches):
                views, y = np.array(b.column("view").to_pylist()), b.column("y").to_numpy()
                for v, n in width.items():
                    at = np.flatnonzero(views == v)
                    if len(at):
                        x = np.frombuffer(b"".join(b.column("x").take(pa.array(at)).to_pylist()), np.float32).reshape(-1, n).astype(np.float64)
                        total[v] = total[v] + f(v, x, y[at])
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["view", "sums"])

        def add(batches):
            total: dict[str, np.ndarray] = {}
            for b in batches:
                for v, t in zip(b.column("view").to_pylist(), b.column("sums").to_pylist()):
                    total[v] = total.get(v, 0) + np.frombuffer(t, np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["view", "sums"])

        rows = reduce(DataFrame.unionAll, self.given).mapInArrow(run, "view string, sums binary")
        out = {v: f(v, np.zeros((0, n)), np.zeros(0)) for v, n in width.items()}
        for r in rows.repartition(8).mapInArrow(add, "view string, sums binary").collect():
            out[r["view"]] = out[r["view"]] + np.frombuffer(r["sums"], np.float64)
        return out


def _vectors(docs: DataFrame, extra: list[str]) -> DataFrame:
    """The two feature vectors of each row as bytes of 32-bit floats, with the columns ``extra``."""

    def run(batches):
        v = Views()
        for b in slices(batches, 200):
            raw = [b.column(c).to_pylist() for c in ("lang", "source", "n_chars")]
            texts = [v.text(t).tobytes() for t in b.column("text").to_pylist()]
            columns = [*(b.column(c) for c in extra), pa.array(texts, pa.binary()), pa.array([v.meta(*r).tobytes() for r in zip(*raw)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*extra, "text_view", "meta_view"])

    types = dict(docs.dtypes)
    return docs.mapInArrow(run, "".join(f"{c} {types[c]}, " for c in extra) + "text_view binary, meta_view binary")


def train(docs: DataFrame, labels: DataFrame, views: DataFrame, max_labelled: int = 8_000, rounds: int = 3) -> tuple[CoTrained | None, float]:
    """The classifier and the share of good documents among the labelled; ``views`` has the views of all documents.

    At most ``max_labelled`` labelled documents are used, those of the smallest hashes of doc_id, and all unlabelled
    ones; of several rows with one labelled id, the least (text first) is used.  Ids whose crc32 (as text) leaves 2 modulo 4 stay out, so that they can test the result.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    test = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where(~test).orderBy(*order).limit(max_labelled)
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("quality", "text", "lang", "source", "n_chars")).alias("r")).select("doc_id", "r.*")
    found = _vectors(rows, ["doc_id", "quality"]).collect()  # max_labelled rows at most
    found.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    y = np.array([r["quality"] for r in found], np.float64)
    if not len(y):
        return None, 1.0
    text, meta = (np.frombuffer(b"".join(r[c] for r in found), np.float32).reshape(len(found), -1).astype(np.float64) for c in ("text_view", "meta_view"))
    held = F.coalesce(test, F.lit(False))  # a null id is unlabelled
    pool = views.where(~held).join(known.select("doc_id"), "doc_id", "left_anti")
    return co_train(text, meta, y, TablePool(pool), rounds), float(y.mean())


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **bounds: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source, n_chars): doc_id, held_out, text_score,
    meta_score, score (probability of good quality), keep (score >= threshold).

    Nulls count as empty, unknown or zero.  Ids may be null or repeated; labels that are null, or not 0 or 1,
    are ignored, and of several for one id the smallest counts.  Without labels of both kinds every score is
    the share of good documents among the labelled (1 if there are none).  Other columns are ignored.
    """
    wanted = {"doc_id": "long", "text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    docs = docs.select(*(F.col(c).cast(t).alias(c) for c, t in wanted.items()))
    views = table(_vectors(docs, ["doc_id"]), "views")
    model, share = train(docs, labels, views, **bounds)
    shared = docs.sparkSession.sparkContext.broadcast((model, share))

    def score(batches):
        model, share = shared.value
        for b in slices(batches, 1000):
            z = np.zeros((3, b.num_rows)) + math.log((share + 1e-6) / (1 - share + 1e-6))
            if model is not None and b.num_rows:
                text, meta = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.float32).reshape(b.num_rows, -1).astype(np.float64) for c in ("text_view", "meta_view"))
                z = np.stack((model.text.logit(text), model.meta.logit(meta), model.logit(text, meta)))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            columns = [b.column("doc_id"), b.column("held_out"), *(pa.array(x) for x in p), pa.array(p[2] >= threshold)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "text_score", "meta_score", "score", "keep"])

    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return views.withColumn("held_out", held).mapInArrow(score, "doc_id long, held_out boolean, text_score double, meta_score double, score double, keep boolean")
