import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from notewright.llm import chat_format, components, decontaminate, jaccard, knn, line_dedup, lm_score, pack, quality, queries, token_count, toxicity
from notewright.llm.common import ascii_words, shingle_sets
from tests.conftest import DATA, rows_of

BYTE_BPE, WORD_BPE = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("word_bpe_49k.json")
CLASH = "_id long, _md5 string, rest string, root long, fp string, batch int, score double, n_words long, ids string, lost int"


def documents(spark, rows):
    """(doc_id, text) rows with columns whose names the operators use inside."""
    more = (1, "m", "r", 2, "f", 3, 0.5, 4, "i", 5)
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *more) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


ODD = [
    (1, None),
    (2, ""),
    (3, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while."),
    (4, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while."),
    (4, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while."),
    (None, "The quick brown fox jumps over the lazy dog, and then it sleeps for a long while."),
    (None, "one line that is long enough to count\nshort\n  ONE line that is long enough to count \n"),
    (7, "one line that is long enough to count\n\n"),
    (8, "One Line that is long enough to count"),
    (9, "word " * 50_000),
    (10, "<|endoftext|> é ü ß 漢字 🎉 \x00 \u0085 \x1c it's 12,5\r\n"),
    (11, "!!! ... ???"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{DATA}/documents.parquet").select(["doc_id", "text"]).to_pylist()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, DATA).toPandas(), duck.execute(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


# 1


def test_top_k_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [1.0, None]), (5, [inf, 0.0]), (6, [nan, 0.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, []), (2, [0.5, 0.5])]
    v = knn.quantize(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)))
    got = knn.top_k(v, v.where("vec_id = 0"), k=2, shard_rows=2, block_queries=1).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 256 * 128), (0, 2, 2, 256 * 128)]
    assert knn.top_k(v.limit(0), v, k=2).count() == 0
    assert [r["vec_id"] for r in knn.top_k(v, v.where("vec_id = 0"), k=9).collect()] == [1, 2, 2]


def test_top_k_of_large_numbers_and_repeated_ids(spark, duck):
    rng = random.Random(4)
    rows = [(i % 90, [rng.choice([1.0, 1e7, 3e7, -2e9, 1e6]) * rng.random() for _ in range(3)]) for i in range(200)] + [(0, [1.0, 2.0, 3.0])] * 2
    rows += [(200, [1e7, 0.0, 0.0]), (201, [3e7, 1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = knn.quantize(frame)
    assert v.count() == len(rows)
    got = knn.top_k(v, v.where("vec_id % 50 = 0"), k=5, shard_rows=30, block_queries=3).toPandas()
    own = duck.cursor()
    embeddings = frame.toPandas()
    embeddings["embedding"] = embeddings["embedding"].map(list)
    own.register("large", embeddings)
    want = own.execute(knn.ORACLE.replace("FROM embeddings", "FROM large")).df()
    assert rows_of(got) == rows_of(want) and len(got) > 5 * 5
    huge = knn.quantize(spark.createDataFrame([(0, [2.0**54, 2.0**54]), (1, [2.0**54, 0.0]), (2, [-(2.0**54), 0.0])], "vec_id long, embedding array<double>"))
    assert [(r["vec_id"], r["score"]) for r in knn.top_k(huge, huge.where("vec_id = 0")).orderBy("rank").collect()] == [(1, 2**63 - 1), (2, -(2**63))]


def test_top_k_takes_every_finite_number(spark):
    """The largest floats, doubles of 2**60 and 1e300, beside zeros: their products are exact."""
    big = 3.4e38
    rows = [(0, [0.0, 5.0]), (1, [big, 1.0]), (2, [-big, 2.0]), (3, [2.0**60, 3.0]), (4, [0.0, 0.5]), (5, [1e300, 0.25]), (6, [0.0, -1e300])]
    v = knn.quantize(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = knn.top_k(v, v.where("vec_id = 0"), k=9, shard_rows=2).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(3, 5 * 3 << 16), (2, 5 * 2 << 16), (1, 5 << 16), (4, 5 * 2**15), (5, 5 * 2**14), (6, -(2**63))]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 400), st.integers(1, 6), st.integers(0, 10**6))
def test_tree_search_is_exact(n, dim, seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(-3, 4, (n, dim)).astype(float)
    ids = rng.permutation(n)
    tree, q = knn.KdTree(ids, v, leaf=8), rng.integers(-3, 4, dim).astype(float)
    want = sorted(((int(s), -int(i)) for s, i in zip(v @ q, ids) if i != 0), reverse=True)[:5]
    bounds = tree.bounds(q[None])[0]
    assert sorted(tree.search(0, q, bounds, 5, None), reverse=True) == want
    if len(want) == 5:
        assert sorted(tree.search(0, q, bounds, 5, want[2]), reverse=True) == want[:2]


# 2 and 5


def test_token_counts(spark, odd, empty, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTE_BPE)
    got = token_count.token_counts(odd, BYTE_BPE).collect()
    assert sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == sorted((len((x or "").encode()), n := len(t.encode(x or "").ids), n > 1024) for _, x in ODD)
    assert token_count.token_counts(empty, BYTE_BPE).count() == 0
    counter, rng = token_count.BpeCounter(BYTE_BPE), random.Random(5)
    pieces = [*"ab  \n\t'sdt1²é\u0085 \x1c,.", "<|endoftext|>", "'s", "hello", " the"]
    own = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(2000)] + [r["text"] for r in texts]
    assert [counter.count(x) for x in own] == [len(e.ids) for e in t.encode_batch(own, add_special_tokens=False)]


def test_packing(spark, odd, empty, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_BPE)
    rows = pack.pack_documents(odd, WORD_BPE, capacity=64).collect()
    by_doc: dict = {}
    for _, x in ODD:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 64)):
            by_doc.setdefault((p, at, len(ids[at : at + 64]), zlib.crc32(np.array(ids[at : at + 64], "<u4").tobytes())), []).append(1)
    assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == Counter({k: len(v) for k, v in by_doc.items()})
    used: dict = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in used.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 64
    assert pack.pack_documents(empty, WORD_BPE).count() == 0
    e, rng = pack.ChunkEncoder(WORD_BPE, chunks=50, words=50), random.Random(6)
    pieces = [*"ab  \n\t'sdt1²é\u0085 \x1c,.İΣ", "<|endoftext|>", "'s", "Hello", " the", "Ǻ", "é"]
    own = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(2000)] + [r["text"] for r in texts]
    assert e.encode(own) == [np.array(x.ids, "<u4").tobytes() for x in t.encode_batch(own, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 5), max_size=8))
def test_plan_is_a_packing(counts):
    at = pack.plan(counts, 20)
    n = int(at["sequences"])
    assert n >= -(-sum(w * c for w, c in counts.items()) // 20)
    spans: dict = {}
    for w, c in counts.items():
        mine = [i for i in range(len(at["length"])) if at["length"][i] == w]
        for rank in range(c):
            i = max(i for i in mine if at["first"][i] <= rank)
            spans.setdefault(int(at["sequence"][i] + rank - at["first"][i]), []).append((int(at["offset"][i]), w))
    assert len(spans) == n
    for placed in spans.values():
        end = 0
        for offset, w in sorted(placed):
            assert offset == end
            end += w
        assert end <= 20


def best_packing(items, capacity):
    """The fewest bins, by trying all."""
    best = [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0] and i < len(items):
            return
        if i == len(items):
            best[0] = min(best[0], len(rooms))
            return
        for j in range(len(rooms)):
            if rooms[j] >= items[i] and rooms[j] not in rooms[:j]:
                place(i + 1, [*rooms[:j], rooms[j] - items[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=8))
def test_dominance_keeps_the_optimum(items):
    fixed, left = pack.reduce_by_dominance(Counter(items), 20)
    rest = sorted((w for w, n in left.items() for _ in range(n)), reverse=True)
    assert sum(n for _, n in fixed) + best_packing(rest, 20) == best_packing(sorted(items, reverse=True), 20)


# 3


def brute_hits(text, items, window=10):
    words = ascii_words(text)
    hit, found = set(), set()
    for item, t in items:
        own = ascii_words(t)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            p = own[i : i + window]
            for s in range(len(words) - len(p) + 1):
                if words[s : s + len(p)] == p:
                    hit |= set(range(s, s + len(p)))
                    found.add(item)
    ids = ",".join(sorted(map(str, found - {None})))
    return len(words), len(hit), len(found - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("max_windows", [200_000, 3])
def test_contamination(spark, odd, empty, max_windows):
    items = [(10, "the QUICK brown fox jumps over the lazy dog and then"), (2, "a long, while"), (None, "sleeps for"), (2, "word"), (5, None), (6, ""), (7, "never seen before here")]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, hits int")
    got = decontaminate.contamination(odd, bench, max_windows=max_windows).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *brute_hits(t, items))) for i, t in ODD)
    clean = decontaminate.remove_contaminated(odd, bench, max_windows=max_windows)
    assert clean.columns == odd.columns and clean.count() == sum(not brute_hits(t, items)[-1] for _, t in ODD)
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(odd, bench.limit(0)).where("contaminated").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 4), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), st.integers(0, 10**6))
def test_wu_manber(m, words, seed):
    rng = random.Random(seed)
    patterns = list({tuple(rng.choices([b"a", b"b", b"c"], k=m)) for _ in range(4)})
    want = [(i, tuple(words[i : i + m])) for i in range(len(words) - m + 1) if tuple(words[i : i + m]) in patterns]
    assert sorted(decontaminate.WuManber(m, patterns).scan(words)) == want


# 4


def brute_classes(rows, threshold=0.8):
    sets = [set(s.tolist()) for s in shingle_sets([t for _, t in rows])]
    link = [[i != j and bool(a) and len(a & b) >= threshold * len(a | b) - 1e-12 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min([root[i], *(root[j] for j in range(len(rows)) if link[i][j])]) for i in range(len(rows))]
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in set(root)}
    return [(rows[i][0], least[root[i]], sum(link[i])) for i in range(len(rows))]


def test_near_duplicates(spark, odd, empty):
    rng = random.Random(1)
    base = [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randint(0, 99)) for _ in range(120)]
    near = [(100 + i, " ".join([*base[:i], "changed", *base[i + 1 :]])) for i in range(0, 60, 2)]
    rows = ODD[:11] + near + [(300, "Two words"), (301, "two WORDS")]
    for bounds in ({}, {"block_rows": 7}):
        got = jaccard.near_duplicates(documents(spark, rows), **bounds).select("doc_id", "class_id", "n_links").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_classes(rows)))
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.one_of_each(documents(spark, rows))
    assert kept.columns == odd.columns
    # 4 and a null copy 3; 8 has the words of 7; 1 and 2 have none
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, i) for i in (1, 2, 3, 7, 9, 10, 100, 300)] + [(True, 0)]


@pytest.mark.parametrize("block_shingles", [40, 10])
def test_links_count_once_beside_empty_parts(spark, block_shingles):
    """Blocks smaller than one text leave parts empty; a link inside the other part is not counted again."""
    base = [f"word{i}" for i in range(120)]
    rows = [(i, " ".join([*base, *(f"end{i}x{j}" for j in range(3))])) for i in range(3)] + [(9, "something else altogether in a text alone")]
    got = jaccard.near_duplicates(documents(spark, rows), block_shingles=block_shingles).select("doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got)) == sorted(brute_classes(rows)) == [(0, 0, 2), (1, 0, 2), (2, 0, 2), (9, 9, 0)]


def test_banding_reaches_recall():
    bands, rows = jaccard.banding(0.8, 0.9995, 160)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995 and bands * rows <= 160


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# 6 and 7


def test_quality(spark, odd, empty, labels):
    got = quality.quality_scores(odd, labels)
    assert got.count() == len(ODD) and got.where("score between 0 and 1").count() == len(ODD)
    assert quality.quality_scores(empty, labels).count() == 0
    assert quality.quality_scores(odd, labels.limit(0)).where("keep").count() == len(ODD)


def _auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    return (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_quality_is_no_worse_for_the_exchange(spark, sf):
    """Held-out accuracy and ranking with the exchange are at least those without it."""
    docs, known = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    right, ranked = {}, {}
    for rounds in (0, 3):
        rows = quality.quality_scores(docs, known, rounds=rounds).join(known, "doc_id").where("held_out").toPandas()
        y, score = rows["quality"].to_numpy(), rows["score"].to_numpy()
        right[rounds], ranked[rounds] = ((score >= 0.5) == (y == 1)).mean(), _auc(score, y)
    assert right[3] >= max(right[0], 0.97) and ranked[3] >= max(ranked[0] - 1e-4, 0.99), (right, ranked)


def test_co_training_exchanges_labels():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 900).astype(float)
    text, meta = (np.stack((y * 6 - 3 + rng.normal(size=900), rng.normal(size=900)), axis=1) for _ in range(2))
    model = quality.co_train(text[:150], meta[:150], y[:150], quality.MemoryPool(text[150:], meta[150:]))
    assert min(model.exchanged.values()) > 100 and ((model.logit(text, meta) > 0) == (y == 1)).mean() > 0.98


def test_a_view_without_skill_abstains():
    """Metadata that says nothing labels nothing, though one label is frequent; and it doesn't spoil the sum."""
    rng = np.random.default_rng(2)
    y = (rng.random(2000) < 0.9).astype(float)
    text, meta = np.stack((y * 6 - 3 + rng.normal(size=2000), rng.normal(size=2000)), axis=1), rng.normal(size=(2000, 3))
    model = quality.co_train(text[:400], meta[:400], y[:400], quality.MemoryPool(text[400:], meta[400:]))
    assert model.exchanged["text"] == 0 < model.exchanged["meta"] and ((model.logit(text, meta) > 0) == (y == 1)).mean() > 0.97


def test_fits_converge_from_separable_rows():
    """No step raises the loss; the gradient is small at the end, also where rows can be told apart wholly."""
    rng = np.random.default_rng(3)
    for y in ((rng.random(300) < 0.02).astype(float), np.repeat([0.0, 1.0], 150)):
        x = np.concatenate((y[:, None] * 50 + rng.normal(size=(300, 1)), rng.normal(size=(300, 5))), axis=1)
        m = quality.Logistic.fit(x, y)
        g = m.sums(x, y)[1:8] - np.append(np.full(6, m.ridge), 1e-3) * m.weights
        assert np.abs(g).max() < 0.05


def test_exchange_by_plain_loops():
    """Labels go to the view that is not sure, from the round in which the other is sure first."""
    one = quality.Logistic(np.array([1.0, 0.0]), np.zeros(1), np.ones(1))
    history = [({"text": one, "meta": one}, {"text": (-2.0, 2.0), "meta": (-np.inf, 3.0)}), ({"text": one, "meta": one}, {"text": (-1.0, 1.0), "meta": (-3.0, 3.0)})]
    text, meta = np.array([[-3.0], [-1.5], [0.0], [1.2], [5.0]]), np.array([[0.0], [-3.5], [4.0], [2.0], [-1.0]])
    for rounds in (1, 2):
        want = {}
        for v, other, x in (("text", "meta", meta), ("meta", "text", text)):
            sure = [[i for i, (z,) in enumerate(x) if z <= cut[other][0] or z >= cut[other][1]] for _, cut in history[:rounds]]
            want[v] = [(i, float(x[i, 0] > 0)) for i in sure[-1] if not any(i in s for s in sure[:-1])]
        got = quality.newly_labelled(history[:rounds], text, meta)
        assert {v: list(zip(rows.tolist(), y.tolist())) for v, (rows, y) in got.items()} == want


def test_co_training_uses_the_whole_pool(spark):
    """More documents than 400 a class and round can be exchanged, and Spark's sums are those of one block."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 9000).astype(float)
    views = [np.zeros((9000, n), np.float32) for n in (quality.TEXT_WIDTH, quality.META_WIDTH)]
    for x in views:
        x[:, 0], x[:, 1] = y * 8 - 4 + rng.normal(size=9000), rng.normal(size=9000)
    rows = [(i, bytearray(views[0][i].tobytes()), bytearray(views[1][i].tobytes())) for i in range(200, 9000)]
    pool = spark.createDataFrame(rows, "doc_id long, text_view binary, meta_view binary").repartition(5)
    text, meta = (x.astype(float) for x in views)
    one = quality.co_train(text[:200], meta[:200], y[:200], quality.MemoryPool(text[200:], meta[200:]))
    many = quality.co_train(text[:200], meta[:200], y[:200], quality.TablePool(pool))
    assert one.exchanged == many.exchanged and sum(one.exchanged.values()) > 8 * 4 * 400
    assert np.allclose(one.text.weights, many.text.weights, atol=1e-3) and np.allclose(one.meta.weights, many.meta.weights, atol=1e-3)


@pytest.mark.parametrize("token", ["5tu", "1d1", "a.b", "aab", "s t", "$$a", "6o|", "x-y z", "*ll", "b", "aaa1"])
def test_viterbi_against_all_readings(token):
    """No reading of the lattice has a higher probability than the one decoded."""
    rng = np.random.default_rng(7)
    model = toxicity.CharModel(rng.integers(0, 50, 1 << toxicity.LM_BITS), rng.integers(50, 99, 1 << toxicity.LM_BITS), {})

    def score(text):
        s, a, b = 0.0, toxicity.BEGIN, toxicity.BEGIN
        for c in [*map(ord, text), toxicity.END]:
            s, a, b = s + model.log_prob(a, b, c), b, c
        return s

    best = {}
    for ways in itertools.product(*toxicity.lattice(token)):
        text = "".join(t for t, _ in ways)
        best[text] = max(best.get(text, -1e9), score(text) + sum(w for _, w in ways))
    assert best[toxicity.restore(token, model)] >= max(best.values()) - 1e-9


def test_outline():
    assert toxicity.outline("s. 5t upp 1 d") == b"stupid" and toxicity.outline("") == b"" and toxicity.outline("wo€l") == b"woei" and toxicity.outline(" .-") == b""


def test_workers_keep_nothing_of_other_operators(spark):
    """A tokenizer's caches stay for tasks of its own operator only."""
    path = queries.tokenizer_path("word_bpe_49k.json")

    def run(batches):
        from notewright.llm.common import tidy

        list(batches)
        own = [pack.encoder(path) is pack.encoder(path)]
        list(tidy("pack")(list)([]))
        one = pack.encoder(path)
        list(tidy("other")(lambda b: iter(b))([]))
        yield pa.RecordBatch.from_pydict({"same": own, "kept": [pack.encoder(path) is one]})

    assert [tuple(r) for r in spark.range(1).coalesce(1).mapInArrow(run, "same boolean, kept boolean").collect()] == [(True, False)]


def test_only_what_may_be_a_known_word_is_decoded(monkeypatch):
    """Nothing plain is decoded, and what is not decoded has no reading with a feature."""
    rng = np.random.default_rng(4)
    model = toxicity.CharModel(rng.integers(0, 50, 1 << toxicity.LM_BITS), rng.integers(50, 99, 1 << toxicity.LM_BITS), {"stupid": 9, "loser": 9})
    scorer = toxicity.Scorer({"=stupid": 4.0, "stupi": 3.0, "loser": 3.0, "=bad": 2.0}, -3.0, model)
    letters, disguises = "stupidloserba", "5$7|013@.-* é"
    tokens = ["".join(rng.choice(list(letters + disguises)) for _ in range(rng.integers(1, 9))).strip() for _ in range(400)]
    tokens += ["5tupid", "s.t.u.p.1.d", "stuuupid", "l0oser!", "b@d", "b-a-d!"]
    got = [scorer.token(t) for t in tokens]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity.Scorer, "may_hit", lambda self, token: True)
        assert got == [scorer.token(t) for t in tokens] and any(got)
    monkeypatch.setattr(toxicity, "readings", None)  # a call would fail
    assert scorer.features("Hello, little apple! It's all good: 1,300 (or more) well-known books|letters...") == set()


def test_toxicity(spark, odd, empty, labels):
    got = toxicity.toxicity_scores(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert toxicity.toxicity_scores(odd, labels.limit(0)).where("predicted = 1").count() == 0
    docs, known = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.train(docs, known)
    for bad in ("an 1d10t said", "m o r o n", "stuuupid", "$tup1d", "p4thetic!!", "w-o-r-t-h-l-e-s-s", "L.0.S.3.R", "st upid", "so stu pid, he", "s tup id", "you 5t up1d thing", "s. t. u. p. i. d.", "wor th 1ess"):
        assert scorer.score(bad) >= 0.3, bad
    for good in ("The mail is abc12@x.com", "key 4f9a-77b1 of 2012", "", None, "a b c", "must upidate", "a mor onion", "his tupid"):
        assert scorer.score(good) < 0.3, good
    tested = toxicity.toxicity_scores(docs, known).join(known, "doc_id").where("held_out")
    wrong = tested.where("predicted <> toxic").count()
    assert wrong / tested.count() < 0.03
    clean = toxicity.remove_toxic(odd, known)
    assert clean.columns == odd.columns and clean.count() == len(ODD)


def test_doubled_letters_and_final_symbols_are_restored(spark):
    scorer = toxicity.train(*(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")))
    for bad in ("stuupid", "iddiot", "worthles$", "worthle$$", "idio+", '"idio+",', "worthles$!", "stuupid!"):
        assert scorer.score(f"you are {bad} today") >= 0.3, bad
    for good in ("a good letter will follow", "cool!", "hello $", "it costs 5$ + tax", "summer+"):
        assert scorer.score(good) < 0.3, good


# 8


def test_lm_scores(spark, odd, empty):
    got = lm_score.lm_scores(odd, odd.where("doc_id is null or doc_id <> 3")).collect()
    split = lambda t: re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]
    counts = Counter(w for i, t in ODD if i != 3 for w in split(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter((i, len(split(t)), sum(counts[w] > 0 for w in split(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(t)), 6)) for i, t in ODD)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert lm_score.lm_scores(empty, odd).count() == 0
    assert lm_score.lm_scores(odd, empty).count() == len(ODD)


class BruteMixing:
    """The model by plain loops: dictionaries by (table, context, path so far), no slots, a bit at a time.

    Of the operator it takes the words' and bytes' paths, the list of tree words, and the state of a pair of counts.
    """

    def __init__(self, rows, words, model):
        self.words, self.code = words, model.code
        self.counts: dict = {}
        for t in rows:
            for steps in self.streams(t):
                for bits, _, contexts in steps:
                    for i, bit in enumerate(bits):
                        for c in contexts:
                            self.counts.setdefault((c, bits[:i]), [0, 0])[bit] += 1
        self.cells: tuple[dict, dict] = ({}, {})
        for t in rows:
            for cells, steps in zip(self.cells, self.streams(t)):
                for bit, depth, level, held in (x for step in steps for x in self.bits(step)):
                    cell = (depth, level >> 2, tuple(self.state(c, bit) for c in held))
                    cells.setdefault(cell, [0, 0])[bit] += 1

    def path(self, symbol):
        at = int(self.code.start[symbol])
        nodes = [int(x) for x in self.code.node[at : at + int(self.code.length[symbol])]]
        return tuple(x >> 32 & 1 for x in nodes), [x >> 35 for x in nodes]

    def streams(self, text):
        """The word symbols and the spelled bytes, each as (bits, levels of the trees' odds, contexts)."""
        split = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) + [""]
        before, out, spelled = ("begin", None), [], []
        ends = lambda w: None if w == "?" else w[-2:] if isinstance(w, bytes) else w
        for w in (x.encode() for x in split):
            known = w in self.words
            bits, levels = self.path(self.words[w] if known else self.code.escape)
            out.append((bits, levels, [(0, before[0]), (1, before), (2, ends(before[0]), ends(before[1]))]))
            before = (w if known else "?", before[0])
            for i, x in enumerate(w + b" " if not known else b""):
                bits, levels = self.path(self.code.escape + 1 + x)
                spelled.append((bits, levels, [(3, w[max(0, i - 3) : i]), (4, w[max(0, i - 5) : i]), (5, w[:i])]))
        return out, spelled

    def bits(self, step):
        bits, levels, contexts = step
        for i, (bit, level) in enumerate(zip(bits, levels)):
            held = [self.counts.get((c, bits[:i]), (0, 0)) for c in contexts]
            yield bit, min(i, 2), level, held

    @staticmethod
    def state(counts, without=None):
        zeros, ones = counts
        if max(zeros, ones) > 255:
            zeros, ones = (math.ceil(n * 255 / max(counts)) for n in counts)
        elif without is not None and counts[without] and max(counts) < 255:
            zeros, ones = zeros - (without == 0), ones - (without == 1)
        return int(lm_score.STATE[ones << 8 | zeros])

    @staticmethod
    def kind(state):
        """Never met; one side, once or twice; one side, more often; both sides."""
        return 0 if state == 0 else 3 if state > 12 else 1 if state in (1, 2, 7, 8) else 2

    def nats(self, text, model, rate, calm):
        total = 0.0
        for stream, steps in zip((model.words, model.spelled), self.streams(text)):
            held: dict = {}
            for block in {int(lm_score.block_of(np.array([i]))[0]): 0 for i in range(len(steps))}:
                moved: dict = {}
                for i, step in enumerate(steps):
                    if int(lm_score.block_of(np.array([i]))[0]) != block:
                        continue
                    for bit, depth, level, found in self.bits(step):
                        states = [self.state(c) for c in found]
                        gate = depth * 64 + sum(self.kind(s) * 4 ** (2 - j) for j, s in enumerate(states))
                        x = np.array([level / 16 - 2, *(stream.odds[j][s] for j, s in enumerate(states))])
                        w, _ = held.setdefault(gate, [stream.weights[gate].copy(), 0])
                        p = 1 / (1 + math.exp(-float(w @ x)))
                        total -= math.log(p if bit else 1 - p)
                        m = moved.setdefault(gate, [np.zeros(len(x)), 0])
                        m[0], m[1] = m[0] + (bit - p) * x, m[1] + 1
                for gate, (pull, n) in moved.items():
                    held[gate][1] += n
                    held[gate][0] = held[gate][0] + rate / (calm + held[gate][1]) * pull
        return total


def test_lm_by_brute_force(spark, monkeypatch):
    """Counts, cells and scores of Spark's model against plain loops, on tables large enough for no two nodes to meet."""
    monkeypatch.setattr(lm_score, "slot_bits", lambda n, most=30: 24)
    rng = random.Random(8)
    nouns = ["cat", "dog", "Tree", "house", "rivière", "x1"]
    rows = [" ".join(rng.choice(nouns) + rng.choice(["", "", "", "s", "ing", str(rng.randint(0, 50))]) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    known = lm_score.train(docs.select("doc_id", "text", (F.col("doc_id") < 20).alias("trains"), F.lit(True).alias("scored")))
    count = Counter(w for t in rows[:20] for w in [x.encode() for x in t.lower().split()] + [b""])
    assert known.total == sum(count.values()) and known.distinct == len(count)
    order = sorted((w for w, n in count.items() if n > 1), key=lambda w: (-count[w], w))
    brute = BruteMixing(rows[:20], {w: i for i, w in enumerate(order)}, known.model)
    for stream, cells in zip((known.model.words, known.model.spelled), brute.cells):
        counted = np.zeros((3, lm_score.LEVELS, *[lm_score.STATES] * 3, 2), np.int64)
        for (depth, level, states), n in cells.items():
            counted[(depth, level, *states)] = n
        own = lm_score.Stream(stream.first_symbol, stream.layout, [])
        lm_score.fit(counted.ravel(), own)
        assert np.allclose(own.odds, stream.odds, atol=1e-5) and np.allclose(own.weights, stream.weights, atol=1e-4)
    got = {r["doc_id"]: r["score"] for r in lm_score.lm_scores(docs, F.col("doc_id") < 20).collect()}
    for i in [0, 1, 2, *range(20, 40)]:
        want = -brute.nats(rows[i], known.model, 4.0, 60.0) / math.log(10)
        assert abs(got[i] - want) < 1e-3 * max(1, abs(want)), i


def test_lm_fit_is_the_optimum():
    rng = np.random.default_rng(2)
    counted = np.zeros((3, lm_score.LEVELS, *[lm_score.STATES] * 3, 2), np.int64)
    for _ in range(3000):
        at = (rng.integers(3), rng.integers(lm_score.LEVELS), *rng.integers(0, 4, 3))
        counted[at] += rng.integers(0, 5, 2)
    stream = lm_score.Stream(0, lm_score.Layout(12, 10), [])
    lm_score.fit(counted.ravel(), stream)
    cells = np.argwhere(counted.any(axis=-1))
    for g in range(lm_score.GATES):
        pull = -lm_score.RIDGE * (stream.weights[g] - [1, 0, 0, 0])
        for d, level, *s in cells:
            if int(d) * 64 + sum(BruteMixing.kind(x) * 4 ** (2 - j) for j, x in enumerate(s)) == g:
                zeros, ones = counted[(d, level, *s)]
                x = np.array([(level * 4 + 1.5) / 16 - 2, *(stream.odds[j][s[j]] for j in range(3))])
                pull = pull + x * (ones - (zeros + ones) / (1 + math.exp(-stream.weights[g] @ x)))
        assert np.abs(pull).max() < 1e-3, g


def test_lm_is_a_distribution():
    """The paths of a tree are a whole code, and the two sides of a bit share its probability."""
    code = lm_score.make_code(np.array([50, 3, 3, 1, 0, 7]), np.arange(256))
    for first, n in ((0, 6), (6, 256)):
        assert sum(2.0 ** -int(x) for x in code.length[first : first + n]) == 1
        assert len({(int(p), int(k)) for p, k in zip(code.path[first : first + n], code.length[first : first + n])}) == n
    assert (np.sort(code.rank[:6]) == np.arange(6)).all() and (code.leaves[1][code.rank[6:].astype(int)] == np.arange(256)).all()
    again = lm_score.Code(*code.__reduce__()[1])
    assert (again.node == code.node).all() and (again.start == code.start).all()
    z = np.linspace(-5, 5, 11)
    assert np.allclose(np.exp(-np.logaddexp(0, -z)) + np.exp(-np.logaddexp(0, z)), 1)


def test_lm_beats_uniform_and_learns(spark, texts):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in texts], "doc_id long, text string")
    apart = lm_score.lm_scores(docs, docs.where("doc_id % 5 <> 0")).where("doc_id % 5 = 0 and n_tokens > 50").collect()
    assert np.median([r["bits_per_byte"] for r in apart]) < 3.2
    flagged = lm_score.lm_scores(docs, F.col("doc_id") % 5 != 0).where("doc_id % 5 = 0 and n_tokens > 50").collect()
    assert {(r["doc_id"], round(r["score"], 2)) for r in apart} == {(r["doc_id"], round(r["score"], 2)) for r in flagged}


def test_lm_known_texts_gain_on_unigrams(spark):
    """Held-out texts of the small table: where every token is known, most score above add-one unigrams."""
    docs = spark.read.parquet(f"{DATA.replace("sf0.001", "sf0.01")}/documents.parquet")
    rows = lm_score.lm_scores(docs, F.expr("crc32(cast(doc_id as string)) % 7 <> 2")).where("crc32(cast(doc_id as string)) % 7 = 2").collect()
    known = [(r["score"] - r["base_score"]) / r["n_tokens"] for r in rows if r["n_known"] == r["n_tokens"]]
    assert len(known) >= 10 and np.median(known) > 0.1


def test_lm_keeps_contexts_met_once(spark):
    """A context of the training texts that occurs once is in the tables, down to the symbol."""
    docs = spark.createDataFrame([(1, "a b a b c d c e", True, True)], "doc_id long, text string, trains boolean, scored boolean")
    model = lm_score.train(docs).model
    ids = [np.array([1, 2, 0], np.int32)]
    met = [lm_score.layout_bits(model.code, *x[:3])[2] for x in model.streams(ids, [b""])]
    assert met and all(len(h) for h in met[0]) and sum(int((h != 0).sum()) for h in met[0]) > 0


def test_lm_slots_grow_and_pairs_merge():
    sizes = [lm_score.slot_bits(n) for n in (10**6, 10**8, 10**9, 5 * 10**10, 10**14)]
    assert sizes == sorted(sizes) and sizes[1] == 23 and sizes[3] == 27 and len(set(sizes)) == 5
    assert all(0 < x.own <= x.bits for n in (0, 1, 10**6, 10**12) for x in lm_score.layouts(n))
    layout = lm_score.Layout(30, 10)  # 12 bits are left for counts
    pairs, want = lm_score.Pairs(layout), Counter()
    rng = np.random.default_rng(3)
    for _ in range(20):
        keys = rng.integers(0, 50, 200).astype(np.uint64) << np.uint64(40)
        times = rng.integers(1, 9000, 200)
        pairs.add(keys, times)
        pairs.add(keys)
        for k, n in zip(keys.tolist(), times.tolist()):
            want[k] += n + 1
    keys, counts = pairs.all()
    assert dict(zip(keys.tolist(), counts.tolist())) == want and keys.tolist() == sorted(want)
    pairs.add(keys, counts)
    batch = lm_score.pack_pairs(2, layout, 7, *pairs.all())
    parts = [lm_score._unpack_pairs([batch.slice(i, 1)], [layout] * 3) for i in range(batch.num_rows)]
    assert dict(x for _, _, p in parts for x in zip(*(v.tolist() for v in p.all()))) == want


def test_lm_salted_merge_is_the_same(spark):
    docs = spark.createDataFrame([(f"one two {i % 40} three",) for i in range(300)], "text string").repartition(4)
    rows = docs.select(F.lit(1).cast("long").alias("doc_id"), "text", F.lit(True).alias("trains"), F.lit(True).alias("scored"))
    code = lm_score.make_code(np.array([300, 300, 300, 300, 300]), np.ones(256, np.int64))
    words = {b"": 0, b"one": 1, b"two": 2, b"three": 3}
    encoded = lm_score._encode(rows, words, np.zeros(5))
    held, ends = lm_score.layouts(5000), lm_score.endings(list(words))
    one, many = (lm_score._tables(lm_score._word_pairs(encoded, code, ends, held, n, most=500), code, held, n) for n in (1, 3))
    assert all((a == b).all() for a, b in zip(one, many)) and one[0].any() and one[2].any()


def test_lm_tokens_of_many_texts():
    texts = ["", None, " ", "A b\x0bC\x1cd\x0c e\r\n", "\x85x Y É İ", "one", "  lead", "trail  ", "a\x00b \x1f q"]
    for some in (texts, texts[3:7], []):
        found, bounds = lm_score.tokens(pa.array(texts, pa.string()).slice(3, 4) if len(some) == 4 else pa.array(some, pa.string()))
        want = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()) for t in some]
        assert [found[i:j].to_pylist() for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist())] == want


def test_lm_near_steps_share_slots_and_count_by_pair():
    """Steps of a path lie in runs of slots, no two nodes of a run in one; bits are counted as by plain loops."""
    rng = np.random.default_rng(8)
    code = lm_score.make_code(rng.integers(0, 10**6, 3000), rng.integers(0, 1000, 256))
    place: dict = {}
    for symbol in range(3000):
        at, n = int(code.start[symbol]), int(code.length[symbol])
        names = [int(x) & 0xFFFFFFFF for x in code.node[at : at + n]]
        path = tuple(int(x) >> 32 & 1 for x in code.node[at : at + n])
        for i in range(0, n, lm_score.NEAR):
            run = names[i : i + lm_score.NEAR]
            assert len({x >> lm_score.NEAR for x in run}) == 1
            for j, x in enumerate(run):
                assert place.setdefault(path[: i + j], x) == x
    for d in range(0, 20, lm_score.NEAR):
        runs: dict = {}
        for p, x in place.items():
            if d <= len(p) < d + lm_score.NEAR:
                runs.setdefault(p[:d], []).append(x)
        assert all(len(set(x)) == len(x) for x in runs.values())
    layout = lm_score.Layout(14, 12)
    context = layout.hashed(rng.integers(0, 40, 500).astype(np.uint64))
    keys = np.unique(context << np.uint64(lm_score.SYMBOL_BITS) | rng.integers(0, 3000, 500).astype(np.uint64))
    keys = keys[keys >> np.uint64(lm_score.SYMBOL_BITS + 4 + layout.own) == 1]
    counts, want = rng.integers(1, 9, len(keys)), np.zeros((2, 1 << layout.own))
    for key, n in zip(keys, counts.tolist()):
        symbol = int(code.leaves[0][int(key) & (1 << lm_score.SYMBOL_BITS) - 1])
        first = int(layout.first(np.array([key >> np.uint64(lm_score.SYMBOL_BITS)]))[0])
        for x in code.node[code.start[symbol] : code.start[symbol] + code.length[symbol]].tolist():
            want[x >> 32 & 1, (first ^ x) & (1 << layout.own) - 1] += n
    assert len(keys) > 50 and all((lm_score.bit_counts(keys, counts, code, 0, layout, most) == want).all() for most in (7, 10**6))


def test_lm_scores_of_texts_alone_and_together(spark, texts):
    """Texts longer than what is laid out at once, and short ones, score alike in any company."""
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in texts], "doc_id long, text string")
    model = lm_score.train(docs.select("*", F.lit(True).alias("trains"), F.lit(True).alias("scored"))).model
    rng = np.random.default_rng(4)
    ids = [rng.integers(0, model.code.escape, n).astype(np.int32) for n in (40_000, 1, 9, 700)]
    together = model.log10(ids, [b""] * 4)
    assert np.allclose(together, [model.log10([x], [b""])[0] for x in ids], rtol=1e-5)


def test_lm_refines_short_texts(spark, texts):
    docs = spark.createDataFrame([(r["doc_id"], r["text"]) for r in texts], "doc_id long, text string")
    model = lm_score.train(docs.select("*", F.lit(True).alias("trains"), F.lit(True).alias("scored"))).model
    ids = [np.arange(12, dtype=np.int32)]
    still = [lm_score.code_lengths(model.code, *x, rate=0.0) for x in model.streams(ids, [b""])]
    assert -still[0][0] / math.log(10) != model.log10(ids, [b""])[0]


# 9


def brute_lines(rows, least=20, docs=3):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    holders: dict = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                holders.setdefault(key(x), set()).add(-math.inf if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        own = -math.inf if i is None else i
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= docs and own < max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup(spark, odd, empty):
    got = line_dedup.dedup_lines(odd)
    assert sorted(map(str, map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()))) == sorted(map(str, brute_lines(ODD)))
    assert got.select("rest.n_chars", "rest.rest", "rest.lost").count() == len(ODD)
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_dedup.dedup_lines(odd.select("doc_id", "text")).count() == len(ODD)


def test_line_runs_compact_and_anti_join(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    keys = lambda rows: spark.createDataFrame(rows, "doc_id long, h1 long, h2 long")
    for i in range(5):
        batch = keys([(i, i, 0), (i, 99, 0), (i, 99, 0)])
        assert runs.new_lines(batch).select("h1").distinct().count() == (2 if i == 0 else 1)
        runs.append(batch)
    late = runs.repeats(keys([(-1, 99, 0), (-1, 50, 0), (-2, 50, 0), (-3, 51, 0)]))
    assert sorted((r["doc_id"], r["h1"]) for r in late.collect()) == [(-2, 50), (-1, 99)]
    assert {r["h1"]: (r["n_docs"], r["max_doc"]) for r in runs.merged().collect()}[99] == (6, 4)
    runs = line_dedup.LineRuns(spark, fanout=2)
    for i in range(5):
        runs.append(keys([(i, i, 0), (i, 99, 0), (i, 99, 0)]))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {r["h1"]: (r["n_docs"], r["max_doc"]) for r in runs.merged().collect()}[99] == (5, 4)


# 10


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, valid int")


def test_chat_round_trip(spark):
    rng = random.Random(2)
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[=]", "[/ROLE]", "\\", "<", "[", "/", "s>", " ", "\n", "a", "é", "🎉", "$1", "\\E"]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "", "[=]", None]), None if rng.random() < 0.05 else "".join(rng.choices(pieces, k=rng.randint(0, 12)))) for c in range(150) for t in range(rng.randint(1, 5))]
    out = chat_format.read_back(chat_format.format_conversations(conversations(spark, rows))).collect()
    want = {c: [(r or "", t or "", r == "assistant") for k, _, r, t in rows if k == c] for c in {r[0] for r in rows}}
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in out} == want
    for r in out:
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


def test_chat_states_and_edges(spark):
    order = {1: "user assistant", 2: "system user assistant user", 3: "assistant user", 4: "user user", 5: "system", 6: "user system", 7: "tool"}
    rows = [(c, i, r, "t") for c, said in order.items() for i, r in enumerate(said.split())] + [(None, 1, "assistant", None), (None, 0, "user", "x")]
    got = {r["conv_id"]: r for r in chat_format.digest(chat_format.format_conversations(conversations(spark, rows))).collect()}
    assert {c for c, r in got.items() if r["valid"]} == {1, 2, None}
    assert got[None]["turns_sha256"] == hashlib.sha256(b"user\nx\nassistant\n\n").hexdigest() and got[None]["loss_chars"] == 0
    assert chat_format.digest(chat_format.format_conversations(conversations(spark, []))).count() == 0


# Pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    known = spark.read.parquet(f"{DATA}/labels.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_scores(docs, known).collect()}
    rows = [r for r in rows if not scores[r[0]]]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "line dedup":
            kept = {i: sha for i, _, _, sha in brute_lines(rows)}
            assert {i: hashlib.sha256(t.encode()).hexdigest() for i, t in got.items()} == kept
            rows = list(got.items())
        elif name == "near duplicates":
            rows = [r for r, (i, least, _) in zip(rows, brute_classes(rows)) if i == least]
        elif name == "decontamination":
            rows = [r for r in rows if not brute_hits(r[1], bench)[-1]]
        assert docs.columns == columns and got == dict(rows), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(dict(rows))


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    """Null ids and texts, repeated rows, clashing columns, a long text: packed whole; nothing gives nothing."""
    for name, docs in (("odd", odd), ("empty", empty)):
        path = f"file://{tmp_path}/{name}"
        docs.withColumn("n_chars", F.when(F.col("doc_id") != 7, F.col("n_chars"))).write.parquet(f"{path}/documents.parquet")
        spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([(1, None), (None, ""), (2, "no such words in any of them at all here today")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        got = sorted(corpus_pipeline.run(spark, path).collect(), key=str)
        assert (len(got) > 0) == (name == "odd")
        if name == "odd":
            ids = {r["doc_id"] for r in got}
            # The line that 3, 4 and a null id share stays in 4, whose two rows are copies; what is left without words stays.
            assert ids == {None, 1, 2, 3, 4, 7, 8, 9, 10, 11} and {i: [r["length"] > 1 for r in got if r["doc_id"] == i] for i in (3, 4)} == {3: [False], 4: [True]}
            assert all(r["length"] <= 2048 for r in got) and sum(r["length"] for r in got if r["doc_id"] == 9) > 40_000
