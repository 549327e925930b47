import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from notewright import constants as K
from notewright.config import Settings
from notewright.errors import CallBudgetError, RateLimitError
from notewright.operators import catalog, chat, metrics, rules, sampling, split, textgen, tokens
from notewright.plans import generate, prepare


@pytest.fixture(scope="module")
def codes(spark):
    rows = [(f"A{i:02}", f"ailment number {i}", True, "c", i) for i in range(30)]
    return catalog.dedup(spark.createDataFrame(rows, "code string, name string, is_billable boolean, category_name string, pos long"))


class Counting:
    """Writes a line for each call to a file that all tasks share; fails while a marker file is there."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, prompt):
        with open(f"{self.folder}/calls", "a") as f:
            f.write(hashlib.md5(prompt.encode()).hexdigest() + "\n")
        if "number 7" in prompt and os.path.exists(f"{self.folder}/broken"):
            raise RuntimeError("no answer")
        return textgen.stub(prompt)

    def calls(self):
        with open(f"{self.folder}/calls") as f:
            return f.read().split()


def test_each_request_is_generated_once_and_failures_again(spark, codes, tmp_path):
    """All of a batch's results read what was written; the second run asks for what failed, the third for nothing."""
    ask, out = Counting(tmp_path), f"file://{tmp_path}/out"
    (tmp_path / "broken").touch()
    requests = generate.batch_requests(spark.createDataFrame([("default", 9), ("oncology", 4), ("none", 0)], "profile string, n_notes long"), None, 2)
    first = generate.run_batch(requests, codes, sampling.profile_table(spark), out, ask)
    failed = {r["note_idx"] for r in first.failures.collect()}
    stats = {r["profile"]: r for r in first.stats.collect()}
    assert len(ask.calls()) == 13 and failed and all(r["error"] == "RuntimeError: no answer" for r in first.failures.collect())
    assert first.notes.count() == 13 - len(failed) == sum(r["generated"] for r in stats.values()) and {k: r["asked"] for k, r in stats.items()} == {"default": 9, "oncology": 4}
    assert {r["profile"] for r in first.samples.collect()} <= {"default", "oncology"} and first.issues.count() >= 0 and len(ask.calls()) == 13
    assert first.calls.head().asDict() == {"prompts": 13, "answered": 13 - len(failed), "total_calls": 13 - len(failed), "failed_calls": len(failed), "limited_calls": 0, "success_rate": (13 - len(failed)) * 100.0 / 13}
    os.remove(tmp_path / "broken")
    second = generate.run_batch(requests, codes, sampling.profile_table(spark), out, ask)
    assert len(ask.calls()) == 13 + len(failed) and second.failures.count() == 0 and second.notes.count() == 13 and second.succeeded
    third = generate.run_batch(requests, codes, sampling.profile_table(spark), out, ask)
    assert len(ask.calls()) == 13 + len(failed) and sorted(r["text"] for r in third.notes.collect()) == sorted(r["text"] for r in second.notes.collect())


def test_a_broken_run_keeps_finished_waves(spark, codes, tmp_path):
    """A run whose job fails: what earlier waves wrote is not asked for again."""
    ask = Counting(tmp_path)
    asked = generate.asked_codes(generate.batch_requests(spark.createDataFrame([("default", 12)], "profile string, n_notes long"), None, 2), codes, sampling.profile_table(spark))
    path, real, done = f"file://{tmp_path}/answers", generate.answers, []

    def failing(rows, *args):
        done.append(1)
        out = real(rows, *args)
        return out.withColumn("raw", F.raise_error("lost").cast("string")) if len(done) == 3 else out

    with pytest.MonkeyPatch.context() as m, pytest.raises(Exception, match="lost"):
        m.setattr(generate, "answers", failing)
        generate.durable_answers(asked, path, ask, waves=4)
    kept = spark.read.parquet(path).count()
    before = len(ask.calls())
    assert generate.durable_answers(asked, path, ask, waves=4).count() == 12 and len(ask.calls()) - before == 12 - kept and 0 < kept < 12


def test_single_note_raises(spark, codes):
    asked = spark.createDataFrame([("x", "default", [("A01", "ailment", None)])], "note_idx string, profile string, codes array<struct<code string, name string, category_name string>>")

    def dead(prompt):
        raise RuntimeError("no answer")

    assert generate.notes_of_codes(asked, dead).count() == 0
    with pytest.raises(Exception, match="no answer"):
        generate.notes_of_codes(asked, dead, on_error="raise").collect()
    assert generate.notes_of_codes(asked, on_error="raise").count() == 1


def test_budget_and_observed_counters(spark):
    """A task stops calling at its budget; the observation and the frame of counters agree."""
    made = textgen.generate_text(spark.range(10).select(F.col("id").cast("string").alias("p")).coalesce(1), "p", "t", lambda p: f"a{p}", budget=4)
    watched, watch = textgen.observed(made, "t")
    rows = watched.collect()
    assert [r["t"] for r in rows] == ["a0", "a1", "a2", "a3"] + [None] * 6 and all("CallBudgetError" in r["t_error"] for r in rows[4:])
    want = {"prompts": 10, "answered": 4, "total_calls": 4, "failed_calls": 0, "limited_calls": 0, "success_rate": 100.0}
    assert watch.get == want == textgen.client_rates(made, "t").head().asDict()


def test_retrying_client_counts():
    said = iter([RateLimitError("429"), RuntimeError("x"), "short", "y" * 60])

    def answer(prompt):
        x = next(said)
        if isinstance(x, Exception):
            raise x
        return x

    waits = []
    client = textgen.with_retries(answer, sleep=waits.append)
    assert client("p") == "y" * 60 and (client.calls, client.failed, client.limited) == (4, 1, 1) and waits == [1, 1.0]
    client.budget = 4
    with pytest.raises(CallBudgetError):
        client("p")


def test_settings_rule_a_batch(spark, codes, tmp_path):
    s = Settings(api_keys={"gemini": "k"}, min_codes_per_note=1, max_codes_per_note=2, rate_limit_delay=0.0, enable_validation=False, output_directory=f"file://{tmp_path}/o")
    requests = spark.createDataFrame([(f"r{i}", "default") for i in range(6)], "note_idx string, profile string")
    batch = generate.batch_by_settings(s, requests, codes, sampling.profile_table(spark), textgen.stub)
    assert "validation_result" not in batch.notes.columns and {len(r["codes"]) for r in batch.notes.collect()} <= {1, 2} and batch.stats.head()["valid"] == 6


@pytest.mark.parametrize("ratio", [0.0, 0.2, 0.5, 1.0])
def test_split_is_exact_in_seeded_order(spark, ratio):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", None, "c"]), "x" * i) for i in range(300)] + [(1000, "one", "y")]
    out = split.stratified_split(spark.createDataFrame(rows, "id long, s string, _c string").repartition(3), "s", "id", ratio)
    got = {r["id"]: r["split"] for r in out.collect()}
    assert out.columns == ["id", "s", "_c", "split"] and len(got) == 301
    for s in ("a", "b", None, "c", "one"):
        own = sorted((i for i, x, _ in rows if x == s), key=lambda i: hashlib.md5(f"42-{i}".encode()).hexdigest())
        k = int(len(own) * (1.0 - ratio))
        assert [got[i] for i in own] == ["train"] * k + ["validation"] * (len(own) - k)


def test_split_of_a_key_that_repeats(spark):
    """Most rows of a stratum have one key: sizes stay exact; null keys and an empty frame do no harm."""
    rows = [("k", "a")] * 90 + [(f"u{i}", "a") for i in range(10)] + [(None, "b")] * 7
    df = spark.createDataFrame(rows, "id string, s string")
    got = {(r["s"], r["split"]): r["count"] for r in split.stratified_split(df, "s", "id", 0.4).groupBy("s", "split").count().collect()}
    assert got == {("a", "train"): 60, ("a", "validation"): 40, ("b", "train"): 4, ("b", "validation"): 3}
    assert split.stratified_split(df.limit(0), "s", "id").count() == 0


def test_fixed_classes_and_unequal_lists(spark):
    rows = [(0, ["A", "B"], ["A"]), (1, ["C"], ["C", "B"]), (2, ["A"], ["A"])]
    pairs = spark.createDataFrame(rows, "index int, predicted array<string>, truth array<string>")
    got = {r["label"]: tuple(r)[1:4] for r in metrics.per_class(pairs, ["A", "Z", "A"]).collect()}
    assert got == {"A": (2, 0, 0), "Z": (0, 0, 0)}
    one = metrics.summary(pairs, ["A", "Z"]).head()
    assert (one["num_classes"], one["f1_macro"], one["f1_micro"], round(one["exact_match_accuracy"], 6)) == (2, 0.5, 1.0, 0.333333)
    short = metrics.zip_summary(pairs.select("index", "predicted"), pairs.where("index = 2").select("index", "truth")).head()
    assert (short["num_samples"], round(short["exact_match_accuracy"], 6), short["num_classes"]) == (3, 0.333333, 1)
    none = metrics.zip_summary(pairs.limit(0).select("index", "predicted"), pairs.select("index", "truth")).head()
    assert (none["num_samples"], none["exact_match_accuracy"], none["num_classes"], none["f1_macro"]) == (0, 0.0, 0, 0.0)


def test_templates(spark):
    m = F.array(*(F.struct(F.lit(r).alias("role"), F.lit(c).alias("content")) for r, c in (("system", "S"), ("user", "U"), ("assistant", "A"))))
    row = spark.range(1).select(chat.templated(m).alias("c"), chat.templated(m, "gemma").alias("g"), chat.inference_prompt(F.lit("U"), "S", template="gemma").alias("o"), chat.model_prompt(F.lit("U"), F.lit("none")).alias("n")).head()
    assert row["c"] == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nU<|im_end|>\n<|im_start|>assistant\nA<|im_end|>"
    assert row["g"] == "<bos><start_of_turn>user\nS\n\nU<end_of_turn>\n<start_of_turn>model\nA<end_of_turn>"
    assert row["o"] == "<bos><start_of_turn>user\nS\n\nU<end_of_turn>\n<start_of_turn>model\n" and row["n"] is None
    with pytest.raises(ValueError, match="chatml"):
        chat.templated(m, "other")
    assert {x[8] for x in K.MODELS} <= set(K.TEMPLATES)


def test_cut_equals_the_tokenizers_own(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    texts = ["", None, "one two three four five six", "naïve 漢字 🎉 " * 20, "x" * 500, "<|endoftext|> a b c d e f g h i j"]
    for most in (1, 7, 40):
        for r in tokens.cut_tokens(spark.createDataFrame([(t,) for t in texts], "t string"), "t", path, most).collect():
            if r["t"] is None:
                assert r["cut"] is None and r["n_tokens"] is None
                continue
            full = own.encode(r["t"], add_special_tokens=False)
            assert r["n_tokens"] == len(full.ids) and r["kept_tokens"] == min(most, len(full.ids)) and r["t"].startswith(r["cut"])
            assert r["cut"] == (r["t"] if len(full.ids) <= most else r["t"][: full.offsets[most - 1][1]])
            if r["t"].isascii():
                assert own.encode(r["cut"], add_special_tokens=False).ids == full.ids[:most] or own.decode(full.ids[:most], skip_special_tokens=False) == r["cut"]


def test_terms_found_by_rarest_piece(spark):
    rows = [("A", "Heart failure", True, "Cardio"), ("B", "heartburn", True, None), ("C", "Ear", True, "ÄRGER"), ("D", None, True, "x")]
    cat = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "code string, name string, is_billable boolean, category_name string, ord long")
    terms = ["heart", "HEART F", "ar", "e", "", "%", "zzz", "ärg", None, "tb", "heartburns"]
    got = {(r["term"], r["code"]) for r in sampling.term_hits(cat, spark.createDataFrame([(t,) for t in terms], "term string")).collect()}
    assert got == {(t, c) for t in terms if t is not None for c, n, _, k in rows if t.lower() in (n or "").lower() or t.lower() in (k or "").lower()}
    plan = sampling.term_hits(cat, spark.createDataFrame([("heart",)], "term string"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert sampling.term_hits(cat, spark.createDataFrame([], "term string")).count() == 0


def test_cues_in_their_windows(spark):
    far = "x" * 55
    texts = ["no fever", f"possible {far} fever", f"denies {far[:48]} fever", "fever, no cough", None, "possible and no fever. fever"]
    code = F.array(*(F.struct(F.lit(c).alias("code"), F.lit("Fever today").alias("name")) for c in ("A01", "R50")))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(rules.negation(F.col("t"), code)).alias("n"), F.size(rules.uncertainty(F.col("t"), code)).alias("u"))
    assert [(r["n"], r["u"]) for r in df.collect()] == [(2, 0), (0, 0), (2, 0), (0, 0), (0, 0), (2, 1)]


def test_conversion_keeps_errors_beside_samples(spark):
    rows = [("a", "t", ["I10"], "p", '{"age": true, "gender": null}'), ("b", None, ["I10"], "p", None), ("c", "t", None, "p", None), (None, "t", [], None, "[1]"), ("e", "t", [], None, "null")]
    df = spark.createDataFrame(rows, "note_id string, clinical_text string, icd10_codes array<string>, profile string, m string").withColumn("metadata", F.parse_json("m"))
    got = prepare.convert(df).collect()
    assert [r["error"] for r in got] == [None, "Note b: clinical_text is null", "Note c: icd10_codes is null", "Note None: metadata is no object", None]
    assert got[0]["messages"][1]["content"] == "Patient age: True\nGender: None\n\nAnalyze this clinical note:\n\nt" and got[1]["messages"] is None
    assert prepare.to_samples(df).count() == 2 and prepare.convert(df, []).head()["messages"][1]["content"] == "Analyze this clinical note:\n\nt"
