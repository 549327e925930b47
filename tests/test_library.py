import io
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from notewright import constants as K
from notewright import queries
from notewright.config import PrepareSettings, Settings
from notewright.errors import CodeNotFoundError, ConfigurationError, DatasetLoadError, InsufficientCodesError, RateLimitError
from notewright.eventlog import EventLog
from notewright.functions import parsing, text
from notewright.operators import catalog, chat, metrics, registry, rules, sampling, split, stats, textgen
from notewright.plans import generate as generate_plan
from notewright.plans import prepare as prepare_plan
from notewright.sources import catalog as catalog_source
from notewright.sources import notes as note_source
from notewright.sources import sinks
from tests.conftest import DATA, rows_of


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).head()["x"]


@pytest.mark.parametrize("code,ok", [("E11.9", True), ("I10", True), ("J45.901", True), ("E119", True), ("E11.", True), ("E1", False), ("123.4", False), ("S52.501A", False), ("e11.9", False), (None, False)])
def test_code_format(spark, code, ok):
    assert one(spark, parsing.is_valid_code(F.col("c")), c=code) is ok


def test_sanitize_golden(spark):
    note = "Patient has E11.9 and (I10) noted.\nB12 level [E11.65]\n : low  value"
    got = one(spark, rules.sanitize(F.col("t"), F.col("c")), t=note, c=["E11.9", "I10", "E11.6"])
    assert (got["text"], got["removed"]) == ("Patient hasandnoted.\n level5]\nlow value", 4)


@pytest.mark.parametrize(
    "said,codes",
    [
        ('{"icd10_codes": ["E11.9", "I10"]}', ["E11.9", "I10"]),
        ('["A01"]', ["A01"]),
        ('Sure: {"icd10_codes": ["E11.9"]} done', ["E11.9"]),
        ("{'icd10_codes': ['E11.9']}", ["E11.9"]),
        ("I10, E11.9 and I10", ["E11.9", "I10"]),
        ('{"icd10_codes": null}', []),
        ("", []),
        (None, []),
        ("5", []),
    ],
)
def test_parse_codes(spark, said, codes):
    assert one(spark, parsing.parse_codes(F.col("o")), o=said) == codes


def test_upper_median(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in (1, 2, 3, 4)], "i int, clinical_text string")
    assert stats.length_stats(df).head()["median_chars"] == 3


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="no fever\n ", min_size=0, max_size=150))
def test_windows_before(spark, t):
    t = t + " fever"
    want = [t[max(0, i - 60) : i] for i in range(len(t)) if t.startswith("fever", i) and (i == 0 or not t[i - 1].isalnum()) and not t[i + 5 : i + 6].isalnum()]
    assert one(spark, text.windows_before(F.col("t"), F.lit("fever"), 60), t=t) == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=8), max_size=4))
def test_json_codes_round_trip(spark, codes):
    codes = [c.encode("utf-8", "ignore").decode() for c in codes]
    got = one(spark, text.json_codes(F.col("c")), c=codes)
    assert json.loads(got) == {"icd10_codes": codes}


def test_split_counts(spark):
    rows = [(f"{s}{i}", s) for s, n in zip("abcd", (10, 5, 1, 7)) for i in range(n)]
    out = split.stratified_split(spark.createDataFrame(rows, "id string, s string"), "s", "id")
    train = {r["s"]: r["n"] for r in out.where("split = 'train'").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert out.count() == 23 and [train.get(s, 0) for s in "abcd"] == [8, 4, 0, 5]


def test_metrics_golden(spark):
    rows = [(0, ["A", "B"], ["A"]), (1, ["C"], ["C", "B"]), (2, ["A", "D"], ["E"]), (3, [], ["A"])]
    got = metrics.summary(spark.createDataFrame(rows, "index int, predicted array<string>, truth array<string>")).head()
    assert (round(got["f1_micro"], 6), round(got["f1_macro"], 6), got["exact_match_accuracy"]) == (0.4, round((2 / 4 + 0 + 1 + 0 + 0) / 5, 6), 0.0)


@pytest.fixture(scope="module")
def codes(spark):
    rows = [("E11.9", "Type 2 diabetes", True, "Endocrine", 0), ("I10", "Hypertension", True, "", 1), ("A00", "Cholera 100%", False, None, 2), ("E11.9", "Diabetes, later", True, "Endocrine", 3)]
    return catalog.dedup(spark.createDataFrame(rows, "code string, name string, is_billable boolean, category_name string, pos long")).cache()


def test_catalog(codes):
    assert [(r["code"], r["name"], r["ord"]) for r in codes.orderBy("ord").collect()] == [("E11.9", "Diabetes, later", 0), ("I10", "Hypertension", 1), ("A00", "Cholera 100%", 2)]
    assert catalog.search(codes, "%", billable_only=False).count() == 1
    assert catalog.search(codes, "", max_results=0).count() == 1
    assert catalog.billable(codes, 0).count() == 0
    with pytest.raises(ValueError):
        catalog.billable(codes, -1)
    with pytest.raises(CodeNotFoundError, match="code=Z"):
        catalog.require(codes, "Z")
    with pytest.raises(InsufficientCodesError):
        sampling.random_billable(codes, 3)


def test_profile_selection_is_whole(spark):
    out = queries.profile_select(spark, DATA)
    asked = queries._requests(spark, DATA)
    n = out.groupBy("note_idx").agg(F.count("*").alias("n"), F.count_distinct("code").alias("d"))
    assert asked.join(n, "note_idx").where("n <> n_codes or n <> d").count() == 0 and n.count() == asked.count()
    assert out.join(queries._catalog(spark, DATA).where("not is_billable"), "code").count() == 0


def test_read_catalog_and_notes(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('[{"icd10_code": "A", "name": null, "icd10_name": "x"}, {"code": "B", "is_billable": false, "category_description": "k"}]')
    got = catalog_source.read_catalog(spark, str(path)).orderBy("pos").collect()
    assert [(r["code"], r["is_billable"], r["category_name"]) for r in got] == [("A", True, None), ("B", False, "k")]
    with pytest.raises(DatasetLoadError):
        catalog_source.read_catalog(spark, str(tmp_path / "none.json"))
    path.write_text('{"notes": [{"id": "", "text": "t", "codes": ["I10"], "age": 5}, {"note_id": "n", "clinical_text": " ", "icd_codes": []}]}')
    notes = note_source.normalize_notes(note_source.read_raw_notes(spark, str(path)))
    rows = notes.orderBy("pos").select("note_id", "clinical_text", "icd10_codes", "profile", F.try_variant_get("metadata", "$.age", "int").alias("age")).collect()
    assert [tuple(r) for r in rows] == [("note_000000", "t", ["I10"], "unknown", 5), ("n", " ", [], "unknown", None)]
    with pytest.raises(ValueError, match="n: clinical_text is blank"):
        note_source.load_notes(notes)
    assert note_source.load_notes(notes, "drop").count() == 1


def test_gate(spark):
    m = chat.to_messages(F.lit("hello"), F.col("c"))
    errors = lambda c, n=512: one(spark, chat.sample_errors(m, n), c=c)
    assert errors(["I10"]) == []
    assert errors([]) == ["Assistant JSON: Empty icd10_codes list"]
    size = len(K.SYSTEM_PROMPT) + len("\nhello\n") + len('{"icd10_codes": ["S52.501A"]}')
    tokens = int((int(size / 4.0) + 1) * 1.2)
    assert errors(["S52.501A"], 1) == ["Assistant JSON: Invalid ICD-10 codes: ['S52.501A']", f"Token length: Estimated {tokens} tokens exceeds max_seq_length=1"]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (0, "é")], "i int, s string")
    sinks.write_json_array(rows, str(tmp_path / "a"), "i")
    text_of = "".join(p.read_text() for p in (tmp_path / "a").glob("part-*"))
    assert json.loads(text_of) == [{"i": 0, "s": "é"}, {"i": 1, "s": None}]
    pairs = spark.createDataFrame([(0, ["A"], ["A", "<b>"])], "index int, predicted array<string>, truth array<string>")
    doc = sinks.metrics_document(metrics.summary(pairs), metrics.per_class(pairs), run=1)
    assert doc["per_class"]["A"]["f1"] == 1.0 and doc["metadata"] == {"run": 1}
    assert "&lt;b&gt;" in sinks.html_report(metrics.summary(pairs), metrics.top_classes(pairs))


def test_retries_and_registry(spark):
    calls, waits = [], []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise RateLimitError("429", retry_after=0.25)
        return "x" * 60

    assert textgen.with_retries(flaky, sleep=waits.append)("p") == "x" * 60 and waits == [0.25, 0.25]
    made = textgen.generate_text(spark.createDataFrame([("1. Cough",), (None,)], "p string"), "p", "t", textgen.stub).collect()
    assert "cough" in made[0]["t"] and made[1]["t_error"] is None
    assert registry.model(spark, "phi3")["context_length"] == 4096
    with pytest.raises(ValueError, match="phi3"):
        registry.model(spark, "other")


def test_settings():
    s = Settings.from_environment({"OPENAI_API_KEY": "k", "MAX_CODES_PER_NOTE": "7", "ENABLE_VALIDATION": "false"}).check()
    assert (s.llm_provider, s.max_codes_per_note, s.enable_validation) == ("openai", 7, False)
    for bad in ({}, {"GEMINI_API_KEY": "k", "MIN_CODES_PER_NOTE": "9"}, {"GEMINI_API_KEY": "k", "CONFIDENCE_THRESHOLD": "101"}, {"GEMINI_API_KEY": "k", "ICD10_DATASET_PATH": "/none.json"}):
        with pytest.raises(ConfigurationError):
            Settings.from_environment(bad).check()
    assert PrepareSettings.from_environment({"FT_VALIDATION_SPLIT": "0.1"}).validation_split == 0.1


def test_event_log():
    out = io.StringIO()
    log = EventLog(out)
    log.set_context(run=1)
    with log.within(run=2):
        log.metric("loss", 0.5)
    log.event("epoch_end", epoch=1)
    first, second = map(json.loads, out.getvalue().splitlines())
    assert (first["run"], first["value"], second["run"], second["epoch"]) == (2, 0.5, 1, 1) and first["timestamp"].endswith("Z")


def _raw_notes(spark, path):
    notes = [{"id": f"n{i}", "text": "The patient was seen today. " * 8, "codes": ["E11.9", "I10"][: 1 + i % 2], "profile": "a" if i % 4 else "b", "ward": i} for i in range(40)]
    notes.append({"id": "bad", "text": "Seen today.", "codes": ["S52.501A"], "profile": "a"})
    spark.createDataFrame([(json.dumps({"notes": notes}),)], "value string").coalesce(1).write.text(path)


def test_prepare_dataset_writes_both_files(spark, tmp_path):
    _raw_notes(spark, f"file://{tmp_path}/raw")
    done = prepare_plan.prepare_dataset(spark, f"file://{tmp_path}/raw", f"file://{tmp_path}/out")
    assert done.sizes == {"train": 32, "validation": 8} and done.gate == {"total_samples": 41, "valid_samples": 40, "invalid_samples": 1}
    assert [r["note_id"] for r in done.errors.collect()] == ["bad"] and done.lengths["median_chars"] > 100
    train, validation = (note_source.read_samples(spark, p).selectExpr("note_id", "try_variant_get(metadata, '$.ward', 'int') AS ward", "try_variant_get(metadata, '$.num_codes', 'int') AS n").collect() for p in (done.train, done.validation))
    assert sorted(r["ward"] for r in train + validation) == list(range(40)) and all(r["n"] == 1 + r["ward"] % 2 and r["note_id"] == f"n{r['ward']}" for r in train + validation)


def test_batch_isolates_failures(spark):
    cat = catalog.dedup(spark.createDataFrame([(f"A{i:02}", f"ailment number {i}", True, "c", i) for i in range(30)], "code string, name string, is_billable boolean, category_name string, pos long"))

    def flaky(prompt):
        if "number 7 " in prompt or "number 7\n" in prompt:
            raise RuntimeError("no answer")
        return textgen.stub(prompt)

    profiles = sampling.profile_table(spark)
    batch = generate_plan.multi_profile_batch(cat, profiles, per_profile=6, n_codes=2, generate=flaky, names=["default", "oncology", "unheard"])
    rows = {r["profile"]: r for r in batch.stats.collect()}
    assert set(rows) == {"default", "oncology", "unheard"} and all(r["asked"] == 6 and r["generated"] <= 6 for r in rows.values())
    assert batch.notes.count() == sum(r["generated"] for r in rows.values()) and batch.succeeded == (batch.notes.count() >= 0.8 * 18)
    assert batch.issues.columns == ["issue", "occurrences"]

    def dead(prompt):
        raise RuntimeError("no answer")

    assert not generate_plan.multi_profile_batch(cat, profiles, 2, generate=dead, names=["default"]).succeeded
    codes = spark.createDataFrame([("x", "default", [("A01", "ailment number 1", None)])], "note_idx string, profile string, codes array<struct<code string, name string, category_name string>>")
    single = generate_plan.notes_of_codes(codes, validate=False).head()
    assert "ailment number 1" in single["text"] and "validation_result" not in single.asDict()


def test_fill_differs_between_notes(spark):
    """Random selection: notes share no run of codes, and each gets as many as it asks for."""
    cat = catalog.dedup(spark.createDataFrame([(f"A{i:03}", f"n{i}", True, "c", i) for i in range(200)], "code string, name string, is_billable boolean, category_name string, pos long"))
    requests = spark.createDataFrame([(i, "x", 5) for i in range(100)], "note_idx long, profile string, n_codes int")
    rows = sampling.Selector(cat).select(requests, "random").collect()
    by_note = {}
    for r in rows:
        by_note.setdefault(r["note_idx"], set()).add(r["code"])
    assert len(by_note) == 100 and all(len(v) == 5 for v in by_note.values())
    shared = [len(by_note[i] & by_note[j]) for i in range(100) for j in range(i)]
    assert sum(shared) / len(shared) < 0.25 and max(shared) <= 4  # 5 * 5 / 200 = 0.125 expected


def test_inference_prompt_and_zip(spark):
    got = one(spark, chat.inference_prompt(F.col("u"), "sys"), u="ask")
    assert got == "<|im_start|>system\nsys<|im_end|>\n<|im_start|>user\nask<|im_end|>\n<|im_start|>assistant\n"
    assert one(spark, chat.inference_prompt(F.col("u"), "sys", 3), u="ask") == got[:12]
    left = spark.createDataFrame([(i, ["A"]) for i in range(4)], "index int, predicted array<string>")
    right = spark.createDataFrame([(i, ["A"]) for i in range(3)], "index int, truth array<string>")
    assert metrics.zip_pairs(left, right).count() == 3


def test_metadata_edges(spark):
    rows = [("p", ["A01"], '{"profile": "own", "x": [1, 2]}'), (None, None, None), ("p", [], "[1]"), ("p", ["A"], '"text"')]
    df = spark.createDataFrame(rows, "p string, c array<string>, m string").select(F.to_json(chat.sample_metadata(F.col("p"), F.col("c"), F.parse_json("m"))).alias("j"))
    assert [json.loads(r["j"]) for r in df.collect()] == [{"profile": "own", "num_codes": 1, "x": [1, 2]}, {"profile": None, "num_codes": 0}, {"profile": "p", "num_codes": 0}, {"profile": "p", "num_codes": 1}]
