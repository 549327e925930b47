"""The library's operators bound to the tables, with the same results in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright import constants as K
from notewright.errors import ContentFilteredError, RateLimitError, TextGenerationError
from notewright.functions import parsing, text
from notewright.operators import catalog, chat, metrics, prompting, records, registry, rules, sampling, split, stats, textgen, tokens
from notewright.plans import evaluate, generate, prepare
from notewright.sources import catalog as catalog_source
from notewright.sources import notes as note_source
from notewright.sources import sinks
from notewright.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- Tables standing in for catalogue, notes and evaluation pairs; the same expressions in SQL ---

_CODE_SQL = """chr(CAST(65 + k % 26 AS INTEGER)) || lpad(CAST((k // 26) % 100 AS VARCHAR), 2, '0') || CASE k % 4 WHEN 0 THEN ''
  WHEN 1 THEN '.' || CAST(k % 10 AS VARCHAR) WHEN 2 THEN '.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') ELSE '.' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') || 'A' END"""
_RAW_SQL = f"""raw AS (SELECT {_CODE_SQL} AS code, p_name AS name, p_size % 5 <> 0 AS is_billable,
  CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS category_name, k AS pos FROM (SELECT *, p_partkey AS k FROM part))"""
_CAT_SQL = f"""{_RAW_SQL}, cat AS (SELECT code, r.name AS name, r.is_billable AS is_billable, r.category_name AS category_name, ord FROM (
  SELECT code, arg_max({{'name': name, 'is_billable': is_billable, 'category_name': category_name}}, pos) AS r, min(pos) AS ord FROM raw GROUP BY code))"""


def _code(k):
    dotted = F.concat(F.lit("."), F.lpad((k % 1000).cast("string"), 3, "0"))
    suffix = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat(F.lit("."), (k % 10).cast("string"))).when(k % 4 == 2, dotted).otherwise(F.concat(dotted, F.lit("A")))
    return F.concat(F.char(65 + k % 26), F.lpad((F.floor(k / 26) % 100).cast("string"), 2, "0"), suffix)


def _raw_catalog(spark, d) -> DataFrame:
    return _read(spark, d, "part").select(
        _code(F.col("p_partkey")).alias("code"),
        F.col("p_name").alias("name"),
        (F.col("p_size") % 5 != 0).alias("is_billable"),
        F.when(F.col("p_size") % 7 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("category_name"),
        F.col("p_partkey").alias("pos"),
    )


def _catalog(spark, d) -> DataFrame:
    return catalog.dedup(_raw_catalog(spark, d))


_WORD_SQL = "list_filter(string_split(lower({0}), ' '), lambda w: length(w) > 3 AND w NOT IN ('with', 'without', 'type', 'unspecified'))[1]"
_NOTES_SQL = f"""{_RAW_SQL}, np AS (SELECT count(*) AS n FROM part),
dc AS (SELECT doc_id, text, lang, (doc_id * 7 + j) % n AS k, j FROM (SELECT *, unnest(range(0, doc_id % 4 + 1)) AS j FROM documents), np),
dn AS (SELECT doc_id, any_value(lang) AS lang, any_value(text) AS body, list({{'code': code, 'name': name}} ORDER BY j) AS codes FROM dc JOIN raw ON raw.pos = dc.k GROUP BY doc_id),
notes AS (SELECT doc_id, lang, codes, body || CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN ' (' || codes[1].code || ')'
  WHEN 2 THEN ' denies ' || coalesce({_WORD_SQL.format('codes[1].name')}, 'it') || ' today' WHEN 3 THEN ' possible ' || coalesce({_WORD_SQL.format('codes[1].name')}, 'it') || ' noted'
  ELSE ' Q99.' || CAST(doc_id % 10 AS VARCHAR) END AS text FROM dn)"""


def _notes(spark, d) -> DataFrame:
    """doc_id, lang, text, codes: documents with codes of parts, and taints that the rules look for."""
    n = F.broadcast(_read(spark, d, "part").agg(F.count("*").alias("n")))  # one row
    docs = _read(spark, d, "documents").select("doc_id", "lang", "text")
    asked = docs.select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int"))).alias("j")).crossJoin(n)
    coded = asked.withColumn("pos", (F.col("doc_id") * 7 + F.col("j")) % F.col("n")).join(_raw_catalog(spark, d), "pos")
    codes = coded.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("j", "code", "name"))).alias("c"))
    notes = docs.join(codes, "doc_id").withColumn("codes", F.transform("c", lambda c: F.struct(c["code"].alias("code"), c["name"].alias("name"))))
    word = F.coalesce(text.keyword(F.col("codes")[0]["name"]), F.lit("it"))
    taint = (
        F.when(F.col("doc_id") % 5 == 0, "")
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit(" ("), F.col("codes")[0]["code"], F.lit(")")))
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit(" denies "), word, F.lit(" today")))
        .when(F.col("doc_id") % 5 == 3, F.concat(F.lit(" possible "), word, F.lit(" noted")))
        .otherwise(F.concat(F.lit(" Q99."), (F.col("doc_id") % 10).cast("string")))
    )
    return notes.select("doc_id", "lang", F.concat("text", taint).alias("text"), "codes")


def _joined(column, sep: str = "|"):
    return F.array_join(column, sep)


# --- Catalogue ---


@_query(f"WITH {_CAT_SQL} SELECT code, name, is_billable, category_name, ord FROM cat")
def catalog_dedup(spark, d):
    return _catalog(spark, d)


@_query("""SELECT p_name AS code, r.p_brand AS brand, r.p_size AS size, ord FROM (
  SELECT p_name, arg_max({'p_brand': p_brand, 'p_size': p_size}, p_partkey) AS r, min(p_partkey) AS ord FROM part GROUP BY p_name)""")
def catalog_dedup_names(spark, d):
    """Many records per key: the last wins, at the first one's place."""
    return catalog.dedup(_read(spark, d, "part").select(F.col("p_name").alias("code"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_partkey").alias("pos")))


@_query(f"WITH {_CAT_SQL} SELECT count(*) AS total_codes, count(*) FILTER (WHERE is_billable) AS billable_code_count FROM cat")
def catalog_counts(spark, d):
    return catalog.counts(_catalog(spark, d))


@_query(f"WITH {_CAT_SQL} SELECT coalesce(nullif(category_name, ''), 'Uncategorized') AS category, count(*) AS n_codes, count(*) FILTER (WHERE is_billable) AS n_billable FROM cat GROUP BY 1")
def catalog_by_category(spark, d):
    return catalog.by_category(_catalog(spark, d))


@_query(f"WITH {_CAT_SQL} SELECT upper(substr(code, 1, 1)) AS chapter, count(*) AS n_codes FROM cat GROUP BY 1")
def catalog_by_chapter(spark, d):
    return catalog.by_chapter(_catalog(spark, d))


@_query(f"WITH {_CAT_SQL} SELECT DISTINCT 'category' AS kind, coalesce(nullif(category_name, ''), 'Uncategorized') AS key FROM cat UNION ALL SELECT DISTINCT 'chapter', upper(substr(code, 1, 1)) FROM cat")
def catalog_keys(spark, d):
    return catalog.keys(_catalog(spark, d))


@_query(f"WITH {_CAT_SQL} SELECT code, name, is_billable, category_name, ord FROM cat WHERE code = 'B00.1'")
def code_lookup(spark, d):
    return catalog.lookup(_catalog(spark, d), "B00.1")


@_query(f"""WITH {_CAT_SQL} SELECT code, upper(substr(code, 1, 1)) AS first_character, upper(substr(code, 1, 1)) IN ('S', 'T') AS is_injury_code,
  upper(substr(code, 1, 1)) IN ('V', 'W', 'X', 'Y') AS is_external_cause_code, upper(substr(code, 1, 1)) = 'R' AS is_symptom_code,
  upper(substr(code, 1, 1)) = 'Z' AS is_z_code, upper(substr(code, 1, 1)) IN ('S', 'T') AND length(code) >= 3 AS requires_7th_character,
  CASE upper(substr(code, 1, 1)) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.CHAPTERS.items())} END AS chapter_name FROM cat""")
def code_attributes(spark, d):
    rows = _catalog(spark, d)
    return rows.select("code", *(c.alias(n) for n, c in text.code_attributes(F.col("code")).items()), text.chapter_name(F.col("code")).alias("chapter_name"))


@_query(f"WITH {_CAT_SQL} SELECT code, name, ord FROM cat WHERE is_billable AND category_name = 'Brand#3' ORDER BY ord LIMIT 25")
def billable_codes(spark, d):
    return catalog.billable(_catalog(spark, d), 25, "Brand#3").select("code", "name", "ord")


@_query(f"WITH {_CAT_SQL} SELECT code, name, is_billable, ord FROM cat WHERE upper(substr(code, 1, 1)) = 'S' AND is_billable")
def code_chapter(spark, d):
    return catalog.chapter(_catalog(spark, d), "s").select("code", "name", "is_billable", "ord")


@_query(f"WITH {_CAT_SQL} SELECT code, name, category_name, ord FROM cat WHERE is_billable AND (contains(lower(name), 'wid') OR contains(lower(coalesce(category_name, '')), 'wid')) ORDER BY ord LIMIT 100")
def code_search(spark, d):
    return catalog.search(_catalog(spark, d), "WID").select("code", "name", "category_name", "ord")


# --- Selection ---


@_query(f"WITH {_CAT_SQL} SELECT code, name FROM cat WHERE is_billable ORDER BY md5('42-' || code), code LIMIT 50")
def random_select(spark, d):
    return sampling.random_billable(_catalog(spark, d), 50).select("code", "name")


@_query("SELECT doc_id AS note_idx, CAST(2 + CAST('0x' || substr(md5('42-' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4 AS INTEGER) AS n_codes FROM documents")
def codes_per_note(spark, d):
    return sampling.codes_per_note(_read(spark, d, "documents").select(F.col("doc_id").alias("note_idx")))


def _requests(spark, d) -> DataFrame:
    """A request for each document: profiles by turns, one of them unknown."""
    names = F.array(*(F.lit(x) for x in ("tools", "colors", "default", "unheard")))
    rows = _read(spark, d, "documents").select(F.col("doc_id").alias("note_idx"), names[(F.col("doc_id") % 4).cast("int")].alias("profile"))
    return sampling.codes_per_note(rows)


def _profiles(spark) -> DataFrame:
    """Profiles whose terms occur in the parts' names."""
    own = [("tools", "", ["bolt", "gear", "ring"], 0.4, ["widget"]), ("colors", "", ["red", "blue", "hot"], 0.75, ["small", "large"]), ("default", "", [], 0.0, [])]
    return spark.createDataFrame(own, sampling.profile_table(spark).schema)


_HEX = "CAST('0x' || substr(md5({0}), 1, 8) AS BIGINT)"
_REQ_SQL = f"""req AS (SELECT doc_id AS note_idx, CASE doc_id % 4 WHEN 0 THEN 'tools' WHEN 1 THEN 'colors' WHEN 2 THEN 'default' ELSE 'unheard' END AS profile,
  CAST(2 + {_HEX.format("'42-' || CAST(doc_id AS VARCHAR)")} % 4 AS INTEGER) AS n_codes FROM documents)"""
_CHOSEN_SQL = f"""quota AS (SELECT *, CAST(floor(n_codes * CASE profile WHEN 'tools' THEN 0.4 WHEN 'colors' THEN 0.75 ELSE 0 END) AS INTEGER) AS k_com FROM req),
term(profile, kind, term) AS (VALUES ('tools', 'p', 'bolt'), ('tools', 'p', 'gear'), ('tools', 'p', 'ring'), ('tools', 'c', 'widget'),
  ('colors', 'p', 'red'), ('colors', 'p', 'blue'), ('colors', 'p', 'hot'), ('colors', 'c', 'small'), ('colors', 'c', 'large')),
hit AS (SELECT profile, kind, term, code, ord, row_number() OVER (PARTITION BY profile, kind, term ORDER BY ord) AS h
  FROM cat JOIN term ON contains(lower(cat.name), term) OR contains(lower(coalesce(category_name, '')), term) WHERE is_billable),
cand AS (SELECT note_idx, kind, code, n_codes, k_com, {{'k': md5(CASE kind WHEN 'p' THEN '42-' ELSE '43-' END || CAST(note_idx AS VARCHAR) || '-' || term), 't': term, 'o': ord}} AS rk
  FROM quota JOIN hit USING (profile) WHERE h <= CASE kind WHEN 'p' THEN 10 ELSE 5 END),
best AS (SELECT note_idx, kind, code, n_codes, k_com, min(rk) AS rk FROM cand GROUP BY ALL),
pri AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY note_idx ORDER BY rk) AS place FROM best WHERE kind = 'p') WHERE place <= n_codes - k_com),
com AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY note_idx ORDER BY rk) AS place FROM best b WHERE kind = 'c'
  AND NOT EXISTS (SELECT 1 FROM pri WHERE pri.note_idx = b.note_idx AND pri.code = b.code)) WHERE place <= k_com),
chosen AS (SELECT note_idx, code, place, 'primary' AS part FROM pri UNION ALL SELECT note_idx, code, place, 'comorbid' FROM com),
ring AS (SELECT code, row_number() OVER (ORDER BY md5('42-' || code), code) - 1 AS spot FROM cat WHERE is_billable),
need AS (SELECT note_idx, n_codes, n_codes - (SELECT count(*) FROM chosen WHERE chosen.note_idx = req.note_idx) AS need FROM req),
draw AS (SELECT note_idx, need, step, (CASE WHEN step < 2 * n_codes THEN {_HEX.format("'42-' || CAST(note_idx AS VARCHAR) || '-' || CAST(step AS VARCHAR)")}
  ELSE {_HEX.format("'42-' || CAST(note_idx AS VARCHAR)")} + step END) % (SELECT count(*) FROM ring) AS spot FROM (SELECT *, unnest(range(0, 4 * n_codes)) AS step FROM need WHERE need > 0)),
drawn AS (SELECT note_idx, need, code, min(step) AS step FROM draw JOIN ring USING (spot) GROUP BY ALL),
fill AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY note_idx ORDER BY step) AS place FROM drawn d
  WHERE NOT EXISTS (SELECT 1 FROM chosen WHERE chosen.note_idx = d.note_idx AND chosen.code = d.code)) WHERE place <= need),
sel AS (SELECT note_idx, code, CAST(place AS INTEGER) AS place, part FROM chosen UNION ALL SELECT note_idx, code, CAST(place AS INTEGER), 'fill' FROM fill)"""
_SELECT_SQL = f"{_CAT_SQL}, {_REQ_SQL}, {_CHOSEN_SQL}"


@_query(f"WITH {_SELECT_SQL} SELECT note_idx, code, place, part FROM sel")
def profile_select(spark, d):
    return sampling.select_for_profiles(_requests(spark, d), _catalog(spark, d), _profiles(spark))


# --- Prompts ---

_LINES_SQL = "string_agg(CAST(i AS VARCHAR) || '. ' || name || CASE WHEN coalesce(category_name, '') <> '' THEN ' (Category: ' || category_name || ')' ELSE '' END, chr(10) ORDER BY i)"


@_query(f"""WITH {_RAW_SQL}, g AS (SELECT pos // 4 AS note_idx, row_number() OVER (PARTITION BY pos // 4 ORDER BY pos) AS i, code, name, category_name FROM raw),
  l AS (SELECT note_idx, {_LINES_SQL} AS lines, string_agg('- ' || code || ': ' || name, chr(10) ORDER BY i) AS dashes FROM g GROUP BY note_idx)
  SELECT note_idx, 'Write a realistic Progress Note. Never write a diagnosis code.' || chr(10) || chr(10) || 'Diagnoses:' || chr(10) || lines || chr(10) || chr(10)
    || 'Sections: Subjective, Objective, Assessment, Plan' || chr(10) || chr(10) || 'Context: None' || chr(10) AS prompt, dashes FROM l""")
def prompt_build(spark, d):
    rows = _raw_catalog(spark, d).select(F.expr("pos div 4").alias("note_idx"), F.struct("pos", "code", "name", "category_name").alias("c"))
    grouped = rows.groupBy("note_idx").agg(F.array_sort(F.collect_list("c")).alias("codes"))
    prompt = prompting.generation_prompt(F.lit("PROGRESS_NOTE"), F.col("codes"), F.lit(""))
    asked = F.regexp_extract(prompting.validation_prompt(F.lit("-"), F.col("codes")), r"(?s)Codes:\n(.*)\n\nAnswer", 1)
    return grouped.select("note_idx", prompt.alias("prompt"), asked.alias("dashes"))


# --- Rules over notes ---


_CLEAN_SQL = r"""s1 AS (SELECT doc_id, t0, [regexp_escape(c.code) for c in codes] AS q FROM s0),
  s2 AS (SELECT doc_id, list_reduce(list_prepend({'t': t0, 'n': 0, 'c': ''}, list_transform(q, lambda c: {'t': '', 'n': 0, 'c': c})),
    lambda a, x: {'t': regexp_replace(a.t, '[\(\[\s]*' || x.c || '[\)\]\s]*', '', 'gi'), 'n': CAST(a.n + len(regexp_extract_all(a.t, '(?i)[\(\[\s]*' || x.c || '[\)\]\s]*')) AS INTEGER), 'c': ''}) AS r FROM s1),
  s3 AS (SELECT doc_id, r.n + len(regexp_extract_all(r.t, '\b[A-Z]\d{2}\.?\d{0,4}[A-Z]?\b')) AS removed, regexp_replace(r.t, '\b[A-Z]\d{2}\.?\d{0,4}[A-Z]?\b', '', 'g') AS t FROM s2),
  clean AS (SELECT doc_id, CAST(removed AS INTEGER) AS removed, trim(regexp_replace(regexp_replace(regexp_replace(t, ' {2,}', ' ', 'g'), '\(\s*\)|\[\s*\]', '', 'g'), '(?m)^\s*:\s*', '', 'g'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM s3)"""


@_query(f"WITH {_NOTES_SQL}, s0 AS (SELECT doc_id, text AS t0, codes FROM notes), {_CLEAN_SQL} SELECT doc_id, removed, md5(t) AS text_md5 FROM clean")
def sanitize_text(spark, d):
    clean = rules.sanitize(F.col("text"), F.transform("codes", lambda c: c["code"]))
    return _notes(spark, d).select("doc_id", clean.alias("s")).select("doc_id", F.col("s.removed").alias("removed"), F.md5("s.text").alias("text_md5"))


_LEAK_SQL = """list_concat([ 'CODE_LEAKAGE: ICD-10 code ''' || c.code || ''' appears in note text' for c in codes if contains(upper(text), upper(c.code)) ],
  [ 'CODE_LEAKAGE: Unexpected ICD-10 code pattern ''' || m || ''' in text' for m in list_sort(list_distinct(regexp_extract_all(text, '\\b[A-Z]\\d{2}\\.\\d{1,4}[A-Z]?\\b'))) if NOT list_contains([ c.code for c in codes ], m) ])"""
_SHORT_SQL = """CASE WHEN length(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) < 100 THEN ['NOTE_TOO_SHORT: Note is ' || CAST(length(text) AS VARCHAR) || ' chars, minimum is 100'] ELSE CAST([] AS VARCHAR[]) END"""


@_query(f"WITH {_NOTES_SQL} SELECT doc_id, array_to_string({_LEAK_SQL}, '|') AS issues FROM notes")
def code_leakage(spark, d):
    return _notes(spark, d).select("doc_id", _joined(rules.code_visibility(F.col("text"), F.col("codes"))).alias("issues"))


@_query(f"WITH {_NOTES_SQL} SELECT doc_id, array_to_string({_SHORT_SQL}, '|') AS issues FROM notes")
def min_length(spark, d):
    return _notes(spark, d).select("doc_id", _joined(rules.minimum_length(F.col("text"))).alias("issues"))


def _cue_sql(name: str, width: int, cue: str, message: str, where: str) -> str:
    """Each place of a note's key words, and whether a cue stands before it; SQL without look-behind."""
    word = _WORD_SQL.format("c.name")
    return f"""{name}_w AS (SELECT doc_id, i, c.code AS code, {word} AS kw, lower(text) AS t FROM (SELECT doc_id, text, unnest(codes) AS c, unnest(range(1, len(codes) + 1)) AS i FROM notes) WHERE {word} IS NOT NULL AND contains(lower(text), {word}) AND {where}),
{name}_p AS (SELECT doc_id, i, code, kw, t, unnest(range(1, length(t) - length(kw) + 2)) AS pp FROM {name}_w),
{name}_h AS (SELECT DISTINCT doc_id, i, code, kw FROM {name}_p WHERE substr(t, pp, length(kw)) = kw AND (pp = 1 OR NOT regexp_matches(substr(t, pp - 1, 1), '\\w')) AND NOT regexp_matches(substr(t, pp + length(kw), 1), '\\w')
  AND regexp_matches(substr(t, greatest(1, pp - {width}), least({width}, pp - 1)), '{cue}')),
{name} AS (SELECT doc_id, list({message} ORDER BY i) AS {name}_list FROM {name}_h GROUP BY doc_id)"""


_NEG_SQL = _cue_sql("neg", 60, K.NEGATION, "'POSSIBLE_NEGATION: ''' || kw || ''' may be negated (code: ' || code || ')'", "true")
_UNC_SQL = _cue_sql("unc", 50, K.UNCERTAINTY, "'UNCERTAIN_DIAGNOSIS: ''' || kw || ''' has uncertainty language but ' || code || ' is definitive'", "upper(substr(c.code, 1, 1)) NOT IN ('R', 'Z')")


@_query(f"WITH {_NOTES_SQL}, {_NEG_SQL} SELECT doc_id, coalesce(array_to_string(neg_list, '|'), '') AS warnings FROM notes LEFT JOIN neg USING (doc_id)")
def negation_flags(spark, d):
    return _notes(spark, d).select("doc_id", _joined(rules.negation(F.col("text"), F.col("codes"))).alias("warnings"))


@_query(f"WITH {_NOTES_SQL}, {_UNC_SQL} SELECT doc_id, coalesce(array_to_string(unc_list, '|'), '') AS warnings FROM notes LEFT JOIN unc USING (doc_id)")
def uncertainty_flags(spark, d):
    return _notes(spark, d).select("doc_id", _joined(rules.uncertainty(F.col("text"), F.col("codes"))).alias("warnings"))


_CHECK_SQL = f"""{_NEG_SQL}, {_UNC_SQL},
chk AS (SELECT doc_id, lang, list_concat({_LEAK_SQL}, {_SHORT_SQL}) AS crit, list_concat(coalesce(neg_list, []), coalesce(unc_list, [])) AS warn FROM notes LEFT JOIN neg USING (doc_id) LEFT JOIN unc USING (doc_id)),
val AS (SELECT *, CAST(CASE WHEN len(crit) = 0 THEN greatest(0, 100 - 10 * len(warn)) ELSE 0 END AS DOUBLE) AS score FROM chk)"""
_VALID_SQL = f"{_NOTES_SQL}, {_CHECK_SQL}"


@_query(f"WITH {_VALID_SQL} SELECT doc_id, len(crit) = 0 AND score >= 70 AS is_valid, score AS confidence_score, CAST(len(crit) AS INTEGER) AS n_critical, CAST(len(warn) AS INTEGER) AS n_warnings FROM val")
def note_validation(spark, d):
    r = "validation_result."
    out = rules.validate(_notes(spark, d))
    return out.select("doc_id", r + "is_valid", r + "confidence_score", F.size(r + "critical_issues").alias("n_critical"), F.size(r + "warnings").alias("n_warnings"))


@_query(f"""WITH {_VALID_SQL}, iss AS (SELECT doc_id, unnest(list_concat(crit, warn)) AS issue, unnest(range(0, len(crit) + len(warn))) AS i FROM val WHERE NOT (len(crit) = 0 AND score >= 70))
  SELECT issue, count(*) AS n FROM iss GROUP BY issue ORDER BY n DESC, min({{'d': doc_id, 'i': i}}) LIMIT 5""")
def issue_histogram(spark, d):
    return stats.issue_histogram(rules.validate(_notes(spark, d)).withColumnRenamed("doc_id", "pos"))


@_query(f"WITH {_VALID_SQL} SELECT lang AS profile, count(*) AS generated, count(*) FILTER (WHERE len(crit) = 0 AND score >= 70) AS valid, round(count(*) FILTER (WHERE len(crit) = 0 AND score >= 70) * 100.0 / count(*), 6) AS valid_rate FROM val GROUP BY lang")
def profile_rates(spark, d):
    out = stats.generation_rates(rules.validate(_notes(spark, d)).withColumnRenamed("lang", "profile"))
    return out.withColumn("valid_rate", F.round("valid_rate", 6))


# --- Loading and statistics ---


@_query("""SELECT CASE WHEN doc_id % 3 = 0 THEN 'd' || CAST(doc_id AS VARCHAR) ELSE 'note_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') END AS note_id, md5(coalesce(text, '')) AS text_md5,
  CASE WHEN doc_id % 2 = 0 THEN 'E11.9,I10' ELSE '' END AS codes, CASE WHEN doc_id % 5 = 0 THEN 'unknown' ELSE lang END AS profile, source AS meta_source,
  CASE WHEN trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 'clinical_text is blank' WHEN doc_id % 2 <> 0 THEN 'icd10_codes is empty' END AS error FROM documents""")
def normalize_notes(spark, d):
    """Documents written as raw notes under varying spellings, then read back to one."""
    docs = _read(spark, d, "documents")
    raw = F.to_json(
        F.struct(
            F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("d"), F.col("doc_id").cast("string"))).when(F.col("doc_id") % 3 == 1, "").alias("id"),
            F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("narrative"),
            F.when(F.col("doc_id") % 2 == 1, F.col("text")).alias("text"),
            F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("E11.9"), F.lit("I10"))).otherwise(F.array().cast("array<string>")).alias("codes"),
            F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("profile"),
            "source",
        )
    )
    notes = note_source.with_error(note_source.normalize_notes(docs.select(F.col("doc_id").alias("pos"), F.parse_json(raw).alias("doc"))))
    return notes.select("note_id", F.md5("clinical_text").alias("text_md5"), _joined(F.col("icd10_codes"), ",").alias("codes"), "profile", F.try_variant_get("metadata", "$.source", "string").alias("meta_source"), "error")


@_query("SELECT lang, count(*) AS n_notes, min(length(text)) AS min_chars, max(length(text)) AS max_chars, round(avg(length(text)), 6) AS mean_chars, list_sort(list(length(text)))[count(*) // 2 + 1] AS median_chars FROM documents GROUP BY lang")
def dataset_summary(spark, d):
    return stats.length_stats(_read(spark, d, "documents"), "text", ["lang"]).withColumn("mean_chars", F.round("mean_chars", 6))


@_query("SELECT lang AS profile, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 6) AS percent, min(doc_id) AS first_pos FROM documents GROUP BY lang")
def profile_distribution(spark, d):
    docs = _read(spark, d, "documents").select(F.col("lang").alias("profile"), F.col("doc_id").alias("pos"))
    return stats.distribution(docs).withColumn("percent", F.round("percent", 6))


_PAIRS_SQL = """pairs AS (SELECT l_orderkey AS i, list_sort(list(DISTINCT p_brand) FILTER (WHERE l_quantity >= 10)) AS p, list_sort(list(DISTINCT p_brand) FILTER (WHERE l_returnflag <> 'A')) AS t
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
pr AS (SELECT i, coalesce(p, []) AS p, coalesce(t, []) AS t FROM pairs),
mk AS (SELECT label, count(*) FILTER (WHERE list_contains(p, label) AND list_contains(t, label)) AS tp, count(*) FILTER (WHERE list_contains(p, label) AND NOT list_contains(t, label)) AS fp,
  count(*) FILTER (WHERE NOT list_contains(p, label) AND list_contains(t, label)) AS fn FROM (SELECT p, t, unnest(list_distinct(list_concat(p, t))) AS label FROM pr) GROUP BY label),
cls AS (SELECT label, tp, fp, fn, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM mk)"""


def _pairs(spark, d) -> DataFrame:
    """Labels of each order: brands of large lines, and of lines that were not returned."""
    brands = _read(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = _read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag").join(brands, "l_partkey")
    said = F.collect_set(F.when(F.col("l_quantity") >= 10, F.col("p_brand")))
    so = F.collect_set(F.when(F.col("l_returnflag") != "A", F.col("p_brand")))
    return lines.groupBy(F.col("l_orderkey").alias("index")).agg(said.alias("predicted"), so.alias("truth"))


@_query(f"WITH {_PAIRS_SQL} SELECT CAST(sum(len(t)) AS BIGINT) AS total_codes, (SELECT count(DISTINCT x) FROM (SELECT unnest(t) AS x FROM pr)) AS unique_codes, round(sum(len(t)) / count(*), 6) AS avg_codes_per_note FROM pr")
def label_stats(spark, d):
    return stats.code_stats(_pairs(spark, d), "truth").withColumn("avg_codes_per_note", F.round("avg_codes_per_note", 6))


# --- Chat samples ---

_JSON_SQL = """'{"icd10_codes": [' || array_to_string([ '"' || c.code || '"' for c in codes ], ', ') || ']}'"""
_USER_SQL = "'encounter_type: ' || lang || chr(10) || chr(10) || 'Analyze this clinical note:' || chr(10) || chr(10) || text"


def _samples(spark, d) -> DataFrame:
    notes = _notes(spark, d)
    context = [("age", F.lit(False), F.lit(None)), ("encounter_type", F.lit(True), F.col("lang"))]
    messages = chat.to_messages(chat.user_message(F.col("text"), context), F.transform("codes", lambda c: c["code"]))
    return notes.select("doc_id", "lang", messages.alias("messages"))


@_query(f"WITH {_NOTES_SQL} SELECT doc_id, md5({_USER_SQL}) AS user_md5, {_JSON_SQL} AS answer, md5('<|im_start|>system' || chr(10) || '{K.SYSTEM_PROMPT}' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || {_USER_SQL} || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || {_JSON_SQL} || '<|im_end|>') AS chatml_md5 FROM notes")
def chat_format(spark, d):
    m = F.col("messages")
    return _samples(spark, d).select("doc_id", F.md5(chat.first_content(m, "user")).alias("user_md5"), chat.first_content(m, "assistant").alias("answer"), F.md5(chat.chatml_text(m)).alias("chatml_md5"))


@_query("SELECT doc_id, CAST(floor(length(text) / 4.0) + 1 AS BIGINT) AS n_tokens FROM documents")
def token_estimate(spark, d):
    return _read(spark, d, "documents").select("doc_id", text.token_estimate(F.col("text")).alias("n_tokens"))


@_query("""WITH c AS (SELECT conv_id, list(coalesce(role, '') ORDER BY turn) AS roles, list(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ORDER BY turn) AS texts FROM conversations GROUP BY conv_id)
  SELECT conv_id, CASE WHEN len(roles) <> 3 THEN 'Expected 3 messages, got ' || CAST(len(roles) AS VARCHAR)
    WHEN roles <> ['system', 'user', 'assistant'] THEN 'Expected roles [''system'', ''user'', ''assistant''], got [''' || array_to_string(roles, ''', ''') || ''']'
    WHEN texts[1] = '' THEN 'Message 0 (system) has empty content' WHEN texts[2] = '' THEN 'Message 1 (user) has empty content' WHEN texts[3] = '' THEN 'Message 2 (assistant) has empty content' END AS error FROM c""")
def chat_structure(spark, d):
    turns = _read(spark, d, "conversations").select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.col("text").alias("content")).alias("t"))
    messages = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("messages"))
    return messages.select("conv_id", chat.structure_error(F.col("messages")).alias("error"))


_GATE_SQL = f"""{_NOTES_SQL}, smp AS (SELECT doc_id, lang, [ c.code for c in codes if NOT regexp_full_match(c.code, '[A-Z][0-9]{{2}}\\.?[0-9]{{0,4}}') ] AS bad,
  CAST(floor((floor((length('{K.SYSTEM_PROMPT}') + 1 + length({_USER_SQL}) + 1 + length({_JSON_SQL})) / 4.0) + 1) * CAST(1.2 AS DOUBLE)) AS BIGINT) AS n FROM notes),
gate AS (SELECT doc_id, lang, list_filter([CASE WHEN len(bad) > 0 THEN 'Assistant JSON: Invalid ICD-10 codes: [''' || array_to_string(bad, ''', ''') || ''']' END,
  CASE WHEN n > 1024 THEN 'Token length: Estimated ' || CAST(n AS VARCHAR) || ' tokens exceeds max_seq_length=1024' END], lambda x: x IS NOT NULL) AS errors FROM smp)"""


@_query(f"WITH {_GATE_SQL} SELECT doc_id, array_to_string(errors, '|') AS errors FROM gate")
def gate_samples(spark, d):
    return _samples(spark, d).select("doc_id", _joined(chat.sample_errors(F.col("messages"), 1024)).alias("errors"))


@_query(f"WITH {_GATE_SQL} SELECT count(*) AS total_samples, count(*) FILTER (WHERE len(errors) = 0) AS valid_samples, count(*) FILTER (WHERE len(errors) > 0) AS invalid_samples FROM gate")
def gate_stats(spark, d):
    return chat.dataset_stats(_samples(spark, d), 1024)


@_query(f"WITH {_RAW_SQL} SELECT code, regexp_full_match(code, '[A-Z][0-9]{{2}}\\.?[0-9]{{0,4}}') AS is_valid FROM raw")
def code_format(spark, d):
    return _raw_catalog(spark, d).select("code", parsing.is_valid_code(F.col("code")).alias("is_valid"))


def _split_sql(table: str, stratum: str) -> str:
    return f"""spl AS (SELECT doc_id, {stratum} AS stratum, CASE WHEN row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42-' || CAST(doc_id AS VARCHAR)), doc_id)
  <= floor(count(*) OVER (PARTITION BY {stratum}) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'validation' END AS split FROM {table})"""


@_query(f"WITH {_split_sql('documents', 'lang')} SELECT doc_id, stratum, split FROM spl")
def stratified_split(spark, d):
    docs = _read(spark, d, "documents").select("doc_id", F.col("lang").alias("stratum"))
    return split.stratified_split(docs, "stratum", "doc_id")


@_query(f"WITH {_split_sql('labels', 'quality')} SELECT stratum, split, count(*) AS n FROM spl GROUP BY 1, 2")
def split_counts(spark, d):
    rows = _read(spark, d, "labels").select("doc_id", F.col("quality").alias("stratum"))
    return split.stratified_split(rows, "stratum", "doc_id").groupBy("stratum", "split").agg(F.count("*").alias("n"))


# --- Model output and evaluation ---


@_query(f"""WITH {_NOTES_SQL}, o AS (SELECT doc_id, codes, CASE doc_id % 6 WHEN 0 THEN [ c.code for c in codes ] WHEN 1 THEN [ c.code for c in codes ] WHEN 2 THEN [ c.code for c in codes ]
  WHEN 5 THEN CAST([] AS VARCHAR[]) ELSE list_sort(list_distinct([ regexp_extract(c.code, '^[A-Z][0-9]{{2}}(\\.[0-9]{{1,4}})?') for c in codes ])) END AS found FROM notes)
  SELECT doc_id, array_to_string([ CASE WHEN doc_id % 6 IN (3, 4) AND regexp_matches(f, '\\.') AND list_contains([ c.code for c in codes ], f || 'A') AND NOT list_contains([ c.code for c in codes ], f) THEN substr(f, 1, 3) ELSE f END for f in found ], ',') AS found FROM o""")
def parse_output(spark, d):
    """Outputs of six forms: JSON, JSON within prose, a list, prose, single quotes, nothing."""
    notes = _notes(spark, d)
    codes = F.transform("codes", lambda c: c["code"])
    answer = text.json_codes(codes)
    form = F.col("doc_id") % 6
    output = (
        F.when(form == 0, answer)
        .when(form == 1, F.concat(F.lit("The codes are "), answer, F.lit(" as asked.")))
        .when(form == 2, F.to_json(codes))
        .when(form == 3, F.concat(F.lit("I found "), F.array_join(codes, " and "), F.lit(" here.")))
        .when(form == 4, F.replace(answer, F.lit('"'), F.lit("'")))
        .otherwise("")
    )
    found = parsing.parse_codes(output)
    return notes.select("doc_id", _joined(found, ",").alias("found"))


@_query(f"""WITH {_PAIRS_SQL}, s AS (SELECT i AS "index", list_sort(list_intersect(p, t)) AS tp, [ x for x in p if NOT list_contains(t, x) ] AS fp, [ x for x in t if NOT list_contains(p, x) ] AS fn FROM pr)
  SELECT "index", array_to_string(tp, ',') AS true_positives, array_to_string(fp, ',') AS false_positives, array_to_string(fn, ',') AS false_negatives,
  round(coalesce(len(tp) / nullif(len(tp) + len(fp), 0), 0), 6) AS precision, round(coalesce(len(tp) / nullif(len(tp) + len(fn), 0), 0), 6) AS recall,
  round(coalesce(2 * len(tp) / nullif(2 * len(tp) + len(fp) + len(fn), 0), 0), 6) AS f1, len(fp) + len(fn) = 0 AS exact_match FROM s""")
def eval_per_sample(spark, d):
    out = metrics.per_sample(_pairs(spark, d))
    sets = (_joined(F.col(c), ",").alias(c) for c in ("true_positives", "false_positives", "false_negatives"))
    return out.select("index", *sets, *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")), "exact_match")


_ROUNDED = "label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"


def _rounded(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.round(c, 6).alias(c) if t == "double" else c for c, t in rows.dtypes))


@_query(f"WITH {_PAIRS_SQL} SELECT {_ROUNDED} FROM cls")
def eval_per_class(spark, d):
    return _rounded(metrics.per_class(_pairs(spark, d)))


@_query(f"WITH {_PAIRS_SQL} SELECT {_ROUNDED} FROM cls ORDER BY cls.f1 DESC, label LIMIT 20")
def eval_top20(spark, d):
    return _rounded(metrics.top_classes(_pairs(spark, d)))


@_query(f"""WITH {_PAIRS_SQL}, a AS (SELECT count(*) AS num_classes, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(precision) AS pm, avg(recall) AS rm, avg(f1) AS fm FROM cls)
  SELECT (SELECT count(*) FROM pr) AS num_samples, round((SELECT count(*) FILTER (WHERE p = t) / count(*) FROM pr), 6) AS exact_match_accuracy, num_classes, round(tp / (tp + fp), 6) AS precision_micro,
  round(tp / (tp + fn), 6) AS recall_micro, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_micro, round(pm, 6) AS precision_macro, round(rm, 6) AS recall_macro, round(fm, 6) AS f1_macro FROM a""")
def eval_summary(spark, d):
    return _rounded(metrics.summary(_pairs(spark, d)))


def _records(spark, d) -> DataFrame:
    """Validated notes with the fields that generation gives them."""
    notes = rules.validate(_notes(spark, d)).withColumn("note_type", F.lit("PROGRESS_NOTE")).withColumn("model", F.lit("stub")).withColumnRenamed("lang", "profile")
    at = F.timestamp_seconds(F.col("doc_id"))
    return notes.select("*", at.alias("generated_at"), records.note_id(at, F.col("doc_id")).alias("note_id"), (F.col("doc_id") % 2).alias("n_removed"))


@_query(f"""WITH {_VALID_SQL}, v AS (SELECT doc_id, lang, len(crit) = 0 AND score >= 70 AS ok, score FROM val)
  SELECT 'note_' || strftime(make_timestamp(doc_id * 1000000), '%Y%m%d_%H%M%S') || '_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS note_id, CASE WHEN ok THEN 'VALID' ELSE 'INVALID' END AS validation_status,
  score AS confidence_score, lang AS generation_profile, strftime(make_timestamp(doc_id * 1000000), '%Y-%m-%dT%H:%M:%S.%f') AS generated_at, array_to_string([ c.code for c in n.codes ], ',') AS codes
  FROM v JOIN notes n USING (doc_id, lang)""")
def note_records(spark, d):
    out = records.serialized(_records(spark, d))
    return out.select("note_id", "validation_status", "confidence_score", "generation_profile", "generated_at", _joined(F.col("assigned_icd10_codes"), ",").alias("codes"))


@_query(f"""WITH {_NOTES_SQL} SELECT md5(text) AS input_md5, array_to_string([ c.code for c in codes ], ',') AS output, lang AS profile FROM notes""")
def training_form(spark, d):
    return records.training_form(_records(spark, d)).select(F.md5("input").alias("input_md5"), _joined(F.col("output"), ",").alias("output"), "metadata.profile")


@_query(f"""WITH {_VALID_SQL} SELECT count(*) AS notes_generated, count(*) FILTER (WHERE len(crit) = 0 AND score >= 70) AS notes_valid, count(*) FILTER (WHERE doc_id % 2 = 1) AS notes_sanitized,
  round(count(*) FILTER (WHERE len(crit) = 0 AND score >= 70) * 100.0 / count(*), 6) AS validation_rate, round(count(*) FILTER (WHERE doc_id % 2 = 1) * 100.0 / count(*), 6) AS sanitization_rate FROM val""")
def run_counters(spark, d):
    return _rounded(records.run_counters(_records(spark, d)))


@_query(f"WITH {_GATE_SQL} SELECT 'n' || CAST(doc_id % 300 AS VARCHAR) AS note_id, arg_max(array_to_string(errors, '|'), doc_id) AS errors FROM gate WHERE len(errors) > 0 GROUP BY 1")
def gate_errors(spark, d):
    samples = _samples(spark, d).select(F.concat(F.lit("n"), (F.col("doc_id") % 300).cast("string")).alias("note_id"), F.col("doc_id").alias("pos"), "messages")
    return chat.dataset_errors(samples, 1024).select("note_id", _joined(F.col("errors")).alias("errors"))


# --- Registry, events, whole plans ---


def _even_sql(x: str) -> str:
    """Half-even rounding to two places of a double as it is written."""
    d = f"(CAST(CAST({x} AS VARCHAR) AS DECIMAL(24, 16)) * 100)"
    return f"CAST(CASE WHEN {d} - floor({d}) = 0.5 THEN floor({d}) + floor({d}) % 2 ELSE round({d}) END AS DOUBLE) / 100"


@_query(f"""WITH m AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{m[0]}', {m[6]})" for i, m in enumerate(K.MODELS))}) AS x(i, variant, v)),
  e AS (SELECT p_partkey, variant, CAST(v AS DOUBLE) AS v, CAST(v AS DOUBLE) * 0.02 AS l, (p_size % 4 + 1) * CAST(0.5 AS DOUBLE) * (128 * (p_partkey % 8 + 1)) / 512 AS a FROM part JOIN m ON p_partkey % 3 = m.i)
  SELECT p_partkey, variant, {_even_sql("l")} AS lora_gb, {_even_sql("l * 1.5")} AS optimizer_gb, {_even_sql("a")} AS activations_gb, {_even_sql("v + l + l * 1.5 + a")} AS total_gb, v + l + l * 1.5 + a <= 6 AS fits_6gb FROM e""")
def vram_estimate(spark, d):
    """Memory for a batch and length drawn from each part."""
    rows = _read(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 3).alias("i"), (F.col("p_size") % 4 + 1).alias("batch"), (128 * (F.col("p_partkey") % 8 + 1)).alias("seq"))
    models = registry.models(spark).withColumn("i", F.array_position(F.array(*(F.lit(m[0]) for m in K.MODELS)), F.col("variant")) - 1)
    joined = rows.join(F.broadcast(models), "i")  # three rows
    est = registry.memory_estimate(F.col("min_vram_gb"), F.col("batch"), F.col("seq"))
    return joined.select("p_partkey", "variant", *(c.alias(k) for k, c in est.items() if k != "model_gb"))


@_query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS "timestamp", CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, event_type AS message, json_extract_string(props, '$.k') AS k FROM events""")
def event_log(spark, d):
    """Events as JSON log lines, read back."""
    rows = _read(spark, d, "events").select(
        "event_id",
        F.col("ts"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.lit("events").alias("logger"),
        F.col("event_type").alias("message"),
        F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("event_id"), F.col("event_id").cast("string"))).alias("extras"),
    )
    doc = F.from_json("value", "timestamp string, level string, message string, k string, event_id string")
    return sinks.log_events(rows).select(doc.alias("e")).select(F.col("e.event_id").cast("long").alias("event_id"), "e.timestamp", "e.level", "e.message", "e.k")


@_query(f"WITH {_GATE_SQL}, ok AS (SELECT doc_id, lang FROM gate WHERE len(errors) = 0), {_split_sql('ok', 'lang')} SELECT CAST(doc_id AS VARCHAR) AS note_id, stratum AS profile, split FROM spl")
def prepare_training_data(spark, d):
    """Format, gate and split in one plan."""
    notes = _notes(spark, d).select(F.col("doc_id").cast("string").alias("note_id"), F.col("text").alias("clinical_text"), F.transform("codes", lambda c: c["code"]).alias("icd10_codes"), F.col("lang").alias("profile"))
    context = [("encounter_type", F.lit(True), F.col("profile"))]
    return prepare.prepare(notes, context=context).select("note_id", "profile", "split")


def _made_sql(req: str, having: str = "true") -> str:
    """Notes of the requests ``req``, as the offline generator makes them, but for those whose codes fail ``having``."""
    return f"""{_CAT_SQL}, {req}, {_CHOSEN_SQL}, own AS (SELECT note_idx AS doc_id, list({{'code': code, 'name': cat.name}} ORDER BY CASE part WHEN 'primary' THEN 0 WHEN 'comorbid' THEN 1 ELSE 2 END, place) AS codes
  FROM sel JOIN cat USING (code) GROUP BY note_idx HAVING {having}),
s0 AS (SELECT doc_id, codes, 'Subjective: ' || array_to_string([ 'The patient was seen for ' || lower(c.name) || ' and examined with care.' for c in codes ], ' ')
  || ' Objective: vital signs are stable. Plan: follow up in two weeks.' AS t0 FROM own), {_CLEAN_SQL},
notes AS (SELECT doc_id, profile AS lang, t AS text, removed, codes FROM clean JOIN own USING (doc_id) JOIN req ON note_idx = doc_id), {_CHECK_SQL}"""


_MADE_SQL = _made_sql(_REQ_SQL)


@_query(f"WITH {_MADE_SQL} SELECT doc_id AS note_idx, notes.lang AS profile, md5(text) AS text_md5, CAST(len(codes) AS INTEGER) AS n_codes, removed AS n_removed, len(crit) = 0 AND score >= 70 AS is_valid, score AS confidence_score FROM notes JOIN val USING (doc_id)")
def generate_notes(spark, d):
    """A note for each document's request, by the offline text generator."""
    made = generate.generate_notes(_requests(spark, d), _catalog(spark, d), _profiles(spark))
    return made.select("note_idx", "profile", F.md5("text").alias("text_md5"), F.size("codes").alias("n_codes"), "n_removed", "validation_result.is_valid", "validation_result.confidence_score")


def _echo(prompt: str) -> str:
    """A predictor for tests: the prompt itself, whose code-like words the parser will find."""
    return prompt


_FOUND_SQL = f"""ev AS (SELECT doc_id AS i, list_distinct(regexp_extract_all({_USER_SQL}, '\\b([A-Z][0-9]{{2}}(?:\\.[0-9]{{1,4}})?)\\b')) AS p, list_distinct([ c.code for c in codes ]) AS t FROM notes)"""


@_query(f"""WITH {_NOTES_SQL}, {_FOUND_SQL}, s AS (SELECT i, len([ x for x in p if list_contains(t, x) ]) AS tp, len(p) AS np, len(t) AS nt FROM ev)
  SELECT i AS "index", CAST(tp AS INTEGER) AS tp, CAST(np - tp AS INTEGER) AS fp, CAST(nt - tp AS INTEGER) AS fn, tp = np AND tp = nt AS exact_match FROM s""")
def evaluate_samples(spark, d):
    """Predict from the stored user turns, parse and score."""
    samples = _samples(spark, d).withColumnRenamed("doc_id", "note_id")
    return metrics.per_sample(evaluate.predictions(samples, _echo)).select("index", F.size("true_positives").alias("tp"), F.size("false_positives").alias("fp"), F.size("false_negatives").alias("fn"), "exact_match")


def _with_metadata(spark, d) -> DataFrame:
    """Notes as the loader gives them; the metadata of every third clashes with what the sample adds."""
    extra = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('{"source": "s'), F.col("doc_id"), F.lit('", "num_codes": 99}'))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit('{"source": "s'), F.col("doc_id"), F.lit('"}')))
    return _notes(spark, d).select(F.col("doc_id").cast("string").alias("note_id"), F.col("text").alias("clinical_text"), F.transform("codes", lambda c: c["code"]).alias("icd10_codes"), F.col("lang").alias("profile"), F.parse_json(extra).alias("metadata"))


_META_SQL = "doc_id, lang AS profile, CASE WHEN doc_id % 3 = 0 THEN '99' ELSE CAST(len(codes) AS VARCHAR) END AS num_codes, CASE WHEN doc_id % 3 <> 2 THEN 's' || CAST(doc_id AS VARCHAR) END AS source"


def _metadata_of(samples: DataFrame) -> DataFrame:
    get = lambda k: F.try_variant_get("metadata", f"$.{k}", "string").alias(k)
    return samples.select(F.col("note_id").cast("long").alias("doc_id"), get("profile"), get("num_codes"), get("source"))


@_query(f"WITH {_NOTES_SQL} SELECT {_META_SQL} FROM notes")
def sample_metadata(spark, d):
    """Profile, number of codes and the note's own fields, which win."""
    return _metadata_of(prepare.to_samples(_with_metadata(spark, d)))


@_query(f"WITH {_GATE_SQL}, ok AS (SELECT g.doc_id, g.lang, n.codes FROM gate g JOIN notes n USING (doc_id) WHERE len(errors) = 0) SELECT {_META_SQL}, md5({_JSON_SQL}) AS answer_md5, 3 AS n_turns FROM ok")
def write_read_samples(spark, d):
    """Prepared samples written as JSONL and read back."""
    path = scratch_path(spark, "samples")
    sinks.write_samples(prepare.prepare(_with_metadata(spark, d), context=[("encounter_type", F.lit(True), F.col("profile"))]), path)
    back = note_source.read_samples(spark, path)
    return _metadata_of(back).join(back.select(F.col("note_id").cast("long").alias("doc_id"), F.md5(chat.first_content(F.col("messages"), "assistant")).alias("answer_md5"), F.size("messages").alias("n_turns")), "doc_id")


@_query(f"""WITH {_PAIRS_SQL.replace("FROM pairs)", "FROM pairs WHERE i % 3 <> 0 AND i % 5 <> 0)")} SELECT label, tp, fp, fn FROM cls""")
def eval_zip(spark, d):
    """Predictions and truths of unequal length, paired by position."""
    pairs = _pairs(spark, d)
    return metrics.per_class(metrics.zip_pairs(pairs.where(F.col("index") % 3 != 0), pairs.where(F.col("index") % 5 != 0))).select("label", "tp", "fp", "fn")


@_query(f"""WITH {_NOTES_SQL}, {_FOUND_SQL}, s AS (SELECT unnest(list_distinct(list_concat(p, t))) AS label, p, t FROM ev),
  c AS (SELECT label, count(*) FILTER (WHERE list_contains(p, label) AND list_contains(t, label)) AS tp, count(*) FILTER (WHERE NOT list_contains(t, label)) AS fp, count(*) FILTER (WHERE NOT list_contains(p, label)) AS fn FROM s GROUP BY label)
  SELECT label, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def evaluate_report(spark, d):
    """Predict, parse, score, write: the classes of the report as it was written."""
    samples = _samples(spark, d).withColumnRenamed("doc_id", "note_id")
    path = scratch_path(spark, "report")
    evaluate.evaluate_samples(samples, _echo, path, template=False, model="echo")
    doc = spark.read.text(f"{path}/metrics.json", wholetext=True).select(F.from_json("value", "per_class map<string,struct<precision:double,recall:double,f1:double>>").alias("m"))
    rows = doc.select(F.explode("m.per_class").alias("label", "r"))
    return rows.select("label", *(F.round(F.col(f"r.{c}"), 6).alias(c) for c in ("precision", "recall", "f1")))


_BATCH_SQL = """req AS (SELECT md5(profile || '|' || CAST(i AS VARCHAR)) AS note_idx, profile, 3 AS n_codes FROM (SELECT profile, unnest(range(1, n + 1)) AS i FROM (
  SELECT CASE doc_id % 4 WHEN 0 THEN 'tools' WHEN 1 THEN 'colors' WHEN 2 THEN 'default' ELSE 'unheard' END AS profile, count(*) // 2 AS n FROM documents GROUP BY 1)))"""


def _sometimes(prompt: str) -> str:
    """The offline generator, which refuses prompts of one category."""
    if "(Category: Brand#3)" in prompt:
        raise ContentFilteredError("blocked")
    return textgen.stub(prompt)


def _asked(spark, d) -> DataFrame:
    """Profiles, each with half as many notes as it has documents."""
    return _requests(spark, d).groupBy("profile").agg(F.floor(F.count("*") / 2).alias("n_notes"))


@_query(f"""WITH {_made_sql(_BATCH_SQL, "NOT bool_or(coalesce(category_name, '') = 'Brand#3')")}, ok AS (SELECT doc_id, len(crit) = 0 AND score >= 70 AS valid FROM val),
  g AS (SELECT req.profile, count(*) AS asked, count(ok.doc_id) AS generated, count(*) FILTER (WHERE valid) AS valid FROM req LEFT JOIN ok ON ok.doc_id = req.note_idx GROUP BY 1)
  SELECT profile, asked, generated, valid, round(coalesce(valid * 100.0 / nullif(generated, 0), 0), 6) AS validation_rate FROM g""")
def multi_profile_batch(spark, d):
    """A batch over several profiles whose generator refuses some prompts: what was asked, generated and valid."""
    requests = generate.batch_requests(_asked(spark, d), None, 3)
    return _rounded(generate.run_batch(requests, _catalog(spark, d), _profiles(spark), scratch_path(spark, "batch"), _sometimes).stats)


@_query(f"""WITH {_made_sql(_BATCH_SQL)}, bad AS (SELECT note_idx FROM sel JOIN cat USING (code) WHERE category_name = 'Brand#3' GROUP BY 1)
  SELECT note_idx, profile, 'ContentFilteredError: blocked' AS error FROM req WHERE note_idx IN (SELECT note_idx FROM bad)""")
def batch_failures(spark, d):
    """The requests of such a batch that failed, after a second run over the same folder: it asks for these only."""
    requests, path = generate.batch_requests(_asked(spark, d), None, 3), scratch_path(spark, "batch")
    for _ in range(2):
        batch = generate.run_batch(requests, _catalog(spark, d), _profiles(spark), path, _sometimes, waves=2)
    return batch.failures


class _Unsteady:
    """A generator by the number that is the prompt: 0 always refuses, 1 is rate-limited first, 2 fails first, 3 answers too shortly first."""

    def __init__(self):
        self.prompt, self.n = None, 0

    def __call__(self, prompt: str) -> str:
        self.prompt, self.n = prompt, self.n + 1 if prompt == self.prompt else 1
        form = int(prompt) % 5
        if form == 0:
            raise ContentFilteredError("blocked")
        if form == 1 and self.n == 1:
            raise RateLimitError("quota", retry_after=0.001)
        if form == 2 and self.n == 1:
            raise TextGenerationError("no answer")
        return "short" if form == 3 and self.n == 1 else f"An answer that is long enough to be taken for a note: {prompt}"


def _no_wait(seconds: float) -> None:
    """Instead of sleeping."""


@_query("""SELECT count(*) AS prompts, count(*) FILTER (WHERE doc_id % 5 <> 0) AS answered, CAST(sum(CASE doc_id % 5 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) AS BIGINT) AS total_calls,
  CAST(sum(CASE doc_id % 5 WHEN 0 THEN 9 WHEN 2 THEN 1 ELSE 0 END) AS BIGINT) AS failed_calls, count(*) FILTER (WHERE doc_id % 5 = 1) AS limited_calls,
  round(sum(CASE doc_id % 5 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END) * 100.0 / sum(CASE doc_id % 5 WHEN 0 THEN 9 WHEN 2 THEN 2 WHEN 3 THEN 2 ELSE 1 END), 6) AS success_rate FROM documents""")
def client_rates(spark, d):
    """Calls of a client that retries an unsteady generator, a prompt for each document."""
    asked = _read(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("prompt"))
    made = textgen.generate_text(asked, "prompt", "said", textgen.with_retries(_Unsteady(), sleep=_no_wait))
    return _rounded(textgen.client_rates(made, "said"))


# --- Files, templates, whole preparation ---


@_query(f"""WITH {_VALID_SQL}, v AS (SELECT doc_id, 'note_' || strftime(make_timestamp(doc_id * 1000000), '%Y%m%d_%H%M%S') || '_' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) AS note_id, len(crit) = 0 AND score >= 70 AS ok FROM val)
  SELECT row_number() OVER (ORDER BY note_id) - 1 AS pos, note_id, md5(text) AS text_md5, array_to_string([ c.code for c in codes ], ',') AS codes, lang AS profile, CASE WHEN ok THEN 'VALID' ELSE 'INVALID' END AS status
  FROM v JOIN notes USING (doc_id)""")
def save_load_notes(spark, d):
    """Note records saved as one JSON array in many parts, and read back by byte ranges."""
    path = sinks.save_notes(records.serialized(_records(spark, d)), scratch_path(spark, "saved"))
    notes = note_source.normalize_notes(note_source.read_raw_notes(spark, path), ("profile", "generation_profile"))
    return notes.select("pos", "note_id", F.md5("clinical_text").alias("text_md5"), _joined(F.col("icd10_codes"), ",").alias("codes"), "profile", F.try_variant_get("metadata", "$.validation_status", "string").alias("status"))


@_query(f"""WITH {_RAW_SQL} SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, code, name, is_billable, CASE WHEN pos % 3 = 1 THEN NULL ELSE category_name END AS category_name FROM raw""")
def read_catalog(spark, d):
    """Parts written as a catalogue under varying names of the fields, and read by byte ranges."""
    rows, path, form = _raw_catalog(spark, d), scratch_path(spark, "catalog"), F.col("pos") % 3
    named = lambda name, column, *forms: F.when(form.isin(*forms), F.col(column)).alias(name)
    fields = [named("code", "code", 1, 2), named("icd10_code", "code", 0), named("name", "name", 1, 2), named("icd10_name", "name", 0), "is_billable", named("category_description", "category_name", 0), named("category_name", "category_name", 2)]
    lines = rows.select("pos", F.to_json(F.struct(*fields)).alias("item"))  # without fields that are null, which would count
    ends = F.broadcast(rows.agg(F.min("pos").alias("lo"), F.max("pos").alias("hi")))  # one row
    text = F.concat(F.when(F.col("pos") == F.col("lo"), "[").otherwise(""), "item", F.when(F.col("pos") == F.col("hi"), "]").otherwise(","))
    lines.crossJoin(ends).repartitionByRange("pos").sortWithinPartitions("pos").select(text.alias("value")).write.text(path)
    return catalog_source.read_catalog(spark, path).select("pos", "code", "name", "is_billable", "category_name")


_TURN_SQL = {
    "chatml": f"'<|im_start|>system' || chr(10) || '{K.SYSTEM_PROMPT}' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)",
    "gemma": f"'<bos><start_of_turn>user' || chr(10) || '{K.SYSTEM_PROMPT}' || chr(10) || chr(10) || text || '<end_of_turn>' || chr(10) || '<start_of_turn>model' || chr(10)",
}


@_query(f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'phi3' WHEN 1 THEN 'gemma2b' ELSE 'qwen1.5' END AS variant, md5(CASE WHEN doc_id % 3 = 1 THEN {_TURN_SQL['gemma']} ELSE {_TURN_SQL['chatml']} END) AS prompt_md5 FROM documents""")
def model_prompts(spark, d):
    """Every document as a prompt in the template of one of the three models."""
    variant = F.array(*(F.lit(m[0]) for m in K.MODELS))[(F.col("doc_id") % 3).cast("int")]
    rows = _read(spark, d, "documents").select("doc_id", variant.alias("variant"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", "variant", F.md5(chat.model_prompt(F.col("text"), F.col("variant"))).alias("prompt_md5"))


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query()
def cut_prompts(spark, d):
    """Prompts cut at 512 tokens of a real tokenizer."""
    asked = _read(spark, d, "documents").select("doc_id", chat.inference_prompt(F.coalesce("text", F.lit(""))).alias("prompt"))
    cut = tokens.cut_tokens(asked, "prompt", _tokenizer(), 512)
    return cut.select("doc_id", "n_tokens", "kept_tokens", F.length("cut").alias("cut_chars"), F.md5("cut").alias("cut_md5"))


_BAD_SQL = "CASE WHEN doc_id % 7 = 0 THEN 'clinical_text is null' WHEN doc_id % 11 = 0 THEN 'icd10_codes is null' WHEN doc_id % 13 = 0 THEN 'metadata is no object' END"


@_query(f"""WITH {_NOTES_SQL}, b AS (SELECT *, {_BAD_SQL} AS bad FROM notes) SELECT doc_id, 'Note ' || CAST(doc_id AS VARCHAR) || ': ' || bad AS error, CASE WHEN bad IS NULL THEN 3 ELSE 0 END AS n_turns,
  CASE WHEN bad IS NULL THEN md5('Analyze this clinical note:' || chr(10) || chr(10) || text) END AS user_md5 FROM b""")
def convert_batch(spark, d):
    """Notes as samples, some of which can't be: errors stay beside good samples."""
    i = F.col("doc_id")
    notes = _notes(spark, d).select(
        i.alias("note_id"),
        F.when(i % 7 != 0, F.col("text")).alias("clinical_text"),
        F.when(i % 11 != 0, F.transform("codes", lambda c: c["code"])).alias("icd10_codes"),
        F.col("lang").alias("profile"),
        F.parse_json(F.when(i % 13 == 0, "[1]").when(i % 2 == 0, '{"ward": 5}')).alias("metadata"),
    )
    m = F.col("messages")
    return prepare.convert(notes).select(F.col("note_id").alias("doc_id"), "error", F.when(m.isNotNull(), F.size(m)).otherwise(0).alias("n_turns"), F.md5(chat.first_content(m, "user")).alias("user_md5"))


@_query("""WITH l AS (SELECT doc_id, text, list_filter([CASE WHEN doc_id % 2 = 0 THEN 'Patient age: ' || CASE WHEN doc_id % 3 = 0 THEN 'None' ELSE CAST(doc_id % 90 AS VARCHAR) END END,
    CASE WHEN doc_id % 5 < 2 THEN 'Gender: ' || CASE doc_id % 5 WHEN 0 THEN 'female' ELSE 'male' END END, CASE WHEN doc_id % 7 = 0 THEN 'Encounter: ' || source END], lambda x: x IS NOT NULL) AS lines FROM documents)
  SELECT doc_id, md5(array_to_string(lines, chr(10)) || CASE WHEN len(lines) > 0 THEN chr(10) || chr(10) ELSE '' END || 'Analyze this clinical note:' || chr(10) || chr(10) || coalesce(text, '')) AS user_md5 FROM l""")
def context_lines(spark, d):
    """Age, gender and encounter of a note's metadata, null values among them, as lines before the note."""
    i = F.col("doc_id")
    field = lambda when, key, value: F.when(when, F.concat(F.lit(f'"{key}": '), value))
    fields = [
        field(i % 2 == 0, "age", F.when(i % 3 == 0, "null").otherwise((i % 90).cast("string"))),
        field(i % 5 < 2, "gender", F.when(i % 5 == 0, '"female"').otherwise('"male"')),
        field(i % 7 == 0, "encounter_type", F.concat(F.lit('"'), "source", F.lit('"'))),
    ]
    meta = F.parse_json(F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}")))
    rows = _read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), meta.alias("metadata"))
    return rows.select("doc_id", F.md5(chat.user_message(F.col("text"), chat.metadata_context(F.col("metadata")))).alias("user_md5"))


@_query("""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Invalid JSON' WHEN 2 THEN 'JSON missing ''icd10_codes'' key' WHEN 3 THEN 'JSON missing ''icd10_codes'' key' WHEN 4 THEN '''icd10_codes'' must be a list'
  WHEN 5 THEN 'Empty icd10_codes list' WHEN 6 THEN 'Invalid ICD-10 codes: [''x' || CAST(doc_id AS VARCHAR) || ''']' ELSE 'Invalid JSON' END AS error FROM documents""")
def answer_errors(spark, d):
    """Assistant turns with each kind of fault."""
    forms = ['{"icd10_codes": ["I10"]}', '{"icd10_codes": ["I10"', '["I10"]', '{"codes": ["I10"]}', '{"icd10_codes": "I10"}', '{"icd10_codes": []}']
    answer = F.when(F.col("doc_id") % 8 == 6, F.concat(F.lit('{"icd10_codes": ["I10", "x'), F.col("doc_id").cast("string"), F.lit('"]}'))).when(F.col("doc_id") % 8 == 7, "")
    for k, form in enumerate(forms):
        answer = answer.when(F.col("doc_id") % 8 == k, form)
    return _read(spark, d, "documents").select("doc_id", chat.assistant_error(answer).alias("error"))


_LOADED_SQL = """ld AS (SELECT doc_id, lang, codes, text FROM notes WHERE trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')"""


@_query(f"""WITH {_GATE_SQL.replace(_USER_SQL, _USER_SQL.replace("encounter_type", "Encounter"))}, {_LOADED_SQL}, ok AS (SELECT doc_id, lang FROM gate WHERE len(errors) = 0 AND doc_id IN (SELECT doc_id FROM ld)), {_split_sql('ok', 'lang')},
  c AS (SELECT unnest(codes).code AS code FROM ld)
  SELECT 'notes of documents' AS dataset_name, (SELECT count(*) FROM ld) AS total_notes, (SELECT count(*) FROM c) AS total_codes, (SELECT count(DISTINCT code) FROM c) AS unique_codes, round((SELECT count(*) FROM c) / (SELECT count(*) FROM ld), 6) AS avg_codes_per_note,
  min(length(text)) AS min_chars, max(length(text)) AS max_chars, round(avg(length(text)), 6) AS mean_chars, list_sort(list(length(text)))[count(*) // 2 + 1] AS median_chars, count(*) AS total_samples, (SELECT count(*) FROM ok) AS valid_samples,
  count(*) - (SELECT count(*) FROM ok) AS invalid_samples, (SELECT count(*) FROM spl WHERE split = 'train') AS n_train, (SELECT count(*) FROM spl WHERE split = 'validation') AS n_validation FROM ld""")
def prepare_summary(spark, d):
    """A raw file of notes loaded, summed up, converted, gated, split and written: all numbers of the summary."""
    raw = _notes(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("narrative"), F.transform("codes", lambda c: c["code"]).alias("codes"), F.col("lang").alias("profile"), F.col("lang").alias("encounter_type"))
    path = scratch_path(spark, "raw")
    sinks.write_json_array(raw, f"{path}/notes of documents.json", "id")
    done = prepare.prepare_dataset(spark, f"{path}/notes of documents.json", f"{path}/out", "drop")
    kinds = "dataset_name string, total_notes long, total_codes long, unique_codes long, avg_codes_per_note double, min_chars long, max_chars long, mean_chars double, median_chars long, total_samples long, valid_samples long, invalid_samples long, n_train long, n_validation long"
    return _rounded(spark.createDataFrame([done.row()], kinds))


# --- Fixed classes and lists of unequal length ---

_FIXED_SQL = """lab AS (SELECT DISTINCT p_brand AS label FROM part WHERE p_brand <> 'Brand#3' UNION SELECT 'none-' || r_name FROM region),
fix AS (SELECT label, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(precision, 0) AS precision, coalesce(recall, 0) AS recall, coalesce(f1, 0) AS f1 FROM lab LEFT JOIN cls USING (label))"""


def _labels(spark, d) -> DataFrame:
    """Classes: all brands but one, and some that never occur."""
    brands = _read(spark, d, "part").select(F.col("p_brand").alias("label")).where("label <> 'Brand#3'")
    return brands.unionAll(_read(spark, d, "region").select(F.concat(F.lit("none-"), "r_name").alias("label"))).distinct()


@_query(f"WITH {_PAIRS_SQL}, {_FIXED_SQL} SELECT {_ROUNDED} FROM fix")
def eval_fixed_labels(spark, d):
    """Per class over a fixed list of classes, of which some never occur."""
    return _rounded(metrics.per_class(_pairs(spark, d), _labels(spark, d)))


_SUMMED_SQL = """round(tp / (tp + fp), 6) AS precision_micro, round(tp / (tp + fn), 6) AS recall_micro, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_micro, round(pm, 6) AS precision_macro, round(rm, 6) AS recall_macro, round(fm, 6) AS f1_macro"""
_TOTAL_SQL = "a AS (SELECT count(*) AS num_classes, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, avg(precision) AS pm, avg(recall) AS rm, avg(f1) AS fm FROM {0})"


@_query(f"""WITH {_PAIRS_SQL}, {_FIXED_SQL}, {_TOTAL_SQL.format("fix")} SELECT (SELECT count(*) FROM pr) AS num_samples, round((SELECT count(*) FILTER (WHERE p = t) / count(*) FROM pr), 6) AS exact_match_accuracy, num_classes, {_SUMMED_SQL} FROM a""")
def eval_fixed_summary(spark, d):
    """The rates over these classes: those that never occur count as zeros in the macro rates."""
    return _rounded(metrics.summary(_pairs(spark, d), _labels(spark, d)))


@_query(f"""WITH {_PAIRS_SQL.replace("FROM pairs)", "FROM pairs WHERE i % 3 <> 0 AND i % 5 <> 0)")}, {_TOTAL_SQL.format("cls")}, np AS (SELECT count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 3 <> 0)
  SELECT n AS num_samples, round((SELECT count(*) FILTER (WHERE p = t) FROM pr) / n, 6) AS exact_match_accuracy, num_classes, {_SUMMED_SQL} FROM a, np""")
def eval_zip_summary(spark, d):
    """Lists of unequal length: exact matches are a share of the predictions."""
    pairs = _pairs(spark, d)
    return _rounded(metrics.zip_summary(pairs.where(F.col("index") % 3 != 0), pairs.where(F.col("index") % 5 != 0)))


@_query(f"""WITH {_CAT_SQL}, t AS (SELECT DISTINCT substr(p_name, CAST(1 + p_partkey % 5 AS INTEGER), CAST(p_partkey % 6 AS INTEGER)) AS term FROM part) SELECT term, count(*) AS n_codes, min(ord) AS first_ord
  FROM cat JOIN t ON contains(lower(cat.name), lower(term)) OR contains(lower(coalesce(category_name, '')), lower(term)) GROUP BY term""")
def term_search(spark, d):
    """Terms of 0 to 5 characters looked up in the catalogue by their rarest trigram."""
    terms = _read(spark, d, "part").select(F.substring(F.col("p_name"), (1 + F.col("p_partkey") % 5).cast("int"), (F.col("p_partkey") % 6).cast("int")).alias("term")).distinct()
    return sampling.term_hits(_catalog(spark, d), terms).groupBy("term").agg(F.count("*").alias("n_codes"), F.min("ord").alias("first_ord"))
