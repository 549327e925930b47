"""Sanitising of notes and rule-based checks, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright import constants as K
from notewright.functions.text import first_character, keyword, quoted, strip, windows_before


def sanitize(text: Column, codes: Column) -> Column:
    """struct<text, removed>: codes taken out, each with the brackets and white space around it, in their order.

    Then any code-like word goes, runs of blanks shrink, empty brackets and a line's leading colon go.
    """

    def out(state: Column, pattern) -> Column:
        found = F.size(F.regexp_extract_all(state["text"], pattern, F.lit(0)))
        return F.struct(F.regexp_replace(state["text"], pattern, F.lit("")).alias("text"), (state["removed"] + found).alias("removed"))

    def one(state: Column, code: Column) -> Column:
        """Without one code; its pattern is tried only on a text that holds it in some case."""
        holds = F.lower(state["text"]).contains(F.lower(code)) | F.upper(state["text"]).contains(F.upper(code))
        return F.when(holds, out(state, F.concat(F.lit(r"(?iu)[\(\[\s]*"), quoted(code), F.lit(r"[\)\]\s]*")))).otherwise(state)

    def rest(state: Column) -> Column:
        general = F.regexp_replace(state["text"], K.CODE_SANITIZE, "")
        clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(general, r" {2,}", " "), r"\(\s*\)|\[\s*\]", ""), r"(?m)^\s*:\s*", "")
        found = F.size(F.regexp_extract_all(state["text"], F.lit(K.CODE_SANITIZE), F.lit(0)))
        return F.struct(strip(clean).alias("text"), (state["removed"] + found).alias("removed"))

    return F.aggregate(codes, F.struct(text.alias("text"), F.lit(0).alias("removed")), one, rest)


def code_visibility(text: Column, codes: Column) -> Column:
    """Critical issues: assigned codes standing in the text in any case, and other dotted codes (sorted)."""
    seen = F.filter(codes, lambda c: F.upper(text).contains(F.upper(c["code"])))
    own = F.transform(seen, lambda c: F.concat(F.lit("CODE_LEAKAGE: ICD-10 code '"), c["code"], F.lit("' appears in note text")))
    other = F.array_sort(F.array_except(F.regexp_extract_all(text, F.lit(K.CODE_LEAK), F.lit(0)), F.transform(codes, lambda c: c["code"])))
    return F.concat(own, F.transform(other, lambda m: F.concat(F.lit("CODE_LEAKAGE: Unexpected ICD-10 code pattern '"), m, F.lit("' in text"))))


def minimum_length(text: Column, least: int = K.MIN_NOTE_CHARS) -> Column:
    """A critical issue if the stripped text is short; the message gives the unstripped length."""
    said = F.concat(F.lit("NOTE_TOO_SHORT: Note is "), F.length(text).cast("string"), F.lit(f" chars, minimum is {least}"))
    return F.when(F.length(strip(text)) < least, F.array(said)).otherwise(F.array().cast("array<string>"))


#: Characters before a key word in which a cue counts.
NEGATION_WIDTH, UNCERTAINTY_WIDTH = 60, 50


def cues(text: Column, codes: Column) -> Column:
    """array<struct<code, word, negated, uncertain>>: each code's key word (null without one), and whether some place of it
    in the text has a cue of negation, or of uncertainty, shortly before it.  Each key word's places are found once for both.
    """
    low = F.lower(text)
    any_negation, any_uncertainty = low.rlike(K.NEGATION), low.rlike(K.UNCERTAINTY)  # most texts lack one or both

    def of(c: Column) -> Column:
        word = keyword(c["name"])
        windows = F.when(word.isNotNull() & low.contains(word) & (any_negation | any_uncertainty), windows_before(low, word, NEGATION_WIDTH))
        flags = F.aggregate(
            windows,
            F.struct(F.lit(False).alias("negated"), F.lit(False).alias("uncertain")),
            lambda s, w: F.struct((s["negated"] | w.rlike(K.NEGATION)).alias("negated"), (s["uncertain"] | F.right(w, F.lit(UNCERTAINTY_WIDTH)).rlike(K.UNCERTAINTY)).alias("uncertain")),
        )
        return F.struct(c["code"].alias("code"), word.alias("word"), flags.alias("flags"))

    return F.transform(codes, of)


def negation_warnings(cues: Column) -> Column:
    """Warnings for diagnoses that may be negated; one per code at most."""
    found = F.filter(cues, lambda c: F.coalesce(c["flags"]["negated"], F.lit(False)))
    return F.transform(found, lambda c: F.concat(F.lit("POSSIBLE_NEGATION: '"), c["word"], F.lit("' may be negated (code: "), c["code"], F.lit(")")))


def uncertainty_warnings(cues: Column) -> Column:
    """Warnings for definitive codes under uncertain language; symptoms (R) and factors (Z) are let pass."""
    found = F.filter(cues, lambda c: F.coalesce(c["flags"]["uncertain"], F.lit(False)) & ~first_character(c["code"]).isin("R", "Z"))
    return F.transform(found, lambda c: F.concat(F.lit("UNCERTAIN_DIAGNOSIS: '"), c["word"], F.lit("' has uncertainty language but "), c["code"], F.lit(" is definitive")))


def negation(text: Column, codes: Column) -> Column:
    """``negation_warnings`` of a text."""
    return negation_warnings(cues(text, codes))


def uncertainty(text: Column, codes: Column) -> Column:
    """``uncertainty_warnings`` of a text."""
    return uncertainty_warnings(cues(text, codes))


def validate(notes: DataFrame, text: str = "text", codes: str = "codes", threshold: float = K.PASS_CONFIDENCE) -> DataFrame:
    """Adds validation_result: is_valid, confidence_score, critical_issues, warnings, validation_source.

    Any critical issue makes a note invalid with confidence 0; else each warning costs 10 of 100.
    """
    t, c = F.col(text), F.col(codes)
    checked = notes.withColumn("_critical", F.concat(code_visibility(t, c), minimum_length(t))).withColumn("_cues", cues(t, c))
    checked = checked.withColumn("_warnings", F.concat(negation_warnings(F.col("_cues")), uncertainty_warnings(F.col("_cues"))))
    clean = F.size("_critical") == 0
    score = F.when(clean, F.greatest(F.lit(0), 100 - K.WARNING_COST * F.size("_warnings"))).otherwise(0).cast("double")
    result = F.struct((clean & (score >= threshold)).alias("is_valid"), score.alias("confidence_score"), F.col("_critical").alias("critical_issues"), F.col("_warnings").alias("warnings"), F.lit("rule_based").alias("validation_source"))
    return checked.withColumn("validation_result", result).drop("_critical", "_cues", "_warnings")
