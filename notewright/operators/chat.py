"""Chat samples: messages from notes, structure and token gates, dataset validation, text for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright import constants as K
from notewright.functions.parsing import is_valid_code, strict_json
from notewright.functions.text import json_codes, strip, token_estimate


def user_message(text: Column, context: list[tuple[str, Column, Column]] | None = None) -> Column:
    """The user's turn; ``context`` lists (label, is present, value) lines put before it, a null value as "None"."""
    lines = [F.when(present, F.concat(F.lit(f"{label}: "), F.coalesce(value.cast("string"), F.lit("None")))) for label, present, value in context or []]
    body = F.concat(F.lit(K.USER_PREFIX), text)
    if not lines:
        return body
    said = F.concat_ws("\n", *lines)
    return F.when(said == "", body).otherwise(F.concat(said, F.lit("\n\n"), body))


def metadata_context(metadata: Column) -> list[tuple[str, Column, Column]]:
    """Context lines of what a note's metadata (variant) tells of age, gender and encounter; a key whose value is null counts."""
    fields = F.coalesce(F.try_variant_get(metadata, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))

    def line(label: str, key: str):
        value = F.try_variant_get(metadata, f"$.{key}", "string")
        kind = F.schema_of_variant(F.try_variant_get(metadata, f"$.{key}", "variant"))
        return label, F.map_contains_key(fields, key), F.when(kind == "BOOLEAN", F.initcap(value)).otherwise(value)

    return [line(label, key) for label, key in K.CONTEXT_LINES.items()]


def to_messages(user: Column, codes: Column, system: str = K.SYSTEM_PROMPT) -> Column:
    """array<struct<role, content>> of system, user and assistant."""
    turns = (("system", F.lit(system)), ("user", user), ("assistant", json_codes(codes)))
    return F.array(*(F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in turns))


def sample_metadata(profile: Column, codes: Column, metadata: Column) -> Column:
    """A sample's metadata (variant): profile, num_codes and the note's own fields, which win where names clash.

    Metadata that is null or no object adds nothing.
    """
    more = F.coalesce(F.try_variant_get(metadata, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    own = F.create_map(F.lit("profile"), profile.cast("variant"), F.lit("num_codes"), F.coalesce(F.size(codes), F.lit(0)).cast("variant"))
    return F.to_variant_object(F.map_concat(F.map_filter(own, lambda k, v: ~F.map_contains_key(more, k)), more))


def structure_error(messages: Column) -> Column:
    """The first fault of a sample's structure; null if it has none: three turns, their roles in order, none blank."""
    roles = F.transform(messages, lambda m: m["role"])
    blank = F.filter(F.transform(messages, lambda m, i: F.struct(i.alias("i"), m["role"].alias("role"), strip(F.coalesce(m["content"], F.lit(""))).alias("c"))), lambda m: m["c"] == "")
    first = F.try_element_at(blank, F.lit(1))
    listed = F.concat(F.lit("['"), F.array_join(roles, "', '"), F.lit("']"))
    return (
        F.when(F.size(messages) != 3, F.concat(F.lit("Expected 3 messages, got "), F.size(messages).cast("string")))
        .when(roles != F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), F.concat(F.lit("Expected roles ['system', 'user', 'assistant'], got "), listed))
        .when(F.size(blank) > 0, F.concat(F.lit("Message "), first["i"].cast("string"), F.lit(" ("), first["role"], F.lit(") has empty content")))
    )


def assistant_error(content: Column) -> Column:
    """The first fault of the assistant's JSON; null if it has none."""
    doc = strict_json(content)
    kind = F.schema_of_variant(doc)
    inner = F.try_variant_get(doc, "$.icd10_codes", "variant")
    codes = F.try_variant_get(doc, "$.icd10_codes", "array<string>")
    bad = F.filter(codes, lambda c: ~is_valid_code(c))
    return (
        F.when(doc.isNull(), "Invalid JSON")
        .when(~kind.startswith("OBJECT") | inner.isNull(), "JSON missing 'icd10_codes' key")
        .when(~F.schema_of_variant(inner).startswith("ARRAY"), "'icd10_codes' must be a list")
        .when(F.size(codes) == 0, "Empty icd10_codes list")
        .when(F.size(bad) > 0, F.concat(F.lit("Invalid ICD-10 codes: ['"), F.array_join(bad, "', '"), F.lit("']")))
    )


def token_error(messages: Column, max_tokens: int, overhead: float = 1.2) -> Column:
    """A fault if the estimated tokens, with overhead, are more than ``max_tokens``."""
    joined = F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), "\n")
    n = F.floor(token_estimate(joined) * F.lit(overhead)).cast("long")
    return F.when(n > max_tokens, F.concat(F.lit("Estimated "), n.cast("string"), F.lit(f" tokens exceeds max_seq_length={max_tokens}")))


def sample_errors(messages: Column, max_tokens: int = 512, strict: bool = True) -> Column:
    """All faults of a sample; ``strict`` stops at a structural one."""
    structure = structure_error(messages)
    answer = F.try_element_at(messages, F.lit(3))["content"]
    label = lambda name, e: F.concat(F.lit(name + ": "), e)
    rest = F.array_compact(F.array(label("Assistant JSON", assistant_error(answer)), label("Token length", token_error(messages, max_tokens))))
    own = F.array(label("Structure", structure))
    return F.when(structure.isNull(), rest).otherwise(own if strict else F.concat(own, rest))


def keep_valid(samples: DataFrame, max_tokens: int = 512) -> DataFrame:
    """Samples without a fault."""
    return samples.where(F.size(sample_errors(F.col("messages"), max_tokens)) == 0)


def dataset_stats(samples: DataFrame, max_tokens: int = 512) -> DataFrame:
    """total_samples, valid_samples, invalid_samples."""
    ok = F.size(sample_errors(F.col("messages"), max_tokens)) == 0
    return samples.select(ok.alias("ok")).agg(F.count("*").alias("total_samples"), F.count_if("ok").alias("valid_samples"), F.count_if(~F.col("ok")).alias("invalid_samples"))


def dataset_errors(samples: DataFrame, max_tokens: int = 512, pos: str = "pos") -> DataFrame:
    """note_id and errors of each faulty sample; of repeated ids the last one's."""
    faulty = samples.select("note_id", pos, sample_errors(F.col("messages"), max_tokens).alias("errors")).where(F.size("errors") > 0)
    return faulty.groupBy("note_id").agg(F.max_by("errors", pos).alias("errors"))


def templated(messages: Column, template: str = "chatml", to_answer: bool = False) -> Column:
    """Messages as the text of a template of ``constants.TEMPLATES``; with ``to_answer`` open for the assistant's turn.

    Where a template has no system turn, that text and a blank line go before the next message's.
    """
    if template not in K.TEMPLATES:
        raise ValueError(f"unknown template {template!r}; one of {list(K.TEMPLATES)}")
    t = K.TEMPLATES[template]
    role = lambda m: F.coalesce(*(F.when(m["role"] == a, b) for a, b in t["roles"].items()), m["role"])
    if not t["system_turn"]:
        told = F.filter(messages, lambda m: m["role"] == "system")
        rest = F.filter(messages, lambda m: m["role"] != "system")
        before = F.array_join(F.transform(told, lambda m: F.concat(m["content"], F.lit("\n\n"))), "")
        messages = F.transform(rest, lambda m, i: F.struct(m["role"].alias("role"), F.concat(F.when(i == 0, before).otherwise(""), m["content"]).alias("content")))
    turns = F.transform(messages, lambda m: F.concat(F.lit(t["begin"]), role(m), F.lit(t["after_role"]), m["content"], F.lit(t["end"])))
    return F.concat(F.lit(t["start"]), F.array_join(turns, t["between"]), F.lit(t["open"] if to_answer else ""))


def chatml_text(messages: Column) -> Column:
    """Messages as ChatML text."""
    return templated(messages)


def inference_prompt(user: Column, system: str = K.SYSTEM_PROMPT, max_tokens: int | None = None, template: str = "chatml") -> Column:
    """A system and a user turn as a template's text, open for the assistant's; cut at ``max_tokens`` estimated tokens
    (``tokens.cut_tokens`` cuts at real ones)."""
    turns = F.array(*(F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in (("system", F.lit(system)), ("user", user))))
    text = templated(turns, template, to_answer=True)
    return text if max_tokens is None else F.substring(text, 1, 4 * max_tokens)


def model_prompt(user: Column, variant: Column, system: str = K.SYSTEM_PROMPT) -> Column:
    """``inference_prompt`` in the template of each row's model (of ``constants.MODELS``); null for an unknown one."""
    by_template: dict[str, list[str]] = {}
    for m in K.MODELS:
        by_template.setdefault(m[8], []).append(m[0])
    return F.coalesce(*(F.when(variant.isin(*names), inference_prompt(user, system, template=t)) for t, names in by_template.items()))


def first_content(messages: Column, role: str) -> Column:
    """The content of the first message of a role; null if there is none."""
    return F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(1))["content"]
