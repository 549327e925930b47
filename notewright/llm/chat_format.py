"""Chat formatting as a finite-state machine over roles, in DataFrame functions only.

A declarative template gives, for each role, the text before and after a turn
and whether its text counts for the loss; a transition table gives the order of
roles that is valid.  Control strings inside texts are escaped reversibly, so
the formatted conversation can be read back exactly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Roles by name; ``other`` (its role name stands between its two marks) takes every other role.

    Every ``before`` must start, and every ``after`` must end, with one of ``control``; a text is escaped by
    doubling ``\\`` and putting one behind the first character of each control string inside it.
    """

    roles: dict[str, Role] = field(
        default_factory=lambda: {
            "system": Role("<<SYS>>\n", "\n<</SYS>>"),
            "user": Role("[INST] ", " [/INST]"),
            "assistant": Role("<s> ", " </s>", loss=True),
        }
    )
    other: tuple[str, str, str] = ("[ROLE] ", " [=] ", " [/ROLE]")
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[=]", "[/ROLE]")
    #: Valid transitions; "" is the start, and ``final`` the states in which a conversation may end.
    transitions: tuple[tuple[str, str], ...] = (("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"))
    final: tuple[str, ...] = ("user", "assistant")


DEFAULT = Template()


def _quote(s: str) -> str:
    return "\\Q" + s + "\\E"


def escape(text: Column, template: Template = DEFAULT) -> Column:
    """Double each backslash, then break every control string with one."""
    tails = "|".join(f"(?<={_quote(c[0])})(?={_quote(c[1:])})" for c in template.control)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), tails, "\\\\")


def unescape(text: Column) -> Column:
    """The text whose ``escape`` is ``text``."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_segments(role: Column, text: Column, template: Template = DEFAULT) -> Column:
    """A turn as segments array<struct<text, loss>>: mark, escaped text, mark; the loss flag is the text's alone."""

    def segments(before: Column, after: Column, loss: bool) -> Column:
        parts = ((before, False), (escape(text, template), loss), (after, False))
        return F.array(*(F.struct(t.alias("text"), F.lit(flag).alias("loss")) for t, flag in parts))

    opened, between, closed = template.other
    chosen = None
    for name, r in template.roles.items():
        own = segments(F.lit(r.before), F.lit(r.after), r.loss)
        chosen = F.when(role == name, own) if chosen is None else chosen.when(role == name, own)
    return chosen.otherwise(segments(F.concat(F.lit(opened), escape(role, template), F.lit(between)), F.lit(closed), False))


def is_valid(roles: Column, template: Template = DEFAULT) -> Column:
    """Run the machine over an array of roles: true if every transition exists and the last state is final."""
    allowed = F.array(*(F.lit(f"{a}>{b}") for a, b in template.transitions))
    steps = F.transform(roles, lambda r, i: F.concat(F.when(i == 0, "").otherwise(F.try_element_at(roles, i)), F.lit(">"), r))
    return F.forall(steps, lambda s: F.array_contains(allowed, s)) & F.coalesce(F.try_element_at(roles, F.lit(-1)).isin(*template.final), F.lit(False))


def format_conversations(conversations: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conv_id: conv_id, valid, segments array<struct<text, loss>>, formatted (their texts joined).

    ``conversations`` has conv_id, turn, role, text.  Turns are in order of turn (nulls first), ties by role,
    then text; repeated rows are repeated turns.  A null text or role is empty.  A null conv_id is one
    conversation of its own.  An order of roles that the machine rejects is formatted all the same, with valid
    false; a role the template does not name is written with its name.  Other columns are ignored.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    grouped = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segments = F.flatten(F.transform("turns", lambda t: turn_segments(t["role"], t["text"], template)))
    out = grouped.select("conv_id", is_valid(F.col("turns.role"), template).alias("valid"), segments.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """The turns of formatted conversations: adds turns array<struct<role, text, loss>>, from ``formatted`` alone."""
    opened, between, closed = template.other
    ways = {name: (r.before, r.after) for name, r in template.roles.items()} | {"": (opened, closed)}
    pattern = "(?s)" + "|".join(f"{_quote(a)}.*?{_quote(b)}" for a, b in ways.values())

    def turn(raw: Column) -> Column:
        def made(role: Column, text: Column, loss: bool) -> Column:
            return F.struct(unescape(role).alias("role"), unescape(text).alias("text"), F.lit(loss).alias("loss"))

        def inner(a: str, b: str) -> Column:
            return F.substring(raw, F.lit(len(a) + 1), F.length(raw) - len(a) - len(b))

        rest = inner(opened, closed)
        at = F.instr(rest, between)
        other = made(F.substring(rest, F.lit(1), at - 1), F.substring(rest, at + len(between), F.length(rest)), False)
        chosen = None
        for name, r in template.roles.items():
            own = made(F.lit(name), inner(r.before, r.after), r.loss)
            chosen = F.when(raw.startswith(r.before), own) if chosen is None else chosen.when(raw.startswith(r.before), own)
        return chosen.otherwise(other)

    raws = F.regexp_extract_all("formatted", F.lit(pattern), F.lit(0))
    return formatted.withColumn("turns", F.transform(raws, turn))


def digest(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """What the formatted text says when read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid."""
    read = read_back(formatted, template)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


#: The same result in SQL, under the default template.
ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, regexp_replace(replace(text, '\', '\\'), '(<)(<SYS>>|</SYS>>|/s>|s>)|(\[)(/INST\]|INST\]|/ROLE\]|ROLE\]|=\])', '\1\3\\\2\4', 'g') AS esc FROM t),
f AS (SELECT *, length(esc) + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
    ELSE 21 + length(role) END AS chars,
    lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) || '>' || role AS step,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) AS back FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(step IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user'))
    AND bool_or(back = 1 AND role IN ('user', 'assistant')) AS valid
FROM f GROUP BY conv_id
"""
