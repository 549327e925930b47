"""Seeded selection of codes: uniform, and guided by a profile.

Order by md5(seed-key) stands for a shuffle: exact sizes, the same on any cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.constants import PROFILES
from notewright.errors import InsufficientCodesError

#: Profiles with their hits are broadcast, so their number has a bound.
MAX_PROFILES = 10_000


def shuffle_key(seed: int | str, *parts: Column) -> Column:
    """The place of a row in a seeded shuffle."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *(p.cast("string") for p in parts)))


def seeded_rank(rows: DataFrame, mark: Column, by: list[str], tie: list[str], salts: int = 64) -> DataFrame:
    """Adds rank (from 1) in order of ``mark``, a hex hash, and size, the number of rows; both within ``by``.

    Ranges of the hash's first bits are ranked apart and shifted by the counts of the ranges before, so a group
    that holds most rows is ``salts`` tasks, not one.
    """
    part = F.floor(F.conv(F.substring("_mark", 1, 4), 16, 10).cast("int") * salts / 65536).cast("int")
    keyed = rows.withColumn("_mark", mark).withColumn("_part", part)
    group = [F.col(c) for c in by] or [F.lit(0)]
    sizes = keyed.groupBy(*by, "_part").agg(F.count("*").alias("_n"))  # at most salts rows a group
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*(F.col(c).alias("_" + c) for c in by), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy(*group)).alias("size"))
    own = keyed.withColumn("_own", F.row_number().over(Window.partitionBy(*by, "_part").orderBy("_mark", *tie)))
    same = F.col("_part") == F.col("_p")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col("_" + c))
    return own.join(sizes, same).select(*rows.columns, (F.col("_before") + F.col("_own")).alias("rank"), "size")


def random_billable(catalog: DataFrame, count: int, seed: int = 42, category: str | None = None, strict: bool = True) -> DataFrame:
    """``count`` billable codes without replacement; an error if there are fewer (unless not ``strict``)."""
    if count <= 0:
        raise ValueError("count must be positive")
    rows = catalog.where(F.col("is_billable"))
    if category:
        rows = rows.where(F.col("category_name") == category)
    if strict and rows.limit(count).count() < count:
        raise InsufficientCodesError("too few billable codes", wanted=count)
    return rows.orderBy(shuffle_key(seed, F.col("code")), "code").limit(count)


def codes_per_note(notes: DataFrame, low: int = 2, high: int = 5, seed: int = 42, key: str = "note_idx") -> DataFrame:
    """Adds n_codes: a draw from ``low`` to ``high``, both included."""
    draw = F.conv(F.substring(shuffle_key(seed, F.col(key)), 1, 8), 16, 10).cast("long") % (high - low + 1)
    return notes.withColumn("n_codes", (F.lit(low) + draw).cast("int"))


def profile_table(spark) -> DataFrame:
    """The profiles: profile, description, primary_search_terms, comorbidity_ratio, comorbidity_terms."""
    schema = "profile string, description string, primary_search_terms array<string>, comorbidity_ratio double, comorbidity_terms array<string>"
    return spark.createDataFrame([(k, *v) for k, v in PROFILES.items()], schema)


def _grams(text: Column, size: Column | int) -> Column:
    """The distinct substrings of ``size`` characters; for 0 the empty one."""
    size = size if isinstance(size, Column) else F.lit(size)
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, size)))


def term_hits(catalog: DataFrame, terms: DataFrame, size: int = 3) -> DataFrame:
    """(term, code, ord): the codes whose name or category holds a term (of ``terms``), in any case, literally.

    The catalogue's substrings of ``size`` characters (fewer for shorter terms) that occur in terms are its index; a term is
    looked up by its rarest one, and what is found is compared in full.  Terms are few enough to be broadcast.
    """
    asked = terms.select("term", F.lower("term").alias("_low")).where(F.col("term").isNotNull())
    pieces = asked.select("term", "_low", F.explode(_grams(F.col("_low"), F.least(F.length("_low"), F.lit(size)))).alias("gram"))
    lengths = [r["n"] for r in asked.select(F.least(F.length("_low"), F.lit(size)).alias("n")).distinct().collect()]  # four values at most
    rows = catalog.select("code", "ord", F.lower(F.coalesce("name", F.lit(""))).alias("n"), F.lower(F.coalesce("category_name", F.lit(""))).alias("c"))
    parts = [_grams(F.col(t), k) for t in ("n", "c") for k in lengths] or [F.array().cast("array<string>")]
    wanted = F.broadcast(pieces.select("gram").distinct())
    index = rows.select("*", F.explode(F.array_distinct(F.flatten(F.array(*parts)))).alias("gram")).join(wanted, "gram", "left_semi")
    frequent = index.groupBy("gram").agg(F.count("*").alias("n_codes"))
    rarest = pieces.join(frequent, "gram", "left").groupBy("term", "_low").agg(F.min_by("gram", F.struct(F.coalesce("n_codes", F.lit(0)), "gram")).alias("gram"))
    found = index.join(F.broadcast(rarest), "gram").where(F.expr("contains(n, _low) OR contains(c, _low)"))
    return found.select("term", "code", "ord")


def _profile_hits(profiles: DataFrame, catalog: DataFrame, per_term: int) -> DataFrame:
    """profile, ratio, primary, comorbid: each term with the codes of its first ``per_term`` hits in catalogue order."""
    if profiles.limit(MAX_PROFILES + 1).count() > MAX_PROFILES:
        raise ValueError(f"more than {MAX_PROFILES} profiles")
    none = F.array().cast("array<string>")
    asked = profiles.select("profile", "comorbidity_ratio", F.coalesce("primary_search_terms", none).alias("p"), F.coalesce("comorbidity_terms", none).alias("c"))
    distinct = asked.select(F.explode(F.concat("p", "c")).alias("term")).distinct()
    hits = term_hits(catalog.where("is_billable"), distinct)
    hits = hits.withColumn("hit", F.row_number().over(Window.partitionBy("term").orderBy("ord"))).where(F.col("hit") <= per_term)
    listed = hits.groupBy("term").agg(F.array_sort(F.collect_list(F.struct("hit", "code"))).alias("h"))
    found = listed.agg(F.map_from_entries(F.collect_list(F.struct("term", F.col("h.code")))).alias("hits"))  # one row
    with_codes = lambda terms: F.transform(terms, lambda t: F.struct(t.alias("term"), F.coalesce(F.try_element_at("hits", t), none).alias("codes")))
    guided = F.size("p") > 0
    return asked.crossJoin(F.broadcast(found)).select(
        "profile",
        F.when(guided, F.coalesce("comorbidity_ratio", F.lit(0.0))).otherwise(0.0).alias("ratio"),
        with_codes("p").alias("primary"),
        F.when(guided, with_codes("c")).alias("comorbid"),
    )


def _in_seeded_order(terms: str, seed: int, per_term: int) -> Column:
    """The distinct codes of a request's terms, terms in its own seeded order, of each the first ``per_term``."""
    placed = F.transform(F.coalesce(terms, F.array()), lambda t: F.struct(shuffle_key(seed, F.col("note_idx"), t["term"]).alias("k"), t["term"].alias("term"), t["codes"].alias("codes")))
    return F.array_distinct(F.flatten(F.transform(F.array_sort(placed), lambda t: F.slice(t["codes"], 1, per_term))))


def select_for_profiles(requests: DataFrame, catalog: DataFrame, profiles: DataFrame, seed: int = 42, primary_hits: int = 10, comorbid_hits: int = 5) -> DataFrame:
    """Codes of each request (note_idx, profile, n_codes): note_idx, code, place, part (primary, comorbid, fill).

    A share of the codes, cut to a whole number, is for comorbidities.  Terms are tried in a seeded order, each with
    its first hits in catalogue order; what is short is filled from the other billable codes in seeded order.
    An unknown profile, or one without terms, is filled alone.  A request may get fewer codes than it asks for
    only if the catalogue has fewer.  ``note_idx`` is unique; there are at most ``MAX_PROFILES`` profiles.

    The hits of all terms are found once; a request then chooses among those of its profile without a shuffle, and
    only what is left to fill meets the catalogue, by its place in a shuffle of it.
    """
    guide = F.broadcast(_profile_hits(profiles, catalog, max(primary_hits, comorbid_hits)))
    asked = requests.join(guide, "profile", "left")
    share = F.floor(F.col("n_codes") * F.coalesce("ratio", F.lit(0.0))).cast("int")
    primary = F.slice(_in_seeded_order("primary", seed, primary_hits), 1, F.greatest(F.col("n_codes") - share, F.lit(0)))
    asked = asked.select("note_idx", "n_codes", share.alias("share"), primary.alias("first"), "comorbid")
    other = F.slice(F.array_except(_in_seeded_order("comorbid", seed + 1, comorbid_hits), "first"), 1, F.greatest("share", F.lit(0)))
    asked = asked.select("note_idx", "n_codes", "first", other.alias("second"))

    named = lambda codes, part: F.transform(codes, lambda c, i: F.struct(c.alias("code"), (i + 1).alias("place"), F.lit(part).alias("part")))
    chosen = asked.select("note_idx", F.inline(F.concat(named("first", "primary"), named("second", "comorbid"))))

    # The fill is drawn at seeded places of the shuffled billable codes, a note's own; where draws fall on codes it has,
    # it goes on from the last place.  No note meets the whole catalogue.
    codes = catalog.where("is_billable").select("code")
    ring = seeded_rank(codes, shuffle_key(seed, F.col("code")), [], ["code"])
    shuffled = ring.select("code", (F.col("rank") - 1).cast("int").alias("at"))
    short = asked.select("note_idx", "n_codes", F.concat("first", "second").alias("have")).withColumn("need", F.col("n_codes") - F.size("have")).where("need > 0")
    drawn = lambda *by: F.conv(F.substring(shuffle_key(seed, F.col("note_idx"), *by), 1, 8), 16, 10).cast("long")
    spots = short.withColumn("step", F.explode(F.sequence(F.lit(0), 4 * F.col("n_codes") - 1)))
    spot = F.when(F.col("step") < 2 * F.col("n_codes"), drawn(F.col("step").cast("string"))).otherwise(drawn() + F.col("step"))
    size = F.broadcast(codes.agg(F.count("*").alias("size")).where("size > 0"))  # one row at most
    fill = spots.crossJoin(size).withColumn("at", (spot % F.col("size")).cast("int")).join(shuffled, "at")
    fill = fill.groupBy("note_idx").agg(F.array_sort(F.collect_list(F.struct("step", "code"))).alias("f"), F.first("have").alias("have"), F.first("need").alias("need"))
    rest = F.slice(F.array_except(F.col("f.code"), "have"), 1, F.col("need"))
    return chosen.unionByName(fill.select("note_idx", F.inline(named(rest, "fill"))))


class Selector:
    """Selection strategies by name; each takes (requests, catalog) and gives (note_idx, code, ...)."""

    def __init__(self, catalog: DataFrame, seed: int = 42):
        self.catalog, self.seed = catalog, seed
        spark = catalog.sparkSession
        none = spark.createDataFrame([], profile_table(spark).schema)
        self.strategies: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
            "profile_based": lambda r, c: select_for_profiles(r, c, profile_table(spark), self.seed),
            "random": lambda r, c: select_for_profiles(r, c, none, self.seed),
        }

    def register(self, name: str, strategy: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        self.strategies[name] = strategy

    def select(self, requests: DataFrame, strategy: str = "profile_based") -> DataFrame:
        if strategy not in self.strategies:
            raise ValueError(f"unknown strategy: {strategy}")
        return self.strategies[strategy](requests, self.catalog)
