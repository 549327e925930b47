"""Catalogue operators: dedup, counts, keys, lookups and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.errors import CodeNotFoundError
from notewright.functions.text import first_character


def dedup(rows: DataFrame) -> DataFrame:
    """One row per code: the last record's fields, at the first one's place (``ord``).

    ``max_by`` and ``min`` aggregate on both sides of the shuffle, so a code that comes very often is cheap.
    """
    fields = [c for c in rows.columns if c not in ("code", "pos")]
    best = rows.groupBy("code").agg(F.max_by(F.struct(*fields), "pos").alias("r"), F.min("pos").alias("ord"))
    return best.select("code", *(F.col(f"r.{c}").alias(c) for c in fields), "ord")


def _category(name: str = "category_name"):
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit("Uncategorized"))


def counts(catalog: DataFrame) -> DataFrame:
    """total_codes and billable_code_count."""
    return catalog.agg(F.count("*").alias("total_codes"), F.count_if("is_billable").alias("billable_code_count"))


def by_category(catalog: DataFrame) -> DataFrame:
    """Codes and billable codes of each category; null or empty ones are "Uncategorized"."""
    return catalog.groupBy(_category().alias("category")).agg(F.count("*").alias("n_codes"), F.count_if("is_billable").alias("n_billable"))


def by_chapter(catalog: DataFrame) -> DataFrame:
    """Codes of each first letter."""
    return catalog.groupBy(first_character(F.col("code")).alias("chapter")).agg(F.count("*").alias("n_codes"))


def keys(catalog: DataFrame) -> DataFrame:
    """The sorted distinct categories and chapters, as (kind, key)."""
    found = catalog.select(F.explode(F.array(F.struct(F.lit("category").alias("kind"), _category().alias("key")), F.struct(F.lit("chapter").alias("kind"), first_character(F.col("code")).alias("key")))).alias("k"))
    return found.select("k.kind", "k.key").distinct().orderBy("kind", "key")


def lookup(catalog: DataFrame, code: str) -> DataFrame:
    """The row of one code, matched exactly."""
    return catalog.where(F.col("code") == code)


def require(catalog: DataFrame, code: str):
    """The row of one code; an error if there is none."""
    row = lookup(catalog, code).head()
    if row is None:
        raise CodeNotFoundError("code not found", code=code)
    return row


def search(catalog: DataFrame, query: str, max_results: int = 100, billable_only: bool = True) -> DataFrame:
    """Codes whose name or category holds ``query``, literally, in any case; the first ones in catalogue order.

    An empty query matches all; a limit below 1 gives one row.
    """
    q = F.lower(F.lit(query))
    named = F.lower("name").contains(q) | F.coalesce(F.lower(F.nullif(F.col("category_name"), F.lit(""))).contains(q), F.lit(False))
    rows = catalog.where(F.col("is_billable")) if billable_only else catalog
    return rows.where(named).orderBy("ord").limit(max(max_results, 1))


def billable(catalog: DataFrame, count: int | None = None, category: str | None = None) -> DataFrame:
    """Billable codes in catalogue order, of one category if it is given and not empty; the first ``count``."""
    if count is not None and count < 0:
        raise ValueError("count must not be negative")
    rows = catalog.where(F.col("is_billable"))
    if category:
        rows = rows.where(F.col("category_name") == category)
    rows = rows.orderBy("ord")
    return rows if count is None else rows.limit(count)


def chapter(catalog: DataFrame, letter: str, billable_only: bool = True) -> DataFrame:
    """Codes of one chapter."""
    rows = catalog.where(first_character(F.col("code")) == letter.upper())
    return rows.where(F.col("is_billable")) if billable_only else rows
