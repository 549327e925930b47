"""The code catalogue: reading and naming its columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.sources.json_array import read_array

SCHEMA = "code string, name string, is_billable boolean, category_code string, category_name string, diagnosis_category string, hcc_raf double"


def normalize(rows: DataFrame, variant: str = "doc", pos: str = "pos") -> DataFrame:
    """Catalogue columns from variant objects: an alias counts only where the main key is missing, so a null stays."""

    def pick(kind: str, *keys: str, default=None):
        out = F.lit(default).cast(kind)
        for key in reversed(keys):
            found = F.try_variant_get(F.col(variant), f"$.{key}", "variant")
            out = F.when(found.isNotNull(), F.try_variant_get(F.col(variant), f"$.{key}", kind)).otherwise(out)
        return out

    return rows.select(
        pick("string", "code", "icd10_code", default="").alias("code"),
        pick("string", "name", "icd10_name", default="").alias("name"),
        pick("boolean", "is_billable", default=True).alias("is_billable"),
        pick("string", "category_code").alias("category_code"),
        pick("string", "category_name", "category_description").alias("category_name"),
        pick("string", "diagnosis_category").alias("diagnosis_category"),
        pick("double", "hcc_raf").alias("hcc_raf"),
        F.col(pos).cast("long").alias("pos"),
    )


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array as catalogue rows with their position, read by many tasks; ``DatasetLoadError`` if it can't be read."""
    return normalize(read_array(spark, path).elements.select("pos", F.parse_json("text").alias("doc")))
