"""Model registry and memory estimate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.constants import MODELS


def models(spark: SparkSession) -> DataFrame:
    """The registered models."""
    schema = "variant string, hf_model_id string, quantized_model_id string, parameter_count string, context_length int, recommended_max_seq_len int, min_vram_gb double, min_vram_training_gb double, chat_template string"
    return spark.createDataFrame(MODELS, schema)


def model(spark: SparkSession, variant: str):
    """One model's row; an error naming the variants if there is none."""
    row = models(spark).where(F.col("variant") == variant).head()
    if row is None:
        raise ValueError(f"unknown model {variant!r}; one of {[m[0] for m in MODELS]}")
    return row


def memory_estimate(min_vram: Column, batch: Column, seq: Column) -> dict[str, Column]:
    """GB for training, half-even to two places: model, adapters (2 %), optimiser (1.5 x), activations, total, fits_6gb."""
    lora = min_vram * 0.02
    optimizer, activations = lora * 1.5, batch * 0.5 * seq / 512
    total = min_vram + lora + optimizer + activations
    parts = {"model_gb": min_vram, "lora_gb": lora, "optimizer_gb": optimizer, "activations_gb": activations, "total_gb": total}
    return {k: F.bround(v, 2) for k, v in parts.items()} | {"fits_6gb": total <= 6}
