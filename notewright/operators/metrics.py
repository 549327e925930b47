"""Multi-label metrics over (index, predicted, truth): arrays of labels, sets per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def rates(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    """precision, recall, f1; 0 where a denominator is."""
    return _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn)


def per_sample(pairs: DataFrame) -> DataFrame:
    """Each row's true and false positives and negatives (sorted), rates and exact match."""
    p, t = F.array_distinct("predicted"), F.array_distinct("truth")
    sets = {"true_positives": F.array_intersect(p, t), "false_positives": F.array_except(p, t), "false_negatives": F.array_except(t, p)}
    rows = pairs.select("index", *(F.array_sort(v).alias(k) for k, v in sets.items()))
    precision, recall, f1 = rates(*(F.size(c) for c in sets))
    exact = (F.size("false_positives") == 0) & (F.size("false_negatives") == 0)
    return rows.select("*", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), exact.alias("exact_match"))


def zip_pairs(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(index, predicted, truth) of two lists by position: (index, predicted) and (index, truth).  The longer one's rest is left out."""
    return predicted.select("index", "predicted").join(truth.select("index", "truth"), "index")


def _marks(pairs: DataFrame, labels: DataFrame | list[str] | None = None) -> DataFrame:
    """(label, tp, fp, fn): one shuffle, on the label, of partial sums.

    With ``labels`` (names, or a frame with a column label) exactly these, zeros for those that never occur.
    """
    found = pairs.select("predicted", "truth", F.explode(F.array_union("predicted", "truth")).alias("label"))
    said, so = F.array_contains("predicted", F.col("label")), F.array_contains("truth", F.col("label"))
    marks = found.groupBy("label").agg(F.count_if(said & so).alias("tp"), F.count_if(said & ~so).alias("fp"), F.count_if(~said & so).alias("fn"))
    if labels is None:
        return marks
    classes = labels if isinstance(labels, DataFrame) else pairs.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    return classes.select("label").distinct().join(marks, "label", "left").fillna(0, ["tp", "fp", "fn"])


def per_class(pairs: DataFrame, labels: DataFrame | list[str] | None = None) -> DataFrame:
    """label, tp, fp, fn, precision, recall, f1 of each label predicted or true; of those given, whether they occur or not."""
    precision, recall, f1 = rates(F.col("tp"), F.col("fp"), F.col("fn"))
    return _marks(pairs, labels).select("label", "tp", "fp", "fn", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def top_classes(pairs: DataFrame, n: int = 20) -> DataFrame:
    """The classes of highest F1; ties by label."""
    return per_class(pairs).orderBy(F.desc("f1"), "label").limit(n)


def _summary(pairs: DataFrame, labels: DataFrame | list[str] | None, samples: DataFrame) -> DataFrame:
    """One row; ``samples`` (num_samples) has the number that exact matches are a share of."""
    precision, recall, f1 = rates(F.sum("tp"), F.sum("fp"), F.sum("fn"))
    macro = (F.coalesce(F.avg(c), F.lit(0.0)).alias(f"{c}_macro") for c in ("precision", "recall", "f1"))
    classes = per_class(pairs, labels).agg(F.count("*").alias("num_classes"), precision.alias("precision_micro"), recall.alias("recall_micro"), f1.alias("f1_micro"), *macro)
    same = F.size(F.array_except("predicted", "truth")) + F.size(F.array_except("truth", "predicted")) == 0
    exact = pairs.agg(F.count_if(same).alias("exact"))
    rows = samples.crossJoin(F.broadcast(exact)).crossJoin(F.broadcast(classes))  # one row each
    return rows.select("num_samples", _ratio(F.col("exact"), F.col("num_samples")).alias("exact_match_accuracy"), *classes.columns)


def summary(pairs: DataFrame, labels: DataFrame | list[str] | None = None) -> DataFrame:
    """One row: num_samples, num_classes, micro and macro rates, exact_match_accuracy.

    With ``labels`` the rates and num_classes are of these classes; matches are of whole sets in any case.
    """
    return _summary(pairs, labels, pairs.agg(F.count("*").alias("num_samples")))


def zip_summary(predicted: DataFrame, truth: DataFrame, labels: DataFrame | list[str] | None = None) -> DataFrame:
    """``summary`` of two lists paired by position (``zip_pairs``): num_samples is the number of predictions, and exact
    matches are a share of these, also where the list of truths is shorter."""
    return _summary(zip_pairs(predicted, truth), labels, predicted.agg(F.count("*").alias("num_samples")))
