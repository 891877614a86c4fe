"""Metrics of binary classifiers as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ordering import cut_into_ranges, running_totals


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def classification_metrics(scored: DataFrame, label: str = "exited", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class in one pass, rounded to 4."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return counts.select(
        F.round(_or_zero(tp + tn, tp + fp + fn + tn), 4).alias("Accuracy"),
        F.round(_or_zero(tp, tp + fp), 4).alias("Precision"),
        F.round(_or_zero(tp, tp + fn), 4).alias("Recall"),
        F.round(_or_zero(2 * tp, 2 * tp + fp + fn), 4).alias("F1-Score"),
    )


def _class_sums(label: str) -> dict[str, Column]:
    return {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) == 0)}


def roc_auc(scored: DataFrame, label: str = "exited", score: str = "churn_probability", ranges: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Every positive beats the negatives with a lower score. Within a range of scores that is
    counted by a window over distinct scores; between ranges by their totals.
    """
    narrow = scored.select(F.col(score).cast("double").alias("score"), F.col(label).alias("label"))
    per_score = (
        cut_into_ranges(narrow.where("score IS NOT NULL"), "score", ranges)
        .groupBy("range_no", "score")
        .agg(*[c.alias(n) for n, c in _class_sums("label").items()])
    )
    lower = Window.partitionBy("range_no").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("pos") * (F.coalesce(F.sum("neg").over(lower), F.lit(0)) + F.col("neg") / 2.0)
    per_range = per_score.withColumn("wins", wins).groupBy("range_no").agg(
        F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    # at most ranges + 1 rows from here on
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    tied = per_range.withColumn("neg_before", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    return tied.agg(
        F.try_divide(
            F.sum(F.col("wins") + F.col("pos").cast("double") * F.col("neg_before")),
            F.sum("pos").cast("double") * F.sum("neg"),
        ).alias("roc_auc")
    )


def roc_curve(scored: DataFrame, label: str = "exited", score: str = "churn_probability", ranges: int | None = None) -> DataFrame:
    """(fpr, tpr, threshold) per distinct score, with the (0, 0) point; collinear points stay."""
    narrow = scored.select(F.col(score).cast("double").alias("threshold"), F.col(label).alias("label"))
    curve = running_totals(narrow, "threshold", _class_sums("label"), descending=True, ranges=ranges, totals=True).select(
        F.try_divide(F.col("cum_neg"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("all_pos")).alias("tpr"),
        "threshold",
    )
    start = scored.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return start.unionByName(curve)


def confusion_matrix(scored: DataFrame, label: str = "exited", prediction: str = "prediction") -> DataFrame:
    """All four cells, empty ones as 0."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = scored.agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a, b in cells])
    rows = [F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"c{a}{b}").alias("n")) for a, b in cells]
    return counts.select(F.inline(F.array(*rows)))


def classification_report(scored: DataFrame, label: str = "exited", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    wide = scored.agg(*[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    cell = {(a, b): F.col(f"c{a}{b}") for a in (0, 1) for b in (0, 1)}
    by_class = {}
    for k in (0, 1):
        o = 1 - k
        hit, support = cell[k, k], cell[k, k] + cell[k, o]
        by_class[k] = (
            _or_zero(hit, hit + cell[o, k]),
            _or_zero(hit, support),
            _or_zero(2 * hit, 2 * hit + cell[o, k] + cell[k, o]),
            support,
        )
    total = by_class[0][3] + by_class[1][3]
    accuracy = _or_zero(cell[0, 0] + cell[1, 1], total)
    macro = [(by_class[0][i] + by_class[1][i]) / 2 for i in range(3)]
    weighted = [_or_zero(by_class[0][i] * by_class[0][3] + by_class[1][i] * by_class[1][3], total) for i in range(3)]
    lines = [("0", *by_class[0]), ("1", *by_class[1])]
    lines += [("accuracy", accuracy, accuracy, accuracy, total)]
    lines += [("macro avg", *macro, total), ("weighted avg", *weighted, total)]
    rows = [
        F.struct(
            F.lit(name).alias("class"),
            F.round(precision, 6).alias("precision"),
            F.round(recall, 6).alias("recall"),
            F.round(f1, 6).alias("f1_score"),
            support.alias("support"),
        )
        for name, precision, recall, f1, support in lines
    ]
    return wide.select(F.inline(F.array(*rows)))
