"""Classification metrics as aggregates over (label, prediction) rows.

Every metric reduces to one ``groupBy(label, prediction).count()`` (partial
aggregation on each executor, at most classes^2 rows after the shuffle), so
they cost one pass whatever the size of the scored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.operators.layout import stage


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (accuracy in %, matches, total)."""
    eq = (F.col(label) == F.col(prediction)).cast("long")
    return df.agg(
        (F.avg(eq.cast("double")) * 100.0).alias("accuracy"),
        F.sum(eq).alias("matches"),
        F.count(F.lit(1)).alias("total"),
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes=None) -> DataFrame:
    """One row per class with a count column per predicted class, zeros included.

    The classes are those that occur as a label or as a prediction (one row
    each reaches the driver, as each becomes a column); ``classes`` adds more.
    """
    cm = confusion_counts(df, label, prediction)
    found = {r[0] for r in cm.select(F.explode(F.array("actual", "predicted").cast("array<long>")).alias("c")).distinct().collect()}
    every = sorted((found | set(classes or ())) - {None})
    frame = df.sparkSession.createDataFrame([(int(c),) for c in every], "actual LONG")
    piv = cm.groupBy(F.col("actual").cast("long").alias("actual")).agg(
        *[F.sum(F.when(F.col("predicted") == c, F.col("n"))).alias(f"_{c}") for c in every])
    kind = dict(df.dtypes)[label]
    return frame.join(piv, "actual", "left").select(
        F.col("actual").cast(kind).alias("actual"), *[F.coalesce(f"`_{c}`", F.lit(0)).cast("long").alias(f"pred_{c}") for c in every])


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          names=None) -> DataFrame:
    """Per-class precision/recall/F1/support, plus accuracy, macro and weighted rows.

    0/0 is reported as 0 (scikit-learn ``zero_division`` default behaviour).
    Output: (row_name, precision, recall, f1, support), values rounded to 4 digits.
    """
    cm = stage(confusion_counts(df, label, prediction), "confusion")  # at most classes^2 rows
    tp = cm.where(F.col("actual") == F.col("predicted")).groupBy(F.col("actual").alias("cls")).agg(
        F.sum("n").alias("tp"))
    act = cm.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    pred = cm.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("npred"))
    per = (act.join(pred, "cls", "full").join(tp, "cls", "left")
           .select("cls",
                   F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("npred", F.lit(0)).alias("npred")))
    per = per.select(
        "cls", "support",
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("npred")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0)).alias("recall"),
    ).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                              F.col("precision") + F.col("recall")), F.lit(0.0)))
    if names:
        name_col = F.coalesce(F.try_element_at(F.create_map(*[x for i, n in enumerate(names)
                                                               for x in (F.lit(i), F.lit(n))]),
                                               F.col("cls")), F.col("cls").cast("string"))
    else:
        name_col = F.col("cls").cast("string")
    rows = per.select(name_col.alias("row_name"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    acc = cm.agg((F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
                  / F.sum("n")).alias("a"), F.sum("n").alias("n"))
    acc_row = acc.select(F.lit("accuracy").alias("row_name"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), F.col("a").alias("f1"),
                         F.col("n").cast("long").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("row_name"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("row_name"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
        F.sum("support").cast("long").alias("support"))
    out = rows.unionByName(acc_row).unionByName(macro).unionByName(weighted)
    return out.select("row_name", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")], "support")


def log_loss_row(label: str, probability: str, eps: float = 1e-15) -> Column:
    """Cross-entropy of one row; the probability is clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1.0 - eps))
    return F.when(F.col(label) == 1, -F.ln(p)).otherwise(-F.ln(1.0 - p))


def log_loss(df: DataFrame, label: str = "label", probability: str = "p1", eps: float = 1e-15) -> DataFrame:
    """Mean binary cross-entropy of P(class 1), probabilities clipped to [eps, 1-eps]."""
    return df.agg(F.avg(log_loss_row(label, probability, eps)).alias("log_loss"), F.count(F.lit(1)).alias("total"))
