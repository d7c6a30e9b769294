"""Evaluation metrics from tables of truth and prediction: confusion, IoU, kappa, calibration, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("true_c"), F.col(predicted).alias("pred_c")).agg(F.count("*").alias("n"))


def per_class(cm: DataFrame, ignore: int | None = 0, drop_ignored_first: bool = False) -> DataFrame:
    """``class tp fp fn iou recall`` from a confusion table.

    Two conventions: false positives among rows whose truth is ``ignore`` count, unless those rows are dropped first.
    """
    cm = cm.where(F.col("true_c") != ignore) if drop_ignored_first and ignore is not None else cm
    sides = cm.select(
        F.explode(
            F.when(F.col("true_c") == F.col("pred_c"), F.array(F.struct(F.col("true_c").alias("class"), F.col("n").alias("tp"), F.lit(0).cast("long").alias("fp"), F.lit(0).cast("long").alias("fn")))).otherwise(
                F.array(
                    F.struct(F.col("true_c").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"), F.col("n").alias("fn")),
                    F.struct(F.col("pred_c").alias("class"), F.lit(0).cast("long").alias("tp"), F.col("n").alias("fp"), F.lit(0).cast("long").alias("fn")),
                )
            )
        ).alias("s")
    ).select("s.*")
    total = sides.groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    nan = F.lit(float("nan"))
    return total.select(
        "*", F.coalesce(F.round(F.col("tp") / F.nullif(F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0)), 4), nan).alias("iou"),
        F.coalesce(F.round(F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0)), 4), nan).alias("recall"),
    )


def summary(cm: DataFrame, ignore: int | None = 0) -> DataFrame:
    """Mean IoU over classes but ``ignore``, accuracy over truths but ``ignore``, and Cohen's kappa over the same."""
    kept = cm if ignore is None else cm.where(F.col("true_c") != ignore)
    iou = per_class(cm, ignore)
    iou = iou if ignore is None else iou.where(F.col("class") != ignore)
    miou = F.broadcast(iou.where(~F.isnan("iou")).agg(F.avg("iou").alias("miou")))
    total = F.broadcast(kept.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("true_c") == F.col("pred_c"), F.col("n")).otherwise(0)).alias("right")))
    rows = kept.groupBy(F.col("true_c").alias("c")).agg(F.sum("n").alias("a"))
    cols = kept.groupBy(F.col("pred_c").alias("c")).agg(F.sum("n").alias("b"))
    chance = F.broadcast(rows.join(cols, "c").agg(F.sum(F.col("a").cast("double") * F.col("b")).alias("ab")))
    po, pe = F.col("right") / F.col("all"), F.coalesce(F.col("ab"), F.lit(0.0)) / (F.col("all").cast("double") * F.col("all"))
    return total.join(miou, F.lit(True)).join(chance, F.lit(True)).select("miou", po.alias("accuracy"), F.coalesce((po - pe) / F.nullif(1 - pe, F.lit(0.0)), F.lit(0.0)).alias("kappa"))


def top_confusions(cm: DataFrame, n: int = 30) -> DataFrame:
    """The most frequent confusions by their share of the true class."""
    rate = F.col("n") / F.sum("n").over(Window.partitionBy("true_c"))
    return cm.withColumn("rate", rate).where("true_c <> pred_c").orderBy(F.desc("rate"), "true_c", "pred_c").limit(n)


def reliability(df: DataFrame, confidence: str, right: Column, bins: int = 15) -> DataFrame:
    """Bin, rows, mean confidence and accuracy. Bins are found by their edges, the last one closed."""
    edges = [k / bins for k in range(1, bins)]
    at = F.aggregate(F.array(*map(F.lit, edges)), F.lit(0), lambda a, e: a + (F.col(confidence) >= e).cast("int"))
    return df.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(confidence).alias("confidence"), F.avg(right.cast("double")).alias("accuracy"))


def expected_calibration_error(df: DataFrame, confidence: str, right: Column, bins: int = 15) -> DataFrame:
    r = reliability(df, confidence, right, bins)
    return r.agg(F.coalesce(F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))) / F.sum("n"), F.lit(0.0)).alias("ece"))


def roc_pr(df: DataFrame, score: str, positive: Column, buckets: int = 64) -> DataFrame:
    """Exact areas under the ROC and the precision-recall curve, ties at one point, by trapezoids; one class gives NaN.

    Running sums are taken within ranges of scores, and offsets of ranges added: no task sorts all scores.
    """
    points = df.groupBy(F.col(score).cast("double").alias("s")).agg(F.count_if(positive).cast("double").alias("p"), F.count_if(~positive).cast("double").alias("q"))
    cuts = points.agg(F.percentile_approx("s", [k / buckets for k in range(1, buckets)], 10000).alias("cuts"))
    ranged = points.join(F.broadcast(cuts), F.lit(True)).withColumn("r", F.size(F.filter("cuts", lambda c: c > F.col("s")))).drop("cuts")
    sums = ranged.groupBy("r").agg(F.sum("p").alias("rp"), F.sum("q").alias("rq"))
    before = Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    zero = F.lit(0.0)
    offsets = sums.select("r", F.coalesce(F.sum("rp").over(before), zero).alias("op"), F.coalesce(F.sum("rq").over(before), zero).alias("oq"))
    total = sums.agg(F.sum("rp").alias("np"), F.sum("rq").alias("nq"))
    down = Window.partitionBy("r").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    c = ranged.join(F.broadcast(offsets), "r").select("s", "p", "q", (F.col("op") + F.sum("p").over(down)).alias("tp"), (F.col("oq") + F.sum("q").over(down)).alias("fp"))
    tp0, fp0 = F.col("tp") - F.col("p"), F.col("fp") - F.col("q")
    now = F.col("tp") / (F.col("tp") + F.col("fp"))
    prior = F.coalesce(tp0 / F.nullif(tp0 + fp0, zero), now)  # the curve starts at recall 0 with the first precision
    area = c.agg(F.sum(F.col("q") * (F.col("tp") + tp0) / 2).alias("roc"), F.sum(F.col("p") * (now + prior) / 2).alias("pr"))
    nan = F.lit(float("nan"))
    both = area.join(F.broadcast(total), F.lit(True))
    ok = (F.col("np") > 0) & (F.col("nq") > 0)
    return both.select(
        F.when(ok, F.col("roc") / F.nullif(F.col("np") * F.col("nq"), zero)).otherwise(nan).alias("auroc"), F.when(ok, F.col("pr") / F.nullif(F.col("np"), zero)).otherwise(nan).alias("aupr")
    )


def percentiles_of(df: DataFrame, value: str) -> DataFrame:
    from skyquilt.operators.aggregates import exact_percentiles

    p = exact_percentiles(df, value, [0.1, 0.5, 0.9])
    return p.select(*[F.col("p")[k].alias(n) for k, n in enumerate(("p10", "p50", "p90"))])


def auroc_by_class(df: DataFrame, cls: str, score: str, positive: Column) -> DataFrame:
    """Area under the ROC of each class, ties half, and its rows: the rows are counted by score first, and a class's distinct scores ranked. NaN with one kind only.

    For scores of few values (counts, rounded shares); ``roc_pr`` ranks by ranges where they are as many as the rows.
    """
    h = df.groupBy(cls, score).agg(F.count_if(positive).alias("a"), F.count_if(~positive).alias("b"))
    up = Window.partitionBy(cls).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    h = h.withColumn("below", F.coalesce(F.sum("b").over(up), F.lit(0)))
    area = F.sum(F.col("a") * (F.col("below") + F.col("b") / 2)) / F.nullif((F.sum("a") * F.sum("b")).cast("double"), F.lit(0.0))
    return h.groupBy(cls).agg(F.coalesce(area, F.lit(float("nan"))).alias("auroc"), F.sum(F.col("a") + F.col("b")).alias("plots"))


def curves_by_class(df: DataFrame, cls: str, score: str, positive: Column) -> DataFrame:
    """``auroc`` and ``aupr`` of each class, ties at one point, by trapezoids; the precision-recall curve starts at (0, its first precision). NaN with one kind only.

    For scores of few values: the rows are counted by score first, and a class's distinct scores are ranked.
    """
    h = df.groupBy(cls, score).agg(F.count_if(positive).cast("double").alias("a"), F.count_if(~positive).cast("double").alias("b"))
    down = Window.partitionBy(cls).orderBy(F.desc(score))
    so_far, whole = down.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(cls)
    h = h.withColumns({"tp": F.sum("a").over(so_far), "fp": F.sum("b").over(so_far), "np": F.sum("a").over(whole), "nn": F.sum("b").over(whole)})
    recall, precision = F.col("tp") / F.nullif("np", F.lit(0.0)), F.col("tp") / (F.col("tp") + F.col("fp"))
    h = h.withColumns({"r": recall, "p": precision, "f": F.col("fp") / F.nullif("nn", F.lit(0.0))})
    before = lambda c, first: F.coalesce(F.lag(c).over(down), first)
    h = h.withColumns({"d_roc": (F.col("f") - before("f", F.lit(0.0))) * (F.col("r") + before("r", F.lit(0.0))) / 2, "d_pr": (F.col("r") - before("r", F.lit(0.0))) * (F.col("p") + before("p", F.col("p"))) / 2})
    both = (F.max("np") > 0) & (F.max("nn") > 0)
    area = lambda c: F.when(both, F.sum(c)).otherwise(F.lit(float("nan")))
    return h.groupBy(cls).agg(area("d_roc").alias("auroc"), area("d_pr").alias("aupr"))


def plot_report(plots: DataFrame, truth: str, predicted: str, scores: str, classes: list[int]) -> DataFrame:
    """A row a class that has plots: how many, how many of them were predicted right, its areas under both curves over all plots; and the accuracy over all plots of a known class (1 and above).

    ``scores``: an array with a score for each class from 0. A plot without a class (null or below 1) counts as negative for all.
    """
    t = F.coalesce(F.col(truth), F.lit(-1))
    known = plots.where(t >= 1)
    overall = F.broadcast(known.agg(F.count("*").alias("n_known"), F.avg((F.col(predicted) == t).cast("double")).alias("accuracy")))
    per = known.where(t.isin(classes)).groupBy(t.alias("class")).agg(F.count("*").alias("plots"), F.count_if(F.col(predicted) == t).alias("right"))
    asked = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.get(scores, F.lit(c)).alias("score")) for c in classes]))
    long = plots.select(t.alias("t"), asked.alias("s")).select("t", "s.*")
    curves = curves_by_class(long, "class", "score", F.col("t") == F.col("class"))
    return per.join(curves, "class").join(overall, F.lit(True)).select("class", "plots", "right", "auroc", "aupr", "n_known", "accuracy")
