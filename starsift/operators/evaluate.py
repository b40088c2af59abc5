"""Splits, evaluation tables, thresholds, drift and gates."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import labels
from starsift.operators.quantiles import quantile_values
from starsift.operators.windows import row_normalise, share_of
from starsift.sources import durable


def hash_bucket(key: str, buckets: int, seed: int = 42) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))


def split(df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, bucket: Column | None = None) -> DataFrame:
    """``is_test`` from a stable hash of the key: repeatable under any partitioning, no shuffle.

    Classes are hit in proportion because the hash ignores them. ``bucket`` (0..9999) replaces the hash.
    """
    b = hash_bucket(key, 10_000, seed) if bucket is None else bucket
    return df.withColumn("is_test", b < int(round(fraction * 10_000)))


def stratified_split(df: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """The same with a cut per class, for rare classes whose share must be tight."""
    hashed = df.withColumn("_h", hash_bucket(key, 1_000_000, seed))
    cuts = hashed.groupBy(label).agg(F.percentile_approx("_h", fraction, 100_000).alias("_cut"))
    renamed = cuts.withColumnRenamed(label, "_l")
    joined = hashed.join(renamed, hashed[label].eqNullSafe(renamed["_l"]), "left")
    return joined.withColumn("is_test", F.col("_h") <= F.col("_cut")).drop("_h", "_cut", "_l")


def folds(df: DataFrame, key: str, k: int = 3, seed: int = 42, bucket: Column | None = None) -> DataFrame:
    b = hash_bucket(key, k, seed) if bucket is None else bucket
    return df.withColumn("fold", b.cast("int"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (classes * n_class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    every = Window.partitionBy()  # one row per class
    return counts.withColumn("weight", F.sum("n").over(every) / (F.count("*").over(every) * F.col("n")))


def label_counts(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def confusion(df: DataFrame, actual: str, predicted: str, classes: list) -> DataFrame:
    """Counts and row shares for every pair of the given classes, zeros included."""
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    pairs = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted")) for a in classes for p in classes]
    grid = df.sparkSession.range(1).select(F.inline(F.array(*pairs)))
    full = grid.join(counts, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return row_normalise(full)


def per_class_report(df: DataFrame, actual: str, predicted: str, classes: list) -> DataFrame:
    """Precision, recall, F1 and support per class; a zero denominator scores 0."""
    aggs = []
    for i, c in enumerate(classes):
        a, p = F.col(actual) == c, F.col(predicted) == c
        aggs += [F.count_if(a & p).alias(f"tp_{i}"), F.count_if(a).alias(f"ac_{i}"), F.count_if(p).alias(f"pr_{i}")]
    cells = [
        F.struct(F.lit(c).alias("cls"), F.col(f"tp_{i}").alias("tp"), F.col(f"ac_{i}").alias("support"),
                 F.col(f"pr_{i}").alias("predicted"))
        for i, c in enumerate(classes)
    ]
    rows = df.agg(*aggs).select(F.inline(F.array(*cells)))
    precision = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    out = rows.withColumns({"precision": precision, "recall": recall})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)))


def class_report(df: DataFrame, actual: str, predicted: str, classes: list) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted averages in one row."""
    per = per_class_report(df, actual, predicted, classes)
    total = F.sum("support")
    return per.agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        *[F.avg(m).alias(f"{m}_macro") for m in ("precision", "recall", "f1")],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), total).alias(f"{m}_weighted") for m in ("precision", "recall", "f1")],
    )


def score_ranges(df: DataFrame, label: str, score: str, ranges: int | None = None) -> DataFrame:
    """s, p, n (positives and negatives of each distinct score) with b, its range: ranges rise with the score and hold about
    the same number of distinct scores each, however crowded the scores are. ``ranges``: by default the shuffle partitions."""
    per = df.groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = per.filter(F.col("s").isNotNull()).repartitionByRange(ranges, "s").withColumn("b", F.spark_partition_id())
    return durable.stored(ranged, "score-ranges")  # the range of a score must not change between its uses


def roc_auc(df: DataFrame, label: str, score: str, buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve of a 0/1 label, ties counting half; exact at any size.

    Rows are counted per distinct score. The negatives below a score are those of lower ranges, one number each, and of its
    own range, so no window spans all scores and no range is crowded. ``buckets`` is the number of ranges. Null scores take no part.
    """
    per = score_ranges(df, label, score, buckets)
    by_range = per.groupBy("b").agg(F.sum("n").alias("bn"))
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    below = by_range.select("b", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("below"))
    inside = Window.partitionBy("b").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = per.withColumn("in_range", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(below, "b")
    wins = F.sum(F.col("p") * (F.col("below") + F.col("in_range") + F.col("n") / 2))
    return ranked.agg(
        F.try_divide(wins, F.sum("p") * F.sum("n")).alias("auc"), F.sum("p").alias("positives"), F.sum("n").alias("negatives")
    )


def roc_auc_weighted(df: DataFrame, label: str, scores: dict) -> DataFrame:
    """One-vs-rest areas averaged by class support; ``scores`` maps class -> score column."""
    parts = [
        roc_auc(df.select((F.col(label) == c).cast("int").alias("_y"), F.col(col).alias("_s")), "_y", "_s")
        for c, col in scores.items()
    ]
    each = reduce(lambda a, b: a.unionByName(b), parts)
    return each.agg(F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum("positives")).alias("auc_weighted"))


def regression_report(df: DataFrame, actual: str, predicted: str, threshold: float = 0.5) -> DataFrame:
    """Errors on the 0..100 scale, Pearson r, and accuracy and weighted F1 at a threshold."""
    a = F.col(actual)
    p = F.least(F.greatest(F.col(predicted), F.lit(0.0)), F.lit(1.0))
    err = (p - a) * 100
    hit_a, hit_p = a >= threshold, p >= threshold
    g = df.agg(
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.corr(a, p).alias("pearson_r"),
        F.count_if(hit_a & hit_p).alias("tp"),
        F.count_if(~hit_a & hit_p).alias("fp"),
        F.count_if(hit_a & ~hit_p).alias("fn"),
        F.count_if(~hit_a & ~hit_p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    f1_pos = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    f1_neg = F.coalesce(F.try_divide(2 * tn, 2 * tn + fp + fn), F.lit(0.0))
    return g.select(
        "mse", "rmse", "mae", "pearson_r",
        F.try_divide(tp + tn, total).alias("accuracy"),
        F.try_divide(f1_pos * (tp + fn) + f1_neg * (tn + fp), total).alias("f1_weighted"),
    )


def threshold_curve(df: DataFrame, label: str, score: str, thresholds: list[float]) -> DataFrame:
    """Precision, recall and F1 at each threshold from one aggregate over the rows."""
    y, s = F.col(label) == 1, F.col(score)
    aggs = [F.count_if(y).alias("pos")]
    for i, t in enumerate(thresholds):
        aggs += [F.count_if(y & (s >= t)).alias(f"tp_{i}"), F.count_if(s >= t).alias(f"pp_{i}")]
    cells = [
        F.struct(F.lit(t).alias("threshold"), F.col(f"tp_{i}").alias("tp"), F.col(f"pp_{i}").alias("pp"))
        for i, t in enumerate(thresholds)
    ]
    rows = df.agg(*aggs).select("pos", F.inline(F.array(*cells)))
    return rows.select(
        "threshold",
        F.coalesce(F.try_divide("tp", "pp"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("tp", "pos"), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), F.col("pp") + F.col("pos")), F.lit(0.0)).alias("f1"),
    )


SCAN = [round(0.10 + 0.05 * i, 2) for i in range(16)]
CURVE = [round(0.05 + 0.025 * i, 3) for i in range(36)]


def threshold_scan(df: DataFrame, label: str, score: str, thresholds=tuple(SCAN)) -> DataFrame:
    """The threshold with the best F1, the lowest on ties; 0.5 when none scores above 0."""
    curve = threshold_curve(df, label, score, list(thresholds))
    best = F.max_by(F.struct("threshold", "f1"), F.struct(F.round("f1", 9), -F.col("threshold")))
    picked = curve.agg(best.alias("b"))
    return picked.select(
        F.when(F.col("b.f1") > 0, F.col("b.threshold")).otherwise(0.5).alias("threshold"), F.col("b.f1").alias("f1")
    )


def confidence_hist(df: DataFrame, confidence: str, correct: Column, bins: int = 25) -> DataFrame:
    b = labels.histogram_bin(F.col(confidence), 0.0, 1.0, bins)
    return df.groupBy(b.alias("bin")).agg(
        F.count_if(correct).alias("n_correct"), F.count_if(~correct).alias("n_wrong")
    )


def residual_hist(df: DataFrame, actual: str, predicted: str, bins: int = 25) -> DataFrame:
    residual = (F.col(predicted) - F.col(actual)) * 100
    return df.groupBy(labels.histogram_bin(residual, -100.0, 100.0, bins).alias("bin")).agg(F.count("*").alias("n"))


def psi(base: DataFrame, current: DataFrame, col: str, bins: int = 10, alert: float = 0.2) -> DataFrame:
    """Population stability index against the baseline's quantile bins; alert above the limit."""
    found = quantile_values(base, [col], [i / bins for i in range(1, bins)])[col]
    cuts = F.array(*[F.lit(q).cast("double") for q in found])

    def shares(df: DataFrame, name: str) -> DataFrame:
        b = F.size(F.filter(cuts, lambda q: q < F.col(col)))
        counted = df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
        return share_of(counted, [], "n", 1.0, name).select("bin", name)

    floor = F.lit(1e-6)
    both = shares(base, "b").join(shares(current, "c"), "bin", "full")
    b, c = F.greatest(F.coalesce("b", floor), floor), F.greatest(F.coalesce("c", floor), floor)
    total = F.sum((c - b) * F.log(c / b))
    return both.agg(total.alias("psi")).select(F.lit(col).alias("feature"), "psi", (F.col("psi") > alert).alias("drifted"))


def gate(metrics: DataFrame, gates=tuple(fv.GATES)) -> DataFrame:
    """Metrics (name, value) against their limits; a metric without a value fails."""
    limits = metrics.sparkSession.createDataFrame(list(gates), "metric string, op string, bound double")
    ok = F.when(F.col("op") == ">=", F.col("value") >= F.col("bound")).otherwise(F.col("value") <= F.col("bound"))
    return limits.join(metrics.select("metric", "value"), "metric", "left").select(
        "metric", "value", "bound", F.coalesce(ok, F.lit(False)).alias("passed")
    )


def metrics_long(report: DataFrame, names: dict[str, str]) -> DataFrame:
    """One report row to (metric, value) rows: ``names`` maps column -> metric."""
    cells = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for c, m in names.items()]
    return report.select(F.inline(F.array(*cells)))
