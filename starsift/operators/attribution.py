"""Additive attributions of linear models and the tables built from them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import text as tx
from starsift.operators.windows import running_sum, top_n_by

ABSENT = "(absent)"


def vector_cells(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, idx, value) for the stored entries of dense or sparse ML vectors."""
    raw = df.select(key, F.unwrap_udt(vector).alias("_v"))
    entries = F.when(
        F.col("_v.type") == 0, F.arrays_zip(F.col("_v.indices").alias("idx"), F.col("_v.values").alias("value"))
    ).otherwise(F.transform("_v.values", lambda x, i: F.struct(i.alias("idx"), x.alias("value"))))
    return raw.select(key, F.inline(entries).alias("idx", "value")).filter(F.col("value") != 0)


def feature_means(cells: DataFrame, n_rows: Column) -> DataFrame:
    """Column means with absent entries counted as zero."""
    return cells.groupBy("idx").agg((F.sum("value") / n_rows).alias("mean"))


def linear_attributions(rows: DataFrame, key: str, vector: str, coefficients: DataFrame, means: DataFrame) -> DataFrame:
    """(key, cls, idx, value): coef * (x - mean) per stored feature, plus one row (idx -1) with
    the sum over the features a row does not have. Values sum to margin minus baseline."""
    weights = coefficients.join(means, "idx", "left").withColumn("mean", F.coalesce("mean", F.lit(0.0)))
    weights = weights.select("cls", "idx", "coefficient", "mean").filter(F.col("coefficient") != 0)
    cells = vector_cells(rows, key, vector)
    # classes by features, as the fitted model itself; the cells grow with the rows
    present = cells.join(F.broadcast(weights), "idx").select(
        key, "cls", "idx", (F.col("coefficient") * (F.col("value") - F.col("mean"))).alias("attribution"),
        (F.col("coefficient") * F.col("mean")).alias("_cm"),
    )
    totals = weights.groupBy("cls").agg(F.sum(F.col("coefficient") * F.col("mean")).alias("_all"))
    # classes are few: every row meets every class through an exploded literal-size list. These rows are summed together
    # with the cells, so that no table of one row per key is ever joined (or sent whole to every task)
    per_row = rows.select(key).withColumn("_t", F.explode(totals.agg(F.collect_list(F.struct("cls", "_all")).alias("t")).scalar()))
    own = per_row.select(key, F.col("_t.cls").alias("cls"), F.lit(None).cast("double").alias("_cm"), F.col("_t._all").alias("_all"))
    seen = present.select(key, "cls", "_cm", F.lit(None).cast("double").alias("_all")).unionByName(own)
    sums = seen.groupBy(key, "cls").agg(F.sum("_cm").alias("_seen"), F.max("_all").alias("_all"), F.count("_all").alias("_rows"))
    # a repeated key has a row each time; a null key meets no cell
    known = F.when(F.col(key).isNotNull(), F.col("_seen"))
    rest = sums.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows")))).select(
        key, "cls", F.lit(-1).alias("idx"), (F.coalesce(known, F.lit(0.0)) - F.col("_all")).alias("attribution")
    )
    return present.drop("_cm").unionByName(rest)


def name_features(attr: DataFrame, names: DataFrame) -> DataFrame:
    """Attach (idx, feature) names, one row per feature of a fitted model; the absent row keeps its own name."""
    return attr.join(F.broadcast(names.select("idx", "feature")), "idx", "left").withColumn(
        "feature", F.coalesce("feature", F.lit(ABSENT))
    )


def global_importance(attr: DataFrame, n: int = 20, cls: str = "cls", feature: str = "feature", value: str = "attribution") -> DataFrame:
    """Mean absolute and signed attribution per class and feature, best ``n`` per class."""
    g = attr.groupBy(cls, feature).agg(F.avg(F.abs(value)).alias("mean_abs"), F.avg(value).alias("mean_signed"))
    return top_n_by(g, [cls], [F.round("mean_abs", 6).desc(), F.col(feature).asc()], n)


def explain_rows(attr: DataFrame, key: str, n: int = 15, feature: str = "feature", value: str = "attribution") -> DataFrame:
    """Waterfall per row: the ``n`` largest by size, the rest summed as "other", running total."""
    # the ranking needs every feature of one row; a row's features are bounded by its text
    ranked = top_n_by(attr, [key], [F.round(F.abs(value), 6).desc(), F.col(feature).asc()], 2**31 - 1)
    top = ranked.filter(F.col("rank") <= n).select(key, "rank", feature, value)
    other = (
        ranked.filter(F.col("rank") > n)
        .groupBy(key)
        .agg(F.sum(value).alias(value))
        .filter(F.abs(value) > 1e-12)
        .select(key, F.lit(n + 1).alias("rank"), F.lit("other").alias(feature), value)
    )
    return running_sum(top.unionByName(other), [key], [F.asc("rank")], value)


def token_contributions(df: DataFrame, key: str, text: str, attr: DataFrame, feature: str = "feature", value: str = "attribution") -> DataFrame:
    """Each token of a text with its word's attribution and its size relative to the text's largest."""
    words = attr.filter(~F.contains(feature, F.lit(" "))).groupBy(key, F.col(feature).alias("word")).agg(
        F.sum(value).alias("value")
    )
    # a text's words meet it as one map, so texts are joined once and tokens never shuffled
    row = words.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("word", "value"))).alias("_words"), F.max(F.abs("value")).alias("_peak")
    )
    tokens = F.posexplode(F.regexp_extract_all(text, F.lit(f"[{fv.WORD}']+"), F.lit(0))).alias("pos", "token")
    joined = df.select(key, text).join(row, key, "left").select(key, "_words", "_peak", tokens)
    word = F.regexp_replace(F.lower("token"), r"^[.,!?\"']+|[.,!?\"']+$", "")
    v = F.coalesce(F.try_element_at("_words", word), F.lit(0.0))
    scaled = F.least(F.abs(v) / (F.coalesce("_peak", F.lit(1.0)) + 1e-9), F.lit(1.0))
    return joined.select(key, "pos", "token", v.alias("contribution"), scaled.alias("intensity"))
