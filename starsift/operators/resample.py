"""Class balancing: synthetic oversampling, undersampling, Tomek links."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.operators.evaluate import hash_bucket, label_counts
from starsift.operators.similarity import neighbours


def _unit(*parts) -> Column:
    """Repeatable number in [0, 1) from columns and literals."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.pmod(F.xxhash64(*cols), F.lit(1_000_000)) / 1_000_000


def _wanted(df: DataFrame, label: str) -> DataFrame:
    """Rows each class lacks to reach the largest class (one row per class)."""
    counts = label_counts(df, label)
    largest = counts.agg(F.max("n").alias("m")).scalar()
    return counts.select(F.col(label).alias("_l"), "n", (largest - F.col("n")).alias("lacking"))


def _synthesise(df: DataFrame, key: str, label: str, vector: str, near: DataFrame, quota: DataFrame, seed: int) -> DataFrame:
    """Interpolated rows: ``quota`` (id, copies) times, each towards a hashed choice of neighbour."""
    seeds = quota.filter(F.col("copies") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    reach = near.groupBy("id").agg(F.max("rank").alias("reach"))
    chosen = seeds.join(reach, "id").withColumn(
        "rank", (1 + F.floor(_unit(F.col("id"), F.col("copy"), seed) * F.col("reach"))).cast("int")
    )
    pairs = chosen.join(near.select("id", "rank", "other"), ["id", "rank"])
    a = df.select(F.col(key).alias("id"), F.col(label), F.col(vector).alias("_a"))
    b = df.select(F.col(key).alias("other"), F.col(vector).alias("_b"))
    step = _unit(F.col("id"), F.col("copy"), seed + 1)
    made = pairs.join(a, "id").join(b, "other").withColumn("_step", step)
    return made.select(
        F.lit(None).cast(df.schema[key].dataType).alias(key),
        F.col(label),
        F.zip_with("_a", "_b", lambda x, y: x + F.col("_step") * (y - x)).cast(df.schema[vector].dataType).alias(vector),
        F.lit(True).alias("synthetic"),
        F.col("id").alias("source_id"),
    )


def _deal(rows: DataFrame, seed: int) -> DataFrame:
    """Whole copies per row (id, _l, _share, lacking): the whole parts, and the rest to the largest remainders of a class.

    Remainders are counted per class in hundredths of a thousand, so no class is sorted in one task: rows above the
    class's cut get one more, those at the cut by the order of their hash as far as it goes.
    """
    whole = F.floor("_share").cast("int")
    step = F.floor((F.col("_share") - F.floor("_share")) * 100_000).cast("int")
    tie = F.pmod(F.xxhash64("id", F.lit(seed + 2)), F.lit(1_000)).cast("int")
    rows = rows.select("id", "_l", "lacking", whole.alias("whole"), (step * 1_000 + tie).alias("order"))
    rest = rows.groupBy("_l").agg((F.max("lacking") - F.sum("whole")).alias("rest"))
    by_order = rows.groupBy("_l", "order").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("_l").orderBy(F.desc("order"))) - F.col("c")
    cut = by_order.withColumn("before", before).join(rest, "_l")
    at_cut = cut.select("_l", "order", F.least("c", F.greatest(F.col("rest") - F.col("before"), F.lit(0))).alias("more"))
    ranked = F.row_number().over(Window.partitionBy("_l", "order").orderBy("id"))
    dealt = rows.withColumn("_rank", ranked).join(at_cut, ["_l", "order"])
    return dealt.select("id", (F.col("whole") + (F.col("_rank") <= F.col("more")).cast("int")).alias("copies"))


def smote(df: DataFrame, key: str, label: str, vector: str, width: int, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows that bring every class to the size of the largest.

    Neighbours come from the cell search within each class. Copies are dealt
    round: each row gets the whole part of lacking / n, and the rows first in
    hash order one more, so classes balance exactly. A class of one row has no
    neighbour and gets none.
    """
    near = neighbours(df, key, vector, width, k, group=label, seed=seed)
    wanted = _wanted(df, label)
    rows = df.select(F.col(key).alias("id"), F.col(label).alias("_l")).join(wanted.filter(F.col("lacking") > 0), "_l")
    quota = _deal(rows.withColumn("_share", F.col("lacking") / F.col("n")), seed)
    return _synthesise(df, key, label, vector, near, quota, seed)


def adasyn(df: DataFrame, key: str, label: str, vector: str, width: int, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows placed mostly where a row's neighbours belong to other classes."""
    around = neighbours(df, key, vector, width, k, seed=seed)
    classes = df.select(F.col(key).alias("other"), F.col(label).alias("_ol"))
    own = df.select(F.col(key).alias("id"), F.col(label).alias("_l"))
    hard = (
        own.join(around.join(classes, "other"), "id", "left")
        .groupBy("id", "_l")
        .agg(F.coalesce(F.avg((F.col("_ol") != F.col("_l")).cast("int")), F.lit(0.0)).alias("r"))
    )
    totals = hard.groupBy("_l").agg(F.sum("r").alias("total"))
    share = F.when(F.col("total") > 0, F.col("r") * F.col("lacking") / F.col("total")).otherwise(F.col("lacking") / F.col("n"))
    rows = hard.join(totals, "_l").join(_wanted(df, label), "_l").withColumn("_share", share)
    quota = _deal(rows.filter(F.col("lacking") > 0), seed)
    near = neighbours(df, key, vector, width, k, group=label, seed=seed)
    return _synthesise(df, key, label, vector, near, quota, seed)


def undersample(df: DataFrame, key: str, label: str, ratio: float = 0.5, seed: int = 42, bucket: Column | None = None) -> DataFrame:
    """Thin every class larger than smallest / ratio by a hash of the key (no sort, no shuffle of rows)."""
    counts = label_counts(df, label)
    target = counts.agg((F.min("n") / ratio).alias("t")).scalar()
    keep = counts.select(F.col(label).alias("_l"), F.least(target / F.col("n"), F.lit(1.0)).alias("_keep"))
    b = (hash_bucket(key, 1_000_000, seed) if bucket is None else bucket) / 1_000_000
    return df.join(keep, df[label] == F.col("_l")).filter(b < F.col("_keep")).drop("_l", "_keep")


def tomek_links(df: DataFrame, key: str, label: str, vector: str, width: int, seed: int = 42) -> DataFrame:
    """Pairs of mutual nearest neighbours from different classes."""
    near = neighbours(df, key, vector, width, 1, seed=seed).select("id", "other")
    back = near.select(F.col("id").alias("other"), F.col("other").alias("id"))
    mutual = near.join(back, ["id", "other"])
    classes = df.select(F.col(key).alias("id"), F.col(label).alias("id_label"))
    others = df.select(F.col(key).alias("other"), F.col(label).alias("other_label"))
    return mutual.join(classes, "id").join(others, "other").filter(
        (F.col("id_label") != F.col("other_label")) & (F.col("id") < F.col("other"))
    )


def remove_tomek(df: DataFrame, key: str, label: str, vector: str, width: int, seed: int = 42) -> DataFrame:
    """Drop the more frequent class's member of every link (the smaller label on equal counts)."""
    links = tomek_links(df, key, label, vector, width, seed)
    counts = label_counts(df, label)
    a = counts.select(F.col(label).alias("id_label"), F.col("n").alias("na"))
    b = counts.select(F.col(label).alias("other_label"), F.col("n").alias("nb"))
    sized = links.join(a, "id_label").join(b, "other_label")
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("id_label") < F.col("other_label")))
    victims = sized.select(F.when(first, F.col("id")).otherwise(F.col("other")).alias(key)).distinct()
    return df.join(victims, key, "left_anti")


def smote_tomek(df: DataFrame, key: str, label: str, vector: str, width: int, k: int = 5, seed: int = 42) -> DataFrame:
    """Rows and synthetic rows together, without the members of Tomek links (synthetic keys follow the largest key)."""
    made = smote(df, key, label, vector, width, k, seed).select(key, label, vector)
    top = df.agg(F.max(key)).first()[0]
    numbered = made.withColumn(key, (F.lit(top) + 1 + F.monotonically_increasing_id()).cast(df.schema[key].dataType))
    both = df.select(key, label, vector).unionByName(numbered)
    return remove_tomek(both, key, label, vector, width, seed)
