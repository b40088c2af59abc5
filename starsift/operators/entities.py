"""Brand, feature and model mentions with offsets; entity tables.

Everything works on one review's text or its entity array, so no operator here
shuffles except the final counts, and all of it is Column expressions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions import text as tx
from starsift.functions.matching import ENTITY, MODEL_PATTERN, find_spans
from starsift.operators.windows import top_n_by


def spans(text: Column, pattern: str) -> Column:
    """Matches of a pattern with 0-based start and end offsets."""
    return F.transform(find_spans(text, [("", pattern, 0.0)]), _bare)


def _bare(e: Column) -> Column:
    return F.struct(e["text"].alias("text"), e["start"].alias("start"), e["end"].alias("end"))


def brand_entities(text: Column, brands=tuple(fv.BRANDS)) -> Column:
    return find_spans(text, [("BRAND", brands, fv.BRAND_CONFIDENCE)])


def feature_entities(text: Column, features=tuple(fv.PRODUCT_FEATURES)) -> Column:
    return find_spans(text, [("FEATURE", features, fv.FEATURE_CONFIDENCE)])


def model_entities(text: Column) -> Column:
    """Letters plus digits, or letters-hyphen-digits."""
    return find_spans(text, [("PRODUCT_MODEL", MODEL_PATTERN, fv.MODEL_CONFIDENCE)])


def brand_mentions(df: DataFrame, key: str, text: str, brands: DataFrame) -> DataFrame:
    """Single-word brand mentions against a dictionary table of any size (column ``brand``)."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"[{fv.WORD}#&]+"), F.lit(0))
    counts = df.select(key, F.explode(tokens).alias("_t")).groupBy(key, "_t").agg(F.count("*").alias("mentions"))
    named = brands.select("brand", F.lower("brand").alias("_t")).distinct()
    return counts.join(named, "_t").select(key, "brand", "mentions")


def _greedy(sorted_spans: Column, keep_text_once: bool) -> Column:
    """Walk spans in order, dropping any that start before the last kept end."""
    start = F.struct(
        F.lit(-1).alias("last"), F.array().cast("array<string>").alias("seen"), F.array().cast(ENTITY).alias("out")
    )

    def step(acc, e):
        name = F.lower(F.trim(e["text"]))
        ok = e["start"] >= acc["last"]
        if keep_text_once:
            ok = ok & ~F.array_contains(acc["seen"], name)
        return F.struct(
            F.when(ok, e["end"]).otherwise(acc["last"]).alias("last"),
            (F.when(ok, F.concat(acc["seen"], F.array(name))).otherwise(acc["seen"]) if keep_text_once
             else acc["seen"]).alias("seen"),
            F.when(ok, F.concat(acc["out"], F.array(e))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(sorted_spans, start, step, lambda acc: acc["out"])


def model_numbers(text: Column, patterns=tuple(fv.MODEL_PATTERNS_FULL)) -> Column:
    """Model-number spans of several patterns, overlaps removed left to right."""
    found = find_spans(text, [(str(i), p, 0.0) for i, p in enumerate(patterns)], once=False)
    return F.transform(_greedy(found, False), _bare)


def _place(e: Column, rank: Column) -> Column:
    """Sort key first, so that plain struct ordering sorts by start, then rank, then end."""
    return F.struct(e["start"].alias("start"), rank.alias("rank"), e["end"].alias("end"), e.alias("e"))


def merge_layers(*layers: Column) -> Column:
    """Entities of all layers, earlier layers winning a repeated span, sorted by start."""
    def place(layer: Column, i: int) -> Column:
        return F.transform(
            layer,
            lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), F.lit(i).alias("layer"), e.alias("e")),
        )

    placed = F.concat(*[place(layer, i) for i, layer in enumerate(layers)])
    start = F.struct(F.lit(-1).alias("s"), F.lit(-1).alias("t"), F.array().cast(ENTITY).alias("out"))

    def step(acc, p):
        repeated = (acc["s"] == p["start"]) & (acc["t"] == p["end"])
        return F.struct(
            p["start"].alias("s"),
            p["end"].alias("t"),
            F.when(repeated, acc["out"]).otherwise(F.concat(acc["out"], F.array(p["e"]))).alias("out"),
        )

    return F.aggregate(F.sort_array(placed), start, step, lambda acc: acc["out"])


def extract_entities(text: Column, brands=tuple(fv.BRANDS), features=tuple(fv.PRODUCT_FEATURES)) -> Column:
    """Brand, feature and model layers in one pass, repeated spans kept once, sorted by start."""
    return find_spans(
        text,
        [
            ("BRAND", brands, fv.BRAND_CONFIDENCE),
            ("FEATURE", features, fv.FEATURE_CONFIDENCE),
            ("PRODUCT_MODEL", MODEL_PATTERN, fv.MODEL_CONFIDENCE),
        ],
    )


def resolve_overlaps(entities: Column) -> Column:
    """By start then confidence: drop overlaps and repeats of the same text."""
    placed = F.sort_array(F.transform(entities, lambda e: _place(e, -e["confidence"])))
    return _greedy(F.transform(placed, lambda p: p["e"]), True)


def aspect_map(text: Column, aspects=fv.ENTITY_ASPECTS) -> Column:
    """Map aspect -> keywords found on word boundaries."""
    every = [k for keys in aspects.values() for k in keys]
    present = tx.words_present(F.lower(F.coalesce(text, F.lit(""))), list(dict.fromkeys(every)))

    def matched(found: Column, keys: list[str]) -> Column:
        return F.filter(found, lambda k: k.isin(*keys))

    def entries(found: Column) -> Column:
        return F.array(
            *[F.struct(F.lit(a).alias("key"), matched(found, keys).alias("value")) for a, keys in aspects.items()]
        )

    return F.map_from_entries(F.filter(tx.let(present, entries), lambda e: F.size(e["value"]) > 0))


def entity_columns(df: DataFrame, entities: str, aspects: str | None = None) -> DataFrame:
    """Pipe-joined brands, products, models and amounts with counts and the first brand."""

    def texts(*kinds):
        return F.transform(F.filter(entities, lambda e: e["label"].isin(*kinds)), lambda e: e["text"])

    brands = F.array_distinct(texts("BRAND", "ORG"))
    out = df.withColumns(
        {
            "brands": F.array_join(brands, " | "),
            "products": F.array_join(F.array_distinct(texts("PRODUCT")), " | "),
            "model_numbers": F.array_join(F.array_distinct(texts("MODEL", "PRODUCT_MODEL")), " | "),
            "money_mentions": F.array_join(texts("MONEY"), " | "),
            "entity_count": F.size(entities),
            "has_brand": F.size(brands) > 0,
            "brand_count": F.size(brands),
            "top_brand": F.coalesce(F.get(brands, F.lit(0)), F.lit("")),
        }
    )
    return out.withColumn("aspects", F.array_join(F.map_keys(aspects), " | ")) if aspects else out


def brand_pairs(df: DataFrame, brands: Column, n: int = 10) -> DataFrame:
    """Most frequent pairs of brands in one review (a review holds at most the dictionary's brands)."""
    listed = F.array_sort(F.array_distinct(F.filter(F.transform(brands, lambda b: F.trim(b)), lambda b: b != "")))
    kind = "array<struct<brand_1:string,brand_2:string>>"
    start = F.struct(F.array().cast("array<string>").alias("before"), F.array().cast(kind).alias("out"))

    def step(acc, b):
        new = F.transform(acc["before"], lambda a: F.struct(a.alias("brand_1"), b.alias("brand_2")))
        return F.struct(
            F.concat(acc["before"], F.array(b)).alias("before"), F.concat(acc["out"], new).alias("out")
        )

    pairs = F.aggregate(listed, start, step, lambda acc: acc["out"])
    counts = df.select(F.inline(pairs)).groupBy("brand_1", "brand_2").agg(F.count("*").alias("co_mentions"))
    return counts.orderBy(F.desc("co_mentions"), "brand_1", "brand_2").limit(n)


def entity_frequencies(df: DataFrame, entities: Column) -> DataFrame:
    return df.select(F.explode(entities).alias("e")).groupBy(F.col("e.label").alias("label")).agg(
        F.count("*").alias("n")
    )


def brand_frequencies(df: DataFrame, brands: Column, n: int = 15) -> DataFrame:
    """Reviews mentioning each brand (title case), top ``n``."""
    named = F.transform(F.array_distinct(brands), lambda b: F.initcap(b))
    counts = df.select(F.explode(named).alias("brand")).groupBy("brand").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "brand").limit(n)


def aspect_frequencies(df: DataFrame, aspects: Column) -> DataFrame:
    return df.select(F.explode(F.map_keys(aspects)).alias("aspect")).groupBy("aspect").agg(F.count("*").alias("n"))


def map_entity_label(label: Column, mapping=fv.ENTITY_LABELS) -> Column:
    """Product taxonomy label of a generic one, itself when unmapped."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(table, label), label)


def filter_entities(entities: Column, min_len: int = 2) -> Column:
    return F.filter(entities, lambda e: F.length(F.trim(e["text"])) >= min_len)


def densities(text: Column, entities: Column, aspects: Column) -> dict[str, Column]:
    n = F.greatest(tx.word_count(text), F.lit(1))
    return {"entity_density": F.size(entities) / n, "aspect_density": F.size(aspects) / n}
