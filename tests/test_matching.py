"""Spans found by Column expressions against a plain scan of each text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from starsift import fixed_values as fv
from starsift.functions.matching import MODEL_PATTERN, find_spans
from starsift.operators import entities

LAYERS = [("BRAND", ["Acme", "Acme Pro", "3m", "éclair", "a-b"], 0.9), ("FEATURE", ["acme", "battery life", "battery", "life", "c++"], 0.8), ("MODEL", MODEL_PATTERN, 0.7)]
PIECES = [
    "Acme", "ACME pro", "3M", "Éclair", "a-b", "battery life", "Battery", "lifetime", "c++", "WH-1000", "S24", "x_acme", " ", "  ",
    "\n", ".", "-", "😀", "é", "Acme's", "(acme)", "battery\tlife", "",
]


def plain(text, layers, once=True):
    rows = []
    for i, (_, x, _) in enumerate(layers):
        if isinstance(x, str):
            rows += [(*m.span(), i) for m in re.finditer(x, text)]
            continue
        low = {t.lower() for t in x}
        rows += [(*m.span(), i) for m in re.finditer(r"[^\W]+", text) if m.group().lower() in low]
        phrases = sorted((t for t in low if not re.fullmatch(r"\w+", t)), key=len, reverse=True)
        rows += [(*m.span(), i) for m in re.finditer(r"(?<!\w)(?:" + "|".join(map(re.escape, phrases)) + r")(?!\w)", text, re.I)] if phrases else []
    first = {}
    for a, b, i in rows:
        first[a, b] = min(i, first.get((a, b), i))
    rows = [(a, i, b) for (a, b), i in first.items()] if once else [(a, i, b) for a, b, i in rows]
    return [(text[a:b], layers[i][0], a, b, layers[i][2]) for a, i, b in sorted(rows)]


def found(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    return [[tuple(e) for e in r.v] for r in df.select("i", column(F.col("t")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("once", [True, False])
def test_layers_equal_a_plain_scan(spark, once):
    rng = random.Random(5)
    texts = ["", "acme", "Acme Pro", *("".join(rng.choice(PIECES) + rng.choice(["", " ", " ", ","]) for _ in range(rng.randrange(14))) for _ in range(400))]
    assert found(spark, texts, lambda t: find_spans(t, LAYERS, once)) == [plain(t, LAYERS, once) for t in texts]


def test_long_text_null_and_no_layer(spark):
    long = "the battery life of Acme S24 is fine " * 2000
    assert found(spark, [long, None], lambda t: find_spans(t, LAYERS)) == [plain(long, LAYERS), []]
    assert found(spark, ["Acme"], lambda t: find_spans(t, [])) == found(spark, ["Acme"], lambda t: find_spans(t, [("B", [], 1.0)])) == [[]]


def test_marks_in_the_text(spark):
    texts = ["\uffffAcme \uffff\uffff S24\uffff", "\uffff"]
    assert found(spark, texts, lambda t: find_spans(t, LAYERS)) == [plain(t, LAYERS) for t in texts]
    assert found(spark, ["a\uffffb"], lambda t: entities.spans(t, "(?s)a.b")) == [[("a\ufffeb", 0, 3)]]


def test_model_numbers_and_spans_on_unicode(spark):
    texts = ["Ünder S24 Pro, v3.1.2", "Gen 5 😀 Gen٣ 5th generation", "naïve Éa1 Note"]
    layers = [(str(i), p, 0.0) for i, p in enumerate(fv.MODEL_PATTERNS_FULL)]
    assert found(spark, texts, lambda t: find_spans(t, layers, once=False)) == [plain(t, layers, False) for t in texts]
    assert found(spark, ["aé bc"], lambda t: entities.spans(t, r"\w+")) == [[("aé", 0, 2), ("bc", 3, 5)]]
    with pytest.raises(ValueError, match="empty"):
        entities.spans(F.col("t"), "a*")


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("Acme S24",)], "t string").select(entities.extract_entities(F.col("t")))
    assert "Python" not in df._jdf.queryExecution().toString()
