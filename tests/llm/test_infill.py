"""Fill-in-the-middle against SQL, a plain cutter and exact round trips."""

import hashlib
import re

import brute
import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from starsift.llm import infill, queries

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(key, text):
    """(n, form, prefix_chars, middle_chars, output) by writing out every unit."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql_and_plain_version(spark, sf):
    df = queries.QUERIES["op13_fill_in_middle"](spark, sf)
    assert compare.difference(df, compare.connect(sf), queries.ORACLES["op13_fill_in_middle"]) is None
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = brute.rows(df, "doc_id")
    assert set(got) == set(texts)
    for i, t in texts.items():
        n, form, p, m, out = plain(i, t)
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, p, m, brute.sha(out), brute.sha(t or ""))
    assert {r.form for r in got.values()} == {"plain", "psm", "spm"}


def test_awkward_rows(spark):
    marked = [(200 + i, t, "x", "s", 1) for i, t in enumerate(["a <P> b", "<S>", "x<M>", "<P", "a<<S", "<<P>>", "é" * 50 + "abc ÀB", "🙂" * 20, "A" * 5000, ". " * 3000])]
    rows = brute.AWKWARD + marked + [(8, "same text here", "y", "t", 2)] + [(i, f"word{i} two, three <S and {i}", "x", "s", 1) for i in range(300, 500)]
    df = spark.createDataFrame(rows, brute.SCHEMA).withColumns({c: F.lit(7) for c in ("n", "form", "output", "prefix_chars", "middle_chars", "start", "ids")})
    got = sorted((tuple(r) for r in infill.fill_in_middle(df).collect()), key=repr)
    want = []
    for i, t, *_ in rows:
        n, form, p, m, out = plain(i, t)
        want.append((i, n, form, p, m, brute.sha(out), brute.sha(t or ""), out))
    assert got == sorted(want, key=repr)
    assert infill.fill_in_middle(brute.empty(spark)).count() == 0
    all_cut = infill.fill_in_middle(df, plain_percent=0, suffix_first_percent=100)
    assert {r.form for r in all_cut.filter("doc_id >= 300").collect()} == {"spm"}


def test_wavelet_matrix_ranks():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, size).astype(np.uint8)
        matrix = infill.WaveletMatrix(symbols, 2)
        places = np.arange(size + 1)
        for c in range(4):
            assert matrix.rank(c, places).tolist() == [int((symbols[:i] == c).sum()) for i in places]
