"""The document table and noun phrases: every step, every row."""

from starsift.operators import corpus
from starsift.queries import corpus as queries


def test_noun_phrases_are_returned_for_every_document(spark, tmp_path):
    rows = [(1, "an engine quickly moving wheel dogs"), (2, ""), (3, None), (4, "bigger dog quickly bigger dog")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: (r.phrases, r.has_phrases, r.tokens) for r in queries.noun_phrases(spark, str(tmp_path)).collect()}
    assert out == {1: ("an engine | wheel dogs", True, 6), 2: ("", False, 0), 3: ("", False, 0), 4: ("bigger dog", True, 5)}


def test_document_table_has_lemmas_and_noun_phrases(spark, tmp_path):
    rows = [(1, "Fast servers quickly moving servers, server"), (2, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.document_table(spark, str(tmp_path)).collect()}
    assert out[1].processed_text == "fast server quickly moving server server"
    assert out[1].top_keywords == "server, fast, moving, quickly"
    assert out[1].noun_phrases == "fast servers" and out[1].token_count == 6 and out[1].bigram_count == 5
    assert (out[2].processed_text, out[2].noun_phrases, out[2].token_count) == ("", "", 0)


def test_rows_with_one_key_or_none_keep_their_own_words(spark):
    rows = [(1, "red cars"), (1, "red cars"), (1, "blue boats"), (None, "green cars"), (None, None)]
    df = spark.createDataFrame(rows, "id int, text string")
    tags = spark.createDataFrame([("red", "JJ"), ("blue", "VBG")], "token string, tag string")
    lemmas = spark.createDataFrame([("cars", "car"), ("boats", "boat")], "token string, lemma string")
    out = corpus.process_documents(df, "id", "text", tags, lemmas).collect()
    assert sorted((r.text or "", r.processed_text, r.noun_phrases, r.token_count) for r in out) == [
        ("", "", "", 0), ("blue boats", "blue boat", "", 2), ("green cars", "green car", "green cars", 2),
        ("red cars", "red car", "red cars", 2), ("red cars", "red car", "red cars", 2)]
