"""Queries for splits, evaluation, attribution, resampling and models."""

from pyspark.sql import functions as F

from starsift.functions import labels
from starsift.functions import text as tx
from starsift.operators import attribution as at
from starsift.operators import cleaning, evaluate, models, resample, search, sentiment, text_models
from starsift.queries.corpus import VT
from starsift.queries.oracle import over, words
from starsift.queries.registry import query
from starsift.sources import adapters as ad
from starsift.sources import artifacts, durable


def _scores(s, d):
    return ad.labelled_scores(s, d).select("doc_id", "label", "score", "prediction", "lang")


@query(
    "train_test_split",
    "L-06",
    over("reviews", "SELECT review_id, (review_id * 7919) % 10000 < 2000 AS is_test FROM reviews"),
)
def train_test_split(s, d):
    r = ad.text_reviews(s, d).select("review_id")
    return evaluate.split(r, "review_id", 0.2, bucket=(F.col("review_id") * 7919) % 10000)


@query(
    "hash_split_shares",
    "L-06",
    over("reviews", "SELECT star_rating, true AS within_two_points FROM reviews GROUP BY 1"),
)
def hash_split_shares(s, d):
    """The hashed split stays near the wanted share in every class."""
    r = evaluate.stratified_split(ad.text_reviews(s, d).select("review_id", "star_rating"), "review_id", "star_rating", 0.2)
    share = F.count_if("is_test") / F.count("*")
    return r.groupBy("star_rating").agg((F.abs(share - 0.2) < 0.02).alias("within_two_points"))


@query("fold_assignment", "L-07", over("reviews", "SELECT review_id, cast(review_id % 5 AS int) AS fold FROM reviews"))
def fold_assignment(s, d):
    return evaluate.folds(ad.text_reviews(s, d).select("review_id"), "review_id", 5, bucket=F.col("review_id") % 5)


@query(
    "class_weights",
    "E-40",
    over(
        "scores",
        """SELECT label, count(*) AS n, round((SELECT count(*) FROM scores) / ((SELECT count(DISTINCT label) FROM scores) * count(*)), 6)
                  AS weight FROM scores GROUP BY 1""",
    ),
)
def class_weights(s, d):
    return evaluate.class_weights(_scores(s, d), "label")


@query("label_counts", "E-41", over("scores", "SELECT label, count(*) AS n FROM scores GROUP BY 1"))
def label_counts(s, d):
    return evaluate.label_counts(_scores(s, d), "label")


@query(
    "ensemble_labels",
    "L-16",
    over(
        "reviews",
        """, p AS (SELECT review_id, compound, star_rating / 15.0 AS a, (5 - star_rating) / 15.0 + 1.0 / 3 AS b FROM reviews),
        e AS (SELECT review_id, 0.6 * b + 0.4 * least(greatest((-compound - 0.05) / 0.95, 0), 1) AS neg,
                     0.6 * (1 - a - b) + 0.4 * greatest(1 - least(greatest((compound - 0.05) / 0.95, 0), 1)
                       - least(greatest((-compound - 0.05) / 0.95, 0), 1), 0) AS neu,
                     0.6 * a + 0.4 * least(greatest((compound - 0.05) / 0.95, 0), 1) AS pos FROM p)
        SELECT review_id, round(neg, 6) AS p_neg, round(neu, 6) AS p_neu, round(pos, 6) AS p_pos,
               CASE WHEN round(neg, 6) >= round(neu, 6) AND round(neg, 6) >= round(pos, 6) THEN 0
                    WHEN round(neu, 6) >= round(pos, 6) THEN 1 ELSE 2 END AS cls FROM e""",
    ),
)
def ensemble_labels(s, d):
    a = F.col("star_rating") / 15.0
    b = (5 - F.col("star_rating")) / 15.0 + 1.0 / 3
    p = F.transform(sentiment.ensemble(F.array(b, 1 - a - b, a), F.col("compound")), lambda x: F.round(x, 6))
    return ad.text_reviews(s, d).select("review_id", p.alias("p")).select(
        "review_id", F.col("p")[0].alias("p_neg"), F.col("p")[1].alias("p_neu"), F.col("p")[2].alias("p_pos"),
        sentiment.argmax(F.col("p")).alias("cls"),
    )


@query(
    "ensemble_binary",
    "L-16",
    over(
        "reviews",
        """SELECT review_id, round(0.6 * (star_rating / 5.0) + 0.4 * ((compound + 1) / 2), 6) AS p_pos FROM reviews""",
    ),
)
def ensemble_binary(s, d):
    a = F.col("star_rating") / 5.0
    p = sentiment.ensemble(F.array(1 - a, a), F.col("compound"), mode="binary")
    return ad.text_reviews(s, d).select("review_id", p[1].alias("p_pos"))


@query(
    "confusion_matrix",
    "L-18 G-08",
    over(
        "scores",
        """, g AS (SELECT a.range AS actual, p.range AS predicted FROM range(0, 2) a, range(0, 2) p),
        c AS (SELECT label, prediction, count(*) AS n FROM scores GROUP BY 1, 2),
        f AS (SELECT cast(actual AS int) AS actual, cast(predicted AS int) AS predicted, coalesce(n, 0) AS n
              FROM g LEFT JOIN c ON label = actual AND prediction = predicted)
        SELECT *, round(n / sum(n) OVER (PARTITION BY actual), 6) AS row_share FROM f""",
    ),
)
def confusion_matrix(s, d):
    return evaluate.confusion(_scores(s, d), "label", "prediction", [0, 1])


PER = """, k AS (SELECT cast(range AS int) AS cls FROM range(0, 2)),
  t AS (SELECT cls, count(*) FILTER (WHERE label = cls AND prediction = cls) AS tp, count(*) FILTER (WHERE label = cls) AS support,
               count(*) FILTER (WHERE prediction = cls) AS predicted FROM k, scores GROUP BY 1),
  u AS (SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall FROM t),
  per AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM u)"""


@query(
    "per_class_report",
    "L-19",
    over("scores", PER + """ SELECT cls, tp, support, predicted, round(precision, 6) AS precision, round(recall, 6) AS recall,
                             round(f1, 6) AS f1 FROM per"""),
)
def per_class_report(s, d):
    return evaluate.per_class_report(_scores(s, d), "label", "prediction", [0, 1])


@query(
    "class_report",
    "L-19",
    over(
        "scores",
        PER
        + """ SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(recall), 6) AS balanced_accuracy,
              round(avg(precision), 6) AS precision_macro, round(avg(recall), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro,
              round(sum(precision * support) / sum(support), 6) AS precision_weighted,
              round(sum(recall * support) / sum(support), 6) AS recall_weighted,
              round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM per""",
    ),
)
def class_report(s, d):
    return evaluate.class_report(_scores(s, d), "label", "prediction", [0, 1])


@query(
    "roc_auc",
    "L-20",
    over(
        "scores",
        """, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM scores),
        k AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n, sum(rk) FILTER (WHERE label = 1) AS sr FROM r)
        SELECT round((sr - p * (p + 1) / 2) / (p * n), 6) AS auc, p AS positives, n AS negatives FROM k""",
    ),
)
def roc_auc(s, d):
    return evaluate.roc_auc(_scores(s, d), "label", "score")


@query(
    "roc_auc_weighted",
    "L-20",
    over(
        "scores",
        """, x AS (SELECT lang, 'en' AS c, lang = 'en' AS y, score AS s FROM scores
                   UNION ALL SELECT lang, 'fr', lang = 'fr', 1 - score FROM scores
                   UNION ALL SELECT lang, 'de', lang = 'de', score / 2 FROM scores),
        r AS (SELECT c, y, rank() OVER (PARTITION BY c ORDER BY s) + (count(*) OVER (PARTITION BY c, s) - 1) / 2 AS rk FROM x),
        k AS (SELECT c, count(*) FILTER (WHERE y) AS p, count(*) FILTER (WHERE NOT y) AS n, sum(rk) FILTER (WHERE y) AS sr FROM r GROUP BY 1)
        SELECT round(sum((sr - p * (p + 1) / 2) / (p * n) * p) / sum(p), 6) AS auc_weighted FROM k""",
    ),
)
def roc_auc_weighted(s, d):
    df = _scores(s, d).withColumns({"s_en": F.col("score"), "s_fr": 1 - F.col("score"), "s_de": F.col("score") / 2})
    return evaluate.roc_auc_weighted(df, "lang", {"en": "s_en", "fr": "s_fr", "de": "s_de"})


@query(
    "regression_report",
    "L-21",
    over(
        "reviews",
        """, t AS (SELECT CASE WHEN helpfulness_denominator > 0 THEN helpfulness_numerator / helpfulness_denominator ELSE 0 END AS a,
                          coalesce(predicted_helpfulness, 0.5) AS p FROM reviews),
        c AS (SELECT count(*) FILTER (WHERE a >= .5 AND p >= .5) AS tp, count(*) FILTER (WHERE a < .5 AND p >= .5) AS fp,
                     count(*) FILTER (WHERE a >= .5 AND p < .5) AS fn, count(*) FILTER (WHERE a < .5 AND p < .5) AS tn,
                     avg(((p - a) * 100) * ((p - a) * 100)) AS mse, avg(abs(p - a) * 100) AS mae, corr(a, p) AS r FROM t)
        SELECT round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse, round(mae, 6) AS mae, round(r, 6) AS pearson_r,
               round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
               round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp)) / (tp + fp + fn + tn), 6) AS f1_weighted
        FROM c""",
    ),
)
def regression_report(s, d):
    from starsift.functions import features as ft

    a = ft.helpfulness_ratio(F.col("helpfulness_numerator"), F.col("helpfulness_denominator"))
    r = ad.text_reviews(s, d).select(a.alias("a"), F.coalesce("predicted_helpfulness", F.lit(0.5)).alias("p"))
    return evaluate.regression_report(r, "a", "p")


def _curve_sql(thresholds) -> str:
    rows = ", ".join(f"(cast({t} AS double))" for t in thresholds)
    return f""", th AS (SELECT * FROM (VALUES {rows}) v(threshold)),
    c AS (SELECT threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 1 AND score >= threshold) AS tp,
                 count(*) FILTER (WHERE score >= threshold) AS pp FROM th, scores GROUP BY 1),
    curve AS (SELECT threshold, coalesce(tp / nullif(pp, 0), 0) AS precision, coalesce(tp / nullif(pos, 0), 0) AS recall,
                 coalesce(2 * tp / nullif(pp + pos, 0), 0) AS f1 FROM c)"""


@query(
    "threshold_curve",
    "L-22",
    over(
        "scores",
        _curve_sql(evaluate.CURVE) + " SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM curve",
    ),
)
def threshold_curve(s, d):
    return evaluate.threshold_curve(_scores(s, d), "label", "score", evaluate.CURVE)


@query(
    "threshold_scan",
    "L-22",
    over("scores", _curve_sql(evaluate.SCAN) + " SELECT threshold, round(f1, 6) AS f1 FROM curve ORDER BY round(f1, 9) DESC, threshold LIMIT 1"),
)
def threshold_scan(s, d):
    return evaluate.threshold_scan(_scores(s, d), "label", "score")


@query(
    "confidence_histogram",
    "L-23",
    over(
        "scores",
        """SELECT least(cast(floor(greatest(score, 1 - score) / 0.04) AS int), 24) AS bin,
                  count(*) FILTER (WHERE label = prediction) AS n_correct, count(*) FILTER (WHERE label <> prediction) AS n_wrong
           FROM scores GROUP BY 1""",
    ),
)
def confidence_histogram(s, d):
    df = _scores(s, d).withColumn("confidence", F.greatest("score", 1 - F.col("score")))
    return evaluate.confidence_hist(df, "confidence", F.col("label") == F.col("prediction"))


@query(
    "residual_histogram",
    "L-23",
    over(
        "scores",
        "SELECT least(cast(floor(((score - label) * 100 + 100) / 8.0) AS int), 24) AS bin, count(*) AS n FROM scores GROUP BY 1",
    ),
)
def residual_histogram(s, d):
    return evaluate.residual_hist(_scores(s, d), "label", "score")


@query(
    "population_stability",
    "L-32",
    """WITH b AS (SELECT value AS v FROM events WHERE ts < TIMESTAMP '2024-01-16'), c AS (SELECT value * 1.2 AS v FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
       q AS (SELECT quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM b),
       bs AS (SELECT len(list_filter(q, lambda e: e < v)) AS bin, count(*) / sum(count(*)) OVER () AS s FROM b, q GROUP BY 1),
       cs AS (SELECT len(list_filter(q, lambda e: e < v)) AS bin, count(*) / sum(count(*)) OVER () AS s FROM c, q GROUP BY 1),
       j AS (SELECT greatest(coalesce(bs.s, 1e-6), 1e-6) AS b, greatest(coalesce(cs.s, 1e-6), 1e-6) AS c FROM bs FULL JOIN cs USING (bin))
       SELECT 'value' AS feature, round(sum((c - b) * ln(c / b)), 6) AS psi, sum((c - b) * ln(c / b)) > 0.2 AS drifted FROM j""",
)
def population_stability(s, d):
    e = ad.table(s, d, "events").select("ts", "value")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    base = e.filter(F.col("ts") < cut)
    current = e.filter(F.col("ts") >= cut).withColumn("value", F.col("value") * 1.2)
    return evaluate.psi(base, current, "value")


@query(
    "validation_gates",
    "L-33",
    over(
        "scores",
        PER
        + """, m AS (SELECT sum(f1 * support) / sum(support) AS wf1, sum(tp) / sum(support) AS acc FROM per)
        SELECT 'sentiment_weighted_f1' AS metric, round(wf1, 6) AS value, 0.85 AS bound, wf1 >= 0.85 AS passed FROM m
        UNION ALL SELECT 'aspect_accuracy', round(acc, 6), 0.82, acc >= 0.82 FROM m
        UNION ALL SELECT 'ner_f1', NULL, 0.80, false UNION ALL SELECT 'helpfulness_rmse', NULL, 0.12, false""",
    ),
)
def validation_gates(s, d):
    report = evaluate.class_report(_scores(s, d), "label", "prediction", [0, 1])
    metrics = evaluate.metrics_long(report, {"f1_weighted": "sentiment_weighted_f1", "accuracy": "aspect_accuracy"})
    return evaluate.gate(metrics)


ATTR = """attr AS (SELECT l_orderkey AS id, concat('f', l_linenumber) AS feature, l_returnflag AS cls, sum(l_discount - 0.05) AS attribution
          FROM lineitem GROUP BY 1, 2, 3)"""


def _attr(s, d):
    return (
        ad.table(s, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"), F.concat(F.lit("f"), "l_linenumber").alias("feature"), F.col("l_returnflag").alias("cls"))
        .agg(F.sum(F.col("l_discount") - 0.05).alias("attribution"))
    )


@query(
    "global_importance",
    "L-29",
    f"""WITH {ATTR}, g AS (SELECT cls, feature, round(avg(abs(attribution)), 6) AS mean_abs, round(avg(attribution), 6) AS mean_signed FROM attr GROUP BY ALL),
    k AS (SELECT *, cast(row_number() OVER (PARTITION BY cls ORDER BY mean_abs DESC, feature) AS int) AS rank FROM g)
    SELECT * FROM k WHERE rank <= 5""",
)
def global_importance(s, d):
    return at.global_importance(_attr(s, d), 5)


_LF = """lf AS (SELECT id, feature, sum(attribution) AS attribution FROM attr GROUP BY ALL)"""


@query(
    "explained_rows",
    "L-30 G-07",
    f"""WITH {ATTR}, {_LF}, k AS (SELECT *, cast(row_number() OVER (PARTITION BY id ORDER BY round(abs(attribution), 6) DESC, feature) AS int) AS rank FROM lf),
    w AS (SELECT id, rank, feature, attribution FROM k WHERE rank <= 2
          UNION ALL SELECT id, 3, 'other', sum(attribution) FROM k WHERE rank > 2 GROUP BY id HAVING abs(sum(attribution)) > 1e-9)
    SELECT id, rank, feature, round(attribution, 6) AS attribution,
           round(sum(attribution) OVER (PARTITION BY id ORDER BY rank ROWS UNBOUNDED PRECEDING), 6) AS running FROM w""",
)
def explained_rows(s, d):
    lf = _attr(s, d).groupBy("id", "feature").agg(F.round(F.sum("attribution"), 9).alias("attribution"))
    return at.explain_rows(lf, "id", 2)


@query(
    "token_contributions",
    "L-31",
    over(
        "reviews",
        """, a AS (SELECT review_id, unnest(['battery', 'price', 'camera']) AS word, unnest([compound, star_rating / 5.0, 0.5]) AS value FROM reviews),
        p AS (SELECT review_id, max(abs(value)) AS peak FROM a GROUP BY 1),
        l AS (SELECT review_id, regexp_extract_all(review_text, '[A-Za-z0-9_'']+') AS toks FROM reviews),
        t AS (SELECT review_id, unnest(toks) AS token, cast(generate_subscripts(toks, 1) - 1 AS int) AS pos FROM l)
        SELECT t.review_id, pos, token, round(coalesce(value, 0), 6) AS contribution,
               round(least(abs(coalesce(value, 0)) / (peak + 1e-9), 1), 6) AS intensity
        FROM t LEFT JOIN a ON t.review_id = a.review_id AND lower(token) = word JOIN p ON p.review_id = t.review_id""",
    ),
)
def token_contributions(s, d):
    r = ad.text_reviews(s, d)
    cells = F.array(
        *[F.struct(F.lit(w).alias("feature"), v.alias("attribution"))
          for w, v in (("battery", F.col("compound")), ("price", F.col("star_rating") / 5.0), ("camera", F.lit(0.5)))]
    )
    attr = r.select("review_id", F.inline(cells))
    return at.token_contributions(r, "review_id", "review_text", attr)


# --- models: rows-only checks -------------------------------------------------------


def _labelled(s, d):
    r = ad.text_reviews(s, d)
    return models.indexed(
        r.select("review_id", "compound", labels.star_label(F.col("star_rating")).alias("label"),
                 tx.preprocess_text(F.col("review_text"), 3, digits="drop").alias("text")),
        "label",
    )


def _vectors(s, d, max_features=5000, max_n=2):
    rows, vocab = models.text_vectors(_labelled(s, d), "review_id", "text", max_features, max_n, extra=["compound"])
    return rows.drop("text"), vocab


def _held_out(rows):
    """(rows to fit, how many, rows to score)."""
    parts = evaluate.split(rows, "review_id", 0.2)
    train = parts.filter(~F.col("is_test"))
    return train, train.count(), parts.filter("is_test")


@query("helpfulness_feature_rows", "L-01")
def helpfulness_feature_rows(s, d):
    r = ad.text_reviews(s, d).withColumnsRenamed({"review_text": "clean_review_text", "star_rating": "Score"})
    return models.helpfulness_features(r).select("review_id", *models.fv.HELPFULNESS_COLUMNS)


def _helpfulness_rows(s, d):
    """What a fit or a score reads, and no text."""
    from starsift.functions import features as ft

    r = ad.text_reviews(s, d).withColumnsRenamed({"review_text": "clean_review_text", "star_rating": "Score"})
    target = ft.helpfulness_ratio(F.col("helpfulness_numerator"), F.col("helpfulness_denominator"))
    return models.helpfulness_features(r).select("review_id", *models.fv.HELPFULNESS_COLUMNS, "helpfulness_denominator", target.alias("target"))


def _exposed(rows):
    return cleaning.filter_exposure(rows, 5, votes="helpfulness_denominator")


@query("scored_helpfulness", "L-02 L-03 A-18")
def scored_helpfulness(s, d):
    rows = durable.materialise(_helpfulness_rows(s, d))
    model = models.fit_helpfulness(_exposed(rows))
    return models.score_helpfulness(rows, model).select("review_id", "predicted_helpfulness")


@query("helpfulness_importances", "L-04")
def helpfulness_importances(s, d):
    # only the rows that are fitted on get features
    train = durable.materialise(_exposed(_helpfulness_rows(s, d)))
    return models.importances(s, models.fit_helpfulness(train))


@query("logistic_predictions", "L-08 L-17")
def logistic_predictions(s, d):
    train, n, test = _held_out(_vectors(s, d)[0])
    model = models.logistic_regression(n).fit(train)
    return models.predict_batch(test, model).select("review_id", "predicted_label", "confidence", "p_negative", "p_neutral", "p_positive")


@query("calibrated_svc_predictions", "L-09")
def calibrated_svc_predictions(s, d):
    train, n, test = _held_out(_vectors(s, d, 500, 1)[0])
    svc, calibrate = models.fit_calibrated_svc(train, "review_id", n, iterations=20)
    return models.apply_calibrated(test, svc, calibrate).groupBy("label", "prediction").agg(F.count("*").alias("n"))


@query("forest_predictions", "L-10")
def forest_predictions(s, d):
    train, _, test = _held_out(_vectors(s, d, 500, 1)[0])
    model = models.random_forest(trees=20, depth=10).fit(train)
    return models.predict_batch(test, model).groupBy("label", "predicted_label").agg(F.count("*").alias("n"))


#: Naive Bayes over held-in documents, in SQL: vocabulary, idf and class weights see only rows that are not held out.
_BAYES = f"""WITH d AS (SELECT doc_id, lang, {VT} AS w, (doc_id * 7919) % 10000 < 2000 AS held FROM documents),
  c AS (SELECT doc_id, lang, held, term, count(*) AS tf FROM (SELECT doc_id, lang, held, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) AS term FROM d) GROUP BY ALL),
  n AS (SELECT count(*) AS n FROM d WHERE NOT held),
  v AS (SELECT term, count(*) AS df FROM c, n WHERE NOT held GROUP BY term HAVING count(*) BETWEEN 2 AND 0.95 * any_value(n) ORDER BY sum(tf) DESC, term LIMIT 5000),
  r AS (SELECT doc_id, lang, held, term, (1 + ln(tf)) * (ln((1 + n) / (1 + df)) + 1) AS w FROM c JOIN v USING (term), n),
  x AS (SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM r),
  k AS (SELECT lang AS cls, count(*) AS size FROM d WHERE NOT held GROUP BY 1),
  s AS (SELECT lang AS cls, term, sum(weight) AS s FROM x WHERE NOT held GROUP BY ALL),
  g AS (SELECT cls, term, coalesce(s, 0) + 0.1 AS mass FROM k CROSS JOIN v LEFT JOIN s USING (cls, term)),
  t AS (SELECT cls, term, ln(mass / sum(mass) OVER (PARTITION BY cls)) AS theta FROM g),
  m AS (SELECT doc_id, cls, sum(weight * theta) AS m FROM x JOIN t USING (term) WHERE held GROUP BY ALL),
  p AS (SELECT d.doc_id, d.lang AS label, k.cls, coalesce(m.m, 0) + ln((size + 0.1) / ((SELECT n FROM n) + 0.1 * (SELECT count(*) FROM k))) AS m
        FROM d CROSS JOIN k LEFT JOIN m ON m.doc_id = d.doc_id AND m.cls = k.cls WHERE held),
  e AS (SELECT *, exp(m - max(m) OVER (PARTITION BY doc_id)) AS e FROM p)
  SELECT doc_id, label, arg_min(cls, (-e, cls)) AS predicted_label, round(max(e) / sum(e), 4) AS confidence FROM e GROUP BY ALL"""


@query("bayes_predictions", "L-11 L-17 A-18", _BAYES)
def bayes_predictions(s, d):
    """Fitted on held-in documents, stored as a version, read back and applied to the held-out ones."""
    docs = evaluate.split(ad.documents(s, d).select("doc_id", "text", F.col("lang").alias("label")), "doc_id", 0.2, bucket=(F.col("doc_id") * 7919) % 10000)
    folder = durable.folder(s, "models")
    artifacts.save(s, folder, "bayes", text_models.fit_bayes(docs.filter(~F.col("is_test")), "doc_id", "text", "label"))
    model, _, _ = artifacts.load(s, folder, "bayes")
    out = text_models.classify(docs.filter("is_test"), "doc_id", "text", model)
    return out.select("doc_id", "label", "predicted_label", F.round("confidence", 4).alias("confidence"))


@query("stratified_fold_sizes", "L-07", "SELECT lang, 5 AS folds, true AS even, count(*) AS n FROM documents GROUP BY lang")
def stratified_fold_sizes(s, d):
    """Folds of every class differ by at most two rows."""
    rows = search.stratified_folds(ad.documents(s, d).select("doc_id", "lang"), "doc_id", "lang", 5)
    sizes = rows.groupBy("lang", "fold").agg(F.count("*").alias("n"))
    return sizes.groupBy("lang").agg(F.count("*").cast("int").alias("folds"), (F.max("n") - F.min("n") <= 2).alias("even"), F.sum("n").alias("n"))


_SETTINGS = search.grid()


@query(
    "searched_models",
    "L-07 L-09 L-11 L-12 L-13 L-15",
    "SELECT f AS max_features, g AS max_n, kind, strength, balanced, true AS scored, true AS best_beats_majority FROM (VALUES "
    + ", ".join(f"('{x.kind}', cast({x.strength} AS double), {str(x.balanced).lower()})" for x in _SETTINGS)
    + f") v(kind, strength, balanced), (SELECT unnest({list(search.GRID['max_features'])}) AS f), (SELECT unnest({list(search.GRID['max_n'])}) AS g)",
)
def searched_models(s, d):
    """The whole grid over features, n-grams, C, class weights and model kinds on five stratified folds, by language."""
    docs = ad.documents(s, d).select("doc_id", "lang", "text")
    classes = [r.lang for r in docs.select("lang").filter("lang IS NOT NULL").distinct().orderBy("lang").collect()]
    found = search.search(s, docs, "doc_id", "text", "lang", classes, _SETTINGS)
    share = evaluate.label_counts(docs, "lang").agg((F.max("n") / F.sum("n")).alias("share")).first().share
    best = found.agg(F.max("accuracy").alias("a")).first().a
    scored = F.col("f1_macro").between(0, 1) & F.col("f1_weighted").between(0, 1) & F.col("accuracy").between(0, 1)
    return found.select("max_features", "max_n", "kind", "strength", "balanced", scored.alias("scored"), F.lit(best > share).alias("best_beats_majority"))


@query("model_comparison", "L-12")
def model_comparison(s, d):
    rows = models.text_vectors(_labelled(s, d), "review_id", "text")[0].drop("text", "label", "compound")
    n = rows.count()
    _, _, table = models.compare_models(
        rows, {"Logistic Regression": models.logistic_regression(n), "Naive Bayes": models.naive_bayes(), "Random Forest": models.random_forest()}
    )
    return table


#: C of the searched logistic regressions.
_STRENGTHS = (0.1, 0.5, 1.0, 5.0)


@query("grid_search_results", "L-13 L-15")
def grid_search_results(s, d):
    rows = models.text_vectors(_labelled(s, d), "review_id", "text")[0].drop("text", "label", "compound")
    n = rows.count()
    cv = models.grid_search(rows, models.logistic_regression(n), {"regParam": [1.0 / (c * n) for c in _STRENGTHS]})
    return models.search_results(s, cv)


@query("random_search_results", "L-14 L-15")
def random_search_results(s, d):
    rows = models.text_vectors(_labelled(s, d), "review_id", "text")[0].drop("text", "label", "compound")
    cv = models.random_search(rows, models.naive_bayes(), {"smoothing": (0.001, 10.0)})
    return models.search_results(s, cv)


@query("top_coefficients", "L-24")
def top_coefficients(s, d):
    rows, vocab = models.text_vectors(_labelled(s, d), "review_id", "text")
    model = models.logistic_regression(rows.count()).fit(rows)
    return models.top_coefficients(s, model, vocab)


@query("linear_attributions", "L-28 L-30")
def linear_attributions(s, d):
    rows, vocab = models.text_vectors(_labelled(s, d), "review_id", "text")
    n = rows.count()
    model = models.logistic_regression(n).fit(rows)
    cells = at.vector_cells(rows, "review_id", "features")
    means = at.feature_means(cells, F.lit(n))
    attr = at.linear_attributions(rows, "review_id", "features", models.coefficient_rows(s, model), means)
    named = at.name_features(attr, vocab.select("idx", F.col("term").alias("feature")))
    return at.global_importance(named, 10)


@query("lsa_components", "F-15")
def lsa_components(s, d):
    docs = ad.documents(s, d).select("doc_id", "text")
    rows, _ = models.text_vectors(docs, "doc_id", "text", 300, 1, name="v")
    _, reduced = models.lsa(rows, "v", 10, 300)
    from pyspark.ml.functions import vector_to_array

    return reduced.select("doc_id", *[F.abs(vector_to_array("lsa")[i]).alias(f"lsa_{i}") for i in range(10)])


@query("text_feature_block", "L-34")
def text_feature_block(s, d):
    from pyspark.ml.functions import vector_to_array

    docs = ad.documents(s, d).select("doc_id", "text")
    return models.text_feature_block(docs, "doc_id", "text", 128, 16).select(
        "doc_id", F.size(vector_to_array("text_features")).alias("width")
    )


def _two_class(s, d):
    e = ad.table(s, d, "embeddings")
    return e.select("vec_id", F.when(F.col("label") <= 1, "rare").otherwise("common").alias("cls"), "embedding")


@query("smote_rows", "L-25")
def smote_rows(s, d):
    return resample.smote(_two_class(s, d), "vec_id", "cls", "embedding", 64).select("cls", "source_id", "embedding")


@query("adasyn_rows", "L-26")
def adasyn_rows(s, d):
    return resample.adasyn(_two_class(s, d), "vec_id", "cls", "embedding", 64).select("cls", "source_id", "embedding")


@query(
    "undersampled",
    "L-27",
    """WITH c AS (SELECT CASE WHEN label <= 1 THEN 'rare' ELSE 'common' END AS cls, count(*) AS n FROM embeddings GROUP BY 1),
       k AS (SELECT cls, least((SELECT min(n) FROM c) / 0.5 / n, 1.0) AS keep FROM c)
       SELECT vec_id, cls FROM (SELECT vec_id, CASE WHEN label <= 1 THEN 'rare' ELSE 'common' END AS cls FROM embeddings) JOIN k USING (cls)
       WHERE ((vec_id * 7919) % 1000000) / 1000000 < keep""",
)
def undersampled(s, d):
    out = resample.undersample(_two_class(s, d), "vec_id", "cls", 0.5, bucket=(F.col("vec_id") * 7919) % 1_000_000)
    return out.select("vec_id", "cls")


@query("tomek_cleaned", "L-27")
def tomek_cleaned(s, d):
    return resample.remove_tomek(_two_class(s, d), "vec_id", "cls", "embedding", 64).select("vec_id", "cls")
