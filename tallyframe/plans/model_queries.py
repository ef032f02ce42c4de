"""Metrics, models, reduction and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cluster as cl
from ..operators import density as dn
from ..operators import metrics as mt
from ..operators import modeling as md
from ..operators import panel as pn
from ..operators import reduce as rd
from ..operators import silhouette as si
from ..operators import splits as sp
from ..operators.entity_ols import expanding_ols, fit_fold_ols
from ..session import scratch_path
from ..sources.tables import load_step, read_table, save_model
from . import flows
from . import frames as fr
from .catalog import query

TARGETED = fr.targeted_sql(fr.BARS_SQL)


def _naive(spark, folder):
    return pn.next_day_target(fr.bars(spark, folder)).na.drop(subset=["target_close_next"])


@query("m5_persistence", f"""WITH {TARGETED} SELECT "Name", CAST(target_date AS VARCHAR) AS target_date, target_close_next AS actual, close AS predicted FROM targeted WHERE target_close_next IS NOT NULL""", "actual predicted")
def _(spark, folder):
    return _naive(spark, folder).select("Name", "target_date", F.col("target_close_next").alias("actual"), F.col("close").alias("predicted"))


ERRORS = """count(*) AS rows, avg(abs(p - a)) AS mae, sqrt(avg((p - a) * (p - a))) AS rmse, 1 - avg((p - a) * (p - a)) / var_pop(a) AS r2,
  avg(abs(p - a) / greatest(abs(a), 2.220446049250313e-16)) * 100 AS mape_percent"""


@query("m9_regression_metrics", f"""WITH {TARGETED}, e AS (SELECT target_close_next AS a, close AS p FROM targeted WHERE target_close_next IS NOT NULL) SELECT {ERRORS} FROM e""", "mae rmse r2 mape_percent")
def _(spark, folder):
    return mt.regression_metrics(_naive(spark, folder), "target_close_next", "close")


@query("m9_regression_metrics_by_entity", f"""WITH {TARGETED}, e AS (SELECT "Name", target_close_next AS a, close AS p FROM targeted WHERE target_close_next IS NOT NULL) SELECT "Name", {ERRORS} FROM e GROUP BY 1""", "mae rmse r2 mape_percent")
def _(spark, folder):
    return mt.regression_metrics(_naive(spark, folder), "target_close_next", "close", ["Name"])


def _rule(spark, folder):
    """Order outcome against a fixed priority rule, with a split by year."""
    df = read_table(spark, folder, "orders")
    return df.select(
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("actual"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "yes").otherwise("no").alias("predicted"),
        F.when(F.year("o_orderdate") < 1998, "train").otherwise("test").alias("split"),
    )


RULE = """WITH r AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS actual, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'yes' ELSE 'no' END AS predicted,
  CASE WHEN year(o_orderdate) < 1998 THEN 'train' ELSE 'test' END AS split FROM orders)"""
SCORES = """, s AS (SELECT split, l AS label, count(*) FILTER (WHERE actual = l AND predicted = l) AS hits, count(*) FILTER (WHERE actual = l) AS support, count(*) FILTER (WHERE predicted = l) AS claimed, count(*) AS total
  FROM r, (SELECT unnest(['no', 'yes']) AS l) GROUP BY 1, 2),
c AS (SELECT *, hits / claimed::DOUBLE AS precision, hits / support::DOUBLE AS recall, 2.0 * hits / (claimed + support) AS f1 FROM s)"""
MEASURES = """max(total) AS rows, sum(hits) / max(total)::DOUBLE AS accuracy, avg(recall) AS balanced_accuracy, max(precision) FILTER (WHERE label = 'yes') AS precision_positive,
  max(recall) FILTER (WHERE label = 'yes') AS recall_positive, max(f1) FILTER (WHERE label = 'yes') AS f1_positive, avg(precision) AS precision_macro, avg(recall) AS recall_macro, avg(f1) AS f1_macro"""
MEASURE_NAMES = "accuracy balanced_accuracy precision_positive recall_positive f1_positive precision_macro recall_macro f1_macro"


@query("m10_confusion", RULE + """ SELECT a AS actual, p AS predicted, count(*) FILTER (WHERE actual = a AND predicted = p) AS count,
  100.0 * count(*) FILTER (WHERE actual = a AND predicted = p) / count(*) FILTER (WHERE actual = a) AS row_percent FROM r, (SELECT unnest(['no', 'yes']) AS a), (SELECT unnest(['no', 'yes']) AS p) GROUP BY 1, 2""", "row_percent")
def _(spark, folder):
    return mt.confusion(_rule(spark, folder), ["no", "yes"])


@query("m11_classification_report", RULE + SCORES + """, t AS (SELECT label, sum(hits) AS hits, sum(support) AS support, sum(claimed) AS claimed, sum(total) AS total FROM s GROUP BY 1),
k AS (SELECT label, hits, hits / claimed::DOUBLE AS precision, hits / support::DOUBLE AS recall, 2.0 * hits / (claimed + support) AS f1, support, total FROM t)
SELECT label, precision, recall, f1, support::BIGINT AS support FROM k UNION ALL SELECT 'accuracy', sum(hits) / max(total)::DOUBLE, sum(hits) / max(total)::DOUBLE, sum(hits) / max(total)::DOUBLE, max(total)::BIGINT FROM k
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM k
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM k""", "precision recall f1")
def _(spark, folder):
    return mt.classification_report(_rule(spark, folder), ["no", "yes"])


@query("m12_summary_metrics", RULE + SCORES + f" SELECT split, {MEASURES} FROM c GROUP BY 1", MEASURE_NAMES)
def _(spark, folder):
    return mt.summary_metrics(_rule(spark, folder), ["no", "yes"], "yes", by=["split"])


GAPPED = ["accuracy", "f1_positive", "f1_macro"]


@query("m14_generalisation_gap", RULE + SCORES + f", m AS (SELECT split, {MEASURES} FROM c GROUP BY 1) SELECT 'rule' AS model, " + ", ".join(
    f"max({g}) FILTER (WHERE split = 'train') AS {g}_train, max({g}) FILTER (WHERE split = 'test') AS {g}_test, max({g}) FILTER (WHERE split = 'train') - max({g}) FILTER (WHERE split = 'test') AS {g}_gap" for g in GAPPED
) + " FROM m", " ".join(f"{g}_{s}" for g in GAPPED for s in ("train", "test", "gap")))
def _(spark, folder):
    table = mt.summary_metrics(_rule(spark, folder), ["no", "yes"], "yes", by=["split"]).withColumn("model", F.lit("rule"))
    return mt.generalisation_gap(table, GAPPED, ["model"])


@query("a30_adjusted_rand", """WITH n AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY 1, 2),
x AS (SELECT sum(n::DOUBLE * (n - 1) / 2) AS joint, sum(n)::DOUBLE AS t FROM n), ra AS (SELECT sum(s * (s - 1) / 2) AS v FROM (SELECT sum(n)::DOUBLE AS s FROM n GROUP BY a)),
rb AS (SELECT sum(s * (s - 1) / 2) AS v FROM (SELECT sum(n)::DOUBLE AS s FROM n GROUP BY b))
SELECT (joint - ra.v * rb.v / (t * (t - 1) / 2)) / ((ra.v + rb.v) / 2 - ra.v * rb.v / (t * (t - 1) / 2)) AS adjusted_rand FROM x, ra, rb""", "adjusted_rand", digits=9)
def _(spark, folder):
    return mt.adjusted_rand(read_table(spark, folder, "lineitem", ["l_returnflag", "l_linestatus"]), "l_returnflag", "l_linestatus")


# Encoders and models ----------------------------------------------------------------------------

@query("d1_one_hot", """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 0 ELSE 1 END::DOUBLE AS hot_slots FROM part""", "hot_slots")
def _(spark, folder):
    df = read_table(spark, folder, "part").select("p_partkey", "p_type")
    prep = md.fit_preprocessor(df.where("p_type <> 'PROMO'"), [], ["p_type"])
    from pyspark.ml.functions import vector_to_array
    hot = F.aggregate(vector_to_array("features_vector"), F.lit(0.0), lambda a, b: a + b)
    return prep.transform(df).select("p_partkey", hot.alias("hot_slots"))


@query("d2_ordinal", """WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand <> 'Brand#13'))
SELECT p_partkey, coalesce(code, -1)::DOUBLE AS code FROM part LEFT JOIN c USING (p_brand)""", "code")
def _(spark, folder):
    df = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    prep = md.fit_preprocessor(df.where("p_brand <> 'Brand#13'"), [], ["p_brand"], encode="ordinal")
    return prep.transform(df).select("p_partkey", F.col("p_brand__ord").alias("code"))


def _orders_wide(spark, folder):
    """Orders with their customer's segment and balance: two targets, mixed features."""
    od = read_table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    cu = read_table(spark, folder, "customer", ["c_custkey", "c_acctbal", "c_mktsegment"])
    return od.join(cu, "c_custkey").select(
        "o_orderkey", "o_totalprice", "c_acctbal", "c_mktsegment", "o_orderpriority", F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("final"),
        F.when(F.col("o_totalprice") > 300000, "yes").otherwise("no").alias("large"),
    )


FEATURES = ["o_totalprice", "c_acctbal", "year", "c_mktsegment", "o_orderpriority"]
EXCLUSIONS = {"final": ["large"], "large": ["o_totalprice", "final"]}


WIDE = """w AS (SELECT o_orderkey, o_totalprice, c_acctbal, year(o_orderdate)::DOUBLE AS year, c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey),
seg AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT c_mktsegment AS v FROM w)),
pri AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT o_orderpriority AS v FROM w))"""


@query("d3_preprocessor", f"""WITH {WIDE}, z AS (SELECT o_orderkey, (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER () AS a,
  (c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER () AS b, coalesce((year - avg(year) OVER ()) / nullif(stddev_pop(year) OVER (), 0), 0) AS c FROM w)
SELECT o_orderkey, 0::BIGINT AS slot, a AS value FROM z UNION ALL SELECT o_orderkey, 1, b FROM z UNION ALL SELECT o_orderkey, 2, c FROM z
UNION ALL SELECT o_orderkey, 3 + code, (c_mktsegment = v)::INT::DOUBLE FROM w, seg
UNION ALL SELECT o_orderkey, 3 + (SELECT count(*) FROM seg) + code, (o_orderpriority = v)::INT::DOUBLE FROM w, pri""", "value")
def _(spark, folder):
    """Every slot of the encoded vector of every order."""
    df = _orders_wide(spark, folder)
    prep = md.fit_preprocessor(df, *md.split_columns(df, FEATURES))
    from pyspark.ml.functions import vector_to_array
    return prep.transform(df).select("o_orderkey", F.posexplode(vector_to_array("features_vector")).alias("slot", "value"))


def _grid(spark, folder):
    return flows.classification_study(_orders_wide(spark, folder), {"final": "yes", "large": "yes"}, ["o_orderkey"], EXCLUSIONS, trees=20, depth=8, max_iter=100)


@query("m15_experiment_grid")
def _(spark, folder):
    """Balanced logistic regression and forest for two targets, on train and test."""
    return _grid(spark, folder)[0]


@query("m13_train_test_gaps")
def _(spark, folder):
    return _grid(spark, folder)[1]


@query("m1_logistic_predictions")
def _(spark, folder):
    """Held-out predictions of the balanced logistic regression."""
    df = sp.stratified_split(_orders_wide(spark, folder).withColumn("label", (F.col("large") == "yes").cast("double")), "large", ["o_orderkey"])
    train = df.where("split = 'train'")
    prep = md.fit_preprocessor(train, *md.split_columns(df, ["c_acctbal", "year", "c_mktsegment", "o_orderpriority"]))
    ready = md.balanced_weights(prep.transform(train), "label")
    scored = md.logistic(ready.count()).fit(ready).transform(prep.transform(df.where("split = 'test'")))
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("m2_forest_importances")
def _(spark, folder):
    df = _orders_wide(spark, folder).withColumn("label", (F.col("large") == "yes").cast("double"))
    prep = md.fit_preprocessor(df, *md.split_columns(df, FEATURES))
    ready = md.balanced_weights(prep.transform(df), "label")
    return md.feature_importances(md.forest_classifier(trees=20, depth=8).fit(ready), ready)


def _ready(spark, folder):
    return flows.model_ready(fr.bars(spark, folder), fr.CUTOFF)


@query("m3_linear_forecast")
def _(spark, folder):
    return flows.forecast(_ready(spark, folder), models=["linear_regression"]).metrics.drop("fit_seconds", "predict_seconds")


@query("m3_entity_effects", f"""WITH {TARGETED}, r AS (SELECT "Name", close, volume, target_close_next AS t FROM targeted WHERE target_date < DATE '{fr.CUTOFF}'),
d AS (SELECT close - avg(close) OVER w AS a, volume - avg(volume) OVER w AS b, t - avg(t) OVER w AS y FROM r WINDOW w AS (PARTITION BY "Name")),
m AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS yb FROM d),
s AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS close_slope, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS volume_slope FROM m)
SELECT "Name", count(*) AS n, avg(t) - close_slope * avg(close) - volume_slope * avg(volume) AS effect, close_slope, volume_slope FROM r, s GROUP BY "Name", close_slope, volume_slope""", "effect close_slope volume_slope")
def _(spark, folder):
    """Least squares on two features with one intercept per entity."""
    from ..operators.entity_ols import fit_entity_ols

    model = fit_entity_ols(_ready(spark, folder).where("split = 'train'"), ["close", "volume"], "Name", "target_close_next")
    return model.effects.select("Name", "n", "effect", F.lit(model.slopes[0]).alias("close_slope"), F.lit(model.slopes[1]).alias("volume_slope"))


@query("m4_forest_forecast")
def _(spark, folder):
    return flows.forecast(_ready(spark, folder), models=["random_forest"]).metrics.drop("fit_seconds", "predict_seconds")


@query("m6_expanding_cv")
def _(spark, folder):
    train = _ready(spark, folder).where("split = 'train'")
    return md.expanding_cv(train, flows.FORECAST_NUMERIC, ["Name"], parallelism=5).drop("fit_seconds", "predict_seconds")


@query("m7_predictions_table")
def _(spark, folder):
    result = flows.forecast(_ready(spark, folder))
    return result.predictions.select("Name", "date", "target_date", "close", "target_close_next", "pred_naive", "pred_linear_regression", "pred_random_forest")


@query("m8_feature_importance")
def _(spark, folder):
    return flows.forecast(_ready(spark, folder), models=["random_forest"]).importances


@query("m16_actual_vs_predicted", f"""WITH {TARGETED} SELECT CAST(target_date AS VARCHAR) AS target_date, round(target_close_next, 4) AS actual, round(close, 4) AS predicted, 'naive' AS model
FROM targeted WHERE "Name" = '7' AND target_date >= DATE '{fr.CUTOFF}'""", "actual predicted")
def _(spark, folder):
    ready = _ready(spark, folder).where("split = 'test'").withColumn("pred_naive", F.col("close"))
    metrics = mt.regression_metrics(ready, "target_close_next", "pred_naive").withColumn("model", F.lit("naive"))
    return flows.best_model_series(metrics, ready, "7")


@query("s6_saved_model", f"""WITH {TARGETED}, ready AS (SELECT * FROM targeted WHERE target_close_next IS NOT NULL), r AS (SELECT "Name", close, volume, target_close_next AS t FROM ready WHERE target_date < DATE '{fr.CUTOFF}'),
d AS (SELECT close - avg(close) OVER w AS a, volume - avg(volume) OVER w AS b, t - avg(t) OVER w AS y FROM r WINDOW w AS (PARTITION BY "Name")),
m AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS yb FROM d),
s AS (SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS p, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS q FROM m),
e AS (SELECT "Name", count(*) AS n, avg(t) - any_value(p) * avg(close) - any_value(q) * avg(volume) AS effect FROM r, s GROUP BY 1), u AS (SELECT sum(n * effect) / sum(n) AS unseen FROM e)
SELECT "Name", CAST(date AS VARCHAR) AS date, coalesce(effect, unseen) + p * close + q * volume AS prediction FROM ready LEFT JOIN e USING ("Name"), s, u WHERE target_date >= DATE '{fr.CUTOFF}'""", "prediction")
def _(spark, folder):
    """Test predictions of the least-squares model after it was saved and loaded again."""
    from ..operators.entity_ols import fit_entity_ols

    ready, path = _ready(spark, folder), scratch_path(spark, "s6")
    save_model(fit_entity_ols(ready.where("split = 'train'"), ["close", "volume"], "Name", "target_close_next"), path)
    return load_step(spark, path).transform(ready.where("split = 'test'")).select("Name", "date", "prediction")


FOLD_MODELS = f"""WITH {TARGETED}, ready AS (SELECT * FROM targeted WHERE target_close_next IS NOT NULL AND target_date < DATE '{fr.CUTOFF}'),
days AS (SELECT target_date, row_number() OVER (ORDER BY target_date) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT target_date FROM ready)),
r AS (SELECT "Name", close, volume, target_close_next AS t, CASE WHEN pos < n - 5 * (n // 6) THEN 0 ELSE (pos - (n - 5 * (n // 6))) // (n // 6) + 1 END AS f FROM ready JOIN days USING (target_date)),
seen AS (SELECT g.f AS fold, r.* FROM r JOIN (SELECT DISTINCT f FROM r WHERE f > 0) g ON r.f < g.f),
d AS (SELECT fold, close - avg(close) OVER w AS a, volume - avg(volume) OVER w AS b, t - avg(t) OVER w AS y FROM seen WINDOW w AS (PARTITION BY fold, "Name")),
m AS (SELECT fold, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS yb FROM d GROUP BY 1),
s AS (SELECT fold, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS close_slope, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS volume_slope FROM m),
e AS (SELECT fold, "Name", count(*) AS n, avg(t) - any_value(close_slope) * avg(close) - any_value(volume_slope) * avg(volume) AS effect FROM seen JOIN s USING (fold) GROUP BY 1, 2)"""


def _folded(spark, folder):
    """Training rows with the folds of the model-ready rows."""
    return _ready(spark, folder).where("split = 'train'")


@query("m6_fold_effects", FOLD_MODELS + """ SELECT fold AS cv_fold, "Name", n, effect, close_slope, volume_slope FROM e JOIN s USING (fold)""", "effect close_slope volume_slope")
def _(spark, folder):
    """Slopes and entity effects of every fold's model from one scan."""
    model = fit_fold_ols(_folded(spark, folder), ["close", "volume"], "Name", "target_close_next")
    return model.effects.join(F.broadcast(model.table()), "cv_fold").select("cv_fold", "Name", "n", "effect", F.col("slopes")[0].alias("close_slope"), F.col("slopes")[1].alias("volume_slope"))


@query("m6_expanding_least_squares", FOLD_MODELS + f""", u AS (SELECT fold, sum(n * effect) / sum(n) AS unseen FROM e GROUP BY 1),
scored AS (SELECT r.f AS cv_fold, t AS a, close, coalesce(effect, unseen) + close_slope * close + volume_slope * volume AS fitted FROM r JOIN s ON s.fold = r.f JOIN u ON u.fold = r.f LEFT JOIN e ON e.fold = r.f AND e."Name" = r."Name"),
long AS (SELECT cv_fold, 'naive' AS model, a, close AS p FROM scored UNION ALL SELECT cv_fold, 'linear_regression', a, fitted FROM scored)
SELECT cv_fold, model, {ERRORS} FROM long GROUP BY 1, 2""", "mae rmse r2 mape_percent")
def _(spark, folder):
    """Errors of least squares and persistence on every fold."""
    return expanding_ols(_folded(spark, folder), ["close", "volume"], "Name", "target_close_next", "close")


# Reduction and clustering -----------------------------------------------------------------------

VEC = f"WITH {fr.VECTORS}"
CENTRES = """, cells AS (SELECT label, i, avg(features[i]) AS m FROM ve, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2),
centres AS (SELECT label, list(m ORDER BY i) AS centroid FROM cells GROUP BY 1), own AS (SELECT ve.*, centroid, list_distance(features, centroid) AS away FROM ve JOIN centres USING (label))"""


@query("j8_nearest_centroid", VEC + CENTRES + """, d AS (SELECT id, c.label AS cluster, list_distance(features, centroid) AS distance_to_centroid FROM ve, centres c)
SELECT id, cluster, distance_to_centroid FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance_to_centroid, cluster) = 1""", "distance_to_centroid")
def _(spark, folder):
    df = fr.vectors(spark, folder)
    centres = [r["centroid"] for r in cl.group_centroids(df, "label").orderBy("label").collect()]
    return cl.assign_nearest(df, centres).select("id", "cluster", "distance_to_centroid")


@query("g2_inertia", VEC + CENTRES + "SELECT sum(away * away) AS inertia FROM own", "inertia")
def _(spark, folder):
    return cl.inertia(fr.vectors(spark, folder), "label")


SILHOUETTE = VEC + """, d AS (SELECT a.id, a.label AS mine, b.label AS other, sum(power(list_distance(a.features, b.features), 2)) AS s, count(*) AS n FROM ve a, ve b GROUP BY 1, 2, 3),
i AS (SELECT id, mine, s / greatest(n - 1, 1) AS inner_mean, n FROM d WHERE mine = other), o AS (SELECT id, min(s / n) AS outer_mean FROM d WHERE mine <> other GROUP BY 1),
p AS (SELECT id, mine AS cluster, CASE WHEN n = 1 THEN 0 ELSE (outer_mean - inner_mean) / greatest(outer_mean, inner_mean) END AS silhouette FROM i JOIN o USING (id)) """


@query("g3_silhouette", SILHOUETTE + "SELECT avg(silhouette) AS silhouette FROM p", "silhouette", digits=9)
def _(spark, folder):
    return cl.silhouette(fr.vectors(spark, folder), "id", "label")


@query("g3_silhouette_points", SILHOUETTE + "SELECT id AS key, cluster, silhouette FROM p", "silhouette")
def _(spark, folder):
    return cl.silhouette_points(fr.vectors(spark, folder), "id", "label")


EUCLIDEAN = SILHOUETTE.replace("sum(power(list_distance(a.features, b.features), 2))", "sum(list_distance(a.features, b.features))")


@query("g3_silhouette_euclidean", EUCLIDEAN + "SELECT avg(silhouette) AS silhouette FROM p", "silhouette", digits=9)
def _(spark, folder):
    return si.euclidean_silhouette(fr.vectors(spark, folder), "id", "label", error=0)


@query("g3_silhouette_euclidean_points", EUCLIDEAN + "SELECT id AS key, cluster, silhouette FROM p", "silhouette")
def _(spark, folder):
    return si.euclidean_silhouette_points(fr.vectors(spark, folder), "id", "label", error=0)


@query("g4_calinski_harabasz", VEC + CENTRES + """, whole AS (SELECT list(m ORDER BY i) AS g FROM (SELECT i, avg(features[i]) AS m FROM ve, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1)),
b AS (SELECT sum(n * power(list_distance(centroid, g), 2)) AS between FROM (SELECT label, any_value(centroid) AS centroid, count(*) AS n FROM own GROUP BY 1), whole)
SELECT (between / (count(DISTINCT label) - 1)) / (sum(away * away) / (count(*) - count(DISTINCT label))) AS calinski_harabasz FROM own, b GROUP BY between""", "calinski_harabasz")
def _(spark, folder):
    return cl.calinski_harabasz(fr.vectors(spark, folder), "label")


@query("g5_davies_bouldin", VEC + CENTRES + """, s AS (SELECT label, any_value(centroid) AS c, avg(away) AS s FROM own GROUP BY 1),
w AS (SELECT a.label, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM s a JOIN s b ON a.label <> b.label GROUP BY 1) SELECT avg(worst) AS davies_bouldin FROM w""", "davies_bouldin")
def _(spark, folder):
    return cl.davies_bouldin(fr.vectors(spark, folder), "label")


SWEEP = """WITH s AS (SELECT CAST(month(o_orderdate) AS BIGINT) AS k, sum(o_totalprice) / 1e6 AS inertia, avg((o_orderstatus = 'F')::INT) AS silhouette, avg(o_totalprice) AS davies_bouldin
  FROM orders WHERE month(o_orderdate) BETWEEN 2 AND 10 GROUP BY 1)"""
CHORD = """, e AS (SELECT min(k)::DOUBLE AS x0, max(k)::DOUBLE AS x1, arg_min(inertia, k) AS y0, arg_max(inertia, k) AS y1, min(inertia) AS lo, max(inertia) AS hi FROM s)"""
RAW = CHORD + ", d AS (SELECT k, abs((x1 - x0) * (inertia - y0) - (y1 - y0) * (k - x0)) / sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) AS distance_to_chord FROM s, e)"
SCALED = CHORD + """, d AS (SELECT k, abs(((inertia - y0) / (hi - lo)) - ((y1 - y0) / (hi - lo)) * ((k - x0) / (x1 - x0))) / sqrt(1 + power((y1 - y0) / (hi - lo), 2)) AS distance_to_chord FROM s, e)"""
BEST = "SELECT k AS elbow_k, distance_to_chord FROM d ORDER BY distance_to_chord DESC, k LIMIT 1"


def _sweep(spark, folder):
    """A stand-in selection curve with one row per month 2..10, built from all orders."""
    df = read_table(spark, folder, "orders").withColumn("k", F.month("o_orderdate")).where("k between 2 and 10")
    return df.groupBy("k").agg((F.sum("o_totalprice") / 1e6).alias("inertia"), F.avg((F.col("o_orderstatus") == "F").cast("int")).alias("silhouette"), F.avg("o_totalprice").alias("davies_bouldin"))


@query("g6_elbow", SWEEP + RAW + BEST, "distance_to_chord")
def _(spark, folder):
    return cl.elbow(_sweep(spark, folder))


@query("g6_elbow_normalised", SWEEP + SCALED + BEST, "distance_to_chord")
def _(spark, folder):
    return cl.elbow(_sweep(spark, folder), normalize=True)


@query("g7_choose_k_near_elbow", SWEEP + RAW + f", b AS ({BEST}) SELECT elbow_k, k AS selected_k FROM s, b WHERE abs(k - elbow_k) <= 1 ORDER BY silhouette DESC, davies_bouldin, k LIMIT 1")
def _(spark, folder):
    return cl.choose_k_near_elbow(_sweep(spark, folder))


@query("g7_choose_k_by_margin", SWEEP + SCALED + f""", b AS ({BEST}), t AS (SELECT elbow_k, max(silhouette) AS best, max(silhouette) FILTER (WHERE k = elbow_k) AS mine, first(k ORDER BY silhouette DESC, k) AS top FROM s, b GROUP BY 1)
SELECT elbow_k, CASE WHEN best >= mine + 0.03 THEN top ELSE elbow_k END AS selected_k FROM t""")
def _(spark, folder):
    return cl.choose_k_by_margin(_sweep(spark, folder))


@query("g8_distance_to_centroid", VEC + CENTRES + "SELECT id, label, away AS distance FROM own", "distance")
def _(spark, folder):
    df = fr.vectors(spark, folder)
    joined = df.join(cl.group_centroids(df, "label"), "label")
    return joined.select("id", "label", F.sqrt(cl.squared_distance(F.col("features"), F.col("centroid"))).alias("distance"))


@query("g9_kth_distances", VEC + """, d AS (SELECT a.id, list_distance(a.features, b.features) AS x FROM ve a, ve b)
SELECT id, x AS kth_distance FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY x) = 12""", "kth_distance")
def _(spark, folder):
    df = fr.vectors(spark, folder)
    return dn.kth_distances(df, df, 12)


SEARCH = """WITH s AS (SELECT l_quantity AS eps, (count(*) % 25)::BIGINT AS cluster_count, 100.0 * avg((l_returnflag = 'R')::INT) AS noise_percent, avg(l_discount) AS silhouette FROM lineitem GROUP BY 1),
v AS (SELECT *, cluster_count BETWEEN 2 AND 20 AND noise_percent BETWEEN 1 AND 40 AND silhouette IS NOT NULL AS valid FROM s),
o AS (SELECT *, CASE WHEN valid THEN silhouette - 0.004 * abs(noise_percent - 10) - 0.005 * greatest(cluster_count - 10, 0) ELSE -999 END::DOUBLE AS objective FROM v) """


def _search(spark, folder):
    """A stand-in radius search with one row per quantity, built from all line items."""
    return read_table(spark, folder, "lineitem").groupBy(F.col("l_quantity").alias("eps")).agg(
        F.pmod(F.count(F.lit(1)), F.lit(25)).alias("cluster_count"), (F.avg((F.col("l_returnflag") == "R").cast("int")) * 100).alias("noise_percent"), F.avg("l_discount").alias("silhouette"))


@query("g11_eps_objective", SEARCH + "SELECT * FROM o", "eps noise_percent silhouette objective")
def _(spark, folder):
    return cl.eps_objective(_search(spark, folder))


@query("g11_choose_eps", SEARCH + "SELECT * FROM o ORDER BY valid DESC, objective DESC, silhouette DESC LIMIT 1", "eps noise_percent silhouette objective")
def _(spark, folder):
    return cl.choose_eps(_search(spark, folder))


@query("g16_cluster_counts", "SELECT CAST(label AS BIGINT) AS label, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM embeddings GROUP BY 1", "share")
def _(spark, folder):
    return cl.cluster_counts(fr.vectors(spark, folder), "label")


EPS, MIN_SAMPLES = 0.2, 4
PLANE = "RECURSIVE pt AS (SELECT c_custkey AS id, [c_acctbal / 1000, c_nationkey::DOUBLE] AS f FROM customer)"
DBSCAN = f"""WITH {PLANE}, near AS (SELECT a.id, b.id AS other FROM pt a JOIN pt b ON list_distance(a.f, b.f) <= {EPS}), deg AS (SELECT id, count(*) AS neighbours FROM near GROUP BY 1),
core AS (SELECT id FROM deg WHERE neighbours >= {MIN_SAMPLES}), link AS (SELECT n.id, n.other FROM near n SEMI JOIN core a ON n.id = a.id SEMI JOIN core b ON n.other = b.id),
reach AS (SELECT id, id AS root FROM core UNION SELECT l.other, r.root FROM reach r JOIN link l ON l.id = r.id), comp AS (SELECT id, min(root) AS cluster FROM reach GROUP BY 1),
border AS (SELECT n.id, min(c.cluster) AS cluster FROM near n JOIN comp c ON n.other = c.id GROUP BY 1)
SELECT d.id, coalesce(comp.cluster, border.cluster, -1) AS cluster, d.neighbours >= {MIN_SAMPLES} AS is_core FROM deg d LEFT JOIN comp USING (id) LEFT JOIN border USING (id)"""


def _plane(spark, folder):
    return read_table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), F.array(F.col("c_acctbal") / 1000, F.col("c_nationkey").cast("double")).alias("features"), F.col("c_nationkey").cast("long").alias("cluster"))


@query("g10_dbscan", DBSCAN)
def _(spark, folder):
    return dn.dbscan(_plane(spark, folder).drop("cluster"), EPS, MIN_SAMPLES)


@query("j9_nearest_within_radius", f"""WITH q AS (SELECT s_suppkey AS id, [s_acctbal / 1000, s_nationkey::DOUBLE] AS f FROM supplier), pt AS (SELECT c_custkey AS id, [c_acctbal / 1000, c_nationkey::DOUBLE] AS f, c_nationkey::BIGINT AS cluster FROM customer),
h AS (SELECT q.id, pt.cluster, list_distance(q.f, pt.f) AS distance FROM q JOIN pt ON list_distance(q.f, pt.f) <= {EPS} QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY distance, pt.id) = 1)
SELECT q.id, coalesce(cluster, -1) AS cluster, distance FROM q LEFT JOIN h USING (id)""", "distance")
def _(spark, folder):
    asked = read_table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.array(F.col("s_acctbal") / 1000, F.col("s_nationkey").cast("double")).alias("features"))
    return dn.nearest_within(asked, _plane(spark, folder), EPS)


@query("g12_out_of_sample_density", f"""WITH q AS (SELECT s_suppkey AS id, [s_acctbal / 1000, s_nationkey::DOUBLE] AS f FROM supplier), lab AS ({DBSCAN}), pt AS (SELECT c_custkey AS id, [c_acctbal / 1000, c_nationkey::DOUBLE] AS f FROM customer),
h AS (SELECT q.id, lab.cluster FROM q JOIN pt ON list_distance(q.f, pt.f) <= {EPS} JOIN lab ON lab.id = pt.id AND lab.is_core QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.f, pt.f), pt.id) = 1)
SELECT q.id, coalesce(cluster, -1) AS cluster FROM q LEFT JOIN h USING (id)""")
def _(spark, folder):
    asked = read_table(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.array(F.col("s_acctbal") / 1000, F.col("s_nationkey").cast("double")).alias("features"))
    points = _plane(spark, folder).drop("cluster")
    labels = dn.dbscan(points, EPS, MIN_SAMPLES).where("is_core").select("id", "cluster")
    return dn.nearest_within(asked, points.join(labels, "id"), EPS).select("id", "cluster")


NEAR_SAMPLES, NEAR_EPS = 5, 1.15
PAIRS = VEC + ", d AS (SELECT a.id, b.id AS other, list_distance(a.features, b.features) AS x FROM ve a, ve b)"


def _density_sql(radii: str) -> str:
    """Labels at every radius of the table ``radii`` (``eps``), after ``PAIRS``: a recursion walks from core to core."""
    return PAIRS.replace("WITH", "WITH RECURSIVE", 1) + f"""{radii}, near AS (SELECT eps, id, other FROM d, radii WHERE x <= eps), deg AS (SELECT eps, id, count(*) AS neighbours FROM near GROUP BY 1, 2),
core AS (SELECT eps, id FROM deg WHERE neighbours >= {NEAR_SAMPLES}), link AS (SELECT n.eps, n.id, n.other FROM near n SEMI JOIN core a ON n.eps = a.eps AND n.id = a.id SEMI JOIN core b ON n.eps = b.eps AND n.other = b.id),
reach AS (SELECT eps, id, id AS root FROM core UNION SELECT r.eps, l.other, r.root FROM reach r JOIN link l ON l.eps = r.eps AND l.id = r.id),
comp AS (SELECT eps, id, min(root) AS cluster FROM reach GROUP BY 1, 2),
border AS (SELECT n.eps, n.id, min(c.cluster) AS cluster FROM near n JOIN comp c ON n.eps = c.eps AND n.other = c.id GROUP BY 1, 2),
lab AS (SELECT eps, g.id, coalesce(c.cluster, b.cluster, -1) AS cluster, g.neighbours >= {NEAR_SAMPLES} AS is_core FROM deg g LEFT JOIN comp c USING (eps, id) LEFT JOIN border b USING (eps, id))"""


ONE_RADIUS = f", radii AS (SELECT {NEAR_EPS}::DOUBLE AS eps)"


@query("g10_dbscan_embeddings", _density_sql(ONE_RADIUS) + " SELECT id, cluster, is_core FROM lab")
def _(spark, folder):
    """Density clusters in 64 dimensions, where no grid reaches."""
    return dn.dbscan(fr.vectors(spark, folder).drop("label"), NEAR_EPS, NEAR_SAMPLES)


@query("g12_out_of_sample_density_embeddings", _density_sql(ONE_RADIUS) + """, q AS (SELECT vec_id AS id, list_transform(CAST(embedding AS DOUBLE[]), lambda c: c * 0.9) AS f FROM embeddings),
h AS (SELECT q.id, lab.cluster, list_distance(q.f, ve.features) AS distance FROM q JOIN ve ON list_distance(q.f, ve.features) <= 1.15 JOIN lab ON lab.id = ve.id AND lab.is_core
  QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY distance, ve.id) = 1)
SELECT q.id, coalesce(cluster, -1) AS cluster, distance FROM q LEFT JOIN h USING (id)""", "distance")
def _(spark, folder):
    """Rows that were not clustered (all vectors, drawn in by a tenth) take the cluster of their nearest core row."""
    rows = fr.vectors(spark, folder).drop("label")
    core = rows.join(dn.dbscan(rows, NEAR_EPS, NEAR_SAMPLES).where("is_core"), "id")
    asked = rows.select("id", F.transform("features", lambda c: c * 0.9).alias("features"))
    return dn.nearest_within(asked, core, NEAR_EPS)


SEARCH_QUANTILES = (0.02, 0.15, 0.3, 0.5, 0.7)
SEARCHED = _density_sql(f""", k AS (SELECT id, x FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY x) = {NEAR_SAMPLES}),
radii AS (SELECT DISTINCT unnest(quantile_cont(x, {list(SEARCH_QUANTILES)})) AS eps FROM k)""") + """, kept AS (SELECT eps, id, cluster AS mine FROM lab WHERE cluster <> -1),
apart AS (SELECT a.eps, a.id, a.mine, b.mine AS other, sum(x) AS s, count(*) AS n FROM kept a JOIN d ON d.id = a.id JOIN kept b ON b.eps = a.eps AND b.id = d.other GROUP BY 1, 2, 3, 4),
inner_side AS (SELECT eps, id, s / greatest(n - 1, 1) AS a, n FROM apart WHERE mine = other), outer_side AS (SELECT eps, id, min(s / n) AS b FROM apart WHERE mine <> other GROUP BY 1, 2),
scores AS (SELECT eps, avg(CASE WHEN n = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM inner_side JOIN outer_side USING (eps, id) GROUP BY 1),
searched AS (SELECT eps, 5::BIGINT AS min_samples, count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS cluster_count, count(*) FILTER (WHERE cluster = -1) AS noise_count,
  100.0 * count(*) FILTER (WHERE cluster = -1) / count(*) AS noise_percent, any_value(s.silhouette) AS silhouette FROM lab LEFT JOIN scores s USING (eps) GROUP BY 1),
v AS (SELECT *, cluster_count BETWEEN 2 AND 20 AND noise_percent BETWEEN 1 AND 40 AND silhouette IS NOT NULL AS valid FROM searched),
o AS (SELECT *, CASE WHEN valid THEN silhouette - 0.004 * abs(noise_percent - 10) - 0.005 * greatest(cluster_count - 10, 0) ELSE -999 END::DOUBLE AS objective FROM v),
best AS (SELECT *, CASE WHEN valid THEN 0 WHEN cluster_count >= 2 AND silhouette IS NOT NULL THEN 1 ELSE 2 END AS tier FROM o
  ORDER BY tier, CASE tier WHEN 0 THEN -objective WHEN 1 THEN -silhouette ELSE abs(noise_percent - 10) END, CASE tier WHEN 0 THEN -silhouette WHEN 1 THEN noise_percent ELSE 0 END, eps LIMIT 1) """
FOUND = "eps noise_percent silhouette objective"


def _choice(spark, folder):
    """k-distances, candidate radii, search and choice over all embeddings."""
    return flows.density_choice(fr.vectors(spark, folder), "id", NEAR_SAMPLES, SEARCH_QUANTILES)


@query("flow_eps_search", SEARCHED + "SELECT * FROM o", FOUND)
def _(spark, folder):
    return _choice(spark, folder).search


@query("flow_eps_choice", SEARCHED + "SELECT * EXCLUDE (tier, objective, valid), valid, objective FROM best", FOUND)
def _(spark, folder):
    return _choice(spark, folder).chosen


@query("flow_eps_labels", SEARCHED + "SELECT id, cluster, is_core FROM lab JOIN best USING (eps)")
def _(spark, folder):
    return _choice(spark, folder).labels


@query("flow_k_search")
def _(spark, folder):
    """The measures of every K and what the elbow rule makes of them."""
    found = flows.centroid_choice(fr.vectors(spark, folder))
    return found.search.join(F.broadcast(found.chosen), F.col("k") == F.col("selected_k"), "left").select("k", "inertia", "silhouette", "calinski_harabasz", "davies_bouldin", "elbow_k", "selected_k")


@query("flow_k_choice")
def _(spark, folder):
    """Size and spread of the clusters at the chosen K."""
    return flows.centroid_choice(fr.vectors(spark, folder)).profile


@query("k4_noise_examples", f"""WITH lab AS ({DBSCAN}), pt AS (SELECT c_custkey AS id, [c_acctbal / 1000, c_nationkey::DOUBLE] AS f FROM customer),
k AS (SELECT a.id, list_distance(a.f, b.f) AS x FROM pt a, pt b QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY x) = {MIN_SAMPLES})
SELECT id, x AS kth_distance FROM k JOIN lab USING (id) WHERE cluster = -1 ORDER BY x DESC, id LIMIT 200""", "kth_distance")
def _(spark, folder):
    points = _plane(spark, folder).drop("cluster")
    labelled = dn.dbscan(points, EPS, MIN_SAMPLES)
    noise = points.join(labelled.where("cluster = -1"), "id", "left_semi")
    return dn.noise_examples(labelled, dn.kth_distances(points, noise, MIN_SAMPLES)).select("id", "kth_distance")


@query("g1_kmeans_sweep")
def _(spark, folder):
    return cl.kmeans_sweep(fr.vectors(spark, folder), "id", max_iter=500)[0]


@query("g13_divisive_hierarchy")
def _(spark, folder):
    """Divisive hierarchy against K-means at the same K: adjusted Rand index."""
    df = fr.vectors(spark, folder)
    labelled = cl.predict(cl.fit_kmeans(df, 5, seeds=[42]), df, cluster="kmeans")
    labelled = cl.predict(cl.divisive_hierarchy(df, 5), labelled, cluster="hierarchy")
    return mt.adjusted_rand(labelled, "kmeans", "hierarchy")


def _space(spark, folder):
    return flows.feature_space(_orders_wide(spark, folder), FEATURES, "o_orderkey")


@query("d4_truncated_svd")
def _(spark, folder):
    return _space(spark, folder).rows


@query("k5_top_loadings")
def _(spark, folder):
    return _space(spark, folder).loadings


@query("d6_feature_space_summary", f"""WITH {WIDE} SELECT count(*) AS rows, 5::BIGINT AS original_feature_count, 3::BIGINT AS numerical_feature_count, 2::BIGINT AS categorical_feature_count,
  3 + (SELECT count(*) FROM seg) + (SELECT count(*) FROM pri) AS encoded_feature_count, 10::BIGINT AS component_count FROM w""")
def _(spark, folder):
    return _space(spark, folder).summary.drop("explained_variance_ratio")


@query("d5_pca_2d")
def _(spark, folder):
    sessions = flows.standardised_sessions(fr.bars(spark, folder))
    return rd.pca_coordinates(sessions, [f"{c}_z" for c in pn.SESSION_FEATURES], ["Name", "date"])[0].select("Name", "date", F.col("features")[0].alias("pc1"), F.col("features")[1].alias("pc2"))


def _wide_customers(spark, folder):
    """Customers with their order figures: mixed features for segmentation."""
    spent = read_table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.avg("o_totalprice").alias("mean_order"), F.count(F.lit(1)).alias("orders"))
    return read_table(spark, folder, "customer").join(spent, "c_custkey", "left").select("c_custkey", "c_acctbal", "mean_order", "orders", "c_mktsegment")


@query("g14_stability_table")
def _(spark, folder):
    return flows.stability(_wide_customers(spark, folder), ["c_acctbal", "mean_order", "orders", "c_mktsegment"], "c_custkey", k=3, eps=0.8, min_samples=10, components=4)[0]


@query("g15_assignments")
def _(spark, folder):
    df = _wide_customers(spark, folder)
    _, labels = flows.stability(df, ["c_acctbal", "mean_order", "orders"], "c_custkey", k=3, eps=0.6, min_samples=10, components=2)
    return cl.assignments(labels, df.select("c_custkey", "c_mktsegment"), "c_custkey", ["split", "kmeans", "hierarchy", "dbscan"])


@query("flow_session_segmentation")
def _(spark, folder):
    return flows.session_segmentation(fr.bars(spark, folder))[2]


@query("flow_session_density")
def _(spark, folder):
    return cl.cluster_counts(flows.session_density(fr.bars(spark, folder))[0])
