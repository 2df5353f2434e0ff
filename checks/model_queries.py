"""Queries over target analysis, splits, models, explanations and report tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.registry import check, stacked
from checks.tables import (
    GAPPED_LINEITEM, GAPPED_PART, LINE_KEYS, customer_accounts, gapped_lineitem, labelled_documents, rounded, table,
)
from checks.feature_queries import METADATA_SQL, part_plan
from tableloom.functions.keys import hash_key
from tableloom.operators import clean, explain, guards, metrics, models, profile, report, split, target
from tableloom.plans.options import ModelOptions, PrepareOptions
from tableloom.plans.prepare import fit_prepare
from tableloom.plans.study import train_models
from tableloom.session import materialize

KEY_LIST = ", ".join(LINE_KEYS)

# --- B15, E1: the target --------------------------------------------------------------------------

TARGETS = [
    ("orders", "o_orderstatus", False), ("orders", "o_totalprice", True), ("lineitem", "l_quantity", True),
    ("lineitem", "l_linenumber", True), ("part", "p_brand", False), ("part", "p_size", True),
    ("events", "user_id", True), ("customer", "c_nationkey", True), ("customer", "c_name", False),
]


def profile_sql(source: str, column: str, numeric: bool) -> str:
    number = f"CAST({column} AS DOUBLE)" if numeric else "NULL::DOUBLE"
    return f"""
SELECT '{source}' AS source, '{column}' AS target, n_rows, n_distinct, unique_ratio, singles / n_distinct AS singleton_ratio, largest / n_rows AS modal_share,
 coalesce(whole, false) AS all_integer, coalesce(whole AND low IN (0, 1) AND high = n_distinct + low - 1, false) AS sequential, {str(not numeric).lower()} AS categorical
FROM (SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(y) AS n_distinct, count(y) / sum(n) AS unique_ratio, count(*) FILTER (n = 1) AS singles, max(n) AS largest,
 min(v) AS low, max(v) AS high, bool_and(v = floor(v)) AS whole FROM
 (SELECT {column} AS y, any_value({number}) AS v, count(*) AS n FROM {source} GROUP BY {column}))"""


PROFILE_SQL = stacked([profile_sql(*t) for t in TARGETS])
RATIOS = ", ".join(f"round({c}, 6) AS {c}" for c in ("unique_ratio", "singleton_ratio", "modal_share"))


@check("b15_target_profile", f"SELECT source, target, n_rows, n_distinct, {RATIOS}, all_integer, sequential, categorical FROM ({PROFILE_SQL})")
def _(spark, sf):
    result = None
    for source, column, _ in TARGETS:
        row = target.target_profile(table(spark, sf, source), column).select(
            F.lit(source).alias("source"), F.lit(column).alias("target"), "*")
        result = row if result is None else result.unionByName(row)
    return rounded(result)


@check("e1_task_detection", f"""
SELECT source, target, n_rows, n_distinct, CASE WHEN unique_ratio > 0.9 OR n_distinct > 0.5 * n_rows OR singleton_ratio > 0.5 THEN 'regression'
 WHEN categorical THEN CASE WHEN n_distinct > 100 THEN 'regression' ELSE 'classification' END
 WHEN n_distinct <= 20 THEN 'classification'
 WHEN all_integer AND unique_ratio < 0.05 AND n_distinct <= 100 THEN 'classification'
 WHEN sequential THEN CASE WHEN n_distinct <= 50 THEN 'classification' ELSE 'regression' END
 WHEN modal_share > 0.05 AND n_distinct <= 50 THEN 'classification' ELSE 'regression' END AS task FROM ({PROFILE_SQL})""")
def _(spark, sf):
    result = None
    for source, column, _ in TARGETS:
        row = target.detect_task(table(spark, sf, source), column).withColumn("source", F.lit(source))
        result = row if result is None else result.unionByName(row)
    return result


# --- E2-E7: splits, guards and folds --------------------------------------------------------------

ORDER_HASH = "md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR)))"


@check("e2_random_split", f"""
SELECT o_orderkey, row_number() OVER (ORDER BY {ORDER_HASH}) <= ceil(0.2 * (SELECT count(*) FROM orders)) AS is_test FROM orders""")
def _(spark, sf):
    return split.split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@check("e3_stratified_split", f"""
SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {ORDER_HASH})
 <= least(greatest(floor(0.2 * count(*) OVER (PARTITION BY o_orderstatus) + 0.5), 1), count(*) OVER (PARTITION BY o_orderstatus) - 1) AS is_test FROM orders""")
def _(spark, sf):
    return split.split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus")


# Without keys the hash is of all columns.
KEYLESS_HASH = "md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus))"


@check("e2_split_without_keys", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, row_number() OVER (ORDER BY {KEYLESS_HASH}) <= ceil(0.2 * (SELECT count(*) FROM orders)) AS is_test FROM orders""")
def _(spark, sf):
    return split.split(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"))


# Every customer with two orders or more is a class of its own.
MANY_CLASSES = "(SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) > 1)"


def many_classes(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    several = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return orders.join(several, "o_custkey", "left_semi")


@check("e3_many_classes", f"""
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY {ORDER_HASH})
 <= least(greatest(floor(0.2 * n + 0.5), 1), n - 1) AS is_test FROM {MANY_CLASSES}""")
def _(spark, sf):
    return split.split(many_classes(spark, sf), ["o_orderkey"], "o_custkey")


@check("e7_many_classes", f"""
SELECT o_orderkey, o_custkey, CAST(ntile(3) OVER (PARTITION BY o_custkey ORDER BY {ORDER_HASH}) - 1 AS INTEGER) AS fold FROM {MANY_CLASSES}""")
def _(spark, sf):
    return split.assign_folds(many_classes(spark, sf), ["o_orderkey"], 3, "o_custkey")


# Parts labelled by brand and type, every hundredth part being a class of its own.
RARE_PART = """(SELECT p_partkey, CASE WHEN p_partkey % 100 = 7 THEN concat('rare ', p_partkey) ELSE concat(p_brand, ' ', p_type) END AS label,
 md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))) < '33333333333333333333333333333333' AS is_test FROM part)"""


def rare_part(spark, sf):
    key = F.col("p_partkey")
    label = F.when(key % 100 == 7, F.concat(F.lit("rare "), key.cast("string"))).otherwise(F.concat_ws(" ", "p_brand", "p_type"))
    return table(spark, sf, "part").select(
        "p_partkey", label.alias("label"), (hash_key(["p_partkey"]) < F.lit("3" * 32)).alias("is_test"))


GUARDED = {
    "rare_part": (f"(SELECT label AS y FROM {RARE_PART} WHERE NOT is_test)", "classification"),
    "order_status": ("(SELECT o_orderstatus AS y FROM orders)", "classification"),
    "customer_name": ("(SELECT c_name AS y FROM customer)", "classification"),
    "region": ("(SELECT r_name AS y FROM region)", "classification"),
    "price": ("(SELECT o_totalprice AS y FROM orders)", "regression"),
}


@check("e4_training_guards", stacked([f"""
SELECT '{name}' AS source, CAST(sum(n) AS BIGINT) AS train_rows, count(y) AS classes, count(*) FILTER (n = 1) AS singletons,
 CASE WHEN sum(n) < 10 THEN 'too_few_rows'
 {'' if task == 'regression' else "WHEN count(y) > 0.8 * sum(n) THEN 'too_many_classes' WHEN count(*) FILTER (n = 1) > 0.5 * count(y) THEN 'mostly_singletons' WHEN count(*) FILTER (n = 1) >= 0.3 * count(y) AND count(*) FILTER (n = 1) > 0 THEN 'too_many_singletons' WHEN count(*) FILTER (n = 1) > 0 AND sum(n) - count(*) FILTER (n = 1) < 10 THEN 'too_few_rows_after_removal' WHEN count(*) FILTER (n = 1) > 0 THEN 'remove_singletons'"}
 ELSE 'ok' END AS verdict FROM (SELECT y, count(*) AS n FROM {source} GROUP BY y)""" for name, (source, task) in GUARDED.items()]))
def _(spark, sf):
    inputs = {
        "rare_part": rare_part(spark, sf).where("NOT is_test").select(F.col("label").alias("y")),
        "order_status": table(spark, sf, "orders").select(F.col("o_orderstatus").alias("y")),
        "customer_name": table(spark, sf, "customer").select(F.col("c_name").alias("y")),
        "region": table(spark, sf, "region").select(F.col("r_name").alias("y")),
        "price": table(spark, sf, "orders").select(F.col("o_totalprice").alias("y")),
    }
    result = None
    for name, df in inputs.items():
        row = guards.training_verdict(df, "y", GUARDED[name][1]).select(F.lit(name).alias("source"), "*")
        result = row if result is None else result.unionByName(row)
    return result


@check("e5_singleton_removal", f"""
SELECT p_partkey, label, is_test FROM {RARE_PART} WHERE label NOT IN
 (SELECT label FROM {RARE_PART} WHERE NOT is_test GROUP BY label HAVING count(*) = 1)""")
def _(spark, sf):
    df = rare_part(spark, sf)
    train, test = df.where("NOT is_test"), df.where("is_test")
    train, test = guards.remove_singletons(train, test, "label")
    return train.unionByName(test)


FOLDED = {
    "order_status": ("orders", "o_orderstatus", "classification", 5),
    "order_price": ("orders", "o_totalprice", "regression", 5),
    "region": ("region", "r_name", "classification", 5),
    "supplier": ("supplier", "s_nationkey", "classification", 4),
    "brand": ("part", "p_brand", "classification", 10),
}


@check("e6_fold_count", stacked([f"""
SELECT '{name}' AS source, CAST(sum(n) AS BIGINT) AS n_rows, min(n) AS smallest_class, CAST(greatest(2, {
    f"least({folds}, floor(sum(n) / 2))" if task == "regression"
    else f"CASE WHEN min(n) = 1 THEN 2 ELSE least({folds}, floor(sum(n) / 2), CASE WHEN min(n) <= 5 THEN 2 ELSE min(n) END) END"
}) AS BIGINT) AS folds FROM (SELECT {column} AS y, count(*) AS n FROM {source} GROUP BY y)""" for name, (source, column, task, folds) in FOLDED.items()]))
def _(spark, sf):
    result = None
    for name, (source, column, task, folds) in FOLDED.items():
        row = split.fold_counts_table(table(spark, sf, source), column, task, folds).select(F.lit(name).alias("source"), "*")
        result = row if result is None else result.unionByName(row)
    return result


@check("e7_stratified_folds", f"""
SELECT o_orderkey, o_orderstatus, CAST(ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {ORDER_HASH}) - 1 AS INTEGER) AS fold FROM orders""")
def _(spark, sf):
    return split.assign_folds(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 5, "o_orderstatus")


@check("e7_random_folds", f"SELECT o_orderkey, CAST(ntile(5) OVER (ORDER BY {ORDER_HASH}) - 1 AS INTEGER) AS fold FROM orders")
def _(spark, sf):
    return split.assign_folds(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 5)


# --- E14, E15: metrics on rule-made predictions -----------------------------------------------------

RULES = {
    "binary": "(SELECT CAST(quality AS VARCHAR) AS y, CASE WHEN n_chars % 5 = 0 THEN '0' ELSE '1' END AS p FROM documents JOIN labels USING (doc_id))",
    "multiclass": "(SELECT o_orderstatus AS y, CASE WHEN o_custkey % 4 = 0 THEN 'F' WHEN o_totalprice < 200000 THEN 'O' ELSE o_orderstatus END AS p FROM orders)",
}


def class_metrics_sql(name: str, source: str) -> str:
    return f"""
SELECT '{name}' AS source, round(sum(hits) / sum(support), 6) AS accuracy, {', '.join(
    f"round(CASE WHEN count(*) FILTER (support > 0) = 2 THEN arg_max({m}, label) FILTER (support > 0) ELSE sum({m} * support) / sum(support) END, 6) AS {m}"
    for m in ('precision', 'recall', 'f1_score'))}
FROM (SELECT label, support, hits, CASE WHEN chosen = 0 THEN 0 ELSE hits / chosen END AS precision, CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
 CASE WHEN support + chosen = 0 THEN 0 ELSE 2 * hits / (support + chosen) END AS f1_score FROM
 (SELECT label, count(*) FILTER (y = label) AS support, count(*) FILTER (p = label) AS chosen, count(*) FILTER (y = label AND p = label) AS hits
  FROM {source}, (SELECT DISTINCT label FROM (SELECT y AS label FROM {source} UNION ALL SELECT p FROM {source})) GROUP BY label))"""


@check("e14_classification_metrics", stacked([class_metrics_sql(n, s) for n, s in RULES.items()]))
def _(spark, sf):
    binary = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id").select(
        F.col("quality").cast("string").alias("y"), F.when(F.col("n_chars") % 5 == 0, "0").otherwise("1").alias("p"))
    status = F.col("o_orderstatus")
    multiclass = table(spark, sf, "orders").select(
        status.alias("y"), F.when(F.col("o_custkey") % 4 == 0, "F").when(F.col("o_totalprice") < 200000, "O").otherwise(status).alias("p"))
    return rounded(
        metrics.classification_metrics(binary, "y", "p").select(F.lit("binary").alias("source"), "*").unionByName(
            metrics.classification_metrics(multiclass, "y", "p").select(F.lit("multiclass").alias("source"), "*")))


@check("e15_regression_metrics", """
SELECT round(avg((y - p) * (y - p)), 4) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
 round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2_score FROM (SELECT l_extendedprice / 1000 AS y, l_quantity * 1.8 + l_tax AS p FROM lineitem)""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_quantity") * 1.8 + F.col("l_tax")).alias("p"))
    found = metrics.regression_metrics(df, "y", "p")
    return found.select(*[F.round(c, 6 if c == "r2_score" else 4).alias(c) for c in found.columns])


def shared(build):
    """Build once per application and scale: several queries read tables of the same training."""
    kept = {}

    def get(spark, sf):
        key = (spark.sparkContext.applicationId, sf)
        if key not in kept:
            kept[key] = build(spark, sf)
        return kept[key]

    return get


# --- E8-E13, E16-E19: models ------------------------------------------------------------------------

@shared
def quality_table(spark, sf):
    plan = fit_prepare(labelled_documents(spark, sf), "quality", ["doc_id"], PrepareOptions(derive_features=False))
    return materialize(plan.fitted_table())


@shared
def account_table(spark, sf):
    plan = fit_prepare(customer_accounts(spark, sf), "order_total", ["c_custkey"], PrepareOptions(derive_features=False))
    return materialize(plan.fitted_table())


def predictions(df, label: str, task: str, name: str, key: str, features=None):
    trained = models.train(df, label, task, name, features, [key])
    return rounded(trained.predict(df).select(key, label, "prediction"))


@check("e8_random_forest_classifier")
def _(spark, sf):
    return predictions(quality_table(spark, sf), "quality", "classification", "RandomForest", "doc_id")


@check("e8_random_forest_regressor")
def _(spark, sf):
    return predictions(account_table(spark, sf), "order_total", "regression", "RandomForest", "c_custkey")


@check("e9_gradient_boosting_classifier")
def _(spark, sf):
    return predictions(quality_table(spark, sf), "quality", "classification", "GradientBoosting", "doc_id")


@check("e9_gradient_boosting_regressor")
def _(spark, sf):
    return predictions(account_table(spark, sf), "order_total", "regression", "GradientBoosting", "c_custkey")


@check("e10_logistic_regression")
def _(spark, sf):
    return predictions(quality_table(spark, sf), "quality", "classification", "LogisticRegression", "doc_id")


@check("e10_logistic_regression_multiclass")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 100000).alias("price"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    return predictions(orders, "o_orderstatus", "classification", "LogisticRegression", "o_orderkey")


# Ridge with two features has a closed form: (S + I) w = s over centred sums.
LINE_HASH = "md5(concat_ws('|', '{seed}', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)))"
RIDGE = f"""
WITH c AS (SELECT {KEY_LIST}, l_extendedprice / 1000 AS y, l_quantity AS a, l_tax * 100 AS b,
 avg(l_extendedprice / 1000) OVER () AS my, avg(l_quantity) OVER () AS ma, avg(l_tax * 100) OVER () AS mb FROM lineitem),
s AS (SELECT sum((a - ma) * (a - ma)) + 1 AS aa, sum((b - mb) * (b - mb)) + 1 AS bb, sum((a - ma) * (b - mb)) AS ab,
 sum((a - ma) * (y - my)) AS ya, sum((b - mb) * (y - my)) AS yb FROM c),
w AS (SELECT (ya * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS wb FROM s),
p AS (SELECT *, my + wa * (a - ma) + wb * (b - mb) AS prediction FROM c, w),
background AS (SELECT avg(a) AS ga, avg(b) AS gb, avg(prediction) AS base FROM (SELECT * FROM p ORDER BY {LINE_HASH.format(seed=43)} LIMIT 50)),
sample AS (SELECT *, concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS instance FROM p ORDER BY {LINE_HASH.format(seed=42)} LIMIT 100)
"""
RIDGE_SHAPLEY = f"""{RIDGE} SELECT instance, 'a' AS feature, a AS feature_value, wa * (a - ga) AS shapley_value FROM sample, background
UNION ALL SELECT instance, 'b', b, wb * (b - gb) FROM sample, background"""


def line_numbers(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LINE_KEYS, (F.col("l_extendedprice") / 1000).alias("y"), F.col("l_quantity").alias("a"), (F.col("l_tax") * 100).alias("b"))


def ridge(df):
    return models.train(df, "y", "regression", "Ridge", ["a", "b"])


@check("e11_ridge", f"{RIDGE} SELECT {KEY_LIST}, round(prediction, 4) AS prediction FROM p")
def _(spark, sf):
    df = line_numbers(spark, sf)
    return rounded(ridge(df).predict(df).select(*LINE_KEYS, "prediction"), 4)


@check("e17_importance_ridge", f"""{RIDGE} SELECT 'Ridge' AS model, feature, CAST(row_number() OVER (ORDER BY importance DESC) AS INTEGER) AS rank,
 round(importance, 6) AS importance FROM (SELECT 'a' AS feature, abs(wa) AS importance FROM w UNION ALL SELECT 'b', abs(wb) FROM w)""")
def _(spark, sf):
    return rounded(ridge(line_numbers(spark, sf)).importance(spark))


@check("f2_shapley_ridge", f"SELECT instance, feature, round(feature_value, 6) AS feature_value, round(shapley_value, 6) AS shapley_value FROM ({RIDGE_SHAPLEY})")
def _(spark, sf):
    df = line_numbers(spark, sf)
    return rounded(explain.shapley_values(ridge(df), df, LINE_KEYS, method="subsets").drop("method"))


@check("f2_shapley_ridge_closed_form", f"SELECT instance, feature, round(feature_value, 6) AS feature_value, round(shapley_value, 6) AS shapley_value, 'linear' AS method FROM ({RIDGE_SHAPLEY})")
def _(spark, sf):
    df = line_numbers(spark, sf)
    return rounded(explain.shapley_values(ridge(df), df, LINE_KEYS))


@check("f2_shapley_kernel", f"SELECT instance, feature, round(feature_value, 6) AS feature_value, round(shapley_value, 6) AS shapley_value, 'kernel' AS method FROM ({RIDGE_SHAPLEY})")
def _(spark, sf):
    df = line_numbers(spark, sf)
    return rounded(explain.shapley_values(ridge(df), df, LINE_KEYS, background=50, method="kernel"))


@check("f3_base_value_ridge", f"{RIDGE} SELECT round(base, 4) AS base_value FROM background")
def _(spark, sf):
    df = line_numbers(spark, sf)
    return rounded(explain.base_value(ridge(df), explain.background_rows(df, LINE_KEYS, ["a", "b"], 50, 42)), 4)


@check("f4_global_importance_ridge", f"SELECT feature, round(avg(abs(shapley_value)), 6) AS importance FROM ({RIDGE_SHAPLEY}) GROUP BY feature")
def _(spark, sf):
    df = line_numbers(spark, sf)
    return rounded(explain.global_importance(explain.shapley_values(ridge(df), df, LINE_KEYS)))


# Lasso with one feature: the covariance is shrunk by the penalty.
@check("e12_lasso", f"""
WITH c AS (SELECT {KEY_LIST}, l_extendedprice / 1000 AS y, l_quantity AS a, avg(l_extendedprice / 1000) OVER () AS my, avg(l_quantity) OVER () AS ma FROM lineitem),
w AS (SELECT sign(cov) * greatest(abs(cov) - 1, 0) / var AS wa FROM (SELECT avg((a - ma) * (y - my)) AS cov, avg((a - ma) * (a - ma)) AS var FROM c))
SELECT {KEY_LIST}, round(my + wa * (a - ma), 2) AS prediction FROM c, w""")
def _(spark, sf):
    df = line_numbers(spark, sf)
    trained = models.train(df, "y", "regression", "Lasso", ["a"])
    return rounded(trained.predict(df).select(*LINE_KEYS, "prediction"), 2)


# Folds of linear models: the normal equations of the rows outside each fold, scored on the rows inside.
LINE_FOLDS = f"""
WITH c AS (SELECT l_extendedprice / 1000 AS y, l_quantity AS a, l_tax * 100 AS b,
 CAST(ntile(5) OVER (ORDER BY {LINE_HASH.format(seed=42)}) - 1 AS INTEGER) AS fold FROM lineitem),
k AS (SELECT DISTINCT fold AS k FROM c),
m AS (SELECT k, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb FROM c, k WHERE fold <> k GROUP BY k),
s AS (SELECT k, any_value(n) AS n, any_value(my) AS my, any_value(ma) AS ma, any_value(mb) AS mb, sum((a - ma) * (a - ma)) AS aa, sum((b - mb) * (b - mb)) AS bb,
 sum((a - ma) * (b - mb)) AS ab, sum((a - ma) * (y - my)) AS ya, sum((b - mb) * (y - my)) AS yb FROM c JOIN m ON c.fold <> m.k GROUP BY k)"""
RIDGE_WEIGHTS = "SELECT k, my, ma, mb, (ya * (bb + 1) - yb * ab) / ((aa + 1) * (bb + 1) - ab * ab) AS wa, (yb * (aa + 1) - ya * ab) / ((aa + 1) * (bb + 1) - ab * ab) AS wb FROM s"
LASSO_WEIGHTS = "SELECT k, my, ma, mb, sign(ya) * greatest(abs(ya / n) - 1, 0) / (aa / n) AS wa, 0 AS wb FROM s"
FOLD_SCORES = "SELECT '{model}' AS model, k AS fold, round(1 - avg((y - my - wa * (a - ma) - wb * (b - mb)) ** 2) / var_pop(y), 6) AS r2_score FROM c JOIN ({weights}) w ON c.fold = w.k GROUP BY k"


def linear_folds(spark, sf, name, features):
    df = split.assign_folds(line_numbers(spark, sf), LINE_KEYS, 5, name="fold")
    prepared = models.prepare_vectors(df, "y", "regression", features, fold="fold")
    scores = models.cross_validate(prepared, [name], "fold", 5)
    prepared.release()
    return rounded(spark.createDataFrame([(name, k, float(v)) for k, v in enumerate(scores[name])], "model string, fold int, r2_score double"))


@check("e13_ridge_folds", f"{LINE_FOLDS} {FOLD_SCORES.format(model='Ridge', weights=RIDGE_WEIGHTS)}")
def _(spark, sf):
    return linear_folds(spark, sf, "Ridge", ["a", "b"])


@check("e13_lasso_folds", f"{LINE_FOLDS} {FOLD_SCORES.format(model='Lasso', weights=LASSO_WEIGHTS)}")
def _(spark, sf):
    return linear_folds(spark, sf, "Lasso", ["a"])


@shared
def quality_result(spark, sf):
    """One tournament on the labelled documents serves the queries that read its tables."""
    return train_models(quality_table(spark, sf), "quality", ["doc_id"], ModelOptions(cv_folds=3, parallel=8))


@shared
def account_result(spark, sf):
    return train_models(account_table(spark, sf), "order_total", ["c_custkey"], ModelOptions(cv_folds=3, parallel=8))


@check("e13_cross_validation")
def _(spark, sf):
    """Five stratified folds of two models, one row per model and fold."""
    df = split.assign_folds(quality_table(spark, sf), ["doc_id"], 5, "quality", name="fold")
    kept = models.trainable_features(df, ["doc_id", "quality", "fold"])
    prepared = models.prepare_vectors(df, "quality", "classification", kept, fold="fold")
    names = ["RandomForest", "LogisticRegression"]
    scores = models.cross_validate(prepared, names, "fold", 5, parallel=8)
    prepared.release()
    rows = [(name, number, float(value)) for name in names for number, value in enumerate(scores[name])]
    return rounded(spark.createDataFrame(rows, "model string, fold int, accuracy double"))


@check("e16_tournament_classification")
def _(spark, sf):
    return rounded(quality_result(spark, sf).metrics)


@check("e16_tournament_regression")
def _(spark, sf):
    return rounded(account_result(spark, sf).metrics)


@check("e17_feature_importance")
def _(spark, sf):
    return rounded(quality_result(spark, sf).importance())


@check("e18_predict_best")
def _(spark, sf):
    return models.predict(quality_result(spark, sf), quality_table(spark, sf)).select("doc_id", "quality", "prediction")


@check("e19_model_comparison")
def _(spark, sf):
    result = account_result(spark, sf)
    return rounded(models.comparison(result.metrics, result.task))


# --- Models whose result is known: the target is a step of one column ---------------------------------

STEP = "(SELECT c_custkey, c_nationkey, CAST(c_nationkey >= 12 AS INTEGER) AS label, CASE WHEN c_nationkey >= 12 THEN 100.0 ELSE 20.0 END AS amount FROM customer)"
STEP_SIZES = models.ModelSizes(trees=20, rounds=10)


@shared
def step_table(spark, sf):
    key = F.col("c_nationkey")
    return materialize(table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", (key >= 12).cast("int").alias("label"), F.when(key >= 12, 100.0).otherwise(20.0).alias("amount")))


def step_predictions(spark, sf, label, task, name):
    trained = models.train(step_table(spark, sf), label, task, name, ["c_nationkey"], sizes=STEP_SIZES)
    return rounded(trained.predict(step_table(spark, sf)).select("c_custkey", "prediction"))


@shared
def step_result(spark, sf):
    options = ModelOptions(cv_folds=3, models=("RandomForest", "GradientBoosting"), sizes=STEP_SIZES)
    return train_models(step_table(spark, sf).drop("amount"), "label", ["c_custkey"], options)


@check("e8_random_forest_step_classes", f"SELECT c_custkey, label AS prediction FROM {STEP}")
def _(spark, sf):
    return step_predictions(spark, sf, "label", "classification", "RandomForest")


@check("e8_random_forest_step_amounts", f"SELECT c_custkey, CAST(amount AS DOUBLE) AS prediction FROM {STEP}")
def _(spark, sf):
    return step_predictions(spark, sf, "amount", "regression", "RandomForest")


@check("e9_gradient_boosting_step_classes", f"SELECT c_custkey, label AS prediction FROM {STEP}")
def _(spark, sf):
    return step_predictions(spark, sf, "label", "classification", "GradientBoosting")


@check("e9_gradient_boosting_step_amounts", f"SELECT c_custkey, CAST(amount AS DOUBLE) AS prediction FROM {STEP}")
def _(spark, sf):
    return step_predictions(spark, sf, "amount", "regression", "GradientBoosting")


# Three classes that need both columns.
TWO_COLUMNS = """(SELECT c_custkey, c_nationkey, c_custkey % 7 AS day,
 CASE WHEN c_nationkey < 12 THEN 0 WHEN c_custkey % 7 < 3 THEN 1 ELSE 2 END AS kind FROM customer)"""


@shared
def two_column_classes(spark, sf):
    nation, day = F.col("c_nationkey"), F.col("c_custkey") % 7
    kind = F.when(nation < 12, 0).when(day < 3, 1).otherwise(2)
    return materialize(table(spark, sf, "customer").select("c_custkey", "c_nationkey", day.alias("day"), kind.alias("kind")))


def two_column_model(spark, sf, name, sizes):
    return models.train(two_column_classes(spark, sf), "kind", "classification", name, ["c_nationkey", "day"], sizes=sizes)


@check("e9_boosting_softmax", f"SELECT c_custkey, kind AS prediction, 1.0::DOUBLE AS probability_sum, true AS loss_falls FROM {TWO_COLUMNS}")
def _(spark, sf):
    trained = two_column_model(spark, sf, "GradientBoosting", models.ModelSizes(rounds=15, round_depth=3))
    losses = trained.model.losses
    vectors = models.assembled(two_column_classes(spark, sf), trained.features, ["c_custkey"])
    scored = trained.model.transform(vectors)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b)
    falls = len(losses) > 1 and all(b < a for a, b in zip(losses, losses[1:]))
    return rounded(scored.select("c_custkey", F.col("prediction").cast("int"), total.alias("probability_sum"), F.lit(falls).alias("loss_falls")))


@check("e8_random_forest_two_columns", f"SELECT c_custkey, kind AS prediction FROM {TWO_COLUMNS}")
def _(spark, sf):
    trained = two_column_model(spark, sf, "RandomForest", models.ModelSizes(trees=40, tree_depth=8))
    return trained.predict(two_column_classes(spark, sf)).select("c_custkey", "prediction")


@shared
def two_column_result(spark, sf):
    options = ModelOptions(cv_folds=3, models=("RandomForest", "GradientBoosting"), sizes=models.ModelSizes(trees=40, tree_depth=8, rounds=10, round_depth=3))
    return train_models(two_column_classes(spark, sf), "kind", ["c_custkey"], options)


@check("e16_tournament_two_columns", """SELECT ordinal, model, metric, CASE WHEN metric = 'cv_std' THEN 0.0 ELSE 1.0 END::DOUBLE AS value
 FROM (VALUES (0, 'RandomForest'), (1, 'GradientBoosting')) m(ordinal, model),
 (VALUES ('accuracy'), ('precision'), ('recall'), ('f1_score'), ('cv_mean'), ('cv_std')) t(metric)""")
def _(spark, sf):
    return rounded(two_column_result(spark, sf).metrics)


@check("e18_predict_best_two_columns", f"SELECT c_custkey, kind, kind AS prediction FROM {TWO_COLUMNS}")
def _(spark, sf):
    return models.predict(two_column_result(spark, sf), two_column_classes(spark, sf)).select("c_custkey", "kind", "prediction")


def logistic_gradient(df, target, features, count):
    """Mean gradient of the penalised loss at the fitted weights, per class and feature: 0 at the minimum."""
    trained = models.train(df, target, "classification", "LogisticRegression", features)
    weights = trained.model.coefficientMatrix.toArray()
    single = len(weights) == 1
    rows = models.assembled(trained.labels.attach(df, target, "_y"), features, [F.col("_y"), *[F.col(f) for f in features]])
    chances = trained.model.transform(rows).withColumn("_p", vector_to_array("probability"))
    measures = []
    for c in ([1] if single else range(len(weights))):
        error = F.get("_p", F.lit(c)) - (F.col("_y") == float(c)).cast("double")
        for j, f in enumerate(features):
            slope = F.sum(error * F.col(f)) + float(weights[0 if single else c][j])
            measures.append(F.struct(F.lit(c).alias("position"), F.lit(f).alias("feature"), (F.rint(slope / count * 1000) / 1000 + 0.0).alias("gradient"), F.count(F.lit(1)).alias("rows")))
    return chances.agg(F.array(*measures).alias("m")).select(F.inline("m"))


@check("e10_logistic_optimality", "SELECT 1 AS position, feature, 0.0::DOUBLE AS gradient, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS rows FROM (VALUES ('price'), ('year')) t(feature)")
def _(spark, sf):
    orders = status_orders(spark, sf).where("o_orderstatus <> 'P'")
    return logistic_gradient(orders, "o_orderstatus", ["price", "year"], orders.count())


@check("e10_logistic_optimality_multiclass", "SELECT position, feature, 0.0::DOUBLE AS gradient, (SELECT count(*) FROM orders) AS rows FROM (VALUES ('price'), ('year')) t(feature), (VALUES (0), (1), (2)) p(position)")
def _(spark, sf):
    orders = status_orders(spark, sf)
    return logistic_gradient(orders, "o_orderstatus", ["price", "year"], orders.count())


def status_orders(spark, sf):
    return table(spark, sf, "orders").select(
        (F.col("o_totalprice") / 100000).alias("price"), (F.year("o_orderdate") - 1995).cast("double").alias("year"), "o_orderstatus")


STEP_FOLD = f"""(SELECT *, CAST(ntile(4) OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', CAST(c_custkey AS VARCHAR)))) - 1 AS INTEGER) AS fold FROM {STEP})"""


@check("e13_cross_validation_step", f"SELECT model, fold, 1.0::DOUBLE AS accuracy, count(*) AS test_rows FROM {STEP_FOLD}, (VALUES ('RandomForest'), ('GradientBoosting')) m(model) GROUP BY ALL")
def _(spark, sf):
    df = split.assign_folds(step_table(spark, sf), ["c_custkey"], 4, "label", name="fold")
    prepared = models.prepare_vectors(df, "label", "classification", ["c_nationkey"], sizes=STEP_SIZES, fold="fold")
    scores = models.cross_validate(prepared, ["RandomForest", "GradientBoosting"], "fold", 4)
    prepared.release()
    rows = [(name, number, float(value)) for name, own in scores.items() for number, value in enumerate(own)]
    sizes = df.groupBy("fold").agg(F.count(F.lit(1)).alias("test_rows"))
    return rounded(spark.createDataFrame(rows, "model string, fold int, accuracy double").join(sizes, "fold"))


STEP_MODELS = "(VALUES (0, 'RandomForest'), (1, 'GradientBoosting')) m(ordinal, model)"


@check("e16_tournament_step", f"""SELECT ordinal, model, metric, CASE WHEN metric = 'cv_std' THEN 0.0 ELSE 1.0 END::DOUBLE AS value
 FROM {STEP_MODELS}, (VALUES ('accuracy'), ('precision'), ('recall'), ('f1_score'), ('cv_mean'), ('cv_std')) t(metric)""")
def _(spark, sf):
    return rounded(step_result(spark, sf).metrics)


@check("e17_feature_importance_step", "SELECT 'RandomForest' AS model, 'c_nationkey' AS feature, 1 AS rank, 1.0::DOUBLE AS importance")
def _(spark, sf):
    return rounded(step_result(spark, sf).importance())


@check("e18_predict_best_step", f"SELECT c_custkey, label, label AS prediction FROM {STEP}")
def _(spark, sf):
    return models.predict(step_result(spark, sf), step_table(spark, sf)).select("c_custkey", "label", "prediction")


@check("e19_model_comparison_step", f"SELECT model, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS cv_mean, 0.0::DOUBLE AS cv_std FROM {STEP_MODELS}")
def _(spark, sf):
    result = step_result(spark, sf)
    return rounded(models.comparison(result.metrics, result.task))


# One tree of two levels: nations come first, as they tell more, then the customer's number in each branch. A subset
# without a feature weighs both sides of its split by their shares of the rows that come there.
TWO_STEPS = """(SELECT c_custkey, c_nationkey, c_custkey % 7 AS day, CASE WHEN c_nationkey >= 12 THEN 100.0 ELSE 20.0 END
 + CASE WHEN c_custkey % 7 >= 3 THEN 5.0 ELSE 0.0 END + CASE WHEN c_nationkey >= 12 AND c_custkey % 7 >= 3 THEN 4.0 ELSE 0.0 END AS amount FROM customer)"""
TREE_SHAPLEY = f"""
WITH t AS (SELECT *, c_nationkey >= 12 AS far, day >= 3 AS late FROM {TWO_STEPS}),
sides AS (SELECT far, count(*) / (SELECT count(*) FROM t) AS share, avg(amount) AS mean FROM t GROUP BY 1),
cells AS (SELECT DISTINCT far, late, amount FROM t),
by_day AS (SELECT late, sum(share * amount) AS mean FROM cells JOIN sides USING (far) GROUP BY 1),
worths AS (SELECT t.c_custkey, t.c_nationkey, t.day, (SELECT avg(amount) FROM t) AS v, s.mean AS vn, d.mean AS vd, t.amount AS vnd
 FROM (SELECT * FROM t ORDER BY md5(concat_ws('|', '42', CAST(c_custkey AS VARCHAR))) LIMIT 100) t JOIN sides s USING (far) JOIN by_day d USING (late))
SELECT CAST(c_custkey AS VARCHAR) AS instance, 'c_nationkey' AS feature, c_nationkey::DOUBLE AS feature_value, (vn - v + vnd - vd) / 2 AS shapley_value FROM worths
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'day', day::DOUBLE, (vd - v + vnd - vn) / 2 FROM worths"""


@shared
def two_steps(spark, sf):
    nation, day = F.col("c_nationkey"), F.col("c_custkey") % 7
    amount = F.when(nation >= 12, 100.0).otherwise(20.0) + F.when(day >= 3, 5.0).otherwise(0.0) + F.when((nation >= 12) & (day >= 3), 4.0).otherwise(0.0)
    return materialize(table(spark, sf, "customer").select("c_custkey", "c_nationkey", day.alias("day"), amount.alias("amount")))


@check("f2_shapley_tree", f"SELECT instance, feature, feature_value, round(shapley_value, 6) AS shapley_value, 'tree' AS method FROM ({TREE_SHAPLEY})")
def _(spark, sf):
    df = two_steps(spark, sf)
    sizes = models.ModelSizes(rounds=1, round_depth=2)
    trained = models.train(df, "amount", "regression", "GradientBoosting", ["c_nationkey", "day"], sizes=sizes)
    return rounded(explain.shapley_values(trained, df, ["c_custkey"], method="tree"))


@check("f4_global_importance_tree", f"SELECT feature, round(avg(abs(shapley_value)), 6) AS importance FROM ({TREE_SHAPLEY}) GROUP BY feature")
def _(spark, sf):
    df = two_steps(spark, sf)
    trained = models.train(df, "amount", "regression", "GradientBoosting", ["c_nationkey", "day"], sizes=models.ModelSizes(rounds=1, round_depth=2))
    return rounded(explain.global_importance(explain.shapley_values(trained, df, ["c_custkey"], method="tree")))


# Every stump of the forest splits the classes cleanly, whatever rows it drew, so its values and the base sum to the class.
@check("f2_shapley_forest_of_stumps", f"""SELECT CAST(c_custkey AS VARCHAR) AS instance, 'c_nationkey' AS feature, label::DOUBLE AS explained
 FROM (SELECT * FROM {STEP} ORDER BY md5(concat_ws('|', '42', CAST(c_custkey AS VARCHAR))) LIMIT 100)""")
def _(spark, sf):
    df = step_table(spark, sf)
    trained = models.train(df, "label", "classification", "RandomForest", ["c_nationkey"], sizes=models.ModelSizes(trees=20, tree_depth=1))
    base = explain.tree_base_value(trained, spark).first()["base_value"]
    values = explain.shapley_values(trained, df, ["c_custkey"], method="tree")
    return rounded(values.select("instance", "feature", (F.col("shapley_value") + base).alias("explained")))


# Against background rows the stump's value is the class less the background's mean.
@check("f2_shapley_tree_background", f"""SELECT CAST(c_custkey AS VARCHAR) AS instance, 'c_nationkey' AS feature, round(label - base, 6) AS shapley_value
 FROM (SELECT * FROM {STEP} ORDER BY md5(concat_ws('|', '42', CAST(c_custkey AS VARCHAR))) LIMIT 100),
 (SELECT avg(label) AS base FROM (SELECT * FROM {STEP} ORDER BY md5(concat_ws('|', '43', CAST(c_custkey AS VARCHAR))) LIMIT 50))""")
def _(spark, sf):
    df = step_table(spark, sf)
    trained = models.train(df, "label", "classification", "RandomForest", ["c_nationkey"], sizes=STEP_SIZES)
    return rounded(explain.shapley_values(trained, df, ["c_custkey"], method="tree_background").select("instance", "feature", "shapley_value"))


# Inside the first quartile the target is 1, elsewhere 0: near a row of the first quartile the output is
# exactly "stays in its own bin", so the contribution is 1 less a small penalty.
QUARTILE_STEP = """(SELECT c_custkey, c_nationkey, q1, CAST(c_nationkey <= q1 AS INTEGER) AS low FROM customer, (SELECT quantile_cont(c_nationkey, 0.25) AS q1 FROM customer))"""
NEAR_SQL = f"""
SELECT CAST(c_custkey AS VARCHAR) AS instance, 1.0::DOUBLE AS prediction, 1.0::DOUBLE AS actual, 1 AS rank, 'c_nationkey' AS feature,
 printf('c_nationkey <= %.2f', q1) AS rule, 1.0::DOUBLE AS contribution
FROM (SELECT * FROM {QUARTILE_STEP} ORDER BY md5(concat_ws('|', '42', CAST(c_custkey AS VARCHAR))) LIMIT 20) WHERE low = 1"""


@shared
def near_surrogates(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    first = customers.agg(F.percentile("c_nationkey", 0.25)).first()[0]
    df = customers.withColumn("low", (F.col("c_nationkey") <= first).cast("int"))
    trained = models.train(df, "low", "classification", "RandomForest", ["c_nationkey"], sizes=STEP_SIZES)
    local = explain.local_surrogates(trained, df, ["c_custkey"], "low", instances=20, samples=1000)
    return materialize(local.where("actual = 1"))


@check("f5_local_surrogate_step", NEAR_SQL)
def _(spark, sf):
    return rounded(near_surrogates(spark, sf), 1)


@check("g9_top_local_contributions_step", f"SELECT * FROM ({NEAR_SQL})")
def _(spark, sf):
    return rounded(explain.top_contributions(near_surrogates(spark, sf)).select(*near_surrogates(spark, sf).columns), 1)


# The training part leaves round(share * rows) of each class out.
STEP_SIZES_SQL = f"""(SELECT CAST(sum(n - t) AS BIGINT) AS train_rows, CAST(sum(t) AS BIGINT) AS test_rows FROM
 (SELECT count(*) AS n, CAST(floor(0.2 * count(*) + 0.5) AS BIGINT) AS t FROM {STEP} GROUP BY label))"""


@check("g4_training_summary_step", f"""SELECT 'classification' AS task, 'label' AS target, train_rows, test_rows, 'RandomForest' AS best_model, 1.0::DOUBLE AS best_score FROM {STEP_SIZES_SQL}""")
def _(spark, sf):
    return rounded(report.training_summary(step_result(spark, sf)))


@check("g5_metric_table_step", f"SELECT model, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1_score, 1.0::DOUBLE AS cv_mean FROM {STEP_MODELS}")
def _(spark, sf):
    result = step_result(spark, sf)
    return rounded(report.metric_table(result.metrics, result.task))


@check("g6_top_importance_step", "SELECT 'RandomForest' AS model, 'c_nationkey' AS feature, 1 AS rank, 1.0::DOUBLE AS importance")
def _(spark, sf):
    return rounded(report.top_importance(step_result(spark, sf).importance()))


@check("g7_model_facts_step", f"""
SELECT 'model' AS section, name, value FROM {STEP_SIZES_SQL}, LATERAL (VALUES ('task', 'classification'), ('target', 'label'), ('models', '2'),
 ('train_rows', CAST(train_rows AS VARCHAR)), ('test_rows', CAST(test_rows AS VARCHAR)), ('RandomForest', '1.0000')) t(name, value)
UNION ALL SELECT 'scores', concat(model, ' ', metric), '1.0000' FROM {STEP_MODELS}, (VALUES ('accuracy'), ('f1_score')) t(metric)
UNION ALL SELECT 'importance', 'c_nationkey', '1.0000'""")
def _(spark, sf):
    return report.model_facts(step_result(spark, sf))


# --- F: explanations --------------------------------------------------------------------------------

@check("f1_row_sample", f"SELECT {KEY_LIST}, l_quantity FROM lineitem ORDER BY {LINE_HASH.format(seed=42)} LIMIT 100")
def _(spark, sf):
    return split.sample_rows(table(spark, sf, "lineitem").select(*LINE_KEYS, "l_quantity"), LINE_KEYS)


# A linear model with the weights of an additive score: one over each feature's deviation.
SCORE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEAR_SHAPLEY = f"""(SELECT s.instance, f.feature, f.v AS feature_value, f.w * (f.v - f.m) AS shapley_value FROM
 (SELECT concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS instance, * FROM lineitem ORDER BY {LINE_HASH.format(seed=42)} LIMIT 100) s,
 (SELECT {', '.join(f'avg({c}) AS m_{c}, 1 / stddev_pop({c}) AS w_{c}' for c in SCORE_FEATURES)} FROM lineitem) t,
 LATERAL (VALUES {', '.join(f"('{c}', s.{c}, t.w_{c}, t.m_{c})" for c in SCORE_FEATURES)}) AS f(feature, v, w, m))"""


def linear_shapley(spark, sf):
    df = table(spark, sf, "lineitem")
    row = df.agg(*[F.stddev_pop(c).alias(c) for c in SCORE_FEATURES]).first()
    weights = {c: 1 / row[c] for c in SCORE_FEATURES}
    return explain.linear_shapley_values(df, LINE_KEYS, weights, explain.feature_means(df, SCORE_FEATURES))


@check("f2_shapley_linear", f"SELECT instance, feature, round(feature_value, 6) AS feature_value, round(shapley_value, 6) AS shapley_value FROM {LINEAR_SHAPLEY}")
def _(spark, sf):
    return rounded(linear_shapley(spark, sf))


@check("f4_global_importance_linear", f"SELECT feature, round(avg(abs(shapley_value)), 6) AS importance FROM {LINEAR_SHAPLEY} GROUP BY feature")
def _(spark, sf):
    return rounded(explain.global_importance(linear_shapley(spark, sf)))


# Fixed value: the sentence a feature's direction is reported in.
@check("f6_directions_linear", f"""
SELECT feature, round(importance, 6) AS importance, direction,
 printf('Feature ''%s'' has average SHAP importance of %.4f. On average, this feature %s predictions.', feature, importance, direction) AS explanation FROM
 (SELECT feature, avg(abs(shapley_value)) AS importance, CASE WHEN avg(shapley_value) > 0 THEN 'increases' ELSE 'decreases' END AS direction
  FROM {LINEAR_SHAPLEY} GROUP BY feature ORDER BY importance DESC LIMIT 10)""")
def _(spark, sf):
    return rounded(explain.directions(linear_shapley(spark, sf)))


@shared
def account_shapley(spark, sf):
    return materialize(explain.shapley_values(account_result(spark, sf).best, account_table(spark, sf), ["c_custkey"]))


@check("f2_shapley_model")
def _(spark, sf):
    return rounded(account_shapley(spark, sf))


@check("f3_base_value")
def _(spark, sf):
    best = account_result(spark, sf).best
    return rounded(explain.base_value(best, explain.background_rows(account_table(spark, sf), ["c_custkey"], best.features, 50, 42)))


@check("f4_global_importance_model")
def _(spark, sf):
    return rounded(explain.global_importance(account_shapley(spark, sf)))


@check("f6_directions_model")
def _(spark, sf):
    return rounded(explain.directions(account_shapley(spark, sf)))


def surrogates(spark, sf):
    return explain.local_surrogates(account_result(spark, sf).best, account_table(spark, sf), ["c_custkey"], "order_total")


@check("f5_local_surrogate")
def _(spark, sf):
    return rounded(surrogates(spark, sf), 4)


@check("g9_top_local_contributions")
def _(spark, sf):
    return rounded(explain.top_contributions(surrogates(spark, sf)), 4)


# --- G: report tables -------------------------------------------------------------------------------

def number_fact(stage: str, metric: str) -> str:
    return f"max(CAST(value AS BIGINT)) FILTER (stage = '{stage}' AND metric = '{metric}' AND \"column\" IS NULL)"


OVERVIEW_SQL = f"""SELECT {number_fact('input', 'rows')} AS original_rows, {number_fact('input', 'columns')} AS original_columns,
 {number_fact('output', 'rows')} AS final_rows, {number_fact('output', 'columns')} AS final_columns, {number_fact('duplicates', 'removed')} AS duplicates_removed
 FROM (SELECT stage, "column", metric, CASE WHEN "column" IS NULL THEN value END AS value FROM ({METADATA_SQL}))"""


@check("g1_overview", OVERVIEW_SQL)
def _(spark, sf):
    return report.overview(part_plan(spark, sf).metadata())


GAPS = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]


@check("g2_missing_handled", stacked([f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM {GAPPED_LINEITEM}" for c in GAPS]))
def _(spark, sf):
    return report.missing_handled(profile.missing_counts(gapped_lineitem(spark, sf)))


@check("g3_outlier_summary", """
SELECT * FROM (SELECT 'value' AS "column", count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
 FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)) WHERE outliers > 0""")
def _(spark, sf):
    return report.outlier_summary(clean.outlier_counts(table(spark, sf, "events"), "iqr", ["value", "user_id"]))


@check("g4_training_summary")
def _(spark, sf):
    return rounded(report.training_summary(quality_result(spark, sf)))


@check("g5_metric_table_classification")
def _(spark, sf):
    result = quality_result(spark, sf)
    return rounded(report.metric_table(result.metrics, result.task))


@check("g5_metric_table_regression")
def _(spark, sf):
    result = account_result(spark, sf)
    return rounded(report.metric_table(result.metrics, result.task))


@check("g6_top_importance")
def _(spark, sf):
    return rounded(report.top_importance(account_result(spark, sf).importance()))


@check("g7_preparation_facts", f"""
WITH o AS ({OVERVIEW_SQL})
SELECT 'data' AS section, 'engineered_features' AS name, CAST(final_columns - original_columns AS VARCHAR) AS value FROM o
UNION ALL SELECT 'data', 'duplicates_removed', CAST(duplicates_removed AS VARCHAR) FROM o
UNION ALL SELECT 'missing', "column", value FROM ({METADATA_SQL}) WHERE stage = 'missing'""")
def _(spark, sf):
    metadata = part_plan(spark, sf).metadata()
    order = {c: i for i, c in enumerate(["p_name", "p_brand", "p_type", "p_size"])}
    return report.preparation_facts(metadata, report.missing_of(metadata, order))


@check("g7_summary_facts")
def _(spark, sf):
    metadata = part_plan(spark, sf).metadata()
    order = {c: i for i, c in enumerate(["p_name", "p_brand", "p_type", "p_size"])}
    return report.summary_facts(metadata, report.missing_of(metadata, order), quality_result(spark, sf))


@check("g8_deltas", f"""SELECT original_rows, final_rows - original_rows AS row_change, final_columns, final_columns - original_columns AS column_change,
 duplicates_removed FROM ({OVERVIEW_SQL})""")
def _(spark, sf):
    return report.deltas(part_plan(spark, sf).metadata())
