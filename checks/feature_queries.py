"""Queries over encoding, scaling, derived features and the whole preparation, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, mode_sql, stacked
from checks.tables import GAPPED_PART, LINE_KEYS, gapped_part, rounded, table
from tableloom.functions import columns as C
from tableloom.operators import encode, features
from tableloom.plans.options import PrepareOptions
from tableloom.plans.prepare import fit_prepare

PART_TEXTS = ["p_name", "p_brand", "p_type"]


@check("d1_encoding_policy", stacked([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, CASE WHEN count(DISTINCT {c}) <= 10 THEN 'onehot' ELSE 'label' END AS encoding FROM {GAPPED_PART}"
    for c in PART_TEXTS
]))
def _(spark, sf):
    return encode.encoding_policy(gapped_part(spark, sf))


PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
TYPE_INDICATORS = ", ".join(f"coalesce(p_type = '{t}', false) AS \"p_type_{t}\"" for t in PART_TYPES[1:])


@check("d2_onehot", f"SELECT p_partkey, {TYPE_INDICATORS} FROM {GAPPED_PART}")
def _(spark, sf):
    df = gapped_part(spark, sf).select("p_partkey", "p_type")
    return encode.onehot_encode(df, ["p_type"])


@check("d3_label_encoding", f"""
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY coalesce(p_name, 'nan')) - 1 AS INTEGER) AS p_name,
 CAST(dense_rank() OVER (ORDER BY coalesce(p_brand, 'nan')) - 1 AS INTEGER) AS p_brand FROM {GAPPED_PART}""")
def _(spark, sf):
    return encode.label_encode(gapped_part(spark, sf).select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"])


def centred(column: str, center: str, scale: str) -> str:
    return f"round(({column} - (SELECT {center} FROM lineitem)) / (SELECT {scale} FROM lineitem), 6) AS {column}"


KEY_LIST = ", ".join(LINE_KEYS)
SCALED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@check("d4_standard_scaling", f"""
SELECT {KEY_LIST}, {', '.join(centred(c, f'avg({c})', f'stddev_pop({c})') for c in SCALED)} FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE_KEYS, *SCALED)
    return rounded(features.fit_standard(df, SCALED).transform(df))


@check("d5_robust_scaling", f"""
SELECT {KEY_LIST}, {', '.join(centred(c, f'quantile_cont({c}, 0.5)', f'quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)') for c in SCALED)} FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(*LINE_KEYS, *SCALED)
    return rounded(features.fit_robust(df, SCALED).transform(df))


@check("d6_pair_product", f"""
SELECT {KEY_LIST}, round(l_quantity * l_extendedprice, 4) AS l_quantity_x_l_extendedprice, round(l_extendedprice * l_discount, 4) AS l_extendedprice_x_l_discount FROM lineitem""")
def _(spark, sf):
    return rounded(table(spark, sf, "lineitem").select(
        *LINE_KEYS, features.pair_product("l_quantity", "l_extendedprice"), features.pair_product("l_extendedprice", "l_discount")), 4)


@check("d7_pair_ratio", f"""
SELECT {KEY_LIST}, round(l_extendedprice / (l_quantity + 1e-8), 4) AS l_extendedprice_div_l_quantity, round(l_quantity / (l_extendedprice + 1e-8), 8) AS l_quantity_div_l_extendedprice FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select(
        *LINE_KEYS, features.pair_ratio("l_extendedprice", "l_quantity"), features.pair_ratio("l_quantity", "l_extendedprice"))
    return df.withColumns({
        "l_extendedprice_div_l_quantity": F.round("l_extendedprice_div_l_quantity", 4),
        "l_quantity_div_l_extendedprice": F.round("l_quantity_div_l_extendedprice", 8),
    })


@check("d8_square", f"SELECT {KEY_LIST}, l_quantity * l_quantity AS l_quantity_squared, round(l_discount * l_discount, 6) AS l_discount_squared FROM lineitem")
def _(spark, sf):
    return rounded(table(spark, sf, "lineitem").select(*LINE_KEYS, features.square("l_quantity"), features.square("l_discount")))


@check("d9_log_magnitude", "SELECT c_custkey, round(ln(1 + abs(c_acctbal)), 6) AS c_acctbal_log FROM customer")
def _(spark, sf):
    return rounded(table(spark, sf, "customer").select("c_custkey", features.log_magnitude("c_acctbal")))


# The whole preparation of part: gaps filled, features de-duplicated with the lowest key kept, sizes
# capped, two text columns coded and one turned into indicators, all scaled, features derived.
def scaled_sql(column: str, center: str, scale: str) -> str:
    return f"({column} - {center}) / coalesce(nullif({scale}, 0), 1) AS {column}"


def prepared_part_sql(scaler: str = "standard", derived: bool = True) -> str:
    numbers = ["p_name", "p_brand", "p_size"]
    if scaler == "robust":
        measures = ", ".join(
            f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s_{c}" for c in numbers)
    else:
        measures = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in numbers)
    scaled = ", ".join(scaled_sql(c, f"m_{c}", f"s_{c}") for c in numbers)
    names = [f"p_type_{t}" for t in PART_TYPES[1:]]
    pairs = [("p_name", "p_brand"), ("p_brand", "p_size")]
    extra = [f"round({a} * {b}, 6) AS {a}_x_{b}, round({a} / ({b} + 1e-8), 6) AS {a}_div_{b}" for a, b in pairs]
    extra += [f"round({c} * {c}, 6) AS {c}_squared, round(ln(1 + abs({c})), 6) AS {c}_log" for c in numbers]
    return f"""
WITH gapped AS (SELECT * FROM {GAPPED_PART}),
filled AS (SELECT p_partkey, p_name, coalesce(p_brand, {mode_sql('p_brand', 'gapped')}) AS p_brand,
 coalesce(p_type, {mode_sql('p_type', 'gapped')}) AS p_type,
 coalesce(CAST(p_size AS DOUBLE), (SELECT quantile_cont(CAST(p_size AS DOUBLE), 0.5) FROM gapped)) AS p_size, p_retailprice FROM gapped),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand, p_type, p_size ORDER BY p_partkey) AS rn FROM filled) WHERE rn = 1),
fences AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT quantile_cont(p_size, 0.25) AS q1, quantile_cont(p_size, 0.75) AS q3 FROM firsts)),
coded AS (SELECT p_partkey, p_retailprice, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS DOUBLE) AS p_name,
 CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS p_brand, greatest(lo, least(hi, p_size)) AS p_size,
 {', '.join(f"p_type = '{t}' AS p_type_{t}" for t in PART_TYPES[1:])} FROM firsts, fences),
scaled AS (SELECT p_partkey, p_retailprice, {scaled}, {', '.join(names)} FROM coded, (SELECT {measures} FROM coded))
SELECT p_partkey, p_retailprice, {', '.join(f'round({c}, 6) AS {c}' for c in numbers)}, {', '.join(names)}{', ' + ', '.join(extra) if derived else ''} FROM scaled"""


def part_plan(spark, sf, **options):
    return fit_prepare(gapped_part(spark, sf), "p_retailprice", ["p_partkey"], PrepareOptions(**options))


@check("d10_full_preparation", prepared_part_sql())
def _(spark, sf):
    return rounded(part_plan(spark, sf).fitted_table())


@check("d10_full_preparation_robust", prepared_part_sql("robust", derived=False))
def _(spark, sf):
    return rounded(part_plan(spark, sf, scaler="robust", derive_features=False).fitted_table())


DERIVED_NAMES = ["p_name_x_p_brand", "p_name_div_p_brand", "p_brand_x_p_size", "p_brand_div_p_size"] + [
    f"{c}_{kind}" for c in ["p_name", "p_brand", "p_size"] for kind in ("squared", "log")
]
OUTPUT_KINDS = {c: "numeric" for c in ["p_name", "p_brand", "p_size"]} | {
    f"p_type_{t}": "other" for t in PART_TYPES[1:]} | {c: "numeric" for c in DERIVED_NAMES}


def fact(stage: str, column: str | None, metric: str, value: str) -> str:
    name = f"'{column}'" if column else "NULL::VARCHAR"
    return f"SELECT '{stage}' AS stage, {name} AS \"column\", '{metric}' AS metric, CAST({value} AS VARCHAR) AS value"


FILLED_PART = f"""(SELECT p_partkey, p_name, coalesce(p_brand, {mode_sql('p_brand', GAPPED_PART)}) AS p_brand,
 coalesce(p_type, {mode_sql('p_type', GAPPED_PART)}) AS p_type,
 coalesce(CAST(p_size AS DOUBLE), (SELECT quantile_cont(CAST(p_size AS DOUBLE), 0.5) FROM {GAPPED_PART})) AS p_size FROM {GAPPED_PART})"""
FIRST_PART = f"(SELECT p_name, p_brand, p_type, p_size FROM {FILLED_PART} GROUP BY ALL)"
SIZE_FENCES = f"""(SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
 (SELECT quantile_cont(p_size, 0.25) AS q1, quantile_cont(p_size, 0.75) AS q3 FROM {FIRST_PART}))"""
PART_ROWS = f"(SELECT count(*) FROM {GAPPED_PART})"
PART_FINAL_ROWS = f"(SELECT count(*) FROM {FIRST_PART})"
PART_OUTLIERS = f"(SELECT count(*) FILTER (p_size < lo OR p_size > hi) FROM {FIRST_PART}, {SIZE_FENCES})"
PART_MISSING = {c: f"(SELECT count(*) - count({c}) FROM {GAPPED_PART})" for c in ("p_brand", "p_type", "p_size")}

METADATA_SQL = stacked(
    [fact("input", None, "rows", PART_ROWS), fact("input", None, "columns", "4")]
    + [fact("input", c, "type", f"'{t}'") for c, t in
       {"p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int"}.items()]
    + [fact("missing", c, "count", sql) for c, sql in PART_MISSING.items()]
    + [fact("duplicates", None, "removed", f"{PART_ROWS} - {PART_FINAL_ROWS}")]
    + [fact("outliers", "p_size", "count", PART_OUTLIERS)]
    + [fact("encoding", "p_name", "encoding", "'label'"), fact("encoding", "p_brand", "encoding", "'label'"),
       fact("encoding", "p_type", "encoding", "'onehot'")]
    + [fact("output", None, "rows", PART_FINAL_ROWS), fact("output", None, "columns", str(len(OUTPUT_KINDS)))]
    + [fact("output", c, "kind", f"'{k}'") for c, k in OUTPUT_KINDS.items()]
)


@check("d11_preparation_metadata", METADATA_SQL)
def _(spark, sf):
    return part_plan(spark, sf).metadata()


@check("d12_clip", "SELECT c_custkey, greatest(0.0, least(5000.0, c_acctbal))::DOUBLE AS both, greatest(0.0, c_acctbal)::DOUBLE AS lower FROM customer")
def _(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", C.clip(balance, 0, 5000).alias("both"), C.clip(balance, lower=0).alias("lower"))


@check("d13_score_and_label", f"""
SELECT {KEY_LIST}, round(score, 6) AS score, CAST(score > 0.5 AS INTEGER) AS label FROM (
 SELECT *, 0.5 * (l_quantity - 1) / 49 + 0.3 * l_discount / 0.1 + 0.2 * (1 - l_tax / 0.08) AS score FROM
 (SELECT {KEY_LIST}, l_quantity, l_discount, l_tax FROM lineitem))""")
def _(spark, sf):
    score = C.weighted_score([
        (0.5, F.col("l_quantity"), 1, 49), (0.3, F.col("l_discount"), 0, 0.1), (0.2, 1 - F.col("l_tax") / 0.08, 0, 1)])
    df = table(spark, sf, "lineitem").select(*LINE_KEYS, score.alias("score"))
    return rounded(df.withColumn("label", C.threshold_label(F.col("score"))))


@check("d14_value_map", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1.5 WHEN '2-HIGH' THEN 1.3 WHEN '3-MEDIUM' THEN 1.0 END::DOUBLE AS factor,
 round(o_totalprice * CASE o_orderpriority WHEN '1-URGENT' THEN 1.5 WHEN '2-HIGH' THEN 1.3 WHEN '3-MEDIUM' THEN 1.0 END::DOUBLE, 4) AS weighted FROM orders""")
def _(spark, sf):
    factor = C.map_values(F.col("o_orderpriority"), {"1-URGENT": 1.5, "2-HIGH": 1.3, "3-MEDIUM": 1.0})
    return rounded(table(spark, sf, "orders").select(
        "o_orderkey", factor.alias("factor"), (F.col("o_totalprice") * factor).alias("weighted")), 4)


@check("d15_calendar", """
SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS is_weekend FROM orders""")
def _(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", C.day_of_week(day).alias("day_of_week"), C.is_weekend(day).alias("is_weekend"))


@check("d16_null_injection", f"SELECT * FROM {GAPPED_PART}")
def _(spark, sf):
    return gapped_part(spark, sf)


# The flagship: lineitem with gaps, prepared end to end with the price as target. The ratios' lower
# sides (quantity and month) have no value near their mean, where a ratio would only show rounding.
FLAGSHIP_NUMBERS = ["l_tax", "l_quantity", "ship_month"]
LINE_GAPPED = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_tax,
 CASE WHEN l_partkey % 17 <> 3 THEN l_quantity END AS l_quantity,
 CASE WHEN l_suppkey % 13 <> 2 THEN month(l_shipdate) END AS ship_month,
 CASE WHEN l_partkey % 19 <> 4 THEN l_returnflag END AS l_returnflag, l_linestatus FROM lineitem)"""


def each_number(template: str) -> str:
    return ", ".join(template.replace("$", c) for c in FLAGSHIP_NUMBERS)


FLAGSHIP_SQL = f"""
WITH gapped AS (SELECT * FROM {LINE_GAPPED}),
filled AS (SELECT {KEY_LIST}, l_extendedprice, {each_number('coalesce(CAST($ AS DOUBLE), (SELECT quantile_cont(CAST($ AS DOUBLE), 0.5) FROM gapped)) AS $')},
 coalesce(l_returnflag, {mode_sql('l_returnflag', 'gapped')}) AS l_returnflag, l_linestatus FROM gapped),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {each_number('$')}, l_returnflag, l_linestatus
 ORDER BY {KEY_LIST}, l_extendedprice) AS rn FROM filled) WHERE rn = 1),
quartiles AS (SELECT {each_number('quantile_cont($, 0.25) AS q1_$, quantile_cont($, 0.75) AS q3_$')} FROM firsts),
coded AS (SELECT {KEY_LIST}, l_extendedprice,
 {each_number('greatest(q1_$ - 1.5 * (q3_$ - q1_$), least(q3_$ + 1.5 * (q3_$ - q1_$), $)) AS $')},
 l_returnflag = 'N' AS l_returnflag_N, l_returnflag = 'R' AS l_returnflag_R, l_linestatus = 'O' AS l_linestatus_O FROM firsts, quartiles),
scaled AS (SELECT {KEY_LIST}, l_extendedprice, {each_number('($ - m_$) / s_$ AS $')}, l_returnflag_N, l_returnflag_R, l_linestatus_O
 FROM coded, (SELECT {each_number('avg($) AS m_$, stddev_pop($) AS s_$')} FROM coded))
SELECT {KEY_LIST}, l_extendedprice, {each_number('round($, 4) AS $')}, l_returnflag_N, l_returnflag_R, l_linestatus_O,
 {', '.join(f'round({a} * {b}, 4) AS {a}_x_{b}, round({a} / ({b} + 1e-8), 4) AS {a}_div_{b}' for a, b in zip(FLAGSHIP_NUMBERS, FLAGSHIP_NUMBERS[1:]))},
 {each_number('round($ * $, 4) AS $_squared, round(ln(1 + abs($)), 4) AS $_log')} FROM scaled"""


def flagship_input(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LINE_KEYS, "l_extendedprice", "l_tax",
        C.null_every(F.col("l_quantity"), F.col("l_partkey"), 17, 3).alias("l_quantity"),
        C.null_every(F.month("l_shipdate"), F.col("l_suppkey"), 13, 2).alias("ship_month"),
        C.null_every(F.col("l_returnflag"), F.col("l_partkey"), 19, 4).alias("l_returnflag"), "l_linestatus",
    )


def flagship(spark, sf):
    plan = fit_prepare(flagship_input(spark, sf), "l_extendedprice", LINE_KEYS)
    return rounded(plan.fitted_table(), 4)


check("d10_prepare_lineitem", FLAGSHIP_SQL)(flagship)
