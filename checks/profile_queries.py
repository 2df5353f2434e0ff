"""Queries over sources, sinks and profiles, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, mode_sql, stacked
from checks.tables import GAPPED_LINEITEM, GAPPED_PART, LINE_KEYS, gapped_lineitem, gapped_part, rounded, table
from tableloom.operators import profile, sketches
from tableloom.session import materialize, scratch_path
from tableloom.sources import tables as sources

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: Ranges of the input that one task writes to one file.
RANGES_A_FILE = 4


# --- A: sources and sinks -------------------------------------------------------------------------

@check("a1_read_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(spark, sf):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = scratch_path(spark, "orders") + ".csv"
    sources.write_table(table(spark, sf, "orders").select(*columns), path)
    return sources.read_table(spark, path)


@check("a2_na_tokens_and_types", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
 CASE WHEN o_orderkey % 11 <> 4 THEN CAST(o_custkey AS DOUBLE) END AS o_custkey,
 CASE WHEN o_orderkey % 7 <> 2 THEN o_totalprice END AS o_totalprice,
 CASE WHEN o_orderkey % 5 <> 1 THEN o_orderpriority END AS o_orderpriority,
 o_orderkey % 2 = 0 AS is_even FROM orders""")
def _(spark, sf):
    key = F.col("o_orderkey")
    texts = table(spark, sf, "orders").select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 11 == 4, "null").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(key % 7 == 2, "NA").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 5 == 1, "n/a").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(key % 2 == 0, "True").otherwise("False").alias("is_even"),
    )
    return sources.infer_types(texts)


@check("a3_text_round_trip", """SELECT doc_id, concat('  "', text, '", ', chr(10), 'end ') AS text, lang FROM documents""")
def _(spark, sf):
    framed = F.concat(F.lit('  "'), F.col("text"), F.lit('", \nend ')).alias("text")
    path = sources.write_table(table(spark, sf, "documents").select("doc_id", framed, "lang"), scratch_path(spark, "texts") + ".csv")
    return sources.read_table(spark, path)


def joined_files(df):
    """Fewer files than the table has ranges, so each is cut again when it is read; a task writes ``RANGES_A_FILE`` ranges, whatever the table's size."""
    return df.coalesce(max(1, df.rdd.getNumPartitions() // RANGES_A_FILE))


# Breaks, quotes, commas and outer spaces in every text; a file is cut into many ranges.
@check("a1_read_csv_parallel", """SELECT doc_id, concat(' "', replace(text, ' ', chr(10)), '", ', chr(10), '""end" ') AS text, n_chars FROM documents""")
def _(spark, sf):
    framed = F.concat(F.lit(' "'), F.replace("text", F.lit(" "), F.lit("\n")), F.lit('", \n""end" ')).alias("text")
    path = sources.write_table(joined_files(table(spark, sf, "documents").select("doc_id", framed, "n_chars")), scratch_path(spark, "breaks") + ".csv")
    return sources.read_table(spark, path)


@check("a3_write_table", """
SELECT format, count(*) AS n_rows, sum(c_custkey)::BIGINT AS key_sum, round(sum(c_acctbal), 2) AS balance
FROM customer, (VALUES ('csv'), ('parquet')) AS f(format) GROUP BY format""")
def _(spark, sf):
    df = table(spark, sf, "customer")
    base = scratch_path(spark, "written")
    result = None
    for name in ("csv", "parquet"):
        path = sources.write_table(df, f"{base}/{name}/customer.{name}")
        back = sources.read_table(spark, path).agg(
            F.lit(name).alias("format"), F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").alias("key_sum"),
            F.round(F.sum("c_acctbal"), 2).alias("balance"),
        )
        result = back if result is None else result.unionByName(back)
    return result


@check("a4_feature_target_split", """
SELECT o_custkey, o_orderstatus, o_totalprice, o_orderpriority AS target FROM orders""")
def _(spark, sf):
    df = table(spark, sf, "orders")
    target = sources.resolve_target(df)
    kept = sources.feature_columns(df, target, ["o_orderkey", "o_orderdate"])
    return df.select(*kept, F.col(target).alias("target"))


# --- B: profiles ----------------------------------------------------------------------------------

@check("b1_shape", "SELECT count(*) AS rows, 11::BIGINT AS columns FROM lineitem")
def _(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


ORDER_KINDS = {
    "o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "categorical",
    "o_totalprice": "numeric", "o_orderdate": "datetime", "o_orderpriority": "categorical",
}


@check("b2_column_kinds", stacked([
    f"SELECT '{c}' AS \"column\", '{k}' AS kind, count({c}) AS present FROM orders" for c, k in ORDER_KINDS.items()
]))
def _(spark, sf):
    return profile.kinds_table(table(spark, sf, "orders"))


GAPPED_COLUMNS = [*LINE_KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
MISSING_SQL = stacked([
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, {i} AS position FROM {GAPPED_LINEITEM}"
    for i, c in enumerate(GAPPED_COLUMNS)
])


@check("b3_missing_counts", f'SELECT "column", missing FROM ({MISSING_SQL}) WHERE missing > 0')
def _(spark, sf):
    return profile.missing_counts(gapped_lineitem(spark, sf)).drop("position")


@check("b4_missing_ranking", f"""
SELECT "column", missing, CAST(total AS BIGINT) AS total FROM
 (SELECT *, sum(missing) OVER () AS total FROM ({MISSING_SQL})) WHERE missing > 0""")
def _(spark, sf):
    return profile.missing_ranking(gapped_lineitem(spark, sf))


@check("b5_numeric_describe", stacked([f"""
SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
 round(min({c}), 4)::DOUBLE AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
 round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4)::DOUBLE AS max FROM {GAPPED_LINEITEM}""" for c in LINE_NUMBERS]))
def _(spark, sf):
    return rounded(profile.describe(gapped_lineitem(spark, sf).select(*LINE_NUMBERS)), 4)


PART_TEXTS = ["p_name", "p_brand", "p_type"]


@check("b6_categorical_summary", stacked([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, {mode_sql(c, GAPPED_PART)} AS most_common FROM {GAPPED_PART}"
    for c in PART_TEXTS
]))
def _(spark, sf):
    return profile.categorical_summary(gapped_part(spark, sf))


# Sketches of seven batches, merged: the exact count lies within the stated bound.
SKETCHED = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]


def merged_sketches(spark, sf):
    batched = gapped_lineitem(spark, sf).withColumn("batch", F.col("l_orderkey") % 7)
    return sketches.merge_sketches(materialize(sketches.sketch_columns(batched, SKETCHED, ["batch"])))


@check("b6_approximate_summary", stacked([
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS exact, count(*) - count({c}) AS n_missing, true AS within FROM {GAPPED_LINEITEM}" for c in SKETCHED]))
def _(spark, sf):
    exact = gapped_lineitem(spark, sf).agg(*[F.countDistinct(c).alias(c) for c in SKETCHED])
    counts = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("exact")) for c in SKETCHED])))
    found = sketches.approximate_summary(merged_sketches(spark, sf)).join(counts, F.col("column") == F.col("name"))
    return found.select("column", "exact", "n_missing", F.col("exact").between(F.col("at_least"), F.col("at_most")).alias("within"))


@check("b6_approximate_categories", stacked([
    f"SELECT '{c}' AS \"column\", true AS within, {mode_sql(c, GAPPED_LINEITEM)} AS most_common" for c in ["l_returnflag", "l_linestatus"]]))
def _(spark, sf):
    df = gapped_lineitem(spark, sf).select("l_returnflag", "l_linestatus")
    counts = profile.categorical_summary(df).select(F.col("column").alias("name"), F.col("n_distinct").alias("exact"))
    found = profile.categorical_summary(df, approximate=True).join(counts, F.col("column") == F.col("name"))
    return found.select("column", (F.abs(F.col("n_distinct") - F.col("exact")) <= sketches.DISTINCT_ERROR * F.col("exact")).alias("within"), "most_common")


@check("b5_merged_quantiles", stacked([
    f"SELECT '{c}' AS \"column\", share::DOUBLE AS share, (SELECT count({c}) FROM {GAPPED_LINEITEM}) AS n_present, true AS within FROM (VALUES (0.25), (0.5), (0.75)) s(share)"
    for c in SKETCHED[:3]]))
def _(spark, sf):
    """The rows below and up to an approximate quantile enclose its share, within the rank error."""
    shares = [0.25, 0.5, 0.75]
    found = sketches.sketch_quantiles(merged_sketches(spark, sf), shares)
    df, rows, measures = gapped_lineitem(spark, sf), [], []
    for c in SKETCHED[:3]:
        for i, value in enumerate(found[c]):
            below, upto = F.count_if(F.col(c) < value) / F.count(c), F.count_if(F.col(c) <= value) / F.count(c)
            within = (below - sketches.RANK_ERROR <= shares[i]) & (shares[i] <= upto + sketches.RANK_ERROR)
            measures += [within.alias(f"w_{c}_{i}"), F.count(c).alias(f"n_{c}_{i}")]
            rows.append([("column", F.lit(c)), ("share", F.lit(shares[i])), ("n_present", F.col(f"n_{c}_{i}")), ("within", F.col(f"w_{c}_{i}"))])
    return profile.long_table(df.agg(*measures), rows)


@check("b7_preview", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def _(spark, sf):
    return profile.preview(table(spark, sf, "orders"), ["o_orderkey"])


@check("b8_correlations", stacked([
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {GAPPED_LINEITEM}"
    for a in LINE_NUMBERS for b in LINE_NUMBERS
]))
def _(spark, sf):
    return rounded(profile.correlations(gapped_lineitem(spark, sf).select(*LINE_NUMBERS)))


# Too many pairs for one aggregate: four gapped numbers in five forms each, and a key.
WIDE_BASES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
WIDE = {
    **{f"{c}_{i}": form.format(f"CAST({c} AS DOUBLE)") for c in WIDE_BASES for i, form in enumerate(["{0}", "{0} * {0}", "sqrt({0})", "{0} % 7", "ln(1 + {0})"])},
    "key": "CAST(l_suppkey AS DOUBLE)",
}
WIDE_VALUES = ", ".join(f"('{n}', {e})" for n, e in WIDE.items())


@check("b8_wide_correlations", f"""
SELECT a, b, round(corr(x, y), 6) AS r FROM {GAPPED_LINEITEM}, LATERAL (VALUES {WIDE_VALUES}) p(a, x), LATERAL (VALUES {WIDE_VALUES}) q(b, y) GROUP BY a, b""")
def _(spark, sf):
    wide = gapped_lineitem(spark, sf).select(*[F.expr(e).alias(n) for n, e in WIDE.items()])
    return rounded(profile.correlations(wide))


def box_sql(column: str, source: str) -> str:
    return f"""
SELECT '{column}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
 round(least(min(v) FILTER (v BETWEEN lo AND hi), any_value(q1)), 6) AS whisker_low,
 round(greatest(max(v) FILTER (v BETWEEN lo AND hi), any_value(q3)), 6) AS whisker_high,
 count(*) FILTER (v < lo OR v > hi) AS fliers
FROM (SELECT CAST({column} AS DOUBLE) AS v, q1, q2, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM {source},
 (SELECT quantile_cont(CAST({column} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({column} AS DOUBLE), 0.5) AS q2,
 quantile_cont(CAST({column} AS DOUBLE), 0.75) AS q3 FROM {source}))"""


@check("b9_box_plot", stacked([box_sql("value", "events"), box_sql("user_id", "events")]))
def _(spark, sf):
    return rounded(profile.box_plot(table(spark, sf, "events"), ["value", "user_id"]))


def histogram_sql(column: str, source: str, bins: int = 30) -> str:
    return f"""
SELECT '{column}' AS "column", g.bin, round(lo + g.bin * w, 6) AS bin_low, round(lo + (g.bin + 1) * w, 6) AS bin_high,
 coalesce(n, 0) AS n
FROM (SELECT lo, (hi - lo) / {bins} AS w, CAST(unnest(range({bins})) AS BIGINT) AS bin FROM
  (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})) g
LEFT JOIN (SELECT bin, count(*) AS n FROM (
  SELECT raw - CAST(v < lo + raw * w AS BIGINT) + CAST(v >= lo + (raw + 1) * w AND raw <> {bins - 1} AS BIGINT) AS bin FROM (
   SELECT {column} AS v, lo, (hi - lo) / {bins} AS w,
    CAST(least(floor(({column} - lo) / (hi - lo) * {bins}), {bins - 1}) AS BIGINT) AS raw
   FROM {source}, (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) WHERE {column} IS NOT NULL))
  GROUP BY bin) c ON g.bin = c.bin"""


@check("b10_histogram", stacked([histogram_sql(c, GAPPED_LINEITEM) for c in LINE_NUMBERS]))
def _(spark, sf):
    return rounded(profile.histogram(gapped_lineitem(spark, sf).select(*LINE_NUMBERS)))


@check("b11_feature_statistics", stacked([f"""
SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median,
 round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(max({c}), 4) AS max,
 round(skewness({c}), 4) AS skewness, round(kurtosis({c}), 4) AS kurtosis FROM {GAPPED_LINEITEM}"""
    for c in ["l_quantity", "l_discount", "l_tax"]]))
def _(spark, sf):
    return rounded(profile.feature_statistics(gapped_lineitem(spark, sf).select(*LINE_NUMBERS), "l_extendedprice"), 4)


QUALITY_COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
QUALITY_BLANKS = " + ".join(f"count(*) - count({c})" for c in QUALITY_COLUMNS)


@check("b12_quality_statistics", f"""
SELECT count(*) AS total_rows, 5::BIGINT AS total_columns, 3::BIGINT AS numeric_columns, 2::BIGINT AS categorical_columns,
 {QUALITY_BLANKS} AS missing_values_total, count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(QUALITY_COLUMNS)} FROM {GAPPED_LINEITEM})) AS duplicate_rows,
 round((count(*) * 5 - ({QUALITY_BLANKS})) * 100.0 / (count(*) * 5), 6)::DOUBLE AS completeness FROM {GAPPED_LINEITEM}""")
def _(spark, sf):
    return rounded(profile.quality_statistics(gapped_lineitem(spark, sf).select(*QUALITY_COLUMNS)))


@check("b13_completeness", f"""
SELECT count(*) * 5 AS cells, {QUALITY_BLANKS} AS missing,
 round((count(*) * 5 - ({QUALITY_BLANKS})) * 100.0 / (count(*) * 5), 6)::DOUBLE AS completeness FROM {GAPPED_LINEITEM}""")
def _(spark, sf):
    return rounded(profile.completeness(gapped_lineitem(spark, sf).select(*QUALITY_COLUMNS)))


@check("b14_data_size", """
SELECT bytes, round(bytes / 1024.0, 4)::DOUBLE AS kb, round(bytes / 1024.0 ** 2, 4)::DOUBLE AS mb, round(bytes / 1024.0 ** 3, 4)::DOUBLE AS gb FROM
 (SELECT CAST(sum(octet_length(encode(text)) + octet_length(encode(lang)) + octet_length(encode(source))) + 16 * count(*) AS BIGINT) AS bytes FROM documents)""")
def _(spark, sf):
    return rounded(profile.data_size(table(spark, sf, "documents")), 4)
