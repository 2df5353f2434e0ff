"""Queries over cleaning stages, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, mode_sql, stacked
from checks.tables import GAPPED_LINEITEM, GAPPED_PART, LINE_KEYS, gapped_lineitem, gapped_part, rounded, table
from tableloom.functions.columns import null_every
from tableloom.functions.text import clean_prose, paragraphs
from tableloom.operators import clean, profile
from tableloom.operators.neighbours import fill_from_neighbours
from tableloom.session import scratch_path, spread_few
from tableloom.streaming.apply import write_stream
from tableloom.streaming.duplicates import first_rows

KEY_LIST = ", ".join(LINE_KEYS)
LINE_FEATURES = ["l_quantity", "l_discount", "l_returnflag", "l_linestatus"]


@check("c1_drop_sparse_columns", f"""
SELECT {KEY_LIST}, l_quantity, l_extendedprice, l_tax, l_returnflag, l_linestatus FROM {GAPPED_LINEITEM}""")
def _(spark, sf):
    return clean.drop_sparse_columns(gapped_lineitem(spark, sf), 0.5, LINE_KEYS)


@check("c2_median_imputation", f"""
SELECT {KEY_LIST}, round(coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM {GAPPED_LINEITEM})), 6) AS l_quantity,
 round(coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM {GAPPED_LINEITEM})), 6) AS l_tax FROM {GAPPED_LINEITEM}""")
def _(spark, sf):
    df = gapped_lineitem(spark, sf).select(*LINE_KEYS, "l_quantity", "l_tax")
    return rounded(clean.fit_median(df, ["l_quantity", "l_tax"]).transform(df))


@check("c3_mode_imputation", f"""
SELECT p_partkey, coalesce(p_brand, {mode_sql('p_brand', GAPPED_PART)}) AS p_brand,
 coalesce(p_type, {mode_sql('p_type', GAPPED_PART)}) AS p_type FROM {GAPPED_PART}""")
def _(spark, sf):
    df = gapped_part(spark, sf).select("p_partkey", "p_brand", "p_type")
    return clean.fit_mode(df, ["p_brand", "p_type"]).transform(df)


# The squared distance adds the columns in order and scales by all (3) over shared columns.
GAPPED_CUSTOMER = """(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 3 THEN c_acctbal END AS a,
 CASE WHEN c_custkey % 11 <> 5 THEN CAST(c_nationkey AS DOUBLE) END AS b,
 CAST(c_custkey % 41 AS DOUBLE) AS d FROM customer)"""


def neighbour_sql(column: str) -> str:
    both = {c: f"(r.{c} IS NOT NULL AND t.{c} IS NOT NULL)" for c in "abd"}
    total = " + ".join(f"(CASE WHEN {ok} THEN (r.{c} - t.{c}) * (r.{c} - t.{c}) ELSE 0 END)" for c, ok in both.items())
    shared = " + ".join(f"CAST({ok} AS INTEGER)" for ok in both.values())
    return f"""(SELECT k, list_avg(list_transform(nearest, lambda e: e.v)) AS fill FROM (
 SELECT r.c_custkey AS k, min({{'d': ({total}) * (3 / ({shared})), 'v': t.{column}}}, 5) AS nearest
 FROM {GAPPED_CUSTOMER} r, {GAPPED_CUSTOMER} t WHERE r.{column} IS NULL AND t.{column} IS NOT NULL GROUP BY r.c_custkey))"""


@check("c4_knn_imputation", f"""
SELECT g.c_custkey, round(coalesce(g.a, fa.fill), 6) AS a, round(coalesce(g.b, fb.fill), 6) AS b, g.d
FROM {GAPPED_CUSTOMER} g LEFT JOIN {neighbour_sql('a')} fa ON fa.k = g.c_custkey LEFT JOIN {neighbour_sql('b')} fb ON fb.k = g.c_custkey""")
def _(spark, sf):
    key = F.col("c_custkey")
    df = table(spark, sf, "customer").select(
        "c_custkey", null_every(F.col("c_acctbal"), key, 7, 3).alias("a"),
        null_every(F.col("c_nationkey").cast("double"), key, 11, 5).alias("b"), (key % 41).cast("double").alias("d"),
    )
    return rounded(fill_from_neighbours(df, ["a", "b", "d"]))


@check("c5_drop_duplicates", f"""
SELECT {KEY_LIST}, l_quantity, l_discount, l_returnflag, l_linestatus FROM (
 SELECT *, row_number() OVER (PARTITION BY l_quantity, l_discount, l_returnflag, l_linestatus ORDER BY {KEY_LIST}) AS rn FROM lineitem) WHERE rn = 1""")
def _(spark, sf):
    return clean.drop_duplicates(table(spark, sf, "lineitem").select(*LINE_KEYS, *LINE_FEATURES), LINE_FEATURES, LINE_KEYS)


@check("c5_duplicate_count", """
SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem)) AS duplicates FROM lineitem""")
def _(spark, sf):
    return profile.duplicate_count(table(spark, sf, "lineitem").select(*LINE_FEATURES))


# Three deliveries of files; the query starts anew on its checkpoint after each. The first delivery of a key stays.
@check("c5_stream_duplicates", "SELECT user_id, event_type, CAST(min(event_id % 3) AS BIGINT) AS delivery FROM events GROUP BY 1, 2")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", (F.col("event_id") % 3).alias("delivery"))
    base = scratch_path(spark, "stream")
    for number in range(3):
        events.where(F.col("delivery") == number).repartition(2).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        kept = first_rows(stream, ["user_id", "event_type"])
        write_stream(kept, f"{base}/out", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{base}/out")


def fence_sql(column: str, source: str) -> str:
    return f"""(SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
 (SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM {source}))"""


# Events with the value squared have outliers on one side, orders of magnitude apart.
EVENTS = "(SELECT event_id, value, value * value AS energy, CAST(user_id AS DOUBLE) AS user_id FROM events)"


def events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "value", (F.col("value") * F.col("value")).alias("energy"), F.col("user_id").cast("double").alias("user_id")
    )


EVENT_NUMBERS = ["value", "energy", "user_id"]


@check("c6_iqr_outlier_counts", stacked([f"""
SELECT '{c}' AS "column", count(*) FILTER ({c} < lo OR {c} > hi) AS outliers FROM {EVENTS}, {fence_sql(c, EVENTS)}""" for c in EVENT_NUMBERS]))
def _(spark, sf):
    return clean.outlier_counts(events(spark, sf), "iqr", EVENT_NUMBERS).drop("position")


@check("c7_iqr_capping", f"""
SELECT event_id, round(greatest(v.lo, least(v.hi, value)), 6) AS value, round(greatest(e.lo, least(e.hi, energy)), 5) AS energy, user_id
FROM {EVENTS}, {fence_sql('value', EVENTS)} v, {fence_sql('energy', EVENTS)} e""")
def _(spark, sf):
    df = events(spark, sf)
    capped = clean.fit_iqr(df, ["value", "energy"]).transform(df)
    return rounded(capped.withColumn("energy", F.rint(F.col("energy") * 1e5) / 1e5))


@check("c8_zscore_outlier_counts", stacked([f"""
SELECT '{c}' AS "column", count(*) FILTER (abs(({c} - m) / s) > 3) AS outliers FROM {EVENTS}, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {EVENTS})"""
    for c in EVENT_NUMBERS]))
def _(spark, sf):
    return clean.outlier_counts(events(spark, sf), "zscore", EVENT_NUMBERS).drop("position")


ZSCORE_STEPS = []
_source = EVENTS
for _i, _c in enumerate(EVENT_NUMBERS):
    ZSCORE_STEPS.append(
        f"kept{_i} AS (SELECT e.* FROM {_source} e, (SELECT avg({_c}) AS m, stddev_samp({_c}) AS s FROM {_source}) WHERE abs(({_c} - m) / s) <= 3)"
    )
    _source = f"kept{_i}"


@check("c9_zscore_row_removal", f"WITH {', '.join(ZSCORE_STEPS)} SELECT event_id, value, round(energy, 4) AS energy, user_id FROM {_source}")
def _(spark, sf):
    df = events(spark, sf)
    fitted, _ = clean.fit_zscore_sequential(df, EVENT_NUMBERS)
    return rounded(fitted.transform(df), 4)


@check("c10_count_only", f"""
SELECT count(*) AS rows, round(max(value), 4) AS largest, (SELECT count(*) FILTER (value < lo OR value > hi) FROM {EVENTS}, {fence_sql('value', EVENTS)}) AS outliers FROM {EVENTS}""")
def _(spark, sf):
    df = events(spark, sf)
    fences = clean.fit_iqr(df, ["value"])
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.max("value"), 4).alias("largest"),
        F.count_if(fences.is_outlier("value")).alias("outliers"),
    )


# Headings, list lines, bold marks and special characters put around the given texts.
MARKED_TEXT = """concat(CASE doc_id % 4 WHEN 0 THEN '## ' WHEN 1 THEN '- ' WHEN 2 THEN '**' ELSE '' END, text,
 chr(10), chr(10), '• 5 × 3 → 15 m² `x`', chr(10), '   ', chr(10), '* item', chr(10), chr(10), '.hidden')"""
# The white space and the marks that the cleaning rules are defined by.
SPACES = "[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def replaced_sql(text: str, marks: list[tuple[str, str]]) -> str:
    for mark, by in marks:
        text = f"replace({text}, '{mark}', '{by}')"
    return text


# Marks removed and characters replaced.
NORMAL = [("###", ""), ("##", ""), ("**", ""), ("■", ""), ("▪", ""), ("•", ""), ("‑", "-"), ("×", "x"), ("→", "->")]


def squeeze_sql(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACES}', ' ', 'g'), ' ')"


def marked_documents(spark, sf):
    df = table(spark, sf, "documents")
    kind = F.col("doc_id") % 4
    start = F.when(kind == 0, "## ").when(kind == 1, "- ").when(kind == 2, "**").otherwise("")
    text = F.concat(start, F.col("text"), F.lit("\n\n• 5 × 3 → 15 m² `x`\n   \n* item\n\n.hidden"))
    return df.select("doc_id", text.alias("text"))


LINES = f"list_transform(string_split({replaced_sql(MARKED_TEXT, [*NORMAL, ('`', ''), ('*', '')])}, chr(10)), lambda x: {squeeze_sql('x')})"


@check("c11_clean_prose", f"""
SELECT doc_id, array_to_string(list_filter({LINES}, lambda x: x <> '' AND left(x, 1) NOT IN ('#', '-', '*', '.')), concat(chr(10), chr(10))) AS cleaned FROM documents""")
def _(spark, sf):
    return spread_few(marked_documents(spark, sf)).select("doc_id", clean_prose(F.col("text")).alias("cleaned"))


@check("c12_paragraphs", f"""
SELECT doc_id, position, paragraph FROM (SELECT doc_id, CAST(position AS INTEGER) AS position, {squeeze_sql('part')} AS paragraph FROM (
 SELECT doc_id, unnest(parts) AS part, unnest(range(len(parts))) AS position FROM (
  SELECT doc_id, string_split({replaced_sql(MARKED_TEXT, NORMAL)}, concat(chr(10), chr(10))) AS parts FROM documents)))
WHERE paragraph <> '' AND left(paragraph, 1) NOT IN ('#', '-', '*', '.')""")
def _(spark, sf):
    return paragraphs(spread_few(marked_documents(spark, sf)), "text", ["doc_id"])
