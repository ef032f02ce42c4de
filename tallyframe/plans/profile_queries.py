"""Scans, audits and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import indicator, sentinel_to_null, shape_label, variability_label
from ..operators import describe as d
from ..operators import frequency as fq
from ..operators import outliers as o
from ..operators import relate as rel
from ..operators import validate as v
from ..operators.ordering import exact_quantiles
from ..sources.tables import read_table
from . import frames as fr
from .catalog import query

N4 = fr.LINE_COLUMNS
LONG = fr.long_sql("li", N4)
PCTS = {"p01": 0.01, "p05": 0.05, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
PCT_SQL = ", ".join(f"quantile_cont(value, {p}) AS {n}" for n, p in PCTS.items())
BIG = {"variance_sample": 2, "std_sample": 4, "mean": 5, "cv_percent": 5}
FENCED = f"""WITH {fr.LINES}, long AS ({LONG}),
fences AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1),
placed AS (SELECT l.*, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM long l JOIN fences USING (variable))"""


@query("s3_pruned_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000", "o_totalprice")
def _(spark, folder):
    return read_table(spark, folder, "orders", ["o_orderkey", "o_totalprice"]).where("o_totalprice > 100000")


def _prepared_pair(spark, folder):
    """Customer balances and a keyed second table with original, capped and scaled variants."""
    from ..operators.prepare import column_stack
    base = fr.customers(spark, folder)
    return base, column_stack(base, "c_custkey", ["c_acctbal"]).withColumnRenamed("c_acctbal_raw", "c_acctbal_original")


STACK = f"""WITH {fr.CUSTOMERS}, s AS (SELECT median(c_acctbal) AS med, quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3 FROM cu),
f AS (SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal AS raw, coalesce(c_acctbal, med) AS imputed,
  least(greatest(coalesce(c_acctbal, med), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) AS capped, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM cu, s),
st AS (SELECT min(capped) AS a, max(capped) AS b, avg(capped) AS m, stddev_pop(capped) AS sd FROM f),
stack AS (SELECT f.*, (capped - a) / (b - a) AS mm, (capped - m) / sd AS z FROM f, st)"""


@query("s4_aligned_ingest", STACK + "SELECT c_custkey, c_nationkey, capped AS c_acctbal, c_mktsegment FROM stack", "c_acctbal")
def _(spark, folder):
    original, prepared = _prepared_pair(spark, folder)
    return v.aligned_ingest(original, prepared, "c_custkey", ["c_acctbal"])


@query("v2_duplicate_keys", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, folder):
    return v.duplicate_keys(read_table(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"]), ["l_orderkey", "l_linenumber"])


ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "priority": "string", "o_orderstatus": "string", "y": "string", "day": "date"}


def _overview_sql(column: str, kind: str) -> str:
    unknown = f"count(*) FILTER (WHERE {column} = 'unknown')" if kind == "string" else "0"
    return (f"SELECT '{column}' AS variable, count(DISTINCT {column}) AS unique_count, count(*) - count({column}) AS missing_count, "
            f"CAST({unknown} AS BIGINT) AS unknown_count, '{kind}' AS data_type FROM od")


@query("v3_column_overview", f"WITH {fr.ORDERS} " + " UNION ALL ".join(_overview_sql(c, k) for c, k in ORDER_TYPES.items()))
def _(spark, folder):
    return v.column_overview(fr.orders(spark, folder))


@query("v4_null_census", f"WITH {fr.LINES} " + " UNION ALL ".join(f"SELECT '{c}' AS variable, count(*) - count({c}) AS missing_count FROM li" for c in N4))
def _(spark, folder):
    return v.null_census(fr.lines(spark, folder), N4)


@query("v5_missing_audit", f"""WITH {fr.CUSTOMERS} SELECT 'c_acctbal' AS variable, count(*) - count(c_acctbal) AS true_null_before,
  CAST(0 AS BIGINT) AS semantic_unknown_before, CAST(0 AS BIGINT) AS null_after FROM cu
  UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment), count(*) FILTER (WHERE c_mktsegment = 'unknown'), CAST(0 AS BIGINT) FROM cu""")
def _(spark, folder):
    from ..operators.prepare import MedianImputer, ModeImputer
    raw = fr.customers(spark, folder)
    marked = raw.withColumn("c_mktsegment", sentinel_to_null("c_mktsegment"))
    clean = MedianImputer(["c_acctbal"]).fit(marked).transform(ModeImputer(["c_mktsegment"]).fit(marked).transform(marked))
    return v.missing_audit(raw, clean, ["c_acctbal", "c_mktsegment"])


def _class_sql(t: str) -> str:
    return f"SELECT '{t}' AS target, CAST({t} AS VARCHAR) AS class, count(*) AS count, 100.0 * count(*) / sum(count(*)) OVER () AS percent FROM lineitem GROUP BY {t}"


@query("v6_class_distribution", " UNION ALL ".join(_class_sql(t) for t in ("l_returnflag", "l_linestatus")), "percent")
def _(spark, folder):
    return v.class_distribution(read_table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("v7_alignment_audit", STACK + """SELECT 'c_acctbal' AS variable, count(*) AS rows, true AS aligned, count(*) - count(capped) AS capped_null,
  min(raw) AS original_min, max(raw) AS original_max, min(capped) AS capped_min, max(capped) AS capped_max,
  count(*) FILTER (WHERE raw IS DISTINCT FROM capped) AS changed_count, min(mm) AS minmax_min, max(mm) AS minmax_max,
  avg(z) AS zscore_mean, stddev_pop(z) AS zscore_std_population FROM stack""",
       "original_min original_max capped_min capped_max minmax_min minmax_max zscore_mean zscore_std_population")
def _(spark, folder):
    return v.alignment_audit(*_prepared_pair(spark, folder), "c_custkey", ["c_acctbal"])


@query("v9_scaling_quality", STACK + """SELECT 'c_acctbal' AS variable, min(mm) AS minmax_min, max(mm) AS minmax_max,
  avg(z) AS zscore_mean, stddev_pop(z) AS zscore_std_population FROM stack""", "minmax_min minmax_max zscore_mean zscore_std_population")
def _(spark, folder):
    return v.scaling_quality(_prepared_pair(spark, folder)[1], ["c_acctbal"])


A1_SQL = f"""WITH {fr.LINES}, long AS ({LONG}),
base AS (SELECT variable, count(value) AS count, count(*) - count(value) AS missing, avg(value) AS mean, min(value) AS min, max(value) AS max,
  max(value) - min(value) AS range, var_samp(value) AS variance_sample, stddev_samp(value) AS std_sample, stddev_samp(value) / avg(value) * 100 AS cv_percent,
  skewness(value) AS skewness, kurtosis(value) AS kurtosis_excess, {PCT_SQL} FROM long GROUP BY 1),
freq AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
top AS (SELECT variable, max(n) AS mode_frequency FROM freq GROUP BY 1),
ties AS (SELECT f.variable, count(*) AS tied, min(value) AS smallest_mode FROM freq f JOIN top t ON f.variable = t.variable AND f.n = t.mode_frequency AND f.n > 1 GROUP BY 1)
SELECT base.*, p25 AS q1, p50 AS median, p75 AS q3, p75 - p25 AS iqr, mode_frequency, smallest_mode,
  greatest(coalesce(tied, 0) - 10, 0) AS modes_not_shown FROM base JOIN top USING (variable) LEFT JOIN ties USING (variable)"""


@query("a1_descriptive_rows", A1_SQL, "mean min max range variance_sample std_sample cv_percent skewness kurtosis_excess q1 median q3 iqr smallest_mode " + " ".join(PCTS), special=BIG)
def descriptive_rows(spark, folder):
    return d.describe_with_modes(fr.lines(spark, folder), N4).drop("mode")


@query("a2_describe_with_outliers", FENCED + """SELECT variable, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std_sample, min(value) AS min, max(value) AS max,
  quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.05) AS p05, any_value(q1) AS p25, any_value(median) AS p50, any_value(q3) AS p75,
  quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99, any_value(iqr) AS iqr, any_value(lower_fence) AS lower_fence, any_value(upper_fence) AS upper_fence,
  count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) AS outlier_count, skewness(value) AS skewness FROM placed GROUP BY 1""",
       "mean std_sample min max p01 p05 p25 p50 p75 p95 p99 iqr lower_fence upper_fence skewness", special=BIG)
def _(spark, folder):
    return d.describe_with_outliers(fr.lines(spark, folder), N4).select(
        "variable", "count", "mean", "std_sample", "min", "max", "p01", "p05", "p25", "p50", "p75", "p95", "p99", "iqr", "lower_fence", "upper_fence", "outlier_count", "skewness")


@query("a3_iqr_fences", FENCED + "SELECT DISTINCT variable, q1, median, q3, iqr, lower_fence, upper_fence FROM placed", "q1 median q3 iqr lower_fence upper_fence")
def _(spark, folder):
    return o.iqr_fences(fr.lines(spark, folder), N4)


SELECTED = f"""WITH {fr.LINES}, long AS (SELECT l_returnflag, variable, value FROM ({fr.long_sql("li", N4, "l_returnflag")}))
SELECT {{keys}} variable, quantile_cont(value, 0.01) AS p01, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3, quantile_cont(value, 0.99) AS p99 FROM long GROUP BY ALL"""
SELECTED_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


def _selected(spark, folder, by=()):
    """Quantiles by bracketed selection, the way large groups are handled, whatever the table size."""
    wanted = exact_quantiles(fr.lines(spark, folder), N4, SELECTED_PROBS, by, small_rows=0)
    return wanted.select(*by, "variable", *[F.col("q")[i].alias(n) for i, n in enumerate(("p01", "q1", "median", "q3", "p99"))])


@query("a3_selected_quantiles", SELECTED.replace("{keys}", ""), "p01 q1 median q3 p99")
def _(spark, folder):
    return _selected(spark, folder)


@query("a3_selected_quantiles_by_group", SELECTED.replace("{keys}", "l_returnflag,"), "p01 q1 median q3 p99")
def _(spark, folder):
    return _selected(spark, folder, ["l_returnflag"])


@query("a4_outlier_summary", FENCED + """SELECT variable, q1, q3, lower_fence, upper_fence, count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) AS outlier_count,
  count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) / count(*)::DOUBLE AS outlier_share FROM placed GROUP BY ALL""", "q1 q3 lower_fence upper_fence outlier_share")
def _(spark, folder):
    return o.outlier_summary(fr.lines(spark, folder), N4)


def _state_sql(state: str, table: str) -> str:
    return f"""SELECT '{state}' AS state, variable, count(value) AS count, count(*) - count(value) AS missing, avg(value) AS mean, median(value) AS median,
  stddev_samp(value) AS std_sample, min(value) AS min, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, max(value) AS max, skewness(value) AS skewness,
  any_value(lo) AS lower_fence, any_value(hi) AS upper_fence, count(*) FILTER (WHERE value < lo OR value > hi) AS outlier_count
  FROM (SELECT 'c_acctbal' AS variable, {table} AS value, (SELECT quantile_cont({table}, 0.25) - 1.5 * (quantile_cont({table}, 0.75) - quantile_cont({table}, 0.25)) FROM stack) AS lo,
    (SELECT quantile_cont({table}, 0.75) + 1.5 * (quantile_cont({table}, 0.75) - quantile_cont({table}, 0.25)) FROM stack) AS hi FROM stack) GROUP BY variable"""


@query("a5_before_after", STACK + _state_sql("raw", "raw") + " UNION ALL " + _state_sql("clean", "capped"),
       "mean median std_sample min q1 q3 max skewness lower_fence upper_fence", special=BIG)
def _(spark, folder):
    _, prepared = _prepared_pair(spark, folder)
    return d.before_after({
        "raw": prepared.select(F.col("c_acctbal_original").alias("c_acctbal")), "clean": prepared.select(F.col("c_acctbal_capped").alias("c_acctbal")),
    }, ["c_acctbal"])


@query("a6_domain_dispersion", f"""WITH {fr.LINES}, long AS ({LONG}), logs AS (SELECT *, log10(greatest(value, 1e-9)) AS lg FROM long WHERE value IS NOT NULL)
SELECT variable, min(value) AS min, quantile_cont(value, 0.25) AS q1, median(value) AS median, quantile_cont(value, 0.75) AS q3, max(value) AS max,
  min(lg) AS log_min, quantile_cont(lg, 0.01) AS log_p01, quantile_cont(lg, 0.25) AS log_q1, median(lg) AS log_median, quantile_cont(lg, 0.75) AS log_q3,
  quantile_cont(lg, 0.99) AS log_p99, max(lg) AS log_max FROM logs GROUP BY 1""",
       "min q1 median q3 max log_min log_p01 log_q1 log_median log_q3 log_p99 log_max")
def _(spark, folder):
    return d.domain_dispersion(fr.lines(spark, folder), N4)


@query("a7_modes", f"""WITH {fr.LINES}, long AS ({LONG}), freq AS (SELECT variable, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY 1, 2),
top AS (SELECT variable, max(n) AS mode_frequency FROM freq GROUP BY 1),
ties AS (SELECT f.variable, value, row_number() OVER (PARTITION BY f.variable ORDER BY value) AS place, count(*) OVER (PARTITION BY f.variable) AS tied
  FROM freq f JOIN top t ON f.variable = t.variable AND n = mode_frequency AND n > 1)
SELECT t.variable, mode_frequency, sum(value) FILTER (WHERE place <= 10) AS shown_sum, min(value) AS smallest_mode, greatest(coalesce(max(tied), 0) - 10, 0) AS modes_not_shown
FROM top t LEFT JOIN ties USING (variable) GROUP BY 1, 2""", "shown_sum smallest_mode")
def _(spark, folder):
    table = d.modes(fr.lines(spark, folder), N4)
    total = F.aggregate(F.transform(F.split("mode", "; "), lambda t: t.cast("double")), F.lit(0.0), lambda a, b: a + b)
    return table.select("variable", "mode_frequency", total.alias("shown_sum"), "smallest_mode", "modes_not_shown")


@query("a8_smallest_mode", f"""WITH {fr.ORDERS}, f AS (SELECT y, priority AS mode, count(*) AS n FROM od GROUP BY 1, 2)
SELECT y, 'priority' AS variable, mode FROM f QUALIFY row_number() OVER (PARTITION BY y ORDER BY n DESC, mode) = 1""")
def _(spark, folder):
    return d.smallest_mode(fr.orders(spark, folder), ["priority"], ["y"])


def _freq_sql(columns: list[str]) -> str:
    return f"""WITH {fr.LINES}, long AS ({fr.long_sql("li", columns)}), rows AS (SELECT * FROM long WHERE value IS NOT NULL),
lim AS (SELECT variable, count(*) AS total, min(value) AS lo, max(value) AS hi, CAST(greatest(1, ceil(1 + 3.322 * log10(count(*)))) AS BIGINT) AS k FROM rows GROUP BY 1),
grid AS (SELECT variable, total, lo, hi, k, (hi - lo) / k AS width, unnest(range(1, k + 1)) AS class_number FROM lim),
edges AS (SELECT *, lo + (class_number - 1) * width AS lower_bound, CASE WHEN class_number = k THEN hi ELSE lo + class_number * width END AS upper_bound FROM grid),
cnt AS (SELECT e.variable, class_number, lower_bound, upper_bound, total,
  (SELECT count(*) FROM rows r WHERE r.variable = e.variable AND (r.value > e.lower_bound OR (e.class_number = 1 AND r.value >= e.lower_bound)) AND r.value <= e.upper_bound) AS frequency FROM edges e)
SELECT variable, class_number, lower_bound, upper_bound, (lower_bound + upper_bound) / 2 AS midpoint, frequency, 100.0 * frequency / total AS relative_frequency_percent,
  CAST(sum(frequency) OVER w AS BIGINT) AS cumulative_frequency, 100.0 * sum(frequency) OVER w / total AS cumulative_percent
FROM cnt WINDOW w AS (PARTITION BY variable ORDER BY class_number)"""


@query("a9_frequency_table", _freq_sql(N4), "lower_bound upper_bound midpoint relative_frequency_percent cumulative_percent")
def _(spark, folder):
    return fq.frequency_table(fr.lines(spark, folder), N4)


@query("a10_histogram", f"""WITH rows AS (SELECT c_acctbal AS value FROM customer), lim AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 28 AS width FROM rows),
grid AS (SELECT lo, hi, width, unnest(range(0, 28)) AS bin FROM lim)
SELECT 'c_acctbal' AS variable, bin, lo + bin * width AS left_edge, lo + (bin + 1) * width AS right_edge,
  (SELECT count(*) FROM rows WHERE value >= lo + bin * width AND (value < lo + (bin + 1) * width OR bin = 27)) AS count FROM grid""", "left_edge right_edge")
def _(spark, folder):
    return fq.histogram(read_table(spark, folder, "customer"), ["c_acctbal"], 28)


@query("a10_trimmed_histogram", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.99) AS b FROM lineitem),
rows AS (SELECT l_extendedprice AS value FROM lineitem, q WHERE l_extendedprice BETWEEN a AND b),
lim AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 34 AS width FROM rows), grid AS (SELECT lo, hi, width, unnest(range(0, 34)) AS bin FROM lim)
SELECT 'l_extendedprice' AS variable, bin, lo + bin * width AS left_edge, lo + (bin + 1) * width AS right_edge,
  (SELECT count(*) FROM rows WHERE value >= lo + bin * width AND (value < lo + (bin + 1) * width OR bin = 33)) AS count FROM grid""", "left_edge right_edge")
def _(spark, folder):
    return fq.histogram(read_table(spark, folder, "lineitem"), ["l_extendedprice"], 34, trim=(0.01, 0.99))


@query("a11_boxplot_by_group", f"""WITH {fr.ORDERS}, fences AS (SELECT priority, quantile_cont(o_totalprice, 0.25) AS q1, median(o_totalprice) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM od GROUP BY 1),
p AS (SELECT priority, o_totalprice AS value, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM od JOIN fences USING (priority) WHERE o_totalprice IS NOT NULL)
SELECT priority, 'o_totalprice' AS variable, q1, median, q3, min(value) FILTER (WHERE value BETWEEN lo AND hi) AS whisker_low, max(value) FILTER (WHERE value BETWEEN lo AND hi) AS whisker_high,
  count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS outlier_count FROM p GROUP BY 1, 3, 4, 5""", "q1 median q3 whisker_low whisker_high")
def _(spark, folder):
    return o.boxplot_stats(fr.orders(spark, folder), ["o_totalprice"], ["priority"])


@query("a12_group_profile", f"""WITH {fr.LINES} SELECT l_returnflag, count(*) AS size, avg(l_quantity) AS l_quantity_mean, avg(l_extendedprice) AS l_extendedprice_mean,
  100.0 * count(*) / sum(count(*)) OVER () AS percent, median(l_extendedprice) AS l_extendedprice_median, median(l_tax) AS l_tax_median FROM li GROUP BY 1""",
       "l_quantity_mean l_extendedprice_mean percent l_extendedprice_median l_tax_median")
def _(spark, folder):
    return d.group_profile(fr.lines(spark, folder), "l_returnflag", ["l_quantity", "l_extendedprice"], ["l_extendedprice", "l_tax"])


@query("a13_group_rates_and_tops", f"""WITH {fr.LINES}, f AS (SELECT l_returnflag, l_quantity, count(*) AS n FROM li GROUP BY 1, 2),
t AS (SELECT l_returnflag, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS top_l_quantity FROM f QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY n DESC, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)) = 1)
SELECT l_returnflag, count(*) AS size, avg(CASE WHEN l_linestatus = 'F' THEN 1.0 ELSE 0.0 END) * 100 AS l_linestatus_rate, any_value(top_l_quantity) AS top_l_quantity FROM li JOIN t USING (l_returnflag) GROUP BY 1""",
       "l_linestatus_rate")
def _(spark, folder):
    df = fr.lines(spark, folder).withColumn("l_quantity", F.col("l_quantity").cast("long").cast("string"))
    return d.group_rates_and_tops(df, "l_returnflag", {"l_linestatus": "F"}, ["l_quantity"])


@query("a14_response_rates", f"WITH {fr.ORDERS} SELECT priority, avg((y = 'yes')::INT) AS rate, CAST(sum((y = 'yes')::INT) AS BIGINT) AS positives, count(*) AS n FROM od GROUP BY 1", "rate")
def _(spark, folder):
    return d.response_rates(fr.orders(spark, folder), "priority", indicator("y", "yes"))


@query("a15_wilson_interval", f"""WITH {fr.ORDERS}, r AS (SELECT priority, avg((y = 'yes')::INT) AS rate, CAST(sum((y = 'yes')::INT) AS BIGINT) AS positives, count(*) AS n FROM od GROUP BY 1)
SELECT *, (rate + 3.8416 / (2 * n) - 1.96 * sqrt(rate * (1 - rate) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n) AS low,
  (rate + 3.8416 / (2 * n) + 1.96 * sqrt(rate * (1 - rate) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n) AS high FROM r""", "rate low high")
def _(spark, folder):
    return d.response_rates(fr.orders(spark, folder), "priority", indicator("y", "yes"), interval=True)


@query("a16_row_shares", f"WITH {fr.ORDERS} SELECT priority, avg((y = 'no')::INT) AS no, avg((y = 'yes')::INT) AS yes FROM od GROUP BY 1", "no yes")
def _(spark, folder):
    return d.row_shares(fr.orders(spark, folder), "priority", "y", ["no", "yes"])


@query("a17_value_counts", f"WITH {fr.ORDERS} SELECT priority, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM od GROUP BY 1", "share")
def _(spark, folder):
    return d.value_counts(fr.orders(spark, folder), "priority")


@query("a18_binned_response", """WITH e AS (SELECT unnest(range(1, 6)) AS bin, unnest([0.0, 10.0, 20.0, 30.0, 40.0]) AS left_edge, unnest([10.0, 20.0, 30.0, 40.0, 50.0]) AS right_edge)
SELECT bin, left_edge::DOUBLE AS left_edge, right_edge::DOUBLE AS right_edge, count(*) AS count, avg((l_returnflag = 'R')::INT) AS rate FROM lineitem JOIN e ON l_quantity > left_edge AND l_quantity <= right_edge GROUP BY 1, 2, 3""", "rate")
def _(spark, folder):
    return rel.binned_response(read_table(spark, folder, "lineitem"), "l_quantity", indicator("l_returnflag", "R"), [0, 10, 20, 30, 40, 50])


@query("a18_decile_response", """WITH q AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS e FROM orders),
b AS (SELECT unnest(range(1, len(e))) AS bin, e FROM q), r AS (SELECT bin, e[bin] AS left_edge, e[bin + 1] AS right_edge FROM b)
SELECT bin, left_edge, right_edge, count(*) AS count, avg((o_orderstatus = 'F')::INT) AS rate FROM orders JOIN r ON (o_totalprice > left_edge OR (bin = 1 AND o_totalprice = left_edge)) AND o_totalprice <= right_edge GROUP BY 1, 2, 3""",
       "left_edge right_edge rate")
def _(spark, folder):
    df = read_table(spark, folder, "orders")
    return rel.binned_response(df, "o_totalprice", indicator("o_orderstatus", "F"), rel.decile_edges(df, "o_totalprice"), include_lowest=True)


def _matrix_sql(source: str, columns: list[str], value) -> str:
    return source + " UNION ALL ".join(f"SELECT '{a}' AS row, '{b}' AS \"column\", {value(a, b)} AS correlation FROM src" for a in columns for b in columns)


@query("a19_pearson", _matrix_sql(f"WITH {fr.LINES}, src AS (SELECT * FROM li) ", N4, lambda a, b: f"corr({a}, {b})"), "correlation")
def _(spark, folder):
    return rel.pearson(fr.lines(spark, folder), N4)


@query("a20_spearman", _matrix_sql(f"""WITH {fr.LINES}, ok AS (SELECT * FROM li WHERE l_tax IS NOT NULL),
src AS (SELECT {", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in N4)} FROM ok) """, N4, lambda a, b: f"corr({a}, {b})"), "correlation")
def _(spark, folder):
    return rel.spearman(fr.lines(spark, folder), N4)


@query("a21_ols_lines", """SELECT 'l_quantity' AS predictor, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem
UNION ALL SELECT 'l_discount', regr_slope(l_extendedprice, l_discount), regr_intercept(l_extendedprice, l_discount) FROM lineitem""", "slope intercept", digits=4)
def _(spark, folder):
    return rel.ols_lines(read_table(spark, folder, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice")


@query("a22_ecdf", """SELECT o_orderstatus, 'o_totalprice' AS variable, value, sum(n) OVER (PARTITION BY o_orderstatus ORDER BY value) / sum(n) OVER (PARTITION BY o_orderstatus) AS cumulative_share
FROM (SELECT o_orderstatus, o_totalprice AS value, count(*) AS n FROM orders GROUP BY 1, 2)""", "value cumulative_share")
def _(spark, folder):
    return fq.ecdf(read_table(spark, folder, "orders"), ["o_totalprice"], ["o_orderstatus"])


@query("a22_trimmed_ecdf", """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS a, quantile_cont(l_extendedprice, 0.99) AS b FROM lineitem),
c AS (SELECT l_returnflag, l_extendedprice AS value, count(*) AS n FROM lineitem, q WHERE l_extendedprice BETWEEN a AND b GROUP BY 1, 2)
SELECT l_returnflag, 'l_extendedprice' AS variable, value, sum(n) OVER (PARTITION BY l_returnflag ORDER BY value) / sum(n) OVER (PARTITION BY l_returnflag) AS cumulative_share FROM c""", "value cumulative_share")
def _(spark, folder):
    return fq.trimmed_ecdf(read_table(spark, folder, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query("a23_kernel_density", """WITH s AS (SELECT count(*) AS n, min(c_acctbal) AS lo, max(c_acctbal) AS hi, power(count(*), -0.2) * stddev_samp(c_acctbal) AS h FROM customer),
g AS (SELECT unnest(range(0, 200)) AS step), p AS (SELECT step, lo + step * (hi - lo) / 199 AS x, h FROM g, s)
SELECT 'c_acctbal' AS variable, step, x, avg(exp(-0.5 * power((x - c_acctbal) / h, 2)) / (sqrt(2 * pi()) * h)) AS density FROM p, customer GROUP BY 2, 3""", "x density", special={"density": 12})
def _(spark, folder):
    return fq.kernel_density(read_table(spark, folder, "customer"), ["c_acctbal"])


@query("a24_hexbin", """WITH q AS (SELECT quantile_cont(l_quantity, 0.01) AS a, quantile_cont(l_quantity, 0.99) AS b, quantile_cont(l_extendedprice, 0.01) AS c, quantile_cont(l_extendedprice, 0.99) AS d FROM lineitem),
p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem, q WHERE l_quantity BETWEEN a AND b AND l_extendedprice BETWEEN c AND d),
b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p),
s AS (SELECT (x - x0) / ((x1 - x0) / 45) AS u, (y - y0) / ((y1 - y0) / 25) AS v FROM p, b),
h AS (SELECT floor(u + 0.5) AS i1, floor(v + 0.5) AS j1, floor(u) AS i2, floor(v) AS j2, u, v FROM s),
w AS (SELECT *, power(u - i1, 2) + 3 * power(v - j1, 2) < power(u - i2 - 0.5, 2) + 3 * power(v - j2 - 0.5, 2) AS corner FROM h)
SELECT CASE WHEN corner THEN 0 ELSE 1 END::BIGINT AS lattice, CASE WHEN corner THEN i1 ELSE i2 END::BIGINT AS i, CASE WHEN corner THEN j1 ELSE j2 END::BIGINT AS j, count(*) AS count FROM w GROUP BY 1, 2, 3""")
def _(spark, folder):
    return fq.hexbin(read_table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")


def _curve_sql(state: str, column: str) -> str:
    return f"SELECT '{state}' AS state, 'c_acctbal' AS variable, unnest(range(0, 101)) AS step, unnest((SELECT quantile_cont({column}, [x / 100.0 FOR x IN range(0, 101)]) FROM stack)) AS value"


PROBS = "[" + ", ".join(str(i / 100) for i in range(101)) + "]"


@query("a25_order_statistics", STACK + _curve_sql("raw", "raw").replace("[x / 100.0 FOR x IN range(0, 101)]", PROBS) + " UNION ALL " + _curve_sql("clean", "capped").replace("[x / 100.0 FOR x IN range(0, 101)]", PROBS), "value")
def _(spark, folder):
    _, prepared = _prepared_pair(spark, folder)
    return fq.order_statistics({
        "raw": prepared.select(F.col("c_acctbal_original").alias("c_acctbal")), "clean": prepared.select(F.col("c_acctbal_capped").alias("c_acctbal")),
    }, ["c_acctbal"])


@query("a29_profile_zscores", """WITH p AS (SELECT l_returnflag, avg(l_quantity) AS l_quantity_mean, ln(1 + avg(l_extendedprice)) AS l_extendedprice_mean FROM lineitem GROUP BY 1)
SELECT l_returnflag, (l_quantity_mean - avg(l_quantity_mean) OVER ()) / stddev_pop(l_quantity_mean) OVER () AS l_quantity_mean,
  (l_extendedprice_mean - avg(l_extendedprice_mean) OVER ()) / stddev_pop(l_extendedprice_mean) OVER () AS l_extendedprice_mean FROM p""", "l_quantity_mean l_extendedprice_mean")
def _(spark, folder):
    profile = d.group_profile(read_table(spark, folder, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"])
    return d.profile_zscores(profile, ["l_quantity_mean", "l_extendedprice_mean"], ["l_extendedprice_mean"]).select("l_returnflag", "l_quantity_mean", "l_extendedprice_mean")


LABELLED = f"""WITH {fr.LINES}, long AS ({LONG}), s AS (SELECT variable, skewness(value) AS skewness, stddev_samp(value) / avg(value) * 100 AS cv_percent FROM long GROUP BY 1) """


@query("f15_shape_label", LABELLED + """SELECT variable, CASE WHEN abs(skewness) < 0.5 THEN 'fairly symmetric' WHEN skewness >= 1 THEN 'strong right skew' WHEN skewness > 0 THEN 'moderate right skew'
  WHEN skewness <= -1 THEN 'strong left skew' ELSE 'moderate left skew' END AS shape FROM s""")
def _(spark, folder):
    return d.moments(fr.lines(spark, folder), N4).select("variable", shape_label("skewness").alias("shape"))


@query("f16_variability_label", LABELLED + "SELECT variable, CASE WHEN cv_percent < 15 THEN 'low' WHEN cv_percent < 30 THEN 'moderate' ELSE 'high' END AS variability FROM s")
def _(spark, folder):
    return d.moments(fr.lines(spark, folder), N4).select("variable", variability_label("cv_percent").alias("variability"))
