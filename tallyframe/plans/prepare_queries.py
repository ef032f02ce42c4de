"""Filters, scalar functions, joins, ranking, set operations, imputation, capping, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as sc
from ..functions.windows import running_sum
from ..operators import describe as d
from ..operators import outliers as o
from ..operators import panel as pn
from ..operators import prepare as p
from ..operators import sampling as sm
from ..operators import validate as v
from ..session import scratch_path
from ..sources import tables as tb
from ..sources.tables import read_table
from . import frames as fr
from .catalog import query
from .profile_queries import FENCED, N4, STACK

DOUBLED = "WITH twice AS (SELECT *, 0 AS copy FROM events UNION ALL SELECT event_id, ts, user_id, event_type, value + 1000, props, 1 FROM events WHERE event_type = 'click')"


def _doubled(spark, folder):
    """Events with a shifted second copy of every click."""
    events = read_table(spark, folder, "events")
    again = events.where("event_type = 'click'").withColumn("value", F.col("value") + 1000).withColumn("copy", F.lit(1))
    return events.withColumn("copy", F.lit(0)).unionByName(again)


# Round trips: each writes a whole table to the shared folder and reads it back -----------------------

ORDER_TEXT = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("day", T.DateType()), T.StructField("o_totalprice", T.DoubleType())])


@query("s1_delimited_scan", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer", "c_acctbal")
def _(spark, folder):
    """Customers through semicolon-delimited text with a header; types are inferred."""
    path = scratch_path(spark, "s1")
    tb.write_delimited(read_table(spark, folder, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"]), path, sep=";")
    return tb.read_delimited(spark, path, sep=";")


@query("s2_dated_scan", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01'", "o_totalprice")
def _(spark, folder):
    """Orders through comma-delimited text whose dates are parsed by the schema, filtered on the date."""
    path = scratch_path(spark, "s2")
    tb.write_delimited(read_table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"), path)
    return tb.read_delimited(spark, path, ORDER_TEXT).where("day >= '1998-01-01'")


@query("s5_delimited_sink", "SELECT o_orderstatus, count(*) AS rows, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day, sum(o_totalprice) AS total FROM orders GROUP BY 1", "total", digits=2)
def _(spark, folder):
    """Orders written with a date format, a folder a status, and read back by it."""
    path = scratch_path(spark, "s5")
    rows = read_table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice", "o_orderstatus")
    tb.write_delimited(rows, path, date_format="dd/MM/yyyy", partition_by=["o_orderstatus"])
    back = tb.read_delimited(spark, path, T.StructType([*ORDER_TEXT.fields, T.StructField("o_orderstatus", T.StringType())]), date_format="dd/MM/yyyy")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("o_totalprice").alias("total"))


@query("s7_run_record", """SELECT count(*) AS rows, ['l_quantity', 'l_extendedprice'] AS columns, [round(avg(l_quantity), 6), round(avg(l_extendedprice), 6)] AS means FROM lineitem""")
def _(spark, folder):
    """Row count and means of a scan as one JSON record, read back."""
    path, columns = scratch_path(spark, "s7"), ["l_quantity", "l_extendedprice"]
    figures = read_table(spark, folder, "lineitem").agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in columns]).first()
    tb.write_run_record(spark, {"rows": figures["rows"], "columns": columns, "means": [round(figures[c], 6) for c in columns]}, path)
    return tb.read_run_record(spark, path).select("rows", "columns", "means")


@query("v1_require_columns", "SELECT 'missing required columns: [''c_fax'', ''c_mail'']' AS verdict, count(*) AS rows FROM customer UNION ALL SELECT 'complete', count(*) FROM customer UNION ALL SELECT 'the input has no rows', count(*) FILTER (WHERE c_custkey < 0) FROM customer")
def _(spark, folder):
    """What the check says of a complete table, one without two columns and one without rows."""
    df = read_table(spark, folder, "customer")
    def verdict(rows, columns):
        try:
            v.require_columns(rows, columns)
        except ValueError as fault:
            return str(fault)
        return "complete"
    asked = [(df, ["c_custkey", "c_mail", "c_fax"]), (df, ["c_custkey"]), (df.where("c_custkey < 0"), ["c_custkey"])]
    parts = [rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(verdict(rows, columns)).alias("verdict"), "rows") for rows, columns in asked]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("f1_entity_series", DOUBLED + """SELECT event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, value FROM twice WHERE event_type = 'click'
QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY copy, event_id) = 1""", "value")
def _(spark, folder):
    df = _doubled(spark, folder).select("event_type", F.to_date("ts").alias("day"), "event_id", "value", "copy")
    return pn.entity_series(df, "event_type", "click", "day", ["copy", "event_id"]).drop("copy")


@query("f2_keep_last", DOUBLED + "SELECT event_id, event_type, value FROM twice QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY copy DESC) = 1", "value")
def _(spark, folder):
    return pn.last_per_key(_doubled(spark, folder).select("event_id", "event_type", "value", "copy"), ["event_id"], ["copy"]).drop("copy")


@query("f3_null_row_drop", f"WITH {fr.ORDERS} SELECT o_orderkey, o_totalprice FROM od WHERE o_totalprice IS NOT NULL", "o_totalprice")
def _(spark, folder):
    return fr.orders(spark, folder).na.drop(subset=["o_totalprice"]).select("o_orderkey", "o_totalprice")


@query("f4_positive_only", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_nationkey >= 0", "c_acctbal")
def _(spark, folder):
    return p.positive_only(read_table(spark, folder, "customer"), ["c_acctbal"], ["c_nationkey"]).select("c_custkey", "c_acctbal")


@query("f5_finite_scrub", "SELECT c_custkey, 1000.0 / c_nationkey AS ratio FROM customer WHERE c_nationkey <> 0", "ratio")
def _(spark, folder):
    df = read_table(spark, folder, "customer")
    infinite = F.when(F.col("c_nationkey") == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1000.0), F.col("c_nationkey")))
    return df.select("c_custkey", sc.finite(infinite).alias("ratio")).na.drop(subset=["ratio"])


@query("f6_log_family", """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END AS ln_value, ln(1 + abs(c_acctbal)) AS log1p_value,
  log10(greatest(c_acctbal, 1e-9)) AS log10_value, sign(c_acctbal) * ln(1 + abs(c_acctbal)) AS signed_value FROM customer""", "ln_value log1p_value log10_value signed_value")
def _(spark, folder):
    df = read_table(spark, folder, "customer")
    return df.select("c_custkey", F.ln("c_acctbal").alias("ln_value"), F.log1p(F.abs("c_acctbal")).alias("log1p_value"),
                     sc.log10_floored("c_acctbal").alias("log10_value"), sc.signed_log1p("c_acctbal").alias("signed_value"))


@query("f7_candle_features", f"""WITH {fr.BARS_SQL} SELECT "Name", CAST(date AS VARCHAR) AS date, (high - low) / open AS range_pct, (high - greatest(open, low)) / open AS upper_pct,
  (least(open, high) - low) / open AS lower_pct FROM bars""", "range_pct upper_pct lower_pct")
def _(spark, folder):
    return fr.bars(spark, folder).select("Name", "date", sc.intraday_range("open", "high", "low").alias("range_pct"),
                                         sc.upper_shadow("open", "high", "low").alias("upper_pct"), sc.lower_shadow("open", "high", "low").alias("lower_pct"))


@query("f8_calendar_cycle", """SELECT o_orderkey, sin(2 * pi() * month(o_orderdate) / 12) AS month_sin, cos(2 * pi() * month(o_orderdate) / 12) AS month_cos,
  sin(2 * pi() * (isodow(o_orderdate) - 1) / 5) AS dow_sin, cos(2 * pi() * (isodow(o_orderdate) - 1) / 5) AS dow_cos FROM orders""", "month_sin month_cos dow_sin dow_cos")
def _(spark, folder):
    return read_table(spark, folder, "orders").select("o_orderkey", *[c.alias(n) for n, c in sc.calendar_cycle(F.to_date("o_orderdate")).items()])


Q98 = "q AS (SELECT quantile_cont(o_totalprice, 0.01) AS a, quantile_cont(o_totalprice, 0.99) AS b FROM od)"


@query("f9_quantile_clip", f"WITH {fr.ORDERS}, {Q98} SELECT o_orderkey, CASE WHEN o_totalprice IS NOT NULL THEN least(greatest(o_totalprice, a), b) END AS o_totalprice FROM od, q", "o_totalprice")
def _(spark, folder):
    return p.quantile_clip(fr.orders(spark, folder), ["o_totalprice"]).select("o_orderkey", "o_totalprice")


@query("f10_quantile_trim", f"WITH {fr.ORDERS}, {Q98} SELECT o_orderkey, o_totalprice FROM od, q WHERE o_totalprice BETWEEN a AND b", "o_totalprice")
def _(spark, folder):
    return p.quantile_trim(fr.orders(spark, folder), ["o_totalprice"]).select("o_orderkey", "o_totalprice")


@query("f11_sentinel_to_null", f"WITH {fr.CUSTOMERS} SELECT c_custkey, nullif(c_mktsegment, 'unknown') AS c_mktsegment FROM cu")
def _(spark, folder):
    return fr.customers(spark, folder).select("c_custkey", sc.sentinel_to_null("c_mktsegment").alias("c_mktsegment"))


@query("f12_binary_indicator", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS BIGINT) AS is_final FROM orders")
def _(spark, folder):
    return read_table(spark, folder, "orders").select("o_orderkey", sc.indicator("o_orderstatus", "F").alias("is_final"))


@query("f13_unpivot", f"WITH {fr.BARS_SQL} " + fr.long_sql("bars", fr.BARS, 'bars."Name", CAST(date AS VARCHAR) AS date'), "value")
def _(spark, folder):
    return d.unpivoted(fr.bars(spark, folder), ["Name", "date"], fr.BARS)


@query("f14_pivot", """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1""")
def _(spark, folder):
    counts = read_table(spark, folder, "orders").groupBy("o_orderpriority", "o_orderstatus").count()
    return d.pivoted(counts, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], "count")


@query("f17_rounding", "SELECT l_returnflag, round(avg(l_extendedprice), 4) AS mean4, round(avg(l_discount), 6) AS mean6 FROM lineitem GROUP BY 1", "mean4 mean6")
def _(spark, folder):
    means = read_table(spark, folder, "lineitem").groupBy("l_returnflag").agg(F.avg("l_extendedprice").alias("mean4"), F.avg("l_discount").alias("mean6"))
    return p.rounded(means, {"mean4": 4, "mean6": 6})


@query("f19_calendar_parts", "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders")
def _(spark, folder):
    return read_table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query("f20_symmetric_clip", f"""WITH {fr.CUSTOMERS}, f AS (SELECT c_custkey, coalesce(c_acctbal, 0) AS v FROM cu), l AS (SELECT greatest(abs(quantile_cont(v, 0.005)), abs(quantile_cont(v, 0.995))) AS m FROM f)
SELECT c_custkey, least(greatest(v, -m), m) AS c_acctbal FROM f, l""", "c_acctbal")
def _(spark, folder):
    return p.symmetric_clip(fr.customers(spark, folder), "c_acctbal").select("c_custkey", "c_acctbal")


@query("j1_inner_join", """SELECT a.l_returnflag, size, price FROM (SELECT l_returnflag, count(*) AS size FROM lineitem GROUP BY 1) a
JOIN (SELECT l_returnflag, avg(l_extendedprice) AS price FROM lineitem GROUP BY 1) b ON a.l_returnflag = b.l_returnflag""", "price")
def _(spark, folder):
    df = read_table(spark, folder, "lineitem")
    sizes = df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("size"))
    return sizes.join(df.groupBy("l_returnflag").agg(F.avg("l_extendedprice").alias("price")), "l_returnflag")


@query("j2_left_join_profiles", """SELECT c_custkey, c_nationkey, n_name, r_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey > 4) n ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(spark, folder):
    nation = read_table(spark, folder, "nation").where("n_nationkey > 4").withColumnRenamed("n_nationkey", "c_nationkey")
    region = read_table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = read_table(spark, folder, "customer", ["c_custkey", "c_nationkey"]).join(nation, "c_nationkey", "left")
    return joined.join(region, "n_regionkey", "left").select("c_custkey", F.col("c_nationkey").cast("int"), "n_name", "r_name")


@query("j4_key_zip", STACK + "SELECT c_custkey, raw, capped, mm, z FROM stack", "raw capped mm z")
def _(spark, folder):
    base = fr.customers(spark, folder)
    variants = p.column_stack(base, "c_custkey", ["c_acctbal"])
    return base.join(variants, "c_custkey").select("c_custkey", F.col("c_acctbal").alias("raw"), F.col("c_acctbal_capped").alias("capped"),
                                                   F.col("c_acctbal_minmax").alias("mm"), F.col("c_acctbal_zscore").alias("z"))


@query("j7_aligned_counts", f"""WITH {fr.CUSTOMERS}, m AS (SELECT c_mktsegment AS s FROM cu WHERE c_mktsegment <> 'unknown' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
b AS (SELECT c_mktsegment, count(*) AS before FROM cu GROUP BY 1), a AS (SELECT CASE WHEN c_mktsegment = 'unknown' THEN s ELSE c_mktsegment END AS c_mktsegment, count(*) AS after FROM cu, m GROUP BY 1)
SELECT coalesce(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment, coalesce(before, 0) AS before, coalesce(after, 0) AS after FROM a FULL JOIN b ON a.c_mktsegment = b.c_mktsegment""")
def _(spark, folder):
    before = fr.customers(spark, folder)
    marked = before.withColumn("c_mktsegment", sc.sentinel_to_null("c_mktsegment"))
    return d.aligned_counts(before, p.ModeImputer(["c_mktsegment"]).fit(marked).transform(marked), "c_mktsegment")


@query("k1_sorted_panel", f"""WITH {fr.targeted_sql(fr.BARS_SQL)} SELECT CAST(target_date AS VARCHAR) AS target_date, "Name", close FROM targeted WHERE target_date IS NOT NULL""", "close")
def _(spark, folder):
    return pn.next_day_target(fr.bars(spark, folder)).where("target_date is not null").select("target_date", "Name", "close").orderBy("target_date", "Name")


ORDER_FENCED = f"""WITH {fr.ORDERS}, od2 AS (SELECT o_orderkey, priority, y, ln(o_totalprice) AS v FROM od WHERE o_totalprice > 0),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM od2),
x AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM od2, q)"""


def _logged_orders(spark, folder):
    return fr.orders(spark, folder).withColumn("v", F.ln("o_totalprice"))


@query("k2_top_outliers", ORDER_FENCED + """, t AS (SELECT *, CASE WHEN v > upper_fence THEN v - upper_fence ELSE lower_fence - v END AS distance_to_bound FROM x WHERE v < lower_fence OR v > upper_fence)
SELECT 'v' AS variable, row_number() OVER (ORDER BY distance_to_bound DESC, o_orderkey) AS place, o_orderkey, v AS value, lower_fence, upper_fence, distance_to_bound FROM t
QUALIFY place <= 10""", "value lower_fence upper_fence distance_to_bound")
def _(spark, folder):
    return o.top_outliers(_logged_orders(spark, folder), ["v"], ["o_orderkey"])


@query("k3_extreme_outliers", ORDER_FENCED + """, t AS (SELECT *, CASE WHEN v < lower_fence THEN 'low' ELSE 'high' END AS direction FROM x WHERE v < lower_fence OR v > upper_fence)
SELECT 'v' AS variable, direction, row_number() OVER (PARTITION BY direction ORDER BY CASE WHEN direction = 'low' THEN v ELSE -v END, o_orderkey) AS place, o_orderkey, priority, y, v AS value, lower_fence, upper_fence FROM t
QUALIFY place <= 5""", "value lower_fence upper_fence")
def _(spark, folder):
    return o.extreme_outliers(_logged_orders(spark, folder), ["v"], ["o_orderkey"], ["priority", "y"])


@query("k6_best_row", "SELECT o_orderpriority, avg(o_totalprice) AS mean FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1", "mean")
def _(spark, folder):
    means = read_table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("mean"))
    return sm.best_rows(means, [F.desc("mean"), "o_orderpriority"])


DIGEST = "md5(o_orderkey || '|42'), o_orderkey"
ORDER_OUT = "o_orderkey, o_custkey, o_totalprice, priority, o_orderstatus, y, CAST(day AS VARCHAR) AS day"


@query("k7_group_sample", f"WITH {fr.ORDERS} SELECT {ORDER_OUT} FROM od QUALIFY row_number() OVER (PARTITION BY y ORDER BY {DIGEST}) <= 5000", "o_totalprice")
def _(spark, folder):
    return sm.group_sample(fr.orders(spark, folder), "y", ["o_orderkey"], 5000)


@query("k7_binned_sample", f"""WITH {fr.ORDERS}, p AS (SELECT *, row_number() OVER (ORDER BY o_totalprice, {DIGEST}) AS place, count(*) OVER () AS n FROM od WHERE o_totalprice IS NOT NULL),
b AS (SELECT *, CAST(ceil(place * 20 / n::DOUBLE) AS BIGINT) AS bin FROM p) SELECT {ORDER_OUT}, bin FROM b QUALIFY row_number() OVER (PARTITION BY bin ORDER BY {DIGEST}) <= 125""", "o_totalprice")
def _(spark, folder):
    return sm.binned_sample(fr.orders(spark, folder).where("o_totalprice is not null"), "o_totalprice", ["o_orderkey"])


@query("k8_uniform_sample", f"WITH {fr.ORDERS} SELECT {ORDER_OUT} FROM od ORDER BY {DIGEST} LIMIT 1000", "o_totalprice")
def _(spark, folder):
    return sm.uniform_sample(fr.orders(spark, folder), ["o_orderkey"], 1000)


@query("u1_union_all", "SELECT 'customer' AS origin, c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier", "balance")
def _(spark, folder):
    left = read_table(spark, folder, "customer").select(F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return left.unionByName(read_table(spark, folder, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")))


@query("u2_key_union", """SELECT coalesce(a.k, b.k) AS c_nationkey, coalesce(before, 0) AS before, coalesce(after, 0) AS after FROM (SELECT CAST(c_nationkey AS BIGINT) AS k, count(*) AS before FROM customer GROUP BY 1) a
FULL JOIN (SELECT CAST(s_nationkey AS BIGINT) AS k, count(*) AS after FROM supplier GROUP BY 1) b ON a.k = b.k""")
def _(spark, folder):
    suppliers = read_table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "c_nationkey")
    return d.aligned_counts(read_table(spark, folder, "customer"), suppliers, "c_nationkey")


@query("c1_median_impute", f"WITH {fr.LINES} SELECT l_returnflag, coalesce(l_tax, (SELECT median(l_tax) FROM li)) AS l_tax, count(*) AS n FROM li GROUP BY 1, 2", "l_tax")
def _(spark, folder):
    df = fr.lines(spark, folder)
    return p.MedianImputer(["l_tax"]).fit(df).transform(df).groupBy("l_returnflag", "l_tax").agg(F.count(F.lit(1)).alias("n"))


@query("c2_mode_impute", f"""WITH {fr.CUSTOMERS}, m AS (SELECT c_mktsegment AS s FROM cu WHERE c_mktsegment <> 'unknown' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT c_custkey, CASE WHEN c_mktsegment = 'unknown' THEN s ELSE c_mktsegment END AS c_mktsegment FROM cu, m""")
def _(spark, folder):
    df = fr.customers(spark, folder).withColumn("c_mktsegment", sc.sentinel_to_null("c_mktsegment"))
    return p.ModeImputer(["c_mktsegment"]).fit(df).transform(df).select("c_custkey", "c_mktsegment")


@query("c3_iqr_cap", STACK + "SELECT c_custkey, capped AS c_acctbal FROM stack", "c_acctbal")
def _(spark, folder):
    df = fr.customers(spark, folder)
    filled = p.MedianImputer(["c_acctbal"]).fit(df).transform(df)
    return p.IqrCapper(["c_acctbal"]).fit(df).transform(filled).select("c_custkey", "c_acctbal")


@query("c3_cap_counts", FENCED + """SELECT variable, lower_fence, upper_fence, count(*) FILTER (WHERE value < lower_fence) AS capped_low, count(*) FILTER (WHERE value > upper_fence) AS capped_high,
  count(*) FILTER (WHERE value < lower_fence OR value > upper_fence) AS capped_count FROM placed GROUP BY 1, 2, 3""", "lower_fence upper_fence")
def _(spark, folder):
    df = fr.lines(spark, folder)
    return p.IqrCapper(N4).fit(df).counts(df)


@query("c4_minmax", "SELECT o_orderkey, (o_totalprice - min(o_totalprice) OVER ()) / (max(o_totalprice) OVER () - min(o_totalprice) OVER ()) AS scaled, CAST(0 AS DOUBLE) AS flat FROM orders", "scaled flat")
def _(spark, folder):
    df = read_table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("scaled"), F.lit(7.0).alias("flat"))
    return p.MinMaxScaler(["scaled", "flat"], suffix="").fit(df).transform(df)


@query("c5_zscore", "SELECT o_orderkey, (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER () AS scaled, CAST(0 AS DOUBLE) AS flat FROM orders", "scaled flat")
def _(spark, folder):
    df = read_table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("scaled"), F.lit(7.0).alias("flat"))
    return p.ZScaler(["scaled", "flat"], suffix="").fit(df).transform(df)


@query("c6_drop_null_target", f"WITH {fr.ORDERS} SELECT o_orderkey, y FROM od WHERE o_totalprice IS NOT NULL")
def _(spark, folder):
    return fr.orders(spark, folder).na.drop(subset=["o_totalprice"]).select("o_orderkey", "y")


@query("c7_column_stack", STACK + "SELECT c_custkey, raw AS c_acctbal_raw, imputed AS c_acctbal_imputed, capped AS c_acctbal_capped, mm AS c_acctbal_minmax, z AS c_acctbal_zscore FROM stack",
       "c_acctbal_raw c_acctbal_imputed c_acctbal_capped c_acctbal_minmax c_acctbal_zscore")
def _(spark, folder):
    return p.column_stack(fr.customers(spark, folder), "c_custkey", ["c_acctbal"])


@query("w11_cumulative", """SELECT o_orderpriority, n, CAST(sum(n) OVER (ORDER BY o_orderpriority) AS BIGINT) AS cumulative, sum(n) OVER (ORDER BY o_orderpriority) / sum(n) OVER () AS share
FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""", "share")
def _(spark, folder):
    from pyspark.sql import Window
    table = d.value_counts(read_table(spark, folder, "orders"), "o_orderpriority").select("o_orderpriority", F.col("count").alias("n"))
    running = running_sum("n", Window.orderBy("o_orderpriority"))
    return table.select("o_orderpriority", "n", running.alias("cumulative"), (running / table.agg(F.sum("n")).scalar()).alias("share"))
