"""Daily panels: calendar gaps, window features, splits, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import windows as win
from ..operators import panel as pn
from ..operators import sampling as sm
from ..operators import splits as sp
from ..operators import validate as v
from ..operators.describe import raw_filled_log
from ..operators.relate import grouped_pearson
from ..sources.tables import read_table
from . import frames as fr
from .catalog import query

KEY = '"Name", CAST(date AS VARCHAR) AS date'
GRID = 'grid AS (SELECT n."Name", d.date FROM (SELECT DISTINCT "Name" FROM bars) n CROSS JOIN (SELECT DISTINCT date FROM bars) d)'
BY = '(PARTITION BY "Name" ORDER BY date)'


def by_day():
    return win.per_entity("Name", "date")


def series(name: str, expression: str, doubles: str, source=None, sql: str = fr.STATUS_BARS_SQL, digits: int = 6):
    """A per-entity window query: one output column per expression."""
    def register(fn):
        def run(spark, folder):
            df = (source or fr.status_bars)(spark, folder)
            return df.select("Name", "date", *[c.alias(n) for n, c in fn(by_day()).items()])

        return query(name, f"WITH {sql} SELECT {KEY}, {expression} FROM bars", doubles, digits)(run)

    return register


@query("v10_missing_timestamps", f'WITH {fr.BARS_SQL}, {GRID} SELECT "Name", CAST(date AS VARCHAR) AS date FROM grid ANTI JOIN bars USING ("Name", date)')
def missing(spark, folder):
    return pn.missing_timestamps(fr.bars(spark, folder))


@query("v10_missing_within_lifetime", f"""WITH {fr.BARS_SQL}, {GRID}, life AS (SELECT "Name", min(date) AS a, max(date) AS b FROM bars GROUP BY 1)
SELECT "Name", CAST(date AS VARCHAR) AS date FROM grid ANTI JOIN bars USING ("Name", date) JOIN life USING ("Name") WHERE date BETWEEN a AND b""")
def _(spark, folder):
    return pn.missing_timestamps(fr.bars(spark, folder), within_lifetime=True)


@query("v10_panel_size", f'WITH {fr.BARS_SQL}, {GRID} SELECT (SELECT count(*) FROM grid) - count(*) AS missing_timestamps, (SELECT count(*) FROM grid) AS full_panel_rows, count(*) AS raw_rows FROM bars')
def _(spark, folder):
    return pn.panel_size(fr.bars(spark, folder))


@query("v12_first_row_with_null", f"""WITH {fr.GAPPY_SQL} SELECT "Name", CAST(date AS VARCHAR) AS date, CASE WHEN high IS NULL THEN 'high' ELSE 'volume' END AS null_column FROM bars
WHERE high IS NULL OR volume IS NULL ORDER BY "Name", bars.date LIMIT 1""")
def _(spark, folder):
    return v.first_row_with_null(fr.gappy_bars(spark, folder), fr.BARS, "Name", "date")


@query("v12_most_gapped_entity", f"""WITH {fr.BARS_SQL}, {GRID} SELECT "Name", count(*) AS missing FROM grid ANTI JOIN bars USING ("Name", date) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def _(spark, folder):
    return pn.most_gapped_entity(fr.bars(spark, folder))


@query("j3_complete_panel", f'WITH {fr.BARS_SQL}, {GRID} SELECT "Name", CAST(date AS VARCHAR) AS date, open, high, low, close, volume FROM grid LEFT JOIN bars USING ("Name", date)', "open high low close")
def _(spark, folder):
    return pn.complete_panel(fr.bars(spark, folder))


@query("j6_anti_join", "SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey")
def _(spark, folder):
    return read_table(spark, folder, "customer", ["c_custkey"]).join(read_table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("u3_set_difference", 'SELECT CAST(o_orderdate AS DATE)::VARCHAR AS day FROM orders EXCEPT SELECT CAST(l_shipdate AS DATE)::VARCHAR FROM lineitem')
def _(spark, folder):
    ordered = read_table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return ordered.join(read_table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("day")), "day", "left_anti")


@series("w1_next_day_target", f"lead(close) OVER {BY} AS target_close_next, CAST(lead(date) OVER {BY} AS VARCHAR) AS target_date", "target_close_next", fr.bars, fr.BARS_SQL)
def _(w):
    return {"target_close_next": win.lead_one("close", w), "target_date": win.lead_one("date", w)}


@series("w2_lag", f"lag(close) OVER {BY} AS close_lag1, lag(volume) OVER {BY} AS volume_lag1", "close_lag1")
def _(w):
    return {"close_lag1": win.lag_one("close", w), "volume_lag1": win.lag_one("volume", w)}


@series("w3_log_change", f"ln(close) - lag(ln(close)) OVER {BY} AS log_return, 100 * (ln(close) - lag(ln(close)) OVER {BY}) AS log_return_pct", "log_return log_return_pct")
def _(w):
    return {"log_return": win.log_change("close", w), "log_return_pct": win.log_change("close", w, 100.0)}


@series("w4_percent_change", f"close / lag(close) OVER {BY} - 1 AS pct", "pct")
def _(w):
    return {"pct": win.percent_change("close", w)}


def _rolling(fn: str, size: int, least: int) -> str:
    frame = f'(PARTITION BY "Name" ORDER BY date ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)'
    return f"CASE WHEN count(close) OVER {frame} >= {least} THEN {fn}(close) OVER {frame} END"


@series("w5_rolling_mean", f"{_rolling('avg', 20, 5)} AS ma20, {_rolling('avg', 60, 15)} AS ma60", "ma20 ma60", digits=4)
def _(w):
    return {"ma20": win.rolling_mean("close", w), "ma60": win.rolling_mean("close", w, 60, 15)}


@series("w6_rolling_std", f"{_rolling('stddev_samp', 20, 5)} AS sd20, {_rolling('stddev_samp', 20, 20)} * sqrt(252) * 100 AS annualised", "sd20 annualised", digits=2)
def _(w):
    return {"sd20": win.rolling_std("close", w), "annualised": win.rolling_std("close", w, 20, 20) * F.sqrt(F.lit(252.0)) * 100}


CENTRED = '(PARTITION BY "Name" ORDER BY date ROWS BETWEEN 126 PRECEDING AND 125 FOLLOWING)'
DEVIATION = f"CASE WHEN count(close) OVER {CENTRED} >= 60 THEN (exp(ln(close) - avg(ln(close)) OVER {CENTRED}) - 1) * 100 END"


@series("w7_detrended", f"{DEVIATION} AS deviation", "deviation")
def _(w):
    return {"deviation": win.detrended_percent("close", w)}


FULL = f"""{fr.GAPPY_SQL}, {GRID},
panel AS (SELECT "Name", date, open, high, low, close, volume::DOUBLE AS volume, row_number() OVER (PARTITION BY "Name" ORDER BY date) AS pos FROM grid LEFT JOIN bars USING ("Name", date))"""


def _fill_sql(c: str) -> str:
    before, after = 'OVER (PARTITION BY "Name" ORDER BY date ROWS UNBOUNDED PRECEDING)', 'OVER (PARTITION BY "Name" ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)'
    a, b = f"last_value({c} IGNORE NULLS) {before}", f"first_value({c} IGNORE NULLS) {after}"
    i, j = f"last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) {before}", f"first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) {after}"
    return f"coalesce({c}, {a} + ({b} - {a}) * (pos - {i}) / ({j} - {i})::DOUBLE, {a}, {b}) AS {c}_filled"


FILLED = FULL + ", filled AS (SELECT *, open IS NULL AND high IS NULL AND low IS NULL AND close IS NULL AND volume IS NULL AS was_missing_timestamp, " + ", ".join(_fill_sql(c) for c in fr.BARS) + " FROM panel)"


def _filled(spark, folder):
    return pn.fill_panel(pn.complete_panel(fr.gappy_bars(spark, folder)))


@query("w8_interpolated_panel", f"WITH {FILLED} SELECT {KEY}, " + ", ".join(f"{c}_filled" for c in fr.BARS) + " FROM filled", " ".join(f"{c}_filled" for c in fr.BARS))
def _(spark, folder):
    return _filled(spark, folder).select("Name", "date", *[f"{c}_filled" for c in fr.BARS])


@query("w9_edge_fills", f"""WITH {FULL} SELECT {KEY}, last_value(close IGNORE NULLS) OVER (PARTITION BY "Name" ORDER BY panel.date ROWS UNBOUNDED PRECEDING) AS forward,
  first_value(close IGNORE NULLS) OVER (PARTITION BY "Name" ORDER BY panel.date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward FROM panel""", "forward backward")
def _(spark, folder):
    panel = pn.complete_panel(fr.gappy_bars(spark, folder))
    return panel.select("Name", "date", win.forward_fill("close", by_day()).alias("forward"), win.back_fill("close", win.per_entity_backward("Name", "date")).alias("backward"))


@query("w10_gap_flag", f"WITH {FILLED} SELECT {KEY}, was_missing_timestamp FROM filled")
def _(spark, folder):
    return _filled(spark, folder).select("Name", "date", "was_missing_timestamp")


FEATURES = FILLED + """, logged AS (SELECT *, ln(open_filled) AS log_open, ln(close_filled) AS log_close, ln(1 + volume_filled) AS log_volume FROM filled
  WHERE open_filled > 0 AND high_filled > 0 AND low_filled > 0 AND close_filled > 0 AND volume_filled >= 0),
changed AS (SELECT *, log_close - lag(log_close) OVER w AS log_return_close, lag(close_filled) OVER w AS close_lag1 FROM logged WINDOW w AS (PARTITION BY "Name" ORDER BY date)),
feats AS (SELECT *, CASE WHEN count(close_filled) OVER f >= 5 THEN avg(close_filled) OVER f END AS rolling_close_mean_20,
  CASE WHEN count(log_return_close) OVER f >= 5 THEN stddev_samp(log_return_close) OVER f END AS rolling_volatility_20,
  CASE WHEN count(volume_filled) OVER f >= 5 THEN avg(volume_filled) OVER f END AS rolling_volume_mean_20
  FROM changed WINDOW f AS (PARTITION BY "Name" ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""
FEATURE_OUT = ["log_open", "log_close", "log_volume", "log_return_close", "close_lag1", "rolling_close_mean_20", "rolling_volatility_20", "rolling_volume_mean_20"]


@query("flow_gap_filled_features", f"WITH {FEATURES} SELECT {KEY}, was_missing_timestamp, {', '.join(FEATURE_OUT)} FROM feats", " ".join(FEATURE_OUT), digits=9)
def gap_filled_features(spark, folder):
    return pn.panel_features(_filled(spark, folder)).select("Name", "date", "was_missing_timestamp", *FEATURE_OUT)


@query("a5_raw_filled_log", f"""WITH {FEATURES} SELECT 'close' AS variable, (SELECT count(close) FROM bars) AS raw_count, (SELECT count(*) - count(close) FROM bars) AS raw_missing, (SELECT avg(close) FROM bars) AS raw_mean,
  (SELECT stddev_samp(close) FROM bars) AS raw_std, (SELECT skewness(close) FROM bars) AS raw_skew, count(close_filled) AS filled_count, count(*) - count(close_filled) AS filled_missing,
  avg(close_filled) AS filled_mean, stddev_samp(close_filled) AS filled_std, stddev_samp(log_close) AS log_std, skewness(log_close) AS log_skew FROM feats""",
       "raw_mean raw_std raw_skew filled_mean filled_std log_std log_skew")
def _(spark, folder):
    raw = fr.gappy_bars(spark, folder)
    features = pn.panel_features(pn.fill_panel(pn.complete_panel(raw)))
    return raw_filled_log(raw, features.select(F.col("close_filled").alias("close")), features.select(F.col("log_close").alias("close")), ["close"])


@query("f18_context_slice", f"""WITH {FILLED}, raw AS (SELECT * FROM panel), gaps AS (SELECT "Name", min(CASE WHEN high IS NULL THEN date END) AS gap FROM raw GROUP BY 1),
r AS (SELECT raw.*, gap, row_number() OVER (PARTITION BY "Name" ORDER BY date DESC) AS from_end FROM raw JOIN gaps USING ("Name"))
SELECT r."Name", CAST(r.date AS VARCHAR) AS date, r.high AS raw, f.high_filled AS filled FROM r LEFT JOIN filled f ON r."Name" = f."Name" AND r.date = f.date
WHERE CASE WHEN gap IS NOT NULL THEN r.date BETWEEN gap - INTERVAL 25 DAY AND gap + INTERVAL 25 DAY ELSE from_end <= 80 END""", "raw filled")
def _(spark, folder):
    panel = pn.complete_panel(fr.gappy_bars(spark, folder))
    filled = pn.fill_panel(panel).select("Name", "date", F.col("high_filled").alias("high"))
    return pn.context_slice(panel, filled, "high")


@query("w12_value_bins", f"""WITH {fr.targeted_sql(fr.BARS_SQL)}, r AS (SELECT * FROM targeted WHERE target_close_next IS NOT NULL),
p AS (SELECT *, row_number() OVER (ORDER BY target_close_next, md5("Name" || '|' || CAST(date AS VARCHAR) || '|42'), "Name", date) AS place, count(*) OVER () AS n FROM r)
SELECT {KEY}, CAST(ceil(place * 20 / n::DOUBLE) AS BIGINT) AS bin FROM p""")
def _(spark, folder):
    targeted = pn.next_day_target(fr.bars(spark, folder)).na.drop(subset=["target_close_next"])
    return sm.value_bins(targeted, "target_close_next", ["Name", "date"]).select("Name", "date", "bin")


@query("a26_series_correlation", f"WITH {fr.STATUS_BARS_SQL} " + " UNION ALL ".join(f"""SELECT "Name", '{a}' AS row, '{b}' AS "column", corr({a}, {b}) AS correlation FROM bars GROUP BY 1""" for a in fr.BARS for b in fr.BARS), "correlation")
def _(spark, folder):
    """The five-by-five correlation block of every series."""
    return grouped_pearson(fr.status_bars(spark, folder), fr.BARS, ["Name"])


@query("a26_series_snapshot", f"""WITH {fr.STATUS_BARS_SQL}, r AS (SELECT *, close / lag(close) OVER {BY} - 1 AS ret FROM bars)
SELECT "Name", count(*) AS rows, CAST(min(date) AS VARCHAR) AS date_min, CAST(max(date) AS VARCHAR) AS date_max, arg_min(close, date) AS close_start, arg_max(close, date) AS close_end,
  avg(close) AS close_mean, stddev_samp(close) AS close_std, avg(volume) AS volume_mean, max(volume) AS volume_max,
  CAST(first(date ORDER BY volume DESC, date) AS VARCHAR) AS volume_max_date, max(ret) * 100 AS max_daily_return_pct, CAST(first(date ORDER BY ret DESC NULLS LAST, date) AS VARCHAR) AS max_daily_return_date,
  min(ret) * 100 AS min_daily_return_pct, CAST(first(date ORDER BY ret ASC NULLS LAST, date) AS VARCHAR) AS min_daily_return_date, corr(close, volume) AS close_volume_corr,
  (arg_max(close, date) / arg_min(close, date) - 1) * 100 AS close_total_change_pct, median(close) AS close_median, median(volume) AS volume_median FROM r GROUP BY 1""",
       "close_start close_end close_mean close_std volume_mean max_daily_return_pct min_daily_return_pct close_volume_corr close_total_change_pct close_median volume_median", digits=4)
def _(spark, folder):
    return pn.series_snapshot(fr.status_bars(spark, folder))


ROLL20 = '(PARTITION BY "Name" ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)'


@query("a27_volatility_extremes", f"""WITH {fr.STATUS_BARS_SQL}, r AS (SELECT *, ln(close) - lag(ln(close)) OVER {BY} AS ch FROM bars),
s AS (SELECT *, CASE WHEN count(ch) OVER {ROLL20} >= 20 THEN stddev_samp(ch) OVER {ROLL20} END * sqrt(252) * 100 AS vol FROM r)
SELECT "Name", max(vol) AS max_rolling_volatility_percent, CAST(first(date ORDER BY vol DESC NULLS LAST, date) AS VARCHAR) AS max_rolling_volatility_date,
  stddev_samp(ch * 100) AS daily_log_return_std_percent, max(ch * 100) AS max_daily_log_return_percent, CAST(first(date ORDER BY ch DESC NULLS LAST, date) AS VARCHAR) AS max_daily_log_return_date,
  min(ch * 100) AS min_daily_log_return_percent, CAST(first(date ORDER BY ch ASC NULLS LAST, date) AS VARCHAR) AS min_daily_log_return_date FROM s GROUP BY 1""",
       "max_rolling_volatility_percent daily_log_return_std_percent max_daily_log_return_percent min_daily_log_return_percent", digits=5)
def _(spark, folder):
    return pn.volatility_extremes(fr.status_bars(spark, folder))


@query("a28_seasonality", f"""WITH {fr.STATUS_BARS_SQL}, dv AS (SELECT "Name", month(date) AS month, {DEVIATION} AS d FROM bars), m AS (SELECT "Name", month, avg(d) AS d FROM dv GROUP BY 1, 2)
SELECT "Name", 'close' AS variable, first(month ORDER BY d DESC, month) AS highest_month, max(d) AS highest_percent, first(month ORDER BY d, month) AS lowest_month, min(d) AS lowest_percent, max(d) - min(d) AS amplitude_percent
FROM m GROUP BY 1""", "highest_percent lowest_percent amplitude_percent")
def _(spark, folder):
    return pn.seasonality(fr.status_bars(spark, folder), ["close"])


SESSION_OUT = pn.SESSION_FEATURES


@query("flow_session_features", f"""WITH {fr.BARS_SQL} SELECT {KEY}, ln(open) AS log_open, ln(high) AS log_high, ln(low) AS log_low, ln(1 + volume) AS log_volume, (high - low) / open AS intraday_range_pct,
  (high - greatest(open, low)) / open AS upper_shadow_pct, (least(open, high) - low) / open AS lower_shadow_pct, sin(2 * pi() * month(bars.date) / 12) AS month_sin, cos(2 * pi() * month(bars.date) / 12) AS month_cos,
  sin(2 * pi() * (isodow(bars.date) - 1) / 5) AS dow_sin, cos(2 * pi() * (isodow(bars.date) - 1) / 5) AS dow_cos FROM bars WHERE open > 0 AND high > 0 AND low > 0 AND volume > 0""", " ".join(SESSION_OUT))
def _(spark, folder):
    return pn.session_features(fr.bars(spark, folder)).select("Name", "date", *SESSION_OUT)


# Splits and folds -------------------------------------------------------------------------------

def _targeted(spark, folder):
    return pn.next_day_target(fr.bars(spark, folder))


def _labelled(spark, folder):
    ready = _targeted(spark, folder).na.drop(subset=["target_close_next", "target_date"])
    return sp.label_folds(sp.time_split(ready, fr.CUTOFF), 5)


TARGETED = fr.targeted_sql(fr.BARS_SQL)
SPLIT = f"""{TARGETED}, ready AS (SELECT *, CASE WHEN target_date < DATE '{fr.CUTOFF}' THEN 'train' ELSE 'test' END AS split FROM targeted WHERE target_close_next IS NOT NULL),
days AS (SELECT target_date, row_number() OVER (ORDER BY target_date) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT target_date FROM ready WHERE split = 'train')),
folds AS (SELECT target_date, CASE WHEN pos < n - 5 * (n // 6) THEN 0 ELSE (pos - (n - 5 * (n // 6))) // (n // 6) + 1 END AS fold FROM days)"""


@query("x3_time_split", f"""WITH {SPLIT} SELECT split, count(*) AS rows, CAST(min(target_date) AS VARCHAR) AS first_day, CAST(max(target_date) AS VARCHAR) AS last_day FROM ready GROUP BY 1""")
def _(spark, folder):
    ready = _targeted(spark, folder).na.drop(subset=["target_close_next"])
    return sp.time_split(ready, fr.CUTOFF).groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("target_date").alias("first_day"), F.max("target_date").alias("last_day"))


@query("x4_fold_calendar", f"WITH {SPLIT} SELECT CAST(target_date AS VARCHAR) AS target_date, pos AS position, fold AS cv_fold FROM days JOIN folds USING (target_date)")
def _(spark, folder):
    ready = _targeted(spark, folder).na.drop(subset=["target_close_next"])
    return sp.fold_calendar(sp.time_split(ready, fr.CUTOFF).where("split = 'train'"), 5)


@query("x5_fold_labels", f"""WITH {SPLIT} SELECT {KEY.replace('date AS', 'ready.date AS')}, split, CASE WHEN split = 'test' THEN -1 ELSE fold END AS cv_fold FROM ready LEFT JOIN folds USING (target_date)""")
def _(spark, folder):
    return _labelled(spark, folder).select("Name", "date", "split", "cv_fold")


@query("x5_fold_summary", f"""WITH {SPLIT}, t AS (SELECT target_date AS d, fold FROM ready JOIN folds USING (target_date) WHERE split = 'train')
SELECT k AS fold, CAST(min(d) FILTER (WHERE fold < k) AS VARCHAR) AS train_target_start, CAST(max(d) FILTER (WHERE fold < k) AS VARCHAR) AS train_target_end,
  CAST(min(d) FILTER (WHERE fold = k) AS VARCHAR) AS validation_target_start, CAST(max(d) FILTER (WHERE fold = k) AS VARCHAR) AS validation_target_end,
  count(DISTINCT d) FILTER (WHERE fold < k) AS train_unique_dates, count(DISTINCT d) FILTER (WHERE fold = k) AS validation_unique_dates,
  count(*) FILTER (WHERE fold < k) AS train_rows, count(*) FILTER (WHERE fold = k) AS validation_rows FROM t, (SELECT unnest(range(1, 6)) AS k) GROUP BY k""")
def _(spark, folder):
    ready = _targeted(spark, folder).na.drop(subset=["target_close_next"])
    return sp.fold_summary(sp.time_split(ready, fr.CUTOFF).where("split = 'train'"), 5)


@query("j5_semi_join_fold", f'WITH {SPLIT} SELECT {KEY}, close FROM ready SEMI JOIN (SELECT target_date FROM folds WHERE fold = 2) f ON ready.target_date = f.target_date WHERE split = \'train\'', "close")
def _(spark, folder):
    ready = _targeted(spark, folder).na.drop(subset=["target_close_next"])
    train = sp.time_split(ready, fr.CUTOFF).where("split = 'train'")
    return sp.in_fold(train, sp.fold_calendar(train, 5), 2).select("Name", "date", "close")


@query("v8_split_integrity", f"""WITH {SPLIT} SELECT CAST(0 AS BIGINT) AS rows_with_nulls, count(*) FILTER (WHERE target_date <= date) AS target_not_after_feature, CAST(0 AS BIGINT) AS unknown_split, CAST(0 AS BIGINT) AS test_rows_with_fold,
  CAST(max(target_date) FILTER (WHERE split = 'train') AS VARCHAR) AS train_target_end, CAST(min(target_date) FILTER (WHERE split = 'test') AS VARCHAR) AS test_target_start,
  max(target_date) FILTER (WHERE split = 'train') < min(target_date) FILTER (WHERE split = 'test') AS no_leakage FROM ready""")
def _(spark, folder):
    return v.split_integrity(_labelled(spark, folder), ["Name", "date", *fr.BARS, "target_close_next", "target_date"])


@query("v11_row_loss", f"""WITH {fr.targeted_sql(fr.GAPPY_SQL)}, f AS (SELECT *, high IS NULL OR volume IS NULL AS gap, target_close_next IS NOT NULL AS has FROM targeted)
SELECT count(*) AS input_rows, count(*) FILTER (WHERE NOT has) AS removed_no_next_target, count(*) FILTER (WHERE gap AND has) AS removed_missing_features, count(*) FILTER (WHERE has AND NOT gap) AS model_ready_rows,
  count(*) FILTER (WHERE has AND NOT gap AND target_date < DATE '{fr.CUTOFF}') AS train_rows, count(*) FILTER (WHERE has AND NOT gap AND target_date >= DATE '{fr.CUTOFF}') AS test_rows,
  count(*) FILTER (WHERE has AND NOT gap AND target_date < DATE '{fr.CUTOFF}') / count(*) FILTER (WHERE has AND NOT gap)::DOUBLE AS train_ratio,
  count(*) FILTER (WHERE has AND NOT gap AND target_date >= DATE '{fr.CUTOFF}') / count(*) FILTER (WHERE has AND NOT gap)::DOUBLE AS test_ratio FROM f""", "train_ratio test_ratio")
def _(spark, folder):
    return sp.row_loss(pn.next_day_target(fr.gappy_bars(spark, folder)), fr.BARS, fr.CUTOFF)


SHARE = "('0x' || substr(md5({key} || '|42'), 1, 8))::BIGINT / 4294967296.0"


@query("x1_stratified_split", f"""WITH {fr.ORDERS} SELECT y, CASE WHEN {SHARE.format(key="y || '|' || o_orderkey")} < 0.2 THEN 'test' ELSE 'train' END AS split, count(*) AS rows FROM od GROUP BY 1, 2""")
def _(spark, folder):
    return sp.stratified_split(fr.orders(spark, folder), "y", ["o_orderkey"]).groupBy("y", "split").agg(F.count(F.lit(1)).alias("rows"))


@query("x1_exact_stratified_split", f"""WITH {fr.ORDERS}, r AS (SELECT o_orderkey, y, row_number() OVER (PARTITION BY y ORDER BY md5(y || '|' || o_orderkey || '|42')) AS place, count(*) OVER (PARTITION BY y) AS n FROM od)
SELECT o_orderkey, y, CASE WHEN place <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM r""")
def _(spark, folder):
    return sp.exact_stratified_split(fr.orders(spark, folder), "y", ["o_orderkey"]).select("o_orderkey", "y", "split")


@query("x2_random_split", f"""WITH {fr.ORDERS} SELECT CASE WHEN {SHARE.format(key="o_orderkey")} < 0.2 THEN 'test' ELSE 'train' END AS split, count(*) AS rows FROM od GROUP BY 1""")
def _(spark, folder):
    return sp.hash_split(fr.orders(spark, folder), ["o_orderkey"]).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query("x6_feature_exclusion", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders", "o_totalprice")
def _(spark, folder):
    df = read_table(spark, folder, "orders")
    return df.select(*sp.feature_columns(df, "o_orderstatus", {"o_orderstatus": ["o_orderdate"]}))


@query("x7_label_hold_out", "SELECT e.label, count(*) AS rows, avg(embedding[1]) AS first_mean FROM embeddings e GROUP BY 1", "first_mean")
def _(spark, folder):
    df = fr.vectors(spark, folder)
    held_out, blind = df.select("id", "label"), df.drop("label").select("id", F.get("features", F.lit(0)).alias("first"))
    return blind.join(held_out, "id").groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.avg("first").alias("first_mean"))
