"""Queries of the panel and window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import forecast as fc
from ..operators import runs as rl
from ..operators import timeseries as ts
from ..plans.forecast import likely_again
from .data import AS_OF, observations, record_rows, score_rows, table, with_tables
from .registry import register
from .tidy import d, i, r, tidy

PANEL = with_tables("panel")
W = "OVER (PARTITION BY OpDiv, indicator ORDER BY date"
ALL = "OVER (PARTITION BY OpDiv, indicator)"
KEY = f"OpDiv, indicator, {d('date')} AS date"


def panel(spark, sf: str) -> DataFrame:
    return ts.dense_panel(observations(spark, sf), AS_OF)


def runs(spark, sf: str) -> DataFrame:
    return rl.run_length_panel(observations(spark, sf), AS_OF, first_day=True)


def features(spark, sf: str) -> DataFrame:
    return rl.recurrence_features(rl.run_length_panel(observations(spark, sf), AS_OF), AS_OF)


@register("dense_panel", f"""{PANEL} SELECT {KEY}, observations, {i('dayofweek')} AS dayofweek,
  is_weekend, {i('day')} AS day, {i('month')} AS month, {i('seen')} AS seen, total_seen FROM panel""")
def _(spark, sf):
    return tidy(panel(spark, sf))


@register("cross_panel", f"""{with_tables('obs')},
 ud AS (SELECT OpDiv, API_UserName, indicator, obs_date AS date, sum(observations) AS o FROM obs GROUP BY ALL),
 ukeys AS (SELECT OpDiv, API_UserName, indicator, sum(CASE WHEN o > 0 THEN 1 ELSE 0 END) AS total_seen FROM ud GROUP BY ALL HAVING sum(CASE WHEN o > 0 THEN 1 ELSE 0 END) >= 1),
 g AS (SELECT k.*, CAST(unnest(generate_series(s.f, DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS date
   FROM ukeys k JOIN (SELECT OpDiv, min(obs_date) AS f FROM obs GROUP BY 1) s ON k.OpDiv = s.OpDiv)
 SELECT g.OpDiv, g.API_UserName, g.indicator, {d('g.date')} AS date, CAST(coalesce(ud.o, 0) AS BIGINT) AS observations,
  CAST(g.total_seen AS BIGINT) AS total_seen FROM g LEFT JOIN ud USING (OpDiv, API_UserName, indicator, date)""")
def _(spark, sf):
    out = ts.cross_panel(observations(spark, sf), AS_OF)
    return tidy(out, "OpDiv", "API_UserName", "indicator", "date", "observations", "total_seen")


_FEATURES = f"""
 idx AS (SELECT *, row_number() {W}) - 1 AS i, count(*) {ALL} AS n,
    max(CASE WHEN seen = 1 THEN datediff('day', DATE '2024-01-01', date) END) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
    FROM panel),
 gaps AS (SELECT *, CASE WHEN seen = 1 THEN datediff('day', DATE '2024-01-01', date) - prev END AS gap FROM idx),
 feats AS (SELECT OpDiv, indicator, max(n) - 1 - max(CASE WHEN seen = 1 THEN i END) AS last_seen,
   {', '.join(f"sum(CASE WHEN i >= n - {k} THEN seen ELSE 0 END) AS freq_{k}" for k in (1, 7, 14, 30, 45))},
   coalesce(avg(gap), max(n)) AS avg_gap,
   CASE WHEN count(gap) > 1 THEN (stddev_pop(gap) - avg(gap)) / (stddev_pop(gap) + avg(gap)) ELSE 0 END AS burstiness
   FROM gaps GROUP BY OpDiv, indicator)"""


@register("recurrence_features", f"""{PANEL},{_FEATURES} SELECT OpDiv, indicator, {i('last_seen')} AS last_seen,
  {', '.join(f"{i(f'freq_{k}')} AS freq_{k}" for k in (1, 7, 14, 30, 45))}, {r('avg_gap')} AS avg_gap,
  {r('burstiness')} AS burstiness,
  {', '.join(f"CASE WHEN freq_{k} > 0 THEN 1 ELSE 0 END::BIGINT AS label_{k}" for k in (7, 14, 30, 45))} FROM feats""")
def _(spark, sf):
    return tidy(features(spark, sf))


_EXP = "1 - exp(-greatest(freq_30 / 30.0, 1e-6) * {h})"


@register("forecast_likely_again", f"""{PANEL},{_FEATURES},
 p AS (SELECT *, {_EXP.format(h=7)} AS p FROM feats)
 SELECT OpDiv, indicator, {i('last_seen')} AS last_seen, {i('freq_7')} AS freq_7, {i('freq_30')} AS freq_30,
  {r('p')} AS probability, '7-Day: ' || CASE WHEN p >= 0.6 AND freq_7 >= 2 THEN 'Highly likely'
    WHEN p >= 0.07 AND freq_7 >= 1 THEN 'Possibly active' ELSE 'Low confidence' END AS confidence
 FROM p ORDER BY round(p, 6) DESC, OpDiv, indicator LIMIT 100""")
def _(spark, sf):
    return tidy(likely_again(observations(spark, sf), AS_OF, 7, 100))


@register("exp_hazard", f"""{PANEL},{_FEATURES} SELECT OpDiv, indicator,
  {', '.join(f"{r(_EXP.format(h=h))} AS exp_{h}" for h in (1, 7, 14, 30, 45))} FROM feats""")
def _(spark, sf):
    out = fc.exp_hazard(features(spark, sf))
    return tidy(out, "OpDiv", "indicator", *[f"exp_{h}" for h in fc.HORIZONS])


@register("rule_labels", f"""{PANEL},{_FEATURES} SELECT OpDiv, indicator,
  {', '.join(f"CAST(last_seen <= {h - 1} AS BIGINT) AS rule_{h}" for h in (1, 7, 14, 30, 45))} FROM feats""")
def _(spark, sf):
    out = fc.rule_labels(features(spark, sf))
    return tidy(out, "OpDiv", "indicator", *[f"rule_{h}" for h in fc.HORIZONS])


def _ensemble_inputs(spark, sf):
    """Stand-in model columns derived from the features, so SQL can follow the arithmetic."""
    out = fc.exp_hazard(features(spark, sf))
    return out.withColumns(
        {f"logistic_{h}": F.col("freq_30") / 30.0 for h in fc.HORIZONS}
        | {f"boosted_{h}": F.col("freq_14") / 14.0 for h in fc.HORIZONS}
        | {f"weibull_{h}": F.when(F.col("last_seen") < 20, F.col("freq_7") / 7.0) for h in fc.HORIZONS}
    )


_ENS = (
    "freq_30 / 30.0 * 0.3 + freq_14 / 14.0 * 0.25 + "
    "(CASE WHEN last_seen < 20 THEN freq_7 / 7.0 END) * 0.25 + (" + _EXP + ") * 0.2"
)


@register("ensemble_probability", f"""{PANEL},{_FEATURES} SELECT OpDiv, indicator,
  {', '.join(f"{r(_ENS.format(h=h))} AS ensemble_{h}" for h in (1, 7, 14, 30, 45))} FROM feats""")
def _(spark, sf):
    out = fc.ensemble_probability(_ensemble_inputs(spark, sf))
    return tidy(out, "OpDiv", "indicator", *[f"ensemble_{h}" for h in fc.HORIZONS])


def _conf_sql(h: int) -> str:
    return f"""'{h}-Day: ' || CASE WHEN ({_ENS.format(h=h)}) >= 0.6 AND freq_{h} >= 2 THEN 'Highly likely'
      WHEN ({_ENS.format(h=h)}) >= 0.07 AND freq_{h} >= 1 THEN 'Possibly active' ELSE 'Low confidence' END"""


@register("confidence_band", f"""{PANEL},{_FEATURES} SELECT OpDiv, indicator,
  {', '.join(f"{_conf_sql(h)} AS confidence_{h}" for h in (1, 7, 14, 30, 45))} FROM feats""")
def _(spark, sf):
    out = fc.ensemble_probability(_ensemble_inputs(spark, sf))
    for h in fc.HORIZONS:
        out = fc.confidence_band(out, h)
    return out.select("OpDiv", "indicator", *[f"confidence_{h}" for h in fc.HORIZONS])


def _report(spark, sf):
    today = rl.seen_on(rl.run_length_panel(observations(spark, sf), AS_OF), AS_OF)
    out = fc.ensemble_probability(_ensemble_inputs(spark, sf))
    for h in fc.HORIZONS:
        out = fc.confidence_band(out, h)
    return fc.forecast_report(out, today, last_day=AS_OF)


_PCT = "CASE WHEN ({e}) IS NOT NULL THEN CAST(CAST(round_even(least(greatest(({e}) * 100, 0.0), 100.0) * 100, 0) / 100 AS DOUBLE) AS VARCHAR) || '%' END"


@register("forecast_report", f"""{PANEL},{_FEATURES} SELECT f.indicator AS "Indicator", CAST(t.seen AS BIGINT) AS "Observed Today",
  {', '.join(f'CAST(freq_{k} AS BIGINT) AS "Frequency ({k}d)"' for k in (1, 7, 30, 45))},
  {', '.join(f'{_PCT.format(e=_ENS.format(h=h))} AS "Probability: {h}-Day", {_conf_sql(h)} AS "Confidence: {h}-Day"' for h in (1, 7, 14, 30, 45))},
  f.OpDiv AS "Partner"
  FROM feats f LEFT JOIN panel t ON f.OpDiv = t.OpDiv AND f.indicator = t.indicator AND t.date = DATE '2024-01-30'""")
def _(spark, sf):
    return tidy(_report(spark, sf))


# forecasts made on day 16 of the month, checked up to the last day
_CUT = "2024-01-16"


def _log(spark, sf):
    obs = observations(spark, sf)
    past = obs.where(F.col("obs_date") <= _CUT)
    features = fc.exp_hazard(ts.recurrence_features(ts.dense_panel(past, _CUT)), (7, 14, 30, 45))
    for h in (7, 14, 30, 45):
        features = fc.confidence_band(features, h, f"exp_{h}")
    report = features.select(
        F.col("OpDiv").alias("Partner"), F.col("indicator").alias("Indicator"),
        *[F.col(f"confidence_{h}").alias(f"Confidence: {h}-Day") for h in (7, 14, 30, 45)],
    )
    return fc.forecast_log(report, ts.dense_panel(obs, AS_OF, min_seen=1), _CUT, AS_OF)


_LOG = f"""{with_tables('obs')},
 past AS (SELECT OpDiv, indicator, obs_date AS date, sum(observations) AS o FROM obs WHERE obs_date <= DATE '{_CUT}' GROUP BY ALL),
 feats AS (SELECT OpDiv, indicator, {', '.join(f"sum(CASE WHEN o > 0 AND date > DATE '{_CUT}' - {h} THEN 1 ELSE 0 END) AS freq_{h}" for h in (7, 14, 30, 45))}
   FROM past GROUP BY ALL HAVING sum(CASE WHEN o > 0 THEN 1 ELSE 0 END) >= 2),
 logs AS ({' UNION ALL '.join(f'''SELECT OpDiv, indicator, '{h}-Day' AS t, DATE '{_CUT}' + {h} AS chk,
   '{h}-Day: ' || CASE WHEN {_EXP.format(h=h)} >= 0.6 AND freq_{h} >= 2 THEN 'Highly likely'
     WHEN {_EXP.format(h=h)} >= 0.07 AND freq_{h} >= 1 THEN 'Possibly active' ELSE 'Low confidence' END AS c FROM feats''' for h in (7, 14, 30, 45))}),
 act AS (SELECT OpDiv, indicator, obs_date AS date, max(CASE WHEN observations > 0 THEN 1 ELSE 0 END) AS seen FROM obs GROUP BY ALL),
 log AS (SELECT l.OpDiv AS "Partner", l.indicator AS "Indicator", DATE '{_CUT}' AS "Forecast Date", t AS "Forecast Type",
   c AS "Confidence", chk AS "Forecasted Check Date",
   CASE WHEN chk > DATE '2024-01-30' THEN 'Pending' WHEN coalesce(a.seen, 0) = 1 THEN 'Seen'
        ELSE 'Not Seen' END AS "Outcome"
   FROM logs l LEFT JOIN act a ON l.OpDiv = a.OpDiv AND l.indicator = a.indicator AND a.date = l.chk)"""
_LOG_COLS = f""""Partner", "Indicator", {d('"Forecast Date"')} AS "Forecast Date", "Forecast Type", "Confidence",
  {d('"Forecasted Check Date"')} AS "Forecasted Check Date", "Outcome\""""


@register("forecast_log", f"{_LOG} SELECT {_LOG_COLS} FROM log")
def _(spark, sf):
    return tidy(_log(spark, sf))


def _daily_reports(spark, sf):
    """What each partner reported per day; every fourth sighting is reported as not observed."""
    return observations(spark, sf).select(
        F.col("OpDiv").alias("Partner"), F.col("indicator").alias("Indicator"),
        F.date_add("obs_date", 20).alias("FileDate"),
        F.when(F.col("observations") % 4 == 0, 0).otherwise(1).alias("Observed Today"),
    )


_RESOLVED = f"""{_LOG},
 rep AS (SELECT OpDiv AS p, indicator AS ind, obs_date + 20 AS fd, max(CASE WHEN observations % 4 = 0 THEN 0 ELSE 1 END) AS s FROM obs GROUP BY ALL),
 repday AS (SELECT DISTINCT fd FROM rep),
 resolved AS (SELECT log.* REPLACE (
    trim(regexp_replace("Confidence", '^\\d+-Day:\\s*', '')) AS "Confidence",
    CASE WHEN rep.s = 1 THEN 'Seen' WHEN repday.fd IS NOT NULL THEN 'Not Seen' ELSE "Outcome" END AS "Outcome")
  FROM log LEFT JOIN rep ON "Partner" = rep.p AND "Indicator" = rep.ind AND "Forecasted Check Date" = rep.fd
  LEFT JOIN repday ON "Forecasted Check Date" = repday.fd)"""


@register("resolve_outcomes", f"{_RESOLVED} SELECT {_LOG_COLS} FROM resolved")
def _(spark, sf):
    return tidy(fc.resolve_outcomes(_log(spark, sf), _daily_reports(spark, sf)))


@register("forecast_feedback", f"""{_RESOLVED} SELECT {_LOG_COLS} FROM resolved WHERE "Outcome" IN ('Seen', 'Not Seen')
  UNION ALL SELECT "Partner", "Indicator", {d('"Forecast Date"')}, "Forecast Type", trim(regexp_replace("Confidence", '^\\d+-Day:\\s*', '')),
  {d('"Forecasted Check Date"')}, 'Unknown' FROM log WHERE "Forecast Type" = '7-Day' AND NOT EXISTS (SELECT 1 FROM resolved z WHERE
    z."Partner" = log."Partner" AND z."Indicator" = log."Indicator" AND z."Forecast Type" = '7-Day' AND z."Outcome" IN ('Seen', 'Not Seen'))
  UNION ALL SELECT "Partner", "Indicator", {d('"Forecast Date"')}, '30-Day', trim(regexp_replace("Confidence", '^\\d+-Day:\\s*', '')) || ' (old)',
  {d('"Forecasted Check Date"')}, 'Unknown' FROM log WHERE "Forecast Type" = '14-Day'""")
def _(spark, sf):
    log = fc.resolve_outcomes(_log(spark, sf), _daily_reports(spark, sf))
    old = log.withColumn("Outcome", F.lit("Unknown"))
    master = old.where("`Forecast Type` = '7-Day'").unionByName(
        old.where("`Forecast Type` = '14-Day'").withColumns(
            {"Forecast Type": F.lit("30-Day"), "Confidence": F.concat("Confidence", F.lit(" (old)"))}
        )
    )
    return tidy(fc.forecast_feedback(log, master))


@register("cumulative_seen", f"{PANEL} SELECT {KEY}, {i(f'sum(seen) {W})')} AS cumulative_seen FROM panel")
def _(spark, sf):
    return tidy(rl.cumulative_seen(runs(spark, sf)), "OpDiv", "indicator", "date", "cumulative_seen")


_LAST = "max(CASE WHEN seen = 1 THEN date END) " + W
for _name, _strict, _sql in (
    ("days_since_last_seen", False, f"datediff('day', {_LAST}), date)"),
    ("days_since_last_seen_strict", True,
     f"coalesce(datediff('day', {_LAST} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), date), 0)"),
):
    def _query(spark, sf, strict=_strict):
        out = rl.days_since_last_seen(runs(spark, sf), strict)
        return tidy(out, "OpDiv", "indicator", "date", "days_since_last_seen")

    register(_name, f"{PANEL} SELECT {KEY}, {i(_sql)} AS days_since_last_seen FROM panel")(_query)

_STREAK = f"""streak AS (SELECT *, sum(seen) OVER (PARTITION BY OpDiv, indicator, island ORDER BY date) AS seen_streak
  FROM (SELECT *, sum(1 - seen) {W}) AS island FROM panel))"""


@register("seen_streak", f"{PANEL}, {_STREAK} SELECT {KEY}, {i('seen_streak')} AS seen_streak FROM streak")
def _(spark, sf):
    return tidy(rl.seen_streak(runs(spark, sf)), "OpDiv", "indicator", "date", "seen_streak")


_SUMMARY = f"""
 flip AS (SELECT *, CASE WHEN lag(seen) {W}) = seen THEN 0 ELSE 1 END AS chg, row_number() {W}) - 1 AS i,
   max(CASE WHEN seen = 1 THEN date END) {W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM panel),
 runs AS (SELECT *, sum(chg) {W}) AS run FROM flip),
 lens AS (SELECT *, count(*) OVER (PARTITION BY OpDiv, indicator, run) AS len,
   CASE WHEN seen = 1 THEN datediff('day', prev, date) END AS gap FROM runs),
 summ AS (SELECT OpDiv, indicator, count(*) AS total_days, sum(seen) AS total_seen, avg(seen) AS seen_ratio, stddev_pop(seen) AS seen_std,
   coalesce(max(CASE WHEN seen = 1 THEN len END), 0) AS max_seen_streak, coalesce(max(CASE WHEN seen = 0 THEN len END), 0) AS max_unseen_streak,
   avg(gap) AS mean_seen_interval, stddev_pop(gap) AS std_seen_interval, count(*) - 1 - max(CASE WHEN seen = 1 THEN i END) AS days_since_last_seen
   FROM lens GROUP BY OpDiv, indicator)"""
_SUMM_COLS = f"""OpDiv, indicator, {i('total_days')} AS total_days, {i('total_seen')} AS total_seen, {r('seen_ratio')} AS seen_ratio,
  {r('seen_std')} AS seen_std, {i('max_seen_streak')} AS max_seen_streak, {i('max_unseen_streak')} AS max_unseen_streak,
  {r('mean_seen_interval')} AS mean_seen_interval, {r('std_seen_interval')} AS std_seen_interval, {i('days_since_last_seen')} AS days_since_last_seen"""


@register("streak_summary", f"{PANEL},{_SUMMARY} SELECT {_SUMM_COLS} FROM summ")
def _(spark, sf):
    return tidy(rl.streak_summary(runs(spark, sf), AS_OF))


def _roll_sql(col, windows, full):
    out = []
    for n in windows:
        frame = f"{W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("sum", "sum"), ("min", "min"), ("max", "max")):
            e = f"CASE WHEN count({col}) {frame} >= {n if full else 1} THEN {fn}({col}) {frame} END"
            e = r(e) if name in ("mean", "std") else i(e)
            out.append(f"{e} AS {col}_{name}_{n}")
    return ", ".join(out)


for _name, _wins, _full in (("rolling_stats", (3, 7, 14, 30), False), ("rolling_stats_full", (3, 7), True)):
    def _query(spark, sf, wins=_wins, full=_full):
        out = ts.rolling_stats(panel(spark, sf), "observations", wins, None if full else 1)
        extra = [c for c in out.columns if c.startswith("observations_")]
        return tidy(out, "OpDiv", "indicator", "date", *extra)

    register(_name, f"{PANEL} SELECT {KEY}, {_roll_sql('observations', _wins, _full)} FROM panel")(_query)

_F14 = f"{W} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"


@register("rolling_quantile_flags", f"""{PANEL},
 q AS (SELECT *, quantile_cont(observations, 0.75) {_F14} AS hi, quantile_cont(observations, 0.25) {_F14} AS lo FROM panel),
 f AS (SELECT *, CAST(observations >= hi AND seen = 0 AS BIGINT) AS h, CAST(observations <= lo AND seen = 1 AS BIGINT) AS l FROM q)
 SELECT {KEY}, h AS high_activity_not_seen, l AS low_activity_seen, {r(f'avg(h) {_F14}')} AS high_activity_not_seen_ratio_14d,
  {r(f'avg(l) {_F14}')} AS low_activity_seen_ratio_14d FROM f""")
def _(spark, sf):
    out = ts.rolling_quantile_flags(panel(spark, sf))
    return tidy(out, "OpDiv", "indicator", "date", "high_activity_not_seen", "low_activity_seen",
                "high_activity_not_seen_ratio_14d", "low_activity_seen_ratio_14d")


_MISMATCH = """
 quart AS (SELECT OpDiv, indicator, quantile_cont(observations, 0.75) AS hi, quantile_cont(observations, 0.25) AS lo FROM panel GROUP BY ALL),
 mism AS (SELECT p.OpDiv, p.indicator, sum(CAST(observations >= hi AND seen = 0 AS INT)) AS hc, avg(CAST(observations >= hi AND seen = 0 AS INT)) AS hr,
   sum(CAST(observations <= lo AND seen = 1 AS INT)) AS lc, avg(CAST(observations <= lo AND seen = 1 AS INT)) AS lr
   FROM panel p JOIN quart q ON p.OpDiv = q.OpDiv AND p.indicator = q.indicator GROUP BY ALL)"""


@register("activity_mismatch", f"""{PANEL},{_MISMATCH} SELECT OpDiv, indicator, {i('hc')} AS high_activity_not_seen_count,
  {r('hr')} AS high_activity_not_seen_ratio, {i('lc')} AS low_activity_seen_count, {r('lr')} AS low_activity_seen_ratio FROM mism""")
def _(spark, sf):
    return tidy(ts.activity_mismatch(panel(spark, sf)))


_F7 = f"{W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


@register("trend_ratios", f"""{PANEL}, {_STREAK},
 t AS (SELECT *, avg(seen) {_F14} AS ratio, stddev_samp(seen) {_F14} AS sd, avg(observations) {_F14} AS o14, avg(observations) {_F7} AS o7,
   coalesce(lag(seen_streak) {W}), 0) AS prev FROM streak)
 SELECT {KEY}, {r(f'coalesce(ratio - lag(ratio, 7) {W}), 0)')} AS seen_ratio_diff, {r('coalesce(o14 / (o7 + 1e-6), 0)')} AS obs_ratio_spike,
  {i('prev')} AS seen_streak_prev, {r('coalesce(sd / (ratio + 1e-5), 0)')} AS volatility_ratio,
  CAST(prev >= 5 AND seen_streak = 0 AS BIGINT) AS recent_drop_flag FROM t""")
def _(spark, sf):
    out = rl.trend_ratios(runs(spark, sf))
    return tidy(out, "OpDiv", "indicator", "date", "seen_ratio_diff", "obs_ratio_spike",
                "seen_streak_prev", "volatility_ratio", "recent_drop_flag")


@register("lag_features", f"""{PANEL} SELECT {KEY},
  {', '.join(f"{i(f'lag({c}, {k}) {W})')} AS {c}_lag_{k}" for c in ('observations', 'seen') for k in (1, 2, 3))} FROM panel""")
def _(spark, sf):
    out = ts.lag_features(panel(spark, sf), ("observations", "seen"), 3)
    return tidy(out, "OpDiv", "indicator", "date",
                *[f"{c}_lag_{k}" for c in ("observations", "seen") for k in (1, 2, 3)])


@register("calendar_features", f"""SELECT o_orderkey, {i('year(o_orderdate)')} AS year, {i('month(o_orderdate)')} AS month, {i('day(o_orderdate)')} AS day,
  {i('isodow(o_orderdate) - 1')} AS dayofweek, {i('dayofyear(o_orderdate)')} AS dayofyear, isodow(o_orderdate) >= 6 AS is_weekend FROM orders""")
def _(spark, sf):
    out = ts.calendar_features(table(spark, sf, "orders"), "o_orderdate")
    return tidy(out, "o_orderkey", "year", "month", "day", "dayofweek", "dayofyear", "is_weekend")


@register("lead_target", f"{PANEL} SELECT {KEY}, {i(f'lead(observations) {W})')} AS target FROM panel")
def _(spark, sf):
    return tidy(ts.lead_target(panel(spark, sf), "observations"), "OpDiv", "indicator", "date", "target")


@register("sequence_windows", f"""{PANEL},
 s AS (SELECT *, list(observations) {W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS a, list(seen) {W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS b,
   list(seen) {W} ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING) AS t FROM panel)
 SELECT {KEY}, array_to_string(a, '|') AS observations_seq, array_to_string(b, '|') AS seen_seq, array_to_string(t, '|') AS target_seq
 FROM s WHERE len(a) = 5 AND len(t) = 2""")
def _(spark, sf):
    return tidy(ts.sequence_windows(panel(spark, sf), ("observations", "seen"), 5, "seen", 2))


@register("ewm", f"""{PANEL},
 s AS (SELECT *, row_number() {W}) - 1 AS t FROM panel)
 SELECT a.OpDiv, a.indicator, {d('a.date')} AS date, {r('sum(b.observations * power(0.5, a.t - b.t) * (CASE WHEN b.t = 0 THEN 1 ELSE 0.5 END))')} AS observations_ewm_3
 FROM s a JOIN s b ON a.OpDiv = b.OpDiv AND a.indicator = b.indicator AND b.t <= a.t GROUP BY a.OpDiv, a.indicator, a.date""")
def _(spark, sf):
    return tidy(ts.ewm(panel(spark, sf), "observations", 3), "OpDiv", "indicator", "date", "observations_ewm_3")


@register("minmax_scale", f"""{PANEL} SELECT {KEY},
  {r('(observations - min(observations) OVER ()) / (CASE WHEN max(observations) OVER () = min(observations) OVER () THEN 1.0 ELSE max(observations) OVER () - min(observations) OVER () END)')} AS whole,
  {r(f'(observations - min(observations) {ALL}) / (CASE WHEN max(observations) {ALL} = min(observations) {ALL} THEN 1.0 ELSE max(observations) {ALL} - min(observations) {ALL} END)')} AS per_key FROM panel""")
def _(spark, sf):
    out = ts.minmax_scale(panel(spark, sf), "observations", out="whole")
    out = ts.minmax_scale(out, "observations", ("OpDiv", "indicator"), out="per_key")
    return tidy(out, "OpDiv", "indicator", "date", "whole", "per_key")


@register("difference", f"""{PANEL} SELECT {KEY}, {i(f'observations - lag(observations, 1) {W})')} AS observations_diff_1,
  {i(f'observations - lag(observations, 12) {W})')} AS observations_diff_12 FROM panel""")
def _(spark, sf):
    out = ts.difference(ts.difference(panel(spark, sf), "observations", 1), "observations", 12)
    return tidy(out, "OpDiv", "indicator", "date", "observations_diff_1", "observations_diff_12")


@register("seasonal_means", f"""{PANEL},
 a AS (SELECT *, (row_number() {W}) - 1) % 7 AS phase, CASE WHEN count(*) {W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) = 7
   THEN avg(observations) {W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS trend FROM panel),
 b AS (SELECT OpDiv, indicator, phase, avg(observations - trend) AS pm FROM a GROUP BY ALL),
 c AS (SELECT *, pm - avg(pm) {ALL} AS seasonal FROM b)
 SELECT a.OpDiv, a.indicator, {d('a.date')} AS date, {i('a.phase')} AS phase, {r('trend')} AS trend, {r('seasonal')} AS seasonal,
  {r('observations - trend - seasonal')} AS residual FROM a JOIN c ON a.OpDiv = c.OpDiv AND a.indicator = c.indicator AND a.phase = c.phase""")
def _(spark, sf):
    out = ts.seasonal_means(panel(spark, sf), "observations", 7)
    return tidy(out, "OpDiv", "indicator", "date", "phase", "trend", "seasonal", "residual")


@register("seasonal_means_even", f"""{PANEL},
 a AS (SELECT *, (row_number() {W}) - 1) % 12 AS phase, CASE WHEN count(*) {W} ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13
   THEN (sum(observations) {W} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + (lag(observations, 6) {W}) + lead(observations, 6) {W})) / 2) / 12 END AS trend FROM panel),
 b AS (SELECT OpDiv, indicator, phase, avg(observations - trend) AS pm FROM a GROUP BY ALL),
 c AS (SELECT *, pm - avg(pm) {ALL} AS seasonal FROM b)
 SELECT a.OpDiv, a.indicator, {d('a.date')} AS date, {i('a.phase')} AS phase, {r('trend')} AS trend, {r('seasonal')} AS seasonal,
  {r('observations - trend - seasonal')} AS residual FROM a JOIN c ON a.OpDiv = c.OpDiv AND a.indicator = c.indicator AND a.phase = c.phase""")
def _(spark, sf):
    out = ts.seasonal_means(panel(spark, sf), "observations", 12)
    return tidy(out, "OpDiv", "indicator", "date", "phase", "trend", "seasonal", "residual")


@register("autocorrelation", f"""{PANEL},
 x AS (SELECT OpDiv, indicator, row_number() {W}) AS i, observations - avg(observations) {ALL} AS x FROM panel),
 v AS (SELECT OpDiv, indicator, sum(x * x) AS v FROM x GROUP BY ALL),
 p AS (SELECT a.OpDiv, a.indicator, a.i - b.i AS lag, sum(a.x * b.x) AS s FROM x a JOIN x b
   ON a.OpDiv = b.OpDiv AND a.indicator = b.indicator AND a.i - b.i BETWEEN 1 AND 7 GROUP BY ALL),
 c AS (SELECT p.OpDiv, p.indicator, lag, s / v AS acf FROM p JOIN v ON p.OpDiv = v.OpDiv AND p.indicator = v.indicator)
 SELECT OpDiv, indicator, CAST(lag AS BIGINT) AS lag, {r('acf')} AS acf, {i(f'min(CASE WHEN acf > 0.2 THEN lag END) {ALL}')} AS first_lag_above FROM c""")
def _(spark, sf):
    return tidy(ts.autocorrelation(panel(spark, sf), "observations", 7, 0.2))


@register("predictability", f"""{PANEL}, {_STREAK},
 s AS (SELECT OpDiv, indicator, count(*) AS n, sum(seen) AS k, stddev_samp(seen) AS sd, max(seen_streak) AS m, avg(seen) AS rate FROM streak GROUP BY ALL)
 SELECT OpDiv, indicator, n AS total_days, {i('k')} AS total_seen, {r('sd')} AS seen_days_std, {i('m')} AS max_seen_streak, {r('rate')} AS seen_rate,
  k >= 5 AND rate >= 0.1 AND m >= 3 AS is_predictable FROM s""")
def _(spark, sf):
    return tidy(ts.predictability(panel(spark, sf)))


_SCORES = f"""{PANEL},{_SUMMARY},{_MISMATCH},
 sc AS (SELECT s.*, total_seen * 0.3 + seen_ratio * 50 + max_seen_streak * 0.2 - days_since_last_seen * 0.1 AS seen_score,
   hr * 100 + max_unseen_streak * 0.2 + days_since_last_seen * 0.5 AS unseen_risk FROM summ s JOIN mism m ON s.OpDiv = m.OpDiv AND s.indicator = m.indicator)"""


@register("activity_scores", f"{_SCORES} SELECT OpDiv, indicator, {r('seen_score')} AS seen_score, {r('unseen_risk')} AS unseen_risk FROM sc")
def _(spark, sf):
    return tidy(ts.activity_scores(panel(spark, sf)), "OpDiv", "indicator", "seen_score", "unseen_risk")


@register("activity_class_means", f"""{_SCORES} SELECT CAST(days_since_last_seen = 0 AS BIGINT) AS seen, {r('avg(seen_score)')} AS seen_score,
  {r('avg(unseen_risk)')} AS unseen_risk FROM sc GROUP BY 1""")
def _(spark, sf):
    scores = ts.activity_scores(panel(spark, sf)).withColumn(
        "seen", (F.col("days_since_last_seen") == 0).cast("int")
    )
    return tidy(ts.score_class_means(scores, "seen"))


@register("forward_fill", f"""{with_tables('recs')} SELECT indicator, id, {i('last_value(rating IGNORE NULLS) OVER (PARTITION BY indicator ORDER BY id)')} AS rating FROM recs""")
def _(spark, sf):
    out = ts.forward_fill(record_rows(spark, sf), "rating", "id", ("indicator",))
    return tidy(out.select("indicator", "id", F.col("rating").cast("long").alias("rating")))


@register("retain_latest_days", f"""{with_tables('obs')} SELECT indicator, OpDiv, {d('obs_date')} AS obs_date, observations FROM obs
  WHERE obs_date IN (SELECT DISTINCT obs_date FROM obs ORDER BY 1 DESC LIMIT 5)""")
def _(spark, sf):
    out = ts.retain_latest_days(observations(spark, sf), 5, "obs_date")
    return tidy(out, "indicator", "OpDiv", "obs_date", "observations")


@register("latest_row", f"""{PANEL} SELECT {KEY}, observations, {i('seen')} AS seen FROM panel WHERE date <= DATE '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY OpDiv, indicator ORDER BY date DESC) = 1""")
def _(spark, sf):
    return tidy(ts.latest_row(panel(spark, sf), "2024-01-20"), "OpDiv", "indicator", "date", "observations", "seen")


@register("top_fraction", f"""{with_tables('scores')} SELECT indicator, {i('score')} AS score FROM scores
  QUALIFY row_number() OVER (ORDER BY score DESC, indicator) <= ceil((SELECT count(*) FROM scores) * 0.1)""")
def _(spark, sf):
    return tidy(ts.top_fraction(score_rows(spark, sf), "score", 0.1), "indicator", "score")


@register("quantile_bands", f"""{with_tables('scores')},
 e AS (SELECT quantile_cont(score, [0.0, 0.4, 0.7, 0.9, 1.0]) AS e FROM scores)
 SELECT indicator, {i('score')} AS score, CASE WHEN score <= e[2] AND e[2] > e[1] THEN 'Low' WHEN score <= e[3] AND e[3] > e[1] THEN 'Moderate'
  WHEN score <= e[4] AND e[4] > e[1] THEN 'High' WHEN score <= e[5] AND e[5] > e[1] THEN 'Critical' END AS band FROM scores, e""")
def _(spark, sf):
    return tidy(ts.quantile_bands(score_rows(spark, sf), "score"), "indicator", "score", "band")
