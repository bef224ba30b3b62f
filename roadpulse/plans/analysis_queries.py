"""Trends, holidays, statistics, probabilities and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse import schema as S
from roadpulse.functions import columns as C
from roadpulse.operators import lookup, probability, profiles, stats, trends
from roadpulse.plans import inputs
from roadpulse.plans.inputs import FIRST_YEAR, HOLIDAY_FIRST, HOLIDAY_LAST, LAST_YEAR
from roadpulse.plans.oracle import define, r, rounded, sql
from roadpulse.plans.registry import query

_IN_YEARS = f"year(ts) BETWEEN {FIRST_YEAR} AND {LAST_YEAR}"
_IN_HOLIDAY_YEARS = f"year(ts) BETWEEN {HOLIDAY_FIRST} AND {HOLIDAY_LAST}"
_NAMES = "('New Years Day', 'Labor Day')"

define("yearly", ["traffic_hourly"], f"""
    SELECT year(ts) AS yr, count(*) AS recorded_hours, CAST(sum(traffic_volume) AS BIGINT) AS total_volume,
           round(avg(traffic_volume), 1) AS avg_volume_per_hour
    FROM traffic_hourly WHERE {_IN_YEARS} GROUP BY 1""")
define("holiday_dates", ["parsed"], f"""
    SELECT year(ts) AS yr, holiday, min(CAST(ts AS DATE)) AS holiday_date FROM parsed
    WHERE holiday IN {_NAMES} AND {_IN_HOLIDAY_YEARS} GROUP BY 1, 2""")
define("holiday_temps", ["traffic_hourly", "holiday_dates"], """
    SELECT d.holiday, d.yr, CAST(d.holiday_date AS VARCHAR) AS holiday_date, round(avg(temp), 2) AS avg_temp_kelvin,
           round(avg(temp) - 273.15E0, 2) AS avg_temp_celsius, count(*) AS hours_recorded
    FROM holiday_dates d JOIN traffic_hourly h ON CAST(h.ts AS DATE) = d.holiday_date GROUP BY 1, 2, 3""")
define("conditions", ["traffic_hourly"], """
    SELECT count(*) AS n, count(*) FILTER (c) AS nc, count(*) FILTER (l) AS nl, count(*) FILTER (k) AS nk,
      count(*) FILTER (c AND l) AS ncl, count(*) FILTER (c AND k) AS nck, count(*) FILTER (c AND h) AS nch
    FROM (SELECT traffic_volume > 5500 AS c, weather_main = 'Clear' AS l, weather_main = 'Clouds' AS k, temp > 292 AS h
          FROM traffic_hourly WHERE temp > 0)""")


def _yearly_hours(spark, sf_dir):
    return inputs.hourly(spark, sf_dir, first_year=FIRST_YEAR, last_year=LAST_YEAR)


def _holiday_hours(spark, sf_dir):
    years = {"first_year": HOLIDAY_FIRST, "last_year": HOLIDAY_LAST}
    return inputs.hourly(spark, sf_dir, **years), inputs.parsed(spark, sf_dir, **years)


# -- yearly ------------------------------------------------------------------
@query("year_filter", sql("traffic_hourly", f"""
    SELECT corridor, ts, traffic_volume FROM traffic_hourly WHERE {_IN_YEARS}"""))
def year_filter(spark, sf_dir):
    return _yearly_hours(spark, sf_dir).filter(trends.in_years(FIRST_YEAR, LAST_YEAR)).select(
        "corridor", "ts", "traffic_volume"
    )


@query("yearly_totals", sql("yearly", "SELECT * FROM yearly"))
def yearly_totals(spark, sf_dir):
    return trends.yearly_totals(_yearly_hours(spark, sf_dir), FIRST_YEAR, LAST_YEAR)


@query("yearly_trends", sql("yearly", """
    SELECT *, total_volume - lag(total_volume) OVER w AS total_volume_change,
      round(100E0 * (total_volume - lag(total_volume) OVER w) / lag(total_volume) OVER w, 1) AS total_volume_pct_change,
      round(avg_volume_per_hour - lag(avg_volume_per_hour) OVER w, 1) + 0E0 AS avg_volume_change,
      round(100E0 * (avg_volume_per_hour - lag(avg_volume_per_hour) OVER w) / lag(avg_volume_per_hour) OVER w, 1) + 0E0 AS avg_volume_pct_change
    FROM yearly WINDOW w AS (ORDER BY yr)"""))
def yearly_trends(spark, sf_dir):
    return trends.yearly_trends(_yearly_hours(spark, sf_dir), FIRST_YEAR, LAST_YEAR)


@query("yoy_change", sql("yearly", """
    SELECT yr, total_volume - lag(total_volume) OVER (ORDER BY yr) AS total_volume_change,
      round(avg_volume_per_hour - lag(avg_volume_per_hour) OVER (ORDER BY yr), 1) + 0E0 AS avg_volume_change FROM yearly"""))
def yoy_change(spark, sf_dir):
    return yearly_trends(spark, sf_dir).select("yr", "total_volume_change", "avg_volume_change")


@query("yoy_pct_change", sql("yearly", """
    SELECT yr, round(100E0 * (total_volume - lag(total_volume) OVER w) / lag(total_volume) OVER w, 1) + 0E0 AS total_volume_pct_change,
      round(100E0 * (avg_volume_per_hour - lag(avg_volume_per_hour) OVER w) / lag(avg_volume_per_hour) OVER w, 1) + 0E0 AS avg_volume_pct_change
    FROM yearly WINDOW w AS (ORDER BY yr)"""))
def yoy_pct_change(spark, sf_dir):
    return yearly_trends(spark, sf_dir).select("yr", "total_volume_pct_change", "avg_volume_pct_change")


@query("coverage_extremes", sql("yearly", """
    SELECT (SELECT yr FROM yearly ORDER BY recorded_hours, yr LIMIT 1) AS fewest_hours_year, min(recorded_hours) AS fewest_hours,
      (SELECT yr FROM yearly ORDER BY recorded_hours DESC, yr LIMIT 1) AS most_hours_year, max(recorded_hours) AS most_hours,
      (SELECT yr FROM yearly ORDER BY avg_volume_per_hour DESC, yr LIMIT 1) AS peak_mean_year, max(avg_volume_per_hour) AS peak_mean
    FROM yearly"""))
def coverage_extremes(spark, sf_dir):
    return trends.coverage_extremes(yearly_totals(spark, sf_dir))


# -- holidays ----------------------------------------------------------------
@query("holiday_in_list", sql("parsed", f"""
    SELECT corridor, ts, holiday, temp FROM parsed WHERE holiday IN {_NAMES} AND {_IN_HOLIDAY_YEARS}"""))
def holiday_in_list(spark, sf_dir):
    _, seen = _holiday_hours(spark, sf_dir)
    return trends.named_holidays(seen, S.HOLIDAY_NAMES, HOLIDAY_FIRST, HOLIDAY_LAST).select(
        "corridor", "ts", "holiday", "temp"
    )


@query("holiday_dates", sql("holiday_dates", """
    SELECT yr, holiday, CAST(holiday_date AS VARCHAR) AS holiday_date FROM holiday_dates"""))
def holiday_dates(spark, sf_dir):
    _, seen = _holiday_hours(spark, sf_dir)
    return trends.holiday_dates(seen, HOLIDAY_FIRST, HOLIDAY_LAST)


@query("holiday_day_temp", sql("traffic_hourly", f"""
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS holiday_date, round(avg(temp), 2) AS avg_temp_kelvin,
      round(avg(temp) - 273.15E0, 2) + 0E0 AS avg_temp_celsius, count(*) AS hours_recorded
    FROM traffic_hourly WHERE CAST(ts AS DATE) IN
      (SELECT CAST(ts AS DATE) FROM parsed WHERE holiday IN {_NAMES} AND {_IN_HOLIDAY_YEARS}) GROUP BY 1"""))
def holiday_day_temp(spark, sf_dir):
    return trends.holiday_day_temp(*_holiday_hours(spark, sf_dir), HOLIDAY_FIRST, HOLIDAY_LAST)


@query("holiday_temperature", sql("holiday_temps", "SELECT * FROM holiday_temps"))
def holiday_temperature(spark, sf_dir):
    return trends.holiday_temperature(*_holiday_hours(spark, sf_dir), HOLIDAY_FIRST, HOLIDAY_LAST)


@query("holiday_temp_change", sql("holiday_temps", """
    SELECT holiday, min(yr) AS first_year, arg_min(avg_temp_celsius, yr) AS first_celsius, max(yr) AS last_year,
      arg_max(avg_temp_celsius, yr) AS last_celsius,
      round(arg_max(avg_temp_celsius, yr) - arg_min(avg_temp_celsius, yr), 2) + 0E0 AS change_celsius
    FROM holiday_temps GROUP BY holiday HAVING count(*) >= 2"""))
def holiday_temp_change(spark, sf_dir):
    return trends.holiday_temp_change(holiday_temperature(spark, sf_dir))


@query("missing_years", sql("parsed", f"""
    SELECT holiday, CAST(yr AS BIGINT) AS yr FROM (VALUES ('New Years Day'), ('Labor Day')) h(holiday), range(1993, 2003) t(yr)
    EXCEPT SELECT holiday, year(ts) FROM parsed WHERE holiday IN {_NAMES} AND year(ts) BETWEEN 1993 AND 2002"""))
def missing_years(spark, sf_dir):
    """A wider range than the data covers, so that years are in fact missing."""
    dates = trends.holiday_dates(inputs.parsed(spark, sf_dir), 1993, 2002)
    return trends.missing_years(dates, 1993, 2002)


# -- statistics ---------------------------------------------------------------
@query("descriptive_stats", sql("traffic_hourly", f"""
    SELECT count(*) AS n, {r('avg(traffic_volume)', 4)} AS mean, {r('stddev_samp(traffic_volume)', 4)} AS std,
      {r('var_samp(traffic_volume)', 4)} AS variance, min(traffic_volume) AS min, max(traffic_volume) AS max,
      max(traffic_volume) - min(traffic_volume) AS range, {r('median(traffic_volume)', 4)} AS median FROM traffic_hourly"""), digits=4)
def descriptive_stats(spark, sf_dir):
    return stats.descriptive_stats(inputs.hourly(spark, sf_dir))


@query("coef_variation", sql("traffic_hourly", f"""
    SELECT {r('stddev_samp(traffic_volume) / avg(traffic_volume)')} AS coef_variation,
      {r('avg(traffic_volume) - median(traffic_volume)')} AS mean_median_gap,
      CASE WHEN avg(traffic_volume) > median(traffic_volume) * 1.05E0 THEN 'right-skewed' ELSE 'fairly symmetric' END AS skew_note
    FROM traffic_hourly"""))
def coef_variation(spark, sf_dir):
    return stats.spread_notes(stats.descriptive_stats(inputs.hourly(spark, sf_dir)))


_DESCRIBED = ["temp", "temp_scaled", "clouds_all", "clouds_all_scaled", "traffic_volume"]


@query("describe_columns", sql("featured", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count({c}) AS n, {r(f'avg({c})', 5)} AS mean, {r(f'stddev_samp({c})', 5)} AS std,
      {r(f'min({c})', 5)} AS min, {r(f'max({c})', 5)} AS max, {r(f'quantile_cont({c}, 0.25)', 5)} AS q1,
      {r(f'median({c})', 5)} AS median, {r(f'quantile_cont({c}, 0.75)', 5)} AS q3 FROM featured""" for c in _DESCRIBED)), digits=5)
def describe_columns(spark, sf_dir):
    return stats.describe_columns(inputs.featured(spark, sf_dir), _DESCRIBED)


@query("drop_zero_temp", sql("traffic_hourly", """
    SELECT corridor, count(*) FILTER (temp > 0) AS kept, count(*) FILTER (NOT temp > 0) AS excluded,
      min(temp) FILTER (temp > 0) AS lowest FROM traffic_hourly GROUP BY corridor"""))
def drop_zero_temp(spark, sf_dir):
    good = F.col("temp") > S.IMPOSSIBLE_TEMP_KELVIN
    return inputs.hourly(spark, sf_dir).groupBy("corridor").agg(
        F.count_if(good).alias("kept"),
        F.count_if(~good).alias("excluded"),
        F.min(F.when(good, F.col("temp"))).alias("lowest"),
    )


@query("temp_volume_corr", sql("traffic_hourly", f"""
    SELECT {r('corr(temp, traffic_volume) FILTER (temp > 0)')} AS r, count(*) FILTER (temp > 0) AS n,
      count(*) FILTER (NOT temp > 0) AS n_excluded, {r('pow(corr(temp, traffic_volume) FILTER (temp > 0), 2)')} AS r_squared
    FROM traffic_hourly"""))
def temp_volume_corr(spark, sf_dir):
    return stats.correlation(inputs.hourly(spark, sf_dir))


def _p_values(groups: str, by: str) -> str:
    """SQL after a table of (by, r, n): the incomplete beta function by its continued fraction, one row a term."""
    return f"""
    , sized AS (SELECT *, (n - 2) / 2E0 AS a, 0.5E0 AS b, 1 - r * r AS x, 1 - r * r >= ((n - 2) / 2E0 + 1) / ((n - 2) / 2E0 + 2.5) AS swap FROM {groups}),
    turned AS (SELECT *, CASE WHEN swap THEN b ELSE a END AS p, CASE WHEN swap THEN a ELSE b END AS q, CASE WHEN swap THEN 1 - x ELSE x END AS z FROM sized),
    walk AS (
      SELECT {by}, p, q, z, 0 AS k, CAST(1 AS DOUBLE) AS c, 1 / (1 - (p + q) * z / (p + 1)) AS d, 1 / (1 - (p + q) * z / (p + 1)) AS v FROM turned
      UNION ALL
      SELECT {by}, p, q, z, k + 1, 1 + t / c, 1 / (1 + t * d), v * (1 + t / c) / (1 + t * d) FROM (
        SELECT *, CASE WHEN k % 2 = 0 THEN m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m))
          ELSE -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1)) END AS t
        FROM (SELECT *, CAST(k // 2 + 1 AS DOUBLE) AS m FROM walk WHERE k < 2000))),
    tested AS (
      SELECT g.*, CASE WHEN swap THEN 1 - f ELSE f END AS p_value FROM (
        SELECT t.*, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) * v / t.p AS f
        FROM turned t JOIN walk USING ({by}) WHERE k = 2000) g)"""


@query("temp_volume_corr_test", sql("traffic_hourly", f"""
    , whole AS (SELECT 1 AS one, corr(temp, traffic_volume) FILTER (temp > 0) AS r, count(*) FILTER (temp > 0) AS n, count(*) FILTER (NOT temp > 0) AS n_excluded FROM traffic_hourly)
    {_p_values('whole', 'one')}
    SELECT {r('r')} AS r, n, n_excluded, {r('r * r')} AS r_squared, {r('p_value')} AS p_value FROM tested""").replace("WITH ", "WITH RECURSIVE ", 1))
def temp_volume_corr_test(spark, sf_dir):
    """With the p-value."""
    return stats.correlation_test(stats.correlation(inputs.hourly(spark, sf_dir)))


_TESTED = ["temp", "clouds_all", "rain_1h", "snow_1h"]


@query("correlation_tests", sql("cleaned", f"""
    , pairs AS ({' UNION ALL '.join(f"SELECT corridor, '{f}' AS feature, {f} AS x, traffic_volume AS y FROM cleaned" for f in _TESTED)}),
    grouped AS (SELECT corridor, feature, corr(x, y) AS r, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS n FROM pairs GROUP BY 1, 2)
    {_p_values('grouped', 'corridor, feature')}
    SELECT corridor, feature, {r('r')} AS r, n, {r('p_value')} AS p_value FROM tested""").replace("WITH ", "WITH RECURSIVE ", 1))
def correlation_tests(spark, sf_dir):
    """Per corridor and reading: correlation with the volume and its p-value."""
    return stats.correlation_tests(inputs.cleaned(spark, sf_dir), _TESTED, by=["corridor"])


@query("corr_strength_band", sql("traffic_hourly", f"""
    , by_corridor AS (SELECT corridor, corr(temp, traffic_volume) AS c, count(*) AS n FROM traffic_hourly WHERE temp > 0 GROUP BY 1)
    SELECT corridor, {r('c')} AS r, CASE WHEN abs(c) < 0.1 THEN 'negligible' WHEN abs(c) < 0.3 THEN 'weak' WHEN abs(c) < 0.5 THEN 'moderate'
      WHEN abs(c) < 0.7 THEN 'strong' ELSE 'very strong' END AS strength,
      CASE WHEN c > 0 THEN 'positive' ELSE 'negative' END AS direction FROM by_corridor"""))
def corr_strength_band(spark, sf_dir):
    by_corridor = (
        stats.plausible_temp(inputs.hourly(spark, sf_dir))
        .groupBy("corridor")
        .agg(F.corr("temp", F.col("traffic_volume").cast("double")).alias("r"))
    )
    return stats.correlation_notes(by_corridor)


@query("linear_trend", sql("traffic_hourly", f"""
    SELECT {r('regr_slope(traffic_volume, temp)', 5)} AS slope, {r('regr_intercept(traffic_volume, temp)', 3)} AS intercept,
      min(temp) AS x_min, max(temp) AS x_max FROM traffic_hourly WHERE temp > 0"""))
def linear_trend(spark, sf_dir):
    fit = stats.linear_trend(stats.plausible_temp(inputs.hourly(spark, sf_dir)))
    return fit.withColumns({"slope": F.round("slope", 5), "intercept": F.round("intercept", 3)})


def _histogram_sql(table: str, bins: int) -> str:
    return f"""
    , b AS (SELECT min(traffic_volume)::DOUBLE AS lo, max(traffic_volume)::DOUBLE AS hi, avg(traffic_volume) AS m, median(traffic_volume) AS md FROM {table}),
    f AS (SELECT least(floor((traffic_volume - lo) * {bins} / (hi - lo)), {bins - 1}) AS bin, count(*) AS n FROM {table}, b GROUP BY 1)
    SELECT CAST(k.bin AS BIGINT) AS bin, {r(f'lo + k.bin * ((hi - lo) / {bins})')} AS bin_start, {r(f'lo + (k.bin + 1) * ((hi - lo) / {bins})')} AS bin_end,
      coalesce(f.n, 0) AS n, {r('m')} AS mean_mark, {r('md')} AS median_mark
    FROM range({bins}) k(bin) CROSS JOIN b LEFT JOIN f ON f.bin = k.bin"""


@query("volume_histogram", sql("featured", _histogram_sql("featured", 40)))
def volume_histogram(spark, sf_dir):
    return stats.histogram(inputs.featured(spark, sf_dir), 40)


@query("volume_histogram_50", sql("traffic_hourly", _histogram_sql("traffic_hourly", 50)))
def volume_histogram_50(spark, sf_dir):
    return stats.histogram(inputs.hourly(spark, sf_dir), 50)


# -- probabilities --------------------------------------------------------------
def _condition_counts(spark, sf_dir):
    return probability.condition_counts(stats.plausible_temp(inputs.hourly(spark, sf_dir)))


@query("condition_flags", sql("traffic_hourly", """
    SELECT corridor, ts, traffic_volume > 5500 AS congested, weather_main = 'Clear' AS clear,
      weather_main = 'Clouds' AS cloudy, temp > 292 AS hot FROM traffic_hourly WHERE temp > 0"""))
def condition_flags(spark, sf_dir):
    return probability.condition_flags(stats.plausible_temp(inputs.hourly(spark, sf_dir))).select(
        "corridor", "ts", "congested", "clear", "cloudy", "hot"
    )


@query("probabilities", sql("conditions", f"""
    SELECT n, nc AS n_congested, nl AS n_clear, ncl AS n_congested_clear, {r('nc / n')} AS p_congested,
      {r('nl / n')} AS p_clear, {r('ncl / n')} AS p_both FROM conditions"""))
def probabilities(spark, sf_dir):
    return probability.probabilities(_condition_counts(spark, sf_dir))


@query("conditional_prob", sql("conditions", f"""
    SELECT {r('ncl / nc')} AS p_clear_given_congested, {r('nch / nc')} AS p_hot_given_congested FROM conditions"""))
def conditional_prob(spark, sf_dir):
    return probability.conditional_probabilities(_condition_counts(spark, sf_dir))


@query("independence_gap", sql("conditions", f"""
    SELECT {r('(nc / n) * (nl / n)')} AS expected, {r('ncl / n')} AS observed, {r('ncl / n - (nc / n) * (nl / n)')} AS gap,
      CASE WHEN abs(ncl / n - (nc / n) * (nl / n)) > 0.001 THEN 'not independent' ELSE 'appear independent' END AS verdict
    FROM conditions"""))
def independence_gap(spark, sf_dir):
    return probability.independence(_condition_counts(spark, sf_dir))


@query("odds_ratio", sql("conditions", f"""
    SELECT {rounded('odds_clear odds_cloudy odds_ratio')}, CASE WHEN odds_ratio > 0.7 AND odds_ratio < 1.4 THEN 'modest' ELSE 'meaningful' END AS effect,
      CASE WHEN abs(odds_ratio - 1) <= 0.05 THEN 'same' WHEN odds_ratio > 1 THEN 'higher' ELSE 'lower' END AS direction
    FROM (SELECT ncl / nullif(nl - ncl, 0) AS odds_clear, nck / nullif(nk - nck, 0) AS odds_cloudy,
            (ncl / nullif(nl - ncl, 0)) / (nck / nullif(nk - nck, 0)) AS odds_ratio FROM conditions)"""))
def odds_ratio(spark, sf_dir):
    return probability.odds_ratio(_condition_counts(spark, sf_dir))


@query("congestion_rate_by_weather", sql("traffic_hourly", f"""
    SELECT weather_main AS weather, count(*) AS n, {r('avg(CAST(traffic_volume > 5500 AS INT))')} AS rate
    FROM traffic_hourly WHERE temp > 0 GROUP BY 1 ORDER BY n DESC, weather LIMIT 6"""))
def congestion_rate_by_weather(spark, sf_dir):
    return probability.congestion_rate_by_weather(stats.plausible_temp(inputs.hourly(spark, sf_dir)))


# -- profiles --------------------------------------------------------------------
@query("hourly_profile", sql("timed", f"""
    SELECT hour, {r('avg(traffic_volume)')} AS mean_volume, count(*) AS n FROM timed GROUP BY hour"""))
def hourly_profile(spark, sf_dir):
    return profiles.hourly_profile(inputs.featured(spark, sf_dir))


@query("peak_hour", sql("timed", f"""
    , p AS (SELECT hour, avg(traffic_volume) AS m FROM timed GROUP BY hour)
    SELECT (SELECT hour FROM p ORDER BY m DESC, hour LIMIT 1) AS peak_hour, {r('max(m)')} AS peak_mean,
      (SELECT hour FROM p ORDER BY m, hour LIMIT 1) AS quietest_hour, {r('min(m)')} AS quietest_mean FROM p"""))
def peak_hour(spark, sf_dir):
    return profiles.peak_hour(inputs.featured(spark, sf_dir))


@query("hour_by_daytype_pivot", sql("timed", f"""
    SELECT hour, {r('avg(traffic_volume) FILTER (is_weekend = 0)')} AS weekday,
      {r('avg(traffic_volume) FILTER (is_weekend = 1)')} AS weekend FROM timed GROUP BY hour"""))
def hour_by_daytype_pivot(spark, sf_dir):
    return profiles.hour_by_day_type(inputs.featured(spark, sf_dir))


@query("weather_profile", sql("timed", f"""
    SELECT weather_main, {r('avg(traffic_volume)')} AS mean_volume, count(*) AS n FROM timed GROUP BY 1"""))
def weather_profile(spark, sf_dir):
    return profiles.weather_profile(inputs.featured(spark, sf_dir))


@query("weather_spread", sql("timed", f"""
    , p AS (SELECT weather_main AS w, avg(traffic_volume) AS m FROM timed GROUP BY 1)
    SELECT (SELECT w FROM p ORDER BY m DESC, w LIMIT 1) AS highest, (SELECT w FROM p ORDER BY m, w LIMIT 1) AS lowest,
      {r('max(m) - min(m)')} AS spread FROM p"""))
def weather_spread(spark, sf_dir):
    return profiles.weather_spread(inputs.featured(spark, sf_dir))


@query("weekday_vs_weekend", sql("timed", f"""
    SELECT {rounded('weekday_mean weekend_mean')}, {r('weekday_mean - weekend_mean')} AS difference,
      {r('100 * (weekday_mean - weekend_mean) / weekend_mean')} AS percent_of_weekend
    FROM (SELECT avg(traffic_volume) FILTER (is_weekend = 0) AS weekday_mean,
            avg(traffic_volume) FILTER (is_weekend = 1) AS weekend_mean FROM timed)"""))
def weekday_vs_weekend(spark, sf_dir):
    return profiles.weekday_vs_weekend(inputs.featured(spark, sf_dir))


@query("top_hours", sql("timed", f"""
    SELECT hour, {r('avg(traffic_volume)')} AS mean_volume, count(*) AS n FROM timed GROUP BY hour
    ORDER BY avg(traffic_volume) DESC, hour LIMIT 5"""))
def top_hours(spark, sf_dir):
    return profiles.top_hours(inputs.featured(spark, sf_dir), 5)


@query("travel_window", sql("timed", """
    SELECT corridor, ts, hour, traffic_volume FROM timed WHERE hour BETWEEN 6 AND 22"""))
def travel_window(spark, sf_dir):
    return profiles.travel_hours(inputs.featured(spark, sf_dir)).select("corridor", "ts", "hour", "traffic_volume")


@query("day_type_filter", sql("timed", "SELECT corridor, ts, traffic_volume FROM timed WHERE is_weekend = 1"))
def day_type_filter(spark, sf_dir):
    return inputs.featured(spark, sf_dir).filter("is_weekend = 1").select("corridor", "ts", "traffic_volume")


define("quiet", ["timed"], """
    SELECT * FROM (
      SELECT is_weekend, hour, avg(traffic_volume) AS m,
        row_number() OVER (PARTITION BY is_weekend ORDER BY avg(traffic_volume), hour) AS place
      FROM timed WHERE hour BETWEEN 6 AND 22 GROUP BY 1, 2) WHERE place <= 3""")


@query("recommend_history", sql("quiet", f"""
    SELECT CASE is_weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS day_type, place, hour,
      (hour + 1) % 24 AS until_hour, {r('m')} AS mean_volume FROM quiet"""))
def recommend_history(spark, sf_dir):
    return profiles.quietest_hours(inputs.featured(spark, sf_dir))


@query("recommend_history_message", sql("quiet", """
    , q AS (SELECT CASE is_weekend WHEN 1 THEN 'weekend' ELSE 'weekday' END AS day_type, hour, CAST(round(m) AS BIGINT) AS v FROM quiet WHERE place = 1)
    SELECT day_type, 'Quietest hour for a ' || day_type || ' trip: ' || lpad(hour::VARCHAR, 2, '0') || ':00-'
      || lpad(((hour + 1) % 24)::VARCHAR, 2, '0') || ':00, about ' || v::VARCHAR || ' vehicles' AS message FROM q"""))
def recommend_history_message(spark, sf_dir):
    from roadpulse.operators.scenarios import history_messages

    return history_messages(profiles.quietest_hours(inputs.featured(spark, sf_dir)))


@query("category_counts", sql("featured", f"""
    SELECT CAST(CASE congestion_category WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 3 END AS BIGINT) AS position,
      congestion_category, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()')} AS share FROM featured GROUP BY 1, 2"""))
def category_counts(spark, sf_dir):
    return profiles.category_counts(inputs.featured(spark, sf_dir))


@query("label_balance", sql("labelled", f"""
    SELECT high_risk, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()')} AS proportion FROM labelled GROUP BY 1"""))
def label_balance(spark, sf_dir):
    return profiles.label_balance(inputs.featured(spark, sf_dir))


# -- requests for a time -------------------------------------------------------------
define("requests", [], """
    SELECT CAST(o_custkey % 4 AS BIGINT) AS corridor, CASE WHEN o_orderkey % 1499 = 5 THEN 'sometime soon' ELSE
      strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_minutes(CAST(o_orderkey * 37 % 1440 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END AS requested
    FROM orders""")
define("answers", ["requests", "labelled"], """
    SELECT q.corridor, q.target, q.n_requests, b.ts AS before_ts, a.ts AS after_ts,
      CASE WHEN a.ts IS NULL OR (b.ts IS NOT NULL AND date_diff('second', b.ts, q.target) <= date_diff('second', q.target, a.ts))
           THEN b.ts ELSE a.ts END AS nearest_ts
    FROM (SELECT corridor, TRY_CAST(requested AS TIMESTAMP) AS target, count(*) AS n_requests FROM requests
          WHERE TRY_CAST(requested AS TIMESTAMP) IS NOT NULL GROUP BY 1, 2) q
    ASOF LEFT JOIN labelled b ON b.corridor = q.corridor AND q.target >= b.ts
    ASOF LEFT JOIN labelled a ON a.corridor = q.corridor AND q.target <= a.ts""")


@query("nearest_record", sql("answers", """
    SELECT q.corridor, q.target, q.n_requests, q.nearest_ts, l.traffic_volume, l.congestion_category, l.weather_main,
      l.weather_description, round(l.temp - 273.15E0, 1) + 0E0 AS celsius, l.is_weekend,
      abs(date_diff('second', q.nearest_ts, q.target)) AS seconds_off,
      abs(date_diff('second', q.nearest_ts, q.target)) > 3600 AS far
    FROM answers q JOIN labelled l ON l.corridor = q.corridor AND l.ts = q.nearest_ts"""))
def nearest_record(spark, sf_dir):
    good, _ = lookup.parse_requests(inputs.requests(spark, sf_dir))
    series = inputs.featured(spark, sf_dir).withColumn("celsius", F.round(C.celsius(F.col("temp")), 1))
    return lookup.nearest_record(
        series,
        good,
        ["traffic_volume", "congestion_category", "weather_main", "weather_description", "celsius", "is_weekend"],
    )


@query("rejected_request_times", sql("requests", """
    SELECT corridor, requested, 'not a valid date/time' AS reason FROM requests WHERE TRY_CAST(requested AS TIMESTAMP) IS NULL"""))
def rejected_request_times(spark, sf_dir):
    _, bad = lookup.parse_requests(inputs.requests(spark, sf_dir))
    return bad
