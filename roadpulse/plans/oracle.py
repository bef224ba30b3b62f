"""Building blocks of the SQL statements the queries are checked against.

The SQL is written for DuckDB, independently of the DataFrame code: windows
over whole corridors, built-in quantiles and as-of joins, which are fine on
one machine.
"""

from __future__ import annotations

from roadpulse import schema as S

# Stand-in observation table, as documented in FIXTURES.md.
_RAW_BASE = """
 SELECT CAST(l_shipdate AS DATE) AS d, CAST(l_orderkey % 24 AS INT) AS h, CAST(l_suppkey % 4 AS INT) AS corridor,
        l_orderkey AS ok, l_partkey AS pk, l_linenumber AS ln,
        (l_partkey * 31 + l_linenumber) % 100 AS wb,
        isodow(CAST(l_shipdate AS DATE)) AS dw
 FROM lineitem"""

_RAW_WEATHER = """
 SELECT *, CASE WHEN wb<33 THEN 'Clear' WHEN wb<64 THEN 'Clouds' WHEN wb<76 THEN 'Rain' WHEN wb<83 THEN 'Mist'
   WHEN wb<88 THEN 'Snow' WHEN wb<92 THEN 'Drizzle' WHEN wb<95 THEN 'Haze' WHEN wb<97 THEN 'Thunderstorm'
   WHEN wb=97 THEN 'Fog' WHEN wb=98 THEN 'Smoke' ELSE 'Squall' END AS weather_main FROM raw_base"""

_RAW = """
 SELECT corridor,
  CASE WHEN month(d)=1 AND day(d)=1 THEN 'New Years Day' WHEN month(d)=9 AND day(d)<=7 AND dw=1 THEN 'Labor Day'
       WHEN month(d)=7 AND day(d)=4 THEN 'Independence Day' WHEN month(d)=12 AND day(d)=25 THEN 'Christmas Day' ELSE 'None' END AS holiday,
  CASE WHEN ok % 997 = 3 THEN 0.0E0 ELSE 265.0E0 + 4*(6-abs(month(d)-7)) + (pk % 10)*0.5E0 END AS temp,
  CASE WHEN ok % 4999 = 7 THEN 9831.25E0 WHEN weather_main IN ('Rain','Drizzle','Thunderstorm') THEN (pk % 40)*0.25E0 ELSE 0.0E0 END AS rain_1h,
  CASE WHEN weather_main='Snow' THEN (pk % 8)*0.0625E0 ELSE 0.0E0 END AS snow_1h,
  CAST((pk*7) % 101 AS BIGINT) AS clouds_all,
  weather_main,
  CASE WHEN weather_main='Clear' AND ln % 2 = 0 THEN 'Sky is Clear' WHEN weather_main='Clear' THEN ' sky is clear'
       WHEN weather_main='Squall' THEN 'SQUALLS' ELSE lower(weather_main) END AS weather_description,
  CASE WHEN ok % 1999 = 11 THEN 'not-a-date' ELSE CAST(d AS VARCHAR) || ' ' || lpad(CAST(h AS VARCHAR),2,'0') || ':00:00' END AS date_time,
  CAST(300 + (CASE WHEN dw>=6 THEN 250 ELSE 400 END) * (CASE WHEN abs(h-15)<12 THEN 12-abs(h-15) ELSE 0 END)
       + ((year(d)*372+month(d)*31+day(d))*37 + h*101 + corridor*53) % 1500 AS BIGINT) AS traffic_volume
 FROM raw_weather"""

_PARSED = """
 SELECT corridor, nullif(trim(holiday), 'None') AS holiday, temp, rain_1h, snow_1h, clouds_all, weather_main,
        lower(trim(weather_description)) AS weather_description, traffic_volume,
        TRY_CAST(date_time AS TIMESTAMP) AS ts
 FROM traffic_raw WHERE TRY_CAST(date_time AS TIMESTAMP) IS NOT NULL"""

_HOURLY = """
 SELECT corridor, ts, min(traffic_volume) AS traffic_volume, min(temp) AS temp, min(holiday) AS holiday,
        min(weather_main) AS weather_main
 FROM parsed GROUP BY corridor, ts"""

_FIRST = """
 SELECT * EXCLUDE (place), holiday IS NOT NULL AS is_holiday FROM (
  SELECT *, row_number() OVER (PARTITION BY corridor, ts ORDER BY holiday NULLS FIRST, temp, rain_1h, snow_1h,
         clouds_all, weather_main, weather_description, traffic_volume) AS place FROM parsed)
 WHERE place = 1"""

_CLEANED = """
 SELECT f.* REPLACE (
   CASE WHEN f.temp <= 0 THEN coalesce(t.m, f.temp) ELSE f.temp END AS temp,
   CASE WHEN f.rain_1h > 9000 THEN coalesce(r.m, f.rain_1h) ELSE f.rain_1h END AS rain_1h)
 FROM first_rows f
 LEFT JOIN (SELECT month(ts) AS mon, median(temp) AS m FROM first_rows WHERE temp > 0 GROUP BY 1) t ON t.mon = month(f.ts)
 LEFT JOIN (SELECT month(ts) AS mon, median(rain_1h) AS m FROM first_rows WHERE rain_1h <= 9000 GROUP BY 1) r ON r.mon = month(f.ts)"""

_PARAMS = """
 SELECT min(temp) AS temp_min, max(temp) AS temp_max, min(clouds_all) AS clouds_min, max(clouds_all) AS clouds_max,
        quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS q2,
        quantile_cont(traffic_volume, 0.75) AS q3
 FROM cleaned"""

_ONE_HOT = ", ".join(f"CAST(weather_main = '{w}' AS BIGINT) AS \"weather_{w}\"" for w in S.WEATHER_VALUES)

_TIMED = f"""
 SELECT *, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, CAST(isodow(ts) >= 6 AS BIGINT) AS is_weekend,
   sin(2*pi()*hour(ts)/24) AS hour_sin, cos(2*pi()*hour(ts)/24) AS hour_cos,
   sin(2*pi()*(isodow(ts)-1)/7) AS dow_sin, cos(2*pi()*(isodow(ts)-1)/7) AS dow_cos,
   {_ONE_HOT},
   CAST(weather_main IN ('Thunderstorm','Snow','Squall') AS BIGINT) AS is_severe_weather,
   CAST(weather_main IN ('Fog','Mist','Haze','Smoke') AS BIGINT) AS is_low_visibility,
   CAST(rain_1h > 0 OR snow_1h > 0 AS BIGINT) AS has_precipitation
 FROM cleaned"""

_FEATURED = """
 SELECT t.*, (t.temp - p.temp_min) / nullif(p.temp_max - p.temp_min, 0) AS temp_scaled,
   (t.clouds_all - p.clouds_min) / nullif(p.clouds_max - p.clouds_min, 0) AS clouds_all_scaled,
   CASE WHEN traffic_volume <= q1 THEN 'Low' WHEN traffic_volume <= q2 THEN 'Medium'
        WHEN traffic_volume <= q3 THEN 'High' ELSE 'Severe' END AS congestion_category
 FROM timed t, params p"""

_LABELLED = """
 SELECT *, CAST(congestion_category IN ('High','Severe') AND (is_severe_weather = 1 OR is_low_visibility = 1) AS BIGINT) AS high_risk
 FROM featured"""

_SPLIT = """
 SELECT *, position <= floor(0.8E0 * series_rows) AS is_train FROM (
  SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY ts) AS position,
         count(*) OVER (PARTITION BY corridor) AS series_rows FROM labelled)"""

_TEST_ROWS = """
 SELECT *, CASE WHEN place <= floor(test_rows / 2) THEN 1 ELSE 2 END AS half, place <= 200 AS in_first_n FROM (
  SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY ts) AS place,
         count(*) OVER (PARTITION BY corridor) AS test_rows FROM split WHERE NOT is_train)"""

_LAGS = ", ".join(
    f"lag(traffic_volume, {k}) OVER (PARTITION BY corridor ORDER BY ts) AS lag_{k}" for k in range(1, S.LOOKBACK + 1)
)
_LAGGED = f"SELECT * FROM (SELECT corridor, ts, traffic_volume, {_LAGS} FROM cleaned) WHERE lag_{S.LOOKBACK} IS NOT NULL"

_BASKETS = """
 SELECT CASE WHEN hour < 6 THEN 'Night' WHEN hour < 12 THEN 'Morning' WHEN hour < 18 THEN 'Afternoon' ELSE 'Evening' END AS time_of_day,
   CASE WHEN is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
   weather_main AS weather, congestion_category AS congestion
 FROM featured"""

_CTES: dict[str, tuple[list[str], str]] = {
    "raw_base": ([], _RAW_BASE),
    "raw_weather": (["raw_base"], _RAW_WEATHER),
    "traffic_raw": (["raw_weather"], _RAW),
    "parsed": (["traffic_raw"], _PARSED),
    "traffic_hourly": (["parsed"], _HOURLY),
    "first_rows": (["parsed"], _FIRST),
    "cleaned": (["first_rows"], _CLEANED),
    "params": (["cleaned"], _PARAMS),
    "timed": (["cleaned"], _TIMED),
    "featured": (["timed", "params"], _FEATURED),
    "labelled": (["featured"], _LABELLED),
    "split": (["labelled"], _SPLIT),
    "test_rows": (["split"], _TEST_ROWS),
    "lagged": (["cleaned"], _LAGGED),
    "baskets": (["featured"], _BASKETS),
}


def define(name: str, needs: list[str], body: str) -> None:
    """Add a shared sub-query."""
    _CTES[name] = (needs, body)


def sql(needs: str, select: str) -> str:
    """``select`` with the named sub-queries and all they depend on in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dependency in _CTES[name][0]:
            add(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        add(name)
    parts = ",\n".join(f"{name} AS MATERIALIZED ({_CTES[name][1]})" for name in ordered)
    return f"WITH {parts}\n{select}" if parts else select


def r(expression: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), {digits}) + 0E0)"


def rounded(names: str, digits: int = 6) -> str:
    """``round(x) AS x`` for a blank-separated list of columns."""
    return ", ".join(f'{r(name, digits)} AS "{name}"' for name in names.split())
