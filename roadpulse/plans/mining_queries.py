"""Itemsets, rules, cluster tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.functions import columns as C
from roadpulse.operators import clustering, mining
from roadpulse.plans import inputs
from roadpulse.plans.oracle import define, r, rounded, sql
from roadpulse.plans.registry import query

define("itemsets", ["baskets"], """
    SELECT mask, t, d, w, c, n, n / total AS support FROM (
      SELECT 15 - CAST(GROUPING(time_of_day, day_type, weather, congestion) AS BIGINT) AS mask,
        coalesce(time_of_day, '*') AS t, coalesce(day_type, '*') AS d, coalesce(weather, '*') AS w, coalesce(congestion, '*') AS c,
        count(*) AS n, (SELECT count(*) FROM baskets) AS total
      FROM baskets GROUP BY CUBE (time_of_day, day_type, weather, congestion))
    WHERE mask > 0 AND n / total >= 0.02""")


def _items(mask: str) -> str:
    named = [
        f"CASE WHEN {mask} & {bit} > 0 THEN '{name}_' || s.{column} END"
        for name, bit, column in [("time_of_day", 8, "t"), ("day_type", 4, "d"), ("weather", 2, "w"), ("congestion", 1, "c")]
    ]
    return f"list_sort(list_filter([{', '.join(named)}], lambda x: x IS NOT NULL))"


def _match(mask: str, alias: str) -> str:
    pairs = [("t", 8), ("d", 4), ("w", 2), ("c", 1)]
    return f"{alias}.mask = {mask} AND " + " AND ".join(
        f"{alias}.{column} = CASE WHEN {mask} & {bit} > 0 THEN s.{column} ELSE '*' END" for column, bit in pairs
    )


define("rules", ["itemsets"], f"""
    SELECT * FROM (
      SELECT {_items('p.a')} AS antecedents, {_items('(s.mask - p.a)')} AS consequents, a.support AS antecedent_support,
        b.support AS consequent_support, s.support, s.support / a.support AS confidence,
        (s.support / a.support) / b.support AS lift
      FROM itemsets s JOIN (SELECT CAST(x AS BIGINT) AS a FROM range(1, 15) g(x)) p ON p.a < s.mask AND (p.a & s.mask) = p.a
      JOIN itemsets a ON {_match('p.a', 'a')} JOIN itemsets b ON {_match('(s.mask - p.a)', 'b')})
    WHERE lift >= 1""")


@query("baskets", sql("baskets", "SELECT time_of_day, day_type, weather, congestion, count(*) AS n FROM baskets GROUP BY ALL"))
def baskets(spark, sf_dir):
    return mining.baskets(inputs.featured(spark, sf_dir)).groupBy(*mining.ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("frequent_itemsets", sql("itemsets", f"""
    SELECT mask, t AS time_of_day, d AS day_type, w AS weather, c AS congestion, n, {r('support')} AS support FROM itemsets"""))
def frequent_itemsets(spark, sf_dir):
    return mining.frequent_itemsets(mining.baskets(inputs.featured(spark, sf_dir)))


@query("pattern_itemsets", sql("itemsets", f"""
    SELECT array_to_string({_items('s.mask')}, ', ') AS items, n, {r('support')} AS support FROM itemsets s"""))
def pattern_itemsets(spark, sf_dir):
    """The same sets found by frequent-pattern trees."""
    found = mining.pattern_itemsets(mining.named_items(mining.baskets(inputs.featured(spark, sf_dir))))
    return found.withColumn("items", F.array_join("items", ", "))


def _rules(spark, sf_dir):
    return mining.association_rules(frequent_itemsets(spark, sf_dir))


@query("association_rules", sql("rules", f"""
    SELECT array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents,
      {rounded('antecedent_support consequent_support support confidence lift')} FROM rules"""))
def association_rules(spark, sf_dir):
    return _rules(spark, sf_dir).withColumns({
        "antecedents": F.array_join("antecedents", ", "), "consequents": F.array_join("consequents", ", "),
    })


def _top_sql(wanted: str, n: int) -> str:
    return f"""
    SELECT array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents,
      {rounded('support confidence')}, {r('lift')} AS lift FROM rules
    WHERE list_has_any(consequents, [{wanted}])
    ORDER BY round(rules.lift, 9) DESC, array_to_string(antecedents, ', '), array_to_string(consequents, ', ') LIMIT {n}"""


@query("rules_for_target", sql("rules", _top_sql(
    "'congestion_Low', 'congestion_Medium', 'congestion_High', 'congestion_Severe'", 8)))
def rules_for_target(spark, sf_dir):
    return mining.rules_for_target(_rules(spark, sf_dir), top=8)


@query("rules_for_high_congestion", sql("rules", _top_sql("'congestion_High', 'congestion_Severe'", 5)))
def rules_for_high_congestion(spark, sf_dir):
    return mining.rules_for_target(_rules(spark, sf_dir), ["High", "Severe"], 5)


# -- clusters ------------------------------------------------------------------------
_SEVERITY = """CASE WHEN weather_main = 'Clear' THEN 0 WHEN weather_main = 'Clouds' THEN 1 WHEN weather_main IN ('Drizzle', 'Mist', 'Haze') THEN 2
   WHEN weather_main IN ('Rain', 'Fog', 'Smoke') THEN 3 WHEN weather_main IN ('Snow', 'Thunderstorm', 'Squall') THEN 4 END"""
define("points", ["timed"], f"SELECT corridor, ts, hour, {_SEVERITY} AS weather_severity, traffic_volume FROM timed")
# Given labels stand in for fitted ones where SQL has to reproduce the result.
define("clustered", ["points"], """
    SELECT *, CASE WHEN hour < 6 THEN 0 WHEN traffic_volume > 3000 THEN 1 ELSE 2 END AS cluster FROM points""")


def _given_clusters(spark, sf_dir):
    given = F.when(F.col("hour") < 6, 0).when(F.col("traffic_volume") > 3000, 1).otherwise(2)
    return clustering.cluster_features(inputs.featured(spark, sf_dir)).withColumn("cluster", given)


@query("zscore", sql("points", " ".join([f"""
    SELECT corridor, ts, {r('(hour - a) / b')} AS hour_z, {r('(weather_severity - c) / d')} AS weather_severity_z,
      {r('(traffic_volume - e) / f')} AS traffic_volume_z FROM points,
      (SELECT avg(hour) AS a, stddev_pop(hour) AS b, avg(weather_severity) AS c, stddev_pop(weather_severity) AS d,
         avg(traffic_volume) AS e, stddev_pop(traffic_volume) AS f FROM points)"""])))
def zscore(spark, sf_dir):
    points = clustering.cluster_features(inputs.featured(spark, sf_dir))
    return clustering.standardise(points).select("corridor", "ts", *[f"{c}_z" for c in clustering.CLUSTER_COLUMNS])


@query("cluster_summary", sql("clustered", """
    SELECT CAST(cluster AS BIGINT) AS cluster, round(avg(hour), 1) AS hour, round(avg(weather_severity), 1) AS weather_severity,
      round(avg(traffic_volume), 1) AS traffic_volume, count(*) AS n_hours FROM clustered GROUP BY cluster"""))
def cluster_summary(spark, sf_dir):
    return clustering.cluster_summary(_given_clusters(spark, sf_dir))


@query("cluster_describe", sql("clustered", """
    SELECT CAST(cluster AS BIGINT) AS cluster, CASE WHEN h < 6 OR h > 21 THEN 'overnight/off-peak' WHEN h < 16 THEN 'daytime/commute-adjacent' ELSE 'evening peak' END
      || '; ' || CASE WHEN s < 1 THEN 'clear/mild' WHEN s < 2 THEN 'cloudy' WHEN s < 3 THEN 'wet/reduced-visibility' ELSE 'severe weather' END
      || '; ' || CASE WHEN v < 2000 THEN 'low' WHEN v < 4500 THEN 'moderate' ELSE 'high' END || ' volume, ' || CAST(CAST(round(v, 0) AS BIGINT) AS VARCHAR) || ' vehicles an hour' AS label
    FROM (SELECT cluster, round(avg(hour), 1) AS h, round(avg(weather_severity), 1) AS s, round(avg(traffic_volume), 1) AS v FROM clustered GROUP BY 1)"""))
def cluster_describe(spark, sf_dir):
    return clustering.cluster_summary(_given_clusters(spark, sf_dir)).select(
        "cluster",
        C.cluster_label(F.col("hour"), F.col("weather_severity"), F.col("traffic_volume")).alias("label"),
    )
