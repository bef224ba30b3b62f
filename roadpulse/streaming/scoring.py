"""Scoring scenario requests as they arrive."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse import schema as S
from roadpulse.operators import models, scenarios


def request_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(S.SCENARIO_SCHEMA).parquet(path)


def score_stream(
    requests: DataFrame, volume_model: PipelineModel, risk_model: PipelineModel, path: str, checkpoint: str
) -> StreamingQuery:
    """Valid requests go to ``scored`` with both answers, the rest to ``rejected`` with a reason.

    Each batch is written under its own number, so a batch repeated after a
    failure replaces its first attempt.  The models answer every valid scenario
    once, before the stream starts; requests look their answers up.  A batch is
    read for each of the two outputs instead of being kept.
    """
    answers = models.scenario_answers(requests.sparkSession, volume_model, risk_model)

    def write(batch: DataFrame, number: int) -> None:
        checked = scenarios.check_scenarios(batch)
        scored = scenarios.look_up(checked.filter("reason IS NULL"), answers)
        scored.select(
            "hour", "day_type", "weather", F.col("is_holiday").cast("int").alias("is_holiday"),
            "predicted_traffic_volume", "high_risk_probability", "high_risk_prediction",
        ).write.mode("overwrite").parquet(f"{path}/scored/batch={number}")
        checked.filter("reason IS NOT NULL").write.mode("overwrite").parquet(f"{path}/rejected/batch={number}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
