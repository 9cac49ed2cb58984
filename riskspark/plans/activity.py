"""Latest activity per merchant (C11): the event union shared by the batch
analysis and its Structured Streaming form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def activity_events(login: DataFrame, page_click: DataFrame, mobile_click: DataFrame,
                    legacy: DataFrame | None) -> DataFrame:
    """(merchant_token, at) rows from every activity source: successful
    logins count by day, clicks by time, legacy activity as recorded (when
    ``legacy`` is given)."""
    logins = (login.where(F.col("merchant_token").isNotNull() & (F.col("success") == F.lit(True)))
              .select("merchant_token", F.to_date("recorded_at").cast("timestamp_ntz").alias("at")))
    clicks = [c.where(F.col("merchant_token").isNotNull())
              .select("merchant_token", F.col("recorded_at").alias("at"))
              for c in (page_click, mobile_click)]
    events = logins.unionByName(clicks[0]).unionByName(clicks[1])
    if legacy is None:
        return events
    return events.unionByName(legacy.select("merchant_token", F.col("last_activity_at").alias("at")))


def latest_activity(events: DataFrame) -> DataFrame:
    return (events.groupBy(F.col("merchant_token").alias("subject_merchant_token"))
            .agg(F.max("at").alias("last_activity_date")))
