"""Point-in-time features of the event stream on a daily spine (trailing
24 h / 7 d / 30 d windows, recency)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.operators.pit import Feature, point_in_time_features

EVENT_COLUMNS = ["user_id", "snapshot_date", "events_lifetime", "events_last_24h", "events_last_7d",
                 "value_last_7d", "distinct_event_types_7d", "purchases_lifetime", "error_rate_lifetime",
                 "avg_value_lifetime", "max_value_30d", "days_since_first_event", "days_since_last_event"]


#: event types at most; a stream with more fails the query
EVENT_TYPES = 64


def event_feature_set() -> list[Feature]:
    et = F.col("event_type")
    return [
        Feature("events_lifetime", "count", "event_id"),
        Feature("events_last_24h", "count", "event_id", window="24 hours"),
        Feature("events_last_7d", "count", "event_id", window="7 days"),
        Feature("value_last_7d", "sum", "value", window="7 days", default=0.0),
        Feature("distinct_event_types_7d", "count_distinct", "event_type", window="7 days", domain=EVENT_TYPES),
        Feature("purchases_lifetime", "count", "event_id", where=et == "purchase"),
        Feature("error_rate_lifetime", "rate", "event_id", where=et == "error"),
        Feature("avg_value_lifetime", "avg", "value"),
        Feature("max_value_30d", "max", "value", window="30 days"),
        Feature("days_since_first_event", "days_since_min"),
        Feature("days_since_last_event", "days_since_max"),
    ]


def event_features(events: DataFrame, lead: str = "1 day", distinct: str = "coverage") -> DataFrame:
    facts = events.select("event_id", "user_id", "ts", "event_type", "value")
    return point_in_time_features(facts, "user_id", "ts", event_feature_set(), unit="day",
                                  lead=lead, distinct=distinct).select(*EVENT_COLUMNS)
