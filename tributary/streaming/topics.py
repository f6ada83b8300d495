"""Many topics to parquet under one supervisor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tributary.schemas import TAXI_TOPICS
from tributary.streaming.ingest import parquet_sink, parse_json_values, with_event_watermark
from tributary.streaming.supervisor import supervise

WATERMARK_COLUMN = "timestamp"
WATERMARK_DELAY = "2 minutes"


def topic_frames(raw: dict[str, DataFrame], schemas: dict = TAXI_TOPICS) -> dict[str, DataFrame]:
    """Each topic's ``value`` parsed by its declared schema; the watermark
    is set only on topics that have the event-time column."""
    out = {}
    for topic, df in raw.items():
        schema, _ = schemas[topic]
        parsed = parse_json_values(df, schema)
        if WATERMARK_COLUMN in parsed.columns:
            parsed = with_event_watermark(parsed, WATERMARK_COLUMN, WATERMARK_DELAY)
        out[topic] = parsed
    return out


def run_topics(spark: SparkSession, raw: dict[str, DataFrame], out_base: str, ck_base: str,
               available_now: bool = True) -> list[StreamingQuery]:
    """Start one parquet sink per topic (own checkpoint) and supervise them:
    when one fails, to start or later, the others are stopped and the error
    is raised."""
    qs: list[StreamingQuery] = []
    try:
        for t, df in topic_frames(raw).items():
            qs.append(parquet_sink(df, f"{out_base}/{t}", f"{ck_base}/{t}", available_now, query_name=None))
    except Exception:
        for q in qs:
            q.stop()
        raise
    supervise(spark, qs)
    return qs
