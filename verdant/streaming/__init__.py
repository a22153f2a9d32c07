"""Structured Streaming jobs over the shared operators."""

from verdant.streaming.job import (  # noqa: F401
    run_streaming_job,
    start_rejects_query,
    start_table_queries,
    stream_aggregates,
)
from verdant.streaming.progress import BatchReportListener, batch_summary  # noqa: F401
from verdant.streaming.ingest import start_crop_ingest, start_weather_ingest, weather_events_stream  # noqa: F401
