"""Structured Streaming twins of the batch operators."""

from flowlab.streaming.keyed import run_keyed_context  # noqa: F401
from flowlab.streaming.scoring import (  # noqa: F401
    alert_stream,
    run_stream_summary,
    score_stream,
    stream_score,
    stream_summary,
)
from flowlab.streaming.sources import csv_stream, json_stream, parquet_stream, start, unzoned, zoned  # noqa: F401
from flowlab.streaming.windows import run_source_context, stream_dedup  # noqa: F401
