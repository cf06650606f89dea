"""Scoring job (OP-93): a folder of JSON requests -> predictions and rejects."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from trip_engine.operators.model import load_model
from trip_engine.sources.requests import read_requests
from trip_engine.streaming.scoring import score_stream


def run(spark: SparkSession, requests_path: str, model_path: str, output_path: str, rejects_path: str,
        checkpoint: str, shape: str = "raw", available_now: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """Start the query on the saved model; ``available_now`` drains the folder and stops."""
    return score_stream(read_requests(spark, requests_path, streaming=True), load_model(model_path), output_path,
                        rejects_path, checkpoint, shape, available_now, None if available_now else every)
