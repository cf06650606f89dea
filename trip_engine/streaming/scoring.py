"""Continuous scoring of requests (OP-28, OP-74).

The original service answers one HTTP request with one Spark job. Here the
requests arrive as a stream (a folder of JSON lines; Kafka in production),
every micro-batch is validated, the valid records scored with the persisted
pipeline and the rest sent to a dead-letter output with the reason.

Both outputs of a micro-batch count together or not at all. Each try writes into
folders of its own, and when both are complete one small commit record naming the try is
put in place by a rename. ``read_scored`` reads the tries that have a record, so
neither a batch cut off between its two writes nor a batch written twice
(``foreachBatch`` is at-least-once) is ever seen. A batch that has its record is
not scored again, and what earlier tries of it left is deleted.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trip_engine.functions.exprs import shape_duration
from trip_engine.operators.filters import tag_required
from trip_engine.sources.requests import MALFORMED, RAW, WRONG_TYPE
from trip_engine.specs import LABEL, MISSING_KEY_MESSAGE, MODEL_FEATURES, REQUEST_ID

REQUIRED_KEYS = (REQUEST_ID, *MODEL_FEATURES)


MALFORMED_MESSAGE = "Malformed record"
WRONG_TYPE_MESSAGE = "Wrong type: "
REASON = "reject_reason"


def tag_requests(requests: DataFrame, keys=REQUIRED_KEYS, message: str = MISSING_KEY_MESSAGE) -> DataFrame:
    """OP-28: every request with its ``reject_reason`` (NULL: accepted), in one
    pass. A record that is not a JSON object is malformed; a field of the wrong type is
    told from a missing one where the requests come from ``parse_requests``."""
    if MALFORMED not in requests.columns:
        return tag_required(requests, list(keys), message, REASON)
    each = F.concat_ws("; ", *[  # leaves out NULLs
        F.when(F.array_contains(WRONG_TYPE, k), F.lit(f"{WRONG_TYPE_MESSAGE}{k}"))
         .when(F.col(k).isNull(), F.lit(message.format(key=k))) for k in keys])
    return requests.withColumn(REASON, F.when(F.col(MALFORMED), F.lit(MALFORMED_MESSAGE))
                               .when(each != "", each))


def validate_requests(requests: DataFrame, keys=REQUIRED_KEYS,
                      message: str = MISSING_KEY_MESSAGE) -> tuple[DataFrame, DataFrame]:
    """OP-28: (accepted, rejected-with-reason). Without ``keys`` the requests are tagged already."""
    tagged = requests if keys is None else tag_requests(requests, keys, message)
    extra = [c for c in (MALFORMED, WRONG_TYPE) if c in tagged.columns]
    return (tagged.filter(F.col(REASON).isNull()).drop(REASON, RAW, *extra),
            tagged.filter(F.col(REASON).isNotNull()).drop(*extra))


def score_batch(batch: DataFrame, model: PipelineModel, shape: str = "raw",
                keys=REQUIRED_KEYS) -> tuple[DataFrame, DataFrame]:
    """Score one batch of requests: (predictions, rejects). Rejects carry the
    record as it came, where it is known."""
    accepted, rejected = validate_requests(batch, keys)
    preds = model.transform(accepted).select(
        REQUEST_ID, shape_duration("prediction", shape).alias(f"predicted_{LABEL}"))
    return preds, rejected


def outcome_columns(batch: DataFrame) -> DataFrame:
    """The requests tagged, with what the two outputs need: the record as it came goes to
    the rejects only, so accepted requests do without it."""
    tagged = tag_requests(batch).drop(MALFORMED, WRONG_TYPE)
    return tagged.withColumn(RAW, F.when(F.col(REASON).isNotNull(), F.col(RAW))) if RAW in tagged.columns else tagged


# Beside the predictions; readers of the folder skip names that begin with an underscore.
COMMITS = "_commits"


class BatchCommits:
    """The commit records of a stream's micro-batches: one JSON file per batch, which
    appears complete (written under another name, then renamed)."""

    def __init__(self, spark: SparkSession, out_path: str):
        self.folder = os.path.join(out_path, COMMITS)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _record(self, batch_id: int):
        return self._path(os.path.join(self.folder, f"batch-{batch_id}.json"))

    def done(self, batch_id: int) -> bool:
        return self._fs.exists(self._record(batch_id))

    def any(self) -> bool:
        return bool(self._fs.globStatus(self._path(os.path.join(self.folder, "batch-*.json"))))

    def commit(self, batch_id: int, attempt: str, rows: dict[str, int]) -> None:
        beside = self._path(os.path.join(self.folder, f".{batch_id}-{attempt}"))
        out = self._fs.create(beside, True)
        try:
            out.write(bytearray(json.dumps({"batch": batch_id, "attempt": attempt, **rows}) + "\n", "utf-8"))
        finally:
            out.close()
        if not self._fs.rename(beside, self._record(batch_id)) and not self.done(batch_id):
            raise RuntimeError(f"batch {batch_id} could not be committed")

    def discard_tries(self, path: str, batch_id: int, but: str | None = None) -> None:
        """Delete what the tries of a batch have written under ``path``."""
        folder = self._path(os.path.join(path, f"batch={batch_id}"))
        if self._fs.exists(folder):
            for found in self._fs.listStatus(folder):
                if found.getPath().getName() != f"attempt={but}":
                    self._fs.delete(found.getPath(), True)


def write_scored_batch(batch: DataFrame, batch_id: int, model: PipelineModel, out_path: str, rejects_path: str,
                       shape: str = "raw") -> None:
    """Score one micro-batch and commit both outputs together."""
    commits = BatchCommits(batch.sparkSession, out_path)
    if commits.done(batch_id):
        return  # a replay of a batch that is out already
    attempt = f"t{uuid.uuid4().hex}"  # a letter first: never read as a number
    batch = outcome_columns(batch).persist()
    try:
        for path, rows in zip((out_path, rejects_path), score_batch(batch, model, shape, None)):
            rows.write.mode("errorifexists").parquet(os.path.join(path, f"batch={batch_id}", f"attempt={attempt}"))
        commits.commit(batch_id, attempt, {"requests": batch.count()})
    finally:
        batch.unpersist()
    for path in (out_path, rejects_path):
        commits.discard_tries(path, batch_id, but=attempt)


def score_stream(requests: DataFrame, model: PipelineModel, out_path: str, rejects_path: str,
                 checkpoint: str, shape: str = "raw", available_now: bool = False,
                 processing_time: str | None = None) -> StreamingQuery:
    """OP-74: start the scoring query. ``available_now`` drains what is there
    and stops (tests, backfills); otherwise it runs on ``processing_time``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_scored_batch(batch, batch_id, model, out_path, rejects_path, shape)

    writer = (requests.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_commits(spark: SparkSession, out_path: str) -> DataFrame:
    """(batch, attempt, requests) of the committed micro-batches."""
    schema = "batch long, attempt string, requests long"
    if not BatchCommits(spark, out_path).any():
        return spark.createDataFrame([], schema)
    # the folder's own name hides it from readers of the folder above, not from a direct read
    return spark.read.schema(schema).json(os.path.join(out_path, COMMITS))


def read_scored(spark: SparkSession, out_path: str, rejects_path: str) -> DataFrame:
    """Both outputs of ``score_stream`` as one frame, committed batches only:
    id, status, predicted_trip_duration, reject_reason. The commit records (one row a
    batch) select the folders."""
    none = {f"predicted_{LABEL}": "double", "reject_reason": "string"}
    parts = []
    commits = read_commits(spark, out_path).select("batch", "attempt")
    for path, status in ((out_path, "accepted"), (rejects_path, "rejected")):
        if commits.isEmpty():
            rows = spark.createDataFrame([], f"{REQUEST_ID} string, predicted_{LABEL} double, reject_reason string")
        else:
            # written tries without a record are left out here, and their files by partition pruning
            rows = spark.read.parquet(path).withColumns(
                {"batch": F.col("batch").cast("long"), "attempt": F.col("attempt").cast("string")}
            ).join(commits, ["batch", "attempt"], "left_semi")
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in none.items() if c not in rows.columns})
        parts.append(rows.select(REQUEST_ID, F.lit(status).alias("status"), *none))
    return parts[0].unionByName(parts[1])
