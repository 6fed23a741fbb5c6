"""Scoring and checking rows as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.contract import flag_rows
from tablewright.operators.models import Trained
from tablewright.operators.transforms import FittedTable
from tablewright.plans.score import score
from tablewright.spec import TableSpec


def score_stream(
    stream: DataFrame,
    trained: Trained,
    fitted: FittedTable,
    path: str,
    checkpoint: str,
    keep: Sequence[str] | None = None,
    once: bool = False,
    event_key: Sequence[str] | None = None,
    event_time: str | None = None,
    late: str = "10 minutes",
    bad: str | None = None,
) -> StreamingQuery:
    """Append scored rows to Parquet under ``path``. Stateless unless ``event_key`` and ``event_time`` ask for each
    event to be scored once, which keeps keys only as long as ``late``. ``once`` stops after what is there.

    A value that does not read as its type, or a label never seen, stops the stream. With ``bad`` such rows, and those that break
    another rule of the declaration, go there instead, with their ``problems``; the others are scored. Both sinks have a folder for
    each micro-batch, which a repeated batch overwrites, so every row is in one of them once.
    """
    if event_key and event_time:
        timed = stream.withColumn("__at", F.col(event_time).cast("timestamp"))  # times without a zone take the session's
        stream = timed.withWatermark("__at", late).dropDuplicatesWithinWatermark(list(event_key)).drop("__at")
    if bad is not None:
        columns = list(stream.columns)

        def write(batch: DataFrame, batch_id: int) -> None:
            flagged = fitted.unseen(flag_rows(batch, fitted.spec))
            flagged = flagged.withColumn("problems", F.concat("broken_rules", "unseen_labels")).select(*columns, "problems").persist()
            try:
                good = flagged.where(F.size("problems") == 0).drop("problems")
                score(good, trained, fitted, keep).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
                flagged.where(F.size("problems") > 0).write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")
            finally:
                flagged.unpersist()

        routed = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        return (routed.trigger(availableNow=True) if once else routed).start()
    writer = score(stream, trained, fitted, keep).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def quarantine_stream(
    stream: DataFrame, spec: TableSpec, good: str, bad: str, checkpoint: str, lenient: bool = False, once: bool = False
) -> StreamingQuery:
    """Rows that keep the contract go to ``good``, the others with their broken rules to ``bad``. Each micro-batch
    overwrites its own folder, so a repeated batch changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = flag_rows(batch, spec, lenient).persist()
        try:
            clean = flagged.where(F.size("broken_rules") == 0).drop("broken_rules")
            clean.write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
            flagged.where(F.size("broken_rules") > 0).write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")
        finally:
            flagged.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
