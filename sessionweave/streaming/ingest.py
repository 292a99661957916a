"""File streams that run to the end of what is there, with checkpoints in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def shared(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; where that is unset, a temporary one on a local master alone."""
    root, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not root and not re.match(r"local(\[[^\]]*\])?$", master):
        raise ValueError(f"spark.checkpoint.dir is not set, and executors of {master} share no folder with the driver")
    root = root or "file://" + tempfile.mkdtemp(prefix="stream-")
    return f"{root.rstrip('/')}/stream-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """Stream of the Parquet files of a table, which may be one file."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    one = not spark.read.parquet(path).select(F.input_file_name()).limit(1).collect()[0][0].rpartition("/")[0].endswith(name)
    source = spark.readStream.schema(schema)
    return source.option("pathGlobFilter", name).parquet(folder) if one else source.parquet(path)


def drain(stream: DataFrame, root: str) -> DataFrame:
    """Run a stream to the end of its input into Parquet files, exactly once, and read them."""
    query = (
        stream.writeStream.outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").start(f"{root}/out", format="parquet")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def count_by(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Counts of a column over a file stream: partial counts a batch, summed at the end."""
    root = shared(spark)

    def batch(rows: DataFrame, number: int) -> None:
        # Writing by batch number makes a repeated batch overwrite itself.
        rows.groupBy(key).count().write.mode("overwrite").parquet(f"{root}/counts/batch={number}")

    query = file_stream(spark, path).select(key).writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(batch).start()
    query.awaitTermination()
    return spark.read.parquet(f"{root}/counts").groupBy(key).agg(F.sum("count").alias("n"))


def episode_step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counts of an episode's events and errors so far, and whether an error stands unanswered."""
    events, errors, last_error, last_good = state.get if state.exists else (0, 0, -1, -1)
    for f in frames:
        bad = f["event_type"] == "error"
        events, errors = events + len(f), errors + int(bad.sum())
        last_error = max(last_error, int(f["micros"].where(bad, -1).max()))
        last_good = max(last_good, int(f["micros"].where(~bad, -1).max()))
    state.update((events, errors, last_error, last_good))
    yield pd.DataFrame({"user_id": [key[0]], "events": [events], "errors": [errors], "open": [last_error > last_good]})


def episode_states(spark: SparkSession, path: str) -> DataFrame:
    """Last state of every episode of an event stream, kept in the state store by user."""
    stream = file_stream(spark, path).select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    kept = stream.groupBy("user_id").applyInPandasWithState(
        episode_step, "user_id bigint, events bigint, errors bigint, open boolean", "events bigint, errors bigint, last_error bigint, last_good bigint",
        "append", GroupStateTimeout.NoTimeout,
    )
    return drain(kept, shared(spark)).groupBy("user_id").agg(F.max_by(F.struct("errors", "open"), "events").alias("s"), F.max("events").alias("events")).select(
        "user_id", "events", "s.errors", "s.open"
    )
