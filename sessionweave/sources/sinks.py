"""Sinks: JSON lines with a description, routed partitions, reviewed and filtered copies, manifests, Markdown and bundles."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.operators.records import Cleaner, canonical
from sessionweave.sources.files import describe


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def json_lines(rows: DataFrame, path: str, overwrite: bool = False, order: list[str] | None = None) -> dict:
    """One canonical JSON object a line; all or nothing, and refused where something stands already.  Returns the description.

    With an order, lines are sorted over all files (by range, so no task holds
    them all); a struct's fields are written by name.
    """
    if order:
        rows = rows.orderBy(*order)
    text = rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("value"))
    text.write.mode("overwrite" if overwrite else "errorifexists").text(path)
    return describe(rows.sparkSession, path)


def raw_lines(lines: DataFrame, path: str, by: list[str], value: str = "value") -> None:
    """Lines byte for byte, in a folder a value of the routing columns."""
    lines.select(F.col(value).alias("value"), *by).write.mode("errorifexists").partitionBy(*by).text(path)


def reviewed_lines(lines: DataFrame, accepted: DataFrame, key: str, path: str) -> dict:
    """Raw lines of accepted units alone."""
    lines.join(accepted.select(key).distinct(), key, "left_semi").select("value").write.mode("errorifexists").text(path)
    return describe(lines.sparkSession, path)


def redacted_lines(lines: DataFrame, path: str, redact: Callable[[str], tuple[str, int]] | None = None, value: str = "value") -> dict:
    """Lines written again with every string through ``redact``; counts of what it did come with the description."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, hits = [], []
            for t in b["v"].to_pylist():
                c = Cleaner(redact)
                out.append(canonical(c.value(json.loads(t))))
                hits.append(c.counts["redactions"])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), pa.array(hits, pa.int64())], ["value", "hits"])

    done = lines.select(F.col(value).alias("v")).mapInArrow(run, "value string, hits bigint")
    spark = lines.sparkSession
    done.write.mode("errorifexists").parquet(f"{path}/redacted")  # worked out once, for both what is written and what is counted
    kept = spark.read.schema(done.schema).parquet(f"{path}/redacted")
    kept.select("value").write.text(f"{path}/lines")
    sums = kept.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("redactions"), F.count_if(F.col("hits") > 0).alias("changed")).first()
    return describe(spark, f"{path}/lines") | {"redactions": sums.redactions, "changed": sums.changed}


def small_file(spark: SparkSession, path: str, data: bytes, overwrite: bool = False) -> None:
    """A small file, whole or not at all: written beside, then renamed."""
    jvm, where, fs = _fs(spark, path)
    if fs.exists(where):
        if not overwrite:
            raise FileExistsError(path)
        fs.delete(where, False)
    beside = jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if not fs.rename(beside, where):
        raise OSError(f"cannot rename to {path}")


def manifest(spark: SparkSession, path: str, content: dict, overwrite: bool = False) -> None:
    """A manifest as readable JSON with sorted keys."""
    small_file(spark, path, (json.dumps(content, ensure_ascii=False, indent=2, sort_keys=True) + "\n").encode(), overwrite)


def release(parts: dict[str, DataFrame], folder: str, order: list[str], **more) -> dict:
    """A release: a file a split, and the manifest that describes them."""
    spark = next(iter(parts.values())).sparkSession
    outputs = {f"{name}.jsonl": json_lines(df, f"{folder}/{name}.jsonl", order=order) for name, df in parts.items()}
    content = {"outputs": outputs} | more
    manifest(spark, f"{folder}/manifest.json", content)
    return content


def ended_traces(events: DataFrame, states: DataFrame, path: str) -> dict:
    """Event lines of episodes that ended; open ones are refused by name."""
    open_ = [r.episode for r in states.filter("ended is null").select("episode").limit(5).collect()]
    if open_:
        raise ValueError(f"episodes have not ended: {', '.join(open_)}")
    return json_lines(events, path, order=["episode", "ordinal"])


def markdown(spark: SparkSession, skills: list[dict], folder: str, overwrite: bool = False) -> list[str]:
    """One file a skill (a validated, short list): front matter and body."""
    out = []
    for s in skills:
        text = f"---\nname: {s['name']}\ndescription: {json.dumps(s['description'], ensure_ascii=False)}\n---\n\n{s.get('body', '').strip()}\n"
        out.append(f"{folder}/{s['name']}/SKILL.md")
        small_file(spark, out[-1], text.encode(), overwrite)
    return out


def bundle(files: dict[str, bytes]) -> bytes:
    """A tar archive that depends on names and contents alone: sorted, no owner, no time."""
    data = io.BytesIO()
    with tarfile.open(fileobj=data, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name in sorted(files):
            info = tarfile.TarInfo(name)
            info.size, info.mode = len(files[name]), 0o644
            tar.addfile(info, io.BytesIO(files[name]))
    return data.getvalue()


def append_sources(rows: DataFrame, source: str, root: str, outputs: dict[str, list[str]]) -> DataFrame:
    """Append rows of new sources to several outputs, once a source.

    A source's rows go to a folder of its own in every output, and its name to
    the ledger last: a source that a failed run left half written is written
    again over its own folder, and one in the ledger is skipped.  Returns the ledger.
    """
    spark = rows.sparkSession
    ledger = f"{root}/ledger"
    _, where, fs = _fs(spark, ledger)
    schema = f"`{source}` string"
    done = spark.read.schema(schema).parquet(ledger) if fs.exists(where) else spark.createDataFrame([], schema)
    fresh = rows.join(done, source, "left_anti")
    for name, columns in outputs.items():
        mode = {"partitionOverwriteMode": "dynamic"}
        fresh.select(*columns, source).write.mode("overwrite").options(**mode).partitionBy(source).parquet(f"{root}/{name}")
    fresh.select(F.col(source).cast("string")).distinct().write.mode("append").parquet(ledger)
    return spark.read.schema(schema).parquet(ledger)
