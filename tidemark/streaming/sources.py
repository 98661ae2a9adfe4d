"""Streaming sources (S1, S2) and the stand-ins used offline.

* ``kafka_options`` / ``read_kafka``: a message topic read from the newest
  offset over all partitions; rows ``(key, value, ts)`` with ``ts`` the
  broker's arrival timestamp (the arrival stamp T1). Needs the
  ``spark-sql-kafka`` package on the classpath, which this environment does
  not bundle; the option builder is tested, the read is not run here.
* ``table_stream``: a parquet table, one file or a folder of part files, as a
  file stream (one micro-batch per ``max_files_per_trigger`` files).
* ``write_flush_marker``: a one-row sentinel far after the newest event,
  so a bounded replay closes its last windows. It is a valid click (it has to
  pass every filter Catalyst may push below the watermark) from user -1 and
  lands in a window that never closes, so it never reaches any output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLUSH_USER = -1

# A message as a broker delivers it: key, JSON text, arrival timestamp.
MESSAGE_SCHEMA = "key bigint, value string, ts timestamp"


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest",
                  **extra: str) -> dict[str, str]:
    """Options of a Kafka source over all partitions of ``topic``. Offsets that
    the broker has lost end the query (Spark's ``failOnDataLoss`` default)."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
               **extra: str) -> DataFrame:
    """``(key, value, ts)`` of a Kafka topic as text (value = JSON message)."""
    raw = spark.readStream.format("kafka").options(
        **kafka_options(servers, topic, starting_offsets, **extra)).load()
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      F.col("timestamp").alias("ts"))


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Table ``{sf_dir}/{name}.parquet``, a file or a folder of part files, as a stream."""
    path, files = f"{sf_dir.rstrip('/')}/{name}.parquet", "*.parquet"
    if not is_folder(spark, path):
        path, files = sf_dir, f"{name}.parquet"
    return read_files_stream(spark, path, files, schema, max_files_per_trigger)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def read_files_stream(spark: SparkSession, folder: str, file_glob: str, schema,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Files of ``folder`` matching ``file_glob`` as a stream, in the order of their modification times."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(folder)


def write_slice(rows: DataFrame, folder: str, files: int, total: int) -> None:
    """Append ``rows`` to the files of ``folder``, ``files`` of them (``total`` with those before), also when
    there are fewer rows than that: a file stream that takes ``files`` at a time then reads a slice at a time."""
    spark = rows.sparkSession
    rows.repartition(files).write.mode("append").option("maxRecordsPerFile", 0).parquet(folder)
    fs, p = _file_system(spark, f"{folder}/*.parquet")
    for _ in range(total - len(fs.globStatus(p))):
        rows.limit(0).coalesce(1).write.mode("append").parquet(folder)


def read_message_files(spark: SparkSession, folder: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Stand-in for a topic: parquet files of ``(key, value, ts)`` messages (the columns of ``read_kafka``)."""
    return read_files_stream(spark, folder, "*.parquet", MESSAGE_SCHEMA, max_files_per_trigger)


def write_flush_marker(events: DataFrame, path: str, after: str = "1 day") -> None:
    """Append the sentinel row (schema of ``events``), ``after`` its newest ts (longer than the watermark)."""
    cols = {f.name: F.lit(None).cast(f.dataType) for f in events.schema.fields}
    cols.update({
        "event_id": F.lit(-1).cast("bigint"),
        "ts": F.col("__max") + F.expr(f"INTERVAL {after}"),
        "user_id": F.lit(FLUSH_USER).cast("bigint"),
        "event_type": F.lit("click"),
        "value": F.lit(0.0),
        "props": F.lit('{"k": -1}'),
    })
    (events.agg(F.max("ts").alias("__max"))
     .select(*[c.alias(n) for n, c in cols.items()])
     .coalesce(1).write.mode("append").parquet(path))
