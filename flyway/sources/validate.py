"""Per-file validation of a Parquet table (S4, S13): every footer read in Spark tasks, rows reconciled with the read."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOOTER = "path string, n_rows bigint, columns array<string>, error string"


def footer_kernel():
    """mapInArrow: (path) -> (path, n_rows, columns, error) from the file's footer alone."""
    schema = pa.schema([("path", pa.string()), ("n_rows", pa.int64()), ("columns", pa.list_(pa.string())),
                        ("error", pa.string())])

    def footer(path):
        from pyarrow import fs, parquet
        try:
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as f:
                meta = parquet.read_metadata(f)
        except Exception as e:  # noqa: BLE001  what the file or its store says is the finding
            return path, None, None, f"{type(e).__name__}: {str(e)[:200]}"
        return path, meta.num_rows, list(meta.schema.to_arrow_schema().names), None

    def run(batches):
        for b in batches:
            rows = [footer(p) for p in b.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                zip(*rows) if rows else [[]] * 4, schema)], schema=schema)

    return run


def footers(files: DataFrame, per_task: int = 512) -> DataFrame:
    """(path, n_rows, columns, error) of every file of ``files`` (path); ``per_task`` files a task."""
    tasks = max(1, -(-files.count() // per_task))
    return files.select("path").repartition(tasks, "path").mapInArrow(footer_kernel(), FOOTER)


def file_report(spark: SparkSession, base: str, files: DataFrame, schema, needed: list[str]) -> DataFrame:
    """(path, status, n_rows, n_read, missing) of every file under ``base``.

    ``status``: ``ok``; ``unreadable`` (no footer); ``columns`` (lacks some of ``needed``); ``short``
    (fewer rows could be decoded than the footer has: damaged pages).  All needed columns are
    decoded: this reads the table once.
    """
    raw = (spark.read.schema(schema).option("basePath", base).option("ignoreCorruptFiles", "true")
           .option("ignoreMissingFiles", "true").parquet(base))
    odd = F.pmod(F.xxhash64(*needed), F.lit(2))
    decoded = F.sum(odd) + F.sum(1 - odd)               # counts rows, and no optimizer can drop the columns
    read = raw.groupBy(F.col("_metadata.file_path").alias("path")).agg(decoded.alias("n_read"))
    missing = F.array_except(F.array(*map(F.lit, needed)), F.col("columns"))
    status = (F.when(F.col("error").isNotNull(), "unreadable").when(F.size("missing") > 0, "columns")
              .when(F.col("n_read") < F.col("n_rows"), "short").otherwise("ok"))
    return (footers(files).join(read, "path", "left").withColumn("n_read", F.coalesce("n_read", F.lit(0)))
            .withColumn("missing", F.when(F.col("error").isNull(), missing)).withColumn("status", status)
            .select("path", "status", "n_rows", "n_read", "missing"))
