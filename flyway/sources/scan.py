"""Scans of the raw observation table and of the derived tables."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .validate import file_report, footers
from ..schema import OBSERVED_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, SUMMARY_SCHEMA, require_columns
from ..session import cut_lineage

log = logging.getLogger(__name__)
MOST_WARNINGS = 100      # lines in the log; the report itself covers every file


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """(path, length) of every data file under ``base`` on any store; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
            .select("path", "length"))


def check_file_columns(files: DataFrame, needed: list[str]) -> None:
    """Fail if a file lacks a needed column.

    A declared schema would fill it with NULL, so every file's own footer is asked, in Spark tasks: the
    column may be missing in one old file only.  A file without a readable footer fails the read itself.
    """
    old = (footers(files).withColumn("missing", F.array_except(F.array(*map(F.lit, needed)), F.col("columns")))
           .where(F.size("missing") > 0).orderBy("path").limit(20).collect())
    if old:
        raise ValueError("missing required columns: " + "; ".join(f"{r['path']}: {r['missing']}" for r in old))


def read_raw(spark: SparkSession, base: str, tolerant: bool = False,
             paths: list[str] | None = None) -> DataFrame:
    """Raw table laid out as ``base/year=YYYY/*.parquet``; the schema is declared, not inferred.

    Every file must hold the required columns.  ``paths`` restricts the read to some files.
    ``tolerant`` skips what cannot be read and warns: of files without a readable footer, of files of
    which only some rows could be decoded, and of files that lack a required column, whose
    rows are left out (NULLs would pass for values).  It fails when no file can be read.
    """
    needed = [c for c in RAW_COLUMNS if c != "year"]
    reader = spark.read.schema(RAW_SCHEMA).option("basePath", base)
    files = list_files(spark, base)
    if not tolerant:
        check_file_columns(files if paths is None else spark.createDataFrame([(p,) for p in paths], "path string"), needed)
        return reader.parquet(*(paths or [base]))
    reader = (reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true"))
    raw = reader.parquet(*(paths or [base]))
    if paths is not None:
        files = files.where(F.col("path").isin(list(paths)))
    report = cut_lineage(file_report(spark, base, files, RAW_SCHEMA, needed), "file-report")
    for r in report.where("status <> 'ok'").orderBy("path").limit(MOST_WARNINGS).collect():
        log.warning("%s file %s: %s of %s rows read, missing columns %s", r["status"], r["path"], r["n_read"], r["n_rows"],
                    r["missing"])
    if not report.where("status in ('ok', 'short')").limit(1).count():
        raise FileNotFoundError(f"no file under {base} could be read")
    old = report.where("status = 'columns'").select("path")
    if not old.limit(1).count():
        return raw
    kept = raw.withColumn("_path", F.col("_metadata.file_path")).join(old.withColumnRenamed("path", "_path"), "_path", "left_anti")
    return kept.drop("_path")


def fold_years(raw: DataFrame, folds: DataFrame, fold: int) -> DataFrame:
    """The raw rows of the years that one fold touches.

    ``raw`` lies in ``year=`` folders: the fold's years, a few rows broadcast, prune the folders before any
    file is listed for reading (dynamic partition pruning).
    """
    years = (folds.where(F.col("fold") == fold)
             .select(F.explode(F.array("year_from", "year_to")).alias("year")).distinct())
    return raw.join(F.broadcast(years), "year", "left_semi")         # at most two years per pair of the fold table


def sample_paths(spark: SparkSession, base: str, max_files: int) -> list[str]:
    """The first ``max_files`` files by name of each folder (year) under ``base``."""
    files = list_files(spark, base).select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"))
    first = F.row_number().over(Window.partitionBy("folder").orderBy("path"))
    return sorted(r["path"] for r in files.withColumn("place", first).where(F.col("place") <= max_files)
                  .select("path").collect())


def project_essential(raw: DataFrame) -> DataFrame:
    """Column pruning to the 18 raw columns."""
    require_columns(raw, RAW_COLUMNS, "raw observations")
    return raw.select(*RAW_COLUMNS)


def filter_observed(raw: DataFrame) -> DataFrame:
    """Keep ``species_observed`` rows; NULL counts as not observed."""
    return raw.where(F.col("species_observed"))


def scan_observed(raw: DataFrame) -> DataFrame:
    """Project, keep observed rows, drop the flag."""
    return filter_observed(project_essential(raw)).select(*OBSERVED_COLUMNS)


def scan_years(raw: DataFrame, years: list[int] | None) -> DataFrame:
    """Restrict to some years: a partition filter on ``year``."""
    obs = scan_observed(raw)
    return obs if years is None else obs.where(F.col("year").isin(list(years)))


def scan_sample(spark: SparkSession, base: str, max_files: int) -> DataFrame:
    """Dev sample: the first ``max_files`` files (by name) of each year; only they are read (S3)."""
    return scan_observed(read_raw(spark, base, paths=sample_paths(spark, base, max_files)))


# Keyword lists of the three column categories (substring match).
GEO_KEYWORDS = "state|county|lat|lon|location|region|country|locality"
TEMPORAL_KEYWORDS = "date|time|day|hour|month|year"
EFFORT_KEYWORDS = "effort|duration|distance|protocol"


def column_inventory_df(df: DataFrame) -> DataFrame:
    """Per year present in the data, every column with its categories.

    The column list is schema metadata; each distinct year row is expanded by an
    explode of that constant list, so nothing is collected.
    """
    names = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                               F.lit(f.dataType.simpleString()).alias("data_type"))
                      for f in df.schema.fields])
    inv = (df.select("year").distinct()
             .select("year", F.explode(names).alias("c"))
             .select("year", "c.column_name", "c.data_type"))
    lc = F.lower("column_name")
    return inv.select("year", "column_name", "data_type",
                      lc.rlike(GEO_KEYWORDS).alias("is_geographic"),
                      lc.rlike(TEMPORAL_KEYWORDS).alias("is_temporal"),
                      lc.rlike(EFFORT_KEYWORDS).alias("is_effort"))


def read_summaries(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Union per-year summary files; warn on a missing year, fail if none."""
    frames = []
    for year, path in sorted(paths.items()):
        try:                                  # asks the path's own file system
            frames.append(spark.read.schema(SUMMARY_SCHEMA).parquet(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            log.warning("summary for %s not found at %s", year, path)
    if not frames:
        raise FileNotFoundError("no year summary could be loaded")
    return reduce(DataFrame.unionByName, frames)
