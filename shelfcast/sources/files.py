"""Reading and writing the files of the weekly cycle."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import dates
from shelfcast.functions.rules import nan_to_null
from shelfcast.operators.panel import DATE

HISTORY = "unique_id string, date string, y double"
COVARIATES = "sell_price double, event_type_1 string, event_type_2 string, snap int"
FORECASTS = "unique_id string, date string, fh int, y double, Model string, Color string, `True` double"
SCORES = "unique_id string, rmsse double, mae double, bias double, Model string, cv int, date string"
RULES = "unique_id string, ExtraDay int"

# Names of the files that make up the cycle.
FORECAST_FILE = r"forecasts_(\d{4}-\d{2}-\d{2})\.csv$"
EVALUATION_FILE = r"evaluation_(\d{8})\.csv$"
CONFIRMED_FILE = r"confirmed_(\d{8})\.csv$"
DATED_FILE = r"(\d{6}|\d{8})\.(?:csv|xlsx)$"
LANDING_FILE = r"^\d{6}\.(csv|xlsx)$"
# The same name as a single file or as a folder of part files.
LANDING_PATH = r"/(\d{6}\.(?:csv|xlsx))(?:/part-[^/]*)?$"


def clean(df: DataFrame) -> DataFrame:
    """NaN becomes null in every double column, and dates are parsed."""
    fixed = {c: nan_to_null(F.col(f"`{c}`")) for c, t in df.dtypes if t == "double"}
    if DATE in df.columns and dict(df.dtypes)[DATE] == "string":
        fixed[DATE] = dates.parse_date(F.col(DATE))
    return df.withColumns(fixed) if fixed else df


def read_table(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV with header, or Parquet, with a declared schema."""
    if path.rstrip("/").endswith(".parquet"):
        return clean(spark.read.parquet(path))
    return clean(spark.read.csv(path, schema=schema, header=True, sep=sep, nanValue="NaN"))


def delimiter(spark: SparkSession, path: str, candidates: tuple[str, ...] = (",", ";")) -> str:
    """The first candidate that splits the header line, else the first one."""
    header = spark.read.text(path).limit(1).first()
    line = header["value"] if header else ""
    return next((c for c in candidates if c in line), candidates[0])


def read_update(spark: SparkSession, path: str, schema: str = HISTORY) -> DataFrame:
    """A weekly update, separated by commas or semicolons."""
    return read_table(spark, path, schema, delimiter(spark, path))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An empty table when the file is not there."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return clean(spark.createDataFrame([], schema))


def read_future(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_table(spark, path, schema).withColumnRenamed(DATE, "ds")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths below a folder; the contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return found.option("recursiveFileLookup", "true").load(path).select("path")


def classify(paths: DataFrame) -> DataFrame:
    """Category and date of each file name; files of no category are left out."""
    path = F.col("path")
    name = F.element_at(F.split(path, "/"), -1)
    dated = dates.parse_file_date(F.regexp_extract(path, DATED_FILE, 1))
    found = F.array(
        _entry("main", path.rlike(DATED_FILE) & path.contains("main"), dated),
        _entry(
            "update",
            path.rlike(DATED_FILE)
            & ~path.contains("main")
            & ~path.contains("evaluation")
            & ~path.contains("confirmed"),
            dated,
        ),
        _entry("forecast", path.rlike(FORECAST_FILE), F.try_to_date(F.regexp_extract(path, FORECAST_FILE, 1), "yyyy-MM-dd")),
        _entry("evaluation", path.rlike(EVALUATION_FILE), _digits(EVALUATION_FILE)),
        _entry("confirmed", path.rlike(CONFIRMED_FILE), _digits(CONFIRMED_FILE)),
    )
    rows = paths.select(name.alias("name"), F.inline_outer(found))
    return rows.where(F.col("matches") & F.col("file_date").isNotNull()).drop("matches")


def _digits(pattern: str) -> Column:
    return dates.parse_file_date(F.regexp_extract("path", pattern, 1))


def _entry(category: str, matches: Column, date: Column) -> Column:
    return F.struct(
        F.lit(category).alias("category"), matches.alias("matches"), date.alias("file_date")
    )


def newest_versions(paths: DataFrame) -> DataFrame:
    """The newest file per category, the last name among equal dates."""
    newest = F.max(F.struct("file_date", "name"))
    return (
        classify(paths)
        .groupBy("category")
        .agg(newest.alias("_n"))
        .select("category", "_n.name", "_n.file_date")
    )


def landing_check(paths: DataFrame) -> DataFrame:
    """Is the name of an arriving file acceptable."""
    name = F.element_at(F.split("path", "/"), -1)
    return paths.withColumn("name", name).withColumn("accepted", F.col("name").rlike(LANDING_FILE))


def append_update(main: DataFrame, update: DataFrame | None) -> DataFrame:
    """History with the update below it; unchanged without one or when both end on the same day."""
    if update is None:
        return main
    newest = main.agg(F.max(DATE)).scalar()
    other_day = update.agg(F.max(DATE)).scalar() != newest
    added = update.where(other_day)
    return main.unionByName(added, allowMissingColumns=True)


def snapshot_name(df: DataFrame) -> DataFrame:
    """One row with the file name of a snapshot of the table."""
    stamp = F.date_format(F.max(DATE), "ddMMyyyy")
    return df.agg(F.concat(F.lit("main_"), stamp, F.lit(".csv")).alias("name"))


def write_dated(df: DataFrame, path: str, by: str = DATE) -> None:
    """Parquet partitions per date; a rerun replaces the dates it holds and no others.

    Rows of one date are spread over several files when there are many, as the
    split of a hot date is left to the adaptive rebalance.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def write_forecasts(published: DataFrame, documents: DataFrame, path: str) -> str:
    """Nested documents as JSON lines and the flat table as CSV named by its newest date."""
    newest = published.agg(F.max(DATE).cast("string").alias("d")).first()["d"]
    documents.write.mode("overwrite").json(f"{path}/latest_predictions.json")
    flat = f"{path}/forecasts_{newest}.csv"
    published.write.mode("overwrite").csv(flat, header=True, emptyValue="")
    return flat


def write_named(df: DataFrame, folder: str, by: str, suffix: str = ".csv") -> None:
    """One CSV file per value of `by`, named by it, each published in one step.

    The files are written aside, one task per value, and renamed through the
    file system that the folder lives in, so a reader finds a whole file or
    none, and a rerun replaces the files it writes and no others. The driver
    handles names only.
    """
    spark = df.sparkSession
    aside = f"{folder.rstrip('/')}/.aside-{uuid.uuid4().hex}"
    df.repartition(F.col(by)).write.partitionBy(by).option("maxRecordsPerFile", 0).csv(aside, header=True)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(folder)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    replace[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    try:
        for entry in files.listStatus(hadoop.Path(aside)):
            if not entry.isDirectory():
                continue
            name = entry.getPath().getName().split("=", 1)[1]
            written = [f.getPath() for f in files.listStatus(entry.getPath()) if f.getPath().getName().startswith("part-")]
            if len(written) != 1:
                raise ValueError(f"{len(written)} files for {name!r}")
            context.rename(written[0], hadoop.Path(target, name + suffix), replace)
    finally:
        files.delete(hadoop.Path(aside), True)


def read_named(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of a folder of named files with the `file` each came from."""
    rows = spark.read.schema(schema).csv(folder, header=True, pathGlobFilter="*.csv", enforceSchema=False)
    return clean(rows).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def write_batches(df: DataFrame, path: str) -> None:
    """One file per weekly batch, named by its last date."""
    from shelfcast.operators.panel import week_batches

    named = week_batches(df).select(*df.columns, F.date_format("week_end", "ddMMyyyy").alias("week_end"))
    write_named(named, path, "week_end")
