"""File, catalog and JDBC scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a data folder, either one file or a directory of files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream_table(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same table as a file stream."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A glob is resolved to files and directories alike; a plain file path is not accepted by file streams.
    return reader.parquet(f"{folder}/{name}.parque[t]")


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines. Give the schema when it is known: inference reads the data twice."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
             header: bool = True) -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Parquet directories with differing files: union of all columns plus the directory keys."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_recursive(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files at any depth, directory names ignored."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    lines = spark.read.text(path)
    return lines.repartition(min_partitions) if min_partitions else lines


def read_line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new text files as ``value`` with ``timestamp``, the time at which their file arrived."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select("value", F.col("_metadata.file_modification_time").alias("timestamp"))


def sql_on_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def column_types(df: DataFrame) -> dict[str, str]:
    """Column name to type name, to drive jobs that are generic over tables."""
    return dict(df.dtypes)


def catalog_column_types(spark: SparkSession, name: str) -> dict[str, str]:
    return {c.name: c.dataType for c in spark.catalog.listColumns(name)}


def with_input_file(df: DataFrame, name: str = "input_file") -> DataFrame:
    return df.withColumn(name, F.col("_metadata.file_path"))


def read_jdbc(spark: SparkSession, url: str, dbtable: str, properties: dict[str, str],
              split_column: str | None = None, bounds: tuple | None = None, partitions: int = 1) -> DataFrame:
    """JDBC scan. ``split_column`` with its bounds makes ``partitions`` parallel range reads."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", dbtable).options(**properties)
    if split_column:
        reader = reader.options(partitionColumn=split_column, lowerBound=bounds[0],
                                upperBound=bounds[1], numPartitions=partitions)
    return reader.load()


def rows_per_folder(df: DataFrame) -> DataFrame:
    """``(folder, n_rows, listed)``: rows by the last folder of their file, and whether ``inputFiles`` names a file of it.

    File names differ from run to run, folders do not. The list of files is the one that the scan holds on the driver.
    """
    last = lambda path: path.rsplit("/", 2)[-2]
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    counted = df.select(folder.alias("folder")).groupBy("folder").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("listed", F.col("folder").isin(sorted({last(p) for p in df.inputFiles()})))
