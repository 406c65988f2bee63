"""Reading and writing tables: Parquet, JDBC, CSV and stage snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import stage


# The columns of the order tables that the retail tables are made from.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int",
    "part": "p_partkey long, p_brand string",
    "lineitem": "l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp",
}


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """One source table stored as Parquet, without its leftover row-number column.

    Known tables have their schema declared, so that no job runs to find it out.
    """
    schema = schema or SOURCE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet").drop("index")


def read_database_table(
    spark: SparkSession, url: str, table: str, split: dict[str, str] | None = None, **options: str
) -> DataFrame:
    """One table of a SQL database; needs the driver jar of that database.

    `split` holds partitionColumn, lowerBound, upperBound and numPartitions: with
    it the executors read ranges side by side, without it one task reads it all.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**(split or {}), **options).load().drop("index")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", mode: str = "FAILFAST"
) -> DataFrame:
    """CSV files with a header, whose columns are matched by name.

    A file whose header is in another order than the first one's fails the read, and so
    does a value, of a column that is read, that is not of its type; with
    `mode="PERMISSIVE"` such a value becomes null instead.
    """
    header = spark.read.option("header", True).option("sep", sep).csv(path).columns
    types = {f.name: f for f in schema.fields}
    laid = T.StructType([types.get(name, T.StructField(name, T.StringType())) for name in header])
    raw = (
        spark.read.schema(laid)
        .options(header=True, sep=sep, dateFormat="yyyy-MM-dd", mode=mode, enforceSchema=False)
        .csv(path)
    )
    return raw.select(*[f.name for f in schema.fields])


def read_csv_apart(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """The lines of CSV files that parse, and those that do not: file, record and reason.

    Every line but the headers is in one of the two. The files are parsed once.
    """
    header = spark.read.option("header", True).option("sep", sep).csv(path).columns
    types = {f.name: f for f in schema.fields}
    laid = T.StructType([types.get(name, T.StructField(name, T.StringType())) for name in header])
    whole = T.StructType([*laid.fields, T.StructField(BAD_RECORD, T.StringType())])
    options = {"header": True, "sep": sep, "dateFormat": "yyyy-MM-dd", "enforceSchema": False, "mode": "PERMISSIVE"}
    parsed = spark.read.schema(whole).options(columnNameOfCorruptRecord=BAD_RECORD, **options).csv(path)
    parsed = stage(parsed.select("*", F.col("_metadata.file_path").alias("file")), "csv-lines")
    texts = T.StructType([T.StructField(name, T.StringType()) for name in header])
    wrong = [
        F.when(
            F.col("fields")[f.name].isNotNull() & F.col("fields")[f.name].try_cast(f.dataType).isNull(),
            F.lit(f"{f.name} is not {f.dataType.simpleString()}"),
        )
        for f in laid.fields
    ]
    bad = parsed.where(F.col(BAD_RECORD).isNotNull()).withColumn(
        "fields", F.from_csv(BAD_RECORD, texts.simpleString()[7:-1].replace(":", " "), {"sep": sep})
    )
    reason = F.coalesce(*wrong, F.lit("number of fields"))
    good = parsed.where(F.col(BAD_RECORD).isNull()).select(*[f.name for f in schema.fields])
    return good, bad.select("file", F.col(BAD_RECORD).alias("record"), reason.alias("reason"))


BAD_RECORD = "_bad_record"


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    writer.option("dateFormat", "yyyy-MM-dd").csv(path)


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """A typed snapshot between stages.

    With `partition_by` the rows are first gathered by those columns, so a folder
    gets a few large files instead of one from every task.
    """
    if partition_by:
        df.repartition(*partition_by, "date" if "date" in df.columns else partition_by[0]).write.mode(
            "overwrite"
        ).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
