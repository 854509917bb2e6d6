"""File and in-memory sources, and the partitioned Parquet sink."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from vendaria.functions import parse_date, parse_timestamp
from vendaria.sources.scratch import materialize


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line. Columns bind by position and a malformed cell becomes NULL."""
    return spark.read.format("csv").option("header", "true").schema(schema).load(path)


class Checked(NamedTuple):
    """What a file holds: the rows that fit their types, and the cells of the lines that do not."""

    rows: DataFrame
    #: (file, line, column, cell): one row for each bad cell; without column and cell if the line has another number
    #: of cells than there are columns, or is no record at all.
    rejected: DataFrame


_LINE, _FILE = "_line", "_file"
AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType, staging: str, header: bool = True, check_header: bool = False
) -> Checked:
    """CSV whose malformed lines are told apart, where `read_csv` turns bad cells into NULL.

    The file is read and parsed once, into `staging`, whole: what is rejected does not depend on the columns that are
    asked for later. A line with a bad cell is rejected as it stands; its good cells are in `line`. Empty cells are
    NULL, and empty lines are no records. `check_header` refuses files whose header names other columns than `schema`.
    """
    read = (
        spark.read.format("csv")
        .option("header", str(header).lower())
        .option("enforceSchema", str(not check_header).lower())
        .option("columnNameOfCorruptRecord", _LINE)
        .schema(StructType([*schema, StructField(_LINE, StringType())]))
        .load(path)
    )
    parsed = read.select("*", F.col("_metadata.file_path").alias(_FILE))
    parsed = materialize(parsed, staging)
    # One cell more than there are columns shows lines that are too long.
    cells = ", ".join(f"c{i} string" for i in range(len(schema) + 1))
    bad = parsed.filter(F.col(_LINE).isNotNull()).withColumn("_cells", F.from_csv(_LINE, cells, AS_IS))
    found = [
        F.when(
            F.col(f"`{field.name}`").isNull() & F.col(f"_cells.c{i}").isNotNull(),
            F.struct(F.lit(field.name).alias("column"), F.col(f"_cells.c{i}").alias("cell")),
        )
        for i, field in enumerate(schema)
    ]
    none = F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("cell"))
    found = F.array_compact(F.array(*found))
    wrong = F.when((F.size(found) == 0) | F.col(f"_cells.c{len(schema)}").isNotNull(), F.array(none)).otherwise(found)
    rejected = bad.select(F.col(_FILE).alias("file"), F.col(_LINE).alias("line"), F.explode(wrong).alias("_wrong"))
    return Checked(
        parsed.filter(F.col(_LINE).isNull()).select(*[f"`{n}`" for n in schema.names]),
        rejected.select("file", "line", "_wrong.*"),
    )


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet file or hive-partitioned directory.

    The schema is passed so that partition columns keep their type and no footer is read to infer one;
    the select puts them back into the declared order.
    """
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_partitioned(
    df: DataFrame, path: str, partition_col: str, mode: str = "overwrite", rebalance: bool = True
) -> None:
    """Parquet directory partitioned by one column.

    Unless told otherwise rows are first gathered by partition value, or every task would write one small
    file per value. It is a REBALANCE and not a `repartition`, so AQE splits a value that holds a large share
    of the rows over many tasks and merges the small ones.
    """
    out = df.hint("rebalance", F.col(partition_col)) if rebalance else df
    out.write.format("parquet").mode(mode).partitionBy(partition_col).save(path)


def from_rows(
    spark: SparkSession, rows: Iterable[Sequence], schema: StructType, strict: bool = True
) -> DataFrame:
    """Literal rows whose dates and timestamps are written as text, as change feeds deliver them."""
    as_text = StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, (DateType, TimestampType)) else f.dataType)
            for f in schema
        ]
    )
    parsed = []
    for field in schema:
        column = F.col(field.name)
        if isinstance(field.dataType, TimestampType):
            column = parse_timestamp(column, strict)
        elif isinstance(field.dataType, DateType):
            column = parse_date(column, strict)
        parsed.append(column.alias(field.name))
    return spark.createDataFrame(list(rows), as_text).select(*parsed)
