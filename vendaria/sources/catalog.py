"""Views, databases and the table that keeps the history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    quoted = location.replace("\\", "\\\\").replace("'", "\\'") if location else ""
    where = f" LOCATION '{quoted}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A temp view or a catalog table, with its files listed anew: another session, such as the one a stream
    runs its batches in, may have replaced them."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def create_table_from(df: DataFrame, name: str, partition_col: str) -> None:
    """First load of a managed table whose schema is that of `df`."""
    df.write.format("parquet").partitionBy(partition_col).saveAsTable(name)


def ensure_gmv_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database and the history table if they are missing; the one place that declares the table."""
    if "." in name:
        ensure_database(spark, name.rsplit(".", 1)[0], location)
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {name} (
            transaction_date DATE COMMENT 'Day the payment was released',
            subsidiary STRING COMMENT 'Subsidiary of the transaction',
            gmv_daily DOUBLE COMMENT 'Gross merchandise value of the day and subsidiary',
            valid_from DATE COMMENT 'First day this version is valid',
            valid_to DATE COMMENT 'Last day this version is valid',
            is_current BOOLEAN COMMENT 'Whether this is the valid version',
            load_timestamp TIMESTAMP COMMENT 'When this version was loaded'
        )
        USING PARQUET
        PARTITIONED BY (transaction_date)
        COMMENT 'Daily gross merchandise value by subsidiary with every version it had'
        """
    )
