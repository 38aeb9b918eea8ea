"""Database tables over JDBC. Credentials come from the caller, never from code."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    **options: object,
) -> dict[str, str]:
    given = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver, **options}
    return {k: str(v) for k, v in given.items() if v is not None}


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    num_partitions: int | None = None,
    **options: object,
) -> DataFrame:
    """Table scan; with a numeric, date or timestamp ``partition_column`` it is read by
    ``num_partitions`` tasks over ``bounds``. Filters and column pruning reach the database."""
    if partition_column is not None:
        if bounds is None or num_partitions is None:
            raise ValueError("a partition column needs bounds and num_partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": num_partitions,
        }
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def jdbc_bounds(
    spark: SparkSession, url: str, table: str, column: str, **options: object
) -> tuple[object, object]:
    """Lowest and highest value of ``column``, computed by the database."""
    query = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"
    row = spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load().first()
    return row[0], row[1]


def write_jdbc(
    df: DataFrame, url: str, table: str, *, replace: bool = False, **options: object
) -> None:
    """Append rows; ``replace`` truncates first and keeps the table definition.

    A failure fails the job, so a streaming batch is retried instead of lost.
    """
    if replace:
        options = {"truncate": "true", **options}
    mode = "overwrite" if replace else "append"
    df.write.format("jdbc").mode(mode).options(**jdbc_options(url, table, **options)).save()
