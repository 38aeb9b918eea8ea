"""Parquet archives: per batch, per day, and dated snapshots."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickward.functions.times import utc_date, utc_day
from tickward.operators.retention import day_slice
from tickward.sources.commits import commits, read_commits, rewrite, source_key, write_commit
from tickward.sources.storage import CODEC, exists, no_rows


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and continue from the files: evaluated once, of known size, and safe against
    a lost executor."""
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_archive(df: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch under its stream and number; the same batch of the same stream replaces
    itself, another stream's batch of that number is left alone."""
    source = source_key(getattr(batch_id, "source", "")) or "none"
    df.write.mode("overwrite").parquet(f"{path}/source={source}/batch_id={int(batch_id)}")


def read_archive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every archived batch, with its ``batch_id``; empty before the first one."""
    full = T.StructType([*schema.fields, T.StructField("source", T.StringType()), T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(full).parquet(path) if exists(spark, path) else no_rows(spark, full)
    return rows.drop("source")


DIGEST = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("n", T.LongType()),
        T.StructField("total", T.DecimalType(38, 0)),
        T.StructField("mixed", T.LongType()),
        T.StructField("stamp", T.LongType()),
    ]
)
FOLD_DIGESTS = 20  # runs whose digests are read one by one


def _comparable(df: DataFrame) -> DataFrame:
    """Maps, which have no order and cannot be compared, as their sorted entries."""
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    return df.withColumns({c: F.array_sort(F.map_entries(c)) for c in maps}) if maps else df


def _missing_from(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``rows`` without those that ``held`` has, each as often as it has it."""
    missing = _comparable(rows).exceptAll(_comparable(held))
    maps = {f.name: F.map_from_entries(f.name) for f in rows.schema.fields if isinstance(f.dataType, T.MapType)}
    return missing.withColumns(maps) if maps else missing


def day_digests(rows: DataFrame, column: str) -> DataFrame:
    """Per day what tells its multiset of rows apart whatever their order: the number, sum and xor of row hashes."""
    kept = _comparable(rows)
    hashed = kept.select(F.col(column).alias("day"), F.xxhash64(*[c for c in sorted(kept.columns) if c != column], F.lit(0)).alias("h"))
    return hashed.groupBy("day").agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("mixed"))


def _known_digests(digests: DataFrame) -> DataFrame:
    return digests.groupBy("day").agg(F.max(F.struct("stamp", "n", "total", "mixed")).alias("last")).select("day", "last.n", "last.total", "last.mixed", "last.stamp")


def _add_missing(rows: DataFrame, path: str, column: str) -> None:
    """Append those of ``rows`` that the archive does not hold yet, as often as they are missing.

    The digests of the archived days stand beside them. Days whose rows agree with what is archived are left alone; of the archive only the
    other days are read. A run that died before it stored its digests leaves days that differ, which are compared.
    """
    spark, root = rows.sparkSession, f"{path}/_digests"
    known = _known_digests(read_commits(spark, root, DIGEST)).withColumnsRenamed({c: f"_{c}" for c in DIGEST.names})
    now = day_digests(rows, column)
    alike = now["day"].eqNullSafe(known["_day"]) & (now["n"] == known["_n"]) & now["total"].eqNullSafe(known["_total"]) & (now["mixed"] == known["_mixed"])
    others = now.join(known, alike, "left_anti").agg(F.collect_set("day"), F.count_if(F.col("day").isNull())).first()
    days, undated = others
    if not days and not undated:
        return
    chosen = F.col(column).isin(days) if days else F.lit(False)
    chosen = chosen | F.col(column).isNull() if undated else chosen
    touched = rows.where(chosen)
    if exists(spark, path):
        touched = _missing_from(touched, spark.read.schema(rows.schema).parquet(path).where(chosen))
    touched.hint("rebalance", column).write.mode("append").partitionBy(column).parquet(path)
    held = spark.read.schema(rows.schema).parquet(path).where(chosen)
    write_commit(day_digests(held, column).withColumn("stamp", F.lit(time.time_ns())).coalesce(1), root)
    if len(commits(spark, root).deltas) > FOLD_DIGESTS:
        rewrite(spark, root, DIGEST, lambda digests: _known_digests(digests).coalesce(1))


def archive_day(df: DataFrame, ts: str, path: str, day: dt.date | str | None = None, column: str = "date") -> str:
    """Add the rows of one UTC day (today by default) under ``<column>=YYYY-MM-DD``; returns the folder.

    Rows the day holds already are not added again, and rows that have left the table since an
    earlier run stay. The rebalance evens out files whatever share of the slice a single input
    file holds.
    """
    day = utc_day(day)
    _add_missing(day_slice(df, ts, day).withColumn(column, F.lit(day)), path, column)
    return f"{path}/{column}={day.isoformat()}"


def archive_by_day(df: DataFrame, ts: str, path: str, column: str = "date") -> None:
    """Add every row under its UTC day, rows without a time under the NULL day; what is archived stays.

    Only days that differ from what is archived are read from the archive and compared. Rows are rebalanced by day, so a day is a few files; a day far
    larger than the others is split over tasks by the adaptive planner.
    """
    _add_missing(df.withColumn(column, utc_date(df, ts)), path, column)


def archive_snapshot(df: DataFrame, path: str, day: dt.date | str | None = None, column: str = "date") -> str:
    """Write the whole table under ``<column>=YYYY-MM-DD`` (today by default), replacing an
    earlier run of that day."""
    folder = f"{path}/{column}={utc_day(day).isoformat()}"
    df.write.mode("overwrite").parquet(folder)
    return folder
