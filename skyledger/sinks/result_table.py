"""Last-write-wins result table, one partition per day.

An upsert merges a batch into the days that it touches and replaces those partitions alone, so a read of some days
opens only their files and holds one row per key. The merged partitions are complete beside the table before any is put
in its place: a job that dies in between finds the rest when the batch is delivered again. A repeated batch changes
nothing, as rows keep the number of the batch that wrote them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.params import DAY_MS
from skyledger.session import drop_folder, path_exists, replace_folder, subfolders

# Key columns: time plus tags. The since-start results keep window_end, so every snapshot survives.
RESULT_KEYS: dict[str, tuple[str, ...]] = {
    "q1": ("window_start", "airline"),
    "q2_1h": ("window_start", "window_type", "rank"),
    "q2_6h": ("window_start", "window_type", "rank"),
    "q2_global": ("window_start", "window_end", "window_type", "rank"),
    "q3_1d": ("window_start", "window_type", "airline", "hour"),
    "q3_7d": ("window_start", "window_type", "airline", "hour"),
    "q3_global": ("window_start", "window_end", "window_type", "airline", "hour"),
}

# The same without window_end: only the last since-start snapshot survives, and a ranking that
# shrinks keeps its old lower ranks.
POINT_KEYS = RESULT_KEYS | {
    "q2_global": ("window_start", "window_type", "rank"),
    "q3_global": ("window_start", "window_type", "airline", "hour"),
}


def latest_rows(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest row per key: highest batch, then highest window end.

    Works like a top-1 per key, so each task drops superseded rows before the exchange.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("batch_id"), F.desc("window_end"))
    return history.withColumn("age", F.row_number().over(order)).where("age = 1").drop("age")


def day_of(keys: Sequence[str]) -> Column:
    """Partition of a row: the day of its window end where that is part of the key, else of its window start."""
    time = F.col("window_end" if "window_end" in keys else "window_start")
    return F.floor(time / DAY_MS).cast("long")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = [*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("day", T.LongType())]
    return spark.read.schema(T.StructType(full)).parquet(f"{path}/rows")


def upsert(rows: DataFrame, path: str, batch_id: int, keys: Sequence[str], days: Sequence[int] | None = None) -> None:
    """Merges a batch into the table; of equal keys the higher batch wins, then the later window end.

    ``days`` are the partitions that the rows touch, where the caller knows them; a batch has as many as the calendar.
    """
    spark = rows.sparkSession
    pending = f"{path}/pending/batch_id={batch_id}"
    if not path_exists(spark, f"{pending}/_SUCCESS"):
        stamped = rows.withColumns({"batch_id": F.lit(batch_id).cast("long"), "day": day_of(keys)})
        if days is None:
            days = [r.day for r in stamped.select("day").distinct().collect()]
        if not days:
            return
        merged = stamped
        if path_exists(spark, f"{path}/rows"):
            merged = _read(spark, path, rows.schema).where(F.col("day").isin(list(days))).unionByName(stamped)
        latest_rows(merged, ["day", *keys]).repartition("day").write.mode("overwrite").partitionBy("day").parquet(pending)
    for folder in subfolders(spark, pending):
        name = folder.rsplit("/", 1)[1]
        if name.startswith("day="):
            replace_folder(spark, folder, f"{path}/rows/{name}")
    for folder in subfolders(spark, f"{path}/pending"):
        if int(folder.rsplit("=", 1)[1]) < batch_id:
            drop_folder(spark, folder)


def read_results(
    spark: SparkSession, path: str, schema: T.StructType, first_day: int | None = None, last_day: int | None = None
) -> DataFrame:
    """Current rows of a table; with days (counted from the epoch) only their partitions are read."""
    rows = _read(spark, path, schema)
    if first_day is not None:
        rows = rows.where(F.col("day") >= first_day)
    if last_day is not None:
        rows = rows.where(F.col("day") <= last_day)
    return rows.select(*schema.names)


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """One batch of rows in a folder of its own, which a repeated batch overwrites."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that ``write_batch`` has left in a folder."""
    names = (p.rsplit("/", 1)[1] for p in subfolders(spark, path))
    return sorted(int(n[len("batch_id="):]) for n in names if n.startswith("batch_id="))
