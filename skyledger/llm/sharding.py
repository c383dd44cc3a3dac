"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots. Bytes and rows are aggregated per slot, and a versioned map
says which shard owns which slot. The map is edited, never recomputed, when shards are added: the new shard takes
slots and no other slot moves. Everything here is DataFrame code; the map has one row per slot, so it is bounded
by ``slots`` whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 4096


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text and one for its end; a null text has none of its own."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def with_slot(docs: DataFrame, key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """Adds ``virtual_slot``; a null key hashes like any other value."""
    return docs.withColumn("virtual_slot", F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int"))


def slot_stats(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes, rows), a row for every slot, empty ones included."""
    used = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(used), "virtual_slot", "left").fillna(0, ["bytes", "rows"])


def first_map(stats: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map: slots from the largest down, each to the shard with the fewest bytes so far.

    The fold runs over one array with an entry per slot. Ties go to the lower slot and the lower shard.
    Returns (version, virtual_slot, shard, bytes, rows).
    """
    ordered = stats.agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("bytes")).alias("less"), "virtual_slot", "bytes", "rows"))).alias("todo"))
    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("load"),
        F.array().cast("array<int>").alias("owner"))

    def give(done: Column, slot: Column) -> Column:
        target = F.array_position(done["load"], F.array_min(done["load"])).cast("int") - 1
        return F.struct(
            F.transform(done["load"], lambda b, i: F.when(i == target, b + slot["bytes"]).otherwise(b)).alias("load"),
            F.concat(done["owner"], F.array(target)).alias("owner"))

    owners = ordered.select("todo", F.aggregate("todo", start, give)["owner"].alias("owner"))
    pairs = owners.select(F.explode(F.arrays_zip("todo", "owner")).alias("p"))
    return pairs.select(
        F.lit(1).alias("version"), F.col("p.todo.virtual_slot").alias("virtual_slot"),
        F.col("p.owner").alias("shard"), F.col("p.todo.bytes").alias("bytes"), F.col("p.todo.rows").alias("rows"))


def add_shard(current: DataFrame) -> DataFrame:
    """The next version of a map, with one shard more.

    Each old shard gives the new one its smallest-ranked slots until about its fair share of bytes is handed over;
    all other slots stay where they are. A shard never gives more than that share, so a lone huge slot stays.
    """
    shards = F.max("shard").over(Window.partitionBy("version")) + 1
    own = Window.partitionBy("version", "shard")
    given = own.orderBy("bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("bytes").over(own) / (shards + 1)
    moved = current.select(
        "version", "virtual_slot", "shard", "bytes", "rows", shards.cast("int").alias("new_shard"),
        (F.sum("bytes").over(given) <= share).alias("moves"))
    return moved.select(
        (F.col("version") + 1).alias("version"), "virtual_slot",
        F.when(F.col("moves"), F.col("new_shard")).otherwise(F.col("shard")).alias("shard"), "bytes", "rows")


def place(records: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``shard`` and ``slot``, the gapless position in the shard.

    A record's position is the number of rows in the shard's earlier virtual slots plus its rank in its own, so
    rows are ordered within a virtual slot only and no shard meets in one task.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*order))
    return (
        records.withColumn("rank_in_slot", rank)
        .join(F.broadcast(offsets), "virtual_slot")
        .withColumn("slot", (F.col("before") + F.col("rank_in_slot") - 1).cast("long"))
        .drop("before", "rank_in_slot"))


def shard_documents(docs: DataFrame, slot_map: DataFrame | None = None, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, virtual_slot) for every row of ``docs``.

    Law: ``bytes``. Null texts have size 1 and the crc of the empty text. Repeated rows are placed one by one; an
    empty table gives no rows. Other columns of ``docs`` are not read.
    """
    records = with_slot(docs.select(
        "doc_id", record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")))
    if slot_map is None:
        sizes = with_slot(docs.select("doc_id", record_size(F.col("text")).alias("size")))
        slot_map = first_map(slot_stats(sizes), shards)
    return place(records, slot_map, ["doc_id", "size", "text_crc32"])
