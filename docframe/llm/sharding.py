"""Sharding by fixed virtual slots.

Records hash into thousands of virtual slots. Bytes are summed per slot (at most ``n_slots`` rows, whatever the input), a
greedy pass over this bounded table gives each slot to the least loaded shard, largest slots first, and the result is
stored as a new version of the slot-to-shard map. Growing edits the map: only slots that go to the new shard change.

Everything runs as DataFrame expressions. Records are numbered within their shard by two levels, virtual slot and place
in it, so no shard is sorted in one task. A key that holds more than an eighth of a slot's mean share of the rows (a
repeated doc_id, null ids with equal texts) is spread over all slots, row by row; the narrow records are written first, so
that this spread is the same for the sums and for the assignment.

Defined results: a null text has 16 bytes and the CRC of the empty string (0); a null doc_id hashes by the text instead;
an empty table gives no rows; repeated rows get different numbers; texts of any length count with all their bytes.
``grow_slot_map`` of an empty map is empty; a map whose slots are all larger than the new fair share stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docframe.llm.common import fresh, read_table, scratch, stage

N_SLOTS = 8192
OVERHEAD = 16


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def with_virtual_slots(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Staged (doc_id, size, text_crc32, spread) rows plus virtual_slot."""
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text_crc32", "size"))
    keyed = records.withColumn("key", key)
    most = max(1, records.count() // (8 * n_slots))
    hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("key", F.lit(True).alias("hot"))
    marked = keyed.join(F.broadcast(hot), "key", "left")  # at most 8 * n_slots keys have so many rows, or half the rows of a small table
    slot = F.when(F.col("hot"), F.xxhash64("key", "spread")).otherwise(F.col("key"))
    return marked.select("doc_id", "size", "text_crc32", F.pmod(slot, F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_sizes(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """bytes and rows of each virtual slot in use; summed before the shuffle."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows"))


def build_slot_map(sizes: DataFrame, n_shards: int) -> DataFrame:
    """Largest slot first to the least loaded shard. ``sizes`` has at most ``n_slots`` rows, so one task holds it."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("neg"), F.col("virtual_slot").alias("slot"), F.col("n_rows"))))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_shards).alias("loads"), F.array().cast("array<int>").alias("owners"))

    def give(state: Column, slot: Column) -> Column:
        shard = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        loads = F.transform(state["loads"], lambda load, i: F.when(i == shard, load - slot["neg"]).otherwise(load))
        return F.struct(loads.alias("loads"), F.concat(state["owners"], F.array(shard)).alias("owners"))

    placed = sizes.groupBy().agg(ordered.alias("slots")).withColumn("owners", F.aggregate("slots", start, give, lambda s: s["owners"]))
    pairs = placed.select(F.explode(F.arrays_zip("slots", "owners")).alias("p"))
    return pairs.select(
        F.lit(1).alias("version"), F.col("p.slots.slot").alias("virtual_slot"), F.col("p.owners").alias("shard"),
        (-F.col("p.slots.neg")).alias("bytes"), F.col("p.slots.n_rows").alias("n_rows"),
    )


def grow_slot_map(slot_map: DataFrame, n_shards: int) -> DataFrame:
    """The next version with one more shard: every old shard hands over its smallest slots beyond the new fair share.

    ``n_shards`` counts the old shards; the new one gets that number. All other slots keep their shard.
    """
    total = slot_map.agg(F.sum("bytes").alias("total"))
    by_shard = Window.partitionBy("shard")
    upto = by_shard.orderBy("bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        slot_map.join(F.broadcast(total))  # one row
        .withColumns({"load": F.sum("bytes").over(by_shard), "upto": F.sum("bytes").over(upto)})
        .withColumn("moves", F.col("upto") <= F.col("load") - F.col("total") / (n_shards + 1))
    )
    return cut.select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.when(F.col("moves"), F.lit(n_shards)).otherwise(F.col("shard")).alias("shard"), "bytes", "n_rows"
    )


MAP_SCHEMA = "virtual_slot int, shard int, bytes long, n_rows long, version int"


def store_slot_map(slot_map: DataFrame, root: str, version: int) -> None:
    """Write a new version of the map below ``root``; older versions stay readable."""
    slot_map.drop("version").coalesce(1).write.parquet(f"{root}/version={version}")


def load_slot_map(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest by default."""
    maps = spark.read.schema(MAP_SCHEMA).option("basePath", root).parquet(root)
    wanted = maps.agg(F.max("version")).first()[0] if version is None else version
    return maps if wanted is None else maps.where(F.col("version") == wanted)


def assign(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add shard and the record's number in it (``slot``, from 0 without gaps).

    The map is broadcast: it has at most ``n_slots`` rows.
    """
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    start, number = fresh("start"), fresh("number")
    starts = slot_map.select("virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias(start))
    place = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return records.withColumn(number, place).join(F.broadcast(starts), "virtual_slot").withColumn("slot", (F.col(start) + F.col(number) - 1).cast("long")).drop(start, number)


def shard_documents(docs: DataFrame, n_shards: int, map_root: str, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard, slot, and the shard after one more is added (``rebalanced_shard``).

    Writes version 1 of the map for ``n_shards`` below ``map_root``, and its edit for one more as version 2.
    """
    text = F.col(text_col)
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    narrow = docs.select(F.col(id_col).alias("doc_id"), record_size(text).alias("size"), crc.alias("text_crc32"), F.monotonically_increasing_id().alias("spread"))
    records = with_virtual_slots(stage(narrow, "records"), n_slots)
    spark = docs.sparkSession
    store_slot_map(build_slot_map(slot_sizes(records, n_slots), n_shards), map_root, 1)
    first = load_slot_map(spark, map_root, 1)
    store_slot_map(grow_slot_map(first, n_shards), map_root, 2)
    grown = load_slot_map(spark, map_root, 2).select("virtual_slot", F.col("shard").alias("rebalanced_shard"))
    return assign(records, first).join(F.broadcast(grown), "virtual_slot")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(read_table(spark, sf_dir, "documents"), 40, scratch(spark, "slot-map"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "rebalanced_shard")


QUERIES = {"op2_sharding": op2_sharding}
ORACLE_SQL: dict[str, str] = {}
