"""Sharding by fixed virtual slots.

Records hash into thousands of slots, a number that never changes, by their id and their text's
checksum. Records that are alike in both are counted, and every ``ALIKE`` of them hash under a
number of their own, so that neither one id nor one text can fill a slot. Bytes are summed per slot,
and a small versioned map says which shard holds each slot. Rebalancing edits the map: slots
stay where they are while their shard is within its fair share, the others go, largest first,
to the shard with the fewest bytes. A new map is an edit of an empty one. Only the map ever
passes through one task; it has as many rows as there are slots, whatever the data.

Defined cases: a null text has no bytes and size 1; rows without a doc_id are hashed as an id of
their own; up to ``ALIKE`` repeated rows fall into one slot and get different places in their
shard; an empty table gives an empty result and a map that deals empty slots round. Columns other than
the two named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, stash, whole_text

SLOTS = 4096
#: Equal records that share a slot, and how many of them are dealt out at once.
ALIKE, DEALT = 16, 1 << 16


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: 32 bits of the key's MD5, modulo the fixed number of slots."""
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % slots).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """What sharding needs of each record; the text itself is not carried further."""
    text = whole_text("text")
    alike = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    ).groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    # In two steps, so that no row has to hold a number for each of very many records.
    parts = alike.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / DEALT))).alias("part"))
    first = F.col("part") * DEALT
    each = parts.select(
        "doc_id", "size", "text_crc32", F.explode(F.sequence(first, F.least(first + DEALT, F.col("n")) - 1)).alias("number"))
    block = F.floor(F.col("number") / ALIKE)
    key = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("text_crc32").cast("string"),
        F.when(block > 0, block.cast("string")))
    return each.select("doc_id", "size", "text_crc32", virtual_slot(key.cast("binary"), slots).alias("vslot"))


def slot_bytes(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones included."""
    every = recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    found = recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return every.join(found, "vslot", "left").fillna(0, ["bytes", "rows"])


def edit_map(usage: DataFrame, shards: int, version: int, old: DataFrame | None = None) -> DataFrame:
    """A map (version, vslot, shard) for ``shards`` shards, near to equal in bytes.

    ``usage`` is from ``slot_bytes``; ``old`` is the map in force. Both have one row per slot.
    """
    known = usage.join(old.select("vslot", "shard"), "vslot", "left") if old is not None else usage.withColumn("shard", F.lit(None).cast("int"))
    known = known.withColumn("shard", F.when(F.col("shard") < shards, F.col("shard")))
    # Empty slots have nothing to balance: they stay, or are dealt round.
    known = known.withColumn(
        "shard", F.when((F.col("bytes") == 0) & F.col("shard").isNull(), F.col("vslot") % shards).otherwise(F.col("shard")))
    fair = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards
    filled = F.sum("bytes").over(Window.partitionBy("shard").orderBy("bytes", "vslot"))
    marked = known.withColumn("fair", fair).withColumn("filled", filled)
    stays = marked.withColumn(
        "stays", F.col("shard").isNotNull() & ((F.col("bytes") == 0) | (F.col("filled") <= F.col("fair"))))
    whole = stays.agg(
        F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct(-F.col("bytes"), F.col("vslot"))))).alias("pool"),
        *(F.coalesce(F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes"))), F.lit(0)).alias(f"l{s}")
          for s in range(shards)))
    loads = F.array(*(F.col(f"l{s}") for s in range(shards)))

    def place(acc: Column, slot: Column) -> Column:
        to = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        return F.struct(
            F.transform(acc["loads"], lambda x, i: F.when(i == to, x - slot["col1"]).otherwise(x)).alias("loads"),
            F.concat(acc["picks"], F.array(F.struct(slot["vslot"].alias("vslot"), to.alias("moved")))).alias("picks"))

    start = F.struct(loads.alias("loads"), F.array().cast("array<struct<vslot:int,moved:int>>").alias("picks"))
    moved = whole.select(F.explode(F.aggregate("pool", start, place)["picks"]).alias("p")).select("p.*")
    return stays.join(moved, "vslot", "left").select(
        F.lit(version).alias("version"), "vslot", F.coalesce("moved", "shard").cast("int").alias("shard"))


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add the map's versions to those stored at ``path``; a version is written once."""
    slot_map.write.partitionBy("version").mode("append").parquet(path)


def load_map(spark, path: str, version: int | None = None) -> DataFrame:
    """One stored version, by default the latest."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.filter(F.col("version") == version).select("version", "vslot", "shard")


def place_in_shard(recs: DataFrame, slot_map: DataFrame, usage: DataFrame) -> DataFrame:
    """Add ``shard`` and ``slot``, the record's gapless place in its shard.

    A place is the rows of the shard's earlier virtual slots plus the rank within the own slot,
    so no shard is ever sorted as a whole.
    """
    rows_before = F.sum("rows").over(
        Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1))
    table = slot_map.join(usage, "vslot").select(
        "vslot", "shard", F.coalesce(rows_before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    ranked = recs.withColumn("rank", rank)
    # One row per slot, a fixed number.
    return ranked.join(F.broadcast(table), "vslot").withColumn(
        "slot", (F.col("before") + F.col("rank") - 1).cast("long")).drop("before", "rank")


def shard_by_bytes(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Every document with its shard under the law ``bytes``; the map is stored and read back."""
    recs = stash(records(docs, slots), "shard-records")
    usage = stash(slot_bytes(recs, slots), "slot-bytes")
    path = map_path or scratch(docs.sparkSession, "slot-map")
    save_map(edit_map(usage, shards, version=1), path)
    placed = place_in_shard(recs, load_map(docs.sparkSession, path, 1), usage)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"))
