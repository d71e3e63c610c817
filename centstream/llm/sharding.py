"""Sharding by fixed virtual slots.

Records hash into ``SLOTS`` fixed slots by their text, so equal texts share a slot and a
shard. Only the copies of a text whose bytes alone are over ``HEAVY`` of a shard's fair share
are dealt over slots, by id; there can be no more than ``SHARDS / HEAVY`` such texts. Bytes
are added up per slot, and a slot-to-shard map is made from those sums: largest slot first,
each to the shard with the least bytes so far. Law: ``bytes``.

The map is versioned and stored where the caller says (``store_map``, ``latest_map``). Where
there is one, ``rebalance`` edits it, so that only slots move that an overfull shard gives up.

Only DataFrame functions are used. The map has ``SLOTS`` entries whatever the input, so
it may be one row and be broadcast. A row's place in its shard is the number of rows of
the shard's earlier slots, plus those of the slot's earlier ranges of a row hash, plus its
place in its range; no shard and no slot is sorted as a whole.

Null texts count as 8 bytes, as empty ones do, and are one text with them. A null id hashes
like any value. Texts of any length are one record. Rows with equal id and text get places of
their own. Other columns are ignored, or kept by ``assigned``, where columns named like its
results are replaced. No rows: an empty result.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from centstream.llm.store import packed, stored
from centstream.sources.files import Folder

SLOTS = 4096
SHARDS = 24
#: Ranges of a row hash in each slot, in which rows are numbered.
RANGES = 64
#: Share of a shard's fair share from which on a text's copies are dealt over slots.
HEAVY = 0.5
#: Bytes that a record takes besides its text.
OVERHEAD = 8
#: Share of the mean that a shard may be above it before it gives up slots.
TOLERANCE = 0.02

RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _record(docs: DataFrame) -> list[Column]:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    content = F.coalesce("text", F.lit("")).cast("binary")
    return [
        size.alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.struct(F.xxhash64(content), F.crc32(content), F.length(content)).alias("_text"),
        F.xxhash64(F.lit(3), F.col("doc_id").cast("long")).alias("_row"),
    ]


def heavy_texts(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(_text, _heavy) of texts whose copies are to be dealt over slots: ``shards / HEAVY`` at most."""
    sums = records.groupBy("_text").agg(F.sum("size").alias("bytes"), F.count("*").alias("copies"))
    total = records.agg(F.sum("size")).scalar()
    heavy = sums.filter((F.col("copies") > 1) & (F.col("bytes") * shards > total * HEAVY))
    return heavy.select(F.col("_text").alias("_same"), F.lit(True).alias("_heavy"))


def _slotted(records: DataFrame, shards: int) -> DataFrame:
    """Records with their slot and their range within it."""
    heavy = stored(heavy_texts(records.select("_text", "size"), shards), "heavy-texts")
    joined = records.join(F.broadcast(heavy), F.col("_text") == F.col("_same"), "left")
    hashed = F.when(F.col("_heavy"), F.xxhash64("_text", "_row")).otherwise(F.xxhash64("_text"))
    return joined.select(
        *records.columns,
        F.pmod(hashed, F.lit(SLOTS)).cast("int").alias("_vslot"),
        F.pmod(F.xxhash64("_row", "_text"), F.lit(RANGES)).cast("int").alias("_range"),
    )


def range_sums(slotted: DataFrame) -> DataFrame:
    """Bytes and rows per slot and range; at most ``SLOTS * RANGES`` rows."""
    return slotted.groupBy("_vslot", "_range").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("records")
    )


def slot_sums(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Bytes and rows of every slot, empty ones included; at most ``SLOTS`` rows."""
    return _per_slot(range_sums(_slotted(docs.select(*_record(docs)), shards)))


def _per_slot(ranges: DataFrame) -> DataFrame:
    sums = ranges.groupBy("_vslot").agg(F.sum("bytes").alias("bytes"), F.sum("records").alias("records"))
    every = ranges.sparkSession.range(0, SLOTS, 1, 1).select(F.col("id").cast("int").alias("_vslot"))
    return every.join(F.broadcast(sums), "_vslot", "left").na.fill(0, ["bytes", "records"])


def _dealt(loads: Column, slots: Column) -> Column:
    """Shard of each of ``slots`` (largest first), each to the least loaded shard."""
    start = F.struct(loads.alias("loads"), F.expr("cast(array() as array<int>)").alias("shards"))

    def place(state, slot):
        to = F.array_position(state.loads, F.array_min(state.loads)).cast("int")
        raised = F.transform(
            state.loads, lambda load, i: F.when(i == to - 1, load + slot.bytes).otherwise(load)
        )
        return F.struct(
            raised.alias("loads"), F.concat(state.shards, F.array(to - 1)).alias("shards")
        )

    return F.aggregate(slots, start, place, lambda state: state.shards)


def _ordered(rows: DataFrame) -> Column:
    """Array of (bytes, slot), largest first, of the fixed number of slots."""
    return F.array_sort(
        F.collect_list(F.struct((-F.col("bytes")).alias("less"), "_vslot", "bytes"))
    )


def _mapped(one_row: DataFrame, version: int) -> DataFrame:
    pairs = F.explode(F.arrays_zip("slots", "shards"))
    return one_row.select(pairs.alias("p")).select(
        F.lit(version).alias("version"),
        F.col("p.slots._vslot").alias("_vslot"),
        F.col("p.shards").alias("shard"),
    )


def first_map(sums: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 1 of the map: (version, _vslot, shard)."""
    row = sums.agg(_ordered(sums).alias("slots"))
    loads = F.array_repeat(F.lit(0).cast("long"), shards)
    return _mapped(row.withColumn("shards", _dealt(loads, F.col("slots"))), 1)


def rebalance(
    old: DataFrame, sums: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Next version of a map for new sums and perhaps another number of shards.

    A shard keeps its slots, smallest first, up to the mean and ``tolerance``; the rest,
    and the slots of shards that are gone, are dealt out anew.
    """
    both = old.join(F.broadcast(sums), "_vslot")
    running = Window.partitionBy("shard").orderBy("bytes", "_vslot")
    total = Window.partitionBy(F.lit(0))
    marked = both.select(
        "version", "_vslot", "shard", "bytes",
        F.sum("bytes").over(running.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        (F.sum("bytes").over(total) / shards * (1 + tolerance)).alias("most"),
    ).withColumn("stays", (F.col("shard") < shards) & (F.col("upto") <= F.col("most")))
    slot = F.struct((-F.col("bytes")).alias("less"), "_vslot", "bytes")
    kept = F.struct("_vslot", "shard", "bytes")
    row = marked.agg(
        F.max("version").alias("version"),
        F.array_sort(F.collect_list(F.when(~F.col("stays"), slot))).alias("slots"),
        F.collect_list(F.when(F.col("stays"), kept)).alias("kept"),
    )
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.aggregate(
            F.filter("kept", lambda k: k.shard == i),
            F.lit(0).cast("long"),
            lambda load, k: load + k.bytes,
        ),
    )
    row = row.withColumn("shards", _dealt(loads, F.col("slots")))
    moved = row.select(
        (F.col("version") + 1).alias("version"),
        F.explode(F.arrays_zip("slots", "shards")).alias("p"),
    ).select("version", F.col("p.slots._vslot").alias("_vslot"), F.col("p.shards").alias("shard"))
    stayed = row.select((F.col("version") + 1).alias("version"), F.explode("kept").alias("k"))
    return moved.unionByName(stayed.select("version", "k._vslot", "k.shard"))


def store_map(slot_map: DataFrame, path: str) -> int:
    """Write a map under its version in the folder ``path``; that version."""
    slot_map = stored(slot_map, "slot-map")
    version = slot_map.agg(F.max("version")).first()[0]
    slot_map.write.parquet(f"{path}/version={version}")
    return version


def latest_map(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest map under ``path``, or None."""
    files = Folder(spark, path)
    done = [int(v) for v in files.children("", "version=") if files.exists(f"version={v}/_SUCCESS")]
    if not done:
        return None
    rows = spark.read.parquet(f"{path}/version={max(done)}")
    return rows.select(F.lit(max(done)).alias("version"), "_vslot", "shard")


def _mapped_slots(sums: DataFrame, shards: int, maps: str | None) -> DataFrame:
    """The map in force: made from the sums, or the stored one rebalanced and stored again."""
    old = latest_map(sums.sparkSession, maps) if maps else None
    made = first_map(sums, shards) if old is None else rebalance(old, sums, shards)
    if maps:
        store_map(made, maps)
        return latest_map(sums.sparkSession, maps)
    return stored(made, "slot-map")


def _numbered(docs: DataFrame, columns: list[str], shards: int, maps: str | None) -> DataFrame:
    rows = docs.select(packed(columns), F.col("doc_id").alias("_doc"), *_record(docs))
    slotted = _slotted(rows, shards)
    ranges = stored(range_sums(slotted), "range-sums")
    slot_map = _mapped_slots(stored(_per_slot(ranges), "slot-sums"), shards, maps)
    by_shard = Window.partitionBy("shard").orderBy("_vslot", "_range")
    before = F.sum("records").over(by_shard.rowsBetween(Window.unboundedPreceding, -1))
    places = ranges.join(F.broadcast(slot_map), "_vslot").select(
        "_vslot", "_range", "shard", F.coalesce(before, F.lit(0)).alias("_before")
    )
    within = F.row_number().over(Window.partitionBy("_vslot", "_range").orderBy("_row", "_text", "_doc"))
    return (
        slotted.withColumn("_within", within)
        .join(F.broadcast(places), ["_vslot", "_range"])  # SLOTS * RANGES rows at most
        .select(
            "kept.*",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("_before") + F.col("_within") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def assignment(docs: DataFrame, shards: int = SHARDS, maps: str | None = None) -> DataFrame:
    """Shard and place of each document, by ``doc_id``; ``maps`` is the folder of stored maps."""
    return _numbered(docs.select("doc_id", "text"), ["doc_id"], shards, maps)


def assigned(docs: DataFrame, shards: int = SHARDS, maps: str | None = None) -> DataFrame:
    """The documents with their shard and place."""
    kept = [c for c in docs.columns if c.lower() not in RESULTS]
    return _numbered(docs, kept, shards, maps)
