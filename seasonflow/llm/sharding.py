"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots. Bytes are summed for each slot, and a
stored, versioned map says which shard a slot belongs to. Rebalancing writes the next version of
the map and moves as few slots as it can; records never change their slot.

Defined results: a null text has no bytes and the CRC of the empty text; a null id is hashed like
any other value; repeated rows are rows of their own; an empty table gives an empty result and an
untouched map; columns beyond the named ones are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seasonflow.llm.common import table
from seasonflow.llm.registry import query
from seasonflow.session import literal_table, scratch_path, settle

SLOTS = 8192
SHARDS = 40
#: Parts of a virtual slot that holds more than its part's share of all records.
PARTS = 1024
#: Records up to which a slot is numbered in one task anyway.
LEAST_HOT = 100_000
#: Bytes that a record has besides its text.
RECORD_BYTES = 16
MAP_SCHEMA = "version int, virtual_slot int, shard int"


def virtual_slot(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """One narrow row for each record: what sharding needs, without the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        virtual_slot(F.col(key), slots).alias("virtual_slot"),
        F.monotonically_increasing_id().alias("part"),
    )


def slot_loads(rows: DataFrame) -> DataFrame:
    """Bytes and records of each virtual slot: at most ``slots`` rows, summed before the shuffle."""
    return rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def first_map(slots: int = SLOTS, shards: int = SHARDS) -> dict[int, int]:
    return {s: s * shards // slots for s in range(slots)}


def rebalance(current: dict[int, int], loads: dict[int, int], shards: int = SHARDS) -> dict[int, int]:
    """Edits the map until the shards' bytes are as equal as single moves and swaps make them.

    Slots of shards that no longer exist go first. Then the fullest shard gives the emptiest one the
    slot, or changes with it the two slots, whose difference comes nearest to half the gap. The work
    depends on the number of slots, which is fixed, and not on the data.
    """
    result = dict(current)
    own: list[dict[int, int]] = [{} for _ in range(shards)]
    total = [0] * shards
    homeless = []
    for slot, shard in result.items():
        if shard < shards:
            own[shard][slot] = loads.get(slot, 0)
            total[shard] += loads.get(slot, 0)
        else:
            homeless.append(slot)
    heap = [(t, s) for s, t in enumerate(total)]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda s: (-loads.get(s, 0), s)):
        _, shard = heapq.heappop(heap)
        result[slot] = shard
        own[shard][slot] = loads.get(slot, 0)
        total[shard] += loads.get(slot, 0)
        heapq.heappush(heap, (total[shard], shard))
    for _ in range(4 * len(result)):
        full = max(range(shards), key=lambda s: (total[s], -s))
        low = min(range(shards), key=lambda s: (total[s], s))
        gap = total[full] - total[low]
        best = _best_change(own[full], own[low], gap)
        if best is None:
            break
        give, take = best
        for slot, source, to in ((give, full, low), (take, low, full)):
            if slot is not None:
                load = own[source].pop(slot)
                own[to][slot] = load
                total[source] -= load
                total[to] += load
                result[slot] = to
    return result


def _best_change(full: dict[int, int], low: dict[int, int], gap: int) -> tuple[int, int | None] | None:
    """The slot to give, and the one to take for it if any; None if nothing narrows the gap."""
    takes = sorted((load, slot) for slot, load in low.items())
    best, choice = gap, None
    for slot, load in full.items():
        if 0 < load < gap and abs(gap - 2 * load) < best:
            best, choice = abs(gap - 2 * load), (slot, None)
    if best > max(1, gap // 4) or choice is None:
        sizes = [x[0] for x in takes]
        from bisect import bisect_left

        for slot, load in full.items():
            i = bisect_left(sizes, load - gap / 2)
            for j in (i - 1, i):
                if 0 <= j < len(takes) and abs(gap - 2 * (load - takes[j][0])) < best:
                    best, choice = abs(gap - 2 * (load - takes[j][0])), (slot, takes[j][1])
    return choice


def store_map(spark: SparkSession, path: str, version: int, mapping: dict[int, int]) -> None:
    """Appends one version; earlier ones stay, so that every shard ever written can be found."""
    rows = [(version, s, k) for s, k in sorted(mapping.items())]
    literal_table(spark, rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[int, int]]:
    """The given or the newest version of a stored map; its size is the fixed number of slots."""
    stored = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    rows = stored.where(F.col("version") == version).select("virtual_slot", "shard").collect()
    return version, {r.virtual_slot: r.shard for r in rows}


def rebalance_stored(spark: SparkSession, path: str, rows: DataFrame, shards: int = SHARDS) -> int:
    """Reads the newest map, edits it for the bytes of ``rows``, stores and returns the next version."""
    version, current = load_map(spark, path)
    loads = {r.virtual_slot: r.bytes for r in slot_loads(rows).collect()}  # at most SLOTS rows
    store_map(spark, path, version + 1, rebalance(current, loads, shards))
    return version + 1


def assign(rows: DataFrame, spark: SparkSession, path: str, version: int) -> DataFrame:
    """Adds the shard of a map's version, and a gapless position in the shard.

    Positions come from the counts of the virtual slots before a slot in its shard, and a row number
    in the slot: no task holds a shard. ``rows`` is a stored table with ``part`` (a number that spreads
    equal records too); a slot with more than one of ``PARTS`` of all records (null or much repeated ids)
    is numbered by its parts, so no task holds it either. There are fewer than ``PARTS`` such slots.
    """
    _, mapping = load_map(spark, path, version)
    counts = {r.virtual_slot: r.records for r in slot_loads(rows).collect()}
    most = max(sum(counts.values()) // PARTS, LEAST_HOT)
    bases, base = [], {}
    for slot, shard in sorted(mapping.items()):
        bases.append((slot, shard, base.get(shard, 0), counts.get(slot, 0) > most))
        base[shard] = base.get(shard, 0) + counts.get(slot, 0)
    placed = literal_table(spark, bases, "virtual_slot int, shard int, base long, hot boolean")
    dealt = rows.join(F.broadcast(placed), "virtual_slot")
    dealt = dealt.withColumn("part", F.when(F.col("hot"), F.pmod("part", F.lit(PARTS))).otherwise(0))
    order = Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = dealt.withColumn("place", F.col("base") + F.row_number().over(order) - 1)
    sizes = dealt.where("hot").groupBy("virtual_slot", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("virtual_slot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = settle(sizes.select("virtual_slot", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    whole = numbered.join(shifts, ["virtual_slot", "part"], "left")
    return whole.withColumn("slot", F.col("place") + F.coalesce("shift", F.lit(0)))


@query("op8_virtual_slots")
def virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    rows = settle(digests(table(spark, folder, "documents")))
    path = scratch_path(spark, "slot-map")
    store_map(spark, path, 1, first_map())
    version = rebalance_stored(spark, path, rows)
    return assign(rows, spark, path, version).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(version).alias("map_version"),
    )
