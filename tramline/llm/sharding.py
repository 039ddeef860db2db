"""Sharding by balanced label propagation.

Linked documents start on hashed shards. In each round a group nominates the shards that hold most of its
documents and still take some; documents on shards with fewer of their group want to move there.
Quotas per pair of shards admit as many moves as swap places or fit free capacity, so sizes stay even while links
between shards become fewer. At the end documents without links fill what is left, and counts differ by
one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import ROWS_PER_WINDOW, landed, last_at_most, numbered, with_parts

SHARDS = 16
ROUNDS = 10
# Rounds end when fewer than this share of the linked documents move.
STILL = 0.001
# A shard takes more documents while this share of its capacity is free.
OPEN = 0.002


def _draw(*columns) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def nominations(labels: DataFrame, capacity: int) -> DataFrame:
    """`group, label, targets`: for each shard a group should leave, where its documents there may go.

    A group keeps the shards that hold most of it and still take documents, as many as it needs to
    have room for all; `targets` are those, each with the upper end of its part of [0, 1).
    """
    counts = labels.groupBy("group", "label").agg(F.count(F.lit(1)).alias("here"))
    loads = counts.groupBy("label").agg((F.lit(capacity) - F.sum("here")).alias("free"))
    # Equal counts are ordered by a hash, so that small groups do not all prefer the same shard.
    rank = F.struct("here", F.xxhash64("group", "label").alias("tie"), "label")
    takes = F.col("free") > OPEN * capacity
    # At most one row per shard in a window.
    best_first = Window.partitionBy("group").orderBy(F.desc("rank"))
    before = F.coalesce(
        F.sum(F.when(takes, F.col("here") + F.col("free"))).over(best_first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    total = F.sum(F.when(takes, F.col("here"))).over(Window.partitionBy("group"))
    ranked = (
        counts.join(F.broadcast(loads), "label")
        .withColumn("rank", rank)
        .withColumn("kept", takes & (before < total))
        .withColumn("room", F.when(F.col("kept"), F.col("free")))
        .withColumn("upto", F.sum("room").over(best_first) / F.sum("room").over(Window.partitionBy("group")))
    )
    target = F.when(F.col("kept"), F.struct("upto", "label"))
    targets = ranked.groupBy("group").agg(
        F.sort_array(F.collect_list(target)).alias("targets"), F.max(F.when(F.col("kept"), F.col("rank"))).alias("best")
    )
    return (
        ranked.join(targets, "group")
        .filter(~F.col("kept") & (F.col("best") > F.col("rank")))
        .select("group", "label", "targets")
    )


def _admitted(wishes: DataFrame, loads: DataFrame, capacity: int) -> DataFrame:
    """`label, to, share`: the share of the wishes from one shard to another that is granted."""
    wanted = wishes.groupBy("label", "to").agg(F.count(F.lit(1)).alias("wanted"))
    back = wanted.select(F.col("label").alias("to"), F.col("to").alias("label"), F.col("wanted").alias("back"))
    free = loads.select(F.col("label").alias("to"), F.greatest(F.lit(0), F.lit(capacity) - F.col("load")).alias("free"))
    # Shards squared rows at most.
    swaps = wanted.join(back, ["label", "to"], "left").withColumn(
        "swapped", F.least("wanted", F.coalesce("back", F.lit(0)))
    )
    rest = F.col("wanted") - F.col("swapped")
    into = F.sum(rest).over(Window.partitionBy("to"))
    room = F.when(into > 0, F.least(F.lit(1.0), F.coalesce("free", F.lit(capacity)) / into)).otherwise(0.0)
    return swaps.join(free, "to", "left").select(
        "label", "to", ((F.col("swapped") + rest * room) / F.col("wanted")).alias("share")
    )


def propagate(members: DataFrame, capacity: int, shards: int = SHARDS) -> DataFrame:
    """Adds `label` to linked rows with `who` and `group`: labels few groups are split over. `who` is a hash that few rows share."""
    labels = landed(members.withColumn("label", F.pmod("who", F.lit(shards)).cast("int")), "labels")
    linked = labels.count()
    for number in range(ROUNDS if linked else 0):
        chosen = F.filter("targets", lambda t: t["upto"] > _draw("who", F.lit(-1 - number)))
        nominated = landed(nominations(labels, capacity), "nominated")
        wishes = labels.join(nominated, ["group", "label"], "left")
        wishes = landed(wishes.withColumn("to", F.get(chosen, F.lit(0))["label"]).drop("targets"), "wishes")
        loads = wishes.groupBy("label").agg(F.count(F.lit(1)).alias("load"))
        granted = _admitted(wishes.filter(F.col("to").isNotNull()), loads, capacity)
        moves = F.col("share").isNotNull() & (_draw("who", F.lit(number)) < F.col("share"))
        stepped = wishes.join(F.broadcast(granted), ["label", "to"], "left").withColumn("moves", moves)
        labels = landed(
            stepped.withColumn("label", F.when(F.col("moves"), F.col("to")).otherwise(F.col("label"))).drop("to", "share"),
            "labels",
        )
        if labels.filter("moves").count() <= STILL * linked:
            break
        labels = labels.drop("moves")
    return labels.drop("moves")


def assign_shards(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`doc_id, size, text_crc32, group, shard, slot` for every row with `doc_id` and `text`.

    Documents with equal texts are linked. Shards hold equally many rows, or one more or less;
    `slot` is gapless from 0 in each. `size` is the text's UTF-8 bytes plus 1. A null text
    counts as empty and is linked with empty ones; rows that repeat a doc_id are placed one by one.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = landed(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    total = rows.count()
    # Landed, so that both sides of the join are plain shuffles, of which Spark splits hot groups.
    groups = landed(rows.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "groups")
    counted = with_parts(rows.join(groups, "group", "left").fillna(1, "members"), ["doc_id"], "row", "part")
    counted = landed(counted.withColumn("who", F.xxhash64("doc_id", "part")).drop("part"), "counted")
    capacity = max(1, total // shards)
    linked = propagate(counted.filter("members > 1"), capacity, shards)

    # Rows of one group are numbered one after the other, so a full shard gives up whole groups.
    part = F.pmod(F.xxhash64("row"), F.ceil(F.col("members") / F.lit(ROWS_PER_WINDOW)))
    order = ["group", "doc_id", "size"]
    placed = landed(
        numbered(linked, ["label"], order, "slot", deal=F.xxhash64("group", part)).withColumn(
            "limit", F.lit(total // shards) + (F.col("label") < total % shards).cast("long")
        ),
        "placed",
    )
    kept = placed.filter("slot < limit").withColumn("shard", F.col("label"))
    columns = ["doc_id", "size", "text_crc32", "group", "shard", "slot"]
    pool = landed(
        counted.filter("members = 1").unionByName(placed.filter("slot >= limit"), allowMissingColumns=True)
        .select("doc_id", "size", "text_crc32", "group", part.alias("part")),
        "pool",
    )
    held = {r["shard"]: r["count"] for r in kept.groupBy("shard").count().collect()}
    starts, upto = [], 0
    for shard in range(shards):
        starts.append(upto)
        upto += total // shards + (shard < total % shards) - held.get(shard, 0)
    shard = last_at_most(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("rank"))
    filled = (
        numbered(pool, [], order, "rank", deal=F.xxhash64("group", "part"))
        .withColumn("shard", shard)
        .withColumn("slot", F.col("rank") - F.get(F.array(*[F.lit(s - held.get(n, 0)).cast("long") for n, s in enumerate(starts)]), "shard"))
    )
    return kept.select(columns).unionByName(filled.select(columns))
