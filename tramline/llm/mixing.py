"""Mixing sources to target weights by entropy balancing.

Every source has a target number of words. Among all rates that meet it, entropy balancing
takes those closest to 1 in relative entropy: a document of `x` times its source's mean size
gets the rate `exp(lambda * x)`, at most `MOST_COPIES`, with one multiplier per source. The multipliers solve
the convex dual, here by Newton steps inside a shrinking bracket. Documents of one
source and size share a rate, so each step is an aggregate over the counts by source and size.
The rates become whole copies by running sums over those counts, largest size first; what is
left of a target is then made up with ever smaller documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import ROWS_PER_WINDOW, WORD, code_point_key, landed, with_parts

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
CLOSE = 1e-7
STEPS = 60
REPAIRS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds `target` to one row per source with `source`, `key` and `source_size`.

    Sources in code-point order, null last, weigh `weights`, repeating, and share all words. No
    target exceeds `MOST_COPIES` times its source; the excess goes to the others by weight until none
    is above. That end point is min(limit, weight * level) for one level, found here with one
    sort by limit / weight: the sources at their limit come first.
    """
    # One row per source, so one task sees as many rows as there are sources.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    limited = sources.withColumn("weight", weight.cast("double")).withColumn(
        "limit", F.col("source_size").cast("double") * MOST_COPIES
    )
    tightest = Window.orderBy(F.col("limit") / F.col("weight"), "key")
    below = tightest.rowsBetween(Window.unboundedPreceding, -1)
    rest = tightest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total - F.coalesce(F.sum("limit").over(below), F.lit(0.0))) / F.sum("weight").over(rest)
    free = limited.withColumn("level", level).withColumn(
        "free_level", F.when(F.col("limit") >= F.col("weight") * F.col("level"), F.col("level"))
    )
    # From the first source that is free, every later one is free too, at that first level.
    first = F.first("free_level", ignorenulls=True).over(
        tightest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return free.withColumn(
        "target", F.coalesce(F.least("limit", F.col("weight") * first), F.col("limit"))
    ).select("source", "key", "source_size", "target")


def _rate(multiplier: Column, x: Column) -> Column:
    return F.least(F.exp(multiplier * x), F.lit(float(MOST_COPIES)))


def solve_dual(classes: DataFrame, targets: DataFrame) -> DataFrame:
    """`key, mean, lam`: the multiplier of every source with words and a target."""
    infinity = F.lit(float("inf"))
    full = F.col("target") >= F.col("source_size") * (MOST_COPIES * (1 - 1e-12))
    state = landed(
        classes.groupBy("key")
        .agg(F.sum("n").alias("documents"))
        .join(targets, "key")
        .select(
            "key",
            "target",
            (F.col("source_size") / F.col("documents")).alias("mean"),
            F.when(full, infinity).otherwise(F.log(F.col("target") / F.col("source_size"))).alias("lam"),
            F.lit(float("-inf")).alias("low"),
            infinity.alias("high"),
            full.alias("done"),
        ),
        "dual",
    )
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        tilted = F.exp(F.col("lam") * x)
        mass = F.col("n") * F.col("size")
        slopes = (
            classes.join(state.filter(~F.col("done")), "key")
            .groupBy("key")
            .agg(
                F.sum(mass * _rate(F.col("lam"), x)).alias("taken"),
                F.sum(F.when(tilted < MOST_COPIES, mass * x * tilted).otherwise(0.0)).alias("slope"),
            )
        )
        over = F.col("taken") - F.col("target")
        low = F.when(over <= 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - over / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        halved = (
            F.when(F.col("high") == infinity, F.greatest(F.col("low") * 2, F.lit(1.0)))
            .when(F.col("low") == -infinity, F.least(F.col("high") * 2, F.lit(-1.0)))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        met = F.abs(over) <= CLOSE * F.col("target")
        settled = F.col("done") | F.col("taken").isNull()
        state = landed(
            state.join(slopes, "key", "left")
            .withColumns({"low": F.when(settled, F.col("low")).otherwise(low), "high": F.when(settled, F.col("high")).otherwise(high)})
            .withColumn(
                "lam",
                F.when(settled | met, F.col("lam")).when(inside, newton).otherwise(halved),
            )
            .withColumn("done", settled | met)
            .select("key", "target", "mean", "lam", "low", "high", "done"),
            "dual",
        )
        if not state.filter(~F.col("done")).limit(1).count():
            break
    return state.select("key", "mean", "lam")


def whole_copies(classes: DataFrame, rates: DataFrame, targets: DataFrame) -> DataFrame:
    """`key, size, n, copies`: how many copies all documents of a source and size get together."""
    by_size = Window.partitionBy("key").orderBy(F.desc("size"))
    upto = by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = by_size.rowsBetween(Window.unboundedPreceding, -1)
    most = F.col("n") * MOST_COPIES
    # A window holds one row per size of its source, however many documents there are.
    counts = (
        classes.join(rates, "key")
        .join(targets.select("key", "target"), "key")
        .withColumn("wanted", F.col("n") * _rate(F.col("lam"), F.col("size") / F.col("mean")))
        .withColumn("sofar", F.floor(F.sum("wanted").over(upto) + 0.5))
        .withColumn("copies", F.col("sofar") - F.coalesce(F.lag("sofar").over(by_size), F.lit(0)))
        .withColumn("copies", F.greatest(F.lit(0), F.least(F.col("copies"), most)).cast("long"))
    )
    for _ in range(REPAIRS):
        missing = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("key"))
        room = F.when(F.col("missing") > 0, most - F.col("copies")).otherwise(F.col("copies"))
        counts = (
            counts.withColumn("missing", missing)
            .withColumn("room", F.when(F.col("size") <= F.abs("missing"), room).otherwise(F.lit(0)))
            .withColumn("made_up", F.coalesce(F.sum(F.col("room") * F.col("size")).over(before), F.lit(0)))
            .withColumn("step", F.floor((F.abs("missing") - F.col("made_up")) / F.col("size")))
            .withColumn("step", F.greatest(F.lit(0), F.least("step", "room")))
            .withColumn("copies", (F.col("copies") + F.signum("missing") * F.col("step")).cast("long"))
        )
    return counts.select("key", "size", "n", "copies")


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, row: str | None = None) -> DataFrame:
    """`doc_id, source, size, source_size, target, copies` of every document with `doc_id, source, text`.

    `size` is the number of words; a null text has none, and documents without words get no
    copies. A null source is a source of its own. Rows with equal doc_id are documents of their
    own, and a hash of the doc_id decides which documents of one source and size get one copy more
    than others, so reruns agree. Without documents the result is empty. `row` names a column that numbers the rows; it
    comes too and orders those that repeat a doc_id.
    """
    also = [row] if row else []
    number = (F.col(row) if row else F.monotonically_increasing_id()).alias("_number")
    sizes = landed(
        documents.select("doc_id", "source", code_point_key("source").alias("key"), words(F.col("text")).alias("size"), number, *also),
        "sizes",
    )
    counts = landed(sizes.groupBy("source", "key", "size").agg(F.count(F.lit(1)).alias("n")), "classes")
    targets = landed(
        source_targets(counts.groupBy("source", "key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))),
        "targets",
    )
    classes = counts.filter("size > 0").drop("source")
    rates = solve_dual(classes, targets.filter("source_size > 0"))
    copies = landed(whole_copies(classes, rates, targets), "copies")

    # Copies of a source and size go to buckets of its documents in proportion, then to documents.
    bucket = F.pmod(F.xxhash64("doc_id", "part"), F.ceil(F.col("n") / F.lit(ROWS_PER_WINDOW)))
    spread = with_parts(sizes.filter("size > 0"), ["doc_id", "key", "size"], "_number", "part").drop("_number")
    dealt = landed(spread, "spread").join(copies, ["key", "size"]).withColumn("bucket", bucket)
    buckets = dealt.groupBy("key", "size", "bucket").agg(
        F.count(F.lit(1)).alias("here"), F.first("n").alias("n"), F.first("copies").alias("copies")
    )
    upto = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.expr("(cast(copies as decimal(19, 0)) * cast(upto as decimal(19, 0))) div n")
    shares = (
        buckets.withColumn("upto", F.sum("here").over(upto))
        .withColumn("share", share)
        .withColumn("own", F.col("share") - F.coalesce(F.lag("share").over(Window.partitionBy("key", "size").orderBy("bucket")), F.lit(0)))
        .select("key", "size", "bucket", "here", "own")
    )
    rank = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", *also))
    # Dealt out by bucket explicitly: after the join Spark would keep all of a source and size in one task.
    each = (
        dealt.select("doc_id", "source", "key", "size", "bucket", *also)
        .repartition("key", "size", "bucket")
        .withColumn("rank", rank)
        .join(shares, ["key", "size", "bucket"])
        .withColumn("copies", F.expr("(own * rank) div here - (own * (rank - 1)) div here"))
        .select("doc_id", "source", "key", "size", F.col("copies").cast("long").alias("copies"), *also)
    )
    wordless = sizes.filter("size = 0").drop("_number").withColumn("copies", F.lit(0).cast("long"))
    return (
        each.unionByName(wordless)
        .join(targets.select("key", "source_size", "target"), "key")
        .select("doc_id", "source", "size", "source_size", "target", "copies", *also)
    )
