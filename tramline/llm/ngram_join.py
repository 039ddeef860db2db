"""Similarity join on word n-grams: rare-first prefixes, four filters, each pair verified once.

The n-grams of a text are put in one global order, rare ones first. Two sets whose Jaccard
similarity reaches the threshold share an n-gram among the first few of each, the prefix.
Candidates meet in the list of a prefix n-gram and must pass

    length      the smaller set must be large enough for the larger one,
    position    what follows the shared n-gram must be able to hold the needed overlap,
    suffix      counts of both sets over slices of the hash space bound their difference from below,

before the exact overlap is computed, once for each pair. Equal sets are joined first and take part once.

A list may hold a large group of near copies, of which all pairs would be too many. So the join has rounds: first
each text is compared with one leader of each of its lists. Then components are known, and pairs are
made only between texts of a list that lie in different components. Leaders are chosen
anew for a few rounds; the last round leaves no such pair out, so no component is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import bit_filter, handing_back, in_filter, in_slices, landed, no_rows, removed, ship_package
from tramline.llm.shingles import run_hashes, shingle_sets, texts_at_once, whole_sequence, word_hashes

WORDS = 3
PERCENT = 90
# Shingles that count as frequent, at most, and the shingles counted together in memory.
FREQUENT = 1 << 20
COUNTED_TOGETHER = 1 << 21
# Words are counted in a table of fixed size, by their hash.
WORD_CELLS = 1 << 19
_CELLS_OF_ROW = 1 << 13
# Counts of a task beyond this are cut off, so that they fit four bytes.
_MOST_COUNT = (1 << 31) - 1
# All sets are counted over so many slices of the hash space; those that pass and are larger than SMALL are counted once more:
# a set below the first size over so many bits' slices, and so on. Sets that have nothing in common
# differ by about the root of size * slices, which must exceed what the threshold allows.
COARSE_BITS = 5
SMALL = 256
SLICES = ((1 << 11, 8), (1 << 14, 10), (1 << 62, 14))
LEADER_ROUNDS = 2
# Bits of the filter that finds candidates' texts again; a full filter costs time, not results.
FILTER_BITS = 1 << 26


@dataclass(frozen=True)
class Order:
    """The global order. A shingle comes the earlier the rarer its words are, by the sum of the logarithms of their
    counts, ties by hash. Shingles that are known to be frequent themselves come last, the most frequent at the end.
    Any order gives the same join; this one keeps its lists short."""

    words: np.ndarray
    hashes: np.ndarray
    ranks: np.ndarray

    def rarity(self, hashes: np.ndarray, words: int) -> np.ndarray:
        """Of every run of `words` words, from the words' hashes."""
        logs = self.words[(hashes >> np.uint64(32)).astype(np.int64) % len(self.words)]
        out = np.zeros(max(0, len(hashes) - words + 1), np.int64)
        for n in range(words):
            out += logs[n : n + len(out)]
        return out

    def prefix(self, values: np.ndarray, rarity: np.ndarray, length: int) -> np.ndarray:
        """The first `length` of the sorted different values."""
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
            rarity = np.where(self.hashes[at] == values, self.ranks[at] + (1 << 40), rarity)
        if length < len(values):
            # Only what may be among the first is put in order.
            may = np.flatnonzero(rarity <= np.partition(rarity, length - 1)[length - 1])
            values, rarity = values[may], rarity[may]
        return values[np.lexsort((values, rarity))][:length]


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce("text", F.lit("")).alias("text"))


def _repeated(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur more than once in `sets`, sorted, and how often. `sets` is emptied, so that its values are held once."""
    values = np.concatenate(sets)
    sets.clear()
    values.sort()
    like_next = values[1:] == values[:-1]
    # Where a stretch of equal values begins, and where its last but one is.
    begins = np.flatnonzero(np.diff(like_next, prepend=False) & like_next)
    lasts = np.flatnonzero(np.diff(like_next, append=False) & like_next)
    return values[begins], lasts - begins + 2


def global_order(documents: DataFrame, words: int, most: int = FREQUENT) -> Order:
    """The order, from counts over all documents.

    Words are counted in a table of fixed size, so that its sums over all tasks hold for the whole corpus. In the same
    pass a task counts the shingles of the different sets it sees, some millions at a time, and passes on those that
    occur at least twice there, which finds passages that many texts share. The `most` frequent of these are returned.
    """
    ship_package(documents.sparkSession)
    names = ["word", "token", "n", "cells"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(sets: list[np.ndarray]) -> pa.RecordBatch:
            values, counts = _repeated(sets)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(values), bool)), pa.array(values.astype(np.int64)), pa.array(counts), pa.nulls(len(values), pa.binary())],
                names,
            )

        cells = np.zeros(WORD_CELLS, np.int64)
        sets, seen, held = [], set(), 0
        for batch in in_slices(batches):
            for texts in texts_at_once(batch.column(0).to_pylist()):
                hashes, begins = word_hashes(texts)
                np.add.at(cells, (hashes >> np.uint64(32)).astype(np.int64) % WORD_CELLS, 1)
                runs = run_hashes(hashes, words)
                for first, last in zip(begins[:-1], begins[1:]):
                    if last - first < words:
                        continue
                    values = np.unique(runs[first : last - words + 1])
                    digest = xxhash.xxh3_128_digest(values.tobytes())
                    if digest not in seen:
                        seen.add(digest)
                        sets.append(values)
                        held += len(values)
                    if held >= COUNTED_TOGETHER:
                        yield flush(sets)
                        sets, seen, held = [], set(), 0
        if sets:
            yield flush(sets)
        parts = [(n, part) for n, part in enumerate(cells.reshape(-1, _CELLS_OF_ROW)) if part.any()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([True] * len(parts), pa.bool_()), pa.array([n for n, _ in parts], pa.int64()), pa.nulls(len(parts), pa.int64()),
                pa.array([np.minimum(part, _MOST_COUNT).astype(np.int32).tobytes() for _, part in parts], pa.binary()),
            ],
            names,
        )

    counts = landed(_texts(documents).mapInArrow(handing_back(counted), "word boolean, token long, n long, cells binary"), "counts")

    def summed(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(_CELLS_OF_ROW, np.int64)
        for cells in rows.column("cells"):
            total += np.frombuffer(cells.as_buffer(), np.int32)
        logs = np.round(np.log2(total + 1) * 64).astype(np.int16)
        return pa.table({"token": pa.array([key[0].as_py()], pa.int64()), "cells": pa.array([logs.tobytes()], pa.binary())})

    logs = np.zeros(WORD_CELLS, np.int16)
    for row in counts.filter("word").groupBy("token").applyInArrow(summed, "token long, cells binary").collect():
        at = row["token"] * _CELLS_OF_ROW
        logs[at : at + _CELLS_OF_ROW] = np.frombuffer(row["cells"], np.int16)
    tokens, n = _most_frequent(counts.filter("not word").groupBy("token").agg(F.sum("n").alias("n")), most)
    removed(counts)
    by_count = np.lexsort((tokens, n))
    ranks = np.empty(len(tokens), np.int64)
    ranks[by_count] = np.arange(len(tokens))
    by_hash = np.argsort(tokens)
    return Order(logs, tokens[by_hash], ranks[by_hash])


def _most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and counts of about the `most` most frequent, never more: whole classes of like counts, and a part of the last by hash."""
    counts = landed(counts.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "frequent")
    least, parts, total = 1 << 30, 1, 0
    for row in counts.groupBy("class").count().orderBy(F.desc("class")).collect():
        if total + row["count"] > most:
            # Hashes are even, so twice the share leaves room.
            parts = -(-2 * row["count"] // max(1, most - total))
            least = row["class"]
            break
        least, total = row["class"], total + row["count"]
    chosen = (F.col("class") > least) | ((F.col("class") == least) & (F.pmod("token", F.lit(parts)) == 0))
    rows = counts.filter(chosen).limit(most).toArrow()
    removed(counts)
    return rows.column("token").to_numpy().astype(np.uint64), rows.column("n").to_numpy()


_SETS = "doc_id long, n long, digest binary, text_key long, prefix array<long>, coarse array<byte>, slices array<short>"


def _text_key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _sliced(values: np.ndarray, bits: int, kind: type) -> np.ndarray:
    counts = np.bincount((values >> np.uint64(63 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, np.iinfo(kind).max).astype(kind)


def document_sets(documents: DataFrame, order: Order, words: int, percent: int, row: str | None = None) -> DataFrame:
    """Per row its set's size, digest, prefix in the global order and counts over slices of the hash space.

    `row` numbers the rows: the column of that name, or a number given here.
    """
    shared = documents.sparkSession.sparkContext.broadcast(order)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sizes, digests, keys, prefixes, coarse, slices = [], [], [], [], [], []
            texts = batch.column("text").to_pylist()
            for some in texts_at_once(texts):
                hashes, begins = word_hashes(some)
                runs, rarity = run_hashes(hashes, words), shared.value.rarity(hashes, words)
                for text, first, last, short in zip(some, begins[:-1], begins[1:], _short_sets(hashes, begins, words)):
                    if last - first >= words:
                        values, at = np.unique(runs[first : last - words + 1], return_index=True)
                        rare = rarity[first : last - words + 1][at]
                    else:
                        values, rare = short, np.zeros(len(short), np.int64)
                    n = len(values)
                    sizes.append(n)
                    digests.append(xxhash.xxh3_128_digest(values.tobytes()))
                    keys.append(_text_key(text))
                    length = n - -(-percent * n // 100) + 1
                    prefixes.append(shared.value.prefix(values, rare, length).astype(np.int64) if n else np.zeros(0, np.int64))
                    coarse.append(_sliced(values, COARSE_BITS, np.int8))
                    bits = next(bits for size, bits in SLICES if n < size)
                    slices.append(_sliced(values, bits, np.int16) if n > SMALL else np.zeros(0, np.int16))
            columns = [
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64())), pa.array(coarse, pa.list_(pa.int8())), pa.array(slices, pa.list_(pa.int16())),
            ]
            names = [field.split()[0] for field in _SETS.split(", ")]
            if row:
                columns, names = [*columns, batch.column("row")], [*names, "row"]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *([F.col(row).cast("long").alias("row")] if row else []),
    )
    if row:
        return landed(rows.mapInArrow(handing_back(described), f"{_SETS}, row long"), "sets")
    return landed(rows.mapInArrow(handing_back(described), _SETS).withColumn("row", F.monotonically_increasing_id()), "sets")


def _short_sets(hashes: np.ndarray, begins: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sets of texts with fewer words than a shingle has: the whole sequence as one; nothing for others."""
    for first, last in zip(begins[:-1], begins[1:]):
        yield whole_sequence(hashes[first:last]) if last - first < words else hashes[:0]


def candidate_sets(documents: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """`node, shingles` of the texts named by `nodes` (`node, text_key, digest`).

    The texts are read again; those that no candidate has are passed over by a filter of fixed size, so
    they are neither cut into shingles nor shuffled.
    """
    shared = documents.sparkSession.sparkContext.broadcast(bit_filter(nodes.select("text_key"), FILTER_BITS))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column(0).to_pylist()
            keys = np.array([_text_key(text) for text in texts], np.int64)
            may = np.flatnonzero(in_filter(shared.value, keys))
            sets = list(shingle_sets([texts[n] for n in may], words))
            digests = [xxhash.xxh3_128_digest(values.tobytes()) for values in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[may]), pa.array(digests, pa.binary()), pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["text_key", "digest", "shingles"],
            )

    texts = _texts(documents).mapInArrow(handing_back(found), "text_key long, digest binary, shingles array<long>")
    # Rows that repeat a text repeat its key; the first of them is enough.
    return nodes.join(texts, ["text_key", "digest"]).dropDuplicates(["node"]).select("node", "shingles")


def _fitting(percent: int, other: str) -> Column:
    """Length and position filter of two postings of one list; the names of one begin with `other`."""
    n, at = F.col("n"), F.col("at")
    other_n, other_at = F.col(f"{other}n"), F.col(f"{other}at")
    overlap = F.ceil(percent * (n + other_n) / F.lit(100 + percent))
    enough = F.least(n - at, other_n - other_at) >= overlap
    return (100 * F.least(n, other_n) >= percent * F.greatest(n, other_n)) & enough


class _Verifier:
    """Tells which pairs of texts reach the threshold; the sets of a text are read from the documents once, however many rounds need them."""

    def __init__(self, documents: DataFrame, rows: DataFrame, named: DataFrame, words: int, percent: int) -> None:
        self.documents, self.rows, self.named, self.words, self.percent = documents, rows, named, words, percent
        self.sets = no_rows(documents.sparkSession, "node long, shingles array<long>")

    def _apart(self, pairs: DataFrame, slices: DataFrame) -> DataFrame:
        """Pairs without those whose counts over slices differ by more than the threshold allows.

        Sets that differ by d elements differ by d at most in the sum over all slices. Where sizes lie
        on both sides of a step of SLICES, or one is small, the exact overlap decides.
        """
        side = lambda name: slices.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("slices").alias(f"s{name}"))
        differences = F.zip_with("sx", "sy", lambda a, b: F.abs(a.cast("int") - b.cast("int")))
        summed = F.aggregate(differences, F.lit(0), lambda total, d: total + d)
        apart = F.when(F.size("sx") == F.size("sy"), summed).otherwise(0)
        overlap = F.ceil(self.percent * (F.col("nx") + F.col("ny")) / F.lit(100 + self.percent))
        near = pairs.join(side("x"), "x").join(side("y"), "y").filter(apart <= F.col("nx") + F.col("ny") - 2 * overlap)
        return near.select("x", "y", F.greatest("nx", "ny").alias("larger"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs `x, y` whose sets reach the threshold. Few bytes a set go with every pair, more with those that pass."""
        coarse = landed(self._apart(pairs.distinct(), self.named.withColumnRenamed("coarse", "slices")), "coarse")
        large = coarse.filter(F.col("larger") > SMALL).select("x", "y")
        wide = self.rows.filter(F.col("n") > SMALL).select(F.col("row").alias("node"), "n", "slices")
        both_large = self.named.filter(F.col("n") > SMALL).select("node")
        wide = wide.join(both_large, "node", "left_semi")
        small_one = self.named.filter(F.col("n") <= SMALL).select("node", "n", F.array().cast("array<short>").alias("slices"))
        near = landed(
            coarse.filter(F.col("larger") <= SMALL).select("x", "y")
            .unionByName(self._apart(large, wide.unionByName(small_one)).select("x", "y")),
            "near",
        )
        removed(coarse)
        ends = near.select(F.explode(F.array("x", "y")).alias("node")).distinct()
        missing = landed(
            self.named.join(ends.join(self.sets.select("node"), "node", "left_anti"), "node").select("node", "text_key", "digest"), "ends"
        )
        if not missing.isEmpty():
            more = candidate_sets(self.documents, missing, self.words)
            self.sets = self.sets.unionByName(landed(more, "candidates"))
        sets = self.sets
        both = F.size(F.array_intersect("sx", "sy"))
        of = lambda name: sets.select(F.col("node").alias(name), F.col("shingles").alias(f"s{name}"))
        union = F.size("sx") + F.size("sy") - both
        links = landed(
            near.join(of("x"), "x").join(of("y"), "y").filter(100 * both >= self.percent * union).select("x", "y"), "links"
        )
        removed(near, missing)
        return links


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`node, label` after new `links` `x, y`: nodes that links connect share a label. Nodes
    that no link has touched are missing; they are labels of their own.

    Each round every label that has links left takes the neighbour with the smallest hash, and links are
    moved to what their ends took, which leaves a fraction of them however long the chains are.
    """
    ends = links.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    labels = landed(
        ends.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("label")).unionByName(labels),
        "labels",
    )
    end = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"_{name}"))
    left = landed(
        links.join(end("x"), "x").join(end("y"), "y").filter("_x != _y")
        .select(F.least("_x", "_y").alias("x"), F.greatest("_x", "_y").alias("y")).distinct(),
        "edges",
    )
    number = 0
    while left.limit(1).count():
        place = lambda name: F.struct(F.xxhash64(name, F.lit(number)).alias("hash"), F.col(name).alias("node"))
        both = left.select("x", "y").unionByName(left.select(F.col("y").alias("x"), F.col("x").alias("y")))
        taken = landed(
            both.groupBy("x").agg(F.least(F.min(place("y")), F.first(place("x"))).alias("least"))
            .select(F.col("x").alias("old"), F.col("least.node").alias("new")),
            "taken",
        )
        # Two steps at once: what the taken neighbour took.
        twice = taken.alias("t").join(taken.alias("u"), F.col("t.new") == F.col("u.old")).select("t.old", "u.new")
        twice = landed(twice, "taken")
        before = labels, left
        labels = landed(
            labels.join(twice, labels["label"] == twice["old"], "left").select("node", F.coalesce("new", "label").alias("label")),
            "labels",
        )
        left = landed(
            left.join(twice.select(F.col("old").alias("x"), F.col("new").alias("p")), "x")
            .join(twice.select(F.col("old").alias("y"), F.col("new").alias("q")), "y")
            .filter("p != q").select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct(),
            "edges",
        )
        removed(taken, twice, *before)
        number += 1
    removed(left)
    return labels


def near_classes(
    documents: DataFrame, words: int = WORDS, percent: int = PERCENT, row: str | None = None
) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row with `doc_id` and `text`.

    A set is the distinct shingles of `words` words, A-Z in lower case; a text with fewer words is one
    shingle, and one without words (or null) is empty and linked with nothing. Sets are linked when their
    similarity is at least `percent` of 100. `component_id` is the smallest doc_id reachable by links;
    rows that repeat a doc_id are texts of their own, and null ids count only where there are no others.

    With `row`, the name of a column that numbers the rows, `row` and `first_row` come too: of the rows that links
    reach the one with the smallest doc_id, null last, and then the smallest number.
    """
    spark = documents.sparkSession
    order = global_order(documents, words)
    rows = document_sets(documents, order, words, percent, row)
    head = [F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("head")] if row else []
    classes = landed(
        rows.filter("n > 0").groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("first"), *head), "classes"
    )
    members = landed(
        rows.filter("n > 0").select("row", "doc_id", "n", "digest").join(classes, "digest").drop("digest"), "members"
    )
    own = rows.join(classes.select("node"), rows["row"] == classes["node"], "left_semi").withColumnRenamed("row", "node")
    named = landed(own.select("node", "n", "text_key", "digest", "coarse"), "named")
    postings = own.select("node", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("at", "token"))
    # The text with the fewest rare shingles leads its list. One shuffle gives each text its leader.
    in_list = Window.partitionBy("token")
    met = postings.select(
        "token", "node", "n", "at",
        F.count(F.lit(1)).over(in_list).alias("held"), F.min(F.struct("at", "node", "n")).over(in_list).alias("leader"),
    ).filter("held > 1")
    first = (F.col("node") != F.col("leader.node")) & _fitting(percent, "leader.")
    met = landed(met.withColumn("first", first).filter("first or held > 2"), "postings")
    removed(classes)
    shared = met.filter("held > 2").select("token", "node", "n", "at", F.col("leader.node").alias("met"))

    verifier = _Verifier(documents, rows, named, words, percent)
    labels = no_rows(spark, "node long, label long")
    for number in range(LEADER_ROUNDS + 1):
        if not number:
            pairs, used = met.filter("first").select(F.col("node").alias("a"), F.col("leader.node").alias("b")), []
        else:
            pairs, used = _pairs(shared, labels, percent, leaders=number < LEADER_ROUNDS, number=number)
        links = verifier.links(pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")))
        removed(*used)
        before, labels = labels, components(labels, links)
        removed(before, links)
    removed(met, named, verifier.sets)
    joined = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = [F.min("head").alias("class_head")] if row else []
    smallest = joined.groupBy("label").agg(F.min("first").alias("component_id"), *heads)
    own_row = ["row", F.col("class_head.row").alias("first_row")] if row else []
    linked = joined.join(smallest, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id", *own_row)
    alone = ["row", F.col("row").alias("first_row")] if row else []
    empty = rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), *alone
    )
    return linked.unionByName(empty)


def _pairs(shared: DataFrame, labels: DataFrame, percent: int, leaders: bool, number: int) -> tuple[DataFrame, list[DataFrame]]:
    """Candidate pairs `a, b` of texts that share a list but no component yet and did not meet there, and the landed tables behind them.

    With `leaders`, each text of a list meets one of the list's largest component. Without, all that are left
    meet: texts outside of the largest component meet those texts of the list whose length fits theirs.
    """
    labelled = landed(
        shared.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled"
    )
    counts = labelled.groupBy("token", "label").agg(
        F.count(F.lit(1)).alias("held"),
        F.min(F.struct(F.xxhash64("node", F.lit(number)).alias("turn"), "node", "n", "at")).alias("leader"),
    )
    open_lists = counts.groupBy("token").agg(
        F.count(F.lit(1)).alias("labels"), F.max(F.struct("held", "label", "leader")).alias("main")
    ).filter("labels > 1")
    open_lists = landed(open_lists.select("token", F.col("main.label").alias("main"), "main.leader"), "lists")
    inside = labelled.join(open_lists, "token")
    outside = inside.filter("label != main")
    if leaders:
        return outside.filter((F.col("met") != F.col("leader.node")) & _fitting(percent, "leader.")).select(
            F.col("node").alias("a"), F.col("leader.node").alias("b")
        ), [labelled, open_lists]
    # Sizes that fit lie in the same class or in neighbouring ones.
    scale = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / min(percent, 99)))).cast("int")
    other = inside.select("token", scale.alias("class"), *[F.col(name).alias(f"b_{name}") for name in ("node", "n", "at", "label")])
    reaching = outside.withColumn("class", F.explode(F.array(scale - 1, scale, scale + 1)))
    strangers = (F.col("label") != F.col("b_label")) & ~F.col("met").isin(F.col("node"), F.col("b_node"))
    return reaching.join(other, ["token", "class"]).filter(strangers & _fitting(percent, "b_")).select(
        F.col("node").alias("a"), F.col("b_node").alias("b")
    ), [labelled, open_lists]
