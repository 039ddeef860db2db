"""A third of all rows under one doc_id: whole results, and no task far above the others."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from tramline.llm import common, fingerprints, mixing, packing, sharding  # noqa: E402


@pytest.fixture
def rows():
    rng = random.Random(17)
    hot = [(7, "one two three four", "s1")] * 400 + [(7, corpus.words(rng, 3), "s2") for _ in range(100)] + [(None, "one two three four", None)] * 200
    return hot + [(1000 + i, corpus.words(rng, rng.choice([4, 4, 9])), rng.choice(["s1", "s2", None])) for i in range(900)]


@pytest.fixture(autouse=True)
def small_windows(monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_WINDOW", 32)
    monkeypatch.setattr(mixing, "ROWS_PER_WINDOW", 32)
    monkeypatch.setattr(sharding, "ROWS_PER_WINDOW", 32)


def test_parts_are_even_and_only_for_crowded_keys(spark):
    frame = spark.range(60_000).selectExpr("id as row", "if(id < 20000, 7, if(id < 40000, null, id)) as doc_id")
    parts = common.with_parts(frame, ["doc_id"], "row", "part", 500).cache()
    assert parts.count() == 60_000 and parts.filter("doc_id > 7 and part <> 0").isEmpty()
    for only in ("doc_id = 7", "doc_id is null"):
        held = [r["count"] for r in parts.filter(only).groupBy("part").count().collect()]
        assert len(held) == 40 and max(held) < 1.5 * 500


def test_numbers_are_gapless_and_windows_small(spark, rows):
    frame = common.landed(corpus.documents(spark, rows).select("doc_id", F.length("text").alias("size"), F.monotonically_increasing_id().alias("row")), "rows")
    got = common.numbered(frame, [], ["doc_id", "size"], "n", row="row").collect()
    assert sorted(r.n for r in got) == list(range(len(rows)))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, len(t)) for d, t, _ in rows)


def test_mixing(spark, rows):
    got = mixing.mix(corpus.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len(t.split())) for d, t, s in rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    targets = {r.source: r.target for r in got}
    assert all(abs(taken[s] - t) <= max(8, 0.01 * t) for s, t in targets.items())


def test_sharding(spark, rows):
    got = sharding.assign_shards(corpus.documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in rows)
    counts = Counter(r.shard for r in got)
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1
    for shard, count in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(count))


def test_packing(spark, rows):
    got = packing.packed_documents(corpus.documents(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, *_ in rows)
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in places.values():
        upto = 0
        for offset, length in sorted(pieces):
            assert offset == upto
            upto += length
        assert upto <= packing.CAPACITY
    assert len(places) == -(-sum(r.length for r in got) // packing.CAPACITY)


def test_fingerprints(spark, rows, monkeypatch):
    monkeypatch.setattr(fingerprints, "BYTES_PER_TASK", 500)
    got = fingerprints.fingerprint_pairs(corpus.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((d, len(t)) for d, t, _ in rows)
    # Ids that are not repeated have the text of the next smaller id after them.
    after = sorted(((d, t) for d, t, _ in rows if d is not None and d != 7), reverse=True)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None and r.doc_id != 7}
    for (doc_id, text), (_, following) in zip(after, after[1:]):
        changed = fingerprints.edited(text, following)
        assert by_id[doc_id].edited_fingerprint == fingerprints.as_text(fingerprints.winnow(changed))


def test_ranges_hold_like_numbers_of_bytes(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BYTES_PER_TASK", 20_000)
    frame = spark.range(4000).selectExpr("id as doc_id", "repeat('x', if(id > 3600, 400, 20)) as text")
    out = fingerprints.fingerprint_pairs(frame).select("doc_id", "n_chars", F.spark_partition_id().alias("task"))
    sizes = [r["bytes"] for r in out.groupBy("task").agg(F.sum("n_chars").alias("bytes")).collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * 20_000
