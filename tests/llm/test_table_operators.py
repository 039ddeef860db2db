from __future__ import annotations

import random
import sys
from collections import Counter, defaultdict
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from checks.compare import differences, duckdb_tables  # noqa: E402
from tramline.llm import mixing, ngram_join, sharding, topk  # noqa: E402
from tramline.llm.queries import ORACLE, QUERIES  # noqa: E402


# --- mixing -----------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1)):
    """Reshares the excess by weight, again and again, until no target is above its limit."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    free, capped, total = set(order), {}, float(sum(sizes.values()))
    while True:
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in above}
        free -= above


def test_mixes_meet_their_targets(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1500):
        source = rng.choice(["a", "a", "a", "a", "b", "B", "é", None, "zz"] + ["tiny"] * (i % 40 == 0))
        rows.append((i, corpus.words(rng, min(900, int(rng.paretovariate(1) * 8))), source))
    rows += [(5000 + i, None, "none") for i in range(3)]
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    got = mixing.mix(corpus.documents(spark, rows)).collect()
    want = plain_targets(sizes)
    assert len(got) == len(rows) and len({r.doc_id for r in got}) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and (r.size or not r.copies)
        taken[r.source] += r.copies * r.size
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(8, 0.01 * target)
    again = mixing.mix(corpus.documents(spark, rows[::-1]))
    assert sorted((r.doc_id, r.copies) for r in again.collect()) == sorted((r.doc_id, r.copies) for r in got)


def test_one_source_with_equal_documents_is_taken_once(spark):
    got = mixing.mix(corpus.documents(spark, [(i, "one two three") for i in range(20_000)])).collect()
    assert {r.copies for r in got} == {1} and {r.target for r in got} == {60_000.0}


# --- sharding ---------------------------------------------------------------------------


def test_shards_are_even_and_keep_groups_together(spark):
    rng = random.Random(8)
    texts = ["hot"] * 700 + [f"group {i}" for i in range(150) for _ in range(rng.randrange(2, 7))] + [f"single {i}" for i in range(803)] + [None, ""]
    rng.shuffle(texts)
    got = sharding.assign_shards(corpus.documents(spark, list(enumerate(texts)))).collect()
    slots, shards_of = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        shards_of[texts[r.doc_id] or ""].add(r.shard)
    counts = [len(s) for s in slots.values()]
    assert sorted(slots) == list(range(16)) and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The hot group needs a quarter of the shards or more; of the others few may be cut.
    assert len(shards_of.pop("hot")) <= 9
    assert sum(len(s) > 1 for s in shards_of.values()) <= 16


def test_everything_in_one_group(spark):
    got = sharding.assign_shards(corpus.documents(spark, [(i, "same") for i in range(333)])).collect()
    counts = Counter(r.shard for r in got)
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) == 1


# --- n-gram join ------------------------------------------------------------------------


def plain_components(rows, words, percent):
    sets = {}
    for doc_id, text in rows:
        parts = (text or "").encode().lower().split()
        grams = [tuple(parts[i : i + words]) for i in range(len(parts) - words + 1)] if len(parts) >= words else [tuple(parts)] if parts else []
        sets[doc_id] = frozenset(grams)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((d, len(s), root(d)) for d, s in sets.items())


def copies(seed):
    """Groups of near copies around the threshold, chains, exact and short texts, shared passages."""
    rng = random.Random(seed)
    passage = corpus.words(rng, 50)
    texts = []
    for _ in range(12):
        base = corpus.words(rng, rng.randrange(20, 300))
        texts += [corpus.edited(rng, base, rng.randrange(0, 1 + len(base.split()) // 25)) for _ in range(rng.randrange(1, 12))]
        chain = base
        for _ in range(6):
            chain = corpus.edited(rng, chain, 1 + len(base.split()) // 90)
            texts.append(chain)
    texts += [f"{passage} {corpus.words(rng, rng.randrange(1, 60))}" for _ in range(25)]
    texts += ["Two Words", "two words", "two  WORDS ", "one", "one two three", "ONE two\nthree", "", None, " "]
    order = list(enumerate(texts))
    rng.shuffle(order)
    return order


@pytest.mark.parametrize("words, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 70, 3), (3, 100, 4)])
def test_components_equal_those_of_all_pairs(spark, words, percent, seed):
    rows = copies(seed)
    got = ngram_join.near_classes(corpus.documents(spark, rows), words, percent)
    assert sorted(tuple(r) for r in got.collect()) == plain_components(rows, words, percent)


def test_frequent_order_does_not_change_the_join(spark, monkeypatch):
    rows = copies(7)
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", 1)
    none = lambda docs, words: ngram_join.Order(np.zeros(8, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    monkeypatch.setattr(ngram_join, "global_order", none)
    got = ngram_join.near_classes(corpus.documents(spark, rows), 3, 90)
    assert sorted(tuple(r) for r in got.collect()) == plain_components(rows, 3, 90)


def test_long_chains_of_links_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (7, 7)], "x long, y long")
    labels = ngram_join.components(spark.createDataFrame([], "node long, label long"), links)
    groups = defaultdict(set)
    for r in labels.collect():
        groups[r.label].add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(301)), [1000, 1001]]


# --- top-k ------------------------------------------------------------------------------


@pytest.mark.parametrize("scale", [0.2, 1e5])
def test_best_scores_equal_those_of_all_pairs(spark, monkeypatch, scale):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(400, 20)) * scale).astype(np.float32)
    vectors[100:140] = vectors[100]
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)] + [(900, None, 0), (950, [float("inf")] * 20, 0)]
    frame = spark.createDataFrame(rows, corpus.EMBEDDINGS)
    monkeypatch.setattr(topk, "QUERIES_PER_CELL", 3)
    monkeypatch.setattr(topk, "CANDIDATES_PER_CELL", 64)
    got = sorted(tuple(r) for r in topk.search(topk.whole_vectors(frame), F.col("vec_id") % 50 == 0).collect())
    whole = np.floor(256 * vectors.astype(np.float64)).astype(np.int64).tolist()
    want = []
    for q in range(0, 400, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], c)), i) for i, c in enumerate(whole) if i != q)[:5]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert got == sorted(want)


def plain_best(rows, k=5):
    """Every row but the query's own, by row number."""
    whole = [(n, i, [int(np.floor(256 * float(x))) for x in v]) for n, (i, v) in enumerate(rows)]
    out = []
    for n, query_id, query in whole:
        if query_id is not None and query_id % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(query, c)), i is None, i or 0) for m, i, c in whole if m != n]
            out += [(query_id, at, None if none else i, -s) for at, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_rows_that_share_an_id_are_queries_and_candidates_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES_PER_CELL", 16)
    monkeypatch.setattr(topk, "CANDIDATES_PER_CELL", 64)
    rng = np.random.default_rng(6)
    # A third of all rows under one id, which is a query; ids and vectors that repeat; null ids.
    ids = [50] * 150 + [int(i) for i in rng.integers(0, 120, 300)] + [None, None]
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 8]) for i in ids]
    rows += [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, -1.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], corpus.EMBEDDINGS)
    got = topk.search(topk.whole_vectors(frame), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_best(rows)
    few = spark.createDataFrame([(i, v, 0) for i, v in rows[-4:]], corpus.EMBEDDINGS)
    assert len(topk.search(topk.whole_vectors(few), F.col("vec_id") % 50 == 0).collect()) == 6


def test_cells_are_even_under_one_id(spark):
    frame = spark.range(90_000).selectExpr("if(id < 30000, 50, id) as vec_id", "array(1L) as components")
    rows = frame.select(F.monotonically_increasing_id().alias("row"))
    counts = [r["count"] for r in rows.groupBy(F.pmod(F.xxhash64("row"), F.lit(6))).count().collect()]
    assert len(counts) == 6 and max(counts) < 1.1 * min(counts)


def test_search_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(QUERIES["op10_exact_top_k"](spark, folder), duckdb_tables(folder), ORACLE["op10_exact_top_k"]) is None
