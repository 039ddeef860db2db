from __future__ import annotations

import re
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from tramline.llm import common, ngram_join  # noqa: E402


def test_the_join_starts_no_python_worker_for_empty_tables(spark, monkeypatch):
    plans = []

    def noted(rows, purpose):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return common.landed(rows, purpose)

    monkeypatch.setattr(ngram_join, "landed", noted)
    text = " ".join(f"w{n}" for n in range(40))
    rows = [(1, text), (2, text + " more"), (3, "more " + text), (4, "quite another text"), (5, None)]
    documents = common.landed(corpus.documents(spark, rows), "documents")
    got = ngram_join.near_classes(documents).collect()
    assert {row.doc_id: row.component_id for row in got} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    # A table made from a list in Python is an RDD that Python workers read.
    assert plans and not [plan for plan in plans if "ExistingRDD" in plan]


def test_empty_tables_have_the_types_asked_for(spark):
    rows = common.no_rows(spark, "node long, shingles array<long>")
    assert rows.dtypes == [("node", "bigint"), ("shingles", "array<bigint>")] and rows.count() == 0


def test_repeated_values_are_counted_and_held_once():
    draws = np.random.default_rng(5)
    for size, most in [(0, 2), (1, 1), (2, 1), (9, 3), (500, 40), (500, 10**6)]:
        sets = [draws.integers(0, most, size).astype(np.uint64) for _ in range(3)]
        values, counts = np.unique(np.concatenate(sets), return_counts=True)
        got, times = ngram_join._repeated(sets)
        assert got.tolist() == values[counts > 1].tolist() and times.tolist() == counts[counts > 1].tolist()
    sets = [draws.integers(0, 1 << 60, 1 << 14).astype(np.uint64) for _ in range(64)]
    held = sum(values.nbytes for values in sets)
    tracemalloc.start()
    try:
        ngram_join._repeated(sets)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # What came in was made before; beside it one sorted copy and a few flags.
    assert not sets and most < 2 * held


def test_a_worker_hands_back_what_its_task_freed():
    def in_use():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    last = []

    def step(batches):
        for batch in batches:
            parts = [np.ones(8192) for _ in range(3000)]
            # The last part stays, so that the parts before it do not go back by themselves.
            last.append(parts[-1])
            del parts
            yield batch

    batch = pa.RecordBatch.from_pydict({"n": [1, 2]})
    rows, within = common.handing_back(step)(iter([batch])), []
    for got in rows:
        within.append(in_use())
        assert got.equals(batch)
    assert len(within) == 1 and within[0] - in_use() > 100
