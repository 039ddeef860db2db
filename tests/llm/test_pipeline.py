"""Each stage of the pipeline against a plain version on its own input."""

from __future__ import annotations

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
import corpus_pipeline as pipeline  # noqa: E402
from test_table_operators import plain_components, plain_targets  # noqa: E402
from test_text_operators import plain_spans  # noqa: E402

from tramline.llm import secrets  # noqa: E402
from tramline.llm.common import landed, table  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows before each stage and after the last."""
    frames = [table(spark, FOLDER, "documents")]
    for name, stage in pipeline.STAGES:
        frames.append(landed(stage(spark, frames[-1], FOLDER), name))
    return [frame.collect() for frame in frames]


def test_stages_keep_the_columns_of_documents(kept):
    for rows in kept[:-1]:
        assert list(rows[0].asDict()) == pipeline.COLUMNS


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    toxic = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    before, after = ({r.doc_id for r in rows} for rows in kept[:2])
    gone = before - after
    assert gone and sum(toxic.get(d, 1) == 0 for d in gone) <= 0.02 * len(before)


def test_one_document_of_each_group_stays(kept):
    classes = plain_components([(r.doc_id, r.text) for r in kept[1]], pipeline.COPY_WORDS, pipeline.COPY_PERCENT)
    assert {r.doc_id for r in kept[2]} == {d for d, _, c in classes if c == d}


def test_no_secret_is_left(kept):
    before = {r.doc_id: r for r in kept[2]}
    masked = 0
    for row in kept[3]:
        assert not plain_spans(row.text)
        if row.text != before[row.doc_id].text:
            masked += 1
            assert any(mark in row.text for mark in secrets.MASKS.values()) and row.n_chars == len(row.text)
    assert len(kept[3]) == len(kept[2]) and masked >= sum(bool(plain_spans(r.text)) for r in kept[2])


def test_the_mix_meets_its_targets(kept):
    sizes, taken = Counter(), Counter()
    for r in kept[3]:
        sizes[r.source] += len(r.text.split())
    for r in kept[4]:
        taken[r.source] += len(r.text.split())
    assert max(Counter(r.doc_id for r in kept[4]).values()) <= 3
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= max(20, 0.02 * target)


def test_all_copies_are_packed(kept):
    copies = Counter(r.doc_id for r in kept[4])
    assert Counter(r.doc_id for r in kept[5] if r.piece == 0) == copies
    ends = {}
    for r in sorted(kept[5], key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_near_copies_go_by_row_and_not_by_id(spark):
    rng = random.Random(31)
    one, two, three, four = (corpus.words(rng, 40) for _ in range(4))
    rows = [(3, one), (3, one), (7, one), (7, two), (None, one), (None, three), (None, three), (9, four), (9, f"{four} more"), (9, "")]
    left = pipeline.drop_near_copies(spark, corpus.documents(spark, rows), "").collect()
    texts = Counter((r.doc_id, r.text) for r in left)
    assert texts in [Counter([(3, one), (7, two), (None, three), (9, last), (9, "")]) for last in (four, f"{four} more")]


def test_mixing_takes_rows_and_not_ids(spark):
    rng = random.Random(32)
    rows = [(i % 3 if i % 5 else None, corpus.words(rng, rng.randrange(0, 40)), "abc"[i % 2]) for i in range(200)] + [(1, "", "a"), (2, None, "b")]
    docs = corpus.documents(spark, rows)
    sizes, taken = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    for r in pipeline.mix_sources(spark, docs, "").collect():
        taken[r.source] += len(r.text.split())
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= max(20, 0.02 * target)


def test_all_stages_take_awkward_rows(spark, tmp_path):
    folder = corpus.write_tables(spark, tmp_path, corpus.awkward())
    docs = table(spark, folder, "documents")
    kept = [[(r.doc_id, r.text) for r in docs.collect()]]
    for name, stage in pipeline.STAGES:
        docs = landed(stage(spark, docs, folder), name)
        kept.append([(r.doc_id, r.text) for r in docs.collect()] if "text" in docs.columns else docs.collect())
    # The model is a constant here.
    assert Counter(kept[1]) == Counter(kept[0])
    unlike = Counter(kept[0]) - Counter([(1, "alpha beta gamma delta"), (6, "ALPHA beta gamma delta")])
    assert Counter(kept[2]) == unlike
    assert sum(Counter(kept[3]).values()) == len(kept[2])
    assert set(kept[4]) <= {row for row in kept[3] if (row[1] or "").split()} and (None, "no id here") in kept[4]
    assert Counter(r.doc_id for r in kept[5] if r.piece == 0) == Counter(d for d, _ in kept[4])
