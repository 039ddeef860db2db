"""Every registered operator over empty tables, awkward rows and clashing column names."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from tramline.llm.queries import QUERIES  # noqa: E402

CONTRACT = {
    "op1_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_secret_scans": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op5_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op6_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op7_license_scans": ["doc_id", "n_notices", "licenses", "notices"],
    "op8_chat_formatting": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op9_document_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_exact_top_k": ["query_id", "rank", "vec_id", "score"],
    "op11_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op12_phrase_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op13_language_id": ["doc_id", "held_out", "lang_pred", "score"],
}
PER_DOCUMENT = [name for name in CONTRACT if name not in ("op5_best_fit_packing", "op8_chat_formatting", "op10_exact_top_k", "op12_phrase_collocations")]


def test_all_are_registered():
    assert sorted(QUERIES) == sorted(CONTRACT)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    rows = corpus.awkward()
    return {
        "empty": corpus.write_tables(spark, root / "empty", []),
        "awkward": corpus.write_tables(spark, root / "awkward", rows),
        "clashing": corpus.write_tables(spark, root / "clashing", rows, clashing=True),
    }


@pytest.mark.parametrize("name", CONTRACT)
def test_awkward_tables(spark, folders, name):
    empty = QUERIES[name](spark, folders["empty"]).collect()
    assert len(empty) == (1 if name == "op8_chat_formatting" else 0)
    frame = QUERIES[name](spark, folders["awkward"])
    assert frame.columns[: len(CONTRACT[name])] == CONTRACT[name]
    got = sorted(map(repr, frame.collect()))
    if name in PER_DOCUMENT:
        assert len(got) == len(corpus.awkward())
    # Extra columns change nothing, and reruns agree.
    assert got == sorted(map(repr, QUERIES[name](spark, folders["clashing"]).collect()))
