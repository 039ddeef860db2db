"""Collocations against plain counting, SQL, and transducers against dictionaries."""

from __future__ import annotations

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from checks.compare import differences, duckdb_tables  # noqa: E402
from tramline.llm import collocations as c  # noqa: E402
from tramline.llm.queries import ORACLE, QUERIES  # noqa: E402


def plain(rows, fewest, longest=5, most=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= fewest}

    def covered(lang, words, a):
        return any(
            m == lang and len(longer) > len(words) and f >= a
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
            for (m, longer), f in candidates.items()
        )

    out = []
    for (lang, words), a in candidates.items():
        if not covered(lang, words, a):
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            out.append((lang, " ".join(words), a, left, right, totals[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked, rank, last = [], 0, None
    for lang, *rest in out:
        rank, last = (rank + 1 if lang == last else 1), lang
        if rank <= most:
            ranked.append((lang, rank, *rest))
    return ranked


def _rows(seed, count=120):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(12)] + ["É", "ß🙂", "a-b", " x"]
    phrases = [" ".join(rng.choices(vocabulary, k=rng.randrange(2, 8))) for _ in range(6)]
    rows = []
    for n in range(count):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocabulary).upper() for _ in range(rng.randrange(0, 30))]
        text = "".join(part + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"]) for part in parts)
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return [*rows, (None, None), ("en", None), ("xx", ""), ("xx", " \t.")]


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_counting(spark, monkeypatch, seed):
    if seed:
        # Many shards and ranges, and a full filter of few bits.
        monkeypatch.setattr(c, "WORDS_AT_ONCE", 150)
        monkeypatch.setattr(c, "WORDS_OF_RANGE", 100)
        monkeypatch.setattr(c, "PHRASES_OF_RANGE", 20)
        monkeypatch.setattr(c, "FILTER_BITS", 1 << 15)
    rows = _rows(seed)
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = [tuple(r) for r in c.collocations(frame, fewest=4, most=25).orderBy("lang", "rank").collect()]
    expected = plain(rows, 4, most=25)
    assert got == expected and len(expected) > 60


def test_products_beyond_64_bits_and_floored_ties(spark, monkeypatch):
    frame = spark.createDataFrame([("en", "a b. " * 50 + "c d e. " * 50)], "lang string, text string")
    got = {r["phrase"]: r for r in c.collocations(frame, fewest=10).collect()}
    assert got["a b"]["score"] == 1000 * 50 * 250 // (50 * 50)
    # Both cuts of "c d e" score the same: the first counts, and its own parts are inside it.
    assert (got["c d e"]["l"], got["c d e"]["r"]) == (50, 50) and "c d" not in got and "d e" not in got
    exact = spark.sql(
        "select (1000 * cast(900000000000000 as decimal(16,0)) * cast(9000000000000001 as decimal(16,0)))"
        " div (cast(900000000000000 as decimal(19,0)) * cast(2700000000000007 as decimal(19,0))) s"
    ).first()["s"]
    assert exact == 1000 * 900000000000000 * 9000000000000001 // (900000000000000 * 2700000000000007)


def test_transducers_against_dictionaries():
    rng = random.Random(2)
    lang_of = dict(zip(c._hash_of(["x", "y", "z"]).tolist(), "xyz"))

    def entries(t, weights=None):
        paths = t.paths().tolist()
        weights = t.weights if weights is None else weights
        return {(lang_of[p[0]], tuple(w for w in p[1:] if w)): n for p, n in zip(paths, weights.tolist())}

    def transducer(counted):
        return c.CountTransducer.of_phrases([k[0] for k in counted], [k[1] for k in counted], np.array(list(counted.values())), 3)

    # Labels as far apart as hashes are.
    words = [-(1 << 63), -5, 7, (1 << 63) - 1]
    dictionaries = [Counter((rng.choice("xy"), tuple(rng.choices(words, k=rng.randrange(1, 4)))) for _ in range(80)) for _ in range(4)]
    parts = [transducer(counted) for counted in dictionaries]
    for part, counted in zip(parts, dictionaries):
        assert entries(part) == counted
        # States are shared by prefixes.
        assert len(part.labels[1]) == len({(lang, phrase[0]) for lang, phrase in counted})
    whole, summed = c.CountTransducer.union(parts), sum(dictionaries, Counter())
    assert entries(whole) == summed
    assert entries(whole.at_least(5)) == {k: n for k, n in summed.items() if n >= 5}
    asked = [("x", (-5, 7)), ("y", (7, 7, 7)), ("z", (7,)), ("x", (9,)), ("x", (7,)), ("y", (7, 9, 7)), ("y", (words[0], words[3]))]
    ask = transducer(dict.fromkeys(asked, 1))
    assert entries(ask, whole.compose(ask)) == {key: summed.get(key, 0) for key in asked}
    assert not transducer({("x", (1,)): 1}).at_least(2).compose(ask).any()


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    result = QUERIES["op12_phrase_collocations"](spark, folder)
    assert differences(result, duckdb_tables(folder), ORACLE["op12_phrase_collocations"]) is None
    assert result.count() > 50


def test_rare_pairs_of_frequent_words_are_not_shuffled(spark, monkeypatch):
    """Every word is frequent and one pair is; of the thousands of other pairs hardly any leaves its task as itself."""
    rng = random.Random(8)
    vocabulary = [f"w{n}" for n in range(60)]
    rows = [("en", " ".join("new york" if rng.random() < 0.05 else rng.choice(vocabulary) for _ in range(60))) for _ in range(100)]
    sent, whole = [], c.frequent_phrases

    def watched(shards, *rest):
        sizes = shards.filter("weights is not null").selectExpr("size(labels) - 1 AS words", "size(weights) AS n")
        sent.extend((r["words"], r["n"]) for r in sizes.collect())
        return whole(shards, *rest)

    monkeypatch.setattr(c, "frequent_phrases", watched)
    frame = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = [tuple(r) for r in c.collocations(frame, fewest=30).orderBy("lang", "rank").collect()]
    assert got == plain(rows, 30) and [r[2] for r in got] == ["new york"]
    pairs = {pair for _, text in rows for pair in zip(text.split(), text.split()[1:])}
    assert len(pairs) > 2000 and 0 < sum(n for words, n in sent if words == 2) < len(pairs) // 10


def test_gaps_of_any_width_come_back():
    places = np.array([0, 0, 7, 254, 255, 510, 765, 1020, 1274, 70_000, 70_000, (1 << 22) - 1])
    gaps, wide = c.gaps_of(places)
    assert len(gaps) == len(places) and c.places_of(gaps, wide).tolist() == places.tolist()
    assert c.places_of(*c.gaps_of(places[:0])).tolist() == []
    for words in (0, 1, 10_000, 1 << 40):
        buckets = c.buckets_of(words)
        assert buckets & (buckets - 1) == 0 and 8 * c.PIECES <= buckets <= c.MOST_BUCKETS and buckets >= min(words // c.WORDS_OF_BUCKET, c.MOST_BUCKETS)
