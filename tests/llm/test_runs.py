"""Periodic runs against plain search over every start and period."""

from __future__ import annotations

import hashlib
import random
import sys
import time
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))

import corpus  # noqa: E402
from tramline.llm import runs  # noqa: E402
from tramline.llm.queries import op11_periodic_runs  # noqa: E402


def plain_runs(words):
    """For every period the stretches that keep it; of equal stretches the smallest period stays."""
    n, found = len(words), {}
    for period in range(1, n // 4 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j - i + period
            if j > i and length >= max(6, 4 * period):
                found.setdefault((i, length), period)
            i = j + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def by_start(found):
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab", max_size=60) | st.text("abc", max_size=90), max_size=5))
def test_random_texts(texts):
    split = [[c.encode() for c in t] for t in texts]
    assert runs.find_runs(split) == [by_start(plain_runs(w)) for w in split]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=7), st.integers(1, 14)), max_size=7))
def test_texts_of_powers(parts):
    words = [c.encode() for root, times in parts for c in root * times]
    assert runs.find_runs([words]) == [by_start(plain_runs(words))]


def test_fibonacci_words_and_their_powers():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    for text in (b, b[:30] * 6, "c" + b[:13] * 5 + b):
        words = [c.encode() for c in text]
        assert runs.find_runs([words]) == [by_start(plain_runs(words))]


@pytest.mark.parametrize("text", [
    "spam " * 200_000,
    "lorem ipsum dolor " * 60_000,
    " ".join(f"x{i} a a a a a a" for i in range(20_000)),
    " ".join(f"line {i} buy now and get one of these for free" for i in range(20_000)),
    " ".join(("a " * 3000 + f"x{i}") for i in range(30)),
])
def test_long_texts_take_little_time(text):
    began = time.process_time()
    found = runs.find_runs([text.encode().split()])[0]
    assert time.process_time() - began < 30
    assert found or "buy" in text


def test_edited_words_by_the_formula():
    import zlib

    checked = 0
    for doc_id in range(200):
        words = [f"w{i}".encode() for i in range(1 + doc_id % 37)]
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        expected = words
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            expected = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            checked += 1
        assert runs.edited_words(words, doc_id) == expected
    assert checked > 10
    assert runs.edited_words([b"a"], None) == [b"a"] and runs.edited_words([], 1) == []


def test_query_against_plain_version(spark, tmp_path):
    rng = random.Random(9)
    rows = [(n, " \t\n"[n % 3].join(rng.choice("ab") for _ in range(rng.randrange(0, 120))), "en", "s", 0) for n in range(150)]
    rows += [(7, "é " * 9, "en", "s", 0), (7, "é " * 9, "en", "s", 0), (None, "x y " * 5, None, None, None), (500, None, None, None, None)]
    folder = corpus.write_tables(spark, tmp_path / "t", rows)
    got = sorted(map(tuple, op11_periodic_runs(spark, folder).collect()), key=str)
    expected = []
    for doc_id, text, *_ in rows:
        words = runs.edited_words((text or "").encode().split(), doc_id)
        found = by_start(plain_runs(words))
        dropped = {i for s, length, q in found for i in range(s + q, s + length)}
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        digest = lambda value: hashlib.sha256(value).hexdigest()
        expected.append((
            doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            digest("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()),
            digest(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
        ))
    assert got == sorted(expected, key=str)
    assert sum(r[1] > 0 for r in got) > 50
