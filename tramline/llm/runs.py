"""Periodic runs of words, by maximal pairs.

Two equal stretches of words that neither the word before nor the word after makes longer are a maximal pair. A maximal
pair whose distance is at most a third of its length is a run, from the begin of the first stretch to
the end of the second, with the distance as a period. So nothing is ever extended:

* words are ranked by doubling (stretches of 2, 4, 8, ... words), which sorts the suffixes of a text;
* suffixes that no run can need are left out: at some doubling the same stretch must recur near enough;
* the tree of LCP intervals is walked bottom up. An interval keeps its positions in lists by the word on their left;
  where two intervals meet, positions of different lists within reach are the maximal pairs of that length.

Texts are independent of each other: one pass, no shuffle, and memory in proportion to the longest text
(about a hundred bytes a word).
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import in_slices, ship_package

# A run has so many words at least, and so many times its period.
LEAST_WORDS = 6
LEAST_PERIODS = 4
WORDS_AT_ONCE = 1 << 17

Run = tuple[int, int, int]  # start, length, period


def edited_words(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """For one in ten ids the words from some place on are replaced by repeats of the first of them."""
    if doc_id is None or not words:
        return words
    hashed = zlib.crc32(str(doc_id).encode())
    if hashed % 10:
        return words
    g = hashed // 10
    at = g % len(words)
    rest = len(words) - at
    period = 1 + rest // (3 + g % 8)
    return words[:at] + (words[at : at + period] * (rest // period + 1))[:rest]


class _Suffixes:
    """Suffixes of several texts, ranked by stretches of 2, 4, 8, ... words; stretches never cross a text's end."""

    def __init__(self, texts: list[list[bytes]]):
        known: defaultdict[bytes, int] = defaultdict()
        known.default_factory = known.__len__
        sizes = [len(words) for words in texts]
        self.begins = np.cumsum([0, *sizes])
        self.count = int(self.begins[-1])
        ids = np.fromiter((known[w] for words in texts for w in words), np.int64, self.count)
        text_of = np.repeat(np.arange(len(texts)), sizes)
        self.words = np.append(text_of * len(known) + ids, -1)
        self.ends = np.repeat(self.begins[1:], sizes)
        self.near = np.zeros(self.count, bool)
        self.levels: list[tuple[int, np.ndarray]] = []
        self._rank(len(known))

    def _rank(self, kinds: int) -> None:
        positions = np.arange(self.count)
        follows = np.where(positions + 1 < self.ends, self.words[1:] - (self.words[:-1] // kinds) * kinds + 1, 0)
        rank = np.zeros(self.count, np.int64)
        active, key, step = positions, self.words[:-1] * (kinds + 1) + follows, 2
        while len(active):
            order = np.argsort(key, kind="stable")
            sorted_key, at = key[order], active[order]
            first = np.append(True, sorted_key[1:] != sorted_key[:-1])
            starts = np.flatnonzero(first)
            group = np.cumsum(first) - 1
            parent = rank[at]
            parent_starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            parent_group = np.cumsum(np.append(True, parent[1:] != parent[:-1])) - 1
            # A rank is the number of suffixes before the first that shares the stretch.
            rank[at] = parent + starts[group] - parent_starts[parent_group]
            self.levels.append((step, np.append(rank, -1).astype(np.int32)))
            same = ~first[1:]
            if step * 2 > LEAST_PERIODS:
                close = same & (at[1:] - at[:-1] <= (2 * step - 1) // (LEAST_PERIODS - 1))
                self.near[at[1:][close]] = True
                self.near[at[:-1][close]] = True
            again = np.append(False, same) | np.append(same, False)
            active = np.sort(at[again])
            after = active + step
            second = np.where(after < self.ends[active], rank[np.minimum(after, self.count - 1)] + 1, 0)
            key = rank[active] * (self.count + 2) + second
            step *= 2
        self.rank = rank

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions near to a repeat of theirs in the order of their suffixes, and each one's common length with the one before."""
        order = np.flatnonzero(self.near)
        order = order[np.argsort(self.rank[order])]
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for step, rank in [*reversed(self.levels), (1, self.words)]:
            equal = rank[a] == rank[b]
            common += equal * step
            a += equal * step
            b += equal * step
        return order, np.append(0, common)

    def left(self) -> np.ndarray:
        left = np.append(-1, self.words[:-2])
        left[self.begins[:-1][self.begins[:-1] < self.count]] = -1
        return left


def maximal_pairs(order: list[int], common: list[int], left: list[int], place: list[int]) -> Iterator[Run]:
    """`x, y, length` of the maximal pairs whose distance is at most a third of their length.

    `order` lists positions as their suffixes are sorted and `common` what each shares with the one before; `left` has
    the word before each position and `place` its number in `order`, -1 without. Two intervals of
    the tree meet once; the smaller one's lists are searched for in the larger one's, and then join them.
    """
    shortest = LEAST_WORDS - 1
    waiting: list[tuple[int, int, dict[int, list[int]], int]] = []
    for number, position in enumerate(order):
        lo = hi = number
        lists = {left[position]: [position]}
        following = common[number + 1] if number + 1 < len(order) else 0
        while waiting and waiting[-1][3] >= following:
            other_lo, other_hi, other, length = waiting.pop()
            reach = length // (LEAST_PERIODS - 1)
            if hi - lo <= other_hi - other_lo:
                small, large, large_lo, large_hi = lists, other, other_lo, other_hi
            else:
                small, large, large_lo, large_hi = other, lists, lo, hi
            for word, positions in small.items():
                if len(large) <= 2 * reach:
                    for held in (h for w, h in large.items() if w != word):
                        for x in positions:
                            at = bisect_left(held, x - reach)
                            while at < len(held) and held[at] <= x + reach:
                                yield x, held[at], length
                                at += 1
                else:
                    # More lists than places within reach: look at the places.
                    for x in positions:
                        for y in range(max(0, x - reach), min(len(left), x + reach + 1)):
                            if large_lo <= place[y] <= large_hi and left[y] != word:
                                yield x, y, length
            for word, positions in small.items():
                held = large.setdefault(word, positions)
                if held is not positions:
                    if len(positions) < 16:
                        for x in positions:
                            insort(held, x)
                    else:
                        held.extend(positions)
                        held.sort()
            lists, lo, hi = large, min(lo, other_lo), max(hi, other_hi)
        if following >= shortest:
            waiting.append((lo, hi, lists, following))
        else:
            waiting.clear()


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """Every text's runs by start, then period: stretches of at least 6 words and 4 times their smallest period
    that no neighbouring word extends."""
    found: list[list[Run]] = [[] for _ in texts]
    suffixes = _Suffixes(texts)
    order, common = suffixes.sorted()
    if not len(order):
        return found
    place = np.full(suffixes.count, -1, np.int64)
    place[order] = np.arange(len(order))
    periods: dict[tuple[int, int], int] = {}
    for x, y, length in maximal_pairs(order.tolist(), common.tolist(), suffixes.left().tolist(), place.tolist()):
        stretch, period = (min(x, y), max(x, y) + length), abs(x - y)
        periods[stretch] = min(period, periods.get(stretch, period))
    stretches = sorted((start, period, end) for (start, end), period in periods.items())
    owners = np.searchsorted(suffixes.begins, [s[0] for s in stretches], side="right") - 1
    for owner, (start, period, end) in zip(owners.tolist(), stretches):
        found[owner].append((start - int(suffixes.begins[owner]), end - start, period))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    dropped = bytearray(len(words))
    for start, length, period in runs:
        dropped[start + period : start + length] = b"\1" * (length - period)
    return [word for word, gone in zip(words, dropped) if not gone]


def _strongest(runs: list[Run]) -> tuple[int | None, int | None, int | None, int | None]:
    if not runs:
        return None, None, None, None
    start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return start, length, period, 1000 * length // period


_DIGEST = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def scan_runs(documents: DataFrame, edit: bool = False) -> DataFrame:
    """One row per row of `documents` (`doc_id`, `text`): `doc_id`, its number of runs, the strongest (greatest length over
    period; then the smallest start and period; null without runs), digests of all runs and of the collapsed
    text, and `runs` and `collapsed` themselves.

    Words are runs of anything but ASCII white space; null, empty and blank texts have none, no runs and an empty
    collapsed text. With `edit`, texts are first changed by `edited_words`; a null doc_id changes nothing. Rows that repeat an id
    are texts of their own.
    """
    ship_package(documents.sparkSession)

    def rows(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(9)]
        for words, runs in zip(texts, find_runs(texts)):
            short = b" ".join(collapsed(words, runs))
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
            values = (
                len(runs), *_strongest(runs), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(short).hexdigest(),
                [dict(zip(("start", "length", "period"), run)) for run in runs], short.decode(),
            )
            for column, value in zip(columns, values):
                column.append(value)
        kinds = [pa.int64()] * 5 + [pa.string()] * 2
        kinds += [pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])), pa.string()]
        names = [field.split()[0] for field in _DIGEST.split(", ")] + ["runs", "collapsed"]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", *names]
        )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            ids, texts, held = [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                words = (text or "").encode().split()
                ids.append(doc_id)
                texts.append(edited_words(words, doc_id) if edit else words)
                held += len(words)
                if held >= WORDS_AT_ONCE:
                    yield rows(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield rows(ids, texts)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scanned, f"doc_id long, {_DIGEST}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
