"""Hashed word shingles of many texts at once, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHARS_AT_ONCE = 1 << 18

_STEP = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, count: int) -> np.ndarray:
    if len(_powers.get(base, ())) < count:
        steps = np.full(max(count, CHARS_AT_ONCE), np.uint64(base & ((1 << 64) - 1)))
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:count]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    values ^= values >> np.uint64(29)
    values *= _MIX
    return values ^ (values >> np.uint64(32))


def word_hashes(texts: list[str], replaced: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z in lower case, and where each text's words begin (one entry more).

    `replaced` is a table of 256 bytes for bytes.translate, applied to the lower-cased UTF-8.
    """
    raw = [text.encode().lower() for text in texts]
    return raw_word_hashes([text.translate(replaced) for text in raw] if replaced else raw)


def raw_word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As `word_hashes`, of bytes as they are."""
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    # Of a word from s to e, sum of byte * base^(i - s): a difference of running sums, shifted back.
    base = _STEP
    back = pow(base, -1, 1 << 64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * _powers_of(base, len(data)), dtype=np.uint64)])
    hashes = mixed((sums[ends] - sums[starts]) * _powers_of(back, len(data))[starts])
    begins = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return hashes, np.searchsorted(starts, begins)


def run_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """A 63-bit hash of every run of `words` word hashes."""
    runs = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for n in range(words):
        runs = runs * np.uint64(_STEP) + hashes[n : n + len(runs)]
    return mixed(runs) >> np.uint64(1)


def texts_at_once(texts: list[str]) -> Iterator[list[str]]:
    """The texts in turn, several at once: together about CHARS_AT_ONCE code points, or one longer text."""
    at = 0
    while at < len(texts):
        upto, chars = at + 1, len(texts[at])
        while upto < len(texts) and chars + len(texts[upto]) <= CHARS_AT_ONCE:
            chars += len(texts[upto])
            upto += 1
        yield texts[at:upto]
        at = upto


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: runs of `words` words, or the whole
    sequence as one where there are fewer; none without words. Hashes have 63 bits."""
    for some in texts_at_once(texts):
        hashes, begins = word_hashes(some)
        runs = run_hashes(hashes, words)
        for first, last in zip(begins[:-1], begins[1:]):
            if last - first >= words:
                yield np.unique(runs[first : last - words + 1])
            else:
                yield whole_sequence(hashes[first:last])


def whole_sequence(hashes: np.ndarray) -> np.ndarray:
    """All words as one shingle; nothing without words."""
    if not len(hashes):
        return hashes
    whole = np.full(1, np.uint64(len(hashes)))
    for value in hashes:
        whole = whole * np.uint64(_STEP) + value
    return mixed(whole) >> np.uint64(1)
