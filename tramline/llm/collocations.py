"""Collocations by weighted acyclic automata.

A count transducer reads a language and the words of a phrase and puts out how often the phrase occurs. Tasks sort
the n-grams of the texts they see and build transducers from them, each n-gram adding states only after the
prefix it shares with the one before. Transducers are cut into ranges of hashed prefixes; those of one range
are united, their weights summed, whichever shard they come from. The counts are exact.

Phrases grow word by word: an n-gram is counted only if its first and last n - 1 words were both found frequent, which a
filter of fixed size tells (a full filter costs time, not results). Pairs of frequent words are many more than frequent
pairs, and of a larger corpus ever more so. Therefore the n-grams of a pass are counted by hash in the pass before, about a byte each: only those
in a bucket that gathers enough of them are counted as themselves. A bucket may hold others too, which costs time
and not results: it has at least the count of each. So rare n-grams are not shuffled. In
the end the transducer of the parts of all candidates is composed with that of all frequent phrases, range by range,
which looks up how often the parts occur. Labels are 64-bit hashes of words; only the phrases that are kept are spelled out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import bit_filter, in_filter, in_slices, landed, ship_package
from tramline.llm.shingles import mixed, raw_word_hashes

FEWEST = 100
LONGEST = 5
PHRASES = 2000
UNKNOWN = "und"

# Words counted together in memory, words whose n-grams share a range on average, and phrases looked up together.
WORDS_AT_ONCE = 1 << 21
WORDS_OF_RANGE = 1 << 22
PHRASES_OF_RANGE = 1 << 17
# A range holds phrases by a hash of this many first words.
PREFIX = 3
FILTER_BITS = 1 << 26
# Buckets in which n-grams are counted by hash: one for so many words, at most so many, and in so many pieces.
WORDS_OF_BUCKET = 8
MOST_BUCKETS = 1 << 28
PIECES = 64
# Parts of a language that are ranked by themselves first.
PARTS = 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
# Characters that end a piece.
_ENDS = b".,;:!?\n\x0b\x0c\r"
# A byte that UTF-8 never holds marks the end of a piece.
_MARK = b"\xff"
_SPLIT = bytes.maketrans(bytes(range(65, 91)) + _ENDS, bytes(range(97, 123)) + _MARK * len(_ENDS))
_END = 0

# Labels are numbers of `kinds`, and each state has the number of its arcs: both are far smaller than hashes and states.
_TRANSDUCER = "range int, langs array<string>, names array<string>, kinds array<long>, labels array<array<int>>, degrees array<array<int>>, weights array<int>, gaps binary, wide array<int>"
_PHRASE = "lang string, words array<long>, size int, n long, hash long, name string, flags binary"
_FLAGS = -1


def _hash_of(names: list[str]) -> np.ndarray:
    """64-bit hashes that stand for words and languages as labels."""
    return np.array([xxhash.xxh3_64_intdigest(name.encode()) for name in names], np.uint64).view(np.int64)


@dataclass
class CountTransducer:
    """Arcs by depth. State `s` of depth d is entered from state `parents[d][s]` by `labels[d][s]`, a language at depth 0
    and a word below; states are in the order of what they have read. The last arcs lead to the one final
    state and put out `weights`. Label 0 ends a phrase shorter than the transducer is deep.
    """

    labels: list[np.ndarray]
    parents: list[np.ndarray]
    weights: np.ndarray

    @classmethod
    def of(cls, paths: np.ndarray, weights: np.ndarray) -> CountTransducer:
        """From paths (rows of labels) in any order, with repeats, whose weights are summed."""
        order = np.lexsort(paths.T[::-1])
        paths, weights = paths[order], weights[order]
        starts = np.flatnonzero(np.append(True, (paths[1:] != paths[:-1]).any(axis=1))[: len(paths)])
        return cls.of_sorted(paths[starts], np.add.reduceat(weights, starts) if len(starts) else weights)

    @classmethod
    def of_sorted(cls, paths: np.ndarray, weights: np.ndarray) -> CountTransducer:
        """From sorted different paths: each adds states behind the prefix it shares with the one before."""
        labels, parents = [], []
        adds = np.zeros(len(paths), bool)
        adds[:1] = True
        above = np.zeros(len(paths), np.int64)
        for depth in range(paths.shape[1]):
            adds[1:] |= paths[1:, depth] != paths[:-1, depth]
            labels.append(paths[adds, depth])
            parents.append(above[adds].astype(np.int32))
            above = np.cumsum(adds) - 1
        return cls(labels, parents, weights)

    def paths(self) -> np.ndarray:
        """All paths, a row each, in order."""
        states = np.arange(len(self.weights))
        out = np.empty((len(states), len(self.labels)), np.int64)
        for depth in reversed(range(len(self.labels))):
            out[:, depth] = self.labels[depth][states]
            states = self.parents[depth][states]
        return out

    @classmethod
    def union(cls, parts: list[CountTransducer]) -> CountTransducer:
        """All paths of transducers of one depth; weights of equal paths are summed."""
        return cls.of(np.concatenate([part.paths() for part in parts]), np.concatenate([part.weights for part in parts]))

    def at_least(self, fewest: int) -> CountTransducer:
        often = self.weights >= fewest
        return self.of_sorted(self.paths()[often], self.weights[often])

    def compose(self, asked: CountTransducer) -> np.ndarray:
        """The weight this one puts out for each path of `asked`, 0 for paths it does not read. Both are as deep."""
        if not len(self.weights):
            return np.zeros(len(asked.weights), np.int64)
        # The states of this one that the states of `asked` are paired with, depth by depth; -1 for none.
        paired = np.zeros(1, np.int64)
        for labels, parents, wanted, above in zip(self.labels, self.parents, asked.labels, asked.parents):
            kinds = np.unique(labels)
            of = lambda some: np.minimum(np.searchsorted(kinds, some), len(kinds) - 1)
            own = parents.astype(np.int64) * len(kinds) + of(labels)
            from_state = paired[above]
            key = from_state * len(kinds) + of(wanted)
            at = np.minimum(np.searchsorted(own, key), len(own) - 1)
            paired = np.where((from_state >= 0) & (kinds[of(wanted)] == wanted) & (own[at] == key), at, -1)
        return np.where(paired >= 0, self.weights[np.maximum(paired, 0)], 0)

    @classmethod
    def of_phrases(cls, langs: list[str], phrases: list[list[int]], weights: np.ndarray, depth: int) -> CountTransducer:
        paths = np.full((len(phrases), depth + 1), _END, np.int64)
        paths[:, 0] = _hash_of(langs)
        for row, words in zip(paths, phrases):
            row[1 : len(words) + 1] = words
        return cls.of(paths, weights)


def _phrase_hashes(paths: list[np.ndarray]) -> np.ndarray:
    """64-bit hashes of paths given column by column."""
    out = paths[0].view(np.uint64)
    for column in paths[1:]:
        out = mixed(out * _STEP + column.view(np.uint64))
    return out.view(np.int64)


def buckets_of(words: int) -> int:
    """Buckets for a corpus of so many words: a power of two, and each piece of them is whole bytes."""
    return min(MOST_BUCKETS, max(8 * PIECES, 1 << (words // WORDS_OF_BUCKET).bit_length()))


def gaps_of(places: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Sorted places as the steps between them, a byte each; steps of 255 or more stand aside, in order."""
    gaps = np.diff(places, prepend=0)
    return np.minimum(gaps, 255).astype(np.uint8).tobytes(), gaps[gaps >= 255].astype(np.int32)


def places_of(gaps: bytes, wide: np.ndarray) -> np.ndarray:
    """The reverse of `gaps_of`."""
    steps = np.frombuffer(gaps, np.uint8).astype(np.int64)
    steps[steps == 255] = wide
    return np.cumsum(steps)


_MARK_HASH = raw_word_hashes([_MARK])[0].view(np.int64)[0]


class _Shard:
    """The words of some texts, as hashes, with the ends of pieces between them."""

    def __init__(self, named: bool) -> None:
        self.words: list[np.ndarray] = []
        self.langs: list[np.ndarray] = []
        self.lang_names: dict[str, int] = {}
        self.names: set[bytes] | None = set() if named else None
        self.held = 0

    def add(self, langs: list[str], texts: list[bytes]) -> None:
        raw = [(text.translate(_SPLIT) + _MARK).replace(_MARK, b" \xff ") for text in texts]
        hashes, begins = raw_word_hashes(raw)
        for lang in set(langs) - self.lang_names.keys():
            self.lang_names[lang] = int(_hash_of([lang])[0])
        of_text = np.array([self.lang_names[lang] for lang in langs], np.int64)
        self.words.append(hashes.view(np.int64))
        self.langs.append(np.repeat(of_text, np.diff(begins)))
        if self.names is not None:
            for text in raw:
                self.names.update(text.split())
        self.held += len(hashes)

    def grams(
        self, size: int, frequent: np.ndarray | None, ranges: int, often: np.ndarray | None = None, buckets: int = 0
    ) -> Iterator[dict]:
        """A row per range of prefixes: the n-grams of `size` words whose parts may be frequent and whose bucket is among `often`. Where
        names are wanted, rows of further ranges have those of the words in them. With `buckets`, rows of the ranges behind
        those have the buckets of n-grams that are a word longer."""
        words, langs = np.concatenate(self.words), np.concatenate(self.langs)
        # Where size words follow before the piece ends.
        ends = np.flatnonzero(words == _MARK_HASH)
        left = ends[np.searchsorted(ends, np.arange(len(words)))] - np.arange(len(words))
        at = np.flatnonzero(left >= size)
        del left, ends
        if size > 1:
            for first in (0, 1):
                at = at[in_filter(frequent, _phrase_hashes([langs[at], *(words[at + first + n] for n in range(size - 1))]))]
            if often is not None:
                at = at[in_filter(often, _phrase_hashes([langs[at], *(words[at + n] for n in range(size))]))]
        if not len(at):
            return
        if buckets:
            longer = at[:-1][np.diff(at) == 1]
            places = np.sort(np.mod(_phrase_hashes([langs[longer], *(words[longer + n] for n in range(size + 1))]), np.int64(buckets)))
            wide_piece = buckets // PIECES
            bounds = np.searchsorted(places, np.arange(PIECES + 1) * wide_piece)
            for piece in np.flatnonzero(np.diff(bounds)).tolist():
                gaps, wide = gaps_of(places[bounds[piece] : bounds[piece + 1]] - piece * wide_piece)
                yield {"range": 2 * ranges + piece, "gaps": gaps, "wide": wide}
            del places, longer
        range_of = np.mod(_phrase_hashes([langs[at], *(words[at + n] for n in range(min(size, PREFIX)))]), np.int64(ranges))
        order = np.argsort(range_of, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(range_of[order])) + 1):
            here = at[part]
            paths = np.stack([langs[here], *(words[here + n] for n in range(size))], axis=1)
            yield _as_row(int(range_of[part[0]]), list(self.lang_names), CountTransducer.of(paths, np.ones(len(paths), np.int64)))
        if self.names is not None:
            used = np.unique(np.concatenate([words[at + n] for n in range(size)]))
            names = sorted(self.names - {_MARK})
            hashes = raw_word_hashes(names)[0].view(np.int64)
            for n in range(ranges):
                mine = np.flatnonzero(np.isin(hashes, used[np.mod(used, np.int64(ranges)) == n])).tolist()
                if mine:
                    yield {"range": ranges + n, "names": [names[i].decode() for i in mine]}


def _as_row(number: int, langs: list[str], t: CountTransducer) -> dict:
    kinds = np.unique(np.concatenate(t.labels))
    above = [1, *(len(labels) for labels in t.labels[:-1])]
    return {
        "range": number, "langs": langs, "kinds": kinds, "labels": [np.searchsorted(kinds, labels).astype(np.int32) for labels in t.labels],
        "degrees": [np.bincount(parents, minlength=n).astype(np.int32) for parents, n in zip(t.parents, above)],
        "weights": t.weights.astype(np.int32),
    }


_ARROW = pa.schema([
    ("range", pa.int32()), ("langs", pa.list_(pa.string())), ("names", pa.list_(pa.string())), ("kinds", pa.list_(pa.int64())),
    ("labels", pa.list_(pa.list_(pa.int32()))), ("degrees", pa.list_(pa.list_(pa.int32()))), ("weights", pa.list_(pa.int32())),
    ("gaps", pa.binary()), ("wide", pa.list_(pa.int32())),
])


def shard_transducers(
    texts: DataFrame, size: int, frequent: np.ndarray | None, ranges: int, often: np.ndarray | None = None, buckets: int = 0
) -> DataFrame:
    """The n-grams of `size` words of `texts` (`lang, text`), one transducer for each shard and range of prefixes.

    Labels are hashes. Pairs come with the names of their words, since each word of a longer frequent phrase is in a frequent pair.
    `often` has a bit for each bucket of n-grams that has enough of them. With `buckets`, the n-grams a word
    longer that are made of two of these are put into so many.
    """
    shared = texts.sparkSession.sparkContext.broadcast((frequent, often))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(shard: _Shard) -> Iterator[pa.RecordBatch]:
            frequent, often = shared.value
            for row in shard.grams(size, frequent, ranges, often, buckets):
                yield pa.RecordBatch.from_pylist([row], _ARROW)

        shard = _Shard(named=size == 2)
        for batch in in_slices(batches, 128):
            shard.add(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
            if shard.held >= WORDS_AT_ONCE:
                yield from flush(shard)
                shard = _Shard(named=size == 2)
        if shard.held:
            yield from flush(shard)

    return texts.mapInArrow(counted, _TRANSDUCER)


def _transducers(pieces: pa.Table) -> list[CountTransducer]:
    plain = lambda values: values.to_numpy(zero_copy_only=False)
    out = []
    for kinds, labels, degrees, weights in zip(*(pieces.column(name) for name in ("kinds", "labels", "degrees", "weights"))):
        known = plain(kinds.values)
        arcs = [plain(part.values) for part in degrees.values]
        out.append(
            CountTransducer(
                [known[plain(part.values)] for part in labels.values],
                [np.repeat(np.arange(len(counts), dtype=np.int32), counts) for counts in arcs], plain(weights.values).astype(np.int64),
            )
        )
    return out


def frequent_phrases(shards: DataFrame, fewest: int, ranges: int, buckets: int = 0) -> DataFrame:
    """`lang, words, size, n, hash, name` of the phrases that occur at least `fewest` times in all shards; words are hashes.
    Rows of size 0 are names of words, by their hash; rows with null words have the sum over all phrases of a language and range.
    Rows of size -1 have `flags`, a bit for each bucket of a piece, and the number `n` of the piece: which buckets have at least `fewest`."""

    def named(pieces: pa.Table) -> dict[str, pa.Array]:
        names = sorted({name for names in pieces.column("names").to_pylist() for name in names})
        none = pa.nulls(len(names))
        hashes = raw_word_hashes([name.encode() for name in names])[0].view(np.int64)
        return {
            "lang": none.cast(pa.string()), "words": none.cast(pa.list_(pa.int64())), "size": pa.array([0] * len(names), pa.int32()),
            "n": none.cast(pa.int64()), "hash": pa.array(hashes), "name": pa.array(names, pa.string()), "flags": none.cast(pa.binary()),
        }

    def flagged(piece: int, pieces: pa.Table) -> dict[str, pa.Array]:
        # A count may stop at `fewest`.
        counts = np.zeros(buckets // PIECES, np.int32)
        for gaps, wide in zip(pieces.column("gaps"), pieces.column("wide")):
            places, held = np.unique(places_of(gaps.as_py(), wide.values.to_numpy()), return_counts=True)
            counts[places] = np.minimum(counts[places] + held, fewest)
        none = pa.nulls(1)
        return {
            "lang": none.cast(pa.string()), "words": none.cast(pa.list_(pa.int64())), "size": pa.array([_FLAGS], pa.int32()),
            "n": pa.array([piece], pa.int64()), "hash": none.cast(pa.int64()), "name": none.cast(pa.string()),
            "flags": pa.array([np.packbits(counts >= fewest).tobytes()], pa.binary()),
        }

    def united(key: tuple, pieces: pa.Table) -> pa.Table:
        if key[0].as_py() >= 2 * ranges:
            return pa.table(flagged(key[0].as_py() - 2 * ranges, pieces))
        if key[0].as_py() >= ranges:
            return pa.table(named(pieces))
        lang_names = sorted({lang for langs in pieces.column("langs").to_pylist() for lang in langs})
        lang_of = dict(zip(_hash_of(lang_names).tolist(), lang_names))
        whole = CountTransducer.union(_transducers(pieces))
        size = len(whole.labels) - 1
        langs, lang_at = np.unique(whole.paths()[:, 0], return_inverse=True)
        totals = np.bincount(lang_at, whole.weights, len(langs)).astype(np.int64)
        often = whole.at_least(fewest)
        paths = often.paths()
        none = [None] * len(totals)
        return pa.table({
            "lang": pa.array([lang_of[n] for n in [*paths[:, 0].tolist(), *langs.tolist()]], pa.string()),
            "words": pa.array([*paths[:, 1:].tolist(), *none], pa.list_(pa.int64())),
            "size": pa.array([size] * (len(paths) + len(totals)), pa.int32()),
            "n": pa.array([*often.weights.tolist(), *totals.tolist()], pa.int64()),
            "hash": pa.array([*_phrase_hashes([np.ascontiguousarray(c) for c in paths.T]).tolist(), *none], pa.int64()),
            "name": pa.nulls(len(paths) + len(totals), pa.string()), "flags": pa.nulls(len(paths) + len(totals), pa.binary()),
        })

    return shards.groupBy("range").applyInArrow(united, _PHRASE)


def often_buckets(level: DataFrame, buckets: int) -> np.ndarray:
    """A bit for each bucket, as `in_filter` reads it, from the rows of `frequent_phrases` that have some."""
    size = buckets // PIECES // 8
    out = np.zeros(buckets // 8, np.uint8)
    for row in level.filter(F.col("size") == _FLAGS).select("n", "flags").collect():
        out[row["n"] * size : (row["n"] + 1) * size] = np.frombuffer(row["flags"], np.uint8)
    return out


def _prefix_range(ranges: int) -> Column:
    return F.pmod(F.xxhash64("lang", F.slice("words", 1, PREFIX)), F.lit(ranges)).cast("int").alias("range")


def _looked_up(asked: DataFrame, phrases: DataFrame, ranges: int, depth: int) -> DataFrame:
    """`lang, words, n` of the phrases asked for, range by range."""

    def composed(_: tuple, wanted: pa.Table, held: pa.Table) -> pa.Table:
        langs, words = wanted.column("lang").to_pylist(), wanted.column("words").to_pylist()
        # The weight of a phrase asked for is its row.
        ask = CountTransducer.of_phrases(langs, words, np.arange(len(wanted)), depth)
        counts = CountTransducer.of_phrases(
            held.column("lang").to_pylist(), held.column("words").to_pylist(), held.column("n").to_numpy().astype(np.int64), depth
        )
        n = np.zeros(len(wanted), np.int64)
        n[ask.weights] = counts.compose(ask)
        return pa.table({"lang": pa.array(langs, pa.string()), "words": pa.array(words, pa.list_(pa.int64())), "n": pa.array(n)})

    in_range = lambda rows: rows.withColumn("range", _prefix_range(ranges)).groupBy("range")
    return in_range(asked).cogroup(in_range(phrases)).applyInArrow(composed, "lang string, words array<long>, n long")


def collocations(
    documents: DataFrame, fewest: int = FEWEST, longest: int = LONGEST, most: int = PHRASES
) -> DataFrame:
    """Per language the `most` phrases that stick together best: `lang, rank, phrase, a, l, r, n, score`.

    `documents` has `lang` and `text`; null texts are empty and a null lang counts as `und`. A-Z are lowered, pieces end at
    `.,;:!?` and line ends, words at blanks and tabs. Phrases of 2 to `longest` words that occur `fewest` times are
    candidates, except those that lie in a longer candidate that occurs as often. A phrase's score is that of its weakest
    cut (then the first): the count of words in the language times the phrase's, by those of both parts, in thousandths.
    Ranks go by score, count (both descending) and phrase. Without candidates there are no rows; repeated rows count each.
    """
    ship_package(documents.sparkSession)
    texts = documents.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    held = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    # A word takes about six bytes.
    ranges = max(1, -(-held // (6 * WORDS_OF_RANGE)))
    levels, filters, often = [], None, None
    for size in range(1, longest + 1):
        buckets = buckets_of(held // 6) if size < longest else 0
        level = frequent_phrases(shard_transducers(texts, size, filters, ranges, often, buckets), fewest, ranges, buckets)
        levels.append(landed(level, f"phrases-{size}"))
        if size < longest:
            filters = bit_filter(levels[-1].filter("words is not null").select("hash"), FILTER_BITS)
            often = often_buckets(levels[-1], buckets)
            if not filters.any() or not often.any():
                break
    totals = landed(levels[0].filter("words is null and size = 1").groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    names = levels[min(1, len(levels) - 1)].filter("size = 0").select(F.col("hash").alias("word"), "name")
    phrases = levels[0]
    for level in levels[1:]:
        phrases = phrases.unionByName(level)
    phrases = phrases.filter("words is not null").select("lang", "words", "size", "n")
    candidates = phrases.filter("size > 1")
    part = lambda start, length: F.slice("words", start, length)
    # A phrase inside a longer one that occurs as often is also inside one with a single word more.
    inside = candidates.filter("size > 2").select(
        "lang", "n", F.explode(F.array(part(1, F.col("size") - 1), part(2, F.col("size") - 1))).alias("words")
    )
    kept = landed(candidates.join(inside, ["lang", "words", "n"], "left_anti"), "candidates")
    cuts = kept.select(
        "lang", "words", F.col("n").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")
    ).select(
        "lang", "words", "a", "cut", part(1, F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("size") - F.col("cut")).alias("rest")
    )
    asked = cuts.select("lang", F.explode(F.array("head", "rest")).alias("words")).distinct()
    found = landed(_looked_up(asked, phrases, max(1, -(-phrases.count() // PHRASES_OF_RANGE)), longest), "parts")
    of = lambda name, into: found.select("lang", F.col("words").alias(name), F.col("n").alias(into))
    score = F.expr("(1000 * cast(a as decimal(16,0)) * cast(total as decimal(16,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    weakest = (
        cuts.join(of("head", "l"), ["lang", "head"]).join(of("rest", "r"), ["lang", "rest"]).join(totals, "lang")
        .withColumn("score", score)
        .groupBy("lang", "words")
        .agg(F.min(F.struct("score", "cut", "a", "l", "r", F.col("total").alias("n"))).alias("weakest"))
    )
    spelled = (
        weakest.select("lang", "words", "weakest", F.posexplode("words").alias("at", "word")).join(names, "word")
        .groupBy("lang", "words")
        .agg(F.first("weakest").alias("weakest"), F.array_sort(F.collect_list(F.struct("at", "name"))).alias("spelled"))
        .select("lang", "weakest", F.array_join(F.transform("spelled", lambda s: s["name"]), " ").alias("phrase"))
    )
    order = [F.desc("weakest.score"), F.desc("weakest.a"), F.col("phrase")]
    # Ranked in parts first, so that one task gets the best of each part of a language only.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    best = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best_of_part = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    return (
        spelled.withColumn("rank", best_of_part).filter(F.col("rank") <= most)
        .withColumn("rank", best).filter(F.col("rank") <= most)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *[f"weakest.{name}" for name in ("a", "l", "r", "n", "score")])
    )
