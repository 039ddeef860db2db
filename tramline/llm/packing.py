"""Best-two-fit packing of token runs into sequences.

A bin is filled greedily with the longest runs that still fit. Then its shortest run is taken
out and, if two unpacked runs fit the widened gap more tightly, they replace it. Only lengths
matter to that choice, so it is made on the histogram of lengths, which has at most `capacity`
entries however large the corpus is: a bin that repeats is decided once and carries the number
of its repetitions. The documents are then numbered within their length and dealt out to the
places of that plan by a join, so no document passes through the driver.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import in_slices, landed, last_at_most, numbered, ship_package

CAPACITY = 4096
END_OF_DOCUMENT = 1

# Beyond this number a worker forgets the half of its parts that it met last.
PARTS_KEPT = 600_000
# The tokenizer takes longer over a part of a long line than over one of a short line.
PARTS_AT_ONCE = 500
CHARS_AT_ONCE = 4 << 20

PIECES = "doc_id long, piece int, start long, length long, ids binary"
_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict[str, bytes | bytearray]):
    """Token ids by part. A part not met before gets an empty place and is put on the list `new`."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.new: list[str] = []

    def __missing__(self, part: str) -> bytearray:
        self.new.append(part)
        place = self[part] = bytearray()
        return place


class _Parts:
    """Token ids of texts, each different part encoded once.

    The tokenizer lower-cases, cuts a text into words, digits and runs of other characters, drops
    white space and never merges across a cut; so a text's ids are its parts' ids in order. Parts not met
    before are encoded together: each ends with the one token that is marked as a word's end.
    Texts in Latin script are cut by `re`, others by the tokenizer's normaliser and pattern, and those
    with control characters or control strings are encoded whole.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        endings = "'s|'t|'re|'ve|'m|'ll|'d"
        self.cut = regex.compile(rf"{endings}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+")
        # Most parts are letters, with which no ending begins.
        # Every character of these ranges is a letter.
        latin = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
        self.latin_cut = re.compile(f"[a-z{latin}]+|[0-9]|{endings}|[^\\sa-z0-9{latin}]+")
        self.not_latin = re.compile(f"[^ -~\t\n\r\u00a0{latin}\u2010-\u2027\u20ac]")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.control = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")
        self.known = _Known()

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > PARTS_KEPT:
            # Frequent parts are among those met first.
            self.known = _Known(islice(self.known.items(), PARTS_KEPT // 2))
        known, look_up = self.known, self.known.__getitem__
        found = [None if self._is_whole(text) else list(map(look_up, self._cut(text))) for text in texts]
        new, known.new = known.new, []
        try:
            for at in range(0, len(new), PARTS_AT_ONCE):
                self._learn(new[at : at + PARTS_AT_ONCE])
            return [self._encode(text).tobytes() if parts is None else b"".join(parts) for text, parts in zip(texts, found)]
        finally:
            # A place that was not filled, because of an error, is none.
            for part in new:
                if place := known[part]:
                    known[part] = bytes(place)
                else:
                    del known[part]

    def _is_whole(self, text: str) -> bool:
        # Each test looks for one kind of thing, which is several times faster than a pattern of all.
        return self.control.search(text) is not None or any(mark in text for mark in self.added)

    def _cut(self, text: str) -> list[str]:
        if text.isascii() or not self.not_latin.search(text):
            return self.latin_cut.findall(text.lower())
        return self.cut.findall(self.tokenizer.normalizer.normalize_str(text))

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, parts: list[str]) -> None:
        ids = self._encode(" ".join(parts))
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(parts) and ends[-1] == len(ids):
            raw, last = ids.tobytes(), 0
            for part, end in zip(parts, (4 * ends).tolist()):
                self.known[part][:] = raw[last:end]
                last = end
        else:
            for part in parts:
                self.known[part][:] = self._encode(part).tobytes()


@lru_cache(maxsize=2)
def _parts(path: str) -> _Parts:
    return _Parts(path)


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """`doc_id, piece, start, length, ids` of every document.

    A document is its token ids and a closing id 1; only longer ones are cut, after every
    `capacity` tokens. A null or empty text is the closing id alone. Rows that repeat a doc_id
    are documents of their own, and a null doc_id stays null. `ids` are unsigned 32-bit, little-endian.
    """
    ship_package(documents.sparkSession)
    end = np.array([END_OF_DOCUMENT], "<u4").tobytes()
    wide = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _parts(tokenizer)
        for batch in in_slices(batches):
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                upto, chars = at + 1, len(texts[at])
                while upto < len(texts) and chars + len(texts[upto]) <= CHARS_AT_ONCE:
                    chars += len(texts[upto])
                    upto += 1
                rows = []
                for doc_id, ids in zip(doc_ids[at:upto], parts.ids(texts[at:upto])):
                    ids += end
                    for number, byte in enumerate(range(0, len(ids), wide)):
                        part = ids[byte : byte + wide]
                        rows.append((doc_id, number, byte // 4, len(part) // 4, part))
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), _PIECE_TYPES)]
                yield pa.RecordBatch.from_arrays(arrays, _PIECE_NAMES)
                at = upto

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return texts.mapInArrow(cut, PIECES)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Best-two-fit over counts of lengths: (repetitions, lengths in one bin) of each kind of bin."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    # fits[x]: the longest length of x or less that is still unpacked, 0 if none is.
    fits = np.zeros(capacity + 1, np.int64)

    def refresh() -> None:
        np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0), out=fits)

    refresh()
    bins = []
    while fits[capacity]:
        used: dict[int, int] = {}
        gap = capacity
        while gap:
            length = int(fits[gap])
            while length and used.get(length, 0) >= left[length]:
                length = int(fits[length - 1])
            if not length:
                break
            take = min(gap // length, int(left[length]) - used.get(length, 0))
            used[length] = used.get(length, 0) + take
            gap -= take * length
        if gap and sum(used.values()) > 1:
            _replace_smallest(used, gap, left, fits)
        times = min(int(left[length]) // count for length, count in used.items())
        bins.append((times, [n for n, count in sorted(used.items(), reverse=True) for _ in range(count)]))
        for length, count in used.items():
            left[length] -= times * count
        if any(left[length] == 0 for length in used):
            refresh()
    return bins


def _replace_smallest(used: dict[int, int], gap: int, left: np.ndarray, fits: np.ndarray) -> None:
    smallest = min(used)
    room = gap + smallest
    free = left.copy()
    for length, count in used.items():
        free[length] -= count
    there = np.flatnonzero(free[:room] > 0)
    if not len(there):
        return
    longest = np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))
    partner = longest[room - there]
    # A length may partner itself only if two of it are free.
    alone = (partner == there) & (free[there] < 2)
    partner = np.where(alone, longest[np.maximum(there - 1, 0)], partner)
    sums = np.where(partner > 0, there + partner, 0)
    best = int(np.argmax(sums))
    if smallest < sums[best] <= room:
        used[smallest] -= 1
        if not used[smallest]:
            del used[smallest]
        for length in (int(there[best]), int(partner[best])):
            used[length] = used.get(length, 0) + 1


def _places(spark: SparkSession, bins: list[tuple[int, list[int]]]) -> DataFrame:
    """Each kind of bin's places, grouped by length: the ranks they take and where they lie."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, lengths in bins:
        offset = 0
        for length, count in Counter(lengths).items():
            first = rank.get(length, 0)
            rows.append((length, first, count, sequence, offset))
            rank[length] = first + times * count
            offset += count * length
        sequence += times
    return spark.createDataFrame(rows, "length long, first long, per_bin long, sequence long, base long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds `sequence_id` and `offset` to rows with `doc_id`, `piece` and a `length` of 1 to `capacity`.

    Every piece gets a place, sequences are gapless from offset 0, and no sequence is longer
    than `capacity`. Pieces of equal length are interchangeable; a hash of doc_id and piece
    decides among them, and where many rows share these a column `row` that numbers the rows, if there is one; it is dropped. `pieces` is read several times, so it should
    be a landed table. Empty input gives no rows.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    bins = plan_bins(histogram, capacity)
    if not bins:
        return pieces.drop("row").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    # At most a few times `capacity` rows: every kind of bin uses up a length or halves a count.
    per_length = (
        _places(spark, bins)
        .groupBy("length")
        .agg(F.sort_array(F.collect_list(F.struct("first", "per_bin", "sequence", "base"))).alias("places"))
    )
    columns = [name for name in pieces.columns if name != "row"]
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "start"], "rank", row="row" if "row" in pieces.columns else None)
    return _placed(ranked.join(F.broadcast(per_length), "length"), columns)


def _placed(ranked: DataFrame, columns: list[str]) -> DataFrame:
    place = last_at_most(F.col("places"), F.col("rank"), lambda entry: entry["first"])
    return (
        ranked.withColumn("place", F.get("places", place))
        .withColumn("_in", F.col("rank") - F.col("place.first"))
        .select(
            *columns,
            (F.col("place.sequence") + F.floor(F.col("_in") / F.col("place.per_bin"))).alias("sequence_id"),
            (F.col("place.base") + F.pmod("_in", "place.per_bin") * F.col("length")).alias("offset"),
        )
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, `sequence_id, ids`, from packed rows that still hold `ids`."""
    return packed.groupBy("sequence_id").agg(
        F.expr("transform(sort_array(collect_list(struct(offset, ids))), x -> x.ids)").alias("parts")
    ).select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, b) -> concat(a, b))").alias("ids"))


def packed_documents(documents: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of `documents` with its place: `doc_id, piece, start, length, ids_crc32, sequence_id, offset`."""
    pieces = token_pieces(documents, tokenizer or public_tokenizer(), capacity)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), F.monotonically_increasing_id().alias("row"))
    return pack(landed(digests, "pieces"), capacity)
