"""Documents packed into sequences of a fixed number of tokens, shortest pack first.

A document is its token ids and an end id. What fills whole sequences is cut off from its front;
the rest is one piece of 1 to ``length`` tokens. The packing looks at the histogram of the
lengths alone, which has at most ``length`` entries whatever the input: lengths are placed longest
first, each into the patterns that are shortest so far, and a pattern of which only some copies
get a piece is split in two. A pattern with no room stays as it is. Then every piece finds its
place by its rank among the pieces of its length.

Ranks need no global order: pieces are dealt to ``SALTS`` groups by a hash of id, text and start,
ranked within group and length, and shifted by the counts of the groups before. A length that a
third of all pieces share is ranked in as many tasks as any other set of groups.

Defined results: a null text is an empty one and gives the end id alone. Rows that repeat an id
are packed each for itself; a null id is kept. Columns besides id and text are not read. An empty
table gives no sequences.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bercario.llm.tables import stored
from bercario.llm.words import NOT_SPACE, Words, chunks

LENGTH = 2048
END_ID = 1
SALTS = 256
# What a worker remembers at a time: words, at 24 bytes each, and their ids, at four; and pieces of words,
# at some 200 bytes each.
KNOWN_WORDS, KNOWN_IDS, KNOWN_PIECES = 600_000, 4_000_000, 50_000

PIECES = "doc_id {id}, piece_key long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds:
    """Ids of texts by a tokenizer that lower-cases and never joins across white space.

    Words are encoded once and remembered by their hash, and so are the pieces that the tokenizer cuts
    them into: letters, single digits, other signs. The pieces of new words are encoded together, and
    the ids are told apart by the mark that ends a piece. Words with other letters than those of
    Latin-1 are left to the tokenizer whole, and so are texts that may hold a special token.
    ``tests`` compare with encoding whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.last = {i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")}
        # Hashes of known words in order, and where in ``ids`` the ids of each begin, and how many.
        self.known = np.zeros(0, np.uint64)
        self.begin, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.pieces: dict[str, bytes] = {" ": _NEXT}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text, as little-endian bytes, of texts as UTF-8 and their offsets."""
        raw = data.tobytes()
        if b"<|" in raw:
            bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            return self._encode_each([raw[a:b].decode() for a, b in bounds])
        words = Words(data, offsets, NOT_SPACE)
        hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        lower = words.lower.tobytes()
        ids, begin, sizes = self._look_up(
            hashes, lambda at: [lower[a:b] for a, b in zip(words.start[first[at]], words.end[first[at]], strict=True)]
        )
        # From the ids of each different word to those of all words in order.
        total = np.concatenate([[0], np.cumsum(sizes[which])])
        ids = _gathered(ids, begin[which], sizes[which]).tobytes()
        bounds = zip((4 * total[words.first]).tolist(), (4 * total[words.last]).tolist(), strict=True)
        return [ids[a:b] for a, b in bounds]

    def _look_up(
        self, hashes: np.ndarray, words: Callable[[np.ndarray], list[bytes]]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array with the ids of all words, and where those of each begin, and how many.

        ``hashes`` are in order, ``words`` gives the words at some of their places.
        """
        at = np.searchsorted(self.known, hashes)
        old = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        old[inside] = self.known[at[inside]] == hashes[inside]
        new = np.flatnonzero(~old)
        missing = [word.decode() for word in words(new)]
        learned = self._learn(missing) if missing else {}
        found = [learned[word] for word in missing]
        ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
        begin, sizes = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        begin[old], sizes[old] = self.begin[at[old]], self.sizes[at[old]]
        sizes[new] = [len(one) // 4 for one in found]
        begin[new] = len(self.ids) + np.cumsum(sizes[new]) - sizes[new]
        if len(self.known) + len(new) > KNOWN_WORDS or len(ids) > KNOWN_IDS:
            # The words of this call alone stay.
            self.known, self.sizes, self.begin = hashes, sizes, np.cumsum(sizes) - sizes
            self.ids = _gathered(ids, begin, sizes)
        else:
            self.known = np.insert(self.known, at[new], hashes[new])
            self.begin = np.insert(self.begin, at[new], begin[new])
            self.sizes = np.insert(self.sizes, at[new], sizes[new])
            self.ids = ids
        return ids, begin, sizes

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        learned = {}
        together = " ".join(words)
        if not _PLAIN.fullmatch(together):
            plain = [_PLAIN.fullmatch(word) for word in words]
            others = [word for word, is_plain in zip(words, plain, strict=True) if not is_plain]
            learned.update(zip(others, self._encode_each(others), strict=True))
            words = [word for word, is_plain in zip(words, plain, strict=True) if is_plain]
            together = " ".join(words)
        if len(self.pieces) > KNOWN_PIECES:
            self.pieces = {" ": _NEXT}
        parts, pieces = _PIECE.findall(together.lower()), self.pieces
        new = list({part for part in parts if part not in pieces})
        pieces.update(zip(new, self._encode_pieces(new), strict=True))
        found = b"".join(map(pieces.__getitem__, parts)).split(_NEXT) if words else []
        learned.update(zip(words, found, strict=True))
        return learned

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        if not pieces:
            return []
        ids = []
        groups = [" ".join(pieces[at : at + 64]) for at in range(0, len(pieces), 64)]
        for one in self.tokenizer.encode_batch_fast(groups, add_special_tokens=False):
            ids += one.ids
        ends = [at for at, i in enumerate(ids, 1) if i in self.last]
        if len(ends) != len(pieces):
            return self._encode_each(pieces)
        data = np.array(ids, "<u4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _encode_each(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in encoded]


def _gathered(values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[begin[i] : begin[i] + sizes[i]]`` for each i, one after the other."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    return values[np.arange(total[-1]) + np.repeat(begin - total[:-1], sizes)]


# Words whose lower case and composition need no tables, and their pieces or the blank between.
_PLAIN = re.compile(r"[\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 ]+| ")
# Between the ids of two words; no id has these bytes, and four-byte ids keep it aligned.
_NEXT = b"\xff\xff\xff\xff"


@cache
def word_ids(path: str) -> WordIds:
    """One per process: a worker that is used again still knows the words of its last task."""
    return WordIds(path)


def cut(tokens: int, length: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces."""
    return [(start, min(length, tokens - start)) for start in range(0, tokens, length)]


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: Callable[[], str] = tokenizer_file,
    length: int = LENGTH,
) -> DataFrame:
    """One row per piece: doc_id, piece_key, start, length, ids_crc32, doc_tokens.

    ``tokenizer`` gives the path of the vocabulary and is called where the work is done.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
    )
    rows = rows.select("doc_id", F.xxhash64("doc_id", "body").alias("piece_key"), "body")
    end = np.array([END_ID], "<u4").tobytes()
    names = ["doc_id", "piece_key", "start", "length", "ids_crc32", "doc_tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        ids = word_ids(tokenizer())
        for batch in batches:
            at, found = [], []
            texts = (ids.encode(data, offsets) for _, _, data, offsets in chunks(batch, 2))
            for row, data in enumerate(chain.from_iterable(texts)):
                data += end
                tokens = len(data) // 4
                for start, size in cut(tokens, length):
                    crc = zlib.crc32(data[4 * start : 4 * (start + size)])
                    at.append(row)
                    found.append((start, size, crc, tokens))
            columns = [batch.column(0).take(pa.array(at, pa.int64()))]
            columns.append(batch.column(1).take(pa.array(at, pa.int64())))
            numbers = np.array(found, np.int64).reshape(-1, 4)
            columns += [pa.array(numbers[:, i]) for i in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, PIECES.format(id=kind))


def shortest_pack_first(counts: dict[int, int], length: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths in order) and how often each is used.

    ``counts`` has a number of pieces for each length. Every piece is placed exactly once.
    """
    # Patterns by their total, shortest first; those of equal total in order of making.
    waiting: list[tuple[int, int, list[int], int]] = []
    done: list[tuple[list[int], int]] = []
    made = 0
    for size in sorted(counts, reverse=True):
        left = counts[size]
        placed = []
        while left:
            if waiting and waiting[0][0] + size <= length:
                total, _, pattern, times = heapq.heappop(waiting)
                used = min(times, left)
                if used < times:
                    made += 1
                    heapq.heappush(waiting, (total, made, pattern, times - used))
                pattern, total = [*pattern, size], total + size
            else:
                fits = length // size
                # As many whole sequences of this length alone as there are, then one with the rest.
                used = left // fits if left >= fits else 1
                copies = fits if left >= fits else left
                pattern, total = [size] * copies, copies * size
                left -= used * (copies - 1)
            left -= used
            if total == length:
                done.append((pattern, used))
            else:
                placed.append((pattern, total, used))
        for pattern, total, used in placed:
            made += 1
            heapq.heappush(waiting, (total, made, pattern, used))
    return done + [(pattern, times) for _, _, pattern, times in sorted(waiting, key=lambda x: x[:2])]


def slots(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of a length go, by their rank among the pieces of that length.

    Rows: length, first rank, rank after the last, sequence of the first, offset, times. Equal
    lengths that follow each other in a pattern share a row: rank ``first + copy * times + i``
    lies in sequence ``sequence + i`` at ``offset + copy * length``.
    """
    rows = []
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, times in patterns:
        starts = [0, *accumulate(pattern)]
        at = 0
        while at < len(pattern):
            size = pattern[at]
            copies = 1
            while at + copies < len(pattern) and pattern[at + copies] == size:
                copies += 1
            first = taken.get(size, 0)
            taken[size] = first + copies * times
            rows.append((size, first, taken[size], sequence, starts[at], times))
            at += copies
        sequence += times
    return rows


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: Callable[[], str] = tokenizer_file,
    length: int = LENGTH,
) -> DataFrame:
    """The pieces of ``pieces`` with the sequence_id and the offset of each."""
    spark = docs.sparkSession
    made = stored(pieces(docs, id_col, text_col, tokenizer, length), "packing-pieces")
    made = made.withColumn("salt", F.pmod(F.xxhash64("piece_key", "start"), F.lit(SALTS)))
    counts = stored(
        made.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "packing-counts"
    )
    # At most one row per length: bounded by the length of a sequence, not by the input.
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    patterns = shortest_pack_first({row["length"]: row["n"] for row in histogram}, length)
    places = spark.createDataFrame(
        slots(patterns),
        "slot_length long, first_rank long, end_rank long, first_sequence long, slot_offset long,"
        " times long",
    )
    lower = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        F.col("length").alias("of_length"),
        F.col("salt").alias("of_salt"),
        F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("before"),
    )
    own = W.partitionBy("length", "salt").orderBy("piece_key", "start")
    ranked = made.withColumn("own_rank", F.row_number().over(own) - 1)
    ranked = ranked.join(
        before, (F.col("length") == F.col("of_length")) & (F.col("salt") == F.col("of_salt"))
    ).withColumn("place", F.col("before") + F.col("own_rank"))
    # Bounded like the histogram: a pattern is made or split once per length at most.
    placed = ranked.join(
        F.broadcast(places),
        (F.col("length") == F.col("slot_length"))
        & (F.col("place") >= F.col("first_rank"))
        & (F.col("place") < F.col("end_rank")),
    )
    within = F.col("place") - F.col("first_rank")
    return placed.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first_sequence") + within % F.col("times")).alias("sequence_id"),
        (F.col("slot_offset") + F.expr("(place - first_rank) div times") * F.col("length")).alias(
            "offset"
        ),
    )
