"""Benchmark passages in documents, by winnowing.

Every five consecutive words are hashed, and of every nine consecutive hashes the least (the last
of equal ones) is a fingerprint. Thirteen words are nine hashes, so any thirteen words that a
document and an item share have the same least hash at the same place: no shared span of thirteen
words or more is missed. A document's fingerprints are looked up among those of the item windows,
and a hit is extended to its window, whose thirteen words must all agree. Items of fewer words are
one window each, found from their first word.

The index of the item windows is sent to all tasks if the benchmark's texts have at most
``INDEX_BYTES``. The windows of a larger benchmark stay in Spark: a bitmap of its fingerprints, of a
fixed size, goes to all tasks; the documents are read once, and what passes the bitmap is joined with
the windows by a shuffle. A window is one row there, however many items have it, so a passage of a
third of the documents is split like any frequent key. No item and no window comes to the driver.

Words are what is left of ``a-z``, ``0-9`` and everything outside ASCII, after lower-casing A-Z.

Defined results: a null or empty text, of a document or an item, has no words and no window. Every
row gives one row; rows that repeat an id are judged each for itself, as are those with a null
id. Items that repeat an id count once; an item without id counts under the empty name. Columns
besides id and text are not read. An empty table on either side gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bercario.llm.tables import stored
from bercario.llm.words import ALPHANUMERIC, PLACE, Words, chunks, mixed
from bercario.operators.lookups import fits_broadcast

SPAN = 13
GRAM = 5
WINDOW = SPAN - GRAM + 1
INDEX_BYTES = 2 << 20
# Contaminated: at least this share of the words, one twentieth, is hit.
SHARE = 20
# Contaminated documents whose keys may be sent to all tasks, and their bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 300_000, 16 << 20

_HITS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def fingerprints(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its first word, its least hash, and the word where that hash begins."""
    many = words.count - SPAN + 1
    if many < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    grams = words.hash[: words.count - GRAM + 1] * PLACE[0]
    for place in range(1, GRAM):
        grams += words.hash[place : place + len(grams)] * PLACE[place]
    grams = mixed(grams)
    least = grams[:many].copy()
    at = np.zeros(many, np.int8)
    for step in range(1, WINDOW):
        later = grams[step : step + many]
        lower = later <= least
        least[lower] = later[lower]
        at[lower] = step
    start = np.flatnonzero(words.text[:many] == words.text[SPAN - 1 :])
    return start, least[start], start + at[start]


def run_hash(words: Words, start: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each start."""
    total = np.zeros(len(start), np.uint64)
    for place in range(length):
        total += words.hash[start + place] * PLACE[place]
    return mixed(total + np.uint64(length))


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number in each ``begin[i]:end[i]``, and its ``i``."""
    sizes = end - begin
    which = np.repeat(np.arange(len(begin)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[which], which


class Index:
    """The windows of a benchmark of bounded size. Equal windows are one entry with all their items."""

    def __init__(self, items: list[tuple[str, str]]):
        texts = [text.encode() for _, text in items]
        data = np.frombuffer(b"".join(texts), np.uint8)
        words = Words(data, np.cumsum([0, *map(len, texts)]), ALPHANUMERIC)
        names = [name for name, _ in items]
        rows: dict[tuple, set] = {}
        if words.count:
            start, least, at = fingerprints(words)
            whole = run_hash(words, start, SPAN)
            owners = words.text[start]
            for key in zip(least.tolist(), (at - start).tolist(), whole.tolist(), owners.tolist(), strict=True):
                rows.setdefault((SPAN, *key[:3]), set()).add(names[key[3]])
            for i, count in enumerate((words.last - words.first).tolist()):
                if 0 < count < SPAN:
                    first = words.first[i : i + 1]
                    whole = int(run_hash(words, first, count)[0])
                    rows.setdefault((count, int(words.hash[first[0]]), 0, whole), set()).add(names[i])
        ordered = sorted(rows)
        self.items = [sorted(rows[key]) for key in ordered]
        self.length = np.array([key[0] for key in ordered], np.int64)
        self.mark = np.array([key[1] for key in ordered], np.uint64)
        self.shift = np.array([key[2] for key in ordered], np.int64)
        self.whole = np.array([key[3] for key in ordered], np.uint64)

    def find(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """First word and index entry of every window that stands in the texts."""
        found = []
        for length in np.unique(self.length).tolist():
            low, high = np.searchsorted(self.length, [length, length + 1])
            marks = self.mark[low:high]
            if length == SPAN:
                _, least, at = fingerprints(words)
                # Neighbouring windows share a fingerprint; each is looked up once.
                new = np.ones(len(at), bool)
                new[1:] = at[1:] != at[:-1]
                least, at = least[new], at[new]
            else:
                least, at = words.hash, np.arange(words.count)
            begin = np.searchsorted(marks, least, side="left")
            known = np.flatnonzero(marks[np.minimum(begin, len(marks) - 1)] == least)
            if not len(known):
                continue
            begin, least, at = begin[known], least[known], at[known]
            entry, which = _spread(begin, np.searchsorted(marks, least, side="right"))
            entry += low
            start = at[which] - self.shift[entry]
            inside = (start >= 0) & (start + length <= words.count)
            start, entry = start[inside], entry[inside]
            inside = words.text[start] == words.text[start + length - 1]
            start, entry = start[inside], entry[inside]
            equal = run_hash(words, start, length) == self.whole[entry]
            found.append((start[equal], entry[equal]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans joined where they touch or overlap, in order."""
    result: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


def _scan_chunk(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
    words = Words(data, offsets, ALPHANUMERIC)
    counts = (words.last - words.first).tolist()
    start, entry = index.find(words)
    spans: dict[int, list] = {}
    items: dict[int, set] = {}
    seen: dict[int, set] = {}
    for of, at, which in zip(words.text[start].tolist(), start.tolist(), entry.tolist(), strict=True):
        begin = at - int(words.first[of])
        spans.setdefault(of, []).append((begin, begin + int(index.length[which])))
        if which not in seen.setdefault(of, set()):
            seen[of].add(which)
            items.setdefault(of, set()).update(index.items[which])
    return [
        (count, merged(spans.get(i, [])), sorted(items.get(i, ())))
        for i, count in enumerate(counts)
    ]


_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scan(rows: DataFrame, index: Index) -> DataFrame:
    """doc_id, text_key and ``_HITS`` of each row."""
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                x for _, _, data, offsets in chunks(batch, 2) for x in _scan_chunk(shared.value, data, offsets)
            ]
            columns = [
                pa.array([x[0] for x in found], pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in x[1]] for x in found], _SPAN_TYPE),
                pa.array([x[2] for x in found], pa.list_(pa.string())),
            ]
            names = ["doc_id", "text_key", "n_words", "spans", "items"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, text_key long, {_HITS}")


# Bits of the bitmap of fingerprints, 64 in a number: 8 MB.
BITS = 1 << 26


def _bit(values: np.ndarray) -> np.ndarray:
    return mixed(values) & np.uint64(BITS - 1)


def _item_windows(items: DataFrame) -> DataFrame:
    """length, mark, shift, whole, item and the bit of what a document shows first, of all windows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in chunks(batch, 1):
                words = Words(data, offsets, ALPHANUMERIC)
                start, least, at = fingerprints(words)
                parts = [(np.full(len(start), SPAN), least, at - start, run_hash(words, start, SPAN), words.text[start])]
                count = words.last - words.first
                for length in range(1, SPAN):
                    of = np.flatnonzero(count == length)
                    whole = run_hash(words, words.first[of], length)
                    parts.append((np.full(len(of), length), whole, np.zeros(len(of), np.int64), whole, of))
                length, mark, shift, whole, of = (np.concatenate(x) for x in zip(*parts, strict=True))
                names = batch.column(0).slice(begin, end - begin).take(pa.array(of, pa.int64()))
                numbers = [length, mark.view(np.int64), shift, whole.view(np.int64), _bit(mark).view(np.int64)]
                columns = [*[pa.array(x.astype(np.int64)) for x in numbers], names]
                yield pa.RecordBatch.from_arrays(columns, ["length", "mark", "shift", "whole", "bit", "item"])

    schema = "length long, mark long, shift long, whole long, bit long, item string"
    return items.select("item", "item_text").mapInArrow(work, schema)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Which bits the windows set. At most ``BITS`` / 64 numbers, whatever the benchmark."""
    word, bit = F.shiftright("bit", 6), F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    found = windows.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bitmap.view(np.uint64)


def _passing(words: Words, lengths: list[int], bitmap: np.ndarray) -> tuple[np.ndarray, ...]:
    """length, mark, shift, whole and start of the windows of the texts whose mark is in the bitmap."""

    def known(values: np.ndarray) -> np.ndarray:
        bit = _bit(values)
        return np.flatnonzero((bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))

    parts = []
    for length in lengths:
        if length == SPAN:
            start, least, at = fingerprints(words)
            some = known(least)
            start, mark, shift = start[some], least[some], (at - start)[some]
            whole = run_hash(words, start, SPAN)
        else:
            start = np.arange(max(words.count - length + 1, 0))
            start = start[words.text[start] == words.text[start + length - 1]]
            whole = run_hash(words, start, length)
            some = known(whole)
            start, whole = start[some], whole[some]
            mark, shift = whole, np.zeros(len(start), np.int64)
        parts.append((np.full(len(start), length), mark.view(np.int64), shift, whole.view(np.int64), start))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


_SEEN = "array<struct<length:long,mark:long,shift:long,whole:long,start:long>>"
_SEEN_NAMES = ["length", "mark", "shift", "whole", "start"]


def _joined(rows: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, text_key and ``_HITS`` of each row, for a benchmark of any size."""
    spark = rows.sparkSession
    windows = stored(_item_windows(items).distinct(), "decontamination-windows")
    lengths = sorted(row[0] for row in windows.select("length").distinct().collect())
    bitmap = spark.sparkContext.broadcast(_bitmap(windows))
    rows = rows.withColumn("row", F.monotonically_increasing_id())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, seen = [], []
            for _, _, data, offsets in chunks(batch, 2):
                words = Words(data, offsets, ALPHANUMERIC)
                counts += (words.last - words.first).tolist()
                columns = _passing(words, lengths, bitmap.value)
                owner = words.text[columns[4]]
                order = np.argsort(owner, kind="stable")
                bounds = np.searchsorted(owner[order], np.arange(words.texts + 1)).tolist()
                columns = [*columns[:4], columns[4] - words.first[owner]]
                listed = list(zip(*(x[order].tolist() for x in columns), strict=True))
                seen += [
                    [dict(zip(_SEEN_NAMES, one, strict=True)) for one in listed[a:b]]
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in _SEEN_NAMES]))
            columns = [*(batch.column(i) for i in (0, 1, 3)), pa.array(counts, pa.int64()), pa.array(seen, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "row", "n_words", "seen"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scanned = rows.mapInArrow(work, f"doc_id {kind}, text_key long, row long, n_words long, seen {_SEEN}")
    scanned = stored(scanned, "decontamination-scanned")
    seen = scanned.select("row", F.explode("seen").alias("one")).select("row", "one.*")
    window = ["length", "mark", "shift", "whole"]
    hits = stored(seen.join(windows.select(*window).distinct(), window), "decontamination-hits")
    # A document's own hits: no more than it has words, for each length.
    spans = hits.groupBy("row").agg(
        F.collect_list(F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"))).alias("spans")
    )
    members = windows.select("length", "whole", "item").distinct()
    items_of = hits.select("row", "length", "whole").distinct().join(members, ["length", "whole"])
    items_of = items_of.groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"start": s, "end": e} for s, e in merged([(x["start"], x["end"]) for x in row])]
                for row in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN_TYPE)], ["row", "spans"])

    spans = spans.mapInArrow(merge, "row long, spans array<struct<start:long,end:long>>")
    whole = scanned.drop("seen").join(spans, "row", "left").join(items_of, "row", "left")
    return whole.select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per row: doc_id, text_key, n_words, spans of hit words, items, n_hit, contaminated."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("text_key"),
        F.col(text_col).alias("body"),
    )
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(item_text_col), F.lit("")).alias("item_text"),
    )
    size = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    if size <= index_bytes:
        whole = _scan(rows, Index([tuple(x) for x in items.collect()]))
    else:
        whole = _joined(rows, items)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return whole.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))
    )


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    found = benchmark_hits(docs, benchmark, id_col, text_col).filter("contaminated")
    found = stored(found.select("doc_id", "text_key").distinct(), "contaminated")
    found = found.withColumnsRenamed({"doc_id": "llm_id", "text_key": "llm_key"})
    same = F.col(id_col).eqNullSafe(F.col("llm_id")) & (F.xxhash64(text_col) == F.col("llm_key"))
    # Few enough to send to all tasks, or else matched by a shuffle.
    few = F.broadcast(found) if fits_broadcast(found, BROADCAST_ROWS, BROADCAST_BYTES) else found
    return docs.join(few, same, "left_anti")


def digest(found: DataFrame) -> DataFrame:
    """``benchmark_hits`` with the items as a number and a hash."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
