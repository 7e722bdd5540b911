"""What each filter of a text pipeline removes, in every order of applying the filters.

Filters: A few words, B few different words, C many capitals, D signs of markup, E a copy of a text
with a smaller id. A document's failures are a mask of five bits; what any order of the filters does
follows from how many documents have each mask.

Copies are found by radix tries of whole texts. First every task puts the texts of a batch into a
trie: rows that share a text with a smaller id are copies, one row stands for its text. Those texts
are then dealt by prefixes that adapt: a prefix that more than ``RANGE_WEIGHT`` of text begins with,
or more than ``RANGE_SHARE`` of a task's share, is lengthened, again and again, until its texts fit,
or are all one text. The texts of a prefix meet
in one trie, whose terminals hold the least ids; traversing it gives the rows that stand behind a
smaller id. A text that a third of the rows have comes there once from each batch.

The prefixes to lengthen are collected: at most one for each range's weight of text, and never more
than ``PREFIX_BYTES`` of them: beyond that, ranges are made larger instead.

Masks are counted per part before anything else, so a part on a third of the rows is a few counts. Of
those, 120 orders of five steps are made per part.

Defined results: a null text is an empty one, a null part an empty string. An id that is repeated is
a document for each row; rows of one id and one text are not copies of each other, whoever of them
stands first. A null id comes after all others. A document counts as good or toxic if any label row
of its id says so; one without label or id as neither. Columns besides those named are not read. An
empty table has no parts and gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bercario.llm.tables import stored
from bercario.llm.text_trie import TextTrie, id_order
from bercario.llm.words import text_buffers
from bercario.operators.lookups import attach

FILTERS = "ABCDE"
A, B, C, D, E = (1 << place for place in range(5))

# The failure conditions.
LEAST_WORDS = 50
LEAST_DIFFERENT = 65  # per cent of the words
MOST_CAPITALS = 5  # per cent of the code points
MARKUP = re.compile(rb"[#$%&*|]")

# Bytes of text under one prefix, each row counting as some more, and bytes of all prefixes; a prefix
# has no more than this part of what a shuffled partition has on average.
RANGE_WEIGHT, ROW_WEIGHT = 32 << 20, 400
RANGE_SHARE = 0.5
PREFIX_BYTES = 8 << 20
FIRST_PREFIX, LONGER = 4, 4

_CAPITALS = bytes(range(65, 91))
_CONTINUATION = bytes(range(0x80, 0xC0))


def text_mask(text: bytes) -> int:
    """The failures of a text by itself, of UTF-8 bytes."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text.translate(None, _CONTINUATION))
    mask = A if len(words) < LEAST_WORDS else 0
    if 100 * len(set(words)) < LEAST_DIFFERENT * len(words):
        mask |= B
    if 100 * capitals > MOST_CAPITALS * points:
        mask |= C
    if MARKUP.search(text):
        mask |= D
    return mask


ASSESSED = "doc_id {id}, part string, text_key long, mask int, is_copy boolean, text string"


def _assessed(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Each row with its mask but for E, and whether its batch has its text with a smaller id.

    ``text`` is given once for each text of a batch, with the least id that it has there.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    rows = rows.select("doc_id", "part", F.xxhash64("text").alias("text_key"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(3))
            ids, bounds = [id_order(i) for i in batch.column(0).to_pylist()], offsets.tolist()
            trie, masks = TextTrie(), []
            for row, order in enumerate(ids):
                text = data[bounds[row] : bounds[row + 1]].tobytes()
                masks.append(text_mask(text))
                trie.insert(text, order, row)
            copies = np.zeros(batch.num_rows, bool)
            unspoken = np.ones(batch.num_rows, bool)
            for node in trie.terminals():
                for row in node.rows:
                    copies[row] = ids[row] != node.least
                unspoken[next(row for row in node.rows if ids[row] == node.least)] = False
            texts = pa.array(np.arange(batch.num_rows), mask=unspoken)
            columns = [*batch.columns[:3], pa.array(masks, pa.int32()), pa.array(copies), batch.column(3).take(texts)]
            names = ["doc_id", "part", "text_key", "mask", "is_copy", "text"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(work, ASSESSED.format(id=rows.schema["doc_id"].dataType.simpleString()))


def _weight() -> Column:
    return F.octet_length("text") + F.lit(ROW_WEIGHT).cast("bigint")


def _prefix(length: int) -> Column:
    return F.substring("text", 1, length)


def _with_heavy(texts: DataFrame, heavy: DataFrame, length: int, how: str) -> DataFrame:
    """Joined to prefixes whose size was measured when they were collected."""
    return texts.join(F.broadcast(heavy), _prefix(length) == F.col(heavy.columns[0]), how)


def range_weight(texts: DataFrame, most: int = RANGE_WEIGHT) -> int:
    """How much text may share a prefix, for as many partitions as the session shuffles to."""
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = texts.agg(F.sum(_weight())).first()[0] or 0
    return min(most, max(1, int(RANGE_SHARE * total / partitions)))


def long_prefixes(texts: DataFrame, weight: int) -> list[tuple[int, DataFrame]]:
    """By length: the prefixes (one column) with more than ``weight`` of text that can be split."""
    spark, levels, length, size = texts.sparkSession, [], FIRST_PREFIX, 0
    while True:
        counted = texts.groupBy(_prefix(length).alias("prefix")).agg(
            F.sum(_weight()).alias("weight"), F.max(F.char_length("text")).alias("longest")
        )
        # Texts that all end here are one text; no prefix tells them apart.
        heavy = counted.filter((F.col("weight") > weight) & (F.col("longest") > length)).select("prefix")
        found = heavy.collect()
        if not found:
            return levels
        size += sum(len(row["prefix"].encode()) + 16 for row in found)
        if size > PREFIX_BYTES:
            return long_prefixes(texts, 2 * weight)
        heavy = spark.createDataFrame([tuple(row) for row in found], f"heavy_{length} string")
        levels.append((length, heavy))
        texts = _with_heavy(texts, heavy, length, "left_semi")
        length *= LONGER


def _by_prefix(texts: DataFrame, levels: list[tuple[int, DataFrame]]) -> DataFrame:
    """``texts`` with ``prefix``, the shortest one that need not be lengthened."""
    key = _prefix(levels[-1][0] * LONGER if levels else FIRST_PREFIX)
    for length, heavy in reversed(levels):
        texts = _with_heavy(texts, heavy, length, "left")
        key = F.when(F.col(heavy.columns[0]).isNull(), _prefix(length)).otherwise(key)
    return texts.select("doc_id", "text_key", "text", key.alias("prefix"))


def later_rows(texts: DataFrame, weight: int = RANGE_WEIGHT) -> DataFrame:
    """doc_id and text_key of the texts that another row has with a smaller id.

    The rows of a partition are sorted by prefix, so one trie is held at a time.
    """
    levels = long_prefixes(texts, range_weight(texts, weight))
    dealt = _by_prefix(texts, levels).repartition("prefix").sortWithinPartitions("prefix")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, prefix, ids, keys = TextTrie(), None, [], []

        def later() -> Iterator[pa.RecordBatch]:
            rows = [row for node in trie.terminals() for row in node.rows if id_order(ids[row]) != node.least]
            columns = [pa.array([ids[row] for row in rows], kind), pa.array([keys[row] for row in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            data, offsets = text_buffers(batch.column(2))
            bounds = offsets.tolist()
            own, own_keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, of in enumerate(batch.column(3).to_pylist()):
                if of != prefix:
                    if prefix is not None:
                        yield from later()
                    trie, prefix, ids, keys = TextTrie(), of, [], []
                trie.insert(data[bounds[row] : bounds[row + 1]].tobytes(), id_order(own[row]), len(ids))
                ids.append(own[row])
                keys.append(own_keys[row])
        if prefix is not None:
            yield from later()

    kind = texts.schema["doc_id"].dataType.simpleString()
    return dealt.mapInArrow(work, f"doc_id {kind}, text_key long").distinct()


def document_failures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    weight: int = RANGE_WEIGHT,
) -> DataFrame:
    """doc_id, part, mask (A is bit 0) and documents, how many equal rows that stands for."""
    rows = stored(_assessed(docs, id_col, text_col, part_col), "audit-rows")
    texts = rows.filter(F.col("text").isNotNull()).select("doc_id", "text_key", "text")
    later = later_rows(texts, weight).withColumnsRenamed({"doc_id": "later_id", "text_key": "later_key"})
    # Equal rows are one before they are moved.
    counted = rows.groupBy("doc_id", "part", "text_key", "mask", "is_copy")
    counted = counted.agg(F.count(F.lit(1)).alias("documents"))
    same = F.col("doc_id").eqNullSafe(F.col("later_id")) & (F.col("text_key") == F.col("later_key"))
    joined = counted.join(later, same, "left")
    copy = F.col("is_copy") | F.col("later_key").isNotNull()
    mask = F.col("mask") + F.when(copy, F.lit(E)).otherwise(F.lit(0))
    return joined.select("doc_id", "part", mask.alias("mask"), "documents")


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def steps_of_all_orders() -> list[tuple[str, int, int, int]]:
    """Order, step from 1, the mask of the filters before, and that of the step's filter."""
    bit = {letter: 1 << place for place, letter in enumerate(FILTERS)}
    return [
        ("".join(order), step + 1, sum(bit[x] for x in order[:step]), bit[letter])
        for order in permutations(FILTERS)
        for step, letter in enumerate(order)
    ]


def audit_matrix() -> tuple[list[tuple[str, int, int, int]], dict[str, np.ndarray]]:
    """For each step, which of the 32 masks count for each result; Shapley sums over its filter."""
    steps = steps_of_all_orders()
    mask = np.arange(32)
    before = np.array([x[2] for x in steps])[:, None]
    own = np.array([x[3] for x in steps])[:, None]
    fails, met = (mask & own) != 0, (mask & before) != 0
    matrix = {
        "kept": ~fails & ~met,
        "removed": fails & ~met,
        "redundant": fails & met,
        "unique_fails": (mask == own),
    }
    matrix = {name: part.astype(np.int64) for name, part in matrix.items()}
    matrix["shapley"] = (own == own.T).astype(np.int64) @ matrix["removed"]
    return steps, matrix


def audit(
    failures: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    good_col: str = "quality",
    toxic_col: str = "toxic",
) -> DataFrame:
    """part, filter_order, step and ``COUNTS``, of the rows of ``document_failures``."""
    said = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(
        F.coalesce(F.max(F.col(good_col) == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col(toxic_col) == 1), F.lit(False)).alias("toxic"),
    )
    labelled = attach(stored(failures, "audit-failures"), stored(said, "audit-labels"), "doc_id", unique=True)
    good, toxic = (F.coalesce(name, F.lit(False)) for name in ("good", "toxic"))
    counts = labelled.groupBy("part", "mask", good.alias("good"), toxic.alias("toxic"))
    counts = counts.agg(F.sum("documents").alias("n"))
    # 32 masks with two flags: at most 128 counts for a part.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("counts"))
    steps, matrix = audit_matrix()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = pa.array([x[0] for x in steps])
        step = pa.array([x[1] for x in steps], pa.int32())
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                everyone, of_good, of_toxic = np.zeros((3, 32), np.int64)
                for one in found:
                    everyone[one["mask"]] += one["n"]
                    of_good[one["mask"]] += one["n"] * one["good"]
                    of_toxic[one["mask"]] += one["n"] * one["toxic"]
                made = {name: rows @ everyone for name, rows in matrix.items()}
                made |= {"good_lost": matrix["removed"] @ of_good, "toxic_lost": matrix["removed"] @ of_toxic}
                columns = [pa.array([part] * len(steps)), order, step, *[pa.array(made[n]) for n in COUNTS]]
                yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *COUNTS])

    numbers = ", ".join(f"{name} long" for name in COUNTS)
    return parts.mapInArrow(work, f"part string, filter_order string, step int, {numbers}")
