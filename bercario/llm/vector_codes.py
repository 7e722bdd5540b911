"""Vectors compressed to short codes: product quantisation with equal-average search.

Components become whole numbers, a vector is cut into equal consecutive parts, and each part is
replaced by the number of the nearest entry of its position's codebook. Codebooks are fitted by
rounds of assignment and averaging over all rows.

Nearest entries are found by equal-average search. Entries are sorted by the sum of their
components. For d components the squared gap of two sums is at most d times the squared distance, so
the search goes outward from a part's own sum, the nearer side first, and ends when the squared gap
divided by d strictly exceeds the best distance. Entries at just that gap are still compared, which
keeps ties with the lower index exact.

A round reads the stored rows once. A task adds up its own rows and sends one number per codebook
component; what reaches the driver is as large as the codebooks, whatever the input. All arithmetic
is on whole numbers: 64-bit ones where squares fit, Python's otherwise.

Defined results: rows whose vector is null, or holds null, infinite or undefined components, take no
part; nor do those of another length than most of those that can be cut. Equal ids are ordered by vector, null ids come last; every such row is coded. Fewer rows
than entries give fewer entries. Equal labels share their ``label_error``, null ones too; an error
beyond 64 bits is given as the largest long. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bercario.llm.tables import stored
from bercario.llm.vectors import finite, matrix, of_common_length
from bercario.operators.lookups import attach

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = (1 << 63) - 1
# Sums travel in digits of this many bits, so that sums of sums fit a long.
DIGIT = 40


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of each component; Python's numbers where squared sums need over 64 bits."""
    scaled = np.floor(values * scale)
    if not len(values) or np.abs(scaled).max(initial=0) < (1 << 30) // values.shape[1]:
        return scaled.astype(np.int64)
    exact = np.empty(values.shape, object)
    for at, value in np.ndenumerate(values.astype(object)):
        product = value * scale
        exact[at] = math.floor(product) if math.isfinite(product) else math.floor(value) * scale
    return exact


@dataclass(frozen=True)
class Codebook:
    """The entries of one part position, and their order by component sum."""

    entries: np.ndarray
    order: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        sums = entries.sum(axis=1)
        order = np.argsort(sums, kind="stable")
        return cls(entries, order, sums[order])

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each row, by equal-average search."""
        entries, sums, order = self.entries, self.sums, self.order
        if rows.dtype == object or entries.dtype == object:
            rows, entries, sums = rows.astype(object), entries.astype(object), sums.astype(object)
        many, size = rows.shape
        index, best = np.zeros(many, np.int64), np.zeros(many, rows.dtype)
        active, total = np.arange(many), rows.sum(axis=1)
        right = np.searchsorted(sums, total)
        left = right - 1
        last = len(sums) - 1
        first = True
        while len(active):
            below, above = left >= 0, right <= last
            gap_below, gap_above = total - sums[np.maximum(left, 0)], sums[np.minimum(right, last)] - total
            down = below & (~above | (gap_below <= gap_above))
            gap = np.where(down, gap_below, gap_above)
            go = below | above
            if not first:
                go &= gap * gap <= size * best[active]
            active, left, right, total, down = (x[go] for x in (active, left, right, total, down))
            entry = order[np.where(down, left, right)]
            difference = rows[active] - entries[entry]
            distance = (difference * difference).sum(axis=1)
            better = (distance < best[active]) | ((distance == best[active]) & (entry < index[active]))
            better |= first
            index[active[better]], best[active[better]] = entry[better], distance[better]
            left, right = left - down, right + ~down
            first = False
        return index, best


@dataclass(frozen=True)
class Codebooks:
    """One codebook per part position."""

    parts: tuple[Codebook, ...]
    length: int
    scale: int

    def cut(self, values: np.ndarray) -> Iterator[tuple[Codebook, np.ndarray]]:
        rows, size = whole(values, self.scale), self.length // max(len(self.parts), 1)
        for at, part in enumerate(self.parts):
            yield part, rows[:, at * size : (at + 1) * size]

    def components(self) -> list[int]:
        """All components by part, entry and place."""
        return [int(x) for part in self.parts for x in part.entries.ravel().tolist()]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.components())).encode()).hexdigest()

    def decoded(self, code: bytes) -> list[float]:
        """The vector that a code stands for."""
        parts = zip(self.parts, code, strict=True)
        return [int(x) / self.scale for part, at in parts for x in part.entries[at].tolist()]


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """vec_id, vector, label of the rows that take part, stored."""
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")
    )
    length = F.size("vector")
    rows = rows.filter(finite(F.col("vector")) & (length > 0) & (length % parts == 0))
    return stored(of_common_length(rows, "vector")[0], "vector-codes-rows")


def _digits(number: int) -> Iterator[int]:
    while not -(1 << DIGIT) < number < 1 << DIGIT:
        yield number & ((1 << DIGIT) - 1)
        number >>= DIGIT
    yield number


SUMS = "part int, entry int, place int, digit int, total long"


def _sums(rows: DataFrame, books: Codebooks) -> dict[tuple[int, int], dict[int, int]]:
    """Of each part and entry in use: the sum at each place of a vector, and at -1 the count."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = books.length // len(books.parts)
        shape = [(len(part.entries), size) for part in books.parts]
        sums = [np.zeros(s, object) for s in shape]
        counts = [np.zeros(s[0], np.int64) for s in shape]
        for batch in batches:
            for at, (part, values) in enumerate(books.cut(matrix(batch.column(0)))):
                index, _ = part.nearest(values)
                added = np.zeros(shape[at], values.dtype)
                np.add.at(added, index, values)
                sums[at] += added.astype(object)
                counts[at] += np.bincount(index, minlength=shape[at][0])
        found = [
            (at, entry, place, digit, value)
            for at in range(len(shape))
            for entry in np.flatnonzero(counts[at]).tolist()
            for place, total in enumerate([int(counts[at][entry]), *sums[at][entry].tolist()], -1)
            for digit, value in enumerate(_digits(int(total)))
        ]
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = [pa.int32()] * 4 + [pa.int64()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "place", "digit", "total"])

    summed = rows.select("vector").mapInArrow(work, SUMS)
    summed = summed.groupBy("part", "entry", "place", "digit").agg(F.sum("total").alias("total"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    # As many numbers as the codebooks have components and entries, whatever the input.
    for part, entry, place, digit, total in summed.collect():
        places = found.setdefault((part, entry), {})
        places[place] = places.get(place, 0) + (total << DIGIT * digit)
    return found


def _exact(numbers: list[list[int]]) -> np.ndarray:
    entries = np.array(numbers, object)
    small = max((abs(x) for row in numbers for x in row), default=0) < (1 << 30) // max(entries.shape[1], 1)
    return entries.astype(np.int64) if small else entries


def train(
    rows: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks:
    """Codebooks of the rows of ``usable``: started from the rows of least id, averaged in rounds."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte per part: give 1 to 256 entries")
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    first = rows.orderBy(*order).limit(entries).select("vector").collect()
    if not first:
        return Codebooks((), 0, scale)
    start = whole(np.array([row["vector"] for row in first], np.float64), scale)
    size = start.shape[1] // parts
    cut = [start[:, at * size : (at + 1) * size].tolist() for at in range(parts)]
    books = Codebooks(tuple(Codebook.of(_exact(x)) for x in cut), start.shape[1], scale)
    for _ in range(rounds):
        sums = _sums(rows, books)
        made = [part.entries.tolist() for part in books.parts]
        for (at, entry), places in sums.items():
            made[at][entry] = [places.get(place, 0) // places[-1] for place in range(size)]
        books = Codebooks(tuple(Codebook.of(_exact(x)) for x in made), books.length, scale)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (a byte per part) and error of each row of ``usable``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], 0
            for part, values in books.cut(matrix(batch.column(2))):
                index, distance = part.nearest(values)
                codes.append(index.astype(np.uint8))
                errors = errors + distance.astype(object)
            joined = np.stack(codes, axis=1) if codes else np.zeros((batch.num_rows, 0), np.uint8)
            bounded = [min(int(e), LARGEST) for e in np.broadcast_to(errors, batch.num_rows)]
            code = pa.array([row.tobytes() for row in joined], pa.binary())
            columns = [batch.column(0), batch.column(1), code, pa.array(bounded, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    kinds = [f"{name} {rows.schema[name].dataType.simpleString()}" for name in ("vec_id", "label")]
    return rows.select("vec_id", "label", "vector").mapInArrow(work, ", ".join([*kinds, "code binary, error long"]))


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Codes of all usable rows, stored, and the codebooks that decode them."""
    rows = usable(vectors, id_col, vector_col, label_col, parts)
    books = train(rows, parts, entries, rounds, scale)
    return stored(encode(rows, books), "vector-codes"), books


def digest(codes: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, code in hex, error, the error of all rows of the label, and what the codebooks are.

    Errors are summed per label before they meet the rows, which a label on a third of them does
    not move: sums that were measured to be small are broadcast, others follow ``attach``.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    rows = codes.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", key.alias("own_label"))
    total = F.sum(F.col("error").cast("decimal(28,0)"))
    total = F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint")
    sums = stored(rows.groupBy("own_label").agg(total.alias("label_error")), "vector-codes-labels")
    return attach(rows, sums, "own_label", unique=True).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )
