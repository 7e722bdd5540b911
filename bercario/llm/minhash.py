"""Near duplicates: an inverted join of MinHash signatures, confirmed on full shingle sets.

1. A signature has 64 coordinates, each the least 64-bit value of one random function over the
   shingles of a text, and marked by its coordinate: texts without a common shingle share none, but
   for a chance of their lengths' product in 2 ** 64. Texts of equal shingle sets are one class from here on, so exact copies cost nothing.
2. Every class is posted under each coordinate and value. Classes of similarity 0.75 agree in 48
   coordinates on average, and in fewer than 32 with a probability of 4.6 in a million. Two
   classes with 32 agreements must meet among the 33 rarest postings of either (the prefix); the
   other, more frequent ones are skipped. A class with fewer than 32 postings in company is out.
3. Classes that meet are compared by their whole sets, however many coordinates agree. What is
   sought are the components, so pairs inside one are not compared: first every class is
   compared with two leaders of each list, which joins most of a group of copies at a cost in
   proportion to its size, and then the classes that still differ are compared. Short lists give
   pairs; long ones are cut into blocks, and each pair of blocks yields a spanning forest of its
   links, not the links.

Words are what white space (space, tab to carriage return) leaves, after lower-casing A-Z; a
shingle is five consecutive words, or the whole text if it has fewer.

Defined results: a null or empty text has no shingles and is linked with nothing. A null id is no
component's least id; a component without any id has the null id. Rows that repeat an id are
separate documents. Columns besides id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bercario.llm.components import components
from bercario.llm.tables import stored
from bercario.llm.words import NOT_SPACE, Words, chunks
from bercario.operators.lookups import fits_broadcast

SHINGLE = 5
COORDINATES = 64
LEAST_MATCHES = 32
# Link if 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
LEADERS = 2
# Lists of more classes are compared in blocks of this many.
LONG_LIST = 64
BLOCK = 256
# A block has about this many shingles at most, 8 bytes each, but for one longer text.
BLOCK_SHINGLES = 1 << 19
# Classes whose keys may be sent to all tasks, and their bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20
# Columns of a block's shingle table handled at a time.
_COLUMNS = 4096

_RANDOM = np.random.default_rng(75)
_MASK = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_FACTOR = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
# Least values are small; a mark moves those of each coordinate to a region of their own.
_MARK = (np.arange(COORDINATES, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, in order of the texts, and the number in each text."""
    start, value = words.runs(SHINGLE)
    owner = words.text[start]
    count = words.last - words.first
    for size in range(1, SHINGLE):
        of = np.flatnonzero(count == size)
        if len(of):
            first, whole = words.runs(size)
            chosen = np.isin(first, words.first[of])
            owner = np.concatenate([owner, words.text[first[chosen]]])
            value = np.concatenate([value, whole[chosen]])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.bincount(owner[new], minlength=words.texts)


def _signatures(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The least value of each random function over each text's shingles; zeros without any."""
    begin = np.cumsum(size) - size
    some = np.flatnonzero(size)
    signature = np.zeros((len(size), COORDINATES), np.int64)
    if len(some):
        for i in range(COORDINATES):
            least = np.minimum.reduceat((value ^ _MASK[i]) * _FACTOR[i], begin[some])
            signature[some, i] = (least ^ _MARK[i]).view(np.int64)
    return signature


def _sketch_chunk(data: np.ndarray, offsets: np.ndarray):
    """Set sizes, digests and signatures of the texts of a chunk."""
    value, size = shingles(Words(data, offsets, NOT_SPACE))
    begin = np.cumsum(size) - size
    signature = _signatures(value, size)
    digest = [
        hashlib.blake2b(value[b : b + n].tobytes(), digest_size=16).digest() if n else b""
        for b, n in zip(begin.tolist(), size.tolist(), strict=True)
    ]
    return size, digest, signature


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    width = values.shape[1]
    ends = pa.array(np.arange(len(values) + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), kind))


def sketches(rows: DataFrame) -> DataFrame:
    """doc_id, text_key, n, digest, signature of rows of doc_id, text_key and body."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_key", "n", "digest", "signature"]
        for batch in batches:
            for begin, end, data, offsets in chunks(batch, 2):
                size, digest, signature = _sketch_chunk(data, offsets)
                part = batch.slice(begin, end - begin)
                columns = [pa.array(size, pa.int64()), pa.array(digest, pa.binary())]
                columns.append(_lists(signature, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc_id {kind}, text_key long, n long, digest binary, signature array<long>"
    )


def full_sets(rows: DataFrame) -> DataFrame:
    """cid and the sorted shingle hashes as bytes, of rows of cid and body."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in chunks(batch, 1):
                value, size = shingles(Words(data, offsets, NOT_SPACE))
                ends = np.cumsum(size)
                sets = [value[e - n : e].tobytes() for e, n in zip(ends, size, strict=True)]
                columns = [batch.column(0).slice(begin, end - begin), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["cid", "members"])

    return rows.mapInArrow(work, "cid long, members binary")


def inverted_lists(classes: DataFrame) -> DataFrame:
    """token, cid, n, company: the prefix of each class, of postings that others share."""
    postings = classes.select("cid", "n", F.explode("signature").alias("token"))
    company = stored(
        postings.groupBy("token")
        .agg(F.count(F.lit(1)).alias("company"))
        .filter("company > 1")
        .withColumnRenamed("token", "shared"),
        "minhash-company",
    )
    shared = postings.join(company, F.col("token") == F.col("shared")).drop("shared")
    own = W.partitionBy("cid")
    rank = F.row_number().over(own.orderBy("company", "token"))
    # Postings without company are the rarest; they fill the prefix first.
    last = F.count(F.lit(1)).over(own) - (LEAST_MATCHES - 1)
    prefix = shared.withColumn("rank", rank).withColumn("last", last).filter("rank <= last")
    return stored(prefix.select("token", "cid", "n", "company"), "minhash-lists")


def _sizes_allow(n: str, m: str):
    return 100 * F.least(n, m) >= SIMILARITY * F.greatest(n, m)


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= SIMILARITY * (len(left) + len(right) - common)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    for side in ("a", "b"):
        own = sets.select(F.col("cid").alias("own"), F.col("members").alias(f"{side}_set"))
        pairs = pairs.join(own, F.col(side) == F.col("own")).drop("own")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                similar(
                    np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                )
                for x, y in zip(batch.column("a_set"), batch.column("b_set"), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "a_set", "b_set").mapInArrow(work, "a long, b long")


def forest(left: list[np.ndarray], right: list[np.ndarray], left_label: list, right_label: list):
    """Links between the sides that join different labels, as few as join the same."""
    sizes = np.array([len(x) for x in [*left, *right]])
    if not len(left) or not len(right):
        return []
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    # A shingle of one text alone adds nothing to an intersection.
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(shared.sum()), _COLUMNS):
        begin, end = np.searchsorted(column, [low, low + _COLUMNS])
        table = np.zeros((len(sizes), _COLUMNS), np.float32)
        table[owner[begin:end], column[begin:end] - low] = 1
        common += table[: len(left)] @ table[len(left) :].T
    total = sizes[: len(left), None] + sizes[None, len(left) :]
    linked = (100 * common >= SIMILARITY * (total - common)) & (total > 0)
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = root(left_label[i]), root(right_label[j])
        if a != b:
            parent[a] = b
            links.append((int(i), int(j)))
    return links


def _long_list_links(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes of different components, in the long lists, block by block.

    Only classes outside the largest component of a list are compared with the rest of it.
    """
    # Classes, and their shingles in units that make a block of either as large.
    units = F.sum(F.greatest(F.lit(1.0), F.col("n") * (BLOCK / BLOCK_SHINGLES)))
    part = lists.groupBy("token", "label").agg(units.alias("n_label"))
    largest = part.groupBy("token").agg(
        F.max(F.struct("n_label", "label")).alias("most"),
        F.sum("n_label").alias("n_all"),
        F.count(F.lit(1)).alias("labels"),
    )
    minor = F.greatest(F.col("n_all") - F.col("most.n_label"), F.lit(1.0))
    largest = largest.filter("labels > 1").select(
        F.col("token").alias("of_token"),
        F.col("most.label").alias("main"),
        F.ceil(F.col("n_all") / BLOCK).cast("int").alias("blocks"),
        F.ceil(minor / BLOCK).cast("int").alias("minor_blocks"),
    )
    largest = stored(largest, "minhash-long")
    rows = lists.join(largest, F.col("token") == F.col("of_token")).select(
        "token", "cid", "label", "main", "blocks", "minor_blocks"
    )
    place = F.xxhash64("cid")
    whole = rows.select(
        "token",
        F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)).alias("s"),
        F.pmod(place, "blocks").cast("int").alias("t"),
        F.lit(False).alias("minor"),
        "cid",
        "label",
    )
    minor = rows.filter("label != main").select(
        "token",
        F.pmod(place, "minor_blocks").cast("int").alias("s"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("t"),
        F.lit(True).alias("minor"),
        "cid",
        "label",
    )
    dealt = stored(whole.unionByName(minor), "minhash-blocks")
    own = sets.select(F.col("cid").alias("own"), "members")
    dealt = dealt.join(own, F.col("cid") == F.col("own")).drop("own")

    def compare(block: pa.Table) -> pa.Table:
        minor = np.array(block["minor"].to_pylist(), bool)
        sides = []
        for chosen in (minor, ~minor):
            side = block.filter(pa.array(chosen))
            members = [np.frombuffer(x.as_buffer(), np.uint64) for x in side["members"]]
            sides.append((members, side["cid"].to_pylist(), side["label"].to_pylist()))
        (left, a, a_label), (right, b, b_label) = sides
        links = forest(left, right, a_label, b_label)
        return pa.table({
            "a": pa.array([a[i] for i, _ in links], pa.int64()),
            "b": pa.array([b[j] for _, j in links], pa.int64()),
        })

    return dealt.groupBy("token", "s", "t").applyInArrow(compare, "a long, b long")


def class_links(classes: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) of classes that have the components of all links."""
    lists = inverted_lists(classes)
    met = lists.select(F.col("cid").alias("met")).distinct()
    wanted = stored(
        classes.join(met, F.col("cid") == F.col("met")).select("cid", "rep"),
        "minhash-met",
    )
    few = fits_broadcast(wanted, BROADCAST_ROWS, BROADCAST_BYTES)
    # Told to merge, as Spark goes by the size of files, of which the rows in memory are many times.
    keys = F.broadcast(wanted) if few else wanted.hint("merge")
    texts = rows.join(
        keys,
        rows["doc_id"].eqNullSafe(F.col("rep.doc_id")) & (rows["text_key"] == F.col("rep.text_key")),
    )
    texts = texts.select("cid", "body").dropDuplicates(["cid"])
    sets = stored(full_sets(texts), "minhash-sets")
    chosen = [F.min(F.struct(F.xxhash64("cid", F.lit(i)), "cid", "n")) for i in range(LEADERS)]
    leaders = lists.groupBy("token").agg(F.array(*chosen).alias("leads"))
    leaders = leaders.select(F.col("token").alias("of_token"), F.explode("leads").alias("lead"))
    leaders = leaders.select(
        "of_token", F.col("lead.cid").alias("lead"), F.col("lead.n").alias("lead_n")
    )
    # Stored, so that the join is between plain exchanges and Spark can split a long list's rows.
    leaders = stored(leaders, "minhash-leaders")
    pairs = (
        lists.join(leaders, F.col("token") == F.col("of_token"))
        .filter((F.col("cid") != F.col("lead")) & _sizes_allow("n", "lead_n"))
        .select(F.least("cid", "lead").alias("a"), F.greatest("cid", "lead").alias("b"))
    )
    links = stored(confirmed(pairs.distinct(), sets), "minhash-links")
    labels = components(links)
    labelled = lists.join(labels, lists["cid"] == labels["node"], "left").select(
        "token", "cid", "n", "company", F.coalesce("label", "cid").alias("label")
    )
    labelled = stored(labelled, "minhash-labelled")
    short = labelled.filter(F.col("company") <= LONG_LIST)
    other = short.select(
        F.col("token").alias("of_token"),
        F.col("cid").alias("other"),
        F.col("label").alias("other_label"),
        F.col("n").alias("other_n"),
    )
    pairs = short.join(
        other,
        (F.col("token") == F.col("of_token"))
        & (F.col("cid") < F.col("other"))
        & (F.col("label") != F.col("other_label"))
        & _sizes_allow("n", "other_n"),
    ).select(F.col("cid").alias("a"), F.col("other").alias("b"))
    links = links.unionByName(confirmed(pairs.distinct(), sets))
    long = labelled.filter(F.col("company") > LONG_LIST)
    if not long.isEmpty():
        links = links.unionByName(_long_list_links(long, sets))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, text_key, n_shingles, component, component_id, kept.

    ``component`` is a number of the component, null without shingles; ``component_id`` is its
    least id, which several components may share if ids repeat or are null.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("body")
    )
    sketched = stored(sketches(rows), "minhash-sketches")
    # Partial sums keep one row per class and task, however many copies there are.
    classes = stored(
        sketched.filter("n > 0")
        .groupBy("digest")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("rep"),
            F.min("doc_id").alias("least_id"),
            F.max("n").alias("n"),
            F.max("signature").alias("signature"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "minhash-classes",
    )
    labels = components(class_links(classes, rows))
    linked = classes.join(labels, F.col("cid") == F.col("node")).select("cid", "least_id", "label")
    least = linked.groupBy("label").agg(F.min("least_id").alias("component_id"))
    linked = linked.select(F.col("cid").alias("of_cid"), F.col("label").alias("of_label"))
    linked = linked.join(least, F.col("of_label") == F.col("label"))
    linked = linked.select("of_cid", "of_label", "component_id")
    least = classes.join(linked, F.col("cid") == F.col("of_cid"), "left").select(
        F.col("digest").alias("of_digest"),
        F.coalesce("of_label", "cid").alias("component"),
        # A component without any id has none; its classes have none either.
        F.coalesce("component_id", "least_id").alias("component_id"),
    )
    least = stored(least, "minhash-components")
    found = sketched.join(least, F.col("digest") == F.col("of_digest"), "left")
    alone = F.col("n") == 0
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        "component",
        component.alias("component_id"),
        (alone | F.col("doc_id").eqNullSafe(component)).alias("kept"),
    )
