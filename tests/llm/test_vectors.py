"""Vector codes and nearest neighbours, against plain versions."""

import hashlib
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bercario.llm import neighbours, vector_codes
from bercario.llm.queries import QUERIES

ARRAYS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
    ]
    # Names that the operators use inside.
    + [T.StructField(name, T.StringType()) for name in ("code", "vector", "error", "own_label", "row")]
)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, *["other"] * 5) for row in rows], ARRAYS)


# Vector codes -------------------------------------------------------------------------------


def plain_nearest(part, entries):
    distances = [sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)) for entry in entries]
    best = min(distances)
    return distances.index(best), best


@settings(max_examples=300, deadline=None)
@given(
    st.integers(1, 5).flatmap(
        lambda d: st.tuples(
            st.lists(st.lists(st.integers(-4, 4), min_size=d, max_size=d), min_size=1, max_size=20),
            st.lists(st.lists(st.integers(-4, 4), min_size=d, max_size=d), min_size=1, max_size=20),
            st.sampled_from([1, 1000, 10**30]),
        )
    )
)
def test_equal_average_search_finds_the_nearest(drawn):
    """Small whole numbers: many ties, and gaps of exactly the best distance; then huge ones."""
    rows, entries, factor = drawn
    rows = [[x * factor for x in row] for row in rows]
    entries = [[x * factor for x in entry] for entry in entries]
    book = vector_codes.Codebook.of(vector_codes._exact(entries))
    kind = np.int64 if factor < 10**6 else object
    index, distance = book.nearest(np.array(rows, kind))
    expected = [plain_nearest(row, entries) for row in rows]
    assert list(zip(index.tolist(), map(int, distance), strict=True)) == expected


def of_common_length(usable):
    counts = Counter(len(row[1]) for row in usable)
    return [row for row in usable if len(row[1]) == min(counts, key=lambda n: (-counts[n], n))]


def plain_codes(rows, parts, entries, rounds, scale=4096):
    usable = [
        row
        for row in rows
        if row[1] and len(row[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in row[1])
    ]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    usable = of_common_length(usable)
    if not usable:
        return [], ""
    cut = []
    for _, vector, _ in usable:
        numbers = [math.floor(Fraction(x) * scale) for x in vector]
        size = len(numbers) // parts
        cut.append([numbers[p * size : (p + 1) * size] for p in range(parts)])
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            groups = [[] for _ in books[p]]
            for row in cut:
                groups[plain_nearest(row[p], books[p])[0]].append(row[p])
            books[p] = [
                [sum(x) // len(group) for x in zip(*group, strict=True)] if group else entry
                for entry, group in zip(books[p], groups, strict=True)
            ]
    found, totals = [], {}
    for (vec_id, _, label), row in zip(usable, cut, strict=True):
        near = [plain_nearest(row[p], books[p]) for p in range(parts)]
        error = sum(n[1] for n in near)
        totals[label] = totals.get(label, 0) + error
        found.append((vec_id, "".join(f"{n[0]:02x}" for n in near), error, label))
    numbers = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(numbers.encode()).hexdigest()
    most = (1 << 63) - 1
    return [(i, c, min(e, most), min(totals[label], most), sha) for i, c, e, label in found], sha


def check_codes(spark, rows, parts, entries, rounds):
    made = vector_codes.compress(vectors(spark, rows), parts=parts, entries=entries, rounds=rounds)
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    found = vector_codes.digest(*made).select(*names).collect()
    expected, _ = plain_codes(rows, parts, entries, rounds)
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))


def random_rows(seed, many, size, spread=1.0):
    rng = random.Random(seed)
    return [
        (i, [round(rng.gauss(0, spread), 2) for _ in range(size)], rng.choice([None, 1, 2]))
        for i in rng.sample(range(-many, many), many)
    ]


ODD_VECTORS = [
    (1, None, 1),
    (2, [], 1),
    (3, [1.0, None, 2.0, 3.0], 1),
    (4, [1.0, math.nan, 2.0, 3.0], 2),
    (5, [1.0, math.inf, 2.0, 3.0], 2),
    (6, [1.0, 2.0, 3.0], 2),
    (7, [0.0, 0.0, 0.0, 0.0], None),
    (8, [0.5, -0.5, 0.25, -0.00001], None),
    (8, [0.5, -0.5, 0.25, -0.00001], None),
    (8, [0.5, -0.5, 0.25, 0.75], 3),
    (None, [9.0, 9.0, 9.0, 9.0], 3),
    (9, [1.0] * 6, 3),
    (100, [1.0, 0.5, 0.25, 0.125], 3),
]


def test_codes_equal_plain_ones(spark):
    check_codes(spark, random_rows(1, 120, 12), 4, 7, 3)


def test_codes_of_odd_rows(spark):
    check_codes(spark, ODD_VECTORS, 2, 3, 4)
    check_codes(spark, [], 2, 3, 1)
    check_codes(spark, ODD_VECTORS[:5], 2, 3, 1)


def test_codes_of_huge_components(spark):
    rows = ODD_VECTORS + [(20, [1e300, -1e300, 1.0, 1.7e308], 1), (21, [-1e25, 5.0, 1e9, -1e12], 1)]
    check_codes(spark, rows, 2, 4, 3)


def test_codes_of_one_hot_vector_and_label(spark):
    rows = random_rows(2, 60, 4) + [(1000 + i, [0.1, 0.2, 0.3, 0.4], 7) for i in range(200)]
    check_codes(spark, rows, 2, 5, 3)


def test_decoded_vectors_are_near(spark):
    rows = [(i, [float(i % 4), 1.0, float(i % 3), -1.0], 0) for i in range(50)]
    codes, books = vector_codes.compress(vectors(spark, rows), parts=2)
    of = dict((row[0], row[1]) for row in rows)
    for row in codes.collect():
        assert books.decoded(row["code"]) == pytest.approx(of[row["vec_id"]])


# Nearest neighbours -------------------------------------------------------------------------


def plain_neighbours(rows, is_query, k=10):
    """By id of the query: a list for each row that asks, of (score, null id, id)."""
    usable = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    usable = of_common_length(usable)
    found = {}
    for at, query in enumerate(usable):
        if is_query(query[0]):
            others = [
                (math.dist(query[1], row[1]), row[0] is None, row[0] or 0)
                for i, row in enumerate(usable)
                if i != at
            ]
            found.setdefault(query[0], []).append(sorted(others)[:k])
    return found


def ask(spark, rows, k=10):
    found = neighbours.nearest_neighbours(vectors(spark, rows), F.col("vec_id") % 100 == 0, k).collect()
    answers = {}
    for row in sorted(found, key=lambda row: row["rank"]):
        answers.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    return answers


def by_100(vec_id):
    return vec_id is not None and vec_id % 100 == 0


def recall(answers, expected):
    """Of the true neighbours of queries with an id of their own; what is found is ranked right."""
    hit = total = 0
    for query, (best,) in expected.items():
        got = answers.get(query, [])
        assert [rank for rank, _, _ in got] == list(range(1, len(best) + 1))
        ordered = [(score, i is None, i or 0) for _, i, score in got]
        assert ordered == sorted(ordered)
        true = {i: score for score, _, i in best}
        for _, i, score in got:
            if i in true:
                assert score == pytest.approx(true[i], rel=1e-12, abs=1e-12)
                hit += 1
        total += len(best)
    return hit / total


def test_recall_on_the_whole_table(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    answers = {}
    for row in sorted(QUERIES["op13_neighbours"](spark, folder).collect(), key=lambda row: row["rank"]):
        answers.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert recall(answers, plain_neighbours(rows, by_100)) >= 0.9


def test_recall_among_clusters_and_one_hot_vector(spark, monkeypatch):
    """A third of the rows are one vector: its bucket is split over shards."""
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 12))
    cloud = centres[rng.integers(0, 20, 1200)] + rng.normal(size=(1200, 12)) * 0.3
    rows = [(i * 2, list(map(float, v)), 0) for i, v in enumerate(cloud)]
    rows += [(2 * i + 1, [0.5] * 12, 0) for i in range(600)]
    rows.append((100_000, [0.5] * 12, 0))
    answers, expected = ask(spark, rows), plain_neighbours(rows, by_100)
    assert recall(answers, expected) >= 0.9
    # All of the nearest are equal: the smallest ids win.
    assert [i for _, i, _ in answers[100_000]] == [1, 3, 5, 7, 9, 11, 13, 15, 17, 19]


def test_queries_far_from_all_rows_are_answered_exactly(spark):
    rng = np.random.default_rng(6)
    rows = [(i + 1, list(map(float, v)), 0) for i, v in enumerate(rng.normal(size=(99, 6)))]
    rows += [(1000 * n, [1000.0 * n] * 6, 0) for n in range(1, 5)] + [(2500, [-3e7] * 6, 0)]
    answers, expected = ask(spark, rows), plain_neighbours(rows, by_100)
    for query in (2000, 3000, 4000, 2500):
        assert [i for _, i, _ in answers[query]] == [i for _, _, i in expected[query][0]]


def test_neighbours_of_odd_rows(spark):
    rows = [row for row in ODD_VECTORS if row[1] is None or row[0] != 100]
    rows += [(100, [1.0, 0.5, 0.25, 0.125], 3), (200, [0.5, -0.5, 0.25, 0.75], 3), (200, [0.5, -0.5, 0.25, 0.75], 3)]
    answers, expected = ask(spark, rows), plain_neighbours(rows, by_100)
    assert answers.keys() == expected.keys()
    # Few rows: all the others, the null id last among equals, each repetition a row of its own.
    got = [(i, score) for _, i, score in answers[100]]
    assert [i for i, _ in got] == [None if null else i for _, null, i in expected[100][0]]
    assert len(answers[200]) == 2 * len(expected[200][0])
    assert ask(spark, ODD_VECTORS[:7]) == {}
    assert ask(spark, []) == {}
    assert ask(spark, [(100, [1.0, 2.0], 0)]) == {}


def test_search_for_vectors_that_are_not_indexed(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(40)]
    index = neighbours.build(vectors(spark, rows))
    asked = spark.createDataFrame([(-1, 7, [20.2, 1.0])], "query long, vec_id long, vector array<double>")
    found = index.search(asked, 3).orderBy("rank").collect()
    assert [(row["query_id"], row["vec_id"]) for row in found] == [(7, 20), (7, 21), (7, 19)]


def test_probes_are_all_buckets_above_the_threshold_in_order():
    rng = np.random.default_rng(8)
    hashing = neighbours.Hashing(rng.normal(size=(1, 5, 3)), rng.random((1, 3)), 1.5, 0.8, 0.004)
    for query in rng.normal(size=(20, 5)):
        place = hashing.places(query[None, :], 0)[0]
        own, chances = np.floor(place), {}
        for a in range(-7, 8):
            for b in range(-7, 8):
                for c in range(-7, 8):
                    cell = own + [a, b, c]
                    chances[tuple(cell)] = hashing.chances(place[None, :], cell[None, :]).sum()
        wanted = sorted((c for c in chances if chances[c] >= math.log(0.004)), key=lambda c: -chances[c])
        assert hashing.probes(place, 0).tolist() == hashing.tokens(np.array(wanted), 0).tolist()
