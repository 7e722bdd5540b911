"""Radix tries and the audit of filters, against plain versions."""

import re
from collections import defaultdict
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from bercario.llm import filter_audit
from bercario.llm.text_trie import TextTrie, id_order

from .conftest import ODD, prose


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=8), st.none() | st.integers(0, 9)), max_size=40))
def test_trie_holds_the_least_id_of_every_text(pairs):
    trie, plain = TextTrie(), defaultdict(list)
    for row, (text, doc_id) in enumerate(pairs):
        trie.insert(text.encode(), id_order(doc_id), row)
        plain[text].append(row)
    found = [(node.least, node.rows) for node in trie.terminals()]
    expected = [(min(id_order(pairs[row][1]) for row in plain[text]), plain[text]) for text in sorted(plain)]
    assert found == expected


@pytest.mark.parametrize("length", [10, 1_000_000])
def test_trie_of_long_texts(length):
    trie = TextTrie()
    texts = [b"a" * length, b"a" * length + b"b", b"a" * (length - 1), b"a" * (length // 2) + b"c", b""]
    for row, text in enumerate([*texts, *texts]):
        trie.insert(text, id_order(row), row)
    assert sorted(node.rows for node in trie.terminals()) == [[row, row + len(texts)] for row in range(len(texts))]


# The audit ----------------------------------------------------------------------------------


def plain_failures(rows):
    """For each row, the letters of the filters that it fails."""
    least = {}
    for doc_id, text, _ in rows:
        least[text or ""] = min(least.get(text or "", (True, 0)), id_order(doc_id))
    found = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": id_order(doc_id) > least[text],
        }
        found.append("".join(letter for letter, bad in fails.items() if bad))
    return found


def plain_audit(rows, labels):
    failures = plain_failures(rows)
    good = {i for i, quality, _ in labels if quality == 1}
    toxic = {i for i, _, bad in labels if bad == 1}
    found = {}
    for part in {source or "" for _, _, source in rows}:
        own = [(row[0], f) for row, f in zip(rows, failures, strict=True) if (row[2] or "") == part]
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                found[(part, "".join(order), step)] = [
                    len(left),
                    len(removed),
                    sum(letter in f for _, f in own) - len(removed),
                    sum(f == letter for _, f in own),
                    sum(i is not None and i in good for i, _ in removed),
                    sum(i is not None and i in toxic for i, _ in removed),
                ]
                shapley[letter] += len(removed)
        for (of, order, step), counts in found.items():
            if of == part:
                counts.append(shapley[order[step - 1]])
    return found


DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
    # Names that the operator uses inside.
    + [T.StructField(name, T.StringType()) for name in ("part", "mask", "prefix", "text_key", "good", "n", "is_copy")]
)
LABELS = "doc_id long, quality int, toxic int, good string, n string"


def check_audit(spark, rows, labels, weight=filter_audit.RANGE_WEIGHT):
    docs = spark.createDataFrame([(*row, *["other"] * 7) for row in rows], DOCS).repartition(3)
    said = spark.createDataFrame([(*row, "x", "y") for row in labels], LABELS)
    failures = filter_audit.document_failures(docs, weight=weight)
    found = filter_audit.audit(failures, said).collect()
    assert len(found) == len({(r["part"], r["filter_order"], r["step"]) for r in found})
    got = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in filter_audit.COUNTS] for r in found}
    assert got == plain_audit(rows, labels)


SIGNS = ["", " # ", " |", " ABCDEFGH" * 9, " again" * 70]


def mixed_rows():
    rows = [(i, prose(i % 150, 20 + i % 70) + SIGNS[i % 5], ["web", "books", None, ""][i % 4]) for i in range(400)]
    # A third of all rows have one text; others begin alike.
    rows += [(1000 + i, "one very common text " * 20, "web") for i in range(200)]
    rows += [(2000 + i, "x" * 300 + prose(i % 30, 5), "books") for i in range(90)]
    return rows


def test_audit_equals_a_plain_one(spark):
    labels = [(i, i % 2, i % 7 == 0) for i in range(0, 2100, 3)] + [(3, 0, 1), (None, 1, 1), (1003, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    check_audit(spark, mixed_rows(), labels)


def test_audit_with_long_prefixes(spark):
    """So little text per range that prefixes are lengthened several times."""
    check_audit(spark, mixed_rows(), [(i, 1, 0) for i in range(500)], weight=2_000)


def test_ranges_grow_when_there_are_too_many_prefixes(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "PREFIX_BYTES", 200)
    check_audit(spark, mixed_rows(), [], weight=500)


def test_audit_of_odd_rows(spark):
    rows = [(doc_id, text, f"s{at % 3}" if at % 4 else None) for at, (doc_id, text) in enumerate(ODD)]
    check_audit(spark, rows, [(5, 1, 1), (5, 0, 0), (1, 1, None), (None, 1, 1)])
    check_audit(spark, [], [])


def test_no_prefix_holds_too_much_text(spark):
    rows = [(i, "shared beginning of every text " + prose(i, 30)) for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "xxhash64(text) AS text_key")
    levels = filter_audit.long_prefixes(texts, 5_000)
    assert [length for length, _ in levels][:2] == [4, 16] and len(levels) >= 2
    sizes = filter_audit._by_prefix(texts, levels).selectExpr("prefix", "octet_length(text) + 400 AS w")
    assert max(row[1] for row in sizes.groupBy("prefix").sum("w").collect()) <= 5_000
