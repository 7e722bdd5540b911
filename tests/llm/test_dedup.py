"""Exact copies, repeated lines and near duplicates against plain versions."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from bercario.llm import exact_dedup, line_dedup, minhash, tables
from bercario.llm.components import components

from .conftest import ODD, prose


# Exact copies -----------------------------------------------------------------------------


def exact(pairs):
    groups = defaultdict(list)
    for i, text in pairs:
        groups[text or ""].append(i)
    result = []
    for text, ids in groups.items():
        least = lambda i: -1 if i is None else i
        keep = max(ids, key=least)
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = [True] + [False] * (len(ids) - 1)
        for i, stays in zip(sorted(ids, key=least, reverse=True), kept, strict=True):
            result.append((i, keep, len(ids), stays, sha))
    return sorted(result, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_exact_odd_rows(odd):
    assert found(exact_dedup.exact_duplicates(odd)) == exact(ODD)


def test_exact_splits_large_groups(frame):
    pairs = [(i, "same text" if i % 3 else f"text {i % 50}") for i in range(600)]
    assert found(exact_dedup.exact_duplicates(frame(pairs), least_split=7)) == exact(pairs)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_exact_spreads_copies_without_an_id_of_their_own(frame, doc_id):
    pairs = [(doc_id, "same text")] * 300 + [(3, "same text"), (9, "same text")][: 2 if doc_id is None else 1]
    pairs += [(i, f"text {i}") for i in range(100, 150)]
    assert found(exact_dedup.exact_duplicates(frame(pairs).repartition(5), least_split=20)) == exact(pairs)


def test_exact_uses_several_salts_for_one_id(frame, monkeypatch):
    runs = []
    monkeypatch.setattr(exact_dedup, "stored", lambda df, purpose: runs.append(df) or df)
    exact_dedup.exact_duplicates(frame([(None, "same text")] * 400), least_split=20).count()
    per_salt = [row["count"] for row in runs[0].groupBy("salt").count().collect()]
    assert len(per_salt) >= 15 and max(per_salt) < 80


def test_exact_normalised(frame):
    from pyspark.sql import functions as F

    df = frame([(1, "A b"), (2, "a B"), (3, "ab")])
    rows = found(exact_dedup.exact_duplicates(df, normalise=F.lower))
    assert [row[:4] for row in rows] == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


def test_exact_empty(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0


# Repeated lines ---------------------------------------------------------------------------

SPACE = " \t\n\x0b\f\r"


def plain_lines(text):
    """Word by word: a line ends at a line break, after the last word of a sentence, or after 16 words."""
    pieces, words = [], 0
    begin = 0
    for m in re.finditer(rf"[^{SPACE}]+[{SPACE}]*", text):
        words += 1
        word = m[0].rstrip(SPACE)
        if "\n" in m[0] or word[-1] in line_dedup.ENDS or words == 16 or m.end() == len(text):
            pieces.append(text[begin : m.end()])
            begin, words = m.end(), 0
    return pieces if pieces or not text else [text]


def without_lines(pairs):
    """Ids are unique here."""
    seen, result = set(), {}
    for i, text in sorted(pairs):
        pieces = plain_lines(text or "")
        assert "".join(pieces) == (text or "")
        bare = [piece.strip(SPACE) for piece in pieces]
        covered = set()
        for at in range(len(bare) - 2):
            window = tuple(bare[at : at + 3])
            if window in seen:
                covered |= {at, at + 1, at + 2}
            seen.add(window)
        kept = "".join(p for at, p in enumerate(pieces) if at not in covered)
        result[i] = (None if text is None else kept, len(pieces), len(covered))
    return result


def corpus(seed, many=60):
    rng = random.Random(seed)
    pool = [prose(1000 + i, rng.choice([1, 3, 9, 16, 17, 40])) for i in range(40)]
    passage = prose(5, 55)
    texts = []
    for _ in range(many):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        if rng.random() < 0.4:
            lines.insert(rng.randint(0, len(lines)), passage)
        texts.append(rng.choice(["\n", "\n\n", " \n"]).join(lines))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_against_plain_version(frame, seed):
    pairs = corpus(seed) + [(700 + i, sentences(i % 9, 90) + " \t \n" + sentences(i % 4, 30)) for i in range(20)] + [(900, "same line\n" * 500), (901, None), (902, "")]
    df = line_dedup.without_repeated_lines(frame(pairs))
    assert df.columns[: len(frame([]).columns)] == frame([]).columns
    got = {row["doc_id"]: (row["text"], row["ld_lines"], row["ld_removed"]) for row in df.collect()}
    assert got == without_lines(pairs)


def test_passage_of_over_fifty_words_goes_once(frame):
    passage = prose(77, 51)
    pairs = [(i, f"{prose(i, 30)}\n{passage}\n{prose(i + 50, 20)}") for i in range(20)]
    rows = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(frame(pairs)).collect()}
    assert rows[0] == pairs[0][1]
    for i in range(1, 20):
        assert rows[i] == f"{prose(i, 30)}\n{prose(i + 50, 20)}"


def sentences(seed, words):
    """Prose whose sentences have 4 to 14 words."""
    rng = random.Random(seed)
    found = prose(seed, words).split()
    at = rng.randint(0, 13)
    while at < len(found):
        found[at] += rng.choice(".?!")
        at += rng.randint(4, 14)
    return " ".join(found)


def test_passages_at_any_offset_inside_paragraphs(frame):
    """The same 70 words behind a different number of words of one paragraph."""
    passage = sentences(500, 70)
    pairs = [(i, f"{sentences(600 + i, 1 + i)} {passage} {sentences(700 + i, 20)}") for i in range(48)]
    rows = {r["doc_id"]: r["text"] for r in line_dedup.without_repeated_lines(frame(pairs)).collect()}
    assert rows[0] == pairs[0][1]
    assert not any(passage in rows[i] for i in range(1, 48))
    # Of the passage, what stands before its first sentence end and after its last may stay.
    words = passage.split()
    for i in range(1, 48):
        assert sum(word in set(rows[i].split()) for word in words) <= 28
    got = {i: text for i, (text, _, _) in without_lines(pairs).items()}
    assert rows == got


def test_lines_odd_rows(odd):
    rows = line_dedup.without_repeated_lines(odd).collect()
    assert len(rows) == len(ODD)
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(row["text"])
    four = ODD[3][1]
    # The row without id comes first and keeps the lines; equal rows are treated alike.
    assert four in by_id[None] and None in by_id[None]
    assert by_id[4] == [""] and by_id[5] == ["", ""]
    assert by_id[1] == [None] and by_id[2] == [""] and by_id[3] == [" \n\t "]
    assert by_id[6] == [ODD[6][1]] and by_id[7] == [ODD[7][1]]


def test_lines_empty(empty):
    assert line_dedup.without_repeated_lines(empty).count() == 0


# Near duplicates ---------------------------------------------------------------------------


def shingle_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(5)], strict=False))


def near(pairs):
    sets = {i: shingle_set(text) for i, text in pairs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def changed(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in text.split())


def near_corpus():
    rng = random.Random(3)
    texts = []
    for group in range(12):
        base = prose(group, rng.choice([3, 6, 40, 200]))
        texts += [base, base.upper()]
        texts += [changed(base, rng.random(), rng.choice([0.01, 0.03, 0.05])) for _ in range(5)]
    passage = prose(99, 60)
    texts += [passage + " " + prose(200 + i, 60) for i in range(30)]
    # More copies than a long list may have before it is cut into blocks, of all similarities.
    base = prose(500, 120)
    texts += [changed(base, i, 0.002 * (i % 30)) for i in range(150)]
    texts += ["", "  ", "one", "One", "one two"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_against_all_pairs(frame):
    pairs = near_corpus()
    rows = minhash.near_duplicates(frame(pairs)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert len(rows) == len(pairs)
    assert got == near(pairs)


def test_near_in_blocks_alone(frame, monkeypatch):
    monkeypatch.setattr(minhash, "LEADERS", 1)
    monkeypatch.setattr(minhash, "LONG_LIST", 2)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 800)
    monkeypatch.setattr(minhash, "BROADCAST_BYTES", 0)
    pairs = near_corpus()
    rows = minhash.near_duplicates(frame(pairs)).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows}
    assert got == near(pairs)


def test_classes_that_meet_are_decided_by_their_sets(spark):
    import numpy as np

    # Similar sets of few equal coordinates: such pairs are too rare to be found among texts.
    common = np.arange(75, dtype=np.uint64)
    rows = [(1, common, 1), (2, np.append(common, np.arange(100, 125, dtype=np.uint64)), 2), (3, common[:50], 3)]
    rows = [(cid, [seed] * minhash.COORDINATES, bytearray(members.tobytes())) for cid, members, seed in rows]
    sets = spark.createDataFrame(rows, "cid long, signature array<int>, members binary")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3)], "a long, b long")
    assert [tuple(r) for r in minhash.confirmed(pairs, sets).collect()] == [(1, 2)]


def test_unrelated_sets_share_no_list():
    import numpy as np

    size = np.full(4_000, 400)
    value = np.random.default_rng(1).integers(0, 1 << 64, size.sum(), dtype=np.uint64)
    tokens = minhash._signatures(value, size)
    assert len(np.unique(tokens)) == tokens.size
    assert (minhash._signatures(value[:400], size[:1]) == tokens[0]).all()


def test_near_odd_rows(odd):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    got = defaultdict(list)
    for row in rows:
        got[row["doc_id"]].append((row["component_id"], row["kept"]))
    assert got[4] == [(4, True)] and got[5] == [(4, False)] * 2
    assert got[1] == [(1, True)] and got[2] == [(2, True)] and got[3] == [(3, True)]
    assert got[8] == [(8, True)] * 2
    assert sorted(got[None], key=repr) == [(4, False), (None, True), (None, True)]


def test_near_empty(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40) if i != 20] + [(100, 101), (101, 102), (5, 5)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 0 if i <= 20 else 21 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert {row["node"]: row["label"] for row in rows} == expected


def test_components_compute_links_once_into_few_files(spark, monkeypatch):
    from bercario.llm import components as module

    written = []

    def keep(df, purpose, **options):
        kept = tables.stored(df, purpose, **options)
        written.append((purpose, df._jdf.queryExecution().optimizedPlan().toString(), kept.inputFiles()))
        return kept

    monkeypatch.setattr(module, "stored", keep)
    pairs = spark.range(200, numPartitions=40).selectExpr("id * 2 AS a", "id * 2 + 1 AS b")
    links = pairs.unionByName(pairs).mapInArrow(lambda batches: batches, "a long, b long")
    rows = components(links).collect()
    assert {row["node"]: row["label"] for row in rows} == {i: i - i % 2 for i in range(400)}
    plan, files = next((plan, files) for purpose, plan, files in written if purpose == "links")
    assert plan.count("MapInArrow") == 1
    assert len(files) <= 4


def test_keys_measured_as_too_many_are_not_broadcast(frame, monkeypatch):
    plans = []

    def keep(df, purpose, **options):
        kept = tables.stored(df, purpose, **options)
        if purpose == "minhash-sets":
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept

    monkeypatch.setattr(minhash, "stored", keep)
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 1)
    text = prose(7, 40)
    rows = minhash.near_duplicates(frame([(1, text), (2, text + " end"), (3, "another one")])).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 1, 3: 3}
    assert len(plans) == 1 and "Broadcast" not in plans[0] and "SortMergeJoin" in plans[0]
