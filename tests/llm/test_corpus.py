"""Packing, quality, page extraction and the pipeline."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bercario.llm import html_extract, packing, quality
from bercario.llm.queries import QUERIES, classifier, held_out
from bercario.llm.tables import documents

from .conftest import ODD, prose

# Packing ------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
def test_patterns_use_every_piece_once(counts):
    patterns = packing.shortest_pack_first(counts, 64)
    used = Counter()
    for pattern, times in patterns:
        assert 0 < sum(pattern) <= 64 and times > 0
        for size in pattern:
            used[size] += times
    assert used == Counter(counts)
    places = defaultdict(list)
    for size, first, end, sequence, offset, times in packing.slots(patterns):
        for rank in range(first, end):
            at = offset + (rank - first) // times * size
            places[sequence + (rank - first) % times].append((at, size, rank))
    assert sorted(places) == list(range(sum(times for _, times in patterns)))
    for parts in places.values():
        parts.sort()
        assert [at for at, _, _ in parts] == [0, *np.cumsum([s for _, s, _ in parts])[:-1]]


def test_packing_fills_sequences():
    rng = random.Random(1)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(20_000))
    patterns = packing.shortest_pack_first(counts, 2048)
    assert sum(s * n for s, n in counts.items()) / 2048 / sum(t for _, t in patterns) > 0.98


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_file())


def whole_ids(text):
    return np.array([*tokenizer().encode(text or "", add_special_tokens=False).ids, 1], "<u4")


TOKENS = ["it's", "we'll", "The", "ÀÉ", "<|ENDOFTEXT|>", "!!'s", "İstanbul", "<|endoftext|>", "a<|startoftext|>b", " ", " x", "é", "ß", "ΣΑΣ", "\x1c", "12.5", "日本語", "😀!"]


def test_word_by_word_ids_are_those_of_the_text():
    rng = random.Random(3)
    ids = packing.WordIds(packing.tokenizer_file())
    for plain in (True, False):
        chosen = [token for token in TOKENS if not plain or "<|" not in token]
        texts = [
            "".join(rng.choice(chosen) + rng.choice([" ", "\n", "", "\t", "  "]) for _ in range(12))
            for _ in range(300)
        ]
        data = [text.encode() for text in texts]
        offsets = np.cumsum([0, *map(len, data)])
        found = ids.encode(np.frombuffer(b"".join(data), np.uint8), offsets)
        assert found == [whole_ids(text)[:-1].tobytes() for text in texts]


def encoded(ids, texts):
    data = [text.encode() for text in texts]
    return ids.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


ALONE = ["Привет мир", "日本語", "😀 🎉", "1 2", "the 's", "", "word"]


@pytest.mark.parametrize("text", ["Привет, мир", "日本語のテキスト", "😀😀 🎉", "21", "the's", "2 1 12"])
def test_ids_of_chunks_without_new_pieces(text):
    expected = [whole_ids(text)[:-1].tobytes()]
    fresh = packing.WordIds(packing.tokenizer_file())
    assert encoded(fresh, [text]) == expected
    used = packing.WordIds(packing.tokenizer_file())
    for known in ALONE:
        assert encoded(used, [known]) == [whole_ids(known)[:-1].tobytes()]
    assert encoded(used, [text]) == expected
    assert encoded(used, [text]) == expected


USED = packing.WordIds(packing.tokenizer_file())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30) | st.sampled_from([*ALONE, *TOKENS]), min_size=1, max_size=4))
def test_ids_of_any_texts_one_chunk_after_another(texts):
    texts = [text.encode("utf-8", "ignore").decode() for text in texts]
    assert encoded(USED, texts) == [whole_ids(text)[:-1].tobytes() for text in texts]


def test_words_are_remembered_in_little_memory():
    rng = random.Random(5)
    made = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(150_000)]
    ids = packing.WordIds(packing.tokenizer_file())
    encoded(ids, ["first"])
    tracemalloc.start()
    for at in range(0, len(made), 10_000):
        encoded(ids, [" ".join(made[at : at + 10_000])])
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 100 * len(made)
    for text in (" ".join(made[:300]), " ".join(made[-300:])):
        assert encoded(ids, [text]) == [whole_ids(text)[:-1].tobytes()]


@pytest.mark.parametrize("most", [{"KNOWN_WORDS": 5}, {"KNOWN_IDS": 9}, {"KNOWN_PIECES": 3}])
def test_ids_after_words_are_forgotten(monkeypatch, most):
    for name, value in most.items():
        monkeypatch.setattr(packing, name, value)
    ids = packing.WordIds(packing.tokenizer_file())
    texts = ["the quick brown fox", "the lazy dog", "a fox, a dog", "quick 12 the fox the", "", "brown dog"]
    for text in [*texts, *texts]:
        assert encoded(ids, [text, "the"]) == [whole_ids(x)[:-1].tobytes() for x in (text, "the")]


def test_packing_one_text_without_latin_letters(frame):
    for text in ("Привет мир", "日本語", "😀"):
        check_packing(packing.pack(frame([(1, text)])).collect(), [(1, text)], 2048)


def check_packing(rows, pairs, length):
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= length
    expected = Counter()
    for i, text in pairs:
        ids = whole_ids(text)
        for start in range(0, len(ids), length):
            part = ids[start : start + length]
            expected[(i, start, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert Counter(tuple(row[n] for n in names) for row in rows) == expected


def test_packing(frame, odd):
    check_packing(packing.pack(odd).collect(), ODD, 2048)
    pairs = [(i, prose(i, i % 40)) for i in range(200)] + [(i, "same words again") for i in range(300)]
    check_packing(packing.pack(frame(pairs), length=32).collect(), pairs, 32)


def test_packing_empty(empty):
    assert packing.pack(empty).count() == 0


# Quality ------------------------------------------------------------------------------------


def labelled_texts(many=240):
    rng = random.Random(6)
    pairs, labels = [], []
    for i in range(many):
        text, good = prose(i, rng.randint(5, 120)), i % 4 != 0
        if not good:
            text = rng.choice([text.upper(), text.replace(" ", "### "), text.replace(" ", " | ")])
        pairs.append((i, text))
        labels.append((i, int(good)))
    return pairs, labels


def test_quality_on_held_out_rows(spark, frame):
    pairs, labels = labelled_texts()
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = frame(pairs)
    ensemble = classifier(docs, labels)
    assert 0 < len(ensemble.rules) < 60
    rows = quality.scored(docs, ensemble).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert len(rows) > 50 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in rows) >= 0.95 * len(rows)
    kept = quality.accepted(docs, ensemble)
    assert kept.columns == docs.columns
    scores = quality.scored(docs, ensemble).filter("score >= 0.5")
    assert kept.count() == scores.count()


def test_quality_labels_are_not_read_from_held_out_rows(spark, frame):
    pairs, labels = labelled_texts(120)
    ids = [r[0] for r in frame(pairs).filter(held_out(F.col("doc_id"))).select("doc_id").collect()]
    turned = [(i, 1 - q if i in ids else q) for i, q in labels]
    first, second = (
        classifier(frame(pairs), spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned)
    )
    assert (first.rules, first.weights, first.constant) == (second.rules, second.weights, second.constant)


def test_quality_scores_are_those_of_the_rules_one_by_one(spark, frame):
    pairs, labels = labelled_texts(120)
    pairs += [(900, None), (901, ""), (902, prose(902, 3_000))]
    docs = frame(pairs)
    ensemble = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert ensemble.rules
    expected = {}
    for row in quality.with_statistics(docs.select("doc_id", "text")).collect():
        total = ensemble.constant
        for rule, weight in zip(ensemble.rules, ensemble.weights, strict=True):
            holds = True
            for number, above, threshold in rule:
                value = row[f"llm_{quality.STATISTICS[number]}"]
                holds = holds and (value > threshold if above else value <= threshold)
            total += weight * holds
        expected[row["doc_id"]] = 1 / (1 + math.exp(-total))
    got = {row["doc_id"]: row["score"] for row in quality.scored(docs, ensemble).collect()}
    assert got == pytest.approx(expected, rel=1e-12)


def test_quality_learns_from_a_bounded_sample(spark, frame):
    """Rows that share an id are one; the sample has no more rows than asked for."""
    pairs, labels = labelled_texts()
    pairs += [(0, prose(i, 20)) for i in range(50)]
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    assert quality.training_rows(frame(pairs), table, "doc_id", "text", 30).count() == 30
    assert quality.training_rows(frame(pairs).filter("doc_id = 0"), table, "doc_id", "text", 500).count() == 1
    one, other = (
        [tuple(r) for r in quality.training_rows(frame(pairs).repartition(n), table, "doc_id", "text", 500).collect()]
        for n in (2, 7)
    )
    assert one == other and len(one) == len(labels)


def test_quality_odd_rows(spark, odd, empty):
    for labels, expected in (([], 0.5), ([(4, 1), (6, 1)], 1.0), ([(4, 0)], 0.0)):
        table = spark.createDataFrame(labels, "doc_id long, quality int")
        rows = quality.scored(odd, quality.train(odd, table)).collect()
        assert len(rows) == len(ODD)
        assert all(r["score"] == pytest.approx(expected, abs=1e-6) for r in rows)
    table = spark.createDataFrame([(4, 1), (4, None), (6, 0), (6, 0), (None, 1), (7, 5)], "doc_id long, quality int")
    ensemble = quality.train(odd, table)
    assert quality.scored(odd, ensemble).count() == len(ODD)
    assert quality.scored(empty, ensemble).count() == 0
    assert quality.accepted(empty, ensemble).count() == 0


def test_statistics():
    texts = ["", "AB cd, the\nAB cd, the\nx!", "ü"]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    table = quality._statistics(np.frombuffer(b"".join(data), np.uint8), offsets, quality._stop_hashes())
    row = dict(zip(quality.STATISTICS, table[1], strict=True))
    assert not table[0].any()
    assert row["words"] == 7 and row["lines"] == 3 and row["capitals"] == 4 / 24
    assert row["distinct_words"] == 4 / 7 and row["repeated_lines"] == 10 / 24
    assert row["stop_words"] == 2 / 7 and row["all_capitals"] == 2 / 7 and row["symbol_words"] == 1 / 7


# Pages ---------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="sidebar"><div class="page no-sidebar">
<header>Site name</header><nav><ul><li><a href="/a">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and the rest of it.</div><!-- <p>not this</p> -->
<main><article><h1>A title &amp; more</h1><p>The first of the paragraphs is here,\n with   a <a href="x>y">link</a> in it
and enough words for the rules to decide.<p>Short.<br>Next&nbsp;line<script>var t = "</p>";</script></p>
<div class="ad">Buy this now</div><blockquote>Quoted &lt;b&gt; words &copy; &#233;</blockquote></article>
<section id="comments"><article class="comment"><p>So say we all, and the rest of us too.</p></article><p>The reader says that this is the best of all the articles in the world.</p></section></main>
<aside>Related: <a href="/b">Other</a></aside><form><label>Mail</label><input></form>
<footer>&copy; 2020</footer></div></body></html>"""


def test_page():
    assert html_extract.main_text(PAGE) == "\n\n".join([
        "A title & more",
        "The first of the paragraphs is here, with a link in it and enough words for the rules to decide.",
        "Short. Next line",
        "Quoted <b> words © é",
    ])


def test_page_without_marks():
    long = "This is the text of the page and it is as long as it has to be for the rules. " * 3
    page = (
        f"<div><a href=1>Home</a> <a href=2>News</a></div><div>Heading</div><div>{long}</div><div>Short one</div>"
        "<div><a href=3>More of this</a></div>"
    )
    assert html_extract.main_text(page) == f"Heading\n\n{long.strip()}\n\nShort one"


OTHER_LANGUAGES = [
    "Сегодня мы расскажем о том, почему птицы улетают на юг и возвращаются весной домой. ",
    "今天我们来谈谈为什么候鸟每年秋天都要飞到南方过冬，到了春天又会飞回自己的家乡繁殖后代。",
    "Dzisiaj opowiemy o tym, dlaczego ptaki odlatują jesienią i wracają wiosną do domu. ",
    "Bugün kuşların neden sonbaharda güneye uçtuğunu ve ilkbaharda döndüğünü anlatacağız. ",
]


@pytest.mark.parametrize("sentence", OTHER_LANGUAGES)
def test_pages_in_other_languages(sentence):
    long, short = (sentence * 6).strip(), sentence.strip()
    menu = "<div><a href=1>One</a> <a href=2>Two</a></div>"
    notice = "<div>This is a note of the editor and it is in English for the rest of us.</div>"
    for extra in ("", notice):
        page = f"{menu}<h1>{short[:20]}</h1><div>{long}</div>{menu}<div>{long}!</div>{menu}{extra}"
        text = html_extract.main_text(page)
        assert long in text and f"{long}!" in text and "One" not in text


def test_words_without_stop_words_go_from_an_english_page():
    long = "This is the text of the page and it is as long as it has to be for the rules. " * 6
    keywords = "cheap shoes boots sandals " * 10
    assert html_extract.main_text(f"<div>{long}</div><div>{keywords}</div>") == long.strip()


def test_links_inside_a_marked_article_stay():
    long = "This is the text of the page and it is as long as it has to be for the rules. " * 3
    items = [f"Reference number {i} of the text" for i in range(4)]
    links = "".join(f"<li><a href=/{i}>{item}</a></li>" for i, item in enumerate(items))
    page = (
        f"<div><a href=1>Home</a></div><article><h1><a href=/t>The title</a></h1><p>{long}</p>"
        f"<p>See <a href=/x>the other page</a></p><ul>{links}</ul></article><div><a href=3>More</a></div>"
    )
    expected = ["The title", long.strip(), "See the other page", *items]
    assert html_extract.main_text(page) == "\n\n".join(expected)


PROSE = "This is the text of the page and it is as long as it has to be for the rules. " * 4
BODY = f"<p>{PROSE}</p><p>It is the last of the lines and that is it.</p>"
EXPECTED = f"{PROSE.strip()}\n\nIt is the last of the lines and that is it."
MENU = "<nav><a href=1>Home</a> <a href=2>News</a></nav>"
WRAPPED = [
    '<div style="overflow:hidden">{}</div>',
    '<article style="overflow: hidden">{}</article>',
    '<div title="hidden gem">{}</div>',
    '<div title=\'a "hidden" gem\' data-hidden="false">{}</div>',
    '<div data-id="menu-12">{}</div>',
    '<div data-role="navigation">{}</div>',
    '<div data-note="class=menu hidden">{}</div>',
    '<form action="/x">{}</form>',
    '<form id="aspnetForm"><article>{}</article></form>',
    '<main><form><article>{}</article></form></main>',
    '<div class="job-search">{}</div>',
    '<article id="promo-2024">{}</article>',
    '<article class="social">{}</article>',
    '<article class="comment">{}</article>',
    '<div class="share-price">{}</div>',
    '<div class="widget">{}</div>',
    '<div class="no-sidebar has-menu">{}</div>',
    '<section class="search-results-for-the-term">{}</section>',
    '<article>{}</article>',
    '<main>{}</main>',
]


@pytest.mark.parametrize("wrapping", WRAPPED)
def test_prose_is_never_lost_for_a_name(wrapping):
    page = f"<html><head><title>T</title></head><body>{MENU}{wrapping.format(BODY)}<footer>2020</footer></body></html>"
    assert html_extract.main_text(page) == EXPECTED


@pytest.mark.parametrize("part", [
    '<div class="{}">Some words of a part that is not the article.</div>'.format(name)
    for name in ("ad", "cookie-notice", "site-footer", "share-buttons", "sidebar left", "newsletter-signup", "comment-list")
] + [
    '<p hidden>Some words that are not shown.</p>', '<div style="display: none">Not shown at all here.</div>',
    '<div aria-hidden="true">Not for readers of any kind.</div>', '<div role=banner>Name of the site</div>',
    f'<section class="comments"><p>{PROSE}{PROSE}</p></section>',
    '<form><p>Write to us about this page.</p><label>Mail</label></form>', '<aside>Aside of all</aside>',
])
def test_parts_that_are_not_the_article_go(part):
    for page in (f"<article>{BODY}{part}</article>", f"{part}<article>{BODY}</article>", f"<div>{BODY}</div>{part}"):
        assert html_extract.main_text(page) == EXPECTED


def test_nothing_outside_a_marked_article_stays():
    notice = "<p>This site is going to be closed for the night and it is all we can say to you about it.</p>"
    opinion = f"<div><p>Reader: {PROSE}</p></div>"
    assert html_extract.main_text(f"<div>{notice}</div><article>{BODY}</article>{opinion}") == EXPECTED
    assert html_extract.main_text(f"<div>{notice}</div><main>{BODY}</main>{opinion}") == EXPECTED
    # A mark on a teaser, the body elsewhere.
    assert html_extract.main_text(f"<article><h2>Teaser</h2></article><div>{BODY}</div>") .endswith(EXPECTED)


def test_slips_in_the_markup():
    for slip in ("<nav>", "<aside>", '<div class="ad">', "<header>", "<form>"):
        assert html_extract.main_text(f"<body>{slip}<article>{BODY}</article></body>") == EXPECTED
        assert PROSE.strip() in html_extract.main_text(f"<body>{slip}<a href=1>Home</a><div>{BODY}</div></body>")
    assert html_extract.main_text(f"<html><head><title>T</title><body><article>{BODY}</article>") == EXPECTED
    assert html_extract.main_text(f"<html><head><title>T</title><meta name=x><article>{BODY}</article>") == EXPECTED


def test_inline_parts_and_formulas_and_headings():
    page = "<article><header><h1>The title</h1></header><p>Before <button>Copy</button>the <span hidden>x</span><math><mi>a</mi></math> end.</p></article>"
    assert html_extract.main_text(page) == "The title\n\nBefore the a end."
    form = f"<article>{BODY}<form><p>Subscribe to the best of the letters.</p></form></article>"
    assert html_extract.main_text(form) == EXPECTED


def plain_attributes(rest):
    """Read sign by sign."""
    found, at = {}, 0
    while at < len(rest):
        if rest[at].isspace() or rest[at] in "/=":
            at += 1
            continue
        name = value = ""
        while at < len(rest) and not rest[at].isspace() and rest[at] not in "/=":
            name, at = name + rest[at], at + 1
        ahead = at
        while ahead < len(rest) and rest[ahead].isspace():
            ahead += 1
        if ahead < len(rest) and rest[ahead] == "=":
            at = ahead + 1
            while at < len(rest) and rest[at].isspace():
                at += 1
            if at < len(rest) and rest[at] in "\"'":
                end = rest.find(rest[at], at + 1)
                end = len(rest) if end < 0 else end
                value, at = rest[at + 1 : end], end + 1
            else:
                while at < len(rest) and not rest[at].isspace():
                    value, at = value + rest[at], at + 1
        found.setdefault(name.lower(), value)
    return found


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "class", "hidden", "=", '"', "'", " ", "/", "id", "x y", "-"]), max_size=14).map("".join))
def test_attributes_are_read_from_the_front(rest):
    assert html_extract.attributes(rest) == plain_attributes(rest)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>x", "a < b", "<p title=\"", "</p></div>"])
def test_broken_pages(page):
    text = html_extract.main_text(page)
    assert text in ("", "<", "<p", "a < b", "<p title=\"")


def test_long_broken_pages_take_time_in_proportion():
    for piece in ("<p title=\"x ", "<", "<a ", "<!", "<div>", "&", "<p class='", "<b></i>"):
        html_extract.main_text(piece * 20_000)


def test_pages_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    got = [tuple(r) for r in html_extract.extract(pages).collect()]
    text = html_extract.main_text(PAGE)
    assert sorted(got, key=repr) == sorted(
        [(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=repr
    )
    assert html_extract.extract(pages.limit(0)).count() == 0


# Pipeline -------------------------------------------------------------------------------------


def plain_pipeline(spark, docs, folder):
    """The five stages by the plain versions; the classifier's verdicts are its own."""
    from .test_dedup import near, without_lines
    from .test_scans import contamination

    ensemble = classifier(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    accepted = {r["doc_id"] for r in quality.scored(docs, ensemble).filter("score >= 0.5").collect()}
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in accepted]
    cut = without_lines(pairs).items()
    pairs = [(i, text) for i, (text, _, removed) in cut if not removed or text.strip(" \t\n\x0b\f\r")]
    kept = {i for i, (_, _, stays) in near(pairs).items() if stays}
    pairs = [(i, text) for i, text in pairs if i in kept]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {row[0] for row in contamination(pairs, items) if not row[5]}
    return [(i, text) for i, text in pairs if i in clean]


def test_pipeline(spark, folder):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, folder).collect()
    pairs = plain_pipeline(spark, documents(spark, folder), folder)
    assert 0 < len(pairs) < documents(spark, folder).count()
    check_packing(rows, pairs, 2048)
    # The end id alone is a blank document.
    blank = {i for i, text in pairs if not (text or "").strip()}
    assert {row["doc_id"] for row in rows if row["doc_tokens"] == 1} == blank == set()


def test_copies_leave_as_rows(spark, frame, folder):
    """Exact copies line by line, near copies as documents; what was blank before is left alone."""
    import corpus_pipeline

    lines = "\n".join(prose(800 + i, 30) for i in range(6))
    loose = prose(900, 120)
    pairs = [(1, lines), (2, lines), (3, f" {lines}\n"), (4, loose), (5, changed_words(loose)), (6, prose(901, 40))]
    pairs += [(7, ""), (8, None), (9, " \n ")]
    docs = corpus_pipeline.remove_repeated_lines(spark, frame(pairs), folder)
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 4, 5, 6, 7, 8, 9]
    docs = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 4, 6, 7, 8, 9]


def changed_words(text):
    """In so many places that no three lines are left as they were."""
    return " ".join("changed" if place in (30, 60, 90) else word for place, word in enumerate(text.split()))


def test_stages_keep_columns_and_odd_rows(spark, odd, folder):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, odd, folder)
        assert name == "packing" or result.columns == odd.columns
        rows = result.collect()
        if name == "near_dedup":
            ids = Counter(r["doc_id"] for r in rows)
            assert ids[5] == 0 and ids[4] == 1 and ids[8] == 2


def test_one_of_near_copies_with_repeated_or_null_ids(spark, frame, folder):
    import corpus_pipeline

    base, other, last = prose(70, 80), prose(71, 80), prose(72, 80)
    pairs = [(1, base), (1, base + " end"), (1, base + " the end"), (2, base + " more"), (1, last)]
    pairs += [(None, other), (None, other + " end"), (None, other + " end"), (None, prose(73, 80))]
    pairs += [(None, last + " end"), (None, ""), (None, " "), (3, ""), (3, "")]
    rows = corpus_pipeline.drop_near_duplicates(spark, frame(pairs), folder).collect()
    got = Counter((r["doc_id"], r["text"][:40]) for r in rows)
    expected = [(1, base), (None, other), (1, last), (None, prose(73, 80)), (None, ""), (None, " "), (3, "")]
    assert got == Counter((i, text[:40]) for i, text in expected)


def test_stages_of_an_empty_table(spark, empty, folder):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_queries_read_whole_tables(spark, folder):
    many = documents(spark, folder).count()
    for name in ("op3_exact_dedup", "op4_license_scan", "op5_line_dedup", "op6_pii"):
        assert QUERIES[name](spark, folder).count() == many


def test_no_python_on_the_native_paths(spark, folder):
    for name in ("op3_exact_dedup", "op5_line_dedup", "op6_pii", "op10_secrets"):
        plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
