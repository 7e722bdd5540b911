"""Licences, through a positional index of their rarest words.

Every notice and every whole licence text is a template: its words, and the key phrases that must all
stand in it. The index posts a template under the words of highest IDF of its key phrases, with their
places. IDF is counted over all documents.

A file's words are looked up in the index, the rarest posted word of each template first: each
occurrence gives the places where a template would start, and the postings of its other words must
agree with that start. What is left is verified, key phrase by key phrase. Templates whose rarest words
a file does not have cost it nothing, however many there are. The score of a place is the share of the
template's IDF that stands there.

Words are what is left of ``a-z``, ``0-9`` and everything outside ASCII, after lower-casing A-Z.

Defined results: a null or empty text has no words, no label and score 0. Every row gives one row,
ids repeated, null or not. Columns besides id and text are not read. An empty table gives an empty
result; without documents every word weighs the same.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bercario.llm.licence_texts import BASE_PHRASES, NOTICES, TEXTS
from bercario.llm.words import ALPHANUMERIC, Words, chunks

POSTED = 3

COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string,"
    " labels string, score double"
)


@dataclass
class Template:
    """Words by number; ``key`` are the places of all key phrases, ``posted`` the rarest of them."""

    label: str
    words: list[int]
    key: list[int]
    base: bool
    weight: np.ndarray
    posted: list[int]


def _hash_of(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.cumsum([0, *map(len, words)])
    return Words(data, offsets, ALPHANUMERIC).hash


def plain_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def wordings(notices=NOTICES, phrases=BASE_PHRASES, texts=TEXTS) -> list[tuple[str, list[str], list[str], bool]]:
    """Label, words, key phrases of all templates, and whether a base phrase is all of it."""
    base = [(label, plain_words(text), [text], True) for text, label in phrases.items()]
    short = [(label, plain_words(text), [key], False) for label, text, key in notices]
    return base + short + [(label, plain_words(text), keys, False) for label, text, keys in texts]


def vocabulary(known=None) -> list[str]:
    return sorted({word for _, words, _, _ in known or wordings() for word in words})


def _phrase_places(words: list[str], phrase: str) -> list[int]:
    key = plain_words(phrase)
    first = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    return list(range(first, first + len(key)))


def templates(words: list[str], weights: np.ndarray, known=None) -> list[Template]:
    """The templates with their weights and posted places, rarest first."""
    number = {word: i for i, word in enumerate(words)}
    made = []
    for label, text, keys, base in known or wordings():
        own = [number[word] for word in text]
        key = sorted({place for phrase in keys for place in _phrase_places(text, phrase)})
        rarest = sorted(key, key=lambda place: (-weights[own[place]], place))
        made.append(Template(label, own, key, base, weights[own], rarest[:POSTED]))
    return made


class PositionalIndex:
    """Postings of the rarest words, and the templates as tables."""

    def __init__(self, known: list[Template], words: int):
        def table(rows: list[list], fill) -> np.ndarray:
            made = np.full((len(rows), max(map(len, rows), default=0)), fill)
            for at, row in enumerate(rows):
                made[at, : len(row)] = row
            return made

        self.templates = known
        self.words = table([t.words for t in known], -2)
        self.weights = table([t.weight.tolist() for t in known], 0.0)
        self.total = np.array([t.weight.sum() for t in known])
        # Places that must agree: those of posted words first, then the rest of the key phrases.
        self.must = table([list(dict.fromkeys([*t.posted, *t.key])) for t in known], -1)
        # Postings: by word, the templates whose rarest word it is and where it stands in them.
        rarest = np.array([t.words[t.posted[0]] for t in known], np.int64)
        self.of = np.argsort(rarest, kind="stable")
        self.place = np.array([t.posted[0] for t in known], np.int64)[self.of]
        self.first = np.searchsorted(rarest[self.of], np.arange(words + 1))

    def starts(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From the postings of a text's words: the template, where it would start, by which word."""
        spot = np.flatnonzero(number >= 0)
        low, high = self.first[number[spot]], self.first[number[spot] + 1]
        size = high - low
        which = np.repeat(np.arange(len(spot)), size)
        entry = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        return self.of[entry], spot[which] - self.place[entry], spot[which]

    def found(self, number: np.ndarray, text: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Template, start, text and share of the weight, where all key phrases stand."""
        template, start, by = self.starts(number)
        owner = text.text[by]
        for column in range(1, self.must.shape[1]):
            place = self.must[template, column]
            keep = (place < 0) | self._agree(number, text, template, start, owner, place)
            template, start, owner = template[keep], start[keep], owner[keep]
        share = np.zeros(len(start))
        for place in range(self.words.shape[1] if len(start) else 0):
            places = np.full(len(start), place)
            share += self._agree(number, text, template, start, owner, places) * self.weights[template, place]
        return template, start, owner, np.minimum(share / self.total[template], 1.0)

    def _agree(self, number, text: Words, template, start, owner, place) -> np.ndarray:
        at = start + place
        inside = (at >= 0) & (at < len(number))
        at = np.clip(at, 0, max(len(number) - 1, 0))
        return inside & (text.text[at] == owner) & (number[at] == self.words[template, place])


def idf(docs: DataFrame, words: list[str], text_col: str) -> np.ndarray:
    """Inverse document frequency of each word over all documents."""
    body = docs.select(F.col(text_col).alias("body"))
    hashes = _hash_of([w.encode() for w in words])
    order = np.argsort(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(words), np.int64)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for _, _, data, offsets in chunks(batch, 0):
                text = Words(data, offsets, ALPHANUMERIC)
                number = _numbers(text.hash, hashes[order], order)
                known = np.flatnonzero(number >= 0)
                pairs = np.unique(text.text[known] * len(words) + number[known])
                found += np.bincount(pairs % len(words), minlength=len(words))
        numbers = [*range(len(words)), -1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([*found.tolist(), rows], pa.int64())],
            ["word", "n"],
        )

    # One row per word and task, added up: the driver gets one row per word.
    totals = body.mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {row["word"]: row["n"] for row in totals.collect()}
    return np.array([math.log((1 + n.get(-1, 0)) / (1 + n.get(i, 0))) + 1 for i in range(len(words))])


def _numbers(values: np.ndarray, ordered: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The number of each hash, or -1."""
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, numbers[at], -1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: the id and ``COLUMNS``."""
    words = vocabulary()
    index = PositionalIndex(templates(words, idf(docs, words, text_col)), len(words))
    hashes = _hash_of([w.encode() for w in words])
    order = np.argsort(hashes)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("body"))

    def scan_chunk(data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        text = Words(data, offsets, ALPHANUMERIC)
        count = text.last - text.first
        number = _numbers(text.hash, hashes[order], order)
        base: dict[int, list] = {}
        labels: dict[int, set] = {}
        score: dict[int, float] = {}
        for which, at, of, part in zip(*(x.tolist() for x in index.found(number, text)), strict=True):
            template = index.templates[which]
            labels.setdefault(of, set()).add(template.label)
            score[of] = max(score.get(of, 0.0), part)
            if template.base:
                base.setdefault(of, []).append((at - int(text.first[of]), template.label))
        found = []
        for i in range(text.texts):
            own = base.get(i, [])
            places = [at for at, _ in own]
            found.append((
                int(count[i]), len(own), min(places, default=None), max(places, default=None),
                ",".join(sorted({label for _, label in own})),
                ",".join(sorted(labels.get(i, ()))), score.get(i, 0.0),
            ))
        return found

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["doc_id", *(part.split()[0] for part in COLUMNS.split(", "))]
        for batch in batches:
            found = [x for _, _, data, offsets in chunks(batch, 1) for x in scan_chunk(data, offsets)]
            columns = [pa.array([x[i] for x in found], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, {COLUMNS}")
