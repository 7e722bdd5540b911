"""Quality of documents, by a sparse ensemble of rules.

Statistics of the text feed a small forest; every path from a root to a node becomes a rule, a
conjunction of bounds on statistics; a logistic regression with an L1 penalty weighs the rules and
drops most. What remains is compiled to one column expression, so scoring is part of the query plan.

The classifier is fitted on a bounded sample of labelled rows, ``TRAINING_ROWS`` at most, those of
smallest hash; everything else covers all rows.

Defined results: a null or empty text has statistics of zero and is scored like any text. Every
row gives one row, ids repeated, null or not. If the training rows have one label only, every score is
that label; without any, 0.5. Labels other than 0 and 1 and repeated labels of an id: null
ones are left out, of several the largest counts. Columns besides id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bercario.llm.html_extract import STOP_WORDS
from bercario.llm.tables import stored
from bercario.llm.words import NOT_SPACE, Words, chunks, sums_by_text

TRAINING_ROWS = 20_000
TRAINING_PARTS = 8
TREES = 24
DEPTH = 3
PENALTY = 0.002

STATISTICS = [
    "chars", "words", "word_length", "capitals", "digits", "stops", "symbols", "bars", "blanks",
    "lines", "line_words", "stop_words", "distinct_words", "repeated_lines", "all_capitals",
    "symbol_words", "long_words", "one_letter_words",
]


def _flags(text: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(text.encode())] = True
    return flags


_CAPITAL = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_SMALL = _flags("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
_DIGIT = _flags("0123456789")
_STOP = _flags(".,;:")
_BAR = _flags("|")
_SYMBOL = _flags("!#$%&*+<=>@[]^_`{}~/\\")
_BLANK = _flags(" \t")


def _stop_hashes() -> np.ndarray:
    words = [word.encode() for word in sorted(STOP_WORDS)]
    data = np.frombuffer(b" ".join(words), np.uint8)
    return np.sort(Words(data, np.array([0, len(data)]), NOT_SPACE).hash)


def _statistics(data: np.ndarray, offsets: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` per text."""
    begin, end = offsets[:-1], offsets[1:]
    text = Words(data, offsets, NOT_SPACE)
    of_text = lambda flags: sums_by_text(flags[data], begin, end)
    of_words = lambda values: sums_by_text(values, text.first, text.last)
    size = end - begin
    words = text.last - text.first
    chars, many = np.maximum(size, 1), np.maximum(words, 1)
    total = lambda flags: np.concatenate([[0], np.cumsum(flags[data], dtype=np.int64)])
    in_word = lambda flags: (lambda t: t[text.end] - t[text.start])(total(flags))
    capital, small = in_word(_CAPITAL), in_word(_SMALL)
    length = text.end - text.start
    symbol = in_word(_SYMBOL)
    stop = stops[np.minimum(np.searchsorted(stops, text.hash), len(stops) - 1)] == text.hash
    new = ~_seen_before(text)
    # Lines, as words between line breaks.
    is_line = np.ones(256, bool)
    is_line[10] = False
    line = Words(data, offsets, is_line)
    lines = line.last - line.first
    repeated = np.where(_seen_before(line), line.end - line.start, 0)
    columns = [
        size,
        words,
        of_words(length) / many,
        of_text(_CAPITAL) / chars,
        of_text(_DIGIT) / chars,
        of_text(_STOP) / chars,
        of_text(_SYMBOL) / chars,
        of_text(_BAR) / chars,
        of_text(_BLANK) / chars,
        lines,
        words / np.maximum(lines, 1),
        of_words(stop) / many,
        of_words(new) / many,
        sums_by_text(repeated, line.first, line.last) / chars,
        of_words((capital > 1) & (small == 0)) / many,
        of_words(symbol > 0) / many,
        of_words(length > 15) / many,
        of_words(length == 1) / many,
    ]
    return np.column_stack([np.asarray(column, np.float64) for column in columns])


def _seen_before(words: Words) -> np.ndarray:
    """Whether the text has the same word further to the front."""
    order = np.lexsort((words.hash, words.text))
    hashes, texts = words.hash[order], words.text[order]
    result = np.zeros(words.count, bool)
    result[order[1:]] = (hashes[1:] == hashes[:-1]) & (texts[1:] == texts[:-1])
    return result


def with_statistics(docs: DataFrame, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """All columns, the text last or left out, and ``STATISTICS``.

    Names starting with ``llm_`` are reserved.
    """
    others = [name for name in docs.columns if name != text_col]
    rows = docs.select(*others, text_col)
    kept = [*others, text_col] if keep_text else others
    schema = StructType(list(docs.select(*kept).schema))
    for name in STATISTICS:
        schema = schema.add(f"llm_{name}", "double")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stops = _stop_hashes()
        for batch in batches:
            at = len(others)
            found = [_statistics(data, offsets, stops) for _, _, data, offsets in chunks(batch, at)]
            values = np.concatenate(found) if found else np.zeros((0, len(STATISTICS)))
            columns = [pa.array(values[:, i]) for i in range(len(STATISTICS))]
            names = [*kept, *(f"llm_{name}" for name in STATISTICS)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], names)

    return rows.mapInArrow(work, schema)


# A rule: bounds of statistics, (statistic, whether above, threshold).
Rule = tuple[tuple[int, bool, float], ...]
_BRANCH = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)$")


def rules_of(description: str) -> list[Rule]:
    """Every path of a forest, as Spark describes it: each branch ends one."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[int, bool, float]]] = []
    for line in description.splitlines():
        branch = _BRANCH.match(line)
        if not branch:
            if "Tree" in line:
                path = []
            continue
        depth = len(branch[1])
        path = [x for x in path if x[0] < depth]
        path.append((depth, (int(branch[3]), branch[4] == ">", float(branch[5]))))
        rules[tuple(sorted({bound for _, bound in path}))] = None
    return list(rules)


def rule_column(rule: Rule) -> Column:
    """1.0 where all bounds hold, else 0.0."""
    condition = F.lit(True)
    for number, above, threshold in rule:
        value = F.col(f"llm_{STATISTICS[number]}")
        condition = condition & (value > threshold if above else value <= threshold)
    return condition.cast("double")


class RuleEnsemble:
    """Weighted rules; ``score`` is a column expression over the statistics."""

    def __init__(self, rules: list[Rule], weights: list[float], constant: float):
        self.rules, self.weights, self.constant = rules, weights, constant

    def score(self) -> Column:
        total = F.lit(float(self.constant))
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + rule_column(rule) * weight
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, label_col: str) -> RuleEnsemble:
    """An ensemble from rows of statistics with a label of 0 or 1."""
    counts = {row[0]: row[1] for row in labelled.groupBy(label_col).count().collect()}
    counts.pop(None, None)
    if len(counts) < 2:
        return RuleEnsemble([], [], {(): 0.0, (0,): -20.0, (1,): 20.0}[tuple(counts)])
    statistics = [f"llm_{name}" for name in STATISTICS]
    label = F.col(label_col).cast("double").alias("label")
    # Labels are unequally frequent; each gets half of the weight while the trees are grown.
    total = sum(counts.values())
    weight = F.when(F.col(label_col) == 1, total / counts[1]).otherwise(total / counts[0])
    rows = VectorAssembler(inputCols=statistics, outputCol="features").transform(
        labelled.select(*statistics, label, weight.alias("weight"))
    )
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=7, weightCol="weight", featureSubsetStrategy="0.4"
    )
    rules = rules_of(forest.fit(rows).toDebugString)
    as_rules = labelled.select(
        label, *[rule_column(rule).alias(f"r{i}") for i, rule in enumerate(rules)]
    )
    names = [f"r{i}" for i in range(len(rules))]
    as_rules = VectorAssembler(inputCols=names, outputCol="features").transform(as_rules)
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False
    )
    model = lasso.fit(as_rules.select("label", "features"))
    kept = [(rule, float(w)) for rule, w in zip(rules, model.coefficients, strict=True) if w]
    return RuleEnsemble([r for r, _ in kept], [w for _, w in kept], float(model.intercept))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int) -> DataFrame:
    """Statistics and label of the sampled rows; ``labels`` has the id and a quality of 0 or 1."""
    sample = (
        labels.select(F.col(id_col).alias("llm_id"), F.col("quality").alias("llm_label"))
        .filter(F.col("llm_label").isin(0, 1) & F.col("llm_id").isNotNull())
        .groupBy("llm_id")
        .agg(F.max("llm_label").alias("llm_label"))
        .orderBy(F.xxhash64("llm_id"), "llm_id")
        .limit(rows)
    )
    # Bounded by ``rows``, so it may be sent to all tasks.
    texts = docs.select(F.col(id_col).alias("llm_own"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(sample), F.col("llm_own") == F.col("llm_id"))
    found = with_statistics(found.select("llm_id", "llm_label", F.xxhash64("text").alias("llm_hash"), "text"))
    # Of rows that share an id, the one of least text hash: partial sums keep one per task.
    names = [name for name in found.columns if name not in ("llm_id", "llm_hash", "text")]
    one = found.groupBy("llm_id").agg(F.min(F.struct("llm_hash", *names)).alias("llm_row"))
    # In the same order whatever the number of partitions: trees are grown from samples by place.
    one = one.repartition(TRAINING_PARTS, "llm_id").sortWithinPartitions("llm_id")
    return stored(one.select(*[F.col(f"llm_row.{name}").alias(name) for name in names]), "quality-training")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows: int = TRAINING_ROWS,
) -> RuleEnsemble:
    return fit(training_rows(docs, labels, id_col, text_col, rows), "llm_label")


def scored(
    docs: DataFrame, ensemble: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: doc_id and score, higher for label 1."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return with_statistics(rows).select("doc_id", ensemble.score().alias("score"))


def accepted(
    docs: DataFrame, ensemble: RuleEnsemble, text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """The rows that score at least ``threshold``, with all their columns."""
    marked = with_statistics(docs, text_col, keep_text=True)
    return marked.filter(ensemble.score() >= threshold).select(*docs.columns)
