"""Leaked credentials: candidates by shape, false ones removed by a random forest.

A candidate is a run of 16 or more characters of keys and tokens (letters, digits, ``+/_-``, and up
to two ``=`` behind them; a name before a sign, as in ``TOKEN=...``, is not part of it) with at least one digit or a change between capital and small letters. The forest scores it on

* length and share of digits, capitals and distinct characters
* transitions: how often the character class changes from one character to the next
* dictionary coverage: share of letters in frequent words or word pieces of prose
* path: whether the path or source is one where credentials are kept
* neighbouring words: whether a credential word stands anywhere in the text shortly before it

It is trained from labelled findings. Where there are none by hand, ``silver_labels`` gives them from
evidence that the forest does not see: published formats of providers, and values assigned to a
credential word in quotes, are true; everything else is false. So the forest cannot learn that rule
again; it learns what secrets look like, and finds those that stand without quotes or sign. As such
secrets count as false in training, scores are divided by the share that has a label, see
``labelled_share``, as is usual for learning from positive and unlabelled rows. The training rows are a bounded sample, ``TRAINING_ROWS`` at most: by
hash within each label, half of the bound for either and what one leaves free for the other, so
that rare secrets are learned from however many candidates there are. A row weighs as many
candidates of its label as it stands for, so a score is a share of all candidates. Every candidate
is scored; those with the evidence of a silver label are secrets whatever the forest says.

All steps are column expressions and Spark's own forest, in time proportional to the texts however
many candidates one has. Offsets count code points.

Defined results: a null or empty text has no candidates, and a row without candidates gives no
row. Rows that repeat an id or have none give their findings all the same. If all candidates have
the same label, every score is that label. Columns besides id, path and text are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bercario.llm.folding import indices, running_sums
from bercario.llm.tables import stored

TRAINING_ROWS = 20_000
TREES = 20
DEPTH = 5
CONTEXT_CHARS = 40

# Shapes that providers publish for their keys.
PROVIDER = (
    r"^(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
    r"|sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{10,})"
)
CREDENTIAL_WORDS = (
    "token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key",
    "auth", "credential", "bearer", "private_key",
)
CREDENTIAL_PATHS = (".env", "config", "secret", "credential", ".pem", ".key", "settings")
# Frequent words and word pieces of prose, of three letters or more.
DICTIONARY = (
    "the", "and", "ing", "ion", "tion", "ent", "ment", "ate", "ter", "ers", "ess", "ness", "able",
    "con", "com", "pro", "pre", "der", "die", "und", "sch", "ein", "ich", "che", "ung", "heit",
    "keit", "lich", "les", "que", "eau", "aux", "eux", "elle", "ier", "oir", "des", "pour", "los",
    "las", "del", "ado", "ando", "cion", "mente", "para", "ver", "ge", "er", "en", "es", "re",
)

_CANDIDATE = r"[A-Za-z0-9+/_-]{16,}+={0,2}+"
_MAY_MATCH = r"[A-Za-z0-9+/_-]{16}"
# A run of letters alone is a word; a digit or a change of case makes it a candidate.
_MIXED = r"[0-9]|[a-z][A-Z]"

FEATURES = [
    "length", "digits", "capitals", "distinct", "transitions", "dictionary", "path_hint", "words_near",
]
# What silver labels are made from, never an input of the forest.
EVIDENCE = ["word_before", "assigned", "quoted", "provider"]


def _share(text: Column, expression: str) -> Column:
    """Share of the characters that the expression matches."""
    rest = F.length(F.regexp_replace(text, expression, ""))
    return (F.length(text) - rest) / F.greatest(F.length(text), F.lit(1))


def candidates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
) -> DataFrame:
    """One row per candidate: doc_id, path, start, end, value, before, after."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), path.alias("path"), F.col(text_col).alias("body")
    ).filter(F.col("body").rlike(_MAY_MATCH))
    found = rows.select(
        "doc_id",
        "path",
        "body",
        F.split("body", _CANDIDATE, -1).alias("between"),
        F.regexp_extract_all("body", F.lit(_CANDIDATE), F.lit(0)).alias("matches"),
    )
    # What lies before a match: the piece before it, and the match before that.
    lengths = F.transform(
        indices(F.col("matches")),
        lambda i: F.length(F.get("between", i)) + F.coalesce(F.length(F.get("matches", i - 1)), F.lit(0)),
    )
    starts = running_sums(lengths)
    pieces = F.arrays_zip(
        F.col("matches").alias("value"),
        starts.alias("start"),
        F.transform("between", lambda x: F.right(x, F.lit(CONTEXT_CHARS))).alias("before"),
        F.slice("between", 2, F.size("matches")).alias("after"),
    )
    return (
        found.select("doc_id", "path", F.explode(pieces).alias("piece"))
        .select("doc_id", "path", "piece.*")
        .filter(F.col("start").isNotNull() & F.col("value").rlike(_MIXED))
        .select(
            "doc_id",
            "path",
            "start",
            (F.col("start") + F.length("value")).alias("end"),
            "value",
            "before",
            F.left("after", F.lit(1)).alias("after"),
        )
    )


def with_features(found: DataFrame) -> DataFrame:
    """The candidates with the columns of ``FEATURES`` and ``EVIDENCE``, all doubles."""
    value = F.col("value")
    classes = F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26)
    classes = F.translate(classes, "abcdefghijklmnopqrstuvwxyz", "a" * 26)
    classes = F.translate(classes, "0123456789", "0" * 10)
    # One character per run of a class.
    runs = F.regexp_replace(classes, r"(.)\1++", "$1")
    paths = "|".join(path.replace(".", r"\.") for path in CREDENTIAL_PATHS)
    columns = {
        "length": F.length(value),
        "digits": _share(value, "[0-9]"),
        "capitals": _share(value, "[A-Z]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "transitions": (F.length(runs) - 1) / F.length(value),
        "dictionary": _share(F.lower(value), "(?:" + "|".join(DICTIONARY) + ")"),
        "path_hint": F.lower("path").rlike(paths),
        "words_near": F.lower("before").rlike("|".join(CREDENTIAL_WORDS)),
        "word_before": F.lower("before").rlike("(?:" + "|".join(CREDENTIAL_WORDS) + r")\W*+$"),
        "assigned": F.col("before").rlike(r"[=:]\s*+[\"'`]?$"),
        "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").isin('"', "'", "`"),
        "provider": value.rlike(PROVIDER),
    }
    return found.withColumns({name: column.cast("double") for name, column in columns.items()})


def silver_labels() -> Column:
    """1.0 for a published format or a quoted value assigned to a credential word, else 0.0."""
    assigned = (F.col("word_before") + F.col("assigned") + F.col("quoted")) == 3
    return ((F.col("provider") == 1) | assigned).cast("double")


def train(labelled: DataFrame, label_col: str, rows: int = TRAINING_ROWS, seed: int = 1):
    """A forest from findings labelled 0.0 or 1.0, or None if they have fewer than two labels."""
    order = F.xxhash64("doc_id", "start", "value")
    findings = labelled.select(*FEATURES, F.col(label_col).alias("label"), order.alias("order"))
    counts = dict(findings.groupBy("label").agg(F.count(F.lit(1))).collect())
    if len(counts) < 2:
        return None
    rarer, other = sorted(counts, key=lambda label: (counts[label], label))
    taken = {rarer: min(counts[rarer], rows // 2)}
    taken[other] = min(counts[other], rows - taken[rarer])
    parts = [
        findings.filter(F.col("label") == label)
        .orderBy("order", *FEATURES)
        .limit(many)
        .withColumn("weight", F.lit(counts[label] / many))
        for label, many in taken.items()
    ]
    sample = parts[0].unionByName(parts[1]).coalesce(1)
    sample = stored(sample.sortWithinPartitions("order", *FEATURES, "label"), "secrets-training")
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt", weightCol="weight"
    )
    return forest.fit(vectors)


def scored(found: DataFrame, model, otherwise: float = 0.0) -> DataFrame:
    """The findings with a score from 0 to 1."""
    if model is None:
        return found.withColumn("score", F.lit(float(otherwise)))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="llm_features").transform(found)
    model = model.setFeaturesCol("llm_features").setProbabilityCol("llm_probability")
    model = model.setPredictionCol("").setRawPredictionCol("")
    result = model.transform(vectors)
    return result.withColumn("score", vector_to_array("llm_probability")[1]).drop(
        "llm_features", "llm_probability"
    )


def labelled_share(found: DataFrame, model) -> float:
    """How many of the secrets have a silver label, or 1.0 if that cannot be told.

    The mean score of labelled candidates: where nothing but secrets looks like them, what it lacks
    to 1 are secrets without evidence. Below one half, too much else looks like them.
    """
    positive = scored(found.filter(F.col("label") == 1), model)
    share = positive.agg(F.avg("score")).first()[0]
    return share if share >= 0.5 else 1.0


def secret_findings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    threshold: float = 0.5,
) -> DataFrame:
    """Each candidate with its score: doc_id, start, end, value, score, is_secret."""
    found = stored(
        with_features(candidates(docs, id_col, text_col, path_col)).withColumn(
            "label", silver_labels()
        ),
        "secrets-candidates",
    )
    # Without a model all labels are the same.
    model = train(found, "label")
    result = scored(found, model)
    if model is not None:
        result = result.withColumn("score", F.least(F.col("score") / labelled_share(found, model), F.lit(1.0)))
    result = result.withColumn("score", F.greatest("score", "label"))
    return result.select(
        "doc_id",
        F.col("start").cast("bigint").alias("start"),
        F.col("end").cast("bigint").alias("end"),
        "value",
        "score",
        (F.col("score") >= threshold).alias("is_secret"),
    )
