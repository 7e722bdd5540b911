"""The operators as queries over the given tables, and the SQL that some of them must equal.

A query is a function of a session and a folder with the tables. It applies its operator, with the
operator's own parameters, to every row of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bercario.llm import (
    decontaminate,
    exact_dedup,
    filter_audit,
    html_extract,
    license_scan,
    line_dedup,
    minhash,
    neighbours,
    packing,
    pii,
    quality,
    secrets,
    vector_codes,
)
from bercario.llm.tables import documents


def held_out(doc_id) -> Column:
    """A third of the documents, whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def classifier(docs: DataFrame, labels: DataFrame) -> quality.RuleEnsemble:
    learned = labels.filter(~held_out(F.col("doc_id"))).select("doc_id", "quality")
    return quality.train(docs, learned)


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(documents(spark, folder))


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder)).drop("text_key", "component")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(documents(spark, folder))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select(
        "doc_id",
        F.col("ld_lines").cast("bigint").alias("n_lines"),
        F.col("ld_removed").cast("bigint").alias("n_removed"),
        "text",
    )


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.personal_data(documents(spark, folder)))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.digest(decontaminate.benchmark_hits(documents(spark, folder), benchmark))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    ensemble = classifier(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return quality.scored(docs, ensemble).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_findings(documents(spark, folder))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return vector_codes.digest(*vector_codes.compress(vectors))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    failures = filter_audit.document_failures(documents(spark, folder))
    return filter_audit.audit(failures, spark.read.parquet(f"{folder}/labels.parquet"))


def op13_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Every row whose id is divisible by 100, against all other rows."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


QUERIES = {
    query.__name__: query
    for query in (
        op1_packing,
        op2_minhash_dedup,
        op3_exact_dedup,
        op4_license_scan,
        op5_line_dedup,
        op6_pii,
        op7_decontamination,
        op8_quality,
        op9_html_extraction,
        op10_secrets,
        op11_vector_codes,
        op12_filter_audit,
        op13_neighbours,
    )
}

ORACLE: dict[str, str] = {}

ORACLE["op3_exact_dedup"] = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_SPACE = r" \t\n\x0B\f\r"
_LINE = rf"[{_SPACE}]*(?:[^{_SPACE}]*[^{_SPACE}.!?。！？][ \t\x0B\f\r]+){{0,15}}[^{_SPACE}]+[{_SPACE}]*|[{_SPACE}]+"

ORACLE["op5_line_dedup"] = f"""
    WITH split AS (
        SELECT doc_id, text, regexp_extract_all(text, '{_LINE}') AS pieces FROM documents
    ), line AS (
        SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place FROM split
    ), trimmed AS (
        SELECT *, trim(piece, E' \\t\\n\\x0B\\f\\r') AS bare FROM line
    ), windows AS (
        SELECT doc_id, place, bare AS a, lead(bare) OVER d AS b, lead(bare, 2) OVER d AS c
        FROM trimmed WINDOW d AS (PARTITION BY doc_id ORDER BY place)
    ), numbered AS (
        SELECT doc_id, place,
               row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, place) AS occurrence
        FROM windows WHERE c IS NOT NULL
    ), covered AS (
        SELECT DISTINCT doc_id, place + step AS place
        FROM numbered, (VALUES (0), (1), (2)) AS steps(step) WHERE occurrence > 1
    ), kept AS (
        SELECT line.doc_id, string_agg(piece, '' ORDER BY line.place) AS text
        FROM line ANTI JOIN covered USING (doc_id, place) GROUP BY line.doc_id
    ), removed AS (
        SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id
    )
    SELECT doc_id, len(pieces) AS n_lines, coalesce(removed.n, 0) AS n_removed,
           CASE WHEN split.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
    FROM split LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

ORACLE["op7_decontamination"] = r"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
    ), item_windows AS (
        SELECT DISTINCT item_id, least(13, len(w)) AS size,
               unnest([w[i : i + least(13, len(w)) - 1]
                       for i in range(1, len(w) - least(13, len(w)) + 2)]) AS piece
        FROM items WHERE len(w) > 0
    ), sizes AS (SELECT DISTINCT size FROM item_windows), spots AS (
        SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS start, w
        FROM words, sizes WHERE len(w) >= size
    ), hits AS (
        SELECT DISTINCT doc_id, start, spots.size, item_id
        FROM spots JOIN item_windows
          ON spots.size = item_windows.size AND w[start : start + spots.size - 1] = piece
    ), places AS (
        SELECT DISTINCT doc_id, unnest(range(start, start + size)) AS place FROM hits
    ), hit AS (SELECT doc_id, count(*) AS n FROM places GROUP BY doc_id),
    found AS (
        SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(hit.n, 0) AS n_hit,
           coalesce(found.n, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
           coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= coalesce(len(w), 0) AS contaminated
    FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLE["op2_minhash_dedup"] = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS w FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, unnest(
            CASE WHEN len(w) >= 5 THEN [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
        FROM words
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    met AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
    ), links AS (
        SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * met.n >= 75 * (x.n + y.n - met.n)
    ), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(doc_id, node) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.node
    ), least AS (SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM least LEFT JOIN sizes USING (doc_id)
"""


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Each round: every part with every entry, the least distance, then the means."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
    met{n} AS MATERIALIZED (
        SELECT id, part, min(distance * 256 + entry) AS best
        FROM (
            SELECT id, long.part, entry, sum((x - c) * (x - c)) AS distance
            FROM long JOIN book{n} USING (part, place) GROUP BY id, long.part, entry
        ) GROUP BY id, part
    )""")
        if n < rounds:
            steps.append(f"""
    book{n + 1} AS MATERIALIZED (
        SELECT part, entry, place, coalesce(((s - ((s % n) + n) % n) // n)::BIGINT, c) AS c
        FROM book{n} LEFT JOIN (
            SELECT part, (best % 256)::BIGINT AS entry, place, sum(x) AS s, count(*) AS n
            FROM met{n} JOIN long USING (id, part) GROUP BY ALL
        ) USING (part, entry, place)
    )""")
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS id, vec_id, label,
               [floor({scale} * x::DOUBLE)::BIGINT for x in embedding] AS v
        FROM embeddings
        WHERE len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)
    ), long AS MATERIALIZED (
        SELECT id, spot // size AS part, spot % size AS place, x FROM (
            SELECT id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS spot, len(v) // {parts} AS size
            FROM kept
        )
    ), book0 AS MATERIALIZED (
        SELECT part, id - 1 AS entry, place, x AS c FROM long WHERE id <= {entries}
    ), {",".join(steps)},
    coded AS (
        SELECT id, string_agg(printf('%02x', (best % 256)::INTEGER), '' ORDER BY part) AS code,
               sum(best // 256)::BIGINT AS error
        FROM met{rounds} GROUP BY id
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds})
               AS codebooks_sha256
    FROM kept JOIN coded USING (id)
    """


ORACLE["op11_vector_codes"] = _vector_codes_sql()

_STEPS = ", ".join(str(step) for step in filter_audit.steps_of_all_orders())

ORACLE["op12_filter_audit"] = rf"""
    WITH steps(filter_order, step, before, own) AS (VALUES {_STEPS}),
    counted AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), masked AS (
        SELECT doc_id, part,
               (len(w) < 50)::INTEGER
               + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INTEGER
               + 4 * (100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')))
                      > 5 * length(body))::INTEGER
               + 8 * regexp_matches(body, '[#$%&*|]')::INTEGER
               + 16 * (min(doc_id) OVER (PARTITION BY body) < doc_id)::INTEGER AS mask
        FROM counted
    ), said AS (
        SELECT doc_id, bool_or(coalesce(quality, 0) = 1) AS good, bool_or(coalesce(toxic, 0) = 1) AS toxic
        FROM labels GROUP BY doc_id
    ), masks AS (
        SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good,
               count(*) FILTER (WHERE toxic) AS toxic
        FROM masked LEFT JOIN said USING (doc_id) GROUP BY part, mask
    ), results AS (
        SELECT part, filter_order, step, own,
               sum(n) FILTER (WHERE mask & (before | own) = 0) AS kept,
               sum(n) FILTER (WHERE mask & own <> 0 AND mask & before = 0) AS removed,
               sum(n) FILTER (WHERE mask & own <> 0 AND mask & before <> 0) AS redundant,
               sum(n) FILTER (WHERE mask = own) AS unique_fails,
               sum(good) FILTER (WHERE mask & own <> 0 AND mask & before = 0) AS good_lost,
               sum(toxic) FILTER (WHERE mask & own <> 0 AND mask & before = 0) AS toxic_lost
        FROM masks, steps GROUP BY part, filter_order, step, own
    )
    SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
           coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
           coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
           coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley
    FROM results
"""
