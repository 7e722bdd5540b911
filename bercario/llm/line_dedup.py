"""Repeated passages, by windows of three consecutive lines.

A line ends at a line break, at the end of a sentence (a word with one of ``ENDS`` as its last
character), or after 16 words, so that a long paragraph is many lines. A passage is therefore cut alike
wherever it stands in a paragraph, from its first sentence end on. Three consecutive lines make a
window. Windows that occur more than once in the corpus are found by counting their hashes; every
occurrence but the first, in the order of id and place, covers its three lines, and covered lines are
removed. A removed line always remains at the place where its window occurs first, or where that one's
does.

Lines are compared without white space around them. Both 64-bit hashes of a window must agree. Windows
are computed once and stored; the texts are read once more to be put together.

Defined results: a null text stays null and has no lines; a text of fewer than three lines has
no window and stays as it is. Rows that repeat an id and a text count as one occurrence and are
treated alike; rows that share only an id are different documents. A null id comes first. All
columns are kept, ``text`` is replaced. Names starting with ``ld_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bercario.llm.tables import stored, text_key

LINE_WORDS = 16
# Last characters of a sentence.
ENDS = ".!?。！？"
_SPACE = " \t\n\x0b\f\r"
# Hashes hardly repeat: a dictionary of them is work for nothing.
HASHES_AS_THEY_ARE = {f"parquet.enable.dictionary#{name}": "false" for name in ("ld_a", "ld_b")}
# Words that end no sentence, each with the blanks before the next word of the same line; then one
# more word, with all white space behind it. Nothing is ever given back, so the time is in proportion
# to the text.
_LINE = rf"\s*+(?:\S++(?<![{ENDS}])[^\S\n]++(?=\S)){{0,{LINE_WORDS - 1}}}+\S++\s*+|\s++"


def lines(text: Column) -> Column:
    """The lines of a text; joined again they are the text."""
    return F.regexp_extract_all(text, F.lit(_LINE), F.lit(0))


def _line_hashes(text: Column) -> Column:
    bare = F.transform(lines(text), lambda line: F.btrim(line, F.lit(_SPACE)))
    return F.transform(
        bare, lambda line: F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))
    )


def _windows(hashes: Column) -> Column:
    """Every three consecutive lines, as structs of the hashes of each."""
    many = F.size(hashes) - 2
    three = [F.slice(hashes, step + 1, many).alias(f"line{step}") for step in range(3)]
    return F.when(many > 0, F.arrays_zip(*three))


def repeated_windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Occurrences to be removed: ld_id, ld_text, ld_place (of the window's first line)."""
    places = docs.select(
        F.col(id_col).alias("ld_id"),
        text_key(F.col(text_col)).alias("ld_text"),
        _line_hashes(F.col(text_col)).alias("ld_hashes"),
    )
    # The lines of a window are hashed together after the explosion, in compiled code.
    places = places.select("ld_id", "ld_text", F.posexplode(_windows(F.col("ld_hashes"))).alias("ld_place", "w"))
    places = places.select(
        "ld_id",
        "ld_text",
        "ld_place",
        F.xxhash64("w.line0.a", "w.line1.a", "w.line2.a").alias("ld_a"),
        F.xxhash64("w.line0.b", "w.line1.b", "w.line2.b").alias("ld_b"),
    )
    places = stored(places, "line-dedup-all", **HASHES_AS_THEY_ARE)
    # One hash aggregation with map-side sums: a passage on a third of all rows is one row per
    # task before the shuffle. Stored, so that the join below is between two plain exchanges and
    # Spark can split a frequent window's rows.
    repeated = stored(
        places.groupBy("ld_a", "ld_b")
        .agg(
            F.count(F.lit(1)).alias("ld_n"),
            F.min("ld_id").alias("ld_min"),
            F.count_if(F.col("ld_id").isNull()).alias("ld_null"),
        )
        .filter(F.col("ld_n") > 1)
        .select(
            F.col("ld_a").alias("ld_ra"),
            F.col("ld_b").alias("ld_rb"),
            F.when(F.col("ld_null") == 0, F.col("ld_min")).alias("ld_first"),
        ),
        "line-dedup-windows",
    )
    found = stored(
        places.join(
            repeated,
            (F.col("ld_a") == F.col("ld_ra")) & (F.col("ld_b") == F.col("ld_rb")),
        ).select(
            "ld_id",
            "ld_text",
            "ld_place",
            "ld_a",
            "ld_b",
            F.col("ld_id").eqNullSafe(F.col("ld_first")).alias("ld_in_first"),
        ),
        "line-dedup-places",
    )
    later = found.filter(~F.col("ld_in_first")).select("ld_id", "ld_text", "ld_place")
    # Within the first document, or the documents of that id, only the first place stays. Equal
    # rows share a place and a rank.
    same = W.partitionBy("ld_id", "ld_a", "ld_b").orderBy("ld_text", "ld_place")
    again = found.filter("ld_in_first").withColumn("ld_rank", F.dense_rank().over(same))
    again = again.filter("ld_rank > 1").select("ld_id", "ld_text", "ld_place")
    return later.unionByName(again)


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns, the text without repeated passages, and ld_lines, ld_removed."""
    covered = (
        repeated_windows(docs, id_col, text_col)
        .groupBy("ld_id", "ld_text")
        .agg(F.collect_set("ld_place").alias("ld_places"))
    )
    covered = covered.select(
        "ld_id",
        "ld_text",
        F.array_sort(
            F.array_distinct(
                F.flatten(F.transform("ld_places", lambda p: F.array(p, p + 1, p + 2)))
            )
        ).alias("ld_covered"),
    )
    rows = docs.select(
        "*", F.col(id_col).alias("ld_own_id"), text_key(F.col(text_col)).alias("ld_own_text")
    )
    joined = rows.join(
        covered,
        F.col("ld_own_id").eqNullSafe(F.col("ld_id")) & (F.col("ld_own_text") == F.col("ld_text")),
        "left",
    )
    split = lines(F.col(text_col))
    # Kept lines are what lies between two covered ones.
    edges = F.concat(F.array(F.lit(-1)), F.col("ld_covered"), F.array(F.size("ld_lines")))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(edges) - 2),
        lambda i: F.slice(
            "ld_lines", F.get("ld_edges", i) + 2, F.get("ld_edges", i + 1) - F.get("ld_edges", i) - 1
        ),
    )
    changed = F.col("ld_covered").isNotNull()
    names = [name for name in docs.columns if name != text_col]
    return (
        joined.withColumn("ld_lines", split)
        .withColumn("ld_edges", F.when(changed, edges))
        .select(
            *names,
            F.when(changed, F.array_join(F.flatten(gaps), "")).otherwise(F.col(text_col)).alias(text_col),
            F.when(F.col("ld_lines").isNull(), 0).otherwise(F.size("ld_lines")).alias("ld_line_count"),
            F.when(changed, F.size("ld_covered")).otherwise(0).alias("ld_removed"),
        )
        .select(*docs.columns, F.col("ld_line_count").alias("ld_lines"), "ld_removed")
    )
