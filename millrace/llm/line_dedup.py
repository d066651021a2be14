"""Line dedup: repeated runs of lines, found by prefix doubling over the sequence of lines.

The corpus is the sequence of all lines, document after document in the order of doc_id (null
first; documents that share an id by the hash of their text). Blank lines are no part of it and
are never removed. Suffixes are classed by their first 1, 2, 4, ... lines: the class of the first
2h lines is the pair of the classes, of h lines each, of the suffix and of the one h lines on. A
class is an interval of the suffix array in which the longest common prefix is at least that
long; a suffix that is alone in its class shares no longer prefix either and drops out, so each
round holds repeated lines only.

A run counts when it has ``MIN_CHARS`` characters. Every repeated run that counts is made up of
the least runs that count, one from each of its lines on or back, and a run of any length is one
interval as the pair of the classes of its first and its last 2^k lines. In each interval the
first copy stays; the lines of later copies are deleted, also where copies overlap. The first
copy of every line of the corpus is kept.

Rows that agree in doc_id and text are one document and get the same result. Null and empty texts
stay as they are. A line is never cut. Lines and classes are known by 128-bit hashes, whose equality
by chance (which would delete text) is not to be expected at any size. A very long text costs time
in proportion to its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import KEY, keyed, map_rows, table
from millrace.session import store

MIN_CHARS = 60
LINES = "_id long, _hash long, at int, line int, code binary, ahead int, back int"
BLANKS = " \t\n\r\x0b\x0c"


def _codes(columns: list[list]) -> list:
    """The lines that are not blank, each with the least run from it on and back that counts, in
    lines; 0 where the text ends before."""
    import xxhash

    out: list[list] = [[] for _ in range(7)]
    for id_, hash_, text, least in zip(*columns):
        kept = [(n, line) for n, line in enumerate(text.split("\n")) if line.strip(BLANKS)]
        size = [len(line) for _, line in kept]
        ahead, back = [0] * len(kept), [0] * len(kept)
        start = total = 0
        for end in range(len(kept)):
            total += size[end]
            while total - size[start] >= least:
                total -= size[start]
                ahead[start] = ahead[start] or end - start + 1
                start += 1
            if total >= least:
                back[end] = end - start + 1
                ahead[start] = ahead[start] or end - start + 1
        for at, (n, line) in enumerate(kept):
            code = xxhash.xxh3_128_digest(line)
            for column, value in zip(out, (id_, hash_, at, n, code, ahead[at], back[at])):
                column.append(value)
    return out


def repeated_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """_id, _hash, line (number from 0): the lines of later copies."""
    lines = map_rows(
        keyed(docs).select(*KEY, F.coalesce("text", F.lit("")).alias("text"), F.lit(min_chars).alias("least")),
        LINES,
        _codes,
    )
    # Rows of one document stored several times agree in all columns; as keys alone, without values
    # to keep beside them, they are dropped by hash and not by sorting.
    lines = store(lines.distinct(), "lines")
    # Longest least run of all lines: how far doubling has to go.
    longest = lines.agg(F.greatest(F.max("ahead"), F.max("back"))).first()[0] or 0
    runs = (
        lines.where("ahead > 0")
        .select(*KEY, "at", F.col("ahead").alias("size"))
        .unionAll(lines.where("back > 0").select(*KEY, (F.col("at") - F.col("back") + 1).alias("at"), F.col("back").alias("size")))
    )
    classes = repeated(lines.select(*KEY, "at", F.col("code").alias("class")))
    out, length = None, 1
    while length <= longest:
        classes = store(classes, f"classes{length}")
        part = runs.where((F.col("size") >= length) & (F.col("size") < 2 * length))
        later = later_copies(part, classes, length)
        out = later if out is None else out.unionAll(later)
        ahead = classes.select(*KEY, (F.col("at") - length).alias("at"), F.col("class").alias("_next"))
        classes = repeated(
            classes.join(ahead, [*KEY, "at"]).select(*KEY, "at", _named("class", "_next").alias("class"))
        )
        length *= 2
    if out is None:
        return lines.limit(0).select(*KEY, "line")
    covered = out.select(*KEY, F.explode(F.sequence("at", F.col("at") + F.col("size") - 1)).alias("at")).distinct()
    return lines.select(*KEY, "at", "line").join(covered, [*KEY, "at"]).select(*KEY, "line")


def _named(*parts) -> Column:
    """128 bits for the parts, as equal names delete text: at 64 bits some would be equal by chance
    in a large corpus."""
    return F.unhex(F.md5(F.concat(*parts)))


def _without(text: str | None, gone: list[int] | None) -> str | None:
    """The text without the lines of these numbers, in one pass."""
    if gone is None:
        return None
    gone = set(gone)
    return "\n".join([line for n, line in enumerate(text.split("\n")) if n not in gone])


def repeated(classes: DataFrame) -> DataFrame:
    """Without the suffixes that are alone in their class.

    The classes are stored, since a join splits a hot one only if neither side is an aggregate."""
    shared = store(classes.groupBy("class").agg(F.count("*").alias("_n")).where("_n > 1").select("class"), "shared")
    return classes.join(shared, "class", "left_semi").select(*KEY, "at", "class")


def later_copies(runs: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Of the runs with ``length`` up to twice as many lines, those that are not the first copy."""
    first = classes.withColumnRenamed("class", "_first")
    last = classes.withColumnRenamed("class", "_last")
    named = (
        runs.distinct()
        .join(first, [*KEY, "at"])
        .withColumn("_end", F.col("at") + F.col("size") - length)
        .join(last.withColumnRenamed("at", "_end"), [*KEY, "_end"])
        .select(*KEY, "at", "size", _named("_first", "_last", F.col("size").cast("string").cast("binary")).alias("_run"))
    )
    place = F.struct(*KEY, "at")
    origin = named.groupBy("_run").agg(F.min(place).alias("_origin"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return named.join(store(origin, "origins"), "_run").where(place != F.col("_origin")).select(*KEY, "at", "size")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``_row``: each row of ``docs``, all columns, with text and n_chars (where there is one) as
    they are without later copies; its numbers of lines and of removed lines."""
    gone = repeated_lines(docs, min_chars).groupBy(*KEY).agg(F.collect_set("line").alias("_gone"))
    # All columns travel as one, so that no name of theirs meets a name used here.
    whole = keyed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row")))
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    # Only texts that lose lines go to Python.
    left = F.udf(_without, "string", useArrow=True)(F.when(F.col("_gone").isNotNull(), F.coalesce("text", F.lit(""))), "_gone")
    held = whole.join(gone, list(KEY), "left").select(
        F.when(F.col("_gone").isNotNull(), F.col("_row").withField("text", left)).otherwise(F.col("_row")).alias("_row"),
        F.size(lines).alias("_n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).alias("_n_removed"),
    )
    if "n_chars" in docs.columns:
        size = F.length("_row.text").cast(docs.schema["n_chars"].dataType)
        held = held.withColumn(
            "_row", F.when(F.col("_n_removed") > 0, F.col("_row").withField("n_chars", size)).otherwise(F.col("_row"))
        )
    return held


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "_row.doc_id",
        F.col("_n_lines").cast("long").alias("n_lines"),
        F.col("_n_removed").cast("long").alias("n_removed"),
        F.coalesce(F.length("_row.text"), F.lit(0)).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("_row.text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
