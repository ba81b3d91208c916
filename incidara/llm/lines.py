"""Deletion of repeated line runs, by suffix classes over line-ID sequences.

A document is the sequence of its lines that aren't blank, each named by a
digest. Prefix doubling names longer and longer prefixes of every suffix: the
name of 2k lines is made of the names of k lines at a position and k lines on.
A suffix never leaves its document, so that step needs no shuffle; what needs
one is finding which names recur. A name that recurs is an interval of the
suffix array whose common prefix has at least that many lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from .common import beside_helpers

MIN_LINES = 2
#: A single line counts as a run if it has so many words.
MIN_WORDS = 50


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value))


def _doubled(names: Column, step: int) -> Column:
    """Names of the prefixes that join a prefix with the one ``step`` lines on."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(names) - step, F.lit(0)), F.lit(1)),
        lambda i: F.when(
            i <= F.size(names) - step,
            _digest(F.concat(F.element_at(names, i), F.element_at(names, i + step))),
        ),
    )


def later_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Lines of runs that occur earlier: __id, __sum, __later (sorted line numbers from 0).

    Earlier means at a smaller (doc_id, digest of the text, place). Maximal runs
    are the unions of their windows of ``min_lines`` lines. Rows with nothing
    to delete are not listed.
    """
    lines = F.filter(
        F.transform(
            F.split(F.coalesce("text", F.lit("")), "\n"),
            lambda line, i: F.struct(
                i.alias("at"),
                _digest(line).alias("name"),
                (F.size(F.split(F.trim(line), r"\s+")) >= min_words).alias("long"),
                (F.trim(line, F.lit(" \t\r\x0b\x0c")) == "").alias("blank"),
            ),
        ),
        lambda line: ~line["blank"],
    )
    table = docs.select(
        F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__sum"), lines.alias("lines")
    ).filter(F.size("lines") > 0)
    table = table.withColumn("names", F.transform("lines", lambda line: line["name"]))
    span = 1
    while span < min_lines:
        step = min(span, min_lines - span)
        table = table.withColumn(
            "names", F.when(F.size("names") > step, _doubled(F.col("names"), step)).otherwise(F.array().cast("array<binary>"))
        )
        span += step
    runs = F.transform(
        "names",
        lambda name, i: F.struct(
            name.alias("name"), i.alias("from"), (i + min_lines - 1).alias("to")
        ),
    )
    long_lines = F.filter(
        F.transform(
            "lines",
            lambda line, i: F.struct(
                F.when(line["long"], line["name"]).alias("name"), i.alias("from"), i.alias("to")
            ),
        ),
        lambda run: run["name"].isNotNull(),
    )
    suffixes = table.select(
        "__id", "__sum", F.transform("lines", lambda line: line["at"]).alias("places"),
        F.explode(F.concat(runs, long_lines) if min_lines > 1 else runs).alias("run"),
    ).select(
        "__id", "__sum", "run.name",
        F.expr("slice(places, run.from + 1, run.to - run.from + 1)").alias("covered"),
        F.struct("__id", "__sum", F.element_at("places", F.col("run.from") + 1).alias("at")).alias("place"),
    )
    first = (
        suffixes.groupBy("name")
        .agg(F.min("place").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("name", "first")
    )
    later = suffixes.join(first, "name").filter(F.col("place") > F.col("first"))
    return later.groupBy("__id", "__sum").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("covered")))).alias("__later")
    )


def without_later_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with __later (line numbers that go, or null) and __kept (the text that stays).

    Lines end at a line feed. Blank lines stay and don't part a run. A run goes
    when it has ``min_lines`` lines, or one line of ``min_words`` words, and
    occurs earlier; of equal places in repeated rows all count as the first.
    Null text counts as empty and has nothing to delete; an empty table gives
    no rows; other columns pass through, whatever their names (but ``__`` ones,
    which ``drop_later_runs`` allows too).
    """
    marked = docs.withColumn("__sum", F.xxhash64("text"))
    later = later_lines(docs, min_lines, min_words).withColumnsRenamed({"__sum": "__sum2"})
    joined = marked.join(
        later, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sum") == F.col("__sum2")), "left"
    ).drop("__id", "__sum", "__sum2")
    lines = F.split(F.col("text"), "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("__later", i)), "\n")
    return joined.withColumn("__kept", F.when(F.col("__later").isNull(), F.col("text")).otherwise(kept))


def audit(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row: doc_id, n_lines, n_removed, n_runs (removed line groups), kept_sha256."""
    found = without_later_runs(docs.select("doc_id", "text"), min_lines, min_words)
    later = F.coalesce("__later", F.array().cast("array<int>"))
    runs = F.size(F.filter(later, lambda n, i: (i == 0) | (n - F.element_at(later, F.greatest(i, F.lit(1))) > 1)))
    return found.select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.size(later).cast("long").alias("n_removed"),
        runs.cast("long").alias("n_runs"),
        F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"),
    )


@beside_helpers
def drop_later_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later copies of line runs; columns are those of ``docs``.

    A document that consists of later copies alone goes with its last line.
    """
    found = without_later_runs(docs, min_lines, min_words)
    gone = F.col("__later").isNotNull() & (F.trim(F.col("__kept"), F.lit(" \t\r\n\x0b\x0c")) == "")
    return found.filter(~gone).withColumn("text", F.col("__kept")).select(*[f"`{c}`" for c in docs.columns])
