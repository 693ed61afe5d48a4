"""Line dedup: repeated windows of consecutive lines are found globally, later occurrences removed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import ASKED, lookup_join
from ..session import materialized
from .common import without

WIDTH = 3


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, not again for each element a lambda goes through."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _filled(text: Column) -> Column:
    """The lines with something in them, as (place among all lines, trimmed line)."""
    numbered = F.transform(
        F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("at"), F.btrim(line, F.lit(" \t\r")).alias("line"))
    )
    return F.filter(numbered, lambda x: x["line"] != "")


def _windows(text: Column, width: int) -> Column:
    def of(filled: Column) -> Column:
        def one(i: Column) -> Column:
            part = [F.get(filled, i + k) for k in range(width)]
            return F.struct(
                F.unhex(F.md5(F.concat_ws("\n", *[p["line"] for p in part]))).alias("window"),
                part[0]["at"].alias("first"),
                part[-1]["at"].alias("last"),
            )

        return F.when(F.size(filled) >= width, F.transform(F.sequence(F.lit(0), F.size(filled) - width), one))

    return _once(_filled(text), of)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """`docs` with the later occurrences of repeated line windows taken out of the text.

    A window is `width` consecutive lines that are not blank, compared without the blanks at
    their ends. All windows of all texts are compared by a 128-bit hash. The first occurrence
    of a window (by id, nulls last, then by text hash, then by place) stays; the lines from the
    first to the last of every other occurrence go, blank ones between them included. A line
    that goes always has an equal one that stays, as the occurrence it repeats comes earlier.

    Adds `n_lines`, `n_removed` and `n_windows` (later occurrences) and replaces `text_col`;
    input columns of these names are replaced. A null text stays null with 0 lines; an empty
    text has one blank line; a text with fewer lines than `width` has no window. Rows that
    repeat an id and a text are one document: each keeps what that document keeps. A text whose
    lines all go becomes empty, its row stays.

    Windows are hashed once and written; one occurrence a window goes through the shuffle, not its lines. Very frequent
    windows are answered by a broadcast of at most 1000 keys (`lookup_join`). Overlapping windows that go are merged to
    spans before they are gathered per document, so a document gets no more entries than it has lines.
    """
    text = F.col(text_col)
    keyed = without(docs, ["n_lines", "n_removed", "n_windows"]).withColumn("__key", F.unhex(F.md5(F.coalesce(text, F.lit("")))))
    place = [F.col("id").isNull().alias("no_id"), F.col("id"), F.col("key"), F.col("first")]
    several = keyed.where(F.contains(text, F.lit("\n"))) if width > 1 else keyed
    windows = several.select(F.col(id_col).alias("id"), F.col("__key").alias("key"), F.inline(_windows(text, width)))
    windows = materialized(windows, "line-windows")
    firsts = (
        windows.groupBy("window")
        .agg(F.count("*").alias(ASKED), F.min(F.struct(*place)).alias("earliest"))
        .where(F.col(ASKED) > 1)
    )
    later = lookup_join(windows, firsts, ["window"]).where(F.struct(*place) > F.col("earliest"))
    spans = _spans(later.select("id", "key", "first", "last"))
    joined = keyed.join(spans, (keyed["__key"] == spans["__text"]) & keyed[id_col].eqNullSafe(spans["__id"]), "left")

    def without_gone(lines: Column) -> Column:
        gone = F.flatten(F.transform("__spans", lambda s: F.sequence(s["first"], s["last"])))
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    rest = _once(F.split(text, "\n", -1), without_gone)
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return joined.select(
        *[
            (F.when(F.col("__spans").isNull(), text).otherwise(rest) if c == text_col else F.col(f"`{c}`")).alias(c)
            for c in keyed.columns
            if c != "__key"
        ],
        F.when(text.isNull(), 0).otherwise(breaks + 1).alias("n_lines"),
        F.coalesce("__removed", F.lit(0)).cast("int").alias("n_removed"),
        F.coalesce("__windows", F.lit(0)).cast("int").alias("n_windows"),
    )


def _spans(later: DataFrame) -> DataFrame:
    """Per document the windows that go, merged where they overlap: places, lines removed and number of windows."""
    order = Window.partitionBy("id", "key").orderBy("first")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    before = F.lag("first").over(order)
    marked = later.withColumns({"begins": F.coalesce(F.col("first") > reach, F.lit(True)), "fresh": ~before.eqNullSafe(F.col("first"))})
    marked = marked.withColumn("span", F.sum(F.col("begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = marked.groupBy("id", "key", "span").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum(F.col("fresh").cast("int")).alias("n")
    )
    return spans.groupBy(F.col("id").alias("__id"), F.col("key").alias("__text")).agg(
        F.collect_list(F.struct("first", "last")).alias("__spans"),
        F.sum(F.col("last") - F.col("first") + 1).alias("__removed"),
        F.sum("n").alias("__windows"),
    )
