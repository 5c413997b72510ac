"""Repeated runs of lines, found in a suffix array of line numbers and deleted.

Lines with a word are numbered by the order of their digests, which turns each document
into a sequence.  Prefix doubling ranks the suffixes of all sequences by their first
1, 2, 4, ... lines: suffixes are ordered by the pair (rank, rank that many lines on),
and the distinct pairs are sorted over range partitions.  Ranks are an inverse suffix
array.  Suffixes that no other shares a prefix with leave it, since a repeat cannot
start there.

Suffixes with a common prefix of length t are one longest-common-prefix interval.  Its
members are the rows with equal ranks of the first and of the last 2^k lines of the t,
2^k <= t < 2^(k+1).  An interval matters if its prefix has ``min_words`` words.  It is
enough to look, for each line, at the shortest such run that starts there and the
shortest that ends there: together they cover every longer repeated run.  These runs
have ``min_words`` lines at most, so doubling needs no more than log2(min_words) + 1
rounds, however long the repeats are.

In an interval the run at the smallest place (id, then line) stays; the others go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written
from .common import free_names, release_memory, shuffle_partitions, ship_package

MIN_WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
DOC = ["doc_id", "text_key"]


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _doc_key(key: Column) -> Column:
    """The id as a number; null as the smallest there is, so that joins find it."""
    return F.coalesce(key.cast("long"), F.expr("-9223372036854775807L - 1"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, idx, line_no, words, h1, h2`` for each line that has a word.

    ``idx`` counts such lines, ``line_no`` all lines.  The two digests make 128 bits.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    described = F.transform(
        F.split(text, "\n"),
        lambda line, at: F.struct(
            at.alias("line_no"),
            F.regexp_count(line, F.lit(WORD)).alias("words"),
            F.xxhash64(line).alias("h1"),
            F.xxhash64(F.lit(1), line).alias("h2"),
        ),
    )
    return docs.select(
        _doc_key(F.col(id_col)).alias("doc_id"),
        _text_key(F.col(text_col)).alias("text_key"),
        F.posexplode(F.filter(described, lambda line: line["words"] > 0)).alias("idx", "line"),
    ).select(*DOC, "idx", "line.*")


def _ranked(keys: DataFrame, by: list[str], path: str) -> DataFrame:
    """Number distinct keys that occur twice or more in their sort order.

    Counting first leaves one row for each key, so a line that a third of all rows share
    is one row here.  Numbers grow with the order and may have gaps.
    """
    spark = keys.sparkSession
    repeated = keys.groupBy(*by).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    ordered = repeated.select(*by).repartitionByRange(shuffle_partitions(spark), *by)
    return written(
        ordered.sortWithinPartitions(*by).withColumn("number", F.monotonically_increasing_id()), path
    )


def _shortest_runs(min_words: int):
    """For each document the runs (start, length) that have just ``min_words`` words."""

    @F.arrow_udf("array<struct<start: int, length: int>>")
    def runs(idx: pa.Array, words: pa.Array) -> pa.Array:
        found = []
        for places, counts in zip(idx, words):
            at = np.array(places.as_py(), np.int64)
            size = np.array(counts.as_py(), np.int64)
            own: set[tuple[int, int]] = set()
            breaks = np.flatnonzero(np.diff(at) != 1) + 1
            for a, b in zip(np.r_[0, breaks], np.r_[breaks, len(at)]):
                total = np.r_[0, np.cumsum(size[a:b])]
                first = int(at[a])
                ends = np.searchsorted(total, total[:-1] + min_words)
                own.update((first + g, int(e) - g) for g, e in enumerate(ends) if e < len(total))
                starts = np.searchsorted(total, total[1:] - min_words, side="right") - 1
                own.update((first + int(g), b + 1 - int(g)) for b, g in enumerate(starts) if g >= 0)
            found.append([{"start": s, "length": n} for s, n in sorted(own)])
        release_memory()
        return pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))

    return runs


def _later_copies(level: DataFrame, runs: DataFrame, k: int, folder: str) -> DataFrame:
    """The runs of 2^k to 2^(k+1) - 1 lines that occur at an earlier place too.

    Both sides of the last join are written tables, so that adaptive execution can split
    the interval of a run that a large part of all documents has.
    """
    own = runs.filter(f"length >= {1 << k} AND length < {2 << k}")
    head = level.select(*DOC, F.col("idx").alias("start"), F.col("rank").alias("head"))
    keyed = own.join(head, [*DOC, "start"])
    if k:
        tail = level.select(*DOC, F.col("idx").alias("tail_at"), F.col("rank").alias("tail"))
        keyed = keyed.withColumn("tail_at", F.expr(f"start + length - {1 << k}"))
        keyed = keyed.join(tail, [*DOC, "tail_at"])
    else:
        keyed = keyed.withColumn("tail", F.col("head"))
    place = F.struct("doc_id", "text_key", "start")
    interval = ["length", "head", "tail"]
    keyed = written(keyed.select(*DOC, "start", *interval), f"{folder}/keyed{k}")
    first = keyed.groupBy(*interval).agg(F.min(place).alias("first"))
    first = written(first, f"{folder}/first{k}")
    return keyed.join(first, interval).filter(place > F.col("first")).select(*DOC, "start", "length")


def repeated_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, text_key, first_line, last_line``: maximal runs of lines to delete.

    Line numbers count from 0.  Every line belongs to a run of at least ``min_words``
    words that also stands at a smaller place.  Lines without a word never count, and go
    just where the lines with words around them both go.  Runs that overlap their own copy leave one period.
    Rows that repeat an id and a text are one document.  A null id stands for the
    smallest number and so comes before others.
    Null and empty texts have no runs.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = scratch_folder(spark)
    lines = written(_lines(docs, id_col, text_col), f"{folder}/lines")
    numbers = _ranked(lines.select("h1", "h2"), ["h1", "h2"], f"{folder}/rank0")
    level = written(
        lines.join(numbers, ["h1", "h2"])
        .select(*DOC, "idx", "line_no", "words", F.col("number").alias("rank"))
        .distinct(),
        f"{folder}/level0",
    )
    arrays = level.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("idx", "words"))).alias("lines")
    )
    runs = arrays.select(
        *DOC, F.inline(_shortest_runs(min_words)(F.col("lines.idx"), F.col("lines.words")))
    )
    runs = written(runs, f"{folder}/runs")
    places = level.select(*DOC, "idx", "line_no")
    longest = runs.agg(F.max("length")).first()[0] or 0
    later, k = [_later_copies(level, runs, 0, folder)], 0
    while (2 << k) <= longest:
        on = Window.partitionBy(*DOC).orderBy("idx").rangeBetween(1 << k, 1 << k)
        pairs = level.select(*DOC, "idx", "rank", F.max("rank").over(on).alias("next"))
        pairs = pairs.filter("next IS NOT NULL")
        k += 1
        pairs = written(pairs, f"{folder}/pairs{k}")
        numbers = _ranked(pairs.select("rank", "next"), ["rank", "next"], f"{folder}/rank{k}")
        level = written(
            pairs.join(numbers, ["rank", "next"]).select(*DOC, "idx", F.col("number").alias("rank")),
            f"{folder}/level{k}",
        )
        later.append(_later_copies(level, runs, k, folder))
    copies = later[0]
    for more in later[1:]:
        copies = copies.unionByName(more)
    return _merged(written(copies, f"{folder}/copies"), places)


def _merged(copies: DataFrame, places: DataFrame) -> DataFrame:
    """Overlapping and touching runs as one, in numbers of all lines."""
    before = Window.partitionBy(*DOC).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*DOC).orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    spans = copies.select(*DOC, "start", F.expr("start + length - 1").alias("stop"))
    opens = F.coalesce(F.col("start") > F.max("stop").over(before) + 1, F.lit(True))
    spans = spans.withColumn("opens", opens.cast("int")).withColumn("run", F.sum("opens").over(upto))
    spans = spans.groupBy(*DOC, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    first = places.select(*DOC, F.col("idx").alias("start"), F.col("line_no").alias("first_line"))
    last = places.select(*DOC, F.col("idx").alias("stop"), F.col("line_no").alias("last_line"))
    spans = spans.join(first, [*DOC, "start"]).join(last, [*DOC, "stop"])
    return spans.select(*DOC, "first_line", "last_line")


def drop_repeated_runs(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the later copies of repeated runs deleted from the text.

    All rows and columns stay.  A text of which nothing remains becomes empty; a null
    text stays null.
    """
    runs = repeated_runs(docs, min_words, id_col, text_col)
    spans = runs.groupBy(*DOC).agg(
        F.sort_array(F.collect_list(F.struct("first_line", "last_line"))).alias("spans")
    )
    own_id, key, cut = free_names(docs.columns, "cut_id", "cut_key", "cut_spans")
    spans = written(spans.toDF(own_id, key, cut), f"{scratch_folder(docs.sparkSession)}/spans")
    same = (_doc_key(F.col(id_col)) == F.col(own_id)) & (_text_key(F.col(text_col)) == F.col(key))
    text = F.when(F.col(cut).isNull(), F.col(text_col)).otherwise(
        _without(F.split(F.col(text_col), "\n"), F.col(cut))
    )
    names = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    # The spans grow with the documents, so the join does not wait to see if they can be broadcast.
    return docs.join(spans.hint("merge"), same, "left").select(*names)


def _without(lines: Column, spans: Column) -> Column:
    """Text of the lines outside ``spans``, which are sorted and apart from each other."""
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.element_at(spans, i)["last_line"] + 1)
    stop = lambda i: F.coalesce(F.try_element_at(spans, i + 1)["first_line"], F.size(lines))
    gaps = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.slice(lines, start(i) + 1, F.greatest(stop(i) - start(i), F.lit(0))),
    )
    return F.array_join(F.flatten(gaps), "\n")
