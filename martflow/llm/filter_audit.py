"""What filters do together: a removal game over all coalitions of filters.

A document is removed by a set of filters (a coalition) if it fails any of them.  The
number of documents a coalition removes is its value; how often each pattern of failures
occurs gives the values of all coalitions, so texts are read once.

Values are turned into Hart-Mas-Colell potentials by recursion over the coalitions:
``P(S) = (v(S) + sum of P(S without i) for i in S) / |S|``, and ``P`` of no filter is 0.
A filter's Shapley value is the grand coalition's potential minus the potential of the
coalition without that filter.  A step of an order adds one filter to a coalition, and
what it does is a difference of two values.

All of it is DataFrame code.  One row for each document, part and pattern of failures is
counted in the map tasks; what is left is a few rows a part.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import permutations
from math import factorial
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import scratch_folder, written

#: At most so many filters: each part gets a row for every order and step.
MOST_FILTERS = 6

Failure = Callable[[Column], Column]

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACE), "")


def _of_words(condition: Callable[[Column], Column]) -> Failure:
    return lambda text: condition(_words(text))


def few_words(least: int) -> Failure:
    """Fewer than ``least`` words."""
    return _of_words(lambda words: F.size(words) < least)


def repeated_words(least_percent: int) -> Failure:
    """Fewer distinct words than so many in a hundred; never without words."""

    def failed(words: Column) -> Column:
        distinct = F.size(F.array_distinct(words)).cast("long")
        return distinct * 100 < F.size(words).cast("long") * least_percent

    return _of_words(failed)


def many_capitals(most_percent: int) -> Failure:
    """More capitals A-Z than so many in a hundred code points."""

    def failed(text: Column) -> Column:
        capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
        return capitals * 100 > F.length(text).cast("long") * most_percent

    return failed


def holds_any(characters: str) -> Failure:
    """At least one of the characters."""
    return lambda text: F.length(F.translate(text, characters, "")) < F.length(text)


#: Filters on a text alone, by letter.
TEXT_FILTERS: Mapping[str, Failure] = {
    "A": few_words(50),
    "B": repeated_words(65),
    "C": many_capitals(5),
    "D": holds_any("#$%&*|"),
}
#: The filter that compares a text with those of smaller ids.
COPIES = "E"


def failure_patterns(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Failure] = TEXT_FILTERS,
    copies: str = COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``part, failed, docs, good, toxic``: documents by part and pattern of failures.

    ``failed`` has bit k set for the k-th filter; the filter for copies is the last one.
    Whole texts are read once, to a narrow written table of digests and bits.  A text that
    a large part of all rows share meets its smallest id in a join between two written
    tables, which adaptive execution can split.
    """
    folder = scratch_folder(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = [
        F.when(failed(text), F.lit(1 << k)).otherwise(F.lit(0)) for k, failed in enumerate(filters.values())
    ]
    last = 1 << len(filters)
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
            reduce(add, bits, F.lit(0)).alias("failed"),
        ),
        f"{folder}/rows",
    )
    repeated = rows.groupBy("digest").agg(
        F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("rows")
    )
    repeated = written(repeated.filter("rows > 1").drop("rows"), f"{folder}/repeated")
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    marked = written(marked.filter("good OR toxic"), f"{folder}/marked")
    is_copy = (F.col("doc_id") > F.col("lowest")) | (F.col("doc_id").isNull() & F.col("lowest").isNotNull())
    pattern = F.col("failed") + F.when(is_copy, F.lit(last)).otherwise(F.lit(0))
    return (
        rows.join(repeated, "digest", "left")
        .select("doc_id", "part", pattern.alias("failed"))
        .join(marked, F.col("doc_id") == F.col("labelled"), "left")
        .groupBy("part", "failed")
        .agg(
            F.count(F.lit(1)).alias("docs"),
            F.count_if("good").alias("good"),
            F.count_if("toxic").alias("toxic"),
        )
    )


def coalition_values(patterns: DataFrame, filters: int) -> DataFrame:
    """``part, docs, removed, good, toxic``: one row a part; arrays by coalition.

    Entry S of ``removed`` is how many documents fail a filter of coalition S, whose bits
    name its filters; ``good`` and ``toxic`` count the labelled ones among these.
    """

    def removed(column: str) -> Column:
        hit = [
            F.sum(F.when(F.col("failed").bitwiseAND(F.lit(s)) != 0, F.col(column)).otherwise(F.lit(0)))
            for s in range(1 << filters)
        ]
        return F.array(*hit)

    return patterns.groupBy("part").agg(
        F.sum("docs").alias("docs"),
        removed("docs").alias("removed"),
        removed("good").alias("good"),
        removed("toxic").alias("toxic"),
    )


def potentials(values: Column, filters: int) -> Column:
    """The Hart-Mas-Colell potential of each coalition, times ``filters!``.

    A coalition without one of its filters has a smaller number, so a fold over the
    coalitions in order finds every potential it needs.  ``|S| * P(S) * |S|!`` and so
    ``filters! * P(S)`` are whole numbers, and every division below is exact.
    """
    scale = factorial(filters)

    def step(known: Column, s: Column) -> Column:
        size = F.bit_count(s).cast("long")
        smaller = [
            F.when(
                s.bitwiseAND(F.lit(1 << i)) != 0, F.element_at(known, s - F.lit((1 << i) - 1))
            ).otherwise(F.lit(0).cast("long"))
            for i in range(filters)
        ]
        total = reduce(add, smaller, F.element_at(values, s + 1) * scale)
        return F.array_append(known, F.call_function("div", total, size))

    coalitions = F.array(*(F.lit(s) for s in range(1, 1 << filters)))
    return F.reduce(coalitions, F.array(F.lit(0).cast("long")), step)


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Failure] = TEXT_FILTERS,
    copies: str = COPIES,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """What each filter does at each step of every order, for each part of a table.

    ``part, filter_order, step, filter, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.  ``shapley`` is the filter's Shapley value of documents removed,
    times the number of orders: what it removes, summed over all of them.

    Null texts are empty, null parts are the empty string.  A row without an id is a copy
    of every row with an id and the same text; rows that repeat an id and a text are not
    copies of each other.  Labels that repeat an id count if any of them says so; null
    labels say nothing.  Texts of any length are read whole.  A table without rows gives
    none; other columns are not read.
    """
    names = [*filters, copies]
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters can be audited in every order")
    patterns = failure_patterns(docs, labels, filters, copies, id_col, text_col, part_col)
    return audit_patterns(patterns, names)


def audit_patterns(patterns: DataFrame, names: Sequence[str]) -> DataFrame:
    """The audit of counted failure patterns; ``names`` are the filters, lowest bit first."""
    count = len(names)
    full = (1 << count) - 1
    parts = coalition_values(patterns, count).withColumn("potential", potentials(F.col("removed"), count))
    steps = [
        F.struct(
            F.lit("".join(names[i] for i in order)).alias("filter_order"),
            F.lit(step + 1).alias("step"),
            F.lit(names[order[step]]).alias("filter"),
            F.lit(sum(1 << i for i in order[:step])).alias("before"),
            F.lit(1 << order[step]).alias("own"),
        )
        for order in permutations(range(count))
        for step in range(count)
    ]
    rows = parts.select("*", F.inline(F.array(*steps)))

    def of(column: str, coalition: Column) -> Column:
        return F.element_at(column, coalition + 1)

    before, own = F.col("before"), F.col("own")
    after, without = before + own, F.lit(full) - own
    taken = of("removed", after) - of("removed", before)
    return rows.select(
        "part",
        "filter_order",
        "step",
        "filter",
        (F.col("docs") - of("removed", after)).alias("kept"),
        taken.alias("removed"),
        (of("removed", own) - taken).alias("redundant"),
        (of("removed", F.lit(full)) - of("removed", without)).alias("unique_fails"),
        (of("good", after) - of("good", before)).alias("good_lost"),
        (of("toxic", after) - of("toxic", before)).alias("toxic_lost"),
        (of("potential", F.lit(full)) - of("potential", without)).alias("shapley"),
    )
