"""Interaction audit of ordered filters by the Hart-Mas-Colell potential, in DataFrame functions.

A set of filters is a coalition; its worth is the number of documents that at least one of
its filters removes. The 32 coalitions of five filters are valued once from the counts of
failure patterns, the potential of each coalition follows from those of its subsets, and
everything asked about an order of filters is a difference between two coalitions.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from opskit.llm.common import durable

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Potentials are carried in units of one over this number, in which all of them are whole.
UNIT = len(ORDERS)

MIN_WORDS, DISTINCT_SHARE, UPPER_SHARE = 200, 50, 3
DUPLICATE = COALITIONS >> 1


def _words(text: Column) -> Column:
    for gap in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(gap), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def own_failures(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails."""
    words = _words(text)
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [n < MIN_WORDS, 100 * distinct < DISTINCT_SHARE * n, 100 * upper > UPPER_SHARE * F.char_length(text), text.rlike("[#$%&*|]")]
    bits = F.lit(0)
    for i, failed in enumerate(tests):
        bits = bits + F.when(failed, 1 << i).otherwise(0)
    return bits


def marked(labels: DataFrame) -> DataFrame:
    """One row per labelled doc_id: is any of its rows good, is any toxic."""
    some = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)) == 1
    return labels.filter("doc_id is not null").groupBy("doc_id").agg(some("quality").alias("good"), some("toxic").alias("toxic"))


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, failed, docs, good, toxic): documents per part and set of failed filters.

    Documents with one id count once per row. A text is a duplicate (E) if a smaller id holds
    it anywhere; a null id has no order, so its row neither is a duplicate nor makes one.
    Texts meet as digests: copies are counted before they are shuffled, and what remains of a
    text is one row per part and label.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), own_failures(text).alias("failed"))
    rows = durable(rows)
    kinds = ["digest", "part", "failed", "good", "toxic"]
    ids = rows.filter("doc_id is not null").groupBy("doc_id", "digest", "part", "failed").agg(F.count("*").alias("n"))
    ids = ids.join(marked(labels), "doc_id", "left").fillna(False, ["good", "toxic"])
    counted = ids.groupBy(*kinds).agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "n")).alias("first"))
    smallest = counted.groupBy("digest").agg(F.min("first.doc_id").alias("smallest"), F.count("*").alias("kinds"))
    # a text of one kind is its own first; only texts of several kinds are compared
    alone = counted.join(smallest.filter("kinds > 1"), "digest", "left")
    originals = F.when(F.col("smallest").isNull() | (F.col("first.doc_id") == F.col("smallest")), F.col("first.n")).otherwise(0)
    split = alone.select("part", "failed", "good", "toxic", "n", originals.alias("kept"))
    both = F.inline(F.array(F.struct(F.col("failed"), F.col("kept").alias("n")), F.struct((F.col("failed") + DUPLICATE).alias("failed"), (F.col("n") - F.col("kept")).alias("n"))))
    with_id = split.select("part", "good", "toxic", both)
    no = F.lit(False)
    without = rows.filter("doc_id is null").groupBy("part", "failed").agg(F.count("*").alias("n")).withColumns({"good": no, "toxic": no})
    n = F.col("n")
    of = lambda c: F.sum(F.when(F.col(c), n).otherwise(0))
    return with_id.unionByName(without).filter("n > 0").groupBy("part", "failed").agg(F.sum(n).alias("docs"), of("good").alias("good"), of("toxic").alias("toxic"))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), i)


def _worths(pattern: Column, measure: str) -> Column:
    """The measure of what each coalition removes, as an array by coalition."""

    def worth(s):
        lost = lambda acc, p: acc + F.when(p["failed"].bitwiseAND(s) != 0, p[measure]).otherwise(F.lit(0).cast("bigint"))
        return F.aggregate(pattern, F.lit(0).cast("bigint"), lost)

    return F.transform(F.sequence(F.lit(0), F.lit(COALITIONS - 1)), worth)


def _potentials(worths: Column) -> Column:
    """P(S) = (v(S) + sum over i in S of P(S without i)) / |S|, times ``UNIT``, by coalition.

    Subsets have smaller numbers than their coalition, so one pass in order is enough.
    """
    members = F.sequence(F.lit(0), F.lit(len(FILTERS) - 1))

    def step(found, s):
        inside = F.filter(members, lambda i: s.bitwiseAND(_bit(i)) != 0)
        smaller = F.aggregate(inside, F.lit(0).cast("bigint"), lambda acc, i: acc + F.get(found, s - _bit(i)))
        here = F.call_function("div", F.get(worths, s) * UNIT + smaller, F.size(inside))
        return F.concat(found, F.array(here))

    return F.aggregate(F.sequence(F.lit(1), F.lit(COALITIONS - 1)), F.array(F.lit(0).cast("bigint")), step)


def games(counted: DataFrame) -> DataFrame:
    """One row per part: worths of all coalitions (docs, good, toxic), potentials, Shapley values.

    ``counted`` has part, failed, docs, good, toxic, at most 32 rows per part. ``shapley`` is
    the potential of all filters minus that without the filter, in units of one over ``UNIT``.
    """
    per = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "docs", "good", "toxic")).alias("p"), F.sum("docs").alias("total"))
    for measure in ("docs", "good", "toxic"):
        per = per.withColumn(measure, _worths(F.col("p"), measure))
    per = per.withColumn("potential", _potentials(F.col("docs")))
    all_ = COALITIONS - 1
    value = F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda i: F.get("potential", F.lit(all_)) - F.get("potential", F.lit(all_) - _bit(i)))
    return per.select("part", "total", "docs", "good", "toxic", "potential", value.alias("shapley"))


def steps(games: DataFrame) -> DataFrame:
    """Every order of the filters, step by step: differences between consecutive coalitions."""
    orders = F.explode(F.array(*[F.lit(o) for o in ORDERS])).alias("filter_order")
    rows = games.select("*", orders).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    place = lambda k: F.instr(F.lit(FILTERS), F.substr("filter_order", k, F.lit(1))) - 1
    upto = lambda k: F.aggregate(F.sequence(F.lit(0), k), F.lit(0), lambda acc, j: acc + F.when(j > 0, _bit(place(j))).otherwise(0))
    rows = rows.withColumns({"i": place(F.col("step")), "before": upto(F.col("step") - 1)}).withColumn("after", F.col("before") + _bit(F.col("i")))
    gained = lambda measure: F.get(measure, F.col("after")) - F.get(measure, F.col("before"))
    all_ = F.lit(COALITIONS - 1)
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.get("docs", F.col("after"))).alias("kept"), gained("docs").alias("removed"),
        (F.get("docs", _bit(F.col("i"))) - gained("docs")).alias("redundant"), (F.get("docs", all_) - F.get("docs", all_ - _bit(F.col("i")))).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"), F.get("shapley", F.col("i")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (lang; null: empty), order of the five filters and step: what the filter removes.

    Columns part, filter_order, step, kept, removed, redundant (fails the filter, removed
    earlier), unique_fails (fails this filter only), good_lost, toxic_lost and shapley (its
    removals summed over all orders). ``docs`` has doc_id, text, lang, and ``labels`` doc_id,
    quality, toxic; further columns are ignored. Null text is empty, a document is good or
    toxic if any of its label rows says so, and rows without an id have no label. Without
    documents there are no rows.
    """
    return steps(games(patterns(docs, labels)))
