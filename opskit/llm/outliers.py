"""Quality rules and robust multivariate outliers, in DataFrame functions only.

Every document has a vector of transformed text statistics. Per language and source, the
minimum covariance determinant (MCD) estimate takes location and scatter from the most
concentrated share of the vectors, found by concentration steps from a median start. Vectors
at a large Mahalanobis distance are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opskit.llm.common import GAP, durable, words_of

MIN_WORDS = 50
#: Share of the vectors that location and scatter are taken from.
COVERAGE = 0.75
STEPS = 4
#: Vectors a language and source needs for an estimate of its own.
MIN_GROUP = 100
#: Squared Mahalanobis distance beyond which a vector is rejected.
CUTOFF = 90.0
#: Smallest standard deviation of a statistic, in its transformed unit: many are constant.
FLOORS = (0.35, 0.10, 0.15, 0.10, 0.30)
#: MCD scatter of the central share is too small for normal data by this factor (five statistics).
CONSISTENCY = 1.45
#: Groups whose estimates are broadcast (about 200 bytes each); beyond it they are joined.
BROADCAST_GROUPS = 20_000

X = [f"x{i}" for i in range(len(FLOORS))]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice."""
    n = F.size(words)

    def covered(places: Column) -> Column:
        steps = F.transform(F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))), lambda p, i: F.least(F.lit(3), p - F.get(places, i)))
        return F.when(F.size(places) == 0, 0).otherwise(F.aggregate(steps, F.lit(3), lambda a, s: a + s))

    def repeated(windows: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(windows, a)["w"] == F.get(windows, b)["w"], F.lit(False))
        hits = F.filter(F.sequence(F.lit(0), F.size(windows) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        return _let(F.sort_array(F.transform(hits, lambda k: F.get(windows, k)["at"])), covered)

    def windows_of(ws: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))

    def count(found: Column) -> Column:
        # most texts repeat nothing: a hash set tells, and only the others are sorted
        tagged = F.transform(found, lambda w, i: F.struct(w.alias("w"), i.alias("at")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), 0).otherwise(_let(F.sort_array(tagged), repeated))

    return F.when(n < 4, 0).otherwise(_let(words, lambda ws: _let(windows_of(ws), count)))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", *keep, text.alias("_t"))
    base = base.withColumn("_w", words_of(F.col("_t")))
    solid = F.filter(F.split("_t", "\n"), lambda x: F.regexp_replace(x, GAP, "") != "")
    out = base.select(
        "doc_id", *keep,
        F.size("_w").cast("bigint").alias("n_words"),
        F.char_length(F.translate("_t", " \t\n\x0b\f\r", "")).cast("bigint").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        _let(solid, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("_w")).cast("bigint").alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vectors(stats: DataFrame) -> DataFrame:
    """``stats`` with the transformed statistics x0 to x4 (zeros without words)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    values = (F.log(n), F.log(chars / n), F.log1p(100 * F.col("n_symbols") / chars), F.sqrt(F.col("n_repeat_words") / n), F.log1p(F.col("n_dup_lines").cast("double")))
    return stats.withColumns(dict(zip(X, values)))


def _grouped(vectors: DataFrame, min_group: int) -> tuple[DataFrame, bool]:
    """``vectors`` with their group, and whether there are few groups. Column ``g``: language and source, or where these are few vectors the pool of such
    sources of the language, or the pool of such languages; null where that is too small."""
    sizes = vectors.where("not base_failed").groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    small = F.col("n") < min_group
    pooled = sizes.withColumn("_pool", F.sum(F.when(small, F.col("n")).otherwise(0)).over(W.partitionBy("_lang")))
    level = F.when(~small, 0).when(F.col("_pool") >= min_group, 1).otherwise(2)
    levels = pooled.withColumn("_level", level)
    rest = levels.where("_level = 2").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    name = (
        F.when(F.col("_level") == 0, F.to_json(F.struct("_lang", "_source")))
        .when(F.col("_level") == 1, F.to_json(F.struct("_lang")))
        .when(rest >= min_group, F.lit("all"))
    )
    named = durable(levels.withColumn("g", name).select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), "g"))
    few = named.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return _attach(vectors, named, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), few).drop("_l", "_s"), few


def _attach(rows: DataFrame, per_group: DataFrame, on, few: bool) -> DataFrame:
    """Left join of one row per group; broadcast only while there are few groups."""
    return rows.join(F.broadcast(per_group) if few else per_group, on, "left")


def _distance(p: int = len(X)) -> Column:
    """Squared Mahalanobis distance from the location m* and the inverse Cholesky factor i*_*."""
    total = F.lit(0.0)
    for i in range(p):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"i{i}_{j}") * (F.col(X[j]) - F.col(f"m{j}"))
        total = total + z * z
    return total


def _factor(moments: DataFrame, scale: float) -> DataFrame:
    """Location and inverse Cholesky factor of the scatter times ``scale`` plus the squared floors, per group."""
    p = len(X)
    df = moments
    for i in range(p):
        df = df.withColumn(f"m{i}", F.col(f"s{i}") / F.col("n"))
    for i in range(p):
        for j in range(i + 1):
            c = (F.col(f"s{j}_{i}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * scale
            df = df.withColumn(f"c{i}_{j}", F.greatest(c, F.lit(0.0)) + FLOORS[i] ** 2 if i == j else c)
    for i in range(p):  # Cholesky: lower factor l
        for j in range(i + 1):
            v = F.col(f"c{i}_{j}")
            for k in range(j):
                v = v - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            df = df.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(v, F.lit(1e-9))) if i == j else v / F.col(f"l{j}_{j}"))
    for i in range(p):  # its inverse
        for j in range(i + 1):
            if i == j:
                df = df.withColumn(f"i{i}_{i}", 1 / F.col(f"l{i}_{i}"))
            else:
                v = F.lit(0.0)
                for k in range(j, i):
                    v = v - F.col(f"l{i}_{k}") * F.col(f"i{k}_{j}")
                df = df.withColumn(f"i{i}_{j}", v / F.col(f"l{i}_{i}"))
    return df.select(F.col("g").alias("_g"), *[f"m{i}" for i in range(p)], *[f"i{i}_{j}" for i in range(p) for j in range(i + 1)])


def _moments(rows: DataFrame) -> DataFrame:
    p = len(X)
    sums = [F.sum(X[i]).alias(f"s{i}") for i in range(p)]
    products = [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}_{j}") for i in range(p) for j in range(i, p)]
    return rows.groupBy("g").agg(F.count("*").alias("n"), *sums, *products)


def _share_bins(rows: DataFrame, by: list[str], bin_: str, share: float) -> DataFrame:
    """The lowest bin that, with those below it, holds the share of the group's rows (exact counts)."""
    counts = rows.groupBy(*by, bin_).agg(F.count("*").alias("n"))
    below = W.partitionBy(*by).orderBy(bin_).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*by)
    ranked = counts.withColumn("run", F.sum("n").over(below)).withColumn("all", F.sum("n").over(whole))
    return ranked.where(F.col("run") >= F.ceil(share * F.col("all"))).groupBy(*by).agg(F.min(bin_).alias("cut"))


def _start(rows: DataFrame, few: bool) -> DataFrame:
    """Medians and scaled median deviations, to 1/64, as a diagonal first estimate."""
    long = rows.select("g", F.posexplode(F.array(*X)).alias("k", "x"))
    med = _share_bins(long.withColumn("bin", F.round(F.col("x") * 64)), ["g", "k"], "bin", 0.5).select("g", "k", (F.col("cut") / 64).alias("med"))
    med = durable(med)
    away = _attach(long, med.withColumnsRenamed({"g": "_g", "k": "_k"}), (F.col("g") == F.col("_g")) & (F.col("k") == F.col("_k")), few)
    mad = _share_bins(away.withColumn("bin", F.round(F.abs(F.col("x") - F.col("med")) * 64)), ["g", "k"], "bin", 0.5)
    both = med.join(mad, ["g", "k"]).withColumn("sd", 1.4826 * F.col("cut") / 64)
    cols = []
    for i, floor in enumerate(FLOORS):
        cols.append(F.max(F.when(F.col("k") == i, F.col("med"))).alias(f"m{i}"))
        cols.append(F.max(F.when(F.col("k") == i, 1 / F.greatest(F.col("sd"), F.lit(floor)))).alias(f"i{i}_{i}"))
    start = both.groupBy(F.col("g").alias("_g")).agg(*cols)
    return start.withColumns({f"i{i}_{j}": F.lit(0.0) for i in range(len(X)) for j in range(i)})


def estimates(rows: DataFrame, few: bool, coverage: float = COVERAGE, steps: int = STEPS) -> DataFrame:
    """Location and inverse factor of the scatter, per group of ``rows`` (g, x0 ...), durable.

    A concentration step takes the share of vectors nearest by the last estimate, from exact
    counts of distances binned at 1/32 of a log unit, and estimates anew; it never raises the
    determinant. A last step reweights: all vectors within the 97.5 percent ellipsoid.
    """
    now = durable(_start(rows, few))
    for step in range(steps):
        placed = _attach(rows, now, F.col("g") == F.col("_g"), few).withColumn("bin", F.floor(32 * F.log(_distance() + 1e-6)))
        cut = _share_bins(placed, ["g"], "bin", coverage).withColumnRenamed("g", "_h")
        near = placed.join(cut, F.col("g") == F.col("_h")).where("bin <= cut")
        now = durable(_factor(_moments(near.select("g", *X)), CONSISTENCY if step == steps - 1 else 1.0))
    inside = _attach(rows, now, F.col("g") == F.col("_g"), few).where(_distance() <= 12.83)
    return durable(_factor(_moments(inside.select("g", *X)), 1.0))


def judge(docs: DataFrame, min_group: int = MIN_GROUP, cutoff: float = CUTOFF, **options) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, distance (squared; null without an estimate) and kept.

    A null text has no words. Estimates are taken from the documents that pass the base
    rules; null languages and sources are groups of their own; where even the pooled groups
    are too small, the base rules alone decide. Repeated rows count as often as they occur.
    """
    stats = statistics(docs.withColumns({"_lang": F.col("lang").cast("string"), "_source": F.col("source").cast("string")}), "_lang", "_source")
    grouped, few = _grouped(_vectors(durable(stats)), min_group)
    rows = durable(grouped)
    found = estimates(rows.where("not base_failed and g is not null").select("g", *X), few, **options)
    out = _attach(rows, found, F.col("g") == F.col("_g"), few).withColumn("distance", _distance())
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")
