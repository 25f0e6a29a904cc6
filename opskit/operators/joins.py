"""Joins the reference workload needs beyond plain equi joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opskit.functions import text
from opskit.operators.ordered import null_safe_join, series_fill, series_lag, series_running_sum, with_group
from opskit.session import durable

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Checked size bound in rows and, if those are few, in bytes of their text form."""
    if df.count() > max_rows:
        return False
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    return df.agg(size.alias("b")).first()["b"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the size is proven small; otherwise a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row relation to every row; NULLs when it is empty."""
    values = one_row.select(F.struct("*")).scalar()
    out = df.withColumn("_one", values)
    return out.select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in one_row.columns])


def compare_sides(a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Full outer comparison: measures of both sides (0 when absent) and their difference."""
    left = a.select(*keys, *[F.col(m).alias(f"{m}_a") for m in measures])
    right = b.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(m).alias(f"{m}_b") for m in measures])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_{k}"))
        cond = c if cond is None else cond & c
    full = left.join(right, cond, "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return full.select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in keys],
        *[
            e
            for m in measures
            for e in (
                zero(f"{m}_a").alias(f"{m}_a"),
                zero(f"{m}_b").alias(f"{m}_b"),
                (zero(f"{m}_b") - zero(f"{m}_a")).alias(f"{m}_diff"),
            )
        ],
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    cols: Sequence[str],
    direction: str = "backward",
    tie: str | None = None,
) -> DataFrame:
    """Nearest right row at or before (``backward``) or at or after (``forward``) each left row.

    Both sides are unioned into one series per key and the payload is carried along it, so
    no pair is built; series are cut into slices, so a hot key or instant is split.  Equal right times are
    resolved by ``tie`` (largest for backward, smallest for forward).
    """
    if not by:
        raise ValueError("name the series keys; add a constant column for a single series")
    backward = direction == "backward"
    r_side, l_side = (0, 1) if backward else (1, 0)
    pay = F.struct(*[F.col(c) for c in cols])
    tie_col = F.col(tie) if tie else F.lit(0)
    l_cols = [c for c in left.columns if c not in by]
    lhs = left.select(
        *by, F.col(left_ts).alias("_ts"), F.lit(l_side).alias("_side"), F.monotonically_increasing_id().alias("_tie"),
        F.struct(*l_cols).alias("_row"),
    )
    rhs = right.select(
        *by, F.col(right_ts).alias("_ts"), F.lit(r_side).alias("_side"), tie_col.cast("bigint").alias("_tie"),
        pay.alias("_match"),
    )
    both = lhs.unionByName(rhs, allowMissingColumns=True)
    filled = series_fill(both, by, ["_ts", "_side", "_tie"], "_match", "_hit", backward)
    return filled.filter(F.col("_row").isNotNull()).select(
        *by, *[F.col(f"_row.{c}").alias(c) for c in l_cols], *[F.col(f"_hit.{c}").alias(c) for c in cols]
    )


def bounds(df: DataFrame, ts: str, start, end, by: Sequence[str] = ()) -> DataFrame:
    """First sample time at or after ``start`` and last one at or before ``end``."""
    return df.groupBy(*by).agg(
        F.min(F.when(F.col(ts) >= start, F.col(ts))).alias("lower_time"),
        F.max(F.when(F.col(ts) <= end, F.col(ts))).alias("upper_time"),
    )


def to_ranges(points: DataFrame, point: str, by: Sequence[str] = ()) -> DataFrame:
    """Consecutive distinct points of a key to (lower, upper, range_id, last range flag)."""
    p = points.select(*by, F.col(point)).filter(F.col(point).isNotNull()).distinct()
    p = series_lag(p, by, [point], [point], "next_", lead=True)
    p = series_running_sum(p, by, [point], F.lit(1).cast("bigint"), "range_id")
    p = with_group(p, by, _end=F.max(point)).filter(F.col(f"next_{point}").isNotNull())
    upper = F.col(f"next_{point}")
    return p.select(*by, "range_id", F.col(point).alias("lower"), upper.alias("upper"), (upper == F.col("_end")).alias("is_last"))


def range_join(samples: DataFrame, ranges: DataFrame, by: Sequence[str], ts: str, tie: str | None = None) -> DataFrame:
    """Samples with the range of their key that holds them.

    Ranges of a key do not overlap; each is half open except the last one, which includes
    its upper edge.  That makes it an as-of join on the lower edge plus a check.
    """
    hit = asof_join(samples, ranges, by, ts, "lower", ["range_id", "lower", "upper", "is_last"], "backward")
    inside = (F.col(ts) < F.col("upper")) | (F.col("is_last") & (F.col(ts) == F.col("upper")))
    return hit.filter(inside)


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """SQL NOT IN: nothing qualifies once the list holds a NULL, NULL never qualifies.

    Written as a plain anti join plus two scalar facts, so the list may be of any size.
    """
    facts = other.agg(
        F.coalesce(F.max(F.col(other_col).isNull()), F.lit(False)).alias("has_null"), F.count("*").alias("n")
    ).select(F.struct("has_null", "n")).scalar()
    keys = other.select(F.col(other_col).alias("_k")).filter("_k is not null").distinct()
    kept = df.join(keys, F.col(col) == F.col("_k"), "left_anti")
    kept = kept.withColumn("_f", facts)
    return kept.filter((F.col("_f.n") == 0) | (~F.col("_f.has_null") & F.col(col).isNotNull())).drop("_f")


def normalised_key(col: str, strip: Sequence[str] = (" base", " ratio", " (ms)")) -> Column:
    """Counter name without its endings (` ratio base` too), lower case, trimmed."""
    pattern = "(" + "|".join(s.replace("(", r"\(").replace(")", r"\)") for s in strip) + ")+$"
    return F.rtrim(F.regexp_replace(text.norm(col), pattern, ""))


def join_normalised(a: DataFrame, b: DataFrame, keys: Sequence[str], a_name: str, b_name: str) -> DataFrame:
    """Equi join on a precomputed normalised name (plus ordinary keys)."""
    left = a.withColumn("join_name", normalised_key(a_name))
    right = b.withColumn("join_name", normalised_key(b_name)).drop(b_name)
    return null_safe_join(left, right, [*keys, "join_name"])


def contains_join(
    texts: DataFrame, text_id: str, text_col: str, terms: DataFrame, term_id: str, term_col: str, max_terms: int = 200
) -> DataFrame:
    """(text, term) pairs where the whole text contains the term.

    A proven short list of terms is tested in place.  Of a longer list every term is filed
    under one piece of it that every text holding the term must hold as well: a token strictly
    inside the term (a whole token of the text), else one of its q-grams, else the short term
    itself.  Of all such pieces the one in the fewest texts is taken, so terms with one
    beginning, or with common words, do not meet on one key; a term with a piece in no text at
    all is found nowhere.
    """
    t = terms.select(F.col(term_id).alias("_tid"), F.col(term_col).alias("_term")).filter("length(_term) > 0")
    base = texts.select(F.col(text_id), F.col(text_col).alias("_text"))
    if is_small(t, max_terms):
        listed = t.agg(F.collect_list(F.struct("_tid", "_term"))).scalar()  # at most max_terms entries
        hit = F.filter(F.col("_terms"), lambda x: F.contains(F.col("_text"), x["_term"]))
        found = base.withColumn("_terms", listed).select(text_id, F.explode(hit).alias("_h"))
        return found.select(text_id, F.col("_h._tid").alias(term_id))
    q = 6
    tokens = lambda c: F.split(F.col(c), r"[^\p{L}\p{N}]+")
    inner = F.filter(F.slice(tokens("_term"), F.lit(2), F.greatest(F.size(tokens("_term")) - 2, F.lit(0))), lambda x: x != "")

    def cut(col, width) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(col) - width + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.col(col).substr(i, F.lit(width) if isinstance(width, int) else width))

    of_text = {"token": tokens("_text"), "gram": cut("_text", q), "cut": F.flatten(F.transform(F.array(*[F.lit(i) for i in range(1, q)]), lambda w: cut("_text", w)))}
    of_term = {"token": inner, "gram": cut("_term", q), "cut": F.array("_term")}
    kind = F.when(F.size(inner) > 0, "token").when(F.length("_term") >= q, "gram").otherwise("cut")
    seeded = durable(t.withColumn("_kind", kind))
    candidates = None
    for way, pieces in of_text.items():
        some = seeded.filter(F.col("_kind") == way)
        if some.isEmpty():
            continue
        filed = some.select("_tid", "_term", F.explode(F.array_distinct(of_term[way])).alias("_piece"))
        # only the id travels with the pieces; the text joins again for the few candidates
        held = durable(base.select(text_id, F.explode(F.array_distinct(pieces)).alias("_piece")).join(filed.select("_piece").distinct(), "_piece", "left_semi"))
        held_by = held.groupBy("_piece").agg(F.count("*").alias("_n"))
        rare = filed.join(held_by, "_piece", "left").groupBy("_tid", "_term").agg(
            F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_piece")).alias("_r")).filter("_r._n > 0")
        part = held.join(rare.select("_tid", "_term", "_r._piece"), "_piece").select(text_id, "_tid", "_term").distinct()
        candidates = part if candidates is None else candidates.unionByName(part)
    hits = base.join(candidates, text_id).filter(F.contains("_text", F.col("_term")))
    return hits.select(text_id, F.col("_tid").alias(term_id))


def ancestor_prefixes(path: Column | str, sep: str) -> Column:
    """Every leading part of a path that ends with the separator."""
    c = F.col(path) if isinstance(path, str) else path
    parts = F.split(c, F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E")))
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), sep), F.lit(sep)),
    )


def longest_prefix_join(
    paths: DataFrame, path_id: str, path: str, prefixes: DataFrame, prefix: str, cols: Sequence[str], sep: str
) -> DataFrame:
    """Each path with its longest matching prefix (prefixes end with the separator).

    Every path is expanded to its own few ancestor prefixes and joined by equality.
    """
    exploded = paths.select(path_id, path, F.explode(ancestor_prefixes(path, sep)).alias(prefix))
    best = (
        exploded.join(prefixes.select(prefix, *cols), prefix)
        .groupBy(path_id)
        .agg(F.max_by(F.struct(prefix, *cols), F.length(prefix)).alias("_best"))
    )
    joined = paths.join(best, path_id, "left")
    return joined.select(*paths.columns, F.col(f"_best.{prefix}").alias(prefix), *[F.col(f"_best.{c}").alias(c) for c in cols])


def denormalise(fact: DataFrame, dims: Mapping[str, DataFrame], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left joins to dimensions keyed by a same-named column; small ones are broadcast."""
    for key, dim in dims.items():
        fact = fact.join(broadcast_if_small(dim, max_rows), key, "left")
    return fact


def resolve_polymorphic(fact: DataFrame, class_col: str, id_col: str, dims: Mapping[object, tuple[DataFrame, str, str]]) -> DataFrame:
    """Name of an object whose dimension depends on its class: one filtered join per class.

    ``dims`` maps a class to (dimension, key column, name column).
    """
    out = None
    for cls, (dim, key, name) in dims.items():
        d = dim.select(F.col(key).alias("_k"), F.col(name).alias("object_name"))
        part = fact.filter(F.col(class_col) == cls).join(d, F.col(id_col) == F.col("_k")).drop("_k")
        out = part if out is None else out.unionByName(part)
    return out


def head_to_head(answers: DataFrame, parent: str, owner: str, score: str, me, rival) -> DataFrame:
    """Scores of two owners under the same parent."""
    mine = answers.filter(F.col(owner) == me).select(parent, F.col(score).alias("my_score"))
    theirs = answers.filter(F.col(owner) == rival).select(parent, F.col(score).alias("rival_score"))
    winner = (
        F.when(F.col("my_score") > F.col("rival_score"), "You win")
        .when(F.col("my_score") < F.col("rival_score"), "Rival wins")
        .otherwise("Tie")
    )
    return mine.join(theirs, parent).withColumn("winner", winner)
