"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Every assistant turn becomes an
example of its own: all turns before it as context, itself as the target, and the loss mask
covers its text only. Turns after the last target form one example without a target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: control strings of chat templates, split behind their first character
OPENING = r"[<\[]"
REST = r"\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"

START, STOP = "<|im_start|>", "<|im_end|>\n"
TARGET = "assistant"


def escaped(c: Column) -> Column:
    """A backslash goes behind the first character of every control string, escaped ones included."""
    return F.regexp_replace(c, f"({OPENING})(\\\\*)({REST})", "$1\\\\$2$3")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, f"({OPENING})\\\\(\\\\*)({REST})", "$1$2$3")


def _role_out(c: Column) -> Column:
    """A role without line breaks."""
    return escaped(F.replace(F.replace(c, F.lit("\\"), F.lit("\\-")), F.lit("\n"), F.lit("\\n")))


def _role_in(c: Column) -> Column:
    return F.replace(F.replace(unescaped(c), F.lit("\\n"), F.lit("\n")), F.lit("\\-"), F.lit("\\"))


def examples(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, example, text, trainable, loss_start, loss_end).

    ``turns`` has conv_id, turn, role, text; other columns are ignored. Offsets are code
    points of ``text``, the end exclusive; without a target both are its length. Turns go by
    number, nulls first, ties by role and text, and repeated rows are turns of their own. Null
    role and text count as empty, a null conv_id is one conversation. A conversation is the
    unit of training and is brought together in one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(START), _role_out(role), F.lit("\n"))
    body = escaped(text)
    turn = F.struct(
        F.col("turn").alias("turn"), F.concat(head, body, F.lit(STOP)).alias("piece"),
        F.char_length(head).alias("head"), F.char_length(body).alias("body"), (role == TARGET).alias("target"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("turns", i - 1)["target"] | (i == n))
    rows = whole.select("conv_id", "turns", F.posexplode(ends).alias("example", "end"))
    last = F.get("turns", F.col("end") - 1)
    shown = F.slice("turns", F.lit(1), F.col("end"))
    rows = rows.select(
        "conv_id", F.col("example").cast("bigint").alias("example"), F.array_join(F.transform(shown, lambda t: t["piece"]), "").alias("text"),
        last["target"].alias("trainable"), last["body"].alias("body"),
    )
    size = F.char_length("text")
    stop = F.when(F.col("trainable"), size - len(STOP)).otherwise(size)
    start = F.when(F.col("trainable"), size - len(STOP) - F.col("body")).otherwise(size)
    return rows.select("conv_id", "example", "text", "trainable", start.cast("bigint").alias("loss_start"), stop.cast("bigint").alias("loss_end"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of ``examples`` output, parsed from its texts: one row per conversation.

    conv_id, n_turns, turns_sha256 (role, line break, text, line break of every turn),
    loss_chars and loss_sha256 (the text under the loss masks), formatted_chars.
    """
    masked = F.expr("substring(text, cast(loss_start as int) + 1, cast(loss_end - loss_start as int))")
    per = formatted.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("full"),
        F.sort_array(F.collect_list(F.struct("example", masked.alias("loss")))).alias("losses"),
        F.sum(F.char_length("text").cast("bigint")).alias("formatted_chars"),
    )
    parts = F.split("full", "<\\|im_end\\|>\n")
    turns = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.substr(p, F.lit(len(START) + 1)))
    role = lambda t: _role_in(F.substring_index(t, "\n", 1))
    text = lambda t: unescaped(F.substr(t, F.instr(t, F.lit("\n")) + 1))
    per = per.withColumn("turns", turns).withColumn("loss", F.array_join(F.transform("losses", lambda x: unescaped(x["loss"])), ""))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(role(t), F.lit("\n"), text(t), F.lit("\n"))), "")
    return per.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
