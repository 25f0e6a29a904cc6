"""Text functions as Column expressions (all JVM-side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed_length(c) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(_c(c)))


def position(needle: str, c) -> Column:
    """1-based position of a literal, 0 when absent."""
    return F.locate(needle, _c(c))


def pattern_position(c, regex: str) -> Column:
    """1-based position of the first match of a pattern, 0 when absent."""
    return F.regexp_instr(_c(c), F.lit(regex))


def last_segment(c, sep: str) -> Column:
    return F.substring_index(_c(c), sep, -1)


def dirname(c, sep: str) -> Column:
    """Everything before the last separator; the whole text when there is none."""
    c = _c(c)
    keep = F.length(c) - F.length(last_segment(c, sep)) - len(sep)
    return F.when(F.instr(c, sep) > 0, F.substring(c, F.lit(1), keep)).otherwise(c)


def extension(c) -> Column:
    return F.when(F.instr(_c(c), ".") > 0, last_segment(c, "."))


def strip_markers(c, markers: tuple[str, ...] = ("\r", "\n", "<?query --", "--?>")) -> Column:
    return reduce(lambda acc, m: F.replace(acc, F.lit(m), F.lit("")), markers, _c(c))


def stuff(c, start: int, length: int, new: str) -> Column:
    """Replace ``length`` characters from ``start`` (1-based) by ``new``."""
    return F.overlay(_c(c), F.lit(new), F.lit(start), F.lit(length))


def pad_id(c, n: int = 10) -> Column:
    """``n`` digits with leading zeros; longer ids stay whole."""
    digits = _c(c).cast("string")
    return F.when(F.length(digits) > n, digits).otherwise(F.lpad(digits, n, "0"))


def sort_id(c, n: int = 10) -> Column:
    """One step of a path that sorts like the ids, whatever their length.

    Ids have ``n`` digits with leading zeros; a longer one gets one ``:`` (behind the digits in
    order) per further digit in front, so that its length is known and it sorts behind shorter ones.
    """
    digits = _c(c).cast("string")
    return F.concat(F.repeat(F.lit(":"), F.greatest(F.length(digits) - n, F.lit(0))), pad_id(digits, n))


def norm(c) -> Column:
    """Comparison form: case-insensitive, trailing blanks ignored."""
    return F.lower(F.rtrim(_c(c)))


def bracket(c) -> Column:
    return F.concat(F.lit("["), F.replace(_c(c), F.lit("]"), F.lit("]]")), F.lit("]"))


def name_part(c, i: int) -> Column:
    """Part ``i`` of a dotted name counted from the right, brackets removed."""
    parts = F.reverse(F.split(_c(c), r"\."))
    return F.regexp_replace(F.get(parts, F.lit(i - 1)), r"^\[|\]$", "")


def concat_nn(*cols) -> Column:
    """Concatenation where NULL counts as empty text."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def split_clean(c, sep: str) -> Column:
    """Split on a literal separator, trim the items, drop blank ones."""
    items = F.transform(F.split(_c(c), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E"))), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != "")


def tag_list(c) -> Column:
    """``<a><b>`` to ``[a, b]``."""
    return F.regexp_extract_all(_c(c), F.lit("<([^<>]+)>"), 1)


def to_long(c) -> Column:
    """Number text with thousands separators."""
    return F.regexp_replace(_c(c), "[, ]", "").cast("bigint")


def statement_slice(text, start_offset, end_offset) -> Column:
    """Part of a statement given byte offsets of two-byte characters; -1 means to the end."""
    text, a, b = _c(text), _c(start_offset), _c(end_offset)
    last = F.when(b == -1, F.length(text) * 2).otherwise(b)
    return F.substring(text, F.floor(a / 2).cast("int") + 1, (F.floor((last - a) / 2) + 1).cast("int"))


def hex0x(c) -> Column:
    return F.concat(F.lit("0x"), F.hex(_c(c)))


def pseudo_random(key, seed: int) -> Column:
    """Repeatable number in [0, 1) from a key."""
    digest = F.md5(F.concat(_c(key).cast("string"), F.lit(f"/{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def host(c) -> Column:
    """Host of ``host.domain\\instance``."""
    return F.substring_index(F.substring_index(_c(c), "\\", 1), ".", 1)


def domain(c) -> Column:
    machine = F.substring_index(_c(c), "\\", 1)
    return F.when(F.instr(machine, ".") > 0, F.substring(machine, F.instr(machine, ".") + 1, F.length(machine)))


def instance(c) -> Column:
    return F.when(F.instr(_c(c), "\\") > 0, F.substring_index(_c(c), "\\", -1))


def like_class(c, pattern: str) -> Column:
    """LIKE with ``%``, ``_`` and character classes such as ``[A-Z]``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        end = pattern.find("]", i) if ch == "[" else -1
        if end > i:
            out.append(pattern[i : end + 1])
            i = end + 1
            continue
        out.append({"%": "(?s:.*)", "_": "(?s:.)"}.get(ch) or ("\\" + ch if not ch.isalnum() and ch not in " :/" else ch))
        i += 1
    return _c(c).rlike("^" + "".join(out) + "$")


def parse_waits(c) -> Column:
    """``(8x: 1/2/3ms)TYPE, (591ms)TYPE`` to ``array<struct<type, tasks, max_ms>>``.

    With a colon the number before ``x`` is the task count and the list after it holds
    min/avg/max; without a colon a single task waited the given time.
    """
    items = F.regexp_extract_all(_c(c), F.lit(r"(\([^()]*ms\)[A-Z0-9_]+)"), 1)

    def one(item: Column) -> Column:
        inner = F.regexp_extract(item, r"^\(([^)]*)ms\)", 1)
        numbers = F.split(F.trim(F.substring_index(inner, ":", -1)), "/")
        return F.struct(
            F.regexp_extract(item, r"\)([A-Z0-9_]+)$", 1).alias("type"),
            F.when(F.instr(inner, ":") > 0, F.regexp_extract(inner, r"^(\d+)x:", 1).cast("int")).otherwise(1).alias("tasks"),
            F.array_max(F.transform(numbers, lambda n: n.cast("bigint"))).alias("max_ms"),
        )

    return F.transform(items, one)


def max_wait_ms(c) -> Column:
    return F.array_max(F.transform(parse_waits(c), lambda w: w["max_ms"]))


def lock_wait(c) -> Column:
    """First lock wait (type starting with LCK) of a wait text, NULL when there is none."""
    return F.get(F.filter(parse_waits(c), lambda w: w["type"].startswith("LCK")), F.lit(0))
