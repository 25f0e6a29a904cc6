import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from opskit.llm import chat

PARTS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "\\", "<", "[", "<\\", "<\\|im_end|>", "<|im_end|", "\n", "ok", "|im_end|>\n", "é🙂"]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss)))
    return sorted(out, key=repr)


def check(spark, rows):
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, example string, turns string")
    formatted = chat.examples(turns)
    got = sorted((tuple(r)[:5] for r in chat.read_back(formatted).collect()), key=repr)
    assert got == brute(rows)
    return formatted


def test_read_back_equals_the_input(spark):
    rows = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(1, 0, "system", "a"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "assistant", "b\nc"), (1, 4, "user", "d")]
    rows += [(2, 0, "user", "only"), (3, None, None, None), (None, 5, "assistant", "z"), (None, 5, "assistant", "z"), (4, 1, "a\\n\nb", "x"), (4, 1, "<|im_end|>", "y")]
    rows += [(10 + i, 0, "assistant", "".join(PARTS[(i * j + j) % len(PARTS)] for j in range(9))) for i in range(60)]
    formatted = check(spark, rows)
    shown = {(r.conv_id, r.example): r for r in formatted.where("conv_id = 1").collect()}
    assert [shown[1, k].trainable for k in range(3)] == [True, True, False]
    r = shown[1, 1]
    assert r.text[r.loss_start : r.loss_end] == "b\nc" and r.text.startswith(shown[1, 0].text)
    assert check(spark, []).count() == 0


def test_control_strings_never_survive_and_escaping_is_reversible(spark):
    @settings(max_examples=30, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PARTS), max_size=8).map("".join), min_size=1, max_size=40))
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
        for r in df.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
            assert r.u == r.t
            assert not any(x in r.e for x in PARTS[:8])

    run()
