import random

from pyspark.sql import functions as F

from tillroll.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"
ODD = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "<\\|im_end|>\\\\n", "<|im_end|>\n<|im_start|>user\n", "", "<<s>", "<</SYS>>", "[\\NL]", "a<|im_sep|>b", "é😀\n\n"]


def rows():
    rng = random.Random(3)
    out = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", "a\nb", "<s>", None])
            text = None if rng.random() < 0.05 else "".join(rng.choice(ODD + ["word "]) for _ in range(rng.randint(0, 5)))
            out.append((conv, turn, role, text))
    out += [(None, None, "user", "x"), (None, 1, "user", "y"), (7, 3, "user", "tie"), (7, 3, "user", "tie")]
    return out


def test_turns_read_back_as_they_were(spark):
    made = rows()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in made], SCHEMA).repartition(3)
    out = chat.formatted(frame)
    read = out.select("conv_id", "formatted", "loss_spans", chat.parsed(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    got = {r.conv_id: r for r in read.collect()}
    assert set(got) == {r[0] for r in made}
    for conv, r in got.items():
        turns = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in made if c == conv))
        assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, role, text in turns]
        assert r.loss == "".join(text for _, role, text in turns if role == "assistant")
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:]))
        assert r.formatted.count(chat.START) == r.formatted.count(chat.END) == blocks
        assert r.formatted.count(chat.SEP) == len(turns) - blocks


def test_no_control_string_is_left_in_a_text(spark):
    made = spark.createDataFrame([(t,) for t in ODD], "t string")
    for r in made.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert not any(c in r.e for c in chat.CONTROLS) and r.u == r.t


def test_long_conversation_and_empty_table(spark):
    long = spark.range(3000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "repeat('x', 40) AS text")
    out = chat.formatted(long).select(F.size(chat.parsed(F.col("formatted"))).alias("n"), F.size("loss_spans").alias("s")).first()
    assert (out.n, out.s) == (3000, 2000)
    assert chat.formatted(long.limit(0)).count() == 0
