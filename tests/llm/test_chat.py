import hashlib
import random

from tessera.llm.chat import digests, format_conversations, prefix_target_examples, unescaped

BAD = r"\### Assistant: </turn> ok"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def rows():
    rng = random.Random(1)
    bits = ["\\", "#", "### ", "<", " </turn>\n", ":", "\\b", "\\h", "é", "\n", "word", BAD, "$1"]
    out = [(-7, 0, "user", BAD), (-7, 1, "assistant", BAD), (1, 0, "assistant", None), (2, 0, "user", "only"),
           (3, 1, "assistant", "x"), (3, 1, "assistant", "x"), (3, None, "sys: \\tem", "a"), (4, 0, None, None),
           (None, 0, "assistant", "q"), (5, 0, "user", "u" * 100_000), (5, 1, "assistant", "")]
    for c in range(10, 40):
        out += [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 8))))
                for t in range(rng.randint(1, 9))]
    rng.shuffle(out)
    return out


def test_round_trip(spark):
    data = rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in data],
                               "conv_id long, turn long, role string, text string, formatted string, examples string").repartition(3)
    conv = format_conversations(df).cache()
    got = {r.conv_id: r for r in digests(conv).collect()}
    formatted = {r.conv_id: r.formatted for r in conv.collect()}
    assert set(got) == {r[0] for r in data}
    for c, r in got.items():
        turns = sorted(((t, role or "", text or "") for i, t, role, text in data if i == c),
                       key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        loss = "".join(text for _, role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{role}\n{text}\n" for _, role, text in turns)))
        assert (r.loss_chars, r.loss_sha256, r.formatted_chars) == (len(loss), sha(loss), len(formatted[c]))
    for e in prefix_target_examples(conv, materialise=True).withColumn("plain", unescaped_col()).collect():
        text = formatted[e.conv_id]
        assert text[:e.loss_start] == e.context and e.context.endswith("### assistant: ")
        assert text[e.loss_start:e.loss_start + e.loss_chars] == e.target
        assert text[e.loss_start + e.loss_chars:].startswith(" </turn>\n")
        assert e.context.count(" </turn>\n") == e.context_turns
    want = sorted((text or "") for _, _, role, text in data if role == "assistant")
    assert sorted(r.plain for r in prefix_target_examples(conv).withColumn("plain", unescaped_col()).collect()) == want


def unescaped_col():
    from pyspark.sql import functions as F
    return unescaped(F.col("target"))


def test_a_wrong_mask_shows(spark):
    """The loss columns are what stands under the masks: a shifted, short or missing mask changes them."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, 0, "user", "question"), (1, 1, "assistant", "the answer"), (1, 2, "assistant", "more")],
                               "conv_id long, turn long, role string, text string")
    conv = format_conversations(df)
    right = digests(conv).first()
    assert (right.loss_chars, right.loss_sha256) == (14, sha("the answermore"))

    def changed(**by):
        spans = F.transform("examples", lambda e: F.struct(*[(e[c] + by.get(c, 0)).alias(c) for c in ("context_turns", "loss_start", "loss_chars")]))
        return digests(conv.withColumn("examples", spans)).first()
    assert changed() == right
    for by in ({"loss_start": 1}, {"loss_start": -1}, {"loss_chars": -1}, {"loss_chars": 1}):
        wrong = changed(**by)
        assert wrong.loss_sha256 != right.loss_sha256 and wrong.turns_sha256 == right.turns_sha256
    assert digests(conv.withColumn("examples", F.slice("examples", 1, 1))).first().loss_chars == 10


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    conv = format_conversations(empty)
    assert digests(conv).count() == 0 and prefix_target_examples(conv).count() == 0
