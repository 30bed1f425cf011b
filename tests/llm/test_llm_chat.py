import hashlib

from clinilake.llm import chat


def _table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def _expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "user", "hi <|end|>\n&amp; <|more|>"), (1, 1, "assistant", "&lt;b> <|assistant|>\n"),
    (1, 2, "assistant", "second"), (1, 3, "assistant", None), (1, 4, "user", ""),
    (2, 0, None, None), (2, 1, "a|>\nb", "role with marks"), (2, 1, "a|>\nb", "role with marks"),
    (3, None, "system", "no turn"), (3, 5, "assistant", "x" * 20000), (3, 5, "user", "tie"),
    (None, 0, "assistant", "no id"), (4, 0, "assistant", "é<"),
]


def test_round_trip_of_awkward_conversations(spark):
    formatted = chat.format_conversations(_table(spark, ROWS))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(formatted).collect()}
    assert got == _expected(ROWS)
    for r in formatted.collect():
        assert "".join(s.text for s in r.segments) == r.formatted


def test_adjacent_turns_of_a_role_share_a_block(spark):
    text = chat.format_conversations(_table(spark, ROWS)).where("conv_id = 1").first().formatted
    assert text.count("<|assistant|>") == 1 and text.count("<|user|>") == 2 and text.count("<|more|>") == 2


def test_empty_table_and_extra_columns(spark):
    from pyspark.sql import functions as F
    empty = _table(spark, [])
    assert chat.digests(chat.format_conversations(empty)).count() == 0
    wide = _table(spark, ROWS).withColumn("turns", F.lit(1)).withColumn("t", F.lit(2)).withColumn("segments", F.lit(3))
    assert chat.digests(chat.format_conversations(wide)).count() == 5


def test_one_conversation_with_most_rows(spark):
    rows = [(9, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(6000)] + [(8, 0, "user", "a")]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in chat.digests(chat.format_conversations(_table(spark, rows))).collect()}
    assert got == _expected(rows)
