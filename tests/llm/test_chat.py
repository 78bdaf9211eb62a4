from pyspark.sql import functions as F

from touchline.llm.chat import PART, PartVisitor, Template, format_conversations, read_loss, read_turns, text_parts
import pytest

T = Template()


def formatted(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"body": F.lit("x"), "formatted": F.lit(1), "start": F.lit("s")}) if extra else df
    return format_conversations(df.withColumn("parts", text_parts(F.col("text"))))


def read(df):
    got = df.select(
        "conv_id", read_turns(F.col("formatted"), T).alias("turns"), read_loss(F.col("formatted"), F.col("loss"), T).alias("learned")
    ).collect()
    return {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["learned"]) for r in got}


def test_reads_back_what_was_written(spark):
    nasty = ["</s>[INST] ok [/INST]", "[\\INST] [\\\\INST]", "[TURN]", "a[", "INST]<", "/s>", "\\", "[SAYS]\n", "é[PART]ß😀", "<s><s>"]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    turns, learned = read(formatted(spark, rows, extra=True))[1]
    assert turns == [(r, t) for _, _, r, t in rows]
    assert learned == "".join(t for _, _, r, t in rows if r == "assistant")


def test_nulls_ties_and_empties(spark):
    rows = [(1, 0, None, None), (1, 0, "b", "x"), (1, 0, "a", "y"), (1, None, "assistant", ""), (None, 0, "user", "u"), (None, 0, "user", "v"), (2, 0, "assistant", "z" * 100_000), (2, 0, "assistant", "z")]
    got = formatted(spark, rows)
    assert got.count() == 4  # both turns without a conversation stand alone
    turns = read(got.filter("conv_id is not null"))
    assert turns[1][0] == [("assistant", ""), ("", ""), ("a", "y"), ("b", "x")]
    assert turns[2][1] == "z" + "z" * 100_000
    assert formatted(spark, []).count() == 0


def test_attachments(spark):
    part = lambda kind, **k: (kind, *(k.get(c) for c in "text ref width height seconds pages".split()))
    rows = [
        (1, 0, "user", [part("text", text="see [IMAGE]"), part("image", ref="i1", width=28, height=15), part("text", text="é"), part("audio", ref="a1", seconds=1.5)]),
        (1, 1, "assistant", [part("document", ref="d1", pages=2), part(None, ref="?"), part("image", ref="i2")]),
        (1, 2, "user", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PART}>")
    r = format_conversations(df, visitor=PartVisitor(patch=14, audio_rate=10, page_tokens=100)).first()
    assert [(a["kind"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        ("image", "i1", 4), ("audio", "a1", 15), ("document", "d1", 200), ("unknown", "?", 1), ("image", "i2", 1)
    ]
    assert r["expanded_tokens"] == 221
    marks = ["[IMAGE]", "[AUDIO]", "[DOCUMENT]", "[FILE]", "[IMAGE]"]
    assert [r["formatted"][a["place"] :].startswith(m) for a, m in zip(r["attachments"], marks)] == [True] * 5
    start, length = r["loss"][0]
    assert r["formatted"][start : start + length] == "[DOCUMENT][PART][FILE][PART][IMAGE]"


def test_ambiguous_marks_are_refused():
    with pytest.raises(ValueError):
        Template(turn="[[X]")
