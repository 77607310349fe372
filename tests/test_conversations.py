"""Turns without a conversation stay in the table of conversations."""

from __future__ import annotations

from sparkprep.plans import tables


def test_turns_without_a_conversation(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (9, 0, "user", "c"), (None, 0, "user", "d"), (None, 1, "bot", "e")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["text"]: (r["subset"], r["sample_idx"]) for r in tables.conversations(spark, str(tmp_path)).collect()}
    assert sorted(got) == list("abcde")
    assert [got[t][1] for t in "abc"] == [0, 1, 2]
    assert got["d"][0] == got["e"][0] and {got["d"][1], got["e"][1]} == {0, 1}
