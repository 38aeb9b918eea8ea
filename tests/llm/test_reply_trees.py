"""Paths through reply trees and round trips through the format."""

from pyspark.sql import functions as F

from llm_data import shipped  # noqa: F401
from tickward.llm.reply_trees import chosen_paths, format_paths, linear_replies, masked, parse

SCHEMA = "conv_id long, msg_id long, parent_id long, role string, text string, score double, branch string, _id int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "b", 0) for r in rows], SCHEMA)


def paths(df, **options):
    out = {}
    for r in chosen_paths(df, **options).collect():
        out.setdefault((r["conv_id"], r["branch"]), []).append((r["depth"], r["msg_id"]))
    return {k: [m for _, m in sorted(v)] for k, v in out.items()}


TREE = [
    (1, 1, None, "user", "q", 0.0),
    (1, 2, 1, "assistant", "good", 0.9),
    (1, 3, 1, "assistant", "bad", 0.1),
    (1, 4, 3, "user", "thanks", 0.9),
    (1, 5, 2, "user", "more", 0.6),
    (1, 6, 2, "user", "less", 0.6),
    (2, 1, None, "user", "alone", None),
    (3, 7, 99, "user", "parent unknown", 1.0),
    (None, 1, None, "user", "no id", 0.0),
    (None, 2, 1, None, None, 0.0),
]


def test_best_branch_of_each_tree(spark):
    assert paths(messages(spark, TREE)) == {(1, 1): [1, 2, 5], (2, 1): [1], (3, 1): [7], (None, 1): [1, 2]}


def test_branches_come_in_rank_order(spark):
    got = paths(messages(spark, TREE), branches=9)
    assert [got[1, b] for b in (1, 2, 3)] == [[1, 2, 5], [1, 2, 6], [1, 3, 4]]


def test_long_chain_and_circle(spark):
    chain = [(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(300)]
    circle = [(2, 1, 2, "user", "a", 0.0), (2, 2, 1, "user", "b", 0.0), (3, 1, 1, "user", "c", 0.0)]
    assert paths(messages(spark, chain + circle)) == {(1, 1): list(range(300))}
    assert paths(messages(spark, [])) == {}


HARD = ["\\### Assistant: </turn> ok", "", None, "\\s\\l\\\\", "<turn user>\nx</turn>\n", "\\ss\\sl\\", "a>b\n\n", "<<>>", "é😀\n"]


def test_texts_come_back_whatever_they_hold(spark):
    rows = [(k, i, r, t) for k, t in enumerate(HARD) for i, r in enumerate(["user", "assistant", "odd>\n<\\role\\n", None])]
    turns = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    done = format_paths(chosen_paths(linear_replies(turns), acyclic=True))
    read = done.select("conv_id", parse(F.col("formatted")).alias("t"), masked(F.col("formatted"), F.col("loss_spans")).alias("m"), "formatted").collect()
    assert len(read) == len(HARD)
    for r in read:
        text = HARD[r["conv_id"]] or ""
        assert [(t["role"], t["text"]) for t in r["t"]] == [("user", text), ("assistant", text), ("odd>\n<\\role\\n", text), ("", text)]
        assert r["m"] == text
        assert r["formatted"].count("</turn>\n") == 4


def test_repeated_and_unordered_turns(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, None, "system", "s"), (2, 0, "user", "x" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [t["text"] for t in r["t"]] for r in format_paths(chosen_paths(linear_replies(turns))).select("conv_id", parse(F.col("formatted")).alias("t")).collect()}
    assert got == {1: ["s", "a", "b", "b"], 2: ["x" * 100_000]}
