"""Conversations from reply trees.

Messages point at the message they answer. Self-joins that double the distance climb from every message to its root, so a
tree of depth d takes about log2(d) joins; on the way the scores of a path are summed. The leaves of a tree are ranked by
the mean score of their path, and the chosen paths are walked back by the same doubled links. Each path becomes one string:

    <turn ROLE>
    TEXT</turn>

with a line end after each turn. In roles and texts a backslash is written \\s and the less-than sign \\l, in roles also
greater-than \\g and line end \\n, so neither a mark nor an escape of another kind can come from a text. The loss mask is a list of
(start, length) in code points: the assistant's texts without marks.

NULL roles and texts are empty. Messages whose parent is unknown are roots. Messages of one conversation must have
distinct ids; those on a circle of replies belong to no path. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickward.llm.common import stored

ASSISTANT = "assistant"
OPEN, CLOSE = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\s"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\g"), F.lit(">")))


def linear_replies(turns: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as messages that each answer the one before; ties in turn by role, text."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text"))
    place = F.row_number().over(order).cast("long")
    rows = turns.select("conv_id", place.alias("msg_id"), "role", "text")
    return rows.withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)).withColumn("score", F.lit(0.0))


def _same(left: DataFrame, right: DataFrame, key: str, other: str) -> Column:
    return left["conv_id"].eqNullSafe(right["_conv"]) & (left[key] == right[other])


def climb(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Link tables, the k-th from each message to the one 2^k steps up, and per message its depth and path score."""
    ids = messages.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_up"))
    known = messages.join(ids, _same(messages, ids, "parent_id", "_up"), "left")
    state = known.select("conv_id", "msg_id", "_up", F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("total"))
    state = stored(state, "replies")
    links = []
    while True:
        going = state.where("_up is not null")
        if going.isEmpty():
            return links, state
        links.append(going.select("conv_id", "msg_id", "_up"))
        if len(links) > 62:
            raise ValueError("replies form a circle")
        above = state.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"), F.col("_up").alias("_next"), F.col("depth").alias("_d"), F.col("total").alias("_t"))
        climbed = going.join(above, _same(going, above, "_up", "_id"))
        climbed = climbed.select("conv_id", "msg_id", F.col("_next").alias("_up"), (F.col("depth") + F.col("_d")).alias("depth"), (F.col("total") + F.col("_t")).alias("total"))
        state = stored(state.where("_up is null").unionAll(climbed), "replies")


def without_circles(messages: DataFrame, max_depth: int = 1 << 20) -> DataFrame:
    """``messages`` that reach a root within ``max_depth`` steps, a limit no honest conversation meets."""
    ids = messages.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"))
    state = messages.join(ids, _same(messages, ids, "parent_id", "_id"), "left").select("conv_id", "msg_id", F.col("_id").alias("_up"))
    state, steps = stored(state, "circles"), 1
    while steps < max_depth and not state.where("_up is not null").isEmpty():
        above = state.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"), F.col("_up").alias("_next"))
        state = stored(state.join(above, _same(state, above, "_up", "_id"), "left").select("conv_id", "msg_id", F.col("_next").alias("_up")), "circles")
        steps *= 2
    lost = state.where("_up is not null").select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"))
    return messages.join(lost, _same(messages, lost, "msg_id", "_id"), "left_anti")


def chosen_paths(messages: DataFrame, branches: int = 1, acyclic: bool = False) -> DataFrame:
    """The ``branches`` best root-to-leaf paths of every conversation, one row per message on them.

    Adds branch (from 1), leaf_id and depth (1 at the root). A path's rank is its mean score, then its length, longest
    first, then its leaf's id. ``acyclic`` spares the search for circles where there can be none.
    """
    messages = messages.select("conv_id", "msg_id", "parent_id", "role", "text", "score")
    messages = messages if acyclic else without_circles(messages)
    links, state = climb(messages)
    if not links:
        path = state.select("conv_id", "msg_id", "depth", "total")
        leaves = path
    else:
        parents = links[0].select(F.col("conv_id").alias("_conv"), F.col("_up").alias("_id")).distinct()
        leaves = state.join(parents, _same(state, parents, "msg_id", "_id"), "left_anti")
    best = Window.partitionBy("conv_id").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "msg_id")
    marked = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches)
    marked = marked.select("conv_id", "branch", F.col("msg_id").alias("leaf_id"), "msg_id")
    for link in reversed(links):
        up = link.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"), "_up")
        climbed = marked.join(up, _same(marked, up, "msg_id", "_id")).select("conv_id", "branch", "leaf_id", F.col("_up").alias("msg_id"))
        marked = stored(marked.unionAll(climbed), "paths")
    depths = state.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"), "depth")
    marked = marked.join(depths, _same(marked, depths, "msg_id", "_id")).drop("_conv", "_id")
    texts = messages.select(F.col("conv_id").alias("_conv"), F.col("msg_id").alias("_id"), "role", "text")
    return marked.join(texts, _same(marked, texts, "msg_id", "_id")).drop("_conv", "_id")


def format_paths(paths: DataFrame) -> DataFrame:
    """One row per path: conv_id, branch, formatted and loss_spans."""
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit(">\n"))
    turns = paths.select(
        "conv_id", "branch", "depth", F.concat(head, text, F.lit(CLOSE)).alias("turn"), F.char_length(head).alias("_head"), F.char_length(text).alias("_text"), (F.col("role") == ASSISTANT).alias("_loss")
    )
    so_far = Window.partitionBy("conv_id", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.char_length("turn")).over(so_far)
    start = end - F.char_length("turn") + F.col("_head")
    turns = turns.withColumn("span", F.when(F.col("_loss"), F.struct(start.cast("long").alias("start"), F.col("_text").cast("long").alias("length"))))
    rows = turns.groupBy("conv_id", "branch").agg(F.sort_array(F.collect_list(F.struct("depth", "turn", "span"))).alias("t"))
    spans = F.filter("t.span", lambda s: s.isNotNull())
    return rows.select("conv_id", "branch", F.array_join("t.turn", "").alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, read back: array of (role, text)."""
    parts = F.filter(F.split(formatted, OPEN, -1), lambda part: part != "")
    body = lambda part: F.substr(part, F.instr(part, ">\n") + 2)
    return F.transform(
        parts,
        lambda part: F.struct(
            unescape_role(F.left(part, F.instr(part, ">\n") - 1)).alias("role"),
            unescape(F.left(body(part), F.char_length(body(part)) - len(CLOSE))).alias("text"),
        ),
    )


def masked(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, read back, joined with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
