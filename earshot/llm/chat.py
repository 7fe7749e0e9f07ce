"""Conversations out of reply trees.

Messages point to their parents.  Self-joins double the distance at each round:
``up_t`` knows every message's ancestor 2**t steps above, and the messages on
each root-to-leaf path are found by joining them with ``up_0, up_1, ...``, so a
chain of n replies takes log2(n) rounds on narrow rows.  Branches are ranked by
the sum of their messages' scores, and each chosen path becomes one formatted
conversation with the spans that a model is to learn.

Each turn is written ``<s>[INST]role[/INST]text</s>``.  Where role or text hold
one of the control strings, a backslash goes behind its first character, one
more than stands there already, which can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.tables import keep, release, text_of

BEGIN, MIDDLE, END = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
LEARNT_ROLE = "assistant"
_SPAN = "struct<start:bigint,end:bigint>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def chain(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """(conv_id, node, parent, role, text, score) of turns that each answer the
    one before; equal turns in the order of role and text, nulls first."""
    given = messages.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), text_of("role").alias("role"), text_of("text").alias("text")
    )
    node = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return given.withColumn("node", node).select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _meet(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of one conversation whose left ``key`` is the right ``node``."""
    right = right.withColumnsRenamed({"conv_id": "_conv", "node": "_node"})
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col(key) == F.col("_node"))).drop("_conv", "_node")


def _climbed(tree: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(leaves that a root leads to, up_0, up_1, ...) of (conv_id, node, parent)."""
    nodes = tree.select("conv_id", "node")
    there = _meet(tree.select("conv_id", F.col("node").alias("child"), "parent"), nodes, "parent")
    first = keep(there.select("conv_id", F.col("child").alias("node"), F.col("parent").alias("up")), "up")
    ups, rooted = [first], None
    deepest = (first.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0).bit_length()
    while len(ups) <= deepest:
        further = _meet(ups[-1], ups[-1].withColumnRenamed("up", "_up"), "up").select("conv_id", "node", F.col("_up").alias("up"))
        further = keep(further, "up")
        if not further.take(1):
            break
        ups.append(further)
    else:
        rooted = ups.pop()  # longer than any path: only circles are left in it

    inner = first.select("conv_id", F.col("up").alias("node")).distinct()
    leaves = _without(nodes, inner)
    if rooted is not None:
        leaves = _without(leaves, rooted.select("conv_id", "node"))
    return leaves, ups


def _expanded(leaves: DataFrame, ups: list[DataFrame]) -> DataFrame:
    paths = leaves.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for t, up in enumerate(ups):
        higher = _meet(paths, up, "node").select("conv_id", "leaf", F.col("up").alias("node"), (F.col("above") + 2**t).alias("above"))
        longer = keep(paths.unionByName(higher), "paths")
        if t:
            release(paths)
        paths = longer
    return paths


def root_to_leaf_paths(tree: DataFrame) -> DataFrame:
    """(conv_id, leaf, node, above): the messages of each path, ``above`` steps
    above its leaf.  ``tree`` is (conv_id, node, parent).

    A parent that is not there makes a root.  Messages that answer each other
    in a circle, and what hangs on them, have no root and are left out.
    """
    return _expanded(*_climbed(tree))


def _without(nodes: DataFrame, others: DataFrame) -> DataFrame:
    others = others.withColumnsRenamed({"conv_id": "_conv", "node": "_node"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("node") == F.col("_node"))
    return nodes.join(others, same, "left_anti")


def _path_scores(tree: DataFrame, ups: list[DataFrame]) -> DataFrame:
    """(conv_id, node, total) of every message: the scores from it to its root.
    After round t the sum of 2**t messages; paths are not written out for it."""
    sums = tree.select("conv_id", "node", F.col("score").alias("total"))
    for t, up in enumerate(ups):
        above = _meet(up, sums.withColumnRenamed("total", "more"), "up").select("conv_id", "node", "more")
        above = above.withColumnsRenamed({"conv_id": "_conv", "node": "_node"})
        same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("node") == F.col("_node"))
        total = F.col("total") + F.coalesce("more", F.lit(0.0))
        longer = keep(sums.join(above, same, "left").select("conv_id", "node", total.alias("total")), "sums")
        if t:
            release(sums)
        sums = longer
    return sums


def _best_branches(leaves: DataFrame, scores: DataFrame, branches: int) -> DataFrame:
    """(conv_id, node, branch): the best leaves by score, ties to the smaller one."""
    best_first = Window.partitionBy("conv_id").orderBy(F.desc("total"), "node")
    ranked = _meet(leaves, scores, "node").withColumn("branch", F.row_number().over(best_first))
    return ranked.where(F.col("branch") <= branches).select("conv_id", "node", "branch")


def format_trees(tree: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, branch, formatted, learnt): the ``branches`` best paths of each
    conversation, each as one text, with the spans of it that hold assistant
    texts (code points, end exclusive).

    ``tree``: conv_id, node (long, unique in its conversation), parent, role,
    text, score.  Null roles and texts count as empty, null scores and those that
    are no number as 0, a null conv_id as a conversation of its own.  Other
    columns are ignored.  Only chosen paths are written out.
    """
    tree = tree.select(
        "conv_id", "node", "parent", text_of("role").alias("role"), text_of("text").alias("text"),
        F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("score"),
    )
    tree = keep(tree, "messages")
    leaves, ups = _climbed(tree.select("conv_id", "node", "parent"))
    chosen = keep(_best_branches(leaves, _path_scores(tree, ups), branches), "branches")
    paths = _expanded(chosen.select("conv_id", "node"), ups)
    chosen = chosen.withColumnsRenamed({"conv_id": "_conv", "node": "_leaf"})
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("leaf") == F.col("_leaf"))
    turns = _meet(paths.join(chosen, same).drop("_conv", "_leaf"), tree.select("conv_id", "node", "role", "text"), "node")
    turn = F.struct((-F.col("above")).alias("place"), "role", escaped(F.col("role")).alias("who"), escaped(F.col("text")).alias("what"))
    grouped = turns.groupBy("conv_id", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(F.lit(BEGIN), t["who"], F.lit(MIDDLE), t["what"], F.lit(END)))
    return grouped.select("conv_id", "branch", F.array_join(written, "").alias("formatted"), _learnt_spans("turns").alias("learnt"))


def _learnt_spans(turns: str) -> Column:
    state = f"struct<at:bigint,spans:array<{_SPAN}>>"

    def step(so_far: Column, t: Column) -> Column:
        start = so_far["at"] + len(BEGIN) + F.length(t["who"]) + len(MIDDLE)
        end = start + F.length(t["what"])
        span = F.struct(start.alias("start"), end.alias("end")).cast(_SPAN)
        spans = F.when(t["role"] == LEARNT_ROLE, F.concat(so_far["spans"], F.array(span))).otherwise(so_far["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans")).cast(state)

    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans")).cast(state)
    return F.aggregate(turns, first, step)["spans"]


def read_back(formatted: Column) -> Column:
    """Turns (role, text) of a formatted conversation."""
    parts = F.filter(F.split(formatted, END), lambda p: p != "")

    def turn(part: Column) -> Column:
        middle = F.locate(MIDDLE, part)
        role = F.substring(part, F.lit(len(BEGIN) + 1), middle - len(BEGIN) - 1)
        text = F.substring(part, middle + len(MIDDLE), F.length(part))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and their spans hold, read back from them."""
    learnt = F.transform("learnt", lambda s: unescaped(F.substring(F.col("formatted"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    read = formatted.select(
        "conv_id", read_back(F.col("formatted")).alias("turns"), F.array_join(learnt, "").alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """The table, and conversation -7, whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    extra = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
