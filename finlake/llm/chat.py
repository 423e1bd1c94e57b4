"""Chat formatting from reply trees. DataFrame functions only.

Every root-to-leaf path of a tree of messages is a conversation. Paths come from self-joins that double their reach: with the
ancestor 2^k steps up known for each message, each leaf's known ancestors give those 2^k steps further, so a path of n
messages takes log2(n) rounds. Branches of a tree are ranked by the sum of their scores.

A turn is ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed. Inside roles and texts a ``<``, any
backslashes and a ``|`` get one more backslash, so no control string can stand there, and losing one restores them. In roles
line feeds and percent signs are written %0A and %25.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.llm.shared import stored

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def paths(messages: DataFrame) -> DataFrame:
    """``(tree, leaf, node, up)``: the messages of every root-to-leaf path, ``up`` steps above its leaf.

    ``messages (tree, node, parent)`` with unique, non-null ``(tree, node)``. A parent that is not in the tree makes a root.
    Messages on a cycle, and those below one, reach no root and belong to no path.
    """
    known = messages.select("tree", "node", "parent")
    nodes = known.select("tree", F.col("node").alias("parent"))
    up = stored(known.join(nodes, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("above")), "parents")
    replied = up.select("tree", F.col("above").alias("node")).distinct()
    leaves = known.join(replied, ["tree", "node"], "left_anti")
    reached = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    step, largest = 1, known.groupBy("tree").count().agg(F.max("count")).head()[0] or 0
    while step <= largest and up.take(1):
        further = reached.join(up, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + step).alias("up"))
        reached = stored(reached.unionByName(further), "paths")
        twice = up.select("tree", F.col("node").alias("low"), F.col("above").alias("node")).join(up, ["tree", "node"])
        up = stored(twice.select("tree", F.col("low").alias("node"), "above"), "ancestors")
        step *= 2
    # A path is whole if its top message has no parent; one that ran into a cycle has more steps than messages.
    roots = known.join(nodes, ["tree", "parent"], "left_anti").select("tree", "node", F.lit(True).alias("root"))
    rooted = reached.join(roots, ["tree", "node"]).select("tree", "leaf").distinct()
    return reached.join(rooted, ["tree", "leaf"])


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best paths of each tree, formatted: ``(tree, leaf, branch, formatted, loss)``.

    ``messages (tree, node, parent, score, role, text)``. Branches are ranked by the sum of their scores (null: 0), then by leaf.
    ``loss`` has the spans of the assistant's texts: turn (from 1), first code point in ``formatted``, and the one after.
    Null roles and texts are empty.
    """
    scored = paths(messages).join(messages.drop("parent"), ["tree", "node"])
    total = scored.groupBy("tree", "leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("total"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "leaf"))
    best = total.withColumn("branch", place).where(F.col("branch") <= branches).select("tree", "leaf", "branch")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escaped_role(role), F.lit("\n"))
    turns = scored.join(best, ["tree", "leaf"]).select("tree", "leaf", "branch", "up", role.alias("role"), head.alias("head"), escaped(text).alias("body"))
    order = Window.partitionBy("tree", "leaf").orderBy(F.desc("up"))
    size = F.length("head") + F.length("body") + len(END)
    end = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))
    turns = turns.withColumn("turn", F.row_number().over(order)).withColumn("end", end)
    first = F.col("end") - len(END) - F.length("body")
    span = F.when(F.col("role") == LEARNED_ROLE, F.struct("turn", first.alias("first"), (F.col("end") - len(END)).alias("last")))
    piece = F.struct("turn", F.concat("head", "body", F.lit(END)).alias("piece"))
    out = turns.groupBy("tree", "leaf", "branch").agg(F.sort_array(F.collect_list(piece)).alias("pieces"), F.sort_array(F.collect_list(span)).alias("loss"))
    return out.select("tree", "leaf", "branch", F.concat_ws("", "pieces.piece").alias("formatted"), "loss")


def turns_of(formatted: DataFrame) -> DataFrame:
    """``(tree, leaf, turn, role, text, learned)`` read back from the formatted text and its spans."""
    pieces = formatted.select(
        "tree", "leaf", "loss", F.posexplode(F.split("formatted", r"<\|im_start\|>", -1)).alias("turn", "piece"),
    ).where("turn > 0")
    order = Window.partitionBy("tree", "leaf").orderBy("turn")
    size = F.length("piece") + len(START)
    placed = pieces.select("tree", "leaf", "turn", "piece", (F.sum(size).over(order) - F.length("piece")).alias("first"))
    spans = formatted.select("tree", "leaf", F.explode("loss").alias("span")).select("tree", "leaf", "span.turn", F.col("span.first").alias("a"), F.col("span.last").alias("b"))
    met = placed.join(spans, ["tree", "leaf", "turn"], "left")
    role = F.substring_index("piece", "\n", 1)
    start = F.length(role) + 2
    body = F.substr("piece", start, F.length("piece") - len(END) - start + 1)
    learned = F.when(F.col("a").isNotNull(), F.substr("piece", F.col("a") - F.col("first") + 1, F.col("b") - F.col("a")))
    return met.select("tree", "leaf", "turn", unescaped_role(role).alias("role"), unescaped(body).alias("text"), unescaped(learned).alias("learned"))


def by_turn(rows: DataFrame) -> DataFrame:
    """Messages of conversations given as rows by turn: each row answers the one before it.

    Rows of one conversation are ordered by turn, role and text, nulls first; rows without a conversation id make one
    conversation.
    """
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    turns = rows.select(key.alias("tree"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    numbered = turns.select("tree", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.select("tree", "node", (F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def read_back(rows: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of every conversation, from its formatted form.

    Null roles and texts are empty, repeated rows are turns each, a null ``conv_id`` is one conversation. An empty table gives
    an empty result. Other columns are not read.
    """
    formatted = stored(conversations(stored(by_turn(rows), "messages")), "formatted")
    turns = turns_of(formatted)
    said = F.struct("turn", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("said"), F.coalesce("learned", F.lit("")).alias("learned"))
    whole = turns.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(said)).alias("all"))
    whole = whole.join(formatted.select("tree", "leaf", F.length("formatted").cast("long").alias("formatted_chars")), ["tree", "leaf"])
    learned = F.concat_ws("", "all.learned")
    return whole.select(
        F.when(F.col("tree") != "null", F.col("tree")).cast("long").alias("conv_id"), "n_turns",
        F.sha2(F.concat_ws("", "all.said"), 256).alias("turns_sha256"), F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars",
    )
