"""Chat formatting of reply trees.

A message points to the one it answers.  Self-joins double the reach of each message's
ancestor pointer (1, 2, 4, ... messages up) and sum the scores on the way, until all have
reached their root: as many joins as the depth of the deepest tree has bits.  Leaves are
ranked by the score of their branch; the same pointers, from the longest to the shortest,
then gather all messages of each chosen path, and each path is formatted as one
conversation.

A turn is written ``### role: text</turn>`` and a line break.  Inside roles and texts
``\\``, ``#`` and ``<`` (and ``:`` in roles) are written ``\\b``, ``\\h``, ``\\l``
(``\\c``), so that no text can hold a mark, and ``turns`` reads back what was written.
``loss_spans`` are the places (start from 0, length; code points) of the assistant's
texts in the formatted conversation.

Null roles and texts are empty, a null score is nought.  A message whose parent is null
or absent is a root.  Of messages with the same id in a tree the one with the greatest
(score, role, text) counts.  Messages on a cycle or below one reach no root and are in no
path.  Equal branches rank by depth (deeper first), then by the least leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from graphtide.llm.common import named, stored

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_MARKS = (("#", "\\h"), ("<", "\\l"))


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for plain, mark in (*_MARKS, *([(":", "\\c")] if role else [])):
        out = F.replace(out, F.lit(plain), F.lit(mark))
    return out


def unescape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\c"), F.lit(":"))
    for plain, mark in _MARKS:
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    whole = F.split(formatted, CLOSE, -1)

    def turn(x: Column) -> Column:
        body = F.substr(x, F.lit(len(OPEN) + 1))
        at = F.instr(body, MIDDLE)
        return F.struct(unescape(F.substr(body, F.lit(1), at - 1)).alias("role"), unescape(F.substr(body, at + len(MIDDLE))).alias("text"))

    return F.transform(F.slice(whole, 1, F.size(whole) - 1), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))), "")


def _pointers(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestor pointers (key, node, up) of 1, 2, 4, ... messages, and (key, node, total, depth) of those that reach a root."""
    here = nodes.select("key", F.col("node").alias("parent"), F.col("node").alias("up"))
    linked = nodes.join(here, ["key", "parent"], "left")
    now = stored(linked.select("key", "node", "up", F.col("score").alias("total"), F.lit(1).cast("bigint").alias("depth")), "chat-up-0")
    most = nodes.groupBy("key").agg(F.count("*").alias("n")).agg(F.max("n")).head()[0] or 0
    levels = [now]
    # A path longer than its tree is a cycle.
    while 1 << (len(levels) - 1) <= most and not now.where("up is not null").isEmpty():
        further = now.select("key", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("depth").alias("depth2"))
        open_ = now.where("up is not null").join(further, ["key", "up"]).select("key", "node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("depth") + F.col("depth2")).alias("depth"))
        now = stored(now.where("up is null").unionByName(open_), f"chat-up-{len(levels)}")
        levels.append(now)
    return levels, now.where("up is null").select("key", "node", "total", "depth")


def format_trees(
    messages: DataFrame, *, tree: str, node: str, parent: str, role: str = "role", text: str = "text", score: str | None = None,
    branches: int = 1, learned_role: str = "assistant",
) -> DataFrame:
    """The ``branches`` best paths of each tree: (tree, leaf, branch_score, n_turns, formatted, loss_spans)."""
    key = F.when(named(tree).isNull(), "").otherwise(F.concat(F.lit("="), named(tree).cast("string")))
    own = F.coalesce(named(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    said = messages.where(named(node).isNotNull()).select(
        key.alias("key"), named(tree).alias("tree"), named(node).alias("node"), named(parent).alias("parent"),
        F.coalesce(named(role).cast("string"), F.lit("")).alias("role"), F.coalesce(named(text).cast("string"), F.lit("")).alias("text"), own.alias("score"))
    said = said.groupBy("key", "node").agg(F.max(F.struct("score", "role", "text", "parent", "tree")).alias("m")).select("key", "node", "m.*")
    said = stored(said, "chat-messages")

    levels, rooted = _pointers(said.select("key", "node", "parent", "score"))
    answered = levels[0].where("up is not null").select("key", F.col("up").alias("node")).distinct()
    leaves = rooted.join(answered, ["key", "node"], "left_anti")
    best = Window.partitionBy("key").orderBy(F.desc("total"), F.desc("depth"), "node")
    chosen = stored(leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= branches).select("key", "total", "depth", F.col("node").alias("leaf")), "chat-leaves")

    path = chosen.select("key", "leaf", F.col("leaf").alias("node"), F.col("depth").alias("place"))
    for number in range(len(levels) - 1, -1, -1):
        up = levels[number].where("up is not null").select("key", "node", "up")
        above = path.join(up, ["key", "node"]).select("key", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << number)).alias("place"))
        path = stored(path.unionByName(above), f"chat-path-{number}")

    rows = path.join(said.select("key", "node", "tree", "role", "text"), ["key", "node"])
    head, body = F.concat(F.lit(OPEN), escape(F.col("role"), role=True), F.lit(MIDDLE)), escape(F.col("text"))
    rows = rows.select("key", "leaf", "tree", "place", "role", F.length(head).alias("head"), F.length(body).alias("body"), F.concat(head, body, F.lit(CLOSE)).alias("piece"))
    before = F.sum(F.length("piece")).over(Window.partitionBy("key", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("start", (F.coalesce(before, F.lit(0)) + F.col("head")).cast("int"))
    one = rows.groupBy("key", "leaf", "tree").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "start", "body", "role"))).alias("t"))
    one = one.join(chosen.select("key", "leaf", "total"), ["key", "leaf"])
    learned = F.filter("t", lambda x: x["role"] == learned_role)
    return one.select(
        F.col("tree").alias(tree), "leaf", F.col("total").alias("branch_score"), F.size("t").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(learned, lambda x: F.struct(x["start"].alias("start"), x["body"].alias("length"))).alias("loss_spans"))


def format_conversations(rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations whose rows answer each other in the order of (turn, role, text): trees of one branch."""
    number = F.row_number().over(Window.partitionBy(named(conv)).orderBy(named(turn), named(role), named(text)))
    linked = rows.select(named(conv), named(role), named(text), number.alias("␟node"))
    linked = linked.withColumn("␟parent", F.when(F.col("␟node") > 1, F.col("␟node") - 1))
    return format_trees(linked, tree=conv, node="␟node", parent="␟parent", role=role, text=text)
