"""Reply trees to chat training texts: enumerate, rank and format branches.

Built from joins, windows and string functions only.

A message names its parent; a root-to-leaf path is one possible conversation.
Paths are enumerated by self-joins that double their reach: after round k a
leaf knows its 2^k nearest ancestors and every node its 2^k-th ancestor, so a
thread of n turns needs about log2(n) rounds, not n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tidemark.llm.store import stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: What may follow an opening bracket to make a control string, of this
#: template or of the common instruction ones: no text may hold such a string.
_TAIL = r"(?=\||s>|/s>|INST\]|/INST\])"


def escape(text: Column) -> Column:
    r"""Put one more ``\`` after the bracket of everything that is, or escapes, a control string."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2")


def unescape(text: Column) -> Column:
    """The inverse of ``escape`` for any text."""
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2")


def root_to_leaf_paths(links: DataFrame) -> DataFrame:
    """``links`` (node, parent; unique non-null nodes) -> (leaf, node, depth).

    One row per node of each path; ``depth`` counts from the leaf (0). A
    parent that is null or not a node makes a root. Nodes on a parent cycle,
    or above which there is one, have no root; their paths are left out.
    """
    nodes = links.select(F.col("node").alias("up"))
    jump = stored(links.select("node", F.col("parent").alias("up")).join(nodes, "up", "left_semi"), "paths-jump")
    inner = jump.select(F.col("up").alias("node")).distinct()
    path = links.join(inner, "node", "left_anti").select(F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("depth"))
    limit, reach = links.count(), 1
    while reach <= limit and jump.limit(1).count():
        more = path.join(jump, "node").select("leaf", F.col("up").alias("node"), (F.col("depth") + reach).alias("depth"))
        path = stored(path.unionByName(more), "paths-rows")
        # only nodes that have an ancestor so far up stay in the table
        far = jump.select(F.col("node").alias("up"), F.col("up").alias("next"))
        jump = stored(jump.join(far, "up").select("node", F.col("next").alias("up")), "paths-jump")
        reach *= 2
    endless = jump.select(F.col("node").alias("leaf"))
    return path.join(endless, "leaf", "left_anti")


def format_paths(messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent",
                 role: str = "role", text: str = "text", score: str | None = None, branches: int = 1,
                 learn_role: str = "assistant") -> DataFrame:
    """(tree, leaf, score, rank, n_turns, formatted, segments): the best branches of each tree.

    A branch's score is the sum of its messages' scores (null: 0); branches of
    one tree are ranked by score, then length, then leaf, and the first
    ``branches`` are formatted, root first. ``segments`` are the consecutive
    pieces (text, loss) of ``formatted``; ``loss`` marks what is trained on:
    each text of ``learn_role`` and nothing else.

    A formatted conversation is one value, so the turns of one chosen path
    meet in one task; everything before that works on single rows.

    Defined cases: null role or text counts as empty; rows with a null node
    are ignored, rows that repeat a node count once (the smallest by tree,
    parent, role, text); an empty table gives no rows. Texts of any length are
    formatted whole. Only the named columns are read, whatever others are called.
    """
    msgs = messages.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(F.struct(
        F.col(tree).alias("tree"), F.col(parent).alias("parent"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)).alias("score"))).alias("m"))
    msgs = stored(msgs.select("node", "m.*"), "chat-messages")
    path = root_to_leaf_paths(msgs.select("node", "parent"))
    scored = path.join(msgs.select("node", "score"), "node").groupBy("leaf").agg(
        F.sum("score").alias("score"), F.count("*").alias("n_turns"))
    branch = scored.join(msgs.select(F.col("node").alias("leaf"), "tree"), "leaf")
    best = W.Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("n_turns"), "leaf")
    branch = branch.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    turns = path.join(branch.select("leaf"), "leaf", "left_semi").join(msgs.select("node", "role", "text"), "node")
    piece = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
    per_turn = F.array(
        piece(F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)), F.lit(False)),
        piece(escape(F.col("text")), F.col("role") == learn_role),
        piece(F.lit(END), F.lit(False)))
    whole = turns.groupBy("leaf").agg(F.sort_array(
        F.collect_list(F.struct((-F.col("depth")).alias("at"), per_turn.alias("pieces")))).alias("turns"))
    whole = whole.select("leaf", F.flatten("turns.pieces").alias("segments"))
    return branch.join(whole, "leaf").select(
        "tree", "leaf", "score", "rank", "n_turns", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted conversation holds."""
    turns = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda t: t != "")
    halves = lambda t: F.split(t, r"<\|text\|>")
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring(halves(t)[0], len(TURN) + 1, 1 << 30)).alias("role"), unescape(halves(t)[1]).alias("text")))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    kept = F.filter(segments, lambda p: p.loss)
    return F.array_join(F.transform(kept, lambda p: unescape(p.text)), "")


def chain(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees (tree, node, parent, role, text): each turn replies to the one before.

    Turns order by ``turn``, then role, then text; nulls first. Rows with a null
    ``conv`` form one conversation.
    """
    order = W.Window.partitionBy(conv).orderBy(turn, role, text)
    at = F.row_number().over(order).cast("bigint")
    return conversations.select(F.col(conv).alias("tree"), at.alias("at"), role, text).select(
        "tree", F.struct("tree", "at").alias("node"),
        F.when(F.col("at") > 1, F.struct("tree", (F.col("at") - 1).alias("at"))).alias("parent"),
        F.col(role).alias("role"), F.col(text).alias("text"))
