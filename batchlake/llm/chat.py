"""Reply trees to formatted conversations, with DataFrame functions only.

Messages point to the message they answer. Root-to-leaf paths are enumerated by iterative
self-joins that double their reach: a table of 2**k-th ancestors per message is joined with itself,
until no message has one; then the leaves walk up, one join per power of two, and every pair
(leaf, ancestor) appears once. So the number of joins is the logarithm of the depth. A path scores
the mean of its messages; the best branches of each tree are formatted, one conversation each.

The template marks a turn as ``### role`` (the role URL-encoded), a line end, the text, ``</turn>``
and a line end. In texts a backslash is doubled, ``</turn>`` becomes ``<\\/turn>``, and a line that begins with
``### `` begins with ``\\### `` instead. So the first ``</turn>`` ends a turn, no line inside a text looks like
the heading of one, and ``read_back`` restores every text. The loss mask is a list
of spans (code points) of the assistant's texts in the formatted conversation.

Defined results: null texts and roles count as empty. A message whose parent is missing begins a
tree; messages on a cycle, and replies to them, belong to none and are left out. Ties in rank go
to the smaller leaf id. A message id that repeats in a tree is one message (the smallest row).
Rows without a tree (a null ``conv_id``) or a message id belong to no conversation and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlake.session import materialize

TURN, END = "### ", "</turn>"
_ESCAPED_END = "<\\/turn>"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    marked = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(END), F.lit(_ESCAPED_END))
    return F.regexp_replace(marked, rf"(?<![^\n]){TURN}", rf"\\{TURN}")


def unescape(text: Column) -> Column:
    """The inverse: a backslash stands for the character after it, but in ``<\\/turn>`` for none."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as reply trees: each row answers the one before it in its conversation.
    Rows with equal turns are ordered by role, then text; all rows are kept."""
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(
        F.col(conv_id).alias("tree"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("message", F.row_number().over(order).cast("bigint"))
    return rows.select(
        "tree",
        "message",
        F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def paths(nodes: DataFrame) -> DataFrame:
    """``(tree, leaf, message, up)``: each message on a path and its distance from the leaf.

    ``nodes`` holds ``tree``, ``message``, ``parent`` (null at a root) of whole trees.
    """
    known = nodes.select("tree", "message")
    inner = nodes.where("parent IS NOT NULL").select("tree", F.col("parent").alias("message")).distinct()
    leaves = known.join(inner, ["tree", "message"], "left_anti")
    # Trees with no more messages than 2**k have no path of 2**k steps but along a cycle.
    most = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps = []
    reach = nodes.where("parent IS NOT NULL").select("tree", "message", F.col("parent").alias("far"))
    while 1 << len(jumps) <= most:
        reach = materialize(reach, "ancestors")
        if reach.isEmpty():
            break
        jumps.append(reach)
        on = reach.select("tree", F.col("message").alias("far"), F.col("far").alias("further"))
        reach = reach.join(on, ["tree", "far"]).select("tree", "message", F.col("further").alias("far"))
    walk = leaves.select("tree", F.col("message").alias("leaf"), "message", F.lit(0).cast("bigint").alias("up"))
    for k, jump in reversed(list(enumerate(jumps))):
        higher = walk.join(jump, ["tree", "message"]).select(
            "tree", "leaf", F.col("far").alias("message"), (F.col("up") + (1 << k)).alias("up")
        )
        walk = materialize(walk.unionByName(higher), "paths")
    return walk


def conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best ``branches`` paths of each tree, formatted.

    ``messages``: tree, message, parent, role, text, score. Returns ``tree``, ``leaf``, ``rank``,
    ``score``, ``turns`` (their number), ``formatted`` and ``loss`` (spans of trained text).
    """
    row = F.struct("parent", "role", "text", "score")
    rows = (
        messages.select(
            "tree", "message", "parent",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
        .where("tree IS NOT NULL AND message IS NOT NULL")
        .groupBy("tree", "message")
        .agg(F.min(row).alias("row"))
        .select("tree", "message", "row.*")
    )
    rows = materialize(rows, "messages")
    up = rows.select("tree", F.col("message").alias("parent"), F.lit(True).alias("there"))
    nodes = materialize(
        rows.select("tree", "message", "parent")
        .join(up, ["tree", "parent"], "left")
        .select("tree", "message", F.when(F.col("there"), F.col("parent")).alias("parent")),
        "nodes",
    )
    walk = paths(nodes)
    roots = nodes.where("parent IS NULL").select("tree", "message")
    whole = walk.join(roots, ["tree", "message"], "left_semi").select("tree", "leaf")
    scored = (
        walk.join(rows.select("tree", "message", F.col("score").alias("part")), ["tree", "message"])
        .groupBy("tree", "leaf")
        .agg(F.avg("part").alias("score"))
        .join(whole, ["tree", "leaf"], "left_semi")
    )
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)

    body = escape(F.col("text"))
    head = F.concat(F.lit(TURN), F.url_encode("role"), F.lit("\n"))
    path = Window.partitionBy("tree", "leaf").orderBy(F.desc("up"))
    turns = (
        walk.join(chosen, ["tree", "leaf"])
        .join(rows.select("tree", "message", "role", "text"), ["tree", "message"])
        .select(
            "tree", "leaf", "rank", "score", "up",
            (F.col("role") == ASSISTANT).alias("trained"),
            F.concat(head, body, F.lit(END + "\n")).alias("turn"),
            F.char_length(body).cast("bigint").alias("size"),
        )
        .withColumn("end", F.sum(F.char_length("turn").cast("bigint")).over(path) - len(END) - 1)
    )
    part = F.struct(
        (-F.col("up")).alias("at"), "trained", "turn", (F.col("end") - F.col("size")).alias("start"), "end"
    )
    gathered = turns.groupBy("tree", "leaf", "rank", "score").agg(
        F.array_sort(F.collect_list(part)).alias("parts")
    )
    loss = F.transform(
        F.filter("parts", lambda p: p["trained"]),
        lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")),
    )
    return gathered.select(
        "tree", "leaf", "rank", "score",
        F.size("parts").cast("bigint").alias("turns"),
        F.array_join(F.transform("parts", lambda p: p["turn"]), "").alias("formatted"),
        loss.alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    # Cut at each end mark that no backslash breaks; what follows the last one is empty.
    pieces = F.split(formatted, f"{END}\n", -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            F.url_decode(F.substring_index(F.substring(t, len(TURN) + 1, 2**31 - 1), "\n", 1)).alias("role"),
            unescape(F.substring(t, F.locate("\n", t) + 1, F.lit(2**31 - 1))).alias("text"),
        ),
    )


def trained_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(
            loss,
            lambda s: unescape(
                F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
            ),
        ),
        "",
    )
