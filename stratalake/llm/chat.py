"""Chat formatting of reply trees (operator 1), in DataFrame operations only.

Messages form trees by ``parent_id``.  Ancestor pointers are doubled by
iterative self-joins, so a tree of depth d takes log2(d) rounds; a second
series of self-joins walks the chosen leaves up with those pointers, every
(leaf, ancestor) pair made once.  Branches are ranked by the mean score of
their messages and each chosen root-to-leaf path becomes one conversation.

Template: ``<s>[INST]role[/INST]text</s>`` for each turn.  The control strings
all hold ``<`` or ``[``, so inside roles and texts each of ``\\``, ``<`` and
``[`` is followed by one more backslash; no control string survives there and
``unescape`` restores every text.

Defined results: a null text or role is empty; a null conversation id is a
conversation of its own; turns that share a number, repeated rows included,
stay separate and are ordered by role, then text; a null turn comes first; a
parent that does not exist makes its message a root; messages on a cycle have
no root and belong to no path; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, prepare

TURN_START, ROLE_START, ROLE_END, TURN_END = "<s>", "[INST]", "[/INST]", "</s>"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def reply_paths(messages: DataFrame, paths_per_tree: int | None = 1) -> DataFrame:
    """Root-to-leaf paths of reply trees.

    ``messages``: message_id string (unique), parent_id string, score double.
    Returns (path_id, message_id, depth, rank): the leaf names the path, depth
    is 0 at the root, rank 1 is the tree's branch of highest mean score (ties:
    smaller leaf id).  ``paths_per_tree`` is the number of branches to format
    (the feature's top-k); None keeps all.
    """
    prepare(messages.sparkSession)
    ids = messages.select(F.col("message_id").alias("__known"))
    nodes = materialize(
        messages.select("message_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
        .join(ids, F.col("parent_id") == F.col("__known"), "left")
        .select("message_id", F.col("__known").alias("up"), "score"), "chat-nodes")
    leaves = nodes.join(nodes.select(F.col("up").alias("message_id")).distinct(), "message_id", "left_anti")
    # pointers[k]: each message's ancestor 2^k above, where there is one; only a cycle's outlast the messages
    pointers, up, n = [], nodes.where("up is not null").select("message_id", "up"), nodes.count()
    while (1 << len(pointers)) < n and not up.isEmpty():
        pointers.append(up)
        above = up.select(F.col("message_id").alias("up"), F.col("up").alias("__up2"))
        up = materialize(up.join(above, "up").select("message_id", F.col("__up2").alias("up")), "chat-up")
    walk = leaves.select(F.col("message_id").alias("path_id"), "message_id", F.lit(0).cast("long").alias("above"))
    for k, up in enumerate(pointers):
        step = (walk.join(up, "message_id")
                .select("path_id", F.col("up").alias("message_id"), (F.col("above") + (1 << k)).alias("above")))
        walk = materialize(walk.unionByName(step), "chat-walk")
    walk = walk.join(nodes.select("message_id", "score"), "message_id")
    ranked = walk.groupBy("path_id").agg(F.max_by("message_id", "above").alias("__root"),
                                         F.max("above").alias("__depth"), F.avg("score").alias("__mean"))
    ranked = ranked.withColumn("rank", F.row_number().over(
        Window.partitionBy("__root").orderBy(F.desc("__mean"), "path_id")))
    if paths_per_tree is not None:
        ranked = ranked.where(F.col("rank") <= paths_per_tree)
    return (walk.join(ranked.select("path_id", "__depth", "rank"), "path_id")
            .select("path_id", "message_id", (F.col("__depth") - F.col("above")).alias("depth"), "rank"))


def format_paths(paths: DataFrame, messages: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """One conversation per path: (path_id, rank, segments, formatted).

    ``segments`` cut ``formatted`` into pieces of (text, loss); the loss mask
    covers exactly the texts of the learned role, still escaped.
    """
    turn = F.struct(
        "depth",
        F.concat(F.lit(TURN_START + ROLE_START), escape(F.coalesce("role", F.lit(""))), F.lit(ROLE_END))
        .alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
        (F.coalesce(F.col("role"), F.lit("")) == learned_role).alias("loss"))
    turns = F.sort_array(F.collect_list(turn))
    segments = F.flatten(F.transform("__turns", lambda t: F.array(
        F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
        F.struct(t["body"].alias("text"), t["loss"].alias("loss")),
        F.struct(F.lit(TURN_END).alias("text"), F.lit(False).alias("loss")))))
    return (paths.join(messages.select("message_id", "role", "text"), "message_id")
            .groupBy("path_id", "rank").agg(turns.alias("__turns"))
            .withColumn("segments", segments)
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
            .drop("__turns"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a formatted conversation."""
    pieces = F.split(formatted, TURN_END)
    pieces = F.filter(pieces, lambda p: p != "")
    skip = len(TURN_START + ROLE_START) + 1

    def parts(p):
        cut = F.split(p, r"\[/INST\]", 2)
        return F.struct(unescape(F.substring(cut[0], skip, 1 << 30)).alias("role"), unescape(cut[1]).alias("text"))

    return F.transform(pieces, parts)


def read_learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply chains."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return (conversations.select("conv_id", "turn", "role", "text")
            .withColumn("__pos", F.row_number().over(order))
            .select("conv_id", F.concat_ws("/", conv, F.col("__pos")).alias("message_id"),
                    F.when(F.col("__pos") > 1, F.concat_ws("/", conv, F.col("__pos") - 1)).alias("parent_id"),
                    F.lit(0.0).alias("score"), "role", "text"))


def format_conversations(conversations: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """Every conversation as one formatted path: (conv_id, segments, formatted)."""
    prepare(conversations.sparkSession)
    messages = materialize(conversation_messages(conversations), "chat-messages")
    paths = reply_paths(messages.select("message_id", "parent_id", "score"), None)
    done = format_paths(paths, messages, learned_role)
    names = messages.where("parent_id is null").select("conv_id", "message_id")
    roots = F.regexp_replace("path_id", "/[0-9]+$", "/1")
    return (done.withColumn("message_id", roots).join(names, "message_id")
            .select("conv_id", "segments", "formatted"))
