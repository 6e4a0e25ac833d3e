"""Chat formatting of reply trees, with DataFrame functions only.

A message names the message it replies to.  Ancestor tables by doubling (one
self-join a round, so as many as the depth has binary digits) sum scores along
root-to-leaf paths; the paths of a tree are ranked, and the chosen ones unfold
from their leaves by the same tables.  Table k holds only messages that have an
ancestor 2^k above, so that rounds shrink with the number of deep messages.  No
path's text is ever built that isn't chosen, and the work is linear in messages
and depth's logarithm.

The template writes a turn as

    <s>role\\ntext</s>

and escapes what could be mistaken for its own or other templates' control
strings inside a role or a text: a backslash is doubled, and each control
string gets a backslash after its first character.  Undoing it takes off one
backslash of each pair or single one.  A line break inside a role reads back as
the end of the role, the rest as the text's beginning; no character is lost.

Messages without a conv_id make up one conversation of their own, whose conv_id
comes out null.  In here a conversation's key is ``lost`` (whether its conv_id
is null) and ``conv``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.shared import stage

#: Control strings, as a pattern behind their first character.
CONTROL = r"([<\[])(?=/?s>|/?INST\]|</?SYS>>|/?SYS\]|\|[A-Za-z0-9_]+\|>)"
OPEN, CLOSE = "<s>", "</s>"
PLAIN_ROLE = ("assistant",)


def escaped(text: F.Column) -> F.Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1\\")


def unescaped(text: F.Column) -> F.Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def chain(messages: DataFrame) -> DataFrame:
    """Makes flat conversations into reply trees without branches: each row replies to the one before it.

    Rows are ordered by turn, then role, then text (nulls first); equal rows
    count as often as they come.  Node numbers are (conv_id, place).
    """
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return messages.select("conv_id", place.alias("node"), "role", "text").select("conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


KEY = ("lost", "conv")


def keyed(messages: DataFrame) -> DataFrame:
    known = F.col("conv_id").cast("long")
    return messages.withColumns({"lost": known.isNull(), "conv": F.coalesce(known, F.lit(0))})


def once(messages: DataFrame) -> DataFrame:
    """One row for each node: of several the first by parent, score, role and text, nulls first.  Rows without a node are no messages."""
    first = F.row_number().over(Window.partitionBy(*KEY, "node").orderBy("parent", "score", "role", "text"))
    return messages.where(F.col("node").isNotNull()).withColumn("_first", first).where("_first = 1").drop("_first")


def ancestors(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame | None]:
    """``lost, conv, node, up, total, low`` by powers of two: who is 2^k above, the score from there (exclusive) down to the node, and the smallest node from there up to the node (exclusive).

    A tree has ``most`` nodes at most.  Who still has an ancestor as far above
    hangs on a circle; the table of these comes second.
    """
    tables = [stage(nodes.where(F.col("parent").isNotNull()).select(*KEY, "node", F.col("parent").alias("up"), F.col("score").alias("total"), F.col("parent").alias("low")), "up")]
    while not tables[-1].isEmpty():
        last = tables[-1]
        if 1 << (len(tables) - 1) >= most:
            return tables, last
        above = last.select(*KEY, F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("low").alias("lower"))
        longer = last.join(above, [*KEY, "up"]).select(*KEY, "node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total"), F.least("low", "lower").alias("low"))
        tables.append(stage(longer, "up"))
    return tables[:-1], None


def grounded(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``lost, conv, node, parent, score`` without circles, and its ancestor tables.

    A parent that is missing makes its message a root, and so does a reply to
    itself.  Of messages that reply to each other in a circle the one with the
    smallest node becomes a root.
    """
    own = messages.select(*KEY, "node", F.when(F.col("parent") != F.col("node"), F.col("parent")).alias("parent"), F.coalesce("score", F.lit(0.0)).alias("score"))
    known = own.select(*KEY, F.col("node").alias("parent"), F.lit(True).alias("known"))
    nodes = stage(own.join(known, [*KEY, "parent"], "left").select(*KEY, "node", F.when(F.col("known"), F.col("parent")).alias("parent"), "score"), "nodes")
    most = nodes.groupBy(*KEY).count().agg(F.max("count").alias("n")).first().n or 1
    tables, rest = ancestors(nodes, most)
    if rest is not None:
        # So far above, only circles are left; their members are who stands there.
        circle = rest.select(*KEY, F.col("up").alias("node")).distinct()
        cut = stage(rest.join(circle, [*KEY, "node"], "left_semi").where(F.col("low") == F.col("node")).select(*KEY, "node", F.lit(True).alias("cut")), "cut")
        nodes = stage(nodes.join(cut, [*KEY, "node"], "left").select(*KEY, "node", F.when(F.col("cut").isNull(), F.col("parent")).alias("parent"), "score"), "nodes")
        tables, _ = ancestors(nodes, most)
    return nodes, tables


def chosen_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """``lost, conv, path, node, depth``: the ``keep`` best root-to-leaf paths of each tree, from the root (depth 0) on.

    ``messages``: lost, conv, node, parent (null at a root), score (null: 0),
    each node once.  A path's score is the sum of its messages'; ties go to the
    smaller leaf.  See :func:`grounded` for parents that are missing or lead in
    a circle.
    """
    nodes, tables = grounded(messages)
    inner = nodes.where(F.col("parent").isNotNull()).select(*KEY, F.col("parent").alias("node")).distinct()
    state = nodes.join(inner, [*KEY, "node"], "left_anti").select(*KEY, F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0.0).alias("total"), F.lit(0).alias("depth"))
    for k in range(len(tables) - 1, -1, -1):  # from the largest leap down, as far as the root allows
        leap = tables[k].select(*KEY, F.col("node").alias("at"), "up", F.col("total").alias("more"))
        state = state.join(leap, [*KEY, "at"], "left").select(*KEY, "leaf", F.coalesce("up", "at").alias("at"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), (F.col("depth") + F.when(F.col("up").isNotNull(), 1 << k).otherwise(0)).alias("depth"))
    top = nodes.select(*KEY, F.col("node").alias("at"), F.col("score").alias("own"))
    leaves = state.join(top, [*KEY, "at"]).withColumn("total", F.col("total") + F.col("own"))
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("total"), "leaf"))
    paths = stage(leaves.withColumn("path", rank).where(F.col("path") <= keep).select(*KEY, "path", F.col("leaf").alias("node"), "depth"), "paths")
    for k, table in enumerate(tables):
        leap = table.select(*KEY, "node", "up")
        above = stage(paths.join(leap, [*KEY, "node"]).select(*KEY, "path", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth")), "paths")
        paths = paths.unionAll(above)  # who stands 2^k above; each table's rows come once
    return paths


def formatted(messages: DataFrame, keep: int = 1, unique: bool = False) -> DataFrame:
    """``conv_id, path, formatted, loss_runs`` of each chosen path.

    ``messages``: conv_id, node, parent, role, text, score; more columns do no
    harm.  ``loss_runs`` has a (skip, take, rest) for each turn, in code points
    of ``formatted``, which they cover without gaps: ``take`` characters of each
    are under the loss mask, the texts of assistant turns.  Null roles and texts
    count as empty, null conv_ids as one conversation; an empty table gives no
    rows.  Of several rows with one node one counts (see :func:`once`), which
    ``unique`` says there are none of.  A path is one row, so one conversation's
    text (not its tree) must fit a row.
    """
    own = keyed(messages.select("conv_id", "node", "parent", "role", "text", "score"))
    own = own if unique else once(own)
    role, text = (escaped(F.coalesce(c, F.lit(""))) for c in ("role", "text"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    turn = own.select(*KEY, "node", F.concat(head, text, F.lit(CLOSE)).alias("turn"), F.length(head).alias("head"), F.length(text).alias("body"), F.coalesce(F.col("role").isin(*PLAIN_ROLE), F.lit(False)).alias("learnt"))
    chosen = chosen_paths(own, keep).join(turn, [*KEY, "node"])
    run = F.struct(
        F.when(F.col("learnt"), F.col("head")).otherwise(F.length("turn")).alias("skip"),
        F.when(F.col("learnt"), F.col("body")).otherwise(0).alias("take"),
        F.when(F.col("learnt"), F.lit(len(CLOSE))).otherwise(0).alias("rest"),
    )
    turns = F.sort_array(F.collect_list(F.struct("depth", "turn", run.alias("run"))))
    whole = chosen.groupBy(*KEY, "path").agg(turns.alias("turns"))
    return whole.select(F.when(~F.col("lost"), F.col("conv")).alias("conv_id"), "path", F.array_join(F.col("turns.turn"), "").alias("formatted"), F.col("turns.run").alias("loss_runs"))


def read_back(chats: DataFrame) -> DataFrame:
    """``conv_id, path, turns (role, text), learnt (texts under the mask)`` parsed from ``formatted`` and ``loss_runs``."""
    pieces = F.slice(F.split("formatted", CLOSE, -1), 1, F.size("loss_runs"))
    bare = F.transform(pieces, lambda p: F.substring(p, len(OPEN) + 1, 1 << 30))
    turns = F.transform(bare, lambda p: F.struct(unescaped(F.substring_index(p, "\n", 1)).alias("role"), unescaped(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + F.lit(2))).alias("text")))
    learnt = F.transform(F.arrays_zip(pieces.alias("piece"), F.col("loss_runs").alias("run")), lambda z: unescaped(F.substr(z["piece"], z["run"]["skip"] + F.lit(1), z["run"]["take"])))
    return chats.select("conv_id", "path", "formatted", turns.alias("turns"), learnt.alias("learnt"))


def digests(chats: DataFrame) -> DataFrame:
    """What was read back, as counts and digests."""
    own = read_back(chats)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return own.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
