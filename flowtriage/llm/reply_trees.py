r"""Operator 4, chat formatting of reply trees.

Messages (tree, node, parent, role, text, score) form trees.  Iterative
self-joins enumerate the root-to-leaf paths by doubling: each round joins the
known part of every path with the table of 2^k-th ancestors and the ancestor
table with itself, so a path of n messages takes log2(n) rounds and the rows
are those of the paths.  Branches are ranked by the sum of their scores (null
counts 0), then by leaf; each chosen path is one conversation.

The template writes ``<|im_start|>role\ntext<|im_end|>\n`` for each message.
Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\|`` (in
roles a line feed becomes ``\n``), which ``parse`` undoes, so a text can't end
its turn or start another.  ``loss_spans`` are the code point ranges of the
assistant's (escaped) texts.

Null texts and roles are empty.  Messages without a tree id are one tree, whose id
is null in the result; messages without a node id take no part.  A message whose parent is null or missing is a
root.  Messages whose ancestors form a circle are on no path.  Several rows
of one node are that node's largest row.  An empty table gives an empty result;
other input columns are ignored.

Scale: rounds move ids only and are cut by written tables; texts are joined
once and meet only the messages of their own conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    def part(x):
        return F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), part), "\\")


def chain(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as trees: each row answers the one before it by turn (null first), role and text."""
    order = Window.partitionBy(tree).orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first())
    n = F.row_number().over(order)
    return rows.select(
        F.col(tree).alias("tree"), n.cast("long").alias("node"), F.when(n > 1, n - 1).cast("long").alias("parent"),
        F.col(role).alias("role"), F.col(text).alias("text"), F.lit(None).cast("double").alias("score"),
    )


def paths(links: DataFrame) -> DataFrame:
    """(tree, leaf, node, up) for every message on a root-to-leaf path, ``up`` steps above the leaf, from (tree, node, parent)."""
    known = links.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    jump = links.where("parent is not null").join(known, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("above"))
    jump = materialise(jump, "tree-jump")
    parents = jump.select("tree", F.col("above").alias("node")).distinct()
    reach = links.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    reach = materialise(reach, "tree-reach")
    # a path has at most as many messages as its tree
    most = links.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    step = 1
    while step < most and jump.limit(1).count():
        up = jump.select("tree", "node", F.col("above").alias("to"))
        more = reach.join(up, ["tree", "node"]).select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        reach = materialise(reach.unionByName(more), "tree-reach")
        twice = jump.select("tree", F.col("node").alias("low"), F.col("above").alias("node")).join(up, ["tree", "node"])
        jump = materialise(twice.select("tree", F.col("low").alias("node"), F.col("to").alias("above")), "tree-jump")
        step *= 2
    roots = links.join(known.select("tree", "parent"), ["tree", "parent"], "left_anti").select("tree", "node")
    whole = reach.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf")
    return reach.join(whole, ["tree", "leaf"], "left_semi")


def format_trees(messages: DataFrame, top: int | None = None, train_role: str = "assistant") -> DataFrame:
    """(tree, leaf, branch, score, n_turns, formatted, loss_spans): the ``top`` best branches (all if None) of each tree as conversations."""
    one = F.max(F.struct("parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score")).alias("m")
    # joins need a tree that isn't null
    kind = messages.schema["tree"].dataType
    messages = messages.withColumn("tree", F.coalesce(F.concat(F.lit("1"), F.col("tree").cast("string")), F.lit("0")))
    messages = messages.where("node is not null").groupBy("tree", "node").agg(one).select("tree", "node", "m.*")
    messages = materialise(messages, "tree-messages")
    walked = paths(messages.select("tree", "node", "parent"))
    scored = walked.join(messages.select("tree", "node", "score"), ["tree", "node"])
    branches = scored.groupBy("tree", "leaf").agg(F.sum(F.coalesce("score", F.lit(0.0))).alias("score"), F.count(F.lit(1)).alias("n_turns"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
    branches = branches.withColumn("branch", rank)
    if top is not None:
        branches = branches.where(F.col("branch") <= top)
    turns = walked.join(branches.select("tree", "leaf"), ["tree", "leaf"]).join(messages.drop("score", "parent"), ["tree", "node"])
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turns = turns.select("tree", "leaf", "up", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    size = F.char_length("head") + F.char_length("body") + len(END)
    begin = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head")
    turns = turns.withColumn("begin", begin).withColumn("end", F.col("begin") + F.char_length("body"))
    piece = F.struct((-F.col("up")).alias("at"), "role", "begin", "end", F.concat("head", "body", F.lit(END)).alias("piece"))
    whole = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(piece)).alias("ps"))
    spans = F.transform(F.filter("ps", lambda p: p["role"] == train_role), lambda p: F.struct(p["begin"].alias("begin"), p["end"].alias("end")))
    formatted = F.array_join(F.transform("ps", lambda p: p["piece"]), "")
    whole = whole.select("tree", "leaf", formatted.alias("formatted"), spans.alias("loss_spans"))
    tree = F.when(F.col("tree") != "0", F.expr("substring(tree, 2)")).cast(kind).alias("tree")
    return branches.join(whole, ["tree", "leaf"]).select(tree, "leaf", "branch", "score", "n_turns", "formatted", "loss_spans")


def parse(formatted: Column) -> Column:
    """The turns (role, text) that ``formatted`` holds, unescaped."""

    def turn(x):
        role = F.substring_index(x, "\n", 1)
        at = F.char_length(role) + 1
        body = F.substring(x, at + 1, F.char_length(x) - at - len(END))
        return F.struct(unescape(role).alias("role"), unescape_text(body).alias("text"))

    parts = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def unescape_text(text: Column) -> Column:
    r"""As ``unescape``, but line feeds were left as they are: ``\\`` and ``<\|`` only."""
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), lambda x: F.replace(x, F.lit("\\|"), F.lit("|"))), "\\")


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape_text(F.substring(formatted, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
