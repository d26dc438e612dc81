"""Reply trees as chat transcripts, by DataFrame operations only.

Messages point to the one that they answer. Self-joins that double their reach give every message the sum of the scores up
to its root; the best leaves of each tree are chosen, and the same joins, from the longest reach to the shortest, list the
messages on their paths. So a path of n messages takes log2(n) joins, and nothing is enumerated that isn't chosen.

A turn is written as `<s>[INST] role [/INST]text</s>`. Inside roles and texts a backslash is doubled and the four control
strings get one behind their first character, so none of them is left and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import table

OPEN, CLOSE, ROLE, TEXT = "<s>", "</s>", "[INST]", "[/INST]"
LEARNT = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, CLOSE, ROLE, TEXT):
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _jumps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """For each k the messages that have one 2^k steps above them, with that one; and steps and score from each to its root.

    A message whose root is reached takes no further part, so a round costs what is still on its way.
    """
    up = messages.select("tree", "node", F.col("parent").alias("above"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps"))
    known = messages.select("tree", F.col("node").alias("above"), F.lit(True).alias("known"))
    up = up.join(known, ["tree", "above"], "left").withColumn("above", F.when(F.col("known"), F.col("above"))).drop("known")
    levels, done, count = [], None, None
    while True:
        up = table(up.select("tree", "node", "above", "total", "steps"), "jumps")
        on_its_way, ended = up.where("above is not null"), up.where("above is null")
        if on_its_way.isEmpty():
            return levels, ended if done is None else done.unionByName(ended)
        levels.append(on_its_way)
        count = messages.count() if count is None else count
        if 1 << (len(levels) - 1) > count:
            raise ValueError("replies answer each other in a circle")
        every = up if done is None else up.unionByName(done)
        done = ended if done is None else done.unionByName(ended)
        then = every.select("tree", F.col("node").alias("above"), F.col("above").alias("next"), F.col("total").alias("more"), F.col("steps").alias("on"))
        up = on_its_way.join(then, ["tree", "above"], "left").select(
            "tree", "node", F.col("next").alias("above"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), (F.col("steps") + F.coalesce("on", F.lit(0))).alias("steps")
        )


def branches(messages: DataFrame, top: int = 1) -> DataFrame:
    """The `top` root-to-leaf paths of each tree by mean score, as rows (tree, leaf, branch, depth, node); depth 0 is the root.

    messages: tree, node (unique in its tree), parent (null or unknown: a root), score. Equal scores are ranked by node.
    """
    levels, ended = _jumps(messages)
    replied = messages.select("tree", F.col("parent").alias("node")).distinct()
    leaves = ended.join(replied, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(best)).where(F.col("branch") <= top)
    path = table(chosen.select("tree", F.col("node").alias("leaf"), "branch", (F.col("steps") - 1).alias("depth"), "node"), "paths")
    for k in reversed(range(len(levels))):
        reach = levels[k].select("tree", "node", "above")
        more = path.join(reach, ["tree", "node"]).select("tree", "leaf", "branch", (F.col("depth") - (1 << k)).alias("depth"), F.col("above").alias("node"))
        # A table each time: the plan of two to the power of k joins would outgrow the driver.
        path = table(path.unionByName(more), "paths")
    return path


def transcripts(
    messages: DataFrame, tree: str, node: str, parent: str, role: str = "role", text: str = "text", score: str | None = None,
    top: int = 1, learnt: str = LEARNT,
) -> DataFrame:
    """One row for each chosen path: the tree's id, branch (1: best), n_turns, formatted, loss_spans.

    loss_spans: the code points (begin, end) of `formatted` under the loss mask, the escaped texts of role `learnt`. Null
    roles, texts and scores are '', '' and 0; a null tree is a tree too. Nodes must be unique in their tree. Other columns
    are not read.
    """
    rows = messages.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("~")).alias("tree"), F.col(tree).alias("tree_id"),
        F.col(node).alias("node"), F.col(parent).alias("parent"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        (F.lit(0.0) if score is None else F.coalesce(F.col(score).cast("double"), F.lit(0.0))).alias("score"),
    )
    rows = table(rows, "messages")
    path = branches(rows, top)
    head = F.concat(F.lit(f"{OPEN}{ROLE} "), escape(F.col("role")), F.lit(f" {TEXT}"))
    body = escape(F.col("text"))
    turns = path.join(rows.select("tree", "tree_id", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "tree_id", "leaf", "branch", "depth", "role", F.concat(head, body, F.lit(CLOSE)).alias("turn"), F.length(head).cast("long").alias("skip"), F.length(body).cast("long").alias("size")
    )
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("begin", F.coalesce(F.sum(F.length("turn").cast("long")).over(before), F.lit(0)) + F.col("skip"))
    learnt_span = F.when((F.col("role") == learnt) & (F.col("size") > 0), F.struct("begin", (F.col("begin") + F.col("size")).alias("end")))
    whole = turns.groupBy("tree", "leaf").agg(
        F.first("tree_id").alias("tree_id"), F.first("branch").alias("branch"), F.count("*").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("depth", "turn"))).alias("turns"),
        F.array_sort(F.collect_list(learnt_span)).alias("loss_spans"),
    )
    return whole.select(F.col("tree_id").alias(tree), "branch", "n_turns", F.array_join(F.col("turns.turn"), "").alias("formatted"), "loss_spans")


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    turns = F.filter(F.split(formatted, CLOSE), lambda t: t != "")
    begin = len(f"{OPEN}{ROLE} ")

    def parsed(turn):
        role = F.substring_index(turn, f" {TEXT}", 1)
        body = F.substring(turn, F.length(role) + len(f" {TEXT}") + 1, F.length(turn))
        return F.struct(unescape(F.substring(role, F.lit(begin + 1), F.length(role))).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, parsed)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask."""
    texts = F.transform(spans, lambda s: unescape(F.substring(formatted, (s["begin"] + 1).cast("int"), (s["end"] - s["begin"]).cast("int"))))
    return F.array_join(texts, "")


def as_replies(conversations: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as reply trees: each row answers the one before it by turn (then role, then text)."""
    order = Window.partitionBy(tree).orderBy(turn, role, text)
    rows = conversations.select(tree, role, text, F.row_number().over(order).cast("long").alias("node"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
