"""Reply trees into conversations: paths by self-joins, ranked branches, a reversible template.

``reply_paths`` lists the nodes on the way from every leaf to its root by
pointer doubling: each round joins the paths with jumps twice as long, so a
thread of n turns takes log2(n) rounds, and only ids move. ``format_paths``
ranks the branches of a tree by their summed score and writes each chosen one
as a conversation with its loss mask.

Defined results: a null text or role counts as empty, a null score as 0. A
node without parent, with itself or an unknown node as parent is a root. Of rows that repeat
a node id, the smallest (parent, role, text, score) stays. Nodes whose parents
run in a circle belong to no conversation. Ties in score rank by leaf id.
Texts of any length are formatted whole, and a path weighs as much as all its
messages. Other columns of the input are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import equi, ranked
from chorale.session import materialize

# The template's own marks, and the other strings kept out of texts.
START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
# A character after which a guarded string could go on: a backslash parts them.
GUARDED = r"<(?=\||/?s>|/?<SYS>>|</SYS>>)|\[(?=/?INST\])|\|(?=>)"


def escape(text: Column) -> Column:
    """Text in which no control string is left; ``unescape`` gives the text back."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), GUARDED, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def reply_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, node, up) for every node between a leaf (up = 0) and its root.

    ``nodes`` has tree, node and parent; node ids are unique inside a tree.
    """
    nodes = materialize(nodes.select("tree", "node", "parent"), "nodes")
    known = nodes.select("tree", F.col("node").alias("parent"))
    links = equi(nodes.filter("parent IS NOT NULL AND NOT parent <=> node"), known, ["tree", "parent"])
    links = materialize(links.select("tree", "node", F.col("parent").alias("to")), "links")
    has_child = links.select("tree", F.col("to").alias("node")).distinct()
    leaves = equi(nodes, has_child, ["tree", "node"], "left_anti")
    # The union of all rounds is read from the tables written so far.
    start = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    paths = materialize(start, "paths")
    sizes = nodes.groupBy("tree").count()
    longest = sizes.agg(F.max("count")).first()[0] or 0
    jumps, step = links, 1
    while step < longest and not jumps.isEmpty():
        longer = equi(paths, jumps, ["tree", "node"])
        longer = longer.select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + step).alias("up"))
        paths = paths.unionByName(materialize(longer, "paths"))
        second = jumps.select("tree", F.col("node").alias("to"), F.col("to").alias("to2"))
        doubled = equi(jumps, second, ["tree", "to"]).select("tree", "node", F.col("to2").alias("to"))
        jumps, step = materialize(doubled, "jumps"), step * 2
    if step >= longest and not jumps.isEmpty():
        # Steps as many as a tree has nodes, and still under way: circles. Keep what reaches a root.
        roots = equi(nodes, links.select("tree", "node"), ["tree", "node"], "left_anti").select("tree", "node")
        rooted = equi(paths, roots, ["tree", "node"], "left_semi").select("tree", "leaf").distinct()
        paths = equi(paths, rooted, ["tree", "leaf"], "left_semi")
    return paths


def format_paths(messages: DataFrame, top: int | None = None, train_role: str = "assistant") -> DataFrame:
    """One row per chosen branch: tree, leaf, score, rank, n_turns, formatted, loss_spans.

    ``messages`` has tree, node, parent, role, text, score. ``top`` branches of
    each tree are chosen (None: all). ``loss_spans`` are (start, length) in code
    points of ``formatted``, one for each turn of ``train_role``.
    """
    blank = F.lit("")
    clean = (
        messages.groupBy("tree", "node")
        .agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
        .select(
            "tree",
            "node",
            "m.parent",
            F.coalesce("m.role", blank).alias("role"),
            F.coalesce("m.text", blank).alias("text"),
            F.coalesce(F.col("m.score").cast("double"), F.lit(0.0)).alias("score"),
        )
    )
    clean = materialize(clean, "messages")
    paths = reply_paths(clean)
    scored = equi(paths, clean.select("tree", "node", "score"), ["tree", "node"])
    # Whole tenths of a millionth, so that the order of adding cannot change a rank.
    score = (F.sum(F.round(F.col("score") * 1e7).cast("decimal(38,0)")) / F.lit(1e7)).alias("score")
    branches = scored.groupBy("tree", "leaf").agg(score)
    branches = ranked(branches, ["tree"], [F.col("score").desc(), F.col("leaf").asc()], "branches")
    if top is not None:
        branches = branches.filter(F.col("rank") < top)
    turns = equi(equi(paths, branches, ["tree", "leaf"]), clean.select("tree", "node", "role", "text"), ["tree", "node"])
    turn = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    parts = turns.select(
        "tree", "leaf", "score", "rank", (-F.col("up")).alias("at"), turn.alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == train_role).alias("loss"),
    )
    listed = parts.groupBy("tree", "leaf", "score", "rank").agg(
        F.sort_array(F.collect_list(F.struct("at", "head", "body", "loss"))).alias("turns")
    )
    formatted = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))))
    # A running end of the text so far gives each trained turn its span.
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["end"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("end"),
            F.when(
                t["loss"],
                F.concat(
                    s["spans"],
                    F.array(
                        F.struct((s["end"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))
                    ),
                ),
            ).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return listed.select(
        "tree", "leaf", "score", "rank", F.size("turns").alias("n_turns"),
        formatted.alias("formatted"), spans.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    marked = F.slice(F.split(formatted, r"<\|end\|>"), 1, F.size(F.split(formatted, r"<\|end\|>")) - 1)

    def one(turn: Column) -> Column:
        halves = F.split(turn, r"<\|sep\|>", 2)
        role = F.substring(halves[0], len(START) + 1, 2**31 - 1)
        return F.struct(unescape(role).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(marked, one)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))))
