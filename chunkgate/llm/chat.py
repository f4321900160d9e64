"""Reply trees to formatted conversations.

``root_paths`` finds all ancestors of every leaf by self-joins that double the distance each round,
so a thread of n replies takes log2(n) rounds. ``best_paths`` ranks the branches of a tree by score,
``format_paths`` writes each chosen path as one text with the spans that a model learns from.

Template: ``<|turn|>role LF text<|end|>`` for each turn. Inside roles and texts a backslash is
doubled and each control string, of this template or of other common ones, is broken by ``\\~`` after
its first character; in roles a line feed becomes ``\\n``. ``read_turns`` undoes all of it.

Defined results: rows with a null tree form a tree of their own; a row without parent, or whose
parent is not there, is a root. Of rows with one (tree, node) each is kept as a reply of its own if
``linear_replies`` numbered them; ``root_paths`` itself asks for unique nodes. Rows on a cycle, and
below one, belong to no path. Null roles and texts are empty. Extra columns are ignored. Empty tables
give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkgate.sources.tables import stored

TURN, END = "<|turn|>", "<|end|>"
#: The first character of a string that steers a model in this or another common template. Fixed values.
CONTROL = r"(<)(?=\|[A-Za-z_]+\|>|/?s>|</?SYS>>|/?(?:unk|pad|bos|eos)>)|(\[)(?=/?INST\])"
LEARNED_ROLE = "assistant"


def linear_replies(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns as a tree without branches: node is the place in the conversation, parent the one before.

    Turns with one number follow each other by role and text; null numbers come first.
    """
    order = Window.partitionBy(conversation).orderBy(turn, "role", "text")
    rows = turns.select(F.col(conversation).cast("long").alias("tree"), F.row_number().over(order).cast("long").alias("node"), "role", "text")
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def root_paths(replies: DataFrame) -> DataFrame:
    """tree, leaf, node, height: every node on the path from each leaf up to its root; height 0 is the leaf.

    ``replies`` has tree, node, parent. Round k adds the ancestors at heights 2**k to 2**(k+1) - 1
    and squares the step, until no node has an ancestor so far away.
    """
    links = stored(replies.select(F.coalesce(F.col("tree"), F.lit(-(1 << 62))).alias("tree"), "node", "parent"), "replies")
    parents = links.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    up = stored(links.where("parent is not null").join(links.select("tree", F.col("node").alias("parent")), ["tree", "parent"], "left_semi").select("tree", "node", F.col("parent").alias("above")), "up")
    paths = stored(links.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height")), "paths")
    n, step = links.count(), 1
    while step <= n and not up.isEmpty():
        far = paths.join(up, ["tree", "node"]).select("tree", "leaf", F.col("above").alias("node"), (F.col("height") + step).alias("height"))
        paths = stored(paths.unionByName(far), "paths")
        further = up.select("tree", F.col("node").alias("above"), F.col("above").alias("top"))
        up = stored(up.join(further, ["tree", "above"]).select("tree", "node", F.col("top").alias("above")), "up")
        step *= 2
    if step > n and not up.isEmpty():  # only cycles go on for ever
        endless = up.select("tree", F.col("node").alias("leaf")).distinct()
        paths = paths.join(endless, ["tree", "leaf"], "left_anti")
    return paths


def best_paths(paths: DataFrame, replies: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` branches of each tree with the highest mean score (ties: the smaller leaf), one row for each turn."""
    keyed = replies.withColumn("tree", F.coalesce(F.col("tree"), F.lit(-(1 << 62))))
    scored = paths.join(keyed.select("tree", "node", F.coalesce("score", F.lit(0.0)).alias("score")), ["tree", "node"])
    branches = scored.groupBy("tree", "leaf").agg(F.avg("score").alias("branch_score"), F.max("height").alias("top"))
    by_score = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    chosen = branches.withColumn("branch_rank", F.row_number().over(by_score)).where(F.col("branch_rank") <= keep)
    return (
        paths.join(chosen, ["tree", "leaf"]).join(keyed.select("tree", "node", "role", "text"), ["tree", "node"])
        .select(
            F.when(F.col("tree") != F.lit(-(1 << 62)), F.col("tree")).alias("tree"), "leaf", "branch_rank", "branch_score",
            (F.col("top") - F.col("height")).alias("place"), "role", "text",
        )
    )


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1$2\\~")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"~": "", "n": "\n"}.get(m[1], m[1]), text, flags=re.S)


def format_paths(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """tree, leaf, branch_rank, n_turns, formatted, loss_spans: one text for each path.

    ``loss_spans`` are the (begin, end) code points of the texts that the learned role says.
    """
    head = F.concat(F.lit(TURN), F.regexp_replace(escape(F.col("role")), "\n", r"\\n"), F.lit("\n"))
    rows = turns.select("tree", "leaf", "branch_rank", "place", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == learned_role).alias("learned"))
    path = Window.partitionBy("tree", "leaf").orderBy("place")
    whole = F.length("head") + F.length("body") + len(END)
    rows = rows.withColumn("begin", F.coalesce(F.sum(whole).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head"))
    rows = rows.withColumn("span", F.when(F.col("learned"), F.struct("begin", (F.col("begin") + F.length("body")).alias("end"))))
    piece = F.struct("place", F.concat("head", "body", F.lit(END)).alias("text"))
    return rows.groupBy("tree", "leaf", F.col("branch_rank")).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.concat_ws("", F.transform(F.sort_array(F.collect_list(piece)), lambda x: x["text"])).alias("formatted"),
        F.sort_array(F.collect_list("span")).alias("loss_spans"),
    )


_TURN = re.compile(re.escape(TURN) + r"(.*?)\n(.*?)" + re.escape(END), re.S)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts that a formatted text was made of."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted texts: tree, n_turns, digests of the turns and of what is learned."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tree, text, spans in zip(batch["tree"], batch["formatted"], batch["loss_spans"]):
                turns = read_turns(text)
                said = hashlib.sha256()
                for role, own in turns:
                    said.update(f"{role}\n{own}\n".encode())
                learned = "".join(unescape(text[s["begin"] : s["end"]]) for s in spans)
                out.append((None if pd.isna(tree) else int(tree), len(turns), said.hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=names).astype({"tree": "Int64"})

    names = ["tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return formatted.select("tree", "formatted", "loss_spans").mapInPandas(
        read, "tree long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
