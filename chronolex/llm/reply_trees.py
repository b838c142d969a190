"""Reply trees formatted as conversations. DataFrame functions only."""

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from chronolex.sources.scratch import materialize

TURN = "### "
END = "</turn>"
TRAINED_ROLE = "assistant"

# A turn is `### role:\n`, the text, `</turn>\n`. In roles and texts a backslash becomes `\b`, so that
# afterwards every backslash starts one of these codes, and control strings become codes.
TEXT_CODES = (("\\", "\\b"), ("</turn>", "\\t"), ("###", "\\h"))
ROLE_CODES = (*TEXT_CODES, (":", "\\c"), ("\n", "\\n"))


def escape(column: Column, codes: tuple = TEXT_CODES) -> Column:
    for plain, code in codes:
        column = F.replace(column, F.lit(plain), F.lit(code))
    return column


def unescape(column: Column, codes: tuple = TEXT_CODES) -> Column:
    """The inverse: the backslash comes last, so no code is read out of what was just restored."""
    for plain, code in reversed(codes):
        column = F.replace(column, F.lit(code), F.lit(plain))
    return column


def reply_tree(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Linear conversations as trees: tree, node, parent, role, text, score.

    Rows are ordered by turn, ties by role and text; each row replies to the one before it. NULL texts
    and roles are empty. Rows that agree in everything are turns of their own.
    """
    order = Window.partitionBy("tree").orderBy(F.col("_turn").asc_nulls_first(), "role", "text")
    rows = turns.select(
        F.col(conv_col).alias("tree"),
        F.col(turn_col).alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    numbered = rows.withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _same_tree(tree: str) -> Column:
    return F.col("tree").eqNullSafe(F.col(tree))


def branches(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """(tree, branch, node, depth) for the nodes of each tree's best root-to-leaf paths.

    `nodes` has tree, node (unique in its tree), parent (NULL at a root) and score. Self-joins double
    the step from each node to an ancestor until every node has met its root, adding up depth and
    score on the way: a tree of depth d takes log2(d) joins. Leaves are ranked by the score of their
    path, then by node, and only the chosen branches are written out, by the same doubled steps
    backwards. A node whose parent is missing is a root. Nodes in a cycle never meet a root and are
    left out. Runs actions.
    """
    parents = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    known = (F.col("tree").eqNullSafe(F.col("_t"))) & (F.col("parent") == F.col("_n"))
    up = nodes.join(parents, known, "left").select(
        "tree", "node", F.col("_n").alias("up"), F.lit(1).cast("long").alias("depth"), F.coalesce("score", F.lit(0.0)).alias("total")
    )
    steps = [materialize(up, "steps")]
    # Nodes that have met their root are done; only the others are joined again.
    rooted, rows = steps[0].filter("up IS NULL"), None
    while True:
        standing = steps[-1].filter("up IS NOT NULL")
        open_rows = standing.count()
        # Each round some node that is not in a cycle meets its root.
        if open_rows in (0, rows):
            break
        rows = open_rows
        there = rooted.unionByName(standing).select(
            F.col("tree").alias("_t"),
            F.col("node").alias("_n"),
            F.col("up").alias("_up"),
            F.col("depth").alias("_d"),
            F.col("total").alias("_s"),
        )
        met = _same_tree("_t") & (F.col("up") == F.col("_n"))
        longer = standing.join(there, met).select(
            "tree",
            "node",
            F.col("_up").alias("up"),
            (F.col("depth") + F.col("_d")).alias("depth"),
            (F.col("total") + F.col("_s")).alias("total"),
        )
        steps.append(materialize(longer, "steps"))
        rooted = rooted.unionByName(steps[-1].filter("up IS NULL"))
    replied = nodes.filter("parent IS NOT NULL").select(F.col("tree").alias("_t"), F.col("parent").alias("_n")).distinct()
    leaf = rooted.join(replied, _same_tree("_t") & (F.col("node") == F.col("_n")), "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    best = leaf.withColumn("branch", F.row_number().over(rank)).filter(F.col("branch") <= per_tree)
    path = materialize(best.select("tree", "branch", "node", "depth"), "paths")
    # From the longest step to the shortest: each row of a path adds the ancestor one step up.
    for step in reversed(steps):
        one = step.filter("up IS NOT NULL").select(
            F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"), F.col("depth").alias("_d")
        )
        above = path.join(one, _same_tree("_t") & (F.col("node") == F.col("_n"))).select(
            "tree", "branch", F.col("_up").alias("node"), (F.col("depth") - F.col("_d")).alias("depth")
        )
        path = materialize(path.unionByName(above), "paths")
    return path


def conversations(nodes: DataFrame, per_tree: int = 1, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """(tree, branch, formatted, loss_spans), one row per chosen branch.

    `formatted` is the whole conversation; `loss_spans` are the (start, length) code point ranges of
    the trained role's texts in it, in order. A conversation is one row, so its own length is the
    bound of a task; nothing else is gathered. Runs actions.
    """
    path = branches(nodes, per_tree)
    texts = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "role", "text")
    turn = F.struct(
        "depth",
        F.concat(F.lit(TURN), escape(F.col("role"), ROLE_CODES), F.lit(":\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == trained_role).alias("trained"),
    )
    gathered = (
        path.join(texts, _same_tree("_t") & (F.col("node") == F.col("_n")))
        .groupBy("tree", "branch")
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    )
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    # Spans by one pass over the turns: how far the text has come, and the spans so far.
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["head"])
        span = F.struct(start.cast(LongType()).alias("start"), F.length(t["body"]).cast(LongType()).alias("length"))
        spans = F.when(t["trained"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        at = start + F.length(t["body"]) + len(END) + 1
        return F.struct(at.cast(LongType()).alias("at"), spans.alias("spans"))

    spans = F.aggregate("turns", begin, add)["spans"]
    return gathered.select("tree", "branch", whole.alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    parts = F.filter(F.split(formatted, END + "\n"), lambda p: p != "")

    def turn(part: Column) -> Column:
        colon = F.locate(":\n", part)
        role = F.substring(part, F.lit(len(TURN) + 1), colon - (len(TURN) + 1))
        return F.struct(
            unescape(role, ROLE_CODES).alias("role"), unescape(F.substring(part, colon + 2, F.length(part))).alias("text")
        )

    return F.transform(parts, turn)


def trained_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
