"""A Merkle tree over all documents: leaves by source, subroots of sources, one root, and a proof for every row.

Leaves of a source stand in the order of doc_id (nulls first). On each level three consecutive nodes become their parent; the
last run may be shorter, even one. A lone leaf is its source's subroot. Subroots, ordered by source (null first, by UTF-8
bytes), give the root the same way.

Levels are lag and lead columns: within a block of 3^LEVELS leaves one window serves all of them, since the nodes of level k stand
on every 3^k-th row, on their first leaf. Columns lagging and leading by 3^k and twice that, masked by a node's slot and the
length of its run, are its siblings; rows in slot 0 hash the parent. Back down, a node takes the path of its parent from the row
that its slot lags behind. The tops of blocks are the rows of the next round, so no window sees more than a block, whatever
share of the rows one source holds; their paths are joined to the rows of their block.

Null columns are `-` in a leaf. A null doc_id counts as an empty text where its crc32 is taken. Repeated rows are leaves of their own,
in any order beside each other. Rows of one doc_id with different content stand by their leaf. Empty and very long texts are
like others. An empty table gives no rows. Other columns of the table are neither read nor kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtrace.llm.order import ordered
from runtrace.sources.staging import stage

FANOUT = 3
#: Levels in one block: 2,187 rows, each with at most 14 siblings.
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def leaf_of(*values: Column) -> Column:
    """sha256 over values as text: `-` for null, else byte count, colon, value."""
    said = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*said), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """sha256 over all siblings, level by level."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["left"], step["right"]))), 256)


def climbed(nodes: DataFrame, most: int, levels: int = LEVELS) -> DataFrame:
    """Nodes (`tree`, `place`, `n` nodes in their tree, `node`) with `path`, their siblings up to the top, and `top`.

    `most` is the largest n. Places of a tree are 0 to n - 1.
    """
    if most <= 1:
        return nodes.withColumns({"path": F.array().cast(_PATH), "top": F.col("node")})
    block_size = FANOUT**levels
    block = F.expr(f"place div {block_size}")
    rows = nodes.withColumns({"block": block, "node_0": F.col("node")})
    window = Window.partitionBy("tree", "block").orderBy("place")
    for k in range(levels):
        step = FANOUT**k
        at = F.expr(f"place div {step}")
        slot = at % FANOUT
        n = F.expr(f"(n + {step - 1}) div {step}")
        run = F.least(F.lit(FANOUT), n - (at - slot))
        stands = F.col("place") % step == 0
        lag = [F.lag(f"node_{k}", j * step).over(window) for j in (1, 2)]
        lead = [F.lead(f"node_{k}", j * step).over(window) for j in (1, 2)]
        rows = rows.withColumns({"lag_1": lag[0], "lag_2": lag[1], "lead_1": lead[0], "lead_2": lead[1]})
        nothing = F.lit("")
        left = F.concat(F.when(slot == 2, F.col("lag_2")).otherwise(nothing), F.when(slot >= 1, F.col("lag_1")).otherwise(nothing))
        right = F.concat(F.when(slot + 1 < run, F.col("lead_1")).otherwise(nothing), F.when(slot + 2 < run, F.col("lead_2")).otherwise(nothing))
        siblings = F.when(n > 1, F.array(F.struct(left.alias("left"), right.alias("right")))).otherwise(F.array().cast(_PATH))
        parent = F.when(n > 1, F.sha2(F.concat(F.col(f"node_{k}"), right), 256)).otherwise(F.col(f"node_{k}"))
        rows = rows.withColumns({
            f"siblings_{k}": F.when(stands, siblings), f"node_{k + 1}": F.when(F.col("place") % (FANOUT * step) == 0, parent),
        }).drop("lag_1", "lag_2", "lead_1", "lead_2")
    rows = rows.withColumn("path", F.when(F.col("place") % block_size == 0, F.array().cast(_PATH)))
    for k in reversed(range(levels)):
        step = FANOUT**k
        slot = F.expr(f"place div {step}") % FANOUT
        rows = rows.withColumns({f"lag_{j}": F.lag("path", j * step).over(window) for j in (1, 2)})
        above = F.when(slot == 0, F.col("path")).when(slot == 1, F.col("lag_1")).otherwise(F.col("lag_2"))
        rows = rows.withColumn("path", F.when(F.col("place") % step == 0, F.concat(f"siblings_{k}", above))).drop("lag_1", "lag_2")
    kept = [*nodes.columns, "block", f"node_{levels}", "path"]
    stored = stage(rows.select(*kept), "merkle-level")
    tops = stored.where(F.col("place") % block_size == 0).select(
        "tree", F.col("block").alias("place"), F.expr(f"(n + {block_size - 1}) div {block_size}").alias("n"), F.col(f"node_{levels}").alias("node"))
    above = climbed(tops, -(-most // block_size), levels).select("tree", F.col("place").alias("block"), F.col("path").alias("path_above"), "top")
    return stored.join(above, ["tree", "block"]).withColumn("path", F.concat("path", "path_above")).select(*nodes.columns, "path", "top")


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per document: `doc_id`, `leaf`, `path` (siblings to the root), `subroot`, `root`.

    With `tampered`, an expression over the table's columns for another text, also `tampered_leaf`: null where that text is equal.
    """
    values = [F.col(c) for c in COLUMNS]
    changed = F.lit(None).cast("string")
    if tampered is not None:
        changed = F.when(~tampered.eqNullSafe(F.col("text")), leaf_of(*values[:-1], tampered))
    leaves = docs.select("doc_id", "source", leaf_of(*values).alias("leaf"), changed.alias("tampered_leaf"))
    order = ordered(leaves, ["source"], ["doc_id", "leaf"], name="merkle-leaves")
    most = order.groups.agg(F.max("group_size"), F.count("*")).first()
    nodes = order.rows().select("doc_id", "tampered_leaf", F.col("group_no").alias("tree"), "place", F.col("group_size").alias("n"), F.col("leaf").alias("node"))
    below = climbed(nodes, most[0] or 0, levels)
    if most[0] and most[0] > 1:
        below = stage(below, "merkle-trees")
    subroots = below.where("place = 0").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.lit(most[1]).cast("bigint").alias("n"), F.col("top").alias("node"))
    above = climbed(subroots, most[1], levels).select(F.col("place").alias("tree"), F.col("path").alias("path_above"), F.col("top").alias("root"))
    joined = below.join(above, "tree")
    columns = ["doc_id", F.col("node").alias("leaf"), F.concat("path", "path_above").alias("path"), F.col("top").alias("subroot"), "root"]
    return joined.select(*columns, *(["tampered_leaf"] if tampered is not None else []))


def verified(rows: DataFrame) -> DataFrame:
    """Rows of a manifest with `folded_root`, from the tampered leaf if there is one, and `verified`: whether it is the root."""
    folded = rows.withColumn("folded_root", fold(F.coalesce("tampered_leaf", "leaf"), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
