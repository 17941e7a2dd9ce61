"""Manifest of a table as a Merkle tree, and proofs that climb it in a recursive query.

Each row is a leaf: the SHA-256 of its columns, each with its length in front. The leaves of a group, in order, are one
tree: every ``FAN`` neighbours (the last run: what is left) are hashed together until one node, the group's
subroot, remains; the subroots, in order of their groups, are the leaves of one more tree, whose last node is the root.
Digests are lowercase hex, and are hashed as such.

Levels are built bottom up, each from the one below, and stored as node rows with a link to the parent. A proof is a recursive
query over that table: it starts at a run of leaves and ascends a link at a time, appends the digests beside
the path and folds each leaf's digest, tampered or not, into its parent's. The leaves of a run share every sibling above
it, so they climb as one row that carries a folded digest for each of them; that is an eighth of the rows and of the siblings.

The place of a leaf comes from a range partitioning of the order and the row counts of its partitions, so that no task
sees a whole group, however large it is; equal rows are spread by a number of their own. A parent gathers ``FAN`` rows.
All steps are DataFrame or SQL functions over digests; texts are read once and travel nowhere.

Defined results: a null field counts as ``-``; rows without an id come first in their group, those without a group form
the first group; rows with equal ids are leaves of their own, ordered by digest; a lone leaf is its group's subroot,
a lone subroot the root; rows without an id are not tampered with by ``every_third``; columns besides those named are left
behind; an empty table has no leaves, no root and gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamflow.llm.base import settle, whole_columns

FAN = 8
_HEX = 64
#: The tree of the subroots; others go by the number of their first leaf.
_TOP = -1
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*values: Column) -> Column:
    """SHA-256 of values, each with its length in bytes in front, ``-`` for null."""
    named = [v.cast("string") for v in values]
    fields = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in named]
    return F.sha2(F.concat(*fields), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, *_LOWER)


def every_third(key: str = "doc_id") -> Column:
    """Whether 3 divides the crc32 of the decimal id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0, F.lit(False))


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """Settled rows with their place (from 0) in the order of the columns named, nulls first; equal rows in any order."""
    tie, part, at = "_tie", "_part", "_at"
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie)
    sorted_rows = dealt.sortWithinPartitions(*order, tie).drop(tie)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = settle(sorted_rows.select("*", F.spark_partition_id().alias(part), within.alias(at)), "merkle-order")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return rows.join(starts, part).withColumn(out, F.col("_start") + F.col(at)).drop(part, at, "_start")


def _runs(nodes: DataFrame, *also: str) -> DataFrame:
    """Every ``FAN`` neighbours of a tree as one row: ``members`` in order and their digests in a row."""
    run = F.struct("pos", "digest", *also)
    gathered = nodes.groupBy("tree", "n", F.floor(F.col("pos") / FAN).cast("long").alias("up")).agg(
        F.array_sort(F.collect_list(run)).alias("members")
    )
    return gathered.withColumn("children", F.array_join(F.col("members.digest"), ""))


def _above(tree: DataFrame) -> DataFrame:
    """The next level of nodes, from one whose trees have more than one node."""
    return _runs(tree).select(
        "tree", F.ceil(F.col("n") / FAN).cast("long").alias("n"), F.col("up").alias("pos"),
        F.sha2("children", 256).alias("digest"), "children",
    )


def _heights(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs of leaves and the linked nodes above them, both settled, from leaves (group, doc_id, digest, altered)."""
    placed = numbered(settle(leaves, "merkle-leaves"), ["group", "doc_id", "digest"], "number")
    groups = settle(placed.groupBy("group").agg(F.min("number").alias("tree"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    of = groups.withColumnRenamed("group", "of")
    placed = placed.join(of, placed["group"].eqNullSafe(of["of"]), "left").withColumn("pos", F.col("number") - F.col("tree"))
    runs = settle(_runs(placed, "doc_id", "altered"), "merkle-runs")

    height = _heights(groups.agg(F.max("n")).first()[0] or 0)
    levels = []
    level = runs.select(
        "tree", F.ceil(F.col("n") / FAN).cast("long").alias("n"), F.col("up").alias("pos"),
        F.when(F.col("n") > 1, F.sha2("children", 256)).otherwise(F.col("children")).alias("digest"), "children",
    )
    for nth in range(1, max(1, height) + 1):
        levels.append(settle(level.withColumn("level", F.lit(nth)), "merkle-nodes"))
        level = _above(levels[-1].filter("n > 1"))
    nodes = reduce(DataFrame.unionByName, levels)

    tops = numbered(settle(nodes.filter("n = 1").select("tree", "digest"), "merkle-subroots"), ["tree"], "pos")
    tops = settle(tops.withColumnRenamed("tree", "of"), "merkle-tops")
    n = tops.count()
    top_levels = []
    level = tops.select(F.lit(_TOP).cast("long").alias("tree"), F.lit(n).cast("long").alias("n"), "pos", "digest")
    for nth in range(1, _heights(n) + 1):
        top_levels.append(settle(_above(level).withColumn("level", F.lit(nth)), "merkle-nodes"))
        level = top_levels[-1]

    up, place = F.floor(F.col("pos") / FAN).cast("long"), (F.col("pos") % FAN).cast("int")
    inside = F.col("n") > 1
    linked = nodes.join(tops.select(F.col("of").alias("tree"), F.col("pos").alias("rank")), "tree")
    into_top = ~inside & F.lit(n > 1)
    rank_up, rank_place = F.floor(F.col("rank") / FAN).cast("long"), (F.col("rank") % FAN).cast("int")
    linked = linked.select(
        "tree", "level", "pos", "digest", "children",
        F.when(inside, F.col("tree")).when(into_top, F.lit(_TOP)).cast("long").alias("up_tree"),
        F.when(inside, F.col("level") + 1).when(into_top, F.lit(1)).alias("up_level"),
        F.when(inside, up).when(into_top, rank_up).alias("up_pos"),
        F.when(inside, place).when(into_top, rank_place).alias("place"),
    )
    for above in top_levels:
        linked = linked.unionByName(above.select(
            "tree", "level", "pos", "digest", "children", F.when(inside, F.col("tree")).alias("up_tree"),
            F.when(inside, F.col("level") + 1).alias("up_level"), F.when(inside, up).alias("up_pos"),
            F.when(inside, place).alias("place"),
        ))
    return runs, settle(linked, "merkle-linked")


_CLIMB = """
WITH RECURSIVE climb AS (
    SELECT tree, up AS run, folded, '' AS proof, subroot, subroot AS top, up_tree, up_level, up_pos, place FROM {start}
    UNION ALL
    SELECT c.tree, c.run,
        transform(c.folded, f -> sha2(concat(left(n.children, c.place * {hex}), f, substr(n.children, c.place * {hex} + {hex} + 1)), 256)),
        concat(c.proof, left(n.children, c.place * {hex}), substr(n.children, c.place * {hex} + {hex} + 1)),
        CASE WHEN n.tree = c.tree THEN n.digest ELSE c.subroot END, n.digest,
        n.up_tree, n.up_level, n.up_pos, n.place
    FROM climb c JOIN {nodes} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos
)
SELECT tree, run, folded, proof, subroot, top FROM climb WHERE up_tree IS NULL
"""


def climb(runs: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each run of leaves, once at the root: the folded digests, the siblings above it, its subroot and the root."""
    spark = runs.sparkSession
    leaf = F.col("members")
    # A run's own node: each member's digest put into its place among the others.
    fold = lambda m, j: F.sha2(F.concat(
        F.substr(F.col("children"), F.lit(1), j * _HEX), F.coalesce(m["altered"], m["digest"]),
        F.substr(F.col("children"), j * _HEX + _HEX + 1),
    ), 256)
    lone = F.transform(leaf, lambda m: F.coalesce(m["altered"], m["digest"]))
    first = nodes.filter("level = 1").filter(F.col("tree") != _TOP).select(
        "tree", F.col("pos").alias("up"), F.col("digest").alias("subroot"), "up_tree", "up_level", "up_pos", "place"
    )
    started = runs.join(first, ["tree", "up"]).withColumn("folded", F.when(F.col("n") > 1, F.transform(leaf, fold)).otherwise(lone))
    started = settle(started.select(*first.columns, "folded"), "merkle-start")
    limit = "spark.sql.cteRecursionRowLimit"
    saved = spark.conf.get(limit, None)
    try:
        spark.conf.set(limit, "-1")  # as many rows as there are runs and levels
        at_root = spark.sql(_CLIMB.format(start="{start}", nodes="{nodes}", hex=_HEX), start=started, nodes=nodes)
        return settle(at_root, "merkle-climb")
    finally:
        spark.conf.unset(limit) if saved is None else spark.conf.set(limit, saved)


def prove(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as a leaf: its digest, subroot and root, its proof, and whether the tampered leaf verifies.

    Tampering lower-cases A-Z in ``text`` where ``every_third`` holds. The proof is the concatenated siblings.
    """
    own = whole_columns(docs, "doc_id", "source", "lang", "n_chars", "text")
    fields = ["doc_id", "source", "lang", "n_chars"]
    leaves = own.select(
        F.col("lang").alias("group"), "doc_id", digest(*map(F.col, fields), F.col("text")).alias("digest"),
        F.when(every_third(), digest(*map(F.col, fields), lower_ascii(F.col("text")))).alias("altered"),
    )
    runs, nodes = build(leaves)
    done = climb(runs, nodes)
    both = runs.join(done.withColumnRenamed("run", "up"), ["tree", "up"])
    j = F.col("j")
    beside = F.when(F.col("n") > 1, F.concat(
        F.substr(F.col("children"), F.lit(1), j * _HEX), F.substr(F.col("children"), j * _HEX + _HEX + 1)
    )).otherwise("")
    exploded = both.select("*", F.posexplode("members").alias("j", "member"))
    return exploded.select(
        F.col("member.doc_id").alias("doc_id"), F.col("member.digest").alias("leaf"), "subroot", F.col("top").alias("root"),
        F.concat(beside, F.col("proof")).alias("proof"), F.get("folded", j).alias("folded_root"),
        (F.get("folded", j) == F.col("top")).alias("verified"),
    )
