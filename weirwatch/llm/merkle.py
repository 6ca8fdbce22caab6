"""Operator 13: a Merkle manifest of a table, and proofs by a recursive climb.

Every row is a leaf. The leaves of a language, in order, are hashed in runs of
two, level by level, up to one subroot; the subroots, in order, are hashed the
same way up to the root.

Levels are built six at a time: a block of 64 neighbours is one group, bounded
whatever the table holds, and hashes its levels itself. What is stored is one
row per node at every sixth level, linked to its parent: the siblings on the
way up, bottom first, and where the next row is. Ranks within a language come
from one range-partitioned sort, so a language may hold all rows.

A proof is a recursive query: from the leaves of a block it follows the parent
links, appends the siblings that it passes, and folds each leaf's own hash with
them. The 64 leaves of a block share all siblings above it, so these are kept
once a block and not once a leaf; the depth is a sixth of the tree's. Only
hashes travel; texts are read once, where leaves are hashed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirwatch.llm import stages
from weirwatch.operators.ranking import global_rank

LEVELS = 6
SALTS = 64
#: The tree of subroots; those of languages count from 0.
TOP = -1


def _part(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_hash(*values: Column) -> Column:
    """SHA-256 in hex of the values in order, each as its length in bytes and its text, or ``-`` for null."""
    return F.sha2(F.concat(*map(_part, values)), 256)


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """A leaf per document: ``lang``, ``doc_id``, ``leaf``, and ``claim``, the hash that somebody shows for it.

    The claim is the leaf itself but where ``tampered`` holds: there it is that
    of the row with one character more in ``n_chars``; a null count stays.
    """
    d = {x: F.col(x) for x in ("doc_id", "source", "lang", "n_chars", "text")}
    d["doc_id"], d["n_chars"] = d["doc_id"].cast("long"), d["n_chars"].cast("long")
    leaf = row_hash(*d.values())
    claim = leaf if tampered is None else F.when(tampered, row_hash(*{**d, "n_chars": d["n_chars"] + 1}.values())).otherwise(leaf)
    return docs.select(d["lang"].cast("string").alias("lang"), d["doc_id"].alias("doc_id"), leaf.alias("leaf"), claim.alias("claim"))


def _levels(hashes: Column, count: Column) -> Column:
    """The block's levels as an array of arrays, its own nodes first, then ``count`` levels above."""

    def above(level: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
        return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit(""))), 256))

    rounds = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    # The level is bound by a lambda of its own, so that it is looked up once and not for every node.
    step = lambda done, k: F.concat(done, F.transform(F.slice(done, k, 1), above))
    return F.aggregate(rounds, F.array(hashes), step)


def _siblings(levels: Column, place: Column) -> Column:
    """The siblings on the way from a place of the block to its top: hash or null, and whether it lies to the left."""

    def beside(level: Column, k: Column) -> Column:
        at = F.call_function("shiftright", place, k)
        return F.struct(F.get(level, at.bitwiseXOR(F.lit(1))).alias("hash"), (at.bitwiseAND(F.lit(1)) == 1).alias("left"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def _round(nodes: DataFrame, carry: list[str], number: int) -> tuple[DataFrame, DataFrame]:
    """Six levels of all trees.

    Takes nodes as ``tree``, ``place``, ``hash``, ``nodes`` (in the tree at this
    level) and carried columns. Gives the written blocks of 64 neighbours with
    their ``levels``, and the blocks' tops as nodes of the next round, ``done``
    where a tree has come to its only one.
    """
    block = F.shiftright("place", LEVELS).alias("block")
    gathered = nodes.groupBy("tree", block, "nodes").agg(F.sort_array(F.collect_list(F.struct("place", "hash", *carry))).alias("members"))
    bits = F.when(F.col("nodes") > 1, F.length(F.bin(F.col("nodes") - 1))).otherwise(0)
    blocks = gathered.withColumns({"levels": _levels(F.col("members.hash"), F.least(F.lit(LEVELS), bits)), "round": F.lit(number)})
    blocks = stages.stage(blocks, "merkle-blocks")
    tops = blocks.select(
        "tree",
        F.col("block").alias("place"),
        F.element_at(F.element_at("levels", -1), 1).alias("hash"),
        F.ceil(F.col("nodes") / (1 << LEVELS)).alias("nodes"),
        (F.col("nodes") <= 1 << LEVELS).alias("done"),
    )
    return blocks, tops


def _build_trees(nodes: DataFrame, most: int, carry: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of all trees, the largest of which has ``most`` nodes: their blocks, and the trees' tops."""
    rounds: list[DataFrame] = []
    tops = None
    while True:
        blocks, above = _round(nodes, [] if rounds else carry, len(rounds))
        rounds.append(blocks)
        tops = above.where("done") if tops is None else tops.unionByName(above.where("done"))
        if most <= 1 << LEVELS:
            return rounds, tops
        most = (most + (1 << LEVELS) - 1) >> LEVELS
        nodes = above.where("not done").drop("done")


@dataclass
class Manifest:
    """Stored levels of a tree of trees.

    ``leaves`` are the blocks of the first level: ``tree``, ``block``, up to 64
    ``members`` with their hash and carried columns, and their ``levels``.
    ``nodes`` are rows of the stored levels above: ``tree``, ``round``,
    ``place``, ``hash`` and the ``path`` of siblings up to the next stored
    level. Both have the key of the row there as ``next_tree``, ``next_round``
    and ``next_place``, null after the root. ``root`` is one row, or none for
    an empty table.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: DataFrame


def _linked(blocks: DataFrame, last: tuple[Column, Column, Column]) -> DataFrame:
    """Blocks with the key of the row that their top is, or of what follows a finished tree."""
    ends = F.col("nodes") <= 1 << LEVELS
    on = (F.col("tree"), F.col("round") + 1, F.col("block"))
    return blocks.withColumns({x: F.when(ends, b).otherwise(a) for x, a, b in zip(("next_tree", "next_round", "next_place"), on, last, strict=True)})


def _node_rows(blocks: DataFrame) -> DataFrame:
    rows = blocks.select("tree", "round", "next_tree", "next_round", "next_place", "levels", F.posexplode("members").alias("at", "member"))
    return rows.select(
        "tree", "round", F.col("member.place").alias("place"), F.col("member.hash").alias("hash"), _siblings(F.col("levels"), F.col("at")).alias("path"),
        "next_tree", "next_round", "next_place",
    )


def build(leaves: DataFrame, order: list[Column], carry: list[str]) -> Manifest:
    """The manifest of ``lang`` and ``leaf`` and carried columns; ``order`` is total within a language but for equal rows.

    A null language is one of its own, the first. Equal rows are leaves of
    their own, side by side.
    """
    leaves = stages.stage(leaves, "merkle-leaves")
    by_lang = F.col("lang").asc_nulls_first()
    ranked = global_rank(leaves, [by_lang, *order], "rank")
    sizes = ranked.groupBy("lang").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("nodes"))
    sizes = global_rank(sizes, [by_lang], "tree").withColumn("tree", F.col("tree") - 1)
    most, trees = sizes.agg(F.max("nodes"), F.count(F.lit(1))).first()
    # One language may have all rows: its row of the small side is dealt out.
    salted = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = ranked.withColumn("salt", (F.col("rank") % SALTS).cast("int")).alias("l").join(
        salted.alias("s"), F.col("l.lang").eqNullSafe(F.col("s.lang")) & (F.col("l.salt") == F.col("s.salt"))
    )
    nodes = met.select("s.tree", (F.col("l.rank") - F.col("s.first")).alias("place"), F.col("l.leaf").alias("hash"), "s.nodes", *[f"l.{x}" for x in carry])
    rounds, tops = _build_trees(nodes, most or 0, carry)
    subroots = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "hash", F.lit(trees).cast("long").alias("nodes"))
    upper, root = _build_trees(subroots, trees, [])
    to_top = (F.lit(TOP).cast("long"), F.lit(0), F.col("tree"))
    nowhere = (F.lit(None).cast("long"), F.lit(None).cast("int"), F.lit(None).cast("long"))
    nodes = reduce(DataFrame.unionByName, [_node_rows(_linked(x, to_top)) for x in rounds[1:]] + [_node_rows(_linked(x, nowhere)) for x in upper])
    return Manifest(_linked(rounds[0], to_top), stages.stage(nodes, "merkle-nodes"), stages.stage(root.select("hash"), "merkle-root"))


def _fold(path: str, start: str) -> str:
    return f"""aggregate({path}, {start}, (h, s) -> sha2(
        CASE WHEN s.hash IS NULL THEN h WHEN s.left THEN concat(s.hash, h) ELSE concat(h, s.hash) END, 256))"""


CLIMB = f"""
WITH RECURSIVE climb(tree, block, folded, proof, subroot, next_tree, next_round, next_place) AS (
    SELECT tree, block, folded, '', CAST(NULL AS STRING), next_tree, next_round, next_place FROM {{starts}}
    UNION ALL
    SELECT c.tree, c.block, transform(c.folded, f -> {_fold("n.path", "f")}), concat(c.proof, array_join(n.path.hash, '')),
           CASE WHEN n.tree = {TOP} AND n.round = 0 THEN n.hash ELSE c.subroot END,
           n.next_tree, n.next_round, n.next_place
    FROM climb c JOIN {{nodes}} n
      ON n.tree = c.next_tree AND n.round = c.next_round AND n.place = c.next_place
)
SELECT tree, block, folded, proof, subroot, (SELECT hash FROM {{root}}) AS root FROM climb WHERE next_tree IS NULL
"""


def verify(manifest: Manifest) -> DataFrame:
    """Climb from every leaf to the root and fold its ``claim`` with the siblings that lie beside the way."""
    spark = manifest.leaves.sparkSession
    # The climb has a few rows for each block, whatever their number; its depth is that of the tree.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    folded = F.transform("members", lambda m, i: F.aggregate(_siblings(F.col("levels"), i), m["claim"], _join_hashes))
    starts = manifest.leaves.select("tree", "block", folded.alias("folded"), "next_tree", "next_round", "next_place")
    ends = spark.sql(CLIMB, starts=starts, nodes=manifest.nodes, root=manifest.root)
    met = manifest.leaves.select("tree", "block", "members", "levels").join(ends, ["tree", "block"])
    rows = met.select("levels", "folded", "proof", "subroot", "root", F.posexplode("members").alias("at", "member"))
    own = F.array_join(_siblings(F.col("levels"), F.col("at"))["hash"], "")
    folded_root = F.get("folded", F.col("at"))
    return rows.select(
        F.col("member.doc_id").alias("doc_id"),
        F.col("member.hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(F.concat(own, "proof"), 256).alias("proof_sha256"),
        folded_root.alias("folded_root"),
        (folded_root == F.col("root")).alias("verified"),
    )


def _join_hashes(h: Column, sibling: Column) -> Column:
    other = sibling["hash"]
    return F.sha2(F.when(other.isNull(), h).when(sibling["left"], F.concat(other, h)).otherwise(F.concat(h, other)), 256)


def audit(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Build the manifest of all documents, then prove each of them, those that ``tampered`` picks with a changed row.

    One row per input row: ``doc_id``, ``leaf``, ``subroot``, ``root``,
    ``proof_sha256``, ``folded_root``, ``verified``. Any column may be null; a
    null language comes first, a null doc_id first within its language. Texts
    are hashed whole, empty ones as such. Equal rows are leaves side by side;
    other columns are left out; an empty table gives an empty result.
    """
    leaves = document_leaves(docs, tampered)
    order = [F.col(x).asc_nulls_first() for x in ("doc_id", "leaf", "claim")]
    return verify(build(leaves, order, ["doc_id", "claim"]))
