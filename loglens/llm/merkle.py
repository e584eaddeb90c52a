"""Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf: the hash of its fields, each with its length in front. The
leaves of a group (a language) in order of their id form a binary tree, and the tops of
all groups form another one, whose top is the root of the dataset. A tree is cut into
superblocks of ``BLOCK`` nodes. One pass reduces each superblock to its own top; these
tops are the nodes of the next, ``BLOCK`` times smaller layer, until each tree has one
node. Then the layers are gone through from the top: the nodes of a superblock meet the
siblings that its top needs further up in one cogroup, where the local levels are
reduced again, joined with the outer siblings, and (for the leaves) folded to the root.
So a task holds one superblock, whatever the size of a group, and digests are all
that moves: texts are hashed where they are read.

Places in a tree come from range partitions and their counts, never from one sorted
task. The sorted table is written before places are given, so a lost task gets the same ones.

Defined results: a null field is ``-``; null ids come first; rows with one id are in the
order of their leaves; rows that are equal in all fields have a place each. A null
group is a group of its own and comes first. An empty table has no rows and no root.
Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.common import pick, placed_rows, ship, written

# Levels that one task reduces, and so the nodes of a superblock.
LEVELS = 10
BLOCK = 1 << LEVELS
DIGEST = 64
NO_GROUP = "-"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def reduced(nodes: list[str], height: int) -> list[list[str]]:
    """Levels of a subtree from ``nodes`` up; the last node of a level may stand alone."""
    rows = [nodes]
    for _ in range(height):
        last = rows[-1]
        rows.append([digest("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return rows


def siblings_of(rows: list[list[str]], place: int) -> tuple[str, str]:
    """``(digests, sides)`` of the path from ``place`` to the top of ``rows``.

    A side is ``L`` or ``R`` for a sibling there and ``-`` for none.
    """
    found, sides = [], []
    for level in rows[:-1]:
        other = place ^ 1
        if other < len(level):
            found.append(level[other])
            sides.append("L" if other < place else "R")
        else:
            sides.append("-")
        place >>= 1
    return "".join(found), "".join(sides)


def folded(node: str, digests: str, sides: str) -> str:
    """The top that ``node`` leads to with the siblings of its proof."""
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
            continue
        other = digests[at : at + DIGEST]
        at += DIGEST
        node = digest(other + node if side == "L" else node + other)
    return node


def _height(n) -> int:
    """Levels inside a superblock of a tree with ``n`` nodes."""
    return min(LEVELS, (int(n) - 1).bit_length())


def _field(column):
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(columns):
    """The hash of a row: its fields in order, each with its length in front."""
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


_NODES = "tree string, pos bigint, n bigint, node string"


def _top(block: pd.DataFrame) -> pd.DataFrame:
    """The node of the next layer that a superblock gives."""
    block = block.sort_values("pos")
    n = int(block["n"].iloc[0])
    top = reduced(block["node"].tolist(), _height(n))[-1][0]
    place = int(block["pos"].iloc[0]) >> LEVELS
    return pd.DataFrame(
        {"tree": [block["tree"].iloc[0]], "pos": [place], "n": [-(-n // BLOCK)], "node": [top]}
    )


def _block():
    return F.shiftright("pos", LEVELS).alias("block")


def _layers(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the layers above it; in the last one each tree has one node."""
    layers, largest = [nodes.select("tree", "pos", "n", "node")], None
    while largest is None or largest > 1:
        if largest is None:
            largest = nodes.agg(F.max("n")).first()[0] or 0
        above = layers[-1].groupBy("tree", _block()).applyInPandas(_top, _NODES)
        layers.append(written(above, "merkle-layer"))
        largest = -(-largest // BLOCK)
    return layers


_PATHS = "tree string, block bigint, digests string, sides string, subroot string, root string"


def _paths(block: pd.DataFrame, outer: pd.DataFrame):
    """``(digests, sides)`` of each node of a superblock, up to the root."""
    rows = reduced(block["node"].tolist(), _height(block["n"].iloc[0]))
    more, further = outer["digests"].iloc[0], outer["sides"].iloc[0]
    for i in range(len(rows[0])):
        digests, sides = siblings_of(rows, i)
        yield digests + more, sides + further


def _descend(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """The paths of the superblocks below, each the path of its top in this layer."""
    block = block.sort_values("pos")
    paths = list(_paths(block, outer))
    return pd.DataFrame(
        {
            "tree": block["tree"],
            "block": block["pos"],
            "digests": [p[0] for p in paths],
            "sides": [p[1] for p in paths],
            "subroot": outer["subroot"].iloc[0],
            "root": outer["root"].iloc[0],
        }
    )


def _prove(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proofs of the leaves of a superblock, and the root that each claim folds to."""
    block = block.sort_values("pos")
    paths = list(_paths(block, outer))
    claims = [leaf if c is None else c for leaf, c in zip(block["node"], block["claim"])]
    return pd.DataFrame(
        {
            "id": block["id"],
            "leaf": block["node"],
            "subroot": outer["subroot"].iloc[0],
            "root": outer["root"].iloc[0],
            "digests": [p[0] for p in paths],
            "sides": [p[1] for p in paths],
            "folded_root": [folded(c, *p) for c, p in zip(claims, paths)],
        }
    )


def _exchange(nodes: DataFrame, outer: DataFrame, step, schema) -> DataFrame:
    """Superblocks of ``nodes`` together with the siblings that they need further up."""
    inner = nodes.groupBy("tree", _block())
    return inner.cogroup(outer.groupBy("tree", "block")).applyInPandas(step, schema)


def _lowest_paths(layers: list[DataFrame], outer: DataFrame) -> DataFrame:
    """The paths of the superblocks of ``layers[0]``, from those of the tops."""
    for layer in reversed(layers[1:-1]):
        outer = written(_exchange(layer, outer, _descend, _PATHS), "merkle-paths")
    return outer


def _group_paths(tops: DataFrame) -> DataFrame:
    """For each tree of ``tops(tree, node)``: its path in the tree of all tops."""
    named = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    placed = written(placed_rows(named, "tree", ["name"]), "merkle-groups")
    layers = _layers(placed)
    none = F.lit("")
    outer = layers[-1].select(
        "tree",
        F.lit(0).cast("bigint").alias("block"),
        none.alias("digests"),
        none.alias("sides"),
        F.col("node").alias("subroot"),
        F.col("node").alias("root"),
    )
    outer = _lowest_paths(layers, outer)
    found = _exchange(
        placed.select("tree", "pos", "n", "node", "name"), outer, _named_paths, _NAMED
    )
    return found.select(
        F.col("name").alias("tree"),
        F.lit(0).cast("bigint").alias("block"),
        "digests",
        "sides",
        "subroot",
        "root",
    )


_NAMED = "name string, digests string, sides string, subroot string, root string"


def _named_paths(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("pos")
    paths = list(_paths(block, outer))
    return pd.DataFrame(
        {
            "name": block["name"],
            "digests": [p[0] for p in paths],
            "sides": [p[1] for p in paths],
            "subroot": block["node"],
            "root": outer["root"].iloc[0],
        }
    )


def merkle_leaves(docs: DataFrame, fields, group="lang", doc_id="doc_id", changed=None):
    """``(doc_id, tree, leaf, claim)``: texts are read once, here.

    ``fields`` are the columns that a leaf hashes. ``changed(columns)`` takes them by
    name and gives ``(condition, later columns)``; ``claim`` is the leaf of the row with
    the later columns, null where the condition is not true.
    """
    slim = pick(docs, **{f"f{i}": name for i, name in enumerate(fields)}, group=group, id=doc_id)
    columns = {name: F.col(f"f{i}") for i, name in enumerate(fields)}
    claim = F.lit(None).cast("string")
    if changed:
        condition, later = changed(columns)
        claim = F.when(condition, leaf_of((columns | later).values()))
    return slim.select(
        F.col("id").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("group").cast("string")), F.lit(NO_GROUP)).alias(
            "tree"
        ),
        leaf_of(columns.values()).alias("leaf"),
        claim.alias("claim"),
    )


def merkle_proofs(leaves: DataFrame) -> DataFrame:
    """``(doc_id, leaf, subroot, root, digests, sides, folded_root, verified)``.

    ``digests`` are the siblings from the leaf to the root, one after the other, and
    ``sides`` tells for each level where the sibling stands. ``folded_root`` is what the
    claim of the row (its leaf if it has none) and these siblings give.
    """
    id_type = leaves.schema["doc_id"].dataType
    # Equal leaves of one id are told apart, so that no range of them is one partition.
    told = written(leaves.withColumn("nth", F.monotonically_increasing_id()), "merkle-leaves")
    placed = placed_rows(told, "tree", [F.col("doc_id").asc_nulls_first(), "leaf", "nth"])
    # Ids go through pandas as text, since whole numbers with nulls become floats there.
    placed = placed.select(
        "tree", "pos", "n", F.col("leaf").alias("node"), "claim", F.col("doc_id").cast("string").alias("id")
    )
    placed = written(placed, "merkle-placed")
    layers = _layers(placed)
    outer = _lowest_paths(layers, _group_paths(layers[-1]))
    proofs = _exchange(
        placed,
        outer,
        _prove,
        "id string, leaf string, subroot string, root string, digests string, sides string, "
        "folded_root string",
    )
    return proofs.select(
        F.col("id").cast(id_type).alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "digests",
        "sides",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def one_more_character(columns):
    """A copy with another ``n_chars``, of the rows whose id's checksum 7 divides."""
    tampered = F.crc32(columns["doc_id"].cast("string")) % 7 == 0
    # Decimal, so that the largest long has a successor.
    return tampered, {"n_chars": columns["n_chars"].cast("decimal(38,0)") + 1}


def op13_query(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    proofs = merkle_proofs(merkle_leaves(docs, FIELDS, changed=one_more_character))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("digests", 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


def _sql_field(x):
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


def _sql_leaf(n_chars):
    names = [n_chars if f == "n_chars" else f for f in FIELDS]
    return "sha256(" + " || ".join(_sql_field(x) for x in names) + ")"


# The checksum by bits: the reflected polynomial of crc32 over the decimal digits.
OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_sql_leaf("n_chars")} AS leaf,
         CASE WHEN xor(4294967295, list_reduce([4294967295] || list_transform(
             range(0, 8 * strlen(CAST(doc_id AS VARCHAR))),
             lambda i: (ascii(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS BIGINT), 1))
                   >> CAST(i % 8 AS INTEGER)) & 1),
           lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) % 7 = 0
           THEN {_sql_leaf("(CAST(n_chars AS HUGEINT) + 1)")} END AS claim
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
),
inner_nodes(tree, level, pos, n, node) AS (
  SELECT tree, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 2, (any_value(n) + 1) // 2,
         sha256(string_agg(node, '' ORDER BY pos))
  FROM inner_nodes WHERE n > 1 GROUP BY tree, pos // 2
),
tops AS (
  SELECT tree, node AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos
  FROM inner_nodes WHERE n = 1
),
outer_nodes(level, pos, n, node) AS (
  SELECT 0, pos, (SELECT count(*) FROM tops), subroot FROM tops
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, (any_value(n) + 1) // 2,
         sha256(string_agg(node, '' ORDER BY pos))
  FROM outer_nodes WHERE n > 1 GROUP BY pos // 2
),
dataset AS (SELECT node AS root, level AS height FROM outer_nodes WHERE n = 1),
steps AS (
  SELECT p.tree, p.pos, CAST(l.level AS INTEGER) AS level, s.node AS sibling,
         s.pos < p.pos >> CAST(l.level AS INTEGER) AS on_left
  FROM placed p JOIN tops t ON p.tree = t.tree
  JOIN (SELECT range AS level FROM range(0, 64)) l ON l.level < t.height
  LEFT JOIN inner_nodes s ON s.tree = p.tree AND s.level = l.level
    AND s.pos = xor(p.pos >> CAST(l.level AS INTEGER), 1)
  UNION ALL
  SELECT p.tree, p.pos, CAST(t.height + l.level AS INTEGER), s.node,
         s.pos < t.pos >> CAST(l.level AS INTEGER)
  FROM placed p JOIN tops t ON p.tree = t.tree
  JOIN (SELECT range AS level FROM range(0, 64)) l ON l.level < (SELECT height FROM dataset)
  LEFT JOIN outer_nodes s ON s.level = l.level
    AND s.pos = xor(t.pos >> CAST(l.level AS INTEGER), 1)
),
proofs AS (
  SELECT tree, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256,
         max(level) + 1 AS height
  FROM steps GROUP BY tree, pos
),
folds(tree, pos, level, node) AS (
  SELECT tree, pos, 0, coalesce(claim, leaf) FROM placed
  UNION ALL
  SELECT f.tree, f.pos, f.level + 1,
         sha256(CASE WHEN s.sibling IS NULL THEN f.node WHEN s.on_left THEN s.sibling || f.node
                ELSE f.node || s.sibling END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
)
SELECT p.doc_id, p.leaf, t.subroot, d.root, coalesce(r.proof_sha256, sha256('')) AS proof_sha256,
       f.node AS folded_root, f.node = d.root AS verified
FROM placed p
JOIN tops t ON t.tree = p.tree
CROSS JOIN dataset d
LEFT JOIN proofs r ON r.tree = p.tree AND r.pos = p.pos
JOIN folds f ON f.tree = p.tree AND f.pos = p.pos AND f.level = coalesce(r.height, 0)
"""

ship(__name__)
