"""Merkle manifest of a dataset by slot pivots.

Every row is a leaf. Within each group (a language) leaves are numbered in the order of their ids,
and FANOUT consecutive nodes have one parent, up to the group's root; the group roots, in the
order of the groups, have a tree of their own.

A level is one aggregation: conditional aggregates spread the children of a parent into FANOUT
columns, and the hash of these columns side by side is the parent. On the way down the same table
gives each child its siblings: the columns in front of its own slot and those behind it. So a proof
needs no look-up of siblings, only the join of a parent with its own way to the root.

Numbers come from a sort by ranges: rows are dealt by (group, id, leaf), so a group with all rows
is as even as any, and a small table of counts by range gives each range its first number. Each
level has an eighth of the rows of the one below; each is a table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lengths import written

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
KINDS = {"doc_id": "long", "n_chars": "long"}
TAMPER_EVERY = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WAY = "array<struct<before:string,after:string>>"


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts side by side."""
    return F.sha2(F.concat(*[part.cast("binary") for part in parts]), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: dict[str, Column]) -> Column:
    return hashed(*[field(values[name]) for name in FIELDS])


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, forged``: ``tree`` sorts like the language with null first; ``forged`` is
    the leaf of a tampered row, null where the row isn't tampered."""
    values = {name: F.col(name).cast(KINDS.get(name, "string")) for name in FIELDS}
    chosen = F.crc32(values["doc_id"].cast("string").cast("binary")) % TAMPER_EVERY == 0
    forged = leaf_of(values | {"text": F.translate(values["text"], UPPER, LOWER)})
    return docs.select(
        F.coalesce(F.concat(F.lit("="), values["lang"]), F.lit("")).alias("tree"),
        values["doc_id"].alias("doc_id"),
        leaf_of(values).alias("leaf"),
        F.when(chosen, forged).alias("forged"),
    )


def numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``place`` (from 0, by ``order`` within ``tree``) and ``total`` (rows of the tree).

    Rows that agree in ``order`` are dealt at random, so that many of them don't share a range."""
    dealt = rows.withColumn("deal", F.rand(12)).repartitionByRange("tree", *order, "deal").sortWithinPartitions("tree", *order, "deal")
    dealt = written(dealt.drop("deal").withColumn("row", F.monotonically_increasing_id()), label)
    dealt = dealt.withColumn("range", F.shiftright("row", 33))
    counts = dealt.groupBy("tree", "range").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "range",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("total"),
    )
    return dealt.join(starts, ["tree", "range"]).withColumn("place", F.col("row") + F.col("shift")).drop("row", "range", "shift")


def pivoted(nodes: DataFrame) -> DataFrame:
    """Parents of ``tree, place, total, node``, with their children in columns of slots.

    ``node`` is a struct with the field ``digest``."""
    slot = F.col("place") % FANOUT
    slots = [F.max(F.when(slot == k, F.col("node"))).alias(f"slot_{k}") for k in range(FANOUT)]
    parents = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).cast("long").alias("place"), "total").agg(*slots)
    digests = [F.coalesce(F.col(f"slot_{k}.digest"), F.lit("")) for k in range(FANOUT)]
    return parents.withColumn("digest", hashed(*digests))


def climbed(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The pivot of each level, lowest first, and ``tree, level, digest`` of each tree's root."""
    roots = nodes.where("total = 1").select("tree", F.lit(0).alias("level"), "node.digest")
    most = nodes.agg(F.max("total")).first()[0] or 0
    levels = []
    while most > 1:
        level = written(pivoted(nodes.where("total > 1")), f"{label}-{len(levels)}")
        levels.append(level)
        up = F.ceil(F.col("total") / FANOUT).cast("long")
        nodes = level.select("tree", "place", up.alias("total"), F.struct("digest").alias("node"))
        most = -(-most // FANOUT)
        roots = roots.unionByName(nodes.where("total = 1").select("tree", F.lit(len(levels)).alias("level"), "node.digest"))
    return levels, roots


def children(level: DataFrame, ways: DataFrame) -> DataFrame:
    """``tree, place, way, top, node`` of the children of a level's parents; ``ways`` has the parents' own."""
    digest = [F.coalesce(F.col(f"slot_{k}.digest"), F.lit("")) for k in range(FANOUT)]

    def side(columns: list[Column]) -> Column:
        return F.concat(F.lit(""), *columns)

    slots = [
        F.struct(
            F.lit(k).alias("slot"),
            F.col(f"slot_{k}").alias("node"),
            F.struct(side(digest[:k]).alias("before"), side(digest[k + 1 :]).alias("after")).alias("step"),
        )
        for k in range(FANOUT)
    ]
    met = level.join(ways, ["tree", "place"])
    spread = met.select("tree", "place", "way", "top", F.explode(F.array(*slots)).alias("child")).where("child.node IS NOT NULL")
    return spread.select(
        "tree",
        (F.col("place") * FANOUT + F.col("child.slot")).alias("place"),
        F.concat(F.array("child.step"), "way").alias("way"),
        "top",
        "child.node",
    )


def descended(levels: list[DataFrame], nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """``tree, place, way, top, node`` of all nodes of the lowest level; ``tops`` has ``tree, level, way, top`` of
    the roots, ``top`` being what all nodes of a tree get to know."""

    def roots(level: int) -> DataFrame:
        return tops.where(F.col("level") == level).select("tree", F.lit(0).cast("long").alias("place"), "way", "top")

    ways = roots(len(levels))
    for at in range(len(levels) - 1, 0, -1):
        ways = children(levels[at], ways).drop("node").unionByName(roots(at))
    alone = nodes.where("total = 1").select("tree", "place", "node").join(roots(0).drop("place"), "tree")
    return children(levels[0], ways).unionByName(alone.select("tree", "place", "way", "top", "node")) if levels else alone


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``
    (``doc_id, source, lang, n_chars, text``).

    Nulls are written as ``-``, so an empty text and none differ. Within a language rows without an id come
    first; rows with one id are in the order of their leaves, and rows alike in all five columns are
    interchangeable. A row without an id isn't tampered with. Other columns are left out; an empty table
    gives no rows."""
    rows = written(leaves(docs), "leaves")
    node = F.struct(F.col("leaf").alias("digest"), "doc_id", "forged")
    nodes = numbered(rows, ["doc_id", "leaf"], "numbered-leaves").select("tree", "place", "total", node.alias("node"))
    levels, roots = climbed(nodes, "leaf-level")
    # the tree of the groups' roots: its leaves are the groups
    groups = written(roots, "subroots")
    tops = numbered(groups.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "level", "digest"), ["group"], "numbered-groups")
    tops = tops.select("tree", "place", "total", F.struct("digest", "group", "level").alias("node"))
    top_levels, top = climbed(tops, "group-level")
    start = top.select("tree", "level", F.array().cast(WAY).alias("way"), F.col("digest").alias("top"))
    ways = descended(top_levels, tops, start)
    known = F.struct(F.col("node.digest").alias("subroot"), F.col("top").alias("root")).alias("top")
    ways = written(ways.select(F.col("node.group").alias("tree"), "node.level", "way", known), "group-ways")

    found = descended(levels, nodes, ways)
    fold = F.aggregate("way", F.coalesce("node.forged", "node.digest"), lambda h, step: F.sha2(F.concat(step["before"], h, step["after"]).cast("binary"), 256))
    siblings = F.array_join(F.transform("way", lambda step: F.concat(step["before"], step["after"])), "")
    out = found.select(
        F.col("node.doc_id").alias("doc_id"),
        F.col("node.digest").alias("leaf"),
        "top.subroot",
        "top.root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        fold.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
