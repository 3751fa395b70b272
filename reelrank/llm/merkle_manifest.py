"""Merkle manifest of a dataset from concatenated-level strings.

The leaves of a part (a language) stand in order. An aligned block of 64 consecutive nodes
keeps each of its levels as one string of hex digests; fixed-width substrings of a level
are the inputs of its parents, and what flanks a node inside its run of 8 are its siblings.
The tops of the blocks are the nodes of the next round, until every part has one block; the
roots of the parts then form a tree of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import let
from reelrank.llm.ranks import rank_within
from reelrank.session import cut_lineage

# Children of a node, hex digits of a digest, levels that a block climbs.
FAN = 8
WIDTH = 64
CLIMB = 2
BLOCK = FAN ** CLIMB
# Subroots (one per part) that may be broadcast to the blocks.
BROADCAST_ROWS = 100_000

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each as byte count, ':' and bytes; '-' for null."""
    def part(v: Column) -> Column:
        s = v.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def _cut(level: Column, at: Column, n) -> Column:
    """``n`` digests of a level from place ``at`` on (fewer at its end)."""
    return F.substring(level, at * WIDTH + 1, (n if isinstance(n, Column) else F.lit(n)) * WIDTH)


def _parents(level: Column) -> Column:
    runs = (F.octet_length(level) + (FAN * WIDTH - 1)).cast("int")
    return F.array_join(F.transform(
        F.sequence(F.lit(0), F.floor(runs / (FAN * WIDTH)).cast("int") - 1),
        lambda i: F.sha2(_cut(level, i * FAN, FAN), 256)), "").cast("binary")


def _levels(first: Column, total: Column) -> Column:
    """The levels of a block: all up to one node if it is its part's only block, else CLIMB
    levels above the first."""
    levels = F.array(first)
    for _ in range(CLIMB):
        levels = let(levels, lambda x: F.when(
            (total <= BLOCK) & (F.octet_length(F.element_at(x, -1)) <= WIDTH), x).otherwise(
            F.concat(x, F.array(_parents(F.element_at(x, -1))))))
    return levels


def _siblings(levels: Column, place: Column) -> Column:
    """Level by level, what flanks the node above ``place`` (0-based in its block)."""
    def at(j: Column) -> Column:
        level, node = F.element_at(levels, j + 1), F.floor(place / F.pow(F.lit(FAN), j)).cast("int")
        run = node - node % FAN
        return F.struct(_cut(level, run, node % FAN).cast("string").alias("left"),
                        _cut(level, node + 1, FAN - 1 - node % FAN).cast("string").alias("right"))

    return F.transform(F.slice(F.sequence(F.lit(0), F.size(levels)), 1, F.size(levels) - 1), at)


def _blocks(nodes: DataFrame, name: str) -> DataFrame:
    """(part, block, total, members, path, top): the members' places above their block.

    ``nodes`` has part, rank, total and member (a struct with digest). A part with one block is
    a tree of its own; the others go on with the tops of their blocks as nodes.
    """
    blocks = cut_lineage(
        nodes.groupBy("part", F.floor(F.col("rank") / BLOCK).alias("block"))
        .agg(F.first("total").alias("total"),
             F.array_sort(F.collect_list(F.struct("rank", "member"))).alias("members"))
        .withColumn("levels", _levels(F.array_join("members.member.digest", "").cast("binary"),
                                      F.col("total"))), name)
    top = F.element_at("levels", -1).cast("string")
    most = blocks.agg(F.max("total")).first()[0] or 0
    if most <= BLOCK:
        none = F.lit(None).cast("array<struct<left:string,right:string>>")
        return blocks.select("part", "block", "members", "levels",
                             F.coalesce(none, F.array()).alias("path"), top.alias("top"))
    above = _blocks(blocks.select("part", F.col("block").alias("rank"),
                                  F.ceil(F.col("total") / BLOCK).alias("total"),
                                  F.struct(top.alias("digest")).alias("member")), name)
    above = _members(above).select(F.col("part").alias("up_part"), F.col("rank").alias("up"),
                                   "path", "top")
    return (blocks.join(above, (F.col("part") == F.col("up_part")) & (F.col("block") == F.col("up")))
            .select("part", "block", "members", "levels", "path", "top"))


def _members(blocks: DataFrame) -> DataFrame:
    """(part, rank, member, path, top) of every member of every block; path: the siblings."""
    rows = blocks.select("part", "levels", "top", F.col("path").alias("above"),
                         F.posexplode("members").alias("place", "m"))
    return rows.select("part", "m.rank", "m.member", "top",
                       F.concat(_siblings(F.col("levels"), F.col("place")), "above").alias("path"))


def manifest(docs: DataFrame, part: str = "lang", id_col: str = "doc_id",
             columns: Sequence[str] = COLUMNS, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: id, part, leaf, path, subroot, root and the carried columns.

    A leaf is the digest of ``columns``. The leaves of a part ascend by id (null first), equal
    ids by leaf; rows that are the same in all of it have equal leaves, and which of them
    stands first does not change any digest. ``path`` lists, from the leaf's level to that of
    the root, the digests left and right of the node in its run as strings of 64 hex digits
    each; both are empty in a run of one. A part without a name (null) stands before all
    others, which ascend by their UTF-8 bytes. A part of one row is its own subroot, and a
    table of one part has that subroot as root. An empty table gives an empty result. Other
    columns of ``docs`` are not read, whatever they are called; ``carry`` names expressions
    over ``docs`` to be kept with each row.
    """
    carry = carry or {}
    key = F.col(f"`{part}`").cast("string")
    leaves = cut_lineage(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{part}`").alias("of"),
        F.when(key.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), key)).alias("part"),
        leaf_digest([F.col(f"`{c}`") for c in columns]).alias("digest"),
        F.struct(F.lit(0).alias("nothing"), *[v.alias(k) for k, v in carry.items()]).alias("with")),
        "merkle-leaves")
    ranked = rank_within(leaves, "part", [F.col("id"), F.col("digest")], "merkle-order")
    blocks = _blocks(ranked.select("part", "rank", "total", F.struct(
        "id", "of", "digest", "with").alias("member")), "merkle-blocks")
    parts = rank_within(
        cut_lineage(blocks.where("block = 0").select(F.lit(0).alias("all"), F.col("part").alias("name"),
                                                     F.col("top").alias("digest")), "merkle-parts"),
        "all", [F.col("name")], "merkle-part-order")
    roots = cut_lineage(_members(_blocks(parts.select(
        F.lit("").alias("part"), "rank", "total", F.struct("name", "digest").alias("member")),
        "merkle-roots")).select(F.col("member.name").alias("name"), F.col("path").alias("end"),
                                F.col("top").alias("root")), "merkle-root")
    small = F.broadcast(roots) if roots.count() <= BROADCAST_ROWS else roots
    whole = (blocks.join(small, F.col("part") == F.col("name"))
             .select("part", "members", "levels", F.concat("path", "end").alias("path"),
                     F.struct(F.col("top").alias("subroot"), "root").alias("top")))
    return _members(whole).select(
        F.col("member.id").alias(id_col), F.col("member.of").alias(part),
        F.col("member.digest").alias("leaf"), "path", "top.subroot", "top.root",
        *[F.col(f"member.with.`{k}`").alias(k) for k in carry])


def proof(path: Column) -> Column:
    """The siblings of a path in one string, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give; a run of one is hashed too."""
    return F.aggregate(path, leaf, lambda node, x: F.sha2(
        F.concat(x["left"], node, x["right"]), 256))
