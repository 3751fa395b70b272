"""SimHash near-duplicates with BK-trees over shards of fingerprints.

Fingerprints that differ in at most ``radius`` bits agree exactly on at least
``exact_blocks`` of ``radius + exact_blocks`` bit blocks. Each choice of agreeing blocks
deals the distinct fingerprints into shards; a shard holds a BK-tree (children keyed by
their Hamming distance to the parent) that all fingerprints of the shard search, following
only edges within the radius. The tree of a shard travels to the task of the shard, so no
machine holds the fingerprints of the corpus. Links become components by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import without
from reelrank.session import cut_lineage, ship_package

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Shingle hashes whose bits are counted at once.
CHUNK = 8192


def fingerprint(text: str | None, shingle: int) -> bytes:
    """Eight bytes, big-endian: a bit is set if it is set in over half the shingle hashes."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not found:
        return bytes(8)
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(found) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[len(found) - n:].tolist()
    digest = xxhash.xxh64_digest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        raw = b"".join([digest(joined[s:e], 42) for s, e in
                        zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(``_id``, ``_fp`` as a signed 64-bit integer) for every row."""
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = [int.from_bytes(fingerprint(t.as_py(), shingle), "big", signed=True)
                   for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())],
                                             ["_id", "_fp"])

    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")
                       ).mapInArrow(run, f"_id {id_type}, _fp long")


def bk_forest(tree: np.ndarray, queries: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Links that span what the BK-tree search connects; ``queries`` None: the tree's own.

    The tree is that of inserting ``tree`` in order: of the points below a node, the first
    at each distance is the child on that edge. All queries descend together: those that
    reach a node are compared with it and go on to the edges within the radius.
    Returns pairs of positions in ``tree`` followed by ``queries``; a link between points
    that other links already connect is left out.
    """
    own = queries is None
    points = tree if own else np.concatenate([tree, queries])
    label = np.arange(len(points))
    links: list[tuple[int, int]] = []
    asked = np.arange(len(tree)) if own else np.arange(len(tree), len(points))
    stack = [(np.arange(len(tree)), asked)]
    while stack:
        below, asking = stack.pop()
        node = below[0]
        if own:
            asking = asking[asking > node]
            if not len(asking):
                continue
        far = np.bitwise_count(points[asking] ^ points[node]).astype(np.int16)
        near = asking[far <= radius]
        if len(near):
            other = near[label[near] != label[node]]
            if len(other):
                marks, first = np.unique(label[other], return_index=True)
                links.extend((int(node), int(other[i])) for i in first)
                label[np.isin(label, marks)] = label[node]
        if len(below) == 1:
            continue
        rest = below[1:]
        edge = np.bitwise_count(points[rest] ^ points[node]).astype(np.int16)
        order = np.argsort(edge, kind="stable")
        rest, edge = rest[order], edge[order]
        at = np.flatnonzero(np.diff(edge)) + 1
        for lo, hi in zip([0, *at.tolist()], [*at.tolist(), len(edge)], strict=True):
            goes = asking[np.abs(far - edge[lo]) <= radius]
            if len(goes):
                stack.append((rest[lo:hi], goes))
    return links


def _masks(radius: int, exact_blocks: int) -> list[int]:
    blocks = radius + exact_blocks
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    found = [sum(c) for c in combinations(one, exact_blocks)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(points: DataFrame, radius: int, exact_blocks: int, tree_size: int) -> DataFrame:
    """(``a``, ``b``): links that connect every pair of ``_fp`` within ``radius`` bits.

    ``points`` has distinct ``_fp``. A shard of more than ``tree_size`` points is cut into
    several trees, and every tree is searched by the points of every other part of its
    shard, in separate tasks.
    """
    ship_package(points.sparkSession)
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(radius, exact_blocks)])
    dealt = points.select("_fp", F.posexplode(masks).alias("_c", "_m")).select(
        "_fp", "_c", F.col("_fp").bitwiseAND(F.col("_m")).alias("_v"))
    sizes = cut_lineage(dealt.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
                        .where("_n > 1"), "shard-sizes")
    parts = F.ceil(F.col("_n") / F.lit(tree_size)).cast("int")
    shards = (dealt.join(sizes, ["_c", "_v"])
              .withColumn("_part", F.pmod(F.xxhash64("_fp"), parts).cast("int"))
              .withColumn("_with", F.explode(F.sequence(F.lit(0), parts - 1)))
              .select("_fp", "_c", "_v", "_part",
                      F.least("_part", "_with").alias("_lo"),
                      F.greatest("_part", "_with").alias("_hi")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(fp, part, lo, hi):
            if lo == hi:
                got, all_ = bk_forest(fp, None, radius), fp
            else:
                tree, asked = fp[part == lo], fp[part == hi]
                if not len(tree) or not len(asked):
                    return []
                got, all_ = bk_forest(tree, asked, radius), np.concatenate([tree, asked])
            signed = all_.view(np.int64)
            return [(int(signed[a]), int(signed[b])) for a, b in got]

        held: list[np.ndarray] = []

        def flush(rows):
            out = solve(rows[:, 0].view(np.uint64), rows[:, 3], rows[0, 4], rows[0, 5])
            return out

        def batch_of(pairs):
            a, b = zip(*pairs, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              ["a", "b"])

        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy().astype(np.int64)
                                    for i in range(6)])
            if not len(rows):
                continue
            if held:
                rows = np.concatenate([*held, rows])
            key = rows[:, [1, 2, 4, 5]]
            at = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            bounds = [0, *at.tolist()]
            out = []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                if hi - lo > 1:
                    out.extend(flush(np.ascontiguousarray(rows[lo:hi])))
            held = [rows[bounds[-1]:]]
            if out:
                yield batch_of(out)
        if held and len(held[0]) > 1:
            out = flush(np.ascontiguousarray(held[0]))
            if out:
                yield batch_of(out)

    shard = ["_c", "_v", "_lo", "_hi"]
    return (shards.repartition(*shard).sortWithinPartitions(*shard, "_fp")
            .select("_fp", "_c", "_v", "_part", "_lo", "_hi").mapInArrow(search, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(``u``, ``m``): each linked node and the smallest node of its component.

    Large-star and small-star contraction: the rounds grow with the logarithm of the
    longest chain; every round is two grouped minima and two joins on written tables.
    """
    now = cut_lineage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("m"))
                      .where("u <> m").distinct(), "links")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("m").alias("u"), F.col("u").alias("m")))
        least = both.groupBy("u").agg(F.min("m").alias("_l")).withColumn(
            "_l", F.least("u", "_l"))
        large = both.join(least, "u").where("m > u").select(F.col("m").alias("u"),
                                                            F.col("_l").alias("m"))
        large = cut_lineage(large.where("u <> m").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("m").alias("_l"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.col("u"), F.col("m"))).alias("u"), F.col("_l").alias("m"))
        now = cut_lineage(small.where("u <> m").distinct(), "small-star")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "m").cast("decimal(38,0)"))).first()
        if state == seen:
            return now
        seen = state


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, radius: int = 4, exact_blocks: int = 1,
                    tree_size: int = 4096) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id that links reach.

    Texts with fewer words than a shingle are one shingle; null texts and texts without
    words have fingerprint zero and link like any other. Equal fingerprints are one node,
    so copies cost nothing beyond their row. Null ids do not count as smallest; a component
    of null ids only has a null ``component_id``. An empty table gives an empty result; other
    columns of ``docs`` are not read. ``exact_blocks`` 2 makes shards of about 21 equal bits
    instead of 13, for corpora beyond 10^8 different fingerprints; results are the same.
    """
    rows = cut_lineage(fingerprints(without(docs).select(id_col, text_col), id_col, text_col,
                                    shingle), "fingerprints")
    points = cut_lineage(rows.groupBy("_fp").agg(F.min("_id").alias("_least")), "fp-nodes")
    stars = components(links(points.select("_fp"), radius, exact_blocks, tree_size))
    node = points.join(stars, F.col("_fp") == F.col("u"), "left").select(
        "_fp", "_least", F.coalesce("m", "_fp").alias("_root"))
    roots = node.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = cut_lineage(node.join(roots, "_root").select(
        F.col("_fp").alias("_node"), "component_id"), "fp-components")
    return rows.join(named, F.col("_fp") == F.col("_node"), "left").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id")
