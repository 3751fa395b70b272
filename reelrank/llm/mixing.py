"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of column values (for example domain, language, source).
At each node it is shared among the children in proportion to their weights; what a child
cannot hold (its tokens times the allowed epochs) goes to its siblings first, and only what
no sibling can hold goes back to the level above. A leaf takes whole epochs of its documents
and then a prefix of one more, in a seeded order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelrank.llm.common import Shelved, words
from reelrank.llm.ranks import rank_within
from reelrank.session import cut_lineage

# One bucket of the seeded order holds about so many documents.
BUCKET_DOCS = 1000
HASH_SPACE = 2 ** 32


def _key(column: str) -> Column:
    c = F.col(column)
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), c.cast("string")))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """The seeded order of a document in an epoch: md5 of 'seed:epoch:id'."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _place(seed: int, epoch: Column) -> Column:
    """The order inside a leaf: that of the ids, equal ids by a hash of their texts."""
    return F.concat(order_key(seed, epoch, F.col("_id")), F.hex("_text"))


def _weight(paths: Mapping[tuple[str, ...], float], keys: list[Column]) -> Column:
    """The configured weight of a node, 1 unless given; paths are values from the top."""
    own = {p: float(w) for p, w in paths.items() if len(p) == len(keys)}
    w = F.lit(1.0)
    for path, value in own.items():
        hit = F.lit(True)
        for k, v in zip(keys, path, strict=True):
            hit = hit & (k == F.lit(f"={v}"))
        w = F.when(hit, F.lit(value)).otherwise(w)
    return w


def share_budget(children: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Water filling among siblings: columns ``_cap, _w, _budget`` (the parent's) -> ``_given``.

    Siblings in order of capacity per weight: those that are full before the level reaches
    them are a prefix, which cumulative sums find without iterating.
    """
    group = W.partitionBy(*[F.col(p) for p in parent]) if parent else W.partitionBy(F.lit(0))
    order = group.orderBy(F.col("_cap") / F.col("_w"), F.col(key))
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(W.unboundedPreceding, -1)),
                        F.lit(0.0))
    rest = F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing))
    full = children.where("_w > 0").withColumn(
        "_full", before + F.col("_cap") / F.col("_w") * rest <= F.col("_budget"))
    taken = F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(F.lit(0.0))).over(group)
    open_w = F.sum(F.when(F.col("_full"), F.lit(0.0)).otherwise(F.col("_w"))).over(group)
    return full.withColumn("_given", F.when(F.col("_full"), F.col("_cap")).otherwise(
        (F.col("_budget") - taken) * F.col("_w") / open_w)).drop("_full")


def leaf_plan(sized: DataFrame, keys: list[str], weights: Mapping[tuple[str, ...], float],
              budget_share: float, max_epochs: int) -> DataFrame:
    """One row per leaf: its tokens, documents, token budget, whole epochs and rest."""
    leaves = sized.groupBy(*keys).agg(F.sum("_tokens").alias("_sum"),
                                      F.count(F.lit(1)).alias("_docs"))
    leaves = cut_lineage(leaves, "mix-leaves")
    levels = []
    below = leaves.select(*keys, (F.col("_sum") * F.lit(float(max_epochs))).alias("_cap"))
    for depth in range(len(keys), 0, -1):
        own = keys[:depth]
        nodes = below.groupBy(*own).agg(F.sum("_cap").alias("_cap")).withColumn(
            "_w", _weight(weights, [F.col(k) for k in own]))
        levels.append(nodes)
        below = nodes.where("_w > 0")
    total = leaves.agg(F.sum("_sum")).first()[0] or 0
    room = below.agg(F.sum("_cap")).first()[0] or 0.0
    budget = min(float(int(total * budget_share)), room)
    parents: list[str] = []
    given = None
    for depth, nodes in enumerate(reversed(levels), start=1):
        if given is None:
            children = nodes.withColumn("_budget", F.lit(budget))
        else:
            children = nodes.join(given.select(*parents, F.col("_given").alias("_budget")), parents)
        given = cut_lineage(share_budget(children, parents, keys[depth - 1]), "mix-level")
        parents = keys[:depth]
    plan = leaves.join(given.select(*keys, F.floor("_given").alias("_budget")), keys)
    return plan.withColumn(
        "_epochs", F.when(F.col("_sum") > 0, F.least(
            F.floor(F.col("_budget") / F.col("_sum")), F.lit(max_epochs))).otherwise(F.lit(0))
        .cast("long")).withColumn(
        "_rest", F.col("_budget") - F.col("_epochs") * F.col("_sum")).withColumn(
        "_buckets", F.ceil(F.col("_docs") / F.lit(BUCKET_DOCS)))


def _bucket(key: Column, buckets: Column) -> Column:
    place = F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(HASH_SPACE))
    return F.floor(place * buckets)


def mix_to_weights(docs: DataFrame, levels: Sequence[str],
                   weights: Mapping[tuple[str, ...], float], budget_share: float = 0.5,
                   max_epochs: int = 2, seed: int = 17, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """The selected rows of ``docs``, once for each epoch that takes them.

    Adds ``n_tokens`` (words of the whole text), ``epoch`` (from 0) and ``order_key``. The
    budget is ``budget_share`` of all tokens. A leaf takes ``floor(budget / tokens)`` whole
    epochs (``max_epochs`` at most), then of the next epoch the documents in seeded order
    while their running sum stays within the rest of its budget. Documents with equal ids, or
    without one, are ordered by their texts; of rows that agree in both as many are taken as
    the rest has room for.

    A null in a level column is a branch of its own; null texts have no tokens; a weight of 0
    closes a branch. Leaves without tokens are left out. An empty table gives no rows. Columns
    named like an output are replaced, all others are kept whatever they are called. No leaf is
    sorted as a whole: token sums of hash buckets locate the bucket in which the prefix ends,
    and only the different places of that bucket are ordered. Equal rows at the end of a
    prefix are counted off over ranges, not in one task.
    """
    keys = [f"_k{i}" for i in range(len(levels))]
    shelf = Shelved(docs)
    text = F.col(shelf.at(text_col))
    keyed = (shelf.table.withColumns({k: _key(shelf.at(c)) for k, c in zip(keys, levels, strict=True)})
             .withColumns({"_id": F.col(shelf.at(id_col)),
                           "_text": F.xxhash64(text), "_tokens": F.size(words(text)).cast("long")}))
    sized = cut_lineage(keyed.select(*keys, "_id", "_text", "_tokens"), "mix-sizes")
    plan = cut_lineage(leaf_plan(sized, keys, weights, budget_share, max_epochs), "mix-plan")

    placed = (sized.join(plan.select(*keys, "_epochs", "_rest", "_buckets"), keys)
              .where((F.col("_rest") > 0) & (F.col("_buckets") > 0))
              .withColumn("_order", _place(seed, F.col("_epochs")))
              .withColumn("_b", _bucket(F.col("_order"), F.col("_buckets"))))
    sums = placed.groupBy(*keys, "_b", "_rest").agg(F.sum("_tokens").alias("_s"))
    run = W.partitionBy(*keys).orderBy("_b")
    edge = (sums.withColumn("_cum", F.sum("_s").over(run)).where("_cum > _rest")
            .groupBy(*keys).agg(F.min_by(F.struct("_b", "_cum", "_s"), "_b").alias("_e"))
            .select(*keys, F.col("_e._b").alias("_edge"),
                    (F.col("_e._cum") - F.col("_e._s")).alias("_before")))
    edge = cut_lineage(edge, "mix-edge")
    last = W.partitionBy(*keys).orderBy("_order")
    ordered = cut_lineage(
        placed.join(edge.withColumnRenamed("_edge", "_b"), [*keys, "_b"])
        .groupBy(*keys, "_order", "_rest", "_before").agg(
            F.sum("_tokens").alias("_s"), F.count(F.lit(1)).alias("_n"),
            F.max("_tokens").alias("_each"))
        .withColumn("_cum", F.col("_before") + F.sum("_s").over(last)), "mix-places")
    cut = (ordered.where("_cum <= _rest").groupBy(*keys)
           .agg(F.max("_order").alias("_cut"), F.max("_cum").alias("_used")))
    # The first place that is too large as a whole: equal rows of which some may still fit.
    over = (ordered.where("_cum > _rest").groupBy(*keys)
            .agg(F.min_by(F.struct("_order", "_n", "_each", "_before"), "_order").alias("_o"))
            .join(cut.select(*keys, "_used"), keys, "left")
            .select(*keys, F.col("_o._order").alias("_split"), F.col("_o._n").alias("_n"),
                    F.col("_o._each").alias("_each"),
                    F.coalesce("_used", "_o._before").alias("_used")))
    ends = cut_lineage(
        plan.select(*keys, "_epochs", "_rest", "_buckets").join(edge, keys, "left")
        .join(cut.drop("_used"), keys, "left").join(over, keys, "left")
        .withColumn("_room", F.when((F.col("_n") > 1) & (F.col("_each") > 0), F.floor(
            (F.col("_rest") - F.col("_used")) / F.col("_each"))))
        .withColumn("_split", F.when(F.col("_room") > 0, F.col("_split")))
        .drop("_n", "_each", "_used"), "mix-ends")

    order = _place(seed, F.col("_epochs"))
    bucket = _bucket(order, F.col("_buckets"))
    in_prefix = (F.col("_rest") > 0) & (
        F.col("_edge").isNull() | (bucket < F.col("_edge"))
        | ((bucket == F.col("_edge")) & (order <= F.coalesce("_cut", F.lit("")))))
    copies = F.col("_epochs") + F.when(in_prefix, 1).otherwise(0)

    def result(rows: DataFrame) -> DataFrame:
        return shelf.finish(rows, n_tokens=F.col("_tokens"), epoch=F.col("epoch"),
                            order_key=order_key(seed, F.col("epoch"), F.col("_id")))

    whole = result(keyed.join(ends, keys).withColumn("_copies", copies).where("_copies > 0")
                   .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.col("_copies") - 1))))
    split = ends.where("_split IS NOT NULL")
    if split.isEmpty():
        return whole
    equal = cut_lineage(keyed.join(split, keys).where(order == F.col("_split"))
                        .withColumn("_leaf", F.to_json(F.struct(*keys))), "mix-equal")
    some = rank_within(equal, "_leaf", [], "mix-equal-order").where(F.col("rank") < F.col("_room"))
    return whole.unionByName(result(some.withColumn("epoch", F.col("_epochs"))))
