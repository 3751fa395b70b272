"""Chat formatting by quotation linking.

Messages quote earlier ones with leading ``>`` marks, nested for quotes of quotes. Quoted
lines are parsed by level, normalised and hashed, and joined to the messages that wrote
them; the message quoted at the outermost linked level is the one replied to. The result
is every message without its quotes, with its place in the reply order of its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelrank.llm.common import BLANKS, Shelved, let
from reelrank.session import cut_lineage

# Lines with more authors in a conversation are common ones.
COMMON_AUTHORS = 16
# A run of quote marks, and the line that introduces a quote.
MARKS = r"^(?:[ \t]*>)+"
INTRO = r"(?i)^on\b.*\bwrote:[ \t]*$"


def parse_lines(text: Column) -> Column:
    """Array of struct(level, content, intro, norm): one per line. ``intro`` marks the
    introduction of a deeper quote; introductions of the outermost quotes are left out."""
    def one(line):
        marks = F.regexp_extract(line, MARKS, 0)
        return let(marks, lambda m: F.struct(
            F.length(F.regexp_replace(m, "[^>]", "")).alias("level"),
            F.when(m == "", line).otherwise(F.regexp_replace(line, MARKS + r"[ \t]?", ""))
            .alias("content")))

    def keep(rows):
        marked = F.transform(rows, lambda x, i: F.struct(
            x["level"].alias("level"), x["content"].alias("content"),
            (x["content"].rlike(INTRO) & (F.coalesce(F.get(rows, i + 1)["level"], F.lit(0))
                                          > x["level"])).alias("intro")))
        return F.filter(marked, lambda x: ~((x["level"] == 0) & x["intro"]))

    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return let(F.transform(lines, one), lambda rows: F.transform(keep(rows), lambda x: F.struct(
        x["level"].alias("level"), x["content"].alias("content"), x["intro"].alias("intro"),
        F.trim(F.lower(F.regexp_replace(x["content"], BLANKS, " "))).alias("norm"))))


def own_text(lines: Column) -> Column:
    """The unquoted lines, without blank lines at either end."""
    own = F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["content"])
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def latest_authors(authored: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (``_t, _h, _o``, others) with ``_latest``: the last place before ``_o`` at
    which the line was written (``authored``: ``_t, _h, _o``).

    Range partitions and the last place of each line per partition give the answer, so no
    task has to hold all uses of a line.
    """
    rows = (asked.withColumn("_by", F.lit(None).cast(authored.schema["_o"].dataType))
            .unionByName(authored.withColumn("_by", F.col("_o")), allowMissingColumns=True)
            .withColumn("_own", F.col("_by").isNotNull()))
    parts = cut_lineage(rows.repartitionByRange("_t", "_h", "_o", "_own")
                        .withColumn("_p", F.spark_partition_id()), "line-uses")
    before = parts.groupBy("_t", "_h", "_p").agg(F.max("_by").alias("_last")).withColumn(
        "_before", F.max("_last").over(W.partitionBy("_t", "_h").orderBy("_p")
                                       .rowsBetween(W.unboundedPreceding, -1)))
    # An asker comes before the author of its own place.
    here = F.max("_by").over(W.partitionBy("_t", "_h", "_p").orderBy("_o", "_own")
                             .rowsBetween(W.unboundedPreceding, W.currentRow))
    return (parts.withColumn("_here", here).where(~F.col("_own"))
            .join(before.select("_t", "_h", "_p", "_before"), ["_t", "_h", "_p"])
            .withColumn("_latest", F.coalesce("_here", "_before"))
            .drop("_p", "_by", "_own", "_here", "_before"))


def links(messages: DataFrame, min_share: float, common: int = COMMON_AUTHORS) -> DataFrame:
    """(``_t, _o, _level, _to, _share``): the message that each quote level was taken from.

    ``messages``: ``_t`` (conversation), ``_o`` (place), ``_lines``. Every earlier message of
    the conversation may be the one quoted: that with most distinct lines of the level wins
    (ties: the latest), if it wrote ``min_share`` of them. Quoted introductions are not lines
    of a level: no message can have written them.

    A line of at most ``common`` authors names all of them, and these are given their votes of
    the common lines too. Messages that share nothing but common lines with a level are found
    without listing them: see ``by_common_lines``.
    """
    lines = messages.select("_t", "_o", F.explode(F.array_distinct(F.transform(
        F.filter("_lines", lambda x: (x["norm"] != "") & ~x["intro"]),
        lambda x: F.struct(x["level"].alias("level"), F.xxhash64(x["norm"]).alias("h"))))
    ).alias("_x")).select("_t", "_o", F.col("_x.level").alias("_level"), F.col("_x.h").alias("_h"))
    lines = cut_lineage(lines.distinct(), "message-lines")
    by = ["_t", "_o", "_level"]
    quoted = lines.where("_level > 0")
    asked = quoted.select("_t", "_h").distinct()
    written = cut_lineage(lines.where("_level = 0").select("_t", "_h", "_o")
                          .join(asked, ["_t", "_h"], "left_semi"), "quoted-authors")
    authors = written.groupBy("_t", "_h").agg(F.count(F.lit(1)).alias("_authors"),
                                              F.min("_o").alias("_first"))
    found = cut_lineage(quoted.join(authors, ["_t", "_h"]).where("_first < _o").drop("_first"),
                        "found-lines")
    total = quoted.groupBy(*by).agg(F.count(F.lit(1)).alias("_all"))
    rare, often = found.where(F.col("_authors") <= common), found.where(F.col("_authors") > common)
    wrote = written.select(F.col("_t").alias("_wt"), F.col("_h").alias("_wh"),
                           F.col("_o").alias("_to"))
    same_line = (F.col("_t") == F.col("_wt")) & (F.col("_h") == F.col("_wh"))
    named = cut_lineage(rare.join(wrote, same_line).where("_to < _o")
                        .groupBy(*by, "_to").agg(F.count(F.lit(1)).alias("_n")), "named-authors")
    also = (named.select(*by, "_to").join(often.select(*by, "_h"), by)
            .join(wrote.withColumnRenamed("_to", "_wo"), same_line & (F.col("_to") == F.col("_wo")))
            .groupBy(*by, "_to").agg(F.count(F.lit(1)).alias("_n")))
    votes = named.unionByName(also).groupBy(*by, "_to").agg(F.sum("_n").alias("_n"))
    votes = votes.unionByName(by_common_lines(often, written, total, min_share, common))
    best = votes.groupBy(*by).agg(F.max(F.struct("_n", "_to")).alias("_best"))
    return (best.join(total, by)
            .select(*by, F.col("_best._to").alias("_to"),
                    (F.col("_best._n") / F.col("_all")).alias("_share"))
            .where(F.col("_share") >= min_share))


def by_common_lines(often: DataFrame, written: DataFrame, total: DataFrame, min_share: float,
                    common: int) -> DataFrame:
    """(``_t, _o, _level, _to, _n``): of the messages before ``_o`` that wrote most of a level's
    common lines the latest, where these lines may be ``min_share`` of the level.

    Levels that quote the same set of common lines are one question, messages that wrote the
    same set one answer; votes are counted between different sets only. The answers with the
    same votes are then one sequence of places, in which the latest before ``_o`` is looked up.
    """
    def sets(rows: DataFrame, by: list[str], name: str) -> DataFrame:
        # The common lines of one message.
        return (rows.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias("_hs"))
                .withColumn(name, F.xxhash64("_hs")))

    questions = cut_lineage(
        sets(often, ["_t", "_o", "_level"], "_q").join(total, ["_t", "_o", "_level"])
        .where(F.size("_hs") >= min_share * F.col("_all")).drop("_all"), "common-questions")
    used = (questions.select("_t", F.explode("_hs").alias("_h")).distinct())
    answers = cut_lineage(sets(written.join(used, ["_t", "_h"], "left_semi"), ["_t", "_o"], "_a"),
                          "common-answers")
    kinds = answers.groupBy("_t", "_a").agg(F.min("_o").alias("_first"), F.first("_hs").alias("_hs"))
    pairs = cut_lineage(
        questions.select("_t", "_q", "_hs").distinct()
        .select("_t", "_q", F.explode("_hs").alias("_h"))
        .join(kinds.select("_t", "_a", "_first", F.explode("_hs").alias("_h")), ["_t", "_h"])
        .groupBy("_t", "_q", "_a").agg(F.count(F.lit(1)).alias("_n"), F.first("_first").alias("_first")),
        "common-votes")
    firsts = pairs.groupBy("_t", "_q", "_n").agg(F.min("_first").alias("_first"))
    most = cut_lineage(
        questions.select("_t", "_o", "_level", "_q").join(firsts, ["_t", "_q"])
        .where("_first < _o").groupBy("_t", "_o", "_level", "_q").agg(F.max("_n").alias("_n"))
        .withColumn("_h", F.xxhash64("_q", "_n")), "common-most")
    places = (pairs.withColumn("_h", F.xxhash64("_q", "_n")).select("_t", "_a", "_h")
              .join(most.select("_t", "_h").distinct(), ["_t", "_h"], "left_semi")
              .join(answers.select("_t", "_a", "_o"), ["_t", "_a"]).select("_t", "_h", "_o"))
    latest = latest_authors(places, most.select("_t", "_h", "_o", "_level", "_n"))
    return latest.where("_latest IS NOT NULL").select(
        "_t", "_o", "_level", F.col("_latest").alias("_to"), "_n")


def reply_trees(nodes: DataFrame) -> DataFrame:
    """(``_t, _o, _root, _depth``) from (``_t, _o, _up``), by pointer doubling.

    ``_up`` is null at a root. Every round doubles the distance that a pointer spans, so the
    rounds grow with the logarithm of the longest chain of replies.
    """
    now = cut_lineage(nodes.select(
        "_t", "_o", F.coalesce("_up", "_o").alias("_root"),
        F.when(F.col("_up").isNull(), 0).otherwise(1).cast("long").alias("_depth"),
        F.col("_up").isNull().alias("_done")), "reply-pointers")
    while now.where("NOT _done").limit(1).count():
        above = now.select(F.col("_t").alias("_at"), F.col("_o").alias("_ao"),
                           F.col("_root").alias("_aroot"), F.col("_depth").alias("_adepth"))
        # Pointers that have reached a root take no further part.
        moved = now.where("NOT _done").join(
            above, (F.col("_t") == F.col("_at")) & (F.col("_root") == F.col("_ao"))).select(
                "_t", "_o", F.col("_aroot").alias("_root"),
                (F.col("_depth") + F.col("_adepth")).alias("_depth"),
                (F.col("_adepth") == 0).alias("_done"))
        now = cut_lineage(now.where("_done").unionByName(moved), "reply-pointers")
    return now.drop("_done")


def reply_order(tree: DataFrame) -> DataFrame:
    """Adds ``_position`` (from 0) by (root, depth, place) within each conversation.

    Range partitions and the counts of each conversation per partition give the position,
    so no task has to hold a conversation.
    """
    by = ["_t", "_root", "_depth", "_o"]
    parts = cut_lineage(tree.repartitionByRange(*by).withColumn("_p", F.spark_partition_id()),
                        "reply-order")
    counts = parts.groupBy("_t", "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        W.partitionBy("_t").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0))).drop("_n")
    local = F.row_number().over(W.partitionBy("_t", "_p").orderBy("_root", "_depth", "_o")) - 1
    return (parts.withColumn("_local", local).join(before, ["_t", "_p"])
            .withColumn("_position", F.col("_local") + F.col("_before"))
            .drop("_p", "_local", "_before"))


def link_quotes(messages: DataFrame, thread_col: str = "conv_id", order_col: str = "turn",
                text_col: str = "text", min_share: float = 0.5) -> DataFrame:
    """Every row of ``messages`` with ``body`` (its text without quotes), ``n_quoted_lines``,
    ``quote_levels`` (deepest), ``reply_to`` (the message replied to, null if none),
    ``root``, ``depth`` and ``position`` (its place in the conversation in reply order:
    by root, depth and original place).

    Rows with a null conversation or place are returned with their body, outside any
    conversation (null links and position). Null texts have an empty body. Rows that repeat
    a conversation and place are one message whose lines are taken together; each row is
    returned. A message never replies to itself or to a later one. Columns named like an
    output are replaced; others pass through; an empty table gives no rows. Joins are on
    (conversation, line) or (conversation, place), so a conversation that holds a large
    share of the rows is spread over tasks.
    """
    shelf = Shelved(messages)
    keyed = shelf.table.withColumns({
        "_lines": parse_lines(F.col(shelf.at(text_col))), "_t": F.col(shelf.at(thread_col)),
        "_o": F.col(shelf.at(order_col))})
    placed = cut_lineage(keyed.where("_t IS NOT NULL AND _o IS NOT NULL")
                         .select("_t", "_o", "_lines"), "messages")
    found = links(placed, min_share)
    up = found.groupBy("_t", "_o").agg(F.min_by("_to", "_level").alias("_up"))
    nodes = placed.select("_t", "_o").distinct().join(up, ["_t", "_o"], "left")
    nodes = cut_lineage(nodes, "reply-nodes")
    tree = reply_order(reply_trees(nodes)).join(nodes, ["_t", "_o"])
    tree = cut_lineage(tree.withColumnsRenamed({"_t": "_jt", "_o": "_jo"}), "reply-tree")
    quoted = F.filter("_lines", lambda x: x["level"] > 0)
    levels = F.array_max(F.transform("_lines", lambda x: x["level"]))
    return shelf.finish(
        keyed.join(tree, (F.col("_t") == F.col("_jt")) & (F.col("_o") == F.col("_jo")), "left"),
        body=own_text(F.col("_lines")), n_quoted_lines=F.size(quoted).cast("long"),
        quote_levels=F.coalesce(levels, F.lit(0)), reply_to=F.col("_up"), root=F.col("_root"),
        depth=F.col("_depth"), position=F.col("_position"))
