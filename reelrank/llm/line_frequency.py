"""Quality rules with cross-document line frequency.

Per document: counts of words, symbols, duplicate lines and repeated three-word windows.
Across documents: normalised lines are hashed, the distinct documents of each host that
hold a line are counted, lines above the limit are removed and documents that lose too
much are rejected. Everything is column expressions, joins and grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import BLANKS, Shelved, let, words
from reelrank.session import cut_lineage


def repeated_words(word_array: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the same text.

    Windows are compared by 64-bit hashes; (hash, position) pairs are sorted and equal
    neighbours marked, so the cost is n log n in the words of one text.
    """
    def grams(h):
        two = F.zip_with(h, F.slice(h, 2, F.size(h)), lambda a, b: F.xxhash64(a, b))
        three = F.zip_with(two, F.slice(h, 3, F.size(h)), lambda ab, c: F.xxhash64(ab, c))
        return F.slice(three, 1, F.size(h) - 2)

    def marked(s):
        return F.filter(s, lambda e, i: e["g"].eqNullSafe(F.get(s, i - 1)["g"])
                        | e["g"].eqNullSafe(F.get(s, i + 1)["g"]))

    def covered(p):
        gaps = F.transform(p, lambda x, k: F.least(
            F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def pairs(h):
        return F.sort_array(F.transform(
            grams(h), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def count(w):
        hashes = F.transform(w, lambda x: F.xxhash64(x))
        positions = let(hashes, lambda h: let(pairs(h), lambda s: F.sort_array(
            F.transform(marked(s), lambda e: e["i"]))))
        return let(positions, covered)

    return F.when(F.size(word_array) < 4, F.lit(0).cast("long")).otherwise(count(word_array))


def normalised_line(line: Column) -> Column:
    """Lower case, blanks squeezed to one space and trimmed."""
    return F.trim(F.lower(F.regexp_replace(line, BLANKS, " ")))


def text_lines(text: Column) -> Column:
    """The lines of a text that hold at least one word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                    lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def line_hash(line: Column) -> Column:
    return F.xxhash64(normalised_line(line))


def base_counts(text: Column) -> Column:
    """Struct of the per-document counts and the hashed lines with their sizes."""
    full = F.coalesce(text, F.lit(""))
    blanks = " \t\n\x0b\x0c\r"
    from_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    from_lines = let(text_lines(text), lambda x: F.struct(
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.transform(x, lambda y: let(normalised_line(y), lambda z: F.struct(
            F.xxhash64(z).alias("h"), F.length(z).cast("long").alias("n")))).alias("lines")))
    return F.struct(
        from_words.alias("w"), from_lines.alias("l"),
        F.length(F.translate(full, blanks, "")).cast("long").alias("word_chars"),
        (F.length(full) - F.length(F.translate(full, "#*$%&|<>", ""))).cast("long")
        .alias("n_symbols"))


def null_id_text(id_col: str, text_col: str) -> Column:
    """What tells documents without an id apart: a hash of their text (null with an id)."""
    return F.when(F.col(f"`{id_col}`").isNull(), F.xxhash64(F.col(f"`{text_col}`")))


def line_documents(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row for each (host, line, document); copies of a line in a document count once."""
    hashes = F.array_distinct(F.transform(text_lines(F.col(f"`{text_col}`")), line_hash))
    return (docs.select(F.col(f"`{id_col}`").alias("_id"),
                        null_id_text(id_col, text_col).alias("_tid"), F.col(f"`{host_col}`").alias("_host"),
                        F.explode(hashes).alias("_h")).distinct())


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 host_col: str = "source", max_docs: int = 20, min_left: float = 0.3,
                 min_words: int = 50, max_repeat: float = 0.5) -> DataFrame:
    """Add the counts, ``clean_text`` and the verdict ``kept`` to every row of ``docs``.

    A line is removed if more than ``max_docs`` distinct documents of the same host hold
    it (after lower-casing and squeezing blanks). ``base_failed``: fewer than
    ``min_words`` words, or more than ``max_repeat`` of the words in repeated windows.
    ``kept`` is false if ``base_failed`` or if less than ``min_left`` of the line
    characters is left.

    Null text has no words and fails the base rules; a null host is a host of its own; rows
    that repeat an id count as one document and are each judged, rows without an id are told
    apart by their texts. Columns named like an
    output are replaced. An empty table gives an empty result. A line or host that holds a
    large share of the rows is one key of a grouped count and a skew-split join; no group
    is collected, apart from the removed lines of one document.
    """
    shelf = Shelved(docs)
    docs, id_col, text_col, host_col = shelf.table, *map(shelf.at, (id_col, text_col, host_col))
    found = cut_lineage(line_documents(docs, id_col, text_col, host_col), "line-docs")
    frequent = cut_lineage(
        found.groupBy("_host", "_h").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > max_docs)
        .select(F.col("_host").alias("_fhost"), F.col("_h").alias("_fh")), "frequent-lines")
    removed = cut_lineage(
        found.join(frequent, (F.col("_h") == F.col("_fh"))
                   & F.col("_host").eqNullSafe(F.col("_fhost")))
        .groupBy(F.col("_id").alias("_rid"), F.col("_tid").alias("_rtid")).agg(F.collect_set("_h").alias("_removed")),
        "removed-lines")
    text = F.col(f"`{text_col}`")
    base = (docs.withColumn("_key", F.col(f"`{id_col}`")).withColumn("_text", text)
            .withColumn("_tkey", null_id_text(id_col, text_col))
            .withColumn("_f", base_counts(text)))
    joined = base.join(removed, F.col("_key").eqNullSafe(F.col("_rid"))
                       & F.col("_tkey").eqNullSafe(F.col("_rtid")), "left")
    gone = F.coalesce("_removed", F.array().cast("array<long>"))
    total = F.aggregate("_f.l.lines", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    left = F.aggregate("_f.l.lines", F.lit(0).cast("long"), lambda a, x: a + F.when(
        F.array_contains(gone, x["h"]), F.lit(0)).otherwise(x["n"]))
    n, repeat = F.col("_f.w.n_words"), F.col("_f.w.n_repeat_words")
    clean = F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(
        F.split("_text", "\n", -1), lambda x: ~F.array_contains(gone, line_hash(x))), "\n"))
    failed = (n < min_words) | (repeat > max_repeat * n)
    sized = joined.withColumns({"_total": total, "_left": left})
    return shelf.finish(
        sized, n_words=n, word_chars=F.col("_f.word_chars"), n_symbols=F.col("_f.n_symbols"),
        n_dup_lines=F.col("_f.l.n_dup_lines"), n_repeat_words=repeat, base_failed=failed,
        n_line_chars=F.col("_total"), n_left_chars=F.col("_left"),
        kept=~failed & (F.col("_left") >= min_left * F.col("_total")), clean_text=clean)
