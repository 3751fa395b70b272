"""Cross-tokenizer alignment: token groups that two tokenizers cut at the same bytes.

Inside a task everything is Arrow: token lists are flattened with their parent indices,
segmented cumulative sums of token byte lengths give each token's end in its document, an
Acero join on (document, end) finds the ends that both tokenizers share, and grouped tables
give the links. Spark merges the partial counts and brings them back to the documents.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.session import cut_lineage, ship_package

# Bytes of text that are aligned at once (one longer text is aligned whole), the words whose
# tokens a task remembers, and the id pairs whose counts may be broadcast.
SLICE_BYTES = 1_000_000
MEMORY_BYTES = 48_000_000
BROADCAST_PAIRS = 600_000

# Pretoken pattern of the byte-level vocabulary; the blank mark of the other one.
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLANK = "▁"

# All white space characters, and where a single space is not between two words.
SPACES = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}" \
         r"\x{202F}\x{205F}\x{3000}]"
ODD = f"(?:^| ){SPACES}|{SPACES}(?: |$)"
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 bytes stand
    for themselves, the others for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Ids of ' ' + text by a byte-level BPE file (specials in texts are plain text)."""

    def __init__(self, spec: str) -> None:
        import tiktoken

        alphabet = byte_alphabet()
        model = json.loads(spec)
        special = {t["id"] for t in model["added_tokens"]}
        pieces = {bytes(alphabet[c] for c in p): i for p, i in model["model"]["vocab"].items()
                  if i not in special}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PRETOKENS, special_tokens={},
                                          mergeable_ranks=pieces)
        self.pieces = [b""] * (max(pieces.values()) + 1)
        for p, i in pieces.items():
            self.pieces[i] = p
        self.sizes = np.array([len(p) for p in self.pieces])

    def encode(self, words: list[str]) -> pa.ListArray:
        """The words are encoded in one text and told apart by the bytes of their tokens; those
        that start or end with white space one by one."""
        alone = [w[:1].isspace() or w[-1:].isspace() or not w for w in words]
        joined = "".join([" " + w for w, x in zip(words, alone, strict=True) if not x])
        flat = self.encoding.encode_to_numpy(joined, disallowed_special=()).astype(np.int32)
        ends = np.cumsum([len(w.encode()) + 1 for w, x in zip(words, alone, strict=True) if not x])
        if any(alone):
            cut = iter(np.split(flat, np.searchsorted(np.cumsum(self.sizes[flat]), ends, "right")))
            return pa.array([self.encoding.encode_ordinary(" " + w) if x else next(cut)
                             for w, x in zip(words, alone, strict=True)], pa.list_(pa.int32()))
        at = np.searchsorted(np.cumsum(self.sizes[flat]), ends, "right")
        return pa.ListArray.from_arrays(pa.array(_starts(np.diff(at, prepend=0)), pa.int32()), flat)


class Pieces:
    """Ids of texts by a sentence-piece model, which itself adds the first blank."""

    def __init__(self, proto: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i)
                       else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        # No piece goes on after a blank, so words are cut one by one with the same result.
        self.by_word = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in names)

    def encode(self, words: list[str]) -> pa.ListArray:
        return pa.array(self.model.encode(words, num_threads=1), pa.list_(pa.int32()))


class Memory:
    """Token lists of words, kept over the slices of a task; one growing list array a side."""

    def __init__(self, sides: tuple[ByteLevel, Pieces]) -> None:
        self.sides = sides
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.bytes = 0
        self.lists = [[pa.array([], pa.list_(pa.int32()))] for _ in self.sides]

    def learn(self, fresh: list[str]) -> None:
        n = len(self.known)
        self.known.update(zip(fresh, range(n, n + len(fresh)), strict=True))
        self.bytes += sum(map(len, fresh)) + 100 * len(fresh)
        for side, lists in zip(self.sides, self.lists, strict=True):
            lists.append(side.encode(fresh))

    def places(self, units: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, units, repeat(-1)), np.int32, len(units))

    def tokens(self, units: list[str]) -> list[pa.ListArray]:
        """The token lists of each unit, for both tokenizers."""
        if self.bytes > MEMORY_BYTES:
            self.clear()
        at = self.places(units)
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = [units[i] for i in new]
            self.learn(list(dict.fromkeys(missing)))
            at[new] = self.places(missing)
        for lists in self.lists:
            lists[:] = [pa.concat_arrays(lists)]
        return [lists[0].take(pa.array(at)) for lists in self.lists]


def _concat(pieces: pa.Array, at: pa.Array, starts: np.ndarray) -> pa.Array:
    """The pieces ``at`` end to end, cut at the token numbers ``starts`` (with the last end)."""
    taken = pieces.take(at)
    offsets = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, taken.offset * 8)
    return pa.Array.from_buffers(taken.type, len(starts) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets[starts])), taken.buffers()[2]])


def _counts(at, n: int) -> np.ndarray:
    return np.bincount(np.asarray(at), minlength=n)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


class Aligner:
    """Aligns slices of texts; ``align`` gives one row per text."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        self.sides = ByteLevel(byte_level), Pieces(pieces)
        self.memory = Memory(self.sides)
        self.raw = [pa.array(s.pieces, pa.large_binary()) for s in self.sides]
        self.length = [pc.binary_length(r) for r in self.raw]
        sizes = [len(s.pieces) for s in self.sides]
        # What a token adds to the text of the groups, inside and at the end of its group.
        self.shown = pa.array([f"{i}{mark}" for n, marks in zip(sizes, (",|", ",;"), strict=True)
                               for mark in marks for i in range(n)], pa.large_string())
        self.sizes = sizes

    def _tokens(self, texts: pa.Array) -> tuple[list[pa.Array], list[np.ndarray], np.ndarray]:
        """Ids, their documents, and which texts both tokenizers give back byte by byte."""
        n = len(texts)
        given = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(False)
        units, of = [], []
        held = texts.filter(pa.array(given))
        odd = pc.match_substring_regex(held, ODD).to_pylist()
        for i, x, y in zip(np.flatnonzero(given), held.to_pylist(), odd, strict=True):
            # At a single space between two words both tokenizers cut as well.
            cut = [x] if not self.sides[1].by_word else _BETWEEN.split(x) if y else x.split(" ")
            units += cut
            of.append((i, len(cut)))
        doc_of_unit = np.repeat(*np.array(of, np.int64).reshape(-1, 2).T)
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        expected = pc.binary_join_element_wise(blank, texts.cast(blank.type), none).cast(
            pa.large_binary())
        ids, docs, whole = [], [], given
        for lists, raw in zip(self.memory.tokens(units), self.raw, strict=True):
            flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
            doc = doc_of_unit[parents.to_numpy()]
            joined = _concat(raw, flat, _starts(_counts(doc, n)))
            whole = whole & pc.fill_null(pc.equal(joined, expected), False).to_numpy(False)
            ids.append(flat)
            docs.append(doc)
        for k in (0, 1):
            if not whole.all():
                keep = whole[docs[k]]
                ids[k], docs[k] = ids[k].filter(pa.array(keep)), docs[k][keep]
        return ids, docs, whole

    def align(self, texts: pa.Array) -> dict[str, pa.Array]:
        n = len(texts)
        ids, docs, whole = self._tokens(texts)
        ends = []
        for k in (0, 1):
            total = pc.cumulative_sum(pc.cast(self.length[k].take(ids[k]), pa.int64())).to_numpy()
            first = _starts(_counts(docs[k], n))[:-1]
            before = np.concatenate([[0], total])[first]
            # Document and end in one key.
            ends.append(pa.table({"end": (docs[k] << 40) + total - before[docs[k]],
                                  f"at{k}": np.arange(len(total))}))
        cuts = ends[0].join(ends[1], "end", join_type="inner", use_threads=False)
        group, last = [], []
        for k in (0, 1):
            cut = np.zeros(len(ids[k]), np.int64)
            cut[cuts[f"at{k}"].to_numpy()] = 1
            group.append(np.cumsum(cut) - cut)
            last.append(cut)
        n_groups = int(last[0].sum())
        doc_of = np.zeros(n_groups, np.int64)
        doc_of[group[0]] = docs[0]
        sizes = [_counts(g, n_groups) for g in group]
        out = {"n_a": _counts(docs[0], n), "n_b": _counts(docs[1], n),
               "n_groups": _counts(doc_of, n),
               "n_links": np.bincount(doc_of, sizes[0] * sizes[1], n).astype(np.int64)}
        out["groups"] = self._shown(ids, group, last, sizes, _starts(out["n_a"] + out["n_b"]))
        return {k: pa.array(v) for k, v in out.items()} | self._links(ids, group, doc_of, n)

    def _shown(self, ids: list, group: list, last: list, sizes: list, starts) -> pa.Array:
        """``a1,a2|b1;a3|b2`` of each text: both token runs merged group by group."""
        n_a, n_b = self.sizes
        begin = [_starts(s) for s in sizes]
        codes = np.zeros(len(group[0]) + len(group[1]), np.int64)
        codes[np.arange(len(group[0])) + begin[1][group[0]]] = ids[0].to_numpy() + n_a * last[0]
        codes[np.arange(len(group[1])) + begin[0][group[1] + 1]] = (
            2 * n_a + ids[1].to_numpy() + n_b * last[1])
        return pc.utf8_rtrim(_concat(self.shown, pa.array(codes), starts), ";")

    def _links(self, ids: list, group: list, doc_of: np.ndarray, n: int) -> dict[str, pa.Array]:
        """Per text the linked id pairs, each with the number of its links."""
        alone = [_counts(g, len(doc_of)) == 1 for g in group]
        plain = alone[0] & alone[1]
        a, b = (ids[k].to_numpy()[plain[group[k]]] for k in (0, 1))
        tables = [pa.table({"doc": doc_of[plain], "a": a, "b": b,
                            "links": np.ones(len(a), np.int64)})]
        if not plain.all():
            sides = []
            for k, name in ((0, "a"), (1, "b")):
                many = ~plain[group[k]]
                sides.append(pa.table({"group": group[k][many], name: ids[k].to_numpy()[many]})
                             .group_by(["group", name], use_threads=False)
                             .aggregate([([], "count_all")])
                             .rename_columns(["group", name, f"n_{name}"]))
            pairs = sides[0].join(sides[1], "group", join_type="inner", use_threads=False)
            tables.append(pa.table({
                "doc": doc_of[pairs["group"].to_numpy()], "a": pairs["a"], "b": pairs["b"],
                "links": pc.multiply(pairs["n_a"], pairs["n_b"])}))
        per = (pa.concat_tables(tables).group_by(["doc", "a", "b"], use_threads=False)
               .aggregate([("links", "sum")]).sort_by([("doc", "ascending"), ("a", "ascending"),
                                                       ("b", "ascending")]).combine_chunks())
        offsets = pa.array(_starts(_counts(per["doc"], n)).astype(np.int32))
        return {name: pa.ListArray.from_arrays(offsets, per[col].combine_chunks().cast(t))
                for name, col, t in (("a_ids", "a", pa.int32()), ("b_ids", "b", pa.int32()),
                                     ("pair_links", "links_sum", pa.int64()))}


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0), np.int64)
    start, held = 0, 0
    for i, s in enumerate(size):
        if i > start and held + s > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += s
    if len(size):
        yield batch.slice(start)


def align_texts(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, ``groups`` and id pairs.

    A are the tokens of space + text by the byte-level file ``byte_level``, B those of the text
    by the sentence-piece file ``pieces`` (both read on the driver and sent to the workers: they
    are vocabularies, a few MB). ``groups`` lists the token groups as ``a1,a2|b1;a3|b2``;
    ``a_ids``, ``b_ids`` and ``pair_links`` are the different linked id pairs of the text and how
    many links each has. Texts that are null or empty, or that either tokenizer does not give
    back byte by byte, have no tokens: zeros, '' and empty lists. Every row counts, repeated ids
    and rows too; other columns of ``docs`` are not read, whatever they are called; an empty
    table gives no rows. There is no shuffle; a task holds a slice of 1 MB of text (or one longer
    text) and the tokens of the words that it has met, a bounded number of bytes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    files = spark.sparkContext.broadcast((Path(byte_level).read_text(), Path(pieces).read_bytes()))
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "groups", "a_ids", "b_ids", "pair_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        for batch in batches:
            for part in _slices(batch):
                got = aligner.align(part.column(1))
                got["groups"] = got["groups"].cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *[got[x] for x in names]],
                                                 ["_id", *names])

    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")
                       ).mapInArrow(run, f"_id {kind}, n_a long, n_b long, n_groups long, "
                                    "n_links long, groups string, a_ids array<int>, "
                                    "b_ids array<int>, pair_links array<long>"
                                    ).withColumnRenamed("_id", id_col)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a batch hold each id pair."""
    for batch in batches:
        pairs = pa.table({"a": pc.list_flatten(batch.column(0)),
                          "b": pc.list_flatten(batch.column(1))})
        got = pairs.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        yield from got.rename_columns(["a", "b", "n"]).to_batches()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n_docs, best): rows with each linked id pair; best: no pair of ``a`` has more.

    Arrow counts each batch, Spark merges. The window over an id holds at most as many rows as
    the other vocabulary has entries.
    """
    merged = (aligned.select("a_ids", "b_ids").mapInArrow(_partial, "a int, b int, n long")
              .groupBy("a", "b").agg(F.sum("n").alias("n_docs")))
    return merged.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a")))


def _pair() -> F.Column:
    return F.shiftleft(F.col("a").cast("long"), 32).bitwiseOR(F.col("b").cast("long"))


def score_links(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to a written table of ``align_texts``.

    ``n_best``: links of pairs that no other pair of their A id beats in texts; ``count_sum``: the
    texts of a link's pair, summed over links. The counts of the commonest pairs (all with at
    least a number of texts that keeps them to ``broadcast_pairs``) are broadcast; links of the
    other pairs reach their counts by a shuffle join, so nothing grows with the corpus
    unchecked and no link is dropped. Columns of ``aligned`` other than the pair lists are kept.
    """
    counts = cut_lineage(pair_counts(aligned).select(_pair().alias("pair"), "n_docs", "best"),
                         "pair-counts")
    steps = Window.orderBy(F.desc("bucket"))
    # Pairs by powers of two of their texts: at most 63 rows.
    sizes = (counts.groupBy(F.floor(F.log2("n_docs")).alias("bucket")).count()
             .withColumn("pairs", F.sum("count").over(steps)).where(F.col("pairs") <= broadcast_pairs))
    low = sizes.agg(F.min("bucket")).first()[0]
    common = F.floor(F.log2("n_docs")) >= (64 if low is None else low)
    head, tail = counts.where(common), counts.where(~common)
    keep = [c for c in aligned.columns if c not in ("a_ids", "b_ids", "pair_links")]
    rows = aligned.withColumn("row_number", F.monotonically_increasing_id())
    links = rows.select("row_number", F.inline(F.arrays_zip(
        F.col("a_ids").alias("a"), F.col("b_ids").alias("b"), F.col("pair_links").alias("links"))))
    links = links.select("row_number", _pair().alias("key"), "links")
    sums = [F.sum("links").alias("links"), F.sum(F.when(F.col("best"), F.col("links"))
                                                 .otherwise(0)).alias("n_best"),
            F.sum(F.col("links") * F.col("n_docs")).alias("count_sum")]
    found = (links.join(F.broadcast(head), F.col("key") == F.col("pair"))
             .groupBy("row_number").agg(*sums))
    if not tail.isEmpty():
        rest = (links.join(F.broadcast(head.select("pair")), F.col("key") == F.col("pair"), "left_anti")
                .join(tail, F.col("key") == F.col("pair")).groupBy("row_number").agg(*sums))
        found = found.unionByName(rest).groupBy("row_number").agg(
            *[F.sum(c).alias(c) for c in ("links", "n_best", "count_sum")])
    found = found.select(F.col("row_number").alias("found"), "n_best", "count_sum")
    return (rows.join(found, F.col("row_number") == F.col("found"), "left")
            .select(*keep, F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum")))
