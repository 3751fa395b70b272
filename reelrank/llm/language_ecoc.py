"""Language identification with error-correcting output codes.

Each language has a codeword. For every bit of the code a binary n-gram classifier (the
log-odds of hashed byte n-grams between the languages with and without that bit) predicts
the bit of a text; loss-weighted decoding takes the codeword with the least weighted
logistic loss and flags texts whose best two codewords are close.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import without
from reelrank.session import cut_lineage, ship_package

DIM_BITS = 15
DIM = 1 << DIM_BITS
SLICE = 1 << 16
# ASCII letters in lower case, other ASCII characters as blanks, further bytes as they are.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def ngrams(text: str) -> Iterator[np.ndarray]:
    """Hashed byte 2-, 3- and 4-grams of the whole text, slice by slice."""
    raw = b" " + text.encode("utf-8", "surrogatepass").translate(_FOLD) + b" "
    for at in range(0, len(raw), SLICE):
        b = np.frombuffer(raw[at:at + SLICE + 3], np.uint8).astype(np.uint64)
        code = b[:-1] << np.uint64(8) | b[1:]
        for n in (2, 3, 4):
            if n > 2:
                code = code[:-1] << np.uint64(8) | b[n - 1:]
            if len(code):
                mixed = (code + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)
                yield (mixed[:SLICE] >> np.uint64(64 - DIM_BITS)).astype(np.int64)


def code_matrix(n_classes: int, seed: int = 11) -> np.ndarray:
    """A +1/-1 row per class. Up to seven classes: every split of the classes in two;
    beyond, the best of seeded random codes by the least distance between rows."""
    if n_classes <= 7:
        cols = [[(j >> (i - 1)) & 1 if i else 0 for i in range(n_classes)]
                for j in range(1, 1 << max(n_classes - 1, 0))]
        return 2 * np.array(cols, np.int64).reshape(-1, n_classes).T - 1
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(15 * np.log2(n_classes)))
    best, far = None, -1
    for _ in range(50):
        code = rng.integers(0, 2, (n_classes, bits))
        code[0, code.all(axis=0)] = 0
        code[0, ~code.any(axis=0)] = 1
        gap = min(int((code[i] != code[j]).sum())
                  for i in range(n_classes) for j in range(i))
        if gap > far:
            best, far = code, gap
    return 2 * best - 1


class EcocModel:
    """``weights`` [DIM, bits], per-bit ``scale`` and ``trust``, the code and the languages."""

    def __init__(self, langs: list[str], counts: np.ndarray, alpha: float = 0.5):
        self.langs = langs
        self.code = code_matrix(len(langs))
        profile = (counts + alpha) / (counts.sum(axis=1, keepdims=True) + alpha * DIM)
        cols = [np.log(profile[bit > 0].mean(axis=0)) - np.log(profile[bit < 0].mean(axis=0))
                for bit in self.code.T]
        self.weights = np.array(cols, np.float32).reshape(len(cols), DIM).T.copy()
        self.scale = np.ones(len(cols))
        self.trust = np.ones(len(cols))

    def margins(self, text: str) -> np.ndarray:
        """The mean log-odds of each bit over the n-grams of a text."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for idx in ngrams(text):
            total += self.weights[idx].sum(axis=0, dtype=np.float64)
            n += len(idx)
        return total / max(n, 1)

    def decode(self, margins: np.ndarray) -> tuple[int, float, float]:
        """Index of the language, score (softmax of the losses) and the gap to the second."""
        z = np.clip(4.0 * self.code * (margins / self.scale), -30, 30)
        loss = (np.log1p(np.exp(-z)) * self.trust).sum(axis=1)
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        order = np.argsort(-p, kind="stable")
        gap = float(p[order[0]] - p[order[1]]) if len(order) > 1 else 1.0
        return int(order[0]), float(p[order[0]]), gap


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, fit_rows: int = 5000) -> EcocModel | None:
    """Learn from rows ``_id, _text, _lang``; None if there is none.

    ``fit_rows`` bounds the sample: about so many rows of each language, picked by a hash of
    the id (all, where a language has fewer), one row for each id. Languages are assumed to be few enough to
    list; the counts of the sample reach the driver as one array per language and task.
    """
    spark = labelled.sparkSession
    ship_package(spark)
    labelled = labelled.where(F.col("_lang").isNotNull() & has_letter(F.col("_text")))
    sizes = {r["_lang"]: r["n"] for r in
             labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    place = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("_lang") == lang, F.lit(min(1.0, fit_rows / n))).otherwise(share)
    one = labelled.where(place <= share).groupBy("_id").agg(
        F.min(F.struct("_lang", "_text")).alias("_row"))
    sample = cut_lineage(one.select("_row._text", "_row._lang").repartition(8), "ecoc-sample")
    number = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((len(langs), DIM), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                row = own[number[lang.as_py()]]
                for idx in ngrams(text.as_py()):
                    row += np.bincount(idx, minlength=DIM)
        used = np.flatnonzero(own.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([own[i].tobytes() for i in used], pa.binary())],
            ["_l", "_counts"])

    counts = np.zeros((len(langs), DIM), np.int64)
    for r in sample.mapInArrow(count, "_l long, _counts binary").collect():
        counts[r["_l"]] += np.frombuffer(r["_counts"], np.int64)
    model = EcocModel(langs, counts)
    if len(langs) == 1:
        return model
    held = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        n, wrong, size = 0, np.zeros(m.code.shape[1]), np.zeros(m.code.shape[1])
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                got = m.margins(text.as_py())
                wrong += got * m.code[number[lang.as_py()]] <= 0
                size += np.abs(got)
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([n]), pa.array([wrong.tolist()]), pa.array([size.tolist()])],
            ["_n", "_wrong", "_size"])

    rows = sample.mapInArrow(judge, "_n long, _wrong array<double>, _size array<double>").collect()
    n = max(1, sum(r["_n"] for r in rows))
    wrong = np.sum([r["_wrong"] for r in rows], axis=0) / n
    model.trust = np.clip(1 - 2 * wrong, 0.05, 1.0)
    model.scale = np.maximum(np.sum([r["_size"] for r in rows], axis=0) / n, 1e-9)
    return model


def identify(docs: DataFrame, learn_from: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", fit_rows: int = 5000,
             min_gap: float = 0.2, held_out: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``held_out``, ``lang_pred``, ``score`` (0 to 1)
    and ``ambiguous``.

    ``learn_from`` (rows with id, text and language) is the only source of the model; the
    prediction of a text uses nothing but the text. Null texts and texts without a letter
    are ``und`` with score 0 and ambiguous, and so is everything if nothing can be learned.
    A text is ambiguous if the scores of its two best codewords differ by less than
    ``min_gap``. Repeated rows are each judged; an empty table gives no rows; other columns
    are not read. No shuffle follows the fit.
    """
    spark = docs.sparkSession
    ship_package(spark)
    model = fit(without(learn_from).select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"),
        F.col(f"`{lang_col}`").alias("_lang")), fit_rows)
    held = spark.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            lang, score, close = [], [], []
            for text, letter in zip(batch.column(2), batch.column(3), strict=True):
                if m is None or not letter.as_py():
                    got = ("und", 0.0, True)
                else:
                    i, p, gap = m.decode(m.margins(text.as_py()))
                    got = (m.langs[i], p, gap < min_gap)
                lang.append(got[0])
                score.append(got[1])
                close.append(got[2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(close, pa.bool_())],
                ["_id", "held_out", "lang_pred", "score", "ambiguous"])

    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("_id"),
        (F.lit(False) if held_out is None else held_out).alias("_held"), text.alias("_text"),
        has_letter(text).alias("_letter")).mapInArrow(
            run, f"_id {id_type}, held_out boolean, lang_pred string, score double, "
                 "ambiguous boolean").withColumnRenamed("_id", id_col)
