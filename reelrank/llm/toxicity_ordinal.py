"""Toxicity by cumulative-link ordinal regression on sparse text features.

``P(grade <= k | x) = sigmoid(cut_k - w.x)``: one weight vector for all ordered cuts. The
output is the expected severity ``sum_k P(grade >= k)`` besides the grade probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.session import cut_lineage, ship_package

WORD = re.compile(r"\w+")
STEM = 5
GRADES = 4


def features(text: str | None) -> Counter:
    """Counts of the words of the whole lower-cased text and of the stems of longer words."""
    found = Counter(WORD.findall((text or "").lower()))
    for w, n in list(found.items()):
        if len(w) > STEM:
            found[w[:STEM] + "*"] += n
    return found


def select_features(texts: list[str], toxic: np.ndarray, min_docs: int,
                    min_z: float, most: int) -> list[str]:
    """Features whose document frequencies in toxic and other texts differ clearly."""
    with_, without_ = Counter(), Counter()
    for t, y in zip(texts, toxic, strict=True):
        (with_ if y else without_).update(features(t).keys())
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    rated = []
    for f, a in with_.items():
        b = without_[f]
        if a + b < min_docs:
            continue
        p = (a + b) / (n1 + n0)
        z = (a / n1 - b / n0) / max(1e-12, (p * (1 - p) * (1 / n1 + 1 / n0)) ** 0.5)
        if abs(z) >= min_z:
            rated.append((-abs(z), f))
    return [f for _, f in sorted(rated)[:most]]


def severity_grades(texts: list[dict[str, int]], toxic: np.ndarray, names: list[str]) -> np.ndarray:
    """Grades 0 to 3 from yes/no labels: toxic texts are graded by thirds of how often they
    hold features that are found in toxic texts only (nineteen of twenty times)."""
    with_, all_ = Counter(), Counter()
    keep = set(names)
    for f, y in zip(texts, toxic, strict=True):
        own = keep.intersection(f)
        all_.update(own)
        if y:
            with_.update(own)
    marks = {f for f in names if with_[f] >= 0.95 * all_[f] and not f.endswith("*")}
    hits = np.array([sum(n for w, n in f.items() if w in marks) for f in texts], float)
    low, high = np.quantile(hits[toxic], [1 / 3, 2 / 3]) if toxic.any() else (0, 0)
    return np.where(toxic, 1 + (hits > low) + (hits > high), 0)


def fit_cumulative_link(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int, dim: int,
                        grade: np.ndarray, l2: float = 1e-4, steps: int = 400,
                        rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cuts by gradient descent (Adam) on the likelihood of the grades.

    Cuts are the first cut plus exponentials, so they stay in order.
    """
    k = GRADES - 1
    share = np.clip([(grade <= j).mean() for j in range(k)], 0.01, 0.99)
    first = np.log(share / (1 - share))
    gaps = np.maximum(np.diff(first), 0.05)
    theta = np.concatenate([np.zeros(dim), [first[0]], np.log(gaps)])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    at = np.arange(n)
    for step in range(1, steps + 1):
        w, cuts = theta[:dim], np.cumsum([theta[dim], *np.exp(theta[dim + 1:])])
        x = np.bincount(rows, vals * w[cols], minlength=n)
        s = 1 / (1 + np.exp(-np.clip(cuts[None, :] - x[:, None], -35, 35)))
        cdf = np.concatenate([np.zeros((n, 1)), s, np.ones((n, 1))], axis=1)
        slope = np.concatenate([np.zeros((n, 1)), s * (1 - s), np.zeros((n, 1))], axis=1)
        p = np.maximum(cdf[at, grade + 1] - cdf[at, grade], 1e-9)
        up, down = slope[at, grade + 1] / p, slope[at, grade] / p
        g_x = (up - down) / n
        g_w = np.bincount(cols, vals * g_x[rows], minlength=dim) + l2 * w
        g_cut = np.array([(-(up * (grade == j)) + down * (grade == j + 1)).sum() / n
                          for j in range(k)])
        tail = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate([g_w, [tail[0]], tail[1:] * np.exp(theta[dim + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return theta[:dim], np.cumsum([theta[dim], *np.exp(theta[dim + 1:])])


def fit_texts(texts: list[str], labels: list[int], min_docs: int, min_z: float,
              most: int) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    toxic = np.array(labels, bool)
    if not toxic.any() or toxic.all():
        return None
    names = select_features(texts, toxic, min_docs, min_z, most)
    if not names:
        return None
    number = {f: i for i, f in enumerate(names)}
    # Counted again, so that only the selected features of the sample are held at once.
    found = [{w: n for w, n in features(t).items() if w in number} for t in texts]
    grade = severity_grades(found, toxic, names)
    rows, cols, vals = [], [], []
    for i, f in enumerate(found):
        for w, n in f.items():
            rows.append(i)
            cols.append(number[w])
            vals.append(np.log1p(n))
    weights, cuts = fit_cumulative_link(
        np.array(rows, np.int64), np.array(cols, np.int64), np.array(vals, float), len(found),
        len(names), grade)
    return names, weights, cuts


def fit(rows: DataFrame, known: DataFrame, fit_rows: int = 6000, min_docs: int = 5,
        min_z: float = 4.0, most: int = 20_000) -> tuple[dict[str, float], list[float]] | None:
    """(weights by feature, cuts) from texts ``_id, _text`` and labels ``_lid, _toxic``.

    ``fit_rows`` bounds the sample: about so many toxic and as many other ids, picked by a
    hash of the id (all, where there are fewer), one text for each. The sample is drawn from
    the ids alone and then meets the texts. One task fits it and returns at most ``most``
    features. None without labelled texts of both kinds.
    """
    ship_package(rows.sparkSession)
    ids = rows.where("_text IS NOT NULL").select("_id").distinct()
    labelled = cut_lineage(ids.join(known, F.col("_id") == F.col("_lid")).select("_id", "_toxic"),
                           "toxicity-labels")
    sizes = {r["_toxic"]: r["n"] for r in
             labelled.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.when(F.col("_toxic"), F.lit(min(1.0, fit_rows / sizes.get(True, 1)))).otherwise(
        F.lit(min(1.0, fit_rows / sizes.get(False, 1))))
    picked = cut_lineage(labelled.where(place <= share), "toxicity-picked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # In the order of the ids, so that a repeated task fits the same model.
        got = sorted(x for batch in batches for x in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(),
            batch.column(2).to_pylist(), strict=True))
        model = fit_texts([t for _, t, _ in got], [int(y) for _, _, y in got], min_docs, min_z,
                          most)
        if model is not None:
            names, weights, cuts = model
            yield pa.RecordBatch.from_arrays(
                [pa.array([*names, *[None] * len(cuts)], pa.string()),
                 pa.array([*weights.tolist(), *cuts.tolist()], pa.float64())], ["name", "value"])

    sample = (rows.where("_text IS NOT NULL").join(picked, "_id")
              .groupBy(F.col("_id").cast("string")).agg(F.min("_text"), F.max("_toxic")))
    found = cut_lineage(sample.repartition(1).mapInArrow(run, "name string, value double"),
                       "toxicity-model").collect()
    if not found:
        return None
    return ({r["name"]: r["value"] for r in found if r["name"] is not None},
            sorted(r["value"] for r in found if r["name"] is None))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", fit_rows: int = 6000, threshold: float = 0.5,
                   key: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``expected_severity`` (0 to 3), ``grade`` (the
    likeliest), ``p_toxic`` (P(grade >= 1)) and ``toxic`` (``p_toxic >= threshold``).

    ``labels`` has the id and ``toxic`` (0/1; several rows of an id: toxic if any is). Null
    texts have no features. Without labels of both kinds everything has severity 0 and is
    not toxic. Repeated rows are each scored; an empty table gives no rows; other columns
    are not read. ``key`` (of ``docs``) is returned in place of the id where ids do not tell
    rows apart; labels are always found by the id.
    """
    spark = docs.sparkSession
    ship_package(spark)
    known = (labels.where(F.col("toxic").isNotNull())
             .groupBy(F.col(f"`{id_col}`").alias("_lid"))
             .agg((F.max("toxic") > 0).alias("_toxic")))
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    held = spark.sparkContext.broadcast(fit(rows, known, fit_rows))
    if key is not None:
        rows = docs.select(key.alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        weights, cuts = model if model else ({}, [])
        cuts = np.array(cuts)
        for batch in batches:
            out = []
            for text in batch.column(1):
                if model is None:
                    out.append((0.0, 0, 0.0, False))
                    continue
                f = features(text.as_py())
                x = sum(weights[w] * np.log1p(f[w]) for w in weights.keys() & f.keys()) \
                    if len(f) > len(weights) else \
                    sum(weights[w] * np.log1p(n) for w, n in f.items() if w in weights)
                above = 1 / (1 + np.exp(np.clip(cuts - x, -35, 35)))
                p = -np.diff([1.0, *above, 0.0])
                out.append((float(above.sum()), int(np.argmax(p)), float(above[0]),
                            bool(above[0] >= threshold)))
            cols = list(zip(*out, strict=True)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_())],
                ["_id", "expected_severity", "grade", "p_toxic", "toxic"])

    return rows.mapInArrow(
        run, f"_id {id_type}, expected_severity double, grade int, p_toxic double, toxic boolean"
    ).withColumnRenamed("_id", id_col)
