"""The two classifiers against plain versions: dictionaries, loops and dense arrays."""

import collections
import math
import re
import zlib

import numpy as np
import pytest

from reelrank.llm import queries

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def grams(text):
    """Bins of the byte 2-, 3- and 4-grams of the folded text between two blanks."""
    raw = " ".encode() + bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32
                               for b in text.encode()) + b" "
    out = collections.Counter()
    for n in (2, 3, 4):
        for i in range(len(raw) - n + 1):
            code = int.from_bytes(raw[i:i + n], "big") + (n << 40)
            out[(code * 0x9E3779B97F4A7C15 % 2 ** 64) >> 49] += 1
    return out


def test_language_against_dictionaries(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    found = {d.doc_id: grams(d.text or "") for d in docs}
    learn = [d for d in docs if d.lang and zlib.crc32(str(d.doc_id).encode()) % 5
             and any(c.isalpha() for c in d.text)]
    langs = sorted({d.lang for d in learn})
    profile = {}
    for lang in langs:
        total = sum((found[d.doc_id] for d in learn if d.lang == lang), collections.Counter())
        size = sum(total.values())
        profile[lang] = [(total[b] + 0.5) / (size + 0.5 * 2 ** 15) for b in range(2 ** 15)]
    # Every split of the languages in two; the first language is always on the same side.
    splits = [[(j >> (i - 1)) & 1 if i else 0 for i in range(len(langs))]
              for j in range(1, 2 ** (len(langs) - 1))]

    def weight(split, b):
        sides = [[profile[x][b] for x, bit in zip(langs, split, strict=True) if bit == s] for s in (1, 0)]
        return math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1]))

    weights = [[weight(s, b) for b in range(2 ** 15)] for s in splits]

    def margins(doc_id):
        n = max(1, sum(found[doc_id].values()))
        return [sum(w[b] * c for b, c in found[doc_id].items()) / n for w in weights]

    own = {d.doc_id: margins(d.doc_id) for d in docs}
    sign = {x: [2 * s[i] - 1 for s in splits] for i, x in enumerate(langs)}
    trust, scale = [], []
    for k in range(len(splits)):
        wrong = sum(own[d.doc_id][k] * sign[d.lang][k] <= 0 for d in learn) / len(learn)
        trust.append(min(1.0, max(0.05, 1 - 2 * wrong)))
        scale.append(sum(abs(own[d.doc_id][k]) for d in learn) / len(learn))
    got = {r.doc_id: r for r in queries.op3_language_ecoc(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        if not d.text or not any(c.isalpha() for c in d.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        loss = {x: sum(t * math.log1p(math.exp(-max(-30, min(30, 4 * s * m / z)))) for s, m, z, t in
                       zip(sign[x], own[d.doc_id], scale, trust, strict=True)) for x in langs}
        best = min(loss, key=lambda x: (loss[x], x))
        score = 1 / sum(math.exp(loss[best] - v) for v in loss.values())
        assert r.lang_pred == best and r.score == pytest.approx(score, abs=1e-4)


def plain_words(text):
    out = collections.Counter(re.findall(r"\w+", (text or "").lower()))
    for w, n in list(out.items()):
        if len(w) > 5:
            out[w[:5] + "*"] += n
    return out


def test_toxicity_against_dense_arrays(spark):
    """Features, grades and the descent written plainly, over a dense matrix."""
    docs = {r.doc_id: plain_words(r.text) for r in
            spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    labels = {}
    for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect():
        if r.toxic is not None and r.doc_id in docs:
            labels[r.doc_id] = max(labels.get(r.doc_id, 0), r.toxic)
    ids = sorted(labels, key=str)
    toxic = np.array([labels[i] > 0 for i in ids])
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    names = []
    for f in sorted({f for i in ids if labels[i] for f in docs[i]}):
        a = sum(f in docs[i] for i in ids if labels[i])
        b = sum(f in docs[i] for i in ids if not labels[i])
        p = (a + b) / (n1 + n0)
        if a + b >= 5 and abs(a / n1 - b / n0) >= 4 * max(1e-12, math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))):
            names.append(f)
    assert 0 < len(names) < 2000
    x = np.array([[math.log1p(docs[i][f]) for f in names] for i in ids])
    marks = [f for f in names if not f.endswith("*")
             and sum(f in docs[i] for i in ids if labels[i]) >= 0.95 * sum(f in docs[i] for i in ids)]
    hits = np.array([sum(docs[i][f] for f in marks) for i in ids], float)
    low, high = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    grade = [0 if not t else 1 + int(h > low) + int(h > high) for t, h in zip(toxic, hits, strict=True)]

    sigma = lambda z: 1 / (1 + np.exp(-np.clip(z, -35, 35)))
    share = [min(0.99, max(0.01, np.mean([g <= k for g in grade]))) for k in range(3)]
    start = [math.log(s / (1 - s)) for s in share]
    par = np.array([0.0] * len(names) + [start[0]] + [math.log(max(0.05, b - a)) for a, b in
                                                      zip(start, start[1:], strict=False)])
    m, v, d = np.zeros(len(par)), np.zeros(len(par)), len(names)
    for step in range(1, 401):
        cuts = np.cumsum([par[d], math.exp(par[d + 1]), math.exp(par[d + 2])])
        at = x @ par[:d]
        pull, on_cut = np.zeros(len(ids)), np.zeros(3)
        for k in range(4):
            rows = np.flatnonzero(np.array(grade) == k)
            up = sigma(cuts[k] - at[rows]) if k < 3 else np.ones(len(rows))
            down = sigma(cuts[k - 1] - at[rows]) if k else np.zeros(len(rows))
            p = np.maximum(up - down, 1e-9)
            s_up, s_down = (up * (1 - up) / p, down * (1 - down) / p)
            pull[rows] = s_up - s_down
            if k < 3:
                on_cut[k] -= s_up.sum()
            if k:
                on_cut[k - 1] += s_down.sum()
        on_cut /= len(ids)
        grad = np.concatenate([x.T @ pull / len(ids) + 1e-4 * par[:d],
                               [on_cut.sum(), math.exp(par[d + 1]) * on_cut[1:].sum(),
                                math.exp(par[d + 2]) * on_cut[2]]])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        par = par - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    cuts = np.cumsum([par[d], math.exp(par[d + 1]), math.exp(par[d + 2])])
    got = {r.doc_id: r for r in queries.op4_toxicity_ordinal(spark, LARGER).collect()}
    assert got.keys() == docs.keys()
    for i, found in docs.items():
        at = sum(w * math.log1p(found[f]) for w, f in zip(par, names, strict=False) if f in found)
        above = [float(sigma(at - c)) for c in cuts]
        assert got[i].expected_severity == pytest.approx(sum(above), abs=0.02)
        assert got[i].p_toxic == pytest.approx(above[0], abs=0.02)
        if abs(above[0] - 0.5) > 0.03:
            assert got[i].toxic == (above[0] >= 0.5)
