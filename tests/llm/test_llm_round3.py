"""Alignment, manifest and sharding against brute force, and on odd rows."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import pytest
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from reelrank.llm import alignment, merkle_manifest, ranks, sharding
from reelrank.llm.queries import QUERIES, default_pieces, default_tokenizer

SF = "/root/testdata/sf0.001"
LONG = "alpha beta gamma delta\n" * 20000
DOCS = [(1, "The quick brown Fox\njumps", "en", "s0", 25), (2, None, "en", None, None),
        (3, "", None, "s0", 0), (4, LONG, "de", "s1", len(LONG)),
        (1, "The quick brown Fox\njumps", "en", "s0", 25), (1, "another text", "en", "s0", 12),
        (None, "orphan text", "en", "s1", 11), (None, "orphan text", "en", "s1", 11),
        (-7, "negative", None, "s1", 8), (2 ** 62, "größer ▁ than", "", "s1", 13)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("row", "seed", "shard", "slot", "grown", "grown_shard", "rank", "rank_row", "rank_at",
           "rank_group", "total", "_id", "_text", "part", "leaf", "member", "digest", "n_a",
           "row_number", "pair", "key", "path")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.concat(F.lit(c), F.col("source")))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def jump_plain(key, n):
    """The published loop on Python integers."""
    b, j = -1, 0
    key %= 2 ** 64
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (2.0 ** 31 / ((key >> 33) + 1)))
    return b


def test_jump():
    keys = [0, 1, 2, -1, 2 ** 62, -2 ** 63, *range(1000, 3000)]
    for n in (1, 2, 16, 17, 1000):
        got = sharding.jump(np.array(keys, np.int64), n)
        assert got.tolist() == [jump_plain(k, n) for k in keys]


def test_shards_keep_all_columns(spark, docs, none, tmp_path):
    out = sharding.shard_rows(docs, 4)
    assert set(out.columns) == set(docs.columns)             # clashing ones are the outputs
    rows = out.collect()
    assert len(rows) == len(DOCS)
    kept = [c for c in docs.columns if c not in ("shard", "slot", "grown_shard")]
    assert sorted(map(str, out.select(*kept).collect())) == sorted(
        map(str, docs.select(*kept).collect()))
    for r in rows:
        seed = -1 if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard) == (jump_plain(seed, 4), jump_plain(seed, 5))
    for _, group in itertools.groupby(sorted(rows, key=lambda r: r.shard), lambda r: r.shard):
        assert sorted(r.slot for r in group) == list(range(len(list(
            x for x in rows if x.shard == _))))
    assert sharding.shard_rows(none).count() == 0
    back = sharding.write_shards(docs.drop("shard"), str(tmp_path / "s"), 4)
    assert sorted(str(r.text) for r in back.collect()) == sorted(str(d[1]) for d in DOCS)
    with pytest.raises(ValueError):
        sharding.shard_rows(docs, 0)
    text_key = sharding.shard_rows(spark.createDataFrame(DOCS, SCHEMA), 4, key="source").collect()
    assert len({(r.source, r.shard) for r in text_key}) == 3


def test_ranks_split_equal_rows(spark):
    """A third of the rows agree in everything: they still get places of their own."""
    rows = spark.range(30000).select((F.col("id") % 2).cast("string").alias("g"),
                                     F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("x"))
    got = ranks.rank_within(rows, "g", [F.col("x")], "test-ranks").toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == list(range(15000)) and (part.total == 15000).all()
        assert part.x.is_monotonic_increasing


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle_plain(docs):
    """The contract in plain Python: rows of (doc_id, leaf, subroot, root, proof, folded)."""
    def leaf(d, text):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}"
                   for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)])

    def climb(nodes, mine, changed):
        """Root, and for each place its siblings and the node folded from a changed start."""
        at, proofs, folded = list(range(len(nodes))), [[] for _ in mine], list(changed)
        while len(nodes) > 1:
            for i in range(len(mine)):
                run = at[i] // 8 * 8
                left, right = nodes[run:at[i]], nodes[at[i] + 1:run + 8]
                proofs[i] += left + right
                folded[i] = h(*left, folded[i], *right)
                at[i] //= 8
            nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        return nodes[0], proofs, folded

    parts, out = collections.defaultdict(list), []
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for d in docs:
        own = leaf(d, d["text"])
        hit = d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0
        parts[d["lang"]].append((d["doc_id"], own, leaf(
            d, d["text"].translate(lower) if d["text"] and hit else d["text"])))
    done = []
    for lang in sorted(parts, key=lambda x: (x is not None, (x or "").encode())):
        rows = sorted(parts[lang], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        done.append((rows, *climb([r[1] for r in rows], rows, [r[2] for r in rows])))
    subs = [d[1] for d in done]
    for n, (rows, sub, proofs, folded) in enumerate(done):
        for r, p, f in zip(rows, proofs, folded, strict=True):
            root, _, _ = climb(list(subs), [], [])
            at, nodes, proof, node = n, list(subs), list(p), f
            while len(nodes) > 1:
                run = at // 8 * 8
                left, right = nodes[run:at], nodes[at + 1:run + 8]
                proof += left + right
                node = h(*left, node, *right)
                at //= 8
                nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
            out.append((r[0], r[1], sub, root, h(*proof), node, node == root))
    return out


def as_table(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("n", [0, 1, 8, 65, 4200])
def test_merkle(spark, tmp_path, n):
    """One part, several, parts of one row, full and short runs, over one to three rounds."""
    df = spark.range(n).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 11 == 3, None).when(F.col("id") == 5, "ß").otherwise("en").alias("lang"),
        F.lit("s").alias("source"), (F.col("id") * 2).alias("n_chars"))
    got = QUERIES["op11_merkle_manifest"](spark, as_table(spark, df, tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(merkle_plain([r.asDict() for r in df.collect()]))


def test_merkle_odd_rows(spark, docs, none, tmp_path):
    got = QUERIES["op11_merkle_manifest"](spark, as_table(spark, docs, tmp_path)).collect()
    want = merkle_plain([r.asDict() for r in docs.collect()])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert merkle_manifest.manifest(none).count() == 0
    many = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.concat(
        F.lit("l"), F.col("id")).alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    sub = tmp_path / "many"
    sub.mkdir()
    got = QUERIES["op11_merkle_manifest"](spark, as_table(spark, many, sub)).collect()
    assert sorted(map(tuple, got)) == sorted(merkle_plain([r.asDict() for r in many.collect()]))


class Plain:
    """Alignment of one text with the two libraries and plain loops."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(default_tokenizer())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
        self.of = alignment.byte_alphabet()

    def groups(self, text):
        if not text:
            return []
        ia = self.a.encode(" " + text, add_special_tokens=False).ids
        ib = self.b.encode(text)
        ta = [bytes(self.of[c] for c in self.a.id_to_token(i)) for i in ia]
        tb = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
              for i in ib for p in [self.b.id_to_piece(i)]]
        if b"".join(ta) != (" " + text).encode() or b"".join(tb) != (" " + text).encode():
            return []
        ends = [list(itertools.accumulate(map(len, t))) for t in (ta, tb)]
        shared, out = set(ends[0]) & set(ends[1]), []
        for ids, end in zip((ia, ib), ends, strict=True):
            runs, run = [], []
            for i, e in zip(ids, end, strict=True):
                run.append(i)
                if e in shared:
                    runs.append(run)
                    run = []
            out.append(runs)
        return list(zip(*out, strict=True))


def alignment_plain(texts):
    plain = Plain()
    groups = [plain.groups(t) for t in texts]
    links = [collections.Counter((a, b) for x, y in g for a in x for b in y) for g in groups]
    counts = collections.Counter(p for c in links for p in c)
    best = collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for g, c in zip(groups, links, strict=True):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if counts[p] == best[p[0]]),
                    sum(n * counts[p] for p, n in c.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if shown else ""))
    return out


ODD = ["two  blanks", "a   b", " lead", "trail ", "tab\tx", "line \n y", "\n", " ", "▁", "a▁ b",
       "<|endoftext|> <s> </s> <unk>", "naïve café 東京 Ａ", "x" * 3000, "== " * 50, "a b  c",
       "I'm don't we'll 12 345", "\x1c a \x1d", "é é", "🎉 x🎉", "a 　 b", "0", "\r\n a"]


def test_alignment(spark, docs, none, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD + ODD)] + [(d[0], d[1]) for d in DOCS]
    corpus = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    back = spark.read.parquet(str(tmp_path / "documents.parquet")).collect()
    got = QUERIES["op12_token_alignment"](spark, str(tmp_path)).collect()
    want = [(r.doc_id, *x) for r, x in zip(back, alignment_plain([r.text for r in back]), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_alignment_without_broadcast(spark, docs, none):
    """Counts that are all broadcast, in part, or not at all give the same sums."""
    aligned = alignment.align_texts(docs, default_tokenizer(), default_pieces())
    assert aligned.columns[0] == "doc_id" and len(aligned.columns) == 9
    from reelrank.session import cut_lineage
    written = cut_lineage(aligned, "test-aligned")
    results = [sorted(map(str, alignment.score_links(written, n).collect()))
               for n in (10 ** 6, 12, 0)]
    assert results[0] == results[1] == results[2]
    empty = cut_lineage(alignment.align_texts(none, default_tokenizer(), default_pieces()), "none")
    assert alignment.score_links(empty).count() == 0


def test_word_memory(monkeypatch):
    """Cleared often or never, words give the same tokens as whole texts."""
    spec = (open(public_tokenizers.path("byte_bpe_50k.json")).read(),
            open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    texts = pa.array([*ODD, None, "", "some words again and again", LONG[:4000]])
    whole = alignment.Aligner(*spec)
    whole.sides[1].by_word = False
    want = whole.align(texts)
    for limit in (0, 10 ** 9):
        monkeypatch.setattr(alignment, "MEMORY_BYTES", limit)
        one = alignment.Aligner(*spec)
        for _ in range(2):
            got = one.align(texts)
            assert all(got[k].equals(want[k]) for k in want)
