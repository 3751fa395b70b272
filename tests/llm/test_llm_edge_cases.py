"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelrank.llm import (bloom_lm, bpe_pairs, language_ecoc, line_frequency, mixing,
                          permutation_index, quote_threads, simhash_bktree, toxicity_ordinal,
                          url_filters)
from reelrank.llm.queries import default_tokenizer

LONG = "alpha beta gamma delta " * 20000
DOCS = [(1, "The quick brown fox\njumps over the lazy dog", "en", "s0"),
        (2, None, "en", None), (3, "", None, "s0"), (4, LONG, "de", "s1"),
        (1, "The quick brown fox\njumps over the lazy dog", "en", "s0"),
        (None, "orphan text without an id", "en", "s1"), (5, "123 !!", "de", "s1"),
        (6, "Der schnelle braune Fuchs", "de", "s1"), (7, "Die Katze sitzt", "de", "s0")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    clash = spark.createDataFrame(DOCS, SCHEMA)
    for c in ("host", "score", "kept", "token_ids", "epoch", "_id", "fingerprint", "n_tokens"):
        clash = clash.withColumn(c, F.lit("x"))
    return clash


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe(docs, none):
    rows = bpe_pairs.encode_decode(docs, default_tokenizer()).collect()
    assert len(rows) == len(DOCS)
    assert sorted((r.decoded for r in rows)) == sorted(t or "" for _, t, *_ in DOCS)
    assert bpe_pairs.encode_decode(none, default_tokenizer()).count() == 0


def test_simhash(docs, none):
    rows = simhash_bktree.near_duplicates(docs).collect()
    assert len(rows) == len(DOCS)
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {2, 3} and {r.component_id for r in zero} == {2}
    orphan = next(r for r in rows if r.doc_id is None)
    assert orphan.component_id is None
    assert simhash_bktree.near_duplicates(none).count() == 0


def test_language(docs, none):
    rows = language_ecoc.identify(docs, docs).collect()
    assert len(rows) == len(DOCS)
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {2, 3, 5} and all(0 <= r.score <= 1 for r in rows)
    assert language_ecoc.identify(none, docs).count() == 0
    nothing = language_ecoc.identify(docs, none).collect()
    assert all(r.lang_pred == "und" and r.ambiguous for r in nothing)
    one = language_ecoc.identify(docs, docs.where("lang = 'en'")).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (4, 1), (None, 1), (6, None)], "doc_id long, toxic int")
    rows = toxicity_ordinal.score_toxicity(docs, labels).collect()
    assert len(rows) == len(DOCS)
    for empty in (labels.limit(0), labels.where("toxic = 0")):
        rows = toxicity_ordinal.score_toxicity(docs, empty).collect()
        assert not any(r.toxic for r in rows) and {r.expected_severity for r in rows} == {0.0}
    assert toxicity_ordinal.score_toxicity(none, labels).count() == 0


def test_line_quality(docs, none):
    rows = line_frequency.line_quality(docs).collect()
    assert len(rows) == len(DOCS)
    by = {r.doc_id: r for r in rows}
    assert by[2].n_words == 0 and by[2].base_failed and by[2].clean_text is None
    assert by[4].n_repeat_words == by[4].n_words == 80000 and not by[4].kept
    assert line_frequency.line_quality(none).count() == 0


def test_lm(docs, none):
    rest = F.crc32(F.col("doc_id").cast("string")) % 10
    rows = bloom_lm.score_texts(docs, train=rest != 0, held_out=rest == 0).collect()
    assert len(rows) == len(DOCS) and all(np.isfinite([r.base_score, r.score]).all() for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3)} == {1}
    assert bloom_lm.score_texts(none, train=F.lit(True)).count() == 0
    untrained = bloom_lm.score_texts(docs, train=F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in untrained)


def test_mixing(docs, none):
    rows = mixing.mix_to_weights(docs, ("lang", "source"), {("en",): 2.0}, 1.0, 1).collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(1) == 2 and None in ids and 4 in ids
    assert mixing.mix_to_weights(none, ("lang",), {}, 0.5, 2).count() == 0
    shut = mixing.mix_to_weights(docs, ("lang",), {("en",): 0.0}, 1.0, 1).collect()
    assert "en" not in {r.lang for r in shut}


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://WWW.Example.com/en/x?y", "a"), (2, None, "b"), (3, "no scheme", "c"),
         (1, "http://WWW.Example.com/en/x?y", "a"), (4, "http://example.com", "d"),
         (5, "http://a.net/" + "fr/" * 5000, "e"), (6, "http://xcom/", "f"), (7, "://", "g")],
        "page_id long, url string, host string")
    rules = spark.createDataFrame(
        [("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/fr/fr", "block"),
         ("net", "/fr/fr", "allow"), ("www.example.com", "/en/x", "allow"), (None, "/", "block")],
        "host string, path string, verdict string")
    rows = url_filters.judge_urls(pages, rules).collect()
    assert len(rows) == 8
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in rows}
    assert got[1] == ("www.example.com", "www.example.com/en/x", "allow")
    assert got[2] == ("", None, "allow") and got[3] == ("", None, "allow")
    assert got[4] == ("example.com", None, "allow") and got[6] == ("xcom", None, "allow")
    assert got[5][1:] == ("net/fr/fr", "block") and got[7] == ("", None, "allow")
    assert url_filters.judge_urls(pages, rules.limit(0)).where("rule IS NULL").count() == 8
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0


def test_ann(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], "q") for i in range(60)]
    rows += [(100, None, "q"), (101, [0.0, 0.0, 0.0], "q"), (102, [1.0, float("nan"), 0.0], "q"),
             (103, [1.0, None, 0.0], "q"), (104, [1.0], "q"), (None, [1.0, 1.0, 1.0], "q")]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = permutation_index.search(v).collect()
    assert {r.query_id for r in got} == {0, 20, 40} and max(r.vec_id for r in got) < 60
    x = {i: np.array(e) for i, e, _ in rows[:60]}
    for q in (0, 20, 40):
        best = sorted((-float(x[q] @ x[i]), i) for i in x if i != q)[:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [(r.vec_id, r.score) for r in mine] == [(i, -s) for s, i in best]
    assert permutation_index.search(v.limit(0)).count() == 0


def test_quotes(spark):
    rows = [(1, 0, "u", "Hello there\nsecond line", "x"),
            (1, 1, "a", "On monday u wrote:\n> Hello there\n> second line\n\nI agree", "x"),
            (1, 2, "u", "On x, a wrote:\n> On monday u wrote:\n>> Hello there\n>>second line\n"
                        "> I   AGREE\n\ngood", "x"),
            (1, 3, "b", "> second line\nlate reply", "x"), (2, 0, "u", None, "x"),
            (2, 1, "u", "> never said\nhm", "x"), (None, 0, "u", "lost", "x"),
            (2, 0, "u", None, "x"), (2, 5, "u", "", "x")]
    m = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, body string")
    got = quote_threads.link_quotes(m).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert [by[1, i].reply_to for i in range(4)] == [None, 0, 1, 0]
    assert [by[1, i].depth for i in range(4)] == [0, 1, 2, 1]
    assert [by[1, i].position for i in range(4)] == [0, 1, 3, 2]
    assert by[1, 1].body == "I agree" and by[1, 2].body == "good" and by[1, 2].quote_levels == 2
    assert by[2, 0].body == "" and by[2, 1].reply_to is None and by[2, 5].position == 2
    assert by[None, 0].body == "lost" and by[None, 0].position is None
    assert quote_threads.link_quotes(m.limit(0)).count() == 0


def test_quoted_introductions_take_no_share(spark):
    rows = [(1, 0, "ok\nfirst"), (1, 1, "On turn 0, u wrote:\n> ok\n> first\n\nok\nbeta"),
            (1, 2, "On turn 1, a wrote:\n> On turn 0, u wrote:\n> > ok\n> > first\n> ok\n> beta\n\nend")]
    m = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {r.turn: r for r in quote_threads.link_quotes(m).collect()}
    assert [got[i].reply_to for i in range(3)] == [None, 0, 1] and got[2].depth == 2
    assert got[2].n_quoted_lines == 5 and got[2].body == "end"


def test_latest_author_is_a_candidate(spark):
    # Turn 5 answers turn 3, whose two lines older and later messages wrote too.
    texts = ["ok", "thanks", "else", "ok\nthanks", "more",
             "On turn 3, a wrote:\n> ok\n> thanks\n\nbye", "ok", "thanks"]
    m = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "conv_id long, turn long, text string")
    for parts in (1, 40):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {r.turn: r for r in quote_threads.link_quotes(m).collect()}
        assert got[5].reply_to == 3 and got[5].root == 3 and got[5].depth == 1
        assert sum(r.reply_to is not None for r in got.values()) == 1
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_lines_of_documents_without_ids(spark):
    rows = [(None, f"shared line\nown line number {i}", "s") for i in range(30)]
    rows += [(None, "another\nmore", "s"), (1, "shared line\nby id", "s")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = line_frequency.line_quality(d, min_words=1).collect()
    assert len(got) == 32 and all("shared" not in r.clean_text for r in got)
    assert sum(r.n_left_chars == r.n_line_chars for r in got) == 1  # "another" loses nothing


def test_stages_tell_rows_without_ids_apart(spark, tmp_path):
    """Documents without an id, or with one id and two texts, are judged one by one."""
    clean = [f"the house number {w} stands by the river and the {w} road runs past it all day"
             for w in "one two three four five six seven eight nine ten".split()]
    foul = [f"you {w} are a vile horrid idiot and a vile horrid fool" for w in
            "ants bats cats dogs eels fish".split()]
    rows = [(i, t, "en", "s0", len(t)) for i, t in enumerate(clean * 3 + foul * 3)]
    labels = spark.createDataFrame([(i, 1, int(i >= 30)) for i in range(48)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    loose = [(None, "alpha beta gamma delta epsilon zeta eta theta"), (None, foul[0]),
             (None, clean[0]), (99, "lorem ipsum dolor sit amet consectetur"),
             (99, "quite another text about rivers and their stones"), (None, None)]
    docs = spark.createDataFrame(rows + [(i, t, "en", "s0", 0) for i, t in loose],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.toxicity(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in left.where("doc_id < 90").collect()) == list(range(30))
    got = {(r.doc_id, r.text) for r in left.where("doc_id IS NULL OR doc_id = 99").collect()}
    assert got == set(loose) - {(None, foul[0])}
    spoken = corpus_pipeline.language(spark, left, str(tmp_path))
    assert spoken.count() == left.count() - 1                      # the null text is no language
    once = corpus_pipeline.near_duplicate(spark, left, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in once if r.doc_id is not None and r.doc_id < 90) == list(range(10))
    assert {(r.doc_id, r.text) for r in once if r.doc_id is None or r.doc_id == 99} == (
        got - {(None, clean[0])})


def test_lm_chunks_are_cut_without_effect(docs, monkeypatch):
    rest = F.crc32(F.col("doc_id").cast("string")) % 10
    run = lambda d: sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in
                           bloom_lm.score_texts(d, train=rest != 0).collect())
    whole = run(docs)
    assert run(docs.withColumn("doc_id", F.col("doc_id").cast("string"))) == whole
    monkeypatch.setattr(bloom_lm, "CHUNK_BYTES", 100)
    assert run(docs) == whole


def reply_links(spark, texts):
    m = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)],
                              "conv_id long, turn long, text string")
    return {r.turn: r.reply_to for r in quote_threads.link_quotes(m).collect()}


def plain_links(texts):
    """All earlier messages vote for all lines of a level; the innermost level that has a link."""
    split = [t.split("\n") for t in texts]
    own = [{x.lower() for x in s if x and not x.startswith(">")} for s in split]
    out = {}
    for i, s in enumerate(split):
        lines = {x[2:].lower() for x in s if x.startswith("> ")} - {""}
        best = max(((len(lines & own[j]), j) for j in range(i)), default=(0, 0)) if lines else (0, 0)
        out[i] = best[1] if best[0] and best[0] >= 0.5 * len(lines) else None
    return out


def test_any_earlier_author_is_a_candidate(spark):
    """The parent is neither the first nor the latest author of its lines."""
    texts = ["alpha one two", "beta three", "alpha one two\nbeta three", "alpha one two", "beta three",
             "> alpha one two\n> beta three\nyes"]
    assert reply_links(spark, texts)[5] == 2


@pytest.mark.parametrize("seed", [1, 3])
def test_links_among_many_authors(spark, seed, monkeypatch):
    """Few different lines, each by dozens of authors, rare ones between them, ties and latest."""
    rng = np.random.default_rng(seed)
    words = [f"line {k}" for k in range(4 + 2 * seed)]
    texts = []
    for i in range(150):
        own = [words[k] for k in rng.choice(len(words), rng.integers(0, 4), replace=False)]
        if rng.random() < 0.2:
            own.append(f"rare {rng.integers(0, 12)}")
        quoted = []
        if i and rng.random() < 0.6:
            quoted = [x for x in texts[rng.integers(0, i)].split("\n") if x and x[0] != ">"]
            quoted = quoted[:rng.integers(1, 5)] + ([f"line {rng.integers(0, 9)}"]
                                                    if rng.random() < 0.3 else [])
        texts.append("\n".join([f"> {x}" for x in quoted] + own))
    monkeypatch.setattr(quote_threads, "COMMON_AUTHORS", 16)
    assert reply_links(spark, texts) == plain_links(texts)


def test_mixing_fills_the_budget_with_equal_ids(spark):
    """Rows without an id, with one id, and equal in everything: half the tokens are taken."""
    def picked(rows, share=0.5):
        d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return mixing.mix_to_weights(d, ("lang",), {}, share, 1).collect()

    assert len(picked([(None, f"text number {i}", "a") for i in range(6)])) == 3
    assert len(picked([(7, f"text number {i}", "a") for i in range(6)])) == 3
    assert len(picked([(7, "the same text", "a")] * 600 + [(None, "the same text", "b")] * 400)) == 500
    assert sorted(r.epoch for r in picked([(7, "same", "a")] * 10, 1.0)) == [0] * 10
    got = picked([(None, "four words of text", "a")] * 9 + [(i, "two words", "a") for i in range(9)])
    assert 26 - 4 < sum(r.n_tokens for r in got) <= 27
