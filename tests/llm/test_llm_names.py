"""Columns of the user that are called like a helper column keep their values."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reelrank.llm import (alignment, line_frequency, merkle_manifest, mixing, quote_threads, ranks,
                          sharding, url_filters)

SOURCES = [m.__file__ for m in (line_frequency, mixing, quote_threads, url_filters, sharding, ranks,
                                alignment, merkle_manifest, corpus_pipeline)]
HELPERS = sorted({name for path in SOURCES
                  for name in re.findall(r"[\"'](_[A-Za-z0-9]+|u[0-9])[\"']", Path(path).read_text())}
                 | {"_k0", "_k1", "_k2", "u0", "u1", "u7", "domain", "rid", "seed", "row"})


@pytest.fixture(scope="module")
def tagged(spark):
    def tag(df):
        return df.select("*", *[F.concat(F.lit(f"{n}:"), F.monotonically_increasing_id()).alias(n)
                                for n in HELPERS if n not in df.columns])
    return tag


def values(df, columns):
    return sorted(map(str, df.select(*[F.col(f"`{c}`") for c in columns]).collect()))


@pytest.fixture(scope="module")
def docs(spark, tagged):
    rows = [(i, f"the house number {i} stands by the river\nand the road runs past it all day", "en",
             f"src{i % 3}", 60) for i in range(30)]
    return tagged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                              "n_chars long"))


def test_operators(spark, tagged, docs):
    msgs = tagged(spark.createDataFrame([(1, 0, "hello\nthere"), (1, 1, "> hello\n> there\nyes")],
                                        "conv_id long, turn long, text string"))
    got = quote_threads.link_quotes(msgs)
    assert values(got, msgs.columns) == values(msgs, msgs.columns)
    pages = tagged(spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string"))
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    assert values(url_filters.judge_urls(pages, rules), pages.columns) == values(pages, pages.columns)
    assert values(line_frequency.line_quality(docs), docs.columns) == values(docs, docs.columns)
    whole = mixing.mix_to_weights(docs, ("lang", "source"), {}, 1.0, 1)
    assert values(whole, docs.columns) == values(docs, docs.columns)
    assert values(sharding.shard_rows(docs, 4), docs.columns) == values(docs, docs.columns)


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{tmp_path}/labels.parquet")
    want = dict(zip(range(30), [str(r) for r in docs.orderBy("doc_id").collect()], strict=True))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, str(tmp_path))
        assert left.columns == docs.columns, name
        rows = left.collect()
        assert all(str(r) == want[r.doc_id] for r in rows), name
