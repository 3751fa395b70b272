"""Structured Streaming jobs: ingest idempotence, request rejects, watermark drops."""

import datetime as dt
import glob
import os
import tempfile

from pyspark.sql import functions as F

from reelrank.operators.model import MFModel
from reelrank.operators.scoring import estimate_pairs
from reelrank.streaming import jobs as sj


def _dir():
    return tempfile.mkdtemp(prefix="reelrank-stream-")


def test_ingest_is_idempotent_and_latest_wins(spark):
    base = _dir()
    os.makedirs(f"{base}/src")
    with open(f"{base}/src/a.txt", "w") as f:
        f.write("1:\n100,3,2005-01-01\n101,4,2005-01-02\n")
    sj.run_rating_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    with open(f"{base}/src/b.txt", "w") as f:          # a newer rating of the same pair
        f.write("1:\n100,5,2005-02-01\n2:\n100,2,2004-12-31\n")
    sj.run_rating_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    sj.run_rating_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")   # no new data
    got = sorted(tuple(r) for r in sj.read_ingested(spark, f"{base}/out").collect())
    assert got == [(1, 100, 5.0, dt.date(2005, 2, 1)), (1, 101, 4.0, dt.date(2005, 1, 2)),
                   (2, 100, 2.0, dt.date(2004, 12, 31))]
    # a batch whose commit is lost runs again and overwrites its own folder
    done = max(glob.glob(f"{base}/ckpt/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for p in (done, os.path.join(os.path.dirname(done), f".{os.path.basename(done)}.crc")):
        if os.path.exists(p):
            os.remove(p)
    before = os.path.getmtime(f"{base}/out/batch_id={os.path.basename(done)}")
    sj.run_rating_ingest(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt")
    assert os.path.getmtime(f"{base}/out/batch_id={os.path.basename(done)}") > before
    raw = spark.read.parquet(f"{base}/out")
    assert raw.count() == 4 and raw.select("batch_id").distinct().count() == 2


def test_compacted_state_reads_like_all_batches(spark):
    """Ratings of later, equal and earlier dates arrive before and after two compactions."""
    base = _dir()
    os.makedirs(f"{base}/src")
    out, state = f"{base}/out", f"{base}/state"
    files = ["7:\n1,3,2005-01-05\n2,4,2005-01-05\n3,1,2005-01-05\n",
             "7:\n1,5,2005-01-05\n2,2,2005-01-01\n4,2,2005-03-01\n",
             "8:\n1,2,2005-02-02\n7:\n3,5,2005-01-09\n4,1,2005-02-01\n"]
    for i, text in enumerate(files):
        with open(f"{base}/src/{i}.txt", "w") as f:
            f.write(text)
        sj.run_rating_ingest(spark, f"{base}/src", out, f"{base}/ckpt")
        plain = sorted(map(tuple, sj.read_ingested(spark, out).collect()))
        assert sorted(map(tuple, sj.read_ingested(spark, out, state).collect())) == plain
        if i < 2:
            assert sj.compact_ingested(spark, out, state) == i
            assert sj.compact_ingested(spark, out, state) == i          # nothing new
            assert sorted(map(tuple, sj.read_ingested(spark, out, state).collect())) == plain
    assert [r[:3] for r in plain] == [(7, 1, 5.0), (7, 2, 4.0), (7, 3, 5.0), (7, 4, 2.0), (8, 1, 2.0)]
    # an unfinished state table is passed over
    os.makedirs(f"{state}/upto=9")
    assert sorted(map(tuple, sj.read_ingested(spark, out, state).collect())) == plain


def _model(spark):
    uf = spark.createDataFrame([(1, 0.1, [1.0, 0.0])], "customer_id long, b_u double, p array<double>")
    itf = spark.createDataFrame([(i, i / 10.0, [float(i), 1.0]) for i in range(1, 8)],
                                "movie_id long, b_i double, q array<double>")
    return MFModel(3.0, uf, itf, rank=2, n_items=7)


def test_request_stream_rejects_and_per_request_k(spark):
    base = _dir()
    req = spark.createDataFrame([(1, 1, 3), (2, 9, 2), (3, 1, 0), (4, 9, 51)], sj.REQUEST_SCHEMA)
    req.write.parquet(f"{base}/src")
    seen = spark.createDataFrame([(1, 7)], "customer_id long, movie_id long")
    sj.run_request_stream(spark, f"{base}/src", f"{base}/out", f"{base}/rej", f"{base}/ckpt",
                          _model(spark), seen)
    out = spark.read.parquet(f"{base}/out")
    per = {r.request_id: r.n for r in out.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    assert per == {1: 3, 2: 2}
    warm = [r.movie_id for r in out.filter("request_id = 1").orderBy("rank").collect()]
    assert warm == [6, 5, 4]                         # 7 was seen
    assert {r.segment for r in out.filter("request_id = 2").collect()} == {"cold"}
    rej = spark.read.parquet(f"{base}/rej")
    assert sorted(r.request_id for r in rej.collect()) == [3, 4]


def test_rolling_rmse_drops_rows_behind_the_watermark(spark):
    base = _dir()
    m = _model(spark)
    day = lambda d: dt.datetime(2005, 1, d, 12, 0, tzinfo=dt.timezone.utc)
    batches = [[(1, 1, 4.0, day(10), False), (1, 2, 3.0, day(11), False)],
               [(1, 5, 4.0, day(12), False)],
               [(1, 3, 5.0, day(1), False), (1, 4, 5.0, day(12), False)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, sj.SCORED_SCHEMA).repartition(1).write.parquet(
            f"{base}/src/{i}")
    late = sj.run_rolling_rmse(spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt", m,
                               watermark="2 days")
    assert late == 1
    res = {(r.window_start.day, r.segment): r.n
           for r in sj.read_rolling_rmse(spark, f"{base}/out").collect()}
    # Spark judges late rows against the watermark of the previous batch: by batch 2 it
    # is Jan 11 12:00 - 2 days, so the Jan-1 row is dropped; Jan 12 gets its update.
    assert res == {(10, "warm"): 1, (11, "warm"): 1, (12, "warm"): 2}


def test_a_batch_shuffles_only_the_vectors_of_its_rows(spark):
    """A batch of two rows against 4,000 users and items: the tables are met by broadcast ids."""
    uf = spark.range(4000).select(F.col("id").alias("customer_id"), (F.col("id") / 1e4).alias("b_u"),
                                  F.array(F.lit(1.0), F.col("id") / 1e3).alias("p"))
    itf = spark.range(4000).select(F.col("id").alias("movie_id"), (F.col("id") / 1e4).alias("b_i"),
                                   F.array(F.col("id") / 1e3, F.lit(0.1)).alias("q"))
    m = MFModel(1.0, uf, itf, rank=2, n_users=4000, n_items=4000)
    day = dt.datetime(2005, 1, 10, tzinfo=dt.timezone.utc)
    rows = spark.createDataFrame([(1, 2, 4.0, day, False), (1, 9000, 3.0, day, False),
                                  (9000, 3000, 3.0, day, True), (None, None, 3.0, day, True)],
                                 sj.SCORED_SCHEMA)
    got = sj.score_batch(rows, m)
    want = estimate_pairs(rows, m)
    cols = want.columns
    key = [F.col(c).cast("string") for c in cols]
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, want.select(key).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2 and plan.count("strategy=broadcast") == 2


def test_latest_ratings_survive_replays(spark):
    """Keyed state over several runs, a batch whose commit was lost, and rows that come twice."""
    base = _dir()
    os.makedirs(f"{base}/src")
    files = ["7:\n1,3,2005-01-05\n2,4,2005-01-05\n3,1,2005-01-05\n",
             "7:\n1,5,2005-01-05\n2,2,2005-01-01\n4,2,2005-03-01\n",
             "8:\n1,2,2005-02-02\n7:\n3,5,2005-01-09\n4,1,2005-02-01\n"]
    out, state = f"{base}/out", f"{base}/state"
    for i, text in enumerate(files):
        with open(f"{base}/src/{i}.txt", "w") as f:
            f.write(text)
        sj.run_rating_ingest(spark, f"{base}/src", out, f"{base}/ckpt")
        sj.run_latest_ratings(spark, out, state, partitions=3)
        want = sorted(map(tuple, sj.read_ingested(spark, out).collect()))
        assert sorted(map(tuple, sj.read_latest_ratings(spark, state).collect())) == want
        if i == 1:
            for ckpt in (f"{base}/ckpt", state):          # both streams run their last batch again
                for p in glob.glob(f"{ckpt}/commits/{i}") + glob.glob(f"{ckpt}/commits/.{i}.crc"):
                    os.remove(p)
            sj.run_rating_ingest(spark, f"{base}/src", out, f"{base}/ckpt")
            sj.run_latest_ratings(spark, out, state, partitions=3)
            assert sorted(map(tuple, sj.read_latest_ratings(spark, state).collect())) == want
    assert [r[:3] for r in want] == [(7, 1, 5.0), (7, 2, 4.0), (7, 3, 5.0), (7, 4, 2.0), (8, 1, 2.0)]
    assert glob.glob(f"{state}/state/0/*/*.changelog")


def test_seen_store_reads_the_files_of_its_users(spark):
    seen = spark.range(3000).select((F.col("id") % 1000).alias("customer_id"),
                                    (F.col("id") * 7 % 50).alias("movie_id"))
    store = sj.SeenStore(seen, _dir() + "/seen", users_per_file=100)
    assert 8 <= len(store.ranges) <= 12
    want = {r.customer_id: sorted(r.seen) for r in sj.seen_sets_of(seen).collect()}
    for ids, most in (([5], 1), ([5, 6, 990], 2), (range(150, 400), 5), ([5000], 0)):
        users = spark.createDataFrame([(i,) for i in ids], "customer_id long")
        got = store.of(users, len(ids))
        assert {r.customer_id: sorted(r.seen) for r in got.collect()} == {
            i: want[i] for i in ids if i in want}
        assert len(got.inputFiles()) <= most
    plan = store.of(spark.createDataFrame([(5,)], "customer_id long"), 1)
    assert "EqualTo(customer_id,5)" in plan._jdf.queryExecution().executedPlan().toString()


def test_ingest_parts_of_several_files_are_one_batch_each(spark, monkeypatch, tmp_path):
    """Parts above the rows of a file are written by several tasks; newest date, part, rating win."""
    from reelrank.plans import queries as q
    orders = [(i, i % 9, dt.date(2000, 1, 1 + i % 5)) for i in range(200)]
    lines = [(i % 200, i % 13, 1.0 + i * 7 % 50) for i in range(800)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").write.parquet(
        f"{tmp_path}/sf/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(
        f"{tmp_path}/sf/lineitem.parquet")
    monkeypatch.setattr(q, "INGEST_ROWS_PER_FILE", 50)
    monkeypatch.setattr(q, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    got = {(r.movie_id, r.customer_id): (r.date, r.rating)
           for r in q.stream_rating_ingest(spark, f"{tmp_path}/sf").collect()}
    want = {}
    for o, movie, quantity in lines:
        key = movie, orders[o][1]
        new = orders[o][2], o % 4, min(5.0, 1.0 + (quantity - 1) // 10)
        want[key] = max(want.get(key, new), new)
    assert got == {k: (d, r) for k, (d, _, r) in want.items()}
    assert all(len(glob.glob(f"{tmp_path}/ingest/src/part{i}/*.txt")) > 1 for i in range(4))
    assert len(glob.glob(f"{tmp_path}/ingest/out/batch_id=*")) == 4
