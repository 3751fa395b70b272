"""Independent DuckDB SQL for every SQL-expressible registered query.

Common table expressions are declared once with their dependencies; ``sql(body, *ctes)``
emits the ``WITH`` clause in dependency order.
"""

from __future__ import annotations

from reelrank.config import Params
from reelrank.plans import derive

P = Params()
REG_DIV = repr(1.0 + P.reg_all)

_CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    _CTES[name] = (body, deps)


def sql(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n][0]})" for n in order) + "\n" + body


cte("ratings_all", """
  SELECT customer_id, movie_id, rating, date FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, movie_id
                                 ORDER BY date DESC, rating DESC) AS rn
    FROM (SELECT o_custkey AS customer_id, l_partkey AS movie_id,
                 CAST(least(5, 1 + floor((l_quantity - 1) / 10)) AS FLOAT) AS rating,
                 CAST(o_orderdate AS DATE) AS date
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)) WHERE rn = 1""")
cte("cut", """
  SELECT min(date) AS cut,
         (SELECT count(*) FROM ratings_all) AS n_rows,
         (SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM ratings_all) AS idx
  FROM (SELECT date, sum(n) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING
                                  AND CURRENT ROW) AS cum
        FROM (SELECT date, count(*) AS n FROM ratings_all GROUP BY date))
  WHERE cum > (SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM ratings_all)""",
    "ratings_all")
cte("ratings", """
  SELECT r.customer_id, r.movie_id, r.rating, r.date FROM ratings_all r CROSS JOIN cut
  WHERE NOT (r.customer_id % 7 = 0 AND r.date < cut.cut)""", "ratings_all", "cut")
cte("titles", """
  SELECT p_partkey AS movie_id, CAST(1950 + p_partkey % 56 AS INTEGER) AS year,
         p_name || ', ' || p_brand AS title FROM part""")
cte("train", "SELECT r.* FROM ratings r CROSS JOIN cut WHERE r.date < cut.cut", "ratings", "cut")
cte("first_dates", "SELECT customer_id, min(date) AS first_date FROM ratings GROUP BY customer_id",
    "ratings")
cte("test", """
  SELECT r.*, (f.first_date >= cut.cut) AS is_cold_user
  FROM ratings r CROSS JOIN cut JOIN first_dates f USING (customer_id)
  WHERE r.date >= cut.cut""", "ratings", "cut", "first_dates")
cte("mu", "SELECT avg(CAST(rating AS DOUBLE)) AS mu FROM train", "train")


def _bias_ctes(sweeps: int) -> tuple[str, str]:
    prev_u = None
    for s in range(1, sweeps + 1):
        bu_term = f"coalesce({prev_u}.b_u, 0)" if prev_u else "0"
        join_u = f"LEFT JOIN {prev_u} USING (customer_id)" if prev_u else ""
        cte(f"bi{s}", f"""
  SELECT t.movie_id, avg(CAST(t.rating AS DOUBLE) - mu.mu - {bu_term})
                     / CAST({REG_DIV} AS DOUBLE) AS b_i
  FROM train t CROSS JOIN mu {join_u} GROUP BY t.movie_id""",
            "train", "mu", *((prev_u,) if prev_u else ()))
        cte(f"bu{s}", f"""
  SELECT t.customer_id, avg(CAST(t.rating AS DOUBLE) - mu.mu - coalesce(bi{s}.b_i, 0))
                        / CAST({REG_DIV} AS DOUBLE) AS b_u
  FROM train t CROSS JOIN mu LEFT JOIN bi{s} USING (movie_id) GROUP BY t.customer_id""",
            "train", "mu", f"bi{s}")
        prev_u = f"bu{s}"
    return f"bu{sweeps}", f"bi{sweeps}"


BU, BI = _bias_ctes(P.bias_sweeps)
cte("users_b", f"SELECT customer_id, b_u FROM {BU}", BU)
cte("items_b", f"SELECT movie_id, b_i FROM {BI}", BI)
cte("emb", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings")
cte("nemb", "SELECT count(*) AS n FROM embeddings")
cte("uf", """
  SELECT b.customer_id, b.b_u, emb.e AS p
  FROM users_b b CROSS JOIN nemb LEFT JOIN emb ON emb.vec_id = b.customer_id % nemb.n
  WHERE b.customer_id % 7 <> 0""", "users_b", "emb", "nemb")
cte("itf", """
  SELECT b.movie_id, b.b_i, list_transform(emb.e, lambda x: x * CAST(6.0 AS DOUBLE)) AS q
  FROM items_b b CROSS JOIN nemb LEFT JOIN emb ON emb.vec_id = (b.movie_id * 7 + 3) % nemb.n
  WHERE b.movie_id % 11 <> 0""", "items_b", "emb", "nemb")
cte("scored", """
  SELECT t.customer_id, t.movie_id, t.rating, t.date, t.is_cold_user,
         least(greatest(mu.mu + coalesce(uf.b_u, 0) + coalesce(itf.b_i, 0)
                        + CASE WHEN uf.p IS NOT NULL AND itf.q IS NOT NULL
                               THEN list_dot_product(uf.p, itf.q) ELSE 0 END,
                        CAST(1.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)) AS est,
         uf.customer_id IS NOT NULL AS user_known, itf.movie_id IS NOT NULL AS item_known
  FROM test t CROSS JOIN mu LEFT JOIN uf USING (customer_id) LEFT JOIN itf USING (movie_id)""",
    "test", "mu", "uf", "itf")
cte("hits", f"""
  SELECT customer_id, sum(CASE WHEN rating >= {P.relevance_threshold} THEN 1 ELSE 0 END) AS n_rel,
         sum(CASE WHEN rating >= {P.relevance_threshold} AND rn <= {P.top_n} THEN 1 ELSE 0 END)
           AS n_rel_top,
         sum((est - rating) * (est - rating)) AS sse, count(*) AS n,
         min(CASE WHEN is_cold_user THEN 0 ELSE 1 END) AS warm
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                     ORDER BY round(est, 9) DESC, movie_id ASC) AS rn
        FROM scored)
  GROUP BY customer_id""", "scored")

MIN_M, MIN_U = derive.QUERY_MIN_MOVIE_RATINGS, derive.QUERY_MIN_USER_RATINGS
cte("valid_movies", f"""
  SELECT movie_id FROM ratings GROUP BY movie_id HAVING count(*) >= {MIN_M}""", "ratings")
cte("after_movies", "SELECT * FROM ratings SEMI JOIN valid_movies USING (movie_id)",
    "ratings", "valid_movies")
cte("valid_users", f"""
  SELECT customer_id FROM after_movies GROUP BY customer_id HAVING count(*) >= {MIN_U}""",
    "after_movies")
cte("filtered", "SELECT * FROM after_movies SEMI JOIN valid_users USING (customer_id)",
    "after_movies", "valid_users")


ORACLE: dict[str, str] = {
    "filter_sparse": sql("SELECT customer_id, movie_id, rating, date FROM filtered", "filtered"),
    "valid_movies": sql("SELECT movie_id FROM valid_movies", "valid_movies"),
    "valid_users": sql("SELECT customer_id FROM valid_users", "valid_users"),
    "drop_report": sql("""
      SELECT stage, step, n_rows, n_dropped,
             round(CASE WHEN n_rows + n_dropped > 0
                        THEN n_dropped / (n_rows + n_dropped) END, 6) AS share_dropped
      FROM (SELECT 'parsed' AS stage, 0 AS step, (SELECT count(*) FROM ratings) AS n_rows,
                   CAST(0 AS BIGINT) AS n_dropped
            UNION ALL
            SELECT 'movie_filter', 1, (SELECT count(*) FROM after_movies),
                   (SELECT count(*) FROM ratings) - (SELECT count(*) FROM after_movies)
            UNION ALL
            SELECT 'user_filter', 2, (SELECT count(*) FROM filtered),
                   (SELECT count(*) FROM after_movies) - (SELECT count(*) FROM filtered))""",
        "ratings", "after_movies", "filtered"),
    "temporal_cut": sql("SELECT n_rows, CAST(idx AS BIGINT) AS cut_index, cut FROM cut", "cut"),
    "temporal_split_counts": sql("""
      SELECT (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM test) AS n_test,
             (SELECT count(DISTINCT customer_id) FROM train) AS n_train_users,
             (SELECT count(DISTINCT customer_id) FROM test) AS n_test_users,
             (SELECT count(DISTINCT customer_id) FROM test WHERE is_cold_user) AS n_cold_users,
             (SELECT count(*) FROM test WHERE is_cold_user) AS n_cold_rows,
             (SELECT max(date) FROM train) AS train_max_date,
             (SELECT min(date) FROM test) AS test_min_date""", "train", "test"),
    "cold_flags": sql("SELECT customer_id, movie_id, rating, date, is_cold_user FROM test",
                      "test"),
    "bias_model_items": sql("SELECT movie_id, round(b_i, 6) AS b_i FROM items_b", "items_b"),
    "bias_model_users": sql("SELECT customer_id, round(b_u, 6) AS b_u FROM users_b", "users_b"),
    "score_pairs": sql("""
      SELECT customer_id, movie_id, rating, round(est, 6) AS est, user_known, item_known
      FROM scored""", "scored"),
    "score_pairs_cold": sql("""
      SELECT CASE WHEN user_known AND item_known THEN 'both'
                  WHEN user_known THEN 'user_only'
                  WHEN item_known THEN 'item_only' ELSE 'neither' END AS known,
             count(*) AS n_rows, round(avg(est), 6) AS mean_est,
             round(min(est), 6) AS min_est, round(max(est), 6) AS max_est,
             sum(CASE WHEN est IN (1.0, 5.0) THEN 1 ELSE 0 END)::BIGINT AS n_clipped
      FROM scored GROUP BY 1""", "scored"),
    "rmse_segments": sql("""
      SELECT round(sqrt(avg((est - rating) * (est - rating))), 6) AS test_rmse,
             round(sqrt(avg(CASE WHEN NOT is_cold_user THEN (est - rating) * (est - rating) END)), 6)
               AS test_rmse_warm,
             round(sqrt(avg(CASE WHEN is_cold_user THEN (est - rating) * (est - rating) END)), 6)
               AS test_rmse_cold,
             round(avg(CASE WHEN is_cold_user THEN 0.0 ELSE 1.0 END), 6) AS warm_fraction,
             count(*) AS n_test_rows
      FROM scored""", "scored"),
    "precision_recall_at_k": sql(f"""
      SELECT round(avg(n_rel_top / {float(P.top_n)}), 6) AS precision_at_k,
             round(avg(n_rel_top / n_rel), 6) AS recall_at_k,
             round(avg(CASE WHEN warm = 1 THEN n_rel_top / {float(P.top_n)} END), 6)
               AS precision_at_k_warm,
             round(avg(CASE WHEN warm = 1 THEN n_rel_top / n_rel END), 6) AS recall_at_k_warm
      FROM hits WHERE n_rel > 0""", "hits"),
    "metrics_report": sql(f"""
      SELECT 'svd' AS model_type,
             round(sqrt(sum(sse) / sum(n)), 6) AS test_rmse,
             round(sqrt(sum(CASE WHEN warm = 1 THEN sse END) / sum(CASE WHEN warm = 1 THEN n END)), 6)
               AS test_rmse_warm,
             round(sqrt(sum(CASE WHEN warm = 0 THEN sse END) / sum(CASE WHEN warm = 0 THEN n END)), 6)
               AS test_rmse_cold,
             round(avg(CASE WHEN n_rel > 0 THEN n_rel_top / {float(P.top_n)} END), 6) AS precision_at_k,
             round(avg(CASE WHEN n_rel > 0 AND warm = 1 THEN n_rel_top / {float(P.top_n)} END), 6)
               AS precision_at_k_warm,
             round(avg(CASE WHEN n_rel > 0 THEN n_rel_top / n_rel END), 6) AS recall_at_k,
             round(avg(CASE WHEN n_rel > 0 AND warm = 1 THEN n_rel_top / n_rel END), 6)
               AS recall_at_k_warm,
             CAST({P.top_n} AS INTEGER) AS k, CAST({P.relevance_threshold} AS DOUBLE) AS threshold,
             round(sum(CASE WHEN warm = 1 THEN n END) / sum(n), 6) AS warm_fraction,
             CAST(sum(n) AS BIGINT) AS n_test_rows
      FROM hits""", "hits"),
}

cte("rec_users", "SELECT DISTINCT customer_id FROM test", "test")
cte("seen", "SELECT DISTINCT customer_id, movie_id FROM ratings", "ratings")
cte("rec_cand", """
  SELECT u.customer_id, i.movie_id,
         (mu.mu + i.b_i) + CASE WHEN uf.customer_id IS NOT NULL
                                THEN uf.b_u + CASE WHEN uf.p IS NOT NULL AND i.q IS NOT NULL
                                                   THEN list_dot_product(uf.p, i.q) ELSE 0 END
                                ELSE 0 END AS raw,
         CASE WHEN uf.customer_id IS NOT NULL THEN 'warm' ELSE 'cold' END AS segment
  FROM rec_users u CROSS JOIN itf i CROSS JOIN mu LEFT JOIN uf USING (customer_id)
  WHERE NOT EXISTS (SELECT 1 FROM seen s
                    WHERE s.customer_id = u.customer_id AND s.movie_id = i.movie_id)""",
    "rec_users", "itf", "mu", "uf", "seen")
_REC = sql(f"""
  SELECT customer_id, CAST(rn AS INTEGER) AS rank, movie_id,
         coalesce(t.title, '<unknown>') AS title,
         round(least(greatest(raw, CAST(1.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)), 6) AS score,
         round(raw, 6) AS raw_score, segment
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                     ORDER BY round(raw, 9) DESC, movie_id ASC) AS rn
        FROM rec_cand) c
  LEFT JOIN titles t USING (movie_id)
  WHERE rn <= {P.top_k}""", "rec_cand", "titles")
ORACLE["recommend_topk"] = _REC
ORACLE["recommend_topk_blocked"] = _REC
cte("rec_series", """
  SELECT c.*, coalesce(lower(trim(regexp_replace(t.title, ', Brand#[0-9]+$', ''))),
                       'untitled ' || c.movie_id) AS name
  FROM rec_cand c LEFT JOIN titles t USING (movie_id)""", "rec_cand", "titles")
ORACLE["recommend_topk_series"] = sql(f"""
  SELECT customer_id, CAST(rn AS INTEGER) AS rank, movie_id,
         coalesce(t.title, '<unknown>') AS title,
         round(least(greatest(raw, CAST(1.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)), 6) AS score,
         round(raw, 6) AS raw_score, segment
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                     ORDER BY round(raw, 9) DESC, movie_id ASC) AS rn
        FROM (FROM rec_series QUALIFY row_number() OVER (
                PARTITION BY customer_id, name ORDER BY round(raw, 9) DESC, movie_id ASC) = 1)) c
  LEFT JOIN titles t USING (movie_id)
  WHERE rn <= {P.top_k}""", "rec_series", "titles")
ORACLE["popularity_topk"] = sql(f"""
  SELECT CAST(row_number() OVER (ORDER BY round(mu.mu + i.b_i, 9) DESC, i.movie_id) AS INTEGER)
           AS rank,
         i.movie_id, coalesce(t.title, '<unknown>') AS title,
         round(least(greatest(mu.mu + i.b_i, CAST(1.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)), 6)
           AS score,
         round(mu.mu + i.b_i, 6) AS raw_score
  FROM itf i CROSS JOIN mu LEFT JOIN titles t USING (movie_id)
  QUALIFY rank <= {P.top_k}""", "itf", "mu", "titles")

REL_MIN = derive.QUERY_RELIABLE_MIN_RATINGS
cte("movie_counts", "SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id", "ratings")
cte("user_counts", "SELECT customer_id, count(*) AS n FROM ratings GROUP BY customer_id",
    "ratings")
cte("hist_range", """
  SELECT CASE WHEN min(n) = max(n) THEN min(n) - 0.5 ELSE CAST(min(n) AS DOUBLE) END AS e0,
         CASE WHEN min(n) = max(n) THEN max(n) + 0.5 ELSE CAST(max(n) AS DOUBLE) END AS e1
  FROM movie_counts""", "movie_counts")
cte("user_hist_range", """
  SELECT CASE WHEN min(n) = max(n) THEN min(n) - 0.5 ELSE CAST(min(n) AS DOUBLE) END AS e0,
         CASE WHEN min(n) = max(n) THEN max(n) + 0.5 ELSE CAST(max(n) AS DOUBLE) END AS e1
  FROM user_counts""", "user_counts")


def _histogram(counts: str, span: str) -> str:
    """A count falls into the bin whose edges hold it (the last bin is closed)."""
    return sql(f"""
      SELECT CAST(e.bin AS INTEGER) AS bin, round(e.lo, 6) AS lo, round(e.hi, 6) AS hi,
             count(c.n) AS n
      FROM (SELECT g.bin, g.bin * ((e1 - e0) / 80) + e0 AS lo,
                   CASE WHEN g.bin = 79 THEN e1 ELSE (g.bin + 1) * ((e1 - e0) / 80) + e0 END AS hi
            FROM range(80) g(bin) CROSS JOIN {span}) e
      LEFT JOIN {counts} c ON c.n >= e.lo AND (c.n < e.hi OR (e.bin = 79 AND c.n <= e.hi))
      GROUP BY e.bin, e.lo, e.hi""", counts, span)


cte("movie_stats", f"""
  SELECT movie_id, avg(CAST(rating AS DOUBLE)) AS avg_rating, count(*) AS num_ratings
  FROM ratings GROUP BY movie_id HAVING count(*) >= {REL_MIN}""", "ratings")


def _means_sql(direction: str) -> str:
    return sql(f"""
      SELECT m.movie_id, coalesce(t.title, CAST(m.movie_id AS VARCHAR)) AS label,
             round(m.avg_rating, 6) AS avg_rating, m.num_ratings
      FROM movie_stats m LEFT JOIN titles t USING (movie_id)
      ORDER BY round(m.avg_rating, 9) {direction}, m.movie_id LIMIT 10""",
               "movie_stats", "titles")


ORACLE.update({
    "ratings_overview": sql("""
      SELECT count(*) AS n_ratings, count(DISTINCT customer_id) AS n_users,
             count(DISTINCT movie_id) AS n_movies, min(date) AS min_date, max(date) AS max_date,
             min(rating) AS min_rating, max(rating) AS max_rating,
             count(*) FILTER (WHERE customer_id IS NULL) AS null_customer_id,
             count(*) FILTER (WHERE movie_id IS NULL) AS null_movie_id,
             count(*) FILTER (WHERE rating IS NULL) AS null_rating,
             count(*) FILTER (WHERE date IS NULL) AS null_date
      FROM ratings""", "ratings"),
    "rating_distribution": sql("""
      SELECT rating, n, round(n / sum(n) OVER (), 6) AS share,
             round(sum(n) OVER (ORDER BY rating ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                   / sum(n) OVER (), 6) AS cum_share
      FROM (SELECT rating, count(*) AS n FROM ratings GROUP BY rating)""", "ratings"),
    "rating_mean_median": sql("""
      SELECT round(avg(CAST(rating AS DOUBLE)), 6) AS mean_rating,
             round(median(CAST(rating AS DOUBLE)), 6) AS median_rating FROM ratings""",
        "ratings"),
    "movie_count_describe": sql("""
      SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
             round(CAST(min(n) AS DOUBLE), 6) AS min,
             round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50,
             round(quantile_cont(n, 0.75), 6) AS p75, round(CAST(max(n) AS DOUBLE), 6) AS max
      FROM movie_counts""", "movie_counts"),
    "user_count_percentiles": sql("""
      SELECT round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75,
             round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95,
             round(quantile_cont(n, 0.99), 6) AS p99 FROM user_counts""", "user_counts"),
    "movie_count_histogram": _histogram("movie_counts", "hist_range"),
    "user_count_histogram": _histogram("user_counts", "user_hist_range"),
    "user_count_describe": sql("""
      SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
             round(CAST(min(n) AS DOUBLE), 6) AS min,
             round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50,
             round(quantile_cont(n, 0.75), 6) AS p75, round(CAST(max(n) AS DOUBLE), 6) AS max
      FROM user_counts""", "user_counts"),
    "top_rated_count": sql("""
      SELECT m.movie_id, coalesce(t.title, CAST(m.movie_id AS VARCHAR)) AS label,
             m.n AS num_ratings
      FROM movie_counts m LEFT JOIN titles t USING (movie_id)
      ORDER BY m.n DESC, m.movie_id LIMIT 20""", "movie_counts", "titles"),
    "best_movies": _means_sql("DESC"),
    "worst_movies": _means_sql("ASC"),
    "monthly_volume": sql("""
      SELECT strftime(date, '%Y-%m') AS year_month, count(*) AS n FROM ratings GROUP BY 1""",
        "ratings"),
    "sparsity": sql("""
      SELECT n_users, n_movies, n_ratings, n_users * n_movies AS possible,
             round(n_ratings / (n_users * n_movies), 6) AS density,
             round(1.0 - n_ratings / (n_users * n_movies), 6) AS sparsity
      FROM (SELECT count(DISTINCT customer_id) AS n_users, count(DISTINCT movie_id) AS n_movies,
                   count(*) AS n_ratings FROM ratings)""", "ratings"),
    "user_history": sql("""
      SELECT customer_id, CAST(pos AS INTEGER) AS pos, movie_id, t.title, rating, date,
             strftime(date, '%d/%B/%Y') AS date_str
      FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                         ORDER BY rating DESC, date DESC, movie_id) AS pos
            FROM ratings) r LEFT JOIN titles t USING (movie_id)
      WHERE pos <= 15""", "ratings", "titles"),
    "seen_items": sql("""
      SELECT customer_id, count(*) AS n_seen,
             array_to_string(list_sort(list(movie_id)), ',') AS items
      FROM (SELECT DISTINCT customer_id, movie_id FROM ratings) GROUP BY customer_id""",
        "ratings"),
})

ORACLE.update({
    "sample_users": sql(f"""
      SELECT r.customer_id, r.movie_id, r.rating, r.date FROM ratings r
      JOIN (SELECT customer_id FROM (
              SELECT customer_id, row_number() OVER (
                       ORDER BY md5(CAST(customer_id AS VARCHAR) || ':{P.seed}'), customer_id) AS rn
              FROM (SELECT DISTINCT customer_id FROM ratings))
            WHERE rn <= (SELECT floor(count(DISTINCT customer_id)
                                      * CAST({P.data_sample_fraction} AS DOUBLE)) FROM ratings)) s
      USING (customer_id)""", "ratings"),
    "sample_rows": sql(f"""
      SELECT customer_id, movie_id, rating, date FROM (
        SELECT *, row_number() OVER (
                 ORDER BY md5(CAST(customer_id AS VARCHAR) || ':' || CAST(movie_id AS VARCHAR)
                              || ':{P.seed}'),
                          CAST(customer_id AS VARCHAR) || ':' || CAST(movie_id AS VARCHAR)) AS rn
        FROM ratings)
      WHERE rn <= (SELECT floor(count(*) * CAST({derive.QUERY_SAMPLE_ROWS_FRACTION} AS DOUBLE))
                   FROM ratings)""", "ratings"),
    "dense_index": sql("""
      SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS idx
      FROM (SELECT DISTINCT customer_id FROM ratings)""", "ratings"),
})

ORACLE.update({
    "parse_block_text": sql("""
      SELECT CAST(movie_id AS INTEGER) AS movie_id, CAST(customer_id AS INTEGER) AS customer_id,
             rating, date FROM ratings""", "ratings"),
    "qualifying_users": sql("SELECT DISTINCT CAST(customer_id AS INTEGER) AS customer_id FROM test",
                            "test"),
    "titles_parse": sql("SELECT CAST(movie_id AS INTEGER) AS movie_id, year, title FROM titles",
                        "titles"),
    "forward_fill_events": """
      SELECT event_id, ts, user_id, event_type,
             CASE WHEN event_type = 'purchase' THEN value END AS value,
             last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
               OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
               AS filled_value
      FROM events""",
})

ORACLE.update({
    "model_meta": sql("""
      SELECT round(mu.mu, 6) AS global_mean, CAST(64 AS INTEGER) AS rank,
             (SELECT count(*) FROM uf) AS n_users, (SELECT count(*) FROM itf) AS n_items
      FROM mu""", "mu", "uf", "itf"),
    "model_roundtrip": ORACLE["score_pairs"],
})

ORACLE.update({
    "stream_rating_ingest": """
      SELECT CAST(movie_id AS INTEGER) AS movie_id, CAST(customer_id AS INTEGER) AS customer_id,
             CAST(rating AS FLOAT) AS rating, date
      FROM (SELECT o_custkey AS customer_id, l_partkey AS movie_id, CAST(o_orderdate AS DATE) AS date,
                   least(5, 1 + floor((l_quantity - 1) / 10)) AS rating,
                   row_number() OVER (PARTITION BY o_custkey, l_partkey
                                      ORDER BY CAST(o_orderdate AS DATE) DESC, l_orderkey % 4 DESC,
                                               l_quantity DESC) AS k
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE k = 1""",
    "stream_requests_topk": sql("""
      SELECT c.customer_id AS request_id, c.customer_id, CAST(c.rn AS INTEGER) AS rank,
             c.movie_id, coalesce(t.title, '<unknown>') AS title,
             round(least(greatest(c.raw, CAST(1.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)), 6) AS score,
             round(c.raw, 6) AS raw_score, c.segment
      FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                         ORDER BY round(raw, 9) DESC, movie_id ASC) AS rn
            FROM rec_cand) c
      LEFT JOIN titles t USING (movie_id)
      WHERE c.rn <= 5 * (c.customer_id % 12) AND 5 * (c.customer_id % 12) BETWEEN 1 AND 50""",
        "rec_cand", "titles"),
    "stream_rolling_rmse": sql("""
      SELECT date AS day, CASE WHEN is_cold_user THEN 'cold' ELSE 'warm' END AS segment,
             round(sqrt(avg((est - rating) * (est - rating))), 6) AS rmse, count(*) AS n,
             TRUE AS late_counted
      FROM scored WHERE date >= (SELECT min(date) FROM scored) + 60 OR customer_id % 10 <> 0
      GROUP BY 1, 2""", "scored"),
})

cte("scored_train", """
  SELECT t.customer_id, t.movie_id, t.rating,
         least(greatest(mu.mu + coalesce(uf.b_u, 0) + coalesce(itf.b_i, 0)
                        + CASE WHEN uf.p IS NOT NULL AND itf.q IS NOT NULL
                               THEN list_dot_product(uf.p, itf.q) ELSE 0 END,
                        CAST(1.0 AS DOUBLE)), CAST(5.0 AS DOUBLE)) AS est
  FROM train t CROSS JOIN mu LEFT JOIN uf USING (customer_id) LEFT JOIN itf USING (movie_id)""",
    "train", "mu", "uf", "itf")
ORACLE["train_test_gap_fixed_model"] = sql("""
  SELECT round(a.train_rmse, 6) AS train_rmse, round(b.test_rmse, 6) AS test_rmse,
         round(b.test_rmse - a.train_rmse, 6) AS gap
  FROM (SELECT sqrt(avg((est - rating) * (est - rating))) AS train_rmse FROM scored_train) a
  CROSS JOIN (SELECT sqrt(avg((est - rating) * (est - rating))) AS test_rmse FROM scored) b""",
    "scored_train", "scored")

ORACLE["sample_rows_duplicates"] = f"""
  SELECT CAST(floor(count(*) * CAST({derive.QUERY_SAMPLE_ROWS_FRACTION} AS DOUBLE)) AS BIGINT)
           AS n_sampled
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
ORACLE["stream_request_rejects"] = sql("""
  SELECT DISTINCT customer_id AS request_id, customer_id,
         CAST(5 * (customer_id % 12) AS INTEGER) AS k, 'k must be in 1..50' AS reason
  FROM test WHERE 5 * (customer_id % 12) NOT BETWEEN 1 AND 50""", "test")


# --- planted ratings: the bias-only model in SQL, the fit itself held to a gate ----------

def _planted(source: str) -> str:
    dot = " + ".join(f"(u.e[{j}] * CAST(6.4 AS DOUBLE)) * (i.e[{j}] * CAST(6.4 AS DOUBLE))"
                     for j in (1, 2, 3))
    return f"""
  SELECT t.customer_id, t.movie_id,
         least(greatest(3 + ({dot}), CAST(1 AS DOUBLE)), CAST(5 AS DOUBLE)) AS rating
  FROM {source} t CROSS JOIN nemb JOIN emb u ON u.vec_id = t.customer_id % nemb.n
  JOIN emb i ON i.vec_id = (t.movie_id * 7 + 3) % nemb.n"""


cte("p_train", _planted("train"), "train", "emb", "nemb")
cte("p_test", _planted("test"), "test", "emb", "nemb")
cte("p_mu", "SELECT avg(rating) AS mu FROM p_train", "p_train")
_prev = None
for _s in range(1, P.bias_sweeps + 1):
    _bu = f"coalesce({_prev}.b_u, 0)" if _prev else "0"
    _join = f"LEFT JOIN {_prev} USING (customer_id)" if _prev else ""
    cte(f"p_bi{_s}", f"""
  SELECT t.movie_id, avg(t.rating - p_mu.mu - {_bu}) / CAST({REG_DIV} AS DOUBLE) AS b_i
  FROM p_train t CROSS JOIN p_mu {_join} GROUP BY t.movie_id""",
        "p_train", "p_mu", *((_prev,) if _prev else ()))
    cte(f"p_bu{_s}", f"""
  SELECT t.customer_id, avg(t.rating - p_mu.mu - b.b_i) / CAST({REG_DIV} AS DOUBLE) AS b_u
  FROM p_train t CROSS JOIN p_mu JOIN p_bi{_s} b USING (movie_id) GROUP BY t.customer_id""",
        "p_train", "p_mu", f"p_bi{_s}")
    _prev = f"p_bu{_s}"
for _t in ("train", "test"):
    cte(f"p_{_t}_rmse", f"""
  SELECT sqrt(avg(pow(least(greatest(p_mu.mu + coalesce(u.b_u, 0) + coalesce(i.b_i, 0), 1), 5)
                      - t.rating, 2))) AS rmse
  FROM p_{_t} t CROSS JOIN p_mu LEFT JOIN {_prev} u USING (customer_id)
  LEFT JOIN p_bi{P.bias_sweeps} i USING (movie_id)""",
        f"p_{_t}", "p_mu", _prev, f"p_bi{P.bias_sweeps}")

ORACLE["fit_mf"] = sql("""
  SELECT (SELECT count(*) FROM p_train) AS n_train, (SELECT count(*) FROM p_test) AS n_test,
         round(p_mu.mu, 6) AS mu, round(p_test_rmse.rmse, 6) AS bias_test_rmse,
         TRUE AS als_passes FROM p_mu CROSS JOIN p_test_rmse""", "p_train", "p_test", "p_test_rmse")
ORACLE["train_test_gap"] = sql("""
  SELECT round(a.rmse, 6) AS bias_train_rmse, round(b.rmse, 6) AS bias_test_rmse,
         round(b.rmse - a.rmse, 6) AS bias_gap, TRUE AS als_passes
  FROM p_train_rmse a CROSS JOIN p_test_rmse b""", "p_train_rmse", "p_test_rmse")
ORACLE["hyperparameter_sweep"] = sql("""
  SELECT CAST(s.f AS INTEGER) AS n_factors, CAST(s.r AS DOUBLE) AS reg_all,
         round(rmse, 6) AS bias_test_rmse, TRUE AS als_passes
  FROM p_test_rmse CROSS JOIN (VALUES (100, 0.02), (50, 0.05)) AS s(f, r)""", "p_test_rmse")
ORACLE["distinct_sketches"] = sql("""
  SELECT coalesce(year_month, 'all') AS year_month, count(*) AS n_ratings,
         count(DISTINCT customer_id) AS exact_users, count(DISTINCT movie_id) AS exact_movies,
         TRUE AS users_within, TRUE AS movies_within
  FROM (SELECT *, strftime(date, '%Y-%m') AS year_month FROM ratings)
  GROUP BY GROUPING SETS ((year_month), ())""", "ratings")
ORACLE["dense_index_inverse"] = sql("""
  SELECT idx, customer_id FROM (
    SELECT customer_id, row_number() OVER (ORDER BY customer_id) - 1 AS idx
    FROM (SELECT DISTINCT customer_id FROM ratings)) SEMI JOIN test USING (customer_id)""",
    "ratings", "test")
ORACLE["rating_guard"] = sql("""
  SELECT CAST(movie_id AS INTEGER) AS movie_id, CAST(customer_id AS INTEGER) AS customer_id,
         rating, date FROM ratings WHERE customer_id % 19 <> 0""", "ratings")
cte("log_train", "SELECT r.* FROM ratings_all r CROSS JOIN cut WHERE r.date < cut.cut",
    "ratings_all", "cut")
cte("log_test", "SELECT r.* FROM ratings_all r CROSS JOIN cut WHERE r.date >= cut.cut",
    "ratings_all", "cut")
cte("log_known", "SELECT DISTINCT customer_id, TRUE AS known FROM log_train", "log_train")
ORACLE["run_log"] = sql("""
  SELECT 'r1' AS run_id, 'train' AS stage, (SELECT count(*) FROM log_test) AS n_test_rows,
         (SELECT count(*) FROM log_train) AS n_train_rows,
         (SELECT count(*) FROM log_known) AS num_users,
         round((SELECT avg(CASE WHEN known THEN CAST(0 AS DOUBLE) ELSE 1 END)
                FROM log_test LEFT JOIN log_known USING (customer_id)), 6) AS cold_row_fraction,
         CAST(4 AS INTEGER) AS n_factors, CAST(NULL AS INTEGER) AS eval_k
  UNION ALL SELECT 'r1', 'evaluate', (SELECT count(*) FROM log_test), NULL, NULL, NULL, NULL,
                   CAST(10 AS INTEGER)""", "log_train", "log_test", "log_known")
ORACLE["ingest_report"] = sql("""
  SELECT m.n + m.odd + r.n AS n_lines, m.n + m.odd AS n_headers, m.odd AS n_malformed_headers,
         r.n_bad_customer, r.n_bad_rating, r.n_bad_date, CAST(0 AS BIGINT) AS n_no_movie,
         r.n - r.n_bad_customer - r.n_bad_rating - r.n_bad_date AS n_kept, t.n_title_lines,
         t.n_short_titles
  FROM (SELECT count(*) AS n, count(*) FILTER (WHERE customer_id % 41 = 0) AS n_bad_customer,
               count(*) FILTER (WHERE customer_id % 41 <> 0 AND customer_id % 31 = 0) AS n_bad_rating,
               count(*) FILTER (WHERE customer_id % 41 <> 0 AND customer_id % 31 <> 0
                                AND customer_id % 37 = 0) AS n_bad_date FROM ratings) r,
       (SELECT count(DISTINCT movie_id) AS n,
               count(DISTINCT movie_id) FILTER (WHERE movie_id % 43 = 0) AS odd FROM ratings) m,
       (SELECT count(*) AS n_title_lines, count(*) FILTER (WHERE movie_id % 17 = 0)
               AS n_short_titles FROM titles) t""", "ratings", "titles")

# --- the joint fit with one factor: 2 x 2 normal equations of every user, then item ------------

def _half_step(own: str, other: str, vectors: str, bias: str, factor: str, out: tuple) -> str:
    """(bias, factor) of each ``own`` key from the other side's ``vectors``."""
    lam = f"CAST({P.reg_all} AS DOUBLE)"
    return f"""
  SELECT {own}, (a11 * r2 - a12 * r1) / (a11 * a22 - a12 * a12) AS {out[0]},
         (a22 * r1 - a12 * r2) / (a11 * a22 - a12 * a12) AS {out[1]}
  FROM (SELECT t.{own}, sum(v.{factor} * v.{factor}) + {lam} * count(*) AS a11,
               sum(v.{factor}) AS a12, (1 + {lam}) * count(*) AS a22,
               sum(v.{factor} * (t.rating - p_mu.mu - v.{bias})) AS r1,
               sum(t.rating - p_mu.mu - v.{bias}) AS r2
        FROM p_train t CROSS JOIN p_mu JOIN {vectors} v USING ({other}) GROUP BY t.{own})"""


cte("joint_i0", """
  SELECT DISTINCT movie_id, CAST(0 AS DOUBLE) AS b_i, (movie_id % 7 - 3) / CAST(10 AS DOUBLE) AS q
  FROM p_train""", "p_train")
for _s in range(1, 4):
    cte(f"joint_u{_s}", _half_step("customer_id", "movie_id", f"joint_i{_s - 1}", "b_i", "q",
                                   ("b_u", "p")), "p_train", "p_mu", f"joint_i{_s - 1}")
    cte(f"joint_i{_s}", _half_step("movie_id", "customer_id", f"joint_u{_s}", "b_u", "p",
                                   ("b_i", "q")), "p_train", "p_mu", f"joint_u{_s}")
ORACLE["joint_fit_factors"] = sql("""
  SELECT 'user' AS side, customer_id AS id, round(b_u, 6) AS bias, round(p, 6) AS factor
  FROM joint_u3 UNION ALL
  SELECT 'item', movie_id, round(b_i, 6), round(q, 6) FROM joint_i3""", "joint_u3", "joint_i3")
ORACLE["joint_fit"] = sql("""
  SELECT count(*) AS n_train, count(DISTINCT customer_id) AS n_users,
         count(DISTINCT movie_id) AS n_items, round(avg(rating), 6) AS mu,
         CAST(10 AS INTEGER) AS n_iterations, TRUE AS objective_falls, TRUE AS train_within,
         TRUE AS test_within FROM p_train""", "p_train")
cte("unit", """
  SELECT movie_id, list_transform(q, lambda x: x / sqrt(list_dot_product(q, q))) AS v
  FROM itf WHERE q IS NOT NULL AND list_dot_product(q, q) > 0""", "itf")
ORACLE["similar_items"] = sql(f"""
  SELECT movie_id, CAST(rn AS INTEGER) AS rank, similar_id, round(c, 6) AS cosine
  FROM (SELECT *, row_number() OVER (PARTITION BY movie_id
                                     ORDER BY round(c, 9) DESC, similar_id) AS rn
        FROM (SELECT a.movie_id, b.movie_id AS similar_id, list_dot_product(a.v, b.v) AS c
              FROM unit a JOIN unit b ON a.movie_id <> b.movie_id))
  WHERE rn <= {P.top_k}""", "unit")
ORACLE["personalised_vs_popular"] = sql(f"""
  SELECT segment, count(*) AS n_users, round(avg(n), 6) AS avg_overlap
  FROM (SELECT r.customer_id, r.segment, count(p.movie_id) AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                           ORDER BY round(raw, 9) DESC, movie_id) AS rn
              FROM rec_cand) r
        LEFT JOIN (SELECT i.movie_id FROM itf i CROSS JOIN mu
                   ORDER BY round(mu.mu + i.b_i, 9) DESC, i.movie_id LIMIT {P.top_k}) p
          ON p.movie_id = r.movie_id
        WHERE r.rn <= {P.top_k} GROUP BY 1, 2) GROUP BY 1""", "rec_cand", "itf", "mu")

ORACLE["metrics_json_roundtrip"] = ORACLE["metrics_report"]
ORACLE["recommend_single"] = (f"SELECT * FROM ({_REC}) WHERE customer_id = "
                              "(SELECT min(customer_id) FROM (" + sql(
                                  "SELECT customer_id FROM test", "test") + "))")
ORACLE["recommend_batch"] = f"""SELECT * FROM ({_REC}) WHERE customer_id IN (
  SELECT customer_id FROM (
    SELECT customer_id, count(*) OVER () AS n, row_number() OVER (
             ORDER BY md5(CAST(customer_id AS VARCHAR) || ':{P.seed}'), customer_id) AS rn
    FROM (SELECT DISTINCT customer_id FROM ({sql("SELECT customer_id FROM test", "test")})))
  WHERE rn <= floor(n * CAST(0.3 AS DOUBLE)))"""
