"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs against the driver's tables registered as views.  The
derivations repeat ``shelfwise.fixtures`` in SQL.  Rules that keep both
engines equal: floats cast to double before arithmetic, sums as sequential
folds, ``round(x, 6)`` before ranking, every tie broken on an id.
"""

from __future__ import annotations

# --- shared derivations --------------------------------------------------------------------

RATINGS = """
ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS product_id,
         arg_max(rating, (o_orderdate, o_orderkey, l_linenumber, rating)) AS rating
  FROM (SELECT l_partkey, l_linenumber, o_orderkey, o_custkey, o_orderdate,
               CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey) j
  GROUP BY 1, 2)"""

USERS = """
users AS (
  SELECT c_custkey AS user_id, c_name AS nick_name,
         CAST(c_nationkey % 2 AS DOUBLE) AS gender, CAST(18 + c_custkey * 7 % 60 AS DOUBLE) AS age,
         c_mktsegment AS read_style, n_name AS user_label
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

BOOKS = """
books AS (
  SELECT p_partkey AS book_id, p_name AS book_name, p_brand AS author, a.average,
         p_type AS book_style, concat('size-', p_size) AS book_label
  FROM part LEFT JOIN (SELECT product_id, round(avg(rating), 6) AS average FROM ratings GROUP BY 1) a
    ON a.product_id = p_partkey)"""

FEED = """
feed AS (
  SELECT event_id, CAST(user_id AS BIGINT) AS user_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS product_id,
         CAST(least(5, 1 + floor(value / 20)) AS DOUBLE) AS rating
  FROM events)"""

FACTORS = """
ufac AS (SELECT vec_id // 5 AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings WHERE vec_id % 5 = 0),
ifac AS (SELECT vec_id - vec_id // 5 - 1 AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings WHERE vec_id % 5 <> 0)"""

SPLIT = "('0x' || substr(md5(CAST(concat_ws(':', user_id, product_id) AS VARCHAR)), 1, 8))::BIGINT % 10 < 7"


def dot(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i] * {b}[i]), "
            f"lambda x, y: x + y)")


def sqdist(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i] - {b}[i]) * ({a}[i] - {b}[i])), "
            f"lambda x, y: x + y)")


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# --- faulty feed (shared by feed_parse / rejected_lines) --------------------------------------

FAULTY = """
raw AS (
  SELECT event_id, event_type, value,
         CASE WHEN value >= 300 THEN CAST(CAST(user_id AS HUGEINT) + 9223372036854775808 AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) END AS u,
         CAST(json_extract_string(props, '$.k') AS VARCHAR) AS p,
         CAST(CAST(least(5, 1 + floor(value / 20)) AS DOUBLE) AS VARCHAR) AS r
  FROM events),
lines AS (
  SELECT event_id, u, p, r, event_type,
         CASE event_type
           WHEN 'click' THEN u || ',' || p || ',' || r || ',' || CAST(event_id AS VARCHAR)
           WHEN 'purchase' THEN u || ', ' || p || ',' || r
           WHEN 'signup' THEN u || ',' || p
           WHEN 'error' THEN u || ',' || p || ',NaN'
           ELSE u || ',' || p || ',' || r END AS line
  FROM raw),
tagged AS (
  SELECT event_id, line,
         CASE WHEN event_type = 'signup' THEN 'too few fields'
              WHEN CAST(u AS HUGEINT) > 9223372036854775807 THEN 'id out of range'
              WHEN event_type = 'error' THEN 'number not finite'
              ELSE NULL END AS reason,
         TRY_CAST(u AS BIGINT) AS user_id, CAST(trim(p) AS BIGINT) AS product_id, CAST(r AS DOUBLE) AS rating
  FROM lines)"""


# --- clusters on users (gender, age) with every 150th user as a centre ------------------------------

USER_CLUSTERS = """
pts AS (SELECT user_id, [gender, age] AS f FROM users),
ctr AS (SELECT user_id AS center_id, [gender, age] AS f FROM users WHERE user_id % 150 = 0),
assigned AS (
  SELECT user_id, arg_min(center_id, (d, center_id)) AS cluster FROM (
    SELECT p.user_id, c.center_id,
           (p.f[1] - c.f[1]) * (p.f[1] - c.f[1]) + (p.f[2] - c.f[2]) * (p.f[2] - c.f[2]) AS d
    FROM pts p CROSS JOIN ctr c) s
  GROUP BY user_id),
given_recs AS (
  SELECT user_id, product_id, rk FROM (
    SELECT user_id, product_id,
           row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, product_id) AS rk
    FROM ratings WHERE user_id % 5 <> 0) t WHERE rk <= 10),
donors AS (
  SELECT a.cluster, min(a.user_id) AS donor_id FROM assigned a
  WHERE a.user_id IN (SELECT user_id FROM given_recs) GROUP BY a.cluster)"""


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["ratings_parse"] = with_(RATINGS) + " SELECT user_id, product_id, rating FROM ratings"
    q["users_parse"] = with_(USERS) + " SELECT * FROM users"
    q["books_parse"] = with_(RATINGS, BOOKS) + " SELECT * FROM books"
    q["feed_parse"] = with_(FAULTY) + """
      SELECT event_id, user_id, product_id, rating FROM tagged WHERE reason IS NULL"""
    q["rejected_lines"] = with_(FAULTY) + " SELECT event_id, line, reason FROM tagged WHERE reason IS NOT NULL"
    q["history_tokens"] = with_(FEED) + """
      SELECT user_id, product_id, rating, count(*) AS n FROM feed GROUP BY 1, 2, 3"""

    q["known_users"] = with_(RATINGS) + " SELECT DISTINCT user_id FROM ratings"
    q["known_split"] = with_(RATINGS, FEED) + """
      SELECT event_id, user_id, product_id, rating,
             user_id IN (SELECT user_id FROM ratings WHERE user_id % 5 <> 0) AS is_known
      FROM feed"""
    q["user_features"] = with_(USERS) + """
      SELECT user_id, CAST(user_id AS DOUBLE) AS f_user_id, gender AS f_gender, age AS f_age FROM users"""

    q["train_valid_split"] = with_(RATINGS) + f" SELECT *, {SPLIT} AS is_train FROM ratings"
    q["rmse_baseline"] = with_(RATINGS) + f""",
      train AS (SELECT * FROM ratings WHERE {SPLIT}),
      valid AS (SELECT * FROM ratings WHERE NOT ({SPLIT})),
      means AS (SELECT product_id, avg(rating) AS prediction FROM train GROUP BY 1)
      SELECT round(sqrt(avg((m.prediction - v.rating) * (m.prediction - v.rating))), 6) AS rmse,
             count(*) AS n_pairs
      FROM valid v JOIN means m ON v.product_id = m.product_id"""
    q["rmse_duplicate_pairs"] = with_(FEED) + """
      SELECT round(sqrt(avg((p.rating - a.rating) * (p.rating - a.rating))), 6) AS rmse, count(*) AS n_pairs
      FROM feed p JOIN feed a ON p.user_id = a.user_id AND p.product_id = a.product_id"""

    damping = "[0.0, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0]"
    q["select_best"] = with_(RATINGS) + f""",
      train AS (SELECT * FROM ratings WHERE {SPLIT}),
      valid AS (SELECT * FROM ratings WHERE NOT ({SPLIT})),
      stats AS (SELECT product_id, sum(rating) AS s, count(*) AS n FROM train GROUP BY 1),
      mu AS (SELECT avg(rating) AS mu FROM train),
      grid AS (SELECT CAST(i AS INT) AS trial_no, CAST(({damping})[i] AS DOUBLE) AS d FROM range(1, 8) t(i)),
      trials AS (
        SELECT g.trial_no, 1 AS rank, 1 AS max_iter, g.d AS reg_param,
               round(sqrt(avg(((s.s + g.d * mu.mu) / (s.n + g.d) - v.rating) * ((s.s + g.d * mu.mu) / (s.n + g.d) - v.rating))), 6) AS rmse
        FROM valid v JOIN stats s ON v.product_id = s.product_id CROSS JOIN mu CROSS JOIN grid g
        GROUP BY g.trial_no, g.d),
      th AS (SELECT CAST(threshold AS DOUBLE) AS threshold FROM (VALUES (1.0), (10.0)) t(threshold)),
      best AS (
        SELECT th.threshold, arg_min(t.trial_no, (t.rmse, t.trial_no)) AS best_trial
        FROM th LEFT JOIN trials t ON t.rmse < th.threshold GROUP BY th.threshold)
      SELECT t.trial_no,
             coalesce(t.rank, 10) AS rank, coalesce(t.max_iter, 20) AS max_iter,
             coalesce(t.reg_param, 0.1) AS reg_param, t.rmse, t.trial_no IS NULL AS is_default,
             best.threshold
      FROM best LEFT JOIN trials t ON t.trial_no = best.best_trial"""

    q["predict_pairs"] = with_(FEED, FACTORS) + f"""
      SELECT e.event_id, e.user_id, e.product_id, round({dot('u.f', 'i.f')}, 6) AS score
      FROM feed e JOIN ufac u ON u.id = e.user_id JOIN ifac i ON i.id = e.product_id"""
    topk = with_(FACTORS) + f""",
      scored AS (SELECT u.id AS user_id, i.id AS product_id, round({dot('u.f', 'i.f')}, 6) AS score
                 FROM ufac u CROSS JOIN ifac i),
      ranked AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank,
                        product_id, score FROM scored)
      """
    q["topk_from_factors"] = topk + "SELECT * FROM ranked WHERE rank <= 10"
    q["recs_text"] = topk + """
      SELECT user_id, string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rank) AS books,
             string_agg(printf('%.6f', score), ',' ORDER BY rank) AS scores
      FROM ranked WHERE rank <= 10 GROUP BY user_id"""
    q["recs_parse"] = topk + """
      SELECT user_id, rank, product_id, CAST(printf('%.6f', score) AS DOUBLE) AS score FROM ranked WHERE rank <= 10"""

    q["assign_to_centers"] = f"""
      WITH pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
      ctr AS (SELECT id AS center_id, f FROM pts WHERE id % 50 = 0),
      d AS (SELECT p.id, c.center_id, {sqdist('p.f', 'c.f')} AS dist FROM pts p CROSS JOIN ctr c)
      SELECT id, arg_min(center_id, (dist, center_id)) AS center_id, round(min(dist), 6) AS dist
      FROM d GROUP BY id"""

    q["same_cluster"] = with_(RATINGS, USERS, USER_CLUSTERS) + """
      SELECT n.user_id, n.cluster, m.n_members
      FROM assigned n JOIN (SELECT cluster, count(*) AS n_members FROM assigned WHERE user_id % 5 <> 0 GROUP BY 1) m
        ON n.cluster = m.cluster
      WHERE n.user_id % 5 = 0"""
    q["cluster_donors"] = with_(RATINGS, USERS, USER_CLUSTERS) + " SELECT cluster, donor_id FROM donors"
    q["donors_from_ratings"] = with_(RATINGS, USERS) + """
      , ctr AS (SELECT user_id AS c, CAST(user_id AS DOUBLE) AS x, gender AS y, age AS z FROM users WHERE user_id % 150 = 0),
      pts AS (SELECT user_id, CAST(user_id AS DOUBLE) AS x, CAST(product_id AS DOUBLE) AS y, rating AS z FROM ratings WHERE user_id % 5 <> 0),
      d AS (SELECT user_id, p.y AS product, c, (p.x - ctr.x) * (p.x - ctr.x) + (p.y - ctr.y) * (p.y - ctr.y) + (p.z - ctr.z) * (p.z - ctr.z) AS dist FROM pts p CROSS JOIN ctr),
      n AS (SELECT user_id, product, arg_min(c, (dist, c)) AS cluster FROM d GROUP BY 1, 2)
      SELECT cluster, min(user_id) AS donor_id FROM n GROUP BY 1"""
    q["cold_start"] = with_(RATINGS, USERS, USER_CLUSTERS) + """
      SELECT n.user_id, d.donor_id, CAST(g.rk AS INT) AS rank, g.product_id
      FROM assigned n JOIN donors d ON n.cluster = d.cluster JOIN given_recs g ON g.user_id = d.donor_id
      WHERE n.user_id % 5 = 0 AND n.user_id NOT IN (SELECT user_id FROM given_recs)"""

    q["upsert_latest"] = with_(USERS) + """
      SELECT user_id, nick_name, gender,
             CASE WHEN user_id % 3 = 0 THEN age + 1 ELSE age END AS age,
             CASE WHEN user_id % 3 = 0 THEN read_style || '-2' ELSE read_style END AS read_style,
             user_label
      FROM users"""
    q["upsert_partial"] = with_(USERS) + """
      SELECT user_id,
             CASE WHEN user_id % 4 = 0 THEN nick_name || '-renamed' ELSE nick_name END AS nick_name,
             gender, age, read_style, user_label
      FROM users"""
    q["keyed_lookup"] = with_(USERS) + """
      SELECT user_id, nick_name, user_label FROM users
      WHERE user_id IN (SELECT user_id FROM events)"""
    q["create_if_absent"] = with_(USERS) + """
      SELECT true AS created_first, false AS created_second, count(*) AS n_rows FROM users"""
    q["keyed_compact"] = with_(USERS) + """
      SELECT user_id,
             CASE WHEN user_id % 4 = 0 THEN nick_name || '-renamed' ELSE nick_name END AS nick_name,
             gender, age,
             CASE WHEN user_id % 6 = 0 THEN read_style || '-c' ELSE read_style END AS read_style,
             user_label
      FROM users"""
    q["recs_merge"] = with_(RATINGS, USERS, USER_CLUSTERS) + """,
      all_top AS (
        SELECT user_id, product_id,
               row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, product_id) AS rk
        FROM ratings WHERE user_id % 10 = 0),
      als1 AS (SELECT user_id, 'als' AS source, CAST(1 AS BIGINT) AS model_version,
                      string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rk) AS products, count(*) AS n_recs
               FROM given_recs GROUP BY user_id),
      als2 AS (SELECT user_id, 'als' AS source, CAST(2 AS BIGINT) AS model_version,
                      string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY rk) AS products, count(*) AS n_recs
               FROM all_top WHERE rk <= 10 GROUP BY user_id),
      cs AS (SELECT a.user_id, 'cold_start' AS source, CAST(NULL AS BIGINT) AS model_version,
                    g.products, g.n_recs
             FROM assigned a JOIN donors d ON a.cluster = d.cluster JOIN als1 g ON g.user_id = d.donor_id),
      ranked AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prio DESC) AS r FROM (
          SELECT *, 3 AS prio FROM als2 UNION ALL SELECT *, 2 FROM als1 UNION ALL SELECT *, 1 FROM cs) u)
      SELECT user_id, source, model_version, products, CAST(n_recs AS INT) AS n_recs FROM ranked WHERE r = 1"""
    q["topk_ties"] = with_(FACTORS) + f""",
      scored AS (SELECT u.id AS user_id, i.id AS product_id, round(CASE WHEN u.id % 5 = 0 THEN 0.0 ELSE {dot('u.f', 'i.f')} END, 6) AS score
                 FROM ufac u CROSS JOIN ifac i),
      ranked AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INT) AS rank,
                        product_id, score FROM scored)
      SELECT * FROM ranked WHERE rank <= 10"""
    q["topk_blocks"] = q["topk_pruned"] = q["topk_from_factors"]
    q["users_parse_faulty"] = """
      SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN user_id + 8589934592 ELSE user_id END AS BIGINT) AS user_id, 'n' AS nick_name,
             CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN NULL WHEN 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS gender,
             CASE WHEN event_type IN ('purchase', 'error') THEN NULL ELSE CAST(event_id % 90 AS DOUBLE) END AS age,
             's' AS read_style, 'l' AS user_label
      FROM events WHERE event_type <> 'signup'"""
    q["skipped_users"] = """
      SELECT count(*) AS n_lines, count(*) FILTER (WHERE event_type = 'signup') AS n_rejected,
             count(*) FILTER (WHERE event_type IN ('click', 'purchase', 'error')) AS n_skipped,
             count(*) FILTER (WHERE event_type NOT IN ('signup', 'click', 'purchase', 'error')) AS n_vectors
      FROM events"""
    q["books_parse_faulty"] = """
      SELECT event_id, CAST(9780000000000 + event_id AS BIGINT) AS book_id, 't' AS book_name, 'a' AS author,
             CASE WHEN event_type IN ('click', 'purchase', 'error') THEN NULL ELSE CAST(event_id % 5 AS DOUBLE) END AS average,
             's' AS book_style, 'l' AS book_label
      FROM events WHERE event_type <> 'signup'"""
    q["parse_wide_ids"] = with_(FEED) + """
      SELECT event_id, user_id + 1099511627776 AS user_id, product_id + 1099511627776 AS product_id, rating FROM feed"""
    q["keyed_get"] = with_(USERS, FEED) + """
      SELECT user_id, nick_name, age, 'get' AS how FROM users WHERE user_id = (SELECT arg_max(user_id, event_id) FROM feed)
      UNION ALL
      SELECT k.user_id, nick_name, age, 'lookup' FROM (SELECT DISTINCT user_id * 100 AS user_id FROM feed) k LEFT JOIN users u ON u.user_id = k.user_id"""
    q["upsert_same_batch"] = with_(USERS) + """,
      lines AS (SELECT user_id, max(event_id) AS e FROM events GROUP BY user_id)
      SELECT coalesce(u.user_id, l.user_id) AS user_id,
             CASE WHEN e IS NULL THEN nick_name ELSE 'n' || CAST(e AS VARCHAR) END AS nick_name,
             CASE WHEN e IS NULL THEN gender ELSE CAST(e % 2 AS DOUBLE) END AS gender,
             CASE WHEN e IS NULL THEN age WHEN e % 3 > 0 THEN CAST(100 - e % 83 AS DOUBLE) END AS age,
             CASE WHEN e IS NULL THEN read_style ELSE 's' || CAST(e % 7 AS VARCHAR) END AS read_style,
             CASE WHEN e IS NULL THEN user_label ELSE 'l' || CAST(9 - e % 9 AS VARCHAR) END AS user_label
      FROM users u FULL JOIN lines l ON u.user_id = l.user_id"""
    q["history_same_batch"] = with_(FEED) + """
      SELECT user_id, product_id, arg_max(rating, event_id) AS rating FROM feed GROUP BY user_id, product_id"""
    q["reload_after_compact"] = with_(USERS) + """
      SELECT user_id, CASE WHEN user_id % 7 = 0 OR user_id % 4 = 0 THEN nick_name || '-2' ELSE nick_name END AS nick_name,
             gender, age, read_style, user_label
      FROM users"""
    q["bootstrap_quarantine"] = with_(FAULTY) + """
      SELECT 'ratings' AS kind, reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY reason"""
    return q
