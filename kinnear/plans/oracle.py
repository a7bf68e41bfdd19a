"""Oracle SQL texts (DuckDB) for the registered queries.

Written independently of the Spark plans: similarities here come from a
plain self-join on item and the dense ranking from window functions over
the full similarity table, so they check the Spark strategies and rankings.
The tables are views over the same parquet files.
"""

from __future__ import annotations

from kinnear.plans.queries import EARLY_DAYS, HOLDOUT_N, K_CURVE, K_DENSE, K_EVENTS, K_MAIN, K_NATION, KS, KS_NATION, LOOKUPS

_BASE = """
raw AS (
  SELECT o_custkey AS u, l_partkey AS i,
         CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
         (l_orderkey * 7 + l_linenumber) % 5 = 0 AS t
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
r AS (SELECT u, i, max(rating) AS rating, bool_or(t) AS is_test FROM raw GROUP BY u, i),
train AS (SELECT u, i, rating FROM r WHERE NOT is_test),
test AS (SELECT u, i, rating FROM r WHERE is_test),
mean AS (SELECT u, sum(rating) / count(*) AS a FROM train GROUP BY u),
dev AS (
  SELECT t.u, t.i,
         CASE WHEN abs(t.rating - m.a) < CAST(1e-12 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE
         (t.rating - m.a) / (CASE WHEN t.rating > m.a THEN CAST(5 AS DOUBLE) - m.a
                                  ELSE m.a - CAST(1 AS DOUBLE) END) END AS dev
  FROM train t JOIN mean m ON t.u = m.u),
nz AS (SELECT u, i, dev FROM dev WHERE dev <> 0),
norm AS (SELECT u, sqrt(sum(dev * dev)) AS nrm FROM nz GROUP BY u),
prof AS (SELECT z.u, z.i, z.dev / n.nrm AS w FROM nz z JOIN norm n ON z.u = n.u WHERE n.nrm <> 0)
"""

_SIM = """,
sim AS (SELECT a.u, b.u AS v, sum(a.w * b.w) AS s
        FROM prof a JOIN prof b ON a.i = b.i AND a.u <> b.u GROUP BY a.u, b.u),
cand AS (SELECT u, v, s, round(s, 9) AS sr FROM sim WHERE round(s, 9) <> 0),
rk AS (SELECT u, v, s, sr,
              sum(CASE WHEN sr < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY u) AS nneg,
              row_number() OVER (PARTITION BY u, sr > 0 ORDER BY sr DESC, v) AS rn
       FROM cand),
nbr AS (SELECT u, v, s,
               CAST(CASE WHEN sr > 0 THEN rn
                         ELSE (SELECT count(DISTINCT u) FROM r) - nneg + rn END AS BIGINT) AS rank
        FROM rk)
"""


def _with(*extra: str) -> str:
    return "WITH " + _BASE + "".join(extra)


def _pred(k: int, name: str = "p") -> str:
    """CTE chain ``{name}_wd`` (weighted deviation) and ``{name}`` (prediction)."""
    return f""",
{name}_pairs AS (
  SELECT t.u, t.i, t.rating, m.a, n.s, d.dev
  FROM test t
  LEFT JOIN mean m ON t.u = m.u
  LEFT JOIN (SELECT u, v, s FROM nbr WHERE rank <= {k}) n ON t.u = n.u
  LEFT JOIN nz d ON d.u = n.v AND d.i = t.i),
{name}_agg AS (
  SELECT u, i, rating, a, sum(dev * s) AS num,
         sum(CASE WHEN dev IS NOT NULL THEN abs(s) END) AS den
  FROM {name}_pairs GROUP BY u, i, rating, a),
{name}_wd AS (
  SELECT u, i, rating, a,
         CASE WHEN den IS NOT NULL AND den <> 0 THEN num / den ELSE CAST(0 AS DOUBLE) END AS wdev
  FROM {name}_agg),
{name} AS (
  SELECT u, i, rating,
         a + wdev * (CASE WHEN a + wdev > a THEN CAST(5 AS DOUBLE) - a
                          WHEN a + wdev < a THEN a - CAST(1 AS DOUBLE)
                          ELSE CAST(1 AS DOUBLE) END) AS prediction
  FROM {name}_wd)
"""


def _stats_cte() -> str:
    parts = []
    for k in KS:
        parts.append(_pred(k, f"p{k}"))
    sel = " UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS k, count(abs(rating - prediction)) AS n,
                   avg(abs(rating - prediction)) AS mae,
                   min(abs(rating - prediction)) AS min_e, max(abs(rating - prediction)) AS max_e,
                   var_pop(abs(rating - prediction)) AS var_e,
                   stddev_pop(abs(rating - prediction)) AS std_e
            FROM p{k}"""
        for k in KS
    )
    return "".join(parts) + f""",
stats AS ({sel})
"""


def _edges_select(ks=KS) -> str:
    return " UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS k,
                   count(*) FILTER (WHERE rank <= {k}) AS edges,
                   count(*) FILTER (WHERE rank <= {k} AND round(s, 9) < 0) AS negative_edges
            FROM nbr"""
        for k in ks
    )


_EVENTS = """
r AS (SELECT user_id AS u, event_type AS i, avg(value) AS rating FROM events GROUP BY user_id, event_type),
b AS (SELECT min(rating) AS lo, max(rating) AS hi FROM r),
mean AS (SELECT u, sum(rating) / count(*) AS a FROM r GROUP BY u),
dev AS (
  SELECT r.u, r.i,
         CASE WHEN abs(r.rating - m.a) < CAST(1e-12 AS DOUBLE) THEN CAST(0 AS DOUBLE) ELSE
         (r.rating - m.a) / (CASE WHEN r.rating > m.a THEN b.hi - m.a ELSE m.a - b.lo END) END AS dev
  FROM r JOIN mean m ON r.u = m.u CROSS JOIN b),
nz AS (SELECT u, i, dev FROM dev WHERE dev <> 0),
norm AS (SELECT u, sqrt(sum(dev * dev)) AS nrm FROM nz GROUP BY u),
prof AS (SELECT z.u, z.i, z.dev / n.nrm AS w FROM nz z JOIN norm n ON z.u = n.u WHERE n.nrm <> 0)
"""


_NATIONS = """
r AS (SELECT CAST(c_nationkey AS BIGINT) AS u, l_partkey AS i,
             max(CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE)) AS rating
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      GROUP BY c_nationkey, l_partkey),
train AS (SELECT * FROM r),
""" + _BASE[_BASE.index("mean AS"):]


_EMBEDDINGS = """
cells AS (SELECT vec_id AS u, CAST(unnest(generate_series(0, len(embedding) - 1)) AS BIGINT) AS i,
                 CAST(unnest(embedding) AS DOUBLE) AS dev
          FROM embeddings),
nz AS (SELECT u, i, dev FROM cells WHERE dev <> 0),
r AS (SELECT DISTINCT u FROM nz),
norm AS (SELECT u, sqrt(sum(dev * dev)) AS nrm FROM nz GROUP BY u),
prof AS (SELECT z.u, z.i, z.dev / n.nrm AS w FROM nz z JOIN norm n ON z.u = n.u WHERE n.nrm <> 0)
"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["embedding_knn"] = "WITH " + _EMBEDDINGS + _SIM + (
        f"SELECT u, v, (round(s, 6) + CAST(0 AS DOUBLE)) AS sim, rank FROM nbr WHERE rank <= {K_EVENTS}"
    )
    q["events_knn"] = "WITH " + _EVENTS + _SIM + (
        f"SELECT u, v, (round(s, 6) + CAST(0 AS DOUBLE)) AS sim, rank FROM nbr WHERE rank <= {K_EVENTS}"
    )
    q["ratings_scan"] = _with() + "SELECT u, i, rating, CAST(is_test AS BIGINT) AS is_test FROM r"
    q["parse_fields"] = _with() + "SELECT u, i, rating FROM r"
    q["dedup_ratings"] = _with() + """
SELECT u, i, count(*) AS n, sum(rating) AS r_sum, max(rating) AS r_max,
       (round(sum(rating) / count(*), 6) + CAST(0 AS DOUBLE)) AS r_mean
FROM raw GROUP BY u, i"""
    q["holdout_split"] = _with(f""",
h AS (SELECT u, i,
             row_number() OVER (PARTITION BY u ORDER BY ((u % 1009) * 31 + (i % 1009) * 17) % 1009, i) AS rn,
             count(*) OVER (PARTITION BY u) AS cnt
      FROM r)
""") + f"SELECT u, i, CAST(rn <= {HOLDOUT_N} AND cnt > {HOLDOUT_N} AS BIGINT) AS is_test FROM h"
    q["positive_cells"] = _with() + "SELECT u, i, rating FROM test WHERE rating > 0"
    q["item_slice"] = _with(""",
top_item AS (SELECT i FROM train GROUP BY i ORDER BY count(*) DESC, i LIMIT 1)
""") + "SELECT d.u, (round(d.dev, 6) + CAST(0 AS DOUBLE)) AS dev FROM dev d JOIN top_item ti ON d.i = ti.i"
    q["scale_expr"] = _with() + """
SELECT t.u, t.i,
       (round(CASE WHEN abs(t.rating - m.a) < CAST(1e-12 AS DOUBLE) THEN CAST(1 AS DOUBLE)
                  WHEN t.rating > m.a THEN CAST(5 AS DOUBLE) - m.a
                  WHEN t.rating < m.a THEN m.a - CAST(1 AS DOUBLE)
                  ELSE CAST(1 AS DOUBLE) END, 6) + CAST(0 AS DOUBLE)) AS scale
FROM train t JOIN mean m ON t.u = m.u"""
    q["user_mean"] = _with() + "SELECT u, (round(a, 6) + CAST(0 AS DOUBLE)) AS mean FROM mean"
    q["item_mean"] = _with() + "SELECT i, (round(sum(rating) / count(*), 6) + CAST(0 AS DOUBLE)) AS mean FROM train GROUP BY i"
    q["user_norm"] = _with() + "SELECT u, (round(sqrt(sum(dev * dev)), 6) + CAST(0 AS DOUBLE)) AS norm FROM dev GROUP BY u"
    q["normalized_deviation"] = _with() + "SELECT u, i, (round(dev, 6) + CAST(0 AS DOUBLE)) AS dev FROM dev"
    q["unit_profile"] = _with() + "SELECT u, i, (round(w, 6) + CAST(0 AS DOUBLE)) AS weight FROM prof"
    q["similarity_pairs"] = _with() + """
SELECT a.u, b.u AS v, (round(sum(a.w * b.w), 6) + CAST(0 AS DOUBLE)) AS sim
FROM prof a JOIN prof b ON a.i = b.i AND a.u < b.u
GROUP BY a.u, b.u HAVING round(sum(a.w * b.w), 9) <> 0"""
    q["similarity_one_user"] = _with(""",
top_user AS (SELECT u FROM prof GROUP BY u ORDER BY count(*) DESC, u LIMIT 1)
""") + """
SELECT b.u AS v, (round(sum(a.w * b.w), 6) + CAST(0 AS DOUBLE)) AS sim
FROM prof a JOIN top_user tu ON a.u = tu.u JOIN prof b ON a.i = b.i AND b.u <> a.u
GROUP BY b.u HAVING round(sum(a.w * b.w), 9) <> 0"""
    nbr_out = "SELECT u, v, (round(s, 6) + CAST(0 AS DOUBLE)) AS sim, rank FROM nbr WHERE rank <= {k}"
    q["knn_topk"] = _with(_SIM) + nbr_out.format(k=K_MAIN)
    q["knn_dense_rank"] = _with(_SIM) + nbr_out.format(k=K_DENSE)
    q["knn_multi_k"] = _with(_SIM) + _edges_select()
    q["neighbour_explode"] = q["knn_topk"]
    q["neighbour_lists_text"] = _with(_SIM) + f"""
SELECT u, string_agg(CAST(rank AS VARCHAR) || ':' || CAST(v AS VARCHAR), ',' ORDER BY rank) AS neighbours
FROM nbr WHERE rank <= {K_MAIN} GROUP BY u"""
    q["knn_dense_nation"] = "WITH " + _NATIONS + _SIM + nbr_out.format(k=K_NATION)
    q["knn_multi_k_nation"] = "WITH " + _NATIONS + _SIM + _edges_select(KS_NATION)
    q["ratings_text"] = q["parse_fields"]
    q["dedup_policies"] = _with() + " UNION ALL ".join(
        f"SELECT '{p}' AS policy, u, i, (round({f}, 6) + CAST(0 AS DOUBLE)) AS rating FROM raw GROUP BY u, i"
        for p, f in [("sum", "sum(rating)"), ("max", "max(rating)"), ("mean", "sum(rating) / count(*)")])
    q["sparse_difference"] = _with(""",
a AS (SELECT u, i, max(rating) AS x FROM raw WHERE t GROUP BY u, i),
b AS (SELECT u, i, max(rating) AS y FROM raw WHERE NOT t GROUP BY u, i)
""") + """
SELECT coalesce(a.u, b.u) AS u, coalesce(a.i, b.i) AS i,
       coalesce(x, CAST(0 AS DOUBLE)) - coalesce(y, CAST(0 AS DOUBLE)) + CAST(0 AS DOUBLE) AS diff
FROM a FULL OUTER JOIN b ON a.u = b.u AND a.i = b.i"""
    q["positive_deviations"] = _with() + "SELECT u, i, (round(dev, 6) + CAST(0 AS DOUBLE)) AS dev FROM dev WHERE dev > 0"
    q["cold_start_early"] = f"""
WITH l AS (SELECT o_custkey AS u, l_partkey AS i,
                  CAST(o_orderdate AS DATE) < CAST((SELECT min(o_orderdate) FROM orders) AS DATE) + {EARLY_DAYS} AS early
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
tr AS (SELECT DISTINCT u, i FROM l WHERE early),
te AS (SELECT DISTINCT u, i FROM l WHERE NOT early)
SELECT 'user' AS kind, count(*) AS n FROM te WHERE u NOT IN (SELECT u FROM tr)
UNION ALL
SELECT 'item' AS kind, count(*) AS n FROM te WHERE i NOT IN (SELECT i FROM tr)"""
    q["weighted_deviation"] = _with(_SIM, _pred(K_MAIN)) + "SELECT u, i, (round(wdev, 6) + CAST(0 AS DOUBLE)) AS wdev FROM p_wd"
    q["predict"] = _with(_SIM, _pred(K_MAIN)) + "SELECT u, i, rating, (round(prediction, 6) + CAST(0 AS DOUBLE)) AS prediction FROM p"
    q["cell_errors"] = _with(_SIM, _pred(K_MAIN)) + (
        "SELECT u, i, (round(abs(rating - prediction), 6) + CAST(0 AS DOUBLE)) AS abs_error FROM p"
    )
    q["mae"] = _with(_SIM, _pred(K_MAIN)) + (
        "SELECT (round(avg(abs(rating - prediction)), 6) + CAST(0 AS DOUBLE)) AS mae, count(abs(rating - prediction)) AS n FROM p"
    )
    q["mae_by_k"] = _with(_SIM, _stats_cte()) + "SELECT k, (round(mae, 6) + CAST(0 AS DOUBLE)) AS mae, n FROM stats"
    q["summary_stats"] = _with(_SIM, _stats_cte()) + """
SELECT k, (round(min_e, 6) + CAST(0 AS DOUBLE)) AS min_e, (round(max_e, 6) + CAST(0 AS DOUBLE)) AS max_e, (round(mae, 6) + CAST(0 AS DOUBLE)) AS avg_e,
       (round(var_e, 6) + CAST(0 AS DOUBLE)) AS var_e, (round(std_e, 6) + CAST(0 AS DOUBLE)) AS std_e
FROM stats"""
    q["cold_start"] = _with() + """
SELECT 'user' AS kind, count(*) AS n FROM test WHERE u NOT IN (SELECT u FROM train)
UNION ALL
SELECT 'item' AS kind, count(*) AS n FROM test WHERE i NOT IN (SELECT i FROM train)"""
    q["metrics_report"] = _with(_SIM, _stats_cte()) + " UNION ALL ".join(
        f"SELECT 'abs_error k=' || CAST(k AS VARCHAR) AS section, '{m}' AS metric, (round({c}, 6) + CAST(0 AS DOUBLE)) AS value FROM stats"
        for m, c in [("average", "mae"), ("min", "min_e"), ("max", "max_e"), ("variance", "var_e"), ("stddev", "std_e")]
    )
    q["report_nested"] = _with(_SIM, _stats_cte(), """,
long AS (""" + " UNION ALL ".join(
        f"SELECT 'abs_error k=' || CAST(k AS VARCHAR) AS section, '{m}' AS metric, (round({c}, 6) + CAST(0 AS DOUBLE)) AS value FROM stats"
        for m, c in [("average", "mae"), ("min", "min_e"), ("max", "max_e"), ("variance", "var_e"), ("stddev", "std_e")]
    ) + """)
""") + """
SELECT section, string_agg(metric || '=' || CAST(CAST(round(value * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY metric) AS metrics
FROM long GROUP BY section"""
    ev = [
        "SELECT 'data' AS section, 'train_cells' AS metric, CAST(count(*) AS DOUBLE) AS value FROM train",
        "SELECT 'data', 'test_cells', CAST(count(*) AS DOUBLE) FROM test",
        "SELECT 'data', 'cold_users', CAST(count(*) AS DOUBLE) FROM test WHERE u NOT IN (SELECT u FROM train)",
        "SELECT 'data', 'cold_items', CAST(count(*) AS DOUBLE) FROM test WHERE i NOT IN (SELECT i FROM train)",
        "SELECT 'data', 'users', CAST((SELECT count(DISTINCT u) FROM r) AS DOUBLE)",
    ]
    for k in KS:
        ev += [
            f"SELECT 'k={k}', 'mae', (round(mae, 6) + CAST(0 AS DOUBLE)) FROM stats WHERE k = {k}",
            f"SELECT 'k={k}', 'predicted', CAST(n AS DOUBLE) FROM stats WHERE k = {k}",
            f"SELECT 'k={k}', 'edges', CAST(edges AS DOUBLE) FROM edges WHERE k = {k}",
            f"SELECT 'k={k}', 'negative_edges', CAST(negative_edges AS DOUBLE) FROM edges WHERE k = {k}",
        ]
    q["evaluate"] = _with(_SIM, _stats_cte(), f""",
edges AS ({_edges_select()})
""") + "\nUNION ALL\n".join(ev)
    q["knn_pruned"], q["events_knn_pruned"] = q["knn_topk"], q["events_knn"]
    q["predict_lists"] = q["stored_model"] = q["predict"]
    q["ratings_csv"] = q["parse_fields"]
    q["ratings_rejects"] = _with() + "SELECT u, i, rating, (SELECT count(*) FROM r WHERE u % 7 = 0) AS rejected FROM r WHERE u % 7 <> 0"
    q["split_files"] = _with() + "SELECT u, i, rating, CASE WHEN is_test THEN 'test' ELSE 'train' END AS side FROM r"
    pairs = """
SELECT a.u, b.u AS v, (round(sum(a.w * b.w), 6) + CAST(0 AS DOUBLE)) AS sim
FROM prof a JOIN prof b ON a.i = b.i AND {which} GROUP BY a.u, b.u HAVING round(sum(a.w * b.w), 9) <> 0"""
    q["similarity_chunked"] = "WITH " + _NATIONS + pairs.format(which="a.u < b.u")
    q["similarity_many_users"] = _with(f""",
top AS (SELECT u FROM prof GROUP BY u ORDER BY count(*) DESC, u LIMIT {LOOKUPS})
""") + pairs.format(which="a.u <> b.u AND a.u IN (SELECT u FROM top)")
    q["mae_curve"] = _with(_SIM, f""",
hits AS (SELECT t.u, t.i, n.rank, n.s, d.dev FROM test t JOIN nbr n ON t.u = n.u JOIN nz d ON d.u = n.v AND d.i = t.i WHERE n.rank <= {K_CURVE}),
ks AS (SELECT CAST(unnest(range(1, {K_CURVE} + 1)) AS BIGINT) AS k),
wd AS (SELECT k, u, i, sum(dev * s) / sum(abs(s)) AS wd FROM ks JOIN hits ON rank <= k GROUP BY k, u, i),
w AS (SELECT ks.k, t.rating, m.a, m.a + coalesce(wd, CAST(0 AS DOUBLE)) AS x, coalesce(wd, CAST(0 AS DOUBLE)) AS wd
      FROM ks CROSS JOIN test t JOIN mean m ON t.u = m.u LEFT JOIN wd ON wd.k = ks.k AND wd.u = t.u AND wd.i = t.i),
e AS (SELECT k, abs(rating - (a + wd * (CASE WHEN x > a THEN CAST(5 AS DOUBLE) - a WHEN x < a THEN a - CAST(1 AS DOUBLE)
                                             ELSE CAST(1 AS DOUBLE) END))) AS e FROM w)
""") + "SELECT k, count(*) AS n, (round(avg(e), 6) + CAST(0 AS DOUBLE)) AS mae, (round(sqrt(avg(e * e)), 6) + CAST(0 AS DOUBLE)) AS rmse FROM e GROUP BY k"
    errors = " UNION ALL ".join(f"SELECT u, CAST({k} AS BIGINT) AS k, abs(rating - prediction) AS e FROM p{k}" for k in KS)
    q["error_summary"] = _with(_SIM, *[_pred(k, f"p{k}") for k in KS], f""",
errs AS ({errors})
""") + """
SELECT CASE WHEN grouping(u) = 0 THEN 'user' WHEN grouping(k) = 0 THEN 'k' ELSE 'total' END AS level,
       coalesce(u, -1) AS u, coalesce(k, -1) AS k, count(e) AS n,
       (round(avg(e) + CAST(1e-10 AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS average, (round(var_pop(e) + CAST(1e-10 AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS variance,
       (round(stddev_pop(e) + CAST(1e-10 AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS stddev, (round(min(e) + CAST(1e-10 AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS least,
       (round(max(e) + CAST(1e-10 AS DOUBLE), 6) + CAST(0 AS DOUBLE)) AS most
FROM errs GROUP BY GROUPING SETS ((u, k), (k), ())"""
    return q
