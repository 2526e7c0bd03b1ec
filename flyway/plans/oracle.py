"""DuckDB SQL for the correctness gate, assembled from named CTE fragments.

Each oracle query is ``WITH <the fragments it needs> <body>``.  The fragments
restate the semantics of the Spark operators in plain SQL (hash joins, windows,
aggregates) over the same parquet views.
"""

from __future__ import annotations

K = 10

CTE: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTE[name] = sql.strip()
    DEPS[name] = deps or []


def with_(names: list[str], body: str) -> str:
    """WITH clause of ``names`` and their dependencies, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTE[n]}\n)" for n in order) + "\n" + body.strip()


def with_in(names: list[str], body: str, **instead: str) -> str:
    """``with_`` where each fragment of ``instead`` reads another fragment's rows (a regional run)."""
    kept = {n: (CTE[n], DEPS[n]) for n in instead}
    try:
        for n, other in instead.items():
            cte(n, f"SELECT * FROM {other}", [other])
        return with_(names, body)
    finally:
        for n, (sql, deps) in kept.items():
            cte(n, sql, deps)


# ---------------------------------------------------------------- observation view
cte("obs_raw", """
SELECT CAST(o.o_custkey AS BIGINT) AS observer_id,
       concat(p.p_brand, '/', p.p_type) AS scientific_name,
       CAST(year(o.o_orderdate) AS INTEGER) AS year,
       l.l_returnflag <> 'R' AS species_observed,
       CAST(o.o_orderkey AS BIGINT) AS checklist_id,
       CAST(o.o_orderdate AS DATE) AS observation_date,
       nullif(l.l_quantity, CAST(1.0 AS DOUBLE)) AS observation_count,
       n.n_name AS state,
       concat(n.n_name, '-', CAST(s.s_suppkey % 4 AS VARCHAR)) AS county,
       CAST(s.s_suppkey AS BIGINT) AS locality_id,
       CAST(dayofyear(o.o_orderdate) AS INTEGER) AS day_of_year,
       l.l_linenumber * CAST(2.5 AS DOUBLE) AS hours_of_day,
       o.o_totalprice / CAST(100000.0 AS DOUBLE) AS effort_hours,
       nullif(l.l_discount, CAST(0.0 AS DOUBLE)) * CAST(100.0 AS DOUBLE) AS effort_distance_km,
       l.l_linenumber * CAST(15.0 AS DOUBLE) AS duration_minutes,
       CAST(p.p_size % 5 + 1 AS INTEGER) AS number_observers,
       s.s_nationkey * CAST(2.0 AS DOUBLE) AS latitude,
       s.s_acctbal / CAST(100.0 AS DOUBLE) AS longitude
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
""")

cte("obs", """
SELECT * EXCLUDE (species_observed) FROM obs_raw WHERE species_observed
""", ["obs_raw"])

cte("oys", """
SELECT observer_id, year, list_sort(list_distinct(list(scientific_name))) AS species
FROM obs WHERE observer_id IS NOT NULL AND year IS NOT NULL
GROUP BY observer_id, year
""", ["obs"])

cte("trans", """
SELECT * FROM (
  SELECT observer_id, year AS year_from,
         lead(year) OVER (PARTITION BY observer_id ORDER BY year) AS year_to,
         species AS species_from,
         lead(species) OVER (PARTITION BY observer_id ORDER BY year) AS species_to
  FROM oys) WHERE year_to IS NOT NULL
""", ["oys"])

cte("trans_cons", """
SELECT * FROM trans WHERE year_to = year_from + 1
""", ["trans"])

# ---------------------------------------------------------------- folds
cte("fold_ranked", """
SELECT year_from, year_to,
       row_number() OVER (ORDER BY year_from, year_to) AS rn,
       count(*) OVER () AS n
FROM (SELECT DISTINCT year_from, year_to FROM trans_cons)
""", ["trans_cons"])

cte("folds", """
SELECT CAST(fold AS INTEGER) AS fold, 'train' AS role, year_from, year_to
FROM (SELECT year_from, year_to, unnest(generate_series(rn, least(4, n - 1))) AS fold
      FROM fold_ranked WHERE rn <= least(4, n - 1))
UNION ALL
SELECT CAST(rn - 1 AS INTEGER) AS fold, 'test' AS role, year_from, year_to
FROM fold_ranked WHERE rn >= 2 AND rn - 1 <= least(4, n - 1)
""", ["fold_ranked"])

cte("fold_trans", """
SELECT t.*, f.fold, f.role FROM trans t JOIN folds f USING (year_from, year_to)
""", ["trans", "folds"])

cte("test", """
SELECT fold, observer_id, species_from, species_to FROM fold_trans WHERE role = 'test'
""", ["fold_trans"])

cte("catalogue", """
SELECT DISTINCT unnest(list_concat(species_from, species_to)) AS species FROM trans
""", ["trans"])

# ---------------------------------------------------------------- popularity baseline
cte("pop_counts", """
SELECT species, count(*) AS n_viewers FROM (
  SELECT unnest(species_to) AS species FROM fold_trans WHERE fold = 1 AND role = 'train')
GROUP BY species
""", ["fold_trans"])

cte("pop", """
SELECT c.species, CAST(coalesce(p.n_viewers, 0) AS BIGINT) AS n_viewers,
       row_number() OVER (ORDER BY coalesce(p.n_viewers, 0) DESC, c.species) AS pop_rank
FROM catalogue c LEFT JOIN pop_counts p USING (species)
""", ["catalogue", "pop_counts"])

cte("pred_pop", f"""
SELECT fold, observer_id, species, score, CAST(rk AS INTEGER) AS rank FROM (
  SELECT t.fold, t.observer_id, p.species, CAST(p.n_viewers AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY t.fold, t.observer_id ORDER BY p.pop_rank) AS rk
  FROM test t JOIN pop p ON NOT list_contains(t.species_from, p.species))
WHERE rk <= {K}
""", ["test", "pop"])


# ---------------------------------------------------------------- metrics
def metric_ctes(pred: str, k: int = K, include_zero: bool = False) -> str:
    """Register per-observer stats and per-fold metrics CTEs for prediction CTE ``pred``."""
    p = pred
    cte(f"{p}_h", f"""
SELECT q.fold, q.observer_id, q.species, q.rank,
       CAST(list_contains(t.species_to, q.species) AS INTEGER) AS hit,
       sum(CAST(list_contains(t.species_to, q.species) AS INTEGER)) OVER (
         PARTITION BY q.fold, q.observer_id ORDER BY q.rank
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_hits
FROM {p} q JOIN test t USING (fold, observer_id)
""", [p, "test"])
    cte(f"{p}_po", f"""
SELECT t.fold, t.observer_id, len(t.species_to) AS n_truth,
  coalesce(sum(CASE WHEN h.rank <= {k} THEN h.hit ELSE 0 END), 0) AS hits_k,
  coalesce(sum(CASE WHEN h.rank <= {k} AND h.hit = 1 THEN h.cum_hits / h.rank ELSE 0 END), 0) AS ap_k_num,
  count(h.species) AS n_pred,
  coalesce(sum(h.hit), 0) AS hits_all,
  coalesce(sum(CASE WHEN h.rank <= len(t.species_to) THEN h.hit ELSE 0 END), 0) AS hits_full,
  coalesce(sum(CASE WHEN h.rank <= len(t.species_to) AND h.hit = 1
                    THEN h.cum_hits / h.rank ELSE 0 END), 0) AS ap_full_num
FROM test t LEFT JOIN {p}_h h USING (fold, observer_id)
WHERE len(t.species_to) > 0
GROUP BY t.fold, t.observer_id, len(t.species_to)
""", [f"{p}_h", "test"])
    zk = "TRUE" if include_zero else "hits_k > 0"
    zf = "TRUE" if include_zero else "hits_full > 0"
    cte(f"{p}_m", f"""
SELECT m.*, coalesce(c.coverage, 0.0) AS coverage FROM (
  SELECT fold,
    avg(hits_k / {float(k)}) AS "precision@k",
    avg(hits_k / n_truth) AS "recall@k",
    coalesce(avg(CASE WHEN {zk} THEN ap_k_num / least(n_truth, {k}) END), 0.0) AS "map@k",
    coalesce(avg(CASE WHEN n_pred > 0 THEN hits_all / n_pred END), 0.0) AS precision_full,
    avg(hits_full / n_truth) AS recall_full,
    coalesce(avg(CASE WHEN {zf} THEN ap_full_num / n_truth END), 0.0) AS map_full
  FROM {p}_po GROUP BY fold) m
LEFT JOIN (
  SELECT fold, count(DISTINCT species) / (SELECT count(*) FROM catalogue) AS coverage
  FROM {p} GROUP BY fold) c USING (fold)
""", [f"{p}_po", p, "catalogue"])
    cte(f"{p}_long", f"""
SELECT fold, CAST({k} AS INTEGER) AS k, metric, CAST(value AS DOUBLE) AS value FROM (
  UNPIVOT {p}_m ON "precision@k", "recall@k", "map@k", coverage, precision_full, recall_full, map_full
  INTO NAME metric VALUE value)
""", [f"{p}_m"])
    return f"{p}_long"


# ---------------------------------------------------------------- training-side tables
cte("train", """
SELECT * FROM fold_trans WHERE role = 'train'
""", ["fold_trans"])

cte("n_species", """
SELECT CAST(count(*) AS DOUBLE) AS s FROM catalogue
""", ["catalogue"])

cte("comb", """
SELECT fold, observer_id, year_from, year_to,
       list_distinct(list_concat(species_from, species_to)) AS sp
FROM train
""", ["train"])

cte("hist_n", """
SELECT fold, species, count(*) AS n_i FROM (SELECT fold, unnest(sp) AS species FROM comb)
GROUP BY fold, species
""", ["comb"])

cte("hist_share", """
SELECT fold, species, n_i, n_i / sum(n_i) OVER (PARTITION BY fold) AS share FROM hist_n
""", ["hist_n"])

cte("comb_long", """
SELECT fold, observer_id, year_from, unnest(sp) AS species FROM comb
""", ["comb"])

cte("cooc", """
SELECT a.fold, a.species AS species_i, b.species AS species_j, count(*) AS n_ij
FROM comb_long a JOIN comb_long b
  ON a.fold = b.fold AND a.observer_id = b.observer_id AND a.year_from = b.year_from
WHERE a.species <> b.species
GROUP BY a.fold, a.species, b.species
""", ["comb_long"])

# species features from the fold's training rows (scope='train')
cte("sviews", """
SELECT fold, species, CAST(count(*) AS BIGINT) AS total_viewers FROM (
  SELECT fold, unnest(species_from) AS species FROM train
  UNION ALL
  SELECT fold, unnest(species_to) AS species FROM train)
GROUP BY fold, species
""", ["train"])

cte("sfeat", """
SELECT fold, species, total_viewers,
       CASE WHEN total_viewers >= median(total_viewers) OVER (PARTITION BY fold)
            THEN 'common' ELSE 'rare' END AS popularity,
       total_viewers / greatest(avg(total_viewers) OVER (PARTITION BY fold), 1.0) AS popularity_score
FROM sviews
""", ["sviews"])

cte("boost", """
SELECT fold, species, 1.0 + 0.2 * popularity_score AS boost FROM sfeat
""", ["sfeat"])


# ---------------------------------------------------------------- co-occurrence model (dense form)
def cooc_pred_cte(alpha: float = 0.1, k: int = K, name: str = "pred_cooc", boost: bool = True) -> None:
    cte("cooc_hist", f"""
SELECT t.fold, t.observer_id, v.species_i,
       coalesce(h.n_i, 0) + {alpha} * (SELECT s FROM n_species) AS d_i,
       1.0 / (1.0 + coalesce(h.share, 0.0) * 10.0) AS w
FROM test t, LATERAL (SELECT unnest(t.species_from) AS species_i) v
LEFT JOIN hist_share h ON h.fold = t.fold AND h.species = v.species_i
""", ["test", "hist_share", "n_species"])
    cte("cooc_dense", f"""
SELECT ch.fold, ch.observer_id, c.species,
       sum(ch.w * CASE WHEN ch.d_i > 0 THEN (coalesce(p.n_ij, 0) + {alpha}) / ch.d_i
                       ELSE 1.0 / (SELECT s FROM n_species) END) / sum(ch.w) AS raw_score,
       sum(coalesce(p.n_ij, 0)) AS n_pairs
FROM cooc_hist ch CROSS JOIN catalogue c
LEFT JOIN cooc p ON p.fold = ch.fold AND p.species_i = ch.species_i AND p.species_j = c.species
GROUP BY ch.fold, ch.observer_id, c.species
""", ["cooc_hist", "catalogue", "cooc", "n_species"])
    b = "coalesce(b.boost, 1.0)" if boost else "1.0"
    cte(name, f"""
SELECT fold, observer_id, species, score, CAST(rk AS INTEGER) AS rank FROM (
  SELECT d.fold, d.observer_id, d.species, d.raw_score * {b} AS score,
         row_number() OVER (PARTITION BY d.fold, d.observer_id
                            ORDER BY round(d.raw_score * {b}, 9) DESC, d.species) AS rk
  FROM cooc_dense d JOIN test t USING (fold, observer_id)
  LEFT JOIN boost b ON b.fold = d.fold AND b.species = d.species
  WHERE NOT list_contains(t.species_from, d.species))
WHERE rk <= {k}
""", ["cooc_dense", "test", "boost"])


cooc_pred_cte()
cooc_pred_cte(name="pred_cooc_noboost", boost=False)


# ---------------------------------------------------------------- nearest-observer models
def neighbor_pred_cte(metric: str, n_nb: int = 50, min_common: int = 1, k: int = K,
                      suffix: str = "") -> str:
    m = metric + suffix
    sim = ("common / sqrt(CAST(nt AS DOUBLE) * nr)" if metric == "cosine"
           else "common / CAST(nt + nr - common AS DOUBLE)")
    cte(f"nb_pairs_{m}", f"""
SELECT fold, observer_id, nb_observer_id, nb_year_from, common, {sim} AS sim FROM (
  SELECT t.fold, t.observer_id, r.observer_id AS nb_observer_id, r.year_from AS nb_year_from,
         count(*) AS common, any_value(t.nt) AS nt, any_value(r.nr) AS nr
  FROM (SELECT fold, observer_id, len(species_from) AS nt, unnest(species_from) AS species
        FROM test) t
  JOIN (SELECT fold, observer_id, year_from, len(sp) AS nr, unnest(sp) AS species FROM comb) r
    ON t.fold = r.fold AND t.species = r.species
  GROUP BY t.fold, t.observer_id, r.observer_id, r.year_from)
WHERE common >= {min_common}
""", ["test", "comb"])
    cte(f"nb_top_{m}", f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY fold, observer_id
                               ORDER BY round(sim, 9) DESC, nb_observer_id, nb_year_from) AS nb_rank
  FROM nb_pairs_{m} WHERE sim > 0)
WHERE nb_rank <= {n_nb}
""", [f"nb_pairs_{m}"])
    cte(f"nb_votes_{m}", f"""
SELECT n.fold, n.observer_id, c.species,
       sum(n.sim) / any_value(tot.sim_total) AS score
FROM nb_top_{m} n
JOIN (SELECT fold, observer_id, year_from, unnest(sp) AS species FROM comb) c
  ON c.fold = n.fold AND c.observer_id = n.nb_observer_id AND c.year_from = n.nb_year_from
JOIN (SELECT fold, observer_id, sum(sim) AS sim_total FROM nb_top_{m} GROUP BY fold, observer_id) tot
  ON tot.fold = n.fold AND tot.observer_id = n.observer_id
GROUP BY n.fold, n.observer_id, c.species
""", [f"nb_top_{m}", "comb"])
    cte(f"pred_nb_{m}", f"""
SELECT fold, observer_id, species, score, CAST(rk AS INTEGER) AS rank FROM (
  SELECT v.fold, v.observer_id, v.species, v.score,
         row_number() OVER (PARTITION BY v.fold, v.observer_id
                            ORDER BY round(v.score, 9) DESC, v.species) AS rk
  FROM (SELECT * FROM nb_votes_{m}
        UNION ALL
        SELECT t.fold, t.observer_id, h.species, h.share AS score
        FROM test t JOIN hist_share h ON h.fold = t.fold
        WHERE NOT EXISTS (SELECT 1 FROM nb_top_{m} n
                          WHERE n.fold = t.fold AND n.observer_id = t.observer_id)) v
  JOIN test t USING (fold, observer_id)
  WHERE NOT list_contains(t.species_from, v.species) AND v.score > 0)
WHERE rk <= {k}
""", [f"nb_votes_{m}", "test", "hist_share", f"nb_top_{m}"])
    return f"pred_nb_{m}"


neighbor_pred_cte("cosine")
neighbor_pred_cte("jaccard")
neighbor_pred_cte("cosine", min_common=2, suffix="_mc2")

# ---------------------------------------------------------------- counts
cte("mean_cnt", """
SELECT avg(coalesce(s.total_observations, 0.0)) AS m
FROM fold_trans f LEFT JOIN summ s ON s.observer_id = f.observer_id AND s.year = f.year_to
WHERE f.fold = 1 AND f.role = 'train'
""", ["fold_trans", "summ"])

cte("cnt_rows", """
SELECT t.fold, t.observer_id, coalesce(s.total_observations, 0.0) AS a,
       greatest((SELECT m FROM mean_cnt), 0.0) AS p
FROM fold_trans t LEFT JOIN summ s ON s.observer_id = t.observer_id AND s.year = t.year_to
WHERE t.role = 'test'
""", ["fold_trans", "summ", "mean_cnt"])

cte("cnt_long", """
SELECT fold, metric, value FROM (UNPIVOT (
  SELECT fold, avg(abs(a - p)) AS count_mae, sqrt(avg((a - p) * (a - p))) AS count_rmse,
         CASE WHEN stddev_pop(a) > 0 AND stddev_pop(p) > 0
              THEN coalesce(CASE WHEN isnan(corr(a, p)) THEN 0.0 ELSE corr(a, p) END, 0.0)
              ELSE 0.0 END AS count_correlation,
         avg(abs((a - p) / (a + 1e-8))) * 100 AS count_mape,
         coalesce(avg(CASE WHEN a <> 0 THEN abs((a - p) / a) END) * 100, 0.0) AS mape_nonzero,
         avg(a) AS mean_actual_count, avg(p) AS mean_predicted_count
  FROM cnt_rows GROUP BY fold)
  ON count_mae, count_rmse, count_correlation, count_mape, mape_nonzero, mean_actual_count, mean_predicted_count
  INTO NAME metric VALUE value)
""", ["cnt_rows"])


# ---------------------------------------------------------------- features
_KEYED = "FROM obs WHERE observer_id IS NOT NULL AND year IS NOT NULL"

cte("summ", f"""
SELECT observer_id, year,
       list_sort(list_distinct(list(scientific_name))) AS scientific_name,
       list_sort(list_distinct(list(state))) AS state,
       list_sort(list_distinct(list(county))) AS county,
       list_sort(list_distinct(list(locality_id))) AS locality_id,
       list_sort(list_distinct(list(effort_hours))) AS effort_hours,
       list_sort(list_distinct(list(effort_distance_km))) AS effort_distance_km,
       list_sort(list_distinct(list(duration_minutes))) AS duration_minutes,
       list_sort(list_distinct(list(number_observers))) AS number_observers,
       coalesce(sum(observation_count), 0.0) AS total_observations
{_KEYED} GROUP BY observer_id, year
""", ["obs"])


def _month_cols() -> str:
    return ",\n".join(
        f"  coalesce(count(*) FILTER (WHERE month(observation_date) = {m}) "
        f"/ nullif(count(month(observation_date)), 0), 0.0) AS month_{m}_freq"
        for m in range(1, 13))


cte("tf", f"""
SELECT observer_id, year,
  count(DISTINCT locality_id) AS num_checklists,
  count(DISTINCT scientific_name) AS num_species,
  coalesce(sum(observation_count), 0.0) AS total_observations,
  CASE WHEN count(DISTINCT locality_id) > 0
       THEN coalesce(sum(observation_count), 0.0) / count(DISTINCT locality_id) ELSE 0.0 END
    AS avg_observations_per_checklist,
  coalesce(max(observation_count), 0.0) AS max_observations_per_checklist,
  avg(day_of_year) AS doy_mean, coalesce(stddev_samp(day_of_year), 0.0) AS doy_std,
  CAST(min(day_of_year) AS DOUBLE) AS doy_min, CAST(max(day_of_year) AS DOUBLE) AS doy_max,
  CAST(coalesce(max(day_of_year) - min(day_of_year), 0) AS DOUBLE) AS doy_range,
  avg(hours_of_day) AS hod_mean, coalesce(stddev_samp(hours_of_day), 0.0) AS hod_std,
  min(hours_of_day) AS hod_min, max(hours_of_day) AS hod_max,
{_month_cols()},
  avg(effort_hours) AS effort_mean, coalesce(sum(effort_hours), 0.0) AS effort_total,
  coalesce(max(effort_hours), 0.0) AS effort_max, coalesce(stddev_samp(effort_hours), 0.0) AS effort_std,
  avg(duration_minutes) AS duration_mean, coalesce(sum(duration_minutes), 0.0) AS duration_total,
  coalesce(max(duration_minutes), 0.0) AS duration_max,
  coalesce(stddev_samp(duration_minutes), 0.0) AS duration_std,
  count(DISTINCT locality_id) / 12.0 AS checklists_per_month,
  count(DISTINCT locality_id) AS num_locations,
  count(DISTINCT state) AS num_states,
  avg(day_of_year) AS avg_day_of_year, avg(hours_of_day) AS avg_hours_of_day,
  avg(effort_hours) AS avg_effort_hours, avg(duration_minutes) AS avg_duration
{_KEYED} GROUP BY observer_id, year
""", ["obs"])


def _mode_cte(col: str, name: str) -> None:
    cte(name, f"""
SELECT observer_id, year,
       max(CASE WHEN rk = 1 THEN {col} END) AS top_{col},
       sum(-(n / tot) * ln(n / tot + 1e-10)) AS {col}_diversity,
       count(*) AS n_values
FROM (SELECT *, sum(n) OVER (PARTITION BY observer_id, year) AS tot,
             row_number() OVER (PARTITION BY observer_id, year ORDER BY n DESC, {col}) AS rk
      FROM (SELECT observer_id, year, {col}, count(*) AS n {_KEYED} AND {col} IS NOT NULL
            GROUP BY observer_id, year, {col}))
GROUP BY observer_id, year
""", ["obs"])


_mode_cte("state", "st_mode")
_mode_cte("county", "co_mode")

cte("gf", f"""
SELECT o.observer_id, o.year, s.top_state, c.top_county,
       coalesce(s.state_diversity, 0.0) AS state_diversity,
       CAST(coalesce(s.n_values, 0) AS BIGINT) AS num_states,
       CAST(coalesce(c.n_values, 0) AS BIGINT) AS num_counties,
       CAST(o.num_localities AS BIGINT) AS num_localities,
       o.geographic_spread
FROM (SELECT observer_id, year, count(DISTINCT locality_id) AS num_localities,
             CASE WHEN count(latitude) > 0 AND count(longitude) > 0
                  THEN coalesce(stddev_samp(latitude), 0.0) + coalesce(stddev_samp(longitude), 0.0)
                  ELSE 0.0 END AS geographic_spread
      {_KEYED} GROUP BY observer_id, year) o
LEFT JOIN st_mode s USING (observer_id, year)
LEFT JOIN co_mode c USING (observer_id, year)
""", ["obs", "st_mode", "co_mode"])

cte("tf_summ", """
SELECT observer_id, year,
  CAST(len(scientific_name) AS BIGINT) AS num_species,
  CAST(len(locality_id) AS BIGINT) AS num_checklists,
  coalesce(total_observations, 0.0) AS total_observations,
  CASE WHEN len(locality_id) > 0 THEN coalesce(total_observations, 0.0) / len(locality_id)
       ELSE 0.0 END AS avg_observations_per_checklist,
  coalesce(list_avg(effort_hours), 0.0) AS effort_mean,
  coalesce(list_sum(effort_hours), 0.0) AS effort_total,
  coalesce(list_max(effort_hours), 0.0) AS effort_max,
  CASE WHEN len(effort_hours) > 1 THEN list_stddev_pop(effort_hours) ELSE 0.0 END AS effort_std,
  coalesce(list_avg(duration_minutes), 0.0) AS duration_mean,
  coalesce(list_sum(duration_minutes), 0.0) AS duration_total,
  coalesce(list_max(duration_minutes), 0.0) AS duration_max,
  CASE WHEN len(duration_minutes) > 1 THEN list_stddev_pop(duration_minutes) ELSE 0.0 END
    AS duration_std,
  len(locality_id) / 12.0 AS checklists_per_month,
  CAST(len(locality_id) AS BIGINT) AS num_locations,
  CAST(len(state) AS BIGINT) AS num_states
FROM summ
""", ["summ"])

cte("gf_summ", """
SELECT observer_id, year, list_min(state) AS top_state, list_min(county) AS top_county,
  CASE WHEN len(state) > 0 THEN -ln(1.0 / len(state) + 1e-10) ELSE 0.0 END AS state_diversity,
  CASE WHEN len(state) > 0 THEN -(1.0 / len(state)) * ln(1.0 / len(state) + 1e-10) ELSE 0.0 END
    AS state_diversity_literal,
  CAST(len(state) AS BIGINT) AS num_states, CAST(len(county) AS BIGINT) AS num_counties,
  CAST(len(locality_id) AS BIGINT) AS num_localities,
  CAST(len(locality_id) AS DOUBLE) AS geographic_spread
FROM summ
""", ["summ"])


# ---------------------------------------------------------------- region
def region_ctes(name: str, states: str, summ: str, trans: str) -> None:
    cte(states, f"""
SELECT n.n_name AS state FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = '{name}'
""")
    cte(summ, f"""
SELECT * FROM summ s
WHERE coalesce(len(list_intersect(list_transform(s.state, lambda x: trim(x)),
                                  (SELECT list(state) FROM {states}))) > 0, false)
""", ["summ", states])
    cte(trans, f"""
SELECT * FROM (
  SELECT observer_id, year AS year_from,
         lead(year) OVER (PARTITION BY observer_id ORDER BY year) AS year_to,
         scientific_name AS species_from,
         lead(scientific_name) OVER (PARTITION BY observer_id ORDER BY year) AS species_to
  FROM {summ}) WHERE year_to IS NOT NULL
""", [summ])


region_ctes("EUROPE", "europe", "summ_region", "trans_region")


def cv_cte() -> None:
    parts = []
    for model, pred in [("baseline", "pred_pop"), ("collaborative", "pred_cooc"),
                        ("user_collaborative", "pred_nb_cosine")]:
        parts.append(f"SELECT '{model}' AS model, fold, k, metric, value FROM {metric_ctes(pred)}")
    parts.append(f"SELECT 'baseline' AS model, fold, CAST({K} AS INTEGER) AS k, metric, value FROM cnt_long")
    cte("cv", "\nUNION ALL\n".join(parts),
        ["pred_pop_long", "pred_cooc_long", "pred_nb_cosine_long", "cnt_long"])
    cte("cv_summary", """
SELECT model, k, metric, avg(value) AS mean_value, count(*) AS n_folds FROM cv GROUP BY model, k, metric
""", ["cv"])


cv_cte()


# ---------------------------------------------------------------- species (all transitions)
cte("sv_all", """
SELECT species, year, count(*) AS n FROM (
  SELECT year_from AS year, unnest(species_from) AS species FROM trans
  UNION ALL
  SELECT year_to AS year, unnest(species_to) AS species FROM trans)
GROUP BY species, year
""", ["trans"])

cte("sfeat_all", """
SELECT species, viewers_by_year, total_viewers,
       CASE WHEN total_viewers >= median(total_viewers) OVER () THEN 'common' ELSE 'rare' END AS popularity,
       total_viewers / greatest(avg(total_viewers) OVER (), 1.0) AS popularity_score
FROM (SELECT species, string_agg(CAST(year AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY year)
             AS viewers_by_year, CAST(sum(n) AS BIGINT) AS total_viewers
      FROM sv_all GROUP BY species)
""", ["sv_all"])


def folds_mode_cte(mode: str) -> str:
    name = f"folds_{mode}"
    if mode == "lexicographic":
        cte(f"{name}_ranked", """
SELECT year_from, year_to, row_number() OVER (ORDER BY year_from, year_to) AS rn, count(*) OVER () AS n
FROM (SELECT DISTINCT year_from, year_to FROM trans)
""", ["trans"])
        cte(name, f"""
SELECT CAST(fold AS INTEGER) AS fold, 'train' AS role, year_from, year_to
FROM (SELECT year_from, year_to, unnest(generate_series(rn, least(4, n - 1))) AS fold
      FROM {name}_ranked WHERE rn <= least(4, n - 1))
UNION ALL
SELECT CAST(rn - 1 AS INTEGER) AS fold, 'test' AS role, year_from, year_to
FROM {name}_ranked WHERE rn >= 2 AND rn - 1 <= least(4, n - 1)
""", [f"{name}_ranked"])
    else:
        cte(name, """
SELECT f.fold, 'train' AS role, p.year_from, p.year_to
FROM (SELECT DISTINCT year_from, year_to FROM trans) p
JOIN (SELECT fold, year_to AS test_to FROM folds WHERE role = 'test') f ON p.year_to < f.test_to
UNION ALL
SELECT fold, role, year_from, year_to FROM folds WHERE role = 'test'
""", ["trans", "folds"])
    return name


folds_mode_cte("lexicographic")
folds_mode_cte("ending_before")
