"""DuckDB oracle text for every registered query that has one."""

from oracle.views import with_views


def ratio(num: str, den: str, digits: int = 6) -> str:
    return f"coalesce(round(CAST({num} AS DOUBLE) / nullif({den}, 0), {digits}), 0.0)"


def counts(t: str = "y_true", p: str = "y_pred", where: str = "TRUE", prefix: str = "") -> str:
    return ",\n".join(
        [
            f"count(*) FILTER (WHERE {where}) AS {prefix}n",
            f"count(*) FILTER (WHERE ({where}) AND {t} = 0 AND {p} = 0) AS {prefix}tn",
            f"count(*) FILTER (WHERE ({where}) AND {t} = 0 AND {p} = 1) AS {prefix}fp",
            f"count(*) FILTER (WHERE ({where}) AND {t} = 1 AND {p} = 0) AS {prefix}fn",
            f"count(*) FILTER (WHERE ({where}) AND {t} = 1 AND {p} = 1) AS {prefix}tp",
        ]
    )


def ratios(prefix: str = "", digits: int = 6) -> str:
    p = prefix
    return ",\n".join(
        [
            f"{ratio(f'{p}tp + {p}tn', f'{p}n', digits)} AS {p}accuracy",
            f"{ratio(f'{p}tp', f'{p}tp + {p}fp', digits)} AS {p}precision",
            f"{ratio(f'{p}tp', f'{p}tp + {p}fn', digits)} AS {p}recall",
            f"{ratio(f'2 * {p}tp', f'2 * {p}tp + {p}fp + {p}fn', digits)} AS {p}f1",
        ]
    )


COHORT_LONG = """
cohort_long AS (
  SELECT y_true, y_pred, 'segment' AS cohort_feature, 1 AS o, segment AS cohort_value FROM labelled_orders
  UNION ALL SELECT y_true, y_pred, 'priority', 2, priority FROM labelled_orders
  UNION ALL SELECT y_true, y_pred, 'nation', 3, nation FROM labelled_orders
  UNION ALL SELECT y_true, y_pred, 'line_flag', 4, line_flag FROM labelled_orders
),
cohort_counts AS (
  SELECT cohort_feature, cohort_value, {counts}, count(*) FILTER (WHERE y_true = 1) AS pos
  FROM cohort_long WHERE cohort_value IS NOT NULL GROUP BY cohort_feature, cohort_value
),
cohort_table AS (
  SELECT cohort_feature, cohort_value, n, {rate} AS positive_rate, {ratios}, tn, fp, fn, tp
  FROM cohort_counts
)
""".format(counts=counts(), rate=ratio("pos", "n"), ratios=ratios())

LABELLED_COLUMNS = (
    "row_id, y_true, y_pred, y_learn, segment, priority, nation, total_price, acctbal, "
    "part_a, part_b, part_total, month, week, zero, line_flag"
)

SQL: dict[str, str] = {}

SQL["load_labelled"] = with_views(f"SELECT {LABELLED_COLUMNS} FROM labelled_orders")

SQL["validate_target"] = with_views(
    """SELECT count(*) AS n,
              count(*) FILTER (WHERE y_true IS NULL) AS n_null,
              count(*) FILTER (WHERE y_true IS NOT NULL AND y_true NOT IN (0, 1)) AS n_invalid,
              count(*) FILTER (WHERE y_true = 1) AS n_positive,
              (count(*) FILTER (WHERE y_true IS NULL) = 0
               AND count(*) FILTER (WHERE y_true IS NOT NULL AND y_true NOT IN (0, 1)) = 0) AS valid
       FROM labelled_orders"""
)

SQL["error_flags"] = with_views(
    "SELECT row_id, y_true, y_pred, y_true <> y_pred AS is_error FROM labelled_orders"
)

SQL["false_positives"] = with_views(
    """SELECT row_id, y_true, y_pred, segment, priority, total_price FROM labelled_orders
       WHERE y_pred = 1 AND y_true = 0"""
)

SQL["false_negatives"] = with_views(
    """SELECT row_id, y_true, y_pred, segment, priority, total_price FROM labelled_orders
       WHERE y_pred = 0 AND y_true = 1"""
)

SQL["cohort_filter"] = with_views(
    """SELECT row_id, line_flag,
              CASE WHEN line_flag IS NOT DISTINCT FROM 'R' THEN 'cohort' ELSE 'rest' END AS side
       FROM labelled_orders"""
)

SQL["global_metrics"] = with_views(
    f"""SELECT n, {ratios()}, tn, fp, fn, tp FROM (SELECT {counts()} FROM labelled_orders)"""
)

SQL["cohort_metrics"] = with_views("SELECT * FROM cohort_table", COHORT_LONG)

SQL["worst_cohorts"] = with_views(
    """SELECT * FROM cohort_table WHERE n >= 30
       ORDER BY f1 ASC, n DESC, cohort_feature, cohort_value LIMIT 15""",
    COHORT_LONG,
)

SQL["global_vs_cohort"] = with_views(
    f"""SELECT global_n, {ratios('global_')}, global_tn, global_fp, global_fn, global_tp,
               'segment' AS cohort_column, 'HOUSEHOLD' AS cohort_value,
               cohort_n, {ratios('cohort_')}, cohort_tn, cohort_fp, cohort_fn, cohort_tp
        FROM (SELECT {counts(prefix='global_')},
                     {counts(where="segment = 'HOUSEHOLD'", prefix='cohort_')}
              FROM labelled_orders)"""
)

SQL["strategy_row_prefixed"] = with_views(
    f"""SELECT 'rule' AS strategy,
               {ratios('global_', 4)}, global_fp, global_fn, global_tp, global_n,
               {ratios('cohort_', 4)}, cohort_fp, cohort_fn, cohort_tp, cohort_n
        FROM (SELECT {counts(prefix='global_')},
                     {counts(where="segment = 'HOUSEHOLD'", prefix='cohort_')}
              FROM labelled_orders)"""
)

SQL["class_balance"] = with_views(
    """SELECT segment, count(*) AS n_classes, min(c) AS minority_n, max(c) AS majority_n,
              CAST(sum(c) AS BIGINT) AS n
       FROM (SELECT segment, y_learn, count(*) AS c FROM labelled_orders GROUP BY segment, y_learn)
       GROUP BY segment"""
)

# ---------------------------------------------------------------- profile
SQL["drop_redundant"] = with_views(
    "SELECT row_id, y_true, y_pred, y_learn, segment, priority, nation, total_price, acctbal, "
    "part_a, part_b, month, line_flag FROM labelled_orders"
)

_FEATURES = ["segment", "priority", "nation", "total_price", "acctbal", "part_a", "part_b", "part_total", "month", "week", "zero", "line_flag"]
SQL["feature_groups"] = with_views(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, '{'categorical' if c in ('segment', 'priority', 'nation', 'line_flag') else 'numeric'}' AS feature_group, "
        f"count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct FROM labelled_orders"
        for c in _FEATURES
    )
)

def _corr(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END"
    xb = f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    return f"covar_pop({xa}, {xb}) / nullif(stddev_pop({xa}) * stddev_pop({xb}), 0)"


SQL["redundancy_checks"] = with_views(
    """SELECT 'part_total = part_a + part_b' AS "check", s0 AS passed, CAST(NULL AS DOUBLE) AS value FROM agg
       UNION ALL SELECT 'zero all zero', s1, CAST(NULL AS DOUBLE) FROM agg
       UNION ALL SELECT 'corr(week, month)', CAST(NULL AS BOOLEAN), round(s2, 6) FROM agg""",
    f"""agg AS (
      SELECT coalesce(bool_and(coalesce(abs(part_total - (part_a + part_b))
                       <= 1e-08 + 1e-05 * abs(part_a + part_b), false)), true) AS s0,
             coalesce(bool_and(coalesce(zero = 0, false)), true) AS s1,
             {_corr('week', 'month')} AS s2
      FROM labelled_orders)""",
)

_NUM = ["total_price", "acctbal", "part_a", "part_b", "part_total", "month", "week", "zero"]
_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]]
SQL["high_correlations"] = with_views(
    "SELECT feature_a, feature_b, correlation FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(abs(r{i}), 6) AS correlation FROM corr_row"
        for i, (a, b) in enumerate(_PAIRS)
    )
    + ") WHERE correlation IS NOT NULL AND NOT isnan(correlation) AND correlation > 0.85",
    "corr_row AS (SELECT "
    + ", ".join(f"{_corr(a, b)} AS r{i}" for i, (a, b) in enumerate(_PAIRS))
    + " FROM labelled_orders)",
)

# ---------------------------------------------------------------- split
SPLIT_CTES = """
ranked AS (
  SELECT row_id, y_true, row_number() OVER (PARTITION BY y_true ORDER BY md5('42:' || row_id), row_id) AS rk
  FROM labelled_orders
),
cc AS (SELECT y_true, count(*) AS n_class FROM labelled_orders GROUP BY y_true),
q1 AS (SELECT *, sum(n_class) OVER () AS n_all FROM cc),
q2 AS (SELECT *, CAST(ceil(n_all * 0.2) AS BIGINT) AS n_test FROM q1),
q3 AS (SELECT *, (n_test * n_class) // n_all AS fl, (n_test * n_class) % n_all AS rem FROM q2),
q4 AS (SELECT *, n_test - sum(fl) OVER () AS left_n,
              row_number() OVER (ORDER BY rem DESC, y_true) AS r FROM q3),
quota AS (SELECT y_true, fl + CASE WHEN r <= left_n THEN 1 ELSE 0 END AS test_quota FROM q4)
"""

SQL["stratified_rank"] = with_views("SELECT row_id, y_true, rk AS rank FROM ranked", SPLIT_CTES)
SQL["stratified_split"] = with_views(
    """SELECT row_id, y_true, CASE WHEN rk <= test_quota THEN 'test' ELSE 'train' END AS split
       FROM ranked JOIN quota USING (y_true)""",
    SPLIT_CTES,
)

# split on y_learn (model target): train/test tables used by the preparation oracles
LEARN_SPLIT_CTES = """
lranked AS (
  SELECT *, row_number() OVER (PARTITION BY y_learn ORDER BY md5('42:' || row_id), row_id) AS rk
  FROM labelled_orders
),
lcc AS (SELECT y_learn, count(*) AS n_class FROM labelled_orders GROUP BY y_learn),
lq1 AS (SELECT *, sum(n_class) OVER () AS n_all FROM lcc),
lq2 AS (SELECT *, CAST(ceil(n_all * 0.2) AS BIGINT) AS n_test FROM lq1),
lq3 AS (SELECT *, (n_test * n_class) // n_all AS fl, (n_test * n_class) % n_all AS rem FROM lq2),
lq4 AS (SELECT *, n_test - sum(fl) OVER () AS left_n,
               row_number() OVER (ORDER BY rem DESC, y_learn) AS r FROM lq3),
lquota AS (SELECT y_learn, fl + CASE WHEN r <= left_n THEN 1 ELSE 0 END AS test_quota FROM lq4),
lsplit AS (SELECT lranked.* EXCLUDE (rk), CASE WHEN rk <= test_quota THEN 'test' ELSE 'train' END AS split
           FROM lranked JOIN lquota USING (y_learn)),
train_rows AS (SELECT * EXCLUDE (split) FROM lsplit WHERE split = 'train'),
test_rows AS (SELECT * EXCLUDE (split) FROM lsplit WHERE split = 'test')
"""

FOLD_CTES = """
frk AS (
  SELECT *, row_number() OVER (PARTITION BY y_learn ORDER BY md5('42:fold:' || row_id), row_id) AS rk
  FROM labelled_orders
),
fcc AS (SELECT y_learn, count(*) AS n_class FROM labelled_orders GROUP BY y_learn),
foff AS (SELECT y_learn, coalesce(sum(n_class) OVER (ORDER BY y_learn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS coff FROM fcc),
folds AS (SELECT frk.* EXCLUDE (rk), CAST((coff + rk - 1) % 5 + 1 AS INTEGER) AS fold FROM frk JOIN foff USING (y_learn)),
fold_long AS (
  SELECT f.*, e.eval_fold, CASE WHEN f.fold = e.eval_fold THEN 'val' ELSE 'train' END AS split
  FROM folds f, (SELECT CAST(range AS INTEGER) AS eval_fold FROM range(1, 6)) e
)
"""

SQL["stratified_folds"] = with_views("SELECT row_id, y_learn, fold FROM folds", FOLD_CTES)
SQL["fold_membership"] = with_views(
    """SELECT eval_fold, split, count(*) AS n_rows, count(*) FILTER (WHERE y_learn = 1) AS n_pos
       FROM fold_long GROUP BY eval_fold, split""",
    FOLD_CTES,
)
SUBSET_CTES = """
sub_rank AS (
  SELECT *, row_number() OVER (PARTITION BY eval_fold ORDER BY md5('42:subset:' || row_id), row_id) AS lrk
  FROM fold_long WHERE split = 'train'
),
sub_n AS (SELECT eval_fold, count(*) AS n FROM fold_long WHERE split = 'train' GROUP BY eval_fold),
sub_size AS (
  SELECT eval_fold, fr.f AS fraction, least(n, greatest(CAST(floor(n * fr.f) AS BIGINT), 50)) AS subset_n
  FROM sub_n, (SELECT CAST(range AS DECIMAL(4,2)) / 10 AS f FROM range(1, 11)) fr
),
subsets AS (SELECT s.*, z.fraction, z.subset_n FROM sub_rank s JOIN sub_size z USING (eval_fold) WHERE s.lrk <= z.subset_n)
"""
SQL["learning_subsets"] = with_views(
    """SELECT eval_fold, CAST(fraction AS DOUBLE) AS fraction, subset_n, count(*) AS n_rows,
              count(*) FILTER (WHERE y_learn = 1) AS n_pos
       FROM subsets GROUP BY eval_fold, fraction, subset_n""",
    FOLD_CTES + "," + SUBSET_CTES,
)

# ---------------------------------------------------------------- prepare
SQL["fit_stats"] = with_views(
    """SELECT feature, kind, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std,
              round(scale, 6) AS scale, mode, n_categories FROM (
         SELECT 'total_price' AS feature, 'numeric' AS kind, median(total_price) AS median,
                avg(total_price) AS mean, stddev_pop(total_price) AS std,
                CASE WHEN stddev_pop(total_price) < 2.220446049250313e-15 THEN 1.0 ELSE stddev_pop(total_price) END AS scale,
                NULL AS mode, CAST(NULL AS INTEGER) AS n_categories FROM labelled_orders
         UNION ALL SELECT 'acctbal', 'numeric', median(acctbal), avg(acctbal), stddev_pop(acctbal),
                CASE WHEN stddev_pop(acctbal) < 2.220446049250313e-15 THEN 1.0 ELSE stddev_pop(acctbal) END, NULL, NULL FROM labelled_orders
         UNION ALL SELECT 'part_a', 'numeric', any_value(m), avg(coalesce(part_a, m)), stddev_pop(coalesce(part_a, m)),
                stddev_pop(coalesce(part_a, m)), NULL, NULL
                FROM labelled_orders, (SELECT median(part_a) AS m FROM labelled_orders)
         UNION ALL SELECT 'part_b', 'numeric', any_value(m), avg(coalesce(part_b, m)), stddev_pop(coalesce(part_b, m)),
                stddev_pop(coalesce(part_b, m)), NULL, NULL
                FROM labelled_orders, (SELECT median(part_b) AS m FROM labelled_orders)
         UNION ALL SELECT 'month', 'numeric', median(month), avg(month), stddev_pop(month), stddev_pop(month), NULL, NULL FROM labelled_orders
         UNION ALL SELECT 'segment', 'categorical', NULL, NULL, NULL, NULL,
                (SELECT segment FROM labelled_orders WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1),
                (SELECT CAST(count(DISTINCT segment) AS INTEGER) FROM labelled_orders)
         UNION ALL SELECT 'line_flag', 'categorical', NULL, NULL, NULL, NULL,
                (SELECT line_flag FROM labelled_orders WHERE line_flag IS NOT NULL GROUP BY line_flag ORDER BY count(*) DESC, line_flag LIMIT 1),
                (SELECT CAST(count(DISTINCT line_flag) AS INTEGER) FROM labelled_orders))"""
)

SQL["impute_median"] = with_views(
    """SELECT row_id, coalesce(part_a, ma) AS part_a, coalesce(part_b, mb) AS part_b,
              coalesce(part_total, mt) AS part_total
       FROM labelled_orders, (SELECT median(part_a) AS ma, median(part_b) AS mb, median(part_total) AS mt
                              FROM labelled_orders)"""
)

SQL["impute_mode"] = with_views(
    """SELECT row_id, coalesce(line_flag, (SELECT line_flag FROM labelled_orders WHERE line_flag IS NOT NULL
                                          GROUP BY line_flag ORDER BY count(*) DESC, line_flag LIMIT 1)) AS line_flag
       FROM labelled_orders"""
)


def _scaled(col: str, src: str = "labelled_orders", fit: str = "labelled_orders") -> str:
    return (
        f"round((coalesce(CAST({col} AS DOUBLE), (SELECT median({col}) FROM {fit})) - "
        f"(SELECT avg(coalesce(CAST({col} AS DOUBLE), (SELECT median({col}) FROM {fit}))) FROM {fit})) / "
        f"(SELECT CASE WHEN stddev_pop(v) IS NULL OR stddev_pop(v) < 2.220446049250313e-15 THEN 1.0 ELSE stddev_pop(v) END "
        f"FROM (SELECT coalesce(CAST({col} AS DOUBLE), (SELECT median({col}) FROM {fit})) AS v FROM {fit})), 6) AS {col}"
    )


SQL["standard_scale"] = with_views(
    "SELECT row_id, " + ", ".join(_scaled(c) for c in ["total_price", "acctbal", "month", "zero"]) + " FROM labelled_orders"
)

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_FLAGS = ["A", "N", "R"]


def _onehot(col: str, values: list[str], mode_src: str) -> str:
    mode = (
        f"(SELECT {col} FROM {mode_src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"
    )
    return ", ".join(
        f"CASE WHEN coalesce({col}, {mode}) = '{v}' THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS \"{col}_{v}\"" for v in values
    )


SQL["one_hot"] = with_views(f"SELECT row_id, {_onehot('segment', _SEGMENTS, 'labelled_orders')} FROM labelled_orders")

SQL["transform_test"] = with_views(
    "SELECT row_id, y_learn, "
    + ", ".join(_scaled(c, fit="train_rows") for c in ["total_price", "acctbal", "part_a", "part_b", "month"])
    + ", "
    + _onehot("segment", _SEGMENTS, "train_rows")
    + ", "
    + _onehot("line_flag", _FLAGS, "train_rows")
    + " FROM test_rows",
    LEARN_SPLIT_CTES,
)

SQL["transform_extra"] = SQL["transform_test"].replace("FROM test_rows", "FROM extra_rows")
SQL["features_target"] = with_views(
    "SELECT row_id, segment, priority, nation, total_price, acctbal, part_a, part_b, month, line_flag, y_learn FROM labelled_orders"
)
_VECTOR = [f"{c}" for c in ["total_price", "acctbal", "part_a", "part_b", "month"]] + [f"segment_{v}" for v in _SEGMENTS] + [f"line_flag_{v}" for v in _FLAGS]
SQL["feature_entries"] = (
    "WITH t AS (" + SQL["transform_test"] + ") SELECT row_id, CAST(unnest(range(" + str(len(_VECTOR)) + ")) AS INTEGER) AS position, "
    "unnest([" + ", ".join(f'"{c}"' for c in _VECTOR) + "]) AS value FROM t"
)


def _ranks(col: str, where: str) -> str:
    return f"(SELECT v, row_number() OVER (ORDER BY v) - 1 AS r FROM (SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM events WHERE {where} AND {col} IS NOT NULL))"


def _mode(col: str, where: str) -> str:
    return f"(SELECT CAST({col} AS VARCHAR) FROM events WHERE {where} AND {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, CAST({col} AS VARCHAR) LIMIT 1)"


_BOUGHT = "event_type = 'purchase'"
SQL["dictionary_encode"] = f"""SELECT event_id AS row_id, CAST(u.r AS INTEGER) AS user_index, CAST(p.r AS INTEGER) AS props_index
FROM events e LEFT JOIN {_ranks("user_id", _BOUGHT)} u ON u.v = coalesce(CAST(e.user_id AS VARCHAR), {_mode("user_id", _BOUGHT)})
LEFT JOIN {_ranks("props", _BOUGHT)} p ON p.v = coalesce(e.props, {_mode("props", _BOUGHT)})"""
SQL["dictionary_table"] = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS n, CAST(row_number() OVER (ORDER BY CAST({c} AS VARCHAR)) - 1 AS INTEGER) AS rank "
    f"FROM events WHERE {c} IS NOT NULL GROUP BY CAST({c} AS VARCHAR)"
    for name, c in [("user", "user_id"), ("props", "props"), ("event_type", "event_type")]
)

SQL["row_parity"] = with_views(
    """SELECT count(l.row_id) AS n_left, count(r.row_id) AS n_right,
              count(*) FILTER (WHERE r.row_id IS NULL) AS only_left,
              count(*) FILTER (WHERE l.row_id IS NULL) AS only_right,
              count(*) FILTER (WHERE l.row_id IS NOT NULL AND r.row_id IS NOT NULL) AS n_both,
              (count(*) FILTER (WHERE r.row_id IS NULL) = 0 AND count(*) FILTER (WHERE l.row_id IS NULL) = 0) AS parity
       FROM labelled_orders l FULL OUTER JOIN train_rows r ON l.row_id = r.row_id""",
    LEARN_SPLIT_CTES,
)

# ---------------------------------------------------------------- resample


def smote_ctes(src: str, target: str, x1: str, x2: str, p: str) -> str:
    """Brute-force SMOTE in SQL over table ``src`` (prefix ``p`` for CTE names)."""
    return f"""
{p}cls AS (SELECT {target} AS y, count(*) AS c FROM {src} GROUP BY {target}),
{p}mm AS (SELECT (SELECT y FROM {p}cls ORDER BY c, y LIMIT 1) AS ym, min(c) AS m, max(c) AS big,
                 count(*) AS n_cls FROM {p}cls),
{p}mino AS (SELECT s.row_id, s.{x1} AS x1, s.{x2} AS x2 FROM {src} s, {p}mm WHERE s.{target} = {p}mm.ym
            AND {p}mm.n_cls = 2 AND {p}mm.m >= 2 AND {p}mm.m < {p}mm.big),
{p}pairs AS (SELECT a.row_id, b.row_id AS neighbour_id,
                    sqrt((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2)) AS distance
             FROM {p}mino a JOIN {p}mino b ON a.row_id <> b.row_id),
{p}nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbour_id) AS nn_rank
                         FROM {p}pairs) WHERE nn_rank <= (SELECT least(5, m - 1) FROM {p}mm)),
{p}pos AS (SELECT row_id, row_number() OVER (ORDER BY md5('42:smote:' || row_id), row_id) AS pz FROM {p}mino),
{p}reps AS (SELECT row_id, (big - m) // m + CASE WHEN pz <= (big - m) % m THEN 1 ELSE 0 END AS r FROM {p}pos, {p}mm),
{p}syn0 AS (SELECT row_id, CAST(unnest(range(1, r + 1)) AS INTEGER) AS syn_j FROM {p}reps WHERE r > 0),
{p}syn AS (
  SELECT s.row_id, s.syn_j, nn.neighbour_id,
         b.x1 + g.gap * (q.x1 - b.x1) AS x1, b.x2 + g.gap * (q.x2 - b.x2) AS x2
  FROM {p}syn0 s
  CROSS JOIN LATERAL (SELECT CAST(('0x' || substr(md5('42:nn:' || s.row_id || ':' || s.syn_j), 1, 8))::BIGINT
                               % (SELECT least(5, m - 1) FROM {p}mm) + 1 AS INTEGER) AS pick,
                          CAST(('0x' || substr(md5('42:gap:' || s.row_id || ':' || s.syn_j), 1, 8))::BIGINT AS DOUBLE)
                               / CAST(4294967296 AS DOUBLE) AS gap) g
  JOIN {p}nn nn ON nn.row_id = s.row_id AND nn.nn_rank = g.pick
  JOIN {p}mino b ON b.row_id = s.row_id
  JOIN {p}mino q ON q.row_id = nn.neighbour_id
)
"""


SQL["knn_minority"] = with_views(
    "SELECT row_id, CAST(nn_rank AS INTEGER) AS nn_rank, neighbour_id, round(distance, 6) AS distance FROM e_nn",
    smote_ctes("events_labelled", "y", "x1", "x2", "e_"),
)

SQL["smote_full"] = with_views(
    """SELECT row_id, 0 AS syn_j, false AS is_synthetic, y, round(x1, 6) AS x1, round(x2, 6) AS x2,
              CAST(NULL AS BIGINT) AS neighbour_id FROM events_labelled
       UNION ALL
       SELECT s.row_id, s.syn_j, true, (SELECT ym FROM e_mm), round(s.x1, 6), round(s.x2, 6), s.neighbour_id
       FROM e_syn s""",
    smote_ctes("events_labelled", "y", "x1", "x2", "e_"),
)

COHORT_SMOTE = """
coh AS (SELECT * FROM labelled_orders WHERE segment = 'HOUSEHOLD')
""" + "," + smote_ctes("coh", "y_learn", "total_price", "acctbal", "c_")

SQL["smote_cohort"] = with_views(
    """SELECT row_id, 0 AS syn_j, false AS is_synthetic, y_learn, segment, round(total_price, 6) AS total_price,
              round(acctbal, 6) AS acctbal, CAST(NULL AS BIGINT) AS neighbour_id FROM labelled_orders
       UNION ALL
       SELECT s.row_id, s.syn_j, true, (SELECT ym FROM c_mm), 'HOUSEHOLD', round(s.x1, 6), round(s.x2, 6), s.neighbour_id
       FROM c_syn s""",
    COHORT_SMOTE,
)

SQL["smote_cohort_counts"] = with_views(
    """SELECT (SELECT count(*) FROM coh) AS cohort_original_n,
              (SELECT m FROM c_mm) AS cohort_original_minority_n,
              (SELECT big FROM c_mm) AS cohort_original_majority_n,
              (SELECT count(*) FROM coh) + (SELECT count(*) FROM c_syn) AS cohort_resampled_n,
              (SELECT count(*) FROM c_syn) AS cohort_synthetic_n,
              (SELECT count(*) FROM labelled_orders) + (SELECT count(*) FROM c_syn) AS total_n_after""",
    COHORT_SMOTE,
)

# ---------------------------------------------------------------- protocols (group-rate estimator)
STRATS = "(VALUES ('baseline'), ('real_data'), ('smote'), ('smote_cohort')) s(strategy)"


def fold_ctes(src: str, p: str, key: str = "row_id", k: int = 5) -> str:
    return f"""
{p}frk AS (SELECT *, row_number() OVER (PARTITION BY y_learn ORDER BY md5('42:fold:' || {key}), {key}) AS rk FROM {src}),
{p}fcc AS (SELECT y_learn, count(*) AS n_class FROM {src} GROUP BY y_learn),
{p}foff AS (SELECT y_learn, coalesce(sum(n_class) OVER (ORDER BY y_learn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS coff
            FROM {p}fcc),
{p}folds AS (SELECT f.* EXCLUDE (rk), CAST((coff + rk - 1) % {k} + 1 AS INTEGER) AS fold FROM {p}frk f JOIN {p}foff USING (y_learn)),
{p}fold_long AS (SELECT f.*, e.eval_fold, CASE WHEN f.fold = e.eval_fold THEN 'val' ELSE 'train' END AS split
                 FROM {p}folds f, (SELECT CAST(range AS INTEGER) AS eval_fold FROM range(1, {k + 1})) e)
""".strip()


def _smote_rows(src: str, p: str) -> str:
    """Synthetic rows (no vectors) per eval_fold of table ``src``."""
    return f"""
{p}cls AS (SELECT eval_fold, y_learn, count(*) AS c FROM {src} GROUP BY eval_fold, y_learn),
{p}mm AS (SELECT eval_fold, min(c) AS m, max(c) AS big, count(*) AS n_cls, arg_min(y_learn, c) AS ym
          FROM {p}cls GROUP BY eval_fold),
{p}pos AS (SELECT t.eval_fold, t.row_id, t.segment, t.priority, mm.ym, mm.m, mm.big,
                  row_number() OVER (PARTITION BY t.eval_fold ORDER BY md5('42:smote:' || t.row_id), t.row_id) AS pz
           FROM {src} t JOIN {p}mm mm USING (eval_fold)
           WHERE t.y_learn = mm.ym AND mm.n_cls = 2 AND mm.m >= 2 AND mm.m < mm.big),
{p}syn AS (SELECT eval_fold, row_id, segment, priority, ym AS y_learn, CAST(unnest(range(1, r + 1)) AS INTEGER) AS syn_j
           FROM (SELECT *, (big - m) // m + CASE WHEN pz <= (big - m) % m THEN 1 ELSE 0 END AS r FROM {p}pos)
           WHERE r > 0)
""".strip()


def _rule(fit: str, p: str, by: str) -> str:
    return f"""
{p}gstats AS (SELECT {by}, segment, priority, count(*) AS n_g, count(*) FILTER (WHERE y_learn = 1) AS pos_g
              FROM {fit} GROUP BY {by}, segment, priority),
{p}ostats AS (SELECT {by}, sum(n_g) AS n, sum(pos_g) AS pos FROM {p}gstats GROUP BY {by}),
{p}rule AS (SELECT g.* EXCLUDE (n_g, pos_g), CASE WHEN g.pos_g * o.n >= o.pos * g.n_g THEN 1 ELSE 0 END AS pred
            FROM {p}gstats g JOIN {p}ostats o USING ({by}))
""".strip()


def rate_fit(tr: str, trc: str, p: str) -> str:
    return (
        _smote_rows(tr, p + "sf_")
        + ",\n"
        + _smote_rows(trc, p + "sc_")
        + f""",
{p}fit AS (
  SELECT 'baseline' AS strategy, eval_fold, row_id, 0 AS syn_j, y_learn, segment, priority, 'train' AS origin FROM {tr}
  UNION ALL SELECT 'real_data', eval_fold, row_id, 0, y_learn, segment, priority, 'train' FROM {tr}
  UNION ALL SELECT 'real_data', e.eval_fold, x.row_id, 0, x.y_learn, x.segment, x.priority, 'extra'
            FROM extra_rows x, (SELECT DISTINCT eval_fold FROM {tr}) e
  UNION ALL SELECT 'smote', eval_fold, row_id, 0, y_learn, segment, priority, 'train' FROM {tr}
  UNION ALL SELECT 'smote', eval_fold, row_id, syn_j, y_learn, segment, priority, 'synthetic' FROM {p}sf_syn
  UNION ALL SELECT 'smote_cohort', eval_fold, row_id, 0, y_learn, segment, priority, 'train' FROM {tr}
  UNION ALL SELECT 'smote_cohort', eval_fold, row_id, syn_j, y_learn, segment, priority, 'synthetic' FROM {p}sc_syn
),
"""
        + _rule(f"{p}fit", p, "strategy, eval_fold")
    )


RATE_CTES = (
    LEARN_SPLIT_CTES.strip()
    + ",\n"
    + fold_ctes("train_rows", "cv_")
    + """,
tr AS (SELECT eval_fold, row_id, y_learn, segment, priority FROM cv_fold_long WHERE split = 'train'),
trc AS (SELECT * FROM tr WHERE segment = 'HOUSEHOLD'),
"""
    + rate_fit("tr", "trc", "cv_")
    + f""",
preds AS (
  SELECT f.strategy, CAST(f.eval_fold AS INTEGER) AS fold, 'train' AS split, f.row_id, CAST(f.syn_j AS INTEGER) AS syn_j,
         f.y_learn AS y_true, r.pred AS y_pred, f.segment, f.origin
  FROM cv_fit f JOIN cv_rule r USING (strategy, eval_fold, segment, priority)
  UNION ALL
  SELECT s.strategy, CAST(v.eval_fold AS INTEGER), 'val', v.row_id, 0, v.y_learn, coalesce(r.pred, 0), v.segment, 'train'
  FROM cv_fold_long v CROSS JOIN {STRATS}
  LEFT JOIN cv_rule r ON r.strategy = s.strategy AND r.eval_fold = v.eval_fold
                     AND r.segment = v.segment AND r.priority = v.priority
  WHERE v.split = 'val'
),
comparison AS (
  SELECT strategy, global_n, {ratios("global_")}, global_tn, global_fp, global_fn, global_tp,
         'segment' AS cohort_column, 'HOUSEHOLD' AS cohort_value,
         cohort_n, {ratios("cohort_")}, cohort_tn, cohort_fp, cohort_fn, cohort_tp
  FROM (SELECT strategy, {counts(prefix="global_")}, {counts(where="segment = 'HOUSEHOLD'", prefix="cohort_")}
        FROM preds WHERE split = 'val' GROUP BY strategy)
),
fold_metrics AS (
  SELECT strategy, fold, train_n, val_n, {ratios("train_")}, {ratios("val_")}
  FROM (SELECT strategy, fold, {counts(where="split = 'train'", prefix="train_")},
               {counts(where="split = 'val'", prefix="val_")} FROM preds GROUP BY strategy, fold)
),
ranked AS (SELECT CAST(row_number() OVER (ORDER BY global_f1 DESC, cohort_f1 DESC, strategy) AS INTEGER) AS rank, *
           FROM comparison),
selected AS (SELECT strategy FROM ranked WHERE rank = 1),
ftr AS (SELECT 0 AS eval_fold, row_id, y_learn, segment, priority FROM train_rows),
ftrc AS (SELECT * FROM ftr WHERE segment = 'HOUSEHOLD'),
"""
    + rate_fit("ftr", "ftrc", "fin_")
    + """,
test_preds AS (
  SELECT s.strategy, t.row_id, t.y_learn AS y_true, coalesce(r.pred, 0) AS y_pred, t.segment
  FROM test_rows t CROSS JOIN selected s
  LEFT JOIN fin_rule r ON r.strategy = s.strategy AND r.segment = t.segment AND r.priority = t.priority
),
final_row AS (
  SELECT strategy, global_n, """
    + ratios("global_")
    + """, global_tn, global_fp, global_fn, global_tp,
         'segment' AS cohort_column, 'HOUSEHOLD' AS cohort_value,
         cohort_n, """
    + ratios("cohort_")
    + """, cohort_tn, cohort_fp, cohort_fn, cohort_tp
  FROM (SELECT strategy, """
    + counts(prefix="global_")
    + ", "
    + counts(where="segment = 'HOUSEHOLD'", prefix="cohort_")
    + """ FROM test_preds GROUP BY strategy)
)
"""
)

SQL["strategy_cv_rate"] = with_views("SELECT * FROM comparison", RATE_CTES)
SQL["fold_metrics"] = with_views("SELECT * FROM fold_metrics", RATE_CTES)
SQL["oof_predictions_rate"] = with_views(
    """SELECT fold, row_id, y_true, y_pred, segment, y_true <> y_pred AS is_error
       FROM preds WHERE split = 'val' AND strategy = 'baseline'""",
    RATE_CTES,
)
SQL["smote_fold_stats"] = with_views(
    """SELECT 'smote_cohort' AS strategy, CAST(m.eval_fold AS INTEGER) AS fold,
              (SELECT count(*) FROM trc WHERE trc.eval_fold = m.eval_fold) AS cohort_original_n,
              CAST(m.m AS BIGINT) AS cohort_original_minority_n, CAST(m.big AS BIGINT) AS cohort_original_majority_n,
              (SELECT count(*) FROM trc WHERE trc.eval_fold = m.eval_fold)
                + (SELECT count(*) FROM cv_sc_syn s WHERE s.eval_fold = m.eval_fold) AS cohort_resampled_n,
              (SELECT count(*) FROM cv_sc_syn s WHERE s.eval_fold = m.eval_fold) AS cohort_synthetic_n,
              (SELECT count(*) FROM tr WHERE tr.eval_fold = m.eval_fold)
                + (SELECT count(*) FROM cv_sc_syn s WHERE s.eval_fold = m.eval_fold) AS fold_total_n_after_smote,
              (SELECT count(*) FROM tr WHERE tr.eval_fold = m.eval_fold) AS train_fold_n,
              (SELECT count(*) FROM trc WHERE trc.eval_fold = m.eval_fold) AS cohort_fold_n
       FROM cv_sc_mm m""",
    RATE_CTES,
)
SQL["append_extra"] = with_views(
    """SELECT row_id, y_learn, segment, 'train' AS source FROM labelled_orders
       UNION ALL SELECT row_id, y_learn, segment, 'extra' FROM extra_rows"""
)
SQL["rank_strategies"] = with_views("SELECT rank, strategy, global_f1, cohort_f1 FROM ranked", RATE_CTES)
SQL["selected_strategy"] = with_views("SELECT strategy, 'comparison' AS source FROM selected", RATE_CTES)
SQL["strategy_deltas"] = with_views(
    """SELECT strategy, global_f1,
              round(global_accuracy - (SELECT global_accuracy FROM comparison WHERE strategy = 'baseline'), 6) AS delta_global_accuracy,
              round(global_precision - (SELECT global_precision FROM comparison WHERE strategy = 'baseline'), 6) AS delta_global_precision,
              round(global_recall - (SELECT global_recall FROM comparison WHERE strategy = 'baseline'), 6) AS delta_global_recall,
              round(global_f1 - (SELECT global_f1 FROM comparison WHERE strategy = 'baseline'), 6) AS delta_global_f1
       FROM comparison WHERE strategy <> 'baseline'""",
    RATE_CTES,
)
_LONG_COLS = [f"{sc}_{m}" for sc in ("global", "cohort") for m in ["accuracy", "precision", "recall", "f1", "tn", "fp", "fn", "tp"]]
SQL["strategy_long"] = with_views(
    """SELECT position, strategy, split_part(name, '_', 1) AS scope,
              substr(name, length(split_part(name, '_', 1)) + 2) AS metric, value
       FROM (UNPIVOT (SELECT CAST(CASE strategy WHEN 'baseline' THEN 1 WHEN 'real_data' THEN 2 WHEN 'smote' THEN 3
                                     WHEN 'smote_cohort' THEN 4 END AS INTEGER) AS position, strategy, """
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _LONG_COLS)
    + """ FROM comparison) ON """
    + ", ".join(_LONG_COLS)
    + """ INTO NAME name VALUE value)""",
    RATE_CTES,
)
_TV = [f"{s_}_{m}" for s_ in ("train", "val") for m in ["accuracy", "precision", "recall", "f1"]]
SQL["train_val_by_strategy"] = with_views(
    "SELECT strategy, count(*) AS n_folds, "
    + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std" for c in _TV)
    + " FROM fold_metrics GROUP BY strategy",
    RATE_CTES,
)
SQL["smote_summary"] = with_views(
    """SELECT 'smote_cohort' AS strategy, count(*) AS n_folds, round(avg(s), 6) AS synthetic_mean,
              min(s) AS synthetic_min, max(s) AS synthetic_max, CAST(sum(s) AS BIGINT) AS synthetic_total,
              round(avg(t), 6) AS fold_total_mean, round(avg(t - s), 6) AS train_fold_mean,
              round(avg(c), 6) AS cohort_fold_mean, round(avg(c), 6) AS cohort_original_mean,
              round(avg(c + s), 6) AS cohort_resampled_mean
       FROM (SELECT m.eval_fold, (SELECT count(*) FROM trc WHERE trc.eval_fold = m.eval_fold) AS c,
                    (SELECT count(*) FROM cv_sc_syn x WHERE x.eval_fold = m.eval_fold) AS s,
                    (SELECT count(*) FROM tr WHERE tr.eval_fold = m.eval_fold)
                      + (SELECT count(*) FROM cv_sc_syn x WHERE x.eval_fold = m.eval_fold) AS t
             FROM cv_sc_mm m)""",
    RATE_CTES,
)
SQL["strategy_sizes"] = with_views(
    """SELECT strategy, round(avg(fit_n), 6) AS fit_n_mean, round(avg(cohort_original_n), 6) AS cohort_original_n_mean,
              round(avg(added_n), 6) AS added_n_mean, round(avg(cohort_total_n), 6) AS cohort_total_n_mean
       FROM (SELECT strategy, fold, count(*) AS fit_n,
                    count(*) FILTER (WHERE origin = 'train' AND segment = 'HOUSEHOLD') AS cohort_original_n,
                    count(*) FILTER (WHERE origin IN ('extra', 'synthetic')) AS added_n,
                    count(*) FILTER (WHERE segment = 'HOUSEHOLD') AS cohort_total_n
             FROM preds WHERE split = 'train' GROUP BY strategy, fold)
       GROUP BY strategy""",
    RATE_CTES,
)
def _d3(c):
    return f"CAST(CAST(round(CAST({c} AS DECIMAL(20,10)), 3) AS DECIMAL(14,3)) AS VARCHAR)"


SQL["strategy_table"] = with_views(
    """SELECT CAST(CASE c.strategy WHEN 'baseline' THEN 1 WHEN 'real_data' THEN 2 WHEN 'smote' THEN 3
                                  WHEN 'smote_cohort' THEN 4 END AS INTEGER) AS position,
              c.strategy, s.fit_n_mean, s.cohort_original_n_mean, s.added_n_mean, s.cohort_total_n_mean, """
    + f"{_d3('c.global_f1')} AS global_f1, {_d3('c.cohort_recall')} AS cohort_rec, {_d3('c.cohort_f1')} AS cohort_f1"
    + """
       FROM comparison c JOIN (
         SELECT strategy, round(avg(fit_n), 6) AS fit_n_mean, round(avg(cohort_original_n), 6) AS cohort_original_n_mean,
                round(avg(added_n), 6) AS added_n_mean, round(avg(cohort_total_n), 6) AS cohort_total_n_mean
         FROM (SELECT strategy, fold, count(*) AS fit_n,
                      count(*) FILTER (WHERE origin = 'train' AND segment = 'HOUSEHOLD') AS cohort_original_n,
                      count(*) FILTER (WHERE origin IN ('extra', 'synthetic')) AS added_n,
                      count(*) FILTER (WHERE segment = 'HOUSEHOLD') AS cohort_total_n
               FROM preds WHERE split = 'train' GROUP BY strategy, fold)
         GROUP BY strategy) s USING (strategy)
       WHERE c.strategy IN ('baseline', 'real_data', 'smote', 'smote_cohort')""",
    RATE_CTES,
)
SQL["cohort_breakdown"] = with_views(
    f"""SELECT coalesce(source, 'combined') AS source, n, positives, n - positives AS negatives,
               {ratio('positives', 'n')} AS positive_rate
        FROM (SELECT source, count(*) AS n, count(*) FILTER (WHERE y_learn = 1) AS positives
              FROM (SELECT 'train' AS source, y_learn FROM train_rows WHERE segment = 'HOUSEHOLD'
                    UNION ALL SELECT 'extra', y_learn FROM extra_rows WHERE segment = 'HOUSEHOLD')
              GROUP BY ROLLUP (source))""",
    LEARN_SPLIT_CTES,
)
_OOF_COHORT = f"""
oofj AS (SELECT p.y_true, p.y_pred, p.segment, t.priority, t.nation, t.line_flag
         FROM preds p JOIN train_rows t USING (row_id) WHERE p.split = 'val' AND p.strategy = 'baseline'),
oof_long AS (
  SELECT y_true, y_pred, 'segment' AS cohort_feature, segment AS cohort_value FROM oofj
  UNION ALL SELECT y_true, y_pred, 'priority', priority FROM oofj
  UNION ALL SELECT y_true, y_pred, 'nation', nation FROM oofj
  UNION ALL SELECT y_true, y_pred, 'line_flag', line_flag FROM oofj
),
oof_cohorts AS (
  SELECT cohort_feature, cohort_value, n, {ratio('pos', 'n')} AS positive_rate, {ratios()}, tn, fp, fn, tp
  FROM (SELECT cohort_feature, cohort_value, {counts()}, count(*) FILTER (WHERE y_true = 1) AS pos
        FROM oof_long WHERE cohort_value IS NOT NULL GROUP BY cohort_feature, cohort_value)
)
"""
SQL["cohort_summary"] = with_views(
    """SELECT cohort_feature, cohort_value, n, positive_rate, recall, tn, fp, fn, tp,
              CAST(row_number() OVER (PARTITION BY cohort_feature ORDER BY recall ASC, n DESC, cohort_value) AS INTEGER) AS position
       FROM oof_cohorts""",
    RATE_CTES + "," + _OOF_COHORT,
)
SQL["align_predictions"] = with_views(
    "SELECT t.row_id, t.y_learn, t.segment, t.total_price, "
    + _scaled("total_price", src="t", fit="train_rows").replace("AS total_price", "AS total_price_scaled")
    + """, p.fold, p.y_pred, p.y_true <> p.y_pred AS is_error
       FROM train_rows t JOIN preds p ON p.row_id = t.row_id AND p.split = 'val' AND p.strategy = 'baseline'""",
    RATE_CTES,
)
SQL["final_test_rate"] = with_views("SELECT * FROM final_row", RATE_CTES)
SQL["final_vs_cohort"] = with_views(
    """SELECT 'accuracy' AS metric, global_accuracy AS global_value, cohort_accuracy AS cohort_value FROM final_row
       UNION ALL SELECT 'precision', global_precision, cohort_precision FROM final_row
       UNION ALL SELECT 'recall', global_recall, cohort_recall FROM final_row
       UNION ALL SELECT 'f1', global_f1, cohort_f1 FROM final_row""",
    RATE_CTES,
)
SQL["best_strategy_tvt"] = with_views(
    """SELECT m.metric, m.train, m.val, t.test FROM (
         SELECT 'accuracy' AS metric, round(avg(train_accuracy), 6) AS train, round(avg(val_accuracy), 6) AS val FROM fm_sel
         UNION ALL SELECT 'precision', round(avg(train_precision), 6), round(avg(val_precision), 6) FROM fm_sel
         UNION ALL SELECT 'recall', round(avg(train_recall), 6), round(avg(val_recall), 6) FROM fm_sel
         UNION ALL SELECT 'f1', round(avg(train_f1), 6), round(avg(val_f1), 6) FROM fm_sel) m
       JOIN (SELECT 'accuracy' AS metric, global_accuracy AS test FROM final_row
             UNION ALL SELECT 'precision', global_precision FROM final_row
             UNION ALL SELECT 'recall', global_recall FROM final_row
             UNION ALL SELECT 'f1', global_f1 FROM final_row) t USING (metric)""",
    RATE_CTES + ", fm_sel AS (SELECT * FROM fold_metrics WHERE strategy IN (SELECT strategy FROM selected))",
)
SQL["report_json"] = with_views(
    """SELECT CAST(to_json({'rank': rank, 'strategy': strategy, 'global_n': global_n, 'global_tp': global_tp,
                            'cohort_n': cohort_n, 'cohort_tp': cohort_tp}) AS VARCHAR) AS report FROM ranked""",
    RATE_CTES,
)
SQL["roundtrip_csv"] = SQL["load_labelled"]

CURVE_CTES = """
lc_sub_rank AS (SELECT *, row_number() OVER (PARTITION BY eval_fold ORDER BY md5('42:subset:' || row_id), row_id) AS lrk
                FROM cv_fold_long WHERE split = 'train'),
lc_n AS (SELECT eval_fold, count(*) AS n FROM cv_fold_long WHERE split = 'train' GROUP BY eval_fold),
lc_size AS (SELECT eval_fold, fr.f AS fraction, least(n, greatest(CAST(floor(n * fr.f) AS BIGINT), 50)) AS subset_n
            FROM lc_n, (SELECT CAST(range AS DECIMAL(4,2)) / 10 AS f FROM range(1, 11)) fr),
lc_subsets AS (SELECT s.eval_fold, z.fraction, s.row_id, s.y_learn, s.segment, s.priority
               FROM lc_sub_rank s JOIN lc_size z USING (eval_fold) WHERE s.lrk <= z.subset_n),
""" + _rule("lc_subsets", "lc_", "eval_fold, fraction") + f""",
lc_preds AS (
  SELECT s.eval_fold AS fold, s.fraction, 'train' AS split, s.y_learn AS y_true, r.pred AS y_pred
  FROM lc_subsets s JOIN lc_rule r USING (eval_fold, fraction, segment, priority)
  UNION ALL
  SELECT v.eval_fold, z.fraction, 'val', v.y_learn, coalesce(r.pred, 0)
  FROM cv_fold_long v JOIN lc_size z ON z.eval_fold = v.eval_fold
  LEFT JOIN lc_rule r ON r.eval_fold = v.eval_fold AND r.fraction = z.fraction
                     AND r.segment = v.segment AND r.priority = v.priority
  WHERE v.split = 'val'
),
lc_m AS (SELECT fraction, fold, split, {ratios()} FROM (SELECT fraction, fold, split, {counts()} FROM lc_preds GROUP BY ALL)),
curve AS (
  SELECT CAST(fraction AS DOUBLE) AS fraction,
         round(avg(f1) FILTER (WHERE split = 'train'), 6) AS train_f1,
         round(avg(f1) FILTER (WHERE split = 'val'), 6) AS val_f1,
         round(avg(recall) FILTER (WHERE split = 'train'), 6) AS train_recall,
         round(avg(recall) FILTER (WHERE split = 'val'), 6) AS val_recall,
         CAST(floor((SELECT count(*) FROM train_rows) * 0.8 * fraction) AS BIGINT) AS n_samples
  FROM lc_m GROUP BY fraction
)
"""
SQL["learning_curve_rate"] = with_views("SELECT * FROM curve", RATE_CTES + "," + CURVE_CTES)
SQL["curve_verdict"] = with_views(
    """SELECT round(tf - vf, 6) AS gap_f1, round(vf - vm, 6) AS trend, tf - vf > 0.15 AS overfit, vf - vm > 0.02 AS still_rising
       FROM (SELECT arg_max(train_f1, fraction) AS tf, arg_max(val_f1, fraction) AS vf,
                    max(val_f1) FILTER (WHERE pos = 5) AS vm
             FROM (SELECT *, row_number() OVER (ORDER BY fraction) - 1 AS pos FROM curve))""",
    RATE_CTES + "," + CURVE_CTES,
)


def aug_protocol(src: str, p: str, cohort: str) -> str:
    return (
        fold_ctes(src, p, key="uid")
        + ",\n"
        + _rule(f"(SELECT * FROM {p}fold_long WHERE split = 'train')", p, "eval_fold")
        + f""",
{p}preds AS (SELECT v.*, coalesce(r.pred, 0) AS y_pred FROM {p}fold_long v
             LEFT JOIN {p}rule r ON r.eval_fold = v.eval_fold AND r.segment = v.segment AND r.priority = v.priority
             WHERE v.split = 'val'),
{p}row AS (SELECT {ratios('global_', 4)}, global_fp, global_fn, global_tp, global_n,
                  {ratios('cohort_', 4)}, cohort_fp, cohort_fn, cohort_tp, cohort_n
           FROM (SELECT {counts('y_learn', 'y_pred', prefix='global_')},
                        {counts('y_learn', 'y_pred', where=cohort, prefix='cohort_')} FROM {p}preds))"""
    )


AUG_CTES = (
    """
ab_src AS (SELECT row_id, 0 AS syn_j, y_learn, segment, priority, 'train' AS src, row_id || ':0' AS uid FROM train_rows),
ar_src AS (SELECT * FROM ab_src UNION ALL
           SELECT row_id, 0, y_learn, segment, priority, 'extra', row_id || ':0' FROM extra_rows),
atr AS (SELECT 0 AS eval_fold, row_id, y_learn, segment, priority FROM train_rows),
"""
    + _smote_rows("atr", "as_")
    + """,
as_src AS (SELECT * FROM ab_src UNION ALL
           SELECT row_id, syn_j, y_learn, segment, priority, 'synthetic', row_id || ':' || syn_j FROM as_syn),
"""
    + aug_protocol("ab_src", "ab_", "segment = 'HOUSEHOLD' AND src = 'train'")
    + ",\n"
    + aug_protocol("ar_src", "ar_", "src = 'extra'")
    + ",\n"
    + aug_protocol("as_src", "asm_", "segment = 'HOUSEHOLD' AND src = 'train'")
)
SQL["augmentation_rate"] = with_views(
    """SELECT 'baseline' AS strategy, * FROM ab_row UNION ALL SELECT 'real_data', * FROM ar_row
       UNION ALL SELECT 'smote', * FROM asm_row""",
    LEARN_SPLIT_CTES + "," + AUG_CTES,
)

SQL["validate_document_labels"] = """
SELECT count(*) AS n,
       count(*) FILTER (WHERE l.quality IS NULL) AS n_null,
       count(*) FILTER (WHERE l.quality IS NOT NULL AND l.quality NOT IN (0, 1)) AS n_invalid,
       count(*) FILTER (WHERE l.quality = 1) AS n_positive,
       (count(*) FILTER (WHERE l.quality IS NULL) = 0
        AND count(*) FILTER (WHERE l.quality IS NOT NULL AND l.quality NOT IN (0, 1)) = 0) AS valid
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

SQL["knn_embeddings"] = """
WITH pts AS (SELECT label, vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (SELECT a.label, a.row_id, b.row_id AS neighbour_id,
                 sqrt(list_sum(list_transform(list_zip(a.x, b.x), lambda t: (t[1] - t[2]) * (t[1] - t[2])))) AS distance
          FROM pts a JOIN pts b ON a.row_id <> b.row_id AND a.label = b.label),
nn AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY distance, neighbour_id) AS nn_rank FROM pairs)
SELECT label, row_id, CAST(nn_rank AS INTEGER) AS nn_rank, neighbour_id, round(distance, 6) AS distance FROM nn WHERE nn_rank <= 5"""

# ---------------------------------------------------------------- protocols (nearest class mean)


def _smote_vectors(src: str, p: str) -> str:
    """Synthetic rows with vectors per eval_fold of the prepared table ``src`` (brute-force neighbours)."""
    return f"""
{p}cls AS (SELECT eval_fold, y_learn, count(*) AS c FROM {src} GROUP BY eval_fold, y_learn),
{p}rk AS (SELECT *, row_number() OVER (PARTITION BY eval_fold ORDER BY c, y_learn) AS r,
                 max(c) OVER (PARTITION BY eval_fold) AS big, count(*) OVER (PARTITION BY eval_fold) AS n_cls FROM {p}cls),
{p}mm AS (SELECT eval_fold, y_learn AS ym, c AS m, big, least(5, c - 1) AS k FROM {p}rk
          WHERE r = 1 AND n_cls = 2 AND c >= 2 AND c < big),
{p}mino AS (SELECT s.eval_fold, s.row_id, s.segment, s.x1, s.x2, s.x3 FROM {src} s JOIN {p}mm mm ON s.eval_fold = mm.eval_fold AND s.y_learn = mm.ym),
{p}near AS (SELECT a.eval_fold, a.row_id,
                   min({{'d': sqrt((a.x1 - b.x1) * (a.x1 - b.x1) + (a.x2 - b.x2) * (a.x2 - b.x2) + (a.x3 - b.x3) * (a.x3 - b.x3)), 'i': b.row_id}}, 5) AS l
            FROM {p}mino a JOIN {p}mino b ON a.eval_fold = b.eval_fold AND a.row_id <> b.row_id GROUP BY a.eval_fold, a.row_id),
{p}pos AS (SELECT eval_fold, row_id, row_number() OVER (PARTITION BY eval_fold ORDER BY md5('42:smote:' || row_id), row_id) AS pz FROM {p}mino),
{p}syn0 AS (SELECT eval_fold, row_id, ym, k, CAST(unnest(range(1, r + 1)) AS INTEGER) AS syn_j
            FROM (SELECT *, (big - m) // m + CASE WHEN pz <= (big - m) % m THEN 1 ELSE 0 END AS r FROM {p}pos JOIN {p}mm USING (eval_fold))
            WHERE r > 0),
{p}pick AS (SELECT *, ('0x' || substr(md5('42:nn:' || row_id || ':' || syn_j), 1, 8))::BIGINT % k + 1 AS pick,
                   CAST(('0x' || substr(md5('42:gap:' || row_id || ':' || syn_j), 1, 8))::BIGINT AS DOUBLE) / CAST(4294967296 AS DOUBLE) AS gap
            FROM {p}syn0),
{p}syn AS (SELECT s.eval_fold, s.row_id, s.syn_j, s.ym AS y_learn, b.segment,
                  b.x1 + s.gap * (q.x1 - b.x1) AS x1, b.x2 + s.gap * (q.x2 - b.x2) AS x2, b.x3 + s.gap * (q.x3 - b.x3) AS x3
           FROM {p}pick s JOIN {p}near n USING (eval_fold, row_id) JOIN {p}mino b USING (eval_fold, row_id)
           JOIN {p}mino q ON q.eval_fold = s.eval_fold AND q.row_id = n.l[s.pick].i)
""".strip()


_STD = "CASE WHEN stddev_pop({0}) < 2.220446049250313e-15 THEN 1.0 ELSE stddev_pop({0}) END"
_RAW = "y_learn, segment, CAST(total_price AS DOUBLE) AS v1, CAST(acctbal AS DOUBLE) AS v2, CAST(part_total AS DOUBLE) AS v3"
_SCALED = "(v1 - a1) / s1 AS x1, (v2 - a2) / s2 AS x2, (coalesce(v3, med) - a3) / s3 AS x3"
CENTROID_CTES = (
    LEARN_SPLIT_CTES.strip()
    + ",\n"
    + fold_ctes("train_rows", "cv_")
    + f""",
ctr AS (SELECT eval_fold, row_id, {_RAW} FROM cv_fold_long WHERE split = 'train'),
cex AS (SELECT e.eval_fold, row_id, {_RAW} FROM extra_rows, (SELECT DISTINCT eval_fold FROM ctr) e),
craw AS (SELECT 'own' AS prep, 'train' AS origin, * FROM ctr UNION ALL SELECT 'ext', 'train', * FROM ctr UNION ALL SELECT 'ext', 'extra', * FROM cex),
cmed AS (SELECT prep, eval_fold, median(v3) AS med FROM craw GROUP BY prep, eval_fold),
cst AS (SELECT prep, eval_fold, any_value(med) AS med, avg(v1) AS a1, {_STD.format("v1")} AS s1, avg(v2) AS a2, {_STD.format("v2")} AS s2,
               avg(coalesce(v3, med)) AS a3, {_STD.format("coalesce(v3, med)")} AS s3
        FROM craw JOIN cmed USING (prep, eval_fold) GROUP BY prep, eval_fold),
cprep AS (SELECT prep, origin, eval_fold, row_id, y_learn, segment, {_SCALED} FROM craw JOIN cst USING (prep, eval_fold)),
cown AS (SELECT * FROM cprep WHERE prep = 'own'),
ccoh AS (SELECT * FROM cown WHERE segment = 'HOUSEHOLD'),
"""
    + _smote_vectors("cown", "ws_")
    + ",\n"
    + _smote_vectors("ccoh", "wc_")
    + f""",
cfit AS (
  SELECT 'baseline' AS strategy, eval_fold, row_id, 0 AS syn_j, y_learn, segment, origin, x1, x2, x3 FROM cown
  UNION ALL SELECT 'real_data', eval_fold, row_id, 0, y_learn, segment, origin, x1, x2, x3 FROM cprep WHERE prep = 'ext'
  UNION ALL SELECT 'smote', eval_fold, row_id, 0, y_learn, segment, origin, x1, x2, x3 FROM cown
  UNION ALL SELECT 'smote', eval_fold, row_id, syn_j, y_learn, segment, 'synthetic', x1, x2, x3 FROM ws_syn
  UNION ALL SELECT 'smote_cohort', eval_fold, row_id, 0, y_learn, segment, origin, x1, x2, x3 FROM cown
  UNION ALL SELECT 'smote_cohort', eval_fold, row_id, syn_j, y_learn, segment, 'synthetic', x1, x2, x3 FROM wc_syn
),
cmean AS (SELECT strategy, eval_fold, y_learn, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3 FROM cfit GROUP BY strategy, eval_fold, y_learn),
cpair AS (SELECT n.strategy, n.eval_fold, n.m1 AS n1, n.m2 AS n2, n.m3 AS n3, p.m1 AS p1, p.m2 AS p2, p.m3 AS p3
          FROM cmean n JOIN cmean p USING (strategy, eval_fold) WHERE n.y_learn = 0 AND p.y_learn = 1),
cval AS (
  SELECT s.strategy, v.eval_fold, v.row_id, v.y_learn, v.segment, {_SCALED}
  FROM (SELECT eval_fold, row_id, {_RAW} FROM cv_fold_long WHERE split = 'val') v CROSS JOIN {STRATS}
  JOIN cst ON cst.eval_fold = v.eval_fold AND cst.prep = CASE WHEN s.strategy = 'real_data' THEN 'ext' ELSE 'own' END
),
call AS (
  SELECT strategy, eval_fold, 'train' AS split, row_id, y_learn, segment, x1, x2, x3 FROM cfit
  UNION ALL SELECT strategy, eval_fold, 'val', row_id, y_learn, segment, x1, x2, x3 FROM cval
),
preds AS (
  SELECT strategy, CAST(eval_fold AS INTEGER) AS fold, split, row_id, y_learn AS y_true, segment,
         CASE WHEN (x1 - p1) * (x1 - p1) + (x2 - p2) * (x2 - p2) + (x3 - p3) * (x3 - p3)
                 < (x1 - n1) * (x1 - n1) + (x2 - n2) * (x2 - n2) + (x3 - n3) * (x3 - n3) THEN 1 ELSE 0 END AS y_pred
  FROM call JOIN cpair USING (strategy, eval_fold)
)
"""
)

SQL["strategy_cv_centroid"] = with_views(
    f"""SELECT strategy, global_n, {ratios("global_")}, global_tn, global_fp, global_fn, global_tp,
              'segment' AS cohort_column, 'HOUSEHOLD' AS cohort_value,
              cohort_n, {ratios("cohort_")}, cohort_tn, cohort_fp, cohort_fn, cohort_tp
       FROM (SELECT strategy, {counts(prefix="global_")}, {counts(where="segment = 'HOUSEHOLD'", prefix="cohort_")}
             FROM preds WHERE split = 'val' GROUP BY strategy)""",
    CENTROID_CTES,
)
SQL["fold_metrics_centroid"] = with_views(
    f"""SELECT strategy, fold, train_n, val_n, {ratios("train_")}, {ratios("val_")}
       FROM (SELECT strategy, fold, {counts(where="split = 'train'", prefix="train_")},
                    {counts(where="split = 'val'", prefix="val_")} FROM preds GROUP BY strategy, fold)""",
    CENTROID_CTES,
)
SQL["oof_predictions_centroid"] = with_views(
    """SELECT fold, row_id, y_true, y_pred, segment, y_true <> y_pred AS is_error
       FROM preds WHERE split = 'val' AND strategy = 'smote'""",
    CENTROID_CTES,
)

# whole train prepared, the focus cohort grown, the test rows scored once
SQL["final_smote_cohort_centroid"] = with_views(
    """SELECT row_id, segment, y_learn AS y_true, y_pred, y_learn <> y_pred AS is_error FROM (
         SELECT t.*, CASE WHEN (x1 - p1) * (x1 - p1) + (x2 - p2) * (x2 - p2) + (x3 - p3) * (x3 - p3)
                             < (x1 - n1) * (x1 - n1) + (x2 - n2) * (x2 - n2) + (x3 - n3) * (x3 - n3) THEN 1 ELSE 0 END AS y_pred
         FROM (SELECT row_id, y_learn, segment, {scaled} FROM (SELECT 0 AS eval_fold, row_id, {raw} FROM test_rows) JOIN ust USING (eval_fold)) t
         JOIN (SELECT n.m1 AS n1, n.m2 AS n2, n.m3 AS n3, p.m1 AS p1, p.m2 AS p2, p.m3 AS p3 FROM umean n JOIN umean p ON n.y_learn = 0 AND p.y_learn = 1) ON TRUE)
    """.format(scaled=_SCALED, raw=_RAW),
    LEARN_SPLIT_CTES.strip()
    + f""",
uraw AS (SELECT 0 AS eval_fold, row_id, {_RAW} FROM train_rows),
umed AS (SELECT median(v3) AS med FROM uraw),
ust AS (SELECT 0 AS eval_fold, any_value(med) AS med, avg(v1) AS a1, {_STD.format("v1")} AS s1, avg(v2) AS a2, {_STD.format("v2")} AS s2,
               avg(coalesce(v3, med)) AS a3, {_STD.format("coalesce(v3, med)")} AS s3 FROM uraw, umed),
uprep AS (SELECT eval_fold, row_id, y_learn, segment, {_SCALED} FROM uraw JOIN ust USING (eval_fold)),
ucoh AS (SELECT * FROM uprep WHERE segment = 'HOUSEHOLD'),
"""
    + _smote_vectors("ucoh", "uc_")
    + """,
umean AS (SELECT y_learn, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3
          FROM (SELECT y_learn, x1, x2, x3 FROM uprep UNION ALL SELECT y_learn, x1, x2, x3 FROM uc_syn) GROUP BY y_learn)
""",
)
