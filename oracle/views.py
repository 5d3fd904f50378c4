"""DuckDB text of the proxy views shared by every oracle query.

Mirrors ``cohortlens.sources.proxies`` column for column.
"""

LABELLED_ORDERS = """
lines AS (
  SELECT l_orderkey,
         sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS part_a,
         sum(CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_quantity END) AS part_b,
         sum(l_quantity) AS part_total
  FROM lineitem GROUP BY l_orderkey
),
flag_counts AS (
  SELECT l_orderkey, l_returnflag, count(*) AS c FROM lineitem GROUP BY l_orderkey, l_returnflag
),
flags AS (
  SELECT l_orderkey, l_returnflag AS line_flag FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY c DESC, l_returnflag) AS rk
    FROM flag_counts) WHERE rk = 1
),
orders_base AS (
  SELECT o.o_orderkey AS row_id,
         CAST(o.o_orderstatus = 'F' AS INTEGER) AS y_true,
         CAST(o.o_totalprice > 350000 AS INTEGER) AS y_pred,
         c.c_mktsegment AS segment,
         o.o_orderpriority AS priority,
         n.n_name AS nation,
         o.o_totalprice AS total_price,
         c.c_acctbal AS acctbal,
         l.part_a, l.part_b, l.part_total,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         CAST(weekofyear(o.o_orderdate) AS INTEGER) AS week,
         0 AS zero,
         f.line_flag,
         o.o_orderdate AS order_date,
         ('0x' || substr(md5('42:' || o.o_orderkey), 1, 8))::BIGINT % 100 AS noise
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN flags f ON f.l_orderkey = o.o_orderkey
),
labelled_all AS (
  SELECT row_id, y_true, y_pred,
         CAST(CASE WHEN noise < CASE WHEN segment = 'HOUSEHOLD' THEN 40 ELSE 15 END
                   THEN 1 - y_pred ELSE y_pred END AS INTEGER) AS y_learn,
         segment, priority, nation, total_price, acctbal, part_a, part_b, part_total,
         month, week, zero, line_flag, order_date
  FROM orders_base
),
labelled_orders AS (
  SELECT * FROM labelled_all WHERE NOT coalesce(segment = 'HOUSEHOLD' AND order_date >= TIMESTAMP '2001-01-01', FALSE)
),
extra_rows AS (
  SELECT * REPLACE (row_id + 1000000000 AS row_id) FROM labelled_all
  WHERE segment = 'HOUSEHOLD' AND order_date >= TIMESTAMP '2001-01-01'
),
events_labelled AS (
  SELECT event_id AS row_id, CAST(event_type = 'purchase' AS INTEGER) AS y, event_type,
         CAST(value AS DOUBLE) AS x1, CAST(hour(ts) AS DOUBLE) AS x2
  FROM events
)
"""


def with_views(body: str, extra_ctes: str = "") -> str:
    """Prefix a query with the shared CTEs (and optional extra ones)."""
    ctes = LABELLED_ORDERS.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body}"
