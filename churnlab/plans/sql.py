"""Independent DuckDB SQL for the subscriber fixture and the encoded table.

These strings are the oracle side of the correctness check: they recompute
every derived table from the raw test tables without any of the library
code.
"""

SUBS_CTE = """
subs_orders AS (
  SELECT o_custkey,
         count(*) FILTER (WHERE o_orderdate < TIMESTAMP '2000-08-01') AS n_pre,
         count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2000-08-01') AS n_post,
         min(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '2000-08-01') AS first_pre,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderdate < TIMESTAMP '2000-08-01') AS spend_pre,
         max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)
             FILTER (WHERE o_orderdate < TIMESTAMP '2000-08-01') AS any_urgent,
         max(CASE WHEN o_totalprice >= 450000 THEN 1 ELSE 0 END)
             FILTER (WHERE o_orderdate < TIMESTAMP '2000-08-01') AS any_bulk
  FROM orders GROUP BY o_custkey
),
subs AS (
  SELECT c.c_custkey,
         CASE WHEN coalesce(a.n_post, 0) > 0 THEN 'No' ELSE 'Yes' END AS churn,
         CAST(CASE WHEN coalesce(a.n_pre, 0) > 0
                   THEN (2000 - year(a.first_pre)) * 12 + 8 - month(a.first_pre) ELSE 0 END AS INTEGER) AS tenure,
         CASE WHEN coalesce(a.n_pre, 0) > 0 THEN CAST(CAST(a.spend_pre AS DECIMAL(18,2)) AS VARCHAR) ELSE ' ' END
             AS total_spend,
         CASE WHEN coalesce(a.n_pre, 0) > 0
              THEN CAST(CAST(a.spend_pre AS DECIMAL(18,2)) AS DOUBLE)
                   / greatest((2000 - year(a.first_pre)) * 12 + 8 - month(a.first_pre), 1)
              ELSE 0.0 END AS monthly_spend,
         CAST(c.c_acctbal >= 5000 AS INTEGER) AS high_balance,
         CASE WHEN c.c_acctbal < 0 THEN 'Yes' ELSE 'No' END AS in_debt,
         CASE WHEN coalesce(a.n_pre, 0) < 6 THEN 'Low' WHEN coalesce(a.n_pre, 0) < 10 THEN 'Mid' ELSE 'High' END
             AS commitment,
         c.c_mktsegment AS segment,
         r.r_name AS region,
         CASE WHEN coalesce(a.n_pre, 0) = 0 THEN 'No orders' WHEN a.any_urgent = 1 THEN 'Yes' ELSE 'No' END
             AS urgent_user,
         CASE WHEN coalesce(a.n_pre, 0) = 0 THEN 'No orders' WHEN a.any_bulk = 1 THEN 'Yes' ELSE 'No' END
             AS bulk_buyer,
         c.c_custkey % 6 + 1 AS batch_month
  FROM customer c
  LEFT JOIN subs_orders a ON a.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

# numeric text guard shared with the Spark side: plain or scientific numbers only
NUM_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

# encoded features (D14 without scaling), one row per customer
ENC_CTE = SUBS_CTE + """,
enc AS (
  SELECT c_custkey,
         CAST(churn = 'Yes' AS INTEGER) AS label,
         CAST(tenure AS DOUBLE) AS tenure,
         coalesce(CASE WHEN regexp_matches(trim(total_spend), '""" + NUM_RE + """')
                       THEN TRY_CAST(trim(total_spend) AS DOUBLE) END, 0.0) AS total_spend,
         monthly_spend,
         CAST(high_balance AS DOUBLE) AS high_balance,
         CAST(coalesce(in_debt = 'Yes', false) AS DOUBLE) AS in_debt,
         CAST(CASE commitment WHEN 'Low' THEN 0 WHEN 'Mid' THEN 1 WHEN 'High' THEN 2 ELSE 0 END AS DOUBLE)
             AS commitment,
         CAST(coalesce(urgent_user = 'Yes', false) AS DOUBLE) AS urgent_user,
         CAST(coalesce(bulk_buyer = 'Yes', false) AS DOUBLE) AS bulk_buyer,
         CAST(coalesce(segment = 'AUTOMOBILE', false) AS DOUBLE) AS segment_AUTOMOBILE,
         CAST(coalesce(segment = 'BUILDING', false) AS DOUBLE) AS segment_BUILDING,
         CAST(coalesce(segment = 'FURNITURE', false) AS DOUBLE) AS segment_FURNITURE,
         CAST(coalesce(segment = 'HOUSEHOLD', false) AS DOUBLE) AS segment_HOUSEHOLD,
         CAST(coalesce(segment = 'MACHINERY', false) AS DOUBLE) AS segment_MACHINERY,
         CAST(coalesce(region = 'AFRICA', false) AS DOUBLE) AS region_AFRICA,
         CAST(coalesce(region = 'AMERICA', false) AS DOUBLE) AS region_AMERICA,
         CAST(coalesce(region = 'ASIA', false) AS DOUBLE) AS region_ASIA,
         CAST(coalesce(region = 'EUROPE', false) AS DOUBLE) AS region_EUROPE,
         CAST(coalesce(region = 'MIDDLE EAST', false) AS DOUBLE) AS region_MIDDLE_EAST,
         batch_month
  FROM subs
)"""

def split_sql(src: str) -> str:
    """Exact stratified split over CTE ``src`` (needs ``c_custkey`` and
    ``label``): per class, train size by largest remainder over
    n_train = n - ceil(0.2 n); the lowest md5('42|key') ranks go to test."""
    return f"""
cls AS (SELECT label, count(*) AS n_c FROM {src} GROUP BY label),
tot AS (SELECT sum(n_c) AS n, sum(n_c) - CAST(ceil(0.2 * sum(n_c)) AS BIGINT) AS n_train FROM cls),
alloc0 AS (
  SELECT c.label, c.n_c, t.n_train,
         CAST(floor(CAST(c.n_c AS DOUBLE) * t.n_train / t.n) AS BIGINT) AS base,
         CAST(c.n_c AS DOUBLE) * t.n_train / t.n - floor(CAST(c.n_c AS DOUBLE) * t.n_train / t.n) AS rem
  FROM cls c, tot t
),
alloc AS (
  SELECT label, n_c,
         base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= n_train - sum(base) OVER ()
                     THEN 1 ELSE 0 END AS train_c
  FROM alloc0
),
ranked AS (
  SELECT e.*, row_number() OVER (PARTITION BY e.label ORDER BY md5('42|' || CAST(e.c_custkey AS VARCHAR)),
                                                             e.c_custkey) - 1 AS h_rank
  FROM {src} e
),
split AS (
  SELECT r.* EXCLUDE (h_rank), CASE WHEN r.h_rank < a.n_c - a.train_c THEN 'test' ELSE 'train' END AS split
  FROM ranked r JOIN alloc a ON r.label = a.label
)"""


SPLIT_CTE = ENC_CTE + "," + split_sql("enc")

# raw subscriber columns + label + split (for the scorecard and the retrain rounds)
RAW_SPLIT_CTE = SUBS_CTE + """,
lab AS (SELECT *, CAST(churn = 'Yes' AS INTEGER) AS label FROM subs),""" + split_sql("lab")


# the retrain history: three quarters of the customers (by blocks of six keys) are the
# original table, month 0; the others keep their batch month
BASE_MONTH = "CASE WHEN (c_custkey // 6) % 4 <> 0 THEN 0 ELSE batch_month END"
HISTORY_CTE = RAW_SPLIT_CTE + f""",
hsplit AS (SELECT * REPLACE ({BASE_MONTH} AS batch_month) FROM split)"""
HSUBS_CTE = SUBS_CTE + f""",
hsubs AS (SELECT * REPLACE ({BASE_MONTH} AS batch_month) FROM subs)"""


def score_expr(q: str, t: str = "") -> str:
    """Scorecard (G4) in SQL: additive rule points, clipped; ``q`` is the
    high-spend cut (75th percentile of monthly_spend of the fitting rows)."""
    d = "CAST({} AS DOUBLE)"
    z = d.format("0.0")

    def term(cond, pts):
        return f"CASE WHEN {cond} THEN {d.format(pts)} ELSE {z} END"
    terms = [term(f"{t}tenure < 48", "0.35"), term(f"{t}tenure < 54", "0.15"), term(f"{t}tenure > 64", "-0.15"),
             term(f"{t}commitment = 'Low'", "0.25"), term(f"{t}commitment = 'High'", "-0.20"),
             term(f"{t}monthly_spend > {q}", "0.15"), term(f"{t}urgent_user = 'No'", "0.10"),
             term(f"{t}bulk_buyer = 'No'", "0.10"), term(f"{t}in_debt = 'Yes'", "0.10"),
             f"{t}batch_month * {d.format('0.015')}"]
    return f"least(greatest({' + '.join(terms)}, {d.format('0.05')}), {d.format('0.85')})"


# deterministic scorecard (G4) on the raw fixture; the high-spend cut is the
# 75th percentile of monthly_spend over the whole table
SCORE_CTE = SUBS_CTE + """,
p75 AS (SELECT quantile_cont(monthly_spend, 0.75) AS q FROM subs),
scored AS (
  SELECT s.*, CAST(churn = 'Yes' AS INTEGER) AS label, """ + score_expr("p75.q", "s.") + """ AS score
  FROM subs s, p75
),
pred AS (SELECT *, CAST(score > 0.5 AS INTEGER) AS pred FROM scored)"""
