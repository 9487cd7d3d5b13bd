"""DuckDB SQL for the oracle: the snapshot and the cleaned table as CTEs
that every oracle query starts from. Same definitions as
``sources.snapshot`` and ``operators.clean``, written independently in
SQL so the two engines check each other."""

from __future__ import annotations

SNAPSHOT_CTES = """
per_order AS (
  SELECT l_orderkey,
         count(*) AS n_lines,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_r,
         count(*) FILTER (WHERE l_returnflag = 'A') AS n_a,
         count(*) FILTER (WHERE l_returnflag = 'N') AS n_n,
         count(*) FILTER (WHERE l_linestatus = 'F') AS n_f
  FROM lineitem GROUP BY l_orderkey
),
per_cust AS (
  SELECT o_custkey,
         min(o_orderdate) AS first_order,
         max(o_orderdate) AS last_order,
         arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority,
         arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status,
         sum(o_totalprice) AS total,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS n_billed,
         coalesce(sum(n_lines), 0) AS n_lines, coalesce(sum(n_r), 0) AS n_r,
         coalesce(sum(n_a), 0) AS n_a, coalesce(sum(n_n), 0) AS n_n,
         coalesce(sum(n_f), 0) AS n_f
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
  GROUP BY o_custkey
),
snap0 AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, r_name, per_cust.*,
         CAST((year(TIMESTAMP '2001-08-01') * 12 + month(TIMESTAMP '2001-08-01'))
              - (year(first_order) * 12 + month(first_order))
              - CASE WHEN day(TIMESTAMP '2001-08-01') < day(first_order) THEN 1 ELSE 0 END AS INTEGER) AS tenure
  FROM customer JOIN per_cust ON c_custkey = o_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
),
snap AS (
  SELECT c_custkey AS customerID,
         CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS SeniorCitizen,
         r_name AS Region,
         tenure,
         c_mktsegment AS Contract,
         last_priority AS PaymentMethod,
         last_status AS InternetService,
         CASE WHEN n_r * 3 > n_lines * 1 THEN 'Yes' ELSE 'No' END AS OnlineSecurity,
         CASE WHEN n_a * 3 > n_lines * 1 THEN 'Yes' ELSE 'No' END AS OnlineBackup,
         CASE WHEN n_n * 3 > n_lines * 1 THEN 'Yes' ELSE 'No' END AS DeviceProtection,
         CASE WHEN n_f * 2 > n_lines * 1 THEN 'Yes' ELSE 'No' END AS TechSupport,
         round(total / (tenure + 1), 2) AS MonthlyCharges,
         CASE WHEN n_billed = 0 THEN ' '
              ELSE CAST(CAST(round(total, 2) AS DECIMAL(18, 2)) AS VARCHAR) END AS TotalCharges,
         CASE WHEN last_order < TIMESTAMP '2000-09-03' THEN 'Yes' ELSE 'No' END AS Churn
  FROM snap0
),
clean0 AS (
  SELECT * REPLACE (TRY_CAST(CASE WHEN trim(TotalCharges) = '' THEN NULL ELSE TotalCharges END AS DOUBLE) AS TotalCharges)
  FROM snap
),
clean1 AS (
  SELECT * REPLACE (
    CASE WHEN (SELECT count(*) FILTER (WHERE TotalCharges IS NULL) FROM clean0) > 0 THEN
      CASE WHEN tenure = 0 THEN 0.0::DOUBLE
           WHEN TotalCharges IS NULL AND tenure > 0 THEN MonthlyCharges * tenure
           ELSE TotalCharges END
    ELSE TotalCharges END AS TotalCharges)
  FROM clean0
),
clean AS (
  SELECT * REPLACE (coalesce(TotalCharges, (SELECT quantile_cont(TotalCharges, 0.5) FROM clean1)) AS TotalCharges)
  FROM clean1
)
"""


def _split_args(inner: str) -> tuple[str, str] | None:
    """Split 'expr, digits' at the last top-level comma."""
    depth, cut = 0, -1
    for i, ch in enumerate(inner):
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            cut = i
    if cut < 0:
        return None
    return inner[:cut], inner[cut + 1:]


def decimal_rounding(sql: str) -> str:
    """Rewrite every ``round(x, d)`` to round the shortest decimal text of x
    half-up, which is how Spark rounds a double (DuckDB rounds the binary
    value, so ties such as 72.225 would otherwise come out differently)."""
    out, i = [], 0
    low = sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 1, j + 6
        while depth:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
            k += 1
        inner = sql[j + 6:k - 1]
        parts = _split_args(inner)
        out.append(sql[i:j])
        if parts is None:
            out.append(sql[j:k])
        else:
            expr, digits = parts
            expr = decimal_rounding(expr)
            v = f"CAST(({expr}) AS DOUBLE)"
            out.append(
                f"(CASE WHEN isfinite({v}) THEN CAST(round(CAST({v} AS VARCHAR)::DECIMAL(38, 12), {digits.strip()}) AS DOUBLE) "
                f"ELSE {v} END)"
            )
        i = k


def with_base(body: str, extra_ctes: str = "") -> str:
    """``WITH <snapshot CTEs>[, extra] <body>``, with Spark's rounding."""
    ctes = SNAPSHOT_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return decimal_rounding(f"WITH {ctes}\n{body.strip()}")


def unpivot_sql(table: str, cols, keep: str = "") -> str:
    """UNION ALL unpivot to (keep..., Feature, Category varchar)."""
    k = (keep + ", ") if keep else ""
    return "\nUNION ALL\n".join(
        f"SELECT {k}'{c}' AS Feature, CAST({c} AS VARCHAR) AS Category FROM {table}" for c in cols
    )
