"""Reference SQL (DuckDB dialect) for every named query.

Each statement recomputes its inputs from the driver's base tables with
common table expressions, so the check is independent of the Spark plan.
``sql(body, *needs)`` prepends the CTEs a body depends on, in dependency order.
"""

from __future__ import annotations

TS_EXISTING = "TIMESTAMP '2024-01-01 00:00:00'"
TS_RUN = "TIMESTAMP '2024-06-30 12:00:00'"
RUN_ID = "'2024-06-30 12:00:00'"

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, *deps: str) -> None:
    CTES[name] = (body, deps)


def sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n" + body


# ------------------------------------------------------------------ fixtures
cte("geo", """
SELECT c.c_custkey, c.c_nationkey, r.r_name
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("fact_base", """
SELECT 'T' || x.l_orderkey AS transaction_id, 'P' || x.l_partkey AS product_id, 'C' || x.o_custkey AS customer_id,
       x.date_key, x.quantity, x.discount, g.r_name AS region
FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY date_key, quantity, discount) AS rn
  FROM (
    SELECT l.l_orderkey, l.l_partkey, o.o_custkey,
           CAST(strftime(l.l_shipdate + INTERVAL 15 YEAR, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(l.l_quantity AS INTEGER) AS quantity,
           CAST(l.l_discount AS DECIMAL(5,2)) AS discount
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) y) x
JOIN geo g ON x.o_custkey = g.c_custkey
WHERE x.rn = 1""", "geo")

cte("dim_product", f"""
SELECT 'Unknown' AS product_id, 'Unknown Product' AS product_name, 'Unknown' AS category,
       CAST(0 AS DECIMAL(10,2)) AS price, {TS_EXISTING} AS created_at, {TS_EXISTING} AS updated_at
UNION ALL
SELECT 'P' || p_partkey, p_name, p_type, CAST(p_retailprice AS DECIMAL(10,2)), {TS_EXISTING}, {TS_EXISTING}
FROM part""")

cte("dim_date", """
SELECT 19900101 AS date_key, DATE '1990-01-01' AS full_date, 1990 AS year, 1 AS month, 'Unknown' AS month_name,
       1 AS day, 0 AS quarter
UNION ALL
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER), d, CAST(year(d) AS INTEGER),
       CAST(month(d) AS INTEGER), monthname(d), CAST(day(d) AS INTEGER), CAST(quarter(d) AS INTEGER)
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2010-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d)""")

cte("vw_dim_date", "SELECT * FROM dim_date WHERE full_date >= DATE '2010-01-01'", "dim_date")

cte("raw_customers_base", """
SELECT
  CASE WHEN c.c_custkey % 131 = 0 THEN NULL WHEN c.c_custkey % 137 = 0 THEN '  '
       ELSE 'C' || c.c_custkey END AS customer_id,
  CASE WHEN c.c_custkey % 29 = 0 THEN '' WHEN c.c_custkey % 31 = 0 THEN repeat('Quayside Trading ', 18)
       ELSE c.c_name END AS customer_name,
  CASE WHEN c.c_custkey % 23 = 0 THEN NULL WHEN c.c_custkey % 19 = 0 THEN 'no-at-sign.net'
       ELSE 'buyer.' || c.c_custkey || '@post.example' END AS email,
  CASE WHEN g.c_nationkey % 9 = 0 THEN NULL ELSE g.r_name END AS region,
  CASE WHEN c.c_custkey % 13 = 0 THEN 'someday' WHEN c.c_custkey % 11 = 0 THEN NULL
       WHEN c.c_custkey % 7 = 0 THEN '2023/04/0' || (c.c_custkey % 9 + 1)
       WHEN c.c_custkey % 5 = 0 THEN '2022-09-1' || (c.c_custkey % 10) || 'T00:00:00Z'
       ELSE '2024-06-1' || (c.c_custkey % 10) END AS join_date,
  CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE CAST(CAST(floor(c.c_acctbal) AS BIGINT) AS VARCHAR) END
    AS loyalty_points
FROM customer c JOIN geo g ON c.c_custkey = g.c_custkey""", "geo")

cte("raw_customers", """
SELECT * FROM raw_customers_base
UNION ALL SELECT * FROM raw_customers_base WHERE customer_id LIKE '%50'
UNION ALL SELECT customer_id, customer_name || ' Jr', email, region, join_date, loyalty_points
          FROM raw_customers_base WHERE customer_id LIKE '%75'""", "raw_customers_base")

# Customer flow: source defaults, full-row dedup, keep-first per id, clean, valid id, enforce.
cte("cust_src", """
SELECT coalesce(customer_id, '') AS customer_id, coalesce(customer_name, '') AS customer_name,
       coalesce(email, '') AS email, coalesce(region, '') AS region, coalesce(join_date, '') AS join_date,
       coalesce(loyalty_points, '0') AS loyalty_points
FROM raw_customers""", "raw_customers")

cte("cust_distinct", "SELECT DISTINCT * FROM cust_src", "cust_src")

cte("cust_first", """
SELECT customer_id, customer_name, email, region, join_date, loyalty_points FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
                               ORDER BY loyalty_points, join_date, region, email, customer_name) AS rn
  FROM cust_distinct) WHERE rn = 1""", "cust_distinct")

cte("cust_clean", """
SELECT customer_id,
  CASE WHEN customer_name IS NULL OR length(customer_name) = 0 THEN 'Unknown'
       WHEN length(customer_name) > 255 THEN substr(customer_name, 1, 255) ELSE customer_name END AS customer_name,
  CASE WHEN email IS NULL OR length(email) = 0 THEN 'Unknown' WHEN instr(email, '@') = 0 THEN 'invalid'
       WHEN length(email) > 320 THEN substr(email, 1, 320) ELSE email END AS email,
  CASE WHEN region IS NULL OR length(region) = 0 THEN 'Unknown' ELSE region END AS region,
  CASE WHEN join_date IS NULL OR length(join_date) = 0 OR (instr(join_date, '-') = 0 AND instr(join_date, '/') = 0)
       THEN '19900101'
       WHEN length(join_date) >= 10 THEN replace(replace(left(join_date, 10), '-', ''), '/', '')
       ELSE '19900101' END AS join_date,
  CASE WHEN loyalty_points IS NULL OR length(loyalty_points) = 0 THEN '0'
       WHEN CAST(loyalty_points AS INTEGER) < 0 THEN '0' ELSE loyalty_points END AS loyalty_points
FROM cust_first""", "cust_first")

cte("cust_valid", "SELECT * FROM cust_clean WHERE length(trim(customer_id)) > 0", "cust_clean")

cte("cust_enforced", """
SELECT substr(customer_id, 1, 50) AS customer_id, substr(customer_name, 1, 255) AS customer_name,
       substr(email, 1, 320) AS email, substr(region, 1, 50) AS region,
       CAST(join_date AS INTEGER) AS join_date, CAST(loyalty_points AS INTEGER) AS loyalty_points
FROM cust_valid""", "cust_valid")

cte("dim_customer", f"""
SELECT 'Unknown' AS customer_id, 'Unknown Customer' AS customer_name, 'Unknown' AS email, 'Unknown' AS region,
       19900101 AS join_date, 0 AS loyalty_points, {TS_EXISTING} AS created_at, {TS_EXISTING} AS updated_at
UNION ALL
SELECT customer_id, customer_name, email, region, join_date, loyalty_points, {TS_EXISTING}, {TS_EXISTING}
FROM cust_enforced""", "cust_enforced")

# ------------------------------------------------------------------ amounts
NET = "f.quantity * p.price * (1 - COALESCE(f.discount, 0))"
GROSS = "f.quantity * p.price"


def money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DECIMAL(18,2))"


ORACLE: dict[str, str] = {}

# ------------------------------------------------------------------ analytics
ORACLE["q1_region_category"] = sql(f"""
SELECT f.region, p.category, {money(f'SUM({NET})')} AS total_sales
FROM fact_base f JOIN dim_product p ON f.product_id = p.product_id
GROUP BY f.region, p.category ORDER BY f.region, p.category""", "fact_base", "dim_product")

ORACLE["q2_top5_products"] = sql(f"""
SELECT p.product_name, {money(f'SUM({NET})')} AS total_revenue
FROM fact_base f JOIN dim_product p ON f.product_id = p.product_id
GROUP BY p.product_name ORDER BY total_revenue DESC, p.product_name LIMIT 5""", "fact_base", "dim_product")

ORACLE["q3_monthly_trend"] = sql(f"""
SELECT d.year, d.month, {money(f'SUM({NET})')} AS monthly_sales
FROM fact_base f JOIN dim_product p ON f.product_id = p.product_id JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year, d.month ORDER BY d.year, d.month""", "fact_base", "dim_product", "dim_date")

ORACLE["q4_avg_discount"] = sql("""
SELECT region, CAST(ROUND(AVG(COALESCE(discount, 0)) * 100, 2) AS DECIMAL(18,2)) AS avg_discount_percentage
FROM fact_base GROUP BY region ORDER BY region""", "fact_base")

ORACLE["q5_high_value_lines"] = sql(f"""
SELECT COUNT(*) AS high_value_transactions
FROM fact_base f JOIN dim_product p ON f.product_id = p.product_id
WHERE {NET} > 1000""", "fact_base", "dim_product")

# ------------------------------------------------------------------ measures
GROSS_LINES = """
SELECT f.*, p.product_name, p.category, p.price, f.quantity * p.price AS gross
FROM fact_base f LEFT JOIN dim_product p ON f.product_id = p.product_id"""
cte("gross_lines", GROSS_LINES, "fact_base", "dim_product")
cte("dated_lines", """
SELECT g.*, d.year, d.month, d.full_date FROM gross_lines g LEFT JOIN vw_dim_date d ON g.date_key = d.date_key""",
    "gross_lines", "vw_dim_date")

ORACLE["m_total_sales"] = sql(f"SELECT {money('SUM(gross)')} AS total_sales FROM gross_lines", "gross_lines")

ORACLE["m_avg_sale_per_transaction"] = sql(f"""
SELECT {money('SUM(gross) / NULLIF(COUNT(DISTINCT transaction_id), 0)')} AS avg_sale_per_transaction
FROM gross_lines""", "gross_lines")

ORACLE["m_total_loyalty_points"] = sql("""
SELECT CAST(SUM(CAST(loyalty_points AS BIGINT)) AS BIGINT) AS total_loyalty_points FROM dim_customer""", "dim_customer")

ORACLE["m_high_value_transactions"] = sql("""
SELECT COUNT(*) FILTER (WHERE txn_total > 1000) AS high_value_transactions
FROM (SELECT transaction_id, SUM(gross) AS txn_total FROM gross_lines GROUP BY transaction_id)""", "gross_lines")

ORACLE["m_total_customers"] = sql("""
SELECT COUNT(DISTINCT customer_id) + MAX(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS total_customers
FROM fact_base""", "fact_base")

ORACLE["dash_kpi_cards"] = sql(f"""
SELECT {money('a.gross')} AS total_sales, {money('a.gross / NULLIF(a.n_txn, 0)')} AS avg_sale_per_transaction,
       l.total_loyalty_points, h.high_value_transactions, a.total_customers
FROM (SELECT SUM(gross) AS gross, COUNT(DISTINCT transaction_id) AS n_txn,
             COUNT(DISTINCT customer_id) + MAX(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS total_customers
      FROM gross_lines) a,
     (SELECT COUNT(*) FILTER (WHERE txn_total > 1000) AS high_value_transactions
      FROM (SELECT transaction_id, SUM(gross) AS txn_total FROM gross_lines GROUP BY transaction_id)) h,
     (SELECT CAST(SUM(CAST(loyalty_points AS BIGINT)) AS BIGINT) AS total_loyalty_points FROM dim_customer) l""",
                               "gross_lines", "dim_customer")

ORACLE["dash_monthly_trend"] = sql(f"""
SELECT year, month, {money('SUM(gross)')} AS total_sales FROM dated_lines GROUP BY year, month
ORDER BY year, month""", "dated_lines")

ORACLE["dash_top5_products"] = sql(f"""
SELECT product_name, {money('SUM(gross)')} AS total_sales FROM gross_lines GROUP BY product_name
ORDER BY total_sales DESC, product_name LIMIT 5""", "gross_lines")

ORACLE["dash_loyalty_by_region"] = sql("""
SELECT region, loyalty_points,
       CAST(ROUND(CAST(loyalty_points AS DOUBLE) * 100 / SUM(loyalty_points) OVER (), 6) AS DECIMAL(18,6)) AS share_pct
FROM (SELECT region, CAST(SUM(CAST(loyalty_points AS BIGINT)) AS BIGINT) AS loyalty_points FROM dim_customer GROUP BY region)
ORDER BY region""", "dim_customer")

ORACLE["dash_category_trend"] = sql(f"""
SELECT year, month, category, {money('SUM(gross)')} AS total_sales FROM dated_lines
GROUP BY year, month, category ORDER BY year, month, category""", "dated_lines")

ORACLE["dash_sales_by_region"] = sql(f"""
SELECT region, {money('SUM(gross)')} AS total_sales FROM gross_lines GROUP BY region ORDER BY region""",
                                     "gross_lines")

ORACLE["m_sales_ytd_daily"] = sql(f"""
SELECT year, date_key, {money('day_sales')} AS daily_sales,
       {money('SUM(day_sales) OVER (PARTITION BY year ORDER BY full_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
         AS sales_ytd
FROM (SELECT year, full_date, date_key, SUM(gross) AS day_sales FROM dated_lines GROUP BY year, full_date, date_key)""",
                                  "dated_lines")

ORACLE["m_sales_ytd_monthly"] = sql(f"""
SELECT year, month, {money('m_sales')} AS monthly_sales,
       {money('SUM(m_sales) OVER (PARTITION BY year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')}
         AS sales_ytd
FROM (SELECT year, month, SUM(gross) AS m_sales FROM dated_lines GROUP BY year, month)""", "dated_lines")

ORACLE["dash_filtered_sales"] = sql(f"""
SELECT transaction_id, product_id, customer_id, date_key, year, month, region, category, quantity, price,
       {money('gross')} AS gross_sales
FROM dated_lines
WHERE region IN ('ASIA', 'EUROPE') AND year IN (2012, 2013) AND month IN (1, 2, 3, 4, 5, 6)
  AND category IN ('ECONOMY', 'PROMO', 'SMALL')""", "dated_lines")

ORACLE["dash_product_sales"] = sql(f"""
SELECT transaction_id, product_id, customer_id, date_key, year, month, region, category, quantity, price,
       {money('gross')} AS gross_sales
FROM dated_lines
WHERE product_id IN ({', '.join(f"'P{k}'" for k in range(1, 26))})""", "dated_lines")


# ------------------------------------------------------------------ sales cleaning
RAW_COLS = ["transaction_id", "customer_id", "product_id", "product_name", "category", "price", "quantity",
            "discount", "date", "region"]
FACT_COLS = ["transaction_id", "product_id", "customer_id", "date_key", "quantity", "discount", "region"]
WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
NUM_RE = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def pystr(x: str) -> str:
    return f"coalesce({x}, 'None')"


def in_list(x: str, values) -> str:
    return f"coalesce({x} IN ({', '.join(repr(v) for v in values)}), false)"


def placeholder(x: str, values) -> tuple[str, str]:
    s = strip(pystr(x))
    miss = in_list(s, values)
    return f"CASE WHEN {miss} THEN 'Unknown' ELSE {s} END", miss


def number(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN regexp_matches({s}, {NUM_RE}) THEN TRY_CAST({s} AS DOUBLE) END"


def number_rule(x: str) -> tuple[str, str, str]:
    n = number(x)
    missing = f"({n}) IS NULL"
    negative = f"coalesce(({n}) < 0, false)"
    return f"CASE WHEN {missing} OR {negative} THEN 0.0 ELSE {n} END", missing, negative


def parse_date(x: str) -> str:
    s = strip(x)
    fmts = ["%d-%m-%Y", "%Y/%m/%d", "%d %b %Y", "%Y-%m-%d"]
    # First, as %Y alone would read a year 3.
    parts = [f"CASE WHEN regexp_matches({s}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2}}$') THEN try_strptime({s}, '%m/%d/%y') END"]
    parts += [f"try_strptime({s}, '{f}')" for f in fmts]
    parts.append(f"try_strptime(regexp_extract({s}, '^(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})[T ]', 1), '%Y-%m-%d')")
    parts.append(f"try_strptime(regexp_extract({s}, '^(\\d{{4}}/\\d{{1,2}}/\\d{{1,2}})[T ]', 1), '%Y/%m/%d')")
    for f in ["%b %d, %Y", "%d-%b-%Y", "%Y.%m.%d", "%d %b %Y %H:%M", "%m/%d/%Y %H:%M"]:
        parts.append(f"try_strptime({s}, '{f}')")
    for f in ["%m/%d/%Y", "%d/%m/%Y", "%m-%d-%Y", "%d %B %Y", "%b %d %Y", "%B %d %Y", "%Y%m%d"]:
        parts.append(f"try_strptime({s}, '{f}')")
    return f"CAST(coalesce({', '.join(parts)}) AS DATE)"


def date_rule(x: str) -> tuple[str, str, str]:
    missing = f"({x} IS NULL OR {strip(x)} = '')"
    p = parse_date(x)
    invalid = f"(NOT {missing} AND ({p}) IS NULL)"
    key = (f"CAST(CASE WHEN {missing} OR {invalid} THEN 19900101 "
           f"ELSE year({p}) * 10000 + month({p}) * 100 + day({p}) END AS INTEGER)")
    return key, missing, invalid


def cols(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{c}" for c in RAW_COLS)


cte("raw_sales", """
SELECT
  CASE WHEN l.l_orderkey % 211 = 0 THEN NULL WHEN l.l_orderkey % 223 = 0 THEN '   '
       ELSE ' T' || l.l_orderkey || ' ' END AS transaction_id,
  CASE WHEN o.o_custkey % 61 = 0 THEN NULL WHEN o.o_custkey % 67 = 0 THEN 'None'
       WHEN o.o_custkey % 71 = 0 THEN 'C_absent' ELSE 'C' || o.o_custkey END AS customer_id,
  CASE WHEN l.l_partkey % 199 = 0 THEN CASE WHEN x.again THEN NULL ELSE '' END
       WHEN x.again THEN ' P' || l.l_partkey ELSE 'P' || l.l_partkey END AS product_id,
  CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE p.p_name END AS product_name,
  CASE WHEN l.l_partkey % 89 = 0 THEN 'NaN' ELSE p.p_type END AS category,
  CASE WHEN l.l_partkey % 83 = 0 THEN 'n/a' WHEN l.l_partkey % 79 = 0 THEN '-1.50'
       ELSE CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
  CASE WHEN x.again THEN '1' WHEN l.l_linenumber = 7 AND l.l_suppkey % 3 = 0 THEN NULL WHEN l.l_suppkey % 13 = 0 THEN '-4'
       WHEN l.l_suppkey % 17 = 0 THEN 'two' ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
  CASE WHEN l.l_suppkey % 11 = 0 THEN NULL WHEN l.l_suppkey % 19 = 0 THEN '-0.05'
       ELSE CAST(CAST(l.l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS discount,
  CASE WHEN l.l_orderkey % 101 = 0 THEN NULL WHEN l.l_orderkey % 103 = 0 THEN 'next week'
       WHEN l.l_orderkey % 107 = 0 THEN strftime(CAST(l.l_shipdate + INTERVAL 15 YEAR AS DATE) + INTERVAL 20 YEAR, '%Y-%m-%d')
       WHEN l.l_orderkey % 109 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%d %b %Y')
       WHEN l.l_orderkey % 113 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%m/%d/%Y')
       WHEN l.l_orderkey % 127 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%b %-d, %Y')
       WHEN l.l_orderkey % 131 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%d-%b-%Y')
       WHEN l.l_orderkey % 137 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%-m/%-d/%y')
       WHEN l.l_orderkey % 139 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%Y.%m.%d')
       WHEN l.l_orderkey % 149 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%-d %b %Y') || ' 00:00'
       WHEN l.l_orderkey % 151 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%m/%d/%Y') || ' 00:00'
       WHEN l.l_linenumber % 4 = 0 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%Y/%m/%d')
       WHEN l.l_linenumber % 4 = 1 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%d-%m-%Y')
       WHEN l.l_linenumber % 4 = 2 THEN strftime(l.l_shipdate + INTERVAL 15 YEAR, '%Y-%m-%dT00:00:00Z')
       ELSE strftime(l.l_shipdate + INTERVAL 15 YEAR, '%Y-%m-%d') END AS date,
  CASE WHEN g.c_nationkey % 9 = 0 THEN NULL ELSE ' ' || g.r_name END AS region,
  CAST((((l.l_orderkey * 16 + l.l_linenumber) * 8192 + date_diff('day', DATE '1990-01-01', CAST(l.l_shipdate AS DATE)))
        * 65536 + l.l_partkey % 65536) * 4 + x.copy AS BIGINT) AS _ord
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN geo g ON o.o_custkey = g.c_custkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN (VALUES (1, false), (2, false), (3, true)) x(copy, again)
  ON x.copy = 1 OR (x.copy = 2 AND l.l_orderkey % 307 = 0)
     OR (x.copy = 3 AND l.l_orderkey % 173 = 0 AND l.l_orderkey % 307 <> 0)""", "geo")

# Distinct raw rows with copy counts; _ord is the first copy's source position.
cte("s_w1", f"""
SELECT {cols()}, COUNT(*) AS _n, MIN(_ord) AS _ord FROM raw_sales GROUP BY {cols()}""", "raw_sales")

cte("s_txn", f"""
SELECT *, {strip(pystr('transaction_id'))} AS txn FROM s_w1""", "s_w1")

TXN_MISSING = "(txn = '' OR lower(txn) IN ('nan', 'none'))"

cte("s_w2", f"""
SELECT *, _ord = min(_ord) OVER (PARTITION BY txn, product_id) AS _is_first
FROM s_txn WHERE NOT {TXN_MISSING}""", "s_txn")

_c = {}
_c["customer_id"], _c["customer_m"] = placeholder("customer_id", ["", "None", "nan"])
_c["product_id"], _c["product_id_m"] = placeholder("product_id", ["", "None", "nan"])
_c["product_name"], _c["product_name_m"] = placeholder("product_name", ["", "None", "nan"])
_c["category"], _c["category_m"] = placeholder("category", ["", "None", "nan", "NaN"])
_c["region"], _c["region_m"] = placeholder("region", ["", "None", "nan", "NaN"])
_c["price"], _c["price_m"], _c["price_n"] = number_rule("price")
_c["quantity"], _c["quantity_m"], _c["quantity_n"] = number_rule("quantity")
_c["discount"], _c["discount_m"], _c["discount_n"] = number_rule("discount")
_c["date_key"], _c["date_m"], _c["date_i"] = date_rule("date")

cte("s_clean", f"""
SELECT {cols('')}, _ord, txn AS c_transaction_id,
  {_c['customer_id']} AS c_customer_id, {_c['product_id']} AS c_product_id,
  {_c['product_name']} AS c_product_name, {_c['category']} AS c_category,
  {_c['price']} AS c_price, {_c['quantity']} AS c_quantity, {_c['discount']} AS c_discount,
  {_c['date_key']} AS c_date_key, {_c['region']} AS c_region,
  {_c['customer_m']} AS f_customer, {_c['product_id_m']} AS f_product_id, {_c['product_name_m']} AS f_product_name,
  {_c['category_m']} AS f_category, ({_c['price_m']} OR {_c['price_n']}) AS f_price,
  {_c['quantity_m']} AS f_quantity_m, {_c['quantity_n']} AS f_quantity_n,
  {_c['discount_m']} AS f_discount_m, {_c['discount_n']} AS f_discount_n,
  {_c['date_m']} AS f_date_m, {_c['date_i']} AS f_date_i, {_c['region_m']} AS f_region
FROM s_w2 WHERE _is_first""", "s_w2")

CLEAN_OUT = ", ".join(f"c_{c} AS {c}" for c in
                      ["transaction_id", "customer_id", "product_id", "product_name", "category", "price",
                       "quantity", "discount", "date_key", "region"])

cte("s_fact_distinct", f"""
SELECT {', '.join(FACT_COLS)}, min(_ord) AS _ord FROM (
  SELECT c_transaction_id AS transaction_id, c_product_id AS product_id, c_customer_id AS customer_id,
         c_date_key AS date_key, c_quantity AS quantity, c_discount AS discount, c_region AS region, _ord
  FROM s_clean) GROUP BY ALL""", "s_clean")

cte("s_fact_flagged", """
SELECT *, _ord = min(_ord) OVER (PARTITION BY transaction_id, product_id) AS _is_first FROM s_fact_distinct""",
    "s_fact_distinct")

cte("s_fact_typed", """
SELECT transaction_id, product_id, customer_id, date_key, CAST(trunc(quantity) AS INTEGER) AS quantity,
       CAST(discount AS DECIMAL(5,2)) AS discount, region
FROM s_fact_flagged WHERE _is_first""", "s_fact_flagged")

cte("s_product_extract", """
SELECT product_id, product_name, category, price FROM (
  SELECT c_product_id AS product_id, c_product_name AS product_name, c_category AS category, c_price AS price,
         row_number() OVER (PARTITION BY c_product_id ORDER BY _ord) AS rn
  FROM s_clean WHERE c_product_id <> 'Unknown') WHERE rn = 1""", "s_clean")

cte("s_product_typed", """
SELECT product_id, product_name, category, CAST(price AS DECIMAL(10,2)) AS price FROM s_product_extract""",
    "s_product_extract")


def raw_json(prefix: str = "") -> str:
    return "CAST(to_json(struct_pack(" + ", ".join(f"{c} := {prefix}{c}" for c in RAW_COLS) + ")) AS VARCHAR)"


# Expected values of the log (column, issue, note), written out here for the same reason.
ISSUES = {
    "duplicate_full_row": ("ALL_COLUMNS", "duplicate_full_row", "Dropped this full duplicate row"),
    "txn_missing": ("transaction_id", "missing_or_blank", "Dropped row due to missing or blank transaction_id"),
    "txn_product_dup": ("transaction_id", "duplicate_transactionid+productid", "Dropped duplicate transactionid+productid pairs"),
    "customer_missing": ("customer_id", "missing", 'customer_id missing or blank; replaced with "Unknown"'),
    "product_id_missing": ("product_id", "missing", "product_id missing or blank; replaced with 'Unknown'"),
    "product_name_missing": ("product_name", "missing", "product_name missing or blank; replaced with 'Unknown'"),
    "category_missing": ("category", "missing", "category missing or blank; replaced with 'Unknown'"),
    "price_invalid": ("price", "invalid_value", "price missing, non-numeric, or negative; replaced with 0"),
    "quantity_invalid": ("quantity", "invalid_value", "quantity missing, non-numeric, or negative; replaced with 0"),
    "discount_invalid": ("discount", "invalid_value", "discount missing, non-numeric, or negative; replaced with 0"),
    "date_missing": ("date", "missing_value", "date missing or blank; replaced with 1990-01-01"),
    "date_invalid": ("date", "invalid_format", "invalid date format; replaced with 19900101"),
    "region_missing": ("region", "missing", "region missing or blank; replaced with 'Unknown'"),
    "fact_key_dup": ("composite_key", "duplicate_key", "Duplicate (transaction_id, product_id) combination found; dropped"),
    "customer_blank_id": ("customer_id", "missing_or_blank", "Dropped customer row with blank customer_id"),
}


def log_select(src: str, col: str, issue: str, note: str, record: str, original: str, copy: str = "1",
               where: str = "true") -> str:
    return f"""
SELECT sha256(concat_ws('|', {RUN_ID}, 'python_etl', '{col}', '{issue}', {original}, CAST({copy} AS VARCHAR)))
         AS log_id,
       {TS_RUN} AS etl_run_id, 'python_etl' AS source_system, {record} AS record_id, '{col}' AS bad_column,
       '{issue}' AS issue_type, {original} AS original_record, '{note.replace("'", "''")}' AS notes
FROM {src} WHERE {where}"""


def _log_parts() -> str:
    parts = []
    c, i, n = ISSUES["duplicate_full_row"]
    parts.append(log_select("(SELECT *, unnest(generate_series(2, _n)) AS _copy FROM s_w1 WHERE _n > 1)",
                            c, i, n, "transaction_id", raw_json(), "_copy"))
    c, i, n = ISSUES["txn_missing"]
    parts.append(log_select("s_txn", c, i, n, "txn", raw_json(), where=TXN_MISSING))
    c, i, n = ISSUES["txn_product_dup"]
    parts.append(log_select("s_w2", c, i, n, "txn", raw_json(), where="NOT _is_first"))
    for key, flag in [("customer_missing", "f_customer"), ("product_id_missing", "f_product_id"),
                      ("product_name_missing", "f_product_name"), ("category_missing", "f_category"),
                      ("price_invalid", "f_price"), ("quantity_invalid", "(f_quantity_m OR f_quantity_n)"),
                      ("discount_invalid", "(f_discount_m OR f_discount_n)"), ("date_missing", "f_date_m"),
                      ("date_invalid", "f_date_i"), ("region_missing", "f_region")]:
        c, i, n = ISSUES[key]
        parts.append(log_select("s_clean", c, i, n, "c_transaction_id", raw_json(), where=flag))
    c, i, n = ISSUES["fact_key_dup"]
    fact_json = "CAST(to_json(struct_pack(" + ", ".join(f"{x} := {x}" for x in FACT_COLS) + ")) AS VARCHAR)"
    parts.append(log_select("s_fact_flagged", c, i, n, "transaction_id", fact_json, where="NOT _is_first"))
    return "\nUNION ALL".join(parts)


cte("s_log", _log_parts(), "s_w1", "s_txn", "s_w2", "s_clean", "s_fact_flagged")

RAW_SEL = ", ".join(RAW_COLS)


def _raw_with(col: str, *exprs: str) -> str:
    out = []
    for c in RAW_COLS:
        out.extend(exprs if c == col else [c])
    return ", ".join(out)


ORACLE["clean_transaction_id"] = sql(f"""
SELECT {_raw_with('transaction_id', 'txn AS transaction_id')}
FROM (SELECT *, {strip(pystr('transaction_id'))} AS txn FROM raw_sales) WHERE NOT {TXN_MISSING}""", "raw_sales")

for _col, _vals in [("customer_id", ["", "None", "nan"]), ("product_id", ["", "None", "nan"]),
                    ("product_name", ["", "None", "nan"]), ("category", ["", "None", "nan", "NaN"]),
                    ("region", ["", "None", "nan", "NaN"])]:
    _v, _m = placeholder(_col, _vals)
    ORACLE[f"clean_{_col}"] = sql(f"SELECT {_raw_with(_col, f'{_v} AS {_col}', f'{_m} AS {_col}_missing')} "
                                  f"FROM raw_sales", "raw_sales")

for _col in ["price", "quantity", "discount"]:
    _v, _m, _n = number_rule(_col)
    ORACLE[f"clean_{_col}"] = sql(
        f"SELECT {_raw_with(_col, f'{_v} AS {_col}', f'{_m} AS {_col}_missing', f'{_n} AS {_col}_negative')} "
        f"FROM raw_sales", "raw_sales")

_k, _m, _i = date_rule("date")
ORACLE["clean_date"] = sql(
    f"SELECT {_raw_with('date', f'{_k} AS date_key', f'{_m} AS date_missing', f'{_i} AS date_invalid')} "
    f"FROM raw_sales", "raw_sales")

ORACLE["dedup_full_row"] = sql(f"SELECT {RAW_SEL} FROM s_w1", "s_w1")
ORACLE["dedup_full_row_rejects"] = sql(f"""
SELECT {RAW_SEL}, CAST(unnest(generate_series(2, _n)) AS BIGINT) AS copy_no FROM s_w1 WHERE _n > 1""", "s_w1")
ORACLE["dedup_txn_product"] = sql(f"SELECT {_raw_with('transaction_id', 'txn AS transaction_id')} "
                                  f"FROM s_w2 WHERE _is_first", "s_w2")
ORACLE["dedup_txn_product_rejects"] = sql(f"SELECT {_raw_with('transaction_id', 'txn AS transaction_id')} "
                                          f"FROM s_w2 WHERE NOT _is_first", "s_w2")
ORACLE["sales_clean"] = sql(f"SELECT {CLEAN_OUT} FROM s_clean", "s_clean")
ORACLE["fact_distinct"] = sql(f"SELECT {', '.join(FACT_COLS)} FROM s_fact_distinct", "s_fact_distinct")
ORACLE["fact_dedup_key"] = sql(f"SELECT {', '.join(FACT_COLS)} FROM s_fact_flagged WHERE _is_first",
                               "s_fact_flagged")
ORACLE["fact_cast"] = sql("SELECT * FROM s_fact_typed", "s_fact_typed")
ORACLE["product_extract"] = sql("SELECT * FROM s_product_extract", "s_product_extract")
ORACLE["product_cast"] = sql("SELECT * FROM s_product_typed", "s_product_typed")
ORACLE["bad_data_log"] = sql("SELECT * FROM s_log", "s_log")
ORACLE["bad_data_summary"] = sql("""
SELECT etl_run_id, source_system, bad_column, issue_type, COUNT(*) AS n_rows FROM s_log
GROUP BY etl_run_id, source_system, bad_column, issue_type""", "s_log")

ORACLE["run_metrics"] = sql("""
SELECT
  (SELECT CAST(SUM(_n) AS BIGINT) FROM s_w1) AS rows_in,
  (SELECT CAST(SUM(_n - 1) AS BIGINT) FROM s_w1) AS full_row_duplicates,
  (SELECT COUNT(*) FROM s_txn WHERE (txn = '' OR lower(txn) IN ('nan', 'none'))) AS missing_transaction_id,
  (SELECT COUNT(*) FROM s_w2 WHERE NOT _is_first) AS duplicate_transaction_product,
  (SELECT COUNT(*) FROM s_clean) AS rows_clean,
  (SELECT COUNT(*) FILTER (WHERE f_customer) FROM s_clean) AS customer_missing,
  (SELECT COUNT(*) FILTER (WHERE f_product_id) FROM s_clean) AS product_id_missing,
  (SELECT COUNT(*) FILTER (WHERE f_product_name) FROM s_clean) AS product_name_missing,
  (SELECT COUNT(*) FILTER (WHERE f_category) FROM s_clean) AS category_missing,
  (SELECT COUNT(*) FILTER (WHERE f_price) FROM s_clean) AS price_invalid,
  (SELECT COUNT(*) FILTER (WHERE f_quantity_m) FROM s_clean) AS quantity_missing,
  (SELECT COUNT(*) FILTER (WHERE f_quantity_n) FROM s_clean) AS quantity_negative,
  (SELECT COUNT(*) FILTER (WHERE f_discount_m) FROM s_clean) AS discount_missing,
  (SELECT COUNT(*) FILTER (WHERE f_discount_n) FROM s_clean) AS discount_negative,
  (SELECT COUNT(*) FILTER (WHERE f_date_m) FROM s_clean) AS date_missing,
  (SELECT COUNT(*) FILTER (WHERE f_date_i) FROM s_clean) AS date_invalid,
  (SELECT COUNT(*) FILTER (WHERE f_region) FROM s_clean) AS region_missing,
  (SELECT COUNT(*) FILTER (WHERE f_quantity_m OR f_quantity_n) FROM s_clean) AS quantity_invalid,
  (SELECT COUNT(*) FILTER (WHERE f_discount_m OR f_discount_n) FROM s_clean) AS discount_invalid,
  (SELECT COUNT(*) FILTER (WHERE c_region = 'Unknown') FROM s_clean) AS region_unknown_total,
  (SELECT COUNT(*) FILTER (WHERE c_customer_id = 'Unknown') FROM s_clean) AS customer_unknown_total,
  (SELECT COUNT(*) FILTER (WHERE NOT _is_first) FROM s_fact_flagged) AS duplicate_fact_key,
  (SELECT COUNT(*) FILTER (WHERE _is_first) FROM s_fact_flagged) AS fact_rows""",
                            "s_w1", "s_txn", "s_w2", "s_clean", "s_fact_flagged")

# ------------------------------------------------------------------ loads
cte("existing_fact", f"""
SELECT *, {TS_EXISTING} AS created_at FROM fact_base
WHERE TRY_CAST(substr(transaction_id, 2) AS BIGINT) % 3 = 0""", "fact_base")

cte("existing_product", """
SELECT product_id, product_name, category,
       CASE WHEN TRY_CAST(substr(product_id, 2) AS BIGINT) % 5 = 0 THEN CAST(1 AS DECIMAL(10,2)) ELSE price END
         AS price, created_at, updated_at
FROM dim_product
WHERE TRY_CAST(substr(product_id, 2) AS BIGINT) IS NULL OR TRY_CAST(substr(product_id, 2) AS BIGINT) % 7 <> 0""",
    "dim_product")

cte("s_fact_fk", """
SELECT f.transaction_id, f.product_id,
       CASE WHEN d.customer_id IS NULL THEN 'Unknown' ELSE f.customer_id END AS customer_id,
       f.date_key, f.quantity, f.discount, f.region
FROM s_fact_typed f LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer) d ON f.customer_id = d.customer_id""",
    "s_fact_typed", "dim_customer")

cte("s_fact_date", """
SELECT * REPLACE (CASE WHEN date_key IN (SELECT date_key FROM dim_date) THEN date_key ELSE 19900101 END AS date_key)
FROM s_fact_fk""", "s_fact_fk", "dim_date")

cte("s_fact_new", f"""
SELECT f.*, {TS_RUN} AS created_at FROM s_fact_date f
WHERE NOT EXISTS (SELECT 1 FROM existing_fact e
                  WHERE e.transaction_id = f.transaction_id AND e.product_id = f.product_id)""",
    "s_fact_date", "existing_fact")


def _reference_log(column: str, note: str, where: str) -> str:
    record = ("CAST(to_json(struct_pack(transaction_id := transaction_id, product_id := product_id, "
              "customer_id := customer_id, date_key := date_key, region := region)) AS VARCHAR)")
    return log_select("s_fact_typed", column, "unknown_reference", note, "transaction_id", record, where=where)


ORACLE["fact_date_fk"] = sql("SELECT * FROM s_fact_date", "s_fact_date")
ORACLE["fact_fk_log"] = sql(
    _reference_log("customer_id", "customer_id not in DimCustomer; replaced with 'Unknown'",
                   "customer_id NOT IN (SELECT customer_id FROM dim_customer)") + "\nUNION ALL" +
    _reference_log("date", "date not in DimDate; replaced with 19900101", "date_key NOT IN (SELECT date_key FROM dim_date)"),
    "s_fact_typed", "dim_customer", "dim_date")
ORACLE["fact_customer_fk"] = sql("SELECT * FROM s_fact_fk", "s_fact_fk")
ORACLE["fact_insert_new"] = sql("SELECT * FROM s_fact_new", "s_fact_new")
ORACLE["fact_rerun_idempotent"] = sql("""
SELECT (SELECT COUNT(*) FROM s_fact_new) AS first_run_inserted,
       (SELECT COUNT(*) FROM s_fact_date f WHERE NOT EXISTS (
          SELECT 1 FROM (SELECT transaction_id, product_id FROM existing_fact
                         UNION ALL SELECT transaction_id, product_id FROM s_fact_new) e
          WHERE e.transaction_id = f.transaction_id AND e.product_id = f.product_id)) AS second_run_inserted,
       (SELECT COUNT(*) FROM existing_fact) + (SELECT COUNT(*) FROM s_fact_new) AS rows_after""",
                                      "s_fact_new", "s_fact_date", "existing_fact")
ORACLE["audit_columns"] = sql("SELECT created_at, COUNT(*) AS n_rows FROM s_fact_new GROUP BY created_at",
                              "s_fact_new")

ORACLE["product_new"] = sql(f"""
SELECT s.*, {TS_RUN} AS created_at, {TS_RUN} AS updated_at FROM s_product_typed s
WHERE NOT EXISTS (SELECT 1 FROM existing_product e WHERE e.product_id = s.product_id)""",
                            "s_product_typed", "existing_product")

PRODUCT_DIFF = ("(s.product_name IS DISTINCT FROM e.product_name OR s.category IS DISTINCT FROM e.category "
                "OR s.price IS DISTINCT FROM e.price)")
ORACLE["product_changed"] = sql(f"""
SELECT s.product_id, s.product_name, s.category, s.price
FROM s_product_typed s JOIN existing_product e ON s.product_id = e.product_id WHERE {PRODUCT_DIFF}""",
                                "s_product_typed", "existing_product")

ORACLE["product_upsert"] = sql(f"""
SELECT coalesce(e.product_id, s.product_id) AS product_id,
       CASE WHEN s.product_id IS NOT NULL AND (e.product_id IS NULL OR {PRODUCT_DIFF}) THEN s.product_name
            ELSE e.product_name END AS product_name,
       CASE WHEN s.product_id IS NOT NULL AND (e.product_id IS NULL OR {PRODUCT_DIFF}) THEN s.category
            ELSE e.category END AS category,
       CASE WHEN s.product_id IS NOT NULL AND (e.product_id IS NULL OR {PRODUCT_DIFF}) THEN s.price
            ELSE e.price END AS price,
       CASE WHEN e.product_id IS NOT NULL THEN e.created_at ELSE {TS_RUN} END AS created_at,
       CASE WHEN s.product_id IS NOT NULL AND (e.product_id IS NULL OR {PRODUCT_DIFF}) THEN {TS_RUN}
            ELSE e.updated_at END AS updated_at
FROM existing_product e FULL OUTER JOIN s_product_typed s ON e.product_id = s.product_id""",
                               "existing_product", "s_product_typed")


# ------------------------------------------------------------------ customer flow
CUST_COLS = ["customer_id", "customer_name", "email", "region", "join_date", "loyalty_points"]
CUST_RULES = {
    "customer_name": """CASE WHEN customer_name IS NULL OR length(customer_name) = 0 THEN 'Unknown'
       WHEN length(customer_name) > 255 THEN substr(customer_name, 1, 255) ELSE customer_name END""",
    "email": """CASE WHEN email IS NULL OR length(email) = 0 THEN 'Unknown' WHEN instr(email, '@') = 0 THEN 'invalid'
       WHEN length(email) > 320 THEN substr(email, 1, 320) ELSE email END""",
    "region": "CASE WHEN region IS NULL OR length(region) = 0 THEN 'Unknown' ELSE region END",
    "join_date": """CASE WHEN join_date IS NULL OR length(join_date) = 0
            OR (instr(join_date, '-') = 0 AND instr(join_date, '/') = 0) THEN '19900101'
       WHEN length(join_date) >= 10 THEN replace(replace(left(join_date, 10), '-', ''), '/', '')
       ELSE '19900101' END""",
    "loyalty_points": """CASE WHEN loyalty_points IS NULL OR length(loyalty_points) = 0 THEN '0'
       WHEN CAST(loyalty_points AS INTEGER) < 0 THEN '0' ELSE loyalty_points END""",
}


def _cust_rule(col: str) -> str:
    sel = ", ".join(f"{CUST_RULES[c]} AS {c}" if c == col else c for c in CUST_COLS)
    return sql(f"SELECT {sel} FROM cust_src", "cust_src")


ORACLE["cust_name"] = _cust_rule("customer_name")
ORACLE["cust_region"] = _cust_rule("region")
ORACLE["cust_email"] = _cust_rule("email")
ORACLE["cust_loyalty"] = _cust_rule("loyalty_points")
ORACLE["cust_join_date"] = _cust_rule("join_date")
ORACLE["cust_dedup_full"] = sql("SELECT * FROM cust_distinct", "cust_distinct")
ORACLE["cust_dedup_id"] = sql("SELECT * FROM cust_first", "cust_first")
ORACLE["cust_sorted"] = sql("""
SELECT * FROM cust_distinct ORDER BY loyalty_points, join_date, region, email, customer_name, customer_id""",
                            "cust_distinct")
ORACLE["cust_route"] = sql("""
SELECT *, CASE WHEN coalesce(length(trim(customer_id)) > 0, false) THEN 'valid' ELSE 'blank_id' END AS route
FROM cust_clean""", "cust_clean")
ORACLE["cust_valid_id"] = sql("SELECT * FROM cust_valid", "cust_valid")
ORACLE["cust_schema_enforce"] = sql("SELECT * FROM cust_enforced", "cust_enforced")

cte("existing_customer", """
SELECT customer_id, customer_name, email, region, join_date,
       CASE WHEN TRY_CAST(substr(customer_id, 2) AS BIGINT) % 6 = 0 THEN 1 ELSE loyalty_points END AS loyalty_points,
       created_at, updated_at
FROM dim_customer
WHERE TRY_CAST(substr(customer_id, 2) AS BIGINT) IS NULL OR TRY_CAST(substr(customer_id, 2) AS BIGINT) % 4 <> 0""",
    "dim_customer")

CUST_DIFF = " OR ".join(f"s.{c} IS DISTINCT FROM e.{c}" for c in
                        ["customer_name", "email", "region", "join_date", "loyalty_points"])
ORACLE["cust_lookup_match"] = sql("""
SELECT s.* FROM cust_enforced s WHERE EXISTS (SELECT 1 FROM existing_customer e WHERE e.customer_id = s.customer_id)""",
                                  "cust_enforced", "existing_customer")
ORACLE["cust_lookup_nomatch"] = sql("""
SELECT s.* FROM cust_enforced s
WHERE NOT EXISTS (SELECT 1 FROM existing_customer e WHERE e.customer_id = s.customer_id)""",
                                    "cust_enforced", "existing_customer")
ORACLE["cust_changed"] = sql(f"""
SELECT s.* FROM cust_enforced s JOIN existing_customer e ON s.customer_id = e.customer_id WHERE {CUST_DIFF}""",
                             "cust_enforced", "existing_customer")
ORACLE["cust_unchanged"] = sql(f"""
SELECT s.* FROM cust_enforced s JOIN existing_customer e ON s.customer_id = e.customer_id WHERE NOT ({CUST_DIFF})""",
                               "cust_enforced", "existing_customer")
_take = f"(s.customer_id IS NOT NULL AND (e.customer_id IS NULL OR {CUST_DIFF}))"
ORACLE["cust_upsert"] = sql(f"""
SELECT coalesce(e.customer_id, s.customer_id) AS customer_id,
       {', '.join(f'CASE WHEN {_take} THEN s.{c} ELSE e.{c} END AS {c}' for c in CUST_COLS[1:])},
       CASE WHEN e.customer_id IS NOT NULL THEN e.created_at ELSE {TS_RUN} END AS created_at,
       CASE WHEN {_take} THEN {TS_RUN} ELSE e.updated_at END AS updated_at
FROM existing_customer e FULL OUTER JOIN cust_enforced s ON e.customer_id = s.customer_id""",
                            "existing_customer", "cust_enforced")


def _cust_log() -> str:
    c, i, n = ISSUES["customer_blank_id"]
    orig = "CAST(to_json(struct_pack(" + ", ".join(f"{x} := {x}" for x in CUST_COLS) + ")) AS VARCHAR)"
    return f"""
SELECT sha256(concat_ws('|', {RUN_ID}, 'ssis_pkg', '{c}', '{i}', {orig}, '1')) AS log_id,
       {TS_RUN} AS etl_run_id, 'ssis_pkg' AS source_system, customer_id AS record_id, '{c}' AS bad_column,
       '{i}' AS issue_type, {orig} AS original_record, '{n}' AS notes
FROM cust_clean WHERE NOT coalesce(length(trim(customer_id)) > 0, false)"""


ORACLE["cust_bad_data_log"] = sql(_cust_log(), "cust_clean")

# ------------------------------------------------------------------ dimensions
cte("fact_per_day", "SELECT date_key, COUNT(*) AS fact_lines FROM fact_base GROUP BY date_key", "fact_base")
DIM_DATE_SEL = "d.date_key, d.full_date, d.year, d.month, d.month_name, d.day, d.quarter"
ORACLE["dim_date"] = sql(f"""
SELECT {DIM_DATE_SEL}, coalesce(f.fact_lines, 0) AS fact_lines
FROM dim_date d LEFT JOIN fact_per_day f ON d.date_key = f.date_key""", "dim_date", "fact_per_day")
ORACLE["vw_dim_date"] = sql(f"""
SELECT {DIM_DATE_SEL}, coalesce(f.fact_lines, 0) AS fact_lines
FROM vw_dim_date d LEFT JOIN fact_per_day f ON d.date_key = f.date_key""", "vw_dim_date", "fact_per_day")
ORACLE["dim_date_bounds"] = sql("""
SELECT (SELECT min(full_date) FROM vw_dim_date) AS min_date, (SELECT max(full_date) FROM vw_dim_date) AS max_date,
       (SELECT COUNT(*) FROM vw_dim_date) AS n_days,
       (SELECT min(date_key) FROM fact_base) AS fact_min_date_key,
       (SELECT max(date_key) FROM fact_base) AS fact_max_date_key""", "vw_dim_date", "fact_base")
ORACLE["dim_date_guard"] = sql("""
SELECT CAST(7670 AS BIGINT) AS first_run_inserted, CAST(0 AS BIGINT) AS second_run_inserted,
       (SELECT COUNT(*) FROM dim_date) AS rows_after,
       (SELECT COUNT(*) FROM fact_base WHERE date_key IN (SELECT date_key FROM dim_date)) AS fact_lines_resolved""",
                               "dim_date", "fact_base")
ORACLE["unknown_members"] = sql("""
SELECT 'dim_customer' AS table_name, (SELECT COUNT(*) FROM cust_enforced) AS rows_before,
       (SELECT COUNT(*) FROM dim_customer) AS rows_after_seed, (SELECT COUNT(*) FROM dim_customer) AS rows_after_reseed
UNION ALL
SELECT 'dim_product', (SELECT COUNT(*) FROM part), (SELECT COUNT(*) FROM dim_product), (SELECT COUNT(*) FROM dim_product)
UNION ALL
SELECT 'dim_date', (SELECT COUNT(*) FROM vw_dim_date), (SELECT COUNT(*) FROM dim_date), (SELECT COUNT(*) FROM dim_date)""",
                                "cust_enforced", "dim_customer", "dim_product", "vw_dim_date", "dim_date")

# ------------------------------------------------------------------ integrity checks
# Dirty mart: the tables with known violations (FIXTURES.md section 8).
OK = "TRY_CAST(substr(f.transaction_id, 2) AS BIGINT)"
cte("bad_fact", f"""
SELECT CASE WHEN {OK} % 61 = 0 THEN NULL ELSE f.transaction_id END AS transaction_id,
       CASE WHEN {OK} % 67 = 0 THEN 'P_gone' ELSE f.product_id END AS product_id,
       CASE WHEN {OK} % 97 = 0 THEN NULL WHEN {OK} % 89 = 0 THEN 'C_gone' ELSE f.customer_id END AS customer_id,
       CASE WHEN {OK} % 83 = 0 THEN 20991231 WHEN {OK} % 59 = 0 THEN NULL ELSE f.date_key END AS date_key,
       CASE WHEN {OK} % 79 = 0 THEN -f.quantity ELSE f.quantity END AS quantity,
       CASE WHEN {OK} % 73 = 0 THEN -0.05 WHEN {OK} % 53 = 0 THEN 1000.0 ELSE CAST(f.discount AS DOUBLE) END AS discount,
       CASE WHEN {OK} % 47 = 0 THEN repeat('far away ', 7) ELSE f.region END AS region
FROM fact_base f JOIN (VALUES (1), (2)) x(copy) ON x.copy = 1 OR {OK} % 71 = 0""", "fact_base")
cte("bad_customer", """
SELECT CASE WHEN TRY_CAST(substr(customer_id, 2) AS BIGINT) % 43 = 0 THEN NULL ELSE customer_id END AS customer_id,
       customer_name, email,
       CASE WHEN TRY_CAST(substr(customer_id, 2) AS BIGINT) % 41 = 0 THEN repeat('north ', 10) ELSE region END AS region
FROM dim_customer""", "dim_customer")
cte("bad_product", """
SELECT CASE WHEN TRY_CAST(substr(product_id, 2) AS BIGINT) % 37 = 0 THEN 'P1' ELSE product_id END AS product_id,
       CASE WHEN TRY_CAST(substr(product_id, 2) AS BIGINT) % 31 = 0 THEN NULL ELSE product_name END AS product_name, category,
       CASE WHEN TRY_CAST(substr(product_id, 2) AS BIGINT) % 29 = 0 THEN 123456789.5 ELSE CAST(price AS DOUBLE) END AS price
FROM dim_product""", "dim_product")
cte("bad_date", """
SELECT * REPLACE (CASE WHEN day = 31 THEN repeat('month ', 4) WHEN day = 30 THEN NULL ELSE month_name END AS month_name)
FROM dim_date""", "dim_date")
CHECKED = {"dim_customer": "bad_customer", "dim_product": "bad_product", "dim_date": "bad_date", "fact_sales": "bad_fact",
           "bad_data_log": "s_log"}
BAD = ("bad_fact", "bad_customer", "bad_product", "bad_date")


def _pk(name: str, table: str, keys: str) -> str:
    return f"""
SELECT '{name}' AS table_name, '{keys}' AS key_columns, COUNT(*) AS duplicate_keys,
       CAST(coalesce(SUM(n), 0) AS BIGINT) AS rows_involved
FROM (SELECT {keys}, COUNT(*) AS n FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1)"""


ORACLE["check_pk_duplicates"] = sql("\nUNION ALL".join([
    _pk("dim_customer", "bad_customer", "customer_id"), _pk("dim_product", "bad_product", "product_id"),
    _pk("dim_date", "bad_date", "date_key"), _pk("fact_sales", "bad_fact", "transaction_id,product_id"),
    _pk("bad_data_log", "s_log", "log_id"), _pk("raw_fact_lines", "s_fact_distinct", "transaction_id,product_id")]),
    *BAD, "s_log", "s_fact_distinct")

# Expected values, written out here so that a wrong constant of the engine does not pass.
REQUIRED = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id", "product_name", "price"],
    "dim_date": ["date_key", "full_date", "year", "month", "month_name", "day", "quarter"],
    "fact_sales": ["transaction_id", "product_id", "date_key"],
    "bad_data_log": ["log_id", "etl_run_id", "source_system", "bad_column", "issue_type", "original_record"],
}
TEXT_WIDTHS = {
    "dim_customer": {"customer_id": 50, "customer_name": 255, "email": 320, "region": 50},
    "dim_product": {"product_id": 20, "product_name": 255, "category": 100},
    "dim_date": {"month_name": 20},
    "fact_sales": {"transaction_id": 20, "product_id": 20, "customer_id": 50, "region": 50},
    "bad_data_log": {"source_system": 50, "record_id": 100, "bad_column": 100, "issue_type": 50, "notes": 255},
}

ORACLE["check_not_null"] = sql("\nUNION ALL".join(
    f"\nSELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM {CHECKED[name]}" for name, columns in REQUIRED.items() for c in columns), *BAD, "s_log")


def _fk(name: str, parent: str, col: str) -> str:
    return f"""
SELECT '{name}' AS fk_name, COUNT(*) AS orphan_rows, COUNT(DISTINCT f.{col}) AS orphan_keys
FROM bad_fact f WHERE f.{col} IS NOT NULL AND f.{col} NOT IN (SELECT {col} FROM {parent} WHERE {col} IS NOT NULL)"""


ORACLE["check_fk_orphans"] = sql("\nUNION ALL".join([
    _fk("fk_customer", "bad_customer", "customer_id"), _fk("fk_product", "bad_product", "product_id"),
    _fk("fk_date", "bad_date", "date_key")]), *BAD)

ORACLE["check_ranges"] = sql("""
SELECT COUNT(*) FILTER (WHERE quantity < 0) AS negative_quantity,
       COUNT(*) FILTER (WHERE discount < 0) AS negative_discount, COUNT(*) AS rows_checked
FROM bad_fact""", "bad_fact")

ORACLE["check_widths"] = sql("\nUNION ALL".join(f"""
SELECT '{name}' AS table_name, '{c}' AS column_name, {n} AS max_width,
       COUNT(*) FILTER (WHERE length({c}) > {n}) AS over_width, CAST(max(length({c})) AS INTEGER) AS longest
FROM {CHECKED[name]}""" for name, limits in TEXT_WIDTHS.items() for c, n in limits.items()), *BAD, "s_log")

ORACLE["check_decimals"] = sql("""
SELECT 'dim_product' AS table_name, 'price' AS column_name, 10 AS precision, 2 AS scale,
       COUNT(*) FILTER (WHERE abs(round(price, 2)) >= 100000000) AS out_of_range FROM bad_product
UNION ALL
SELECT 'fact_sales', 'discount', 5, 2, COUNT(*) FILTER (WHERE abs(round(discount, 2)) >= 1000) FROM bad_fact""",
                               "bad_product", "bad_fact")

# ------------------------------------------------------------------ scalar functions
_pd = parse_date("date")
_num = number("price")
ORACLE["scalar_functions"] = sql(f"""
SELECT {strip('transaction_id')} AS txn_strip, lower({strip('customer_id')}) AS customer_lower,
       coalesce(category IN ('NaN', 'nan'), false) AS category_is_nan,
       coalesce(product_name, 'Unknown') AS name_or_unknown,
       {_num} AS price_number,
       CAST(round(CAST({_num} AS DECIMAL(10,2)) * 3, 1) AS DECIMAL(18,1)) AS price_x3_round1,
       TRY_CAST(quantity AS INTEGER) AS quantity_int,
       {_pd} AS parsed_date,
       strftime({_pd}, '%Y%m%d') AS date_yyyymmdd,
       monthname({_pd}) AS month_name,
       CAST(year({_pd}) AS INTEGER) AS d_year, CAST(month({_pd}) AS INTEGER) AS d_month,
       CAST(day({_pd}) AS INTEGER) AS d_day, CAST(quarter({_pd}) AS INTEGER) AS d_quarter,
       CAST(length(product_name) AS INTEGER) AS name_len,
       substr(product_name, 1, 5) AS name_sub5,
       CAST(instr(region, 'A') AS INTEGER) AS region_pos_a,
       replace(date, '-', '') AS date_no_dash,
       left(date, 4) AS date_left4,
       trim(region) AS region_trim
FROM raw_sales""", "raw_sales")


# ------------------------------------------------------------------ sources and streaming
ORACLE["src_sales_json"] = sql(f"SELECT {cols()} FROM raw_sales", "raw_sales")
ORACLE["src_flatten_product"] = sql(f"SELECT {cols()} FROM raw_sales", "raw_sales")
ORACLE["src_ordinal"] = sql(f"""
SELECT {cols()}, file_no, CAST(row_number() OVER (PARTITION BY file_no ORDER BY _ord) - 1 AS BIGINT) AS position
FROM (SELECT *, (_ord >> 35) // 5000 AS file_no FROM raw_sales)""", "raw_sales")
ORACLE["src_preview"] = sql(f"SELECT {cols()} FROM raw_sales ORDER BY _ord LIMIT 10", "raw_sales")
ORACLE["src_customers_json"] = sql("SELECT * FROM cust_src", "cust_src")
ORACLE["src_target_projection"] = sql("SELECT product_id, price FROM dim_product", "dim_product")
ORACLE["stream_incremental_load"] = sql("""
SELECT * FROM existing_fact UNION ALL SELECT * FROM s_fact_new""", "existing_fact", "s_fact_new")
