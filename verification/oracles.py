"""Expected results as DuckDB SQL, stated straight from the driver's tables.

Money is kept in integer cents. ``half_up(a, b)`` writes the half-up quotient
of non-negative integers; every division to a double comes last.
"""

from __future__ import annotations


def half_up(a: str, b: str) -> str:
    return f"((2 * ({a}) + ({b})) // (2 * ({b})))"


def money(cents: str) -> str:
    return f"CAST(({cents}) / 100.0 AS DOUBLE)"


def with_ctes(body: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} {body}"


ORDERS = """
base AS (
  SELECT o.*, c.c_mktsegment, r.r_name, o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS d,
    CAST(round(o.o_totalprice * 100) AS BIGINT) AS price_cents,
    concat('ORD-', lpad(CAST(o.o_orderkey AS VARCHAR), 9, '0')) AS order_id
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW = """
raw AS (
  SELECT *, FALSE AS stale FROM base
  UNION ALL SELECT *, TRUE AS stale FROM base WHERE k % 50 = 1)"""

SALES = f"""
sales AS (
  SELECT order_id, day AS order_date,
    concat('CLI-', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS customer_id,
    CASE WHEN k % 53 = 0 THEN 'NAO_CLASSIFICADO' ELSE c_mktsegment END AS product_category,
    CASE WHEN k % 59 = 0 THEN 'REGIAO_DESCONHECIDA' ELSE r_name END AS region,
    cents, CAST(k % 20 + 1 AS INTEGER) AS quantity, pct,
    {half_up('cents * (100 - pct)', '100')} AS net,
    CAST(year(day) AS INTEGER) AS order_year, CAST(month(day) AS INTEGER) AS order_month,
    CASE WHEN day IS NOT NULL THEN concat('Q', CAST(quarter(day) AS VARCHAR)) END AS order_quarter
  FROM (
    SELECT *, CASE WHEN k % 89 <> 0 THEN d END AS day,
      CASE WHEN k % 103 <> 0 THEN price_cents END AS cents,
      CASE WHEN k % 11 = 0 THEN 0 ELSE (k % 5) * 5 END AS pct
    FROM base WHERE k % 97 <> 0 AND k % 101 <> 0))"""

LINES = """
lines AS (
  SELECT l.*, CAST(o.o_orderdate AS DATE) AS d,
    CASE WHEN (l_orderkey * 7 + l_linenumber) % 20 <> 0 THEN CAST(1 + (l_partkey + l_linenumber)
      % [7, 7, 8, 10, 20][CAST(l_suppkey % 5 AS INTEGER) + 1] AS INTEGER) END AS lead,
    CASE WHEN l_returnflag IN ('R', 'A') THEN 'ENTREGUE'
         WHEN l_linestatus = 'F' THEN 'ATRASADO' ELSE 'EM_TRANSITO' END AS raw_status,
    concat('SHP-', lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 10, '0')) AS shipment_id,
    concat('ORD-', lpad(CAST(l_orderkey AS VARCHAR), 9, '0')) AS order_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def shipments(order: str) -> str:
    """Clean shipments when the kept copy is the first one in ``order``."""
    return f"""
shipments AS (
  SELECT shipment_id, order_id, d AS dispatch_date, CAST(d + lead AS DATE) AS delivery_date,
    concat('CARRIER-', CAST(l_suppkey % 5 AS VARCHAR)) AS carrier,
    CAST(l_quantity * 725 AS BIGINT) AS freight,
    CASE WHEN lead IS NULL THEN 'EM_TRANSITO' ELSE raw_status END AS status,
    lead AS delivery_lead_time_days, coalesce(lead <= 7, FALSE) AS delivered_on_time
  FROM lines
  QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY {order}) = 1)"""


NEWEST = shipments("l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice")
# Of two ingestion batches the current one is newer; then the raw text columns decide, nulls first.
BY_TEXT = shipments(
    "l_partkey % 2 DESC, CAST(d + lead AS DATE) NULLS FIRST, l_suppkey % 5, "
    "['são paulo', 'recife', 'manaus'][CAST(l_suppkey % 3 AS INTEGER) + 1], "
    "['goiânia', 'salvador'][CAST(l_partkey % 2 AS INTEGER) + 1], "
    "CAST(l_quantity * 7.25 AS VARCHAR), "
    "CASE raw_status WHEN 'ATRASADO' THEN 1 WHEN 'EM_TRANSITO' THEN 2 ELSE 3 END"
)

SHIPPING = f"""
shipping AS (
  SELECT order_id,
    {half_up('10 * sum(delivery_lead_time_days)', 'count(delivery_lead_time_days)')} AS tenths,
    sum(freight) AS freight, bool_or(delivered_on_time) AS on_time
  FROM shipments GROUP BY order_id)"""

SALES_COLUMNS = f"""
  order_id, order_date, customer_id, product_category, region, {money('cents')} AS sales_amount,
  quantity, CAST(pct AS DOUBLE) AS discount, {money('net')} AS net_sales_amount,
  order_year, order_month, order_quarter"""

LOGISTICS_COLUMNS = f"""
  shipment_id, order_id, dispatch_date, delivery_date, carrier, {money('freight')} AS freight_cost,
  status, delivery_lead_time_days, delivered_on_time"""

MONTHLY = """
monthly AS (
  SELECT region, order_year, order_month, sum(net) AS cents
  FROM sales GROUP BY region, order_year, order_month)"""


def growth(value: str, name: str) -> str:
    """Signed half-up growth in percent over the row before, two decimals."""
    window = "(PARTITION BY region ORDER BY order_year NULLS FIRST, order_month NULLS FIRST)"
    before = f"nullif(lag({value}) OVER {window}, 0)"
    change = f"({value} - lag({value}) OVER {window})"
    return (
        f"CAST(sign({change}) * {half_up(f'abs({change}) * 10000', before)} / 100.0 AS DOUBLE)"
        f" AS {name}"
    )


DATED = """
dated AS (
  SELECT l_orderkey, l_linestatus, CAST(o_orderdate AS DATE) AS ordered,
    CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_shipdate AS DATE) END AS shipped
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DAY_TEXT = """CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'not-a-date'
  WHEN k % 3 = 0 THEN strftime(d, '%Y-%m-%d') WHEN k % 3 = 1 THEN strftime(d, '%d/%m/%Y')
  ELSE strftime(d, '%m-%d-%Y') END"""

DISTINCT_CUSTOMERS = "count(DISTINCT customer_id)"


def _scalars() -> dict[str, str]:
    raw = (ORDERS, RAW)
    return {
        "scl_parse_money": with_ctes(
            f"""SELECT order_id, CASE WHEN stale THEN 1.0 WHEN k % 101 <> 0 AND k % 103 <> 0
                THEN {money('price_cents')} END AS sales_amount FROM raw""",
            *raw,
        ),
        "scl_parse_percent": with_ctes(
            """SELECT order_id, CASE WHEN k % 11 <> 0 THEN CAST((k % 5) * 5 AS DOUBLE) END
               AS discount FROM raw""",
            *raw,
        ),
        "scl_parse_int": """SELECT l_orderkey, l_linenumber,
            CASE WHEN l_linenumber NOT IN (4, 5) THEN
              CAST(trunc(l_extendedprice) AS INTEGER) * CASE WHEN l_linenumber = 3 THEN -1 ELSE 1 END
            END AS whole FROM lineitem""",
        "scl_parse_date": with_ctes(
            "SELECT order_id, CASE WHEN k % 97 <> 0 AND k % 89 <> 0 THEN d END AS order_date FROM raw",
            *raw,
        ),
        "scl_normalize_text": with_ctes(
            """SELECT order_id, CASE WHEN k % 59 <> 0 THEN r_name END AS region,
                 CASE WHEN k % 53 <> 0 THEN c_mktsegment END AS product_category,
                 concat('CLI-', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS customer_id,
                 concat('VEN-', CAST(k % 30 AS VARCHAR)) AS salesperson_id FROM raw""",
            *raw,
        ),
        "scl_fill_defaults": with_ctes(
            """SELECT order_id,
                 CASE WHEN k % 11 = 0 THEN 0.0 ELSE CAST((k % 5) * 5 AS DOUBLE) END AS discount,
                 CASE WHEN k % 53 = 0 THEN 'NAO_CLASSIFICADO' ELSE lower(c_mktsegment) END
                   AS product_category,
                 CASE WHEN k % 59 = 0 THEN 'REGIAO_DESCONHECIDA'
                   WHEN k % 2 = 0 THEN concat(' ', lower(r_name), '  ') ELSE r_name END AS region
               FROM raw""",
            *raw,
        ),
        "scl_net_amount": "SELECT l_orderkey, "
        + money(
            half_up(
                "CAST(round(l_extendedprice * 100) AS BIGINT)"
                " * (100 - CAST(round(l_discount * 100) AS BIGINT))",
                "100",
            )
        )
        + " AS net FROM lineitem",
        "scl_calendar": """SELECT l_orderkey, CAST(year(d) AS INTEGER) AS ship_year,
              CAST(month(d) AS INTEGER) AS ship_month,
              CASE WHEN d IS NOT NULL THEN concat('Q', CAST(quarter(d) AS VARCHAR)) END AS ship_quarter
            FROM (SELECT l_orderkey,
              CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_shipdate AS DATE) END AS d FROM lineitem)""",
        "scl_lead_days": with_ctes(
            "SELECT l_orderkey, CAST(shipped - ordered AS INTEGER) AS days FROM dated", DATED
        ),
        "scl_sla_flag": with_ctes(
            "SELECT l_orderkey, coalesce(shipped - ordered <= 90, FALSE) AS on_time FROM dated", DATED
        ),
        "scl_status_override": with_ctes(
            """SELECT l_orderkey,
               CASE WHEN shipped IS NULL THEN 'EM_TRANSITO' ELSE l_linestatus END AS status
               FROM dated""",
            DATED,
        ),
        "scl_band": """SELECT l_orderkey, CASE WHEN l_partkey % 13 = 0 THEN 'OK'
              WHEN l_quantity * 2 < 80 THEN 'ABAIXO_SLA' WHEN l_quantity * 2 < 95 THEN 'ATENCAO'
              ELSE 'OK' END AS band FROM lineitem""",
    }


def _filters_and_joins() -> dict[str, str]:
    raw = (ORDERS, RAW)
    clean = (ORDERS, SALES)
    shipped = (LINES, NEWEST)
    return {
        "flt_critical_not_null": with_ctes(
            f"""SELECT order_id, {DAY_TEXT} AS order_date, CAST(k % 20 + 1 AS VARCHAR) AS quantity
                FROM raw WHERE k % 97 <> 0 AND (stale OR k % 101 <> 0)""",
            *raw,
        ),
        "ded_latest_sales": with_ctes(
            f"""SELECT order_id,
                  concat(' cli-', lpad(CAST(o_custkey AS VARCHAR), 9, '0'), ' ') AS customer_id,
                  CASE WHEN k % 101 <> 0 AND k % 103 <> 0 THEN {money('price_cents')} END AS amount
                FROM base""",
            ORDERS,
        ),
        "ded_key_logistics": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              l_extendedprice, l_returnflag FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_partkey, l_suppkey, l_extendedprice, l_returnflag) = 1""",
        "jon_left_sales_logistics": with_ctes(
            f"""SELECT order_id, region, {money('net')} AS net_sales_amount,
                  CAST(tenths / 10.0 AS DOUBLE) AS avg_lead_time,
                  {money('freight')} AS total_freight_cost, on_time AS delivered_on_time
                FROM sales LEFT JOIN shipping USING (order_id)""",
            *clean, *shipped, SHIPPING,
        ),
        "jon_preagg": """SELECT o_orderkey AS orderkey, o_orderpriority, lines, quantity, last_flag
            FROM orders LEFT JOIN (
              SELECT l_orderkey, count(l_partkey) AS lines, sum(l_quantity) AS quantity,
                max(l_returnflag) AS last_flag FROM lineitem GROUP BY l_orderkey)
            ON o_orderkey = l_orderkey""",
        "agg_bool_or": with_ctes(
            """SELECT order_id, bool_or(delivered_on_time) AS delivered_on_time
               FROM shipments GROUP BY order_id""",
            *shipped,
        ),
        "agg_count_distinct": with_ctes(
            f"""SELECT region, product_category, count(DISTINCT order_id) AS orders,
                  {DISTINCT_CUSTOMERS} AS customers FROM sales GROUP BY region, product_category""",
            *clean,
        ),
        "agg_first_by": with_ctes(
            """SELECT order_id, carrier AS primary_carrier, status AS shipment_status FROM shipments
               QUALIFY row_number() OVER (
                 PARTITION BY order_id ORDER BY dispatch_date, shipment_id) = 1""",
            *shipped,
        ),
        "agg_ratio": with_ctes(
            f"""SELECT region, order_year,
                  {money(half_up('sum(net)', DISTINCT_CUSTOMERS))} AS revenue_per_customer
                FROM sales GROUP BY region, order_year""",
            *clean,
        ),
        "agg_rate": with_ctes(
            f"""SELECT carrier,
                  {money(half_up('10000 * count_if(delivered_on_time)', 'count(*)'))} AS on_time_pct
                FROM shipments GROUP BY carrier""",
            *shipped,
        ),
        "agg_row_count": 'SELECT count(*) AS "rows" FROM lineitem',
    }


def _windows() -> dict[str, str]:
    monthly = (ORDERS, SALES, MONTHLY)
    month = "region, order_year, order_month"
    total = "sum(cents) OVER (PARTITION BY order_year, order_month)"
    return {
        "win_rank": with_ctes(
            f"""SELECT {month}, {money('cents')} AS revenue, CAST(rank() OVER (
                  PARTITION BY order_year, order_month ORDER BY cents DESC NULLS LAST) AS INTEGER)
                AS place FROM monthly""",
            *monthly,
        ),
        "win_rank_spread": """SELECT l_orderkey, l_linestatus, l_extendedprice AS price,
              rank() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice DESC NULLS LAST)
                AS place FROM lineitem""",
        "win_mom_growth": with_ctes(
            f"SELECT {month}, {money('cents')} AS revenue, {growth('cents', 'growth_pct')} FROM monthly",
            *monthly,
        ),
        "win_share": with_ctes(
            f"""SELECT {month}, {money('cents')} AS revenue,
                  {money(half_up('10000 * cents', f'nullif({total}, 0)'))} AS share_pct FROM monthly""",
            *monthly,
        ),
        "win_share_spread": with_ctes(
            f"""SELECT o_orderkey, o_orderstatus, {money('cents')} AS price,
                  CAST({half_up(
                      '100000000 * CAST(cents AS HUGEINT)',
                      'sum(cents) OVER (PARTITION BY o_orderstatus)')} / 1000000.0 AS DOUBLE)
                  AS share_pct FROM priced""",
            "priced AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)",
        ),
        "srt_preview": with_ctes(
            f"""SELECT order_id, {money('net')} AS net_sales_amount FROM sales
                ORDER BY net DESC NULLS LAST, order_id LIMIT 5""",
            ORDERS, SALES,
        ),
    }


def _quality() -> dict[str, str]:
    raw = (ORDERS, RAW)
    nulls = {
        "order_id": "0",
        "order_date": "count_if(k % 97 = 0)",
        "customer_id": "0",
        "product_id": "0",
        "product_category": "count_if(k % 53 = 0)",
        "region": "count_if(k % 59 = 0)",
        "sales_amount": "count_if(k % 101 = 0 AND NOT stale)",
        "quantity": "0",
        "discount": "count_if(k % 11 = 0)",
        "salesperson_id": "0",
        "_ingestion_timestamp": "0",
    }
    counted = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS total, CAST({n} AS BIGINT) AS nulls FROM raw"
        for c, n in nulls.items()
    )
    return {
        "dq_null_gate": with_ctes(
            """SELECT count(*) AS total, CAST(count_if(k % 59 = 0) AS BIGINT) AS null_critical,
                 CAST(count_if(k % 59 = 0) AS DOUBLE) / count(*) * 100 AS null_pct,
                 CAST(count_if(k % 59 = 0) AS DOUBLE) / count(*) * 100 <= 5 AS passed FROM raw""",
            *raw,
        ),
        "dq_profile": with_ctes(
            """SELECT *, CAST(nulls AS DOUBLE) / total * 100 AS null_pct,
                 CAST(nulls AS DOUBLE) / total * 100 > 5 AS flagged FROM counted""",
            *raw, f"counted AS ({counted})",
        ),
        "dq_dedup_stats": """SELECT count(*) AS "rows",
              count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
              count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "dq_rejected": with_ctes(
            """SELECT order_id, concat_ws(',',
                 CASE WHEN k % 101 = 0 THEN 'missing:sales_amount' END,
                 CASE WHEN k % 97 = 0 THEN 'missing:order_date' END,
                 CASE WHEN k % 101 <> 0 AND k % 103 = 0 THEN 'unreadable:sales_amount' END,
                 CASE WHEN k % 97 <> 0 AND k % 89 = 0 THEN 'unreadable:order_date' END) AS reasons
               FROM base WHERE k % 101 = 0 OR k % 97 = 0 OR k % 103 = 0 OR k % 89 = 0""",
            ORDERS,
        ),
    }


def _tables() -> dict[str, str]:
    stored = """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice, l_returnflag
        FROM lineitem"""
    return {
        "src_csv": with_ctes(
            f"""SELECT order_id, {DAY_TEXT} AS order_date,
                  concat(' cli-', lpad(CAST(o_custkey AS VARCHAR), 9, '0'), ' ') AS customer_id,
                  CASE WHEN k % 53 <> 0 THEN lower(c_mktsegment) END AS product_category,
                  CASE WHEN k % 59 = 0 THEN NULL
                    WHEN k % 2 = 0 THEN concat(' ', lower(r_name), '  ') ELSE r_name END AS region,
                  CAST(k % 20 + 1 AS VARCHAR) AS quantity, FALSE AS corrupt FROM raw""",
            ORDERS, RAW,
        ),
        "src_json": with_ctes(
            """SELECT shipment_id, order_id,
                 strftime(CAST(d + lead AS DATE), '%Y-%m-%d') AS delivery_date,
                 concat(' carrier-', CAST(l_suppkey % 5 AS VARCHAR)) AS carrier,
                 ['são paulo', 'recife', 'manaus'][CAST(l_suppkey % 3 AS INTEGER) + 1] AS origin_city,
                 CAST(l_quantity * 725 AS BIGINT) / 100.0 AS freight_cost,
                 CASE WHEN raw_status = 'ENTREGUE' THEN 'entregue' ELSE raw_status END AS status,
                 FALSE AS corrupt FROM lines""",
            LINES,
        ),
        "src_table": """SELECT l_orderkey, l_linenumber, l_quantity,
              lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS code FROM lineitem""",
        "snk_append_merge_schema": """SELECT o_orderkey, o_orderstatus,
              CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders
            UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders""",
        "snk_overwrite_roundtrip": with_ctes(f"SELECT {SALES_COLUMNS} FROM sales", ORDERS, SALES),
        "mnt_compact": stored,
        "mnt_zorder": stored,
        "mnt_orphan_files": "SELECT 'v1' AS version, count(*) AS orphan_rows FROM orders",
        "prj_audit": """SELECT o_orderkey, 'bronze' AS _layer, CAST(2024 AS INTEGER) AS _year,
              '2024-01-02 00:00:00' AS ingested, TRUE AS from_orders FROM orders""",
        "pip_bronze": with_ctes(
            """SELECT 'sales' AS source, order_id AS id,
                 CASE WHEN stale THEN '2024-01-01' ELSE '2024-01-02' END AS ingested,
                 'bronze' AS _layer, CAST(2024 AS INTEGER) AS _year FROM raw
               UNION ALL SELECT 'logistics', shipment_id,
                 CASE WHEN l_partkey % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END, 'bronze', 2024 FROM lines""",
            ORDERS, RAW, LINES,
        ),
    }


REGION_SELECT = f"""
  SELECT region, order_year, order_month, order_quarter, {money('net_c')} AS total_net_revenue,
    {money('gross_c')} AS total_gross_revenue, {money(half_up('gross_c', 'priced'))} AS avg_order_value,
    {money(half_up('100 * pct', 'n'))} AS avg_discount_pct, total_units_sold, total_orders,
    unique_customers, {money(half_up('net_c', 'nullif(unique_customers, 0)'))} AS revenue_per_customer,
    CAST(rank() OVER (PARTITION BY order_year, order_month ORDER BY net_c DESC NULLS LAST) AS INTEGER)
      AS region_rank_by_revenue,
    {growth('net_c', 'mom_growth_pct')}
  FROM (
    SELECT region, order_year, order_month, order_quarter, sum(net) AS net_c, sum(cents) AS gross_c,
      nullif(count(cents), 0) AS priced, sum(pct) AS pct, count(pct) AS n,
      CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT order_id) AS total_orders,
      {DISTINCT_CUSTOMERS} AS unique_customers
    FROM sales GROUP BY ALL)"""

CATEGORY_SELECT = f"""
  SELECT product_category, order_year, order_quarter, {money('net_c')} AS total_net_revenue,
    {money(half_up('net_c', 'priced'))} AS avg_net_revenue_per_order,
    {money(half_up('100 * pct', 'n'))} AS avg_discount_pct, total_units_sold, total_orders,
    unique_customers,
    {money(half_up(
        '10000 * net_c', 'nullif(sum(net_c) OVER (PARTITION BY order_year, order_quarter), 0)'))}
      AS revenue_share_pct
  FROM (
    SELECT product_category, order_year, order_quarter, sum(net) AS net_c,
      nullif(count(net), 0) AS priced, sum(pct) AS pct, count(pct) AS n,
      CAST(sum(quantity) AS BIGINT) AS total_units_sold, count(DISTINCT order_id) AS total_orders,
      {DISTINCT_CUSTOMERS} AS unique_customers
    FROM sales GROUP BY ALL)"""

CARRIER_SELECT = f"""
  SELECT carrier, status, total_shipments,
    CAST({half_up('10 * days', 'nullif(timed, 0)')} / 10.0 AS DOUBLE) AS avg_lead_time_days,
    min_lead_time_days, max_lead_time_days, {money('on_time')} AS on_time_delivery_rate_pct,
    {money('freight_c')} AS total_freight_cost,
    {money(half_up('freight_c', 'total_shipments'))} AS avg_freight_cost_per_shipment,
    CASE WHEN on_time < 8000 THEN 'ABAIXO_SLA' WHEN on_time < 9500 THEN 'ATENCAO' ELSE 'OK' END
      AS carrier_performance_flag
  FROM (
    SELECT carrier, status, count(*) AS total_shipments, sum(delivery_lead_time_days) AS days,
      count(delivery_lead_time_days) AS timed, min(delivery_lead_time_days) AS min_lead_time_days,
      max(delivery_lead_time_days) AS max_lead_time_days,
      {half_up('10000 * count_if(delivered_on_time)', 'count(*)')} AS on_time,
      sum(freight) AS freight_c
    FROM shipments GROUP BY ALL)"""

EXECUTIVE_SELECT = f"""
  SELECT region, order_year, order_month, order_quarter, {money('net_c')} AS total_net_revenue,
    total_orders, unique_customers, total_units_sold,
    {money(half_up('100 * pct', 'n'))} AS avg_discount_pct,
    CAST({half_up('tenths', 'nullif(timed, 0)')} / 10.0 AS DOUBLE) AS avg_delivery_lead_time,
    {money('freight_c')} AS total_freight_cost,
    {money(half_up('10000 * on_time', 'total_orders'))} AS on_time_delivery_rate_pct,
    {money(half_up('10000 * freight_c', 'nullif(net_c, 0)'))} AS freight_cost_as_pct_revenue
  FROM (
    SELECT region, order_year, order_month, order_quarter, sum(net) AS net_c,
      count(DISTINCT order_id) AS total_orders, {DISTINCT_CUSTOMERS} AS unique_customers,
      CAST(sum(quantity) AS BIGINT) AS total_units_sold, sum(pct) AS pct, count(pct) AS n,
      sum(tenths) AS tenths, count(tenths) AS timed, sum(freight) AS freight_c,
      CASE WHEN count(on_time) > 0 THEN count_if(on_time) END AS on_time
    FROM sales LEFT JOIN shipping USING (order_id) GROUP BY ALL)"""


def _plans() -> dict[str, str]:
    clean, shipped = (ORDERS, SALES), (LINES, NEWEST)
    month = "order_year * 12 + order_month"
    gold = f"""
        SELECT 'sales_by_region' AS gold_table, region AS label, {month} AS period,
          total_net_revenue AS money, total_orders AS items FROM by_region
        UNION ALL SELECT 'sales_by_category', product_category,
          order_year * 4 + CAST(substr(order_quarter, 2) AS INTEGER), total_net_revenue, total_orders
          FROM by_category
        UNION ALL SELECT 'logistics_kpi', carrier, CAST(length(status) AS INTEGER),
          total_freight_cost, total_shipments FROM by_carrier
        UNION ALL SELECT 'executive_summary', region, {month}, total_freight_cost, total_units_sold
          FROM executive"""
    return {
        "pip_sales_clean": with_ctes(f"SELECT {SALES_COLUMNS} FROM sales", *clean),
        "pip_silver": with_ctes(f"SELECT {SALES_COLUMNS} FROM sales", *clean),
        "pip_logistics_clean": with_ctes(f"SELECT {LOGISTICS_COLUMNS} FROM shipments", *shipped),
        "pip_silver_logistics": with_ctes(
            f"SELECT {LOGISTICS_COLUMNS} FROM shipments", LINES, BY_TEXT
        ),
        "kpi_sales_by_region": with_ctes(REGION_SELECT, *clean),
        "kpi_sales_by_category": with_ctes(CATEGORY_SELECT, *clean),
        "kpi_logistics": with_ctes(CARRIER_SELECT, *shipped),
        "kpi_executive_summary": with_ctes(EXECUTIVE_SELECT, *clean, *shipped, SHIPPING),
        "pip_gold": with_ctes(
            gold, *clean, *shipped, SHIPPING,
            f"by_region AS ({REGION_SELECT})", f"by_category AS ({CATEGORY_SELECT})",
            f"by_carrier AS ({CARRIER_SELECT})", f"executive AS ({EXECUTIVE_SELECT})",
        ),
    }


VERSIONS = """
first AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents, 10 AS version FROM orders),
changes AS (
  SELECT k, CASE WHEN k % 97 = 1 THEN CAST(day + INTERVAL 2 MONTH AS DATE) ELSE day END AS day,
    CASE WHEN k % 97 = 3 THEN cents ELSE 2 * cents END AS cents,
    CASE k % 97 WHEN 0 THEN 5 WHEN 3 THEN 10 ELSE 11 END AS version FROM first WHERE k % 97 < 5),
arrived AS (
  SELECT * FROM first WHERE k % 97 <> 4 UNION ALL SELECT * FROM changes
  UNION ALL SELECT k, day, 100, 12 FROM changes WHERE k % 97 = 1),
newest AS (SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY k ORDER BY version DESC) = 1)"""


def _incremental() -> dict[str, str]:
    clean, shipped = (ORDERS, SALES), (LINES, NEWEST)
    kept = "k % 97 <> 0 AND k % 101 <> 0"
    gates = f"""
      SELECT 'sales' AS name, (SELECT count(*) FROM raw) AS read, count_if(stale) AS duplicates,
        (SELECT count(*) FROM base WHERE NOT ({kept})) AS rejected,
        count_if({kept} AND NOT stale) AS total,
        count_if({kept} AND NOT stale AND (k % 103 = 0 OR k % 89 = 0)) AS null_critical,
        count_if({kept} AND NOT stale AND (k % 103 = 0 OR k % 89 = 0))
          <= 0.01 * count_if({kept} AND NOT stale) AS passed FROM raw
      UNION ALL SELECT 'logistics', (SELECT count(*) FROM lines),
        (SELECT count(*) FROM lines) - count(*), 0, count(*), 0, TRUE FROM shipments"""
    gold_rows = " UNION ALL ".join(
        f"SELECT '{t}' AS gold_table, count(*) AS n FROM ({q})"
        for t, q in (
            ("executive_summary", EXECUTIVE_SELECT), ("logistics_kpi", CARRIER_SELECT),
            ("sales_by_category", CATEGORY_SELECT), ("sales_by_region", REGION_SELECT),
        )
    )
    heavy = "CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE {} END"
    return {
        "pip_silver_gate": with_ctes(
            f"SELECT name, CAST(read AS BIGINT) AS read, CAST(duplicates AS BIGINT) AS duplicates, CAST(rejected AS BIGINT) AS rejected,"
            f" CAST(total AS BIGINT) AS total, CAST(null_critical AS BIGINT) AS null_critical, passed FROM ({gates})",
            ORDERS, RAW, LINES, BY_TEXT,
        ),
        "pip_gold_region": with_ctes(REGION_SELECT, *clean),
        "pip_gold_category": with_ctes(CATEGORY_SELECT, *clean),
        "pip_gold_logistics": with_ctes(CARRIER_SELECT, *shipped),
        "pip_gold_executive": with_ctes(EXECUTIVE_SELECT, *clean, *shipped, SHIPPING),
        "kpi_refresh": with_ctes(REGION_SELECT, *clean),
        "kpi_refresh_category": with_ctes(CATEGORY_SELECT, *clean),
        "kpi_refresh_executive": with_ctes(EXECUTIVE_SELECT, *clean, *shipped, SHIPPING),
        "kpi_executive_colocated": with_ctes(EXECUTIVE_SELECT, *clean, *shipped, SHIPPING),
        "cch_gold_cached": with_ctes(gold_rows, *clean, *shipped, SHIPPING),
        "prj_layer_stamp": """SELECT o_orderkey, 'silver' AS _layer, '2024-01-01 00:00:00' AS ingested,
              '2024-01-02 00:00:00' AS refined FROM orders""",
        "src_session": """SELECT o_orderkey,
              strftime(epoch_ms(CAST(o_orderkey AS BIGINT) * 86400000 + 3600000), '%Y-%m-%d %H:%M') AS moment,
              'UTC|true|true' AS settings FROM orders""",
        "snk_upsert": f"""WITH {VERSIONS}
            SELECT k, day, {money('cents')} AS price, version, CAST(year(day) AS INTEGER) AS order_year,
              CAST(month(day) AS INTEGER) AS order_month FROM newest""",
        "agg_distinct_sketch": with_ctes(
            f"""SELECT region, order_year, {DISTINCT_CUSTOMERS} AS customers, TRUE AS in_band
                FROM sales WHERE order_year IS NOT NULL GROUP BY ALL""",
            *clean,
        ),
        "jon_heavy": f"""SELECT CAST(x.s_suppkey AS BIGINT) AS s_suppkey, l_orderkey, l_linenumber, s_name
            FROM (SELECT *, {heavy.format('l_suppkey')} AS s_suppkey FROM lineitem) x LEFT JOIN supplier s ON x.s_suppkey = s.s_suppkey""",
        "jon_heavy_salted": f"""SELECT CAST(x.p_partkey AS BIGINT) AS p_partkey, p_name, count(*) AS n
            FROM (SELECT *, {heavy.format('l_partkey')} AS p_partkey FROM lineitem) x JOIN part p ON x.p_partkey = p.p_partkey
            GROUP BY ALL""",
        "mnt_skip_files": """SELECT l_orderkey, l_linenumber, l_partkey, TRUE AS complete, TRUE AS fewer FROM lineitem
            WHERE l_partkey BETWEEN 1 AND 40 AND l_orderkey <= (SELECT min(l_orderkey) + (max(l_orderkey) - min(l_orderkey)) // 4 FROM lineitem)""",
        "src_json_split": r"""SELECT CAST(c_custkey AS VARCHAR) AS shipment_id, concat('}"{,\[', c_name, chr(10), ']"') AS order_id,
              c_mktsegment AS carrier, CAST(NULL AS VARCHAR) AS status, FALSE AS corrupt FROM customer
            UNION ALL SELECT NULL, NULL, NULL, 'first', FALSE""",
        "src_rescued": """SELECT CASE WHEN k % 13 <> 0 AND k % 5 <> 0 THEN CAST(k AS VARCHAR) END AS shipment_id,
              CASE WHEN k % 13 <> 0 AND k % 3 <> 2 THEN c_name END AS carrier, CAST(NULL AS VARCHAR) AS status,
              CASE WHEN k % 13 <> 0 AND (k % 11 = 0 OR k % 7 = 0) THEN concat('{',
                concat_ws(',', CASE WHEN k % 11 = 0 THEN concat('"segment":"', c_mktsegment, '"') END,
                  CASE WHEN k % 7 = 0 THEN '"status":{"x":1}' END), '}') END AS rescued,
              CASE WHEN k % 13 = 0 THEN concat('{broken ', CAST(k AS VARCHAR)) END AS _corrupt_record
            FROM (SELECT *, c_custkey AS k FROM customer)""",
        "src_conform": """SELECT o_orderkey, o_orderstatus, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority,
              CAST(NULL AS VARCHAR) AS o_note FROM orders""",
    }


def oracle_sql() -> dict[str, str]:
    quality = _quality()
    return {
        **_scalars(),
        **_filters_and_joins(),
        **_windows(),
        **quality,
        "pip_silver_rejected": quality["dq_rejected"],
        **_tables(),
        **_plans(),
        **_incremental(),
    }
