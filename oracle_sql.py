"""Independent DuckDB statements of every registered query (the correctness oracle).

Each statement is one CTE chain over the pre-registered source views
(customer, nation, part, orders, lineitem, events): extracts -> bronze ->
silver -> staging -> snapshot -> marts -> checks, written in plain SQL.
Column names and types are aligned with the Spark results (counts BIGINT,
money DECIMAL(38,2), calendar parts INTEGER).
"""

from __future__ import annotations

# ---- fixed values of the fixture (same as the Spark side) --------------------
BATCHES_SQL = """batches(b, extract_date, ingested_at) AS (
  VALUES (1, DATE '1995-01-01', TIMESTAMP '1995-01-01 01:00:00'),
         (2, DATE '1997-01-01', TIMESTAMP '1997-01-01 01:00:00'),
         (3, DATE '1999-01-01', TIMESTAMP '1999-01-01 01:00:00'))"""
SILVER_RULES = [
    ("customers", "not_null", "customer_id", None),
    ("customers", "unique", "customer_id", None),
    ("customers", "in_set", "segment", ("SMB", "MID", "ENT")),
    ("customers", "not_null", "city", None),
    ("products", "not_null", "product_id", None),
    ("products", "unique", "product_id", None),
    ("products", "in_set", "category", ("HW", "SW", "ACC")),
    ("orders", "not_null", "order_id", None),
    ("orders", "unique", "order_id", None),
    ("orders", "not_null", "customer_id", None),
    ("orders", "in_set", "status", ("NEW", "PAID", "SHIPPED", "CANCELLED", "REFUNDED")),
    ("order_items", "not_null", "order_item_id", None),
    ("order_items", "unique", "order_item_id", None),
    ("order_items", "between", "quantity", 1),
]
GOLD_RULES = [
    ("dim_customer", "not_null", "customer_sk", None),
    ("dim_customer", "unique", "customer_sk", None),
    ("dim_customer", "not_null", "customer_id", None),
    ("dim_product", "not_null", "product_sk", None),
    ("dim_product", "unique", "product_sk", None),
    ("dim_date", "not_null", "date_day", None),
    ("dim_date", "unique", "date_day", None),
    ("fact_sales", "not_null", "order_item_id", None),
    ("fact_sales", "unique", "order_item_id", None),
    ("fact_sales", "not_null", "customer_sk", None),
    ("fact_sales", "relationships", "customer_sk", ("dim_customer", "customer_sk")),
    ("fact_sales", "relationships", "product_sk", ("dim_product", "product_sk")),
    ("fact_sales", "not_null", "amount", None),
    ("fact_sales", "in_set", "status", ("NEW", "PAID", "SHIPPED", "CANCELLED", "REFUNDED")),
]
# -------------------------------------------------------------------------------


def _chain(p: str = "", variant: str = "clean") -> list[tuple[str, str]]:
    """CTEs of one pipeline run; every name carries the prefix ``p``."""
    early = "" if variant == "early_new_orders" else \
        "WHERE NOT (o_custkey % 50 = 49 AND o_orderdate < TIMESTAMP '1997-01-01')"
    return [
        (f"{p}bronze_customers", f"""
  SELECT x.c_custkey AS customer_id, x.c_name AS name,
         CASE (x.c_custkey + x.ch) % 3 WHEN 0 THEN ' smb' WHEN 1 THEN 'Mid ' ELSE ' ENT ' END AS segment,
         CASE WHEN (x.c_custkey + x.b) % 20 = 7 THEN NULL ELSE x.n_name END AS city,
         CASE WHEN x.b >= 3 AND x.c_custkey % 10 IN (3, 6) THEN '1999-01-01'
              WHEN (x.b >= 2 AND x.c_custkey % 10 = 3) OR x.c_custkey % 50 = 49 THEN '1997-01-01'
              ELSE '1995-01-01' END || ' 00:00:00' AS updated_at,
         bt.extract_date AS _extract_date, bt.ingested_at AS _ingested_at
  FROM (SELECT c.c_custkey, c.c_name, n.n_name, bt.b,
               (CASE WHEN bt.b >= 2 AND c.c_custkey % 10 = 3 THEN 1 ELSE 0 END
                + CASE WHEN bt.b >= 3 AND c.c_custkey % 10 IN (3, 6) THEN 1 ELSE 0 END) AS ch
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
        CROSS JOIN batches bt
        CROSS JOIN (VALUES (1), (2)) cp(copy_no)
        WHERE NOT (bt.b = 1 AND c.c_custkey % 50 = 49)
          AND (cp.copy_no = 1 OR c.c_custkey % 50 = 10)) x
  JOIN batches bt ON bt.b = x.b"""),
        (f"{p}bronze_products", """
  SELECT p_partkey AS product_id, p_name AS name,
         CASE p_partkey % 3 WHEN 0 THEN 'HW' WHEN 1 THEN 'SW' ELSE 'ACC' END AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         bt.extract_date AS _extract_date, bt.ingested_at AS _ingested_at
  FROM part CROSS JOIN batches bt"""),
        (f"{p}orders_keyed", f"""
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
         CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1
              WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END AS b
  FROM orders {early}"""),
        (f"{p}bronze_orders", f"""
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 100 = 33 THEN -1 - o_custkey ELSE o_custkey END AS customer_id,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_ts,
         CASE WHEN o_orderkey % 100 = 17 THEN NULL
              WHEN o_orderstatus = 'P' THEN 'PAID'
              WHEN o_orderstatus = 'F' THEN 'SHIPPED'
              ELSE CASE o_orderkey % 3 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'REFUNDED' ELSE 'NEW' END
         END AS status,
         bt.extract_date AS _extract_date, bt.ingested_at AS _ingested_at
  FROM {p}orders_keyed ok JOIN batches bt ON bt.b = ok.b"""),
        (f"{p}bronze_order_items", f"""
  SELECT l.l_orderkey * 10 + l.l_linenumber AS order_item_id, l.l_orderkey AS order_id,
         l.l_partkey AS product_id,
         CASE WHEN l.l_partkey % 100 = 0 THEN CAST(0 AS BIGINT)
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS BIGINT) END AS quantity,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS unit_price,
         bt.extract_date AS _extract_date, bt.ingested_at AS _ingested_at
  FROM lineitem l JOIN {p}orders_keyed ok ON l.l_orderkey = ok.o_orderkey
  JOIN batches bt ON bt.b = ok.b"""),
        (f"{p}clean_customers", f"""
  FROM {p}bronze_customers
  SELECT * REPLACE (upper(trim(segment)) AS segment, coalesce(city, 'UNKNOWN') AS city)"""),
        (f"{p}silver_customers", _newest(f"{p}clean_customers", "customer_id",
                                         ["updated_at DESC NULLS LAST", "name", "segment", "city"])),
        (f"{p}silver_products", _newest(f"{p}bronze_products", "product_id", ["name", "category", "unit_price"])),
        (f"{p}silver_orders", f"""
  FROM ({_newest(f"{p}bronze_orders", "order_id", ["customer_id", "order_ts", "status"])})
  SEMI JOIN {p}silver_customers USING (customer_id) WHERE status IS NOT NULL"""),
        (f"{p}silver_order_items", f"""
  FROM ({_newest(f"{p}bronze_order_items", "order_item_id", ["product_id", "quantity", "unit_price"])})
  SEMI JOIN {p}silver_orders USING (order_id)
  SEMI JOIN {p}silver_products USING (product_id) WHERE quantity > 0"""),
        (f"{p}stg_orders", f"""
  SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id,
         CAST(order_ts AS TIMESTAMP) AS order_ts, CAST(status AS VARCHAR) AS status
  FROM {p}silver_orders"""),
        (f"{p}stg_order_items", f"""
  SELECT CAST(order_item_id AS BIGINT) AS order_item_id, CAST(order_id AS BIGINT) AS order_id,
         CAST(product_id AS BIGINT) AS product_id, CAST(quantity AS INTEGER) AS quantity,
         CAST(unit_price AS DECIMAL(12,2)) AS unit_price
  FROM {p}silver_order_items"""),
        (f"{p}stg_products", f"""
  SELECT CAST(product_id AS BIGINT) AS product_id, CAST(name AS VARCHAR) AS name,
         CAST(category AS VARCHAR) AS category, CAST(unit_price AS DECIMAL(12,2)) AS unit_price
  FROM {p}silver_products"""),
        # snapshot: each customer's batches replayed one by one against its open version
        (f"{p}customer_batches", f"""
  SELECT * REPLACE (updated_at::TIMESTAMP AS updated_at),
         row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at) AS nth
  FROM ({_newest(f"{p}clean_customers", "customer_id, _ingested_at",
                 ["updated_at DESC NULLS LAST", "name", "segment", "city"])})"""),
        (f"{p}replay", f"""
  SELECT customer_id, nth, updated_at AS open_since, true AS opens FROM {p}customer_batches WHERE nth = 1
  UNION ALL
  SELECT b.customer_id, b.nth, CASE WHEN b.updated_at > r.open_since THEN b.updated_at ELSE r.open_since END,
         coalesce(b.updated_at > r.open_since, false)
  FROM {p}replay r JOIN {p}customer_batches b ON b.customer_id = r.customer_id AND b.nth = r.nth + 1"""),
        (f"{p}customer_snapshot", f"""
  SELECT customer_id, name, segment, city, updated_at,
         md5(customer_id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, updated_at AS valid_from,
         (SELECT min(later.open_since) FROM {p}replay later
          WHERE later.opens AND later.customer_id = v.customer_id AND later.nth > v.nth) AS valid_to
  FROM {p}customer_batches v JOIN {p}replay USING (customer_id, nth) WHERE opens"""),
        (f"{p}dim_customer", _dim_customer_sql(f"{p}customer_snapshot")),
        (f"{p}dim_product", f"""
  SELECT product_id AS product_sk, product_id, name, category, unit_price FROM {p}stg_products"""),
        (f"{p}dim_date", f"""
  SELECT CAST(d AS DATE) AS date_day, CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         dayname(d) AS weekday
  FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d
        FROM (SELECT CAST(min(order_ts) AS DATE) AS lo, CAST(max(order_ts) AS DATE) AS hi
              FROM {p}stg_orders) b
        WHERE lo IS NOT NULL) s"""),
        (f"{p}fact_sales", _fact_sql(p, f"{p}dim_customer")),
    ]


def _dim_customer_sql(snapshot: str) -> str:
    return f"""
  SELECT scd_id AS customer_sk, customer_id, name, segment, city,
         valid_from, valid_to, (valid_to IS NULL) AS is_current
  FROM {snapshot}"""


def _newest(rel: str, keys: str, ties: list[str]) -> str:
    """The row of each key that was ingested last, ties in the given order (nulls first unless it says otherwise)."""
    order = ", ".join(["_ingested_at DESC NULLS LAST", *[t if " " in t else f"{t} NULLS FIRST" for t in ties]])
    lineage = "_extract_date" if "_ingested_at" in keys else "_extract_date, _ingested_at"
    return f"""
  SELECT * EXCLUDE ({lineage}) FROM (
    SELECT unnest(pick) FROM (SELECT first(r ORDER BY {order}) AS pick FROM {rel} r GROUP BY {keys}))"""


def _fact_sql(p: str, dim: str, open_upper: bool = True) -> str:
    until = "ifnull(valid_to, 'infinity'::TIMESTAMP)" if open_upper else "valid_to"
    return f"""
  SELECT order_item_id, order_id, customer_sk, product_id AS product_sk, order_ts::DATE AS date_day,
         quantity, unit_price, (quantity * unit_price)::DECIMAL(14,2) AS amount, status
  FROM {p}stg_order_items
  JOIN (SELECT order_id, order_ts, status, customer_sk
        FROM {p}stg_orders placed
        LEFT JOIN (SELECT customer_id AS owner, customer_sk, valid_from AS since, {until} AS until FROM {dim}) version
          ON owner = customer_id AND since <= order_ts AND until > order_ts) resolved USING (order_id)"""


def _with(final: str, extra: list[tuple[str, str]] | None = None,
          variants: tuple[str, ...] = ()) -> str:
    ctes = [("batches", None)] + _chain()
    for v in variants:
        ctes += _chain("e_", v)
    ctes += extra or []
    parts = [BATCHES_SQL] + [f"{n} AS ({sql}\n)" for n, sql in ctes if sql is not None]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final


TABLES = ("customers", "products", "orders", "order_items")


def _lineage_counts() -> str:
    return _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, _extract_date AS extract_date, _ingested_at AS ingested_at, "
        f"count(*) AS rows FROM bronze_{t} GROUP BY 2, 3" for t in TABLES))


def _history() -> str:
    return _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, "
        f"CAST(row_number() OVER (ORDER BY ingested_at, extract_date) - 1 AS BIGINT) AS version, "
        f"extract_date, ingested_at, rows FROM (SELECT _extract_date AS extract_date, "
        f"_ingested_at AS ingested_at, count(*) AS rows FROM bronze_{t} GROUP BY 1, 2) c"
        for t in TABLES))


def _version() -> str:
    return _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(DISTINCT _ingested_at) - 1 AS version, "
        f"count(*) AS rows FROM bronze_{t}" for t in TABLES))


def _rule_sql(table_sql: str, table: str, kind: str, col: str, arg) -> str:
    head = f"SELECT '{table}' AS table_name, '{kind}' AS rule, '{col}' AS column_name, "
    if kind == "not_null":
        body = f"count(*) FILTER (WHERE {col} IS NULL)"
        return f"{head}CAST({body} AS BIGINT) AS violations FROM {table_sql}"
    if kind == "in_set":
        vals = ", ".join(f"'{v}'" for v in arg)
        body = f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}))"
        return f"{head}CAST({body} AS BIGINT) AS violations FROM {table_sql}"
    if kind == "between":
        body = f"count(*) FILTER (WHERE {col} IS NOT NULL AND {col} < {arg})"
        return f"{head}CAST({body} AS BIGINT) AS violations FROM {table_sql}"
    if kind == "unique":
        return (f"{head}CAST(coalesce(sum(n), 0) AS BIGINT) AS violations FROM "
                f"(SELECT {col}, count(*) AS n FROM {table_sql} WHERE {col} IS NOT NULL "
                f"GROUP BY {col} HAVING count(*) > 1) d")
    if kind == "relationships":
        ref, field = arg
        return (f"{head}CAST(count(*) AS BIGINT) AS violations FROM {table_sql} t "
                f"WHERE t.{col} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {ref} r WHERE r.{field} = t.{col})")
    raise ValueError(kind)


def _report(rules, name_of, kinds=None, extra_cols: str = "") -> str:
    sel = [_rule_sql(name_of(t), t, k, c, a) for t, k, c, a in rules
           if kinds is None or k in kinds]
    return (f"SELECT {extra_cols}*, violations = 0 AS success FROM ("
            + " UNION ALL ".join(sel) + ") r")


def _contract_kind(kind: str) -> str:
    return _with(_report(SILVER_RULES, lambda t: f"silver_{t}", kinds={kind}))


def _suite_report() -> str:
    dirty = ("silver_customers_bogus", """
  SELECT * FROM silver_customers UNION ALL
  SELECT customer_id, name, 'BOGUS' AS segment, city, updated_at FROM silver_customers
  WHERE customer_id = (SELECT min(customer_id) FROM silver_customers)""")
    clean = _report(SILVER_RULES, lambda t: f"silver_{t}", extra_cols="'clean' AS variant, ")
    bad = _report(SILVER_RULES,
                  lambda t: "silver_customers_bogus" if t == "customers" else f"silver_{t}",
                  extra_cols="'bogus_segment' AS variant, ")
    return _with(f"{clean} UNION ALL {bad}", extra=[dirty])


def _model_tests() -> str:
    rep = _report(GOLD_RULES, lambda t: t)
    scd = """
  SELECT 'dim_customer' AS table_name, 'one_current_version' AS rule, 'customer_id' AS column_name,
         CAST(count(*) FILTER (WHERE open_n > 1) AS BIGINT) AS violations,
         count(*) FILTER (WHERE open_n > 1) = 0 AS success
  FROM (SELECT customer_id, count(*) FILTER (WHERE is_current) AS open_n FROM dim_customer GROUP BY 1) k
  UNION ALL
  SELECT 'dim_customer', 'has_current_version', 'customer_id',
         CAST(count(*) FILTER (WHERE open_n = 0) AS BIGINT),
         count(*) FILTER (WHERE open_n = 0) = 0
  FROM (SELECT customer_id, count(*) FILTER (WHERE is_current) AS open_n FROM dim_customer GROUP BY 1) k"""
    return _with(f"{rep} UNION ALL {scd}")


def _twice(rel: str, hit: str, replaced: str) -> str:
    """Rows of ``rel``, those that meet ``hit`` twice, with some columns replaced."""
    return f"""
  SELECT * REPLACE ({replaced})
  FROM (SELECT * FROM {rel} UNION ALL SELECT * FROM {rel} WHERE {hit})"""


def _contract_faults() -> str:
    faults = [
        ("bad_customers", _twice("silver_customers", "customer_id % 79 = 4", """
      if(customer_id % 89 = 3, 'BOGUS', segment) AS segment, if(customer_id % 83 = 2, NULL, city) AS city,
      if(customer_id % 97 = 5, NULL, customer_id) AS customer_id""")),
        ("bad_products", _twice("silver_products", "product_id % 67 = 3", """
      if(product_id % 71 = 1, 'XX', category) AS category, if(product_id % 73 = 2, NULL, product_id) AS product_id""")),
        ("bad_orders", _twice("silver_orders", "order_id % 47 = 4", """
      if(order_id % 61 = 1, 'LOST', status) AS status, if(order_id % 59 = 2, NULL, customer_id) AS customer_id,
      if(order_id % 53 = 3, NULL, order_id) AS order_id""")),
        ("bad_order_items", _twice("silver_order_items", "order_item_id % 37 = 3", """
      if(order_item_id % 43 = 1, 0, quantity) AS quantity,
      if(order_item_id % 41 = 2, NULL, order_item_id) AS order_item_id""")),
    ]
    return _with(_report(SILVER_RULES, lambda t: f"bad_{t}"), extra=faults)


def _model_faults() -> str:
    faults = [
        ("bad_dim_customer", _twice("dim_customer", "customer_id % 29 = 2", """
      if(customer_id % 31 = 1, NULL, customer_sk) AS customer_sk,
      CASE WHEN customer_id % 23 = 4 THEN true WHEN customer_id % 19 = 5 THEN false ELSE is_current END AS is_current,
      if(customer_id % 37 = 3, NULL, customer_id) AS customer_id""")),
        ("bad_dim_product", _twice("dim_product", "product_sk % 29 = 2", """
      if(product_sk % 31 = 1, NULL, product_sk) AS product_sk""")),
        ("bad_dim_date", _twice("dim_date", "day = 2", "if(day = 1, NULL, date_day) AS date_day")),
        ("bad_fact_sales", _twice("fact_sales", "order_item_id % 37 = 3", """
      CASE WHEN order_item_id % 31 = 4 THEN NULL WHEN order_item_id % 29 = 5 THEN 'nobody'
           ELSE customer_sk END AS customer_sk,
      if(order_item_id % 23 = 6, -1, product_sk) AS product_sk, if(order_item_id % 19 = 7, NULL, amount) AS amount,
      if(order_item_id % 17 = 8, 'LOST', status) AS status,
      if(order_item_id % 41 = 2, NULL, order_item_id) AS order_item_id""")),
    ]
    rules = [(t, k, c, (f"bad_{a[0]}", a[1]) if k == "relationships" else a) for t, k, c, a in GOLD_RULES]
    open_versions = "(SELECT customer_id, count_if(is_current) AS n FROM bad_dim_customer GROUP BY 1)"
    scd = " UNION ALL ".join(
        f"SELECT 'dim_customer', '{rule}', 'customer_id', count_if({bad})::BIGINT, count_if({bad}) = 0 FROM {open_versions}"
        for rule, bad in (("one_current_version", "n > 1"), ("has_current_version", "n = 0")))
    return _with(f"{_report(rules, lambda t: f'bad_{t}')} UNION ALL {scd}", extra=faults)


def _validity_faults() -> str:
    return _with("""
  SELECT count(*) AS checked_rows, count_if(NOT inside)::BIGINT AS violations
  FROM (SELECT day >= valid_from::DATE AND day < ifnull(valid_to::DATE, DATE '9999-12-31') AS inside
        FROM (SELECT customer_sk, if(order_item_id % 11 = 0, date_day - 4000, date_day) AS day FROM fact_sales)
        JOIN dim_customer USING (customer_sk))""")


def _swapped_amounts() -> str:
    extra = [("swapped", """
  SELECT f.order_item_id,
         CASE WHEN f.order_id % 97 = 5 AND f.order_item_id % 10 = 1 THEN coalesce(p.b, f.amount)
              WHEN f.order_id % 97 = 5 AND f.order_item_id % 10 = 2 THEN coalesce(p.a, f.amount)
              ELSE f.amount END AS amount
  FROM fact_sales f LEFT JOIN (
    SELECT x.order_id, x.amount AS a, y.amount AS b FROM fact_sales x JOIN fact_sales y
      ON x.order_id = y.order_id AND x.order_item_id % 10 = 1 AND y.order_item_id % 10 = 2) p
    ON p.order_id = f.order_id"""),
             ("plain", """
  SELECT order_item_id, (quantity * unit_price)::DECIMAL(14,2) AS amount FROM stg_order_items""")]
    return _with("""
  SELECT *, 1::BIGINT AS surplus FROM (FROM swapped EXCEPT ALL FROM plain)
  UNION ALL SELECT *, -1::BIGINT FROM (FROM plain EXCEPT ALL FROM swapped)""", extra=extra)


def _stored_inspect() -> str:
    parts = [f"SELECT 'bronze' AS layer, '{t}' AS table_name, 2::BIGINT AS version, count(*) AS rows FROM bronze_{t}"
             for t in TABLES]
    parts += [f"SELECT 'silver', '{t}', NULL, count(*) FROM silver_{t}" for t in TABLES]
    parts += [f"SELECT 'gold', '{t}', NULL, count(*) FROM {t}"
              for t in ("customer_snapshot", "dim_customer", "dim_product", "dim_date", "fact_sales")]
    return _with(" UNION ALL ".join(parts))


def _batch_lines() -> str:
    lines = _newest("bronze_order_items", "order_item_id", ["product_id", "quantity", "unit_price"])
    return _with(f"""
SELECT substr(o.order_ts, 1, 7) AS month, count(DISTINCT l.order_id) AS orders, count(*) AS lines
FROM ({lines}) l JOIN bronze_orders o USING (order_id)
WHERE o._extract_date = DATE '1997-01-01' GROUP BY 1""")


def _metrics_sql(fact: str, items: str, dim: str, cust: str, label: str | None = None) -> str:
    lab = f"'{label}' AS variant, " if label else ""
    return f"""
  SELECT {lab}m.*,
         revenue_drift >= 0.005 AS revenue_break,
         fact_rows <> silver_items AS rows_break,
         dim_current <> silver_customers AS current_break,
         unresolved_customer_sk > 0 AS unresolved_break,
         multi_current_versions > 0 AS multi_current_break,
         CAST((revenue_drift >= 0.005)::INT + (fact_rows <> silver_items)::INT
              + (dim_current <> silver_customers)::INT + (unresolved_customer_sk > 0)::INT
              + (multi_current_versions > 0)::INT AS INTEGER) AS n_breaks,
         NOT (revenue_drift >= 0.005 OR fact_rows <> silver_items
              OR dim_current <> silver_customers OR unresolved_customer_sk > 0
              OR multi_current_versions > 0) AS ok
  FROM (
    SELECT f.fact_revenue, s.silver_revenue,
           CAST(abs(round(f.fact_revenue - s.silver_revenue, 2)) AS DECIMAL(38,2)) AS revenue_drift,
           f.fact_rows, s.silver_items, d.dim_current, c.silver_customers,
           f.unresolved_customer_sk, mc.multi_current_versions
    FROM (SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(38,2)) AS fact_revenue,
                 count(*) AS fact_rows,
                 count(*) FILTER (WHERE customer_sk IS NULL) AS unresolved_customer_sk
          FROM {fact}) f,
         (SELECT CAST(coalesce(sum(quantity * unit_price), 0) AS DECIMAL(38,2)) AS silver_revenue,
                 count(*) AS silver_items FROM {items}) s,
         (SELECT count(*) FILTER (WHERE is_current) AS dim_current FROM {dim}) d,
         (SELECT count(*) AS silver_customers FROM {cust}) c,
         (SELECT count(*) AS multi_current_versions FROM
            (SELECT customer_id FROM {dim} WHERE is_current GROUP BY 1 HAVING count(*) > 1) x) mc
  ) m"""


def _recon_metrics() -> str:
    return _with(_metrics_sql("fact_sales", "silver_order_items", "dim_customer",
                              "silver_customers"))


def _reopened() -> list[tuple[str, str]]:
    return [
        ("snap_reopen", """
  SELECT * REPLACE (CASE WHEN customer_id = k.k AND valid_from = k.v THEN NULL
                         ELSE valid_to END AS valid_to)
  FROM customer_snapshot,
       (SELECT min(customer_id) AS k,
               (SELECT min(valid_from) FROM customer_snapshot
                WHERE valid_to IS NOT NULL AND customer_id =
                  (SELECT min(customer_id) FROM customer_snapshot WHERE valid_to IS NOT NULL)) AS v
        FROM customer_snapshot WHERE valid_to IS NOT NULL) k"""),
        ("d_reopen", _dim_customer_sql("snap_reopen")),
    ]


def _reopened_sweep() -> str:
    return _with("""
  SELECT o.order_id, o.customer_id, o.order_ts, d.customer_sk
  FROM stg_orders o LEFT JOIN d_reopen d
    ON d.customer_id = o.customer_id AND d.valid_from <= o.order_ts
   AND ifnull(d.valid_to, TIMESTAMP '9999-12-31') > o.order_ts""", extra=_reopened())


def _recon_breaks() -> str:
    extra = [
        ("f_drop", """
  SELECT * FROM fact_sales WHERE order_item_id NOT IN
    (SELECT order_item_id FROM fact_sales ORDER BY order_item_id LIMIT 3)"""),
        ("f_nudge", """
  SELECT * REPLACE (CASE WHEN order_item_id = (SELECT min(order_item_id) FROM fact_sales)
                         THEN CAST(amount + 0.01 AS DECIMAL(14,2)) ELSE amount END AS amount)
  FROM fact_sales"""),
        ("d_drop", """
  SELECT * FROM dim_customer WHERE NOT (is_current AND customer_id =
    (SELECT min(customer_id) FROM dim_customer WHERE is_current))"""),
        ("f_no_open_end", _fact_sql("", "dim_customer", open_upper=False)),
        *_reopened(),
        ("f_reopen", _fact_sql("", "d_reopen")),
    ]
    sel = [
        _metrics_sql("fact_sales", "silver_order_items", "dim_customer", "silver_customers", "clean"),
        _metrics_sql("f_drop", "silver_order_items", "dim_customer", "silver_customers",
                     "drop_fact_rows"),
        _metrics_sql("f_nudge", "silver_order_items", "dim_customer", "silver_customers",
                     "nudge_amount"),
        _metrics_sql("fact_sales", "silver_order_items", "d_drop", "silver_customers",
                     "drop_current_dim_row"),
        _metrics_sql("e_fact_sales", "e_silver_order_items", "e_dim_customer",
                     "e_silver_customers", "early_new_orders"),
        _metrics_sql("f_no_open_end", "silver_order_items", "dim_customer", "silver_customers",
                     "no_open_end"),
        _metrics_sql("f_reopen", "silver_order_items", "d_reopen", "silver_customers",
                     "reopen_closed_version"),
    ]
    return _with(" UNION ALL ".join(sel), extra=extra, variants=("early_new_orders",))


def _silver_as_of() -> str:
    until = "WHERE _ingested_at <= TIMESTAMP '1997-01-01 01:00:00'"
    extra = [("a_orders", f"FROM bronze_orders {until}"), ("a_customers", f"FROM bronze_customers {until}")]
    return _with(f"""
  FROM ({_newest("a_orders", "order_id", ["customer_id", "order_ts", "status"])})
  SEMI JOIN a_customers USING (customer_id) WHERE status IS NOT NULL""", extra=extra)


def _refine_stats() -> str:
    return _with(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, b.n AS bronze_rows, s.n AS kept, b.n - s.n AS dropped "
        f"FROM (SELECT count(*) AS n FROM bronze_{t}) b, (SELECT count(*) AS n FROM silver_{t}) s"
        for t in TABLES))


def _version_accounting() -> str:
    return _with("""
  SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_versions,
         CAST(coalesce(sum(c), 0) AS BIGINT) AS current_versions,
         count(*) FILTER (WHERE n > 1) AS changed_keys,
         CAST(coalesce(max(n), 0) AS BIGINT) AS max_versions
  FROM (SELECT customer_id, count(*) AS n, count(*) FILTER (WHERE is_current) AS c
        FROM dim_customer GROUP BY 1) k""")


def _pit_events() -> str:
    return """
WITH v AS (
  SELECT event_id AS signup_event_id, user_id, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM events WHERE event_type = 'signup'),
p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, p.ts, p.value, v.signup_event_id
FROM p LEFT JOIN v ON v.user_id = p.user_id AND p.ts >= v.valid_from
                  AND p.ts < coalesce(v.valid_to, TIMESTAMP '9999-12-31')"""


def _validity_audit() -> str:
    return _with("""
  SELECT count(*) AS checked_rows, count(*) - count(*) FILTER (inside) AS violations
  FROM (SELECT date_day >= valid_from::DATE AND (valid_to IS NULL OR date_day < valid_to::DATE) AS inside
        FROM fact_sales JOIN dim_customer USING (customer_sk))""")


def _layer_inspect() -> str:
    parts = [f"SELECT 'bronze' AS layer, '{t}' AS table_name, count(*) AS rows FROM bronze_{t}"
             for t in TABLES]
    parts += [f"SELECT 'silver', '{t}', count(*) FROM silver_{t}" for t in TABLES]
    parts += [f"SELECT 'gold', '{t}', count(*) FROM {t}"
              for t in ("customer_snapshot", "dim_customer", "dim_product", "dim_date",
                        "fact_sales")]
    return _with(" UNION ALL ".join(parts))


def _revenue_by_status() -> str:
    return _with("""
  SELECT status, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units,
         CAST(sum(amount) AS DECIMAL(38,2)) AS revenue,
         count(*) FILTER (WHERE customer_sk IS NULL) AS unresolved
  FROM fact_sales GROUP BY status""")


def oracle_sql() -> dict[str, str]:
    sel = lambda rel: _with(f"SELECT * FROM {rel}")
    return {
        "bronze_lineage_counts": _lineage_counts(),
        "bronze_history": _history(),
        "bronze_version": _version(),
        "silver_customers": sel("silver_customers"),
        "silver_products": sel("silver_products"),
        "silver_orders": sel("silver_orders"),
        "silver_order_items": sel("silver_order_items"),
        "silver_as_of": _silver_as_of(),
        "refine_stats": _refine_stats(),
        "staged_orders": sel("stg_orders"),
        "staged_items": sel("stg_order_items"),
        "scd2_rebuild": sel("customer_snapshot"),
        "scd2_incremental": sel("customer_snapshot"),
        "scd2_version_accounting": _version_accounting(),
        "dim_customer": sel("dim_customer"),
        "dim_product": sel("dim_product"),
        "dim_date": sel("dim_date"),
        "fact_sales": sel("fact_sales"),
        "pit_events": _pit_events(),
        "pit_validity_audit": _validity_audit(),
        "pit_reopened_sweep": _reopened_sweep(),
        "contract_not_null": _contract_kind("not_null"),
        "contract_unique": _contract_kind("unique"),
        "contract_in_set": _contract_kind("in_set"),
        "contract_between": _contract_kind("between"),
        "contract_suite_report": _suite_report(),
        "model_test_report": _model_tests(),
        "contract_faults": _contract_faults(),
        "model_test_faults": _model_faults(),
        "pit_validity_faults": _validity_faults(),
        "recon_swapped_amounts": _swapped_amounts(),
        "stored_bronze_counts": _lineage_counts(),
        "stored_inspect": _stored_inspect(),
        "stored_batch_lines": _batch_lines(),
        "stored_revenue_sql": _revenue_by_status(),
        "backfill_dim_customer": sel("dim_customer"),
        "backfill_fact_sales": sel("fact_sales"),
        "backfill_silver_items": sel("silver_order_items"),
        "backfill_refine_stats": _refine_stats(),
        "backfill_recon": _recon_metrics(),
        "recon_metrics": _recon_metrics(),
        "recon_breaks": _recon_breaks(),
        "layer_inspect": _layer_inspect(),
        "revenue_by_status": _revenue_by_status(),
    }
