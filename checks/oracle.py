"""The same results in plain SQL, written from the meaning of each query and not from its plan."""

from __future__ import annotations

_COLUMNS = (
    "invoice_no, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
)
_KEY_ORDER = (
    "invoice_no NULLS LAST, stock_code NULLS LAST, invoice_date NULLS LAST, "
    "quantity NULLS LAST, customer_id NULLS LAST"
)

# Rules that several queries share.
_HAS_KEYS = "customer_id IS NOT NULL AND invoice_no IS NOT NULL AND stock_code IS NOT NULL"
_LACKS_KEYS = "customer_id IS NULL OR invoice_no IS NULL OR stock_code IS NULL"
_IS_RETURN = "invoice_no LIKE 'C%'"

# Each entry may refer to the ones it names in the first place.
_PARTS = {
    "base": ((), """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'c' ELSE '' END
                   || CAST(l_orderkey AS VARCHAR) AS invoice_no,
               CASE WHEN l_partkey % 401 = 0 THEN NULL
                    ELSE ' p' || CAST(l_partkey AS VARCHAR) || 'a' END AS stock_code,
               CASE WHEN l_partkey % 7 = 0 AND l_linenumber % 2 = 0 THEN NULL
                    WHEN l_linenumber % 3 = 0 THEN p_name || ' ' || lower(p_type)
                    ELSE '  ' || p_name || ' ' END AS description,
               CAST(CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END
                         AS INT) AS VARCHAR) AS quantity,
               CASE WHEN l_orderkey % 503 = 0 THEN NULL
                    ELSE substr(CAST(o_orderdate AS VARCHAR), 1, 10) || ' '
                         || lpad(CAST(8 + o_orderkey % 10 AS VARCHAR), 2, '0') || ':'
                         || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':00'
               END AS invoice_date,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || '5' AS unit_price,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL
                    ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               lower(n_name) AS country,
               l_partkey
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey
        JOIN nation ON n_nationkey = CASE WHEN o_orderkey % 7 = 0 THEN (c_nationkey + 1) % 25
                                          ELSE c_nationkey END"""),
    "raw": (("base",), f"""
        SELECT {_COLUMNS} FROM base
        UNION ALL
        SELECT ' ' || upper(invoice_no), upper(stock_code) || ' ', upper(description), quantity,
               invoice_date, CASE WHEN l_partkey % 26 = 0 THEN '1.005' ELSE unit_price END,
               customer_id, ' ' || country
        FROM base WHERE l_partkey % 13 = 0"""),
    "clean": (("raw",), """
        SELECT upper(trim(invoice_no)) AS invoice_no,
               upper(trim(stock_code)) AS stock_code,
               upper(trim(description)) AS description,
               CAST(quantity AS INT) AS quantity,
               CAST(invoice_date AS TIMESTAMP) AS invoice_date,
               CAST(CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(10,2)) AS unit_price,
               CAST(customer_id AS INT) AS customer_id,
               upper(trim(country)) AS country
        FROM raw"""),
    "valid": (("clean",), f"""
        SELECT DISTINCT ON (invoice_no, stock_code, invoice_date, quantity, customer_id) {_COLUMNS}
        FROM clean
        WHERE {_HAS_KEYS}
        ORDER BY {_KEY_ORDER}, description NULLS LAST, unit_price NULLS LAST, country NULLS LAST"""),
    "country_counts": (("valid",), """
        SELECT customer_id, country, CAST(count(*) AS BIGINT) AS orders_count
        FROM valid GROUP BY customer_id, country"""),
    "main_country": (("country_counts",), """
        SELECT customer_id, first(country ORDER BY orders_count DESC, country NULLS LAST) AS country
        FROM country_counts GROUP BY customer_id"""),
    "span": (("valid",), """
        SELECT customer_id, min(invoice_date) AS first_invoice, max(invoice_date) AS last_invoice
        FROM valid GROUP BY customer_id"""),
    "dim_customer": (("span", "main_country"), """
        SELECT customer_id, country, first_invoice, last_invoice
        FROM span JOIN main_country USING (customer_id)"""),
    "description_counts": (("valid",), """
        SELECT stock_code, description, CAST(count(*) AS BIGINT) AS cnt
        FROM valid GROUP BY stock_code, description"""),
    "dim_product": (("description_counts",), """
        SELECT stock_code, first(description ORDER BY cnt DESC, description NULLS LAST) AS description
        FROM description_counts GROUP BY stock_code"""),
    "dates": (("valid",), """
        SELECT DISTINCT invoice_date,
               CAST(extract(day FROM invoice_date) AS INT) AS day,
               CAST(extract(month FROM invoice_date) AS INT) AS month,
               CAST(extract(year FROM invoice_date) AS INT) AS year,
               CAST(extract(dow FROM invoice_date) AS INT) AS weekday
        FROM valid"""),
    "dim_date": (("dates",), """
        SELECT CAST(row_number() OVER (ORDER BY invoice_date NULLS LAST) AS INT) AS invoice_date_id,
               invoice_date, day, month, year, weekday
        FROM dates"""),
    "fact_sales": (("dim_date", "dim_product", "dim_customer"), f"""
        SELECT CAST(row_number() OVER (ORDER BY {_KEY_ORDER}) AS BIGINT) AS fact_id,
               invoice_no, stock_code, customer_id, invoice_date_id, quantity, unit_price,
               CAST(quantity * unit_price AS DECIMAL(10,2)) AS total_amount,
               {_IS_RETURN} AS return_flag
        FROM valid JOIN dim_date USING (invoice_date)
        WHERE stock_code IN (SELECT stock_code FROM dim_product)
          AND customer_id IN (SELECT customer_id FROM dim_customer)"""),
    "load_events": ((), """
        SELECT event_id AS seq,
               CASE event_id % 3 WHEN 0 THEN 'raw' WHEN 1 THEN 'staging' ELSE 'business' END AS layer,
               CAST(user_id AS VARCHAR) AS batch_id,
               event_type AS table_name,
               CASE event_id % 4 WHEN 0 THEN 'STARTED' WHEN 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE WHEN event_id % 4 IN (1, 2) THEN event_id * 10 END AS row_count,
               ts AS started_at,
               CASE WHEN event_id % 4 <> 0 THEN ts + to_milliseconds(event_id % 600000) END AS finished_at,
               CASE WHEN event_id % 4 = 3 THEN 'no reply' END AS error_message
        FROM events"""),
    "latest_events": (("load_events",), """
        SELECT * FROM load_events e
        WHERE seq = (SELECT max(seq) FROM load_events o
                     WHERE o.batch_id = e.batch_id AND o.layer = e.layer
                       AND o.table_name = e.table_name)"""),
}


def _needed(names: tuple[str, ...], found: list[str] | None = None) -> list[str]:
    found = [] if found is None else found
    for name in names:
        if name not in found:
            _needed(_PARTS[name][0], found)
            found.append(name)
    return found


def _sql(select: str, *parts: str) -> str:
    if not parts:
        return select
    blocks = ",\n".join(f"{name} AS ({_PARTS[name][1]})" for name in _needed(parts))
    return f"WITH {blocks}\n{select}"


def _all(part: str) -> str:
    return _sql(f"SELECT * FROM {part}", part)


_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{table}' AS table_name, 'SUCCESS' AS status, "
    f"CAST(count(*) AS BIGINT) AS row_count FROM {part}"
    for layer, table, part in (
        ("raw", "raw_orders", "raw"),
        ("staging", "stg_orders_raw_clean", "clean"),
        ("staging", "stg_orders_valid", "valid"),
        ("business", "dim_customer", "dim_customer"),
        ("business", "dim_product", "dim_product"),
        ("business", "dim_date", "dim_date"),
        ("business", "fact_sales", "fact_sales"),
    )
)

# The planted cells of each column, in order: text, what it means (NULL if nothing), why it is refused.
_PLANTED = """
    WITH quantity(n, cell, meant, fault) AS (VALUES
      (0, '12', 12, NULL), (1, '1.0', NULL, 'no whole number'), (2, 'x7', NULL, 'no whole number'),
      (3, '99999999999', NULL, 'out of range'), (4, ' 8 ', 8, NULL), (5, NULL, NULL, NULL),
      (6, '', NULL, 'no whole number')),
    invoice_date(n, cell, meant, fault) AS (VALUES
      (0, '2010-12-01', TIMESTAMP '2010-12-01 00:00:00', NULL), (1, '40513', NULL, 'no full date'),
      (2, '2010-12', NULL, 'no full date'), (3, '2010-13-01', NULL, 'no such date or time'),
      (4, '2010-12-01 25:00:00', NULL, 'no such date or time'),
      (5, '2010-12-01 08:26:00+05:00', NULL, 'no full date'), (6, NULL, NULL, NULL),
      (7, '2010-12-01 08:26:00', TIMESTAMP '2010-12-01 08:26:00', NULL),
      (8, '2010-12-01T08:26', TIMESTAMP '2010-12-01 08:26:00', NULL)),
    unit_price(n, cell, meant, fault) AS (VALUES
      (0, '2.50', CAST(2.50 AS DECIMAL(10,2)), NULL), (1, '1.005', 1.01, NULL), (2, '12,5', NULL, 'no number'),
      (3, '100000000', NULL, 'out of range'), (4, '1e3', 1000.00, NULL)),
    customer_id(n, cell, meant, fault) AS (VALUES
      (0, '7', 7, NULL), (1, '12a', NULL, 'no whole number'), (2, '-2147483649', NULL, 'out of range'),
      (3, NULL, NULL, NULL)),
    planted AS (
      SELECT l_orderkey, l_linenumber, q, d, p, c,
             concat_ws('; ', 'quantity: ' || q.cell || ': ' || q.fault, 'invoice_date: ' || d.cell || ': ' || d.fault,
                       'unit_price: ' || p.cell || ': ' || p.fault, 'customer_id: ' || c.cell || ': ' || c.fault) AS faults
      FROM lineitem
      JOIN quantity q ON q.n = (l_orderkey * 3 + l_linenumber) % 7
      JOIN invoice_date d ON d.n = (l_orderkey * 4 + l_linenumber) % 9
      JOIN unit_price p ON p.n = (l_orderkey * 5 + l_linenumber) % 5
      JOIN customer_id c ON c.n = (l_orderkey * 6 + l_linenumber) % 4)
"""

def _quarantined() -> str:
    """Where prices of customers that 7 divides are no numbers, their rows are not in the clean table."""
    whole = _sql(_COUNTS, "fact_sales")
    start = whole.index("clean AS (") + len("clean AS (")
    end = whole.index("),\nvalid AS (")
    kept = f"SELECT * FROM ({whole[start:end]}) WHERE coalesce(customer_id % 7 <> 0, true)"
    return f"""{whole[:start]}{kept}{whole[end:]}
        UNION ALL
        SELECT 'staging', 'stg_orders_refused', 'SUCCESS', CAST(count(*) AS BIGINT)
        FROM raw WHERE CAST(customer_id AS INT) % 7 = 0"""


def _unchanged(changed: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{table}' THEN '{columns}'" for table, columns in changed.items())
    by_table = f"CASE table_name {cases} ELSE '' END" if changed else "''"
    return _sql(f"""
        SELECT layer, table_name, row_count AS row_count_before, row_count, {by_table} AS changed
        FROM ({_COUNTS})""", "fact_sales")


ORACLE_SQL: dict[str, str] = {
    "colocated_star": _sql("SELECT * EXCLUDE (fact_id) FROM fact_sales", "fact_sales"),
    "stable_date_keys": _sql("""
        SELECT CAST(row_number() OVER (ORDER BY (invoice_date >= TIMESTAMP '1995-01-01') DESC NULLS LAST,
                                       invoice_date NULLS LAST) AS INT) AS invoice_date_id,
               invoice_date, day, month, year, weekday
        FROM dates""", "dates"),
    "catalog_star": _sql("""
        SELECT state, c.country, d.year, CAST(count(*) AS BIGINT) AS n_lines,
               CAST(sum(f.unit_price + cent) AS DECIMAL(18,2)) AS prices
        FROM fact_sales f JOIN dim_customer c USING (customer_id) JOIN dim_date d USING (invoice_date_id),
             (VALUES ('then', CAST(0 AS DECIMAL(3,2))), ('now', CAST(0.01 AS DECIMAL(3,2)))) states(state, cent)
        GROUP BY state, c.country, d.year""", "fact_sales"),
    "resumed_batch": _sql(f"""
        SELECT *, CAST(CASE layer WHEN 'business' THEN 2 ELSE 1 END AS BIGINT) AS n_starts FROM ({_COUNTS})""",
        "fact_sales"),
    "compacted_log": _sql("SELECT *, 1 AS n_files FROM latest_events", "latest_events"),
    "rejected_casts": _PLANTED + """
        SELECT l_orderkey, l_linenumber, q.cell AS quantity, d.cell AS invoice_date, p.cell AS unit_price,
               c.cell AS customer_id, faults
        FROM planted WHERE faults <> ''""",
    "accepted_casts": _PLANTED + """
        SELECT l_orderkey, l_linenumber, q.meant AS quantity, d.meant AS invoice_date, p.meant AS unit_price,
               c.meant AS customer_id
        FROM planted WHERE faults = ''""",
    "quarantined_batch": _quarantined(),
    "batch_durations": _sql(f"""
        SELECT layer, table_name, true AS took_time, true AS in_turn, true AS fits_batch
        FROM ({_COUNTS})""", "fact_sales"),
    "rerun_fingerprint": _unchanged({}),
    "changed_fingerprint": _unchanged({
        "raw_orders": "*,unit_price", "stg_orders_raw_clean": "*,unit_price", "stg_orders_valid": "*,unit_price",
        "fact_sales": "*,total_amount,unit_price",
    }),
    "rename_columns": _all("raw"),
    "normalize_nulls": """
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice_no,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS priority,
               CASE WHEN o_orderstatus = 'O' THEN '  '
                    WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status
        FROM orders""",
    "csv_roundtrip": _sql("""
        SELECT * REPLACE (CASE WHEN description IS NULL THEN ''
                               WHEN stock_code IS NULL
                                   THEN description || ', "new"' || chr(10) || 'line'
                               ELSE description END AS description)
        FROM raw""", "raw"),
    "json_roundtrip": _all("raw"),
    "parquet_roundtrip": _all("raw"),
    "raw_orders": _all("raw"),
    "write_table": _all("clean"),
    "row_counts": _sql(_COUNTS, "fact_sales"),
    "standardize_text": _sql("""
        SELECT * REPLACE (upper(trim(invoice_no)) AS invoice_no, upper(trim(stock_code)) AS stock_code,
                          upper(trim(description)) AS description, upper(trim(country)) AS country)
        FROM raw""", "raw"),
    "cast_strict": _sql("""
        SELECT * REPLACE (CAST(quantity AS INT) AS quantity,
                          CAST(invoice_date AS TIMESTAMP) AS invoice_date,
                          CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
                          CAST(customer_id AS INT) AS customer_id)
        FROM raw""", "raw"),
    "stg_orders_raw_clean": _all("clean"),
    "required_keys": _sql(f"SELECT * FROM clean WHERE {_HAS_KEYS}", "clean"),
    "rejected_rows": _sql(f"""
        SELECT *, concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id' END,
                                 CASE WHEN invoice_no IS NULL THEN 'invoice_no' END,
                                 CASE WHEN stock_code IS NULL THEN 'stock_code' END) AS reason
        FROM clean WHERE {_LACKS_KEYS}""", "clean"),
    "return_flag": _sql(
        f"SELECT *, coalesce({_IS_RETURN}, false) AS return_flag FROM clean", "clean"),
    "total_amount": _sql(
        "SELECT *, CAST(quantity * unit_price AS DECIMAL(10,2)) AS total_amount FROM clean", "clean"),
    "apply_defaults": _sql(f"""
        SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_stamped,
               CAST(1 AS BIGINT) AS n_load_times,
               CAST(count(*) FILTER ({_IS_RETURN}) AS BIGINT) AS n_returns,
               CAST(count(*) FILTER (NOT {_IS_RETURN}) AS BIGINT) AS n_sales
        FROM clean""", "clean"),
    "returns_only": _sql(f"SELECT * FROM clean WHERE {_IS_RETURN}", "clean"),
    "date_parts": """
        SELECT l_orderkey, l_linenumber, l_shipdate,
               CAST(extract(day FROM l_shipdate) AS INT) AS day,
               CAST(extract(month FROM l_shipdate) AS INT) AS month,
               CAST(extract(year FROM l_shipdate) AS INT) AS year,
               CAST(extract(dow FROM l_shipdate) AS INT) AS weekday
        FROM lineitem""",
    "stg_orders_valid": _all("valid"),
    "country_counts": _all("country_counts"),
    "customer_main_country": _all("main_country"),
    "customer_invoice_span": _all("span"),
    "description_counts": _all("description_counts"),
    "distinct_dates": _all("dates"),
    "top_n_per_group": _sql(f"""
        SELECT customer_id, position, invoice_no, stock_code, unit_price FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY customer_id
                ORDER BY unit_price DESC, {_KEY_ORDER}) AS INT) AS position
            FROM valid)
        WHERE position <= 3""", "valid"),
    "top_n_beyond_the_early_cut": _sql(f"""
        SELECT country, position, invoice_no, stock_code, unit_price FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY country
                ORDER BY unit_price DESC, {_KEY_ORDER}) AS INT) AS position
            FROM (SELECT * REPLACE (CASE WHEN quantity % 3 = 0 THEN 'HOT' ELSE country END AS country)
                  FROM valid WHERE unit_price IS NOT NULL))
        WHERE position <= 5000""", "valid"),
    "dim_customer": _all("dim_customer"),
    "dim_product": _all("dim_product"),
    "dim_date": _all("dim_date"),
    "lookup_date_key": _sql(
        "SELECT v.*, invoice_date_id FROM valid v JOIN dim_date d ON v.invoice_date = d.invoice_date",
        "dim_date"),
    "lookup": _sql(
        "SELECT v.*, p.description AS product FROM valid v JOIN dim_product p USING (stock_code)",
        "dim_product"),
    "lookup_product": _sql("""
        SELECT * FROM valid
        WHERE stock_code IN (SELECT stock_code FROM dim_product WHERE description IS NOT NULL)""",
        "dim_product"),
    "lookup_customer": _sql("""
        SELECT * FROM valid
        WHERE customer_id IN (SELECT customer_id FROM dim_customer WHERE country <> 'FRANCE')""",
        "dim_customer"),
    "fact_sales": _all("fact_sales"),
    "published_star": _sql("""
        SELECT f.* EXCLUDE (invoice_date_id), invoice_date, p.description AS product, c.country AS main_country
        FROM fact_sales f JOIN dim_date USING (invoice_date_id) JOIN dim_product p USING (stock_code)
        JOIN dim_customer c USING (customer_id)""", "fact_sales"),
    "raw_load_log": _sql("""
        SELECT 'raw_orders' AS table_name, 'SUCCESS' AS status,
               CAST(count(*) + second AS BIGINT) AS row_count, false AS refused
        FROM raw, (VALUES (0), (1)) batches(second) GROUP BY second""", "raw"),
    "staging_load_log": _sql("""
        SELECT 'stg_orders_raw_clean' AS table_name, 'SUCCESS' AS status,
               CAST(count(*) + second AS BIGINT) AS row_count, false AS refused
        FROM clean, (VALUES (0), (1)) batches(second) GROUP BY second
        UNION ALL
        SELECT 'stg_orders_valid', 'SUCCESS', CAST(count(*) + second AS BIGINT), false
        FROM valid, (VALUES (0), (1)) batches(second) GROUP BY second""", "valid"),
    "business_load_log": _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, 'SUCCESS' AS status, CAST(count(*) AS BIGINT) AS row_count, "
            f"false AS refused FROM {t} UNION ALL SELECT '{t}', 'FAILED', NULL, true"
            for t in ("dim_customer", "dim_product", "dim_date", "fact_sales")
        ),
        "fact_sales"),
    "pk_violations": """
        SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_violations": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_type <> 'PROMO')""",
    "null_violations": _sql(f"SELECT * FROM clean WHERE {_LACKS_KEYS}", "clean"),
    "length_violations": _sql("SELECT * FROM clean WHERE length(description) > 12", "clean"),
    "range_violations": """
        SELECT * FROM (
            SELECT l_orderkey, l_linenumber,
                   CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 10000 AS DECIMAL(18,2)) AS amount
            FROM lineitem)
        WHERE abs(amount) >= 100000000""",
    "bad_timestamps": """
        WITH planted AS (SELECT ['40513', '101201', '2010', '2010-12', '2010-12-01 08:26:00+05:00',
                                 '2010-13-01', '12/1/2010 8:26', NULL] AS cells)
        SELECT o_orderkey, cells[o_orderkey % 8 + 1] AS invoice_date FROM orders, planted
        WHERE o_orderkey % 3 = 0 AND cells[o_orderkey % 8 + 1] IS NOT NULL""",
    "audit_latest": _all("latest_events"),
    "stage_durations": _sql("""
        SELECT batch_id, layer, table_name, status,
               CAST(date_diff('microsecond', started_at, finished_at) / 1000000.0
                    AS DECIMAL(18,6)) AS seconds
        FROM latest_events WHERE finished_at IS NOT NULL""", "latest_events"),
}
