"""The same answers as plain SQL over the given tables, for an independent engine to check.

Nothing here is used by the Spark code. Fragments are written per table and put together per query.
"""

from __future__ import annotations

from tidemark.operators.generate import CATALOG

TABLES = ("customers", "products", "orders", "order_items", "payments")
TYPE_ONE = TABLES[1:]

COLUMNS = {
    "customers": {"customer_id": 255, "name": 255, "signup_date": "date"},
    "products": {"product_id": 255, "name": 255, "category": 255, "price": "money"},
    "orders": {"order_id": 255, "customer_id": 255, "order_date": "date", "status": 50},
    "order_items": {
        "order_id": 255,
        "product_id": 255,
        "quantity": "money",
        "unit_price": "money",
        "total": "money",
    },
    "payments": {
        "payment_id": 255,
        "method": 50,
        "order_id": 255,
        "order_date": "date",
        "total": "money",
        "payment_date": "date",
    },
}
KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id", "product_id"],
    "payments": ["payment_id", "order_id"],
}
PAYLOADS = {t: [c for c in COLUMNS[t] if c not in KEYS[t]] for t in TABLES}
DATED = {
    "customers": ["signup_date"],
    "orders": ["order_date"],
    "payments": ["payment_date", "order_date"],
}
NEGATIVE = {
    "products": ("negative_price", ["price"]),
    "order_items": ("negative_values", ["quantity", "unit_price", "total"]),
    "payments": ("negative_total", ["total"]),
}
# The hard rows, those with every tenth order missing, and those with the tenth and moved orders only, are batches too.
HARD, EARLY, LATER = 3, 4, 5
AS_OF = {1: "2024-01-01", 2: "2024-01-02", HARD: "2024-01-01", EARLY: "2024-01-01", LATER: "2024-01-02"}


def _roles(batch: int, extras: bool = False) -> str:
    if batch == 2:
        return "(role = 'base' AND k % 3 = 0) OR (role = 'new' AND k % 50 = 0)"
    if extras:
        return "role = 'base' OR (role = 'copy' AND k % 20 = 0) OR (role = 'late' AND k % 33 = 0)"
    return "role = 'base'"


def _with_roles(source: str, batch: int, extras: bool = False) -> str:
    return f"""
        SELECT *, CASE WHEN role = 'new' THEN k + 1000000 ELSE k END AS kk,
               {"role = 'base' AND k % 6 = 0" if batch == 2 else "false"} AS changed
        FROM ({source}) s
        JOIN (VALUES ('base'), ('copy'), ('late'), ('new')) AS r(role) ON {_roles(batch, extras)}
    """


def _lineage(table: str, batch: int) -> str:
    day = AS_OF[batch]
    return f"""
        CASE WHEN role = 'late' THEN TIMESTAMP '{day} 01:00:00'
             ELSE TIMESTAMP '{day} 00:00:00' END AS created_at_bronze,
        '{batch}/{table}_' || CASE WHEN role = 'late' THEN 'late' ELSE 'raw' END || '.csv'
            AS source_file_id
    """


def _customers(batch: int) -> str:
    rows = _with_roles("SELECT c_custkey AS k, c_name FROM customer", batch, extras=True)
    return f"""
        SELECT CASE WHEN role = 'new' THEN 'C' || kk
                    WHEN k % 97 = 0 THEN NULL
                    WHEN k % 89 = 0 THEN '   '
                    WHEN k % 7 = 0 THEN '  C' || kk || ' '
                    ELSE 'C' || kk END AS customer_id,
               CASE WHEN k % 53 = 0 THEN NULL
                    WHEN role = 'late' THEN c_name || ' v2'
                    WHEN changed THEN c_name || ' changed'
                    ELSE c_name END AS name,
               CASE WHEN k % 61 = 0 THEN '22/10/2013'
                    WHEN k % 59 = 0 THEN '2024-13-01'
                    WHEN k % 71 = 0 THEN '2031-01-01'
                    ELSE CAST(DATE '2013-10-22' + CAST(k * 37 % 3000 AS INTEGER) AS VARCHAR) END
                    AS signup_date,
               {_lineage("customers", batch)}
        FROM ({rows})
    """


def _products(batch: int) -> str:
    rows = _with_roles(
        "SELECT p_partkey AS k, p_name, p_type, CAST(p_retailprice AS DECIMAL(10,2)) AS listed FROM part",
        batch,
    )
    return f"""
        SELECT 'P' || kk AS product_id, p_name AS name, p_type AS category,
               CASE WHEN k % 41 = 0 THEN '-1.00'
                    WHEN k % 43 = 0 THEN NULL
                    WHEN k % 47 = 0 THEN 'abc'
                    WHEN changed THEN CAST(CAST(listed + 1.00 AS DECIMAL(10,2)) AS VARCHAR)
                    ELSE CAST(listed AS VARCHAR) END AS price,
               {_lineage("products", batch)}
        FROM ({rows})
    """


def _orders(batch: int) -> str:
    rows = _with_roles(
        "SELECT o_orderkey AS k, o_custkey, o_orderstatus,"
        " CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS ordered FROM orders",
        batch,
    )
    return f"""
        SELECT 'O' || kk AS order_id, 'C' || o_custkey AS customer_id,
               CASE WHEN k % 83 = 0 THEN '2014-12-31'
                    WHEN k % 79 = 0 THEN '2031-01-01'
                    ELSE CAST(ordered AS VARCHAR) END AS order_date,
               CASE WHEN k % 101 = 0 THEN NULL
                    WHEN changed THEN 'Cancelled'
                    ELSE CASE o_orderstatus WHEN 'O' THEN 'Completed' WHEN 'F' THEN 'completed'
                         ELSE 'Pending' END END AS status,
               {_lineage("orders", batch)}
        FROM ({rows})
    """


LINES = """
    SELECT l_orderkey AS k, l_partkey, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
           CASE WHEN (7 * l_orderkey + l_linenumber) % 20 <> 0
                THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS unit_price,
           (7 * l_orderkey + l_linenumber) % 37 = 0 AS bad_quantity
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
"""


def _order_items(batch: int) -> str:
    rows = _with_roles(LINES, batch)
    return f"""
        SELECT 'O' || kk AS order_id, 'P' || l_partkey AS product_id,
               CASE WHEN bad_quantity THEN '-1' ELSE CAST(q AS VARCHAR) END AS quantity,
               CAST(unit_price AS VARCHAR) AS unit_price,
               CAST(CAST(q * unit_price AS DECIMAL(10,2)) AS VARCHAR) AS total,
               {_lineage("order_items", batch)}
        FROM (SELECT *, CASE WHEN changed THEN CAST(quantity + 1 AS DECIMAL(10,2))
                             ELSE quantity END AS q
              FROM ({rows}))
    """


def _payments(batch: int) -> str:
    source = f"""
        SELECT k, order_total, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS ordered
        FROM (SELECT k, CAST(coalesce(sum(CAST(quantity * unit_price AS DECIMAL(10,2))), 0)
                             AS DECIMAL(10,2)) AS order_total
              FROM ({LINES}) GROUP BY k)
        JOIN orders ON o_orderkey = k
    """
    return f"""
        SELECT 'PAY' || kk AS payment_id,
               CASE WHEN changed THEN 'transfer'
                    WHEN k % 4 = 0 THEN 'card' WHEN k % 4 = 1 THEN 'Card'
                    WHEN k % 4 = 2 THEN 'cash' ELSE 'CASH' END AS method,
               'O' || kk AS order_id, CAST(ordered AS VARCHAR) AS order_date,
               CASE WHEN k % 33 = 0 THEN NULL WHEN k % 67 = 0 THEN '-5.00'
                    ELSE CAST(order_total AS VARCHAR) END AS total,
               CAST(ordered + 1 AS VARCHAR) AS payment_date,
               {_lineage("payments", batch)}
        FROM ({_with_roles(source, batch)})
    """


PLAIN = {
    "customers": _customers,
    "products": _products,
    "orders": _orders,
    "order_items": _order_items,
    "payments": _payments,
}


def _number(table: str) -> str:
    return f"coalesce(try_cast(regexp_extract({KEYS[table][0]}, '([0-9]+)', 1) AS BIGINT), 0)"


def _hard(table: str) -> str:
    def rows(every: int, key: str | None = None) -> str:
        columns = _list(f"{key} AS {c}" if key and c in KEYS[table] else c for c in COLUMNS[table])
        return f"SELECT {columns} FROM ({PLAIN[table](1)}) WHERE {_number(table)} % {every} = 0"

    hot = f"CASE {_number(table)} % 2 WHEN 0 THEN ' HOT ' ELSE 'hot' END"
    parts = [rows(1), rows(5), rows(3, hot), rows(17, "CAST(NULL AS VARCHAR)"), rows(19, "'  '")]
    return f"""
        SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS created_at_bronze,
               '1/{table}_hard.csv' AS source_file_id FROM ({" UNION ALL ".join(parts)})
    """


def _shifted(batch: int) -> str:
    """The orders of the first landing without those that come late, or these and those that move."""
    n = _number("orders")
    rows = PLAIN["orders"](1)
    if batch == EARLY:
        return f"SELECT * FROM ({rows}) WHERE {n} % 10 <> 0"
    moved = "coalesce(CAST(try_cast(order_date AS DATE) + 40 AS VARCHAR), order_date)"
    return f"""
        SELECT * REPLACE (TIMESTAMP '2024-01-02 00:00:00' AS created_at_bronze) FROM (
            SELECT * FROM ({rows}) WHERE {n} % 10 = 0
            UNION ALL
            SELECT * REPLACE ({moved} AS order_date) FROM ({rows}) WHERE {n} % 10 <> 0 AND {n} % 7 = 0)
    """


def _landing(table: str):
    def rows(batch: int) -> str:
        if batch == HARD:
            return _hard(table)
        return _shifted(batch) if batch in (EARLY, LATER) else PLAIN[table](batch)

    return rows


LANDING = {t: _landing(t) for t in TABLES}


def _list(names, pattern: str = "{}", between: str = ", ") -> str:
    return between.join(pattern.format(n) for n in names)


def _typed_column(name: str, kind) -> str:
    if kind == "date":
        return (
            f"CASE WHEN regexp_full_match(trim({name}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
            f" THEN CAST(try_strptime(trim({name}), '%Y-%m-%d') AS DATE) END AS {name}"
        )
    if kind == "money":
        return f"try_cast(trim({name}) AS DECIMAL(10,2)) AS {name}"
    return f"substring(lower(trim({name})), 1, {kind}) AS {name}"


def _typed(table: str, batch: int, rows: str, whole: bool = False) -> str:
    """``whole``: keys aren't cut to the length of their column."""
    columns = _list(
        f"lower(trim({n})) AS {n}" if whole and n in KEYS[table] else _typed_column(n, kind)
        for n, kind in COLUMNS[table].items()
    )
    return f"""
        SELECT {columns}, created_at_bronze,
               TIMESTAMP '{AS_OF[batch]} 06:00:00' AS created_at_silver, source_file_id
        FROM ({rows})
    """


def _grouped(name: str) -> str:
    return f"coalesce(nullif(lower(trim({name})), ''), {name})"


def _latest(table: str, batch: int) -> str:
    keys = _list(_grouped(k) for k in KEYS[table])
    order = _list(PAYLOADS[table], "{} DESC NULLS LAST")
    return f"""
        SELECT DISTINCT ON ({keys}) *
        FROM ({LANDING[table](batch)})
        ORDER BY {keys}, created_at_bronze DESC NULLS FIRST, {order}, source_file_id DESC NULLS LAST
    """


def _reason(table: str, batch: int) -> str:
    def missing(name):
        return f"{name} IS NULL" if isinstance(COLUMNS[table][name], str) else f"coalesce({name}, '') = ''"

    rules = [
        f"WHEN {_list((missing(k) for k in KEYS[table]), between=' OR ')} THEN 'missing_pk'",
        f"WHEN {_list((f'length({k}) > {COLUMNS[table][k]}' for k in KEYS[table]), between=' OR ')} THEN 'key_too_long'",
        f"WHEN {_list((missing(p) for p in PAYLOADS[table]), between=' OR ')}"
        " THEN 'missing_required_fields'",
    ]
    if table in DATED:
        outside = f"{{0}} > DATE '{AS_OF[batch]}' + 1 OR {{0}} < DATE '2015-01-01'"
        rules.append(f"WHEN {_list(DATED[table], outside, ' OR ')} THEN 'future_or_past_date'")
    if table in NEGATIVE:
        label, names = NEGATIVE[table]
        rules.append(f"WHEN {_list(names, '{} < 0', ' OR ')} THEN '{label}'")
    return f"CASE {' '.join(rules)} END"


def _tagged(table: str, batch: int) -> str:
    rows = _typed(table, batch, _latest(table, batch), whole=True)
    return f"SELECT *, {_reason(table, batch)} AS reject_reason FROM ({rows})"


def _clean(table: str, batch: int) -> str:
    return f"SELECT * EXCLUDE (reject_reason) FROM ({_tagged(table, batch)}) WHERE reject_reason IS NULL"


def _text(names) -> str:
    return _list(names, "CAST({0} AS VARCHAR) AS {0}")


LINEAGE = ["created_at_bronze", "created_at_silver", "source_file_id"]
AUDIT = LINEAGE[:2]


def _landed(table: str) -> str:
    return f"""
        SELECT {_list(COLUMNS[table])}, '2024-01-01 00:00:00' AS created_at_bronze
        FROM ({LANDING[table](1)})
    """


def _latest_shown(table: str) -> str:
    keys = _list(KEYS[table])
    grouped = _list(f"{_grouped(k)} AS {k}" for k in KEYS[table])
    return f"""
        SELECT * EXCLUDE ({keys}) REPLACE (CAST(created_at_bronze AS VARCHAR) AS created_at_bronze),
               {grouped}
        FROM ({_latest(table, 1)})
    """


def _json(table: str) -> str:
    parts = []
    for name, kind in COLUMNS[table].items():
        if kind == "money":
            shown = f"CAST({name} AS VARCHAR)"
        elif kind == "date":
            shown = f"'\"' || CAST({name} AS VARCHAR) || '\"'"
        else:
            shown = f"CAST(to_json({name}) AS VARCHAR)"
        parts.append(f"'\"{name}\":' || coalesce({shown}, 'null')")
    for name in AUDIT:
        parts.append(f"'\"{name}\":\"' || strftime({name}, '%Y-%m-%dT%H:%M:%S.%f') || '\"'")
    for name in ("source_file_id", "reject_reason"):
        parts.append(f"'\"{name}\":' || CAST(to_json({name}) AS VARCHAR)")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


def _rejected(table: str) -> str:
    return f"""
        SELECT CAST(1 AS BIGINT) AS ingestion_id, '{table}' AS table_name,
               '2024-01-01 06:00:00' AS flagged_at, reject_reason, {_json(table)} AS raw_row
        FROM ({_tagged(table, 1)}) WHERE reject_reason IS NOT NULL
    """


def _long_keys() -> str:
    """Customers whose key has 250 characters in front; keys stand whole where their length is judged."""
    landing = LANDING["customers"](1)
    padded = f"SELECT * REPLACE (repeat('k', 250) || customer_id AS customer_id) FROM ({landing})"
    tagged = _tagged("customers", 1).replace(landing, padded)
    return f"""
        SELECT coalesce(reject_reason, 'clean') AS reject_reason, count(*) AS row_count
        FROM ({tagged}) GROUP BY 1"""


def _labels(table: str) -> list[str]:
    labels = ["missing_pk", "key_too_long", "missing_required_fields"]
    if table in DATED:
        labels.append("future_or_past_date")
    if table in NEGATIVE:
        labels.append(NEGATIVE[table][0])
    return labels


def _summary(table: str) -> str:
    counts = _list(_labels(table), "count(*) FILTER (WHERE reject_reason = '{0}') AS {0}")
    return f"""
        SELECT count(*) FILTER (WHERE reject_reason IS NULL) AS clean, {counts}
        FROM ({_tagged(table, 1)})
    """


def _duplicates(table: str, batch: int) -> str:
    return f"""
        SELECT count(*) AS duplicate_count
        FROM (SELECT row_number() OVER (PARTITION BY {_list(COLUMNS[table])}
                                        ORDER BY created_at_bronze DESC) AS position
              FROM ({LANDING[table](batch)}))
        WHERE position > 1
    """


def _conflicts(table: str) -> str:
    keys = _list(_grouped(k) for k in KEYS[table])
    return f"""
        SELECT count(*) AS key_conflict_count
        FROM (SELECT 1 FROM (SELECT DISTINCT {_list(COLUMNS[table])} FROM ({LANDING[table](1)}))
              GROUP BY {keys} HAVING count(*) > 1)
    """


def _violations(table: str, batch: int = 1) -> str:
    keys = _list(KEYS[table])
    return f"""
        SELECT {keys}, count(*) AS row_count
        FROM ({_typed(table, batch, LANDING[table](batch))}) GROUP BY {keys} HAVING count(*) > 1
    """


def _reasons(table: str, batch: int) -> str:
    return f"""
        SELECT '{table}' AS table_name, coalesce(reject_reason, 'clean') AS reject_reason,
               count(*) AS row_count FROM ({_tagged(table, batch)}) GROUP BY 2
    """


def _hard_quarantine(table: str) -> str:
    return f"""
        SELECT * FROM ({_reasons(table, HARD)}) WHERE reject_reason <> 'clean'
        UNION ALL
        SELECT '{table}', 'malformed_row', count(*) FROM ({PLAIN[table](1)})
        WHERE {_number(table)} % 13 = 0 HAVING count(*) > 0
    """


# ---- merges ----------------------------------------------------------------------------------


def _same_key(table: str) -> str:
    return _list(KEYS[table], "m.{0} = d.{0}", " AND ")


def _differs(table: str) -> str:
    return "(" + _list(PAYLOADS[table], "m.{0} IS DISTINCT FROM d.{0}", " OR ") + ")"


def _two(table: str) -> str:
    """CTEs: main table after batch 1, and the clean second batch."""
    return f"WITH m AS ({_clean(table, 1)}), d AS ({_clean(table, 2)})"


def _merge_parts(table: str) -> dict[str, str]:
    columns = [*COLUMNS[table], *AUDIT]
    return {
        "keep": f"""SELECT {_list(columns, "m.{}")} FROM m LEFT JOIN d ON {_same_key(table)}
                    WHERE d.{KEYS[table][0]} IS NULL OR NOT {_differs(table)}""",
        "update": f"""SELECT {_list(columns, "d.{}")} FROM m JOIN d ON {_same_key(table)}
                      WHERE {_differs(table)}""",
        "insert": f"""SELECT {_list(columns, "d.{}")} FROM d
                      WHERE NOT EXISTS (SELECT 1 FROM m WHERE {_same_key(table)})""",
    }


def _part(table: str, part: str) -> str:
    columns = _text([*COLUMNS[table], *AUDIT])
    return f"{_two(table)} SELECT {columns} FROM ({_merge_parts(table)[part]})"


def _merged(table: str) -> str:
    columns = _text([*COLUMNS[table], *AUDIT])
    parts = " UNION ALL ".join(_merge_parts(table).values())
    return f"{_two(table)} SELECT {columns} FROM ({parts})"


def _history_parts() -> dict[str, str]:
    t = "customers"
    columns = [*COLUMNS[t], *AUDIT]
    start, fresh = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-02'"
    never = "TIMESTAMP '2050-01-01'"
    return {
        "keep": f"""SELECT {_list(columns, "m.{}")}, {start} AS valid_from, {never} AS valid_to,
                           true AS is_valid
                    FROM m LEFT JOIN d ON {_same_key(t)}
                    WHERE d.customer_id IS NULL OR NOT {_differs(t)}""",
        "close": f"""SELECT {_list(columns, "m.{}")}, {start} AS valid_from,
                            {fresh} - INTERVAL 1 DAY AS valid_to, false AS is_valid
                     FROM m JOIN d ON {_same_key(t)} WHERE {_differs(t)}""",
        "open": f"""SELECT {_list(columns, "d.{}")}, {fresh} AS valid_from, {never} AS valid_to,
                           true AS is_valid
                    FROM d WHERE NOT EXISTS (SELECT 1 FROM m WHERE {_same_key(t)}
                                             AND NOT {_differs(t)})""",
    }


HISTORY = [*COLUMNS["customers"], *AUDIT, "valid_from", "valid_to"]


def _history(*parts: str, where: str = "true", columns=HISTORY) -> str:
    rows = " UNION ALL ".join(_history_parts()[p] for p in parts)
    return f"""{_two("customers")} SELECT {_text(columns)}, is_valid FROM ({rows}) WHERE {where}"""


def _merge_counts(table: str) -> str:
    parts = _history_parts() if table == "customers" else _merge_parts(table)
    updated, inserted = ("close", "open") if table == "customers" else ("update", "insert")
    return f"""{_two(table)}
        SELECT (SELECT count(*) FROM ({parts[updated]})) AS updated,
               (SELECT count(*) FROM ({parts[inserted]})) AS inserted,
               (SELECT count(*) FROM ({parts["keep"]})) AS kept
    """


def _union(queries) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({q})" for q in queries)


def _key_check(table: str, rows: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count,
               count(*) FILTER (WHERE n > 1) AS violations
        FROM (SELECT count(*) AS n FROM ({rows}) GROUP BY {_list(KEYS[table])})
    """


def _main_rows(table: str) -> str:
    return _history("keep", "open") if table == "customers" else _merged(table)


def _reconciliation(table: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, daily_in, daily_in - rejected - clean AS dropped_by_dedup,
               CAST(0 AS BIGINT) AS malformed, rejected, clean
        FROM (SELECT (SELECT count(*) FROM ({LANDING[table](1)})) AS daily_in,
                     count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected,
                     count(*) FILTER (WHERE reject_reason IS NULL) AS clean
              FROM ({_tagged(table, 1)}))
    """


# ---- logs ------------------------------------------------------------------------------------


def _file_counts(table: str, batch: int) -> str:
    return f"""
        SELECT CAST({batch} AS BIGINT) AS ingestion_id, source_file_id, '{table}' AS table_name,
               count(*) AS row_count
        FROM ({LANDING[table](batch)}) GROUP BY source_file_id
    """


ALL_FILES = _union(_file_counts(t, b) for t in TABLES for b in (1, 2))

FILE_LOG = f"""
    SELECT ingestion_id, source_file_id, split_part(source_file_id, '/', 2) AS source_file_name,
           table_name, unnest(['bronze_daily', 'bronze_raw']) AS ingestion_for, row_count,
           CASE ingestion_id WHEN 1 THEN '2024-01-01 00:00:00' ELSE '2024-01-02 00:00:00' END
               AS created_at
    FROM ({ALL_FILES})
"""

BRONZE_SUMMARY = f"""
    SELECT ingestion_id, table_name, CAST(sum(row_count) AS BIGINT) AS bronze_daily_row_count,
           CAST(sum(row_count) AS BIGINT) AS bronze_main_row_count
    FROM ({ALL_FILES}) GROUP BY ingestion_id, table_name
"""

ROWS_BY_RUN = f"""
    SELECT table_name, ingestion_id, CAST(sum(row_count) AS BIGINT) AS row_count
    FROM ({ALL_FILES}) GROUP BY table_name, ingestion_id ORDER BY ingestion_id DESC
"""


def _run_entry(table: str, batch: int) -> str:
    def count(label, applies=True):
        if not applies:
            return "CAST(NULL AS BIGINT)"
        return f"count(*) FILTER (WHERE reject_reason = '{label}')"

    main = f"SELECT count(*) FROM ({_clean(table, 1) if batch == 1 else _main_rows(table)})"
    negative = NEGATIVE.get(table, ("", []))[0]
    return f"""
        SELECT CAST({batch} AS BIGINT) AS ingestion_id, '{table}' AS table_name,
               (SELECT count(*) FROM ({LANDING[table](batch)})) AS bronze_daily_row_count,
               (SELECT count(*) FROM ({LANDING[table](batch)})) AS bronze_main_row_count,
               count(*) FILTER (WHERE reject_reason IS NULL) AS silver_daily_row_count,
               ({main}) AS silver_main_row_count,
               {count("missing_pk")} AS silver_daily_null_pk_count,
               {count("missing_required_fields")} AS silver_daily_required_null_count,
               ({_duplicates(table, batch)}) AS silver_daily_duplicate_count,
               {count("future_or_past_date", table in DATED)} AS silver_daily_future_past_count,
               {count(negative, table in NEGATIVE)} AS silver_daily_negative_count
        FROM ({_tagged(table, batch)})
    """


# ---- lookups, sums, stored tables ------------------------------------------------------------

ORDER_DAYS = (
    f"SELECT order_id, max(order_date) AS order_date FROM ({_clean('orders', 1)}) GROUP BY order_id"
)
DATED_ITEMS = f"""
    SELECT {_list(COLUMNS["order_items"], "i.{}")}, o.order_date
    FROM ({_clean("order_items", 1)}) i LEFT JOIN ({ORDER_DAYS}) o ON o.order_id = i.order_id
"""
TYPED_ITEMS = _typed("order_items", 1, _order_items(1))
TOTALS = f"""
    SELECT order_id, CAST(coalesce(sum(total), 0) AS DECIMAL(10,2)) AS total
    FROM ({TYPED_ITEMS}) GROUP BY order_id
"""

# Items have the date that their order has once both runs are merged.
STORED_ITEMS = f"""
    SELECT {_list(COLUMNS["order_items"], "i.{}")}, CAST(o.order_date AS VARCHAR) AS order_date
    FROM ({_merged("order_items")}) i
    LEFT JOIN (SELECT order_id, max(order_date) AS order_date FROM ({_merged("orders")}) GROUP BY order_id) o
    ON o.order_id = i.order_id
"""


# A second run brings orders only; the items follow them.
REDATED_ITEMS = f"""
    WITH m AS ({_clean("orders", EARLY)}), d AS ({_clean("orders", LATER)}),
         o AS (SELECT order_id, max(order_date) AS order_date FROM (
                   SELECT order_id, order_date FROM d
                   UNION ALL
                   SELECT order_id, order_date FROM m
                   WHERE NOT EXISTS (SELECT 1 FROM d WHERE {_same_key("orders")}))
               GROUP BY order_id)
    SELECT {_list(COLUMNS["order_items"], "CAST(i.{0} AS VARCHAR) AS {0}")}, CAST(o.order_date AS VARCHAR) AS order_date
    FROM ({_clean("order_items", 1)}) i LEFT JOIN o ON o.order_id = i.order_id
"""


def _loads(seconds: str) -> str:
    return f"""
        SELECT ingestion_id, table_name, {seconds} FROM ({ALL_FILES}) GROUP BY ingestion_id, table_name
    """


def _quarantine_counts(table: str, batch: int) -> str:
    return f"""
        SELECT CAST({batch} AS BIGINT) AS ingestion_id, '{table}' AS table_name, reject_reason,
               count(*) AS row_count
        FROM ({_tagged(table, batch)}) WHERE reject_reason IS NOT NULL GROUP BY reject_reason
    """


def _both(table: str) -> str:
    return _merged(table) if table in TYPE_ONE else _history("keep", "close", "open")


CATALOG_ROWS = _union(
    [f"SELECT 'bronze.{t}_raw' AS name, count(*) AS row_count FROM ({LANDING[t](1)} UNION ALL {LANDING[t](2)})" for t in TABLES]
    + [f"SELECT 'silver.{t}', count(*) FROM ({_both(t)})" for t in TABLES]
    + ["SELECT 'operational_log.run_log', CAST(10 AS BIGINT)"]
    + [
        f"""SELECT 'operational_log.quarantine', CAST(sum(row_count) AS BIGINT)
        FROM ({_union(_quarantine_counts(t, b) for t in TABLES for b in (1, 2))})"""
    ]
)

# ---- generated data --------------------------------------------------------------------------


def _pick(row: str, purpose: str, choices: str) -> str:
    return f"(CAST('0x' || substr(md5({row} || ':{purpose}'), 1, 8) AS BIGINT) % ({choices}))"


def _one_of(row: str, purpose: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{_pick(row, purpose, str(len(values)))} + 1]"


def _day(row: str, purpose: str, first: int, end: int) -> str:
    days = f"{_pick(row, purpose, str(end - first))} + {first}"
    return f"DATE '1970-01-01' + CAST({days} AS INTEGER)"


NAMES, KINDS, PRICES = map(list, zip(*CATALOG))

GENERATED_PRODUCTS = f"""
    SELECT 'P' || p_partkey AS product_id, {_one_of("p_partkey", "product", NAMES)} AS name,
           {_one_of("p_partkey", "product", KINDS)} AS category,
           {_one_of("p_partkey", "product", PRICES)} AS price
    FROM part
"""
FIRSTS = ["Ada", "Ben", "Chen", "Dina", "Emil", "Fay", "Goro", "Hana", "Ivo", "June"]
LASTS = ["Abbot", "Brook", "Castle", "Dale", "Ember", "Field", "Grove", "Hill", "Isle"]

GENERATED_CUSTOMERS = f"""
    SELECT 'C' || c_custkey AS customer_id,
           {_one_of("c_custkey", "first", FIRSTS)} || ' ' || {_one_of("c_custkey", "last", LASTS)}
               AS name,
           CAST({_day("c_custkey", "signup", 16000, 19000)} AS VARCHAR) AS signup_date
    FROM customer
"""
GENERATED_ORDERS = f"""
    SELECT 'O' || o_orderkey AS order_id,
           'C' || {_pick("o_orderkey", "customer", "SELECT count(*) FROM customer")} AS customer_id,
           {_day("o_orderkey", "ordered", 18000, 20000)} AS order_date,
           {_one_of("o_orderkey", "status", ["Completed", "completed", "Pending", "Cancelled"])}
               AS status
    FROM orders
"""
GENERATED_ITEMS = f"""
    SELECT 'O' || o_orderkey AS order_id, 'P' || product AS product_id, quantity, unit_price,
           CAST(quantity * unit_price AS DECIMAL(10,2)) AS total
    FROM (SELECT o_orderkey, product, {_pick("item", "quantity", "5")} + 1 AS quantity,
                 CASE WHEN {_pick("item", "unpriced", "100")} >= 5
                      THEN CAST({_one_of("CAST(product AS VARCHAR)", "product", PRICES)}
                                AS DECIMAL(10,2)) END AS unit_price
          FROM (SELECT o_orderkey, item,
                       {_pick("item", "bought", "SELECT count(*) FROM part")} AS product
                FROM (SELECT o_orderkey, o_orderkey || '-' || line AS item
                      FROM orders JOIN (VALUES (1), (2), (3)) AS l(line)
                        ON line <= {_pick("o_orderkey", "lines", "3")} + 1)))
"""
GENERATED_PAYMENTS = f"""
    SELECT 'PAY' || number AS payment_id,
           {_one_of("number", "method", ["card", "Card", "cash", "CASH"])} AS method,
           order_id, CAST(order_date AS VARCHAR) AS order_date,
           CASE WHEN {_pick("number", "unpaid", "100")} >= 3 THEN CAST(total AS VARCHAR) END AS total,
           CAST(order_date + 1 AS VARCHAR) AS payment_date
    FROM (SELECT i.order_id, substr(i.order_id, 2) AS number, o.order_date,
                 CAST(coalesce(sum(i.total), 0) AS DECIMAL(10,2)) AS total
          FROM ({GENERATED_ITEMS}) i JOIN ({GENERATED_ORDERS}) o ON o.order_id = i.order_id
          GROUP BY i.order_id, o.order_date)
"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    for t in TABLES:
        sql[f"{t}_landed"] = _landed(t)
        sql[f"{t}_typed"] = f"""
            SELECT {_text([*COLUMNS[t], *LINEAGE])} FROM ({_typed(t, 1, LANDING[t](1))})"""
        sql[f"{t}_latest"] = _latest_shown(t)
        sql[f"{t}_clean"] = f"SELECT {_text([*COLUMNS[t], *LINEAGE])} FROM ({_clean(t, 1)})"
        sql[f"{t}_rejected"] = _rejected(t)
        sql[f"{t}_reject_counts"] = f"""
            SELECT coalesce(reject_reason, 'clean') AS reject_reason, count(*) AS row_count
            FROM ({_tagged(t, 1)}) GROUP BY 1"""
        sql[f"{t}_reject_summary"] = _summary(t)
        sql[f"{t}_duplicate_count"] = _duplicates(t, 1)
        sql[f"{t}_key_conflict_count"] = _conflicts(t)
        sql[f"{t}_key_violations"] = _violations(t)
        sql[f"{t}_merge_counts"] = _merge_counts(t)
        sql[f"hard_{t}_key_violations"] = _violations(t, HARD)
        sql[f"hard_{t}_duplicate_count"] = _duplicates(t, HARD)
        sql[f"{t}_exported"] = f"SELECT {_text(COLUMNS[t])} FROM ({_clean(t, 1)})"
    for t in TYPE_ONE:
        sql[f"{t}_update_set"] = _part(t, "update")
        sql[f"{t}_insert_set"] = _part(t, "insert")
        sql[f"{t}_merged"] = _merged(t)
    sql |= {
        "generated_products": GENERATED_PRODUCTS,
        "generated_customers": GENERATED_CUSTOMERS,
        "generated_orders": f"""
            SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM ({GENERATED_ORDERS})""",
        "generated_order_items": f"""
            SELECT order_id, product_id, quantity, {_text(["unit_price", "total"])}
            FROM ({GENERATED_ITEMS})""",
        "generated_payments": GENERATED_PAYMENTS,
        "customers_closed": _history("close"),
        "customers_opened": _history("open"),
        "customers_history": _history("keep", "close", "open"),
        "customers_current": _history("keep", "open"),
        "clean_key_check": _union(_key_check(t, _clean(t, 1)) for t in TABLES),
        "main_key_check": _union(_key_check(t, _main_rows(t)) for t in TABLES),
        "quarantine_rows": _union(_rejected(t) for t in TABLES),
        "reconciliation": _union(_reconciliation(t) for t in TABLES),
        "file_log": FILE_LOG,
        "bronze_summary": BRONZE_SUMMARY,
        "rows_by_run": ROWS_BY_RUN,
        "customer_rows_loaded": f"SELECT count(*) AS row_count FROM ({_customers(1)})",
        "order_items_with_date": f"""
            SELECT {_text([*COLUMNS["order_items"], "order_date"])} FROM ({DATED_ITEMS})""",
        "order_items_without_order": f"""
            SELECT count(*) AS items, count(*) FILTER (WHERE order_date IS NULL) AS without_order
            FROM ({DATED_ITEMS})""",
        "order_items_priced": f"""
            SELECT i.order_id, i.product_id, CAST(i.quantity AS VARCHAR) AS quantity,
                   CAST(p.price AS VARCHAR) AS unit_price
            FROM ({_clean("order_items", 1)}) i
            LEFT JOIN ({_clean("products", 1)}) p ON p.product_id = i.product_id""",
        "order_totals": f"SELECT order_id, CAST(total AS VARCHAR) AS total FROM ({TOTALS})",
        "payments_from_items": f"""
            SELECT t.order_id, CAST(t.total AS VARCHAR) AS total,
                   CAST(o.order_date AS VARCHAR) AS order_date,
                   CAST(o.order_date + 1 AS VARCHAR) AS payment_date
            FROM ({TOTALS}) t JOIN ({_clean("orders", 1)}) o ON o.order_id = t.order_id""",
        "csv_preview": f"""
            SELECT {_text(COLUMNS["payments"])} FROM ({_clean("payments", 1)})
            ORDER BY {_list(KEYS["payments"])} LIMIT 5""",
        "landed_rows": f"SELECT * FROM ({BRONZE_SUMMARY}) WHERE ingestion_id = 1",
        "run_log": _union(_run_entry(t, b) for t in TABLES for b in (1, 2)),
        "stored_customers": _history(
            "keep", "close", "open", columns=[*COLUMNS["customers"], "valid_from", "valid_to"]
        ),
        "stored_order_items": STORED_ITEMS,
        "stored_quarantine": _union(
            _quarantine_counts(t, b) for t in TABLES for b in (1, 2)
        ),
        "streamed_customers": _history(
            "keep", "close", "open", columns=[*COLUMNS["customers"], "valid_from", "valid_to"]
        ),
        "archived_files": _union(
            [
                f"""SELECT '1_{t}_raw_0.csv' AS file_name, 'archive' AS place, count(*) AS row_count
                FROM ({LANDING[t](1)})"""
                for t in TABLES
            ]
            + ["SELECT 'notes_raw_0.csv', 'landing', CAST(NULL AS BIGINT)"]
        ),
        "retained_rows": _union(
            f"""SELECT CAST(0 AS BIGINT) AS bronze_rows, '{t}' AS table_name, count(*) AS main_rows
            FROM ({_merged(t) if t in TYPE_ONE else _history("keep", "close", "open")})"""
            for t in TABLES
        ),
        "customers_long_keys": _long_keys(),
        "hard_reject_counts": _union(_reasons(t, HARD) for t in TABLES),
        "hard_quarantine": _union(_hard_quarantine(t) for t in TABLES),
        "longest_loads": _loads("max(row_count) / 1000.0 AS executing_time"),
        "bronze_seconds": _loads(
            "max(row_count) / 1000.0 AS bronze_daily_copy_executing_time,"
            " max(row_count) / 1000.0 AS bronze_main_copy_executing_time,"
            " CAST(0 AS DOUBLE) AS bronze_daily_indexing_time,"
            " max(row_count) / 1000.0 AS total_bronze_process_executing_time"
        ),
        "streamed_order_items": STORED_ITEMS,
        "streamed_file_log": f"""
            SELECT ingestion_id, table_name, unnest(['bronze_daily', 'bronze_raw']) AS ingestion_for, row_count
            FROM ({ROWS_BY_RUN})""",
        "streamed_quarantine": _union(_quarantine_counts(t, b) for t in TABLES for b in (1, 2)),
        "order_items_redated": REDATED_ITEMS,
        "skipped_tables": _union(
            f"""SELECT '{t}' AS table_name, {t not in ("orders", "order_items")} AS loaded,
                       {f"(SELECT count(*) FROM ({_clean(t, 1)}))" if t not in ("orders", "order_items") else "CAST(0 AS BIGINT)"} AS main_rows"""
            for t in TABLES
        ),
        "claimed_runs": ROWS_BY_RUN,
        "catalog_tables": CATALOG_ROWS,
    }
    for t in ("products", "orders", "payments"):
        for way in ("stored", "streamed"):
            sql[f"{way}_{t}"] = f"SELECT {_list(COLUMNS[t])} FROM ({_merged(t)})"
    return sql
