"""Independent SQL for every registered query, to be run by DuckDB on the same tables."""

from __future__ import annotations

M32 = "4294967295"
M64 = "18446744073709551615"

# The source tables over the benchmark schema.
ROLES = {
    "customers": """
        SELECT c_custkey AS customer_number, c_name AS customer_name, n_name AS country,
               CASE WHEN c_acctbal >= 0 THEN c_custkey % 125 END AS sales_rep_employee_number,
               CAST(c_acctbal AS DECIMAL(12,2)) AS credit_limit
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "employees": """
        SELECT s_suppkey AS employee_number, split_part(s_name, '#', 2) AS last_name,
               split_part(s_name, '#', 1) AS first_name, CAST(s_nationkey AS BIGINT) AS office_code,
               CASE WHEN s_suppkey <> 0 THEN s_suppkey // 10 END AS reports_to
        FROM supplier""",
    "offices": """
        SELECT CAST(n_nationkey AS BIGINT) AS office_code, n_name AS city, n_name AS country,
               r_name AS territory
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "productlines": """
        SELECT DISTINCT p_type AS product_line, 'Line ' || p_type AS text_description
        FROM part WHERE p_type <> 'PROMO'""",
    "products": """
        SELECT p_partkey AS product_code, p_name AS product_name, p_type AS product_line,
               p_brand AS product_vendor, p_size AS quantity_in_stock,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.60 AS DECIMAL(10,2)) AS buy_price,
               CAST(p_retailprice AS DECIMAL(10,2)) AS msrp
        FROM part""",
    "sales_orders": """
        SELECT o_orderkey AS order_number, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + CAST(7 + o_orderkey % 4 AS INTEGER) AS required_date,
               CASE WHEN o_orderstatus = 'F'
                    THEN CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 7 AS INTEGER)
               END AS shipped_date,
               CASE o_orderstatus WHEN 'F' THEN 'Shipped' WHEN 'O' THEN 'In Process'
                                  WHEN 'P' THEN 'Cancelled' END AS status,
               o_custkey AS customer_number, o_orderpriority AS priority
        FROM orders""",
    "orderdetails": """
        SELECT l_orderkey AS order_number, l_partkey AS product_code,
               CAST(l_quantity AS INTEGER) AS quantity_ordered,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price_each,
               l_linenumber AS order_line_number
        FROM lineitem""",
    "payments": """
        SELECT user_id AS customer_number, CAST(event_id AS VARCHAR) AS check_number,
               CAST(ts AS DATE) AS payment_date, CAST(value AS DECIMAL(12,2)) AS amount
        FROM events WHERE event_type = 'purchase'""",
}

BOUNDS = """
    SELECT min(d) AS min_date, max(d) AS max_date FROM (
        SELECT order_date AS d FROM sales_orders
        UNION ALL SELECT required_date FROM sales_orders
        UNION ALL SELECT shipped_date FROM sales_orders WHERE shipped_date IS NOT NULL
        UNION ALL SELECT payment_date FROM payments)"""

CALENDAR = """
    SELECT CAST(d AS DATE) AS day
    FROM bounds,
         LATERAL (SELECT unnest(generate_series(min_date, max_date, INTERVAL 1 DAY)) AS d)"""

DATE_PARTS = """
    CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d} AS calendar_date,
    CAST(year({d}) AS INTEGER) AS calendar_year, CAST(quarter({d}) AS INTEGER) AS calendar_quarter,
    CAST(month({d}) AS INTEGER) AS calendar_month, strftime({d}, '%B') AS month_name,
    CAST(day({d}) AS INTEGER) AS day_of_month, CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week,
    strftime({d}, '%A') AS day_name, dayofweek({d}) IN (0, 6) AS is_weekend"""

AMOUNTS = """
    CAST(quantity_ordered * price_each AS DECIMAL(12,2)) AS gross_sales_amount,
    CAST(quantity_ordered * buy_price AS DECIMAL(12,2)) AS cost_amount,
    CAST(quantity_ordered * (price_each - buy_price) AS DECIMAL(12,2)) AS margin_amount"""

# Order lines that become sales, on natural keys.
SALES = f"""
    SELECT od.order_number, od.order_line_number, od.product_code, o.customer_number,
           c.sales_rep_employee_number, e.office_code, o.order_date, o.required_date,
           o.shipped_date, o.status, od.quantity_ordered, od.price_each, p.buy_price, p.msrp,
           {AMOUNTS}
    FROM orderdetails od
    JOIN sales_orders o ON od.order_number = o.order_number
    JOIN customers c ON o.customer_number = c.customer_number
    JOIN products p ON od.product_code = p.product_code
    LEFT JOIN employees e ON c.sales_rep_employee_number = e.employee_number
    WHERE o.status <> 'Cancelled'"""

PAID = """
    SELECT p.*, c.sales_rep_employee_number
    FROM payments p JOIN customers c ON p.customer_number = c.customer_number"""

DERIVED = {"bounds": BOUNDS, "calendar": CALENDAR, "sales": SALES, "paid": PAID}
NEEDS = {
    "bounds": ("sales_orders", "payments"),
    "calendar": ("bounds",),
    "sales": ("orderdetails", "sales_orders", "customers", "products", "employees"),
    "paid": ("payments", "customers"),
}


def _ctes(names: tuple[str, ...]) -> dict[str, str]:
    found: dict[str, str] = {}
    for name in names:
        found.update(_ctes(NEEDS.get(name, ())))
        found[name] = ROLES.get(name) or DERIVED[name]
    return found


def sql(body: str, *needs: str, **extra: str) -> str:
    """``body`` behind the named common tables and any extra ones."""
    ctes = {**_ctes(needs), **extra}
    head = ", ".join(f"{n} AS ({q})" for n, q in ctes.items())
    return f"WITH {head} {body}" if head else body


def murmur32(ids: str) -> str:
    """Absolute Murmur3 of BIGINT ids (seed 42, low word, then high word), as id and key."""

    def word(h: str, w: str, n: str) -> str:
        return f"""({w} * 3432918353) & {M32} AS {n}a,
            ((({n}a << 15) & {M32}) | ({n}a >> 17)) AS {n}b, ({n}b * 461845907) & {M32} AS {n}c,
            xor({h}, {n}c) AS {n}d, ((({n}d << 13) & {M32}) | ({n}d >> 19)) AS {n}e,
            ({n}e * 5 + 3864292196) & {M32} AS {n}"""

    return f"""
        SELECT id, abs(CASE WHEN h >= 2147483648 THEN CAST(h AS BIGINT) - 4294967296
                            ELSE CAST(h AS BIGINT) END) AS key
        FROM (SELECT id, CAST(id AS UBIGINT) AS u, u & {M32} AS lo, (u >> 32) & {M32} AS hi,
                     CAST(42 AS UBIGINT) AS h0, {word("h0", "lo", "p")}, {word("p", "hi", "q")},
                     xor(q, CAST(8 AS UBIGINT)) AS f0,
                     (xor(f0, f0 >> 16) * 2246822507) & {M32} AS f1,
                     (xor(f1, f1 >> 13) * 3266489909) & {M32} AS f2, xor(f2, f2 >> 16) AS h
              FROM (SELECT DISTINCT id FROM ({ids}) WHERE id IS NOT NULL))"""


def xxhash64(ids: str) -> str:
    """64-bit xxHash of BIGINT ids (seed 42, one word), as id and key."""
    p1, p2, p3 = "11400714785074694791", "14029467366897019727", "1609587929392839161"
    p4, p5 = "9650029242287828579", "2870177450012600261"

    def u(n: str) -> str:
        return f"CAST({n} AS UHUGEINT)"

    return f"""
        SELECT id, CAST(CASE WHEN h >= {u('9223372036854775808')}
                             THEN CAST(h AS HUGEINT) - 18446744073709551616
                             ELSE CAST(h AS HUGEINT) END AS BIGINT) AS key
        FROM (SELECT id, {u(M64)} AS m, (CAST(id AS UHUGEINT) * {u(p2)}) & m AS k0,
                     ((k0 << 31) & m) | (k0 >> 33) AS k1, (k1 * {u(p1)}) & m AS k2,
                     xor({u('42')} + {u(p5)} + {u('8')}, k2) AS h0,
                     ((h0 << 27) & m) | (h0 >> 37) AS h1, (h1 * {u(p1)} + {u(p4)}) & m AS h2,
                     xor(h2, h2 >> 33) AS h3, (h3 * {u(p2)}) & m AS h4,
                     xor(h4, h4 >> 29) AS h5, (h5 * {u(p3)}) & m AS h6, xor(h6, h6 >> 32) AS h
              FROM (SELECT DISTINCT id FROM ({ids}) WHERE id IS NOT NULL))"""


def _little(at: str, size: int) -> str:
    """The number in ``size`` bytes of a hexadecimal text, the first byte being the lowest."""
    digits = " || ".join(f"substr(digits, 2 * ({at}) + {2 * k + 1}, 2)" for k in reversed(range(size)))
    return f"CAST(CAST('0x' || {digits} AS UBIGINT) AS UHUGEINT)"


def murmur32_text(texts: str) -> str:
    """Absolute Murmur3 of the UTF-8 bytes of texts (seed 42), as id and key.

    Words of four bytes, then every byte left over as a signed number of its own.
    """
    last = _little("place", 1)
    return f"""
        WITH RECURSIVE steps AS (
          SELECT id, hex(id) AS digits, length(hex(id)) // 2 AS n, 0 AS place, CAST(42 AS UHUGEINT) AS h
          FROM (SELECT DISTINCT id FROM ({texts}) WHERE id IS NOT NULL)
          UNION ALL
          SELECT id, digits, n, place + taken, ((((d << 13) & {M32}) | (d >> 19)) * 5 + 3864292196) & {M32}
          FROM (SELECT *, xor(h, (b * 461845907) & {M32}) AS d
                FROM (SELECT *, ((a << 15) & {M32}) | (a >> 17) AS b
                      FROM (SELECT *, (word * 3432918353) & {M32} AS a
                            FROM (SELECT *, CASE WHEN n - place >= 4 THEN 4 ELSE 1 END AS taken,
                                    CASE WHEN n - place >= 4 THEN {_little("place", 4)}
                                         WHEN {last} >= 128 THEN {last} + 4294967040 ELSE {last} END AS word
                                  FROM steps WHERE place < n)))))
        SELECT id, abs(CASE WHEN f >= 2147483648 THEN CAST(f AS BIGINT) - 4294967296 ELSE CAST(f AS BIGINT) END) AS key
        FROM (SELECT id, xor(h, CAST(n AS UHUGEINT)) AS f0, (xor(f0, f0 >> 16) * 2246822507) & {M32} AS f1,
                     (xor(f1, f1 >> 13) * 3266489909) & {M32} AS f2, xor(f2, f2 >> 16) AS f
              FROM steps WHERE place = n)"""


def xxhash64_text(texts: str) -> str:
    """64-bit xxHash of the UTF-8 bytes of texts of fewer than 32 bytes (seed 42), as id and key."""
    p1, p2, p3 = "11400714785074694791", "14029467366897019727", "1609587929392839161"
    p4, p5 = "9650029242287828579", "2870177450012600261"

    def u(n: str) -> str:
        return f"CAST({n} AS UHUGEINT)"

    def turned(x: str, by: int) -> str:
        return f"((({x} << {by}) & {u(M64)}) | ({x} >> {64 - by}))"

    def times(x: str, by: str) -> str:
        # a product of two 64-bit numbers fits in 128 bits
        return f"(({x} * {u(by)}) & {u(M64)})"

    return f"""
        WITH RECURSIVE steps AS (
          SELECT id, hex(id) AS digits, length(hex(id)) // 2 AS n, 0 AS place,
                 ({u('42')} + {u(p5)} + CAST(length(hex(id)) // 2 AS UHUGEINT)) & {u(M64)} AS h
          FROM (SELECT DISTINCT id FROM ({texts}) WHERE id IS NOT NULL)
          UNION ALL
          SELECT id, digits, n, place + taken,
            CASE taken WHEN 8 THEN ({times(turned("x", 27), p1)} + {u(p4)}) & {u(M64)}
                       WHEN 4 THEN ({times(turned("x", 23), p2)} + {u(p3)}) & {u(M64)}
                       ELSE {times(turned("x", 11), p1)} END
          FROM (SELECT *, CASE taken WHEN 8 THEN xor(h, {times(turned(times("word", p2), 31), p1)})
                            WHEN 4 THEN xor(h, {times("word", p1)}) ELSE xor(h, {times("word", p5)}) END AS x
                FROM (SELECT *, CASE taken WHEN 8 THEN {_little("place", 8)} WHEN 4 THEN {_little("place", 4)}
                                ELSE {_little("place", 1)} END AS word
                      FROM (SELECT *, CASE WHEN n - place >= 8 THEN 8 WHEN n - place >= 4 THEN 4 ELSE 1 END AS taken
                            FROM steps WHERE place < n))))
        SELECT id, CAST(CASE WHEN f >= {u('9223372036854775808')} THEN CAST(f AS HUGEINT) - 18446744073709551616
                             ELSE CAST(f AS HUGEINT) END AS BIGINT) AS key
        FROM (SELECT id, xor(h, h >> 33) AS f0, {times("f0", p2)} AS f1, xor(f1, f1 >> 29) AS f2,
                     {times("f2", p3)} AS f3, xor(f3, f3 >> 32) AS f
              FROM steps WHERE place = n)"""


NO_TEXT = "CAST(NULL AS VARCHAR)"

DIM_CUSTOMER = f"""
    SELECT k.key AS customer_key, customer_number, customer_name,
           {NO_TEXT} AS contact_first_name, {NO_TEXT} AS contact_last_name, {NO_TEXT} AS phone,
           {NO_TEXT} AS address_line1, {NO_TEXT} AS address_line2, {NO_TEXT} AS city,
           {NO_TEXT} AS state, {NO_TEXT} AS postal_code, country,
           r.key AS sales_rep_employee_key, sales_rep_employee_number, credit_limit
    FROM customers JOIN keys k ON customer_number = k.id
    LEFT JOIN keys r ON sales_rep_employee_number = r.id"""

DIM_PRODUCT = f"""
    SELECT k.key AS product_key, product_code, product_name, p.product_line,
           pl.text_description AS product_line_description, {NO_TEXT} AS product_scale,
           product_vendor, {NO_TEXT} AS product_description, quantity_in_stock, buy_price, msrp
    FROM products p JOIN keys k ON product_code = k.id
    LEFT JOIN productlines pl ON p.product_line = pl.product_line"""

DIM_EMPLOYEE = f"""
    SELECT k.key AS employee_key, employee_number, first_name, last_name,
           first_name || ' ' || last_name AS full_name, {NO_TEXT} AS extension,
           {NO_TEXT} AS email, {NO_TEXT} AS job_title, m.key AS manager_employee_key, reports_to,
           o.key AS office_key, office_code
    FROM employees JOIN keys k ON employee_number = k.id JOIN keys o ON office_code = o.id
    LEFT JOIN keys m ON reports_to = m.id"""

DIM_OFFICE = f"""
    SELECT k.key AS office_key, office_code, city, {NO_TEXT} AS phone,
           {NO_TEXT} AS address_line1, {NO_TEXT} AS address_line2, {NO_TEXT} AS state, country,
           {NO_TEXT} AS postal_code, territory
    FROM offices JOIN keys k ON office_code = k.id"""

FACT_SALES = """
    SELECT order_number || '-' || product_code AS sales_line_id, order_number, order_line_number,
           c.key AS customer_key, p.key AS product_key, r.key AS sales_rep_employee_key,
           o.key AS sales_office_key,
           CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
           CAST(strftime(required_date, '%Y%m%d') AS INTEGER) AS required_date_key,
           CAST(strftime(shipped_date, '%Y%m%d') AS INTEGER) AS shipped_date_key,
           order_date, required_date, shipped_date, status AS order_status, quantity_ordered,
           price_each, buy_price, msrp, gross_sales_amount, cost_amount, margin_amount
    FROM sales s JOIN keys c ON s.customer_number = c.id JOIN keys p ON s.product_code = p.id
    LEFT JOIN keys r ON s.sales_rep_employee_number = r.id
    LEFT JOIN keys o ON s.office_code = o.id"""

FACT_PAYMENTS = """
    SELECT customer_number || '-' || check_number AS payment_id, customer_number, check_number,
           c.key AS customer_key, r.key AS sales_rep_employee_key,
           CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS payment_date_key, payment_date,
           amount AS payment_amount
    FROM paid JOIN keys c ON customer_number = c.id
    LEFT JOIN keys r ON sales_rep_employee_number = r.id"""

CUSTOMER_IDS = """SELECT customer_number AS id FROM customers
    UNION SELECT sales_rep_employee_number FROM customers"""
PAID_IDS = """SELECT customer_number AS id FROM paid
    UNION SELECT sales_rep_employee_number FROM paid"""
SALES_IDS = """SELECT customer_number AS id FROM sales UNION SELECT product_code FROM sales
    UNION SELECT sales_rep_employee_number FROM sales UNION SELECT office_code FROM sales"""
EMPLOYEE_IDS = """SELECT employee_number AS id FROM employees
    UNION SELECT office_code FROM employees UNION SELECT reports_to FROM employees"""

REVENUE_GROUPS = """
    SELECT CAST(year(order_date) AS INTEGER) AS calendar_year,
           CAST(month(order_date) AS INTEGER) AS calendar_month, c.country, p.product_line,
           CAST(sum(s.quantity_ordered) AS BIGINT) AS units_sold,
           CAST(sum(s.gross_sales_amount) AS DECIMAL(22,2)) AS gross_revenue,
           CAST(sum(s.margin_amount) AS DECIMAL(22,2)) AS margin
    FROM sales s JOIN customers c ON s.customer_number = c.customer_number
    JOIN products p ON s.product_code = p.product_code
    GROUP BY ALL"""

TABLE_COUNTS = """
    SELECT 'dim_customer' AS table_name, count(*) AS {n} FROM customers
    UNION ALL SELECT 'dim_product', count(*) FROM products
    UNION ALL SELECT 'dim_employee', count(*) FROM employees
    UNION ALL SELECT 'dim_office', count(*) FROM offices
    UNION ALL SELECT 'dim_date', count(*) FROM calendar
    UNION ALL SELECT 'fact_order_sales', count(*) FROM sales
    UNION ALL SELECT 'fact_payments', count(*) FROM paid"""
COUNTED = ("customers", "products", "employees", "offices", "calendar", "sales", "paid")

SOURCE_KEYS = {
    "offices": "office_code",
    "employees": "employee_number",
    "customers": "customer_number",
    "productlines": "product_line",
    "products": "product_code",
    "sales_orders": "order_number",
    "orderdetails": "order_number, product_code",
    "payments": "customer_number, check_number",
}


def _source_name(role: str) -> str:
    return "orders" if role == "sales_orders" else role


# Two snapshots of the customers: segments and balances say what changes between them.
CUSTOMER_COLUMNS = (
    "customer_number, customer_name, country, sales_rep_employee_number, credit_limit"
)
OLD_CUSTOMERS = f"""
    SELECT {CUSTOMER_COLUMNS} FROM customers
    WHERE customer_number IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')"""
NEW_CUSTOMERS = """
    SELECT customer_number, customer_name, country,
           CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN sales_rep_employee_number
           END AS sales_rep_employee_number,
           CASE c_mktsegment WHEN 'BUILDING' THEN CAST(credit_limit + 1 AS DECIMAL(12,2))
                WHEN 'HOUSEHOLD' THEN NULL ELSE credit_limit END AS credit_limit
    FROM customers JOIN customer ON customer_number = c_custkey
    WHERE c_acctbal >= 0"""
SNAPSHOTS = {"old": OLD_CUSTOMERS, "new": NEW_CUSTOMERS}

DIFF = """
    SELECT coalesce(old.customer_number, new.customer_number) AS customer_number,
           CASE WHEN old.customer_number IS NULL THEN 'insert'
                WHEN new.customer_number IS NULL THEN 'delete'
                WHEN (old.customer_name, old.country) = (new.customer_name, new.country)
                 AND old.credit_limit IS NOT DISTINCT FROM new.credit_limit
                 AND old.sales_rep_employee_number
                     IS NOT DISTINCT FROM new.sales_rep_employee_number
                THEN 'unchanged' ELSE 'update' END AS change_type
    FROM old FULL JOIN new ON old.customer_number = new.customer_number"""


def _sources_counted() -> str:
    return " UNION ALL ".join(
        f"SELECT '{_source_name(r)}' AS table_name, count(*) AS row_count FROM {r}"
        for r in SOURCE_KEYS
    )


def _keys_counted() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{_source_name(r)}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count,
            count(*) AS distinct_keys, count(*) FILTER (n > 1) AS duplicate_keys
            FROM (SELECT count(*) AS n FROM {r} GROUP BY {k})"""
        for r, k in SOURCE_KEYS.items()
    )


DIMENSIONS = (
    ("dim_customer", "customers", "customer_number"),
    ("dim_product", "products", "product_code"),
    ("dim_employee", "employees", "employee_number"),
    ("dim_office", "offices", "office_code"),
)


def _collisions() -> tuple[str, dict[str, str]]:
    extra, parts = {}, []
    for scheme, formula in (("murmur32", murmur32), ("xxhash64", xxhash64)):
        for dimension, role, key in DIMENSIONS:
            name = f"{scheme}_{role}"
            extra[name] = formula(f"SELECT {key} AS id FROM {role}")
            parts.append(
                f"""SELECT '{dimension}' AS table_name, '{scheme}' AS key_scheme,
                    CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
                    count(*) FILTER (ids > 1) AS colliding_keys
                    FROM (SELECT key, count(*) AS n, count(DISTINCT id) AS ids
                          FROM {role} JOIN {name} ON {key} = id GROUP BY key)"""
            )
    return " UNION ALL ".join(parts), extra


def _integrity() -> str:
    checks = (
        ("fact_order_sales", "customer_key", "dim_customer", "sales", "customer_number",
         "customers", "customer_number"),
        ("fact_order_sales", "product_key", "dim_product", "sales", "product_code",
         "products", "product_code"),
        ("fact_order_sales", "sales_rep_employee_key", "dim_employee", "sales",
         "sales_rep_employee_number", "employees", "employee_number"),
        ("fact_order_sales", "sales_office_key", "dim_office", "sales", "office_code",
         "offices", "office_code"),
        ("fact_order_sales", "order_date_key", "dim_date", "sales", "order_date",
         "calendar", "day"),
        ("fact_order_sales", "required_date_key", "dim_date", "sales", "required_date",
         "calendar", "day"),
        ("fact_order_sales", "shipped_date_key", "dim_date", "sales", "shipped_date",
         "calendar", "day"),
        ("fact_payments", "customer_key", "dim_customer", "paid", "customer_number",
         "customers", "customer_number"),
        ("fact_payments", "sales_rep_employee_key", "dim_employee", "paid",
         "sales_rep_employee_number", "employees", "employee_number"),
        ("fact_payments", "payment_date_key", "dim_date", "paid", "payment_date",
         "calendar", "day"),
    )
    return " UNION ALL ".join(
        f"""SELECT '{fact}' AS fact_table, '{column}' AS fact_column,
            '{dimension}' AS dimension_table,
            count(*) FILTER ({used} IS NULL) AS null_rows,
            count(*) FILTER ({used} NOT IN (SELECT {known} FROM {role})) AS stray_rows,
            count(DISTINCT CASE WHEN {used} NOT IN (SELECT {known} FROM {role}) THEN {used} END)
            AS stray_keys
            FROM {rows}"""
        for fact, column, dimension, rows, used, role, known in checks
    )


MERGED = """
    SELECT coalesce(new.customer_number, old.customer_number) AS customer_number,
           coalesce(new.customer_name, old.customer_name) AS customer_name,
           coalesce(new.country, old.country) AS country,
           CASE WHEN change_type = 'delete' THEN old.sales_rep_employee_number
                ELSE new.sales_rep_employee_number END AS sales_rep_employee_number,
           CASE WHEN change_type = 'delete' THEN old.credit_limit ELSE new.credit_limit
           END AS credit_limit,
           change_type = 'delete' AS is_deleted,
           CASE WHEN change_type = 'unchanged' THEN 'first' ELSE 'second' END AS synced_in
    FROM diff LEFT JOIN old USING (customer_number) LEFT JOIN new USING (customer_number)"""

# A third sync brings the old snapshot back: deleted rows live again, inserted ones go.
REVERTED = """
    SELECT customer_number,
           change_type = 'insert' AS is_deleted,
           CASE WHEN change_type = 'unchanged' THEN 'first' ELSE 'third' END AS synced_in
    FROM diff"""

CHANGE_FEED = """
    SELECT customer_number, customer_name, country, sales_rep_employee_number,
           CASE c_mktsegment WHEN 'BUILDING' THEN CAST(credit_limit + 1 AS DECIMAL(12,2))
                ELSE credit_limit END AS credit_limit,
           c_mktsegment IN ('MACHINERY', 'BUILDING') AS from_feed
    FROM customers JOIN customer ON customer_number = c_custkey"""

REBUILT = f"""
    SELECT od.order_number || '-' || od.product_code AS sales_line_id, od.order_line_number,
           od.quantity_ordered, od.price_each, p.buy_price, {AMOUNTS}
    FROM orderdetails od
    JOIN sales_orders o ON od.order_number = o.order_number
    JOIN customers c ON o.customer_number = c.customer_number
    JOIN (SELECT product_code, CASE WHEN product_vendor = 'Brand#1'
                 THEN CAST(buy_price + 1 AS DECIMAL(10,2)) ELSE buy_price END AS buy_price
          FROM products) p ON od.product_code = p.product_code
    WHERE o.status <> 'Cancelled' AND o.priority <> '5-LOW'"""


def build() -> dict[str, str]:
    collisions, collision_keys = _collisions()
    all_sources = tuple(SOURCE_KEYS)
    return {
        "src_table_counts": sql(_sources_counted(), *all_sources),
        "src_sql_view": sql(
            """SELECT country, status, count(*) AS order_count
               FROM sales_orders JOIN customers USING (customer_number) GROUP BY ALL""",
            "sales_orders",
            "customers",
        ),
        "dim_customer": sql(DIM_CUSTOMER, "customers", keys=murmur32(CUSTOMER_IDS)),
        "dim_product": sql(
            DIM_PRODUCT,
            "products",
            "productlines",
            keys=murmur32("SELECT product_code AS id FROM products"),
        ),
        "dim_employee": sql(DIM_EMPLOYEE, "employees", keys=murmur32(EMPLOYEE_IDS)),
        "dim_office": sql(
            DIM_OFFICE, "offices", keys=murmur32("SELECT office_code AS id FROM offices")
        ),
        "dim_date": sql(f"SELECT {DATE_PARTS.format(d='day')} FROM calendar", "calendar"),
        "fact_order_sales": sql(FACT_SALES, "sales", keys=murmur32(SALES_IDS)),
        "fact_payments": sql(FACT_PAYMENTS, "paid", keys=murmur32(PAID_IDS)),
        "date_bounds": sql("SELECT * FROM bounds", "bounds"),
        "filter_not_cancelled": sql(
            "SELECT order_number, status FROM sales_orders WHERE status <> 'Cancelled'",
            "sales_orders",
        ),
        "left_join_unmatched_rep": sql(
            """SELECT customer_number, sales_rep_employee_number, office_code AS rep_office_code
               FROM customers LEFT JOIN employees
                 ON sales_rep_employee_number = employee_number""",
            "customers",
            "employees",
        ),
        "scalar_date_parts": sql(
            f"""SELECT order_number, {DATE_PARTS.format(d='order_date')} FROM sales_orders""",
            "sales_orders",
        ),
        "scalar_concat_null": sql(
            """SELECT order_number,
                      order_number || '-' || CAST(shipped_date AS VARCHAR) AS shipment_id
               FROM sales_orders""",
            "sales_orders",
        ),
        "scalar_line_amounts": sql(
            f"""SELECT order_number, order_line_number, product_code, {AMOUNTS}
                FROM orderdetails JOIN products USING (product_code)""",
            "orderdetails",
            "products",
        ),
        "hash_key_murmur": sql(
            "SELECT id AS order_number, key AS order_key FROM keys",
            keys=murmur32("SELECT o_orderkey AS id FROM orders"),
        ),
        "hash_key_wide": sql(
            "SELECT id AS order_number, key AS order_key FROM keys",
            keys=xxhash64("SELECT o_orderkey AS id FROM orders"),
        ),
        "hash_key_text": sql(
            """SELECT p_partkey AS product_code, m.key AS narrow_key, x.key AS wide_key
               FROM part LEFT JOIN narrow m ON m.id = p_type LEFT JOIN wide x ON x.id = p_type""",
            narrow=murmur32_text("SELECT p_type AS id FROM part"),
            wide=xxhash64_text("SELECT p_type AS id FROM part"),
        ),
        "report_revenue_month_country_line": sql(
            """SELECT * FROM revenue
               ORDER BY calendar_year, calendar_month, country, product_line""",
            "sales",
            revenue=REVENUE_GROUPS,
        ),
        "report_revenue_recent_first": sql(
            """SELECT * EXCLUDE (margin) FROM revenue
               ORDER BY calendar_year DESC, calendar_month DESC""",
            "sales",
            revenue=REVENUE_GROUPS,
        ),
        "report_revenue_one_year": sql(
            """SELECT * FROM revenue WHERE calendar_year = 1995
               ORDER BY calendar_year, calendar_month, country, product_line""",
            "sales",
            revenue=REVENUE_GROUPS,
        ),
        "report_by_table_names": sql(
            """SELECT calendar_year, country, CAST(sum(gross_revenue) AS DECIMAL(22,2)) AS gross_revenue
               FROM revenue GROUP BY ALL""",
            "sales",
            revenue=REVENUE_GROUPS,
        ),
        "report_top_customers": sql(
            """SELECT customer_name, country,
                      CAST(sum(gross_sales_amount) AS DECIMAL(22,2)) AS gross_revenue
               FROM sales JOIN customers USING (customer_number) GROUP BY ALL
               ORDER BY gross_revenue DESC, customer_name, country LIMIT 20""",
            "sales",
        ),
        "build_warehouse": sql(TABLE_COUNTS.format(n="row_count"), *COUNTED),
        "list_warehouse_tables": sql(TABLE_COUNTS.format(n="row_count"), *COUNTED),
        "stored_fact_order_sales": sql(FACT_SALES, "sales", keys=xxhash64(SALES_IDS)),
        "sink_overwrite_idempotent": sql(
            DIM_CUSTOMER, "customers", keys=murmur32(CUSTOMER_IDS)
        ),
        "audit_target_counts": sql(
            """SELECT table_name, expected_rows, expected_rows AS stored_rows, true AS matches
               FROM counted""",
            *COUNTED,
            counted=TABLE_COUNTS.format(n="expected_rows"),
        ),
        "audit_pk_unique": sql(_keys_counted(), *all_sources),
        "audit_fact_dim_integrity": sql(
            _integrity(), "sales", "paid", "calendar", "offices"
        ),
        "audit_key_collisions": sql(
            collisions, "customers", "products", "employees", "offices", **collision_keys
        ),
        "audit_report_reconciles": sql(
            """SELECT measure, total AS report_total, total AS fact_total, true AS matches FROM (
                 SELECT 'units_sold' AS measure,
                        CAST(sum(quantity_ordered) AS DECIMAL(38,2)) AS total FROM sales
                 UNION ALL SELECT 'gross_revenue', CAST(sum(gross_sales_amount) AS DECIMAL(38,2))
                 FROM sales
                 UNION ALL SELECT 'margin', CAST(sum(margin_amount) AS DECIMAL(38,2)) FROM sales)
            """,
            "sales",
        ),
        "sync_initial_load": sql(
            "SELECT *, false AS is_deleted, 'first' AS synced_in FROM old", "customers", **SNAPSHOTS
        ),
        "sync_snapshot_diff": sql(DIFF, "customers", **SNAPSHOTS),
        "sync_merge": sql(MERGED, "customers", **SNAPSHOTS, diff=DIFF),
        "sync_soft_delete": sql(REVERTED, "customers", **SNAPSHOTS, diff=DIFF),
        "sync_then_rebuild_fact": sql(
            REBUILT, "orderdetails", "sales_orders", "customers", "products"
        ),
        "sync_then_refresh_fact": sql(
            REBUILT, "orderdetails", "sales_orders", "customers", "products"
        ),
        "stream_payments_redelivered": sql(FACT_PAYMENTS, "paid", keys=murmur32(PAID_IDS)),
        "stream_fact_payments": sql(FACT_PAYMENTS, "paid", keys=murmur32(PAID_IDS)),
        "stream_then_build_payments": sql(FACT_PAYMENTS, "paid", keys=murmur32(PAID_IDS)),
        "stream_customer_upsert": sql("SELECT * FROM fed", "customers", fed=CHANGE_FEED),
    }
