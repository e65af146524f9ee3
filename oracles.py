"""SQL twins of the registered queries, for DuckDB over the warehouse tables."""

from __future__ import annotations


def round2(x: str) -> str:
    return (
        f"((CASE WHEN ({x}) < 0 THEN -floor(-({x}) * 100 + 0.5) "
        f"ELSE floor(({x}) * 100 + 0.5) END) / 100.0e0)"
    )


def total(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def mean(x: str) -> str:
    return round2(f"{total(x)} / nullif(count({x}), 0)")


def pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) * 100.0e0 / nullif(CAST({whole} AS DOUBLE), 0))"


# --- entities --------------------------------------------------------------------------


def customers(poison: bool = False) -> str:
    key, first, mail = "c_custkey + 1", "split_part(c_name, '#', 1)", (
        "lower(replace(c_name, '#', '_')) || '@example.com'"
    )
    if poison:
        key = f"CASE WHEN c_custkey % 40 = 7 THEN NULL ELSE {key} END"
        first = f"CASE WHEN c_custkey % 45 = 11 THEN '   ' ELSE {first} END"
        mail = (
            "CASE WHEN c_custkey % 30 = 3 THEN 'not-an-email' "
            f"WHEN c_custkey % 50 = 9 THEN NULL ELSE {mail} END"
        )
    return (
        f"SELECT {key} AS customer_id, {first} AS first_name, "
        f"split_part(c_name, '#', 2) AS last_name, {mail} AS email, n_name AS city, "
        "r_name AS state FROM customer JOIN nation ON c_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey"
    )


def products(poison: bool = False) -> str:
    name, price, stock = "p_name", "p_retailprice", "p_size"
    if poison:
        name = "CASE WHEN p_partkey % 59 = 8 THEN ' ' ELSE p_name END"
        price = (
            "CASE WHEN p_partkey % 71 = 6 THEN -p_retailprice "
            "WHEN p_partkey % 73 = 2 THEN NULL ELSE p_retailprice END"
        )
        stock = (
            "CASE WHEN p_partkey % 67 = 4 THEN -p_size "
            "WHEN p_partkey % 79 = 1 THEN NULL ELSE p_size END"
        )
    return (
        f"SELECT p_partkey + 1 AS product_id, {name} AS product_name, p_type AS category, "
        f"{price} AS price, {stock} AS stock_quantity FROM part"
    )


STATUS_CYCLE = (
    "CASE o_orderkey % 8 WHEN 0 THEN 'PLACED' WHEN 1 THEN 'CONFIRMED' WHEN 2 THEN 'PROCESSING' "
    "WHEN 3 THEN 'SHIPPED' WHEN 4 THEN 'DELIVERED' WHEN 5 THEN 'CANCELLED' "
    "WHEN 6 THEN 'REFUNDED' ELSE 'DELIVERED' END"
)


def orders(poison: bool = False) -> str:
    owner = "o_custkey + CASE WHEN o_custkey % 10 = 3 THEN 2 ELSE 1 END"
    status, amount = STATUS_CYCLE, "o_totalprice"
    if poison:
        owner = f"CASE WHEN o_orderkey % 83 = 5 THEN NULL ELSE {owner} END"
        status = (
            "CASE WHEN o_orderkey % 97 = 13 THEN 'CORRUPTED_STATUS' "
            "WHEN o_orderkey % 101 = 17 THEN NULL WHEN o_orderkey % 103 = 19 THEN 'placed' "
            f"ELSE {status} END"
        )
        amount = (
            "CASE WHEN o_orderkey % 89 = 7 THEN -o_totalprice "
            "WHEN o_orderkey % 107 = 23 THEN NULL ELSE o_totalprice END"
        )
    return (
        f"SELECT o_orderkey + 1 AS order_id, {owner} AS customer_id, {status} AS order_status, "
        f"{amount} AS total_amount, o_orderdate AS order_date, o_orderkey, o_orderstatus, "
        "o_orderpriority FROM orders"
    )


def items(poison: bool = False) -> str:
    order = "l_orderkey + 1"
    if poison:
        order = f"CASE WHEN l_suppkey % 97 = 5 THEN -l_orderkey - 1 ELSE {order} END"
    return (
        f"SELECT l_orderkey * 8 + l_linenumber AS order_item_id, {order} AS order_id, "
        "l_partkey + CASE WHEN l_partkey % 10 = 4 THEN 2 ELSE 1 END AS product_id, "
        "CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS unit_price, "
        "l_shipdate AS shipped_at FROM lineitem"
    )


def payments(poison: bool = False) -> str:
    method = (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'CREDIT_CARD' WHEN '2-HIGH' THEN 'UPI' "
        "WHEN '3-MEDIUM' THEN 'NET_BANKING' WHEN '4-NOT SPECIFIED' THEN 'DEBIT_CARD' "
        "ELSE 'WALLET' END"
    )
    status = (
        "CASE WHEN o_orderkey % 6 < 4 THEN 'SUCCESS' WHEN o_orderkey % 6 = 4 THEN 'PENDING' "
        "ELSE 'FAILED' END"
    )
    amount = "o_totalprice"
    if poison:
        method = (
            "CASE WHEN o_orderkey % 61 = 4 THEN NULL WHEN o_orderkey % 67 = 9 THEN 'upi' "
            f"WHEN o_orderkey % 73 = 2 THEN 'CASH' ELSE {method} END"
        )
        status = (
            "CASE WHEN o_orderkey % 71 = 5 THEN 'UNKNOWN_STATE' "
            f"WHEN o_orderkey % 109 = 6 THEN NULL ELSE {status} END"
        )
        amount = "CASE WHEN o_orderkey % 79 = 3 THEN -500.0e0 ELSE o_totalprice END"
    return (
        "SELECT o_orderkey + 1 AS payment_id, o_orderkey + 1 AS order_id, "
        f"{method} AS payment_method, {status} AS payment_status, {amount} AS payment_amount, "
        "o_orderdate AS payment_date FROM orders"
    )


def tables(poison: bool = False) -> str:
    return (
        f"customers AS ({customers(poison)}), products AS ({products(poison)}), "
        f"orders_ AS ({orders(poison)}), items AS ({items(poison)}), "
        f"payments AS ({payments(poison)})"
    )


CLEAN, POISON = tables(), tables(True)

# --- reports and marts -----------------------------------------------------------------

SPENDING = f"""
spending AS (
  SELECT customer_id, count(order_id) AS lifetime_orders,
    {round2(total("total_amount"))} AS lifetime_value,
    {mean("total_amount")} AS average_basket_size,
    min(order_date) AS first_order_date, max(order_date) AS latest_order_date
  FROM orders_ WHERE order_status <> 'CANCELLED' GROUP BY customer_id)"""

SALES = f"""
sales AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    {round2(total("quantity * unit_price"))} AS gross_revenue
  FROM items GROUP BY product_id)"""

DAYS = f"""
days AS (
  SELECT strftime(CAST(order_date AS DATE), '%Y-%m') AS order_month,
    CAST(order_date AS DATE) AS order_dt, count(order_id) AS total_orders,
    {total("total_amount")} AS revenue, {mean("total_amount")} AS avg_order_value
  FROM orders_ WHERE order_status <> 'CANCELLED' GROUP BY 1, 2),
running AS (
  SELECT order_month, order_dt, total_orders, {round2("revenue")} AS daily_revenue,
    avg_order_value,
    {round2("sum(revenue) OVER (PARTITION BY order_month ORDER BY order_dt ROWS UNBOUNDED PRECEDING)")}
      AS cumulative_monthly_revenue
  FROM days)"""

CLV = f"""
clv AS (
  SELECT c.customer_id, first_name || ' ' || last_name AS customer_name, email, city, state,
    coalesce(lifetime_orders, 0) AS total_orders,
    coalesce(lifetime_value, 0.0e0) AS lifetime_value,
    coalesce(average_basket_size, 0.0e0) AS avg_order_value
  FROM customers c LEFT JOIN spending s ON c.customer_id = s.customer_id)"""

ROLLUP = f"""
per_category AS (
  SELECT category, count(p.product_id) AS catalog_products,
    CAST(coalesce(sum(total_units_sold), 0) AS BIGINT) AS units_sold,
    coalesce({total("gross_revenue")}, 0.0e0) AS gross_revenue
  FROM products p LEFT JOIN sales s ON p.product_id = s.product_id GROUP BY category)"""

ORACLES: dict[str, str] = {
    "daily_sales": f"WITH {CLEAN}, {DAYS} SELECT * FROM running ORDER BY order_dt DESC",
    "top_revenue_days": (
        f"WITH {CLEAN}, {DAYS} SELECT * FROM running "
        "ORDER BY daily_revenue DESC, order_dt DESC LIMIT 5"
    ),
    "customer_lifetime_value": (
        f"WITH {CLEAN}, {SPENDING}, {CLV} SELECT *, "
        "dense_rank() OVER (ORDER BY lifetime_value DESC) AS clv_rank FROM clv "
        "ORDER BY lifetime_value DESC, customer_id LIMIT 20"
    ),
    "clv_inner": (
        f"WITH {CLEAN}, {SPENDING} SELECT c.customer_id, "
        "first_name || ' ' || last_name AS customer_name, city, state, "
        "lifetime_orders AS total_orders, lifetime_value, "
        "average_basket_size AS avg_order_value, "
        "dense_rank() OVER (ORDER BY lifetime_value DESC) AS clv_rank "
        "FROM customers c JOIN spending s ON c.customer_id = s.customer_id "
        "ORDER BY lifetime_value DESC, c.customer_id LIMIT 5"
    ),
    "product_performance": (
        f"WITH {CLEAN}, {SALES} SELECT category, p.product_id, product_name, price, "
        "stock_quantity, coalesce(total_units_sold, 0) AS total_units_sold, "
        "coalesce(gross_revenue, 0.0e0) AS gross_revenue, "
        + round2(
            pct(
                "coalesce(gross_revenue, 0.0e0)",
                "CAST(sum(CAST(gross_revenue AS DECIMAL(18,2))) OVER (PARTITION BY category) "
                "AS DOUBLE)",
            )
        )
        + " AS category_revenue_percentage FROM products p "
        "LEFT JOIN sales s ON p.product_id = s.product_id"
    ),
    "payment_summary": (
        f"WITH {CLEAN} SELECT payment_method, count(payment_id) AS total_transactions, "
        "count(CASE WHEN payment_status = 'SUCCESS' THEN 1 END) AS successful_transactions, "
        "count(CASE WHEN payment_status = 'FAILED' THEN 1 END) AS failed_transactions, "
        + round2(pct("count(CASE WHEN payment_status = 'SUCCESS' THEN 1 END)", "count(payment_id)"))
        + f" AS success_rate_pct, {round2(total('payment_amount'))} AS total_processed_volume, "
        f"{mean('payment_amount')} AS avg_transaction_value FROM payments GROUP BY payment_method"
    ),
    "scorecard": (
        f"WITH {CLEAN}, {SALES}, {ROLLUP}, valid AS "
        "(SELECT * FROM orders_ WHERE order_status <> 'CANCELLED') "
        f"SELECT 'gross_revenue' AS metric, {round2(total('total_amount'))} AS value, "
        "CAST(NULL AS VARCHAR) AS detail FROM valid "
        "UNION ALL SELECT 'valid_orders', CAST(count(order_id) AS DOUBLE), NULL FROM valid "
        f"UNION ALL SELECT 'avg_basket_size', {mean('total_amount')}, NULL FROM valid "
        "UNION ALL SELECT 'active_customers', CAST(count(DISTINCT customer_id) AS DOUBLE), NULL "
        "FROM valid UNION ALL SELECT 'payment_success_pct', "
        + round2(pct("count(CASE WHEN payment_status = 'SUCCESS' THEN 1 END)", "count(payment_id)"))
        + ", NULL FROM payments UNION ALL SELECT * FROM (SELECT 'top_category_revenue', "
        + round2("gross_revenue")
        + ", category FROM per_category ORDER BY gross_revenue DESC, category LIMIT 1)"
    ),
    "category_rollup": (
        f"WITH {CLEAN}, {SALES}, {ROLLUP} SELECT *, "
        + round2(pct("gross_revenue", "sum(gross_revenue) OVER ()"))
        + " AS revenue_share_pct FROM per_category"
    ),
    "top_products": (
        f"WITH {CLEAN}, {SALES} SELECT p.product_id, product_name, category, price, "
        "total_units_sold, gross_revenue FROM products p JOIN sales s "
        "ON p.product_id = s.product_id ORDER BY gross_revenue DESC, p.product_id LIMIT 3"
    ),
    "partition_pruned_sum": (
        f"WITH {CLEAN} SELECT DATE '1998-08-02' AS order_date_dt, {round2(total('total_amount'))} "
        "AS total_amount FROM orders_ WHERE CAST(order_date AS DATE) = DATE '1998-08-02'"
    ),
    "city_revenue": (
        f"WITH {CLEAN} SELECT city, {round2(total('total_amount'))} AS revenue FROM orders_ o "
        "JOIN customers c ON o.customer_id = c.customer_id GROUP BY city"
    ),
    "mart_daily_sales": (
        f"WITH {CLEAN} SELECT CAST(order_date AS DATE) AS order_date_dt, order_status, "
        f"count(order_id) AS total_orders, {round2(total('total_amount'))} AS total_revenue, "
        f"{mean('total_amount')} AS avg_order_value FROM orders_ "
        "WHERE order_status <> 'CANCELLED' GROUP BY 1, 2"
    ),
    "mart_customer_lifetime_value": (
        f"WITH {CLEAN}, {SPENDING} SELECT c.customer_id, first_name, last_name, email, city, "
        "state, lifetime_orders, lifetime_value, average_basket_size, first_order_date, "
        "latest_order_date FROM customers c LEFT JOIN spending s ON c.customer_id = s.customer_id"
    ),
    "mart_customer_ranking": (
        f"WITH {CLEAN}, {SPENDING} SELECT c.customer_id, lifetime_value, "
        "CASE WHEN lifetime_value IS NOT NULL THEN "
        "dense_rank() OVER (ORDER BY lifetime_value DESC NULLS LAST) END AS clv_rank "
        "FROM customers c LEFT JOIN spending s ON c.customer_id = s.customer_id"
    ),
    "mart_product_performance": (
        f"WITH {CLEAN}, {SALES} SELECT p.product_id, product_name, category, price, "
        "stock_quantity, total_units_sold, gross_revenue FROM products p "
        "LEFT JOIN sales s ON p.product_id = s.product_id"
    ),
}

_STATUS_AGGREGATE = (
    f"WITH {CLEAN} SELECT order_status, count(*) AS order_count, "
    f"{round2(total('total_amount'))} AS total_amount FROM orders_ GROUP BY order_status"
)
ORACLES["status_aggregate"] = _STATUS_AGGREGATE
ORACLES["status_aggregate_csv"] = _STATUS_AGGREGATE

_PAYMENT_MART = (
    "SELECT payment_method, payment_status, count(payment_id) AS transaction_count, "
    f"{round2(total('payment_amount'))} AS total_amount, "
    f"{mean('payment_amount')} AS avg_payment_amount FROM payments GROUP BY 1, 2"
)
ORACLES["mart_payment_summary"] = f"WITH {CLEAN} {_PAYMENT_MART}"
ORACLES["mart_payment_success"] = (
    f"WITH {CLEAN}, m AS ({_PAYMENT_MART}) SELECT m.*, r.success_rate_pct FROM m JOIN "
    "(SELECT payment_method, "
    + round2(pct("count(CASE WHEN payment_status = 'SUCCESS' THEN 1 END)", "count(*)"))
    + " AS success_rate_pct FROM payments GROUP BY payment_method) r "
    "ON m.payment_method = r.payment_method"
)
_EXACT_SUM = "CAST(sum(CAST({} AS DECIMAL(38,2))) AS DOUBLE)"
ORACLES["gold_tables"] = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, count(*) AS row_count, {_EXACT_SUM.format(amount)} AS amount, "
    f"CAST(sum({units}) AS BIGINT) AS units FROM ({ORACLES[f'mart_{mart}']})"
    for mart, amount, units in (
        ("daily_sales", "total_revenue", "total_orders"),
        ("customer_lifetime_value", "lifetime_value", "lifetime_orders"),
        ("product_performance", "gross_revenue", "total_units_sold"),
        ("payment_summary", "total_amount", "transaction_count"),
    )
)

# --- quality ---------------------------------------------------------------------------

ORDER_LIST = "'CANCELLED', 'CONFIRMED', 'DELIVERED', 'PLACED', 'PROCESSING', 'REFUNDED', 'SHIPPED'"
PAYMENT_LIST = "'FAILED', 'PENDING', 'REFUNDED', 'SUCCESS'"
METHOD_LIST = "'COD', 'CREDIT_CARD', 'DEBIT_CARD', 'NET_BANKING', 'UPI', 'WALLET'"
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
DECLARED_EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def _text(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), 'None')"


def _not_negative(x: str) -> str:
    return f"WHEN {x} IS NULL OR {x} < 0 THEN '{x} must be >= 0, found: ' || {_text(x)} "


def _allowed(x: str, values: str, null_fails: bool = True) -> str:
    quoted = values.replace("'", "''")
    null = f"{x} IS NULL OR " if null_fails else f"{x} <> '' AND "
    return (
        f"WHEN {null}upper({x}) NOT IN ({values}) "
        f"THEN 'invalid {x}: ''' || {_text(x)} || '''. Allowed: [{quoted}]' "
    )


def _key(x: str) -> str:
    return f"WHEN {x} IS NULL OR {x} = 0 THEN '{x} is NULL or missing' "


RECORD = {
    "customers": (
        _key("customer_id")
        + "WHEN email IS NULL OR email = '' THEN 'email is missing' "
        + f"WHEN NOT regexp_matches(trim(email), '{EMAIL}') "
        + "THEN 'invalid email format: ''' || email || '''' "
        + "WHEN first_name IS NULL OR trim(first_name) = '' THEN 'first_name cannot be empty' "
    ),
    "products": (
        _key("product_id")
        + _not_negative("price")
        + _not_negative("stock_quantity")
        + "WHEN product_name IS NULL OR trim(product_name) = '' "
        + "THEN 'product_name cannot be empty' "
    ),
    "orders": (
        _key("order_id")
        + _key("customer_id")
        + _allowed("order_status", ORDER_LIST)
        + _not_negative("total_amount")
    ),
    "payments": (
        _key("payment_id")
        + _key("order_id")
        + _not_negative("payment_amount")
        + _allowed("payment_status", PAYMENT_LIST)
        + _allowed("payment_method", METHOD_LIST, null_fails=False)
    ),
}

STREAM = {
    "customers": (
        f"WHEN email IS NULL OR NOT regexp_matches(email, '{EMAIL}') THEN 'invalid email format' "
        "WHEN first_name IS NULL OR first_name = '' THEN 'missing first_name' "
    ),
    "orders": (
        "WHEN customer_id IS NULL THEN 'customer_id is null' "
        "WHEN total_amount < 0 THEN 'total_amount is negative' "
        f"WHEN order_status NOT IN ({ORDER_LIST}) THEN 'invalid order_status enum' "
    ),
    "payments": (
        "WHEN payment_amount < 0 THEN 'negative payment_amount' "
        f"WHEN payment_method NOT IN ({METHOD_LIST}) THEN 'invalid payment_method' "
        f"WHEN payment_status NOT IN ({PAYMENT_LIST}) THEN 'invalid payment_status' "
    ),
}


def _required(*names: str) -> str:
    return "".join(f"WHEN {n} IS NULL THEN 'required field {n} is missing' " for n in names)


DECLARED = {
    "customers": (
        _required("customer_id", "email", "first_name", "last_name")
        + f"WHEN NOT regexp_matches(email, '{DECLARED_EMAIL}') THEN 'invalid email' "
    ),
    "products": (
        _required("product_id", "product_name", "category", "price", "stock_quantity")
        + "WHEN price < 0 THEN 'price below minimum 0.0' "
        + "WHEN stock_quantity < 0 THEN 'stock_quantity below minimum 0' "
    ),
    "orders": (
        _required("order_id", "customer_id", "order_status", "total_amount")
        + "WHEN total_amount < 0 THEN 'total_amount below minimum 0.0' "
        + f"WHEN order_status NOT IN ({ORDER_LIST}) THEN 'invalid order_status' "
    ),
    "payments": (
        _required("payment_id", "order_id", "payment_method", "payment_status", "payment_amount")
        + "WHEN payment_amount < 0 THEN 'payment_amount below minimum 0.0' "
        + f"WHEN payment_method NOT IN ({METHOD_LIST}) THEN 'invalid payment_method' "
        + f"WHEN payment_status NOT IN ({PAYMENT_LIST}) THEN 'invalid payment_status' "
    ),
}

SHOWN = {
    "customers": "customer_id, first_name, last_name, email",
    "products": "product_id, product_name, price, stock_quantity",
    "orders": "order_id, customer_id, order_status, total_amount",
    "payments": "payment_id, payment_method, payment_status, payment_amount",
}
FROM = {"customers": "customers", "products": "products", "orders": "orders_", "payments": "payments"}
STATUS = "CASE WHEN validation_reason IS NULL THEN 'VALID' ELSE 'INVALID' END AS validation_status"


def judged(table: str, rules: dict[str, str]) -> str:
    return f"(SELECT *, CASE {rules[table]} ELSE NULL END AS validation_reason FROM {FROM[table]})"


def verdicts(table: str, rules: dict[str, str]) -> str:
    return (
        f"WITH {POISON} SELECT {SHOWN[table]}, {STATUS}, validation_reason "
        f"FROM {judged(table, rules)}"
    )


for _table in RECORD:
    ORACLES[f"dq_{_table}"] = verdicts(_table, RECORD)
for _table in STREAM:
    ORACLES[f"dq_{_table}_stream"] = verdicts(_table, STREAM)

ORACLES["dq_declared"] = f"WITH {POISON} " + " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, {STATUS}, validation_reason, count(*) AS row_count "
    f"FROM {judged(t, DECLARED)} GROUP BY ALL"
    for t in DECLARED
)

_SCORES = " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, count(*) AS total_count, "
    "count(*) FILTER (validation_reason IS NULL) AS valid_count, "
    f"count(validation_reason) AS invalid_count FROM {judged(t, RECORD)}"
    for t in RECORD
)
ORACLES["dq_score"] = (
    f"WITH {POISON} SELECT *, {round2(pct('valid_count', 'total_count'))} AS dq_score, "
    f"{pct('valid_count', 'total_count')} < 95 AS below_sla, "
    f"{pct('invalid_count', 'total_count')} > 5 AS error_alert FROM ({_SCORES})"
)
ORACLES["dq_fork"] = (
    f"WITH {POISON}, s AS ({_SCORES}) SELECT source_table, 'silver' AS side, "
    "valid_count AS row_count FROM s UNION ALL "
    "SELECT source_table, 'errors', invalid_count FROM s"
)

_STAMPS = {
    "customers": "TIMESTAMP '2024-01-01 00:00:00'",
    "products": "TIMESTAMP '2024-01-01 00:00:00'",
    "orders": "order_date",
    "payments": "payment_date",
}
_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "payments": "payment_id",
}
ERROR_ROWS = "errors AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS source_table, CAST({_KEYS[t]} AS VARCHAR) AS record_id, "
    f"strftime({_STAMPS[t]}, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS processing_timestamp, "
    "'audit' AS pipeline_run_id, 'INVALID' AS validation_status, validation_reason "
    f"FROM {judged(t, RECORD)} WHERE validation_reason IS NOT NULL"
    for t in RECORD
) + ")"
ORACLES["dead_letter_records"] = f"WITH {POISON}, {ERROR_ROWS} SELECT * FROM errors"
ORACLES["operations_audit"] = (
    f"WITH {POISON}, {ERROR_ROWS} SELECT source_table, validation_status, validation_reason, "
    "count(*) AS incident_count, min(processing_timestamp) AS first_seen, "
    "max(processing_timestamp) AS last_seen FROM errors GROUP BY 1, 2, 3"
)
ORACLES["dq_unique_email"] = (
    f"WITH {POISON} SELECT email, count(*) AS row_count FROM customers "
    "WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1"
)

_NOT_NULL = {
    "customers": "customer_id first_name last_name email city state",
    "products": "product_id product_name category price stock_quantity",
    "orders": "order_id customer_id order_status total_amount order_date",
    "items": "order_item_id order_id product_id quantity unit_price",
    "payments": "payment_id order_id payment_method payment_status payment_amount",
}
_CHECKS = {
    "products": {"price >= 0": "price < 0", "stock_quantity >= 0": "stock_quantity < 0"},
    "orders": {"total_amount >= 0": "total_amount < 0"},
    "items": {"quantity > 0": "quantity <= 0", "unit_price >= 0": "unit_price < 0"},
    "payments": {"payment_amount >= 0": "payment_amount < 0"},
}
ORACLES["dq_constraints"] = f"WITH {POISON} " + " UNION ALL ".join(
    f"SELECT '{'order_items' if t == 'items' else t}' AS source_table, "
    f"'{name}' AS constraint_name, count(*) FILTER ({test}) AS violations "
    f"FROM {'orders_' if t == 'orders' else t}"
    for t, names in _NOT_NULL.items()
    for name, test in [
        *[(f"{n} NOT NULL", f"{n} IS NULL") for n in names.split()],
        *_CHECKS.get(t, {}).items(),
    ]
)
_LINKS = (
    ("orders", "orders_", "customer_id", "customers", "customers", "customer_id"),
    ("order_items", "items", "order_id", "orders", "orders_", "order_id"),
    ("order_items", "items", "product_id", "products", "products", "product_id"),
    ("payments", "payments", "order_id", "orders", "orders_", "order_id"),
)
ORACLES["dq_orphans"] = f"WITH {POISON} " + " UNION ALL ".join(
    f"SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table, "
    f"count(DISTINCT c.{column}) AS orphan_keys, count(c.{column}) AS orphan_rows "
    f"FROM {child_cte} c WHERE NOT EXISTS "
    f"(SELECT 1 FROM {parent_cte} p WHERE p.{key} = c.{column})"
    for child, child_cte, column, parent, parent_cte, key in _LINKS
)
ORACLES["tier_audit"] = (
    f"WITH {POISON}, v AS {judged('orders', RECORD)}, ok AS "
    "(SELECT * FROM v WHERE validation_reason IS NULL) "
    "SELECT 'bronze' AS tier, true AS is_active, CAST(sum(1 + "
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END + "
    "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END + "
    "CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END + "
    "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) "
    "AS row_count FROM orders_ "
    "UNION ALL SELECT 'silver', true, count(*) FROM ok "
    "UNION ALL SELECT 'gold', true, count(*) FROM (SELECT DISTINCT CAST(order_date AS DATE), "
    "order_status FROM ok WHERE order_status <> 'CANCELLED') "
    "UNION ALL SELECT 'errors', true, count(validation_reason) FROM v"
)

# --- change log ------------------------------------------------------------------------

# Images before and after each event; n_ columns say whether an image exists.
_ISO = "strftime(order_date, '%Y-%m-%dT%H:%M:%S')"
_IMAGE = (
    "CASE WHEN o_orderkey % 131 = 7 THEN NULL ELSE order_id END AS order_id, customer_id, "
    f"order_status, total_amount, {_ISO} AS order_date, {_ISO} AS updated_at"
)
_COLUMNS = ("order_id", "customer_id", "order_status", "total_amount", "order_date", "updated_at")
_GONE = ", ".join(f"CASE WHEN is_empty THEN NULL ELSE {c} END AS {c}" for c in _COLUMNS)
EVENTS = f"""
img AS (SELECT {_IMAGE}, o_orderkey AS k, o_orderstatus, o_orderpriority,
          epoch_ms(order_date) AS t FROM orders_),
sent AS (
  SELECT CASE WHEN k % 137 = 3 THEN 'x' ELSE 'c' END AS operation, t AS event_ts_ms,
    k * 4 AS log_position, order_id, customer_id, order_status,
    CASE WHEN k % 151 = 21 THEN NULL ELSE total_amount END AS total_amount, order_date,
    updated_at, k % 127 = 5 AS is_empty, k % 113 = 8 AND k % 137 <> 3 AS is_corrupt, k,
    o_orderpriority, NULL AS status_before, k % 149 = 11 AS is_void,
    k % 151 = 21 AND total_amount IS NOT NULL AS is_text
  FROM img),
change_log AS (
  SELECT * FROM sent
  UNION ALL SELECT * FROM sent WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'u', t + 1, k * 4 + 1, order_id, customer_id, 'DELIVERED', total_amount,
    order_date, updated_at, false, false, k, o_orderpriority, order_status, false, false
    FROM img WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'u', t + 1, k * 4 + 3, order_id, customer_id, 'SHIPPED', total_amount,
    order_date, updated_at, false, false, k, o_orderpriority, 'DELIVERED', false, false
    FROM img WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'
  UNION ALL SELECT 'd', t + 2, k * 4 + 2, order_id, customer_id, order_status, total_amount,
    order_date, updated_at, false, false, k, o_orderpriority, order_status, false, false
    FROM img WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P'),
blanked AS (
  SELECT CASE WHEN is_corrupt OR is_void THEN NULL ELSE operation END AS operation,
    CASE WHEN is_corrupt OR is_void THEN NULL ELSE event_ts_ms END AS event_ts_ms,
    CASE WHEN is_corrupt OR is_void THEN NULL ELSE log_position END AS log_position,
    order_id, customer_id, order_status, total_amount, order_date, updated_at,
    is_empty OR is_corrupt OR is_void AS is_empty, is_corrupt, k, status_before,
    is_void AND NOT is_corrupt AS is_void, is_text FROM change_log),
ev AS (SELECT operation, event_ts_ms, log_position, {_GONE}, is_empty, is_corrupt, k,
  status_before, is_void, is_text AND NOT is_empty AS is_text FROM blanked)"""

_EVENT_RULES = (
    "WHEN is_corrupt THEN 'unparseable envelope' "
    "WHEN operation IS NULL OR operation NOT IN ('c', 'u', 'd', 'r') "
    "THEN 'invalid or missing CDC operation: ''' || coalesce(operation, 'None') || '''' "
    "WHEN is_empty THEN 'payload for operation ''' || operation || ''' is NULL' "
) + RECORD["orders"].replace(
    "WHEN total_amount",
    "WHEN is_text THEN 'total_amount must be >= 0, found: abc' WHEN total_amount",
    1,
)
_STREAM_EVENT_RULES = (
    "WHEN order_id IS NULL AND (is_corrupt OR operation IS NULL) THEN 'unparseable envelope' "
    "WHEN order_id IS NULL THEN 'order_id is null' "
) + STREAM["orders"]


def _judged_events(rules: str) -> str:
    return (
        f"WITH {POISON}, {EVENTS}, judged AS (SELECT *, CASE {rules} ELSE NULL END "
        "AS validation_reason FROM ev), once AS (SELECT DISTINCT * FROM judged), "
        "accepted AS (SELECT * FROM once WHERE validation_reason IS NULL), "
        "rejected AS (SELECT * FROM once WHERE validation_reason IS NOT NULL) "
    )


_EV = _judged_events(_EVENT_RULES)
_STREAM_EV = _judged_events(_STREAM_EVENT_RULES)
_PAYLOAD = ", ".join(_COLUMNS)
_SHOWN_EVENT = f"operation, event_ts_ms, log_position, {_PAYLOAD}"

ORACLES["cdc_parse"] = f"{_EV} SELECT {_SHOWN_EVENT}, is_empty, is_corrupt FROM judged"
ORACLES["cdc_active_image"] = (
    f"{_EV} SELECT operation, log_position, status_before, "
    "CASE WHEN operation = 'd' THEN NULL ELSE order_status END AS status_after, "
    "order_status AS status_active FROM judged"
)
ORACLES["cdc_event_dedup"] = f"{_EV} SELECT {_SHOWN_EVENT} FROM once"
ORACLES["cdc_idempotent_union"] = ORACLES["cdc_event_dedup"]
ORACLES["cdc_envelope_validation"] = (
    f"{_EV} SELECT operation, log_position, order_id, {STATUS}, validation_reason FROM judged"
)
ORACLES["cdc_split"] = (
    f"{_EV} SELECT CASE WHEN validation_reason IS NULL THEN 'silver' ELSE 'errors' END AS side, "
    "validation_reason, count(*) AS event_count FROM once GROUP BY 1, 2"
)
ORACLES["cdc_latest_state"] = (
    f"{_EV} SELECT {_PAYLOAD} FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
    "ORDER BY event_ts_ms DESC, log_position DESC) AS rn FROM accepted) "
    "WHERE rn = 1 AND operation <> 'd'"
)
ORACLES["cdc_advance_state"] = ORACLES["cdc_latest_state"]
ORACLES["cdc_change_audit"] = (
    f"{_EV} SELECT order_id, event_ts_ms, 'order_status' AS attribute, "
    "status_before AS old_value, order_status AS new_value FROM judged "
    "WHERE operation = 'u' AND status_before IS DISTINCT FROM order_status"
)
ORACLES["lineage_columns"] = (
    f"{_EV} SELECT order_id, operation, 'orders' AS source_table, event_ts_ms AS event_timestamp, "
    "'2024-01-01T00:00:00.000000+00:00' AS processing_timestamp, "
    "'lineage' AS pipeline_run_id FROM accepted"
)
ORACLES["errors_raw_poison"] = (
    f"{_EV} SELECT 'orders' AS source_table, CAST(order_id AS VARCHAR) AS record_id, operation, "
    "validation_reason, CASE WHEN is_corrupt THEN 'garbage ' || k END AS unreadable_text, "
    "true AS has_payload FROM rejected"
)
ORACLES["replayed_bronze"] = (
    f"{_EV} SELECT CAST(order_id AS VARCHAR) AS record_id, operation, {STATUS}, "
    "validation_reason, 'orders' AS source_table, "
    "CASE WHEN validation_reason IS NULL THEN total_amount END AS total_amount FROM once"
)


def _orders_silver(events: str) -> str:
    return (
        f"{events} SELECT {_PAYLOAD}, CAST(left(order_date, 10) AS DATE) AS order_date_dt, "
        "operation, event_ts_ms, log_position, 'orders' AS source_table, "
        "event_ts_ms AS event_timestamp, true AS is_stamped FROM accepted"
    )


ORACLES["stream_orders_silver"] = _orders_silver(_STREAM_EV)
ORACLES["stream_orders_batches"] = ORACLES["stream_orders_silver"]
ORACLES["stream_operations_audit"] = (
    f"{_EV} SELECT 'orders' AS source_table, 'INVALID' AS validation_status, validation_reason, "
    "count(*) AS incident_count FROM rejected GROUP BY validation_reason"
)
ORACLES["stream_snapshot"] = ORACLES["cdc_latest_state"]
ORACLES["stream_orders_errors"] = (
    f"{_STREAM_EV} SELECT 'orders' AS source_table, CAST(order_id AS VARCHAR) AS record_id, "
    "operation, 'INVALID' AS validation_status, validation_reason FROM rejected"
)
_ISO_DATE = "strftime({}, '%Y-%m-%dT%H:%M:%S')"
STREAMED = {
    "customers": {n: n for n in ("first_name", "last_name", "email", "city", "state")},
    "payments": {
        **{n: n for n in ("order_id", "payment_method", "payment_status", "payment_amount")},
        "payment_date": _ISO_DATE.format("payment_date"),
    },
    "products": {n: n for n in ("product_name", "category", "price", "stock_quantity")},
}
for _table, _rules in (
    ("customers", STREAM["customers"]),
    ("payments", STREAM["payments"]),
    ("products", RECORD["products"]),
):
    _id = _KEYS[_table]
    _shown = ", ".join(
        f"CASE WHEN validation_reason IS NULL THEN {value} END AS {name}"
        for name, value in STREAMED[_table].items()
    )
    ORACLES[f"stream_{_table}"] = (
        f"WITH {POISON} SELECT CAST({_id} AS VARCHAR) AS record_id, {STATUS}, validation_reason, "
        f"{_shown} FROM (SELECT *, CASE WHEN {_id} IS NULL THEN '{_id} is null' {_rules} ELSE NULL END "
        f"AS validation_reason FROM {FROM[_table]})"
    )
ORACLES["stream_order_items"] = (
    f"WITH {POISON} SELECT DISTINCT CAST(order_item_id AS VARCHAR) AS record_id, "
    "'VALID' AS validation_status, CAST(NULL AS VARCHAR) AS validation_reason FROM items"
)
ORACLES["stream_payments_batches"] = ORACLES["stream_payments"]
ORACLES["batch_quality"] = ORACLES["dq_score"]
ORACLES["cdc_snapshot_dedup"] = (
    f"WITH {CLEAN} SELECT order_item_id, order_id, product_id, quantity, unit_price FROM ("
    "SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY shipped_at DESC, "
    "order_id DESC, product_id DESC, quantity DESC, unit_price DESC) AS rn FROM items) "
    "WHERE rn = 1"
)

# --- keyed writes, files, events -------------------------------------------------------

ORACLES["upsert_status"] = (
    "SELECT o_orderkey + 1 AS order_id, o_custkey + 1 AS customer_id, "
    "CASE WHEN o_orderstatus = 'P' THEN 'PLACED' ELSE 'DELIVERED' END AS order_status, "
    "CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS total_amount, "
    "o_orderstatus AS warehouse_status FROM orders"
)
ORACLES["insert_if_absent"] = (
    "SELECT o_orderkey + 1 AS order_id, o_custkey + 1 AS customer_id, "
    "CASE WHEN o_orderstatus = 'O' THEN 'CONFIRMED' ELSE 'PLACED' END AS order_status, "
    "o_totalprice AS total_amount, o_orderstatus AS warehouse_status FROM orders"
)
ORACLES["ingest_metrics"] = (
    f"WITH {POISON} SELECT 'customers' AS source_table, count(DISTINCT customer_id) AS row_count "
    "FROM customers UNION ALL SELECT 'products', count(DISTINCT product_id) FROM products "
    "UNION ALL SELECT 'orders', count(DISTINCT order_id) FROM orders_ "
    "UNION ALL SELECT 'order_items', count(DISTINCT order_item_id) FROM items "
    "UNION ALL SELECT 'payments', NULL"
)
ORACLES["csv_roundtrip"] = f"WITH {POISON} SELECT * FROM customers"
ORACLES["lake_views"] = (
    " UNION ALL ".join(
        f"SELECT '{view}' AS view_name, count(*) AS row_count, {_EXACT_SUM.format(amount)} "
        f"AS amount FROM (WITH {CLEAN} SELECT * FROM {cte})"
        for view, cte, amount in (
            ("orders", "orders_", "total_amount"),
            ("payments", "payments", "payment_amount"),
            ("products", "products", "price"),
        )
    )
    + f" UNION ALL SELECT 'errors', count(*), NULL FROM (WITH {POISON}, {ERROR_ROWS} "
    "SELECT * FROM errors)"
)
ORACLES["compact_partition"] = (
    f"WITH {CLEAN} SELECT order_id, order_status, total_amount FROM orders_"
)
ORACLES["backfill_day"] = (
    "SELECT event_id, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN value * 2 ELSE value END "
    "AS value, CAST(ts AS DATE) AS event_day FROM events"
)
ORACLES["schema_merge"] = (
    f"WITH {CLEAN} SELECT order_id, CASE WHEN order_date >= TIMESTAMP '1998-01-01' "
    "THEN order_status END AS order_status FROM orders_"
)
ORACLES["skew_salted_join"] = (
    f"WITH {CLEAN} SELECT order_status, order_id, total_amount, "
    "count(*) OVER (PARTITION BY order_status) AS order_count FROM orders_"
)
ORACLES["stream_event_dedup"] = (
    "SELECT event_id, event_type AS operation, epoch_us(ts) // 1000 AS event_ts_ms FROM events"
)
ORACLES["stream_event_dedup_batches"] = ORACLES["stream_event_dedup"]

_EVENT_TIMES = (
    "e AS (SELECT event_id, event_type, epoch_us(ts) // 1000 AS event_ms, (epoch_us(ts) // 1000) + CAST(floor("
    "(CASE WHEN event_type = 'error' THEN value * 60 ELSE value END) * 1000) AS BIGINT) "
    "AS arrival_ms FROM events)"
)
ORACLES["late_event_audit"] = (
    f"WITH {_EVENT_TIMES}, b AS (SELECT *, arrival_ms // 300000 AS batch FROM e), "
    "m AS (SELECT batch, max(event_ms) AS top FROM b GROUP BY batch), "
    "w AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING) - 600000 AS watermark_ms FROM m) "
    "SELECT event_id, event_ms, arrival_ms, watermark_ms FROM b JOIN w USING (batch) "
    "WHERE event_ms <= watermark_ms"
)
ORACLES["freshness"] = (
    f"WITH {_EVENT_TIMES} SELECT event_type, count(*) AS event_count, "
    "max((arrival_ms - event_ms) / 1000.0e0) AS max_lag_seconds, "
    "count(*) FILTER ((arrival_ms - event_ms) / 1000.0e0 > 30) AS sla_breaches "
    "FROM e GROUP BY event_type"
)
ORACLES["events_json"] = (
    "SELECT event_type, count(*) AS event_count, "
    "CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k_total "
    "FROM events GROUP BY event_type"
)

# --- keyed tables, forked streams, marts that follow the changes -----------------------


def _after_merges(rows: str, key: str, columns: str, column: str, new: str, old: str) -> str:
    return (
        f"SELECT {key}, {columns}, CASE WHEN {key} % 2 = 0 THEN {new} ELSE {old} END AS {column} "
        f"FROM ({rows})"
    )


ORACLES["merge_orders"] = _after_merges(
    orders(), "order_id", "customer_id, total_amount", "order_status", "'SHIPPED'", "order_status"
)
ORACLES["merge_customers"] = _after_merges(
    customers(), "customer_id", "first_name, last_name, email, city, state", "updated_at",
    "'2024-02-01T00:00:00'", "'2024-01-01T00:00:00'",
)
ORACLES["merge_products"] = _after_merges(
    products(), "product_id", "product_name, category, stock_quantity", "price", "price + 1", "price"
)
ORACLES["merge_payments"] = _after_merges(
    payments(), "payment_id", "order_id, payment_method, payment_amount", "payment_status",
    "'REFUNDED'", "payment_status",
)

ORACLES["stream_latest_state"] = ORACLES["cdc_latest_state"]
ORACLES["stream_fork_once"] = (
    f"{_STREAM_EV} SELECT 'orders' AS source_table, CAST(order_id AS VARCHAR) AS record_id, "
    f"operation, {STATUS}, validation_reason, "
    "CASE WHEN validation_reason IS NULL THEN log_position END AS log_position, "
    "CASE WHEN validation_reason IS NULL THEN total_amount END AS total_amount, "
    "CASE WHEN validation_reason IS NULL THEN CAST(left(order_date, 10) AS DATE) END AS order_date_dt "
    "FROM once"
)

_NO_DATES = "CAST(NULL AS DATE) AS first_date, CAST(NULL AS DATE) AS latest_date"
ORACLES["marts_after_changes"] = f"""{_EV},
last_orders AS (
  SELECT *, CAST(left(order_date, 10) AS DATE) AS day FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id
      ORDER BY event_ts_ms DESC, log_position DESC) AS rn FROM accepted)
  WHERE rn = 1 AND operation <> 'd' AND order_status <> 'CANCELLED'),
last_items AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY shipped_at DESC,
    order_id DESC, product_id DESC, quantity DESC, unit_price DESC) AS rn FROM ({items()}))
  WHERE rn = 1),
paid AS (
  SELECT payment_method, payment_amount,
    CASE WHEN payment_id % 5 = 0 THEN 'REFUNDED' ELSE payment_status END AS payment_status
  FROM ({payments()})),
by_customer AS (
  SELECT customer_id, count(order_id) AS units, {total('total_amount')} AS amount,
    {mean('total_amount')} AS mean, min(day) AS first_date, max(day) AS latest_date
  FROM last_orders GROUP BY customer_id),
by_product AS (
  SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units,
    {round2(total('quantity * unit_price'))} AS amount FROM last_items GROUP BY product_id)
SELECT 'daily_sales' AS mart, CAST(day AS VARCHAR) AS first_key, order_status AS second_key,
  count(order_id) AS units, {total('total_amount')} AS amount, {mean('total_amount')} AS mean,
  {_NO_DATES} FROM last_orders GROUP BY day, order_status
UNION ALL SELECT 'customer_lifetime_value', CAST(c.customer_id AS VARCHAR), email, units, amount,
  mean, first_date, latest_date
  FROM ({customers()}) c LEFT JOIN by_customer b ON b.customer_id = c.customer_id
UNION ALL SELECT 'product_performance', CAST(p.product_id AS VARCHAR), product_name, units, amount,
  CAST(NULL AS DOUBLE), {_NO_DATES}
  FROM ({products()}) p LEFT JOIN by_product b ON b.product_id = p.product_id
UNION ALL SELECT 'payment_summary', payment_method, payment_status, count(*),
  {total('payment_amount')}, {mean('payment_amount')}, {_NO_DATES} FROM paid GROUP BY 2, 3
"""


def _transitions(source: str, key: str, status: str, prefix: str) -> str:
    """Events as (key, status, moment, pos) to their changes of status."""
    return f"""{prefix}
steps AS (SELECT *, lag(status) OVER w AS old, row_number() OVER w AS n FROM ({source})
  WINDOW w AS (PARTITION BY key ORDER BY moment, pos)),
moved AS (SELECT *, moment - lag(moment) OVER (PARTITION BY key ORDER BY moment, pos) AS lasted
  FROM steps WHERE n = 1 OR old IS DISTINCT FROM status)
SELECT key AS {key}, old AS from_status, status AS to_status, moment AS event_ts_ms,
  lasted AS duration_ms FROM moved"""


ORACLES["status_transitions"] = _transitions(
    "SELECT order_id AS key, CASE WHEN operation = 'd' THEN NULL ELSE order_status END AS status, "
    "event_ts_ms AS moment, log_position AS pos FROM accepted",
    "order_id", "order_status", f"{_EV},",
)
ORACLES["event_transitions"] = _transitions(
    "SELECT CAST(user_id AS BIGINT) AS key, event_type AS status, epoch_us(ts) // 1000 AS moment, "
    "CAST(event_id AS BIGINT) AS pos FROM events",
    "user_id", "event_type", "WITH",
)
ORACLES["stream_dedup_far_copies"] = ORACLES["stream_fork_once"]

ORACLES["stream_late_events"] = (
    f"{_EV}, b AS (SELECT *, k % 5 AS batch FROM once), "
    "m AS (SELECT batch, max(event_ts_ms) AS top FROM b GROUP BY batch), "
    "w AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING) - 600000 AS watermark_ms FROM m) "
    "SELECT CAST(order_id AS VARCHAR) AS record_id, operation, event_ts_ms, watermark_ms "
    "FROM b JOIN w USING (batch) WHERE event_ts_ms <= watermark_ms"
)
ORACLES["freshness_percentiles"] = (
    f"WITH {_EVENT_TIMES}, p AS (SELECT CAST(unnest([0.5, 0.95, 0.99]) AS DOUBLE) AS percentile), "
    "g AS (SELECT event_type, count(*) AS event_count, max(arrival_ms - event_ms) AS max_lag_ms, "
    "count(*) FILTER (arrival_ms - event_ms > 30000) AS sla_breaches FROM e GROUP BY event_type) "
    "SELECT event_type, percentile, event_count, max_lag_ms, sla_breaches, true AS within_error FROM g, p"
)
ORACLES["dq_across_loads"] = (
    f"WITH {POISON}, stored AS (SELECT * FROM customers WHERE customer_id % 3 = 0), "
    "fresh AS (SELECT * FROM customers WHERE customer_id IS NULL OR customer_id % 3 = 1), "
    "n AS (SELECT email, count(*) AS new_rows FROM fresh WHERE email IS NOT NULL GROUP BY email), "
    "h AS (SELECT email, count(*) AS stored_rows FROM stored GROUP BY email) "
    "SELECT 'email' AS check, email AS value, coalesce(stored_rows, 0) AS stored_rows, new_rows "
    "FROM n LEFT JOIN h USING (email) WHERE coalesce(stored_rows, 0) + new_rows > 1 "
    "UNION ALL SELECT 'customer_id', CAST(customer_id AS VARCHAR), 0, count(*) FROM orders_ "
    "WHERE order_id % 2 = 0 AND customer_id NOT IN (SELECT customer_id FROM stored UNION ALL "
    "SELECT customer_id FROM fresh WHERE customer_id IS NOT NULL) GROUP BY customer_id"
)
ORACLES["clustered_day_sum"] = ORACLES["partition_pruned_sum"]
ORACLES["stream_compacted"] = (
    f"{_STREAM_EV} SELECT {_PAYLOAD}, CAST(left(order_date, 10) AS DATE) AS order_date_dt, "
    "operation, event_ts_ms, log_position, 'orders' AS source_table FROM accepted"
)
