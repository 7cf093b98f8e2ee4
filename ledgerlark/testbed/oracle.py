"""The same queries as plain SQL over the driver's tables, written from the definitions and not from the plans.

Money is handled as whole units of 1/10000 so that sums, quotients and half-up rounding are exact.
"""

from __future__ import annotations

from ledgerlark.sources.schemas import SPECS
from ledgerlark.testbed import catalog

UNITS = 10000

ARRIVAL = """
    (SELECT min(l.l_shipdate) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate >= o.o_orderdate)
"""

TABLES = {
    "t_customers": """
        SELECT c_custkey AS customer_id, c_custkey // 3 AS customer_unique_id, 'CITY_' || c_nationkey AS customer_city,
               lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0')
                   AS customer_zip_code_prefix,
               n_name AS customer_state, r_name AS customer_region
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "t_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END
                   AS order_status,
               o_orderdate AS purchased_at, CAST(o_orderdate AS DATE) AS day,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
               {ARRIVAL} AS arrived_at, o_orderdate + INTERVAL 365 DAY AS estimated_at
        FROM orders o""",
    "t_items": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
               l_shipdate AS shipped_at,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) * 100 AS price_u,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT)
                   * CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS BIGINT) AS freight_u,
               price_u + freight_u AS value_u
        FROM lineitem""",
    "t_products": "SELECT p_partkey AS product_id, nullif(p_type, 'SMALL') AS product_category_name FROM part",
    "t_translation": """
        SELECT * FROM (VALUES ('ECONOMY', 'economy_en'), ('LARGE', 'large_en'), ('MEDIUM', 'medium_en'),
                              ('PROMO', 'promo_en')) AS v(product_category_name, product_category_name_english)""",
    "t_sellers": """
        SELECT s_suppkey AS seller_id, n_name AS seller_state, 'CITY_' || s_nationkey AS seller_city
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "t_payments": """
        SELECT event_id // 2 AS order_id, event_id % 2 + 1 AS payment_sequential, event_type AS payment_type,
               user_id % 12 AS payment_installments, CAST(CAST(value AS DECIMAL(10,2)) * 100 AS BIGINT) * 100 AS value_u
        FROM events""",
    "sold": """
        SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_region, o.day, o.month, o.purchased_at,
               i.product_id, i.seller_id, i.value_u
        FROM t_orders o JOIN t_items i ON i.order_id = o.order_id JOIN t_customers c ON c.customer_id = o.customer_id
        WHERE o.order_status = 'delivered'""",
    "arrived": """
        SELECT o.order_id, c.customer_state, o.month AS purchase_month, o.day,
               CAST(o.arrived_at AS DATE) - o.day AS delivery_days,
               CAST(o.arrived_at AS DATE) - CAST(o.estimated_at AS DATE) AS delay
        FROM t_orders o JOIN t_customers c ON c.customer_id = o.customer_id
        WHERE o.order_status = 'delivered' AND o.arrived_at IS NOT NULL""",
    "categorised": """
        SELECT s.*, coalesce(tr.product_category_name_english, p.product_category_name, 'unknown') AS category
        FROM sold s JOIN t_products p ON p.product_id = s.product_id
        LEFT JOIN t_translation tr ON tr.product_category_name = p.product_category_name""",
    "people": """
        SELECT customer_unique_id, count(DISTINCT order_id) AS n_orders, count(*) AS n_items, sum(value_u) AS spent,
               min(day) AS first_purchase, max(day) AS last_purchase
        FROM sold GROUP BY ALL""",
    "dated": "SELECT p.*, (SELECT max(day) FROM t_orders) - last_purchase AS recency_days FROM people p",
    "rfm": """
        SELECT p.*,
               ntile(5) OVER (ORDER BY recency_days DESC, customer_unique_id) AS r_score,
               ntile(5) OVER (ORDER BY n_orders, customer_unique_id) AS f_score,
               ntile(5) OVER (ORDER BY spent, customer_unique_id) AS m_score,
               CASE WHEN r_score > 3 AND f_score > 3 AND m_score > 3 THEN 'Champions'
                    WHEN r_score > 3 AND f_score > 1 THEN 'Loyal'
                    WHEN r_score > 3 THEN 'Promising'
                    WHEN r_score < 3 AND f_score > 3 THEN 'At Risk'
                    WHEN r_score < 3 THEN 'Lost' ELSE 'Needs Attention' END AS segment
        FROM dated p""",
    "rfm_ten": """
        SELECT p.*,
               ntile(10) OVER (ORDER BY recency_days DESC, customer_unique_id) AS r_score,
               ntile(10) OVER (ORDER BY n_orders, customer_unique_id) AS f_score,
               ntile(10) OVER (ORDER BY spent, customer_unique_id) AS m_score,
               CASE WHEN r_score >= 8 AND f_score >= 8 AND m_score >= 8 THEN 'Champions'
                    WHEN r_score >= 8 AND f_score >= 4 THEN 'Loyal'
                    WHEN r_score >= 8 THEN 'Promising'
                    WHEN r_score <= 4 AND f_score >= 8 THEN 'At Risk'
                    WHEN r_score <= 4 THEN 'Lost' ELSE 'Needs Attention' END AS segment
        FROM dated p""",
    "months": "SELECT month, sum(value_u) AS rev FROM sold GROUP BY month",
    "by_category": """
        SELECT category, count(DISTINCT order_id) AS orders, count(*) AS items_sold, sum(value_u) AS rev
        FROM categorised GROUP BY category""",
    "by_seller": """
        SELECT seller_id, count(DISTINCT order_id) AS orders, count(*) AS items_sold, sum(value_u) AS rev
        FROM sold GROUP BY seller_id""",
    "by_state": """
        SELECT customer_state, count(*) AS n, count(*) FILTER (delay <= 0) AS ok, sum(delay) AS d,
               sum(greatest(delay, 0)) AS late
        FROM arrived GROUP BY customer_state""",
    "by_type": """
        SELECT p.payment_type, count(*) AS n, count(DISTINCT p.order_id) AS orders, sum(p.value_u) AS val,
               sum(p.payment_installments) AS inst
        FROM t_payments p JOIN t_orders o ON o.order_id = p.order_id WHERE o.order_status = 'delivered'
        GROUP BY p.payment_type""",
    "panel": """
        SELECT customer_region AS series_id, day, sum(value_u) AS u, count(DISTINCT order_id) AS n
        FROM sold GROUP BY ALL""",
    "trimmed": f"SELECT * FROM panel WHERE day >= DATE '{catalog.FIRST_DAY}'",
    "calendar": """
        SELECT series_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
        FROM trimmed GROUP BY series_id""",
    "clean": f"""
        SELECT c.series_id, c.day, coalesce(t.u, 0) AS u, coalesce(t.n, 0) AS n
        FROM calendar c LEFT JOIN trimmed t ON t.series_id = c.series_id AND t.day = c.day
        WHERE c.day <= DATE '{catalog.LAST_DAY}'""",
    "split": f"""
        SELECT series_id, day, u, CAST(u AS DOUBLE) / {UNITS} AS v,
               row_number() OVER (PARTITION BY series_id ORDER BY day DESC) <= 60 AS is_test
        FROM clean""",
    "last_train": """
        SELECT series_id, max(day) AS train_end, max_by(u, day) AS u FROM split WHERE NOT is_test GROUP BY series_id""",
    "forecasts": """
        SELECT s.series_id, s.day, 'naive' AS model, s.u AS a, t.u AS f
        FROM split s JOIN last_train t ON t.series_id = s.series_id WHERE s.is_test
        UNION ALL
        SELECT s.series_id, s.day, 'seasonal_naive', s.u, p.u
        FROM split s JOIN clean p ON p.series_id = s.series_id AND p.day = s.day - 7 WHERE s.is_test
        UNION ALL
        SELECT s.series_id, s.day, 'seasonal_naive_recursive', s.u, p.u
        FROM split s JOIN last_train t ON t.series_id = s.series_id
        JOIN clean p ON p.series_id = s.series_id AND p.day = t.train_end - 6 + CAST((s.day - t.train_end - 1) % 7 AS INTEGER)
        WHERE s.is_test""",
}


def units(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE) / {UNITS}"


def half_up(num: str, den: str, places: int = 2) -> str:
    """num / den rounded half away from zero with integers; den is not negative, and zero gives NULL."""
    num, den = f"CAST({num} AS HUGEINT)", f"CAST(nullif({den}, 0) AS HUGEINT)"
    rounded = f"((abs({num}) * {2 * 10**places} + {den}) // (2 * {den}))"
    return f"CAST(sign({num}) * {rounded} AS DOUBLE) / {10**places}"


def pct(part: str, whole: str) -> str:
    return half_up(f"100 * ({part})", whole)


def money_avg(total: str, n: str) -> str:
    return half_up(total, f"{UNITS} * ({n})")


def sql(body: str) -> str:
    """Prefix a query with the definitions it uses, directly or through others."""
    needed: set[str] = set()

    def collect(text: str) -> None:
        for name, definition in TABLES.items():
            if name not in needed and any(word == name for word in _words(text)):
                needed.add(name)
                collect(definition)

    collect(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({d})" for n, d in TABLES.items() if n in needed) + "\n" + body


def _words(text: str) -> list[str]:
    return "".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split()


GROWTH = f"""
    {units('rev')} AS revenue, {units('lag(rev) OVER (ORDER BY month)')} AS revenue_prev_month,
    {pct('rev - lag(rev) OVER (ORDER BY month)', 'lag(rev) OVER (ORDER BY month)')} AS mom_growth_pct"""

STATE = f"""
    customer_state, n AS delivered_orders, ok AS on_time_orders, {pct('ok', 'n')} AS on_time_pct,
    {half_up('d', 'n')} AS avg_delay_days, {half_up('late', 'n')} AS avg_lateness_days"""

CATEGORY = f"category, orders, items_sold, {units('rev')} AS revenue, {money_avg('rev', 'items_sold')} AS avg_item_value"

RFM = f"""
    customer_unique_id, recency_days, n_orders AS frequency, {units('spent')} AS monetary, r_score, f_score, m_score,
    segment"""

FORECAST_ROWS = f"series_id, day, model, {units('a')} AS actual, {units('f')} AS forecast"

METRICS = f"""
    count(*) AS days, round({units('sum(abs(a - f))')} / count(*), 6) AS mae,
    round(sqrt(sum(CAST(a - f AS DOUBLE) * (a - f)) / count(*)) / {UNITS}, 6) AS rmse,
    round(avg(abs(CAST(a - f AS DOUBLE) / nullif(a, 0))) * 100, 6) AS mape"""

WALK = """
    numbered AS (
        SELECT series_id, day, u, row_number() OVER (PARTITION BY series_id ORDER BY day DESC) - 1 AS left_days FROM clean
    ),
    walked AS (
        SELECT s.series_id, s.left_days // 14 + 1 AS fold, m.model, s.u AS a,
               CASE m.model WHEN 'naive' THEN c.u ELSE w.u END AS f
        FROM numbered s
        JOIN numbered c ON c.series_id = s.series_id AND c.left_days = (s.left_days // 14 + 1) * 14
        JOIN numbered w ON w.series_id = s.series_id AND w.left_days = s.left_days + 7,
        (VALUES ('naive'), ('seasonal_naive')) AS m(model)
        WHERE s.left_days < 56
    )"""


def _over(frame: str) -> str:
    return f"OVER (PARTITION BY series_id ORDER BY day ROWS BETWEEN {frame})"


def _full_mean(n: int, shift: int) -> str:
    frame = _over(f"{n - 1 + shift} PRECEDING AND {f'{shift} PRECEDING' if shift else 'CURRENT ROW'}")
    return f"round(CASE WHEN count(u) {frame} = {n} THEN ({units(f'sum(u) {frame}')}) / {n} END, 6)"


def _checks(kind: str, extra: bool = True) -> str:
    """Report rows of the per-row checks, spelled per column."""
    source = {
        "customers": "t_customers", "products": "t_products", "orders": "t_orders", "order_items": "t_items",
        "order_payments": "t_payments", "product_category_translation": "t_translation",
    }
    parts = []

    def add(table: str, column: str, condition: str, relation: str | None = None) -> None:
        parts.append(
            f"""SELECT '{table}' AS "table", '{kind}' AS "check", '{column}' AS "columns",
                count(*) FILTER ({condition}) AS violations FROM {relation or source[table]}"""
        )

    if kind == "domain":
        statuses = "'delivered','shipped','canceled','unavailable','invoiced','processing','created','approved'"
        types = "'credit_card','boleto','voucher','debit_card','not_defined'"
        add("orders", "order_status", f"order_status NOT IN ({statuses})")
        add("order_payments", "payment_type", f"payment_type NOT IN ({types})")
    elif kind == "range":
        add("order_items", "price", "price_u < 0")
        add("order_items", "freight_value", "freight_u < 0")
        add("order_payments", "payment_installments", "payment_installments < 0")
        add("order_payments", "payment_value", "value_u < 0")
        add("products", "product_weight_g", "p_size < 0", "part")
        for side in ("length", "height", "width"):
            add("products", f"product_{side}_cm", "false")
        add("order_reviews", "review_score", "turn % 5 + 1 NOT BETWEEN 1 AND 5", "conversations")
        if extra:
            add("customer", "c_acctbal", "c_acctbal < 0", "customer")
            add("labels", "quality", "quality NOT BETWEEN 1 AND 5", "labels")
            add("labels", "toxic", "toxic NOT BETWEEN 0 AND 1", "labels")
            add("part", "p_size", "p_size > 25", "part")
    elif kind == "not_null":
        for column in ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"):
            add("customers", column, f"{column} IS NULL")
        for column in ("product_category_name", "product_category_name_english"):
            add("product_category_translation", column, f"{column} IS NULL")
        add("products", "product_id", "product_id IS NULL")
        sellers = {"seller_id": "s_suppkey", "seller_zip_code_prefix": "s_suppkey", "seller_city": "s_nationkey", "seller_state": "n_name"}
        for column, raw in sellers.items():
            add("sellers", column, f"{raw} IS NULL", "supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
        orders = {"order_id": "order_id", "customer_id": "customer_id", "order_status": "order_status",
                  "order_purchase_timestamp": "purchased_at", "order_estimated_delivery_date": "estimated_at"}
        for column, raw in orders.items():
            add("orders", column, f"{raw} IS NULL")
        items = {"order_id": "l_orderkey", "order_item_id": "l_linenumber", "product_id": "l_partkey", "seller_id": "l_suppkey",
                 "shipping_limit_date": "l_shipdate", "price": "l_extendedprice", "freight_value": "l_extendedprice * l_tax"}
        for column, raw in items.items():
            add("order_items", column, f"{raw} IS NULL", "lineitem")
        payments = {"order_id": "event_id", "payment_sequential": "event_id", "payment_type": "event_type",
                    "payment_installments": "user_id", "payment_value": "value"}
        for column, raw in payments.items():
            add("order_payments", column, f"{raw} IS NULL", "events")
        reviews = {"review_id": "conv_id", "order_id": "turn", "review_score": "turn", "review_creation_date": "conv_id",
                   "review_answer_timestamp": "conv_id"}
        for column, raw in reviews.items():
            add("order_reviews", column, f"{raw} IS NULL", "conversations")
    else:
        for column, limit in (
            ("customer_id", 32), ("customer_unique_id", 32), ("customer_zip_code_prefix", 5), ("customer_city", 50),
            ("customer_state", 2),
        ):
            add("customers", column, f"length(CAST({column} AS VARCHAR)) > {limit}")
        for column in ("product_category_name", "product_category_name_english"):
            add("product_category_translation", column, f"length({column}) > 50")
        add("products", "product_id", "length(CAST(product_id AS VARCHAR)) > 32")
        add("products", "product_category_name", "length(product_category_name) > 50")
        for column, source_column, limit in (
            ("seller_id", "s_suppkey", 32), ("seller_zip_code_prefix", "s_suppkey", 5),
            ("seller_city", "'CITY_' || s_nationkey", 50), ("seller_state", "n_name", 2),
        ):
            add("sellers", column, f"length(CAST({source_column} AS VARCHAR)) > {limit}",
                "supplier JOIN nation ON n_nationkey = s_nationkey")
        for column, limit in (("order_id", 32), ("customer_id", 32), ("order_status", 20)):
            add("orders", column, f"length(CAST({column} AS VARCHAR)) > {limit}")
        for column in ("order_id", "product_id", "seller_id"):
            add("order_items", column, f"length(CAST({column} AS VARCHAR)) > 32")
        add("order_payments", "order_id", "length(CAST(order_id AS VARCHAR)) > 32")
        add("order_payments", "payment_type", "length(payment_type) > 20")
        for column, source_column, limit in (
            ("review_id", "conv_id", 32), ("order_id", "turn", 32), ("review_comment_title", "role", 100),
        ):
            add("order_reviews", column, f"length(CAST({source_column} AS VARCHAR)) > {limit}", "conversations")
    return "\nUNION ALL\n".join(parts)


def _primary_keys() -> str:
    keyed = {
        "customers": ("customer", "c_custkey"), "products": ("part", "p_partkey"), "sellers": ("supplier", "s_suppkey"),
        "product_category_translation": ("t_translation", "product_category_name"), "orders": ("orders", "o_orderkey"),
        "order_items": ("lineitem", "l_orderkey, l_linenumber"), "order_payments": ("events", "event_id"),
        "order_reviews": ("conversations", "conv_id, turn"),
    }
    label = {s.name: ", ".join(s.key) for s in SPECS}
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS "table", 'primary_key' AS "check", '{label[name]}' AS "columns",
            (SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS violations"""
        for name, (table, key) in keyed.items()
    )


def _foreign_keys() -> str:
    links = (
        ("orders", "customer_id -> customers.customer_id", "orders", "o_custkey", "customer", "c_custkey"),
        ("order_items", "order_id -> orders.order_id", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("order_items", "product_id -> products.product_id", "lineitem", "l_partkey", "part", "p_partkey"),
        ("order_items", "seller_id -> sellers.seller_id", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("order_payments", "order_id -> orders.order_id", "events", "event_id // 2", "orders", "o_orderkey"),
        ("order_reviews", "order_id -> orders.order_id", "conversations", "turn", "orders", "o_orderkey"),
    )
    return "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS "table", 'foreign_key' AS "check", '{label}' AS "columns", count(*) AS violations
            FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent})"""
        for name, label, child, column, parent, key in links
    )


def _null_counts() -> str:
    never = {
        "customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        "product_category_translation": ("product_category_name", "product_category_name_english"),
        "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        "order_items": ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
        "order_reviews": ("review_id", "order_id", "review_score", "review_creation_date", "review_answer_timestamp"),
        "orders": ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
                   "order_estimated_delivery_date"),
        "products": ("product_id", "product_name_length", "product_weight_g"),
        "order_payments": ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    }
    always = ("product_description_length", "product_photos_qty", "product_length_cm", "product_height_cm",
              "product_width_cm")
    rows = [f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", 0 AS nulls" for t, cols in never.items() for c in cols]
    rows += [f"SELECT 'products', '{c}', count(*) FROM part" for c in always]
    rows += ["SELECT 'products', 'product_category_name', count(*) FROM part WHERE p_type = 'SMALL'"]
    rows += [f"SELECT 'orders', '{c}', count(*) FROM t_orders WHERE arrived_at IS NULL"
             for c in ("order_delivered_carrier_date", "order_delivered_customer_date")]
    rows += [f"SELECT 'order_reviews', '{c}', count(*) FILTER ({raw} IS NULL) FROM conversations"
             for c, raw in (("review_comment_title", "role"), ("review_comment_message", "text"))]
    return "\nUNION ALL\n".join(rows)


def _roundtrip() -> str:
    def part(table: str, relation: str, filled: str, chars: str, cents: str = "0", stamps: str = "CAST(NULL AS TIMESTAMP)") -> str:
        return f"""SELECT '{table}' AS "table", count(*) AS "rows", CAST({filled} AS BIGINT) AS filled_cells,
            CAST({chars} AS BIGINT) AS text_chars, CAST(coalesce(sum({cents}), 0) AS BIGINT) AS number_cents,
            strftime(min(least({stamps})), '%Y-%m-%d %H:%M:%S') AS first_stamp,
            strftime(max(greatest({stamps})), '%Y-%m-%d %H:%M:%S') AS last_stamp FROM {relation}"""

    def text(*columns: str) -> str:
        return " + ".join(f"coalesce(sum(length(CAST({c} AS VARCHAR))), 0)" for c in columns)

    reviewed = "TIMESTAMP '2018-01-01' + CAST(conv_id % 1000 AS INTEGER) * INTERVAL 1 DAY"
    return "\nUNION ALL\n".join((
        part("customers", "t_customers", "5 * count(*)",
             text("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state")),
        part("product_category_translation", "t_translation", "2 * count(*)",
             text("product_category_name", "product_category_name_english")),
        part("products", "part", "3 * count(*) + count(nullif(p_type, 'SMALL'))", text("p_partkey", "nullif(p_type, 'SMALL')"),
             "100 * (length(p_name) + p_size)"),
        part("sellers", "t_sellers", "4 * count(*)",
             text("seller_id", "seller_city", "seller_state",
                  "lpad(CAST(seller_id AS VARCHAR), CAST(greatest(5, length(CAST(seller_id AS VARCHAR))) AS INTEGER), '0')")),
        part("orders", "t_orders", "6 * count(*) + 2 * count(arrived_at)",
             text("order_id", "customer_id", "order_status"), stamps="purchased_at, estimated_at, arrived_at"),
        part("order_items", "t_items", "7 * count(*)",
             text("order_id", "product_id", "seller_id"), "100 * order_item_id + price_u // 100 + (freight_u + 50) // 100",
             "shipped_at"),
        part("order_payments", "t_payments", "5 * count(*)", text("order_id", "payment_type"),
             "100 * (payment_sequential + payment_installments) + value_u // 100"),
        part("order_reviews", "conversations", "6 * count(*) + count(text)", text("conv_id", "turn", "role", "text"),
             "100 * (turn % 5 + 1)", f"{reviewed}, {reviewed} + INTERVAL 1 DAY"),
    ))


RECURSION = f"""
    numbers AS (
        SELECT series_id, day, CAST(u AS DOUBLE) / {UNITS} AS v, is_test,
               row_number() OVER (PARTITION BY series_id ORDER BY day DESC) AS back FROM split
    ),
    steps AS (
        SELECT series_id, 0 AS step, list(v ORDER BY day) AS h, CAST(NULL AS DOUBLE) AS f
        FROM numbers WHERE back BETWEEN 61 AND 67 GROUP BY series_id
        UNION ALL
        SELECT series_id, step + 1, list_append(h[2:7], g), g
        FROM (SELECT series_id, step, h,
                     CASE WHEN h[7] <= 300000 THEN 330000 ELSE 180000 END
                     + CASE WHEN list_sum(h) / 7 <= 250000 THEN 90000 ELSE 20000 END * 0.5e0 AS g
              FROM steps WHERE step < 60)
    )"""

BOX = """
    boxed AS (
        SELECT series_id, dayname(day) AS weekday, CAST(u AS DOUBLE) / 10000 AS v,
               quantile_cont(CAST(u AS DOUBLE) / 10000, 0.25) OVER (PARTITION BY series_id, dayname(day)) AS q1,
               quantile_cont(CAST(u AS DOUBLE) / 10000, 0.5) OVER (PARTITION BY series_id, dayname(day)) AS q2,
               quantile_cont(CAST(u AS DOUBLE) / 10000, 0.75) OVER (PARTITION BY series_id, dayname(day)) AS q3,
               v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
        FROM clean
    )"""

PARTS = """
    trended AS (
        SELECT series_id, day, CAST(u AS DOUBLE) / 10000 AS v, dayofweek(day) AS dow,
               CAST(sum(u) OVER around AS DOUBLE) / 10000 / count(*) OVER around AS trend
        FROM clean
        WINDOW around AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)
    ),
    cycle AS (SELECT series_id, dow, median(v - trend) AS m FROM trended GROUP BY ALL),
    centred AS (SELECT series_id, dow, m - avg(m) OVER (PARTITION BY series_id) AS seasonal FROM cycle)"""


def _local_lines(source: str, into: str, name: str, value: str, reach: int, *keys: str) -> str:
    """CTEs that add the local line of `value` to the rows of `source`, as S.local_lines defines it."""
    by = ", ".join(("series_id", *keys))
    w = f"CAST((1 - abs(CAST(e.p - p AS DOUBLE) / {reach + 1}) ** 3) ** 3 AS DOUBLE) * e.r"
    total = lambda term: f"list_sum(list_transform(near, lambda e: {term}))"
    return f"""
    {into}_a AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY day) AS p, {value} AS y FROM {source}),
    {into}_b AS (SELECT *, list({{'p': p, 'y': y, 'r': rho}}) OVER (PARTITION BY {by} ORDER BY day
                        ROWS BETWEEN {reach} PRECEDING AND {reach} FOLLOWING) AS near FROM {into}_a),
    {into}_c AS (SELECT *, {total(w)} AS w0, {total(f"{w} * (e.p - p)")} AS w1, {total(f"{w} * (e.p - p) * (e.p - p)")} AS w2,
                        {total(f"{w} * e.y")} AS t0, {total(f"{w} * (e.p - p) * e.y")} AS t1, {total("e.y")} / len(near) AS flat FROM {into}_b),
    {into} AS (SELECT * EXCLUDE (p, y, near, w0, w1, w2, t0, t1, flat),
                      CASE WHEN w0 * w2 - w1 * w1 > 1e-9 * w0 * w0 THEN (w2 * t0 - w1 * t1) / (w0 * w2 - w1 * w1)
                           WHEN w0 > 0 THEN t0 / w0 ELSE flat END AS {name} FROM {into}_c)"""


def _robust_parts(rounds: int = 5) -> str:
    out = ["""
    robust_0 AS (SELECT series_id, day, CAST(u AS DOUBLE) / 10000 AS v, dayofweek(day) AS dow, CAST(0 AS DOUBLE) AS trend, CAST(0 AS DOUBLE) AS seasonal,
                        CAST(1 AS DOUBLE) AS rho FROM clean)"""]  # fmt: skip
    for i in range(1, rounds + 1):
        out.append(_local_lines(f"robust_{i - 1}", f"cycle_{i}", "cyc", "v - trend", 3, "dow"))
        out.append(f"""
    full_{i} AS (SELECT * EXCLUDE (trend, seasonal), CASE WHEN count(*) OVER week = 7 THEN avg(cyc) OVER week END AS whole FROM cycle_{i}
                 WINDOW week AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    season_{i} AS (SELECT * EXCLUDE (cyc, whole), cyc - coalesce(whole,
                   first(whole IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
                   last(whole IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   avg(cyc) OVER (PARTITION BY series_id)) AS seasonal FROM full_{i})""")
        out.append(_local_lines(f"season_{i}", f"trend_{i}", "trend", "v - seasonal", 7))
        out.append(f"""
    share_{i} AS (SELECT *, abs(v - trend - seasonal) / nullif(6 * median(abs(v - trend - seasonal)) OVER (PARTITION BY series_id), 0) AS share
                  FROM trend_{i}),
    robust_{i} AS (SELECT series_id, day, v, dow, trend, seasonal,
                          CASE WHEN share IS NULL THEN 1 WHEN share < 1 THEN (1 - share * share) ** 2 ELSE 0 END AS rho FROM share_{i})""")
    return ",".join(out)


def _with_extra(extra: str, body: str, recursive: bool = False) -> str:
    full = sql(extra + " " + body)
    head, _, _ = full.partition(extra)
    text = head.rstrip() + ",\n" + extra + "\n" + body
    return text.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else text


def _covered_rows(model: str) -> str:
    return sql(f"SELECT series_id, day, '{model}' AS model, v AS actual, 1 AS has_forecast FROM split WHERE is_test")


# The trend fit by elimination on the normal equations, for each penalty on the head of the training days, then for the best one on all of them.
TREND = """
    placed AS (
        SELECT series_id, day, v, is_test, row_number() OVER (PARTITION BY series_id, is_test ORDER BY day) - 1 AS place,
               count(*) FILTER (NOT is_test) OVER (PARTITION BY series_id) AS days,
               count(*) FILTER (is_test) OVER (PARTITION BY series_id) AS horizon FROM split),
    sized AS (SELECT *, place + CASE WHEN is_test THEN days ELSE 0 END AS i, least(25, days // 14) AS knots,
                     least(horizon, days // 4) AS tail FROM placed),
    lengths AS (SELECT DISTINCT series_id, days - tail AS n FROM sized UNION SELECT DISTINCT series_id, days FROM sized),
    design AS (
        SELECT s.series_id, n, i, v, is_test, day,
               [1.0, CAST(i / n AS DOUBLE)]
               || list_transform(range(1, 26), lambda j: CASE WHEN j <= knots
                                 THEN greatest(CAST(i AS DOUBLE) - CAST(0.8 AS DOUBLE) * (n - 1) * j / (knots + 1), 0) / n ELSE 0 END)
               || list_transform([1, 2, 3], lambda f: sin(2 * pi() * f * i / 7))
               || list_transform([1, 2, 3], lambda f: cos(2 * pi() * f * i / 7)) AS x
        FROM sized s JOIN lengths l ON l.series_id = s.series_id),
    places AS (SELECT unnest(range(1, 34)) AS a),
    products AS (SELECT series_id, n, p.a, q.a AS b, sum(x[p.a] * x[q.a]) AS xx FROM design, places p, places q WHERE i < n GROUP BY ALL),
    rights AS (SELECT series_id, n, a, sum(x[a] * v) AS xy FROM design, places WHERE i < n GROUP BY ALL),
    penalties AS (SELECT CAST(unnest([0.1, 1, 10, 100]) AS DOUBLE) AS penalty),
    lines AS (
        SELECT p.series_id, p.n, penalty, p.a,
               list(xx + CASE WHEN p.a <> b THEN 0 WHEN p.a BETWEEN 3 AND 27 THEN penalty ELSE CAST(1e-6 AS DOUBLE) END ORDER BY b) || [any_value(xy)] AS line
        FROM products p JOIN rights r ON r.series_id = p.series_id AND r.n = p.n AND r.a = p.a, penalties GROUP BY ALL),
    steps AS (
        SELECT series_id, n, penalty, 1 AS k, list(line ORDER BY a) AS m FROM lines GROUP BY ALL
        UNION ALL
        SELECT series_id, n, penalty, k + 1,
               list_transform(range(1, 34), lambda r: CASE WHEN r = k THEN list_transform(m[k], lambda e: e / m[k][k])
                   ELSE list_transform(range(1, 35), lambda c: m[r][c] - m[r][k] * m[k][c] / m[k][k]) END)
        FROM steps WHERE k <= 33),
    betas AS (SELECT series_id, n, penalty, list_transform(m, lambda r: r[34]) AS beta FROM steps WHERE k = 34),
    tried AS (
        SELECT b.series_id, b.penalty, avg(abs(list_dot_product(b.beta, d.x) - d.v)) AS error
        FROM betas b JOIN design d ON d.series_id = b.series_id AND d.n = b.n
        WHERE d.i >= d.n AND NOT d.is_test GROUP BY ALL),
    best AS (SELECT series_id, arg_min(penalty, error) AS penalty FROM tried GROUP BY 1),
    trend AS (
        SELECT d.series_id, d.day, d.v, list_dot_product(b.beta, d.x) AS f
        FROM best JOIN betas b ON b.series_id = best.series_id AND b.penalty = best.penalty
        JOIN design d ON d.series_id = b.series_id AND d.n = b.n
        WHERE d.is_test AND d.n = (SELECT max(n) FROM lengths l WHERE l.series_id = d.series_id))
"""


ORACLE = {
    "a1_monthly_revenue": sql(f"SELECT month, {GROWTH} FROM months ORDER BY month"),
    "a1_monthly_revenue_dense": _with_extra(
        """slots AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
                    FROM months),
        dense AS (SELECT s.month, coalesce(m.rev, 0) AS rev FROM slots s LEFT JOIN months m ON m.month = s.month)""",
        f"SELECT month, {GROWTH} FROM dense",
    ),
    "a2_revenue_by_category": sql(f"SELECT {CATEGORY} FROM by_category ORDER BY rev DESC, category"),
    "a3_top_customers": sql(f"""
        SELECT customer_unique_id, n_orders AS orders_count, {units('spent')} AS total_spent,
               row_number() OVER (ORDER BY spent DESC, customer_unique_id) AS row_num,
               rank() OVER (ORDER BY spent DESC) AS rnk, dense_rank() OVER (ORDER BY spent DESC) AS dense_rnk
        FROM people ORDER BY row_num LIMIT 25"""),
    "a4_customer_ltv": sql(f"""
        SELECT customer_unique_id, n_orders AS orders_count, {units('spent')} AS clv,
               {money_avg('spent', 'n_orders')} AS avg_order_value, first_purchase, last_purchase,
               last_purchase - first_purchase AS days_active
        FROM people ORDER BY spent DESC, customer_unique_id LIMIT 25"""),
    "a5_top_products": sql(f"""
        SELECT category, rank_in_category, product_id, times_sold, {units('rev')} AS revenue FROM (
            SELECT category, product_id, count(*) AS times_sold, sum(value_u) AS rev,
                   row_number() OVER (PARTITION BY category ORDER BY sum(value_u) DESC, product_id) AS rank_in_category
            FROM categorised GROUP BY category, product_id)
        WHERE rank_in_category <= 3"""),
    "a6_delivery_performance": sql(f"SELECT {STATE} FROM by_state"),
    "a7_rfm": sql(f"SELECT {RFM} FROM rfm"),
    "a7_rfm_ten_tiles": sql(f"SELECT {RFM} FROM rfm_ten"),
    "a7_rfm_top100": sql(f"SELECT {RFM} FROM rfm ORDER BY spent DESC, customer_unique_id LIMIT 100"),
    "a8_cohort_retention": _with_extra(
        """visits AS (
            SELECT DISTINCT c.customer_unique_id, o.month FROM t_orders o
            JOIN t_customers c ON c.customer_id = o.customer_id WHERE o.order_status = 'delivered'),
        firsts AS (SELECT customer_unique_id, min(month) AS cohort_month FROM visits GROUP BY 1),
        sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM firsts GROUP BY 1)""",
        f"""SELECT f.cohort_month, z.cohort_size, date_diff('month', f.cohort_month, v.month) AS months_since,
                   count(*) AS active_customers, {pct('count(*)', 'z.cohort_size')} AS retention_pct
            FROM firsts f JOIN visits v USING (customer_unique_id) JOIN sizes z ON z.cohort_month = f.cohort_month
            WHERE date_diff('month', f.cohort_month, v.month) <= 6 GROUP BY f.cohort_month, z.cohort_size, v.month""",
    ),
    "daily_revenue": sql(
        f"SELECT day, {units('sum(value_u)')} AS revenue, count(DISTINCT order_id) AS orders FROM sold GROUP BY day"
    ),
    "daily_revenue_by_category": sql(f"""
        SELECT category AS series_id, day, {units('sum(value_u)')} AS revenue, count(DISTINCT order_id) AS orders
        FROM categorised GROUP BY category, day"""),
    "view_orders_enriched": sql(f"""
        SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_state, c.customer_city, o.order_status,
               strftime(o.purchased_at, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp, o.month AS purchase_month,
               strftime(o.arrived_at, '%Y-%m-%d %H:%M:%S') AS order_delivered_customer_date,
               strftime(o.estimated_at, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date,
               CAST(o.arrived_at AS DATE) - CAST(o.estimated_at AS DATE) AS delivery_delay_days,
               x.items_count, x.sellers_count, {units('x.p + x.f')} AS order_value, {units('x.p')} AS items_subtotal,
               {units('x.f')} AS freight_total
        FROM t_orders o JOIN t_customers c ON c.customer_id = o.customer_id
        JOIN (SELECT order_id, count(*) AS items_count, count(DISTINCT seller_id) AS sellers_count, sum(price_u) AS p,
                     sum(freight_u) AS f FROM t_items GROUP BY order_id) x ON x.order_id = o.order_id"""),
    "view_monthly_revenue": sql(f"""
        SELECT month, orders, customers, {GROWTH} FROM (
            SELECT month, count(DISTINCT order_id) AS orders, count(DISTINCT customer_unique_id) AS customers,
                   sum(value_u) AS rev FROM sold GROUP BY month)"""),
    "view_customer_clv": sql(f"""
        SELECT customer_unique_id, n_orders AS orders_count, {units('spent')} AS clv,
               {money_avg('spent', 'n_items')} AS avg_item_value, first_purchase, last_purchase,
               last_purchase - first_purchase AS days_active, recency_days, r_score, f_score, m_score, segment
        FROM rfm"""),
    "view_delivery_summary": sql(f"SELECT {STATE} FROM by_state"),
    "view_category_performance": sql(f"SELECT {CATEGORY} FROM by_category"),
    "view_seller_performance": sql(f"""
        SELECT s.seller_id, s.seller_state, s.seller_city, b.orders, b.items_sold, {units('b.rev')} AS revenue
        FROM t_sellers s JOIN by_seller b ON b.seller_id = s.seller_id"""),
    "view_payments_summary": sql(f"""
        SELECT payment_type, n AS payments_count, orders AS orders_count, {units('val')} AS total_value,
               {money_avg('val', 'n')} AS avg_value, {half_up('inst', 'n')} AS avg_installments FROM by_type"""),
    "view_delivery_times": sql("""
        SELECT order_id, purchase_month, customer_state, delivery_days, delay AS delay_vs_estimated,
               CASE WHEN delay <= 0 THEN 1 ELSE 0 END AS is_on_time FROM arrived"""),
    "dash_kpi": sql(f"""
        SELECT count(DISTINCT order_id) AS orders, count(DISTINCT customer_unique_id) AS customers,
               {units('sum(value_u)')} AS revenue,
               {money_avg('sum(value_u)', 'count(DISTINCT order_id)')} AS avg_order_value,
               (SELECT {pct('count(*) FILTER (delay <= 0)', 'count(*)')} FROM arrived) AS on_time_pct
        FROM sold"""),
    "dash_worst_states": sql(f"SELECT {STATE} FROM by_state ORDER BY on_time_pct, customer_state LIMIT 10"),
    "dash_segments": sql(f"""
        SELECT segment, count(*) AS customers, {pct('count(*)', '(SELECT count(*) FROM rfm)')} AS customers_pct,
               {money_avg('sum(spent)', 'count(*)')} AS mean_clv FROM rfm GROUP BY segment"""),
    "dash_state_ranks": _with_extra(
        """income AS (SELECT c.customer_state, sum(s.value_u) AS rev FROM sold s
                      JOIN t_customers c ON c.customer_id = s.customer_id GROUP BY 1)""",
        f"""SELECT i.customer_state, {units('i.rev')} AS revenue,
                   {pct('i.rev', '(SELECT sum(rev) FROM income)')} AS revenue_share_pct,
                   rank() OVER (ORDER BY i.rev DESC) AS revenue_rank, {pct('b.ok', 'b.n')} AS on_time_pct,
                   rank() OVER (ORDER BY {pct('b.ok', 'b.n')} NULLS LAST) AS worst_on_time_rank
            FROM income i LEFT JOIN by_state b ON b.customer_state = i.customer_state""",
    ),
    "dash_top_spenders": sql(f"""
        SELECT *, count(*) FILTER (recency_days > 365) OVER () AS silent_in_top FROM (
            SELECT customer_unique_id, {units('spent')} AS clv, n_orders AS orders_count, recency_days, segment
            FROM rfm ORDER BY spent DESC, customer_unique_id LIMIT 10)"""),
    "dash_clv_hist": sql(f"""
        SELECT bucket_start, n AS customers, {pct('sum(n) OVER (ORDER BY bucket_start)', 'sum(n) OVER ()')} AS cumulative_pct,
               CASE WHEN {pct('sum(n) OVER (ORDER BY bucket_start) - n', 'sum(n) OVER ()')} >= 99 THEN 1 ELSE 0 END AS in_tail,
               {pct('sum(under) OVER ()', 'sum(n) OVER ()')} AS under_limit_pct
        FROM (SELECT CAST(spent // (50000 * {UNITS}) * 50000 AS BIGINT) AS bucket_start, count(*) AS n,
                     count(*) FILTER (spent < 1000000 * CAST({UNITS} AS BIGINT)) AS under FROM people GROUP BY 1)"""),
    "dash_categories": sql(f"""
        SELECT * FROM (SELECT {CATEGORY}, row_number() OVER (ORDER BY rev DESC, category) AS revenue_rank,
            row_number() OVER (ORDER BY {money_avg('rev', 'items_sold')} DESC, category) AS item_value_rank
            FROM by_category) WHERE revenue_rank <= 3 OR item_value_rank <= 3"""),
    "dash_delivery_hist": sql("SELECT delivery_days AS days_from, count(*) AS orders FROM arrived GROUP BY 1"),
    "dash_on_time_trend": sql(f"""
        SELECT purchase_month, count(*) AS delivered_orders, count(*) FILTER (delay <= 0) AS on_time_orders,
               {pct('count(*) FILTER (delay <= 0)', 'count(*)')} AS on_time_pct FROM arrived GROUP BY 1"""),
    "dash_payment_mix": sql(f"""
        SELECT payment_type, n AS payments_count, {units('val')} AS total_value,
               {pct('n', 'sum(n) OVER ()')} AS payments_pct, {pct('val', 'sum(val) OVER ()')} AS value_pct FROM by_type"""),
    "dash_top_sellers": sql(f"""
        SELECT seller_id, seller_state, orders, items_sold, {units('rev')} AS revenue,
               {pct('orders', '(SELECT sum(orders) FROM by_seller)')} AS orders_pct,
               {pct('rev', '(SELECT sum(rev) FROM by_seller)')} AS revenue_pct,
               count(*) OVER (PARTITION BY seller_state) AS top_in_state
        FROM (SELECT b.*, s.seller_state FROM by_seller b JOIN t_sellers s ON s.seller_id = b.seller_id
              ORDER BY b.orders DESC, b.rev DESC, b.seller_id LIMIT 10)"""),
    "dash_seller_states": sql(f"""
        SELECT seller_state, count(*) AS sellers, CAST(sum(orders) AS BIGINT) AS orders, {units('sum(rev)')} AS revenue,
               {pct('sum(orders)', '(SELECT sum(orders) FROM by_seller)')} AS orders_pct
        FROM t_sellers s JOIN by_seller b ON b.seller_id = s.seller_id GROUP BY seller_state"""),
    "dash_repeat_rate": sql(f"""
        SELECT count(*) AS customers, count(*) FILTER (n_orders > 1) AS repeat_customers,
               {pct('count(*) FILTER (n_orders > 1)', 'count(*)')} AS repeat_pct FROM people"""),
    "dash_peak_month": sql(f"SELECT month, {units('rev')} AS revenue FROM months ORDER BY rev DESC, month LIMIT 1"),
    "op_ntile_distributed": sql(f"""
        SELECT customer_unique_id, n_orders AS orders_count, {units('spent')} AS clv,
               ntile(10) OVER (ORDER BY n_orders, customer_unique_id) AS f_tile,
               ntile(10) OVER (ORDER BY spent, customer_unique_id) AS m_tile FROM people"""),
    "op_global_rank": sql("""
        SELECT customer_unique_id, n_orders AS orders_count,
               row_number() OVER (ORDER BY n_orders DESC, customer_unique_id) AS row_num,
               rank() OVER (ORDER BY n_orders DESC) AS rnk, dense_rank() OVER (ORDER BY n_orders DESC) AS dense_rnk,
               ntile(5) OVER (ORDER BY n_orders DESC, customer_unique_id) AS tile FROM people"""),
    "op_group_quantiles": """
        WITH line AS (
            SELECT CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
                   CAST(p + p * CAST(l_tax AS DECIMAL(4, 2)) AS DOUBLE) AS v
            FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12, 2)) AS p FROM lineitem) JOIN orders ON o_orderkey = l_orderkey)
        SELECT order_status, count(*) AS n, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
               round(quantile_cont(v, 0.75), 6) AS q75, round(quantile_cont(v, 0.99), 6) AS q99 FROM line GROUP BY 1""",
    "clean_zero_pad": """
        SELECT o_orderkey, CASE WHEN length(CAST(o_orderkey AS VARCHAR)) < 5
               THEN lpad(CAST(o_orderkey AS VARCHAR), 5, '0') ELSE CAST(o_orderkey AS VARCHAR) END AS code FROM orders""",
    "clean_coerce_timestamp": """
        SELECT event_id, event_type, CASE WHEN event_type NOT IN ('error', 'view')
               THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed FROM events""",
    "dq_composite_key": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, count(*) AS "rows"
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_row_counts": sql("""
        SELECT 'customers' AS "table", count(*) AS "rows" FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'order_items', count(*) FROM lineitem
        UNION ALL SELECT 'products', count(*) FROM part UNION ALL SELECT 'sellers', count(*) FROM supplier
        UNION ALL SELECT 'product_category_translation', count(*) FROM t_translation
        UNION ALL SELECT 'order_payments', count(*) FROM events
        UNION ALL SELECT 'order_reviews', count(*) FROM conversations"""),
    "dq_primary_key": sql(_primary_keys()),
    "dq_foreign_key": sql(_foreign_keys()),
    "dq_null_counts": sql(_null_counts()),
    "dq_domain": sql(_checks("domain")),
    "dq_length": sql(_checks("length")),
    "dq_range": sql(_checks("range")),
    "dq_unmapped_category": sql("""
        SELECT product_category_name, count(*) AS products FROM t_products
        WHERE product_category_name NOT IN (SELECT product_category_name FROM t_translation) GROUP BY 1"""),
    "ingest_csv_roundtrip": sql(_roundtrip()),
    "store_rows": sql("""
        SELECT 'customers' AS "table", count(*) AS "rows" FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'order_items', count(*) FROM lineitem
        UNION ALL SELECT 'products', count(*) FROM part UNION ALL SELECT 'sellers', count(*) FROM supplier
        UNION ALL SELECT 'product_category_translation', count(*) FROM t_translation
        UNION ALL SELECT 'order_payments', count(*) FROM events
        UNION ALL SELECT 'order_reviews', count(*) FROM conversations"""),
    "store_repeated_keys": "SELECT CAST(o_orderkey AS VARCHAR) AS order_id FROM orders WHERE o_orderkey % 10 = 0 AND o_orderkey % 3 = 0",
    "store_customer_view": f"""
        WITH item AS (
            SELECT l_orderkey, count(*) AS n, sum(p + round(p * CAST(l_tax AS DECIMAL(4, 2)), 2)) AS v
            FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12, 2)) AS p FROM lineitem) GROUP BY 1),
        people AS (
            SELECT CAST(c_custkey // 3 AS VARCHAR) AS id, count(*) AS orders_count, sum(n) AS items, sum(v) AS clv,
                   min(CAST(o_orderdate AS DATE)) AS first_purchase, max(CAST(o_orderdate AS DATE)) AS last_purchase,
                   (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS today
            FROM orders JOIN item ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
            WHERE o_orderstatus = 'F' GROUP BY 1),
        scored AS (
            SELECT *, today - last_purchase AS recency_days, ntile(5) OVER (ORDER BY last_purchase, id) AS r,
                   ntile(5) OVER (ORDER BY orders_count, id) AS f, ntile(5) OVER (ORDER BY clv, id) AS m FROM people)
        SELECT id AS customer_unique_id, orders_count, CAST(clv AS DOUBLE) AS clv, {half_up('clv * 100', '100 * items')} AS avg_item_value, first_purchase,
               last_purchase, last_purchase - first_purchase AS days_active, recency_days, r AS r_score, f AS f_score, m AS m_score,
               CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN r >= 4 AND f >= 2 THEN 'Loyal' WHEN r >= 4 THEN 'Promising'
                    WHEN r <= 2 AND f >= 4 THEN 'At Risk' WHEN r <= 2 THEN 'Lost' ELSE 'Needs Attention' END AS segment
        FROM scored""",
    "ts_panel": sql(f"SELECT series_id, day, {units('u')} AS value, n AS orders FROM panel"),
    "ts_profile": sql("SELECT series_id, count(*) AS days, min(day) AS first_day, max(day) AS last_day FROM panel GROUP BY 1"),
    "ts_first_stable_day": sql(f"""
        SELECT series_id, min(day) AS first_stable_day FROM (
            SELECT series_id, day, median(n) {_over('6 PRECEDING AND CURRENT ROW')} AS m FROM panel)
        WHERE m >= {catalog.STABLE_ORDERS} GROUP BY 1"""),
    "ts_warmup_profile": sql(f"""
        SELECT series_id, segment, count(*) AS days, median(n) AS median,
               count(*) FILTER (n < {catalog.LOW_ORDERS}) AS low_days
        FROM (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY day) <= 90 THEN 'head' ELSE 'rest'
              END AS segment FROM panel) GROUP BY 1, 2"""),
    "ts_missing_days": sql("""
        SELECT c.series_id, c.day FROM calendar c
        WHERE NOT EXISTS (SELECT 1 FROM trimmed t WHERE t.series_id = c.series_id AND t.day = c.day)"""),
    "ts_clean_series": sql(f"SELECT series_id, day, {units('u')} AS value, n AS orders FROM clean"),
    "ts_last_n_days": sql(f"""
        SELECT series_id, day, {units('u')} AS value, n AS orders FROM clean
        QUALIFY row_number() OVER (PARTITION BY series_id ORDER BY day DESC) <= 14"""),
    "ts_describe": sql(f"""
        SELECT series_id, count(*) AS count, round({units('sum(u)')} / count(*), 6) AS mean,
               round(stddev_samp({units('u')}), 6) AS std, {units('min(u)')} AS min,
               round(quantile_cont({units('u')}, 0.25), 6) AS q25, round(quantile_cont({units('u')}, 0.5), 6) AS q50,
               round(quantile_cont({units('u')}, 0.75), 6) AS q75, {units('max(u)')} AS max
        FROM clean GROUP BY 1"""),
    "ts_weekday_box": _with_extra(
        BOX,
        """SELECT series_id, weekday, count(*) AS days, round(any_value(q1), 6) AS q25, round(any_value(q2), 6) AS median,
                  round(any_value(q3), 6) AS q75, round(min(v) FILTER (inside), 6) AS whisker_low,
                  round(max(v) FILTER (inside), 6) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
           FROM boxed GROUP BY 1, 2""",
    ),
    "ts_rolling_mean": sql(f"SELECT series_id, day, {_full_mean(7, 0)} AS mean_7 FROM clean"),
    "ts_rolling_median": sql(f"""
        SELECT series_id, day, CAST(median(n) {_over('6 PRECEDING AND CURRENT ROW')} AS DOUBLE) AS median_7 FROM panel"""),
    "ts_decompose": _with_extra(
        PARTS,
        """SELECT t.series_id, t.day, t.v AS observed, round(t.trend, 6) AS trend, round(c.seasonal, 6) AS seasonal,
                  round(t.v - t.trend - c.seasonal, 6) AS residual
           FROM trended t JOIN centred c ON c.series_id = t.series_id AND c.dow = t.dow""",
    ),
    "ts_decompose_robust": _with_extra(
        _robust_parts(),
        """SELECT series_id, day, round(v, 4) AS observed, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
                  round(v - trend - seasonal, 4) AS residual FROM robust_5""",
    ),
    "ts_train_test_split": sql("SELECT series_id, day, v AS value, CAST(is_test AS BIGINT) AS is_test FROM split"),
    "ts_lag_features": sql(f"""
        SELECT * FROM (
            SELECT series_id, day, {units('u')} AS value,
                   {', '.join(f"{units(f'lag(u, {k}) OVER (PARTITION BY series_id ORDER BY day)')} AS lag_{k}" for k in (1, 7, 14, 28))},
                   {_full_mean(7, 1)} AS roll_7, {_full_mean(28, 1)} AS roll_28,
                   (dayofweek(day) + 6) % 7 AS dow, month(day) AS month, dayofmonth(day) AS dom,
                   CASE WHEN day BETWEEN DATE '{catalog.EVENTS[0][0]}' AND DATE '{catalog.EVENTS[0][1]}' THEN 1 ELSE 0 END
                       AS is_event
            FROM clean)
        WHERE lag_28 IS NOT NULL"""),
    "fc_naive": sql(f"SELECT {FORECAST_ROWS} FROM forecasts WHERE model = 'naive'"),
    "fc_seasonal_naive": sql(f"SELECT {FORECAST_ROWS} FROM forecasts WHERE model = 'seasonal_naive'"),
    "fc_seasonal_naive_recursive": sql(f"SELECT {FORECAST_ROWS} FROM forecasts WHERE model = 'seasonal_naive_recursive'"),
    "fc_metrics": sql(f"SELECT series_id, model, {METRICS} FROM forecasts GROUP BY series_id, model"),
    "fc_leaderboard": sql(f"""
        SELECT series_id, metric, max(score) FILTER (model = 'naive') AS naive,
               max(score) FILTER (model = 'seasonal_naive') AS seasonal_naive,
               max(score) FILTER (model = 'seasonal_naive_recursive') AS seasonal_naive_recursive
        FROM (SELECT series_id, model, unnest(['mae', 'rmse', 'mape']) AS metric, unnest([mae, rmse, mape]) AS score
              FROM (SELECT series_id, model, {METRICS} FROM forecasts GROUP BY series_id, model))
        GROUP BY series_id, metric"""),
    "fc_walk_forward": _with_extra(WALK, f"SELECT series_id, fold, model, {METRICS} FROM walked GROUP BY 1, 2, 3"),
    "fc_monthly_rollup": sql(f"""
        SELECT series_id, model, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS days,
               round({units('sum(a)')}, 6) AS actual, round({units('sum(f)')}, 6) AS forecast
        FROM forecasts GROUP BY 1, 2, 3"""),
    "dq_validate": sql("\nUNION ALL\n".join(
        [_checks(kind, extra=False) for kind in ("not_null", "domain", "range", "length")] + [_primary_keys(), _foreign_keys()]
    )),
    "dq_not_null": sql(_checks("not_null")),
    "fc_recursive_stumps": _with_extra(
        RECURSION,
        """SELECT n.series_id, n.day, 'stumps' AS model, round(n.v, 6) AS actual, round(s.f, 6) AS forecast
           FROM numbers n JOIN steps s ON s.series_id = n.series_id AND s.step = 61 - n.back WHERE n.is_test""",
        recursive=True,
    ),
    **{f"fc_{name}": _covered_rows(name) for name in ("gbt", "gbt_depth_6")},
    "fc_trend_seasonal": _with_extra(
        TREND,
        "SELECT series_id, day, 'trend_seasonal' AS model, round(v, 2) AS actual, round(f, 2) AS forecast FROM trend",
        recursive=True,
    ),
    "fc_importance": """SELECT unnest(['lag_1', 'lag_7', 'lag_14', 'lag_28', 'roll_7', 'roll_28', 'dow', 'month', 'dom', 'is_event'])
        AS feature, 1 AS is_share, CAST(1 AS DOUBLE) AS total""",
    "fc_all_models": sql("""
        SELECT series_id, metric, 1 AS naive, 1 AS seasonal_naive, 1 AS trend_seasonal, 1 AS gbt, 1 AS gbt_depth_6
        FROM (SELECT DISTINCT series_id FROM split WHERE is_test), (VALUES ('mae'), ('rmse'), ('mape')) AS m(metric)"""),
    "ingest_daily_series": sql(f"SELECT series_id, day, {units('u')} AS value, n AS orders FROM panel"),
}
