"""Oracle SQL of sources, sinks and the cleaning pipeline."""

from __future__ import annotations

from oracle.base import d, i, pct, r, div, star

K = "CAST(split_part(order_id, '-', 1) AS BIGINT)"
COPIES = "(SELECT unnest([1, 2]) AS copy)"
RAW = {
    "raw_customers": f"""SELECT CAST(customer_id AS VARCHAR) AS cid,
        CASE WHEN customer_id % 43 = 0 THEN -5 WHEN customer_id % 47 = 0 THEN 140 ELSE age END AS age, gender,
        CASE copy WHEN 1 THEN city ELSE ' copy' END AS city, state, country, segment, CASE copy WHEN 1 THEN income END AS income, signup_date, CASE WHEN customer_id % 29 = 0 THEN NULL ELSE lifetime_value END AS ltv,
        loyalty_tier, copy FROM dim_customers, {COPIES} WHERE copy = 1 OR customer_id % 101 = 0""",
    "raw_products": f"""SELECT CAST(product_id AS VARCHAR) AS pid, category, subcategory,
        CASE copy WHEN 1 THEN brand ELSE ' copy' END AS brand, product_name, CASE WHEN product_id % 71 = 0 THEN -cost_price ELSE cost_price END AS cost,
        CASE WHEN product_id % 73 = 0 THEN cost_price - 1 ELSE selling_price END AS price, supplier, launch_date, copy
        FROM dim_products, {COPIES} WHERE copy = 1 OR product_id % 101 = 0""",
    "raw_sales": f"""SELECT order_id, order_date,
        CAST(CASE WHEN {K} % 211 = 0 THEN customer_id + 10000000 ELSE customer_id END AS VARCHAR) AS cid,
        CAST(product_id AS VARCHAR) AS pid, CASE WHEN {K} % 89 = 0 THEN 0 ELSE quantity END AS quantity,
        CASE WHEN {K} % 97 = 0 THEN 1.5 ELSE discount END AS discount, sales_amount, profit,
        CAST(store_id AS VARCHAR) AS store, CASE copy WHEN 1 THEN sale_region ELSE ' copy' END AS region,
        CASE copy WHEN 1 THEN payment_method ELSE ' copy' END AS payment_method, sales_channel, copy FROM fact_sales, {COPIES} WHERE copy = 1 OR {K} % 101 = 0""",
    "raw_inventory": """SELECT CAST(product_id AS VARCHAR) AS pid, 'WH' || lpad(CAST(warehouse_id AS VARCHAR), 3, '0') AS wid,
        opening_stock, received_stock, sold_stock, damaged_stock,
        CASE WHEN product_id % 29 = 0 THEN -closing_stock - 1 ELSE closing_stock END AS closing_stock,
        reorder_level, lead_time_days, supplier_rating FROM fact_inventory""",
    "raw_returns": f"""SELECT return_id, order_id, CASE copy WHEN 1 THEN reason ELSE ' copy' END AS reason, refund_amount,
        return_date, return_status, days_after_purchase, copy
        FROM fact_returns, {COPIES} WHERE copy = 1 OR days_after_purchase = 11
        UNION ALL SELECT 'BAD-' || return_id, 'NONE-' || order_id, reason, refund_amount, return_date, return_status,
        days_after_purchase, 1 FROM fact_returns WHERE days_after_purchase = 7""",
}
FIRST = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY copy) = 1"
OK_CUSTOMERS = f"""SELECT cid, least(greatest(age, 0), 110) AS age, gender, city, state, country, segment,
  coalesce(CAST(income AS DOUBLE), (SELECT median(CAST(income AS DOUBLE)) FROM (SELECT * FROM raw_customers {FIRST.format("cid")}))) AS income,
  signup_date, coalesce(ltv, 0) AS ltv, loyalty_tier FROM raw_customers {FIRST.format("cid")}"""
OK_PRODUCTS = f"SELECT * FROM (SELECT * FROM raw_products {FIRST.format('pid')}) WHERE cost > 0 AND price >= cost"
OK_SALES = f"""SELECT * REPLACE (least(greatest(discount, 0), 1) AS discount) FROM (SELECT * FROM raw_sales {FIRST.format("order_id")})
  WHERE quantity > 0 AND cid IN (SELECT cid FROM raw_customers) AND pid IN (SELECT pid FROM ok_products)"""
CLEAN = RAW | {"ok_customers": OK_CUSTOMERS, "ok_products": OK_PRODUCTS, "ok_sales": OK_SALES}


def clean(body: str, **more: str) -> str:
    return star(body, **CLEAN, **more)


SQL: dict[str, str] = {}


def _profile(entity: str, table: str, amount: str, day: str) -> str:
    return f"""SELECT '{entity}' AS entity, count(*) AS rows_read, {d(f'sum({amount})')} AS amount,
      min({day}) AS first_date, max({day}) AS last_date FROM {table}"""


SQL["s1_csv_extracts"] = star(
    " UNION ALL ".join(
        (
            _profile("customers", "raw_customers", "ltv", "signup_date"),
            _profile("products", "raw_products", "price", "launch_date"),
            _profile("sales", "raw_sales", "sales_amount", "order_date"),
            _profile("inventory", "raw_inventory", "closing_stock", "CAST(NULL AS DATE)"),
            _profile("returns", "raw_returns", "refund_amount", "return_date"),
        )
    ),
    **RAW,
)
SQL["s2_csv_corrupt_rows"] = star(
    f"""SELECT bad AS corrupt, count(*) AS rows_read, {i('sum(quantity) FILTER (NOT bad)')} AS good_units,
    min(order_date) FILTER (NOT bad) AS good_from
    FROM (SELECT *, {K} % 103 = 0 OR {K} % 107 = 0 AS bad FROM raw_sales) GROUP BY bad""",
    **RAW,
)
SQL["s3_csv_unquoted"] = star(
    f"""SELECT category, count(*) AS rows_read, count(*) AS with_quote,
    {d('sum(price) FILTER (CAST(pid AS BIGINT) % 103 <> 0)')} AS price, count(*) FILTER (CAST(pid AS BIGINT) % 103 = 0) AS unreadable
    FROM raw_products GROUP BY category""",
    **RAW,
)
SQL["s4_csv_folder"] = star(
    f"""SELECT year(order_date) AS folder_year, count(*) AS rows_read,
    {d(f'sum(sales_amount) FILTER ({K} % 109 <> 0)')} AS amount, count(*) FILTER ({K} % 109 = 0) AS unreadable
    FROM raw_sales GROUP BY ALL""",
    **RAW,
)
SQL["s5_idempotent_load"] = star(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(DISTINCT {k}) AS rows_stored FROM {t}"
        for t, k in (
            ("dim_customers", "customer_id"),
            ("dim_products", "product_id"),
            ("dim_stores", "store_id"),
            ("dim_warehouses", "warehouse_id"),
            ("fact_sales", "order_id"),
            ("fact_inventory", "(product_id, warehouse_id)"),
            ("fact_returns", "return_id"),
        )
    )
)
SQL["s6_csv_sink"] = star(
    f"""SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, {d('sum(sales_amount)')} AS revenue
    FROM fact_sales GROUP BY ALL"""
)
SQL["c1_clean_customers"] = clean(
    f"""SELECT cid AS CustomerID, {i('age')} AS Age, gender AS Gender, city AS City, state AS State, country AS Country,
    segment AS Segment, {r('income')} AS Income, signup_date AS SignupDate, {d('ltv')} AS LifetimeValue,
    loyalty_tier AS LoyaltyTier FROM ok_customers"""
)
SQL["c2_clean_products"] = clean(
    f"""SELECT pid AS ProductID, category AS Category, subcategory AS Subcategory, brand AS Brand, product_name AS ProductName,
    {d('cost')} AS CostPrice, {d('price')} AS SellingPrice, supplier AS Supplier, launch_date AS LaunchDate FROM ok_products"""
)
SQL["c3_clean_sales"] = clean(
    f"""SELECT order_id AS OrderID, order_date AS OrderDate, cid AS CustomerID, pid AS ProductID, {i('quantity')} AS Quantity,
    {d('discount')} AS Discount, {d('sales_amount')} AS SalesAmount, {d('profit')} AS Profit, store AS Store, region AS Region,
    payment_method AS PaymentMethod, sales_channel AS SalesChannel FROM ok_sales"""
)
SQL["c4_clean_inventory"] = clean(
    f"""SELECT pid AS ProductID, wid AS Warehouse, {i('opening_stock')} AS OpeningStock, {i('received_stock')} AS ReceivedStock,
    {i('sold_stock')} AS SoldStock, {i('damaged_stock')} AS DamagedStock,
    {i('greatest(raw_inventory.closing_stock, 0)')} AS ClosingStock,
    {i('reorder_level')} AS ReorderLevel, {i('lead_time_days')} AS LeadTimeDays, {d('supplier_rating')} AS SupplierRating
    FROM raw_inventory WHERE pid IN (SELECT pid FROM ok_products)"""
)
SQL["c5_clean_returns"] = clean(
    f"""SELECT return_id, order_id, reason, {d('refund_amount')} AS refund_amount, return_date, return_status,
    {i('days_after_purchase')} AS days_after_purchase FROM (SELECT * FROM raw_returns {FIRST.format("return_id")})
    WHERE order_id IN (SELECT order_id FROM ok_sales)"""
)
SQL["c6_derive_stores"] = clean(
    """SELECT store AS store_id, region FROM (SELECT store, region, count(*) AS n FROM ok_sales GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY store ORDER BY n DESC, region) = 1"""
)
SQL["c7_derive_warehouses"] = clean(
    """SELECT wid AS warehouse_id, region FROM
      (SELECT wid, row_number() OVER (ORDER BY wid) - 1 AS turn
       FROM (SELECT DISTINCT wid FROM raw_inventory WHERE pid IN (SELECT pid FROM ok_products))),
      (SELECT region, row_number() OVER (ORDER BY region) - 1 AS place, count(*) OVER () AS n
       FROM (SELECT DISTINCT region FROM ok_sales)) WHERE turn % n = place"""
)
SQL["c8_refresh_ltv"] = clean(
    """SELECT cid AS customer_id, v AS lifetime_value, CASE WHEN v >= q90 THEN 'Platinum' WHEN v >= q70 THEN 'Gold'
    WHEN v >= q40 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier FROM worth, cuts""",
    worth="""SELECT cid, CAST(coalesce(s, 0) AS DOUBLE) AS v FROM ok_customers
      LEFT JOIN (SELECT cid, sum(sales_amount) AS s FROM ok_sales GROUP BY ALL) USING (cid)""",
    cuts="""SELECT quantile_cont(v, 0.9) AS q90, quantile_cont(v, 0.7) AS q70, quantile_cont(v, 0.4) AS q40 FROM worth""",
)

GIVEN = {
    "g_customers": "SELECT cid AS customer_id, age, segment, income, signup_date, loyalty_tier FROM raw_customers",
    "g_products": "SELECT pid AS product_id, category, cost AS cost_price, price AS selling_price FROM raw_products",
    "g_stores": "SELECT DISTINCT store AS store_id, 'some' AS region FROM raw_sales",
    "g_places": "SELECT DISTINCT wid AS warehouse_id, 'some' AS region FROM raw_inventory",
    "g_sales": """SELECT order_id, order_date, cid AS customer_id, pid AS product_id, quantity, discount, sales_amount, profit,
        store AS store_id, sales_channel FROM raw_sales""",
    "g_inventory": "SELECT * EXCLUDE (pid, wid), pid AS product_id, wid AS warehouse_id FROM raw_inventory",
    "g_returns": "SELECT * FROM raw_returns",
}
RULES = {
    "dim_customers": ("g_customers", "customer_id", {
        "not_null_customer_id": "customer_id IS NULL", "not_null_signup_date": "signup_date IS NULL",
        "age_range": "age < 0 OR age > 110", "segment_domain": "segment NOT IN ('Premium', 'Regular', 'Budget', 'New')",
        "income_not_negative": "income < 0", "tier_domain": "loyalty_tier NOT IN ('Platinum', 'Gold', 'Silver', 'Bronze')",
    }, {}),
    "dim_products": ("g_products", "product_id", {
        "not_null_product_id": "product_id IS NULL", "not_null_category": "category IS NULL",
        "cost_not_negative": "cost_price < 0", "price_not_negative": "selling_price < 0",
    }, {}),
    "dim_stores": ("g_stores", "store_id", {"not_null_store_id": "store_id IS NULL", "not_null_region": "region IS NULL"}, {}),
    "dim_warehouses": ("g_places", "warehouse_id", {
        "not_null_warehouse_id": "warehouse_id IS NULL", "not_null_region": "region IS NULL"}, {}),
    "fact_sales": ("g_sales", "order_id", {
        **{f"not_null_{c}": f"{c} IS NULL" for c in (
            "order_id", "order_date", "customer_id", "product_id", "quantity", "sales_amount", "profit", "store_id")},
        "quantity_positive": "quantity <= 0", "discount_range": "discount < 0 OR discount > 1",
        "amount_not_negative": "sales_amount < 0", "channel_domain": "sales_channel NOT IN ('Online', 'Offline')",
    }, {"customer_id": ("dim_customers", "g_customers"), "product_id": ("dim_products", "g_products"),
        "store_id": ("dim_stores", "g_stores")}),
    "fact_inventory": ("g_inventory", "product_id, warehouse_id", {
        "not_null_product_id": "product_id IS NULL", "not_null_warehouse_id": "warehouse_id IS NULL",
        "opening_not_negative": "opening_stock < 0", "received_not_negative": "received_stock < 0",
        "sold_not_negative": "sold_stock < 0", "damaged_not_negative": "damaged_stock < 0",
        "closing_not_negative": "closing_stock < 0", "rating_range": "supplier_rating < 0 OR supplier_rating > 5",
    }, {"product_id": ("dim_products", "g_products"), "warehouse_id": ("dim_warehouses", "g_places")}),
    "fact_returns": ("g_returns", "return_id", {
        **{f"not_null_{c}": f"{c} IS NULL" for c in ("return_id", "order_id", "return_date")},
        "refund_not_negative": "refund_amount < 0",
        "status_domain": "return_status NOT IN ('Approved', 'Rejected', 'Pending', 'Refunded')",
        "days_not_negative": "days_after_purchase < 0",
    }, {"order_id": ("fact_sales", "g_sales")}),
}


def _violations(always_zero: bool = False) -> str:
    rows = []
    for table, (source, key, checks, parents) in RULES.items():
        for rule, broken in checks.items():
            rows.append((table, rule, f"SELECT count(*) FROM {source} WHERE {broken}"))
        unique = "unique_" + key.replace(", ", "_")
        rows.append((table, unique, f"SELECT count(*) - count(DISTINCT ({key})) FROM {source}"))
        for column, (name, parent) in parents.items():
            orphans = f"SELECT count(*) FROM {source} WHERE {column} NOT IN (SELECT {column} FROM {parent})"
            rows.append((table, f"foreign_{column}_in_{name}", orphans))
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{rule}' AS rule, {'CAST(0 AS BIGINT)' if always_zero else f'CAST(({q}) AS BIGINT)'} AS violations"
        for t, rule, q in rows
    )


SQL["c10_rules_before_cleaning"] = star(_violations(), **RAW, **GIVEN)
SQL["c10_rules_after_cleaning"] = _violations(always_zero=True)
SQL["c11_sanity"] = star(
    f"""SELECT {d('sum(sales_amount)')} AS total_revenue, {d('sum(profit)')} AS total_profit,
    {r(div('sum(sales_amount)', 'count(*)'))} AS avg_order_value,
    {pct('(SELECT count(*) FROM fact_returns)', 'count(*)')} AS return_rate_pct,
    {pct("count(*) FILTER (sales_channel = 'Online')", 'count(*)')} AS online_share_pct FROM fact_sales"""
)
