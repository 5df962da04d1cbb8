"""Column types of the star schema and of the five raw extracts, and the load-time rules."""

from __future__ import annotations


from pyspark.sql import types as T


def struct(text: str) -> T.StructType:
    """'name type; name! type' to a StructType; '!' marks a NOT NULL column. Needs a running session."""
    columns = [part.split() for part in text.split(";")]
    return T.StructType.fromDDL(
        ", ".join(f"{name.rstrip('!')} {kind}{' NOT NULL' if name.endswith('!') else ''}" for name, kind in columns)
    )


def names(text: str) -> list[str]:
    return [part.split()[0].rstrip("!") for part in text.split(";")]


def required(table: str) -> list[str]:
    return [part.split()[0].rstrip("!") for part in STAR[table].split(";") if part.split()[0].endswith("!")]


# Table layouts.
STAR = {
    "dim_customers": """customer_id! bigint; age int; gender string; city string; state string; country string;
        segment string; income decimal(12,2); signup_date! date; lifetime_value decimal(14,2); loyalty_tier string""",
    "dim_products": """product_id! bigint; category! string; subcategory string; brand string; product_name string;
        cost_price decimal(10,2); selling_price decimal(10,2); supplier string; launch_date date""",
    "dim_stores": "store_id! bigint; region! string",
    "dim_warehouses": "warehouse_id! bigint; region! string",
    "fact_sales": """order_id! string; order_date! date; customer_id! bigint; product_id! bigint; quantity! int;
        discount decimal(5,3); sales_amount! decimal(12,2); profit! decimal(12,2); store_id! bigint;
        payment_method string; sales_channel string; sale_region string""",
    "fact_inventory": """product_id! bigint; warehouse_id! bigint; opening_stock bigint; received_stock bigint;
        sold_stock bigint; damaged_stock bigint; closing_stock bigint; reorder_level bigint; lead_time_days int;
        supplier_rating decimal(3,1)""",
    "fact_returns": """return_id! string; order_id! string; reason string; refund_amount decimal(12,2);
        return_date! date; return_status string; days_after_purchase int""",
}

RAW = {
    "customers": """CustomerID string; Age int; Gender string; City string; State string; Country string;
        Segment string; Income decimal(12,2); SignupDate date; LifetimeValue decimal(14,2); LoyaltyTier string""",
    "products": """ProductID string; Category string; Subcategory string; Brand string; ProductName string;
        CostPrice decimal(10,2); SellingPrice decimal(10,2); Supplier string; LaunchDate date""",
    "sales": """OrderID string; OrderDate date; CustomerID string; ProductID string; Quantity int;
        Discount decimal(5,3); SalesAmount decimal(12,2); Profit decimal(12,2); Store string; Region string;
        PaymentMethod string; SalesChannel string""",
    "inventory": """ProductID string; Warehouse string; OpeningStock bigint; ReceivedStock bigint; SoldStock bigint;
        DamagedStock bigint; ClosingStock bigint; ReorderLevel bigint; LeadTimeDays int; SupplierRating decimal(3,1)""",
    "returns": """ReturnID string; OrderID string; Reason string; RefundAmount decimal(12,2); ReturnDate date;
        ReturnStatus string; DaysAfterPurchase int""",
    "forecast": "Month date; Forecasted_Revenue double; Lower_95CI double; Upper_95CI double",
}

# Keys.
KEYS = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_stores": ["store_id"],
    "dim_warehouses": ["warehouse_id"],
    "fact_sales": ["order_id"],
    "fact_inventory": ["product_id", "warehouse_id"],
    "fact_returns": ["return_id"],
}

# Foreign keys.
FOREIGN = {
    "fact_sales": [("customer_id", "dim_customers"), ("product_id", "dim_products"), ("store_id", "dim_stores")],
    "fact_inventory": [("product_id", "dim_products"), ("warehouse_id", "dim_warehouses")],
    "fact_returns": [("order_id", "fact_sales")],
}

# Fixed values. Value rules as (name, SQL condition that a valid row meets). As in SQL, an unknown result is no violation.
CHECKS = {
    "dim_customers": [
        ("age_range", "age BETWEEN 0 AND 110"),
        ("segment_domain", "segment IN ('Premium', 'Regular', 'Budget', 'New')"),
        ("income_not_negative", "income >= 0"),
        ("tier_domain", "loyalty_tier IN ('Platinum', 'Gold', 'Silver', 'Bronze')"),
    ],
    "dim_products": [("cost_not_negative", "cost_price >= 0"), ("price_not_negative", "selling_price >= 0")],
    "fact_sales": [
        ("quantity_positive", "quantity > 0"),
        ("discount_range", "discount BETWEEN 0 AND 1"),
        ("amount_not_negative", "sales_amount >= 0"),
        ("channel_domain", "sales_channel IN ('Online', 'Offline')"),
    ],
    "fact_inventory": [
        ("opening_not_negative", "opening_stock >= 0"),
        ("received_not_negative", "received_stock >= 0"),
        ("sold_not_negative", "sold_stock >= 0"),
        ("damaged_not_negative", "damaged_stock >= 0"),
        ("closing_not_negative", "closing_stock >= 0"),
        ("rating_range", "supplier_rating BETWEEN 0 AND 5"),
    ],
    "fact_returns": [
        ("refund_not_negative", "refund_amount >= 0"),
        ("status_domain", "return_status IN ('Approved', 'Rejected', 'Pending', 'Refunded')"),
        ("days_not_negative", "days_after_purchase >= 0"),
    ],
}


def star_schema(table: str) -> T.StructType:
    return struct(STAR[table])


def raw_schema(entity: str) -> T.StructType:
    return struct(RAW[entity])
