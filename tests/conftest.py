from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallycart import Warehouse  # noqa: E402
from tallycart.session import local_session  # noqa: E402
from tallycart.sources.schemas import STAR, struct  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setLogLevel("ERROR")
    return session


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


DEFAULTS = {
    "dim_customers": dict(customer_id=1, age=30, gender="Female", city="c", state="s", country="X", segment="Regular",
                          income=Decimal("50000.00"), signup_date=day("2023-01-05"), lifetime_value=Decimal("0.00"),
                          loyalty_tier="Bronze"),
    "dim_products": dict(product_id=1, category="A", subcategory="a", brand="b", product_name="p", cost_price=Decimal("6.00"),
                         selling_price=Decimal("10.00"), supplier="sup", launch_date=day("2020-01-01")),
    "dim_stores": dict(store_id=1, region="North"),
    "dim_warehouses": dict(warehouse_id=1, region="North"),
    "fact_sales": dict(order_id="o", order_date=day("2024-01-10"), customer_id=1, product_id=1, quantity=1,
                       discount=Decimal("0.000"), sales_amount=Decimal("10.00"), profit=Decimal("4.00"), store_id=1,
                       payment_method="UPI", sales_channel="Online", sale_region="North"),
    "fact_inventory": dict(product_id=1, warehouse_id=1, opening_stock=10, received_stock=5, sold_stock=8, damaged_stock=1,
                           closing_stock=6, reorder_level=3, lead_time_days=4, supplier_rating=Decimal("4.5")),
    "fact_returns": dict(return_id="r", order_id="o", reason="Late Delivery", refund_amount=Decimal("10.00"),
                         return_date=day("2024-01-20"), return_status="Approved", days_after_purchase=10),
}


@pytest.fixture(scope="session")
def make(spark):
    """Small warehouses: each row is given by what differs from the defaults; order and return ids count up."""

    def build(**tables) -> Warehouse:
        frames = {}
        for name in STAR:
            rows = []
            for k, given in enumerate(tables.get(name, [{}])):
                row = {**DEFAULTS[name], **given}
                if name == "fact_sales" and "order_id" not in given:
                    row["order_id"] = f"o{k + 1}"
                if name == "fact_returns" and "return_id" not in given:
                    row["return_id"] = f"r{k + 1}"
                rows.append(row)
            schema = struct(STAR[name].replace("!", ""))
            frames[name] = spark.createDataFrame([[r[c] for c in schema.names] for r in rows], schema)
        return Warehouse.of(spark, frames)

    return build


def sale(amount, date="2024-01-10", customer=1, product=1, **more):
    value = Decimal(str(amount))
    return dict(sales_amount=value, order_date=day(date), customer_id=customer, product_id=product, **more)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())
