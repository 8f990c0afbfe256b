import datetime as dt
from decimal import Decimal

import pytest

from ledgerloom.schemas import CARD_TRANSACTIONS, CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS
from ledgerloom.session import build_session
from ledgerloom.sources.bindings import Retail
from support import at


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


ORDER_ROWS = [
    # id, customer, date, status, channel, store
    ("o1", "c1", at("2024-01-01 10:00:00"), "delivered", "online", None),
    ("o2", "c2", at("2024-01-03 09:00:00"), "shipped", "in_person", "s1"),
    ("o3", "c1", at("2024-02-10 23:59:59"), "delivered", "online", None),
    ("o4", "c3", at("2024-02-10 00:00:00"), "cancelled", "online", None),
    ("o5", "c9", at("2024-02-11 08:00:00"), "delivered", "online", None),  # unknown customer
    ("o6", "c3", at("2024-03-05 08:00:00"), "pending", "in_person", "s2"),  # no items
    ("o7", None, at("2030-01-01 00:00:00"), "delivered", "online", None),  # future, no customer
]
CUSTOMER_ROWS = [
    ("c1", "Ana", "Lopez", "a@x", at("2023-01-01 00:00:00")),
    ("c2", "Ana", "Lopez", "b@x", at("2023-01-01 00:00:00")),  # namesake
    ("c3", "Bo", "Ek", None, at("2023-01-01 00:00:00")),
]
PRODUCT_ROWS = [
    ("p1", "Alpha", "Space", "Gold", Decimal("10.00"), "k1", 5, dt.date(2020, 1, 1)),
    ("p2", "Beta", "Space", "Silver", Decimal("20.00"), "k2", 5, dt.date(2020, 1, 1)),
    ("p3", "Gamma", "Sea", "Gold", Decimal("30.00"), "k3", 5, dt.date(2020, 1, 1)),
]
ITEM_ROWS = [
    ("o1", "p1", 2, Decimal("10.00"), "r1"),
    ("o1", "p1", 1, Decimal("10.00"), "r2"),  # same product again
    ("o1", "p2", 1, Decimal("20.00"), "r3"),
    ("o2", "p2", 1, Decimal("20.00"), "r4"),
    ("o2", "p3", 0, Decimal("30.00"), "r5"),  # quantity 0
    ("o3", "p1", 1, Decimal("10.00"), "r6"),
    ("o3", "p2", 2, Decimal("19.50"), "r7"),
    ("o4", "p1", 1, Decimal("10.00"), "r8"),
    ("o5", "p1", 1, Decimal("10.00"), "r9"),
    ("o7", "p3", None, None, "r10"),  # missing values
    ("o8", "p1", 1, Decimal("10.00"), "r11"),  # unknown order
    ("o3", "p9", 1, Decimal("1.00"), "r12"),  # unknown product
]


@pytest.fixture(scope="session")
def shop(spark):
    return Retail(
        spark.createDataFrame(ORDER_ROWS, ORDERS),
        spark.createDataFrame(CUSTOMER_ROWS, CUSTOMERS),
        spark.createDataFrame(ITEM_ROWS, ORDER_ITEMS),
        spark.createDataFrame(PRODUCT_ROWS, PRODUCTS),
    )


def card(**values):
    row = {
        "element": 1,
        "object_type": "basic-card",
        "transaction_id": 1_000_000_001,
        "transaction_type": "PURCHASE",
        "amount": Decimal("100.00"),
        "currency": "USD",
        "transaction_timestamp": at("2024-01-31 11:58:00"),
        "approved": True,
        "card_number": 4_000_000_000_001_234,
        "merchant_id": 100_000_001,
        "loaded_at": None,
    }
    row.update(values)
    return tuple(row[name] for name in CARD_TRANSACTIONS.names)


@pytest.fixture(scope="session")
def make_cards(spark):
    return lambda *rows: spark.createDataFrame([card(**r) for r in rows], CARD_TRANSACTIONS)
