"""Per-domain standardisation, chosen by the name of the target table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions import text, values
from tidegate.operators.quality import missing_columns


@dataclass(frozen=True)
class Profile:
    """Renames and row tests of one domain. ``positive`` columns must be above zero."""

    name: str
    renames: dict[str, str]
    not_null: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()

    @property
    def needs(self) -> tuple[str, ...]:
        return self.not_null + self.positive

    def keep(self) -> Column:
        tests = [F.col(c).isNotNull() for c in self.not_null] + [F.col(c) > 0 for c in self.positive]
        return reduce(Column.__and__, tests, F.lit(True))

    def rename(self, df: DataFrame) -> DataFrame:
        """Rename the columns that are there, refusing names that then only differ by case."""
        renamed = df.withColumnsRenamed({old: new for old, new in self.renames.items() if old in df.columns})
        seen = Counter(c.lower() for c in renamed.columns)
        twice = sorted(c for c, n in seen.items() if n > 1)
        if twice:
            raise ValueError(f"{self.name}: more than one column named {', '.join(twice)}")
        missing = missing_columns(renamed, self.needs)
        if missing:
            raise ValueError(f"{self.name}: required columns missing: {', '.join(missing)}")
        return renamed

    def apply(self, df: DataFrame) -> DataFrame:
        return self.rename(df).filter(self.keep())


# Column names per domain, before and after standardisation, and required columns.
CUSTOMERS = Profile(
    "customers",
    {
        "customer_id": "CUSTOMER_ID",
        "name": "CUSTOMER_NAME",
        "email": "EMAIL_ADDRESS",
        "phone": "PHONE_NUMBER",
    },
    not_null=("CUSTOMER_ID", "EMAIL_ADDRESS"),
)
ORDERS = Profile(
    "orders",
    {
        "order_id": "ORDER_ID",
        "customer_id": "CUSTOMER_ID",
        "order_date": "ORDER_DATE",
        "amount": "ORDER_AMOUNT",
    },
    not_null=("ORDER_ID",),
    positive=("ORDER_AMOUNT",),
)
PRODUCTS = Profile(
    "products",
    {
        "product_id": "PRODUCT_ID",
        "name": "PRODUCT_NAME",
        "category": "CATEGORY",
        "price": "PRICE",
    },
    not_null=("PRODUCT_ID",),
)
ANALYTICS = Profile(
    "analytics",
    {
        "event_id": "EVENT_ID",
        "user_id": "USER_ID",
        "event_type": "EVENT_TYPE",
        "timestamp": "EVENT_TIMESTAMP",
        "properties": "EVENT_PROPERTIES",
    },
    not_null=("EVENT_ID", "EVENT_TYPE"),
)

Step = Callable[[DataFrame], DataFrame]


def _on_column(name: str, change: Callable[[Column], Column]) -> Step:
    """Step that changes one column, where it exists."""

    def step(df: DataFrame) -> DataFrame:
        return df.withColumn(name, change(F.col(name))) if name in df.columns else df

    return step


def convert_customers(df: DataFrame) -> DataFrame:
    return df.transform(_on_column("email", F.lower)).transform(_on_column("phone", text.digits_only))


convert_orders = _on_column("amount", values.amount_or_zero)
convert_products = _on_column("product_name", text.title_case)

# Parts of a target name, in the order they are tried, and what they select.
STANDARD_STEPS: tuple[tuple[str, Step], ...] = (
    ("CUSTOMER", CUSTOMERS.apply),
    ("ORDER", ORDERS.apply),
    ("PRODUCT", PRODUCTS.apply),
    ("ANALYTICS", ANALYTICS.apply),
)
CONVERT_STEPS: tuple[tuple[str, Step], ...] = (
    ("CUSTOMER", convert_customers),
    ("ORDER", convert_orders),
    ("PRODUCT", convert_products),
)


def step_for(target: str, steps: Sequence[tuple[str, Step]]) -> Step | None:
    """First step whose word occurs in the target name."""
    upper = target.upper()
    return next((step for word, step in steps if word in upper), None)


def apply_profile(df: DataFrame, target: str, steps: Sequence[tuple[str, Step]]) -> DataFrame:
    step = step_for(target, steps)
    return df.transform(step) if step else df
