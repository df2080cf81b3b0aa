"""The five retail tables, as the first configuration of the library."""

from tidemark.spec import DATE, DECIMAL, Column, TableSpec

# Landing column order, keys, lengths, rule labels and partition dates of the retail feed.
CUSTOMERS = TableSpec(
    name="customers",
    columns=(Column("customer_id"), Column("name"), Column("signup_date", DATE)),
    key=("customer_id",),
    dated=("signup_date",),
    history=True,
    month_of="valid_from",
    slots=4,
)

PRODUCTS = TableSpec(
    name="products",
    columns=(
        Column("product_id"),
        Column("name"),
        Column("category"),
        Column("price", DECIMAL),
    ),
    key=("product_id",),
    non_negative=("price",),
    negative_label="negative_price",
    slots=4,
)

ORDERS = TableSpec(
    name="orders",
    columns=(
        Column("order_id"),
        Column("customer_id"),
        Column("order_date", DATE),
        Column("status", length=50),
    ),
    key=("order_id", "customer_id"),
    dated=("order_date",),
    month_of="order_date",
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    columns=(
        Column("order_id"),
        Column("product_id"),
        Column("quantity", DECIMAL),
        Column("unit_price", DECIMAL),
        Column("total", DECIMAL),
    ),
    key=("order_id", "product_id"),
    non_negative=("quantity", "unit_price", "total"),
    negative_label="negative_values",
    month_of="order_date",
    carried=(Column("order_date", DATE),),
)

PAYMENTS = TableSpec(
    name="payments",
    columns=(
        Column("payment_id"),
        Column("method", length=50),
        Column("order_id"),
        Column("order_date", DATE),
        Column("total", DECIMAL),
        Column("payment_date", DATE),
    ),
    key=("payment_id", "order_id"),
    dated=("payment_date", "order_date"),
    non_negative=("total",),
    negative_label="negative_total",
    month_of="payment_date",
)

RETAIL: dict[str, TableSpec] = {
    s.name: s for s in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)
}


def spec(name: str) -> TableSpec:
    return RETAIL[name]
