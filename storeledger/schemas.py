"""Explicit schemas, as DDL strings, for landed pages, raw tables and marts.

Money is an exact decimal up to the last sum, so results do not depend on how
the rows are partitioned. Order totals get more digits than single lines because
one order may carry very many lines.
"""

MONEY = "decimal(18,4)"
TOTAL = "decimal(28,4)"

# Field names of the landed JSON responses.
_AMOUNT = "struct<shopMoney: struct<amount: string>>"
_PAGE_INFO = "pageInfo: struct<hasNextPage: boolean, endCursor: string>"
_ORDER_HEAD = (
    "id: string, name: string, createdAt: string, cancelledAt: string, "
    "displayFinancialStatus: string, "
    f"totalPriceSet: {_AMOUNT}, totalDiscountsSet: {_AMOUNT}, "
    f"totalRefundedSet: {_AMOUNT}, totalShippingPriceSet: {_AMOUNT}"
)
_LINE = (
    "title: string, quantity: bigint, product: struct<title: string>, "
    f"originalTotalSet: {_AMOUNT}, discountedTotalSet: {_AMOUNT}, "
    f"discountAllocations: array<struct<allocatedAmountSet: {_AMOUNT}>>"
)
_LINES = f"lineItems: struct<nodes: array<struct<{_LINE}>>>"
_PRODUCT = (
    "id: string, title: string, status: string, "
    "variants: struct<nodes: array<struct<"
    "id: string, title: string, price: string, inventoryQuantity: bigint, "
    "inventoryItem: struct<unitCost: struct<amount: string>>>>>"
)


def _list(name: str, *fields: str) -> str:
    return f"{name}: struct<{', '.join(fields)}>"


# One landed page: which list it belongs to, the cursor it was asked for with
# (null for the first page) and the JSON response.
LANDED_PAGE = "resource string, request_cursor string, body string"

_ORDER_LIST = _list(
    "orders",
    _PAGE_INFO,
    f"nodes: array<struct<{_ORDER_HEAD}, lineItems: struct<{_PAGE_INFO}, nodes: array<struct<{_LINE}>>>>>",
)
_PRODUCT_LIST = _list("products", _PAGE_INFO, f"nodes: array<struct<{_PRODUCT}>>")

# The whole response, parsed once.
RESPONSE = f"errors: string, data: struct<{_ORDER_LIST}, {_PRODUCT_LIST}>"


def _archived(*lists: str) -> str:
    columns = [one.replace(":", "", 1) for one in lists]
    return ", ".join(["request_cursor string, problem string, detail string", *columns, "resource string"])


# A parsed page as it is archived, and the parts of it that a reader names: parquet
# reads the leaves of these and no others. `body` is kept for pages with a problem.
ARCHIVED_PAGE = _archived("body: string", _ORDER_LIST, _PRODUCT_LIST)
PAGE_PROBLEMS = _archived()
ORDER_HEADS = _archived(_list("orders", f"nodes: array<struct<{_ORDER_HEAD}>>"))
ORDER_LINES = _archived(_list("orders", f"nodes: array<struct<id: string, cancelledAt: string, {_LINES}>>"))
PRODUCTS = _archived(_list("products", f"nodes: array<struct<{_PRODUCT}>>"))
PAGE_ENDS = _archived(_list("orders", _PAGE_INFO), _list("products", _PAGE_INFO))
LINE_CHAINS = _archived(_list("orders", f"nodes: array<struct<id: string, lineItems: struct<{_PAGE_INFO}>>>"))
CHILD_COUNTS = _archived(
    _list("orders", f"nodes: array<struct<id: string, lineItems: struct<{_PAGE_INFO}, nodes: array<struct<quantity: bigint>>>>>"),
    _list("products", "nodes: array<struct<id: string, variants: struct<nodes: array<struct<id: string>>>>>"),
)

RAW_COLUMNS = {
    "orders": {
        "order_id": "string",
        "name": "string",
        "created_at": "string",
        "cancelled": "boolean",
        "financial_status": "string",
        "total_price": TOTAL,
        "total_discounts": TOTAL,
        "total_refunded": TOTAL,
        "shipping_charged": TOTAL,
    },
    "order_items": {
        "order_id": "string",
        "cancelled": "boolean",
        "product": "string",
        "quantity": "bigint",
        "original_total": MONEY,
        "discounted_total": MONEY,
        "discount": MONEY,
    },
    "variants": {
        "product_id": "string",
        "product": "string",
        "status": "string",
        "variant_id": "string",
        "variant": "string",
        "price": MONEY,
        "unit_cost": MONEY,
        "inventory_quantity": "bigint",
    },
}
RAW = {
    table: ", ".join(f"{name} {dtype}" for name, dtype in columns.items())
    for table, columns in RAW_COLUMNS.items()
}
