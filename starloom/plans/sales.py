"""Order-line staging and the fact load."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, IntegralType, StructType

from ..functions import calendar_key, share_of
from ..limits import DEFAULT, Limits
from ..operators.blocks import Blocks, id_blocks, rows_in, value_blocks, with_values
from ..operators.lookup import Lookup, lookup_keys, lookup_ways
from ..operators.members import rows_not_in
from ..operators.numbering import number_in_groups
from ..operators.skew import is_small, rows_with_ids, skew_join
from ..scratch import materialize
from ..sources.schemas import ORDER_MONTH


Step = Callable[[DataFrame], DataFrame]

_ID = "SalesOrderID"
_TOTALS = ["SubTotal", "TaxAmt", "Freight"]
_LINE_COLUMNS = ["SalesOrderID", "ProductID", "SpecialOfferID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal"]


def _costs(product: DataFrame) -> DataFrame:
    return product.select("ProductID", F.col("StandardCost").alias("ProductStandardCost"))


# A decimal of more digits than this takes three times the room of a shorter one in a row that is shuffled.
_SHORT = 18
_WIDE = "_wide_"


def _shortened(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Long decimals, except those to ``keep``, as short ones; a value that does not fit goes to a column of its own, empty as a rule.

    That is a text, as an empty long decimal takes its room all the same.
    """
    columns = []
    for field in rows.schema:
        value, kind = F.col(f"`{field.name}`"), field.dataType
        if not isinstance(kind, DecimalType) or kind.precision <= _SHORT or kind.scale > _SHORT or field.name in keep:
            columns.append(value)
            continue
        short = value.try_cast(DecimalType(_SHORT, kind.scale))
        columns += [short.alias(field.name), F.when(short.isNull(), value.cast("string")).alias(_WIDE + field.name)]
    return rows.select(*columns)


def _restored(rows: DataFrame, *before: StructType) -> DataFrame:
    """The values that ``_shortened`` found, in their own types."""
    kinds = {f.name: f.dataType for schema in before for f in schema}
    wide = {c.removeprefix(_WIDE) for c in rows.columns if c.startswith(_WIDE)}
    return rows.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast(kinds[c]), F.col(f"`{_WIDE}{c}`").cast(kinds[c])).alias(c) if c in wide else F.col(f"`{c}`")
            for c in rows.columns
            if not c.startswith(_WIDE)
        ]
    )


def cost_blocks(detail: DataFrame, product: DataFrame, limits: Limits = DEFAULT) -> Blocks | None:
    """The costs of products for a broadcast; None if they are too many, or a product comes twice."""
    if not isinstance(detail.schema["ProductID"].dataType, IntegralType):
        return None
    return value_blocks(_costs(product), "ProductID", "ProductStandardCost", limits)


def ordering_customers(
    header: DataFrame,
    detail: DataFrame,
    product: DataFrame,
    few_orders: bool = False,
    limits: Limits = DEFAULT,
    costs: Blocks | None = None,
) -> DataFrame:
    """The customers of orders that ``stage_sales`` gives a row: only ids are shuffled, and no line is numbered.

    With ``costs`` (see ``cost_blocks``) and integer order ids not even those are, but their bit masks.
    """
    lines = detail.select("SalesOrderID", "ProductID")
    if few_orders:
        lines = rows_with_ids(lines, header, "SalesOrderID", limits)
    if costs:
        sold = rows_in(lines, costs, "ProductID").select("SalesOrderID")
    else:
        sold = skew_join(lines, _costs(product), "ProductID", "left_semi", limits).select("SalesOrderID")
    orders = header.filter("SalesOrderID is not null").select("SalesOrderID", F.col("CustomerID").alias("CustomerAK"))
    ids = id_blocks(sold, "SalesOrderID", limits) if isinstance(orders.schema["SalesOrderID"].dataType, IntegralType) else None
    if ids:
        return rows_in(orders, ids, "SalesOrderID").select("CustomerAK")
    return skew_join(orders, sold.distinct(), "SalesOrderID", "left_semi", limits, hot={}, small=False).select("CustomerAK")


def stage_sales(
    header: DataFrame,
    detail: DataFrame,
    product: DataFrame,
    line_order: Sequence[str] = ("SalesOrderDetailID",),
    few_orders: bool = False,
    limits: Limits = DEFAULT,
    number_all_lines: bool = False,
    order_keys: Step | None = None,
    line_keys: Step | None = None,
    costs: Blocks | None = None,
    by_month: bool = False,
    amounts: bool = True,
) -> DataFrame:
    """One row per order line, numbered within its order, with cost and its share of tax and freight.

    Lines are shuffled once, by order (and once more, by product, only if products
    are too many to broadcast): the numbering and the join with the order header
    share that partitioning.  Orders too big for one task are numbered
    and joined apart (see ``number_in_groups``).  If ``few_orders`` says that the
    headers may be few - only new orders, say - lines of other orders are dropped
    before any shuffle, by a broadcast of the orders or of their ids as bit masks.

    ``order_keys`` and ``line_keys`` look up surrogates: of the parties once per order (``CustomerAK`` and the like), and of
    ``ProductID`` and ``SpecialOfferID`` where lines meet their products.  The rows have those keys then.

    With ``costs`` (see ``cost_blocks``) products cost no shuffle, and lines without one are left out first, but the cost itself
    and what follows from it come after the shuffle, which is narrower so.  ``by_month`` then brings
    the lines of a month together before they get these, for rows that are written by month: they come with ``ORDER_MONTH``.
    It is for ``line_keys`` that shuffle no lines.  Without ``amounts`` the rows have the totals of their orders instead of
    what follows from them, for rows that are stored first: ``with_amounts`` works that out.

    A line without a product takes no number, unless ``number_all_lines`` is set:
    then its number stays free until the product arrives.  Either way it is left out.
    """
    orders = header.select(
        "SalesOrderID",
        "SalesOrderNumber",
        "RevisionNumber",
        F.col("CustomerID").alias("CustomerAK"),
        F.col("SalesPersonID").alias("EmployeeAK"),
        F.col("TerritoryID").alias("SalesTerritoryAK"),
        F.col("BillToAddressID").alias("BillToAddressAK"),
        F.col("ShipToAddressID").alias("ShipToAddressAK"),
        calendar_key(F.col("OrderDate")).alias("OrderDateKey"),
        calendar_key(F.col("ShipDate")).alias("ShipDateKey"),
        calendar_key(F.col("DueDate")).alias("DueDateKey"),
        "SubTotal",
        "TaxAmt",
        "Freight",
    )
    lines = detail.select(*dict.fromkeys([*_LINE_COLUMNS, *line_order]))

    few = few_orders and is_small(orders, limits)
    if few:
        lines = skew_join(lines, orders, "SalesOrderID", "left_semi", limits, small=True)
    elif few_orders:
        lines = rows_with_ids(lines, orders, "SalesOrderID", limits)
    if order_keys:
        orders = order_keys(orders)
    of_order = [c for c in orders.columns if c.endswith(("AK", "Key")) and not c.endswith("DateKey")]

    def with_costs(rows: DataFrame) -> DataFrame:
        if costs:
            priced = with_values(rows, costs, "ProductID", "ProductStandardCost", "inner")
        else:
            priced = skew_join(rows, _costs(product), "ProductID", "inner", limits)
        return line_keys(priced) if line_keys else priced

    if number_all_lines:
        numbered = lines
    else:
        numbered = rows_in(lines, costs, "ProductID") if costs else with_costs(lines)
    long_forms, short_orders = (numbered.schema, orders.schema), _shortened(orders)
    sold = number_in_groups(
        _shortened(numbered, line_order),
        "SalesOrderID",
        line_order,
        "SalesOrderLineNumber",
        limits,
        then=lambda rows, hot: skew_join(rows, short_orders, "SalesOrderID", "inner", limits, hot, small=few),
        size_from=lines,
    )
    month = []
    if by_month and costs:
        # What the lines of an order share comes first: rows after each other differ in their ends only, so they compress better.
        shared = [c for c in short_orders.columns if c != "SalesOrderID"]
        own = [c for c in sold.columns if c not in shared and c.removeprefix(_WIDE) in [*_LINE_COLUMNS[1:], "SalesOrderLineNumber"]]
        sold = sold.select(order_month(F.col("OrderDateKey")).alias(ORDER_MONTH), *shared, *own).hint("rebalance", ORDER_MONTH)
        month = [ORDER_MONTH]
    sold = _restored(sold, *long_forms)
    if number_all_lines or costs:
        sold = with_costs(sold)
    of_line = ["ProductKey", "PromotionKey"] if line_keys else [F.col("ProductID").alias("ProductAK"), F.col("SpecialOfferID").alias("PromotionAK")]
    staged = sold.select(
        "SalesOrderNumber",
        "SalesOrderLineNumber",
        "RevisionNumber",
        *of_line,
        *of_order,
        "OrderDateKey",
        "ShipDateKey",
        "DueDateKey",
        F.col("OrderQty").alias("OrderQuantity"),
        "UnitPrice",
        F.col("UnitPriceDiscount").alias("DiscountAmount"),
        "ProductStandardCost",
        F.col("LineTotal").alias("SalesAmount"),
        *_TOTALS,
        *month,
    )
    return with_amounts(staged) if amounts else staged


def with_amounts(staged: DataFrame) -> DataFrame:
    """Staged lines with their costs and shares in place of the totals of their orders."""
    whole, sales = F.col("SubTotal"), F.col("SalesAmount")
    follows = {
        "ProductStandardCost": [(F.col("ProductStandardCost") * F.col("OrderQuantity")).alias("TotalProductCost")],
        "SalesAmount": [
            share_of(F.col("TaxAmt"), sales, whole).alias("TaxAmount"),
            share_of(F.col("Freight"), sales, whole).alias("FreightAmount"),
        ],
    }
    kept = [c for c in staged.columns if c not in _TOTALS]
    return staged.select(*[x for c in kept for x in (c, *follows.get(c, []))])


def order_month(date_key: Column) -> Column:
    """The month of a calendar key, by which facts are partitioned; 0 where there is no date."""
    return F.coalesce((date_key / 100).cast("int"), F.lit(0))


def within_months(facts: DataFrame, staging: DataFrame, date_key: Column) -> DataFrame:
    """The facts of the months that staged orders lie in: other partitions are not read.

    One row comes to the driver, so the bounds are literals of the plan.
    """
    month = order_month(date_key)
    low, high = staging.agg(F.min(month), F.max(month)).first()
    return facts.filter(F.col(ORDER_MONTH).between(low or 0, high or 0))


def new_fact_rows(
    staging: DataFrame, fact: DataFrame, key: str | Sequence[str] = "SalesOrderNumber", limits: Limits = DEFAULT
) -> DataFrame:
    """Lines of orders not loaded yet.

    With the default key a line added to a loaded order is not picked up;
    ``["SalesOrderNumber", "SalesOrderLineNumber"]`` compares single lines.
    """
    return rows_not_in(staging, fact, key, limits)


def new_headers(header: DataFrame, fact: DataFrame, key: str = "SalesOrderNumber", limits: Limits = DEFAULT) -> DataFrame:
    """Headers of orders not loaded yet.

    Numbers alone are compared first: as a rule few orders are new, and then the other columns of the known ones are
    neither worked out nor shuffled.  Many new ones are found by the bit masks of their ids, if these tell them from the known ones.
    """
    if is_small(fact.select(key), limits, count_first=True):
        return new_fact_rows(header, fact, key, limits)
    by_id = _ID in header.columns and isinstance(header.schema[_ID].dataType, IntegralType)
    numbers = header.select(key, _ID) if by_id else header.select(key).distinct()
    new = materialize(rows_not_in(numbers, fact, key, limits, hot={}, small=False).withColumnRenamed(key, "_new"), "new-numbers")
    if new.isEmpty():
        return header.filter(F.lit(False))
    if is_small(new.select("_new"), limits):
        return header.join(F.broadcast(new.select("_new")), F.col(key).eqNullSafe(F.col("_new")), "left_semi")  # without a number: always new
    ids = id_blocks(new, _ID, limits) if by_id else None
    # A known order with the id of a new one, or a new one without, would make another number of rows.
    if ids and rows_in(numbers, ids, _ID).count() == new.count():
        return rows_in(header, ids, _ID)
    return new_fact_rows(header, fact, key, limits)


def order_roles(customer: DataFrame, employee: DataFrame, geography: DataFrame, territory: DataFrame) -> list[Lookup]:
    """The lookups that are the same for all lines of an order; geography is looked up in two roles."""
    return [
        Lookup(customer, "CustomerAK", "CustomerKey"),
        Lookup(employee, "EmployeeAK", "SalesPersonKey", "EmployeeKey"),
        Lookup(geography, "BillToAddressAK", "BillToAddressKey", "GeographyKey", "GeographyAK"),
        Lookup(geography, "ShipToAddressAK", "ShipToAddressKey", "GeographyKey", "GeographyAK"),
        Lookup(territory, "SalesTerritoryAK", "SalesTerritoryKey"),
    ]


def line_roles(
    promotion: DataFrame, product: DataFrame, promotion_id: str = "PromotionAK", product_id: str = "ProductAK"
) -> list[Lookup]:
    return [
        Lookup(promotion, promotion_id, "PromotionKey", dim_alt_key="PromotionAK"),
        Lookup(product, product_id, "ProductKey", dim_alt_key="ProductAK"),
    ]


def fact_rows(
    lines: DataFrame,
    customer: DataFrame,
    employee: DataFrame,
    promotion: DataFrame,
    product: DataFrame,
    geography: DataFrame,
    territory: DataFrame,
    unknown_key: int | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Staged lines with surrogate keys; ``ORDER_MONTH`` stays only with lines that still lie together by it."""
    roles = [*order_roles(customer, employee, geography, territory), *line_roles(promotion, product)]
    ways = lookup_ways(lines.schema, roles, limits=limits)
    if any(way.shuffles for way in ways):
        lines = lines.drop(ORDER_MONTH)
    return lookup_keys(lines, roles, unknown_key=unknown_key, limits=limits, ways=ways)
