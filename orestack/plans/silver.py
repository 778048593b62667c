"""Silver: typed, valid and unique orders; cleaned and valid customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orestack import schemas
from orestack.functions import dates, money
from orestack.functions.rules import Rule, keep_valid
from orestack.operators.dedup import latest_per_key
from orestack.operators.schema import enforce

# Fixed values.
STATUSES = ("pending", "confirmed", "shipped", "delivered", "cancelled")
REGIONS = ("North", "Central", "South")

# A later copy of an order may change these; customer and product stay as first seen.
ORDER_UPDATE_COLUMNS = (
    "quantity", "unit_price", "total_amount", "status", "order_date", "_silver_updated_at")

ARRIVAL = "_arrival"
_AUDIT_COLUMNS = ("ingested_at", "_bronze_ingested_at", "_source_file")

# Copies with the same arrival time are told apart by their contents.
_ORDER_TIEBREAK = schemas.ARRIVAL.names[1:]


def type_orders(bronze: DataFrame, money_type: T.DecimalType = schemas.MONEY) -> DataFrame:
    """Typed orders with their total, the price as it was delivered. A cell that does not parse becomes NULL."""
    quantity = F.col("quantity").try_cast("int")
    unit_price = F.col("unit_price").try_cast("double")
    return bronze.withColumns({
        "order_date": dates.iso_date(F.col("order_date")),
        "quantity": quantity,
        "unit_price": unit_price,
        "total_amount": money.total_amount(quantity, unit_price, money_type),
        "status": F.lower(F.trim(F.col("status"))),
    })


def order_rules(statuses: Sequence[str] = STATUSES) -> list[Rule]:
    return [
        Rule("order_id_present", F.col("order_id").isNotNull()),
        Rule("customer_id_present", F.col("customer_id").isNotNull()),
        Rule("quantity_positive", F.col("quantity") > 0),
        Rule("unit_price_positive", F.col("unit_price") > 0),
        Rule("status_known", F.col("status").isin(*statuses)),
        Rule("order_date_valid", F.col("order_date").isNotNull()),
        Rule("total_fits", F.col("total_amount").isNotNull()),
    ]


def newest_orders(valid: DataFrame) -> DataFrame:
    """The newest valid copy of every order."""
    return latest_per_key(valid, ["order_id"], "ingested_at", _ORDER_TIEBREAK)


def unique_orders(valid: DataFrame) -> DataFrame:
    """The newest valid copy of every order, without the audit columns of bronze."""
    return newest_orders(valid).drop(*_AUDIT_COLUMNS)


def _place(statuses: Sequence[str], unknown: Column) -> Column:
    """The place of a status among the known ones in the order of texts, from 1."""
    place = unknown
    for number, status in enumerate(sorted(statuses), start=1):
        place = F.when(F.col("status") == status, F.lit(number).cast("tinyint")).otherwise(place)
    return place


# What a short order has in one number: its date in the lower digits, from a day before every date, and above it quantity
# and status.
_DAYS = 2 ** 24
_PACKED = ("quantity", "status", "order_date")


def short_orders(orders: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """The same orders in fewer bytes and columns, to shuffle; ``whole_orders`` takes them back.

    ``quantity`` is one number for quantity, date and the place of the status among the known ones, and a total is left
    out. Where a total is not that of quantity and price, a status is not known or one of them is not there, all of them
    stand in a struct in the place of the total, which else is NULL. Orders of other types than those of silver stay as they are.
    """
    made = ("total_amount", *_PACKED)
    if any(orders.schema[name].dataType != schemas.SILVER_ORDERS[name].dataType for name in (*made, "unit_price")):
        return orders
    quantity, place = F.col("quantity"), _place(statuses, F.lit(None).cast("tinyint"))
    days = F.unix_date("order_date") + F.lit(_DAYS // 2)
    packed = (quantity.cast("bigint") * F.lit(len(statuses) + 1) + place) * F.lit(_DAYS) + days
    usual = F.col("total_amount").eqNullSafe(_derived_total(quantity)) & F.coalesce(quantity >= 0, F.lit(False)) & packed.isNotNull()
    return orders.withColumns({
        "quantity": F.when(usual, packed),
        "total_amount": F.when(~usual, F.struct(*made)),
    }).drop("status", "order_date")


def is_short(orders: DataFrame) -> bool:
    return isinstance(orders.schema["total_amount"].dataType, T.StructType)


def whole_orders(orders: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """The orders that ``short_orders`` made shorter."""
    if not is_short(orders):
        return orders
    parts, other = unpacked(statuses=statuses), F.col("total_amount")
    total = F.when(other.isNull(), _derived_total(parts["quantity"])).otherwise(other["total_amount"])
    return orders.withColumns({**parts, "total_amount": total})


def unpacked(prefix: str = "", statuses: Sequence[str] = STATUSES) -> dict[str, Column]:
    """Quantity, status and date of short orders, whose columns may have a ``prefix``."""
    packed, other = F.col(f"{prefix}quantity"), F.col(f"{prefix}total_amount")
    above, base = F.shiftright(packed, _DAYS.bit_length() - 1), F.lit(len(statuses) + 1)
    place = above % base
    usual = {
        "quantity": ((above - place) / base).cast("int"),  # a whole number, which a double holds
        "status": F.element_at(F.array(*map(F.lit, sorted(statuses))), place.cast("int")),
        "order_date": F.date_from_unix_date((packed % F.lit(_DAYS)).cast("int") - F.lit(_DAYS // 2)),
    }
    return {name: F.when(other.isNull(), usual[name]).otherwise(other[name]) for name in _PACKED}


def _derived_total(quantity: Column) -> Column:
    return money.total_amount(quantity, F.col("unit_price"), schemas.MONEY)


def arrived_orders(valid: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """The silver orders of valid rows with ``_arrival``, what tells the newer of two copies besides the order itself.

    The rows are checked before their shuffle by order: a check makes a new column of the key, by which a merge would
    have to shuffle them again. A status, which is one of ``statuses``, is shuffled as its place among them in the order
    of texts. The total, which is that of ``type_orders``, and the audit time are made after the shuffle.
    """
    unknown = F.raise_error(F.lit("an order with an unknown status is not valid")).cast("tinyint")
    place = _place(statuses, unknown)
    made = {
        "total_amount": money.total_amount(F.col("quantity"), F.col("unit_price"), schemas.MONEY),
        "_silver_updated_at": F.current_timestamp(),
    }
    carried = [field for field in schemas.SILVER_ORDERS.fields if field.name not in made]
    checked = enforce(valid.drop(*made, *_AUDIT_COLUMNS[1:]), T.StructType([*carried, schemas.ARRIVAL["ingested_at"]]))
    newest = newest_orders(checked.withColumn("status", place))
    made["status"] = F.element_at(F.array(*map(F.lit, sorted(statuses))), F.col("status").cast("int"))
    arrival = F.struct(*schemas.STORED_ARRIVAL.names).cast(schemas.STORED_ARRIVAL)
    return newest.withColumns(made).select(*schemas.SILVER_ORDERS.names, arrival.alias(ARRIVAL))


def short_arrival(orders: DataFrame) -> DataFrame:
    """Silver orders as they are stored: without customer and product of ``_arrival`` where both are those of the order.

    An arrival has a customer, so one without is known to be short.
    """
    stored = F.col(ARRIVAL)
    differs = ~(stored["customer_id"].eqNullSafe(F.col("customer_id")) & stored["product_id"].eqNullSafe(F.col("product_id")))
    return orders.withColumn(ARRIVAL, F.struct(
        stored["ingested_at"].alias("ingested_at"),
        *(F.when(differs, stored[name]).alias(name) for name in ("product_id", "customer_id"))).cast(schemas.STORED_ARRIVAL))


def whole_arrival(prefix: str = "", short: bool = False) -> Column:
    """What tells the newer of two copies of an order, from the columns of silver orders with ``_arrival``.

    What is not stored there is that of the order itself, which takes it from its newest copy. The names of the columns
    may have a ``prefix``, and the orders may be ``short`` ones.
    """
    stored = F.col(f"{prefix}{ARRIVAL}")
    parts = {name: F.col(f"{prefix}{name}") for name in schemas.ARRIVAL.names[1:]} | {"ingested_at": stored["ingested_at"]}
    if short:
        parts |= unpacked(prefix)
    for name in ("product_id", "customer_id"):
        parts[name] = F.when(stored["customer_id"].isNull(), parts[name]).otherwise(stored[name])
    return F.struct(*(parts[field.name].cast(field.dataType).alias(field.name) for field in schemas.ARRIVAL.fields))


def not_older(arrived: DataFrame, known: DataFrame, cut: bool = True) -> DataFrame:
    """The arrived orders without those of which a newer copy is known; ``known`` holds a row per order.

    Only keys and arrivals of the known orders are read, cut to the keys that arrived. Without ``cut`` the arrived
    orders are read once.
    """
    matching = known.join(arrived.select("order_id"), "order_id", "left_semi") if cut else known
    before = matching.select("order_id", whole_arrival().alias("_known"))
    joined = arrived.join(before, "order_id", "left")
    return joined.filter(F.col("_known").isNull() | (whole_arrival() >= F.col("_known"))).drop("_known")


def silver_orders(bronze: DataFrame, statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Typed, then validated, then unique: an older valid copy wins over a newer invalid one."""
    valid = keep_valid(type_orders(bronze), order_rules(statuses))
    stamped = unique_orders(valid).withColumn("_silver_updated_at", F.current_timestamp())
    return enforce(stamped, schemas.SILVER_ORDERS)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Customers with cleaned texts and a parsed creation date."""
    return raw.withColumns({
        "name": F.trim(F.col("name")),
        "email": F.lower(F.trim(F.col("email"))),
        "phone": F.regexp_replace("phone", r"\s+", ""),
        "city": F.trim(F.col("city")),
        "region": F.trim(F.col("region")),
        "created_date": dates.iso_date(F.col("created_at")),
    }).drop("created_at")


def customer_rules(regions: Sequence[str] = REGIONS) -> list[Rule]:
    return [
        Rule("customer_id_present", F.col("customer_id").isNotNull()),
        Rule("email_has_at_sign", F.col("email").contains("@")),
        Rule("region_known", F.col("region").isin(*regions)),
    ]


def silver_customers(raw: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    """Clean and valid customers. Copies of a customer are kept, and the creation date may be NULL."""
    return valid_customers(keep_valid(clean_customers(raw), customer_rules(regions)))


def valid_customers(valid: DataFrame) -> DataFrame:
    return enforce(
        valid.withColumn("_silver_updated_at", F.current_timestamp()), schemas.SILVER_CUSTOMERS)
