"""Load text rows into the typed, keyed orders table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions.times import iso_to_timestamp
from larderline.schemas import MONEY, ORDERS


def _typed_order() -> dict[str, Column]:
    """Each order column out of its text. Text that does not parse gives NULL;
    an empty status is a valid, empty text."""
    readings = {
        "price": F.col("price").try_cast(MONEY),
        "order_ts": iso_to_timestamp(F.col("order_ts")),
        "status": F.coalesce("status", F.lit("")),
    }
    for field in ORDERS:
        if field.name not in readings:
            readings[field.name] = F.col(field.name).try_cast(field.dataType)
    return {name: readings[name] for name in ORDERS.names}


def _bad_fields() -> Column:
    """Names of the columns that do not parse, comma-separated."""
    return F.concat_ws(
        ",", *[F.when(value.isNull(), F.lit(name)) for name, value in _typed_order().items()]
    )


def _as_order() -> list[Column]:
    return [value.alias(name) for name, value in _typed_order().items()]


def accepted_orders(text_rows: DataFrame) -> DataFrame:
    """The rows that parse in full, typed."""
    return text_rows.filter(_bad_fields() == "").select(*_as_order())


def rejected_orders(text_rows: DataFrame) -> DataFrame:
    """The rows that do not parse, as they came, with the columns at fault."""
    marked = text_rows.select(*ORDERS.names, _bad_fields().alias("bad_fields"))
    return marked.filter(F.col("bad_fields") != "")


def all_orders_or_fail(text_rows: DataFrame) -> DataFrame:
    """Typed rows; the job fails, and so commits nothing, on the first bad one."""
    bad = _bad_fields()
    checked = F.assert_true(bad == "", F.concat(F.lit("order row with bad "), bad))
    return text_rows.filter(checked.isNull()).select(*_as_order())


# Keys that a filter lists one by one; of more, the range they lie in is used.
LISTED_KEYS = 10_000


def near_keys(loaded: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Loaded rows that may have an incoming key: in the range of these, and if
    they are few, with one of them. Parquet skips row groups by the range, and by
    their Bloom filters where keys are listed; none of the keys is lost."""
    bounds = incoming.agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")
    ).first()
    if bounds.low is None:
        return loaded.filter(F.lit(False))
    if bounds.n <= LISTED_KEYS:
        return loaded.filter(F.col(key).isin([row[0] for row in incoming.select(key).collect()]))
    return loaded.filter(F.col(key).between(bounds.low, bounds.high))


def new_rows(incoming: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not loaded yet. Running a load again after a
    failure thus adds only what is missing."""
    return incoming.join(loaded.select(key), key, "left_anti")


def key_conflicts(incoming: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Incoming keys that a primary key would refuse, with the reason.

    Keys are counted first, so a key with very many rows reaches the join as
    one row.
    """
    keys = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("incoming_rows"))
    known = loaded.select(key).distinct().withColumn("is_loaded", F.lit(True))
    reason = F.when(F.col("is_loaded"), "loaded before").when(
        F.col("incoming_rows") > 1, "repeated"
    )
    return (
        keys.join(known, key, "left")
        .select(key, "incoming_rows", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )
