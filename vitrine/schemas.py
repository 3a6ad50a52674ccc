"""Schemas of every input and output table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

def _schema(ddl: str) -> T.StructType:
    fields = []
    for part in ddl.split(","):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)


SERIES_URLS = _schema("source string, series_code string, list_url string")
SERIES_SIZES = _schema("series_code string, lang string, size int")

# Fetched pages as a crawler lands them; one row per request.
LANDED_PAGES = _schema(
    "source string, name string, url string, series_code string, page_index int, lang string, "
    "set_code string, card_code string, status int, fetched_at timestamp, html string, crawl_id string"
)

# "required" columns are not null.
SHOP_PRODUCTS = _schema(
    "product_id string required, product_group string, model_number string, set_size string, "
    "name string, name_full string, condition string, model_code string, price_yen double, "
    "url string, created_at timestamp, updated_at timestamp"
)
CARD_INDEX = _schema(
    "card_id bigint required, data_id bigint, lang string required, set_code string required, "
    "card_code string required, rarity string"
)
CARD_PRICES = _schema(
    "card_id bigint required, data_id bigint, lang string, set_code string, card_code string, "
    "rarity string, usd_price double, eur_price double"
)
PRICE_HISTORY = _schema(
    "product_id string required, captured_date date required, captured_at timestamp required, "
    "price double, currency string, stock_status string"
)
