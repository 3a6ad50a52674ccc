"""Card pages built from ``part``, read back and taken through to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.times import iso_utc
from vitrine.operators import cards as card_reading
from vitrine.operators import dom, quality
from vitrine.plans import cards
from vitrine.workload import inputs as I
from vitrine.workload.registry import query

_KEYS = ("lang", "set_code", "card_code", "fetched_at")
_VISITS = f"""
    select {I.CARD_LANG} as lang, p_brand as set_code, cast(p_partkey as string) as card_code,
           visit, {I.CARD_KEY} as card_key, coalesce({I.CARD_ID}, '') as card_id,
           {I.DATA_ID} as data_id, case when visit = 1 then {I.RARITY} end as rarity,
           cast({I.USD} as double) as usd_price,
           case when visit = 1 then cast({I.EUR} as double) end as eur_price
    from part, (values (1), (2)) visits(visit)
"""
_SEEN = "concat('2024-03-0', cast(visit as string), 'T06:00:00+00:00')"

_FIELDS = f"""
    select lang, set_code, card_code, {_SEEN} as fetched_at, card_id,
           cast(data_id as string) as data_id, rarity, usd_price, eur_price
    from ({_VISITS})
"""


def _fields(rows: DataFrame) -> DataFrame:
    return rows.withColumn("fetched_at", iso_utc(F.col("fetched_at")))


@query("card_fields", _FIELDS)
def card_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(card_reading.card_fields(I.card_pages(spark, sf_dir), _KEYS))


@query("card_fields_tolerant", _FIELDS)
def card_fields_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fields(dom.card_fields(I.card_pages(spark, sf_dir), _KEYS))


_CARD_LINKS = """
    select cast(p_partkey as string) as page_card, lang, set_code, card_code
    from (select p_partkey, 'jp' as lang, replace(p_brand, '#', '') as set_code,
                 cast(p_size as string) as card_code
          from part), (values (1), (2)) visits(visit)
"""


@query("card_links", _CARD_LINKS)
def card_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.card_pages(spark, sf_dir).select(F.col("card_code").alias("page_card"), "html")
    return card_reading.extract_links(pages, ["page_card"]).drop("link_pos")


@query("card_links_tolerant", _CARD_LINKS)
def card_links_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = I.card_pages(spark, sf_dir).select(F.col("card_code").alias("page_card"), "html")
    return dom.extract_links(pages, ["page_card"]).drop("link_pos")


_STORED = f"""
    select card_key as card_id, lang, set_code, card_code, max(data_id) as data_id,
           max(rarity) as rarity, max(usd_price) as usd_price, max(eur_price) as eur_price
    from ({_VISITS}) where card_key is not null group by all
"""


@query(
    "card_index_table",
    f"select card_id, lang, set_code, card_code, data_id, rarity from ({_STORED})",
)
def card_index_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two visits per card, from HTML to the card index."""
    return cards.card_index(cards.card_records(I.card_pages(spark, sf_dir)))


@query("card_price_table", f"select * from ({_STORED}) where lang = 'en'")
def card_price_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two visits per English card, from HTML to the card prices."""
    return cards.card_prices(cards.card_records(I.card_pages(spark, sf_dir)))


@query(
    "card_rejects",
    f"""
    select lang, set_code, card_code, {_SEEN} as observed_at, 'card_id' as reject_reason
    from ({_VISITS}) where card_key is null
    """,
)
def card_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = quality.rejected(cards.card_records(I.card_pages(spark, sf_dir)))
    return rejects.select(
        "lang",
        "set_code",
        "card_code",
        iso_utc(F.col("observed_at")).alias("observed_at"),
        quality.REASON,
    )


@query(
    "card_index_clashes",
    f"""
    select lang, set_code, card_code, count(*) as n_rows
    from (select distinct card_key, lang, set_code, cast(p_partkey % 7 as string) as card_code
          from (select *, cast(card_code as int) as p_partkey from ({_VISITS})) where card_key is not null)
    group by all having count(*) > 1
    """,
)
def card_index_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards of different ids that claim one language, set and number, as planted in the numbers."""
    number = (F.col("card_code").cast("int") % 7).cast("string")
    pages = I.card_pages(spark, sf_dir).withColumn("card_code", number)
    index = cards.card_index(cards.card_records(pages))
    return quality.duplicate_keys(index, ["lang", "set_code", "card_code"])
