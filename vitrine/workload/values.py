"""Text, price, address and time functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import prices, text, times, urls
from vitrine.workload import inputs as I
from vitrine.workload.registry import query, table


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the built listing pages, as rows."""
    four = F.explode(F.array(*map(F.lit, range(4)))).alias("i")
    return table(spark, sf_dir, "part").select("*", four)


@query(
    "name_parts",
    f"""
    select p_partkey, i, {I.BARE_NAME} as name, {I.CONDITION} as condition,
           {I.MODEL_NUMBER} as model_number, {I.SET_SIZE} as set_size
    from {I.ITEMS}
    """,
)
def name_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = F.col("name_full")
    named = _items(spark, sf_dir).select("p_partkey", "i", F.expr(I.NAME_FULL).alias("name_full"))
    return named.select(
        "p_partkey",
        "i",
        text.clean_name(full).alias("name"),
        text.condition_of(full).alias("condition"),
        text.card_number(full).alias("model_number"),
        text.set_size(full).alias("set_size"),
    )


@query(
    "model_code",
    """
    select p_partkey, case when p_size % 4 = 3 then concat('[', p_brand, ']')
                           when p_size % 4 = 2 then concat('[b]', p_type)
                           else p_type end as model_code
    from part
    """,
)
def model_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = (
        "case when p_size % 4 = 3 then concat('[', p_brand, ']') "
        "when p_size % 4 = 2 then concat('[a][b]', p_type) "
        "when p_size % 4 = 1 then concat('[', p_brand, ']　', p_type) else p_type end"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(shown).alias("shown"))
    return part.select("p_partkey", text.model_code(F.col("shown")).alias("model_code"))


@query("yen_price", f"select p_partkey, i, {I.PRICE_YEN} as price_yen from {I.ITEMS}")
def yen_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.translate(F.expr(I.PRICE_TEXT), "0123456789", "０１２３４５６７８９")
    shown = F.when(F.col("p_size") % 5 == 0, wide).otherwise(F.expr(I.PRICE_TEXT))
    items = _items(spark, sf_dir).select("p_partkey", "i", shown.alias("shown"))
    return items.select("p_partkey", "i", prices.yen_price(F.col("shown")).alias("price_yen"))


@query(
    "decimal_price",
    """
    select p_partkey, case when p_size % 10 = 0 then null
                           when p_size % 10 = 9 then 1.0
                           else cast(round(p_retailprice, 2) as double) end as usd_price
    from part
    """,
)
def decimal_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = (
        "case when p_size % 10 = 0 then 'n/a' when p_size % 10 = 9 then '1,234.56€' "
        "else concat('$ ', cast(round(p_retailprice, 2) as string), ' ea.') end"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(shown).alias("shown"))
    return part.select("p_partkey", prices.decimal_price(F.col("shown")).alias("usd_price"))


@query(
    "resolve_url",
    """
    select p_partkey, case p_partkey % 10
        when 0 then concat('https://shop.example/product/', k)
        when 1 then concat('https://shop.example/list/a/product/', k)
        when 2 then concat('https://shop.example/list/p/', k)
        when 3 then concat('https://shop.example/list/a/', k)
        when 4 then concat('https://cdn.example/', k)
        when 5 then concat('http://other.example/', k)
        when 6 then concat('https://shop.example/list/a/b?page=', k)
        when 7 then concat('https://shop.example/list/a/b?x=1#', k)
        when 8 then concat('https://shop.example/q/', k, '?y=../z')
        end as url
    from (select p_partkey, cast(p_partkey as string) as k from part)
    """,
)
def resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    forms = ("/product/", "product/", "../p/", "./x/../", "//cdn.example/", "http://other.example/")
    ref = F.when(F.col("p_partkey") % 10 == 9, "")
    for n, form in enumerate((*forms, "?page=", "#")):
        ref = ref.when(F.col("p_partkey") % 10 == n, F.concat(F.lit(form), k))
    ref = ref.otherwise(F.concat(F.lit("/a/.././q/"), k, F.lit("?y=../z")))
    part = table(spark, sf_dir, "part").select("p_partkey", ref.alias("ref"))
    base = "https://shop.example/list/a/b?x=1"
    return part.select("p_partkey", urls.resolve_url(base, F.col("ref")).alias("url"))


@query(
    "safe_names",
    """
    select p_partkey, concat(regexp_replace(p_name, '[^a-zA-Z0-9._-]+', '_', 'g'), '_v1.0-b')
           as safe_name
    from part
    """,
)
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("　 "), F.col("p_name"), F.lit("／カ v1.0-b\t"))
    part = table(spark, sf_dir, "part").select("p_partkey", raw.alias("raw"))
    return part.select("p_partkey", text.safe_name(F.col("raw")).alias("safe_name"))


@query(
    "entity_texts",
    "select doc_id, md5(text) as text_md5, length(text) as text_length from documents",
)
def entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts written with references must decode to themselves."""
    encoded = F.col("text")
    for plain, reference in (
        ("&", "&amp;"),
        ("<", "&lt;"),
        ('"', "&quot;"),
        ("'", "&apos;"),
        ("é", "&eacute;"),
        ("ç", "&#231;"),
        ("è", "&#xE8;"),
    ):
        encoded = F.replace(encoded, F.lit(plain), F.lit(reference))
    documents = table(spark, sf_dir, "documents").select("doc_id", encoded.alias("encoded"))
    decoded = documents.select("doc_id", text.decode_entities(F.col("encoded")).alias("decoded"))
    return decoded.select(
        "doc_id",
        F.md5("decoded").alias("text_md5"),
        F.length("decoded").cast("bigint").alias("text_length"),
    )


@query(
    "capture_stamps",
    """
    select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as captured_at,
           strftime(ts, '%Y%m%dT%H%M%SZ') as stamp, ts = ts as survives_text
    from events
    """,
)
def capture_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = times.utc_instant(F.col("ts"))
    events = table(spark, sf_dir, "events").select("event_id", captured.alias("captured"))
    iso = times.iso_utc(F.col("captured"))
    return events.select(
        "event_id",
        iso.alias("captured_at"),
        times.compact_stamp(F.col("captured")).alias("stamp"),
        (times.from_iso(iso) == F.col("captured")).alias("survives_text"),
    )
