"""Validation, paging, keyed writes and constraint checks over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.times import iso_utc, utc_instant
from vitrine.functions.urls import product_group
from vitrine.operators import frontier, paging, quality
from vitrine.operators import upsert as U
from vitrine.sources import pages
from vitrine.workload import inputs as I
from vitrine.workload.registry import query, table

# ---- required fields -------------------------------------------------------------------

_GAPS = """
    select p_partkey,
           case when p_size % 11 = 0 then null when p_size % 11 = 1 then ''
                else cast(p_partkey as string) end as product_id,
           case when p_size % 7 = 0 then '' when p_size % 7 < 3 then concat('/p/', p_name) end
               as product_url,
           case when p_size % 7 = 0 or p_size % 7 = 3 then concat('/u/', p_name)
                when p_size % 7 = 4 then '' end as url,
           case when p_size % 13 = 0 then '' else p_name end as name,
           case when p_size % 17 = 0 then null else p_type end as name_full,
           case when p_size % 19 = 0 then '' else p_brand end as model_number,
           case when p_size % 5 = 0 then null when p_size % 5 = 1 then 0.0
                else p_retailprice end as price_yen
    from {part}
"""
_CHECKED = f"""
    select p_partkey, product_id, coalesce(nullif(product_url, ''), nullif(url, '')) as url,
           name, name_full, model_number, price_yen,
           case when coalesce(product_id, '') = '' then 'product_id'
                when coalesce(nullif(product_url, ''), nullif(url, '')) is null then 'url'
                when coalesce(name, '') = '' then 'name'
                when coalesce(name_full, '') = '' then 'name_full'
                when coalesce(model_number, '') = '' then 'model_number'
                when price_yen is null then 'price_yen' end as reject_reason
    from ({_GAPS.format(part="part")})
"""


def _gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(_GAPS.format(part="{part}"), part=table(spark, sf_dir, "part"))
    return quality.require_products(quality.with_url_fallback(rows)).drop("product_url")


@query(
    "required_fields",
    f"select * exclude (reject_reason) from ({_CHECKED}) where reject_reason is null",
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted(_gaps(spark, sf_dir))


@query(
    "rejects",
    f"select p_partkey, reject_reason from ({_CHECKED}) where reject_reason is not null",
)
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected(_gaps(spark, sf_dir)).select("p_partkey", quality.REASON)


@query(
    "group_guard",
    """
    select page_id, case when url like '%/en/%' then regexp_extract(url, '/en/([0-9]+)', 1) end
           as product_group,
           case when url not like '%/en/%' then 'product_group' end as reject_reason
    from pages
    """,
)
def group_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.replace(F.col("url"), F.lit("/en/"), F.lit("/product-group/"))
    rows = table(spark, sf_dir, "pages").select(
        "page_id", product_group(url).alias("product_group"), F.lit(None).cast("string").alias(quality.REASON)
    )
    return quality.require_group(rows)


# ---- landed pages ------------------------------------------------------------------------

_LANDED = """
    select page_id, case when page_id % 3 = 0 then 'cards' else 'shop' end as source,
           concat('n', cast(page_id as string)) as name, url,
           concat('S', cast(page_id % 7 as string)) as code,
           cast(page_id % 14 + 1 as int) as page_index,
           case when page_id % 11 = 0 then 404 when page_id % 13 = 0 then 500 else 200 end
               as status,
           case when page_id % 17 <> 0 then html end as html
    from pages
"""


@query(
    "landed_listings",
    f"""
    select name, url, code as series_code, page_index, md5(html) as html_md5 from ({_LANDED})
    where source = 'shop' and status = 200 and html is not null
    """,
)
def landed_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.listing_pages(I.landed_pages(spark, sf_dir), "shop")
    return rows.select("name", "url", "series_code", "page_index", F.md5("html").alias("html_md5"))


@query(
    "landed_cards",
    f"""
    select 'en' as lang, code as set_code, cast(page_id as string) as card_code,
           md5(html) as html_md5
    from ({_LANDED}) where source = 'cards' and status = 200 and html is not null
    """,
)
def landed_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.card_pages(I.landed_pages(spark, sf_dir), "cards")
    return rows.select("lang", "set_code", "card_code", F.md5("html").alias("html_md5"))


@query(
    "failed_pages",
    f"select source, name, url, status from ({_LANDED}) where status <> 200 or html is null",
)
def failed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failed(I.landed_pages(spark, sf_dir)).select("source", "name", "url", "status")


_ARCHIVE = """
    select page_id, case page_id % 5
               when 0 then concat('/keep/', cast(page_id % 50 as string), '.html')
               when 1 then concat('raw/p', cast(page_id % 40 as string), '.html')
               when 2 then concat('raw/page_', strftime(seen, '%Y%m%dT%H%M%SZ'), '.html')
               when 3 then concat('raw/n', cast(page_id as string), '.html') end as path,
           seen, html
    from (select *, timestamp '2024-03-01 06:00:00' + to_seconds(cast(page_id as int)) as seen
          from pages)
"""


def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with the path each is archived under: explicit, named, stamped, none."""
    key = F.col("page_id")

    def only(remainder: int, value: Column) -> Column:
        return F.when(key % 5 == remainder, value)

    def text(number: Column) -> Column:
        return number.cast("string")

    save_to = F.coalesce(only(0, F.concat(F.lit("/keep/"), text(key % 50), F.lit(".html"))), F.lit(""))
    folder = F.when(key % 5 == 4, "").otherwise("raw/")
    name = F.coalesce(
        only(1, F.concat(F.lit("p"), text(key % 40))), only(3, F.concat(F.lit("n"), text(key)))
    )
    seen = F.timestamp_add("SECOND", key.cast("int"), F.expr(I.FIRST_RUN))
    landed = table(spark, sf_dir, "pages").select("page_id", "html", seen.alias("fetched_at"))
    path = pages.archive_path(save_to, folder, name, F.col("fetched_at"))
    return landed.withColumn("path", path)


@query("page_archive", f"select page_id, path from ({_ARCHIVE})")
def page_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _archive(spark, sf_dir).select("page_id", "path")


@query(
    "latest_pages",
    f"""
    select path, page_id, md5(html) as html_md5
    from (select *, row_number() over (partition by path order by seen desc) as n
          from ({_ARCHIVE}) where path is not null)
    where n = 1
    """,
)
def latest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _archive(spark, sf_dir).where("path is not null")
    return pages.latest_per_name(kept).select("path", "page_id", F.md5("html").alias("html_md5"))


# ---- paging ------------------------------------------------------------------------------


@query(
    "first_item_fp",
    """
    select user_id, strftime(ts, '%Y-%m-%d') as day, count(*) as n_items,
           arg_min(event_id, event_id) as first_event, arg_min(event_type, event_id) as first_type
    from events group by all
    """,
)
def first_item_fp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's day as a page of events, identified by its first event."""
    items = table(spark, sf_dir, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts", "event_id", "event_type"
    )
    keys = ("user_id", "day")
    days = items.select(*keys).distinct()
    identity = ("event_id", "event_type")
    prints = paging.page_fingerprints(days, items, keys, identity, ["ts", "event_id"])
    return prints.select(
        *keys,
        "n_items",
        F.col("fingerprint.event_id").alias("first_event"),
        F.col("fingerprint.event_type").alias("first_type"),
    )


_PAGING = """
    with pages as (
        select distinct conv_id, turn + 1 as page, length(text) % 5 as fp,
               case when length(text) % 9 = 0 then 0 else 1 end as n
        from conversations {cap}),
    stops as (
        select p.conv_id, min(p.page) as stop
        from pages p left join pages f on f.conv_id = p.conv_id and f.page = 1
        where p.n = 0 or (p.page > 1 and p.fp = f.fp)
        group by p.conv_id)
    select p.conv_id, p.page, p.fp
    from pages p left join stops s on s.conv_id = p.conv_id
    where s.stop is null or p.page < s.stop
"""

PAGE_CAP = 4


def _turn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as series, turns as pages, text length as what a page shows.

    Turns are made distinct first, so repeated ones cannot pile up in a series' window.
    """
    length = F.length("text").cast("bigint")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        (F.col("turn") + 1).alias("page"),
        (length % 5).alias("fp"),
        F.when(length % 9 == 0, 0).otherwise(1).alias("n"),
    ).distinct()


@query("paging_cutoff", _PAGING.format(cap=""))
def paging_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = paging.cut_off(_turn_pages(spark, sf_dir), ["conv_id"], "page", "n", "fp")
    return kept.select("conv_id", "page", "fp")


@query("paging_cap", _PAGING.format(cap=f"where turn < {PAGE_CAP}"))
def paging_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a work list with an explicit cap; what it cuts is the next query's result."""
    turns = _turn_pages(spark, sf_dir)
    kept = paging.cut_off(turns, ["conv_id"], "page", "n", "fp", max_pages=PAGE_CAP)
    return kept.select("conv_id", "page", "fp")


@query(
    "paging_out_of_range",
    f"""
    select distinct conv_id, turn + 1 as page, length(text) % 5 as fp, 'page_cap' as reject_reason
    from conversations where turn >= {PAGE_CAP}
    """,
)
def paging_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = paging.out_of_range(_turn_pages(spark, sf_dir), "page", max_pages=PAGE_CAP)
    return cut.select("conv_id", "page", "fp", "reject_reason").distinct()


# ---- keyed writes --------------------------------------------------------------------------

_EVENT_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
_ORDERED = """
    select *, row_number() over (order by ts, event_id) as n,
           case when event_type = 'error' then null else value end as price,
           case event_type when 'click' then 'Rare' when 'view' then 'Common' end as rarity,
           case event_type when 'signup' then event_id end as data_id
    from events
"""


def _observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of products and cards, with nulls by event type."""
    kind, events = F.col("event_type"), table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        utc_instant(F.col("ts")).alias("observed_at"),
        "value",
        F.when(kind != "error", F.col("value")).alias("price"),
        F.when(kind == "click", "Rare").when(kind == "view", "Common").alias("rarity"),
        F.when(kind == "signup", F.col("event_id")).alias("data_id"),
    )


_ORDER = ("observed_at", "event_id")


def _in_two_batches(rows: DataFrame, policy: U.Policy) -> DataFrame:
    """The state after the first half of the month, then the rest upserted into it."""
    early = F.col("observed_at") < F.expr("timestamp '2024-01-16 00:00:00+00:00'")
    stored = U.fold(rows.where(early), policy, _ORDER)
    return U.upsert(stored, rows.where(~early), policy, _ORDER)


_PRODUCT_STATE = f"""
    select cast(user_id as string) as product_id, last.event_type as product_group,
           cast(last.event_id as string) as model_number, last.rarity as condition,
           last.price as price_yen, {_EVENT_ISO.format("first_ts")} as created_at,
           {_EVENT_ISO.format("last.ts")} as updated_at
    from (select user_id, min(ts) as first_ts, max(n) as n from ({_ORDERED}) group by user_id) k
    join ({_ORDERED}) last using (user_id, n)
"""


def _product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return _observed(spark, sf_dir).select(
        "event_id",
        "observed_at",
        F.col("user_id").cast("string").alias("product_id"),
        F.col("event_type").alias("product_group"),
        F.col("event_id").cast("string").alias("model_number"),
        *(none.alias(c) for c in ("set_size", "name", "name_full", "model_code", "url")),
        F.col("rarity").alias("condition"),
        F.col("price").alias("price_yen"),
        F.col("observed_at").alias("created_at"),
        F.col("observed_at").alias("updated_at"),
    )


def _shown(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_group",
        "model_number",
        "condition",
        "price_yen",
        iso_utc(F.col("created_at")).alias("created_at"),
        iso_utc(F.col("updated_at")).alias("updated_at"),
    )


@query("product_upsert", _PRODUCT_STATE)
def product_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_in_two_batches(_product_rows(spark, sf_dir), U.PRODUCTS))


def _out_of_order(rows: DataFrame, policy: U.Policy, batches: tuple[int, ...]) -> DataFrame:
    """The table after three batches, interleaved in time, folded in the given order of arrival."""
    number, states = F.pmod("event_id", F.lit(3)), None
    for batch in batches:
        fresh = U.state_of(rows.where(number == batch), policy, _ORDER)
        states = fresh if states is None else U.merge_states(states.unionByName(fresh), policy)
    return U.values_of(states, policy)


@query(
    "late_batches",
    f"""
    select arrival, t.* from ({_PRODUCT_STATE}) t, (values ('in turn'), ('late and repeated')) a(arrival)
    """,
)
def late_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches in two orders, once with a batch that comes again: one product table."""
    rows = _product_rows(spark, sf_dir)
    orders = (("in turn", (0, 1, 2)), ("late and repeated", (2, 0, 2, 1)))
    first, second = (
        _shown(_out_of_order(rows, U.PRODUCTS, batches)).withColumn("arrival", F.lit(name)) for name, batches in orders
    )
    return first.unionByName(second)


_LAST_KNOWN = f"""
    select user_id as card_id,
           case when arg_max(event_id, n) % 2 = 0 then 'en' else 'jp' end as lang,
           concat('S', cast(arg_max(event_id, n) % 100 as string)) as set_code,
           cast(arg_max(event_id, n) as string) as card_code,
           arg_max(data_id, n) as data_id, arg_max(rarity, n) as rarity,
           arg_max(price, n) as usd_price,
           arg_max(case when event_type = 'purchase' then value end, n) as eur_price
    from ({_ORDERED}) group by user_id
"""


def _card_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return _observed(spark, sf_dir).select(
        "event_id",
        "observed_at",
        F.col("user_id").alias("card_id"),
        F.when(event % 2 == 0, "en").otherwise("jp").alias("lang"),
        F.concat(F.lit("S"), (event % 100).cast("string")).alias("set_code"),
        event.cast("string").alias("card_code"),
        "data_id",
        "rarity",
        F.col("price").alias("usd_price"),
        F.when(F.col("event_type") == "purchase", F.col("price")).alias("eur_price"),
    )


@query("card_index_upsert", f"select * exclude (usd_price, eur_price) from ({_LAST_KNOWN})")
def card_index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_two_batches(_card_rows(spark, sf_dir), U.CARD_INDEX)


@query("card_price_upsert", _LAST_KNOWN)
def card_price_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_two_batches(_card_rows(spark, sf_dir), U.CARD_PRICES)


@query("late_card_batches", _LAST_KNOWN)
def late_card_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card prices of three batches that arrive out of order."""
    return _out_of_order(_card_rows(spark, sf_dir), U.CARD_PRICES, (2, 0, 1))


@query(
    "snapshot_append",
    f"""
    select cast(user_id as string) as product_id, {_EVENT_ISO.format("ts")} as observed_at,
           value as price_yen, strftime(ts, '%Y-%m-%d') as observed_date
    from events
    union all
    select cast(user_id as string), {_EVENT_ISO.format("ts + interval 1 day")}, value + 1,
           strftime(ts + interval 1 day, '%Y-%m-%d')
    from events where event_type = 'purchase'
    """,
)
def snapshot_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation, then a second batch a day later; nothing is merged."""
    day_later = F.timestamp_add("DAY", F.lit(1), F.col("observed_at"))
    seen = _observed(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("product_id"),
        "observed_at",
        F.col("value").alias("price_yen"),
        "event_type",
    )
    second = seen.where("event_type = 'purchase'").withColumns(
        {"observed_at": day_later, "price_yen": F.col("price_yen") + 1}
    )
    appended = U.snapshots(seen).unionByName(U.snapshots(second))
    return appended.select(
        "product_id",
        iso_utc(F.col("observed_at")).alias("observed_at"),
        "price_yen",
        F.col("observed_date").cast("string").alias("observed_date"),
    )


@query(
    "daily_price",
    f"""
    select cast(user_id as string) as product_id, strftime(ts, '%Y-%m-%d') as captured_date,
           {_EVENT_ISO.format("ts")} as captured_at, price,
           case when event_type = 'view' then 'USD' else 'JPY' end as currency,
           event_type as stock_status
    from (select *, row_number() over (partition by user_id, cast(ts as date)
                                       order by ts desc, event_id desc) as latest
          from ({_ORDERED}))
    where latest = 1
    """,
)
def daily_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = _observed(spark, sf_dir).select(
        "event_id",
        F.col("user_id").cast("string").alias("product_id"),
        F.col("observed_at").alias("captured_at"),
        "price",
        F.when(F.col("event_type") == "view", "USD").alias("currency"),
        F.col("event_type").alias("stock_status"),
    )
    daily = U.daily_prices(captures, tie_break=["event_id"])
    return daily.withColumns(
        {
            "captured_date": F.col("captured_date").cast("string"),
            "captured_at": iso_utc(F.col("captured_at")),
        }
    )


# ---- constraint checks -----------------------------------------------------------------------


@query(
    "dup_keys",
    """
    select user_id, event_type, count(*) as n_rows from events
    where user_id is not null and event_type is not null
    group by all having count(*) > 1
    """,
)
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "events"), ["user_id", "event_type"])


@query(
    "dup_lines",
    """
    select l_orderkey, l_linenumber, count(*) as n_rows from lineitem
    group by all having count(*) > 1
    """,
)
def dup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    "orphans",
    """
    select doc_id, count(*) as n_rows from documents
    where doc_id not in (select doc_id from labels) group by doc_id
    """,
)
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id no label refers to."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.orphan_keys(documents, "doc_id", labels, "doc_id")


@query(
    "silent_customers",
    """
    select c_custkey, count(*) as n_rows from customer
    where c_custkey not in (select user_id from events) group by c_custkey
    """,
)
def silent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer keys without an event: here the parent side repeats its key."""
    customer, events = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")
    return quality.orphan_keys(customer, "c_custkey", events, "user_id")


_NULLED = ("price", "rarity", "data_id", "event_type")


@query(
    "null_counts",
    " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as n_nulls "
        f"from ({_ORDERED})"
        for c in _NULLED
    ),
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_observed(spark, sf_dir), _NULLED)


@query(
    "bad_ids",
    """
    select c_custkey, case when c_mktsegment not in ('BUILDING', 'MACHINERY') then c_custkey end
               as card_id,
           case when c_mktsegment in ('BUILDING', 'MACHINERY') then 'card_id' end as reject_reason
    from customer
    """,
)
def bad_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = (
        "case c_mktsegment when 'BUILDING' then '' when 'MACHINERY' then c_name "
        "else concat(' ', cast(c_custkey as string)) end"
    )
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr(shown).alias("card_id"))
    return quality.require_integer_id(rows)
