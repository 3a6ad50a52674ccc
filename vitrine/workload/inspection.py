"""Page inspection and link reading over the given pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions import urls
from vitrine.operators import cards, dom, inspect
from vitrine.workload import inputs as I
from vitrine.workload.registry import query, table

_DECODED = (
    "replace(replace(replace(replace(replace(replace({}, '&copy;', '©'), '&nbsp;', chr(160)), "
    "'&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"
)

_TITLES = f"""
    select page_id, {_DECODED.format("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)")}
           as title
    from pages
"""


@query("page_titles", _TITLES)
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect.page_titles(table(spark, sf_dir, "pages"), ["page_id"])


@query("page_titles_tolerant", _TITLES)
def page_titles_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom.page_titles(table(spark, sf_dir, "pages"), ["page_id"])


_SCRIPTS = """
    select page_id, script_pos, substr(code, 1, 500) as script_text, length(code) as script_length
    from (
        select page_id, generate_subscripts(s, 1) - 1 as script_pos,
               trim(unnest(s), chr(32) || chr(9) || chr(10) || chr(13)) as code
        from (select page_id,
                     regexp_extract_all(html, '(?s)<script[^>]*>(.*?)</script>', 1) as s
              from pages))
    where code <> ''
"""


def _scripts(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: F.col(c).cast("bigint") for c in ("script_pos", "script_length")}
    )


@query("page_scripts", _SCRIPTS)
def page_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scripts(inspect.inline_scripts(table(spark, sf_dir, "pages"), ["page_id"], preview=500))


@query("page_scripts_tolerant", _SCRIPTS)
def page_scripts_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scripts(dom.inline_scripts(table(spark, sf_dir, "pages"), ["page_id"], preview=500))


def _described_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages, with tags that carry their address put behind the charset tag."""
    charset = '<meta charset="utf-8">'
    address = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    tags = F.concat(
        F.lit(charset + "<meta name='description' content=\""),
        address,
        F.lit('"><meta http-equiv="x" content="y"><META content="'),
        address,
        F.lit('" property="og:url"/>'),
    )
    html = F.replace(F.col("html"), F.lit(charset), tags)
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


_META = """
    with described as (select page_id, url from pages where html like '%<meta charset="utf-8">%')
    select page_id, 1 as meta_pos, 'description' as meta_name, null as meta_property,
           url as meta_content from described
    union all
    select page_id, 3, null, 'og:url', url from described
"""


@query("page_meta", _META)
def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspect.meta_tags(_described_pages(spark, sf_dir), ["page_id"])


@query("page_meta_tolerant", _META)
def page_meta_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom.meta_tags(_described_pages(spark, sf_dir), ["page_id"])


@query(
    "comment_ids",
    """
    select page_id, regexp_extract(html, '<!-- ad ([0-9]+) -->', 1) as ad,
           cast(page_id as string) as card_id,
           case when page_id % 2 = 0 then concat('d', cast(page_id as string)) end as data_id
    from pages
    """,
)
def comment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    more = F.concat(
        F.lit("<!-- CARD ID first --><!--\n CARD ID "),
        key,
        F.lit(" CARD ID\n--><!-- an id: DATA ID none -->"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<!--DATA ID d"), key, F.lit("-->"))).otherwise(""),
    )
    pages = table(spark, sf_dir, "pages").select(
        "page_id", cards.comments(F.concat("html", more)).alias("texts")
    )
    texts = F.col("texts")
    return pages.select(
        "page_id",
        cards.labelled_comment(texts, "ad").alias("ad"),
        cards.labelled_comment(texts, cards.CARD_LABEL).alias("card_id"),
        cards.labelled_comment(texts, cards.DATA_LABEL).alias("data_id"),
    )


_LINKS = """
    select page_id, link_pos, 'jp' as lang, 'SV1' as set_code, card_code
    from (
        select page_id, link_pos, href,
               rtrim(regexp_extract(substr(href, 2), '^([^?#;]*)', 1), '/') as card_code
        from (
            select page_id, generate_subscripts(h, 1) - 1 as link_pos, unnest(h) as href
            from (select page_id,
                         regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1) as h
                  from pages)))
    where href like '/%' and card_code <> '' and card_code not like '%/%'
"""


def _links(rows: DataFrame) -> DataFrame:
    return rows.withColumn("link_pos", F.col("link_pos").cast("bigint"))


@query("link_parts", _LINKS)
def link_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(cards.extract_links(I.linked_pages(spark, sf_dir), ["page_id"], "/cards/jp"))


@query("link_parts_tolerant", _LINKS)
def link_parts_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _links(dom.extract_links(I.linked_pages(spark, sf_dir), ["page_id"], "/cards/jp"))


@query(
    "url_group",
    """
    with split as (
        select page_id, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) as url_path from pages)
    select page_id, url_path, len(string_split(trim(url_path, '/'), '/')) as n_parts,
           case when url_path like '/en/%' then regexp_extract(url_path, '^/en/([0-9]+)', 1) end
               as product_group,
           case when url_path like '/fr/%' then replace(url_path, '/fr/', '/cards/') end as card_path
    from split
    """,
)
def url_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = F.replace(F.col("url"), F.lit("/en/"), F.lit("/product-group/"))
    carded = F.replace(F.col("url"), F.lit("/fr/"), F.lit("/cards/"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        urls.url_path(F.col("url")).alias("url_path"),
        F.size(urls.path_parts(F.col("url"))).cast("bigint").alias("n_parts"),
        urls.product_group(grouped).alias("product_group"),
        urls.card_path(carded).alias("card_path"),
    )
