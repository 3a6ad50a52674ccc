"""Tolerant route: the same extractions for pages that patterns cannot read.

A small Python helper flattens each page into an array of nodes; each node knows where its
subtree ends.  Everything after that (selection, text, links, fields) is Spark: filters and
slices over the node array.  Only the page's HTML goes to the Python worker, in Arrow batches
bounded by ``spark.sql.execution.arrow.maxBytesPerBatch``, and only nodes come back, in batches of
some hundred pages.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from vitrine.functions import text as T
from vitrine.functions.prices import decimal_price
from vitrine.functions.urls import resolve_url
from vitrine.operators import cards, inspect, listing

TEXT, COMMENT = "#text", "#comment"

# Elements that never have content, and those whose text is not page text.
VOID = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
HIDDEN = ("script", "style", "template", "rt", "rp")

NODES = S.ArrayType(
    S.StructType(
        [
            S.StructField("pos", S.IntegerType()),
            S.StructField("end", S.IntegerType()),
            S.StructField("tag", S.StringType()),
            S.StructField("parent", S.StringType()),
            S.StructField("text", S.StringType()),
            S.StructField("classes", S.ArrayType(S.StringType())),
            S.StructField("attrs", S.MapType(S.StringType(), S.StringType())),
        ]
    )
)


# A written batch of nodes holds the pages of about so many characters, however many rows Spark sends.
_BATCH_CHARACTERS = 1 << 18

_TEXTS = pa.list_(pa.string())
_ATTRS = pa.map_(pa.string(), pa.string())
_NODE = pa.struct(
    [
        pa.field("pos", pa.int32()),
        pa.field("end", pa.int32()),
        pa.field("tag", pa.string()),
        pa.field("parent", pa.string()),
        pa.field("text", pa.string()),
        pa.field("classes", _TEXTS),
        pa.field("attrs", _ATTRS),
    ]
)


def _offsets(ends: list[int]) -> pa.Array:
    return pa.array([0, *ends], pa.int32())


class _Flattener(HTMLParser):
    """Collects the nodes of pages in document order, by column; a close tag ends every element inside
    its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # where the nodes of each page, and the classes and attributes of each node, end
        self.page_ends: list[int] = []
        self.class_ends: list[int] = []
        self.attr_ends: list[int] = []
        self.ends: list[int] = []
        self.tags: list[str] = []
        self.parents: list[str | None] = []
        self.texts: list[str | None] = []
        self.classes: list[str] = []
        self.names: list[str] = []
        self.values: list[str] = []

    def read(self, page: str | None) -> None:
        self.reset()
        self.start = len(self.tags)
        self.open: list[int] = []
        # how many elements of each name are open
        self.count: Counter[str] = Counter()
        self.joinable = False
        self.feed(page or "")
        self.close()
        for node in self.open:
            self.ends[node] = len(self.tags) - self.start
        self.page_ends.append(len(self.tags))

    def _add(self, tag: str, text: str | None = None) -> None:
        self.parents.append(self.tags[self.open[-1]] if self.open else None)
        self.tags.append(tag)
        self.ends.append(len(self.tags) - self.start)
        self.texts.append(text)
        self.class_ends.append(len(self.classes))
        self.attr_ends.append(len(self.names))
        self.joinable = tag == TEXT

    def handle_starttag(self, tag, attrs):
        read = {name: value or "" for name, value in attrs}
        self.classes += read.get("class", "").split()
        self.names += read.keys()
        self.values += read.values()
        self._add(tag)
        if tag not in VOID:
            self.open.append(len(self.tags) - 1)
            self.count[tag] += 1

    def handle_endtag(self, tag):
        self.joinable = False
        if self.count[tag]:
            closed = None
            while closed != tag:
                node = self.open.pop()
                self.ends[node] = len(self.tags) - self.start
                closed = self.tags[node]
                self.count[closed] -= 1

    def handle_data(self, data):
        if self.joinable:
            self.texts[-1] += data
        else:
            self._add(TEXT, text=data)

    def handle_comment(self, data):
        self._add(COMMENT, text=data)

    def handle_decl(self, decl):
        self.joinable = False

    handle_pi = handle_decl

    def nodes(self) -> pa.Array:
        """One list of nodes per page that was read."""
        starts = (0, *self.page_ends)
        positions = [i for start, end in zip(starts, self.page_ends) for i in range(end - start)]
        classes = pa.ListArray.from_arrays(_offsets(self.class_ends), pa.array(self.classes, pa.string()))
        attrs = pa.MapArray.from_arrays(
            _offsets(self.attr_ends), pa.array(self.names, pa.string()), pa.array(self.values, pa.string())
        )
        columns = [
            pa.array(positions, pa.int32()),
            pa.array(self.ends, pa.int32()),
            *(pa.array(texts, pa.string()) for texts in (self.tags, self.parents, self.texts)),
            classes.cast(_TEXTS),
            attrs.cast(_ATTRS),
        ]
        nodes = pa.StructArray.from_arrays(columns, fields=list(_NODE))
        return pa.ListArray.from_arrays(_offsets(self.page_ends), nodes)


def _flatten(page: str | None) -> pa.Array:
    """The nodes of one page."""
    flattener = _Flattener()
    flattener.read(page)
    return flattener.nodes()[0].values


def _node_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Pages to node arrays in short batches, so that a worker holds the nodes of few pages at a time."""
    for pages in batches:
        flattener, size = _Flattener(), 0
        for page in pages:
            html = page.as_py()
            flattener.read(html)
            size += len(html or "")
            if size >= _BATCH_CHARACTERS:
                yield flattener.nodes()
                flattener, size = _Flattener(), 0
        if flattener.page_ends:
            yield flattener.nodes()


@F.arrow_udf(NODES)
def page_nodes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """HTML to its node array."""
    yield from _node_batches(batches)


def _is(node: Column, tag: str | None, *classes: str) -> Column:
    test = F.lit(True) if tag is None else node["tag"] == tag
    for name in classes:
        test = test & F.array_contains(node["classes"], name)
    return test


def select_nodes(nodes: Column, tag: str | None, *classes: str) -> Column:
    """Array of the elements with this tag and all these classes."""
    return F.filter(nodes, lambda n: n["attrs"].isNotNull() & _is(n, tag, *classes))


def first_within(nodes: Column, *levels: Callable[[Column], Column]) -> Column:
    """The first element of the last level that lies inside one of the level before, and so on.

    One sweep in document order: as elements nest, a node lies inside one of a level if it stands
    before the furthest end that elements of that level have had so far."""
    start = F.struct(
        *(F.lit(0).alias(f"end{i}") for i in range(len(levels) - 1)), F.lit(None).cast("int").alias("found")
    )

    def step(state: Column, node: Column) -> Column:
        is_element = node["attrs"].isNotNull()
        fields = []
        for i, test in enumerate(levels):
            hit = is_element & test(node)
            if i:
                hit = hit & (node["pos"] < state[f"end{i - 1}"])
            if i < len(levels) - 1:
                end = state[f"end{i}"]
                fields.append(F.when(hit, F.greatest(end, node["end"])).otherwise(end).alias(f"end{i}"))
            else:
                fields.append(F.coalesce(state["found"], F.when(hit, node["pos"])).alias("found"))
        return F.struct(*fields)

    found = F.aggregate(nodes, start, step, lambda state: state["found"])
    return F.get(nodes, found - nodes[0]["pos"])


def subtree(nodes: Column, top: Column) -> Column:
    """The element and all nodes below it; ``nodes`` may itself be a subtree."""
    offset = nodes[0]["pos"]
    return F.slice(nodes, top["pos"] - offset + 1, top["end"] - top["pos"])


def first(nodes: Column) -> Column:
    return F.try_element_at(nodes, F.lit(1))


def node_text(nodes: Column, top: Column) -> Column:
    """Stripped text pieces below an element, joined without spaces; null without element."""
    pieces = F.filter(
        subtree(nodes, top), lambda n: (n["tag"] == TEXT) & ~n["parent"].isin(*HIDDEN)
    )
    return F.when(
        top.isNotNull(), F.array_join(F.transform(pieces, lambda n: T.strip(n["text"])), "")
    )


def _with_nodes(pages: DataFrame, keep: Sequence[str], html: str) -> DataFrame:
    return pages.select(*keep, page_nodes(F.col(html)).alias("_nodes"))


def _product_id(block: Column) -> Column:
    return T.blank_to_null(F.try_element_at(block[0]["attrs"], F.lit(listing.ID_ATTRIBUTE)))


def _product_href(block: Column) -> Column:
    link = first(select_nodes(block, "a", listing.LINK_CLASS))
    return F.try_element_at(link["attrs"], F.lit("href"))


def explode_blocks(
    pages: DataFrame, keep: Sequence[str], base_url: str | None = None, html: str = "html"
) -> DataFrame:
    """As ``listing.explode_blocks``; ``_block`` holds the nodes of the block's subtree."""
    nodes, blocks = F.col("_nodes"), F.col("_blocks")
    trees = F.transform(
        select_nodes(nodes, "div", listing.BLOCK_CLASS), lambda top: subtree(nodes, top)
    )
    out = _with_nodes(pages, keep, html).select(*keep, trees.alias("_blocks"))
    page_columns: list[Column | str] = list(keep)
    if base_url is not None:
        top = F.try_element_at(blocks, F.lit(1))
        identity = F.struct(
            _product_id(top).alias("product_id"),
            resolve_url(base_url, _product_href(top)).alias("product_url"),
        )
        page_columns += [
            F.size(blocks).alias("n_items"),
            F.when(F.size(blocks) > 0, identity).alias("fingerprint"),
        ]
    return out.select(*page_columns, F.posexplode_outer(blocks).alias("item_pos", "_block"))


def read_fields(blocks: DataFrame, base_url: str) -> DataFrame:
    """As ``listing.read_fields``."""
    block = F.col("_block")
    others = [c for c in blocks.columns if c != "_block"]

    def in_box(box: str, span: str) -> Column:
        return first_within(block, lambda n: _is(n, "p", box), lambda n: _is(n, "span", span))

    found = blocks.select(
        *others,
        "_block",
        in_box(listing.NAME_BOX, listing.NAME_CLASS).alias("_name"),
        in_box(listing.NAME_BOX, listing.MODEL_CLASS).alias("_model"),
        in_box(listing.PRICE_BOX, listing.PRICE_CLASS).alias("_price"),
    )
    texts = found.select(
        *others,
        _product_id(block).alias("product_id"),
        _product_href(block).alias("href"),
        node_text(block, F.col("_name")).alias("name_full"),
        node_text(block, F.col("_model")).alias("model_text"),
        node_text(block, F.col("_price")).alias("price"),
    )
    return listing.finish_record(texts, base_url)


def parse_products(
    pages: DataFrame, base_url: str, keep: Sequence[str], html: str = "html"
) -> DataFrame:
    """As ``listing.parse_products``; an outer block includes the fields of inner ones."""
    blocks = explode_blocks(pages, keep, html=html).where(F.col("_block").isNotNull())
    return read_fields(blocks, base_url)


def extract_links(
    pages: DataFrame,
    keep: Sequence[str],
    prefix: str = "/cards/",
    root: str = cards.LINK_ROOT,
    fields: Sequence[str] = cards.LINK_FIELDS,
    html: str = "html",
) -> DataFrame:
    """As ``cards.extract_links``."""
    targets = F.filter(
        select_nodes(F.col("_nodes"), "a"), lambda n: F.map_contains_key(n["attrs"], "href")
    )
    stripped = F.transform(targets, lambda n: T.strip(n["attrs"]["href"]))
    links = _with_nodes(pages, keep, html).select(
        *keep, F.posexplode(stripped).alias("link_pos", "_href")
    )
    return cards.links_from_hrefs(links, keep, prefix, root, fields)


def card_fields(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """As ``cards.card_fields``."""
    nodes = F.col("_nodes")
    detail = first_within(
        nodes,
        lambda n: _is(n, None, cards.PRINT_BOX),
        lambda n: _is(n, None, cards.PRINT_DETAILS),
        lambda n: _is(n, "span") & ~F.array_contains(n["classes"], cards.PRINT_TITLE),
    )
    comment_nodes = F.filter(nodes, lambda n: n["tag"] == COMMENT)

    def price(currency: str) -> Column:
        return first(select_nodes(nodes, "span", cards.PRICE_CLASS, currency))

    found = _with_nodes(pages, keep, html).select(
        *keep,
        "_nodes",
        F.transform(comment_nodes, lambda n: T.strip(n["text"])).alias("_comments"),
        detail.alias("_detail"),
        price(cards.USD_CLASS).alias("_usd"),
        price(cards.EUR_CLASS).alias("_eur"),
    )
    return found.select(
        *keep,
        cards.labelled_comment(F.col("_comments"), cards.CARD_LABEL).alias("card_id"),
        cards.labelled_comment(F.col("_comments"), cards.DATA_LABEL).alias("data_id"),
        cards.rarity_of(node_text(nodes, F.col("_detail"))).alias("rarity"),
        decimal_price(node_text(nodes, F.col("_usd"))).alias("usd_price"),
        decimal_price(node_text(nodes, F.col("_eur"))).alias("eur_price"),
    )


def _only_text(nodes: Column, top: Column) -> Column:
    """Text of an element whose single child is text, else null."""
    child = F.try_element_at(subtree(nodes, top), F.lit(2))
    return F.when((top["end"] - top["pos"] == 2) & (child["tag"] == TEXT), child["text"])


def page_titles(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """As ``inspect.page_titles``."""
    nodes = F.col("_nodes")
    found = _with_nodes(pages, keep, html).select(
        *keep, "_nodes", first(select_nodes(nodes, "title")).alias("_title")
    )
    return found.select(*keep, _only_text(nodes, F.col("_title")).alias("title"))


def meta_tags(pages: DataFrame, keep: Sequence[str], html: str = "html") -> DataFrame:
    """As ``inspect.meta_tags``."""
    attrs = F.col("_tag.attrs")
    rows = _with_nodes(pages, keep, html).select(
        *keep, F.posexplode(select_nodes(F.col("_nodes"), "meta")).alias("meta_pos", "_tag")
    )
    read = rows.select(
        *keep,
        "meta_pos",
        *(
            F.try_element_at(attrs, F.lit(name)).alias(f"meta_{name}")
            for name in ("name", "property", "content")
        ),
    )
    return read.where(inspect.is_named())


def inline_scripts(
    pages: DataFrame,
    keep: Sequence[str],
    html: str = "html",
    preview: int | None = None,
) -> DataFrame:
    """As ``inspect.inline_scripts``."""
    nodes = F.col("_nodes")
    codes = F.transform(
        select_nodes(nodes, "script"), lambda top: T.strip(_only_text(nodes, top))
    )
    rows = _with_nodes(pages, keep, html).select(
        *keep, F.posexplode(codes).alias("script_pos", "_code")
    )
    return inspect.preview_scripts(rows, keep, preview)
