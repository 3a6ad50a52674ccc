"""URL building, splitting and resolving as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import blank_to_null

# Address forms of the shop and of the card site.
GROUP_IN_URL = r"(?U)/product-group/(\d+)"
CARD_PATH = r"(/cards/[^?#]+)"
LISTING_LEAF = "0/photo?num={size}&page="
TRANSLATED_LANG, TRANSLATED_QUERY = "jp", "?translate=en"

# Parts of the generic URI pattern of RFC 3986, appendix B.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*:)"
_ORIGIN = r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)"
_BEFORE_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?"
_DOTS = r"(?:^|/)\.\.?(?:/|$)"

# The usual reference: an absolute path without dots, hosts and characters that are dropped.
_PLAIN_PATH = r"^/(?!/)[^?#.\t\r\n]*+(?:[?#][^\t\r\n]*+)?+\z"


def url_path(url: Column) -> Column:
    """The path component, without ``;params`` of its last part.

    As the standard library does, leading control characters and spaces go first."""
    clean = F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")
    path = F.regexp_replace(F.regexp_extract(clean, r"^([^?#]*)", 1), _BEFORE_PATH, "")
    return F.regexp_replace(path, r";[^/]*\z", "")


def path_parts(url: Column) -> Column:
    """Path split at ``/`` after outer slashes are dropped; inner empty parts stay."""
    return F.split(F.btrim(url_path(url), F.lit("/")), "/")


def product_group(url: Column) -> Column:
    """Digits after ``/product-group/``, or null."""
    return blank_to_null(F.regexp_extract(url, GROUP_IN_URL, 1))


def card_path(url: Column) -> Column:
    """``/cards/…`` up to the query or fragment, or null."""
    return blank_to_null(F.regexp_extract(url, CARD_PATH, 1))


def _without_dots(path: Column) -> Column:
    """Drop ``.`` and resolve ``..``, as a fold over an absolute path's parts."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == ".", acc)
        .when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.array_append(acc, part)),
    )
    joined = F.array_join(
        F.when(path.rlike(r"(?:^|/)\.\.?$"), F.array_append(kept, F.lit(""))).otherwise(kept), "/"
    )
    return F.coalesce(blank_to_null(joined), F.lit("/"))


def resolve_url(base: Column | str, ref: Column) -> Column:
    """Resolve a reference against a base (RFC 3986 section 5.2); null or '' gives null.

    As browsers and the standard library do, leading control characters and spaces go, tabs and
    line breaks go everywhere, and a reference of the base's scheme without a host is relative.
    A literal base folds to constants, and the usual ``/path`` reference takes one test and one
    concatenation.
    """
    base = F.lit(base) if isinstance(base, str) else base
    origin = F.regexp_extract(base, _ORIGIN, 1)
    plain = F.when(ref.rlike(_PLAIN_PATH), F.concat(origin, ref))
    return F.coalesce(plain, _resolve_any(base, origin, ref))


def _fields(**columns: Column) -> Column:
    return F.named_struct(*(part for name, column in columns.items() for part in (F.lit(name), column)))


def _resolve_any(base: Column, origin: Column, ref: Column) -> Column:
    """Any reference.  Each step is bound once; written out, a step would be repeated in every branch
    of the next one, and the whole some thousand expressions large."""
    base_path = F.regexp_replace(F.regexp_extract(base, r"^([^?#]*)", 1), _BEFORE_PATH, "")
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_replace(base_path, r"[^/]*$", ""))
    own_scheme = F.concat(F.lower(F.regexp_extract(base, _SCHEME, 0)), F.lit(""))

    def with_scheme(seen: Column) -> Column:
        scheme = F.lower(F.regexp_extract(seen["bare"], _SCHEME, 0))
        return _fields(ref=seen["ref"], bare=seen["bare"], scheme=scheme)

    def meant(seen: Column) -> Column:
        bare, scheme = seen["bare"], seen["scheme"]
        after = F.length(scheme) + 1
        relative_scheme = (scheme == own_scheme) & ~F.substring(bare, after, F.lit(2)).eqNullSafe("//")
        return F.when((scheme != "") & relative_scheme, F.substring(bare, after, F.length(bare))).otherwise(
            F.when((scheme != "") & (scheme != own_scheme), seen["ref"]).otherwise(bare)
        )

    def in_parts(ref: Column) -> Column:
        path = F.regexp_extract(ref, r"^([^?#]*)", 1)
        tail = F.regexp_extract(ref, r"(?s)^[^?#]*(.*)$", 1)
        relative = F.regexp_replace(F.concat(folder, path), "/{2,}", "/")
        return _fields(ref=ref, path=path, tail=tail, relative=relative)

    def resolved(seen: Column) -> Column:
        ref, path, tail, relative = (seen[c] for c in ("ref", "path", "tail", "relative"))
        return (
            F.when(ref.isNull() | (ref == ""), F.lit(None).cast("string"))
            .when(ref.rlike(r"^/(?!/)") & ~path.rlike(_DOTS), F.concat(origin, ref))
            .when(ref.rlike(_SCHEME), ref)
            .when(ref.startswith("//"), F.concat(F.regexp_extract(base, _SCHEME, 1), ref))
            .when(ref.startswith("?"), F.concat(origin, base_path, ref))
            .when(ref.startswith("#"), F.concat(origin, base_path, base_query, ref))
            .when(ref.startswith("/"), F.concat(origin, _without_dots(path), tail))
            .when(~relative.rlike(_DOTS), F.concat(origin, relative, tail))
            .otherwise(F.concat(origin, _without_dots(relative), tail))
        )

    bare = F.regexp_replace(F.regexp_replace(ref, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    steps = F.array(_fields(ref=ref, bare=bare))
    for step in (with_scheme, meant, in_parts, resolved):
        steps = F.transform(steps, step)
    return steps[0]


def page_url(list_url: Column, page_index: Column, page_size: int = 100) -> Column:
    """Address of one listing page below a series address."""
    folder = F.concat(F.regexp_replace(list_url, "/+$", ""), F.lit("/"))
    leaf = F.concat(F.lit(LISTING_LEAF.format(size=page_size)), page_index.cast("string"))
    return resolve_url(folder, leaf)


def card_url(root: str, lang: Column, set_code: Column, card_code: Column) -> Column:
    """Address of one card page; pages in one language are asked for in translation."""
    address = F.concat_ws("/", F.lit(root.rstrip("/")), lang, set_code, card_code.cast("string"))
    return F.concat(address, F.when(lang == TRANSLATED_LANG, TRANSLATED_QUERY).otherwise(""))
