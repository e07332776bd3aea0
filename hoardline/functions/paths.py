"""Path, key and URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hoardline.functions import vocabulary as V
from hoardline.functions.text import blank_to_null, nan_safe, safe_int

STORE_PREFIXES = ("raw", "processed", "ml")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def slashes(path: Column) -> Column:
    return F.trim(F.replace(path, F.lit("\\"), F.lit("/")))


def strip_dot_slash(path: Column) -> Column:
    """Without any leading dots and slashes."""
    return F.ltrim(path, F.lit("./"))


def normal_path(path: Column) -> Column:
    return strip_dot_slash(slashes(path))


def path_kind(path: Column, prefixes: tuple[str, ...] = STORE_PREFIXES) -> Column:
    """``store`` for an object-store key, ``local`` otherwise; blank paths have no kind."""
    text = F.ltrim(F.trim(path), F.lit("/"))
    key = text.rlike("^(" + "|".join(prefixes) + ")/")
    return F.when(F.coalesce(path, F.lit("")) != "", F.when(key, "store").otherwise("local"))


def canonical_raw_key(path: Column) -> Column:
    """``site_sale/file`` as ``raw/auctions/site/sale/file``; null where that does not apply."""
    text = F.ltrim(F.trim(path), F.lit("./"))
    parts = F.regexp_extract(text, r"^([^/]*)/(.*)$", 2)
    folder = F.regexp_extract(text, r"^([^/]*)/", 1)
    site = F.trim(F.lower(F.regexp_extract(folder, r"^([^_]*)_(.*)$", 1)))
    sale = F.trim(F.lower(F.regexp_extract(folder, r"^([^_]*)_(.*)$", 2)))
    usable = text.contains("/") & ~text.startswith("raw/") & (site != "") & (sale != "")
    return F.when(usable, F.concat_ws("/", F.lit("raw/auctions"), site, sale, parts))


def canonical_lot_key(path: Column, with_side: bool = False) -> Column:
    """``house_sale_lot`` from the folders, else from the file name, else the file stem.

    ``with_side`` appends ``_obv`` or ``_rev`` where the path says so, which keeps the two sides of a
    lot apart.
    """
    text = F.replace(path, F.lit("\\"), F.lit("/"))
    folders = r"/([a-zA-Z]+)/([a-zA-Z0-9]+)/Lot_(\d+)"
    named = r"([a-zA-Z]+)_([a-zA-Z0-9]+)_(\d{4,5})"
    name = basename(text)

    def key(source: Column, pattern: str) -> Column:
        house, sale, lot = (F.regexp_extract(source, pattern, i) for i in (1, 2, 3))
        return F.when(lot != "", F.concat_ws("_", F.lower(house), sale, lot))

    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    found = F.coalesce(key(text, folders), key(name, named), stem, F.lit(""))
    if with_side:
        side = F.regexp_extract(name, r"(_obv|_rev)", 1)
        found = F.concat(found, F.coalesce(side, F.lit("")))
    return found


def path_keys(path: Column, data_root: str = "data") -> Column:
    """Spellings under which the same file may be listed, best first."""
    text = slashes(path)
    marker = data_root.rstrip("/") + "/"
    tail = F.when(text.contains(marker), F.substring(text, F.locate(marker, text) + len(marker), 1 << 30))
    keys = F.array(
        text,
        F.ltrim(text, F.lit("./")),
        F.ltrim(text, F.lit("/")),
        tail,
        F.concat(F.lit(marker), tail),
    )
    return F.filter(F.array_distinct(F.array_compact(keys)), lambda k: k != "")


def crop_prefix(version: str, site: Column, sale: Column, lot: Column) -> Column:
    """Object-store folder of the crops of one lot, with a five-digit lot number."""
    return F.format_string(
        f"processed/vision/{version}/crops/%s/%s/Lot_%05d", site, sale, safe_int(lot)
    )


def crop_key(version: str, site: Column, sale: Column, lot: Column, name: Column) -> Column:
    return F.concat_ws("/", crop_prefix(version, site, sale, lot), name)


def crop_base_name(house: Column, sale: Column, lot: Column) -> Column:
    """Base file name of the crops of a lot."""
    return F.format_string(
        "%s_%s_%05d",
        F.coalesce(blank_to_null(house), F.lit("lot")),
        F.coalesce(blank_to_null(sale), F.lit("0")),
        safe_int(lot),
    )


def lot_url(house: Column, sale: Column, lot: Column) -> Column:
    """Page of a lot at its auction house; blank if house or lot is unknown."""
    site = F.trim(F.lower(nan_safe(house)))
    sale_text = F.trim(nan_safe(sale))
    lot_text = F.trim(nan_safe(lot))
    number = F.when(lot_text.rlike(r"^[+-]?\d+$"), lot_text.try_cast("bigint"))
    padded = F.when(number != 0, F.format_string("%06d", number))

    def fill(template: str) -> Column:
        filled = F.lit(template)
        for mark, value in (("{sale}", sale_text), ("{lot6}", padded), ("{lot}", lot_text)):
            if mark in template:
                filled = F.replace(filled, F.lit(mark), value)
        return filled

    url = F.coalesce(*[F.when(site == name, fill(t)) for name, t in V.LOT_URLS.items()], F.lit(""))
    return F.when((site == "") | (lot_text == ""), "").otherwise(url)


def public_url(path: Column, base: str) -> Column:
    """Absolute URL of a stored image; full URLs and blanks stay as they are."""
    text = F.trim(nan_safe(path))
    plain = (text == "") | text.startswith("http")
    return F.when(plain, text).otherwise(F.concat_ws("/", F.lit(base), F.ltrim(text, F.lit("/"))))


def proxy_url(path: Column) -> Column:
    """URL of the image proxy, with the path percent-encoded except for slashes."""
    quoted = F.url_encode(path)
    for code, plain in (("%2F", "/"), ("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        quoted = F.replace(quoted, F.lit(code), F.lit(plain))
    return F.concat(F.lit("/img?path="), quoted)


def server_url(path: Column, data_root: str = "data") -> Column:
    """Server-relative URL, starting at the data root if the path runs through it."""
    inner = f"/{data_root}/"
    after = F.substring(path, F.locate(inner, path) + len(inner), 1 << 30)
    return (
        F.when(path.contains(inner), F.concat(F.lit(inner), after))
        .when(path.startswith(f"{data_root}/"), F.concat(F.lit("/"), path))
        .otherwise(F.concat(F.lit("/"), F.ltrim(path, F.lit("/"))))
    )


def parent_folder(path: Column) -> Column:
    """Second-last segment; the whole path if there is only one."""
    return F.substring_index(F.substring_index(path, "/", -2), "/", 1)


def is_noise(cluster_id: Column) -> Column:
    text = cluster_id.cast("string")
    return (text == "-1") | F.lower(text).contains("noise")


def cluster_label(cluster_id: Column) -> Column:
    text = cluster_id.cast("string")
    return F.when(is_noise(text), "Noise").otherwise(F.concat(F.lit("Cluster "), text))


def cluster_key(cluster_id: Column) -> Column:
    text = cluster_id.cast("string")
    return F.when(is_noise(text), "-1").otherwise(text)


def lot_numbers(lot_range: Column) -> Column:
    """Lots of a range written ``first-last`` or of a single number, as an array."""
    first = F.trim(F.split_part(lot_range, F.lit("-"), F.lit(1))).cast("bigint")
    last = F.coalesce(
        blank_to_null(F.trim(F.split_part(lot_range, F.lit("-"), F.lit(2)))).cast("bigint"), first
    )
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
