"""Text, address and URL expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import address, text, urls
from ..operators import photos
from ..operators.conform import conform, stamp
from ..schemas import LISTING
from .registry import check, derive, duck, table


@check(
    "conform_schema",
    """SELECT CAST(o_orderkey AS VARCHAR) AS site_id, '2001-08-02' AS added, true AS avalaible, 1 AS source_id,
              o_totalprice AS price, CAST(NULL AS VARCHAR) AS city, CAST(o_custkey AS VARCHAR) AS house_type FROM orders""",
)
def conform_schema(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("site_id"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("category_value")
    )
    rows = rows.withColumn("house_type", F.col("category_value"))
    out = conform(stamp(rows, 1, F.to_date(F.lit("2001-08-02"))), LISTING)
    out = out.withColumn("added", F.date_format("added_date", "yyyy-MM-dd"))
    return out.select("site_id", "added", "avalaible", "source_id", "price", "city", "house_type")


PRICES = """
    SELECT p_partkey, CASE WHEN p_size > 45 THEN 'Info v RK' ELSE CAST(p_size AS STRING) || ' ' ||
           substr(CAST(1000 + p_partkey AS STRING), 1, 3) || ' 000 Kč' END AS price_text FROM {part}"""


@check(
    "price_text",
    f"""SELECT p_partkey, TRY_CAST(nullif(regexp_replace(price_text, '[^0-9]', '', 'g'), '') AS DOUBLE) AS price
        FROM ({duck(PRICES)})""",
)
def price_text(spark, sf_dir):
    return derive(spark, sf_dir, PRICES).select("p_partkey", text.price(F.col("price_text")).alias("price"))


AREAS = """
    SELECT p_partkey, CASE WHEN p_size > 45 THEN 'neuvedeno' WHEN p_size > 40 THEN CAST(p_size AS STRING) || ' m2'
           WHEN p_size > 35 THEN '1.' || CAST(p_size AS STRING) || ',5 m²'
           ELSE replace(CAST(p_size AS STRING) || '.25', '.', ',') || ' m²' END AS area_text FROM {part}"""


@check(
    "area_text",
    f"""SELECT p_partkey, TRY_CAST(nullif(replace(regexp_replace(area_text, '[^0-9,.]', '', 'g'), ',', '.'), '') AS DOUBLE) AS area
        FROM ({duck(AREAS)})""",
)
def area_text(spark, sf_dir):
    return derive(spark, sf_dir, AREAS).select("p_partkey", text.area(F.col("area_text")).alias("area"))


@check(
    "number_or_null",
    f"SELECT p_partkey, TRY_CAST(split_part(area_text, ' ', 1) AS DOUBLE) AS number FROM ({duck(AREAS)})",
)
def number_or_null(spark, sf_dir):
    first = F.split_part(F.col("area_text"), F.lit(" "), F.lit(1))
    return derive(spark, sf_dir, AREAS).select("p_partkey", text.number(first).alias("number"))


@check(
    "numeric_or_parsed",
    f"""SELECT p_partkey, p_retailprice AS ready, TRY_CAST(nullif(regexp_replace(price_text, '[^0-9]', '', 'g'), '') AS DOUBLE) AS parsed,
               CAST(NULL AS DOUBLE) AS absent FROM ({duck(PRICES)}) JOIN part USING (p_partkey)""",
)
def numeric_or_parsed(spark, sf_dir):
    ready = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("Cena_numeric"))
    both = derive(spark, sf_dir, PRICES).withColumnRenamed("price_text", "Plocha").join(ready, "p_partkey")
    return both.select(
        "p_partkey",
        text.numeric_or_parsed(both.columns, "Cena", text.price).alias("ready"),
        text.numeric_or_parsed(both.columns, "Plocha", text.price).alias("parsed"),
        text.numeric_or_parsed(both.columns, "Pozemek", text.price).alias("absent"),
    )


@check(
    "first_token",
    "SELECT l_orderkey, l_linenumber, l_partkey, lower(split_part(p_name, ' ', 1)) AS token FROM lineitem JOIN part ON p_partkey = l_partkey",
)
def first_token(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", text.first_token(F.upper("p_name")).alias("token"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(parts, F.col("p_partkey") == F.col("l_partkey")).drop("p_partkey")


ESTATES = """
    SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'DUM' WHEN 'MACHINERY' THEN 'Kancelar' WHEN 'FURNITURE' THEN 'byt'
           WHEN 'BUILDING' THEN 'POZEMEK' ELSE c_mktsegment END AS estate_type FROM {customer}"""


@check(
    "dict_lookup",
    f"""SELECT c_custkey, CASE lower(estate_type) WHEN 'dum' THEN 2 WHEN 'kancelar' THEN 4 WHEN 'byt' THEN 1 WHEN 'pozemek' THEN 3 ELSE -1 END AS category_value,
               CASE lower(estate_type) WHEN 'dum' THEN 'Domy' WHEN 'kancelar' THEN 'Komerční' WHEN 'byt' THEN 'Byty' WHEN 'pozemek' THEN 'Pozemky' ELSE 'Neznámá' END AS category_name
        FROM ({duck(ESTATES)})""",
)
def dict_lookup(spark, sf_dir):
    kind = text.estate_category(F.col("estate_type"))
    return derive(spark, sf_dir, ESTATES).select(
        "c_custkey",
        F.coalesce(kind.getField("category_value"), F.lit(-1)).alias("category_value"),
        kind.getField("category_name").alias("category_name"),
    )


NAMES = """
    SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Prodej: Byty v domě ' WHEN 'SMALL' THEN ' Rodinné Domy ' WHEN 'LARGE' THEN 'CHATY a chalupy '
           WHEN 'PROMO' THEN 'Komerční objekty ' WHEN 'STANDARD' THEN 'pozemky ' ELSE 'jiné ' END || p_name AS title FROM {part}"""


@check(
    "category_map",
    f"""SELECT p_partkey, CASE WHEN contains(lower(title), 'byty') THEN 1 WHEN contains(lower(title), 'rodinné domy') THEN 2
               WHEN contains(lower(title), 'chaty a chalupy') THEN 2 WHEN contains(lower(title), 'komerční objekty') THEN 4
               WHEN contains(lower(title), 'pozemky') THEN 3 ELSE 5 END AS category_value FROM ({duck(NAMES)})""",
)
def category_map(spark, sf_dir):
    kind = text.category(F.col("title"))
    return derive(spark, sf_dir, NAMES).select("p_partkey", kind.getField("category_value").alias("category_value"))


TITLES = """
    SELECT p_partkey, CASE WHEN p_size < 20 THEN 'Prodej' WHEN p_size < 40 THEN 'Pronájem' ELSE 'Dražba' END || ' bytu ' ||
           CAST(p_size AS STRING) || CASE WHEN p_retailprice > 950 THEN '+kk ' ELSE '+1 ' END || CAST(p_size + 30 AS STRING) || ',5 m²' AS title,
           CASE WHEN p_size < 10 THEN 'DISP_' || CAST(p_size AS STRING) || '_KK' END AS disposition,
           CASE p_type WHEN 'ECONOMY' THEN 'Dum' WHEN 'SMALL' THEN 'pozemek' ELSE 'byt' END AS estate,
           CASE p_type WHEN 'ECONOMY' THEN 'Dům 90 m2, pozemek  ' ELSE 'Plocha ' END || CAST(p_size * 10 AS STRING) || '.5 m^2' AS caption
    FROM {part}"""


@check(
    "title_parse",
    f"""SELECT p_partkey, lower(nullif(regexp_extract(title, '^(Prodej|Pronájem)', 1), '')) AS deal_type,
               nullif(regexp_extract(title, '(\\d+\\+\\d+|\\d+\\+kk)', 1), '') AS rooms,
               CAST(replace(nullif(regexp_extract(title, '([0-9]+(?:[.,][0-9]+)?)\\s*(?:m2|m²|m\\^2)', 1), ''), ',', '.') AS DOUBLE) AS area
        FROM ({duck(TITLES)})""",
)
def title_parse(spark, sf_dir):
    title = F.col("title")
    return derive(spark, sf_dir, TITLES).select(
        "p_partkey",
        text.deal_type(title).alias("deal_type"),
        text.rooms(title).alias("rooms"),
        text.caption_area(title).alias("area"),
    )


@check(
    "disposition",
    f"""SELECT p_partkey, coalesce(lower(replace(replace(disposition, 'DISP_', ''), '_', '+')),
               nullif(regexp_extract(lower(title), '([1-6][+](?:kk|[1-6]))', 1), '')) AS rooms FROM ({duck(TITLES)})""",
)
def disposition(spark, sf_dir):
    return derive(spark, sf_dir, TITLES).select(
        "p_partkey", text.disposition(F.col("disposition"), F.col("title")).alias("rooms")
    )


@check(
    "land_area",
    f"""SELECT p_partkey, CASE lower(estate)
               WHEN 'dum' THEN CAST(replace(nullif(regexp_extract(lower(caption), 'pozemek\\s+([0-9]+(?:[.,][0-9]+)?)', 1), ''), ',', '.') AS DOUBLE)
               WHEN 'pozemek' THEN CAST(replace(nullif(regexp_extract(lower(caption), '([0-9]+(?:[.,][0-9]+)?)\\s*(?:m2|m²|m\\^2)', 1), ''), ',', '.') AS DOUBLE)
               END AS area_land FROM ({duck(TITLES)})""",
)
def land_area(spark, sf_dir):
    return derive(spark, sf_dir, TITLES).select(
        "p_partkey", text.land_area(F.col("estate"), F.col("caption")).alias("area_land")
    )


ADDRESSES = """
    SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 15 THEN p_name || ' ' || CAST(p_size AS STRING) || ', Praha - ' || p_type || ', ' || p_brand
           WHEN p_size < 30 THEN p_name || ',' || p_type || '-' || p_brand || ' , okres ' || p_name ELSE p_name || ', ' || p_type END AS address FROM {part}"""


@check(
    "address_split",
    f"""SELECT p_partkey, trim(split_part(a, ',', 1)) AS street, CASE WHEN contains(a, 'Praha') THEN 'Praha' ELSE trim(split_part(a, ',', 2)) END AS city,
               CASE WHEN len(string_split(a, ',')) > 2 THEN trim(split_part(a, ',', 3)) END AS district,
               CASE WHEN contains(split_part(a, ',', 2), '-') THEN trim(split_part(split_part(a, ',', 2), '-', 2)) END AS city_part
        FROM (SELECT p_partkey, coalesce(address, ',,') AS a FROM ({duck(ADDRESSES)}))""",
)
def address_split(spark, sf_dir):
    place = address.split_address(F.col("address"))
    wanted = ["street", "city", "district", "city_part"]
    return derive(spark, sf_dir, ADDRESSES).select("p_partkey", *[place.getField(c).alias(c) for c in wanted])


FREE_ADDRESSES = """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 2000 THEN 'Dlouha ' || CAST(c_custkey AS STRING) || 'a, ' || n_name || ', okres ' || c_mktsegment || '-mesto'
           WHEN c_acctbal < 4000 THEN c_mktsegment || ' 5 - ' || n_name WHEN c_acctbal < 6000 THEN n_name || ', OKRES  ' || c_mktsegment
           WHEN c_acctbal < 8000 THEN c_mktsegment || ' ' || CAST(c_custkey AS STRING) ELSE c_mktsegment || '-' || n_name || ', x' END AS address
    FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey"""


@check(
    "address_parse",
    f"""WITH a AS (SELECT c_custkey, trim(address) AS a, regexp_extract(address, '(?i)(okres\\s+([^\\-,]+))', 1) AS mention,
                          nullif(trim(regexp_extract(address, '(?i)okres\\s+([^\\-,]+)', 1)), '') AS district FROM ({duck(FREE_ADDRESSES)})),
             b AS (SELECT *, trim(split_part(CASE WHEN mention <> '' THEN trim(replace(a, mention, ''), ', ') ELSE a END, ',', 1)) AS head FROM a)
        SELECT c_custkey, district, nullif(trim(regexp_extract(head, '^([^\\d,]+)\\s+(\\d+\\w*)$', 1)), '') AS street,
               nullif(regexp_extract(head, '^([^\\d,]+)\\s+(\\d+\\w*)$', 2), '') AS house_number,
               CASE WHEN a IS NULL THEN NULL WHEN regexp_matches(head, '^.+?\\s*-\\s*.+') THEN trim(regexp_extract(head, '^(.+?)\\s*-\\s*(.+)', 1)) ELSE head END AS city,
               nullif(trim(regexp_extract(head, '^(.+?)\\s*-\\s*(.+)', 2)), '') AS city_part FROM b""",
)
def address_parse(spark, sf_dir):
    place = address.parse_address(F.col("address"))
    wanted = ["district", "street", "house_number", "city", "city_part"]
    return derive(spark, sf_dir, FREE_ADDRESSES).select("c_custkey", *[place.getField(c).alias(c) for c in wanted])


@check(
    "accent_fold",
    "SELECT doc_id, lower(trim(strip_accents(replace(text, 'ß', 'ss')))) AS folded FROM documents",
)
def accent_fold(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


# Decomposed accents, ligatures, letters of two, and other scripts.
SCRIPTS = """
    SELECT p_partkey, p_name || CASE p_size % 9 WHEN 0 THEN ' plzen\u030C' WHEN 1 THEN ' ĳs' WHEN 2 THEN ' ǆep' WHEN 3 THEN ' ﬁn'
           WHEN 4 THEN ' Щука' WHEN 5 THEN ' Αθήνα' WHEN 6 THEN ' Straße' WHEN 7 THEN ' Æon' ELSE ' Ω' END AS raw FROM {part}"""


@check(
    "accent_fold_scripts",
    """SELECT p_partkey, lower(p_name) || CASE p_size % 9 WHEN 0 THEN ' plzen' WHEN 1 THEN ' ijs' WHEN 2 THEN ' dzep' WHEN 3 THEN ' fin'
              WHEN 4 THEN ' shchuka' WHEN 5 THEN ' athena' WHEN 6 THEN ' strasse' WHEN 7 THEN ' aeon' ELSE ' o' END AS folded FROM part""",
)
def accent_fold_scripts(spark, sf_dir):
    return derive(spark, sf_dir, SCRIPTS).select("p_partkey", text.fold(F.col("raw")).alias("folded"))


ADMIN_NAMES = """
    SELECT p_partkey, CASE WHEN p_size < 8 THEN 'Praha ' || CAST(p_size AS STRING) WHEN p_size < 12 THEN 'Praha-východ' WHEN p_size < 15 THEN 'Praha - Západ'
           WHEN p_size < 25 THEN 'okres ' || p_name || '-jih' WHEN p_size < 35 THEN p_name || '-' || p_type || ' (obec)' ELSE 'Ulice  ' || p_brand || ' Kraj' END AS raw_name
    FROM {part}"""


@check(
    "admin_clean",
    f"""WITH f AS (SELECT p_partkey, lower(trim(strip_accents(raw_name))) AS t FROM ({duck(ADMIN_NAMES)})),
             s AS (SELECT *, CASE WHEN regexp_extract(t, '^[^-]*-\\s*(\\S+)', 1) IN ('jih', 'sever', 'centrum') THEN split_part(t, '-', 1) ELSE t END AS body FROM f)
        SELECT p_partkey, CASE WHEN starts_with(t, 'praha') AND (contains(t, 'praha-vychod') OR contains(t, 'praha-zapad')) THEN 'stredocesky kraj'
               WHEN starts_with(t, 'praha') THEN 'hl.m. praha'
               ELSE array_to_string(list_filter(string_split_regex(regexp_replace(body, '[^0-9a-z\\s]', ' ', 'g'), '\\s+'),
                    lambda w: w NOT IN ('', 'okres', 'kraj', 'ul', 'ulice', 'obec', 'cast')), ' ') END AS admin_name FROM s""",
)
def admin_clean(spark, sf_dir):
    return derive(spark, sf_dir, ADMIN_NAMES).select("p_partkey", text.admin_name(F.col("raw_name")).alias("admin_name"))


_HREFS = "regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)"
_LINKS = f"(SELECT page_id, url AS page_url, {_HREFS} AS hrefs FROM pages)"
_POS = "unnest(hrefs) AS u, generate_subscripts(hrefs, 1) - 1 AS pos"


def _pages(spark, sf_dir):
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"), hrefs.alias("hrefs"))


@check(
    "url_list",
    f"""SELECT page_id, CAST(pos AS INTEGER) AS pos, u AS url FROM (SELECT page_id, page_url, {_POS} FROM {_LINKS})
        WHERE page_url NOT LIKE '%/en/%' AND page_url NOT LIKE '%/fr/%' AND u <> ''
        UNION ALL SELECT page_id, 0, page_url FROM {_LINKS} WHERE page_url LIKE '%/en/%' OR page_url LIKE '%/fr/%'""",
)
def url_list(spark, sf_dir):
    """Bare URLs, single JSON values, and JSON arrays of objects, by page language."""
    objects = F.to_json(F.transform("hrefs", lambda h: F.struct(h.alias("url"))))
    page_url = F.col("page_url")
    shaped = (
        F.when(page_url.contains("/en/"), page_url)
        .when(page_url.contains("/fr/"), F.concat(F.lit('"'), page_url, F.lit('"')))
        .otherwise(objects)
    )
    rows = _pages(spark, sf_dir).select("page_id", urls.item_urls(urls.url_list(shaped)).alias("items"))
    return photos.positioned(rows, "page_id", F.col("items"))


@check(
    "nested_url_list",
    f"SELECT page_id, CAST(pos AS INTEGER) AS pos, u AS url FROM (SELECT page_id, {_POS} FROM {_LINKS}) WHERE u <> ''",
)
def nested_url_list(spark, sf_dir):
    """Arrays of arrays, as JSON text and natively: the first inner array counts."""
    nested = F.array(F.col("hrefs"), F.array(F.col("page_url")))
    from_text = urls.url_list(F.to_json(nested))
    native = urls.nested_first(nested)
    rows = _pages(spark, sf_dir).select("page_id", F.array_intersect(from_text, native).alias("both"), native.alias("items"))
    rows = rows.where(F.size("both") == F.size(F.array_distinct("items")))
    return photos.positioned(rows, "page_id", F.col("items")).where("url != ''")


_HELD_LINKS = "u LIKE '/t%'"


def _photo_inputs(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    feed = pages.select(F.col("page_id").cast("string").alias("site_id"), F.col("hrefs").alias("items"))
    active = pages.where("page_url LIKE 'https%'").select(F.col("page_id").alias("internal_id"), F.col("page_id").cast("string").alias("site_id"))
    held = pages.select(F.col("page_id").alias("internal_id"), F.explode("hrefs").alias("photo_url")).where("photo_url LIKE '/t%'")
    return feed, active, held


@check(
    "photo_links",
    f"""SELECT DISTINCT page_id AS internal_id, CAST(page_id AS VARCHAR) AS site_id, u AS photo_url
        FROM (SELECT page_id, page_url, {_POS} FROM {_LINKS}) WHERE page_url LIKE 'https%' AND u <> '' AND NOT {_HELD_LINKS}""",
)
def photo_links(spark, sf_dir):
    return photos.photo_links(*_photo_inputs(spark, sf_dir))


@check(
    "photo_links_per_listing",
    f"""WITH x AS (SELECT page_id, page_url, {_POS} FROM {_LINKS})
        SELECT DISTINCT page_id AS internal_id, CAST(page_id AS VARCHAR) AS site_id, u AS photo_url FROM x
        WHERE page_url LIKE 'https%' AND u <> '' AND page_id NOT IN (SELECT page_id FROM x WHERE {_HELD_LINKS})""",
)
def photo_links_per_listing(spark, sf_dir):
    return photos.photo_links(*_photo_inputs(spark, sf_dir), per="listing")


_SEEN = "SELECT DISTINCT u FROM (SELECT page_url, unnest(hrefs) AS u FROM {0}) WHERE page_url LIKE '%.org/%'".format(_LINKS)


def _source_links(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    seen = pages.where("page_url LIKE '%.org/%'").select(F.explode("hrefs").alias("url"))
    none = F.array().cast("array<string>")
    links = pages.select(
        F.col("page_id").alias("internal_id"),
        F.when(F.col("page_url").contains("/en/"), F.filter("hrefs", lambda h: h.startswith("/t"))).otherwise(none).alias("hyper_reality"),
        none.alias("sreality_image_urls"),
        F.when(F.col("page_url").contains("/de/"), none).otherwise(F.col("hrefs")).alias("bezrealitky_image_urls"),
        F.col("hrefs").alias("idnes"),
    )
    return links, seen


@check(
    "fresh_urls",
    f"""WITH s AS (SELECT page_id, r, src, unnest(urls) AS url, generate_subscripts(urls, 1) - 1 AS pos FROM (
              SELECT page_id, 0 AS r, 'hyper_reality' AS src, CASE WHEN contains(page_url, '/en/') THEN list_filter(hrefs, lambda h: starts_with(h, '/t')) ELSE [] END AS urls FROM {_LINKS}
              UNION ALL SELECT page_id, 2, 'bezrealitky_image_urls', CASE WHEN contains(page_url, '/de/') THEN [] ELSE hrefs END FROM {_LINKS}
              UNION ALL SELECT page_id, 3, 'idnes', hrefs FROM {_LINKS})),
             f AS (SELECT page_id, r, src, url, min(pos) AS pos FROM s WHERE url <> '' AND url NOT IN ({_SEEN}) GROUP BY ALL)
        SELECT page_id AS internal_id, src AS source, CAST(pos AS INTEGER) AS pos, url FROM f
        WHERE r = (SELECT min(r) FROM f g WHERE g.page_id = f.page_id)""",
)
def fresh_urls(spark, sf_dir):
    links, seen = _source_links(spark, sf_dir)
    return photos.fresh_urls(links, "internal_id", seen)


@check(
    "storage_key",
    f"""SELECT page_id AS internal_id, CAST(pos AS INTEGER) AS pos, '/images/' || page_id || '_pages_' || pos || '.jpg' AS storage_key
        FROM (SELECT page_id, {_POS} FROM {_LINKS})""",
)
def storage_key(spark, sf_dir):
    rows = photos.positioned(_pages(spark, sf_dir), "page_id", F.col("hrefs")).withColumn("source", F.lit("pages"))
    rows = rows.withColumnRenamed("page_id", "internal_id")
    return photos.with_storage_key(rows, "internal_id", "/images/").select("internal_id", "pos", "storage_key")


@check(
    "source_urls",
    f"""SELECT page_id AS internal_id, 'hyper_reality' AS source, 0 AS pos, page_url AS url FROM {_LINKS}
        UNION ALL SELECT page_id, 'idnes', CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER), u
        FROM (SELECT page_id, {_POS} FROM {_LINKS}) WHERE u <> ''""",
)
def source_urls(spark, sf_dir):
    """Stored text columns: a bare URL in one source, a JSON array in another, nothing in the rest."""
    links = _pages(spark, sf_dir).select(
        F.col("page_id").alias("internal_id"),
        F.col("page_url").alias("hyper_reality"),
        F.lit(None).cast("string").alias("sreality_image_urls"),
        F.lit("").alias("bezrealitky_image_urls"),
        F.to_json("hrefs").alias("idnes"),
    )
    return photos.source_urls(photos.parsed_sources(links, "internal_id"), "internal_id")
