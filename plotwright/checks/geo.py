"""Gazetteer, fuzzy matching and the geo cascade.

The gazetteer comes from the parts: name as city, brand as part, type and size as
street. Listings come from the order lines, their place written in one of seven ways.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cascade, fuzzy
from ..operators import gazetteer as gaz
from ..plans.geo import KEYS, normalize, normalize_cached
from ..session import materialized, work_path
from ..sources import sinks
from ..sources.tables import empty_like
from .registry import check, derive, duck, table

GAZETTEER = """
    SELECT DISTINCT p_name AS nazev_obce, p_brand AS nazev_casti_obce, lower(p_type) || ' street ' || CAST(p_size AS STRING) AS nazev_ulice,
           CASE WHEN p_name LIKE '%gear' OR p_name LIKE '%ring' THEN p_type ELSE upper(substr(p_name, instr(p_name, ' ') + 1)) END || ' kraj' AS kraj
    FROM {part}"""
EXCEPTIONS = "SELECT DISTINCT p_name AS nazev_obce FROM {part} WHERE p_name LIKE 'cold%'"
LISTINGS = """
    SELECT l_linenumber AS kind,
           CASE l_linenumber WHEN 1 THEN p_name WHEN 3 THEN CASE WHEN l_returnflag = 'R' THEN 'Okres ' || upper(p_name) ELSE replace(p_name, 'd ', ' ') END END AS district,
           CASE l_linenumber WHEN 2 THEN upper(p_name) WHEN 5 THEN 'somewhere' WHEN 6 THEN p_name || 'x' END AS city,
           CASE l_linenumber WHEN 2 THEN p_brand WHEN 5 THEN lower(p_brand) END AS city_part,
           CASE l_linenumber WHEN 1 THEN lower(p_type) || ' street ' || CAST(p_size AS STRING) WHEN 2 THEN p_type || ' Street ' || CAST(p_size AS STRING)
                WHEN 6 THEN lower(p_type) || ' streets ' || CAST(p_size AS STRING) END AS street,
           CASE l_linenumber WHEN 4 THEN 'Nice ' || replace(p_name, 'e', '') || ' for sale' WHEN 7 THEN NULL ELSE 'Offer' END AS name,
           p_name, CAST(NULL AS STRING) AS region
    FROM {lineitem} JOIN {part} ON p_partkey = l_partkey"""
_G = f"g AS ({duck(GAZETTEER)})"
_L = f"l AS ({duck(LISTINGS)})"


def _gazetteer(spark, sf_dir):
    return materialized(derive(spark, sf_dir, GAZETTEER), "gazetteer")


def _listings(spark, sf_dir):
    return derive(spark, sf_dir, LISTINGS)


def _lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence, one bit per character of b (at most 62)."""
    bit = f"CASE WHEN substr({b}, j + 1, 1) = ch THEN 1::BIGINT << j::INT ELSE 0 END"
    masks = f"list_transform(string_split({a}, ''), lambda ch: coalesce(list_sum(list_transform(range(length({b})), lambda j: {bit})), 0)::BIGINT)"
    full = f"((1::BIGINT << length({b})::INT) - 1)"
    step = f"(((v + (v & m)) | (v - (v & m))) & {full})"
    return f"(length({b}) - bit_count(list_reduce({masks}, lambda v, m: {step}, {full})))"


def _ratio(a: str, b: str) -> str:
    return f"(200.0 * {_lcs(a, b)} / (length({a}) + length({b})))"


def _admin(x: str) -> str:
    words = f"string_split_regex(regexp_replace(lower(trim({x})), '[^0-9a-z\\s]', ' ', 'g'), '\\s+')"
    return f"coalesce(array_to_string(list_filter({words}, lambda w: w NOT IN ('', 'okres', 'kraj', 'ul', 'ulice', 'obec', 'cast')), ' '), '')"


@check(
    "region_names",
    f"WITH {_G} SELECT {_admin('kraj')} AS name, max(kraj) AS kraj FROM g GROUP BY 1",
)
def region_names(spark, sf_dir):
    return gaz.region_names(_gazetteer(spark, sf_dir))


@check(
    "ambiguous_names",
    f"""WITH {_G} SELECT nazev_obce AS name FROM g GROUP BY 1 HAVING count(DISTINCT kraj) > 1 UNION SELECT * FROM ({duck(EXCEPTIONS)})""",
)
def ambiguous_names(spark, sf_dir):
    return gaz.ambiguous_names(_gazetteer(spark, sf_dir), derive(spark, sf_dir, EXCEPTIONS))


@check(
    "city_regions",
    f"""WITH {_G} SELECT nazev_obce AS name, min(kraj) AS kraj FROM g WHERE nazev_obce NOT IN ({duck(EXCEPTIONS)})
        GROUP BY 1 HAVING count(DISTINCT kraj) = 1""",
)
def city_regions(spark, sf_dir):
    return gaz.city_regions(_gazetteer(spark, sf_dir), derive(spark, sf_dir, EXCEPTIONS))


@check(
    "resolve_by_part",
    f"""WITH {_G} SELECT lower(nazev_obce) AS nazev_obce, lower(nazev_casti_obce) AS nazev_casti_obce, min(kraj) AS kraj FROM g
        GROUP BY 1, 2 HAVING count(DISTINCT kraj) = 1""",
)
def resolve_by_part(spark, sf_dir):
    return gaz.regions_by(_gazetteer(spark, sf_dir), ["nazev_obce", "nazev_casti_obce"])


@check(
    "resolve_by_street",
    f"""WITH {_G} SELECT lower(nazev_obce) AS nazev_obce, lower(nazev_ulice) AS nazev_ulice, min(kraj) AS kraj FROM g
        GROUP BY 1, 2 HAVING count(DISTINCT kraj) = 1""",
)
def resolve_by_street(spark, sf_dir):
    return gaz.regions_by(_gazetteer(spark, sf_dir), ["nazev_obce", "nazev_ulice"])


@check(
    "part_cities",
    f"WITH {_G} SELECT lower(nazev_casti_obce) AS name, max(nazev_obce) AS nazev_obce FROM g GROUP BY 1",
)
def part_cities(spark, sf_dir):
    return gaz.part_cities(_gazetteer(spark, sf_dir))


@check(
    "city_parts",
    f"""WITH {_G} SELECT lower(nazev_obce) AS city, lower(nazev_casti_obce) AS part, min(nazev_casti_obce) AS nazev_casti_obce
        FROM g GROUP BY 1, 2""",
)
def city_parts(spark, sf_dir):
    return gaz.city_parts(_gazetteer(spark, sf_dir))


MANGLED = """
    SELECT DISTINCT p_brand AS brand, CASE WHEN p_size < 10 THEN p_name WHEN p_size < 20 THEN replace(p_name, 'e', '') WHEN p_size < 30 THEN p_name || 's'
           WHEN p_size < 40 THEN replace(p_name, ' ', '-') ELSE replace(p_name, 'o', 'oo') END AS query FROM {part}"""
_M = f"m AS ({duck(MANGLED)})"


@check(
    "fuzzy_top1",
    f"""WITH {_M}, q AS (SELECT DISTINCT query FROM m), c AS (SELECT DISTINCT p_name AS choice FROM part),
             s AS (SELECT query, choice, {_ratio('query', 'choice')} AS score FROM q, c)
        SELECT query, choice, round(score, 6) AS score FROM s WHERE score >= 90
        QUALIFY row_number() OVER (PARTITION BY query ORDER BY score DESC, choice) = 1""",
)
def fuzzy_top1(spark, sf_dir):
    queries, choices = derive(spark, sf_dir, MANGLED), table(spark, sf_dir, "part").select("p_name")
    out = fuzzy.fuzzy_top1(queries, "query", choices, "p_name", 90)
    return out.select("query", "choice", F.round("score", 6).alias("score"))


@check(
    "blocked_top1",
    f"""WITH {_M}, c AS (SELECT DISTINCT p_brand, p_name AS choice FROM part),
             s AS (SELECT brand AS block, query, choice, {_ratio('query', 'choice')} AS score FROM m JOIN c ON p_brand = brand)
        SELECT block, query, choice, round(score, 6) AS score FROM s WHERE score > 89
        QUALIFY row_number() OVER (PARTITION BY block, query ORDER BY score DESC, choice) = 1""",
)
def blocked_top1(spark, sf_dir):
    queries, choices = derive(spark, sf_dir, MANGLED), table(spark, sf_dir, "part").select("p_brand", "p_name")
    out = fuzzy.fuzzy_top1(queries, "query", choices, "p_name", 89, True, "brand", "p_brand")
    return out.select("block", "query", "choice", F.round("score", 6).alias("score"))


TITLES = """
    SELECT DISTINCT lower(p_type) || ' ' || CASE WHEN p_size < 20 THEN replace(p_name, 'e', '') WHEN p_size < 35 THEN replace(p_name, 'd ', ' ')
           ELSE 'x' || p_name END || ' ' || CAST(p_size % 3 AS STRING) AS title FROM {part}"""


def _partial(titles: str, cities: str, where: str) -> str:
    """Best window score of each title against each city no longer than it; edges included."""
    windows = """
        SELECT title, name, substr(title, CAST(i AS INT), CAST(length(name) AS INT)) AS w
        FROM p, unnest(range(1, length(title) - length(name) + 2)) AS t(i)
        UNION ALL SELECT title, name, substr(title, 1, CAST(i AS INT)) FROM p, unnest(range(1, length(name))) AS t(i)
        UNION ALL SELECT title, name, right(title, CAST(i AS INT)) FROM p, unnest(range(1, length(name))) AS t(i)"""
    return f"""p AS (SELECT title, name FROM ({titles}), ({cities}) WHERE length(name) < length(title)),
             w AS (SELECT DISTINCT w, name FROM ({windows})), ws AS (SELECT w, name, {_ratio('w', 'name')} AS score FROM w),
             best AS (SELECT title, name, max(score) AS score FROM ({windows}) JOIN ws USING (w, name) GROUP BY 1, 2),
             top AS (SELECT * FROM best WHERE {where} QUALIFY row_number() OVER (PARTITION BY title ORDER BY score DESC, name) = 1)"""


@check(
    "partial_top1",
    f"""WITH {_partial(duck(TITLES), 'SELECT DISTINCT p_name AS name FROM part', 'score >= 85')}
        SELECT title AS query, name AS choice, round(score, 6) AS score FROM top""",
)
def partial_top1(spark, sf_dir):
    out = fuzzy.partial_top1(derive(spark, sf_dir, TITLES), "title", table(spark, sf_dir, "part"), "p_name", 85)
    return out.select("query", "choice", F.round("score", 6).alias("score"))


# The region of an address value: cleaned region name (fuzzy), unambiguous cleaned city, unique row by name.
_VALUES = f"""
    v AS (SELECT DISTINCT value, {_admin('value')} AS c FROM (SELECT unnest([district, city]) AS value FROM l) WHERE value IS NOT NULL),
    rn AS (SELECT {_admin('kraj')} AS name, max(kraj) AS kraj FROM g GROUP BY 1),
    vf AS (SELECT value, kraj FROM (SELECT value, name, kraj, {_ratio('c', 'name')} AS score FROM v, rn WHERE c <> '') WHERE score >= 90
           QUALIFY row_number() OVER (PARTITION BY value ORDER BY score DESC, name) = 1),
    vc AS (SELECT {_admin('nazev_obce')} AS name, min(kraj) AS kraj FROM g GROUP BY 1
           HAVING count(DISTINCT kraj) = 1 AND name NOT IN ({duck(EXCEPTIONS)})),
    vn AS (SELECT lower(nazev_obce) AS n, min(kraj) AS kraj FROM g GROUP BY 1 HAVING count(DISTINCT kraj) = 1),
    vp AS (SELECT lower(nazev_obce) AS n, lower(nazev_casti_obce) AS p, min(kraj) AS kraj FROM g GROUP BY 1, 2 HAVING count(DISTINCT kraj) = 1),
    vs AS (SELECT lower(nazev_obce) AS n, lower(nazev_ulice) AS s, min(kraj) AS kraj FROM g GROUP BY 1, 2 HAVING count(DISTINCT kraj) = 1),
    a AS (SELECT DISTINCT district, city, city_part, street FROM l)"""


def _region_of(column: str) -> str:
    return f"""SELECT a.district, a.city, a.city_part, a.street, coalesce(vf.kraj, vc.kraj, vn.kraj, vp.kraj, vs.kraj) AS kraj,
        CASE WHEN vf.kraj IS NOT NULL THEN '{column}_fuzzy' WHEN vc.kraj IS NOT NULL THEN '{column}_name' WHEN vn.kraj IS NOT NULL THEN '{column}_row'
             WHEN vp.kraj IS NOT NULL THEN '{column}_part' WHEN vs.kraj IS NOT NULL THEN '{column}_street' END AS step
        FROM a LEFT JOIN v ON v.value = a.{column} LEFT JOIN vf ON vf.value = a.{column} LEFT JOIN vc ON vc.name = v.c
        LEFT JOIN vn ON vn.n = lower(a.{column}) LEFT JOIN vp ON vp.n = lower(a.{column}) AND vp.p = lower(a.city_part)
        LEFT JOIN vs ON vs.n = lower(a.{column}) AND vs.s = lower(a.street)"""


_SAME = " AND ".join(f"x.{c} IS NOT DISTINCT FROM y.{c}" for c in ("district", "city", "city_part", "street"))
_TITLES_OPEN = "SELECT DISTINCT lower(name) AS title FROM l WHERE district IS NULL AND name IS NOT NULL"
_REGIONS = f"""{_VALUES}, ad AS ({_region_of('district')}), ac AS ({_region_of('city')}),
    ar AS (SELECT x.district, x.city, x.city_part, x.street, coalesce(x.kraj, y.kraj) AS kraj, coalesce(x.step, y.step) AS step FROM ad x JOIN ac y ON {_SAME}),
    {_partial(_TITLES_OPEN, 'SELECT DISTINCT lower(nazev_obce) AS name FROM g', 'score >= 85')},
    fr AS (SELECT lower(nazev_obce) AS name, min(kraj) AS kraj FROM g GROUP BY 1),
    tr AS (SELECT title, kraj FROM top JOIN fr USING (name)),
    r AS (SELECT x.kind, x.district, x.city, x.city_part, x.street, x.name, x.p_name,
                 CASE WHEN x.district IS NULL THEN tr.kraj END AS region_from_name,
                 coalesce(y.kraj, CASE WHEN x.district IS NULL THEN tr.kraj END) AS region,
                 CASE WHEN y.kraj IS NOT NULL THEN y.step WHEN x.district IS NULL AND tr.kraj IS NOT NULL THEN 'title' END AS region_step
          FROM l x JOIN ar y ON {_SAME} LEFT JOIN tr ON tr.title = lower(x.name))"""
_KEYS = ["kind", "district", "city", "city_part", "street", "name"]


def _counted(df, *values):
    return df.groupBy(*_KEYS, *values).agg(F.count("*").alias("n"))


def _regions(spark, sf_dir):
    return cascade.assign_regions(_listings(spark, sf_dir), _gazetteer(spark, sf_dir), derive(spark, sf_dir, EXCEPTIONS))


@check(
    "region_cascade",
    f"""WITH {_G}, {_L}, {_REGIONS} SELECT {', '.join(_KEYS)}, region, region_step, count(*) AS n FROM r GROUP BY ALL""",
)
def region_cascade(spark, sf_dir):
    return _counted(_regions(spark, sf_dir), "region", "region_step")


@check(
    "quarantine",
    f"""WITH {_G}, {_L}, {_REGIONS} SELECT {', '.join(_KEYS)}, count(*) AS n,
               CASE WHEN region IS NULL AND district IS NULL AND city IS NULL AND region_from_name IS NULL THEN 'garbage' ELSE 'kept' END AS place
        FROM r GROUP BY ALL""",
)
def quarantine(spark, sf_dir):
    kept, garbage = cascade.quarantine(_regions(spark, sf_dir))
    both = kept.withColumn("place", F.lit("kept")).unionByName(garbage.withColumn("place", F.lit("garbage")))
    return _counted(both, "place")


@check(
    "committed_quarantine",
    f"""WITH {_G}, {_L}, {_REGIONS} SELECT {', '.join(_KEYS)}, count(*) AS n,
               CASE WHEN region IS NULL AND district IS NULL AND city IS NULL AND region_from_name IS NULL THEN 'garbage' ELSE 'kept' END AS place
        FROM r GROUP BY ALL""",
)
def committed_quarantine(spark, sf_dir):
    """Listings and quarantine change as one version; a move that died between the two writes is not seen."""
    path = work_path(spark, "listings")
    regions = _regions(spark, sf_dir)
    sinks.publish_set({"kept": regions, "garbage": empty_like(regions)}, path, 1)
    kept, garbage = cascade.quarantine(sinks.read_set(spark, path, "kept"))
    sinks.stage({"kept": kept}, path, 2)
    sinks.publish_set({"kept": kept, "garbage": garbage}, path, 2)
    both = [sinks.read_set(spark, path, p).withColumn("place", F.lit(p)) for p in ("kept", "garbage")]
    return _counted(both[0].unionByName(both[1]), "place")


@check(
    "region_steps",
    f"""WITH {_G}, {_L}, {_REGIONS} SELECT coalesce(region_step, 'unmatched') AS match_step, count(*) AS n FROM r GROUP BY 1""",
)
def region_steps(spark, sf_dir):
    return cascade.step_statistics(_regions(spark, sf_dir), "region_step")


_TITLE_REGION = f"""{_partial('SELECT DISTINCT lower(name) AS title FROM l WHERE name IS NOT NULL', 'SELECT DISTINCT lower(nazev_obce) AS name FROM g', 'score >= 85')}"""


@check(
    "title_regions",
    f"""WITH {_G}, {_L}, {_TITLE_REGION} SELECT DISTINCT l.name AS title, min(kraj) AS region
        FROM l JOIN top ON top.title = lower(l.name) JOIN g ON lower(nazev_obce) = top.name GROUP BY 1""",
)
def title_regions(spark, sf_dir):
    titles = _listings(spark, sf_dir).where("name IS NOT NULL").select(F.col("name").alias("title")).distinct()
    found = cascade.title_regions(titles, "title", _gazetteer(spark, sf_dir))
    return found.where("kraj IS NOT NULL").withColumnRenamed("kraj", "region")


# City steps: exact district, city, part; fuzzy the same; the title last.
_CITIES = f"""
    cn AS (SELECT lower(nazev_obce) AS name, max(nazev_obce) AS nazev_obce FROM g GROUP BY 1),
    pc AS (SELECT lower(nazev_casti_obce) AS name, max(nazev_obce) AS nazev_obce FROM g GROUP BY 1),
    cv AS (SELECT DISTINCT lower(value) AS q FROM (SELECT unnest([district, city]) AS value FROM l) WHERE value IS NOT NULL),
    pv AS (SELECT DISTINCT lower(city_part) AS q FROM l WHERE city_part IS NOT NULL),
    cf AS (SELECT q, nazev_obce FROM (SELECT q, name, nazev_obce, {_ratio('q', 'name')} AS score FROM cv, cn) WHERE score > 90
           QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, name) = 1),
    pf AS (SELECT q, nazev_obce FROM (SELECT q, name, nazev_obce, {_ratio('q', 'name')} AS score FROM pv, pc) WHERE score > 90
           QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, name) = 1),
    {_partial('SELECT DISTINCT lower(name) AS title FROM l WHERE name IS NOT NULL', 'SELECT name FROM cn', 'score > 85')},
    c AS (SELECT l.*, e1.nazev_obce AS m1, e2.nazev_obce AS m2, e3.nazev_obce AS m3, f1.nazev_obce AS m4, f2.nazev_obce AS m5, f3.nazev_obce AS m6, t.nazev_obce AS m7
          FROM l LEFT JOIN cn e1 ON e1.name = lower(district) LEFT JOIN cn e2 ON e2.name = lower(city) LEFT JOIN pc e3 ON e3.name = lower(city_part)
          LEFT JOIN cf f1 ON f1.q = lower(district) LEFT JOIN cf f2 ON f2.q = lower(city) LEFT JOIN pf f3 ON f3.q = lower(city_part)
          LEFT JOIN top ON top.title = lower(l.name) LEFT JOIN cn t ON t.name = top.name)"""
_CITY_STEP = """CASE WHEN m1 IS NOT NULL THEN 'district' WHEN m2 IS NOT NULL THEN 'city' WHEN m3 IS NOT NULL THEN 'city_part'
    WHEN m4 IS NOT NULL THEN 'district_fuzzy' WHEN m5 IS NOT NULL THEN 'city_fuzzy' WHEN m6 IS NOT NULL THEN 'city_part_fuzzy'
    WHEN m7 IS NOT NULL THEN 'name' END"""


def _cities(spark, sf_dir):
    listings = _listings(spark, sf_dir).withColumns({"region": F.lit("r"), "norm_city": F.lit(None).cast("string")})
    return cascade.assign_cities(listings, _gazetteer(spark, sf_dir))


@check(
    "city_cascade",
    f"""WITH {_G}, {_L}, {_CITIES} SELECT {', '.join(_KEYS)}, coalesce(m1, m2, m3, m4, m5, m6, m7) AS norm_city, {_CITY_STEP} AS city_step,
               count(*) AS n FROM c GROUP BY ALL""",
)
def city_cascade(spark, sf_dir):
    return _counted(_cities(spark, sf_dir), "norm_city", "city_step")


@check(
    "city_steps",
    f"""WITH {_G}, {_L}, {_CITIES} SELECT coalesce({_CITY_STEP}, 'unmatched') AS match_step, count(*) AS n FROM c GROUP BY 1""",
)
def city_steps(spark, sf_dir):
    return cascade.step_statistics(_cities(spark, sf_dir), "city_step")


@check(
    "city_part_match",
    f"""WITH {_G}, {_L}, t AS (SELECT lower(nazev_obce) AS c, lower(nazev_casti_obce) AS p, min(nazev_casti_obce) AS part FROM g GROUP BY 1, 2)
        SELECT {', '.join(_KEYS)}, t.part AS norm_city_part, count(*) AS n FROM l LEFT JOIN t ON t.c = lower(city) AND t.p = lower(city_part) GROUP BY ALL""",
)
def city_part_match(spark, sf_dir):
    listings = _listings(spark, sf_dir).withColumn("norm_city_part", F.lit(None).cast("string"))
    return _counted(cascade.assign_city_parts(listings, _gazetteer(spark, sf_dir)), "norm_city_part")


_STREETS = f"""
    t AS (SELECT lower(nazev_obce) AS c, lower(nazev_ulice) AS s, min(nazev_ulice) AS u FROM g GROUP BY 1, 2),
    x AS (SELECT *, lower(p_name) AS nc FROM l),
    sv AS (SELECT DISTINCT nc, v FROM (SELECT nc, unnest([lower(street), lower(city_part), lower(city), lower(district)]) AS v FROM x) WHERE v IS NOT NULL),
    sc AS (SELECT nc, v, u, s, {_ratio('v', 's')} AS score FROM sv JOIN t ON t.c = nc),
    sb AS (SELECT nc, v, u, score FROM sc WHERE score > 89 QUALIFY row_number() OVER (PARTITION BY nc, v ORDER BY score DESC, s) = 1),
    st AS (SELECT x.*, coalesce(CASE WHEN b1.score = 100 THEN b1.u END, CASE WHEN b2.score = 100 THEN b2.u END, CASE WHEN b3.score = 100 THEN b3.u END,
                  CASE WHEN b4.score = 100 THEN b4.u END) AS strict,
                  CASE greatest(b1.score, b2.score, b3.score, b4.score) WHEN b1.score THEN b1.u WHEN b2.score THEN b2.u WHEN b3.score THEN b3.u WHEN b4.score THEN b4.u END AS fuzzy
           FROM x LEFT JOIN sb b1 ON b1.nc = x.nc AND b1.v = lower(street) LEFT JOIN sb b2 ON b2.nc = x.nc AND b2.v = lower(city_part)
           LEFT JOIN sb b3 ON b3.nc = x.nc AND b3.v = lower(city) LEFT JOIN sb b4 ON b4.nc = x.nc AND b4.v = lower(district))"""


def _streets(spark, sf_dir):
    listings = _listings(spark, sf_dir).withColumnRenamed("p_name", "norm_city").withColumn("norm_ulice", F.lit(None).cast("string"))
    return cascade.assign_streets(listings, _gazetteer(spark, sf_dir))


@check(
    "street_match",
    f"""WITH {_G}, {_L}, {_STREETS} SELECT {', '.join(_KEYS)}, p_name AS norm_city, coalesce(strict, fuzzy) AS norm_ulice,
               CASE WHEN strict IS NOT NULL THEN 'strict' WHEN fuzzy IS NOT NULL THEN 'fuzzy' END AS street_step, count(*) AS n FROM st GROUP BY ALL""",
)
def street_match(spark, sf_dir):
    return _counted(_streets(spark, sf_dir), "norm_city", "norm_ulice", "street_step")


@check(
    "top_streets",
    f"""WITH {_G}, {_L}, {_STREETS} SELECT coalesce(strict, fuzzy) AS norm_ulice, count(*) AS n FROM st GROUP BY 1
        ORDER BY n DESC, norm_ulice NULLS FIRST LIMIT 20""",
)
def top_streets(spark, sf_dir):
    from ..operators.select import top_values

    return top_values(_streets(spark, sf_dir), "norm_ulice")


# Each step on what the one before left: cities for kept listings with a region, streets of those cities.
_CHAIN = f"""WITH {_G}, l0 AS ({duck(LISTINGS)}),
    rk AS (WITH l AS (SELECT * FROM l0), {_REGIONS} SELECT * EXCLUDE (p_name),
               region IS NULL AND district IS NULL AND city IS NULL AND region_from_name IS NULL AS lost FROM r),
    ck AS (WITH l AS (SELECT * FROM rk WHERE NOT lost AND region IS NOT NULL), {_CITIES}
           SELECT kind, district, city, city_part, street, name, region_step, coalesce(m1, m2, m3, m4, m5, m6, m7) AS p_name, {_CITY_STEP} AS city_step FROM c
           UNION ALL SELECT kind, district, city, city_part, street, name, region_step, NULL, NULL FROM rk WHERE NOT lost AND region IS NULL),
    sk AS (WITH l AS (SELECT * FROM ck), {_STREETS} SELECT kind, region_step, city_step,
               CASE WHEN strict IS NOT NULL THEN 'strict' WHEN fuzzy IS NOT NULL THEN 'fuzzy' END AS street_step FROM st)"""


_CHAIN_COUNTS = f"""{_CHAIN} SELECT kind, region_step, city_step, street_step, count(*) AS n FROM sk GROUP BY ALL
        UNION ALL SELECT kind, NULL, NULL, NULL, count(*) FROM rk WHERE lost GROUP BY kind"""


def _unplaced(spark, sf_dir):
    """Listings before the chain."""
    nulls = {c: F.lit(None).cast("string") for c in ("norm_city", "norm_city_part", "norm_ulice")}
    return _listings(spark, sf_dir).drop("p_name").withColumns(nulls)


def _outcomes(done, garbage):
    steps = ["region_step", "city_step", "street_step"]
    kept = done.groupBy("kind", *steps).agg(F.count("*").alias("n"))
    blank = [F.lit(None).cast("string").alias(s) for s in steps]
    return kept.unionByName(garbage.groupBy("kind").agg(F.count("*").alias("n")).select("kind", *blank, "n"))


@check("geo_chain", _CHAIN_COUNTS)
def geo_chain(spark, sf_dir):
    """All four steps and the quarantine, counted per outcome."""
    exceptions = derive(spark, sf_dir, EXCEPTIONS)
    return _outcomes(*normalize(_unplaced(spark, sf_dir), _gazetteer(spark, sf_dir), exceptions))


@check("geo_second_day", _CHAIN_COUNTS)
def geo_second_day(spark, sf_dir):
    """The same for all listings after a day that knew all but some hundredth of the places: only these are asked."""
    listings, path = _unplaced(spark, sf_dir), work_path(spark, "place-cache")
    gazetteer, exceptions = _gazetteer(spark, sf_dir), derive(spark, sf_dir, EXCEPTIONS)
    old = F.pmod(F.xxhash64(*KEYS), F.lit(100)) > 0
    normalize_cached(listings.where(old), gazetteer, path, exceptions)
    second = normalize_cached(listings, gazetteer, path, exceptions)
    return _outcomes(second.done, second.garbage)
