"""Bit signatures and near-duplicate joins over the embeddings, read as 8 x 8 gray grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bits, grids
from ..operators import duplicates as dups
from ..operators import band_index, neighbors
from ..session import materialized, work_path
from .registry import check, table

SIDE = 8
CODES = (("ahash", 8, 64), ("dhash", 8, 64), ("phash", 4, 16), ("whash", 4, 16))


def _grids(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("grid"))


_E = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS g FROM embeddings)"
_AHASH = "list_transform(g, lambda v: CASE WHEN v > list_avg(g) THEN '1' ELSE '0' END)"
_BLOCKS = (
    "list_transform(range(16), lambda b: (g[(b // 4) * 16 + (b % 4) * 2 + 1] + g[(b // 4) * 16 + (b % 4) * 2 + 2]"
    " + g[(b // 4) * 16 + (b % 4) * 2 + 9] + g[(b // 4) * 16 + (b % 4) * 2 + 10]) / 4)"
)
# Eight cells as nine stretches: stretch k takes k ninths of the cell before and 9 - k - 1 of the cell at k.
_CELL = "(coalesce(g[(p // 8) * 8 + {k}], 0) * {k} + coalesce(CASE WHEN {k} < 8 THEN g[(p // 8) * 8 + {k} + 1] END, 0) * (8 - {k}))"
_DIFF = (
    "list_transform(range(64), lambda p: CASE WHEN "
    + _CELL.format(k="(p % 8 + 1)") + " > " + _CELL.format(k="(p % 8)") + " THEN '1' ELSE '0' END)"
)
_TEXT = {
    "ahash": f"SELECT vec_id, array_to_string({_AHASH}, '') AS bits FROM e",
    "dhash": f"SELECT vec_id, array_to_string({_DIFF}, '') AS bits FROM e",
    "whash": f"""SELECT vec_id, array_to_string(list_transform(b, lambda v: CASE WHEN v > list_median(b) THEN '1' ELSE '0' END), '') AS bits
                 FROM (SELECT vec_id, {_BLOCKS} AS b FROM e)""",
    "phash": """SELECT vec_id, string_agg(CASE WHEN c > m THEN '1' ELSE '0' END, '' ORDER BY u, v) AS bits FROM (
                 SELECT vec_id, u, v, c, median(c) OVER (PARTITION BY vec_id) AS m FROM (
                   SELECT vec_id, u, v, sum(4 * x * cos(pi() * u * (2 * (p // 8) + 1) / 16) * cos(pi() * v * (2 * (p % 8) + 1) / 16)) AS c
                   FROM (SELECT vec_id, unnest(g) AS x, generate_subscripts(g, 1) - 1 AS p FROM e), range(4) AS us(u), range(4) AS vs(v)
                   GROUP BY vec_id, u, v)) GROUP BY vec_id""",
}


def _signatures(spark, sf_dir, kind="ahash"):
    """vec_id, label, bits and hex signature of a kind."""
    _, side, n_bits = next(c for c in CODES if c[0] == kind)
    text = grids.grid_signature(F.col("grid"), SIDE, side, kind)
    rows = _grids(spark, sf_dir).select("vec_id", "label", text.alias("bits"))
    return rows.withColumn("signature", bits.bits_to_hex(F.col("bits"), n_bits))


def _grid_hash(kind):
    def query(spark, sf_dir):
        return _signatures(spark, sf_dir, kind).select("vec_id", "bits")

    return query


for _kind, _, _n in CODES:
    check(f"grid_{_kind}", f"WITH {_E} {_TEXT[_kind]}")(_grid_hash(_kind))

# Signature as number; the order of the bits does not matter for distances.
_NUM = "list_sum(list_transform(range(length(bits)), lambda i: CASE WHEN substr(bits, CAST(i AS INT) + 1, 1) = '1' THEN 1::UBIGINT << i::INT ELSE 0::UBIGINT END))::UBIGINT"
_HEX = "lower(array_to_string(list_transform(range(length(bits) // 4), lambda d: substr('0123456789abcdef', CAST(1 + 8 * CAST(substr(bits, CAST(4 * d + 1 AS INT), 1) AS INT) + 4 * CAST(substr(bits, CAST(4 * d + 2 AS INT), 1) AS INT) + 2 * CAST(substr(bits, CAST(4 * d + 3 AS INT), 1) AS INT) + CAST(substr(bits, CAST(4 * d + 4 AS INT), 1) AS INT) AS INT), 1)), ''))"


def _sig_cte(kind):
    return f"WITH {_E}, s AS (SELECT vec_id, label, vec_id // 2 AS listing, bits, {_HEX} AS sig, {_NUM} AS num FROM ({_TEXT[kind]}) JOIN e USING (vec_id))"


@check(
    "hash_codes",
    f"""{_sig_cte('ahash')} SELECT vec_id, sig AS signature, bits AS from_bytes, bits AS from_hex,
           CAST(list_sum(list_transform(range(8), lambda i: CASE WHEN substr(bits, CAST(i AS INT) + 1, 1) = '1' THEN 1 << i::INT ELSE 0 END)) AS INTEGER) AS bucket FROM s""",
)
def hash_codes(spark, sf_dir):
    """Hex to bits, through packed bytes and back, and the bucket."""
    rows = _signatures(spark, sf_dir)
    packed = bits.to_bytes(F.col("signature"), 64)
    return rows.select(
        "vec_id",
        "signature",
        bits.from_bytes(packed, 64).alias("from_bytes"),
        bits.bits(F.col("signature"), 64).alias("from_hex"),
        bits.bucket(F.col("bits")).alias("bucket"),
    )


@check(
    "neighbor_buckets",
    f"""{_sig_cte('ahash')}, b AS (SELECT vec_id, CAST(list_sum(list_transform(range(8), lambda i: CASE WHEN substr(bits, CAST(i AS INT) + 1, 1) = '1' THEN 1 << i::INT ELSE 0 END)) AS INTEGER) AS bucket FROM s)
        SELECT vec_id, CAST(unnest(list_concat([bucket], list_transform(range(8), lambda i: xor(bucket, 1 << i::INT)))) AS INTEGER) AS neighbor FROM b""",
)
def neighbor_buckets(spark, sf_dir):
    own = bits.bucket(F.col("bits"))
    return _signatures(spark, sf_dir).select("vec_id", F.explode(bits.neighbor_buckets(own)).alias("neighbor"))


@check(
    "hash_similarity",
    f"""{_sig_cte('ahash')} SELECT a.vec_id, round(1 - bit_count(xor(a.num, b.num)) / 64.0, 9) AS similarity FROM s a JOIN s b ON b.vec_id = a.vec_id + 1""",
)
def hash_similarity(spark, sf_dir):
    rows = _signatures(spark, sf_dir).select("vec_id", bits.words(F.col("signature"), 64).alias("words"))
    after = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("words").alias("other"))
    score = bits.similarity(F.col("words"), F.col("other"), 64)
    return rows.join(after, "vec_id").select("vec_id", F.round(score, 9).alias("similarity"))


def _pairs_sql(kind, n_bits, similarity, more="true"):
    """Every pair tested."""
    distance = "bit_count(xor(a.num, b.num))"
    return f"""{_sig_cte(kind)}, d AS (SELECT DISTINCT sig, bits, num FROM s),
        p AS (SELECT a.sig AS l, b.sig AS r, CAST({distance} AS INTEGER) AS distance, 1 - {distance} / {n_bits}.0 AS similarity
              FROM d a JOIN d b ON a.sig < b.sig WHERE 1 - {distance} / {n_bits}.0 >= {similarity} AND {more})"""


_PAIR_COLUMNS = "SELECT l AS left_sig, r AS right_sig, distance, round(similarity, 9) AS similarity FROM p"


def _pairs(spark, sf_dir, kind, n_bits, similarity):
    signatures = _signatures(spark, sf_dir, kind).select("signature").distinct()
    return neighbors.near_pairs(signatures, n_bits, similarity)


def _named(pairs):
    return pairs.select(
        F.col("left").alias("left_sig"), F.col("right").alias("right_sig"), "distance", F.round("similarity", 9).alias("similarity")
    )


@check("near_pairs_64", f"{_pairs_sql('ahash', 64, 0.7)} {_PAIR_COLUMNS}")
def near_pairs_64(spark, sf_dir):
    return _named(_pairs(spark, sf_dir, "ahash", 64, 0.7))


@check("near_pairs_16", f"{_pairs_sql('whash', 16, 0.85)} {_PAIR_COLUMNS}")
def near_pairs_16(spark, sf_dir):
    return _named(_pairs(spark, sf_dir, "whash", 16, 0.85))


_BUCKET = "list_sum(list_transform(range(8), lambda i: CASE WHEN substr({0}.bits, CAST(i AS INT) + 1, 1) = '1' THEN 1 << i::INT ELSE 0 END))::INT"


@check(
    "lsh_pairs",
    f"""{_pairs_sql('whash', 16, 0.85, f"bit_count(xor({_BUCKET.format('a')}, {_BUCKET.format('b')})) <= 1")}
        SELECT l AS left_sig, r AS right_sig, distance FROM p UNION ALL SELECT r, l, distance FROM p""",
)
def lsh_pairs(spark, sf_dir):
    signatures = _signatures(spark, sf_dir, "whash").select("signature").distinct()
    return _named(neighbors.lsh_pairs(signatures, 16, 0.85)).select("left_sig", "right_sig", "distance")


@check(
    "knn_pairs",
    f"""{_sig_cte('whash')}, c AS (SELECT DISTINCT listing, num FROM s),
        p AS (SELECT a.listing AS key, b.listing AS neighbor, min(bit_count(xor(a.num, b.num)))::INT AS distance FROM c a JOIN c b ON a.listing <> b.listing
              WHERE bit_count(xor(a.num, b.num)) <= 2 GROUP BY 1, 2)
        SELECT key, neighbor, distance, CAST(row_number() OVER (PARTITION BY key ORDER BY distance, neighbor) AS INTEGER) AS rank FROM p
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY distance, neighbor) <= 5""",
)
def knn_pairs(spark, sf_dir):
    images = _signatures(spark, sf_dir, "whash").withColumn("listing", F.expr("vec_id div 2"))
    return neighbors.nearest(images, "listing", "signature", 16, 0.85, 5)


@check(
    "copy_groups",
    f"""{_sig_cte('phash')} SELECT sig AS signature, min(listing) AS first_key, count(DISTINCT listing) AS n_keys FROM s GROUP BY 1""",
)
def copy_groups(spark, sf_dir):
    return neighbors.signature_groups(_images(spark, sf_dir, "phash"), "internal_id", "signature")


def _images(spark, sf_dir, kind="whash"):
    """Photos of listings: two per listing, the source by label."""
    images = _signatures(spark, sf_dir, kind).select(
        F.expr("vec_id div 2").alias("internal_id"),
        F.concat(F.lit("source"), F.col("label").cast("string")).alias("source"),
        (F.col("vec_id") % 2).cast("int").alias("pos"),
        "signature",
    )
    return materialized(images, "images")


@check(
    "dup_adjacency",
    f"""{_pairs_sql('whash', 16, 0.85)}, b AS (SELECT l, r FROM p UNION SELECT r, l FROM p)
        SELECT l AS id, CAST(0 AS BIGINT) AS page, count(*) AS n_neighbors, string_agg(r, ',' ORDER BY r) AS neighbors FROM b GROUP BY l""",
)
def dup_adjacency(spark, sf_dir):
    lists = dups.adjacency(_pairs(spark, sf_dir, "whash", 16, 0.85))
    return lists.withColumn("neighbors", F.array_join("neighbors", ","))


@check(
    "dup_counts",
    f"""{_pairs_sql('whash', 16, 0.85)}, g AS (SELECT sig, min(listing) AS f, count(DISTINCT listing) AS n FROM s GROUP BY 1),
        b AS (SELECT l, r FROM p UNION SELECT r, l FROM p), m AS (SELECT l, sum(n) AS near FROM b JOIN g ON g.sig = r GROUP BY l)
        SELECT sig AS signature, f AS first_key, n AS n_keys, n - 1 AS n_copies, CAST(coalesce(near, 0) AS BIGINT) AS n_near FROM g LEFT JOIN m ON m.l = sig""",
)
def dup_counts(spark, sf_dir):
    return dups.duplicate_counts(_images(spark, sf_dir), "internal_id", "signature", _pairs(spark, sf_dir, "whash", 16, 0.85))


@check(
    "dup_stats",
    f"{_pairs_sql('whash', 16, 0.85)} SELECT count(*) AS total, round(avg(similarity), 9) AS avg_similarity FROM p",
)
def dup_stats(spark, sf_dir):
    stats = dups.duplicate_statistics(_pairs(spark, sf_dir, "whash", 16, 0.85))
    return stats.withColumn("avg_similarity", F.round("avg_similarity", 9))


@check(
    "hash_map",
    f"""{_sig_cte('whash')} SELECT listing AS internal_id, 'source' || label AS source, CAST(0 AS BIGINT) AS page,
           string_agg((vec_id % 2) || ':' || sig, ',' ORDER BY vec_id) AS hashes FROM s GROUP BY 1, 2""",
)
def hash_map(spark, sf_dir):
    maps = dups.hash_maps(_images(spark, sf_dir), "internal_id")
    entries = F.transform(F.map_entries("hashes"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"]))
    return maps.withColumn("hashes", F.array_join(F.array_sort(entries), ","))


_LISTING_DUPS = f"""{_pairs_sql('whash', 16, 0.85)}, c AS (SELECT DISTINCT listing, num FROM s),
    dup AS (SELECT DISTINCT a.listing AS key, b.listing AS duplicate FROM c a JOIN c b ON a.listing <> b.listing WHERE bit_count(xor(a.num, b.num)) <= 2)"""


def _listing_duplicates(spark, sf_dir):
    """Duplicates of every listing, however many carry its signatures or are near to them."""
    images, pairs = _images(spark, sf_dir), _pairs(spark, sf_dir, "whash", 16, 0.85)
    wanted = images.select(F.col("internal_id").alias("key"))
    return dups.duplicates_of(wanted, images, "internal_id", "signature", materialized(pairs, "near-pairs"))


@check("duplicates_of", f"{_LISTING_DUPS} SELECT key, duplicate FROM dup")
def duplicates_of(spark, sf_dir):
    return _listing_duplicates(spark, sf_dir)


@check(
    "dup_report",
    f"""{_LISTING_DUPS}, x AS (SELECT * FROM dup),
        k AS (SELECT key, count(*) AS n_duplicates FROM x GROUP BY key ORDER BY key LIMIT 10),
        h AS (SELECT page_id, url FROM pages WHERE url LIKE 'https%')
        SELECT key, duplicate, n_duplicates, a.url AS own_url, b.url AS duplicate_url, b.url IS NOT NULL AS found
        FROM x JOIN k USING (key) JOIN h a ON a.page_id = key LEFT JOIN h b ON b.page_id = duplicate""",
)
def dup_report(spark, sf_dir):
    """The report's first 10 entries; only pages with https stand for listings still held."""
    entries = table(spark, sf_dir, "pages").where("url LIKE 'https%'").select(F.col("page_id").alias("internal_id"), "url")
    return dups.duplicate_report(entries, _listing_duplicates(spark, sf_dir), "internal_id", ["url"], 10)


_HELD_DUPS = f"""{_LISTING_DUPS}, h AS (SELECT page_id, url FROM pages WHERE url LIKE 'https%'), x AS (SELECT * FROM dup WHERE key IN (SELECT page_id FROM h))"""


def _held(spark, sf_dir):
    """Pages with https stand for listings still held."""
    return table(spark, sf_dir, "pages").where("url LIKE 'https%'").select(F.col("page_id").alias("internal_id"), "url")


def _held_duplicates(spark, sf_dir):
    """Duplicates of every held listing, however many carry its signatures or are near to them."""
    images, pairs = _images(spark, sf_dir), _pairs(spark, sf_dir, "whash", 16, 0.85)
    wanted = _held(spark, sf_dir).select(F.col("internal_id").alias("key"))
    return dups.duplicates_of(wanted, images, "internal_id", "signature", materialized(pairs, "near-pairs"))


@check("duplicates_of_held", f"{_HELD_DUPS} SELECT key, duplicate FROM x")
def duplicates_of_held(spark, sf_dir):
    return _held_duplicates(spark, sf_dir)


@check(
    "dup_report_held",
    f"""{_HELD_DUPS}, k AS (SELECT key, count(*) AS n_duplicates FROM x GROUP BY key)
        SELECT key, duplicate, n_duplicates, a.url AS own_url, b.url AS duplicate_url, b.url IS NOT NULL AS found
        FROM x JOIN k USING (key) JOIN h a ON a.page_id = key LEFT JOIN h b ON b.page_id = duplicate""",
)
def dup_report_held(spark, sf_dir):
    """The report of all held listings, every entry shown."""
    duplicates = materialized(_held_duplicates(spark, sf_dir), "held-duplicates")
    return dups.duplicate_report(_held(spark, sf_dir), duplicates, "internal_id", ["url"])


# The stage's own setting: 256 bits, similarity 0.85. Four threshold bits of each value; every vector once
# as it is, and once with a tenth of its values changed, as a near copy.
LEVELS = (-0.15, -0.05, 0.05, 0.15)
_WIDE = f"""
    WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS g FROM embeddings
               UNION ALL SELECT vec_id + 1000000, list_transform(range(64), lambda i: CASE WHEN (i + vec_id) % 10 = 0 THEN -g[i + 1] ELSE g[i + 1] END) FROM (SELECT vec_id, embedding::DOUBLE[] AS g FROM embeddings)),
         b AS (SELECT id, list_transform(range(256), lambda i: CASE WHEN g[i // 4 + 1] > [{', '.join(map(str, LEVELS))}][i % 4 + 1] THEN 1 ELSE 0 END) AS b FROM v),
         s AS (SELECT id, (id % 1000000 + 7 * (id // 1000000)) // 2 AS listing, array_to_string(list_transform(range(64), lambda d: substr('0123456789abcdef', CAST(1 + 8 * b[4 * d + 1] + 4 * b[4 * d + 2] + 2 * b[4 * d + 3] + b[4 * d + 4] AS INT), 1)), '') AS sig,
                      list_sum(list_transform(range(8), lambda i: b[i + 1] << i::INT))::INT AS bucket,
                      list_transform(range(4), lambda w: list_sum(list_transform(range(64), lambda i: CASE WHEN b[64 * w + i + 1] = 1 THEN 1::UBIGINT << i::INT ELSE 0::UBIGINT END))::UBIGINT) AS w FROM b),
         d AS (SELECT sig, any_value(w) AS w, any_value(bucket) AS bucket FROM s GROUP BY sig),
         p AS (SELECT a.sig AS l, b.sig AS r, a.bucket AS lb, b.bucket AS rb, CAST(bit_count(xor(a.w[1], b.w[1])) + bit_count(xor(a.w[2], b.w[2])) + bit_count(xor(a.w[3], b.w[3])) + bit_count(xor(a.w[4], b.w[4])) AS INTEGER) AS distance
               FROM d a JOIN d b ON a.sig < b.sig),
         n AS (SELECT * FROM p WHERE 1 - distance / 256.0 >= 0.85)"""


def _wide(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("g"))
    turned = F.transform("g", lambda v, i: F.when((i + F.col("vec_id")) % 10 == 0, -v).otherwise(v))
    both = rows.select(F.col("vec_id").alias("id"), "g").unionAll(rows.select(F.col("vec_id") + 1000000, turned))
    flags = F.flatten(F.transform("g", lambda v: F.array(*[F.when(v > level, F.lit("1")).otherwise(F.lit("0")) for level in LEVELS])))
    images = both.select(
        F.expr("(id % 1000000 + 7 * (id div 1000000)) div 2").alias("listing"), bits.bits_to_hex(F.array_join(flags, ""), 256).alias("signature")
    )
    return materialized(images, "wide")


@check("near_pairs_256", f"{_WIDE} SELECT l AS left_sig, r AS right_sig, distance, round(1 - distance / 256.0, 9) AS similarity FROM n")
def near_pairs_256(spark, sf_dir):
    return _named(neighbors.near_pairs(_wide(spark, sf_dir).select("signature").distinct(), 256, 0.85))


@check(
    "lsh_pairs_256",
    f"""{_WIDE}, x AS (SELECT * FROM n WHERE bit_count(xor(lb, rb)) <= 1)
        SELECT l AS left_sig, r AS right_sig, distance FROM x UNION ALL SELECT r, l, distance FROM x""",
)
def lsh_pairs_256(spark, sf_dir):
    pairs = neighbors.lsh_pairs(_wide(spark, sf_dir).select("signature").distinct(), 256, 0.85)
    return _named(pairs).select("left_sig", "right_sig", "distance")


def _new_pairs(spark, path, rows, is_new, n_bits, similarity):
    """The pairs that the last tenth of the rows brings, found among the nine tenths filed before it in two goes."""
    stored, new = rows.where(~is_new).select("signature"), rows.where(is_new).select("signature")
    band_index.create_index(spark, path, n_bits, similarity, expected=100_000)
    first = F.pmod(F.xxhash64("signature"), F.lit(2)) == 0
    band_index.file_signatures(stored.where(first), path)
    band_index.file_signatures(stored.where(~first), path)
    return _named(band_index.probe(new, path))


@check(
    "near_pairs_new",
    f"""{_pairs_sql('ahash', 64, 0.7)}, n AS (SELECT sig FROM s EXCEPT SELECT sig FROM s WHERE vec_id % 10 < 9)
        {_PAIR_COLUMNS} WHERE l IN (FROM n) OR r IN (FROM n)""",
)
def near_pairs_new(spark, sf_dir):
    rows = materialized(_signatures(spark, sf_dir).select("vec_id", "signature"), "signatures")
    return _new_pairs(spark, work_path(spark, "band-index"), rows, F.col("vec_id") % 10 == 9, 64, 0.7)


@check(
    "near_pairs_new_256",
    f"""{_WIDE}, fresh AS (SELECT sig FROM s EXCEPT SELECT sig FROM s WHERE listing % 10 < 9)
        SELECT l AS left_sig, r AS right_sig, distance, round(1 - distance / 256.0, 9) AS similarity FROM n WHERE l IN (FROM fresh) OR r IN (FROM fresh)""",
)
def near_pairs_new_256(spark, sf_dir):
    return _new_pairs(spark, work_path(spark, "band-index"), _wide(spark, sf_dir), F.col("listing") % 10 == 9, 256, 0.85)


@check(
    "dup_counts_256",
    f"""{_WIDE}, g AS (SELECT sig, min(listing) AS f, count(DISTINCT listing) AS n FROM s GROUP BY 1),
        e AS (SELECT l, r FROM n UNION SELECT r, l FROM n), m AS (SELECT l, sum(g.n) AS near FROM e JOIN g ON g.sig = r GROUP BY l)
        SELECT sig AS signature, f AS first_key, n AS n_keys, n - 1 AS n_copies, CAST(coalesce(near, 0) AS BIGINT) AS n_near FROM g LEFT JOIN m ON m.l = sig""",
)
def dup_counts_256(spark, sf_dir):
    images = _wide(spark, sf_dir)
    pairs = neighbors.near_pairs(images.select("signature").distinct(), 256, 0.85)
    return dups.duplicate_counts(images, "listing", "signature", materialized(pairs, "near-pairs"))


@check(
    "knn_pairs_256",
    f"""{_WIDE}, c AS (SELECT DISTINCT listing, sig FROM s), e AS (SELECT l, r, distance FROM n UNION ALL SELECT r, l, distance FROM n UNION ALL SELECT sig, sig, 0 FROM d),
        q AS (SELECT a.listing AS key, b.listing AS neighbor, min(distance) AS distance FROM e JOIN c a ON a.sig = l JOIN c b ON b.sig = r WHERE a.listing <> b.listing GROUP BY 1, 2)
        SELECT key, neighbor, distance, CAST(row_number() OVER (PARTITION BY key ORDER BY distance, neighbor) AS INTEGER) AS rank FROM q
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY distance, neighbor) <= 5""",
)
def knn_pairs_256(spark, sf_dir):
    return neighbors.nearest(_wide(spark, sf_dir), "listing", "signature", 256, 0.85, 5)
