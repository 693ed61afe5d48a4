"""The operators over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import work_path
from . import (
    bpe,
    collocations,
    decontaminate,
    language,
    lattice,
    lines,
    lm_scores,
    negatives,
    ngram_join,
    repeats,
    token_counts,
    toxicity,
    url_rules,
)
from .common import table
from .registry import oracle_sql, queries, query

__all__ = ["oracle_sql", "queries"]

RANKS = "byte_bpe_multi_50k.tiktoken"


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `modulus`."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score_texts(docs, model).select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


@query("op2_ngram_join")
def op2_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


RULES = [
    ("net/", url_rules.BLOCK),
    ("example.net/en/", url_rules.ALLOW),
    ("example.com/de/", url_rules.BLOCK),
    ("org/fr/", url_rules.ALLOW),
]


@query(
    "op3_url_rules",
    r"""WITH cut AS (SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) AS u FROM pages),
             page AS (SELECT page_id, translate(u.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, u.path AS path FROM cut),
             ruled AS (SELECT *, CASE WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                                      WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                                      WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                                      WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM page)
        SELECT page_id, host, path, rule,
               CASE WHEN host = '' THEN 'block' WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN regexp_matches(host, 'casino|porn|xxx|viagra') OR regexp_matches(path, 'casino|porn|xxx|viagra') THEN 'block'
                    ELSE 'allow' END AS verdict FROM ruled""",
)
def op3_url_rules(spark, sf_dir):
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).drop("url")


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(docs, path, work_path(spark, "token-cache"))


@query("op5_bpe")
def op5_bpe(spark, sf_dir):
    ranks = bpe.load_ranks(spark, public_tokenizers.path(RANKS))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.transcode(docs, ranks, public_tokenizers.PATTERN)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_lattice")
def op6_lattice(spark, sf_dir):
    return lattice.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query(
    "op7_decontaminate",
    r"""WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
             item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
             pattern AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(list_slice(w, i + 1, i + least(10, len(w))), ' ') AS words
                         FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM item WHERE len(w) > 0)),
             sizes AS (SELECT DISTINCT size FROM pattern),
             spot AS (SELECT doc_id, i, size, array_to_string(list_slice(w, i + 1, i + size), ' ') AS words
                      FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS i FROM doc CROSS JOIN sizes WHERE len(w) >= size)),
             hit AS (SELECT doc_id, i, spot.size, item_id FROM spot JOIN pattern ON spot.words = pattern.words AND spot.size = pattern.size),
             covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
             owner AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
        SELECT doc.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN owner USING (doc_id)""",
)
def op7_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_test_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_language")
def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.select("doc_id", "text", "lang"), fold(4) != 2)
    labelled = language.label_languages(docs.select("doc_id", "text"), model)
    return labelled.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")


LINES_SQL = r"""
    WITH doc AS (SELECT doc_id, text, md5(coalesce(text, '')) AS k, string_split(text, chr(10)) AS l FROM {documents}),
         filled AS (SELECT doc_id, k, list_filter(list_transform(range(0, len(l)), lambda i: struct_pack(at := i, line := trim(l[i + 1], ' ' || chr(9) || chr(13)))), lambda x: x.line <> '') AS f
                    FROM doc WHERE text IS NOT NULL),
         spot AS (SELECT doc_id, k, f[j + 1].at AS first, f[j + 3].at AS last, md5(f[j + 1].line || chr(10) || f[j + 2].line || chr(10) || f[j + 3].line) AS h
                  FROM (SELECT doc_id, k, f, unnest(range(0, len(f) - 2)) AS j FROM filled WHERE len(f) >= 3)),
         ranked AS (SELECT *, dense_rank() OVER (PARTITION BY h ORDER BY doc_id NULLS LAST, k, first) AS n FROM spot),
         gone AS (SELECT DISTINCT doc_id, k, unnest(range(first, last + 1)) AS p FROM ranked WHERE n > 1),
         gone_list AS (SELECT doc_id, k, list(p) AS ps FROM gone GROUP BY doc_id, k),
         done AS (SELECT doc.doc_id, doc.text, l, ps FROM doc LEFT JOIN gone_list g ON doc.doc_id IS NOT DISTINCT FROM g.doc_id AND doc.k = g.k)
    SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(l) END AS n_lines, coalesce(len(ps), 0) AS n_removed,
           sha256(CASE WHEN ps IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(0, len(l)), lambda i: NOT list_contains(ps, i)), lambda i: l[i + 1]), chr(10)) END) AS text_sha256
    FROM done"""


@query("op9_line_dedup", LINES_SQL.replace("{documents}", "documents"))
def op9_line_dedup(spark, sf_dir):
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


LM_SQL = r"""
    WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
         word AS (SELECT doc_id, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3
                  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
         gram AS (SELECT doc_id, 1 AS k, g1 AS g FROM word UNION ALL SELECT doc_id, 2, g2 FROM word WHERE g2 IS NOT NULL UNION ALL SELECT doc_id, 3, g3 FROM word WHERE g3 IS NOT NULL),
         own AS (SELECT doc_id, k, g, count(*) AS n FROM gram GROUP BY doc_id, k, g),
         total AS (SELECT k, g, sum(n) AS n FROM own GROUP BY k, g),
         others AS (SELECT own.doc_id, own.k, own.g, total.n - own.n AS n FROM own JOIN total USING (k, g)),
         counted AS (SELECT word.doc_id, word.i, coalesce(a.n, 0) AS n1, coalesce(b.n, 0) AS n2, coalesce(c.n, 0) AS n3, g2, g3,
                            (SELECT count(*) FROM word) - len(doc.w) AS n0
                     FROM word JOIN doc USING (doc_id) LEFT JOIN others a ON a.doc_id = word.doc_id AND a.k = 1 AND a.g = g1
                     LEFT JOIN others b ON b.doc_id = word.doc_id AND b.k = 2 AND b.g = g2 LEFT JOIN others c ON c.doc_id = word.doc_id AND c.k = 3 AND c.g = g3),
         context AS (SELECT *, lag(n1) OVER (PARTITION BY doc_id ORDER BY i) AS c1, lag(n2) OVER (PARTITION BY doc_id ORDER BY i) AS c2 FROM counted),
         scored AS (SELECT doc_id, CASE WHEN n3 > 0 THEN ln(n3 / c2)
                                        WHEN n2 > 0 THEN ln(n2 / c1) + CASE WHEN g3 IS NOT NULL THEN ln(0.4) ELSE 0 END
                                        ELSE ln(CASE WHEN n1 > 0 THEN n1 ELSE 0.4 END / greatest(n0, 1)) + CASE WHEN g2 IS NOT NULL THEN ln(0.4) ELSE 0 END + CASE WHEN g3 IS NOT NULL THEN ln(0.4) ELSE 0 END END AS s
                    FROM context)
    SELECT doc.doc_id, len(w) AS n_words, round(coalesce(s, 0), 5) AS log_score, round(s / len(w), 7) AS mean_score
    FROM doc LEFT JOIN (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id) USING (doc_id)"""


@query("op10_lm_scores", LM_SQL)
def op10_lm_scores(spark, sf_dir):
    out = lm_scores.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", F.round("log_score", 5).alias("log_score"), F.round("mean_score", 7).alias("mean_score"))


@query(
    "op11_hard_negatives",
    r"""WITH given AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                       WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
             scaled AS (SELECT vec_id, label, list_transform(v, lambda x: floor(256 * x)) AS v FROM given
                        WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             scored AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS other, b.label, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
                        FROM scaled a JOIN scaled b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
             positive AS (SELECT anchor_id, own, other AS positive_id, score AS positive_score FROM scored WHERE label = own
                          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER part AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN scored USING (anchor_id) WHERE label <> positive.own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW part AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER part <= 10""",
)
def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


PHRASES_SQL = r"""
    WITH piece AS (SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[ 	]+'), lambda x: x <> '') AS w
                   FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS p FROM documents)),
         words AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
         spot AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS k FROM piece) WHERE len(w) >= k),
         f AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS f FROM spot GROUP BY ALL HAVING count(*) >= 100),
         candidate AS (SELECT lang, k AS size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2),
         cut AS (SELECT lang, phrase, a, w, k, array_to_string(list_slice(w, 1, k), ' ') AS first, array_to_string(list_slice(w, k + 1, len(w)), ' ') AS rest
                 FROM (SELECT *, unnest(range(1, size)) AS k FROM candidate)),
         scored AS (SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, n, cut.k, CAST((1000 * CAST(a AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
                    FROM cut JOIN words ON words.lang = cut.lang JOIN f x ON x.lang = cut.lang AND x.phrase = first JOIN f y ON y.lang = cut.lang AND y.phrase = rest),
         lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
         part AS (SELECT lang, phrase AS whole, a, w, k, unnest(range(1, size - k + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS k FROM candidate)),
         inside AS (SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, max(a) AS longer FROM part GROUP BY 1, 2),
         kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside ON inside.lang = lowest.lang AND inside.phrase = lowest.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
    SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score FROM kept
    WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER best <= 2000"""


@query("op12_collocations", PHRASES_SQL)
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


@query(
    "op13_substring_dedup",
    r"""WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w FROM documents),
             spot AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS words FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM doc WHERE len(w) >= 13)),
             first AS (SELECT words, min(doc_id) AS least FROM spot GROUP BY words),
             gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM spot JOIN first USING (words) WHERE least < doc_id),
             gone_list AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
        SELECT doc.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
               sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(ps, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
        FROM doc LEFT JOIN gone_list USING (doc_id)""",
)
def op13_substring_dedup(spark, sf_dir):
    out = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
