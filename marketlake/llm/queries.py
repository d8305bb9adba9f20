"""Registered queries of the operators: each applies one to its whole table.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLE_SQL`` has
the DuckDB SQL of those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (
    decontaminate,
    katz,
    phrases,
    posting_lists,
    sentence_dedup,
    simhash,
    sketch,
    token_counts,
    toxicity,
    trie_bpe,
    url_lists,
    warc,
    whitening,
)
from marketlake.llm.common import crc_mod, table
from marketlake.session import scratch_path


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))
    return toxicity.scores(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op3_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_dedup.dedup_sentences(docs).select(
        "doc_id", "n_sentences", "n_removed", "removed", "text")


def op4_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 10) == 0)


# The tables have no fetch times and no lists. A page is fetched on a day that follows from its id; some pages
# stand for dated events of lists: their host, its parent domain or their directory is added, others are removed.
FETCHED = "date_add(DATE '2024-01-01', CAST(page_id * 37 % 365 AS INT))"
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
LIST_EVENTS = f"""
SELECT CASE page_id % 3 WHEN 0 THEN 'malware' WHEN 1 THEN 'adult' ELSE 'spam' END AS list,
       concat('host:', {_HOST}) AS key, page_id * 11 % 400 AS offset, page_id % 2 = 0 AS added
FROM pages WHERE page_id % 5 < 2
UNION ALL
SELECT 'phishing', concat('domain:', regexp_extract(url, '^[a-z]+://[^/?#:.]+[.]([^/?#:]+)', 1)), page_id * 7 % 400,
       page_id % 4 <> 0
FROM pages WHERE page_id % 11 = 3
UNION ALL
SELECT 'tracker', concat('prefix:', {_HOST}, '/', regexp_extract(url, '^[a-z]+://[^/?#:]+/([^/?#]+)/', 1), '/'),
       page_id * 13 % 400, page_id % 4 <> 1
FROM pages WHERE page_id % 7 = 2
UNION ALL
SELECT 'allow', concat('host:', {_HOST}), page_id * 17 % 400, page_id % 3 <> 0
FROM pages WHERE page_id % 13 = 5
"""


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = spark.sql(LIST_EVENTS.replace("FROM pages", "FROM {pages}"), pages=pages).select(
        "list", "key", F.expr("date_add(DATE '2023-12-15', CAST(offset AS INT))").alias("day"), "added")
    return url_lists.filter_urls(pages.withColumn("fetched", F.expr(FETCHED)), events)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.compare_next(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    id_type = pages.schema["page_id"].dataType.simpleString()
    path = scratch_path(spark, "warc")
    warc.write(pages, path)
    # try_cast: the id of a page without one is written as 'null'
    return warc.read(spark, path).where("kind = 'record'").select(
        F.expr(f"try_cast(record_id AS {id_type})").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(id_type).alias("refers_to"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.bpe(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_toxicity, op3_sentence_dedup, op4_katz, op5_url_lists, op6_token_counts, op7_fingerprint, op8_warc, op9_bpe,
        op10_simhash, op11_posting_lists, op12_whitening, op13_phrases)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql_words(text: str) -> str:
    return rf"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": rf"""
WITH d AS (SELECT doc_id, coalesce({_sql_words('text')}, []) AS w FROM documents),
i AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s+9], ' ') AS win, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
spans AS (SELECT doc_id, s, n, array_to_string(w[s:s+n-1], ' ') AS win
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, s, spans.n, item_id FROM spans JOIN win USING (win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) AS items FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op5_url_lists": rf"""
WITH e AS (SELECT list, key, DATE '2023-12-15' + CAST("offset" AS INT) AS day, max(added::INT) AS held
           FROM ({LIST_EVENTS.replace('AS offset', 'AS "offset"')}) GROUP BY ALL),
iv AS (SELECT list, key, held, day AS f, lead(day, 1, DATE '9999-12-31') OVER (PARTITION BY list, key ORDER BY day) AS t
       FROM e),
p AS (SELECT page_id, url, {_HOST} AS host, DATE '2024-01-01' + CAST(page_id * 37 % 365 AS INT) AS fd,
             regexp_extract(url, '^[a-z]+://[^/?#]*(/[^?#]*)', 1) AS path FROM pages),
m AS (SELECT page_id, list FROM p JOIN iv ON held = 1 AND f <= fd AND fd < t AND (
        key = 'host:' || host
        OR (starts_with(key, 'domain:') AND ends_with('.' || host, '.' || substr(key, 8)) AND contains(substr(key, 8), '.'))
        OR (starts_with(key, 'prefix:') AND starts_with(host || (CASE WHEN path = '' THEN '/' ELSE path END), substr(key, 8))))),
g AS (SELECT page_id, count(*) FILTER (list <> 'allow') AS n, bool_or(list = 'allow') AS allowed,
             coalesce(array_to_string(list_sort(list(DISTINCT list) FILTER (list <> 'allow')), ','), '') AS lists
      FROM m GROUP BY page_id)
SELECT page_id, host, coalesce(n, 0)::BIGINT AS n_entries, coalesce(lists, '') AS lists,
       coalesce(allowed, false) AS allowed, coalesce(n, 0) > 0 AND NOT coalesce(allowed, false) AS blocked
FROM p LEFT JOIN g USING (page_id)
""",
    "op8_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""",
    "op13_phrases": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[s:s+m-1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS s FROM w, range(1, 6) AS t(m) WHERE len(w) >= m)
      GROUP BY ALL),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE m >= 2 AND f >= 100),
cut AS (SELECT lang, phrase, m, f, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS lp,
               array_to_string(string_split(phrase, ' ')[k+1:m], ' ') AS rp
        FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT cut.lang, cut.phrase, cut.f AS a, k, x.f AS l, y.f AS r, n,
             (1000::HUGEINT * cut.f * n) // (x.f::HUGEINT * y.f) AS score
      FROM cut JOIN n USING (lang) JOIN g x ON x.lang = cut.lang AND x.m = k AND x.phrase = lp
      JOIN g y ON y.lang = cut.lang AND y.m = cut.m - k AND y.phrase = rp),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT x.lang, x.phrase FROM c x JOIN c y ON y.lang = x.lang AND y.m > x.m AND 100 * y.f >= 100 * x.f
           AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
           FROM best ANTI JOIN inside USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
""",
}
