"""The operators as queries over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from labelbench.llm import (
    bpe,
    conversations,
    cuckoo,
    fingerprints,
    hosts,
    jaccard,
    language,
    later_oracles,
    leaks,
    lines,
    mixing,
    pseudonyms,
    search,
    sharding,
)
from labelbench.shared import cut


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(_table(spark, folder, "documents"))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards_by_bytes(_table(spark, folder, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cuckoo.exact_duplicates(_table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return lines.drop_repeated_lines(documents, min_docs=10, min_chars=1).select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


# Whoever runs this on real data sets a key of their own; it decides which pseudonyms come out.
PSEUDONYM_KEY = "key of the registered query"


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymised(documents, PSEUDONYM_KEY)


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    codes = language.trained(documents.where(~language.is_held_out()))
    found = language.identified(documents.select("doc_id", "text"), codes)
    return found.select(
        "doc_id", language.is_held_out().alias("held_out"), "lang_pred", "score", "ambiguous"
    )


URL_RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Pages take the labels that bear their number: bad is of low quality or toxic."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    outcomes = _table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), bad.cast("int").alias("bad")
    )
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return hosts.judged(pages, outcomes, URL_RULES).drop("bound")


def op9_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents"), width=5, percent=80)


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(_table(spark, folder, "documents"), vocabulary).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), width=10)
    n_hit = leaks.hit_words()
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    placed = cut(conversations.placed_turns(_table(spark, folder, "conversations")))
    turns, convs = conversations.rebuilt(placed)
    return conversations.prefix_trie(cut(turns), convs)


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    documents, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return search.ranked_documents(documents, items, top=20)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_sharding": op2_sharding,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_pii": op6_pii,
    "op7_language_id": op7_language_id,
    "op8_url_filter": op8_url_filter,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_bpe": op10_bpe,
    "op11_decontamination": op11_decontamination,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op11_decontamination": later_oracles.LEAKS,
    "op12_prefix_trie": later_oracles.PREFIX_TRIE,
    "op13_ranked_search": later_oracles.SEARCH,
    "op3_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id,
            first_value(doc_id) OVER w AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size,
            row_number() OVER w = 1 AS kept,
            text_sha256
        FROM d
        WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)
    """,
    "op4_line_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS nr, doc_id,
                string_split(coalesce(text, ''), chr(10)) AS lines
            FROM documents
        ), l AS (
            SELECT nr, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d
        ), k AS (
            SELECT nr, pos, line, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l
        ), gone AS (
            SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT nr) >= 10
        )
        SELECT d.doc_id, count(*) AS n_lines, count(gone.key) AS n_dropped,
            sha256(coalesce(string_agg(k.line, chr(10) ORDER BY pos)
                FILTER (WHERE gone.key IS NULL), '')) AS kept_sha256
        FROM d JOIN k USING (nr) LEFT JOIN gone USING (key)
        GROUP BY nr, d.doc_id
    """,
    "op8_url_filter": r"""
        WITH p AS (
            SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages
        ), o AS (
            SELECT doc_id AS page_id, (quality = 0 OR toxic = 1)::int AS bad FROM labels
            WHERE (quality = 0 OR toxic = 1) IS NOT NULL
        ), q AS (
            SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS site FROM p
        ), h0 AS (
            SELECT site, count(bad) AS n, coalesce(sum(bad), 0) AS bad, string_split(site, '.') AS labels,
                CASE WHEN regexp_matches(site, '{ADDRESS}') THEN 4
                    WHEN regexp_matches(site, '{LONG_SUFFIX}') THEN 2 ELSE 1 END AS long
            FROM q LEFT JOIN o USING (page_id) GROUP BY site
        ), h AS (
            SELECT site, n, bad, array_to_string(labels[-least(4, long + 1):], '.') AS domain,
                array_to_string(labels[-long:], '.') AS suffix
            FROM h0
        ), d AS (
            SELECT domain, suffix, count_if(n > 0) AS n, sum(if(n > 0, bad / n, 0)) AS bad
            FROM h GROUP BY ALL
        ), s AS (
            SELECT suffix, count_if(n > 0) AS n, sum(if(n > 0, bad / n, 0)) AS bad FROM d GROUP BY suffix
        ), s1 AS (
            SELECT *, 1.0 + sum(bad) OVER () - bad AS above,
                1.0 + sum(n) OVER () - n - (sum(bad) OVER () - bad) AS below
            FROM s
        ), s2 AS ({prior_of_s1}
        ), d1 AS (
            SELECT d.*, if(d.n > 0, d.bad / d.n, 0) AS share, a + s2.bad - share AS above,
                b + s2.n - (d.n > 0)::int - (s2.bad - share) AS below
            FROM d JOIN s2 USING (suffix)
        ), d2 AS ({prior_of_d1}
        ), h1 AS (
            SELECT h.*, if(h.n > 0, h.bad / h.n, 0) AS gave, a + d2.bad - gave AS above,
                b + d2.n - (h.n > 0)::int - (d2.bad - gave) AS below
            FROM h JOIN d2 USING (domain)
        ), h2 AS ({prior_of_h1}
        ), h3 AS (
            SELECT site, a + bad AS a, b + n - bad AS b FROM h2
        ), h4 AS (
            SELECT site, {LIMIT} ** a * (1 - {LIMIT}) ** b / a * exp(lgamma(a + b) - lgamma(a) - lgamma(b))
                * list_sum(list_transform(range(0, (200 + 2 * (a + b))::bigint), lambda i: exp(
                    lgamma(a + b + i) - lgamma(a + b) - lgamma(a + 1 + i) + lgamma(a + 1)
                    + i * ln({LIMIT})))) AS share
            FROM h3
        ), r(rule, verdict) AS (
            VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'),
                ('org/fr/', 'allow')
        ), f AS (
            SELECT host, path, max_by(rule, length(rule)) AS rule,
                max_by(verdict, length(rule)) AS verdict
            FROM (SELECT DISTINCT host, path FROM p) JOIN r
                ON ('.' || host LIKE '%.' || split_part(rule, '/', 1))
                AND starts_with(path, substr(rule, strpos(rule, '/')))
            GROUP BY host, path
        )
        SELECT page_id, host, path, f.rule,
            coalesce(f.verdict, CASE WHEN share < {DOUBT} THEN 'block' ELSE 'allow' END) AS verdict
        FROM q JOIN h4 USING (site) LEFT JOIN f USING (host, path)
    """,
}


def _prior_sql(level: str) -> str:
    """One level's prior from ``above`` and ``below``, as in ``hosts._with_prior``."""
    return f"""
            SELECT *, greatest({hosts.LEAST_STRENGTH}, odds / (vague + spread * (odds - vague)) - 1) AS k,
                k * mean AS a, k * (1 - mean) AS b
            FROM (
                SELECT *, above / (above + below) AS mean, mean * (1 - mean) AS odds,
                    odds / (above + below + 1) AS vague,
                    least({hosts.MOST_SPREAD}, greatest({hosts.LEAST_SPREAD},
                        (sum((bad - n * mean) ** 2 - n * odds - n * (n - 1) * vague) OVER ()
                            + {hosts.USUAL_SPREAD})
                        / (sum(n * (n - 1) * (odds - vague)) OVER () + 1))) AS spread
                FROM {level}
            )"""


for _name in ("ADDRESS", "LONG_SUFFIX", "LIMIT", "DOUBT"):
    ORACLES["op8_url_filter"] = ORACLES["op8_url_filter"].replace("{" + _name + "}", str(getattr(hosts, _name)))
for _level in ("s1", "d1", "h1"):
    ORACLES["op8_url_filter"] = ORACLES["op8_url_filter"].replace(
        "{prior_of_" + _level + "}", _prior_sql(_level)
    )
