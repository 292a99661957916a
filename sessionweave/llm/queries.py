"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.llm import decontaminate, embed_dedup, line_dedup, packing, pii, simhash, substring, toxicity, url_filter, warc

#: Fixed values of the URL rules: host, path, verdict.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]
#: The block list of the query (host with its subdomains, path prefix), where no rule fits: sections of known junk sites.
#: It is made by rule: every site of the kinds under every top domain and language, with its numbered sections of pages.
JUNK_SITES = ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")
TOP_DOMAINS, LANGUAGES, SECTIONS = ("com", "net", "org"), ("en", "fr", "de", "es"), range(1, 100)


def listed_urls(spark: SparkSession) -> DataFrame:
    """Thousands of canonical URLs: sections 1 to 99 by leading digits of a page number."""
    each = lambda values: F.explode(F.array(*(F.lit(v) for v in values)))
    sites = spark.range(1).select(each(JUNK_SITES).alias("site")).withColumn("top", each(TOP_DOMAINS)).withColumn("lang", each(LANGUAGES))
    return sites.withColumn("n", F.explode(F.sequence(F.lit(SECTIONS.start), F.lit(SECTIONS.stop - 1)))).select(
        F.format_string("%s.example.%s", "site", "top").alias("host"), F.format_string("/%s/%d", "lang", "n").alias("path")
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules, listed_urls(spark), keep=["page_id"])


def _op1_sql() -> str:
    literal = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    column = lambda values: f"unnest([{', '.join(repr(v) for v in values)}])"
    return f"""
    with rules(h, p, v) as (values {literal}), sites as (select {column(JUNK_SITES)} as site), tops as (select {column(TOP_DOMAINS)} as top),
    langs as (select {column(LANGUAGES)} as lang),
    listed as (
      select site || '.example.' || top as h, '/' || lang || '/' || n as p from sites, tops, langs, range({SECTIONS.start}, {SECTIONS.stop}) r(n)
    ),
    u as (
      select row_number() over () as k, page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
      from pages
    ), c as (
      select k, page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
      from u
    ), fit as (
      select k, max_by(r.h || r.p, length(r.h || r.p) * 10000 + length(r.h)) as rule, max_by(r.v, length(r.h || r.p) * 10000 + length(r.h)) as v
      from c join rules r on (c.host = r.h or ends_with(c.host, '.' || r.h)) and starts_with(c.path, r.p)
      group by k
    ), bad as (
      select distinct k from c join listed r on starts_with(c.path, r.p) and (c.host = r.h or ends_with(c.host, '.' || r.h))
    )
    select page_id, host, path, rule, coalesce(v, case when bad.k is null then 'allow' else 'block' end) as verdict
    from c left join fit using (k) left join bad using (k)
    """


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


#: Base32 of SHA-1's 160 bits: 32 digits of 5 bits, each read from the two bytes around it.
_op6_sql = """
    with d as (
      select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as hex from pages
    ), b as (
      select page_id, n, hex, (
        select string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
          ((('0x' || substr(hex || '0', (i * 5) // 4 + 1, 3))::int >> (7 - (i * 5) % 4)) & 31) + 1, 1), '' order by i)
        from range(32) t(i)) as digest
      from d
    ), w as (select *, max(page_id) over (partition by digest) as keeper from b)
    select page_id, n::bigint as payload_bytes, digest as payload_digest,
           case when page_id is distinct from keeper then 'revisit' else 'response' end as record_type,
           case when page_id is distinct from keeper then keeper end as refers_to
    from w
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Key of the query's pseudonyms; a real run takes a secret one.
PII_KEY = "example-key"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_op5_sql = r"""
    with lines as (
      select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as k
      from documents
    ), keyed as (
      select *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
    ), owners as (select key, min(doc_id) as owner from keyed where length(key) >= 10 group by key),
    judged as (select doc_id, k, line, coalesce(doc_id <> owner, false) as gone from keyed left join owners using (key))
    select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by k) filter (not gone), '')) as kept_sha256
    from judged group by doc_id
"""


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


_op10_sql = """
    with recursive v as (
      select vec_id, label, embedding::double[] as e from embeddings
      where label is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links as (
      select a.vec_id as a, b.vec_id as b from v a join v b
      on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98
    ), reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on r.b = l.a),
    comp as (select a as vec_id, min(b) as component_id from reach group by a),
    deg as (select a as vec_id, count(*) as n from links group by a)
    select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
    from comp left join deg using (vec_id)
"""

def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.dedup_passages(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), machine).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def tokenizer_file() -> str:
    """Path of the public byte-level vocabulary; imported late, as only this needs it."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_decontamination": op2_decontamination,
    "op3_pii": op3_pii,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_warc": op6_warc,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_embedding_dedup": op10_embedding_dedup,
}

ORACLES: dict[str, str] = {
    "op1_url_filter": _op1_sql(),
    "op5_line_dedup": _op5_sql,
    "op6_warc": _op6_sql,
    "op10_embedding_dedup": _op10_sql,
}
