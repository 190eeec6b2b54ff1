"""The operators applied to the synthetic tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.llm import language_id, license_scan, line_quality, multiprobe, ngram_join, period_runs, pfair_mix, piece_stream, simhash, token_files, url_filter, warc_store, whitening
from tallyfold.llm.common import small_batches

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: (host, path, verdict): a rule covers the host's subdomains and all paths that begin so.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Listed domains, families of unwanted sites under each top domain; each covers its subdomains.
BLOCKED_FAMILIES = ["adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"]
BLOCKED_DOMAINS = [f"{family}.example.{top}" for family in BLOCKED_FAMILIES for top in ("com", "net", "org")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(d,) for d in BLOCKED_DOMAINS], "key string")
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, blocked)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multiprobe.NeighbourSearch(vectors).neighbours(vectors.where("vec_id % 20 = 0"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("licenses", "|").alias("licenses"),
    )


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.judge_documents(docs).drop("text")


def op5_piece_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_stream.piece_digests(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def language_model(docs: DataFrame) -> language_id.Model:
    """Trained on documents outside the fold that is held out."""
    return language_id.train(docs.where((held_out() == F.lit(False)) & F.col("doc_id").isNotNull()))


def held_out():
    """Whether a document is in the fold that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_model(docs)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "accepted")


def op7_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_store.archived(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_texts(_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Target weights of the sources of ``documents``; other sources weigh 2.
TARGET_WEIGHTS = {"src0": 10, "src1": 8, "src2": 8, "src3": 5, "src4": 5, "src5": 3, "src6": 3, "src7": 1}


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair_mix.mix(docs, TARGET_WEIGHTS, default_weight=2)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return period_runs.run_digests(period_runs.period_runs(docs, plant=True))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_multiprobe": op2_multiprobe,
    "op3_license_scan": op3_license_scan,
    "op4_line_quality": op4_line_quality,
    "op5_piece_stream": op5_piece_stream,
    "op6_language_id": op6_language_id,
    "op7_warc_store": op7_warc_store,
    "op8_ngram_join": op8_ngram_join,
    "op9_pfair_mix": op9_pfair_mix,
    "op10_token_files": op10_token_files,
    "op11_simhash": op11_simhash,
    "op12_period_runs": op12_period_runs,
    "op13_whitening": op13_whitening,
}


def _url_sql() -> str:
    """Rules as cases, the longest first, then the list."""
    ordered = sorted(URL_RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    fits = [(f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v) for h, p, v in ordered]
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    listed = " OR ".join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in BLOCKED_DOMAINS)
    return f"""
        WITH u AS (
            SELECT page_id, coalesce(CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) END, '') AS rest FROM pages
        ), p AS (
            SELECT page_id,
                translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u
        )
        SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict
        FROM p
    """


ORACLES: dict[str, str] = {
    "op1_url_filter": _url_sql(),
    "op3_license_scan": license_scan.scan_sql(),
    "op7_warc_store": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
            FROM pages
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN n >= 1000 AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND keeper <> page_id THEN keeper END AS refers_to
        FROM p
    """,
}
