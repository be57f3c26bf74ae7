"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import (
    centroid_drift, decontaminate, jaccard_join, minmax_dedup, piece_spans, quality, secrets, token_alignment, token_counts,
    token_files, toxicity, url_lists, warc,
)
from fleetpulse.session import scratch_path
from fleetpulse.sources.tables import read_parquet

FIRST_FETCH = 1_704_067_200
DAY = 86_400


def tokenizer(name: str) -> str:
    """Place of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch_path(spark, "tokens")
    folder = token_files.write_tokens(table(spark, sf_dir, "documents"), uri, tokenizer("word_bpe_49k.json"), end_id=1)
    return token_files.read_tokens(spark, folder)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "crawl"), scratch_path(spark, "warc")
    written = warc.write_monolithic(warc.deduplicated(table(spark, sf_dir, "pages")), source)
    files = warc.normalise(spark, written, source, target)
    return warc.read_records(spark, files, target).drop("file", "offset")


def captures(pages: DataFrame) -> DataFrame:
    """Every page, fetched at a time of the year that its id tells."""
    return pages.select("page_id", "url", F.expr(f"{FIRST_FETCH} + (page_id * 7919 % 365) * {DAY} + page_id % {DAY}").alias("fetched_at"))


def list_changes(pages: DataFrame) -> DataFrame:
    """Dated list entries from the hosts, domains and first path steps of all pages; their first page tells the dates."""
    host = url_lists.host_of(F.col("url"))
    path = F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    lists = [
        ("hosts", host, 3),
        ("domains", F.substring_index(host, ".", -3), 7),
        ("paths", F.when(path != "", F.concat(host, F.lit("/"), path)), 2),
    ]
    kinds = F.array(*[F.struct(F.lit(n).alias("list_name"), e.alias("entry"), F.lit(k).alias("every")) for n, e, k in lists])
    entries = pages.select("page_id", F.explode(kinds).alias("e")).select("page_id", "e.*").filter("entry IS NOT NULL")
    firsts = entries.groupBy("list_name", "entry", "every").agg(F.min("page_id").alias("f")).filter("f % every = 0")
    dated = F.expr(
        f"""array(
          struct({FIRST_FETCH} + (f * 31 % 200) * {DAY} AS changed_at, 'add' AS action),
          struct({FIRST_FETCH} + (f * 31 % 200 + f % 90 + 1) * {DAY} AS changed_at, 'remove' AS action),
          struct({FIRST_FETCH} + (f * 31 % 200 + f % 90 + 40) * {DAY} AS changed_at, if(f % 2 = 0, 'add', 'remove') AS action))"""
    )
    return firsts.select("list_name", "entry", F.explode(dated).alias("d")).select("list_name", "entry", "d.*")


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lists.judge(captures(pages), url_lists.validity(list_changes(pages)))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.learn(documents, table(spark, sf_dir, "labels")))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op7_link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_counts(table(spark, sf_dir, "documents"))


def op8_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_spans.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op11_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op12_centroid_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_drift.clustered(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    return token_alignment.report(table(spark, sf_dir, "documents"), first, second)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination, op2_secrets, op3_token_files, op4_warc, op5_url_lists,
        op6_toxicity, op7_jaccard_join, op7_link_counts, op8_piece_spans, op9_token_counts, op10_quality,
        op11_minmax_dedup, op12_centroid_drift, op13_token_alignment,
    )
}
