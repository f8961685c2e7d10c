"""The registered queries of this subpackage: each applies one operator, with its production parameters, to
its whole table and derives the columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrafold.llm import decontaminate, divergence, fim, html_extract, langid, licenses, linededup, mixing, neardup, secrets, topk, toxicity, url_rules
from terrafold.llm.textops import table
from terrafold.llm.url_rules import Rule

# The rules that every URL is judged by, (verdict, host, path).
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]
#: Pattern rules for all other URLs: unwanted hosts.
URL_PATTERNS = [Rule("block", "", p, exact=False) for p in
                ("*casino-win.*", "*free-bets.*", "*cheap-pills.*", "*adult-x.*", "*spam-farm.*", "*ads-track.*")]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", langid.held_out(F.col("doc_id"), 5, 0).alias("held_out"))
    labels = table(spark, sf_dir, "labels").where(~langid.held_out(F.col("doc_id"), 5, 0))
    model = toxicity.train(docs, labels)
    got = toxicity.scored(docs, model)
    return got.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return got.select("query_id", "rank", "vec_id", "score")


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as a file tree: source / language / hundred / file, or for texts under 400 characters a license file, at one of the three levels by a
    hash of its id. A null source, language or id is named ``none``, a null text counts as long."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    folders = [part("source"), part("lang"), F.coalesce(F.floor(F.col("doc_id") / 100).cast("string"), F.lit("none"))]
    short = F.coalesce(F.length("text") < 400, F.lit(False))
    depth = F.when(short, F.pmod(F.xxhash64("doc_id"), F.lit(3)) + 1).otherwise(3).cast("int")
    name = F.concat(F.when(short, F.lit("LICENSE-")).otherwise(F.lit("file-")), part("doc_id"))
    return docs.select("doc_id", F.concat_ws("/", F.lit(""), F.concat_ws("/", F.slice(F.array(*folders), F.lit(1), depth)), name).alias("path"), "text")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(document_files(table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), **decontaminate.WHOLE)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 3, 1))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.identify(docs, model)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mixing.curriculum(table(spark, sf_dir, "documents"))
    return got.withColumns({c: F.round(c, 6) for c in ("target", "first_position", "last_position")})


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), n=3, num=85, den=100, bands=40, rows=8)


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES + URL_PATTERNS)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = fim.fill_in_middle(table(spark, sf_dir, "documents"), unit="line", seed=7, percent=100, spm_percent=50)
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fim.restored(), 256).alias("restored_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_line_dedup, op3_topk, op4_licenses, op5_decontamination,
                            op6_language, op7_mixing, op8_near_duplicates, op9_url_rules, op10_secrets,
                            op11_html_extraction, op12_fill_in_middle, op13_source_divergence)}


#: The supplied tables that each query reads.
INPUT_TABLES = {**{name: ["documents"] for name in QUERIES}, "op1_toxicity": ["documents", "labels"], "op3_topk": ["embeddings"],
                "op5_decontamination": ["documents", "benchmark"], "op9_url_rules": ["pages"], "op11_html_extraction": ["pages"]}


def oracle_sql() -> dict[str, str]:
    from terrafold.llm.oracle import ORACLE

    return dict(ORACLE)
