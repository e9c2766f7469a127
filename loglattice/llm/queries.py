"""The registered queries of the operators, with checking SQL where SQL can express them."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglattice.llm import cotrain, credentials, decontam, langid, linespread, merkle, mixing, quality, setsketch, simhash, urltree, warc, whitening
from loglattice.llm.common import read_table
from loglattice.llm.oracles import CREDENTIALS, LINES, MERKLE, MIXING, NEAR, QUALITY, URLS, WARC

Query = Callable[[SparkSession, str], DataFrame]


def template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaks of benchmark items into documents."""
    return decontam.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the cascade's verdict per document."""
    return quality.quality_measures(read_table(spark, sf_dir, "documents"), ["doc_id"])


def mixed_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language per document, learned from the documents that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def simhash_popcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component per document."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def url_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict per page url."""
    return urltree.judge(read_table(spark, sf_dir, "pages"))


def hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The selected documents and their epochs."""
    return mixing.mix(read_table(spark, sf_dir, "documents"), slim=True)


def line_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut per document, and the remaining text's length and digest."""
    cut = linespread.remove_boilerplate(read_table(spark, sf_dir, "documents"), removed="n_removed")
    return cut.select("doc_id", "n_removed", F.length("text").cast("long").alias("chars_left"), F.md5("text").alias("text_md5"))


def secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans per document, base and added, and how its candidates are owned."""
    found = credentials.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_live", "n_copied")


def warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records read back from the archives of all pages."""
    return warc.read_archives(spark, warc.write_archives(read_table(spark, sf_dir, "pages")))


def quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score per document."""
    docs = read_table(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.train(docs, read_table(spark, sf_dir, "labels")))


def setsketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component per document, and whether the document stays."""
    return setsketch.near_duplicates(read_table(spark, sf_dir, "documents"))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of the embeddings; deviations that 64 bits do not hold are an error."""
    found = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots, proof and check after tampering per document."""
    return merkle.verify(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline at the repository's top."""
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


CATALOG: dict[str, tuple[Query, str | None]] = {
    "op1_template_decontamination": (template_decontamination, None),
    "op2_quality_cascade": (quality_cascade, QUALITY),
    "op3_mixed_language": (mixed_language, None),
    "op4_simhash_popcount": (simhash_popcount, None),
    "op5_url_template_tree": (url_template_tree, URLS),
    "op6_hierarchical_mixing": (hierarchical_mixing, MIXING),
    "op7_line_site_spread": (line_site_spread, LINES),
    "op8_secret_ownership": (secret_ownership, CREDENTIALS),
    "op9_warc_dictionary": (warc_dictionary, WARC),
    "op10_quality_cotraining": (quality_cotraining, None),
    "op11_setsketch_neardup": (setsketch_neardup, NEAR),
    "op12_embedding_whitening": (embedding_whitening, None),
    "op13_merkle_manifest": (merkle_manifest, MERKLE),
    "pipeline": (pipeline, None),
}
