"""One query for each operator, over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dayloom.llm import bytepairs, extract, mixing, neighbours, phrases, pieces, quality, repeats, secrets, setjoin, spelling, urls, warc
from dayloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages"))


@query
def op2_nearest_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op3_html_text(spark, folder):
    return extract.extract_pages(table(spark, folder, "pages"))


@query
def op4_similar_documents(spark, folder):
    return setjoin.similar_documents(table(spark, folder, "documents")).drop("key", "label")


@query
def op5_secret_scan(spark, folder):
    return secrets.report(table(spark, folder, "documents"))


@query
def op6_url_filter(spark, folder):
    return urls.judge_urls(table(spark, folder, "pages"), urls.rule_table(spark))


@query
def op7_quality_rules(spark, folder):
    judged = quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op8_source_mix(spark, folder):
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_repeated_strings(spark, folder):
    return repeats.remove_repeats(table(spark, folder, "documents"))


@query
def op10_pieces(spark, folder):
    return pieces.encode_documents(table(spark, folder, "documents")).drop("text")


@query
def op11_spelling_variants(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query
def op12_byte_pairs(spark, folder):
    return bytepairs.digests(bytepairs.encode_documents(table(spark, folder, "documents")))


@query
def op13_collocations(spark, folder):
    return phrases.collocations(table(spark, folder, "documents"))
