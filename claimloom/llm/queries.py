"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm import (
    chat_repair,
    exact_dedup,
    jaccard_join,
    learned_search,
    packing,
    page_text,
    periodic_runs,
    private_data,
    quality,
    quotations,
    token_files,
    url_rules,
    word_shuffle_bpe,
)
from claimloom.llm.shared import new_folder, whole_text

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.DigestIndex(spark, new_folder(spark, "digest-index"))
    found = index.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_text(table(spark, sf_dir, "pages"))


def reply_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotations.in_reply_order(table(spark, sf_dir, "conversations"))


def similar_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.group_similar(table(spark, sf_dir, "documents"))


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = token_files.Settings(public_tokenizers.path("byte_bpe_50k.json"))
    folder = new_folder(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, settings)
    return token_files.token_digests(spark, folder)


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = word_shuffle_bpe.encode(table(spark, sf_dir, "documents"), ranks)
    decoded = word_shuffle_bpe.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    # nothing else is in these workers, so they may remember more than in a pipeline
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer, cached=800_000)


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    every_twentieth = F.col("vec_id") % 20 == 0
    return learned_search.search(table(spark, sf_dir, "embeddings"), every_twentieth, 20)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, machine)


def private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.describe(private_data.find_private(table(spark, sf_dir, "documents")))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; a tenth of the texts, by hash, repeat themselves from a place on.

    With h the crc32 of ``doc_id`` and g = h / 10, the words from number g % n on go round
    every 1 + (n - g % n) / (3 + g % 8) words. A null ``doc_id`` leaves the text alone.
    """
    hashed = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(whole_text(), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", whole_text().alias("text"), hashed.alias("h"))
    chosen = F.col("h") % 10 == 0
    rows = rows.select(
        "doc_id", "text", F.floor(F.col("h") / 10).alias("g"), F.when(chosen, words).alias("words")
    )
    rows = rows.withColumn("n", F.when(F.size("words") > 0, F.size("words")))
    rows = rows.withColumn("a", F.col("g") % F.col("n"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", period)
    place = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.when(i < F.col("a"), i).otherwise(
            F.col("a") + (i - F.col("a")) % F.col("p")
        ),
    )
    planted = F.transform(place, lambda i: F.get(F.col("words"), i.cast("int")))
    return rows.select("doc_id", F.coalesce(F.array_join(planted, " "), "text").alias("text"))


def word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = with_planted_periods(table(spark, sf_dir, "documents"))
    found = periodic_runs.with_runs(planted, ["doc_id"])
    line = F.transform(
        "runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])
    )
    longest = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"),
                (-r["start"]).alias("before"),
                (-r["period"]).alias("shorter"),
            ),
        )
    )
    rows = found.select("row.doc_id", "digest", "runs", "collapsed", longest.alias("longest"))
    n_runs = F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).cast("long")
    length, period = F.col("longest.length"), -F.col("longest.shorter")
    return rows.select(
        "doc_id",
        n_runs.alias("n_runs"),
        (-F.col("longest.before")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2(F.coalesce(F.array_join(line, ""), F.lit("")), 256).alias("runs_sha256"),
        F.coalesce(F.sha2("collapsed", 256), "digest").alias("collapsed_sha256"),
    )


URL_RULES = (
    ("net", "/", url_rules.BLOCK),
    ("example.net", "/en/", url_rules.ALLOW),
    ("example.com", "/de/", url_rules.BLOCK),
    ("org", "/fr/", url_rules.ALLOW),
)


def judged_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = url_rules.judge(table(spark, sf_dir, "pages"), rules)
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with known faults, by the hash of conversation and turn."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    mark = F.crc32(F.concat_ws(":", text("conv_id"), text("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", *[text(c).alias(c) for c in ("role", "text")], mark.alias("mark")
    )
    kind = F.col("mark")
    said = (
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    times = F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))
    return rows.where(kind != 0).select(
        "conv_id", "turn", role.alias("role"), said.alias("text"), F.explode(times).alias("copy")
    )


def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report = chat_repair.repair_report(damaged(conversations))
    found = report.withColumnRenamed("conv_id", "repaired_id")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    met = every.join(found, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return met.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": exact_duplicates,
        "op2_html_extraction": main_text,
        "op3_quotation_linking": reply_ordered,
        "op4_ngram_jaccard_join": similar_documents,
        "op5_token_files": token_id_files,
        "op6_byte_bpe": byte_bpe,
        "op7_packing": packed_sequences,
        "op8_nearest_neighbours": nearest_neighbours,
        "op9_quality_classifier": quality_scores,
        "op10_private_data": private_spans,
        "op11_periodic_runs": word_runs,
        "op12_url_rules": judged_urls,
        "op13_chat_repair": repaired_conversations,
    }
