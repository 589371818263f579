"""The registered queries of this folder; each takes the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchcast.llm import centroids, chat, decontaminate, exact, langid, licenses, merkle, mixing, pii, repeats, simhash, urls, warc
from matchcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


@query
def op2_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark, sf_dir):
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "covered", F.col("words").alias("item_words"), "changed"
    )


@query
def op4_warc(spark, sf_dir):
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("root").alias("component_id"),
    )


@query
def op6_exact_dedup(spark, sf_dir):
    found = exact.exact_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


@query
def op7_repeats(spark, sf_dir):
    return repeats.repeated_bytes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op8_chat(spark, sf_dir):
    said = f"{chat.CLOSE}{chat.HEAD} ok {chat.BODY}"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_chats(rows))


@query
def op9_pii(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op10_mix(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lowered = [F.translate("text", urls.CAPITALS, urls.SMALL) if c == "text" else F.col(c) for c in merkle.FIELDS]
    is_tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = merkle.manifest(docs, beside={"tampered": F.when(is_tampered, merkle.leaf_hash(lowered))})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof"))
    digests = {"leaf": F.col("leaf"), "subroot": F.col("subroot"), "root": F.col("root"), "folded_root": folded, "proof_sha256": merkle.proof_hash(F.col("proof"))}
    rows = found.select(F.col("id").alias("doc_id"), *(merkle.hex_text(v).alias(k) for k, v in digests.items()))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_centroids(spark, sf_dir):
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


URL_BLOCK, URL_ALLOW = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]


@query
def op13_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.entries(spark, URL_BLOCK, URL_ALLOW)).drop("url")
