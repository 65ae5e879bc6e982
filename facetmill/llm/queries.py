"""The operators over their whole tables, with the columns their contracts name."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetmill.session import materialise

from . import bpe, decontamination, extraction, fingerprints, langid, licenses, manifest, neardup, packing, runs, secrets, toxicity, urls
from .batches import let


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    """crc32 of doc_id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(_table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    starts = F.transform("base_places", lambda x: x["start"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(materialise(pieces, "token-pieces"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return found.select(
        "doc_id",
        *[secrets.counted(kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS],
        F.sha2(secrets.listed(secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.listed(secrets.KINDS).alias("spans"),
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(_remainder(3) != 1)
    scorer = toxicity.learn(docs, labels, toxicity.costs(toxicity.trigram_counts(docs)))
    found = toxicity.score(docs, scorer, keep=["doc_id"])
    return found.select(
        "doc_id",
        (_remainder(3) == 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urls.train(urls.training_table(spark))
    judged = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), weights, keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op7_document_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    order = fingerprints.with_next(docs)
    # What the document before this one takes of it: as many characters as it replaces, and its digests.
    wants = order.join(docs.select("doc_id", F.floor(F.char_length("text") / 4).cast("int").alias("cut")), "doc_id")
    wants = wants.select(F.col("next").alias("doc_id"), F.col("doc_id").alias("before"), "cut")
    heads = docs.join(wants, "doc_id").select(
        F.col("before").alias("doc_id"), "cut", F.substr("text", F.lit(1), F.col("cut")).alias("head"), fingerprints.digests(F.col("text")).alias("next_digests")
    )
    # Both joins read the same columns of docs, so the texts are dealt out once.
    joined = docs.join(heads, "doc_id").withColumn("n_chars", F.char_length("text"))
    joined = joined.withColumn("edited", F.concat(F.substr("text", F.lit(1), F.col("n_chars") - F.col("cut")), F.col("head")))
    ready = joined.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.digests(F.col("text")).alias("own"),
        fingerprints.digests(F.col("edited")).alias("changed"),
        "next_digests",
    )
    return ready.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.as_text(F.col("own")).alias("fingerprint"),
        fingerprints.as_text(F.col("changed")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        fingerprints.likeness(F.col("own"), F.col("next_digests")).alias("near_next"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    field = langid.train(docs.filter(_remainder(4) != 2))
    found = langid.identify(docs.drop("lang"), field, keep=["doc_id"])
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontamination.scan_documents(docs, _table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = decontamination.hit_words()
    return scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


# The fields of a document's leaf, in the order in which they are hashed.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = manifest.leaf_digest([lower if c == "text" else F.col(c) for c in LEAF_FIELDS])
    # The leaf as it is found later: that of a tampered text, or null where nothing was touched.
    leaves = manifest.leaves_of(docs, LEAF_FIELDS, tampered=F.when(_remainder(3) == 0, changed))
    built = manifest.build(leaves).withColumn("found", F.coalesce("tampered", "leaf"))
    proof = F.sha2(manifest.proof(F.col("path")), 256).alias("proof_sha256")
    return manifest.verified(built, "found").select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", "verified")


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return bpe.decode(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _planted(text: Column) -> Column:
    """The text whose words from a on repeat p of them, for documents whose checksum ends in 0: a and p follow from it."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(checksum / 10)
        first = (g % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < first, x).otherwise(F.get(w, first + (i - first) % period))), " ")

    return F.when((checksum % 10 == 0) & (F.size(words) > 0), let(words, repeated)).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", _planted(F.coalesce("text", F.lit(""))).alias("text"))
    found = runs.collapse_runs(docs, keep=["doc_id"])
    # The smallest of these is the longest run; of equal ones the first, of those the shorter period.
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", F.array_min(ranked)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        (-best["shorter"]).alias("length"),
        best["period"].alias("period"),
        F.floor(-best["shorter"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_license_scan,
        op3_best_fit_packing,
        op4_secret_scan,
        op5_toxicity,
        op6_url_filter,
        op7_document_fingerprint,
        op8_language_id,
        op9_benchmark_decontamination,
        op10_html_extraction,
        op11_merkle_manifest,
        op12_bpe_codec,
        op13_periodic_runs,
    )
}
