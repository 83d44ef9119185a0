"""The queries of this subpackage: each applies an operator to a whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daysync.llm import bpe, chat, exact, html, lattice, minhash, packing, phrases, pii, quality, secrets, sql, whiten, winnow
from daysync.llm.common import table


#: The vocabulary of the queries; the operators take any file of its form.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op2_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lattice.near_vectors(table(spark, sf_dir, "embeddings"), least=0.93)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op3_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digests(block, ids, offsets, encoder):
        decimals = [str(k).encode() for k in range(len(encoder.vocabulary.token_bytes))]
        ids, bounds = ids.tolist(), offsets.tolist()
        coded, decoded = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            own = ids[a:b]
            coded.append(hashlib.sha256(b",".join([decimals[k] for k in own])).hexdigest())
            decoded.append(hashlib.sha256(encoder.decode(own).encode()).hexdigest())
        sizes = pa.array(offsets[1:] - offsets[:-1])
        columns = [block.column("doc_id"), sizes, pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bpe.with_ids(docs, "text", VOCABULARY, digests, schema)


def _written(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_ownership_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    base = F.filter("secrets", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    status = F.transform("secrets", lambda s: s["status"])
    count = lambda values, value: (F.size(values) - F.size(F.array_remove(values, value))).cast("long")
    return found.select(
        F.col("id").alias("doc_id"), *[count(kinds, k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("secrets")).alias("spans"),
        count(status, "live").alias("n_live"), count(status, "example").alias("n_example"),
    )


def op5_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.visible_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_grace_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_groups(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept",
        F.col("sha256").alias("text_sha256"),
    )


def op7_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chat.conversations(table(spark, sf_dir, "conversations"))
    pairs = chat.stale_replies(found).withColumn("n_turns", F.size("chosen"))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return chat.format_preferences(pairs).select(
        F.col("id").alias("conv_id"), "n_turns", "n_common", "prompt", "chosen", spans("chosen_mask").alias("chosen_mask"),
        "rejected", spans("rejected_mask").alias("rejected_mask"), chat.rendered(F.col("after")).alias("after"),
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents"), VOCABULARY)
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


def op9_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs)).select("doc_id", "pii", F.filter("pii", lambda s: s["base"]).alias("base"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, kind)).alias(kind) for kind in pii.KINDS]
    counts = [(F.size("base") - c).cast("long").alias(f"n_{kind}") for c, kind in zip(counts, pii.KINDS, strict=True)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("pii")).alias("spans"))


def _held_out(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0


def op10_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~_held_out("doc_id"))
    found = quality.scored(docs, quality.train(docs, labels))
    return found.select("doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_winnow_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_lattice_near_dedup": op2_lattice_near_dedup,
        "op3_bpe_trie": op3_bpe_trie,
        "op4_ownership_secrets": op4_ownership_secrets,
        "op5_html_layout": op5_html_layout,
        "op6_grace_exact_dedup": op6_grace_exact_dedup,
        "op7_preference_format": op7_preference_format,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_crf_pii": op9_crf_pii,
        "op10_rule_quality": op10_rule_quality,
        "op11_winnow_contamination": op11_winnow_contamination,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_chebyshev_whitening": op13_chebyshev_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return dict(sql.STATEMENTS)
