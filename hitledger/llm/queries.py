"""The registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from hitledger.llm import (
    bpe, common, divergence, exact_dedup, filter_audit, language, mixing, multiset_hash, ngram_join, pii, ppm, repeats, shards, toxicity,
)
from hitledger.session import scratch_dir

#: Target mix of the ``documents`` table.
MIX = mixing.Mix(
    weights={"domain": {"d0": 5, "d1": 3, "d2": 2}, "language": {"en": 6, "de": 2, "fr": 1, "es": 1}},
    share=(1, 2),
    max_epochs=2,
    seed=17,
    domain="case when source is null then 'd0' else concat('d', ascii(right(source, 1)) % 3) end",
)


def op1_ngram_join(spark, d):
    return ngram_join.near_copies(common.documents(spark, d))


def op2_pii(spark, d):
    return pii.find_personal_data(common.documents(spark, d))


def op3_training_order(spark, d):
    """Shards written, then read back from the first slot on: a row for each sequence."""
    path = f"{scratch_dir(spark, 'shards')}/shards"
    total = shards.write_shards(common.documents(spark, d), path, key=2024)
    found = shards.read_shards(spark, path, total)
    return found.withColumn("tokens_crc32", F.crc32("tokens")).drop("tokens")


def op4_ppm(spark, d):
    """Trained on rows whose crc32 of the id is not 1 modulo 5."""
    return ppm.score_documents(common.documents(spark, d), common.held_out(1, 5))


def op5_suffix_repeats(spark, d):
    return repeats.remove_repeats(common.documents(spark, d))


def op6_multiset_hash(spark, d):
    return multiset_hash.fingerprint_edits(common.documents(spark, d))


def op7_bpe(spark, d):
    return bpe.digest_documents(common.documents(spark, d), public_tokenizers.path("word_bpe_49k.json"))


def op8_source_mix(spark, d):
    chosen = mixing.select_mix(common.documents(spark, d), MIX)
    return chosen.selectExpr("row.doc_id", "domain", "language", "leaf", "epoch", "n_tokens")


def train_languages(docs):
    """Fitted on rows whose crc32 of the id is not 2 modulo 4, by text and label only."""
    return language.LanguageModel.fit(docs.filter(~common.held_out(2, 4)).select("text", "lang"))


def op9_language(spark, d):
    docs = common.documents(spark, d)
    found = language.identify(docs, train_languages(docs))
    return found.withColumn("held_out", common.held_out(2, 4)).select(
        "doc_id", "held_out", "lang_pred", "score", "language_share", "languages"
    )


def op10_exact_dedup(spark, d):
    return exact_dedup.exact_copies(common.documents(spark, d))


def labels(spark, d):
    return spark.read.parquet(f"{d}/labels.parquet")


def op11_toxicity(spark, d):
    """Labels are learned from rows whose crc32 of the id is not 0 modulo 5."""
    docs = common.documents(spark, d)
    model = toxicity.train(docs, labels(spark, d), ~common.held_out(0, 5))
    return toxicity.score(docs, model).select("doc_id", common.held_out(0, 5).alias("held_out"), "score", "predicted")


def op12_source_divergence(spark, d):
    return divergence.source_divergence(common.documents(spark, d))


def op13_filter_audit(spark, d):
    return filter_audit.audit_filters(common.documents(spark, d), labels(spark, d))


def pipeline(spark, d):
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, d)


QUERIES = {
    "pipeline": pipeline,
    "op1_ngram_join": op1_ngram_join,
    "op2_pii": op2_pii,
    "op3_training_order": op3_training_order,
    "op4_ppm": op4_ppm,
    "op5_suffix_repeats": op5_suffix_repeats,
    "op6_multiset_hash": op6_multiset_hash,
    "op7_bpe": op7_bpe,
    "op8_source_mix": op8_source_mix,
    "op9_language": op9_language,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_source_divergence": op12_source_divergence,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES = {
    "op8_source_mix": mixing.mix_sql(MIX) + "\nselect doc_id, domain, language, leaf, cast(epoch as int) as epoch, n_tokens from chosen",
    "op10_exact_dedup": """select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))""",
    "op12_source_divergence": divergence.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
