"""The operators of this folder over the standard tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.catalog.core import Catalog, table
from sluicework.llm import align, ann, bpe, chat, kneserney, licenses, mixing, pii, repeats, simhash, toxicity, trie, winnowing
from sluicework.llm.common import crc32_mod
from sluicework.session import through_storage

CATALOG = Catalog()


@CATALOG.query("op10_bpe_roundtrip")
def bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text and the text they decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = bpe.round_trip(docs, "text", ranks, public_tokenizers.PATTERN, "ids", "decoded", keep=False)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))

@CATALOG.query("op6_toxic_segments")
def toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every text, learnt from three of four folds of the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marks = table(spark, folder, "labels").where(F.coalesce(crc32_mod(F.col("doc_id"), 4), F.lit(-1)) != 2)
    model = toxicity.fit(docs, marks)
    scored = toxicity.score(docs, model, "text")
    return scored.select(
        "doc_id", F.coalesce(crc32_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size(F.filter("passages", lambda p: p["expected"] <= toxicity.EXPECTED)).cast("long").alias("n_passages"))

@CATALOG.query("op8_simhash_components")
def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and their components under two differing bits."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    prints = simhash.fingerprints(docs, "text", shingle=3, keep=False)
    prints = through_storage(prints.select("doc_id", F.col("fingerprint")[0].alias("fingerprint")), "prints")
    found = simhash.with_components(prints, "doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@CATALOG.query("op1_rotated_codes")
def rotated_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of each hundredth vector."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, F.col("vec_id") % 100 == 0)


@CATALOG.query("op2_source_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document a mix by weights 3, 1, 2 takes."""
    docs, plan, _ = mixing.mixed(table(spark, folder, "documents").select("doc_id", "text", "source"))
    wanted = spark.createDataFrame(
        [(i, int(s), float(t)) for i, (s, t) in enumerate(zip(plan.sizes, plan.targets, strict=True))],
        "source long, source_size long, target double")
    return docs.join(F.broadcast(wanted), "source").select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", "taken", F.col("name").alias("source"))


@CATALOG.query("op7_kneser_ney")
def kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    """log10 probability of every text under a trigram model of four of five folds."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(crc32_mod(F.col("doc_id"), 5) == 1, F.lit(False))
    training = docs.where(~held_out)
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model = kneserney.count_model(training, size, order=3)
    scored = kneserney.score(docs, model, "text", keep=False)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@CATALOG.query("op9_chat_roundtrip", """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, length(text) + length(regexp_replace(text, '[^\\\\]', '', 'g'))
        + CASE WHEN role NOT IN ('user', 'assistant', 'system')
               THEN length(role) + length(regexp_replace(role, '[^\\\\<\\[]', '', 'g')) + 1 ELSE 0 END
        + len(regexp_extract_all(text, '</?s>|\\[/?(?:INST|ANSW|SYST|ROLE)\\]'))
        + CASE role WHEN 'assistant' THEN 15 ELSE 18 END AS size
    FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""")
def chat_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and what is read back from the format."""
    told = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    formatted = chat.format_turns(told.unionByName(extra)).where(F.assert_true("faithful").isNull())
    read = formatted.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
                            chat.parse(F.col("formatted")).alias("turns"))
    all_turns = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.loss_text(F.col("turns"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(all_turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


@CATALOG.query("op5_license_blocks")
def license_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every text."""
    docs = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"), "text", keep=False)
    base = F.filter("matches", lambda m: m["phrase"])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")
    starts = F.transform(base, lambda m: m["start"])
    return docs.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0)).alias("score"))


@CATALOG.query("op4_pii_contexts")
def pii_contexts(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every text: counts and digest of the base spans, and all spans."""
    found = pii.find(table(spark, folder, "documents").select("doc_id", "text"))
    told = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(pii.of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


@CATALOG.query("op3_winnowing")
def winnowing_prints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and their edits, and how alike neighbours are."""
    found = winnowing.compared(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        winnowing.written(F.col("fingerprint")).alias("fingerprint"),
        winnowing.written(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@CATALOG.query("op13_aligned_tokens")
def aligned_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two tokenizers meet in every text, and how common their links are."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    told = align.align(docs, "text", public_tokenizers.path("byte_bpe_50k.json"),
                       public_tokenizers.path("piece_bpe_32k.model"), "told", keep=False)
    groups = F.col("told.groups")
    digest = F.when(groups == "", "").otherwise(F.sha2(groups.cast("binary"), 256))
    stored = through_storage(told.withColumn("told", F.col("told").withField("groups", digest)), "aligned")
    return align.with_counts(stored, "told").withColumnRenamed("groups", "groups_sha256")


@CATALOG.query("op11_prefix_trie", """
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
    SELECT conv_id, turns, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
        lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
            lambda b, y: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384::UBIGINT) ELSE b // 2 END))) % 4 AS h
    FROM own),
rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns
    FROM heads a LEFT JOIN own b ON b.conv_id = a.base),
prefixes AS (
    SELECT conv_id, d, turns[1:d] AS node, len(turns) = d AS ends
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY node, d),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
trie AS (
    SELECT nodes.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d = 0 THEN 0
        ELSE (n_convs - 1) * len(regexp_extract_all(nodes.node[d].text, '[^\\x20\\x09-\\x0D]+')) END AS saved
    FROM nodes LEFT JOIN kids ON kids.node = nodes.node),
totals AS (
    SELECT node[1:up] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT node, n_children, saved, unnest(range(0, d + 1)) AS up FROM trie) GROUP BY 1)
SELECT t.conv_id, t.d::BIGINT AS depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens,
    t.ends_sha256
FROM trie t JOIN totals s ON s.node = t.node LEFT JOIN nodes p ON t.d > 0 AND p.node = t.node[1:t.d - 1]""")
def prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations with its subtree totals."""
    return trie.prefix_trie(table(spark, folder, "conversations"))


@CATALOG.query("op12_repeated_bytes")
def repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every text without the bytes of 200-byte strings that also start elsewhere."""
    cut = repeats.without_repeats(table(spark, folder, "documents").select("doc_id", "text"), "text", 200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
