"""Registered queries of this package: thin, over whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import decontaminate as decontamination
from lotwise.llm import exact_dedup as dedup
from lotwise.llm import (conversation_repair, jaccard_join, language_id, near_dedup, periodic_runs,
                         pii, preference, sentencepiece_unigram, sharding, token_counts, url_filter)

#: Vocabulary files, by the name under which the tokenizer package has them.
BPE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # A row without an id has no remainder, so it isn't held out.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = language_id.learn(docs.where(~held_out))
    return language_id.predict(
        docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


#: The rules of the contract of op2.
URL_RULES = [url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
             url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/")]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.learn(pages, URL_RULES)
    return url_filter.judge(pages, URL_RULES, model).drop("url")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.Vocabulary.from_file(_tokenizer_path(BPE_FILE))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, vocabulary)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.byte_shards(_table(spark, sf_dir, "documents"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination.decontaminate(_table(spark, sf_dir, "documents"),
                                        _table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = preference.conversations(_table(spark, sf_dir, "conversations"))
    out = preference.format_preferences(preference.pairs_by_opening(convs), convs)

    def text(col):
        return F.array_join(F.transform(col, lambda s: s["segment"]), "")

    def mask(col):
        return F.array_join(F.transform(col, lambda s: s["train"].cast("int").cast("string")), "")

    return out.select("chosen_id", "rejected_id", "n_prompt_turns", "prompt",
                      text("chosen").alias("chosen_text"), mask("chosen").alias("chosen_mask"),
                      text("rejected").alias("rejected_text"),
                      mask("rejected").alias("rejected_mask"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = sentencepiece_unigram.Pieces.from_file(_tokenizer_path(PIECE_FILE))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_unigram.encode(docs, pieces, decoded_col="decoded")
    return coded.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
        F.xxhash64("piece_ids").alias("ids_hash"),
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), "\u2581", " "))
        .alias("round_trip"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup.exact_dedup(
        _table(spark, sf_dir, "documents"),
        carry={"text_sha256": F.sha2(dedup.normalised(F.col("text")), 256)})
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dedup.near_dedup(_table(spark, sf_dir, "documents"), shingle_words=4)
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
                      .alias("kept"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(_table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, pii.KINDS))
    base = F.filter("spans", lambda s: s["base"])

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)],
                      F.sha2(written(base), 256).alias("base_sha256"),
                      written(F.col("spans")).alias("spans"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"), shingle_words=4, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "class_id", "class_size", "n_links")


def _damaged(convs: DataFrame) -> DataFrame:
    """The rows of the contract of op12, ``copies`` of each."""
    def plain(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn"))) % 20
    return convs.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(plain("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(plain("text"), ".!?", ""))
        .otherwise(plain("text")).alias("text"),
        F.when(fate == 3, 2).otherwise(1).alias("copies")).where(fate != 0)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.transcripts(_damaged(convs), copies_col="copies", known=convs)


def _with_repeats(docs: DataFrame) -> DataFrame:
    """The texts of the contract of op13: in one of ten, the words from a place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string"))
    texts = docs.select("doc_id", "text", h.alias("h"), F.filter(
        F.split("text", r"[ \t-\r]+"), lambda w: w != "").alias("words"))
    texts = texts.select("*", F.size("words").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    texts = texts.select("*", (F.col("g") % F.greatest("n", F.lit(1))).cast("int").alias("a"))
    texts = texts.select("*", (F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
                         .cast("int").alias("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    repeated = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), cycle), F.lit(1), F.col("n"))
    chosen = (F.col("h") % 10 == 0) & (F.col("n") > 0)
    return texts.select("doc_id", F.when(chosen, F.array_join(repeated, " "))
                        .otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs)

    def stronger(best, run):  # an earlier run wins a tie
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)

    found = found.withColumn("best", F.aggregate("runs", F.get("runs", F.lit(0)), stronger))
    line = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_url_filter, op3_token_counts, op4_sharding,
    op5_decontamination, op6_chat_formatting, op7_sentencepiece, op8_exact_dedup, op9_near_dedup, op10_pii,
    op11_jaccard_join, op12_conversation_repair, op13_periodic_runs,
)}
