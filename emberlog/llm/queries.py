"""Each operator applied to its whole table, as a query over the given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm import chat
from emberlog.llm.contamination import with_matches
from emberlog.llm.jaccard import jaccard_components, row_hash
from emberlog.llm.lexical import ranked_search
from emberlog.llm.lines import remove_repeated_lines
from emberlog.llm.mixing import copies, mix
from emberlog.llm.oracles import ORACLES
from emberlog.llm.prefix_trie import forked, numbered, prefix_trie
from emberlog.llm.quality import judge
from emberlog.llm.secrets import RULES, scan_versions, span_text
from emberlog.llm.sharding import shard
from emberlog.llm.substrings import remove_repeated_passages
from emberlog.llm.token_counts import with_token_counts
from emberlog.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 16
#: Wished shares of the tokens, by the domains of `domains`.
WEIGHTS = {"clean": 0.97, "toxic": 0.02, "poor": 0.01}
#: Tokens that a document may have before it counts as over the limit.
TOKEN_LIMIT = 1024
TOKENIZER = "byte_bpe_50k.json"
#: Conversations come in families of so many ids; members share up to FORKED - 1 turns with the first.
FAMILY, FORKED = 20, 4


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, path: str) -> DataFrame:
    """Secrets of every document: base counts, and all spans. Documents come in two rounds; the second
    scans only what the ledger of the first lacks."""
    versions = table(spark, path, "documents").select(F.col("doc_id").alias("path"), "text")
    early = F.pmod(F.xxhash64("path"), F.lit(2)) == 0
    first, ledger = scan_versions(versions.where(early))
    second, _ = scan_versions(versions.where(~early), ledger)
    found = first.unionByName(second)
    base = [rule.name for rule in RULES if rule.base]

    def of_kind(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["rule"] == name)).cast("long")

    return found.select(
        F.col("path").alias("doc_id"),
        *[of_kind(name).alias(f"n_{name}") for name in base],
        F.sha2(span_text(F.filter("spans", lambda s: s["rule"].isin(base))), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op2_toxicity(spark: SparkSession, path: str) -> DataFrame:
    """A toxicity score of every document, learned from labels of those not held out."""
    scored = score_toxicity(table(spark, path, "documents"), table(spark, path, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op3_substring_dedup(spark: SparkSession, path: str) -> DataFrame:
    """Every document without passages of 50 words that one with a smaller id has."""
    kept = remove_repeated_passages(table(spark, path, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def as_events(log: DataFrame, pieces: int = 4) -> DataFrame:
    """An event log that amounts to the turns of `log` (conv_id, turn, role, text).

    An assistant's turn starts as a draft that grows by a delta and is edited, is then regenerated
    and streamed in pieces; a user's is a draft and an edit that ends in the text; others are whole.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.ceil(F.char_length(text) / pieces).cast("int")
    kinds = [(chat.MESSAGE, F.lit("draft ")), (chat.DELTA, F.lit("<|end|>")), (chat.EDIT, F.lit("edited")), (chat.REGENERATE, F.lit(""))]
    kinds += [(chat.DELTA, F.substr(text, F.lit(1) + i * size, size)) for i in range(pieces)]
    said = [(chat.MESSAGE, F.lit("draft")), (chat.EDIT, text)]

    def listed(steps: list) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("step"), F.lit(kind).alias("kind"), t.alias("text")) for k, (kind, t) in enumerate(steps)])

    steps = F.when(F.col("role") == chat.TRAINED, listed(kinds)).when(F.col("role") == "user", listed(said))
    whole = log.where("role is null or role not in ('assistant', 'user')").select(
        "conv_id", F.struct("turn", F.lit(0).alias("step")).alias("seq"), "role", "text",
        F.lit(None).cast("string").alias("kind"), F.lit(None).cast("long").alias("message_id"),
    )
    told = log.where("role in ('assistant', 'user')").withColumn("message_id", F.monotonically_increasing_id())
    told = told.select("conv_id", "turn", "role", "message_id", F.explode(steps).alias("e")).select(
        "conv_id", F.struct("turn", "e.step").alias("seq"), "role", "e.text", "e.kind", "message_id"
    )
    return whole.unionByName(told)


def op4_chat_format(spark: SparkSession, path: str) -> DataFrame:
    """Every conversation, told as an event log, folded, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    log = table(spark, path, "conversations").select(more.columns).unionByName(more)
    formatted = chat.format_conversations(as_events(log))
    read = formatted.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    said_all = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said_all, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op5_line_dedup(spark: SparkSession, path: str) -> DataFrame:
    """Every document without repeated windows of three lines."""
    kept = remove_repeated_lines(table(spark, path, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, path: str) -> DataFrame:
    """Every document with its shard and place in it."""
    text = F.coalesce("text", F.lit(""))
    sizes = table(spark, path, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shard(sizes, SHARDS).select("*", F.lit(None).cast("int").alias("grown_shard"))


def op7_quality_rules(spark: SparkSession, path: str) -> DataFrame:
    """Counts of every document, and the verdict of base and learned rules."""
    judged = judge(table(spark, path, "documents"), table(spark, path, "labels"), ["doc_id"])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "rule")


def op8_jaccard_join(spark: SparkSession, path: str) -> DataFrame:
    """Every document with the group of those that share 80 % of their shingles."""
    return jaccard_components(table(spark, path, "documents"))


def op9_decontamination(spark: SparkSession, path: str) -> DataFrame:
    """Which documents contain which benchmark items."""
    docs = table(spark, path, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, path, "benchmark")).select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", "m.item_id", "m.n_shingles", "m.n_shared")


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of labels: toxic, else poor, else clean."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain"))


def op10_domain_mixing(spark: SparkSession, path: str) -> DataFrame:
    """Posteriors, rate and draw of every document."""
    docs = table(spark, path, "documents")
    keyed = docs.withColumn("row_key", row_hash(docs))
    mixed = mix(keyed, domains(table(spark, path, "labels")), WEIGHTS, ["doc_id", "row_key"])
    return mixed.select(
        "doc_id",
        "tokens",
        *[F.coalesce(F.col("posterior")[d], F.lit(0.0)).alias(f"p_{d}") for d in sorted(WEIGHTS)],
        "rate",
        copies(F.col("rate"), F.col("row_key")).alias("copies"),
    )


def op11_token_counts(spark: SparkSession, path: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it has more than TOKEN_LIMIT tokens."""
    import public_tokenizers

    docs = table(spark, path, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = with_token_counts(docs, public_tokenizers.path(TOKENIZER), ["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op12_prefix_trie(spark: SparkSession, path: str) -> DataFrame:
    """The trie of conversations that take their first turns from the first one of their family."""
    conv = F.col("conv_id")
    shared = (F.crc32(conv.cast("string").cast("binary")) % FORKED).cast("int")
    turns = numbered(table(spark, path, "conversations"))
    return prefix_trie(*forked(turns, conv - conv % FAMILY, shared, FORKED - 1))


def op13_lexical_search(spark: SparkSession, path: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return ranked_search(table(spark, path, "documents"), table(spark, path, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_line_dedup": op5_line_dedup,
    "op6_sharding": op6_sharding,
    "op7_quality_rules": op7_quality_rules,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_decontamination": op9_decontamination,
    "op10_domain_mixing": op10_domain_mixing,
    "op11_token_counts": op11_token_counts,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
}
