"""Secret scans with an incremental blob ledger.

Texts are content-addressed: a blob is the SHA-256 of a text, and every version of a
file that ever had that content points to it. The ledger is a Parquet folder with one
row per (blob, rule, rule version) that was scanned, with the spans found. A scan
looks only at pairs the ledger lacks, appends them, and joins the findings back to all
paths that hold the blob.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.staging import written

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"

#: Blobs to scan are sent to the texts if they are one in so many, and up to so many bytes, of about so many each.
FEW, SENT_BYTES, PAIR_BYTES = 20, 8 << 20, 256


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` whose group `measured` has `least` characters are findings."""

    name: str
    version: int
    pattern: str
    measured: int
    least: int
    base: bool = True
    #: Every match contains this text; texts without it need no regular expression.
    marker: str = ""


#: Fixed values. The first three are the base rules; order is the order of kinds at one start.
RULES = (
    Rule(
        "assign",
        1,
        "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
        "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 18, marker="AKIA"),
    # Runs are maximal, so asking for 16 at once finds those runs of any length that have 16.
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
    Rule("github", 1, "gh[pousr]_[A-Za-z0-9]{36,}", 0, 40, base=False, marker="gh"),
    Rule("slack", 1, "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, base=False, marker="xox"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 20, base=False, marker="eyJ"),
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20, base=False, marker="PRIVATE KEY-----"),
)


def _pieces(rule: Rule) -> Column:
    """Matches of a rule in `text` with the text before each; null when there is none."""
    pattern = F.lit(rule.pattern)
    may = F.col("text").contains(rule.marker) if rule.marker else F.col("text").rlike(rule.pattern)
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda piece: F.char_length(piece))
    whole = F.transform(F.regexp_extract_all("text", pattern, F.lit(0)), lambda match: F.char_length(match))
    measured = (
        F.transform(F.regexp_extract_all("text", pattern, F.lit(rule.measured)), lambda match: F.char_length(match))
        if rule.measured
        else whole
    )
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), measured.alias("measured"))
    return F.when(may, zipped)


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, rule, start, end) of the findings in `blobs` (columns blob, text, todo: names of rules to run)."""
    tried = [
        F.when(
            F.array_contains("todo", rule.name),
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.version).alias("version"),
                F.lit(rule.least).alias("least"),
                _pieces(rule).alias("pieces"),
            ),
        )
        for rule in rules
    ]
    # One row per (blob, rule), then one per match; the start of a match is the length of all before it.
    per_rule = blobs.select("blob", F.explode(F.array(*tried)).alias("found")).where("found is not null")
    return per_rule.select("blob", "found.*").where(F.size("pieces") > 1)


def _spans(scanned: DataFrame) -> DataFrame:
    """Findings as (blob, rule, version, start, end), from the pieces of each text."""
    # A text that stands twice under one path was scanned twice.
    rows = scanned.dropDuplicates(["blob", "rule"]).select("blob", "rule", "version", "least", F.posexplode("pieces").alias("number", "piece"))
    in_order = Window.partitionBy("blob", "rule").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum(F.col("piece.gap") + F.coalesce("piece.whole", F.lit(0))).over(in_order)
    ended = rows.withColumn("end", before.cast("int")).where("piece.whole is not null and piece.measured >= least")
    return ended.select("blob", "rule", "version", (F.col("end") - F.col("piece.whole")).alias("start"), "end")


def scan_versions(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """Findings of all `versions` (columns path, text; others are ignored), and the ledger's new rows.

    `ledger` holds earlier rows (LEDGER); what it has is not scanned again. Returned are
    (path, spans), one row per version, spans ordered by start and then rule and empty where
    nothing was found, and the rows to append to the ledger, already stored. A null text
    counts as empty. Paths may repeat and may be null: each row is answered.
    """
    spark = versions.sparkSession
    texts = versions.select("path", F.coalesce("text", F.lit("")).alias("text"))
    addressed = texts.withColumn("blob", F.sha2("text", 256))
    if ledger is None:
        ledger = spark.createDataFrame([], LEDGER)
    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    known = ledger.join(F.broadcast(_rule_table(spark, rules)), ["rule", "version"]).groupBy("blob").agg(
        F.collect_set("rule").alias("known")
    )
    names = F.transform(wanted, lambda pair: pair["rule"])
    # The smallest hash of a version stands for its blob, so that only one copy of a text moves on.
    copies = addressed.select("blob", F.xxhash64("path", "blob").alias("copy"))
    first = copies.groupBy("blob").agg(F.min("copy").alias("copy"))
    blobs = written(
        first.join(known, "blob", "left").select(
            "blob", "copy", F.array_except(names, F.coalesce("known", F.array().cast("array<string>"))).alias("todo")
        ),
        "blobs",
    )
    todo = blobs.where(F.size("todo") > 0)
    every, unseen_ones = blobs.agg(F.count("*"), F.count_if(F.size("todo") > 0)).first()
    # Where few blobs are unseen they are sent to the texts; only where many are do the texts move.
    few = unseen_ones * FEW <= every and unseen_ones * PAIR_BYTES <= SENT_BYTES
    wanted_ones = F.broadcast(todo) if few else todo.hint("shuffle_hash")
    unseen = (
        addressed.withColumn("copy", F.xxhash64("path", "blob"))
        .join(wanted_ones, ["blob", "copy"])
        .select("blob", "text", "todo")
    )
    spans = _spans(_scan(unseen, rules))
    scanned = todo.select("blob", F.explode("todo").alias("rule")).join(F.broadcast(_rule_table(spark, rules)), "rule")
    found = spans.groupBy("blob", "rule", "version").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    fresh = written(
        scanned.join(found, ["blob", "rule", "version"], "left").select(
            "blob", "rule", "version", F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans")
        ),
        "ledger",
    )
    return _by_path(addressed, ledger.select(fresh.columns).unionByName(fresh), rules), fresh


def _rule_table(spark, rules: tuple[Rule, ...]) -> DataFrame:
    return spark.createDataFrame([(r.name, r.version, i) for i, r in enumerate(rules)], "rule string, version int, rank int")


def _by_path(addressed: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of every path, through its blob."""
    ranks = F.broadcast(_rule_table(addressed.sparkSession, rules))
    hits = ledger.where(F.size("spans") > 0).join(ranks, ["rule", "version"])
    listed = hits.select("blob", "rank", "rule", F.explode("spans").alias("span"))
    per_blob = listed.groupBy("blob").agg(
        F.sort_array(F.collect_set(F.struct("span.start", "rank", "rule", "span.end"))).alias("spans")
    )
    # Stored, so that both sides of the join below are plain shuffles, which Spark can split where a blob has very many paths.
    found = written(per_blob, "findings")
    empty = F.array().cast("array<struct<start:int,rank:int,rule:string,end:int>>")
    return addressed.select("path", "blob").join(found, "blob", "left").select(
        "path", F.coalesce("spans", empty).alias("spans")
    )


def span_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
