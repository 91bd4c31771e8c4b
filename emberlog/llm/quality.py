"""Quality rules as a learned decision list.

Sequential covering over labelled statistics: a rule is grown condition by condition
(feature above or below a threshold) for the labelled documents of low quality that no
earlier rule covers, pruned on held-back rows, and kept if it is precise there. The list
becomes one ordered conditional expression, so scoring is a projection.

The driver sees only counts per feature, bin and label.
"""

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.staging import written
from emberlog.llm.statistics import shape

#: At most this many labelled rows are learned from, the first by hash of the id.
LABELLED_ROWS = 30_000
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 4
#: A rule must be this precise on the rows held back, and cover this many of them.
PRECISION = 0.95
SUPPORT = 3
#: Bad rows, as a share, that a threshold may leave to later rules.
MARGIN = 0.05
MIN_WORDS = 50

RATES = ("chars_per_word", "symbol_rate", "dup_line_rate", "repeat_rate", "capital_rate", "distinct_rate", "words_per_line")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    together = F.lit(True)
    for condition in rule:
        together = together & condition.column()
    return F.coalesce(together, F.lit(False))


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs`, with counts and rates of `text`."""
    counted = docs.select(*keep, shape(F.col("text"), repeats=True).alias("counts")).select(*keep, "counts.*")

    def rate(part: str, whole: str) -> Column:
        return F.try_divide(F.col(part).cast("double"), F.col(whole))

    return counted.withColumns(
        {
            "chars_per_word": rate("word_chars", "n_words"),
            "symbol_rate": rate("n_symbols", "word_chars"),
            "dup_line_rate": rate("n_dup_lines", "n_lines"),
            "repeat_rate": rate("n_repeat_words", "n_words"),
            "capital_rate": rate("n_capitals", "word_chars"),
            "distinct_rate": rate("n_distinct", "n_words"),
            "words_per_line": rate("n_words", "n_lines"),
        }
    )


def labelled_statistics(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """Statistics and `bad` of at most `limit` labelled documents that the base rules let pass.

    Several labels of one document count as bad if any is; null ids and labels don't count.
    """
    clean = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") == 0).cast("int").alias("bad")
    )
    chosen = clean.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # `limit` rows of two numbers: small enough to send to every task. The texts are stored before
    # they are counted, and counts before rows are left out by them: a filter reads only the text,
    # so the optimizer would count all documents on its way to the join.
    texts = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "labelled-texts")
    return written(with_statistics(texts, ["doc_id", "bad"]), "labelled-counts").where(~base_failed())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def bin_of(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts a value is above."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < value)) if cuts else F.lit(0)


def learn_rules(rows: DataFrame) -> list[Rule]:
    """An ordered list of rules for the rows with bad = 1 (columns doc_id, bad and RATES)."""
    grid = rows.select(*[F.percentile_approx(r, [i / BINS for i in range(1, BINS)], 10_000).alias(r) for r in RATES]).first()
    cuts = {r: sorted({c for c in grid[r] or () if c is not None}) for r in RATES}
    # Bin i of a feature holds the values above i of its cuts.
    bins = F.array(*[bin_of(F.col(r), cuts[r]) for r in RATES])
    held_back = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0
    table = written(rows.select("bad", *RATES, bins.alias("bins"), held_back.alias("held_back")), "labelled")
    rules: list[Rule] = []
    open_rows = table
    while len(rules) < MAX_RULES:
        rule = _grown(open_rows.where("not held_back"), cuts)
        rule = _pruned(rule, open_rows.where("held_back")) if rule else ()
        if not rule:
            break
        rules.append(rule)
        open_rows = open_rows.where(~_all(rule))
    return rules


def _grown(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        counts = (
            rows.where(_all(rule))
            .select("bad", F.posexplode("bins").alias("feature", "bin"))
            .groupBy("feature", "bin")
            .agg(F.sum("bad").alias("bad"), F.count("*").alias("rows"))
            .collect()
        )
        table = {(r["feature"], r["bin"]): (r["bad"], r["rows"]) for r in counts}
        all_bad = sum(b for (f, _), (b, _n) in table.items() if f == 0)
        all_rows = sum(n for (f, _), (_b, n) in table.items() if f == 0)
        if not all_bad or all_bad == all_rows:
            break
        best, chosen = 0.0, None
        for f, name in enumerate(RATES):
            bad = rows_below = 0
            for i, cut in enumerate(cuts[name]):
                b, n = table.get((f, i), (0, 0))
                bad, rows_below = bad + b, rows_below + n
                sides = ((False, bad, rows_below), (True, all_bad - bad, all_rows - rows_below))
                for above, p, n in sides:
                    gain = p * (log2(p / n) - log2(all_bad / all_rows)) if p else 0.0
                    if gain > best:
                        best, chosen = gain, Condition(name, above, cut)
        if not chosen:
            break
        rule += (_with_margin(chosen, rows.where(_all(rule))),)
    return rule


def _with_margin(chosen: Condition, rows: DataFrame) -> Condition:
    """The condition with its threshold moved away from the rows it lets go.

    It lies midway between the nearest row on the other side and all but MARGIN of the bad
    rows on its own, so that a good row slightly out of the ordinary isn't caught.
    """
    value, inside = F.col(chosen.feature), chosen.column()
    bad = F.when(inside & (F.col("bad") == 1), value)
    share, near = (MARGIN, F.max(F.when(~inside, value))) if chosen.above else (1 - MARGIN, F.min(F.when(~inside, value)))
    own, other = rows.agg(F.percentile_approx(bad, share, 10_000), near).first()
    return chosen if own is None or other is None else Condition(chosen.feature, chosen.above, (own + other) / 2)


def _pruned(rule: Rule, rows: DataFrame) -> Rule:
    """The prefix of the rule that is best on rows held back, or none if that isn't precise."""
    sums = []
    for k in range(1, len(rule) + 1):
        inside = _all(rule[:k]).cast("int")
        sums += [F.sum(inside * F.col("bad")).alias(f"bad_{k}"), F.sum(inside).alias(f"rows_{k}")]
    counts = rows.agg(*sums).first()
    best, kept = 0.0, ()
    for k in range(1, len(rule) + 1):
        bad, covered = counts[f"bad_{k}"] or 0, counts[f"rows_{k}"] or 0
        if covered >= SUPPORT and bad >= PRECISION * covered:
            worth = (2 * bad - covered) / covered
            if worth > best:
                best, kept = worth, rule[:k]
    return kept


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects a row, from 1; null if none does."""
    if not rules:
        return F.lit(None).cast("int")
    decided = F.when(_all(rules[0]), 1)
    for number, rule in enumerate(rules[1:], 2):
        decided = decided.when(_all(rule), number)
    return decided.cast("int")


def judge(docs: DataFrame, labels: DataFrame, keep: list[str], limit: int = LABELLED_ROWS) -> DataFrame:
    """`keep` of `docs` with its statistics, base_failed, the rejecting `rule` and `kept`.

    A null text counts as empty and fails the base rules. Without labels, or with labels of
    one kind only, no rule is learned and the base rules alone decide.
    """
    rules = learn_rules(labelled_statistics(docs, labels, limit))
    scored = with_statistics(docs, keep).withColumns({"base_failed": base_failed(), "rule": verdict(rules)})
    return scored.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
