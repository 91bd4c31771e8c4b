"""Mixing to target weights with soft domain membership.

A naive Bayes classifier, learned from a labelled table, gives each document a posterior
over domains from its binned statistics and from how many words typical of each domain
it holds. Document rates r between 0 and `most` are then fitted so that the expected
token totals of the domains, sum of r * tokens * posterior, come as near to the targets as
such rates can: projected gradient on the squared error, scaled by the inverse second moment
of the posteriors, until the gradient vanishes. Each step is one pass over the documents; the
driver holds a vector with one number per domain, and a document's rate follows from it alone.
"""

from dataclasses import dataclass
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.quality import bin_of
from emberlog.llm.staging import written
from emberlog.llm.statistics import SYMBOLS, let, lines_with_words

#: At most this many labelled rows are learned from, the first by hash of the id.
LABELLED_ROWS = 20_000
BINS = 8
#: Words typical of a domain: at most this many per domain, in this many documents, with these log-odds.
TYPICAL = 400
TYPICAL_DOCUMENTS = 5
TYPICAL_ODDS = 2.0
BEGINNING = 4
OUTSIDE_WORDS = "[\\x20\\x09-\\x0D.,;:!?\"'()|]+"
#: Weights, in wished tokens, of the pull towards full rates: each warms up the next, the last one counts.
PULLS = (1e-2, 1e-6)
#: A fit ends when no part of the gradient is larger, in wished tokens.
TOLERANCE = 1e-9
STEPS = 50
#: Lengths tried at once; if none is better, much shorter ones are.
LENGTHS = (1.0, 0.3, 0.05)
SHORTEST = 1e-6

RATES = ("chars_per_word", "symbol_rate", "dup_line_rate", "distinct_rate")


def _described(docs: DataFrame, keep: list[str]) -> DataFrame:
    """`keep` of `docs` with tokens, rates and `forms`.

    Tokens are words cut at spaces and punctuation. Forms are the set of words in lower
    case, and of their beginnings marked by *.
    """
    text = F.coalesce("text", F.lit(""))

    def of_words(words: Column) -> Column:
        return let(F.array_distinct(words), lambda distinct: of_sets(words, distinct))

    def of_sets(words: Column, distinct: Column) -> Column:
        beginnings = F.transform(distinct, lambda w: F.concat(F.left(w, F.lit(BEGINNING)), F.lit("*")))
        return let(
            lines_with_words(text),
            lambda lines: F.struct(
                F.size(words).cast("long").alias("tokens"),
                F.char_length(text).alias("chars"),
                F.size(distinct).alias("distinct"),
                F.regexp_count(text, F.lit(SYMBOLS)).alias("symbols"),
                F.size(lines).alias("lines"),
                F.size(F.array_distinct(lines)).alias("distinct_lines"),
                F.concat(distinct, F.array_distinct(beginnings)).alias("forms"),
            ),
        )

    words = F.array_remove(F.split(F.lower(text), OUTSIDE_WORDS, -1), "")
    counted = docs.select(*keep, let(words, of_words).alias("s")).select(*keep, "s.*")

    def rate(part: Column, whole: str) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), F.col(whole)), F.lit(0.0))

    return counted.select(
        *keep,
        "tokens",
        "forms",
        rate(F.col("chars"), "tokens").alias("chars_per_word"),
        rate(F.col("symbols"), "chars").alias("symbol_rate"),
        rate(F.col("lines") - F.col("distinct_lines"), "lines").alias("dup_line_rate"),
        rate(F.col("distinct"), "tokens").alias("distinct_rate"),
    )


@dataclass(frozen=True)
class Classifier:
    """Naive Bayes over binned features: log-probabilities by domain, feature and bin."""

    domains: tuple[str, ...]
    cuts: dict[str, list[float]]
    typical: tuple[tuple[str, ...], ...]
    prior: tuple[float, ...]
    table: dict[tuple[int, str, int], float]

    def binned(self, described: DataFrame, keep: list[str]) -> DataFrame:
        """`keep` of a described table, with a bin for each feature."""
        # A list of literals is one hash set for all rows, unlike an array of them.
        known = sorted({form for forms in self.typical for form in forms})
        hits = F.filter("forms", lambda form: form.isin(known)) if known else F.array().cast("array<string>")
        few = described.select(*keep, *[bin_of(F.col(r), self.cuts[r]).alias(r) for r in RATES], hits.alias("hits"))
        # Few forms are typical of anything; which domain they speak for is looked up among those alone.
        typical = [
            F.least(F.size(F.array_intersect("hits", _listed(forms))), F.lit(BINS - 1)).alias(f"typical_{k}")
            for k, forms in enumerate(self.typical)
        ]
        return few.select(*keep, *RATES, *typical)

    def posterior(self) -> Column:
        """An array of probabilities, one per domain, from bin columns."""
        scores = []
        for k in range(len(self.domains)):
            total = F.lit(self.prior[k])
            for name in self.features():
                per_bin = F.array(*[F.lit(self.table[k, name, b]) for b in range(BINS)])
                total = total + F.get(per_bin, F.col(name))
            scores.append(total)
        if len(scores) == 1:
            return F.array(F.lit(1.0))

        def softmax(s: Column) -> Column:
            return let(F.array_max(s), lambda top: let(F.transform(s, lambda x: F.exp(x - top)), _normal))

        return let(F.array(*scores), softmax)

    def features(self) -> list[str]:
        return [*RATES, *(f"typical_{k}" for k in range(len(self.typical)))]


def _listed(forms) -> Column:
    return F.array(*map(F.lit, forms)) if forms else F.array().cast("array<string>")


def _normal(values: Column) -> Column:
    return let(F.aggregate(values, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(values, lambda x: x / total))


def learn(docs: DataFrame, labelled: DataFrame, limit: int = LABELLED_ROWS) -> Classifier:
    """A classifier from at most `limit` rows of `labelled` (doc_id, domain); of several domains the smallest counts."""
    chosen = (
        labelled.where("doc_id is not null and domain is not null")
        .groupBy("doc_id")
        .agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One half tells which words are typical, the other how often they and the rest occur.
    rows = written(_described(texts, ["doc_id", "domain"]).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2))), "mixing")
    counts = {(r["domain"], r["half"]): r["count"] for r in rows.groupBy("domain", "half").count().collect()}
    domains = tuple(sorted({d for d, _ in counts}))
    if not domains:
        return Classifier((), {r: [] for r in RATES}, (), (), {})
    first_half = {d: counts.get((d, 0), 0) for d in domains}
    typical = _typical_forms(rows.where("half = 0"), domains, first_half) if len(domains) > 1 else tuple(() for _ in domains)
    grid = rows.select(*[F.percentile_approx(r, [i / BINS for i in range(1, BINS)], 10_000).alias(r) for r in RATES]).first()
    cuts = {r: sorted({c for c in grid[r] or () if c is not None}) for r in RATES}
    plain = Classifier(domains, cuts, typical, (), {})
    cells = (
        plain.binned(rows.where("half = 1"), ["domain"])
        .unpivot("domain", plain.features(), "feature", "bin")
        .groupBy("domain", "feature", "bin")
        .count()
        .collect()
    )
    seen = {(r["domain"], r["feature"], r["bin"]): r["count"] for r in cells}
    table = {}
    for k, domain in enumerate(domains):
        size = counts.get((domain, 1), 0)
        for name in plain.features():
            for b in range(BINS):
                table[k, name, b] = log((seen.get((domain, name, b), 0) + 0.5) / (size + 0.5 * BINS))
    total = sum(counts.values())
    prior = tuple(log(sum(counts.get((d, h), 0) for h in (0, 1)) / total) for d in domains)
    return Classifier(domains, cuts, typical, prior, table)


def _typical_forms(rows: DataFrame, domains: tuple[str, ...], sizes: dict[str, int]) -> tuple[tuple[str, ...], ...]:
    every = sum(sizes.values())
    columns = [F.count_if(F.col("domain") == d).alias(f"d{k}") for k, d in enumerate(domains)]
    counts = rows.select("domain", F.explode("forms").alias("form")).groupBy("form").agg(*columns)
    found = []
    for k, domain in enumerate(domains):
        mine = F.col(f"d{k}")
        rest = sum((F.col(f"d{j}") for j in range(len(domains)) if j != k), F.lit(0))
        odds = F.log((mine + 0.5) / (sizes[domain] + 1)) - F.log((rest + 0.5) / (every - sizes[domain] + 1))
        top = (
            counts.where(mine >= TYPICAL_DOCUMENTS)
            .select("form", odds.alias("odds"), mine.alias("n"))
            .where(F.col("odds") >= TYPICAL_ODDS)
            .orderBy(F.desc("odds"), F.desc("n"), "form")
            .limit(TYPICAL)
            .collect()
        )
        found.append(tuple(r["form"] for r in top))
    return tuple(found)


def _pass(members: DataFrame, trials: list[np.ndarray], targets: np.ndarray, most: float, ridge: float):
    """The objective, gradient, curvature and domain totals at each of some vectors, from one pass over the documents."""
    k = len(targets)
    mass = F.col("tokens").cast("double")
    share = [F.get("shares", F.lit(i)) for i in range(k)]
    sums = []
    for z in trials:
        drop = sum((share[i] * F.lit(float(z[i])) for i in range(k)), F.lit(0.0))
        inside = F.least(F.lit(most), F.greatest(F.lit(0.0), drop))
        # What the rates add up to on the way from 0 to the vector.
        way = most * F.least(drop, F.lit(0.0)) + most * inside - inside * inside / 2
        free = ((drop > 0) & (drop < most)).cast("double")
        sums += [F.sum(mass * way)] + [F.sum(mass * (most - inside) * share[i]) for i in range(k)]
        sums += [F.sum(mass * free * share[i] * share[j]) for i in range(k) for j in range(k)]
    found = [float(x or 0.0) for x in members.agg(*[x.alias(f"s{n}") for n, x in enumerate(sums)]).first()]
    out = []
    for n, z in enumerate(trials):
        own = np.array(found[n * (1 + k + k * k) : (n + 1) * (1 + k + k * k)])
        totals, second = own[1 : k + 1], own[k + 1 :].reshape(k, k)
        value = ridge * z @ z / 2 + targets @ z - own[0]
        out.append((value, ridge * z - (totals - targets), second + ridge * np.eye(k), totals))
    return out


def fit_rates(members: DataFrame, targets: list[float], most: float = 1.0) -> tuple[list[float], list[float]]:
    """A vector that gives each document its rate, and the domain totals reached.

    `members` has tokens (long) and shares (the posterior, one number per target). The gradient of
    the squared error with respect to a document's rate is its tokens times the product of its
    shares and the gap of the totals. Gradient steps are added up in one vector; a rate is `most`
    less the product of the shares and that vector, projected onto 0 to `most`. At the optimum the
    vector is the gap divided by RIDGE of the wished tokens, the weight of a pull towards `most`
    that makes the optimum unique. Steps are scaled by the second moment of the shares of documents
    free to move, several lengths are tried in one pass and the best is taken, first with a strong
    pull and then with weaker ones, each until the gradient vanishes.
    """
    wanted = np.array(targets, float)
    size = max(1.0, float(wanted.sum()))
    z = here = None
    for before, strength in zip((None, *PULLS), PULLS):
        # Targets that can be met keep the vector as the pull weakens, others keep the gap.
        starts = [np.zeros(len(targets))] if before is None else [z, z * (before / strength) ** 0.5, z * (before / strength)]
        tried = _pass(members, starts, wanted, most, strength * size)
        best = min(range(len(starts)), key=lambda n: tried[n][0])
        z, here = starts[best], tried[best]
        shorter = 1.0
        for _ in range(STEPS):
            value, gradient, curvature, _totals = here
            if np.abs(gradient).max() <= TOLERANCE * size:
                break
            step = shorter * np.linalg.solve(curvature, gradient)
            trials = [z - length * step for length in LENGTHS]
            tried = _pass(members, trials, wanted, most, strength * size)
            best = min(range(len(LENGTHS)), key=lambda n: tried[n][0])
            if tried[best][0] < value:
                z, here, shorter = trials[best], tried[best], 1.0
            elif shorter > SHORTEST:
                shorter *= LENGTHS[-1] / 2
            else:
                break  # as exact as sums of doubles allow
    return z.tolist(), here[3].tolist()


def rate(vector: list[float], most: float) -> Column:
    """A document's rate under a fitted vector."""
    drop = sum((F.get("shares", F.lit(i)) * F.lit(x) for i, x in enumerate(vector)), F.lit(0.0))
    return F.lit(float(most)) - F.least(F.lit(float(most)), F.greatest(F.lit(0.0), drop))


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    keep: list[str],
    budget: float | None = None,
    most: float = 1.0,
    limit: int = LABELLED_ROWS,
) -> DataFrame:
    """`keep` of `docs` with tokens, posterior (map of domain to probability), rate and target.

    `weights` gives each domain's wished share of the tokens; domains of `labelled` that it
    lacks get none. The budget is in expected tokens; without one it is what the domain of the
    largest share fills at rate `most`. A domain that has less than its share is wished for as
    a whole, so a scarce one never makes the mix small. `target` maps domains to wished
    expected tokens.
    A null text has no tokens. Without any label, every document has the rate `most` and
    an empty posterior.
    """
    found = learn(docs, labelled, limit)
    described = _described(docs, keep)
    if not found.domains:
        nothing = F.create_map().cast("map<string,double>")
        return described.select(
            *keep, "tokens", nothing.alias("posterior"), F.lit(float(most)).alias("rate"), nothing.alias("target")
        )
    binned = found.binned(described, [*keep, "tokens"])
    members = written(binned.select(*keep, "tokens", found.posterior().alias("shares")), "members")
    k = len(found.domains)
    there = members.agg(*[F.sum(F.col("tokens") * F.get("shares", F.lit(i))) for i in range(k)]).first()
    available = [most * float(x or 0.0) for x in there]
    asked = [max(0.0, weights.get(d, 0.0)) for d in found.domains]
    total = sum(asked) or 1.0
    shares = [w / total for w in asked]
    if budget is None:
        main = max(range(k), key=lambda i: shares[i])
        budget = available[main] / shares[main] if shares[main] > 0 else 0.0
    targets = [min(budget * w, a) for w, a in zip(shares, available)]
    vector, _ = fit_rates(members, targets, float(most))
    names = F.array(*map(F.lit, found.domains))
    return members.select(
        *keep,
        "tokens",
        F.map_from_arrays(names, "shares").alias("posterior"),
        rate(vector, most).alias("rate"),
        F.map_from_arrays(names, F.array(*map(F.lit, targets))).alias("target"),
    )


def copies(rate_: Column, key: Column, seed: int = 42) -> Column:
    """How often a document goes into the mix: its rate, rounded up or down at random by its key.

    Rows of one key are drawn alike, so the key should be a hash of the whole row: ids may repeat or be null.
    """
    chance = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate_) + (chance < rate_ - F.floor(rate_)).cast("long")).cast("int")
