"""The pipeline against what its stages must do, by plain loops over the smallest tables."""

import random
from collections import Counter

import duckdb
import numpy as np
import plain
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from emberlog.llm import mixing
from emberlog.llm.jaccard import row_hash
from emberlog.llm.queries import WEIGHTS, domains
from emberlog.llm.staging import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def run_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "test")
        seen.append(docs)
    return seen


@pytest.mark.parametrize("kind", ["corners", "given"])
def test_each_stage_does_its_work(spark, corner_dir, kind):
    folder = corner_dir if kind == "corners" else "/root/testdata/sf0.001"
    tables = run_stages(spark, folder)
    assert all(t.columns == COLUMNS for t in tables[:-1])
    rows = [{r["doc_id"]: r["text"] for r in t.collect()} for t in tables]
    for before, after in zip(rows, rows[1:]):
        assert set(after) <= set(before)
        assert all(before[d] == text for d, text in after.items())
    counts = plain.quality_counts(rows[0].items())
    assert not [d for d in rows[1] if counts[d][-1]]
    groups = plain.jaccard_components(rows[1].items())
    assert set(rows[2]) == {d for d, (_, first) in groups.items() if first == d}
    items = duckdb.sql(f"SELECT item_id, text FROM '{folder}/benchmark.parquet'").fetchall()
    leaked = {d for d, *_ in plain.leaks(rows[2].items(), items)}
    assert set(rows[3]) == set(rows[2]) - leaked
    assert set(rows[5]) == set(rows[4])
    last = tables[-1].collect()
    per_shard = [sum(r["shard"] == s for r in last) for s in range(16)]
    assert max(per_shard) - min(per_shard) <= 1


def test_pipeline_of_empty_tables(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_near_duplicates_are_judged_row_by_row(spark):
    dice = random.Random(11)
    a, b, c, d, e, f, g = (" ".join(f"w{dice.randrange(5000)}" for _ in range(120)) for _ in range(7))
    rows = [
        *[(3, a), (7, a), (7, b), (None, a + " tail")],
        *[(9, c), (9, c + " tail")],
        *[(None, d), (None, d + " tail"), (None, d)],
        *[(11, e), (11, e), (12, f), (12, g), (13, ""), (None, None)],
    ]
    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars int")
    found = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert set(found.values()) == {1}
    assert {(3, a), (7, b), (11, e), (12, f), (12, g), (13, ""), (None, None)} <= set(found)
    assert len(found) == 9 and sum(i == 9 for i, _ in found) == 1
    assert sum(i is None and (t or "").startswith(d) for i, t in found) == 1


def least_error(tokens, shares, targets, steps=20_000):
    """The least squared error that rates from 0 to 1 can reach, by plain accelerated gradient steps in numpy."""
    mass, wanted = tokens[:, None] * shares, np.array(targets)
    curvature = np.linalg.eigvalsh(mass.T @ mass).max()
    rates = moved = np.ones(len(tokens))
    pace, best = 1.0, np.inf
    for _ in range(steps):
        new = np.clip(moved - mass @ (mass.T @ moved - wanted) / curvature, 0, 1)
        if (moved - new) @ (new - rates) > 0:
            pace, moved = 1.0, new
        else:
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            moved, pace = new + (pace - 1) / faster * (new - rates), faster
        rates = new
        best = min(best, np.linalg.norm(mass.T @ rates - wanted) / wanted.sum())
    return best


def posteriors(found, described):
    """Naive Bayes in plain Python from a classifier's tables and a document's rates and forms."""
    bins = [sum(cut < described[r] for cut in found.cuts[r]) for r in mixing.RATES]
    bins += [min(len(set(described["forms"]) & set(forms)), mixing.BINS - 1) for forms in found.typical]
    logs = [p + sum(found.table[k, name, b] for name, b in zip(found.features(), bins)) for k, p in enumerate(found.prior)]
    weights = np.exp(np.array(logs) - max(logs))
    return weights / weights.sum()


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_mixing_stage_draws_at_the_best_rates(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    keyed = docs.withColumn("row_key", row_hash(docs))
    rows = mixing.mix(keyed, domains(labels), WEIGHTS, ["doc_id", "row_key"]).collect()
    names = sorted(WEIGHTS)
    tokens = np.array([r["tokens"] for r in rows], float)
    shares = np.array([[r["posterior"][d] for d in names] for r in rows])
    there = tokens @ shares
    budget = there[names.index("clean")] / WEIGHTS["clean"]
    targets = [min(budget * WEIGHTS[d], t) for d, t in zip(names, there)]
    assert [rows[0]["target"][d] for d in names] == pytest.approx(targets)
    rates = np.array([r["rate"] for r in rows])
    gap = (tokens * rates) @ shares - targets
    error = np.linalg.norm(gap) / sum(targets)
    assert 0 <= rates.min() and rates.max() <= 1
    assert error <= least_error(tokens, shares, targets, 20_000 if sf == "0.01" else 3_000) + 0.001
    # The optimum's own condition, and a bound on what any other rates could gain.
    assert rates == pytest.approx(np.clip(1 - shares @ gap / (mixing.PULLS[-1] * sum(targets)), 0, 1), abs=1e-3)
    best = ((shares @ gap) < 0) * tokens
    assert gap @ ((tokens * rates) @ shares - best @ shares) <= 1e-6 * sum(targets) ** 2
    # A document is drawn if the low 30 bits of the hash of its row fall below its rate.
    seed = xxhash.xxh64_intdigest((42).to_bytes(4, "little"), 42)
    chance = {r["doc_id"]: xxhash.xxh64_intdigest(r["row_key"].to_bytes(8, "little", signed=True), seed) % 2**30 / 2**30 for r in rows}
    wanted = {r["doc_id"] for r, rate in zip(rows, rates) if chance[r["doc_id"]] < rate}
    drawn = {r["doc_id"] for r in corpus_pipeline.mixing(spark, docs, folder).select("doc_id").collect()}
    assert drawn == wanted
    clean = {r["doc_id"] for r in domains(labels).where("domain = 'clean'").collect()} & set(chance)
    assert len(clean - drawn) <= 0.05 * len(clean)


def test_posteriors_are_naive_bayes(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = mixing.learn(docs, domains(labels))
    got = {r["doc_id"]: r["posterior"] for r in mixing.mix(docs, domains(labels), WEIGHTS, ["doc_id"]).collect()}
    for r in mixing._described(docs, ["doc_id"]).collect():
        assert [got[r["doc_id"]][d] for d in found.domains] == pytest.approx(posteriors(found, r).tolist(), abs=1e-9)


def test_rows_without_an_id_are_drawn_one_by_one(spark, monkeypatch):
    """A third of the rows have no id, a third share one; at half rates about half of each are drawn."""
    def half(docs, labelled, weights, keep):
        return docs.select(*keep, F.lit(0.5).alias("rate"))

    monkeypatch.setattr(corpus_pipeline, "mix", half)
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, *_: spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i}", 1.0, i) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rate double, row_key int")
    drawn = corpus_pipeline.mixing(spark, docs, "")
    assert drawn.columns == docs.columns
    counts = Counter(r["row_key"] % 3 for r in drawn.collect())
    assert all(230 < counts[k] < 370 for k in range(3))


@pytest.mark.parametrize("number", [0, 2, 3, 4])
def test_stages_take_any_rows_and_columns(spark, corner_dir, number):
    """Null and repeated ids, null and empty texts, repeated rows and clashing columns."""
    name, stage = corpus_pipeline.STAGES[number]
    base = spark.read.parquet(f"{corner_dir}/documents.parquet")
    odd = base.union(base.limit(5)).union(base.select(F.lit(None).cast("long"), "text", "lang", "source", "n_chars"))
    clashing = {c: F.lit(1) for c in ("row", "kept", "rule", "matches", "rate", "tokens", "posterior", "row_key", "n_words", "bad")}
    odd = odd.withColumns(clashing)
    result = written(stage(spark, odd, corner_dir), "test")
    assert result.columns[: len(odd.columns)] == odd.columns
    before, after = (Counter(tuple(r)[: len(odd.columns)] for r in t.collect()) for t in (odd, result))
    assert after <= before
    if name == "sharding":
        assert after == before
    if name == "benchmark decontamination":
        assert sum(n for r, n in after.items() if not r[1]) == sum(n for r, n in before.items() if not r[1])
