"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

Labelled documents are dealt into three parts. The first gives the lexicon: words and word
beginnings, counted over all its documents, whose log-odds speak for toxicity. The second
fits the trees over features that the lexicon gives (densities, closeness to a second
person) and over capitals, punctuation and obfuscation. The third fits the calibration.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.staging import written
from emberlog.llm.words import column, slices, tokens
from emberlog.operators.skew import BROADCAST_LIMIT_BYTES

#: At most this many labelled rows fit the trees and the calibration, first by hash of the id.
LABELLED_ROWS = 40_000
#: At most this many terms are in the lexicon, strongest first.
LEXICON_TERMS = 20_000
#: About what a row of an id and a label takes.
LABEL_BYTES = 64
TERM_DOCUMENTS = 3
TERM_ODDS = 1.5
STRONG_ODDS = 3.0
BEGINNING = 4
NEAR = 6
TREES, DEPTH = 20, 4
SEPARATORS = tuple(b for b in range(128) if not (chr(b).isalnum() or chr(b) in "'*@$"))
#: Second-person words of the corpus languages.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi vous votre ton usted ti tú vos".split()

FEATURES = (
    "terms",
    "term_rate",
    "odds",
    "odds_rate",
    "strongest",
    "strong_terms",
    "strong_distinct",
    "strong_rate",
    "near_second_person",
    "second_person_rate",
    "capital_rate",
    "emphasis_rate",
    "obfuscated_rate",
    "length",
)

_SALT = np.uint64(0x5851F42D4C957F2D)


def _beginnings(texts: pa.Array):
    return tokens(texts, SEPARATORS, lower=True, prefix=BEGINNING)


def _terms_of(texts: pa.Array):
    """Words and their beginnings as hashes; a beginning and a word never share a hash by design."""
    words = tokens(texts, SEPARATORS, lower=True)
    return words, _beginnings(texts).hashes ^ _SALT


def _count_terms(batches):
    """(term, toxic, clean): documents with each term, summed within the batch."""
    for batch in batches:
        texts, label = column(batch, "text"), np.asarray(column(batch, "label"), np.int64)
        terms, votes = [], []
        for lo, hi in slices(texts):
            words, heads = _terms_of(texts.slice(lo, hi - lo))
            for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                own = np.unique(np.concatenate([words.hashes[a:b], heads[a:b]]))
                terms.append(own)
                votes.append(np.full(len(own), label[lo + i]))
        if not terms:
            continue
        term, vote = np.concatenate(terms), np.concatenate(votes)
        unique, inverse = np.unique(term, return_inverse=True)
        toxic = np.bincount(inverse, weights=vote, minlength=len(unique)).astype(np.int64)
        total = np.bincount(inverse, minlength=len(unique))
        yield pa.RecordBatch.from_arrays(
            [pa.array(unique.view(np.int64)), pa.array(toxic), pa.array(total - toxic)], names=["term", "toxic", "clean"]
        )


def learn_lexicon(labelled: DataFrame, limit: int = LEXICON_TERMS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted term hashes and log-odds, at most `limit`, from labelled texts (columns text, label)."""
    totals = labelled.agg(F.sum("label"), F.count("*")).first()
    toxic_docs, docs = totals[0] or 0, totals[1]
    if not toxic_docs or toxic_docs == docs:
        return np.empty(0, np.uint64), np.empty(0)
    counts = labelled.mapInArrow(_count_terms, "term long, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic_docs + 1)) - F.log((F.col("clean") + 0.5) / (docs - toxic_docs + 1))
    top = (
        counts.where(F.col("toxic") >= TERM_DOCUMENTS)
        .select("term", odds.alias("odds"))
        .where(F.col("odds") >= TERM_ODDS)
        .orderBy(F.desc("odds"), "term")
        .limit(limit)
        .collect()
    )
    terms = np.array([r["term"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(terms)
    return terms[order], np.array([r["odds"] for r in top])[order]


def _weights(hashes: np.ndarray, terms: np.ndarray, odds: np.ndarray) -> np.ndarray:
    if not len(terms):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return np.where(terms[at] == hashes, odds[at], 0.0)


def _byte_counts(texts: pa.Array, wanted: str) -> np.ndarray:
    """How many bytes of `wanted` each text has."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    table = np.zeros(256, bool)
    table[[ord(c) for c in wanted]] = True
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(len(texts), np.int64)
    hits = np.concatenate([[0], np.cumsum(table[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]])])
    return np.diff(hits[offsets - offsets[0]])


def _features(terms: np.ndarray, odds: np.ndarray):
    second = np.unique(tokens(pa.array([" ".join(SECOND_PERSON)]), SEPARATORS, lower=True).hashes)

    def one(weight, address):
        n = len(weight)
        if not n:
            return [0.0] * 10
        hit = weight > 0
        strong = weight >= STRONG_ODDS
        near = 0
        if hit.any() and address.any():
            places = np.flatnonzero(address)
            spots = np.flatnonzero(hit)
            after = np.searchsorted(places, spots)
            right = np.abs(places[np.minimum(after, len(places) - 1)] - spots)
            left = np.abs(places[np.maximum(after - 1, 0)] - spots)
            near = int((np.minimum(left, right) <= NEAR).sum())
        total = float(weight.sum())
        return [
            float(hit.sum()),
            float(hit.sum()) / n,
            total,
            total / n,
            float(weight.max()),
            float(strong.sum()),
            float(len(np.unique(weight[strong]))),
            float(strong.sum()) / n,
            float(near),
            float(address.sum()) / n,
        ]

    def task(batches):
        for batch in batches:
            texts = column(batch, "text").fill_null("")
            rows = []
            for lo, hi in slices(texts):
                piece = texts.slice(lo, hi - lo)
                words, heads = _terms_of(piece)
                weight = np.maximum(_weights(words.hashes, terms, odds), _weights(heads, terms, odds))
                address = np.isin(words.hashes, second)
                size = np.maximum(1, np.asarray(pa.compute.binary_length(piece), np.int64))
                shape = np.stack(
                    [
                        _byte_counts(piece, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") / size,
                        _byte_counts(piece, "!?") / size,
                        _byte_counts(piece, "0134578*@$") / size,
                        np.log1p(size),
                    ],
                    1,
                )
                for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
                    rows.append(one(weight[a:b], address[a:b]) + shape[i].tolist())
            table = np.array(rows, float).reshape(-1, len(FEATURES))
            keep = [column(batch, "doc_id")]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(table[:, k]) for k in range(len(FEATURES))], names=["doc_id", *FEATURES]
            )

    return task


def held_out(doc_id) -> "F.Column":
    """Documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(True))


def score_toxicity(docs: DataFrame, labels: DataFrame, limit: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, features…) per row of `docs` (columns doc_id, text; others are ignored).

    `labels` has doc_id and toxic; of several labels of a document the largest counts, null
    ones don't. Where the labels hold no toxic or no clean document, every score is the
    share of toxic ones among them (0 without labels). A null or empty text is scored by its
    features like any other. A null doc_id is held out.
    """
    usable = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("label"))
        .where(~held_out(F.col("doc_id")))
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(10)))
    )
    usable = written(usable, "labels")
    texts = docs.select("doc_id", "text")
    half = usable.where("part < 5")
    # Labels that fit go to the texts; only more of them than that make the texts move.
    half = F.broadcast(half) if half.count() * LABEL_BYTES <= BROADCAST_LIMIT_BYTES else half.hint("shuffle_hash")
    terms, odds = learn_lexicon(texts.join(half, "doc_id").select("text", "label"))
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, " + ", ".join(f"{name} double" for name in FEATURES)
    table = written(texts.mapInArrow(_features(terms, odds), schema), "features")
    chosen = usable.where("part >= 5").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = written(table.join(chosen, "doc_id"), "fitting")
    kinds = rows.groupBy(F.col("part") < 8, "label").count().collect()
    answer = [F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")]
    if len(kinds) < 4:
        share = usable.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        scored = table.withColumn("score", F.lit(float(share)))
    else:
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
        trees = GBTClassifier(
            featuresCol="vector", labelCol="label", maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.2, seed=7,
            minInstancesPerNode=5,
        ).fit(assembler.transform(rows.where("part < 8").withColumn("label", F.col("label").cast("double"))))

        def raw(frame: DataFrame) -> DataFrame:
            return trees.transform(assembler.transform(frame)).withColumn("raw", vector_to_array("probability")[1])

        steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
            raw(rows.where("part >= 8")).select("raw", F.col("label").cast("double").alias("label"))
        )
        scored = steps.transform(raw(table)).drop("vector", "rawPrediction", "probability", "prediction", "raw")
    bounded = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return scored.select(*answer, bounded.alias("score"), (bounded >= 0.5).cast("int").alias("predicted"), *FEATURES)
