"""The toxicity lexicon and features against plain loops over strings."""

import random
import re
from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from emberlog.llm import toxicity
from emberlog.llm.toxicity import FEATURES, _features, _terms_of, learn_lexicon, score_toxicity

CUT = re.compile(rb"[^a-z0-9'*@$\x80-\xff]+")
UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in CUT.split((text or "").encode().translate(UPPER)) if w]


def terms_of(text):
    """Words, and their first four bytes as terms of another kind."""
    return [("word", w) for w in words(text)], [("head", w[:4]) for w in words(text)]


def hash_of(term):
    kind, raw = term
    found, heads = _terms_of(pa.array([raw.decode()]))
    return int((found.hashes if kind == "word" else heads)[0])


def lexicon(rows):
    toxic, clean, size = Counter(), Counter(), Counter(label for _, label in rows)
    for text, label in rows:
        for term in set(terms_of(text)[0]) | set(terms_of(text)[1]):
            (toxic if label else clean)[term] += 1
    odds = {t: log((n + 0.5) / (size[1] + 1)) - log((clean[t] + 0.5) / (size[0] + 1)) for t, n in toxic.items() if n >= 3}
    return {t: o for t, o in odds.items() if o >= toxicity.TERM_ODDS}


def features(text, odds):
    text = text or ""
    found, heads = terms_of(text)
    size = max(1, len(text.encode()))
    rate = [sum(c in cs for c in text) / size for cs in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "!?", "0134578*@$")]
    shape = [*rate, log(1 + size)]
    n = len(found)
    if not n:
        return [0.0] * 10 + shape
    weight = [max(odds.get(w, 0.0), odds.get(h, 0.0)) for w, h in zip(found, heads)]
    second = {w.encode() for w in toxicity.SECOND_PERSON}
    address = [i for i, (_, w) in enumerate(found) if w in second]
    hits = [i for i, w in enumerate(weight) if w > 0]
    strong = [w for w in weight if w >= toxicity.STRONG_ODDS]
    near = sum(any(abs(i - j) <= toxicity.NEAR for j in address) for i in hits)
    return [
        len(hits), len(hits) / n, sum(weight), sum(weight) / n, max(weight), len(strong), len(set(strong)), len(strong) / n,
        near, len(address) / n, *shape,
    ]


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(4)
    plain = [f"word{i}" for i in range(60)] + ["you", "Your", "tu", "the", "isn't", "naïve"]
    nasty = ["mor0n", "IDI*T", "idiots", "scum", "scummy"]
    out = []
    for i in range(400):
        label = int(i % 4 == 0)
        text = [dice.choice(plain) for _ in range(dice.randrange(0, 30))]
        if label:
            text += [dice.choice(nasty) for _ in range(dice.randrange(1, 4))]
        dice.shuffle(text)
        out.append((dice.choice([" ", ", ", "! "]).join(text), label))
    return out + [("", 0), ("!!! ???", 1), ("ü", 0)]


def test_lexicon_and_features_are_what_plain_loops_give(spark, rows):
    want = lexicon(rows)
    terms, odds = learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert len(want) > 5 and len(terms) == len(want)
    got = dict(zip(terms.tolist(), odds.tolist()))
    for term, value in want.items():
        assert got[hash_of(term)] == pytest.approx(value)
    texts = [t for t, _ in rows] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["doc_id", "text"])
    (table,) = _features(terms, odds)(iter([batch]))
    found = np.array([table.column(table.schema.get_field_index(name)).to_pylist() for name in FEATURES]).T
    assert found == pytest.approx(np.array([features(t, want) for t in texts], float), abs=1e-9)


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_labels_are_sent_or_joined_alike(spark, monkeypatch, rows, limit):
    monkeypatch.setattr(toxicity, "BROADCAST_LIMIT_BYTES", limit)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, label) for i, (_, label) in enumerate(rows)], "doc_id long, toxic int")
    scored = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels).collect()}
    toxic = [scored[i] for i, (_, label) in enumerate(rows) if label]
    clean = [scored[i] for i, (_, label) in enumerate(rows) if not label]
    assert np.mean(toxic) > 0.8 and np.mean(clean) < 0.1
