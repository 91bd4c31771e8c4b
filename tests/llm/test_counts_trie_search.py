"""Token counts, the prefix trie and the lexical search on small hostile inputs."""

import random

import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emberlog.llm import centroids, lexical
from emberlog.llm.ball_tree import BallTree, Best, Rows
from emberlog.llm.lexical import ranked_search
from emberlog.llm.prefix_trie import forked, numbered, prefix_trie
from emberlog.llm.token_counts import Counter, merging_only, whole_tokens, with_token_counts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "a", "b", "'", "'s", "'ll", "'re", "s", "t", " ", "  ", "\n", "\t", "\r\n", "1", "²", "é", "日本", "🎉", "\u00a0", "\u2003",
    "\u0085", "\x1c", "!", "--", "<|endoftext|>", "<|endof", "text|>", "the", "\u0301", "½", "ſ", "'S", "'d've", "\u3000", "\x00", "Ⅷ",
]


@pytest.fixture(scope="module")
def spec():
    with open(TOKENIZER, encoding="utf-8") as file:
        return file.read()


def test_counts_are_the_library_s(spec):
    dice = random.Random(1)
    texts = ["".join(dice.choice(BITS) for _ in range(dice.randint(0, 30))) for _ in range(3000)]
    points = [chr(dice.randrange(0x110000)) for _ in range(3000)]
    points = [p for p in points if not 0xD800 <= ord(p) < 0xE000]
    texts += ["".join(dice.choice(points) + dice.choice(BITS) for _ in range(8)) for _ in range(1000)]
    texts += ["", None, "x" * 100_000, " " * 50_000 + "y"]
    library = Tokenizer.from_str(spec)
    sizes, got, direct = Counter(spec, whole_tokens(spec)).count(pa.array(texts))
    assert got.tolist() == [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert sizes.tolist() == [len((t or "").encode()) for t in texts]
    assert (direct <= got).all() and direct.sum() > 0


def test_proven_strings_are_single_tokens(spec):
    merger, known = merging_only(spec), merging_only(spec).get_vocab_size()
    proven = whole_tokens(spec)
    assert all(len(e.ids) == 1 for e in merger.encode_batch([p.decode() for p in proven]))
    assert 0.9 * known < len(proven) < known


def test_counting_keeps_rows_and_refuses_other_tokenizers(spark, rows_of):
    docs = spark.createDataFrame(
        [(1, "the the", 9), (1, "the the", 9), (None, None, None), (2, "", 1)], "doc_id long, text string, n_tokens int"
    )
    got = with_token_counts(docs.select("doc_id", "text", F.col("n_tokens").alias("n")), TOKENIZER, ["doc_id", "n", "text"])
    assert rows_of(got) == [(None, None, None, 0, 0, 0), (1, 9, "the the", 7, 2, 2), (1, 9, "the the", 7, 2, 2), (2, 1, "", 0, 0, 0)]
    with pytest.raises(ValueError, match="byte-level"):
        with_token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])


def trie_of(log, small):
    conv = F.col("conv_id")
    shared = (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")
    rows = prefix_trie(*forked(numbered(log), conv - conv % 20, shared, 3), small).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[:2])


@pytest.mark.parametrize("small, limit", [(5, 1 << 26), (5, 0), (4096, 1 << 26)])
def test_trie_of_odd_conversations(spark, monkeypatch, small, limit):
    """Null ids, turns, roles and texts, ties, repeated rows, negative ids, a chain, a star; all or nothing on Spark."""
    monkeypatch.setattr(centroids, "BROADCAST_LIMIT_BYTES", limit)
    dice = random.Random(3)
    ids = [None, -41, -40, -20, -1, 0, 1, 2, 3, 5, 20, 21, 22, 25, 39, 40, 45, 60]
    rows = [
        (dice.choice(ids), dice.choice([None, 1, 2, 3, 4, 5]), dice.choice([None, "u", "a"]), dice.choice([None, "", "x y", "z"]))
        for _ in range(150)
    ]
    rows += [(100 + i % 3, j, "u", f"t{j}") for i in range(3) for j in range(120)]
    rows += [(200 + i, 1, "u", "same") for i in range(30)] + rows[:10]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = log.withColumns({"place": F.lit(1), "depth": F.lit("x"), "part": F.lit(None).cast("int")}).repartition(8)
    assert trie_of(log, small) == plain.trie(rows)


def test_a_conversation_is_ordered_over_many_tasks(spark):
    rows = [(0, (j * 7919) % 20_000, "u", "w") for j in range(20_000)] + [(40, 1, "u", "w"), (60, None, None, None)]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = numbered(log)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert turns.where("conv_id = 0").select("part").distinct().count() > 4
    places = sorted(r["place"] for r in turns.where("conv_id = 0").collect())
    assert places == list(range(20_000))


def test_ends_of_a_popular_node_travel_in_chunks(spark, monkeypatch):
    from emberlog.llm import prefix_trie as module

    monkeypatch.setattr(module, "CHUNK_BYTES", 200)
    rows = [(i, 1, "u", "same") for i in range(0, 4000, 20)]
    got = trie_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), 4096)
    assert got == plain.trie(rows)


def test_split_levels_are_few(spark, monkeypatch):
    """A chain of 512 nodes takes logarithmically many levels, not one per node."""
    calls = []
    level = centroids._level
    monkeypatch.setattr(centroids, "_level", lambda *a: calls.append(1) or level(*a))
    rows = [(0, j, "u", f"t{j}") for j in range(300)]
    log = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert trie_of(log, 40) == plain.trie(rows)
    assert 1 <= len(calls) <= 6


def searched(tree, queries, top, keys):
    out = []
    for number, query in enumerate(queries):
        best = Best(top)
        tree.search(number, query, best, keys)
        out.append(list(zip(best.scores.tolist(), best.keys.tolist())))
    return out


@pytest.mark.parametrize("largest", [50, 10**15])
def test_ball_tree_equals_full_scan(largest):
    dice = np.random.default_rng(7)
    sizes = dice.integers(1, 12, 3000)
    terms = np.concatenate([np.sort(dice.choice(400, n, replace=False)) for n in sizes])
    values = dice.integers(1, largest, len(terms))
    rows = Rows(np.append(0, np.cumsum(sizes)), terms, values)
    queries = [np.sort(dice.choice(400, n, replace=False)) for n in (1, 3, 10, 40)]
    keys = dice.permutation(3000)
    tree = BallTree(rows, 400, queries)
    row = np.repeat(np.arange(3000), sizes)
    want = []
    for query in queries:
        total = np.zeros(3000, np.int64)
        np.add.at(total, row[np.isin(terms, query)], values[np.isin(terms, query)])
        order = np.lexsort((keys, -total))[:20]
        want.append([(int(total[i]), int(keys[i])) for i in order if total[i] > 0])
    assert searched(tree, queries, 20, keys) == want
    assert tree.passed > 0 and tree.visited < len(tree.leaves) * len(queries)


def test_bounds_hold_everywhere():
    dice = np.random.default_rng(11)
    sizes = dice.integers(1, 9, 2000)
    terms = np.concatenate([np.sort(dice.choice(90, n, replace=False)) for n in sizes])
    rows = Rows(np.append(0, np.cumsum(sizes)), terms, dice.integers(1, 10**10, len(terms)))
    queries = [np.sort(dice.choice(90, n, replace=False)) for n in (1, 5, 30)]
    tree = BallTree(rows, 90, queries)

    def best_below(node, number):
        if tree.children[node]:
            return max(best_below(c, number) for c in tree.children[node])
        return int(tree.leaves[node].scores(queries[number]).max())

    assert all(best_below(node, q) <= tree.bounds[node][q] for node in range(len(tree.children)) for q in range(len(queries)))


def test_search_with_ties_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TREE_ROWS", 16)
    monkeypatch.setattr(lexical, "TREE_CELLS", 64)
    dice = random.Random(5)
    words = ["a", "B", "c", "ß", "日本", "x1", "of", "of"]
    docs = [(dice.choice([None, *range(60)]), " ".join(dice.choice(words) for _ in range(dice.randint(0, 6)))) for _ in range(150)]
    docs += [(500 + i, "a b") for i in range(60)] + [(7, None), (8, ""), (9, "of " * 4000)]
    items = [(1, "A a of"), (1, "A a of"), (None, "x1 ß nowhere"), (3, None), (4, "..."), (5, "zzz")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit(2)}).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))

    def key(rows):
        return sorted(rows, key=str)

    got = [tuple(r) for r in ranked_search(frame, asked).collect()]
    want = plain.ranks(docs, items)
    # Rows that share id and score may change places.
    assert key(got) == key(want)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 20)
    assert key([tuple(r) for r in ranked_search(frame, asked, 5).collect()]) == key(plain.ranks(docs, items, 5))


def test_lengths_beyond_64_bits():
    lengths, counts = np.array([10**13, 5]), np.array([1, 2])
    got = lexical.impacts(counts, lengths, 10**8, 10**14)
    want = [10**9 * c // (1000 * c + 20 * (50 + 50 * n * 10**8 // 10**14)) for n, c in zip(lengths.tolist(), counts.tolist())]
    assert got.tolist() == want
