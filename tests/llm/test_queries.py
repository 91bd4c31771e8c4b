"""Queries against plain loops, on corner cases and on the smallest given tables."""

import zlib

import duckdb
import plain
import pytest

from emberlog.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(params=["corners", "given"])
def folder(request, corner_dir):
    return corner_dir if request.param == "corners" else GIVEN


def rows_of(folder, table, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{table}.parquet'").fetchall()


def documents(folder):
    return rows_of(folder, "documents", "doc_id, text")


def by_id(frame, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


def test_secrets(spark, folder):
    got = by_id(QUERIES["op1_secret_scan"](spark, folder), "n_assign", "n_access", "n_hex", "base_sha256", "spans")
    want = plain.secrets(documents(folder))
    assert {d: r[:4] for d, r in got.items()} == {d: r[:4] for d, r in want.items()}
    for d, r in got.items():
        kept = ",".join(s for s in r[4].split(",") if s.split(":")[0] in plain.KINDS)
        assert kept == want[d][4]


def test_passages(spark, folder):
    got = by_id(QUERIES["op3_substring_dedup"](spark, folder), "n_words", "n_removed", "kept_sha256")
    assert got == plain.passages(documents(folder))


def test_lines(spark, folder):
    got = by_id(QUERIES["op5_line_dedup"](spark, folder), "n_lines", "n_removed", "kept_sha256")
    assert got == plain.lines(documents(folder))


def test_quality_counts(spark, folder):
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    frame = QUERIES["op7_quality_rules"](spark, folder)
    assert by_id(frame, *columns) == plain.quality_counts(documents(folder))
    assert not [r for r in frame.collect() if r["base_failed"] and r["kept"]]


def test_jaccard(spark, folder):
    got = by_id(QUERIES["op8_jaccard_join"](spark, folder), "n_shingles", "component_id")
    assert got == plain.jaccard_components(documents(folder))


def test_leaks(spark, folder):
    found = QUERIES["op9_decontamination"](spark, folder).collect()
    got = sorted(tuple(r) for r in found)
    assert got == plain.leaks(documents(folder), rows_of(folder, "benchmark", "item_id, text"))


def test_chat(spark, folder):
    frame = QUERIES["op4_chat_format"](spark, folder)
    got = {r["conv_id"]: tuple(r)[1:5] for r in frame.collect()}
    said = "</s>[INST] ok [/INST]"
    rows = rows_of(folder, "conversations", "conv_id, turn, role, text")
    assert got == plain.conversations(rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])


def test_sharding(spark, folder):
    rows = QUERIES["op6_sharding"](spark, folder).collect()
    docs = dict(documents(folder))
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    counts = {}
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in counts.values())
    sizes = [len(counts.get(s, ())) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1


def test_toxicity(spark, folder):
    rows = QUERIES["op2_toxicity"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, _ in documents(folder))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == plain.held_out(r["doc_id"]) for r in rows)


def test_mixing(spark, folder):
    rows = QUERIES["op10_domain_mixing"](spark, folder).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, _ in documents(folder))
    assert all(0 <= r["rate"] <= 1 and r["copies"] in (0, 1) for r in rows)


def test_tokens(spark, folder):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for doc, text in documents(folder):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[doc] = (len((text or "").encode()), n, n > 1024)
    assert by_id(QUERIES["op11_token_counts"](spark, folder), "n_bytes", "n_tokens", "over_limit") == want


def test_trie(spark, folder):
    got = sorted((tuple(r) for r in QUERIES["op12_prefix_trie"](spark, folder).collect()), key=lambda r: r[:2])
    assert got == plain.trie(rows_of(folder, "conversations", "conv_id, turn, role, text"))


def test_ranks(spark, folder):
    got = sorted(tuple(r) for r in QUERIES["op13_lexical_search"](spark, folder).collect())
    assert got == sorted(plain.ranks(documents(folder), rows_of(folder, "benchmark", "item_id, text")))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == (1 if name.startswith("op4_") else 0)
