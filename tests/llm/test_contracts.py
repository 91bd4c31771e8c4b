"""Names and types of the results that others rely on."""

import pytest

from emberlog.llm.queries import QUERIES

LEADING = {
    "op1_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_substring_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op4_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op6_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op7_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op8_jaccard_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op11_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op12_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op13_lexical_search": "item_id bigint, rank int, doc_id bigint, score bigint",
}


@pytest.mark.parametrize("name", sorted(LEADING))
def test_columns(spark, empty_dir, name):
    schema = [f"{f.name} {f.dataType.simpleString()}" for f in QUERIES[name](spark, empty_dir).schema]
    want = LEADING[name].split(", ")
    assert schema[: len(want)] == want
