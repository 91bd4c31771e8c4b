"""SQL counterparts of the queries, for DuckDB, written from their definitions.

Learned verdicts and scores, drawn shards and fitted rates have none.
"""

from emberlog.llm.secrets import RULES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets() -> str:
    found = [
        f"""SELECT doc_id, {rank} AS rank, '{r.name}' AS kind,
               unnest(list_transform(regexp_extract_all(t, {_quoted(r.pattern)}, 0), lambda x: length(x))) AS whole,
               unnest(list_transform(regexp_extract_all(t, {_quoted(r.pattern)}, {r.measured}), lambda x: length(x))) AS measured,
               unnest(list_transform(string_split_regex(t, {_quoted(r.pattern)})[:-2], lambda x: length(x))) AS gap,
               unnest(range(len(regexp_extract_all(t, {_quoted(r.pattern)}, 0)))) AS number,
               {r.least} AS least
        FROM d"""
        for rank, r in enumerate(RULES)
    ]
    base = ", ".join(f"'{r.name}'" for r in RULES if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.name}') AS n_{r.name}" for r in RULES if r.base)
    listed = "string_agg(kind || ':' || (upto - whole) || ':' || upto, ',' ORDER BY upto - whole, rank)"
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    m AS ({" UNION ALL ".join(found)}),
    s AS (
      SELECT *, CAST(sum(gap + whole) OVER (PARTITION BY doc_id, rank ORDER BY number) AS BIGINT) AS upto FROM m
    ),
    k AS (SELECT * FROM s WHERE measured >= least),
    a AS (
      SELECT doc_id, {counts}, {listed} FILTER (kind IN ({base})) AS base, {listed} AS spans FROM k GROUP BY doc_id
    )
    SELECT doc_id, {", ".join(f"coalesce(n_{r.name}, 0) AS n_{r.name}" for r in RULES if r.base)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN a USING (doc_id)"""


PASSAGES = f"""
    WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
    p AS (
      SELECT doc_id, unnest(range(1, len(w) - 48)) AS i,
             unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS h
      FROM d WHERE len(w) >= 50
    ),
    f AS (SELECT h, min(doc_id) AS first FROM p GROUP BY h),
    c AS (SELECT DISTINCT doc_id, i + k AS place FROM p JOIN f USING (h), range(50) r(k) WHERE first < doc_id),
    g AS (SELECT doc_id, list(place) AS gone FROM c GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
           sha256(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(gone, i), false)), ' ')) AS kept_sha256
    FROM d LEFT JOIN g USING (doc_id)"""

LINES = """
    WITH e AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
      FROM documents
    ),
    x AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS k FROM e WHERE line <> ''),
    w AS (
      SELECT doc_id, k, line, lead(line) OVER o AS l2, lead(line, 2) OVER o AS l3
      FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY k)
    ),
    f AS (
      SELECT doc_id, k, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id, k) AS nth FROM w WHERE l3 IS NOT NULL
    ),
    c AS (SELECT DISTINCT doc_id, k + j AS k FROM f, range(3) r(j) WHERE nth > 1),
    gone AS (SELECT x.doc_id, x.place FROM x JOIN c USING (doc_id, k)),
    kept AS (
      SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text FROM e ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
    )
    SELECT doc_id, (SELECT count(*) FROM x WHERE x.doc_id = d.doc_id) AS n_lines,
           (SELECT count(*) FROM gone WHERE gone.doc_id = d.doc_id) AS n_removed,
           sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM documents d LEFT JOIN kept USING (doc_id)"""


def _escaped(text: str) -> str:
    return rf"replace(replace({text}, '\', '\\'), '<|', '<\|')"


CHAT = rf"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ),
    g AS (
      SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
             CAST(sum(17 + length(replace({_escaped("role")}, chr(10), '<\n|')) + length({_escaped("text")})) AS BIGINT)
               AS formatted_chars
      FROM c GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           formatted_chars
    FROM g"""

JACCARD = f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')")} AS w FROM documents
    ),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
        THEN list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' ')))
        WHEN len(w) > 0 THEN [md5(array_to_string(w, ' '))] ELSE [] END) AS h FROM d
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (
      SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    l AS (
      SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)
    ),
    both_ways AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
    r AS (
      SELECT doc_id, doc_id AS c FROM documents
      UNION SELECT v, c FROM r JOIN both_ways ON u = doc_id
    )
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n USING (doc_id)
    GROUP BY doc_id"""

CUT = r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
PLAIN = f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{CUT}'), lambda x: x <> '')"

LEAKS = f"""
    WITH b AS (SELECT item_id, {PLAIN} AS w FROM benchmark),
    i AS (SELECT item_id, w, least(5, len(w)) AS size FROM b WHERE len(w) > 0),
    q AS (
      SELECT DISTINCT item_id, size,
             unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' '))) AS g
      FROM i
    ),
    d AS (SELECT doc_id, {PLAIN} AS w FROM documents),
    z AS (SELECT DISTINCT size FROM i),
    t AS (
      SELECT DISTINCT doc_id, size,
             unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' '))) AS g
      FROM d, z WHERE len(w) >= size
    ),
    n AS (SELECT item_id, count(*) AS n_shingles FROM q GROUP BY item_id),
    m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM t JOIN q USING (size, g) GROUP BY ALL)
    SELECT doc_id, item_id, n_shingles, n_shared FROM m JOIN n USING (item_id) WHERE 100 * n_shared >= 80 * n_shingles"""

# DuckDB has no crc32: bit by bit over the bytes of the decimal id.
CRC32 = """xor(4294967295, list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) for i in range(8)]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
    WITH o AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
      FROM conversations WHERE conv_id IS NOT NULL
    ),
    c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
    b AS (
      SELECT c.conv_id, o.place AS d, role, text FROM c JOIN o ON o.conv_id = base AND o.place <= h
      UNION ALL
      SELECT c.conv_id, o.place - h + (SELECT count(*) FROM o x WHERE x.conv_id = base AND x.place <= h), role, text
      FROM c JOIN o USING (conv_id) WHERE o.place > h
    ),
    p AS (
      SELECT conv_id, d, text, md5(string_agg(md5(role) || md5(text), '' ORDER BY d) OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM b
      UNION ALL SELECT conv_id, 0, NULL, '' FROM c
    ),
    z AS (SELECT conv_id, max(d) AS size FROM p GROUP BY conv_id),
    n AS (
      SELECT k, any_value(d) AS d, min(conv_id) AS rep, count(*) AS n_convs, coalesce(any_value(len({WORDS.format("text")})), 0) AS words
      FROM p GROUP BY k
    ),
    m AS (
      SELECT n.*, x.k AS parent, y.rep AS parent_conv_id
      FROM n LEFT JOIN p x ON x.conv_id = n.rep AND x.d = n.d - 1 LEFT JOIN n y ON y.k = x.k
    ),
    kids AS (SELECT parent AS k, count(*) AS n_children FROM m WHERE parent IS NOT NULL GROUP BY parent),
    t AS (
      SELECT p.k, count(*) FILTER (n_children IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
      FROM n LEFT JOIN kids USING (k) JOIN p ON p.conv_id = n.rep AND p.d <= n.d GROUP BY p.k
    ),
    e AS (
      SELECT k, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM p JOIN z USING (conv_id) WHERE d = size GROUP BY k
    )
    SELECT rep AS conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
           sha256(coalesce(ids, '')) AS ends_sha256
    FROM m JOIN t USING (k) LEFT JOIN kids USING (k) LEFT JOIN e USING (k)"""

TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^{CUT[1:-2]}]+')"

SEARCH = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS w FROM documents),
    c AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
    f AS (
      SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, t, count(*) AS tf
      FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY r, t
    ),
    g AS (SELECT t, count(*) AS df FROM f GROUP BY t),
    q AS (SELECT row_number() OVER () AS i, item_id, {TERMS} AS w FROM benchmark),
    u AS (SELECT DISTINCT i, item_id, unnest(w) AS t FROM q),
    s AS (
      SELECT i, item_id, r, f.doc_id,
             CAST(sum(CAST(floor(1000 * ln((2 * c.n + 2) / (2 * df + 1))) AS BIGINT)
                      * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * f.n * c.n) // c.l)))) AS BIGINT) AS score
      FROM u JOIN f USING (t) JOIN g USING (t), c GROUP BY ALL
    ),
    o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 50"""

ORACLES: dict[str, str] = {
    "op1_secret_scan": _secrets(),
    "op3_substring_dedup": PASSAGES,
    "op4_chat_format": CHAT,
    "op5_line_dedup": LINES,
    "op8_jaccard_join": JACCARD,
    "op9_decontamination": LEAKS,
    "op12_prefix_trie": TRIE,
    "op13_lexical_search": SEARCH,
}
