"""The SQL of the queries that SQL can express, written for DuckDB."""

from __future__ import annotations

from tessera.llm.mixing import BUCKETS, CELL_ROWS, SIZE_BITS, WEIGHTS
from tessera.llm.url_filters import BLOCK_WEIGHT, SOFT_TERMS, STRICT_TERMS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def url_filter() -> str:
    rules = ", ".join(f"('{text}', '{verdict}')" for text, verdict in URL_RULES)
    hit = "regexp_matches(lowered, '(^|[^0-9a-z])' || term || '($|[^0-9a-z])')"
    return f"""
WITH rules AS (
  SELECT text AS rule, verdict, split_part(text, '/', 1) AS rule_host,
         substr(text, strpos(text, '/')) AS rule_path
  FROM (VALUES {rules}) AS r(text, verdict)
), placed AS (
  SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS lowered,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')
           AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), judged AS (
  SELECT page_id, host, path,
         len(list_filter({_list(STRICT_TERMS)}, lambda term: {hit})) AS strict_terms,
         len(list_filter({_list(SOFT_TERMS)}, lambda term: {hit})) AS soft_terms,
         (SELECT max((length(rule), rule, verdict)) FROM rules
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
            AND starts_with(path, rule_path)) AS ruled
  FROM placed
)
SELECT page_id, host, path, ruled[2] AS rule,
       coalesce(ruled[3], CASE WHEN strict_terms * {BLOCK_WEIGHT} + soft_terms >= {BLOCK_WEIGHT}
                          THEN 'block' ELSE 'allow' END) AS verdict,
       strict_terms, soft_terms,
       CAST(strict_terms * {BLOCK_WEIGHT} + soft_terms AS DOUBLE) AS weight
FROM judged
"""


def mix_sources(
    table: str = "documents", seed: str = "mix", buckets: int = BUCKETS, cell_rows: int = CELL_ROWS
) -> str:
    """Copies by the same rule, with whole-source windows instead of counted cells."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    number = "CAST(('0x' || substr(md5({}), 1, {})) AS BIGINT)"
    name = (f"'{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' "
            "|| md5(coalesce(text, ''))")
    return f"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS source_key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         {number.format(name, 15)} AS draw
  FROM {table}
), classed AS (
  SELECT *, greatest(0, length(bin(size)) - {SIZE_BITS}) AS shift,
         draw % ({buckets} + count(*) OVER (PARTITION BY source_key) // {cell_rows}) AS bucket
  FROM sized
), sources AS (
  SELECT source_key, CAST(sum(size) AS BIGINT) AS source_size,
         CAST({weights}[(row_number() OVER (ORDER BY source_key) - 1) % {len(WEIGHTS)} + 1]
              AS DOUBLE) AS weight
  FROM sized GROUP BY source_key
), filling AS (
  SELECT *, source_size * CAST(3 AS DOUBLE) AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(weight) OVER () AS all_weights
  FROM sources
), levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER before, 0))
            / (all_weights - coalesce(sum(weight) OVER before, 0)) AS level
  FROM filling
  WINDOW before AS (ORDER BY cap / weight, source_key
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
  SELECT *, max(level) OVER () AS reached FROM levels
), targets AS (
  SELECT source_key, source_size, least(cap, reached * weight) AS target,
         {number.format(f"'{seed}|' || source_key", 8)} / CAST(4294967296 AS DOUBLE) AS shifted
  FROM final
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source_key
              ORDER BY (size >> shift) + shift * {1 << (SIZE_BITS + 1)}, bucket, size,
                       doc_id NULLS FIRST, draw) AS n
  FROM classed
), copied AS (
  SELECT doc_id, size, source_size, target,
         CAST(floor(n * rate + shifted) - floor((n - 1) * rate + shifted) AS BIGINT) AS copies
  FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
        FROM numbered JOIN targets USING (source_key))
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""


def decontamination(window: int = 10) -> str:
    """Windows as joined words; words beyond ASCII need no case change."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), "
        f"'{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least({window}, len(words)) AS size,
         unnest(list_transform(range(1, len(words) - least({window}, len(words)) + 2),
           lambda i: array_to_string(words[i:i + least({window}, len(words)) - 1], ' ')))
           AS passage
  FROM items WHERE len(words) > 0
), docs AS (
  SELECT row_number() OVER () AS row, doc_id, {words} AS words FROM documents
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT row, size, unnest(range(1, CAST(len(words) AS BIGINT) - size + 2)) AS place, words
  FROM docs CROSS JOIN sizes WHERE len(words) >= size
), found AS (
  SELECT row, place, p.size, item_id
  FROM (SELECT row, place, size, array_to_string(words[place:place + size - 1], ' ') AS passage
        FROM places) p
  JOIN windows w ON p.size = w.size AND p.passage = w.passage
), hits AS (
  SELECT row, count(DISTINCT place + step) AS n_hit
  FROM (SELECT DISTINCT row, place, size FROM found), range(0, {window}) r(step)
  WHERE step < size GROUP BY row
), listed AS (
  SELECT row, count(DISTINCT item_id) AS n_items,
         string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT row, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN listed USING (row)
"""


def warc() -> str:
    """Base32: five hexadecimal digits are four letters."""
    value = "CAST(('0x' || substr(sha1, 5 * (i // 4) + 1, 5)) AS BIGINT)"
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS sha1 FROM pages
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM hashed
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('{alphabet}',
         CAST((({value} >> (15 - 5 * (i % 4))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM coalesce(first_id, page_id) THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM coalesce(first_id, page_id) THEN first_id END AS refers_to
FROM firsts
"""


def embedding_dedup(cosine: float = 0.98) -> str:
    return f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {cosine}
), reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT vec_id, b FROM reached JOIN links ON other = a
), groups AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, CAST((SELECT count(*) FROM links WHERE a = vec_id) AS BIGINT) AS n_links,
       component_id, vec_id = component_id AS kept
FROM groups
"""


def near_duplicates(size: int = 5, percent: int = 75) -> str:
    """Words hold no blank, so joined words are the shingle."""
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
        "'[^\\x20\\x09-\\x0D]+')"
    )
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, {words} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < {size} THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - {size - 2}),
      lambda i: array_to_string(words[i:i + {size - 1}], ' ')) END) AS shingle
  FROM texts
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= {percent} * (p.n + q.n - c)
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT doc_id, b FROM reached JOIN links ON other = a
), groups AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM groups LEFT JOIN sizes USING (doc_id)
"""


def suffix_dedup(length: int = 100) -> str:
    """Every window of every text by its 64-bit digest; the first of each stays."""
    return f"""
WITH docs AS (
  SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents
), sized AS (SELECT *, CAST(octet_length(data) AS BIGINT) AS n_bytes FROM docs),
windows AS (
  SELECT doc_id, place, hash(array_slice(data, place + 1, place + {length})) AS digest
  FROM (SELECT doc_id, data, unnest(range(0, greatest(n_bytes - {length - 1}, 0))) AS place
        FROM sized)
), again AS (
  SELECT doc_id, place FROM windows
  QUALIFY row_number() OVER (PARTITION BY digest ORDER BY doc_id, place) > 1
), marked AS (
  SELECT *, coalesce(place > lag(place) OVER (PARTITION BY doc_id ORDER BY place) + {length},
                     true) AS fresh
  FROM again
), spans AS (
  SELECT doc_id, min(place) AS b, max(place) + {length} AS e
  FROM (SELECT *, sum(CAST(fresh AS INT)) OVER (PARTITION BY doc_id ORDER BY place) AS span
        FROM marked)
  GROUP BY doc_id, span
), pieces AS (
  SELECT doc_id, b, e, hex(array_slice(data, before + 1, b)) AS piece
  FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS before FROM spans)
  JOIN sized USING (doc_id)
), removed AS (
  SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans,
         string_agg(piece, '' ORDER BY b) AS kept, max(e) AS rest
  FROM pieces GROUP BY doc_id
)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || hex(array_slice(data, coalesce(rest, 0) + 1, n_bytes))))
         AS kept_sha256
FROM sized LEFT JOIN removed USING (doc_id)
"""


def filter_audit(filters: str = "ABCDE") -> str:
    """Every order applied to every mask of a part: at most 32 masks by 120 orders."""
    letters = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(filters))
    tables = ", ".join(f"letters l{i}" for i in range(len(filters)))
    names = " || ".join(f"l{i}.letter" for i in range(len(filters)))
    bits = "[" + ", ".join(f"l{i}.bit" for i in range(len(filters))) + "]"
    differ = " AND ".join(
        f"l{i}.letter <> l{j}.letter" for i in range(len(filters)) for j in range(i)
    )
    counts = "coalesce(CAST(sum({}) AS BIGINT), 0)"
    removed = "mask & bit <> 0 AND mask & before = 0"
    return f"""
WITH letters(letter, bit) AS (VALUES {letters}),
orders AS (
  SELECT {names} AS filter_order, {bits} AS bits FROM {tables} WHERE {differ}
), steps AS (
  SELECT filter_order, step, bits[step] AS bit,
         coalesce(list_sum(bits[1:step - 1]), 0) AS before, list_sum(bits[1:step]) AS upto
  FROM orders, range(1, {len(filters) + 1}) r(step)
), marks AS (
  SELECT doc_id, max(CAST(coalesce(quality = 1, FALSE) AS INT)) AS good,
         max(CAST(coalesce(toxic = 1, FALSE) AS INT)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), read AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), firsts AS (SELECT body, min(doc_id) AS first_id FROM read GROUP BY body),
masks AS (
  SELECT part, doc_id,
         CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')))
                     > 3 * length(body) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM read JOIN firsts USING (body)
), cells AS (
  SELECT part, mask, count(*) AS docs, sum(coalesce(good, 0)) AS good,
         sum(coalesce(toxic, 0)) AS toxic
  FROM masks LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), audited AS (
  SELECT part, filter_order, step, bit,
         {counts.format("docs * CAST(mask & upto = 0 AS INT)")} AS kept,
         {counts.format(f"docs * CAST({removed} AS INT)")} AS removed,
         {counts.format("docs * CAST(mask & bit <> 0 AND mask & before <> 0 AS INT)")}
           AS redundant,
         {counts.format("docs * CAST(mask = bit AS INT)")} AS unique_fails,
         {counts.format(f"good * CAST({removed} AS INT)")} AS good_lost,
         {counts.format(f"toxic * CAST({removed} AS INT)")} AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit, before, upto
)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails,
       good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM audited
"""


def prefix_trie(group: int = 100, limit: int = 6) -> str:
    """Nodes as lists of turns; a subtree is every node whose list begins with the node's."""
    # The CRC-32 bit by bit; DuckDB has no function for it.
    bits = (
        "list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), "
        "CAST(flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), "
        "lambda ch: [CAST(ord(ch) + 256 AS UBIGINT), 0, 0, 0, 0, 0, 0, 0])) AS UBIGINT[])), "
        "lambda crc, x: CASE WHEN ((xor(crc, x & 255)) & 1) = 1 "
        "THEN xor(xor(crc, x & 255) >> 1, CAST(3988292384 AS UBIGINT)) "
        "ELSE xor(crc, x & 255) >> 1 END)"
    )
    turn = "coalesce(role, ''), coalesce(text, '')"
    digest = "md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"
    return f"""
WITH originals AS (
  SELECT conv_id AS c, list(md5(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                                 ::VARCHAR) || ':' || length(coalesce(text, ''))
                            ORDER BY turn NULLS FIRST, {digest}) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), sized AS (
  SELECT c, own, CAST(xor({bits}, CAST(4294967295 AS UBIGINT)) % {limit} AS BIGINT) AS h
  FROM originals
), rebuilt AS (
  SELECT s.c, list_concat(coalesce(b.own, [])[1:s.h], s.own[s.h + 1:]) AS turns
  FROM sized s LEFT JOIN originals b ON b.c = s.c - s.c % {group}
), members AS (
  SELECT c, len(turns) AS length, turns[1:d] AS node, d,
         coalesce(CAST(string_split(turns[d], ':')[2] AS BIGINT), 0) AS points
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
         coalesce(string_agg(CASE WHEN length = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')
           AS ends
  FROM members GROUP BY node, d
), children AS (
  SELECT p.node, p.d, count(k.node) AS n_children
  FROM nodes p LEFT JOIN nodes k ON k.d = p.d + 1 AND k.node[1:p.d] = p.node GROUP BY p.node, p.d
), below AS (
  SELECT u.node[1:a] AS node, a AS d, u.n_convs, u.points, u.d AS at, k.n_children
  FROM nodes u JOIN children k ON k.node = u.node AND k.d = u.d, range(0, u.d + 1) r(a)
), subtrees AS (
  SELECT node, d, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n_convs - 1) * points) AS saved
  FROM below GROUP BY node, d
)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id,
       CAST(n.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN children k ON k.node = n.node AND k.d = n.d
JOIN subtrees s ON s.node = n.node AND s.d = n.d
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.node[1:n.d - 1] AND n.d > 0
"""
