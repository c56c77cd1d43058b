"""DuckDB SQL of the queries that SQL can express, written from the plain definitions: sets, windows and counts."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Linked sets share at least one shingle, so a join on shingles finds all pairs; equal sets are one node.
_PARITY_JOIN = f"""
WITH RECURSIVE spoken AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD}) AS words FROM documents),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM spoken),
grams AS (
    SELECT doc_id, n, i, string_agg(word, ' ') OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS shingle FROM placed),
filled AS (SELECT doc_id, list_sort(list(DISTINCT shingle)) AS shingles FROM grams WHERE i <= greatest(n - 4, 1) GROUP BY doc_id),
sets AS (SELECT doc_id, coalesce(shingles, []) AS shingles FROM spoken LEFT JOIN filled USING (doc_id)),
members AS (
    SELECT doc_id, len(shingles) AS n, shingles,
        CASE WHEN len(shingles) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY shingles) END AS node FROM sets),
nodes AS (SELECT DISTINCT node, n, shingles FROM members),
postings AS (SELECT node, n, unnest(shingles) AS shingle FROM nodes),
links AS (
    SELECT a.node AS a, b.node AS b FROM postings a JOIN postings b ON a.shingle = b.shingle AND a.node <> b.node
    GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
    SELECT node, node AS other FROM nodes
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, component_id FROM members JOIN least USING (node)
"""

_SUBSTRING_DEDUP = f"""
WITH spoken AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORD}) AS words FROM documents),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM spoken),
windows AS (
    SELECT doc_id, i, phrase FROM (
        SELECT doc_id, n, i, string_agg(word, ' ') OVER (
            PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS phrase FROM placed)
    WHERE i <= n - 12),
firsts AS (SELECT phrase, min(doc_id) AS first_doc FROM windows GROUP BY phrase),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM windows JOIN firsts USING (phrase) WHERE first_doc < doc_id),
judged AS (
    SELECT placed.doc_id, placed.i, word, covered.i IS NOT NULL AS gone
    FROM placed LEFT JOIN covered ON placed.doc_id = covered.doc_id AND placed.i = covered.i),
kept AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
    FROM judged GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM spoken LEFT JOIN kept USING (doc_id)
"""

#: Every conversation's list of turns is cut to each of its lengths; equal lists are one node.
_PREFIX_TRIE = """
WITH said AS (
    SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS said, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        md5(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')),
        strlen(coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(said ORDER BY pos) AS turns FROM said GROUP BY conv_id),
crc AS (
    SELECT conv_id, CRC_OF AS crc FROM lists),
rebuilt AS (
    SELECT own.conv_id, list_concat(coalesce(root.turns, [])[1:(crc % 9)::BIGINT], own.turns[(crc % 9 + 1)::BIGINT:]) AS turns
    FROM lists own JOIN crc USING (conv_id) LEFT JOIN lists root ON root.conv_id = own.conv_id - own.conv_id % 5),
steps AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM rebuilt),
paths AS (SELECT conv_id, depth, turns[1:depth] AS path, len(turns) = depth AS ends FROM steps),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM paths GROUP BY path, depth),
parents AS (
    SELECT child.path, child.depth, child.conv_id, child.n_convs, child.ends_sha256, parent.conv_id AS parent_conv_id,
        (SELECT count(*) FROM nodes below WHERE below.depth = child.depth + 1 AND below.path[1:child.depth] = child.path) AS n_children
    FROM nodes child LEFT JOIN nodes parent ON parent.depth = child.depth - 1 AND parent.path = child.path[1:child.depth - 1]),
lines AS (
    SELECT path, depth AS top, n_children = 0 AS leaf,
        CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[depth].text) END AS saved FROM parents),
above AS (SELECT path[1:d] AS path, d AS depth, leaf, saved FROM (SELECT path, leaf, saved, unnest(range(top + 1)) AS d FROM lines)),
sums AS (
    SELECT path, depth, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY path, depth)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM parents JOIN sums USING (path, depth)
"""

#: Every string of 200 bytes of every text, counted as it is.
_SUFFIX_DEDUP = """
WITH held AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
strings AS (
    SELECT r, i, b[i:i + 199] AS s FROM (
        SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS i FROM held WHERE octet_length(b) >= 200)),
hits AS (SELECT r, i FROM strings JOIN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1) USING (s)),
marked AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200, true)::INT AS opens FROM hits),
numbered AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS g FROM marked),
spans AS (SELECT r, g, min(i) AS a, max(i) + 200 AS z FROM numbered GROUP BY r, g),
edges AS (
    SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 1) AS a, a AS z FROM spans
    UNION ALL SELECT r, max(z), 9000000000 FROM spans GROUP BY r),
rests AS (
    SELECT r, list_reduce(list(b[edges.a:edges.z - 1] ORDER BY edges.a), lambda x, y: x || y) AS kept
    FROM edges JOIN held USING (r) GROUP BY r),
sums AS (SELECT r, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed FROM spans GROUP BY r)
SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(coalesce(rests.kept, b)) AS kept_sha256
FROM held LEFT JOIN sums USING (r) LEFT JOIN rests USING (r)
"""

_ASSIGN = """
found{k} AS (
    SELECT vec_id, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (
        SELECT vec_id, pieces.p, e, list_sum(list_transform(list_zip(pieces.x, books{k}.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM pieces JOIN books{k} ON pieces.p = books{k}.p)
    GROUP BY vec_id, p)"""
_MOVE = """,
books{j} AS (
    SELECT p, e, coalesce(moved.x, books{k}.x) AS x FROM books{k} LEFT JOIN (
        SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY i) AS x FROM (
            SELECT p, e, i, sum(v)::BIGINT AS s, count(*) AS n FROM (
                SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM found{k} JOIN pieces USING (vec_id, p))
            GROUP BY p, e, i)
        GROUP BY p, e) moved USING (p, e)),"""

#: Plain nearest entries over all pairs of a piece and an entry, two rounds and a last assignment.
_VECTOR_CODES = """
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda v: floor(256 * v::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
pieces AS (
    SELECT vec_id, p, x[(p * len(x) // 16 + 1):((p + 1) * len(x) // 16)] AS x FROM (
        SELECT vec_id, x, unnest(range(16)) AS p FROM kept)),
books0 AS (
    SELECT p, e, x FROM pieces JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id)
    WHERE e < 64),""" + _ASSIGN.format(k=0) + _MOVE.format(k=0, j=1) + _ASSIGN.format(k=1) + _MOVE.format(k=1, j=2) + _ASSIGN.format(
    k=2) + """,
coded AS (
    SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM found2 GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM books2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


def _crc32(value: str) -> str:
    """CRC-32 of a decimal text in SQL: eight shifts a byte."""
    step = ("list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
            "lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({value}::VARCHAR, ''), "
            f"lambda c: ascii(c)::BIGINT)), lambda crc, byte: {step}), 4294967295)")


ORACLES: dict[str, str] = {"op1_parity_join": _PARITY_JOIN, "op5_substring_dedup": _SUBSTRING_DEDUP,
                           "op11_suffix_dedup": _SUFFIX_DEDUP, "op12_vector_codes": _VECTOR_CODES, "op13_prefix_trie": _PREFIX_TRIE.replace("CRC_OF", _crc32("conv_id"))}
