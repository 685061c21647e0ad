"""SQL of those pipeline operators that it expresses, for DuckDB over the same tables."""

from __future__ import annotations

from hoptrail.llm.manifest import FAN, TAMPERED

#: Levels that the SQL of a Merkle tree spells out: FAN ** LEVELS leaves a language, FAN ** TOP languages.
LEVELS, TOP = 9, 4


def crc32(number: str) -> str:
    """Unsigned CRC-32 of a number's decimal digits, bit by bit."""
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, u: xor(v >> 1, 3988292384 * (v & 1)))))"""


def _level(before: str, after: str) -> str:
    return f"""
, {after}_run AS MATERIALIZED (
    SELECT tree, pos // {FAN} AS up, list(node ORDER BY pos) AS run, sum(count(*)) OVER (PARTITION BY tree) AS n
    FROM (SELECT DISTINCT tree, pos, node FROM {before}) GROUP BY tree, pos // {FAN})
, {after} AS MATERIALIZED (
    SELECT l.* REPLACE (
        CASE WHEN n > 1 THEN pos // {FAN} ELSE pos END AS pos,
        CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE node END AS node,
        CASE WHEN n > 1 THEN sha256(array_to_string(run[:pos % {FAN}] || [folded] || run[pos % {FAN} + 2:], ''))
             ELSE folded END AS folded,
        CASE WHEN n > 1 THEN beside || array_to_string(run[:pos % {FAN}], '') || array_to_string(run[pos % {FAN} + 2:], '')
             ELSE beside END AS beside)
    FROM {before} l JOIN {after}_run r ON l.tree = r.tree AND l.pos // {FAN} = r.up)"""


def manifest() -> str:
    def leaf(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        return "sha256(" + " || ".join(
            f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields
        ) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return (
        f"""WITH leaves AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS leaf,
           doc_id IS NOT NULL AND {crc32("coalesce(doc_id, 0)")} % {TAMPERED} = 0 AS tampered, {leaf(low)} AS changed
    FROM documents)
, l0 AS MATERIALIZED (
    SELECT doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           leaf AS node, CASE WHEN tampered THEN changed ELSE leaf END AS folded, '' AS beside, tampered
    FROM leaves)"""
        + "".join(_level(f"l{k}", f"l{k + 1}") for k in range(LEVELS))
        + f"""
, t0 AS MATERIALIZED (
    SELECT * REPLACE ('' AS tree, dense_rank() OVER (ORDER BY tree) - 1 AS pos), node AS subroot FROM l{LEVELS})"""
        + "".join(_level(f"t{k}", f"t{k + 1}") for k in range(TOP))
        + f"""
SELECT doc_id, leaf, subroot, node AS root, sha256(beside) AS proof_sha256, tampered, folded AS folded_root,
       folded = node AS verified
FROM t{TOP}"""
    )


def conversation_trie() -> str:
    return f"""WITH marked AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS points,
           left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS mark
    FROM conversations WHERE conv_id IS NOT NULL)
, own AS (
    SELECT conv_id, list({{'mark': mark, 'points': points}} ORDER BY turn NULLS FIRST, role, mark) AS turns,
           {crc32("conv_id")} % 6 AS h
    FROM marked GROUP BY conv_id)
, rebuilt AS (
    SELECT o.conv_id, coalesce(f.turns[:o.h], []) || o.turns[o.h + 1:] AS turns
    FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 100)
, prefixes AS (
    SELECT conv_id, depth, array_to_string(list_transform(turns[:depth], lambda t: t.mark), '') AS path,
           CASE WHEN depth > 0 THEN turns[depth].points ELSE 0 END AS points, depth = len(turns) AS ends
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt))
, nodes AS MATERIALIZED (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(points) AS points,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path, depth)
, children AS (
    SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1)
, subtrees AS (
    SELECT left(path, 32 * unnest(range(depth + 1))) AS path, CAST(n IS NULL AS BIGINT) AS leaf, (n_convs - 1) * points AS saved
    FROM nodes LEFT JOIN children USING (path))
, totals AS (
    SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM subtrees GROUP BY path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.path = n.path LEFT JOIN children c ON c.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = left(n.path, 32 * (n.depth - 1))"""


def decontamination(window: int = 10, near: int = 3, slop: int = 20) -> str:
    """All windows of all texts joined by their words, and the rarest words of items by their places."""

    def words(text: str) -> str:
        lowered = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

    def grams(table: str, key: str, size: str) -> str:
        return f"""SELECT {key}, unnest(range(0, len(w) - {size} + 1)) AS pos, {size} AS size, w FROM {table}
            WHERE len(w) >= {size}"""

    def digest(ids: str) -> str:
        return f"sha256(coalesce(array_to_string({ids}, ','), ''))"

    return f"""
WITH doc AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, doc_id, coalesce({words("text")}, []) AS w FROM documents)
, item AS MATERIALIZED (
    SELECT row_number() OVER () AS uid, item_id, {words("text")} AS w
    FROM (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, text FROM benchmark WHERE text IS NOT NULL)
    WHERE len({words("text")}) > 0)
, item_gram AS (
    SELECT DISTINCT item_id, size, array_to_string(w[pos + 1:pos + size], ' ') AS gram
    FROM ({grams("item", "item_id", f"least(len(w), {window})")}))
, size AS (SELECT DISTINCT size FROM item_gram)
, doc_gram AS (
    SELECT row_id, pos, size, array_to_string(w[pos + 1:pos + size], ' ') AS gram
    FROM ({grams("doc, size", "row_id", "size")}))
, met AS MATERIALIZED (SELECT row_id, pos, size, item_id FROM doc_gram JOIN item_gram USING (size, gram))
, hit AS (
    SELECT row_id, count(*) AS n_hit
    FROM (SELECT DISTINCT row_id, unnest(range(pos, pos + size)) AS place FROM met) GROUP BY row_id)
, named AS (SELECT row_id, list(DISTINCT item_id ORDER BY item_id) FILTER (item_id IS NOT NULL) AS items FROM met GROUP BY row_id)
, place AS MATERIALIZED (SELECT row_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM doc WHERE len(w) > 0)
, often AS (SELECT word, count(*) AS n FROM place GROUP BY word)
, item_word AS (
    SELECT uid, item_id, word, min(pos) AS pos
    FROM (SELECT uid, item_id, unnest(w) AS word, unnest(range(0, len(w))) AS pos FROM item) GROUP BY uid, item_id, word)
, rare AS (
    SELECT uid, item_id, word, row_number() OVER (PARTITION BY uid ORDER BY n IS NULL, n, pos) AS rank,
        count(n) OVER (PARTITION BY uid) AS known, count(*) OVER (PARTITION BY uid) AS asked, n
    FROM item_word LEFT JOIN often USING (word))
, sought AS MATERIALIZED (
    SELECT uid, item_id, word, rank, least(known, {near}) AS needed FROM rare
    WHERE n IS NOT NULL AND rank <= {near} AND known >= least(asked, 2))
, around AS (
    SELECT s.uid, s.item_id, s.needed, p.row_id, p.pos, p.pos AS low, p.pos AS high
    FROM sought s JOIN place p USING (word) WHERE s.rank = 1)""" + "".join(
        f"""
, around{k} AS (
    SELECT a.uid, a.item_id, a.needed, a.row_id, a.pos, least(a.low, coalesce(p.pos, a.low)) AS low,
        greatest(a.high, coalesce(p.pos, a.high)) AS high
    FROM around{k - 1 if k > 2 else ""} a
    LEFT JOIN sought s ON s.uid = a.uid AND s.rank = {k}
    LEFT JOIN place p ON p.row_id = a.row_id AND p.word = s.word AND p.pos BETWEEN a.pos - {slop} AND a.pos + {slop}
    WHERE s.word IS NULL OR p.pos IS NOT NULL)""" for k in range(2, near + 1)
    ) + f"""
, close AS (
    SELECT row_id, list(DISTINCT item_id ORDER BY item_id) FILTER (item_id IS NOT NULL) AS near
    FROM around{near} WHERE high - low < {slop} GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, {digest("items")} AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(len(near), 0) AS BIGINT) AS n_near, {digest("near")} AS near_sha256
FROM doc LEFT JOIN hit USING (row_id) LEFT JOIN named USING (row_id) LEFT JOIN close USING (row_id)"""
