"""SQL for decontamination, the conversation trie and ranked search."""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str = "text") -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{WORDS}')"


LEAKS = f"""
    WITH item AS (
        SELECT coalesce(item_id::varchar, '') AS item, {_words()} AS words FROM benchmark
    ), sized AS (
        SELECT item, words, least(10, len(words)) AS size FROM item WHERE len(words) > 0
    ), spot AS (
        SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM sized
    ), win AS (
        SELECT DISTINCT item, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM spot
    ), doc AS (
        SELECT row_number() OVER () AS nr, doc_id, {_words()} AS words FROM documents
    ), place AS (
        SELECT nr, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc, (SELECT DISTINCT size FROM win)
    ), hit AS (
        SELECT nr, i, size, item FROM (
            SELECT nr, i, size, array_to_string(words[i:i + size - 1], ' ') AS phrase FROM place
        ) JOIN win USING (size, phrase)
    ), covered AS (
        SELECT nr, count(*) AS n_hit
        FROM (SELECT DISTINCT nr, unnest(range(i, i + size)) AS word FROM hit) GROUP BY nr
    ), named AS (
        SELECT nr, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT nr, item FROM hit) GROUP BY nr
    )
    SELECT doc_id, len(words)::bigint AS n_words, coalesce(n_hit, 0) AS n_hit,
        coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN covered USING (nr) LEFT JOIN named USING (nr)
"""

# The checksum of the conv_id's digits, bit by bit; 3988292384 is its polynomial.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ord(c)::bigint)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
        lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""

PREFIX_TRIE = f"""
    WITH turn AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), conv AS (
        SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32} % 6 AS h, max(pos) AS own
        FROM turn GROUP BY conv_id
    ), sized AS (
        SELECT c.*, least(c.h, coalesce(b.own, 0)) AS taken FROM conv c LEFT JOIN conv b ON b.conv_id = c.base
    ), anew AS (
        SELECT s.conv_id, pos, role, text FROM sized s JOIN turn t ON t.conv_id = s.base AND pos <= taken
        UNION ALL
        SELECT s.conv_id, pos - h + taken, role, text FROM sized s JOIN turn t USING (conv_id) WHERE pos > h
    ), path AS (
        SELECT conv_id, list(md5(role || chr(0) || text) ORDER BY pos) AS path,
            list(length(text) ORDER BY pos) AS chars
        FROM anew GROUP BY conv_id
    ), whole AS (
        SELECT conv_id, coalesce(path, []::varchar[]) AS path, coalesce(chars, []::bigint[]) AS chars
        FROM conv LEFT JOIN path USING (conv_id)
    ), step AS (
        SELECT conv_id, path, chars, unnest(range(0, len(path) + 1)) AS depth FROM whole
    ), node AS (
        SELECT depth, path[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
            any_value(if(depth = 0, 0, chars[depth])) AS chars,
            sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id)
                FILTER (WHERE len(path) = depth), '')) AS ends_sha256
        FROM step GROUP BY depth, path[1:depth]
    ), child AS (
        SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1
    ), full_node AS (
        SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN child USING (prefix)
    ), over AS (
        SELECT *, unnest(range(0, depth + 1)) AS up FROM full_node
    ), sums AS (
        SELECT prefix[1:up] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
            sum((n_convs - 1) * chars)::bigint AS saved_tokens
        FROM over GROUP BY 1
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens,
        n.ends_sha256
    FROM full_node n JOIN sums s ON s.prefix = n.prefix
        LEFT JOIN node p ON n.depth > 0 AND p.prefix = n.prefix[1:n.depth - 1]
"""

SEARCH = f"""
    WITH item AS (
        SELECT row_number() OVER () AS item, item_id, unnest({_words()}) AS term FROM benchmark
    ), asked AS (
        SELECT item, item_id, term, count(*) AS repeats FROM item GROUP BY ALL
    ), doc AS (
        SELECT row_number() OVER () AS nr, doc_id, {_words()} AS words FROM documents
    ), size AS (
        SELECT count(*) FILTER (WHERE len(words) > 0) AS docs, coalesce(sum(len(words)), 0)::bigint AS length
        FROM doc
    ), posting AS (
        SELECT nr, doc_id, n, term, count(*) AS tf
        FROM (SELECT nr, doc_id, len(words) AS n, unnest(words) AS term FROM doc)
        WHERE term IN (SELECT term FROM asked)
        GROUP BY ALL
    ), weight AS (
        SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint AS w
        FROM posting, size GROUP BY term
    ), score AS (
        SELECT item, item_id, nr, doc_id, sum(repeats * w * ((1000000000 * tf)
            // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length))))::bigint AS score
        FROM asked JOIN posting USING (term) JOIN weight USING (term), size
        GROUP BY ALL
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::int AS rank
        FROM score WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
