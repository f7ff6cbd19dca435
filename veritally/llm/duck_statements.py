"""DuckDB statements that state operators 11, 12 and 13 once more, for comparison only."""

from __future__ import annotations


def with_(parts: dict[str, str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({body})" for name, body in parts.items()) + "\n" + final


def crc_parts(texts: str) -> dict[str, str]:
    """The unsigned crc32 of each ``t`` of ``texts``, in ``crcs`` as (t, h).

    A checksum is a sum (exclusive or) of one number per byte, which depends on the byte and on how
    many bytes follow it, and of one that depends on the length.
    """
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return {
        "crc_texts": f"SELECT DISTINCT t, CAST(strlen(t) AS BIGINT) AS size FROM ({texts})",
        "crc_table": f"""
            SELECT i AS byte, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: {step}) AS c
            FROM (SELECT unnest(range(256)) AS i)""",
        "crc_after(byte, after, c)": """
            SELECT byte, CAST(0 AS BIGINT), c FROM crc_table
            UNION ALL
            SELECT a.byte, a.after + 1, xor(a.c >> 8, t.c) FROM crc_after a JOIN crc_table t ON t.byte = a.c & 255
            WHERE a.after < (SELECT max(size) FROM crc_texts)""",
        "crc_empty(size, c)": """
            SELECT CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT)
            UNION ALL
            SELECT e.size + 1, xor(e.c >> 8, t.c) FROM crc_empty e JOIN crc_table t ON t.byte = e.c & 255
            WHERE e.size < (SELECT max(size) FROM crc_texts)""",
        "crc_bytes": """
            SELECT t, size, i, CAST('0x' || substr(hex(encode(t)), 2 * i - 1, 2) AS BIGINT) AS byte
            FROM (SELECT t, size, unnest(range(1, size + 1)) AS i FROM crc_texts)""",
        "crcs": """
            SELECT t, xor(xor(x, e.c), 4294967295) AS h
            FROM (SELECT t, b.size, bit_xor(a.c) AS x FROM crc_bytes b JOIN crc_after a ON a.byte = b.byte AND a.after = b.size - i
                  GROUP BY t, b.size) s JOIN crc_empty e ON e.size = s.size""",
    }


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

VARIANTS = {
    "runs": f"""
        SELECT doc_id || ':' || run AS t, run, count(*) AS times
        FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
        GROUP BY ALL""",
    **crc_parts("SELECT t FROM runs"),
    "results": """
        SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
        FROM runs JOIN crcs USING (t)""",
    "words": """
        SELECT word, CAST(sum(times) AS BIGINT) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5""",
    "holes": """
        SELECT word, n, i, left(word, i - 1) AS before, substr(word, i + 1) AS after
        FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)""",
    "near": """
        SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b USING (before, after) WHERE a.word <> b.word
        UNION
        SELECT a.word, b.word, b.n FROM holes a JOIN words b ON b.word = a.before || a.after
        UNION
        SELECT b.word, a.word, a.n FROM holes a JOIN words b ON b.word = a.before || a.after""",
    "best": """
        SELECT word, other, m, count(*) OVER (PARTITION BY word) AS n_near,
               row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place FROM near""",
    "formed": """
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form, CASE WHEN m >= 5 * n THEN m END AS form_n
        FROM words LEFT JOIN (SELECT * FROM best WHERE place = 1) USING (word)""",
    "chains(word, last)": """
        SELECT word, word FROM formed
        UNION ALL SELECT c.word, f.form FROM chains c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL""",
}

NEAR_COPIES = {
    "split": f"""
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'),
                                   lambda w: w <> '') AS w FROM documents""",
    "sets": """
        SELECT doc_id, CASE WHEN len(w) = 1 THEN w
                            ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM split""",
    "members": "SELECT doc_id, len(s) AS size, unnest(s) AS shingle FROM sets",
    "common": """
        SELECT a.doc_id AS a, b.doc_id AS b, a.size AS n, b.size AS m, count(*) AS shared
        FROM members a JOIN members b ON b.shingle = a.shingle AND a.doc_id <> b.doc_id
             AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
        GROUP BY ALL""",
    "links": "SELECT a, b FROM common WHERE 100 * shared >= 80 * (n + m - shared)",
    "reached(a, b)": "SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b",
    "least_reached": "SELECT a, min(b) AS b FROM reached GROUP BY a",
}

TRIE = {
    **crc_parts("SELECT CAST(conv_id AS VARCHAR) AS t FROM conversations WHERE conv_id IS NOT NULL"),
    "originals": """
        SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id""",
    "rebuilt": """
        SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h % 9], o.turns[h % 9 + 1:]) AS turns
        FROM originals o JOIN crcs ON t = CAST(o.conv_id AS VARCHAR)
        LEFT JOIN originals b ON b.conv_id = o.conv_id - o.conv_id % 5""",
    "passes": "SELECT conv_id, len(turns) AS size, unnest(range(len(turns) + 1)) AS d, turns[1:d] AS path FROM rebuilt",
    "nodes": """
        SELECT path, d, min(conv_id) AS conv_id, count(*) AS n,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends
        FROM passes GROUP BY path, d""",
    "children": "SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS children FROM nodes WHERE d > 0 GROUP BY ALL",
    "valued": """
        SELECT n.*, coalesce(children, 0) AS children, CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * strlen(n.path[n.d].text) END AS saved
        FROM nodes n LEFT JOIN children c ON c.d = n.d AND c.path = n.path""",
    "above": """
        SELECT path[1:u] AS path, u AS d, count(*) FILTER (children = 0) AS leaves, sum(saved) AS saved
        FROM (SELECT *, unnest(range(d + 1)) AS u FROM valued) GROUP BY ALL""",
}


def statements() -> dict[str, str]:
    return {
        "op11_spelling_variants": with_(VARIANTS, """
            SELECT word, form, root, n, n_near, form_n
            FROM formed JOIN (SELECT word, arg_max(last, n) AS root FROM chains JOIN (SELECT word AS last, n FROM words) USING (last) GROUP BY word)
                 USING (word)"""),
        "op12_bottom_sketches": with_(NEAR_COPIES, """
            SELECT doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
                   doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
            FROM sets LEFT JOIN least_reached ON a = doc_id"""),
        "op13_conversation_trie": with_(TRIE, """
            SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs, v.children AS n_children, a.leaves AS n_leaves,
                   CAST(a.saved AS BIGINT) AS saved_tokens, v.ends AS ends_sha256
            FROM valued v JOIN above a ON a.d = v.d AND a.path = v.path LEFT JOIN nodes p ON p.d = v.d - 1 AND p.path = v.path[1:v.d - 1]"""),
    }
