"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# CRC-32 byte by byte: the table of 256 remainders is built from the polynomial.
OP5 = """
WITH RECURSIVE remainders AS (
    SELECT list(crc ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END) AS crc
        FROM range(256) r(i)
    )
), rows AS (
    SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
    SELECT doc_id, n + 16 AS size,
           xor(4294967295::BIGINT, list_reduce(
               list_prepend(4294967295::BIGINT,
                   list_transform(range(n), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
               lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) AS INTEGER) + 1]))) AS text_crc32
    FROM rows, remainders
), costs AS (
    SELECT *, list_transform(range(41), lambda i:
        -ln((CAST('0x' || substr(md5(doc_id || '/' || i), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)) AS c
    FROM sized
), placed AS (
    SELECT doc_id, size, text_crc32,
           CAST(list_position(c, list_min(c[1:40])) - 1 AS INTEGER) AS shard,
           CAST(list_position(c, list_min(c)) - 1 AS INTEGER) AS grown_shard,
           CAST('0x' || substr(md5(doc_id || '/' || size || '/' || text_crc32), 1, 8) AS BIGINT) % 1024 AS slice
    FROM costs
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
"""

OP7 = f"""
WITH d AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), windows AS (
    SELECT doc_id, i, list_aggregate(w[i + 1 : i + 13], 'string_agg', ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(len(w) - 12)) AS i FROM d WHERE len(w) >= 13)
), firsts AS (
    SELECT win, min(doc_id) AS first FROM windows GROUP BY win
), removed AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
    FROM windows JOIN firsts USING (win) WHERE first < doc_id
), gone AS (
    SELECT doc_id, list(p) AS ps FROM removed GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS word FROM d
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM words ANTI JOIN removed USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# The cuts are found by lists of all phrases' counts, without partitions or hashes.
OP11 = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang
), spans AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, range(1, 6) t(k) WHERE len(w) >= k
), counts AS (
    SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k, count(*) AS f FROM spans GROUP BY ALL
    HAVING count(*) >= 100
), lists AS (
    SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM counts WHERE k > 1
), inside AS (
    SELECT lang, array_to_string(w[i : i + size - 1], ' ') AS phrase, max(a) AS around
    FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM lists, range(2, 5) t(size) WHERE size < k) GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, n,
           CAST((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM lists) c
    JOIN totals USING (lang)
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.cut], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1 :], ' ')
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
    SELECT w.* FROM weakest w LEFT JOIN inside i USING (lang, phrase)
    WHERE i.around IS NULL OR 100 * i.around < 100 * w.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

_UNIT = r"[A-Za-z]+|[^A-Za-z]"

OP13 = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
           list_transform(range(4), lambda i: CAST('0x' || substr(sha256('1:' || doc_id), 8 * i + 1, 8) AS BIGINT)) AS h
    FROM documents
), cut AS (
    SELECT *, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
           greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR h[3] % 100 >= 90 THEN 'plain'
                WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1 : b], '') AS middle,
           array_to_string(u[b + 1 :], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLE: dict[str, str] = {
    "op2_block_topk": OP2,
    "op5_rendezvous_shards": OP5,
    "op7_repeated_windows": OP7,
    "op11_son_phrases": OP11,
    "op13_fill_in_middle": OP13,
}
