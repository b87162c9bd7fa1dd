"""DuckDB SQL for the corpus queries that SQL can express."""

# The checksum is folded over the bytes, with a table made from its polynomial.
OP1_SHARDING = """
WITH powers AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)), b)) AS t
), raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, h, length(h) // 2 AS n FROM raw
), summed AS (
  SELECT doc_id, n + 1 AS size, xor(4294967295, list_reduce(
      list_transform(range(n), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM sized, powers
), placed AS (
  SELECT doc_id, size, text_crc32,
    sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS before,
    sum(size) OVER () AS total,
    row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) AS place
  FROM summed
), cut AS (
  SELECT doc_id, size, text_crc32, place, least(15, (2 * before + size) * 16 // (2 * total)) AS shard FROM placed
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""

OP6_TOPK = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), asked AS (
  SELECT vec_id AS query_id, min(v) AS q FROM valid WHERE vec_id % 100 = 0 GROUP BY vec_id
), scored AS (
  SELECT query_id, vec_id, list_inner_product(q, v)::BIGINT AS score
  FROM asked JOIN valid ON vec_id <> query_id AND len(q) = len(v)
), ranked AS (
  SELECT query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP9_JACCARD = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1),
    lambda i: array_to_string(w[i : i + 4], ' '))) AS s
  FROM worded WHERE len(w) > 0
), shingled AS (
  SELECT doc_id, hash(x) AS x FROM (SELECT doc_id, unnest(s) AS x FROM sets)
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingled a JOIN shingled b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)
), ways AS (
  SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links
), reached(root, v) AS (
  SELECT u, u FROM ways
  UNION
  SELECT root, ways.v FROM reached JOIN ways ON reached.v = ways.u
), least AS (
  SELECT v, min(root) AS root FROM reached GROUP BY v
)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id
FROM documents LEFT JOIN sets USING (doc_id) LEFT JOIN least ON v = doc_id
"""

# Every string of 100 bytes is looked at; bytes are pairs of hexadecimal digits.
OP4_REPEATS = """
WITH raw AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), sized AS (
  SELECT doc_id, h, length(h) // 2 AS n FROM raw
), windows AS (
  SELECT doc_id, i, hash(substr(h, 2 * i + 1, 200)) AS x
  FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM sized WHERE n >= 100)
), again AS (
  SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1
), numbered AS (
  SELECT doc_id, i, count(*) FILTER (apart) OVER (PARTITION BY doc_id ORDER BY i) AS k
  FROM (SELECT *, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) > 100 AS apart FROM again)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM numbered GROUP BY doc_id, k
), ends AS (
  SELECT doc_id, a, z FROM spans UNION ALL SELECT doc_id, n, n FROM sized
), pieces AS (
  SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a, z), 0) AS since FROM ends
), kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a, since) AS left_
  FROM pieces JOIN sized USING (doc_id) GROUP BY doc_id
), gone AS (
  SELECT doc_id, sum(z - a) AS bytes, count(*) AS runs FROM spans GROUP BY doc_id
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(bytes, 0)::BIGINT AS n_removed,
  coalesce(runs, 0)::BIGINT AS n_spans, sha256(unhex(left_)) AS kept_sha256
FROM sized JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

# Tokens are listed, cut as lists and joined again.
OP12_INFILL = """
WITH listed AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, text, t, len(t) AS n,
    list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(h, k, 8))::BIGINT) AS d
  FROM listed
), cut AS (
  SELECT doc_id, text, t, n, least(d[1] % (n + 1), d[2] % (n + 1)) AS p, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS m,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR d[3] % 100 >= 90
      THEN 'plain' WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(t[1 : p], '') AS prefix,
    array_to_string(t[p + 1 : m], '') AS middle, array_to_string(t[m + 1 : n], '') AS suffix
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(prefix || middle || suffix) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {
    "op1_sharding": OP1_SHARDING,
    "op4_repeats": OP4_REPEATS,
    "op6_topk": OP6_TOPK,
    "op9_jaccard": OP9_JACCARD,
    "op12_infill": OP12_INFILL,
}
