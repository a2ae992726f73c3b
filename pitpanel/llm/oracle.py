"""DuckDB SQL of the queries that SQL can express over whole tables."""

#: 160 bits of SHA-1 as 32 base32 letters: five hex digits give four letters.
_BASE32 = """array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, (k // 4) * 5 + 1, 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS BIGINT) + 1, 1)), '')"""

OP1 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
same AS (SELECT payload, max(page_id) AS kept FROM p GROUP BY payload)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM p JOIN same USING (payload)"""

_ITEM_WORDS = r"""regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP10 = f"""
WITH d AS (SELECT doc_id, coalesce({_ITEM_WORDS.format(text="text")}, []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ITEM_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, item, dw.size, i FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT doc_id, size, i FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP5 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 75 * (s.n + t.n - k)),
twoway AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, b.y FROM reach r JOIN twoway b ON r.y = b.x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(y) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
wins AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_LEAF = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
#: Whether 2 divides the crc32 of a decimal number: bits of its digits, lowest first, through the register.
_EVEN_CRC = """(list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_transform(range(8), lambda k: (CAST(ascii(c) AS BIGINT) >> k) & 1))),
    lambda r, bit: xor(r >> 1, (xor(r, bit) & 1) * 3988292384), 4294967295) & 1) = 1"""

OP11 = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id, source, text IS NOT NULL AND doc_id IS NOT NULL AND {_EVEN_CRC} AS hit,
    sha256({_LEAF.format(text="text")}) AS leaf, sha256({_LEAF.format(text="replace(text, chr(10), '')")}) AS cut FROM documents),
sources AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM documents)),
placed AS (
  SELECT r, doc_id, leaf, CASE WHEN hit THEN cut ELSE leaf END AS seen, s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i,
    count(*) OVER (PARTITION BY s) AS n FROM rows JOIN sources ON rows.source IS NOT DISTINCT FROM sources.source),
nodes(level, s, i, n, h) AS (
  SELECT 0, s, i, n, leaf FROM placed
  UNION ALL SELECT level + 1, s, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY level, s, i // 3, n),
subroots AS (SELECT s, level, h FROM nodes WHERE n = 1),
upper(level, i, n, h) AS (
  SELECT 0, s, (SELECT count(*) FROM sources), h FROM subroots
  UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, i // 3, n),
-- the path of a row: in its source's tree, then in the tree of sources
steps AS (
  SELECT p.r, c.level AS k, c.h, c.i - (c.i // 3) * 3 AS seat, p.place FROM (
    SELECT r, s, level, i // CAST(pow(3, level) AS BIGINT) AS place FROM placed, (SELECT DISTINCT level FROM nodes) WHERE pow(3, level) < 3 * n AND n > 1) p
  JOIN nodes c ON c.s = p.s AND c.level = p.level AND c.n > 1 AND c.i // 3 = p.place // 3
  UNION ALL
  SELECT p.r, 100 + c.level, c.h, c.i - (c.i // 3) * 3, p.place FROM (
    SELECT r, level, s // CAST(pow(3, level) AS BIGINT) AS place FROM placed, (SELECT DISTINCT level FROM upper)) p
  JOIN upper c ON c.level = p.level AND c.n > 1 AND c.i // 3 = p.place // 3),
runs AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY k) AS k, coalesce(string_agg(h, '' ORDER BY seat) FILTER (WHERE seat < place % 3), '') AS before,
    coalesce(string_agg(h, '' ORDER BY seat) FILTER (WHERE seat > place % 3), '') AS after FROM steps GROUP BY r, k, place),
folds(r, k, h) AS (
  SELECT r, 0, seen FROM placed
  UNION ALL SELECT folds.r, folds.k + 1, sha256(before || folds.h || after) FROM folds JOIN runs ON runs.r = folds.r AND runs.k = folds.k + 1),
ends AS (SELECT r, arg_max(h, k) AS folded_root FROM folds GROUP BY r),
proofs AS (SELECT r, string_agg(before || after, '' ORDER BY k) AS proof FROM runs GROUP BY r),
top AS (SELECT h AS root FROM upper WHERE n = 1)
SELECT doc_id, leaf, subroots.h AS subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (s) JOIN ends USING (r) LEFT JOIN proofs USING (r), top"""

OP12 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 4)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * k >= 80 * (s.n + t.n - k)),
twoway AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, b.y FROM reach r JOIN twoway b ON r.y = b.x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(y) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""

ORACLE_SQL: dict[str, str] = {"op1_warc": OP1, "op5_ngram_join": OP5, "op7_substring_dedup": OP7, "op10_decontamination": OP10, "op11_merkle_manifest": OP11, "op12_minhash_dedup": OP12}
