"""DuckDB statements for the operators whose results SQL can state in full."""

from __future__ import annotations

# ASCII capitals only, as the operators do; lower() would also change other letters.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1_NEAR_DEDUP = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM words
), classes AS (
  SELECT list_sort(s) AS s, min(doc_id) AS class FROM sets WHERE len(s) > 0 GROUP BY ALL
), items AS (
  SELECT class, len(s) AS n, unnest(s) AS item FROM classes
), shared AS (
  SELECT a.class AS a, b.class AS b, a.n + b.n AS total, count(*) AS i
  FROM items a JOIN items b ON a.item = b.item AND a.class < b.class
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * i >= 80 * (total - i)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT class, class AS other FROM classes
  UNION
  SELECT r.class, l.b FROM reach r JOIN both_ways l ON r.other = l.a
), lowest AS (
  SELECT class, min(other) AS component FROM reach GROUP BY class
)
SELECT x.doc_id, len(x.s)::BIGINT AS n_shingles, coalesce(l.component, x.doc_id) AS component_id,
  x.doc_id = coalesce(l.component, x.doc_id) AS kept
FROM sets x LEFT JOIN classes c ON c.s = list_sort(x.s) LEFT JOIN lowest l ON l.class = c.class
"""


OP7_HOST_RULES = r"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS p, unnest(list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4))) AS g
  FROM words WHERE len(w) >= 5
), repeated AS (
  SELECT doc_id, p FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS times FROM grams
  ) WHERE times > 1
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(following - p, 5)))::BIGINT AS n FROM (
    SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS following FROM repeated
  ) GROUP BY doc_id
), rows AS (
  SELECT x.doc_id, x.source, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM words x LEFT JOIN covered c USING (doc_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM rows
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (
    base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines) AS f
  FROM judged GROUP BY source
), moments AS (
  SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS squares, count(*) / sum(n) AS per FROM hosts
), prior AS (
  SELECT m, CASE WHEN squares - m * m - m * (1 - m) * per > 0
    THEN least(1000.0, greatest(1.0, m * (1 - m) / (squares - m * m - m * (1 - m) * per) - 1)) ELSE 1000.0 END AS strength
  FROM moments
), bad AS (
  SELECT source FROM hosts, prior WHERE (f + m * strength) / (n + strength) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad b WHERE b.source IS NOT DISTINCT FROM j.source) AS kept
FROM judged j
"""

# Ten equal words of twelve, and 80 % of a shorter item of six words or more, hold three equal words in a row: all lines
# on which an item can lie along a document come from a join of three words, and are then compared word by word.
OP4_SPACED_SEED = f"""
WITH items AS (
  SELECT row_number() OVER (ORDER BY text) AS item, item_id, {_WORDS.format(_LOWER)} AS b FROM (
    SELECT text, min(item_id) AS item_id FROM benchmark WHERE text IS NOT NULL GROUP BY text
  )
), docs AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS d FROM documents
), item_threes AS (
  SELECT item, unnest(range(0, len(b) - 2)) AS i, unnest(list_transform(range(1, len(b) - 1), lambda k: b[k] || ' ' || b[k + 1] || ' ' || b[k + 2])) AS three
  FROM items WHERE len(b) >= 6
), doc_threes AS (
  SELECT doc_id, unnest(range(0, len(d) - 2)) AS j, unnest(list_transform(range(1, len(d) - 1), lambda k: d[k] || ' ' || d[k + 1] || ' ' || d[k + 2])) AS three
  FROM docs WHERE len(d) >= 3
), lines AS (
  SELECT DISTINCT doc_id, item, j - i AS shift FROM doc_threes JOIN item_threes USING (three)
), compared AS (
  SELECT doc_id, item, item_id, greatest(0, shift) AS start, least(12, len(b)) AS span,
    list_transform(range(greatest(0, shift), least(len(d), shift + len(b))), lambda k: (d[k + 1] = b[k - shift + 1])::INTEGER) AS same
  FROM lines JOIN items USING (item) JOIN docs USING (doc_id)
), windows AS (
  SELECT *, list_filter(range(0, len(same) - span + 1), lambda k: 100 * list_sum(same[k + 1:k + span]) >= 80 * span) AS good FROM compared
), found AS (
  SELECT doc_id, item, item_id, start + good[1] AS start_word, good[-1] + span - good[1] AS n_words,
    list_sum(same[good[1] + 1:good[-1] + span]) AS n_equal
  FROM windows WHERE len(good) > 0
)
SELECT doc_id, item_id, best.s::BIGINT AS start_word, best.n::BIGINT AS n_words, best.e::BIGINT AS n_equal, n_overlaps FROM (
  SELECT doc_id, item_id, arg_max({{'e': n_equal, 'n': n_words, 's': start_word}}, (n_equal, n_words, -start_word)) AS best, count(*) AS n_overlaps
  FROM found GROUP BY doc_id, item, item_id
)
"""


# The checksum is stated bit by bit: a table of 256 entries from the polynomial, then one step per byte.
OP5_BYTE_SHARDS = """
WITH RECURSIVE bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), entries AS (
  SELECT list(c ORDER BY i) AS e FROM bits WHERE k = 8
), codes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 16 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), sums AS (
  SELECT doc_id, size, CASE WHEN size = 16 THEN 0 ELSE xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, size - 16), lambda k: ('0x' || substr(h, (2 * k + 1)::BIGINT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, e[(xor(c, b) & 255) + 1]))) END AS text_crc32
  FROM codes, entries
), placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total,
    row_number() OVER (ORDER BY doc_id) AS number FROM sums
), cut AS (
  SELECT *, least(39, ((2 * before + size) * 40) // (2 * total))::INTEGER AS shard FROM placed
)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
  (number - min(number) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
"""


OP9_ZIP_WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM payloads
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < response THEN response END AS refers_to
FROM firsts
"""

# Two rounds, each an assignment of all parts and a new codebook.
_ASSIGNED = """
  SELECT p.row, p.part, p.v, arg_min(b.entry, b.far * 64 + b.entry) AS entry, min(b.far) AS far FROM parts p, LATERAL (
    SELECT c.entry, list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i])))::BIGINT AS far
    FROM {book} c WHERE c.part = p.part
  ) b GROUP BY p.row, p.part, p.v
"""
_UPDATED = """
  SELECT c.part, c.entry, coalesce(m.v, c.v) AS v FROM {book} c LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS v FROM (
      SELECT part, entry, i, floor(sum(x)::DECIMAL(38, 0) / count(*))::BIGINT AS mean
      FROM (SELECT part, entry, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM {members}) GROUP BY part, entry, i
    ) GROUP BY part, entry
  ) m USING (part, entry)
"""
OP11_RESIDENT_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v,
    row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, vec_id, label, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v
  FROM kept, (SELECT unnest(range(16)) AS part)
), book0 AS MATERIALIZED (
  SELECT part, row - 1 AS entry, v FROM parts WHERE row <= 64
), members0 AS MATERIALIZED ({_ASSIGNED.format(book="book0")}
), book1 AS MATERIALIZED ({_UPDATED.format(book="book0", members="members0")}
), members1 AS MATERIALIZED ({_ASSIGNED.format(book="book1")}
), book2 AS MATERIALIZED ({_UPDATED.format(book="book1", members="members1")}
), members2 AS MATERIALIZED ({_ASSIGNED.format(book="book2")}
), codes AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM members2 GROUP BY row
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (row), digest
"""


OP12_DIVERGENCE = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS t FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 30
), sizes AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT lang, source, coalesce(any_value(v), 0) AS v, coalesce(any_value(lang_total), 0) AS lang_total, coalesce(any_value(total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM texts) LEFT JOIN sizes USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) USING (lang, source)
  GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total::HUGEINT + 5 * v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total::HUGEINT + 5 * v) AS q
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), results AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM results
) WHERE part = 'pair' OR rank <= 50
"""


OP13_LINE_RUNS = """
WITH lines AS (
  SELECT row, doc_id, unnest(l) AS line, unnest(range(len(l))) AS place FROM (
    SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
  )
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
  SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.first AS gone FROM keyed k LEFT JOIN firsts f ON f.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": OP1_NEAR_DEDUP,
        "op4_spaced_seed": OP4_SPACED_SEED,
        "op5_byte_shards": OP5_BYTE_SHARDS,
        "op7_host_rules": OP7_HOST_RULES,
        "op9_zip_warc": OP9_ZIP_WARC,
        "op11_resident_codes": OP11_RESIDENT_CODES,
        "op12_divergence": OP12_DIVERGENCE,
        "op13_line_runs": OP13_LINE_RUNS,
    }
