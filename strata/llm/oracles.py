"""DuckDB SQL for the queries of this subpackage that SQL can express.

Constants are written out here and not imported from the operators.
"""

from __future__ import annotations

B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

OP1 = """
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         array_to_string(list_slice(string_split(coalesce(text, ''), ' '), 1, 3), ' ') AS words
  FROM conversations
), calls AS (
  SELECT conv_id, turn, 'call_' || turn AS call_id,
         CASE WHEN turn % 3 = 2 THEN 'search' ELSE 'reply' END AS name, words, length(text) AS len,
         CASE WHEN turn % 8 >= 2 THEN turn - 2 END AS needs
  FROM turns WHERE role = 'assistant'
), answers AS (
  SELECT conv_id, turn - 1 AS turn, min_by(text, (turn, text)) AS result, count(*) AS n_results
  FROM turns WHERE role <> 'assistant' AND turn > 0 GROUP BY ALL
), chain AS (
  SELECT a.conv_id, a.turn, a.needs,
         (a.needs IS NOT NULL AND b.turn IS NULL)::BIGINT AS n_unknown,
         b.turn IS NOT NULL AS d1, c.turn IS NOT NULL AS d2, d.turn IS NOT NULL AS d3
  FROM calls a
  LEFT JOIN calls b ON b.conv_id = a.conv_id AND b.turn = a.needs
  LEFT JOIN calls c ON c.conv_id = b.conv_id AND c.turn = b.needs
  LEFT JOIN calls d ON d.conv_id = c.conv_id AND d.turn = c.needs
), levels AS (
  SELECT conv_id, turn, n_unknown, CASE WHEN NOT d1 THEN 0 WHEN NOT d2 THEN 1 WHEN NOT d3 THEN 2 ELSE 3 END AS level
  FROM chain
), checked AS (
  SELECT c.*, CASE
    WHEN name = 'reply' THEN CASE WHEN len < 1 THEN '/length: below the minimum' WHEN len > 2000 THEN '/length: above the maximum' ELSE '' END
    ELSE CASE WHEN turn % 7 < 1 THEN '/limit: below the minimum' WHEN turn % 7 > 5 THEN '/limit: above the maximum' ELSE '' END
  END AS errors,
  CASE WHEN name = 'reply'
    THEN '{"length":' || len || ',"opening":' || to_json(words)::VARCHAR || '}'
    ELSE '{"limit":' || (turn % 7) || ',"query":' || to_json(words)::VARCHAR || '}' END AS arguments
  FROM calls c
)
SELECT c.conv_id, c.call_id, c.turn, c.name, l.level::BIGINT AS level,
       row_number() OVER (PARTITION BY c.conv_id ORDER BY l.level, c.turn, c.call_id)::BIGINT AS position,
       l.n_unknown, coalesce(a.n_results, 0)::BIGINT AS n_results,
       CASE WHEN errors <> '' THEN 'invalid' WHEN a.n_results > 0 THEN 'linked' ELSE 'unanswered' END AS status,
       errors,
       '{"arguments":' || arguments || ',"id":"' || c.call_id || '","name":"' || c.name || '"' ||
         CASE WHEN a.n_results > 0 THEN ',"result":' || to_json(a.result)::VARCHAR ELSE '' END || '}' AS message
FROM checked c JOIN levels l USING (conv_id, turn) LEFT JOIN answers a USING (conv_id, turn)
"""

# five hex digits of the digest are four base32 digits
OP2 = f"""
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, array_to_string(list_transform(generate_series(0, 31), lambda i:
    substr('{B32}', 1 + ((('0x' || substr(sha1(body), 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest
  FROM bodies
), kept AS (SELECT payload_digest, max(page_id) AS last FROM digests GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM digests JOIN kept USING (payload_digest)
"""

OP7 = r"""
WITH parsed AS (
  SELECT page_id, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), bodies AS (
  SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM parsed WHERE html IS NOT NULL
), entries AS (
  SELECT DISTINCT host || path AS entry FROM bodies WHERE page_id > first_id AND host <> '' AND length(path) > 1
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM parsed
)
SELECT page_id, host, path, rule, CASE rule
    WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block'
    WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
    ELSE CASE WHEN host || path IN (SELECT entry FROM entries) THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled
"""


# common words that the histograms know; every other run of letters is ''
OP4 = r"""
WITH common AS (SELECT unnest(string_split(
  'the of and to in a is that it for as with on be are at this by or was from an have not you '
  || 'der die das und ist den von zu mit sich des auf für im dem nicht ein eine als auch es '
  || 'le la les de des du un une et en que qui dans pour par sur avec est au pas plus ce il '
  || 'el los las y del se por con no su una para es al lo como más pero sus', ' ')) AS word),
d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
listed AS (SELECT rid, list_filter(string_split_regex(text, '[ \x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
tokens AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM listed),
windows AS (
  SELECT rid, i, [word, lead(word) OVER p, lead(word, 2) OVER p] AS three, lead(word, 2) OVER p IS NOT NULL AS whole
  FROM tokens WINDOW p AS (PARTITION BY rid ORDER BY i)
), twice AS (
  SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, three) AS c FROM windows WHERE whole) WHERE c >= 2
), covered AS (
  SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid
), lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^ \x09-\x0D]') GROUP BY rid
), base AS (
  SELECT rid, doc_id, lang, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[ \x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^\p{Ll}]+', '', 'g')) AS c0, length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS c1,
    length(regexp_replace(text, '[^\p{N}]+', '', 'g')) AS c2, length(regexp_replace(text, '[^.,;:!?''"()-]+', '', 'g')) AS c3
  FROM d JOIN listed USING (rid) LEFT JOIN covered c USING (rid) LEFT JOIN lines l USING (rid)
), classes AS (
  SELECT rid, lang, unnest([0, 1, 2, 3, 4]) AS k, unnest([c0, c1, c2, c3, word_chars - c0 - c1 - c2 - c3])::DOUBLE AS n FROM base
), class_shares AS (
  SELECT lang, k, sum(n) / nullif(sum(sum(n)) OVER (PARTITION BY lang), 0) AS q FROM classes GROUP BY lang, k
), class_terms AS (
  SELECT rid, n / nullif(sum(n) OVER (PARTITION BY rid), 0) AS p, q
  FROM classes c JOIN class_shares s ON s.k = c.k AND s.lang IS NOT DISTINCT FROM c.lang
), class_far AS (
  SELECT rid, sqrt(greatest(0, sum(
    (CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2))) AS far
  FROM class_terms WHERE p IS NOT NULL GROUP BY rid
), runs AS (
  SELECT rid, lang, coalesce(c.word, '') AS word, count(*)::DOUBLE AS n
  FROM (SELECT rid, lang, unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS run FROM d) r
  LEFT JOIN (SELECT DISTINCT word FROM common) c ON c.word = r.run WHERE run <> '' GROUP BY rid, lang, c.word
), word_shares AS (
  SELECT lang, word, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM runs GROUP BY lang, word
), word_terms AS (
  SELECT rid, n, n / sum(n) OVER (PARTITION BY rid) AS p, q
  FROM runs r JOIN word_shares s ON s.word = r.word AND s.lang IS NOT DISTINCT FROM r.lang
), word_far AS (
  SELECT rid, sum(n) AS n_runs, sqrt(greatest(0, 0.5 + sum((p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q)) - q) / 2))) AS far
  FROM word_terms GROUP BY rid
), failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(word_chars >= 200 AND c.far > 0.28, false)
         AND NOT coalesce(n_runs >= 150 AND w.far > 0.30, false) AS kept
FROM failed LEFT JOIN class_far c USING (rid) LEFT JOIN word_far w USING (rid)
"""


# CRC-32 by half bytes, the lower half of a byte first; the list has what each half byte does to the register
HALVES = """[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
   3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""


def crc32_of(text: str) -> str:
    """The unsigned CRC-32 of a string's UTF-8 bytes, as an expression."""
    halves = f"list_transform(range(2 * strlen({text})), lambda i: ('0x' || substr(hex({text}), (xor(i, 1) + 1)::INT, 1))::BIGINT)"
    step = f"xor(c >> 4, ({HALVES}::BIGINT[])[(xor(c, x) & 15) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {halves}), lambda c, x: {step}), 4294967295)"


OP11 = rf"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), cut AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
), runs AS (
  SELECT side, id, unnest(list_concat(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM cut
), counted AS (
  SELECT side, id, f, count(*) AS n FROM runs GROUP BY ALL
), buckets AS (
  SELECT f, {crc32_of("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM counted)
), sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM counted JOIN buckets USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM sums
), weights AS (
  SELECT id, sum(n) AS n_features, sum(n * gain) AS weight
  FROM counted JOIN buckets USING (f) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id
), scored AS (
  SELECT id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT
      + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM cut LEFT JOIN weights USING (id) WHERE side = 'd'
), ranked AS (
  SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT id AS doc_id, n_features, weight, score, r AS rank FROM scored LEFT JOIN (SELECT * FROM ranked WHERE r <= 5 * n // 100) USING (id)
"""

_LEAF = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# trees level by level: the runs of 16, and what stands left and right of a node in its run
OP12 = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({_LEAF.format(text="text")}) AS leaf,
    CASE WHEN {crc32_of("doc_id::VARCHAR")} % 5 = 0 THEN sha256({_LEAF.format(text=_LOWERED)}) END AS now,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY source) AS n
  FROM documents
), nodes AS (
  SELECT 0 AS level, source, place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, source, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM nodes WHERE n > 1 GROUP BY level, source, place // 16
), subroots AS (
  SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS level, place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place))
  FROM upper WHERE n > 1 GROUP BY level, place // 16
), runs AS (
  SELECT level, source, place // 16 AS run, list(digest ORDER BY place) AS ds FROM nodes WHERE n > 1 GROUP BY ALL
), upper_runs AS (
  SELECT level, place // 16 AS run, list(digest ORDER BY place) AS ds FROM upper WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT l.doc_id, r.level AS level, r.ds, l.place // (16 ** r.level)::BIGINT % 16 AS pos
  FROM leaves l JOIN runs r ON r.source IS NOT DISTINCT FROM l.source AND r.run = l.place // (16 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT l.doc_id, 1000 + r.level, r.ds, s.place // (16 ** r.level)::BIGINT % 16
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN upper_runs r ON r.run = s.place // (16 ** (r.level + 1))::BIGINT
), paths AS (
  SELECT doc_id, list(array_to_string(ds[1:pos], '') || '|' || array_to_string(ds[pos + 2:], '') ORDER BY level) AS path FROM steps GROUP BY doc_id
), folded AS (
  SELECT l.*, coalesce(path, []) AS path, s.digest AS subroot, (SELECT digest FROM upper WHERE n = 1) AS root
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source LEFT JOIN paths USING (doc_id)
), done AS (
  SELECT *, list_reduce(list_prepend(coalesce(now, leaf), path), lambda d, p: sha256(split_part(p, '|', 1) || d || split_part(p, '|', 2))) AS folded_root
  FROM folded
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM done
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_tool_calls": OP1, "op2_warc_dictionary": OP2, "op4_divergence": OP4, "op7_url_digests": OP7, "op11_resampling": OP11, "op12_merkle_manifest": OP12}
