"""DuckDB SQL for the queries that SQL can express."""

from plumbline.llm.licenses import RULES, SENTENCES, normalise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP4 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path
  FROM cut
), judged AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
    '.' || host || '|' || path AS whole
  FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
  WHEN rule IS NOT NULL THEN 'block'
  WHEN whole LIKE '%.casino%' OR whole LIKE '%.free-bets.%' OR whole LIKE '%.cheap-pills.%'
    OR whole LIKE '%.spam-farm.%' OR whole LIKE '%.adult-_.%' OR whole LIKE '%.ads-%.%' THEN 'block'
  ELSE 'allow' END AS verdict
FROM judged
"""

OP5 = f"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, nr, lines[nr] AS line, translate(trim(lines[nr],
    chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS nr FROM cut)
), repeated AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT doc_id, nr, line, coalesce(lines.doc_id <> owner, false) AS gone
  FROM lines LEFT JOIN repeated USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = f"""regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

OP6 = f"""
WITH items AS (
  SELECT item_id, {_WORDS} AS words FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
    array_to_string(words[i : i + least(10, len(words)) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i
        FROM items WHERE len(words) > 0)
), docs AS (
  SELECT doc_id, {_WORDS} AS words FROM documents
), grams AS (
  SELECT doc_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows))
), found AS (
  SELECT doc_id, i, grams.size, item_id FROM grams JOIN windows USING (win)
), hit AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS w FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""



def _op3() -> str:
    """The known sentences as a table, each text cut and named in SQL, the rules as a chain of
    replacements."""
    known = ", ".join(
        f"('{normalise(t)}', '{name}')" for name, texts in SENTENCES.items() for t in texts
    )
    steps, chain = [], "chain"
    for k, rule in enumerate(RULES):
        wanted = "|" + "||".join(rule.sequence) + "|"
        steps.append((f"contains({chain}, '{wanted}')", rule.licence, k))
        chain = f"replace({chain}, '{wanted}', '|-|')"
    licences = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name, _ in steps)
    return f"""
WITH known(sentence, name) AS (VALUES {known}), cut AS (
  SELECT doc_id, string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '\\n|(?:[.!?:][ \\t\\r]+)') AS parts FROM documents
), parts AS (
  SELECT doc_id, nr, trim(regexp_replace(parts[nr], '[^a-z0-9]+', ' ', 'g')) AS sentence
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS nr FROM cut)
), named AS (
  SELECT doc_id, nr, CASE WHEN starts_with(sentence, 'copyright ')
    AND regexp_matches(sentence, ' [12][0-9]{{3}}( |$)') THEN 'copyright' ELSE known.name END AS name
  FROM parts LEFT JOIN known USING (sentence)
), listed AS (
  SELECT doc_id, string_agg(name, ',' ORDER BY nr) AS ids,
    coalesce(string_agg('|' || name || '|', '' ORDER BY nr) FILTER (name <> 'copyright'), '') AS chain
  FROM named WHERE name IS NOT NULL GROUP BY doc_id
), ruled AS (
  SELECT doc_id, ids, [{licences}] AS found, {chain} AS rest FROM listed
)
SELECT doc_id, coalesce(ids, '') AS sentence_ids,
  coalesce(array_to_string([x FOR x, i IN found IF x IS NOT NULL AND list_position(found, x) = i], ','), '') AS licences,
  coalesce(len([x FOR x IN string_split(rest, '|') IF x <> '' AND x <> '-']), 0) AS n_unused
FROM documents LEFT JOIN ruled USING (doc_id)
"""


OP9 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, list_sort(list_distinct(
    [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, greatest(len(ws) - 4, CASE WHEN ws = [] THEN 0 ELSE 1 END) + 1)])) AS s
  FROM words
), classes AS MATERIALIZED (
  SELECT min(doc_id) AS rep, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), tokens AS MATERIALIZED (
  SELECT rep, n, unnest(s) AS h FROM classes
), links AS MATERIALIZED (
  SELECT a.rep AS x, b.rep AS y FROM tokens a JOIN tokens b ON a.h = b.h AND a.rep < b.rep
    AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)
), ways AS MATERIALIZED (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT x, x AS y FROM ways UNION SELECT reach.x, ways.y FROM reach JOIN ways ON reach.y = ways.x
), least AS (
  SELECT x AS rep, min(y) AS low FROM reach GROUP BY x
)
SELECT d.doc_id, len(d.s)::BIGINT AS n_shingles, coalesce(low, c.rep, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON c.s = d.s AND len(d.s) > 0 LEFT JOIN least USING (rep)
"""

OP11 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces
), starts AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words
), totals AS (
  SELECT lang, count(*) AS n FROM starts GROUP BY lang
), f1 AS (
  SELECT lang, ws[i] AS w1, count(*) AS f FROM starts GROUP BY ALL
), f2 AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, count(*) AS f FROM starts WHERE i + 1 <= len(ws) GROUP BY ALL
), f3 AS (
  SELECT lang, ws[i] AS w1, ws[i + 1] AS w2, ws[i + 2] AS w3, count(*) AS f
  FROM starts WHERE i + 2 <= len(ws) GROUP BY ALL
), within AS (
  SELECT lang, w1, w2, max(f) AS longer FROM (
    SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3
  ) WHERE f >= 10 GROUP BY ALL
), cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 c LEFT JOIN within USING (lang, w1, w2)
  JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2
  WHERE c.f >= 10 AND NOT coalesce(100 * longer >= 50 * c.f, false)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1
  JOIN f2 y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3 WHERE c.f >= 10
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2
  JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w3 WHERE c.f >= 10
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM scored JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

OP12 = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, coalesce(html, '') AS payload,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), groups AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
    THEN max(page_id) OVER (PARTITION BY payload_digest, payload) ELSE page_id END AS original
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = original THEN NULL ELSE original END AS refers_to
FROM groups
"""

_ROUND = """
, near{r} AS MATERIALIZED (
  SELECT x.vec_id, x.label, x.p, x.v, arg_min(b.e, (list_distance2(x.v, b.v) * 64 + b.e)) AS e,
    min(list_distance2(x.v, b.v)) AS d
  FROM parts x JOIN book{r} b USING (p) GROUP BY ALL
)"""

_UPDATE = """
, sums{n} AS (
  SELECT p, e, j, sum(v[j])::HUGEINT AS s, count(*) AS c
  FROM (SELECT p, e, v, unnest(range(1, len(v) + 1)) AS j FROM near{r}) GROUP BY ALL
), moved{n} AS (
  SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY j)::BIGINT[] AS v FROM sums{n} GROUP BY ALL
), book{n} AS MATERIALIZED (
  SELECT p, e, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN moved{n} m USING (p, e)
)"""


def _codes_sql() -> str:
    """Two rounds of k-means for each of 16 parts, written out."""
    steps = "".join(_ROUND.format(r=r) + _UPDATE.format(r=r, n=r + 1) for r in range(2)) + _ROUND.format(r=2)
    steps = steps.replace("list_distance2(x.v, b.v)", "list_sum([(t[1] - t[2]) * (t[1] - t[2]) FOR t IN list_zip(x.v, b.v)])")
    return f"""
WITH kept AS (
  SELECT vec_id, label, [floor(x::DOUBLE * 256)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS v
  FROM (SELECT *, unnest(range(16)) AS p FROM kept)
), book0 AS MATERIALIZED (
  SELECT p, e, v FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
  ) USING (vec_id) WHERE e < 64
){steps}
, coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
    sum(d)::BIGINT AS error
  FROM near2 GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, j)) FROM (
    SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS j FROM book2)) AS codebooks_sha256
FROM coded
"""


OP13 = _codes_sql()

ORACLES = {
    "op3_license_scan": _op3(),
    "op4_url_filter": OP4,
    "op5_line_dedup": OP5,
    "op6_decontaminate": OP6,
    "op9_ngram_join": OP9,
    "op11_collocations": OP11,
    "op12_warc_revisits": OP12,
    "op13_vector_codes": OP13,
}
