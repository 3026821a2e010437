"""DuckDB SQL for the queries that SQL can express."""

QUALITY = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT doc_id, i, CASE WHEN lead(word, 7) OVER o IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER o,
        lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o, lead(word, 6) OVER o,
        lead(word, 7) OVER o) END AS win FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g WHERE win IS NOT NULL)
      WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(8) AS x(k) GROUP BY doc_id),
wc AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
lines AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM lines GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(dup, 0)::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN wc USING (doc_id) LEFT JOIN lc USING (doc_id) LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        10000 * n_symbols // greatest(word_chars, 1) AS symbols, 10000 * n_dup_lines // greatest(n_lines, 1) AS lines,
        10000 * n_repeat_words // greatest(n_words, 1) AS repeats, 100 * word_chars // greatest(n_words, 1) AS length
      FROM m),
long AS (SELECT lang, source, measure, v - v % (1::BIGINT << greatest(length(bin(v)) - 6, 0)::INT) AS bucket
         FROM (SELECT lang, source, unnest(['symbols', 'lines', 'repeats', 'length']) AS measure,
               unnest([symbols, lines, repeats, length]) AS v FROM b WHERE NOT base_failed)),
sk AS (SELECT lang, source, measure, bucket, count(*) AS n FROM long GROUP BY ALL),
own AS (SELECT lang, source, measure, max(total) AS total, min(bucket) FILTER (4 * upto >= total) AS q1,
          min(bucket) FILTER (4 * upto >= 3 * total) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
                sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM sk) GROUP BY ALL),
wide AS (SELECT lang, measure, min(bucket) FILTER (4 * upto >= total) AS q1,
           min(bucket) FILTER (4 * upto >= 3 * total) AS q3
         FROM (SELECT *, sum(n) OVER (PARTITION BY lang, measure ORDER BY bucket) AS upto,
                 sum(n) OVER (PARTITION BY lang, measure) AS total
               FROM (SELECT lang, measure, bucket, sum(n) AS n FROM sk GROUP BY ALL)) GROUP BY ALL),
p AS (SELECT own.lang, own.source, own.measure, CASE WHEN own.total < 100 THEN wide.q1 ELSE own.q1 END AS q1,
        CASE WHEN own.total < 100 THEN wide.q3 ELSE own.q3 END AS q3
      FROM own JOIN wide ON own.lang IS NOT DISTINCT FROM wide.lang AND own.measure = wide.measure),
f AS (SELECT lang, source, max(q3 + 3 * (q3 - q1) + 500) FILTER (measure = 'symbols') AS symbols_most,
        max(q3 + 3 * (q3 - q1) + 4000) FILTER (measure = 'lines') AS lines_most,
        max(q3 + 3 * (q3 - q1) + 3000) FILTER (measure = 'repeats') AS repeats_most,
        max(q3 + 3 * (q3 - q1) + 150) FILTER (measure = 'length') AS length_most,
        max(q1 - 3 * (q3 - q1) - 150) FILTER (measure = 'length') AS length_least FROM p GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(symbols <= symbols_most AND lines <= lines_most AND repeats <= repeats_most
    AND length <= length_most AND length >= length_least, true) AS kept
FROM b LEFT JOIN f ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
"""

SHARDING = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
bytes AS (SELECT doc_id, t, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::UINTEGER) AS bs FROM d),
crc_table AS (SELECT list(v ORDER BY i) AS crcs FROM (SELECT i, list_reduce(list_prepend(i::UINTEGER, range(8)::UINTEGER[]),
    lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UINTEGER) ELSE a >> 1 END) AS v FROM range(256) AS x(i))),
sums AS (SELECT doc_id, len(bs) AS n_bytes, xor(list_reduce(list_prepend(4294967295::UINTEGER, bs),
    lambda a, b: xor(a >> 8, crcs[(xor(a, b) & 255) + 1])), 4294967295::UINTEGER)::BIGINT AS crc FROM bytes, crc_table),
jump AS (
  SELECT doc_id, n, (coalesce(doc_id, -1)::HUGEINT + 18446744073709551616::HUGEINT) % 18446744073709551616::HUGEINT AS k,
    -1::BIGINT AS b, 0::BIGINT AS j FROM documents, (VALUES (40), (41)) AS s(n)
  UNION ALL
  SELECT doc_id, n, nk AS k, j AS b,
    floor((j + 1) * (2147483648.0::DOUBLE / ((nk >> 33) + 1)::DOUBLE))::BIGINT AS j
  FROM (SELECT *, ((k::UHUGEINT * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT)::HUGEINT AS nk
        FROM jump WHERE j < n)),
placed AS (SELECT doc_id, max(b) FILTER (n = 40) AS shard, max(b) FILTER (n = 41) AS grown FROM jump GROUP BY doc_id)
SELECT doc_id, (n_bytes + 16)::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INT AS shard,
  grown::INT AS grown_shard, (row_number() OVER (PARTITION BY shard
    ORDER BY substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 8), doc_id, crc, n_bytes) - 1)::BIGINT AS slot
FROM sums JOIN placed USING (doc_id)
"""

URLS = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM pages),
h AS (SELECT page_id, translate(regexp_extract(tail, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT h.*, r.rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC NULLS LAST) AS k
  FROM h LEFT JOIN (VALUES ('net', '/', 'net/', 'block'), ('example.net', '/en/', 'example.net/en/', 'allow'),
      ('example.com', '/de/', 'example.com/de/', 'block'), ('org', '/fr/', 'org/fr/', 'allow')) AS r(rh, rp, rule, verdict)
  ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1
"""

MIXING = r"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
s AS (SELECT sum(n) AS total FROM n),
w AS (SELECT source, n, CASE WHEN source = 'src0' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM n),
r AS (SELECT source, total::DOUBLE * weight / (sum(weight) OVER () * n) AS rate FROM w, s),
c AS (SELECT source, greatest(ceil(rate / 8.0::DOUBLE), 1)::INT AS pieces, rate / greatest(ceil(rate / 8.0::DOUBLE), 1)::INT AS mean FROM r),
t AS (SELECT source, pieces, list_reduce(list_prepend({'k': 0::DOUBLE, 'p': exp(-mean), 'cdf': [exp(-mean)]},
      list_transform(range(1, 64), lambda k: {'k': k::DOUBLE, 'p': mean, 'cdf': [0::DOUBLE]})),
      lambda a, x: {'k': x.k, 'p': a.p * x.p / x.k, 'cdf': list_append(a.cdf, a.cdf[-1] + a.p * x.p / x.k)}).cdf AS cdf FROM c),
k AS (SELECT d.*, md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, 'null'))) AS key, pieces, cdf
      FROM documents d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
drawn AS (SELECT *, list_sum(list_transform(range(1, pieces + 1), lambda i: len(list_filter(cdf, lambda c: c <=
      ('0x' || substr(md5('mix:' || key || ':' || i), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE))))::INT AS copies FROM k)
SELECT doc_id, text, lang, source, n_chars, x.i::INT AS copy, md5('mix:' || key || ':' || x.i) AS mix_order
FROM drawn, LATERAL (SELECT unnest(range(1, copies + 1)) AS i) AS x
"""

LEXICAL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), g),
m AS (SELECT rid, doc_id, (10 + (90 * len(ts)::BIGINT * n_docs) // greatest(n_terms, 1))::BIGINT AS m FROM d, g),
s AS (SELECT item_id, rid, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM s JOIN m USING (rid) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) <= 10
"""


def _covered(length: int) -> str:
    """Windows of bytes by hashes of doubled lengths; a byte goes if a window that occurs twice covers it."""
    levels, held, at = [], None, 0
    for e in range(length.bit_length()):
        size = 1 << e
        if e:
            levels.append(f"l{e} AS (SELECT rid, i, hash(x, lead(x, {size // 2}) OVER o) AS x"
                          + (f", hash(held, lead(x, {at}) OVER o) AS held" if held and (length >> (e - 1)) & 1
                             else (", x AS held" if (length >> (e - 1)) & 1 else (", held" if held else "")))
                          + f" FROM l{e - 1} WINDOW o AS (PARTITION BY rid ORDER BY i))")
            if (length >> (e - 1)) & 1:
                held, at = True, at + size // 2
    top = length.bit_length() - 1
    last = f"hash(held, lead(x, {at}) OVER o)" if held else "x"
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT rid, doc_id, octet_length(b) AS n FROM d),
l0 AS (SELECT rid, unnest(bs) AS x, generate_subscripts(bs, 1) AS i FROM (SELECT rid, regexp_extract_all(hex(b), '..') AS bs FROM d)),
{", ".join(levels)},
win AS (SELECT rid, i, CASE WHEN i + {length - 1} <= n THEN {last} END AS x FROM l{top} JOIN n USING (rid)
        WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT x FROM win WHERE x IS NOT NULL GROUP BY x HAVING count(*) > 1),
marked AS (SELECT rid, i, coalesce(max(CASE WHEN rep.x IS NOT NULL THEN i END) OVER (PARTITION BY rid ORDER BY i) > i - {length}, false)
             AS gone FROM win LEFT JOIN rep ON win.x = rep.x),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), false) AS opens FROM marked),
left_over AS (SELECT rid, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
                string_agg(l0.x, '' ORDER BY i) FILTER (NOT gone) AS kept FROM edges JOIN l0 USING (rid, i) GROUP BY rid)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM n LEFT JOIN left_over USING (rid)
"""


def _clusters(k: int, rounds: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(rf"""a{r} AS MATERIALIZED (SELECT rid, c, d FROM (SELECT rid, c, sum((x - y) * (x - y))::BIGINT AS d
  FROM x JOIN c{r} USING (j) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(rf"""c{r + 1} AS MATERIALIZED (SELECT c, j, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END::BIGINT AS y
  FROM c{r} LEFT JOIN (SELECT c, j, sum(x) AS s, count(*) AS n FROM x JOIN a{r} USING (rid) GROUP BY ALL) USING (c, j))""")
    return rf"""
WITH k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
x AS MATERIALIZED (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM k),
c0 AS MATERIALIZED (SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS j FROM (SELECT v,
  row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, 'null')), v) - 1 AS c FROM k) WHERE c < {k}),
{", ".join(steps)},
sums AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY c),
named AS (SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c::INT AS cluster, d AS distance, cluster_inertia, (SELECT sum(d) FROM a{rounds})::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN k USING (rid) JOIN sums USING (c) JOIN named USING (c)
"""


ORACLES = {"op1_quality_rules": QUALITY, "op3_jump_sharding": SHARDING, "op4_url_trie": URLS,
           "op10_poisson_mixing": MIXING, "op11_bag_search": LEXICAL,
           "op12_run_index": _covered(200), "op13_threshold_clusters": _clusters(8, 10)}
