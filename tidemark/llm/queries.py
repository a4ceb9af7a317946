"""The registered queries of this package: name to a callable of (spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, decontaminate, html_text, language, licenses, line_dedup, minhash, phrases, pii, quality_rules, resample, secrets, warc,
)
from tidemark.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    count = lambda spans, kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count("base_spans", kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(secrets.listed("base_spans"), 256).alias("base_sha256"),
        secrets.listed("spans").alias("spans"),
        count("spans", "markov").alias("n_markov"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = decontaminate.mark(docs, documents(spark, sf_dir, "benchmark"), keep_text=False, text_left=False)
    return decontaminate.judged(marked).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(documents(spark, sf_dir))


def capture_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive records made from ``pages``: of each page a response, a revisit an hour later that changes nothing,
    and a third. For a third of the pages that is a revisit of one portal, for a thirtieth a response of it, else a
    revisit with other validators."""
    pages = documents(spark, sf_dir, "pages").select("page_id", "url", F.sha1("html").alias("sha"), F.length("html").alias("n"))
    own = pages.withColumn("at", F.expr("1704067200 + page_id * 7919 % 1000003"))
    rows = """
      array(
        named_struct('nth', 0, 'url', url, 'at', at, 'kind', 'response', 'digest', sha, 'headers', map(
          'Content-Type', 'text/html', 'Content-Length', cast(n as string), 'ETag', left(sha, 12),
          'Last-Modified', cast(at as string), 'Cache-Control', 'no-cache', 'Date', cast(at as string))),
        named_struct('nth', 1, 'url', concat(url, '#top'), 'at', at + 3600, 'kind', 'revisit', 'digest', sha, 'headers', map(
          'Content-Length', '0', 'etag', left(sha, 12), 'cache-control', 'max-age=60', 'Date', cast(at + 3600 as string))),
        named_struct('nth', 2, 'url', if(page_id % 3 = 0 or page_id % 30 = 1, 'http://www.portal.example/', url),
          'at', at - 60, 'kind', if(page_id % 30 = 1, 'response', 'revisit'), 'digest', string(null), 'headers', map(
          'Content-Length', '1', 'ETag', if(page_id % 3 = 0, 'portal', concat('p', if(page_id % 60 = 1, 'ortal', ''))),
          'Date', cast(at - 60 as string))))"""
    return own.select("page_id", F.explode(F.expr(rows)).alias("r")).select(
        (F.col("page_id") * 3 + F.col("r.nth")).alias("record_id"), "r.url", F.timestamp_seconds("r.at").alias("time"),
        "r.kind", "r.digest", "r.headers",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve(capture_records(spark, sf_dir))
    listed = "array_join(transform(array_sort(map_entries(headers)), e -> concat(e.key, ': ', e.value)), '\n')"
    return resolved.withColumn("headers", F.expr(listed))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(documents(spark, sf_dir)))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.texts(pages, html_text.fit(pages))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def tokenizer_file() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_file())


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs), keep_text=False)
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.top(phrases.mine(documents(spark, sf_dir)))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.scan(documents(spark, sf_dir).select("doc_id", "text"), keep_text=False))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_secrets": op1_secrets,
    "op2_decontaminate": op2_decontaminate,
    "op3_line_dedup": op3_line_dedup,
    "op4_warc": op4_warc,
    "op5_licenses": op5_licenses,
    "op6_html_text": op6_html_text,
    "op7_quality_rules": op7_quality_rules,
    "op8_minhash": op8_minhash,
    "op9_bpe": op9_bpe,
    "op10_language": op10_language,
    "op11_phrases": op11_phrases,
    "op12_pii": op12_pii,
    "op13_resample": op13_resample,
}

# --- SQL ----------------------------------------------------------------------

UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
LOWERED = f"translate(text, {UPPER}, lower({UPPER}))"
WORDS_SQL = rf"coalesce(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP2_SQL = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS_SQL} AS w FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 12) AS p
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(p) AS n FROM phrases),
docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
places AS (
  SELECT r, i, n, list_slice(w, i, i + n - 1) AS p
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, i, n, item_id FROM places JOIN phrases USING (p)),
hit_words AS (SELECT r, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

# Two lines are one edit apart if leaving out one character at one place makes them equal, or one of them the other.
OP3_SQL = r"""
WITH pieces AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
lines AS (
  SELECT doc_id, i - 1 AS nth, trim(p[i], ' ' || chr(9) || chr(13)) AS line FROM pieces, unnest(range(1, len(p) + 1)) AS t(i)),
taken AS (SELECT * FROM lines WHERE line <> ''),
firsts AS (SELECT line, min((doc_id, nth)) AS f FROM taken GROUP BY line),
long AS (SELECT * FROM firsts WHERE length(line) >= 10),
variants AS (
  SELECT line, f, hash('changed', i, line[:i - 1] || line[i + 1:]) AS v FROM long, unnest(range(1, length(line) + 1)) AS t(i)
  UNION ALL
  SELECT line, f, hash('extra', i, line[:i - 1] || line[i + 1:]) FROM long, unnest(range(1, length(line) + 1)) AS t(i)
  UNION ALL
  SELECT line, f, hash('extra', i, line) FROM long, unnest(range(1, length(line) + 2)) AS t(i)),
least AS (SELECT v, min(f) AS f FROM variants GROUP BY v),
near AS (SELECT DISTINCT line FROM variants JOIN least USING (v) WHERE variants.f > least.f),
gone AS (
  SELECT doc_id, count(*) AS n_removed, string_agg(CAST(nth AS VARCHAR), ',' ORDER BY nth) AS removed
  FROM taken JOIN firsts USING (line) WHERE line IN (SELECT line FROM near) OR (doc_id, nth) > f GROUP BY doc_id),
counted AS (SELECT doc_id, count(*) AS n_lines FROM taken GROUP BY doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed
FROM documents LEFT JOIN counted USING (doc_id) LEFT JOIN gone USING (doc_id)
"""

# The portal is of every third page; each record's headers are known from what made it.
OP4_SQL = r"""
WITH own AS (
  SELECT page_id, url, sha1(html) AS sha, length(html) AS n, 1704067200 + page_id * 7919 % 1000003 AS t FROM pages),
records AS (
  SELECT page_id * 3 AS id, url, t, false AS again, sha AS digest, left(sha, 12) AS etag, CAST(t AS VARCHAR) AS modified,
    'no-cache' AS cache, 'text/html' AS kind, CAST(n AS VARCHAR) AS size, t AS date FROM own
  UNION ALL
  SELECT page_id * 3 + 1, url || '#top', t + 3600, true, sha, left(sha, 12), NULL, 'max-age=60', NULL, '0', t + 3600 FROM own
  UNION ALL
  SELECT page_id * 3 + 2, CASE WHEN page_id % 3 = 0 OR page_id % 30 = 1 THEN 'http://www.portal.example/' ELSE url END,
    t - 60, page_id % 30 <> 1, NULL,
    CASE WHEN page_id % 3 = 0 OR page_id % 60 = 1 THEN 'portal' ELSE 'p' END, NULL, NULL, NULL, '1', t - 60 FROM own),
bare AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?', '') AS u
  FROM records),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^([^/?]*)', 1)), '^www\d*\.', ''), ':(?:80|443)$', '') AS host,
    regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_filter(list_sort(string_split(regexp_extract(u, '\?(.*)$', 1), '&')), lambda p: p <> '' AND NOT
      regexp_matches(lower(p), '^(?:utm_[a-z]+|ref|sid|sessionid|phpsessid|jsessionid)(?:=|$)')), '&') AS query FROM bare),
named AS (SELECT * EXCLUDE (u, url), host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url FROM parts),
ranked AS (
  SELECT v.*, r.id AS r_id, r.etag AS r_etag, r.digest AS r_digest, r.modified AS r_modified, r.cache AS r_cache,
    r.kind AS r_kind, r.size AS r_size,
    row_number() OVER (PARTITION BY v.id ORDER BY r.t DESC, r.id DESC) AS nth
  FROM named AS v LEFT JOIN named AS r ON v.url = r.url AND NOT r.again AND r.t <= v.t WHERE v.again),
judged AS (
  SELECT *, CASE WHEN r_id IS NULL THEN 'missing'
    WHEN coalesce(etag = r_etag, digest = r_digest, modified = r_modified, false) THEN 'resolved' ELSE 'changed' END AS status
  FROM ranked WHERE nth = 1)
SELECT id AS revisit_id, url, r_id AS response_id, status,
  CASE WHEN status = 'resolved' THEN concat_ws(chr(10),
    'cache-control: ' || coalesce(cache, r_cache), 'content-length: ' || r_size, 'content-type: ' || r_kind,
    'date: ' || date, 'etag: ' || etag, 'last-modified: ' || coalesce(modified, r_modified)) END AS headers
FROM judged
"""

def _template_rows() -> str:
    quoted = [(label, text.replace("'", "''")) for label, text in licenses.EVERY]
    rows = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(quoted))
    return f"(VALUES {rows}) AS v(template, label, text)"


def _phrase_rows() -> str:
    return "(VALUES " + ", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES.items()) + ") AS v(phrase, label)"


OP5_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
phrases AS (SELECT string_split(phrase, ' ') AS p, label FROM {_phrase_rows()}),
places AS (
  SELECT r, i - 1 AS first, label FROM docs, phrases, unnest(range(1, len(w) - len(p) + 2)) AS t(i)
  WHERE list_slice(w, i, i + len(p) - 1) = p),
base AS (
  SELECT r, count(*) AS n_base, min(first) AS first_word, max(first) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY r),
templates AS (SELECT template, label, {WORDS_SQL} AS w FROM {_template_rows()}),
template_grams AS (
  SELECT template, label, len(w) - 3 AS n, i AS place, list_slice(w, i, i + 3) AS g
  FROM templates, unnest(range(1, len(w) - 2)) AS t(i)),
matches AS (
  SELECT r, template, label, n, place, i AS nth
  FROM (SELECT r, i, list_slice(w, i, i + 3) AS g FROM docs, unnest(range(1, len(w) - 2)) AS t(i)) JOIN template_grams USING (g)),
steps AS (
  SELECT *, nth - place AS diagonal,
    CASE WHEN nth - place - lag(nth - place) OVER (PARTITION BY r, template ORDER BY nth - place) > 3 THEN 1 ELSE 0 END AS new
  FROM matches),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS part FROM steps),
merged AS (
  SELECT r, template, label, count(DISTINCT place) / n AS cover, max(nth) + 4 - min(nth) AS size, n
  FROM grouped GROUP BY r, template, label, n, part),
found AS (
  SELECT r, max(cover) AS cover, list(DISTINCT label) AS labels FROM merged
  WHERE cover >= 0.6 AND size <= 1.5 * (n + 3) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
  greatest(coalesce(cover, 0), CASE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END) AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""

SPACED_SQL = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"

OP7_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {SPACED_SQL.format('text')} AS w,
    {SPACED_SQL.format(LOWERED)} AS content FROM documents),
windows AS (SELECT r, i, list_slice(w, i, i + 7) AS g FROM docs, unnest(range(1, len(w) - 6)) AS t(i)),
twice AS (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1),
repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM windows JOIN twice USING (r, g), unnest(range(i, i + 8)) AS u(j) GROUP BY r),
pieces AS (SELECT r, source, content, string_split(text, chr(10)) AS p FROM docs),
lines AS (
  SELECT r, source, content, text AS line, {SPACED_SQL.format(LOWERED)} AS words
  FROM (SELECT r, source, content, unnest(p) AS text FROM pieces)),
full_lines AS (SELECT * FROM lines WHERE len(words) > 0),
later AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY r),
common AS (
  SELECT source, words FROM full_lines GROUP BY source, words HAVING count(DISTINCT content) > 10),
taken AS (
  SELECT r, sum(len(l.words)) AS n FROM full_lines AS l
  JOIN common AS c ON l.words = c.words AND l.source IS NOT DISTINCT FROM c.source GROUP BY r),
counted AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(later.n, 0) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words, CAST(coalesce(taken.n, 0) AS BIGINT) AS n_common_words
  FROM docs LEFT JOIN later USING (r) LEFT JOIN repeated USING (r) LEFT JOIN taken USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 2 * (n_words - n_common_words) >= n_words AS kept
FROM counted
"""

OP8_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, list_slice(w, i, i + 4) AS s
  FROM docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingles AS a JOIN shingles AS b USING (s)
  WHERE a.r <> b.r GROUP BY a.r, b.r),
links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.r = a JOIN sizes AS y ON y.r = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT r AS a, r AS b FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
smallest AS (
  SELECT reach.a AS r, min(docs.doc_id) AS component_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN smallest USING (r) LEFT JOIN sizes USING (r)
"""

OP11_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
spelled AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, list_slice(w, i, i + k - 1) AS p, count(*) AS f
  FROM spelled, unnest(range(1, 5)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY lang, p),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT lang, p, f AS a FROM grams WHERE len(p) > 1 AND f >= 30),
cuts AS (
  SELECT c.lang, c.p, c.a, k, x.f AS l, y.f AS r, CAST(2000000::HUGEINT * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM candidates) AS c
  JOIN grams AS x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, k)
  JOIN grams AS y ON y.lang = c.lang AND y.p = list_slice(c.p, k + 1, len(c.p))),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, list_slice(p, i, i + k - 1) AS p, max(a) AS a
  FROM candidates, unnest(range(2, len(p))) AS s(k), unnest(range(1, len(p) - k + 2)) AS t(i) GROUP BY ALL),
kept AS (
  SELECT lang, array_to_string(w.p, ' ') AS phrase, w.a, l, r, score
  FROM worst AS w LEFT JOIN inner_phrases AS o USING (lang, p) WHERE o.a IS NULL OR 100 * o.a < 80 * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# CRC-32 bit by bit over the bytes of each distinct word.
OP13_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
items AS (SELECT {WORDS_SQL} AS w FROM benchmark),
words AS (SELECT DISTINCT w FROM (SELECT unnest(w) AS w FROM docs UNION ALL SELECT unnest(w) FROM items)),
bytes AS (SELECT w, list_transform(range(0, len(hex(encode(w))) // 2),
    lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS UBIGINT)) AS b FROM words),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::UBIGINT, b), lambda crc, byte: list_reduce(
    list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::UBIGINT)),
    lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT) % 10000 AS bucket
  FROM bytes),
parts AS (SELECT r, bucket FROM (SELECT r, unnest(w) AS w FROM docs) JOIN hashed USING (w)),
source AS (SELECT bucket, count(*) AS s FROM parts GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS w FROM items) JOIN hashed USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM parts) + 10000 AS s, (SELECT coalesce(sum(t), 0) FROM target) + 10000 AS t),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(target.t, 0) + 1)::DOUBLE * sums.s::DOUBLE
    / ((source.s + 1)::DOUBLE * sums.t::DOUBLE)))::BIGINT AS gain
  FROM source LEFT JOIN target USING (bucket), sums),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM parts JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS UBIGINT)::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS nth,
    count(*) OVER (PARTITION BY n_features >= 20) AS able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND nth <= 10 * able // 100 THEN nth END AS rank FROM ranked
"""

ORACLES: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op4_warc": OP4_SQL,
    "op5_licenses": OP5_SQL,
    "op7_quality_rules": OP7_SQL,
    "op8_minhash": OP8_SQL,
    "op2_decontaminate": OP2_SQL,
    "op11_phrases": OP11_SQL,
    "op13_resample": OP13_SQL,
}
