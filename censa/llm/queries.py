"""Queries over the supplied tables, one per operator of this package."""

from __future__ import annotations

from itertools import permutations
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..session import scratch_path
from . import (bpe, divergence, filter_audit, langid, licenses, packing, quality, secrets, simhash, spotsigs,
               substring_dedup, suffix_dedup, warc)
from .common import read_documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(read_documents(spark, sf_dir)).drop("longest_repeat", "n_maximal")


def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(read_documents(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_documents(spark, sf_dir)).drop("found")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    found = secrets.scan(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op7_doubling_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(read_documents(spark, sf_dir)).drop("kept_text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_documents(spark, sf_dir).select("doc_id", "text", "lang"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_earlier(read_documents(spark, sf_dir)).drop("kept_text")


def op10_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bpe.encode(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_documents(spark, sf_dir))


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, f"warc-{uuid4().hex}")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    back = warc.read_archives(spark, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").checkpoint()
    warc.remove_archives(folder)
    return back


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_spotsigs, op3_simhash_near_dedup, op4_packing, op5_license_scan, op6_secret_scan,
    op7_doubling_dedup, op8_language_id, op9_suffix_array_dedup, op10_bpe_chunks, op11_source_divergence,
    op12_filter_interactions, op13_warc)} | {"pipeline": corpus_pipeline.run}

_ANCHORS = ", ".join(f"'{a}'" for a in dict.fromkeys(spotsigs.ANCHORS))

ORACLE: dict[str, str] = {"op2_spotsigs": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
nx AS (SELECT doc_id, text,
              coalesce(lead(text) OVER (ORDER BY doc_id NULLS FIRST, text),
                       first_value(text) OVER (ORDER BY doc_id NULLS FIRST, text)) AS next_text FROM d),
e AS (SELECT doc_id, text, next_text, length(text) AS n,
             left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM nx),
t AS (SELECT text, row_number() OVER () AS tid FROM (SELECT text FROM e UNION SELECT edited FROM e)),
w AS (SELECT tid, text, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS ws FROM t),
u AS (SELECT tid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
k AS (SELECT tid, i, w, w IN ({_ANCHORS}) AS a,
             sum(CASE WHEN w IN ({_ANCHORS}) THEN 0 ELSE 1 END) OVER (PARTITION BY tid ORDER BY i) AS k FROM u),
s AS (SELECT tid, list_sort(list(DISTINCT sig)) AS sigs FROM (
        SELECT x.tid, substr(md5(concat_ws(' ', x.w, c1.w, c2.w)), 1, 8) AS sig
        FROM k x JOIN k c1 ON c1.tid = x.tid AND c1.k = x.k + 1 AND NOT c1.a
        JOIN k c2 ON c2.tid = x.tid AND c2.k = x.k + 2 AND NOT c2.a WHERE x.a) GROUP BY tid),
f AS (SELECT w.text, CASE WHEN s.sigs IS NOT NULL THEN s.sigs
        WHEN len(ws) >= 3 THEN list_sort(list_distinct(list_transform(range(1, len(ws) - 1),
             lambda j: substr(md5(concat_ws(' ', ws[j], ws[j + 1], ws[j + 2])), 1, 8))))
        ELSE [substr(md5(lower(w.text)), 1, 8)] END AS sigs
      FROM w LEFT JOIN s ON s.tid = w.tid)
SELECT e.doc_id, e.n AS n_chars, sha256(e.edited) AS edited_sha256,
       array_to_string(fa.sigs, '') AS fingerprint, array_to_string(fe.sigs, '') AS edited_fingerprint,
       len(list_intersect(fa.sigs, fe.sigs)) / (len(fa.sigs) + len(fe.sigs) - len(list_intersect(fa.sigs, fe.sigs)))::DOUBLE AS near_edited,
       len(list_intersect(fa.sigs, fn.sigs)) / (len(fa.sigs) + len(fn.sigs) - len(list_intersect(fa.sigs, fn.sigs)))::DOUBLE AS near_next,
       len(fa.sigs) AS n_signatures
FROM e JOIN f fa ON fa.text = e.text JOIN f fe ON fe.text = e.edited JOIN f fn ON fn.text = e.next_text
""",
    "op7_doubling_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
s AS (SELECT r, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
      FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM d)),
again AS (SELECT s.r, s.i FROM s JOIN (SELECT h FROM s GROUP BY h HAVING count(*) > 1) g ON g.h = s.h),
m AS (SELECT w.r, w.i, w.w, max(CASE WHEN a.i IS NULL THEN 0 ELSE 1 END)
        OVER (PARTITION BY w.r ORDER BY w.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
      FROM w LEFT JOIN again a ON a.r = w.r AND a.i = w.i),
k AS (SELECT r, sum(gone) AS n, string_agg(CASE WHEN gone = 0 THEN w END, ' ' ORDER BY i) AS kept FROM m GROUP BY r)
SELECT d.doc_id, len(d.ws) AS n_words, CAST(coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.r = d.r
""",
    "op9_suffix_array_dedup": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT r, unnest(range(0, length(x) // 2)) AS i, unnest(regexp_extract_all(x, '..')) AS byte FROM d),
h1 AS (SELECT r, i, byte AS h FROM b),
h2 AS (SELECT r, i, md5(h || lead(h, 1) OVER (PARTITION BY r ORDER BY i)) AS h FROM h1),
h4 AS (SELECT r, i, md5(h || lead(h, 2) OVER (PARTITION BY r ORDER BY i)) AS h FROM h2),
h8 AS (SELECT r, i, md5(h || lead(h, 4) OVER (PARTITION BY r ORDER BY i)) AS h FROM h4),
h16 AS (SELECT r, i, md5(h || lead(h, 8) OVER (PARTITION BY r ORDER BY i)) AS h FROM h8),
h32 AS (SELECT r, i, md5(h || lead(h, 16) OVER (PARTITION BY r ORDER BY i)) AS h FROM h16),
h50 AS (SELECT r, i, md5(h || lead(h, 18) OVER (PARTITION BY r ORDER BY i)) AS h FROM h32),
s AS (SELECT h50.r, d.doc_id, h50.i, h50.h FROM h50 JOIN d ON d.r = h50.r WHERE h50.h IS NOT NULL AND d.doc_id IS NOT NULL),
least_id AS (SELECT h, min(doc_id) AS least_id FROM s GROUP BY h HAVING count(*) > 1),
late AS (SELECT s.r, s.i FROM s JOIN least_id l ON l.h = s.h WHERE s.doc_id > l.least_id),
m AS (SELECT b.r, b.i, b.byte, max(CASE WHEN l.i IS NULL THEN 0 ELSE 1 END)
        OVER (PARTITION BY b.r ORDER BY b.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
      FROM b LEFT JOIN late l ON l.r = b.r AND l.i = b.i),
e AS (SELECT *, CASE WHEN gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY r ORDER BY i), 0) = 0 THEN 1 ELSE 0 END AS first FROM m),
k AS (SELECT r, sum(gone) AS n, sum(first) AS spans, string_agg(CASE WHEN gone = 0 THEN byte END, '' ORDER BY i) AS kept FROM e GROUP BY r)
SELECT d.doc_id, length(d.x) // 2 AS n_bytes, CAST(coalesce(k.n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON k.r = d.r
"""}


def _quality_sql() -> str:
    """The union of maximal repeats of MIN_REPEAT or more words is that of all
    repeated windows of MIN_REPEAT words; a longer repeat than MAX_LONGEST is a
    repeated window of one word more."""
    def windows(k: int) -> str:
        return f"""
s{k} AS (SELECT r, i, md5(array_to_string(ws[i:i + {k - 1}], ' ')) AS h
         FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - {k - 2}, 1))) AS i FROM d)),
a{k} AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, h) AS n FROM s{k}) WHERE n > 1),
c{k} AS (SELECT r, sum(hit) AS n FROM (
           SELECT w.r, max(CASE WHEN a.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.r ORDER BY w.i
                  ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) AS hit
           FROM w LEFT JOIN a{k} a ON a.r = w.r AND a.i = w.i) GROUP BY r),"""
    q = quality
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, generate_subscripts(ws, 1) AS i FROM d),{windows(3)}{windows(q.MIN_REPEAT)}{windows(q.MAX_LONGEST + 1)}
e AS (SELECT d.doc_id, len(d.ws) AS n_words, length(coalesce(array_to_string(d.ws, ''), '')) AS word_chars,
             length(d.t) - length(translate(d.t, '#*$%&|<>', '')) AS n_symbols,
             list_filter(string_split(d.t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
             CAST(coalesce(c3.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(c{q.MIN_REPEAT}.n, 0) AS BIGINT) AS n_span_words,
             coalesce(c{q.MAX_LONGEST + 1}.n, 0) AS too_long
      FROM d LEFT JOIN c3 ON c3.r = d.r LEFT JOIN c{q.MIN_REPEAT} ON c{q.MIN_REPEAT}.r = d.r
      LEFT JOIN c{q.MAX_LONGEST + 1} ON c{q.MAX_LONGEST + 1}.r = d.r),
f AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM e)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
       n_repeat_words, n_span_words, base_failed,
       NOT base_failed AND n_span_words <= {q.MAX_COVERED} * n_words AND too_long = 0 AS kept
FROM f
"""


def _license_sql() -> str:
    rare = licenses.postings(licenses.TEMPLATES, licenses.RARE)
    rows = []
    for t, (label, notice, key) in enumerate(licenses.TEMPLATES):
        words, key_words = notice.split(), key.split()
        at = len(notice[:f" {notice} ".index(f" {key} ")].split())
        rows += [f"({t}, '{label}', {p}, '{w}', {w in rare}, {at <= p < at + len(key_words)}, {len(words)}, {len(key_words)})"
                 for p, w in enumerate(words)]
    base = "\nUNION ALL ".join(
        f"SELECT r, i, '{label}' AS label FROM w WHERE w = '{p.split()[0]}' AND w1 = '{p.split()[1]}'"
        + (f" AND w2 = '{p.split()[2]}'" if len(p.split()) > 2 else "") for p, label in licenses.BASE.items())
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d),
w AS (SELECT *, lead(w, 1) OVER (PARTITION BY r ORDER BY i) AS w1, lead(w, 2) OVER (PARTITION BY r ORDER BY i) AS w2 FROM u),
tpl(t, label, p, w, rare, is_key, n_words, n_key) AS (VALUES {", ".join(rows)}),
b AS ({base}),
votes AS (SELECT u.r, tpl.t, u.i - tpl.p AS st FROM u JOIN tpl ON tpl.w = u.w AND tpl.rare GROUP BY ALL HAVING count(*) >= {licenses.AGREE}),
m AS (SELECT v.r, tpl.label, tpl.n_words, tpl.n_key, v.t, v.st, count(*) AS n, count(*) FILTER (tpl.is_key) AS k
      FROM votes v JOIN tpl ON tpl.t = v.t JOIN u ON u.r = v.r AND u.i = v.st + tpl.p AND u.w = tpl.w GROUP BY ALL),
f AS (SELECT r, label, n / n_words AS share FROM m WHERE k = n_key),
bs AS (SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM b GROUP BY r),
fs AS (SELECT r, max(share) AS share FROM f GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT r, label FROM b UNION SELECT r, label FROM f) GROUP BY r)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(bs.n, 0) AS n_base, CAST(bs.first_word AS BIGINT) AS first_word,
       CAST(bs.last_word AS BIGINT) AS last_word, coalesce(bs.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       CASE WHEN bs.n > 0 THEN 1.0::DOUBLE ELSE coalesce(fs.share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs ON bs.r = d.r LEFT JOIN fs ON fs.r = d.r LEFT JOIN al ON al.r = d.r
"""


ORACLE["op1_quality_rules"] = _quality_sql()
ORACLE["op5_license_scan"] = _license_sql()


ORACLE["op11_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(list_filter(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
cell AS (SELECT g.lang, g.source, kept.term, coalesce(own.n, 0) AS n, kept.n AS lang_n
         FROM g JOIN kept ON kept.lang = g.lang
         LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = kept.term),
t AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total FROM cell),
p AS (SELECT t.lang, t.source, t.term, t.n,
        1 + {divergence.SCALE}::HUGEINT * (t.n + {divergence.SMOOTH}) // (t.total + {divergence.SMOOTH} * v.v) AS p,
        1 + {divergence.SCALE}::HUGEINT * (t.lang_n + {divergence.SMOOTH}) // (v.total + {divergence.SMOOTH} * v.v) AS q
      FROM t JOIN v ON v.lang = t.lang),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pair.value, 0) AS value
          FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= {divergence.TOP}
"""

_ORDERS = ", ".join("('" + "".join(o) + "')" for o in permutations(filter_audit.FILTERS))

ORACLE["op12_filter_interactions"] = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
least AS (SELECT t, min(doc_id) AS least_id FROM d GROUP BY t),
m AS (SELECT w.part,
        coalesce(w.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
        coalesce(w.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic,
        [len(ws) < {filter_audit.MIN_WORDS}, 100 * len(list_distinct(ws)) < {filter_audit.MIN_DISTINCT} * len(ws),
          100 * (length(w.t) - length(translate(w.t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > {filter_audit.MAX_UPPER} * length(w.t),
          regexp_matches(w.t, '[#$%&*|]'), coalesce(w.doc_id > least.least_id, false)] AS f
      FROM w JOIN least ON least.t = w.t),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY ALL),
o(filter_order) AS (VALUES {_ORDERS}),
x AS (SELECT c.*, o.filter_order, list_filter(range(1, 6), lambda k: f[strpos('ABCDE', filter_order[k])]) AS failing FROM c, o),
y AS (SELECT x.*, s.step, len(failing) > 0 AND failing[1] < s.step AS before, f[strpos('ABCDE', filter_order[s.step])] AS fails
      FROM x, (SELECT unnest(range(1, 6)) AS step) s),
z AS (SELECT part, filter_order, step, sum(CASE WHEN before OR fails THEN 0 ELSE n END) AS kept,
        sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails AND before THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails AND len(failing) = 1 THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END) AS toxic_lost FROM y GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM z
"""

ORACLE["op13_warc"] = """
WITH d AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, list_transform(range(0, 8), lambda k: ('0x' || substr(h, 5 * k + 1, 5))::BIGINT) AS part,
        max(page_id) OVER (PARTITION BY t) AS last_id,
        row_number() OVER (PARTITION BY t ORDER BY page_id DESC NULLS LAST) AS nth FROM d)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((part[k // 4 + 1] >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN last_id END AS refers_to
FROM b
"""
