"""The numbered operators applied to the given tables, one registered query each."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, html, language, leaks, lines, merkle, packing, repeats, simhash, spelling, toxicity, urls, warc
from .common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(fn)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = shipped
    return shipped


@query
def op1_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.with_edits(table(spark, sf_dir, "documents"))


@query
def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = leaks.search(docs, items, leaks.fit(docs, items))
    return found.select("doc_id", "item_id", "words_share", "answer_share")


@query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language.held_out("doc_id", 3, 1)
    model = toxicity.train(docs, labels.filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = lines.removed_lines(docs, short=True)
    counted = docs.select("doc_id", lines.text_hash("text").alias("text_hash"), F.size(F.split("text", "\n")).alias("n_lines"))
    return counted.join(found, ["doc_id", "text_hash"], "left").select(
        "doc_id",
        F.greatest("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed_lines"),
    )


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out("doc_id", 5, 0)
    samples = language.learn(docs.filter(~held_out))
    return language.predict(docs, samples).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: Host, path and verdict of the query's rules.
URL_RULES: list[urls.Rule] = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(spark.createDataFrame(list(urls.labelled_urls()), "url string, verdict string"))
    found = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, model)
    return found.select("row.page_id", "host", "path", "rule", "verdict")


TYPO_EVERY = 97


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY)


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversations.repair_reports(conversations.damage(table(spark, sf_dir, "conversations")))
    return found.withColumnRenamed("conv", "conv_id")


SQL["op1_merkle_fingerprints"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
    lead(coalesce(text, '')) OVER (ORDER BY doc_id) AS after, first(coalesce(text, '')) OVER (ORDER BY doc_id) AS head
  FROM documents),
e AS (SELECT doc_id, text, coalesce(after, head) AS next, length(text) AS n FROM d),
t AS (SELECT doc_id, n, text, next, left(text, n - n // 4) || left(next, n // 4) AS edited FROM e),
x AS (SELECT doc_id, 1 AS k, text AS s FROM t UNION ALL SELECT doc_id, 2, edited FROM t
  UNION ALL SELECT doc_id, 3, next FROM t),
m AS (SELECT doc_id, k, s, list_transform(string_split(s, chr(10)), lambda p: array_to_string(list_transform(
    string_split(substr(array_to_string(list_transform(string_split(p, ' '), lambda w:
      CASE WHEN substr(md5(w), 32, 1) IN {merkle.CUTS} THEN chr(10) ELSE ' ' END || w), ''), 2), chr(10)),
    lambda q: sha256(q)), ' ')) AS rows FROM x),
f AS (SELECT doc_id, k, s, list_distinct(string_split(array_to_string(rows, ' '), ' ')) AS pieces,
    array_to_string(list_transform(rows, lambda r: sha256(r)), ' ') AS leaves FROM m),
r AS (SELECT doc_id, k, s, pieces, sha256(array_to_string(list_transform(
    string_split(regexp_replace(leaves, '([08]) ', '\\1|', 'g'), '|'), lambda p: sha256(p)), ' ')) AS root FROM f),
w AS (SELECT a.doc_id, a.s AS text, b.s AS edited, a.root AS ra, b.root AS rb, c.root AS rc,
    a.pieces AS pa, b.pieces AS pb, c.pieces AS pc
  FROM r a JOIN r b ON a.doc_id = b.doc_id AND b.k = 2 JOIN r c ON a.doc_id = c.doc_id AND c.k = 3 WHERE a.k = 1)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256, ra AS fingerprint, rb AS edited_fingerprint,
  CASE WHEN ra = rb THEN 1.0::DOUBLE ELSE least(2.0::DOUBLE * len(list_intersect(pa, pb))
    / greatest(len(pa) + len(pb), 1), 1 - 1 / (2.0::DOUBLE + len(pa) + len(pb))) END AS near_edited,
  CASE WHEN ra = rc THEN 1.0::DOUBLE ELSE least(2.0::DOUBLE * len(list_intersect(pa, pc))
    / greatest(len(pa) + len(pc), 1), 1 - 1 / (2.0::DOUBLE + len(pa) + len(pc))) END AS near_next
FROM w
"""

SQL["op5_warc"] = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
k AS (SELECT digest, n, max(page_id) AS keeper FROM p WHERE n >= {warc.LEAST_BYTES} GROUP BY digest, n)
SELECT page_id, p.n AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN keeper > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keeper > page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest AND p.n = k.n
"""


# Checksums in SQL: the table of CRC-32 by its rule, then byte by byte.
CRC_TABLE_SQL = """crc AS (SELECT list(v ORDER BY k) AS t FROM (SELECT k, list_reduce(range(8), lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k) AS v FROM range(256) r(k)))"""


def crc_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text whose code points are below 2048, in a query with ``crc``."""
    points = f"list_transform(string_split({text}, ''), lambda x: unicode(x))"
    two = "[192 + (p >> 6), 128 + (p & 63)]"
    utf8 = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE {two} END))"
    step = "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_transform({utf8}, lambda b: b::BIGINT), {step}, 4294967295::BIGINT), 4294967295)"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL["op12_spelling_variants"] = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')), '{_UPPER}', '{_LOWER}') AS run
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (SELECT run, n, CASE WHEN doc_id IS NULL THEN 1 ELSE {crc_sql("doc_id || ':' || run")} END AS h FROM counted, crc),
damaged AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0
    THEN left(run, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= {spelling.LEAST_LENGTH}
  GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
cut AS (SELECT word, i, left(word, i::INTEGER - 1) || substr(word, i::INTEGER + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON rest = words.word),
best AS (SELECT near.word, count(*) AS n_near, min({{'minus': -w.n, 'form': near.near}}) AS b
  FROM near JOIN words w ON w.word = near.near GROUP BY near.word),
formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.minus >= {spelling.TIMES} * n THEN b.form END AS form,
    CASE WHEN -b.minus >= {spelling.TIMES} * n THEN -b.minus END::BIGINT AS form_n FROM words LEFT JOIN best USING (word)),
followed AS (SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT f.word, f.next, g.form FROM followed f JOIN formed g ON g.word = f.next)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM followed WHERE next IS NULL) USING (word)
"""

_CONV_KEY = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
_BLANKS = "\\x20\\x09-\\x0D"
_PICK = "list_min(list_filter([{options}], lambda o: o.c IS NOT NULL))"
_FRONT = "{{'c': {to}.c + {cost}, 'a': '{letter}' || {to}.a}}"
_NX = "[3, 3, 4, 3]"


def _front(to: str, cost: str, letter: str) -> str:
    return _FRONT.format(to=to, cost=cost, letter=letter)


# States 1 to 4: nothing read, last initial s, u, a. v: the cheapest (cost, letters) from each state on.
SQL["op13_conversation_repair"] = f"""
WITH RECURSIVE {CRC_TABLE_SQL},
base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc_sql(_CONV_KEY)} % 20 AS k
  FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM base),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    count(*) OVER (PARTITION BY conv_id) AS n, NOT regexp_matches(text, '[^{_BLANKS}]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    NOT regexp_matches(text, '[.!?][{_BLANKS}]*$') AS cut FROM damaged),
faults AS (SELECT *, CASE WHEN blank THEN 1 WHEN again THEN 2 WHEN cut THEN 3 ELSE 0 END AS fault, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM faults GROUP BY conv_id),
path AS (SELECT conv_id, n + 1 AS i, [{{'c': 0, 'a': ''}}, {{'c': 4, 'a': 'II'}}, {{'c': 2, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS v FROM counts
  UNION ALL SELECT conv_id, i, list_transform(range(1, 5), lambda s: {_PICK.format(options=f"w[s], {_front(f'w1[{_NX}[s]]', '2', 'I')}")})
  FROM (SELECT conv_id, i, w, list_transform(range(1, 5), lambda s: {_PICK.format(options=f"w[s], {_front(f'w[{_NX}[s]]', '2', 'I')}")}) AS w1
  FROM (SELECT p.conv_id, f.i, list_transform(range(1, 5), lambda s: {_PICK.format(options=", ".join([
      _front("v[s]", "3", "D"),
      _front(f"v[{_NX}[s]]", "CASE fault WHEN 0 THEN 2 WHEN 3 THEN 3 END", "R"),
      _front("v[CASE WHEN initial = 's' AND s = 1 THEN 2 WHEN initial = 'u' AND s <> 3 THEN 3 WHEN initial = 'a' AND s = 3 THEN 4 END]",
             "CASE fault WHEN 0 THEN 0 WHEN 3 THEN 1 END", "K"),
    ]))}) AS w FROM path p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i - 1))),
best AS (SELECT conv_id, v[1].c AS cost, v[1].a AS audit FROM path WHERE i = 1),
applied AS (SELECT conv_id, audit, 0 AS k, 0::BIGINT AS i, 1 AS s, []::VARCHAR[] AS lines FROM best
  UNION ALL SELECT conv_id, audit, k + 1, i + (letter <> 'I')::INT, CASE WHEN letter = 'D' THEN s WHEN letter = 'K' THEN
      CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END ELSE {_NX}[s] END,
    CASE letter WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text)
      ELSE list_append(lines, CASE s WHEN 3 THEN 'assistant:' ELSE 'user:' END || CASE letter WHEN 'R' THEN text ELSE '' END) END
  FROM (SELECT a.*, substr(a.audit, a.k + 1, 1) AS letter, f.role, f.text, f.initial FROM applied a
    LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.i = a.i + 1 WHERE a.k < length(a.audit)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(a.audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM applied WHERE k = length(audit)) a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
"""
