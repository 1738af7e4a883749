"""Registered queries of the numbered operators and their SQL.

Each query applies one operator, with production parameters, to its whole
table.  ``SQL`` has a DuckDB statement where SQL can express the result; the
others are held against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import (dedup, jaccard, line_dedup, mixing, packing, prefix_trie, quality, repair, sharding, token_scan,
                          toxicity, urls, winnow)
from feedlens.llm.tables import table
from feedlens.session import scratch_path

#: Shards of the sharding query.
SHARDS = 16
#: Shards of the map that the sharding query finds and edits.
SHARDS_BEFORE = 12
#: Seed and epochs of the mixing query.
MIX_SEED, MIX_EPOCHS = 17, 4
#: Domains of the mixing tree: sources are dealt to them by number.
DOMAINS = ("web", "books", "news", "forum")
#: (domain, language, source, weight) of the mixing tree; other nodes weigh 1.
MIX_WEIGHTS = [
    ("web", None, None, 4.0), ("books", None, None, 3.0), ("news", None, None, 2.0), ("forum", None, None, 1.0),
    *[(d, "en", None, 5.0) for d in DOMAINS], *[(d, "de", None, 2.0) for d in DOMAINS],
    ("web", "en", "src0", 0.5), ("books", "en", "src1", 2.0),
]
#: (verdict, host, path) of the URL rules.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/")]


def mix_domain() -> Column:
    """Domain of a source: its number modulo the number of domains, else the first."""
    number = F.coalesce(F.regexp_extract(F.coalesce("source", F.lit("")), r"(\d+)$", 1), F.lit(""))
    index = F.when(number == "", 0).otherwise(number.try_cast("long") % len(DOMAINS))
    return F.element_at(F.array(*map(F.lit, DOMAINS)), F.coalesce(index, F.lit(0)).cast("int") + 1)


def mix_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MIX_WEIGHTS, "domain string, lang string, source string, weight double")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mixing operator's input from ``documents``."""
    return docs.select("doc_id", mix_domain().alias("domain"), "lang", "source", mixing.token_count().alias("tokens"))


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(mix_documents(docs), mix_weights(spark), None, MIX_EPOCHS, MIX_SEED)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.ngram_jaccard_components(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = sharding.SlotMapStore(spark, scratch_path(spark, "slot-map"))
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS, store, shards_before=SHARDS_BEFORE)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.DigestArray(spark, URL_RULES))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = winnow.winnow_documents(table(spark, sf_dir, "documents"))
    own, edited, following = (winnow.hashes(F.col(c)) for c in ("packed", "edited_packed", "next_packed"))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       winnow.as_text(F.col("packed")).alias("fingerprint"),
                       winnow.as_text(F.col("edited_packed")).alias("edited_fingerprint"),
                       winnow.likeness(own, edited).alias("near_edited"), winnow.likeness(own, following).alias("near_next"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """The packing operator's input from ``documents``: clusters are equal
    texts after lower-casing."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                       F.xxhash64(F.lower(F.coalesce("text", F.lit("")))).alias("cluster"), mixing.token_count().alias("tokens"))
    return rows.withColumn("copy", F.monotonically_increasing_id())


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(pack_documents(table(spark, sf_dir, "documents")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(table(spark, sf_dir, "conversations")).drop("n_repaired")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations")).drop("x1", "x2", "screened")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_source_mix, op2_ngram_jaccard, op3_sharding, op4_toxicity, op5_url_filter, op6_winnowing,
        op7_best_fit_packing, op8_token_counts, op9_exact_dedup, op10_quality, op11_conversation_repair,
        op12_line_dedup, op13_prefix_trie)
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _crc32(text: str) -> str:
    """DuckDB expression: unsigned crc32 of an ASCII string, bit by bit."""
    bits = "list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[])"
    turned = f"list_reduce({bits}, lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    characters = f"list_transform(string_split({text}, ''), lambda k: ord(k)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {characters}), lambda a, b: {turned}), 4294967295)"


def _paid(best: str, cost: object, letter: str, line: str | None = None) -> str:
    """A state's best way with one more edit: ``k`` is the cost in six digits
    and the letters, so ways compare as (cost, letters); ``o`` the lines left."""
    key = f"lpad(CAST(CAST(substr({best}.k, 1, 6) AS INT) + {cost} AS VARCHAR), 6, '0') || substr({best}.k, 7) || '{letter}'"
    lines = f"{best}.o" if line is None else f"list_append({best}.o, {line})"
    return f"CASE WHEN {best} IS NOT NULL THEN {{'k': {key}, 'o': {lines}}} END"


def _least(*ways: str) -> str:
    return f"list_sort(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))[1]"


def _inserted(source: str) -> str:
    """States n, s, u, a of ``source`` after rows that may be inserted."""
    user = _least("u", *(_paid(q, 3, "I", "'user:'") for q in "nsa"))
    return f"(SELECT * REPLACE ({_least('a', _paid('u', 3, 'I', chr(39) + 'assistant:' + chr(39)))} AS a) FROM (SELECT * REPLACE ({user} AS u) FROM ({source})))"


def _repair_step() -> str:
    kept, rerole = "3 * CAST(truncated AS INT)", "3 + 3 * CAST(truncated AS INT)"
    own = "role || ':' || text"

    def state(q: str, keep: str, befores: str, name: str | None) -> str:
        ways = [_paid(q, 4, "D")]
        for b in befores:
            ways.append(f"CASE WHEN NOT gone AND role LIKE '{keep}%' THEN {_paid(b, kept, 'K', own)} END")
            if name:
                ways.append(f"CASE WHEN NOT gone THEN {_paid(b, rerole, 'R', f'{chr(39)}{name}:{chr(39)} || text')} END")
        return f"{_least(*ways)} AS {q}"

    return ", ".join([state("n", "", "", None), state("s", "s", "n", None), state("u", "u", "nsa", "user"),
                      state("a", "a", "u", "assistant")])


SQL: dict[str, str] = {
    "op2_ngram_jaccard": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM w, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS u(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = d.doc_id
""",
    "op5_url_filter": rf"""
WITH r(verdict, host, path) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM u),
m AS (SELECT p.page_id, r.host || r.path AS rule, r.verdict,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS k
      FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.k = 1
""",
    "op8_token_counts": rf"""
SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS n_tokens FROM documents
""",
    "op9_exact_dedup": f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON g.t = n.t
""",
    "op11_conversation_repair": f"""
WITH RECURSIVE r0 AS (
  SELECT conv_id, turn, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
r1 AS (
  SELECT conv_id, turn, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM r0, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE kind <> 0),
r2 AS (
  SELECT *, rtrim(text, {_SPACES}) AS body, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM r1),
r AS (
  SELECT conv_id, turn, i, role, text, body = '' AS blank, body <> '' AND seen > 1 AS duplicate,
         body <> '' AND seen = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated, body = '' OR seen > 1 AS gone,
         lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS prior FROM r2),
g AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         CAST(count_if(blank) AS BIGINT) AS blank, CAST(count_if(duplicate) AS BIGINT) AS duplicate,
         CAST(count_if(truncated) AS BIGINT) AS truncated, CAST(count_if(prior IS NOT NULL AND
         left(prior, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS BIGINT) AS illegal, max(i) AS rows FROM r GROUP BY conv_id),
start AS (
  SELECT conv_id, 0::BIGINT AS i, {{'k': '000000', 'o': []::VARCHAR[]}} AS n, NULL::STRUCT(k VARCHAR, o VARCHAR[]) AS s,
         NULL::STRUCT(k VARCHAR, o VARCHAR[]) AS u, NULL::STRUCT(k VARCHAR, o VARCHAR[]) AS a FROM g),
w AS (
  SELECT conv_id, i, n, s, u, a FROM {_inserted("SELECT * FROM start")}
  UNION ALL
  SELECT conv_id, i, n, s, u, a FROM {_inserted(f"SELECT w.conv_id, r.i, {_repair_step()} FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1")}),
e AS (
  SELECT g.*, {_least("w.n", "w.a")} AS best FROM g JOIN w ON w.conv_id IS NOT DISTINCT FROM g.conv_id AND w.i = g.rows)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(substr(best.k, 1, 6), '0') AS BIGINT) AS cost,
       coalesce(substr(best.k, 7), '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op12_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, i, parts[i] AS line, translate(trim(parts[i], {_SPACES}), '{_UPPER}', '{_LOWER}') AS key
      FROM d, unnest(range(1, len(parts) + 1)) AS u(i)),
k AS (SELECT key, max(doc_id) AS keep FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.doc_id, l.i, l.line, k.key IS NOT NULL AND l.doc_id <> k.keep AS gone FROM l LEFT JOIN k ON k.key = l.key)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256 FROM m GROUP BY doc_id
""",
    "op13_prefix_trie": f"""
WITH t AS (
  SELECT conv_id, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS e, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(e ORDER BY turn NULLS FIRST, e) AS seq, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM t GROUP BY conv_id),
c AS (
  SELECT o.conv_id, list_concat(coalesce(b.seq[1:o.h], []), o.seq[o.h + 1:]) AS seq
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
p AS (SELECT conv_id, d, seq[1:d] AS k, len(seq) = d AS ends FROM c, unnest(range(len(seq) + 1)) AS u(d)),
n AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d > 0 THEN strlen(k[d].x) ELSE 0 END AS bytes,
         sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p GROUP BY k, d),
f AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
b AS (
  SELECT n.k[1:e] AS k, count_if(f.k IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM n LEFT JOIN f ON f.k = n.k, unnest(range(n.d + 1)) AS u(e) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(f.n_children, 0) AS n_children,
       CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN b ON b.k = n.k LEFT JOIN f ON f.k = n.k LEFT JOIN n q ON n.d > 0 AND q.k = n.k[1:n.d - 1]
""",
}
