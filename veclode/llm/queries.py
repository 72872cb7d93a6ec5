"""The registered queries of this subpackage, and their SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veclode.llm import language_id, quality, secret_scan, toxicity
from veclode.llm.common import held_out
from veclode.llm.centroids import cluster_vectors, with_inertia
from veclode.llm.conversation_repair import repair_conversations
from veclode.llm.decontamination import decontaminate, is_contaminated
from veclode.llm.exact_dedup import exact_duplicates
from veclode.llm.jaccard_join import jaccard_components
from veclode.llm.packing import pack
from veclode.llm.sharding import shard
from veclode.llm.substring_dedup import repeated_passages
from veclode.llm.url_filter import filter_urls

# (host, path, verdict): fixed values of the query
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Listed are pages on hosts that name one of these, and pages of so little html (characters) that
# they say nothing, whatever their host; the filter then finds the same pages under other
# schemes, host prefixes, query strings and with other contents.
SPAM_WORDS = ("casino", "pills", "poker", "replica")
THIN_PAGE = 1500

DEFAULT_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark, sf_dir):
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op2_url_filter(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    host = F.lower(F.regexp_extract("url", "://([^/?#]*)", 1))
    bad = host.rlike("|".join(SPAM_WORDS)) | (F.length("html") < THIN_PAGE)
    judged = filter_urls(pages.select("page_id", "url"), rules, pages.where(bad).select("url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_secret_scan(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.secret_spans(F.col("text")).alias("found"))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    base = secret_scan.spans_text(F.col("found"), secret_scan.BASE_KINDS)
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in secret_scan.BASE_KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("found")).alias("spans"),
    )


def op4_substring_dedup(spark, sf_dir):
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    rules = quality.fit_rules(docs, labels)
    judged, name = quality.judge(docs.select("doc_id", "text"), rules)
    q = F.col(name)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    columns += ["base_failed", "kept", "rule"]
    return judged.select("doc_id", *[q[c].alias(c) for c in columns])


def op6_packing(spark, sf_dir):
    return pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_toxicity(spark, sf_dir):
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    net = toxicity.fit_network(docs, labels)
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        toxicity.toxicity_score(F.col("text"), net).alias("score"),
        toxicity.language_threshold(F.col("lang"), net).alias("threshold"),
    )
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("flagged"),
    )


def op8_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    prototypes = language_id.fit_prototypes(docs.where("NOT held_out"))
    found = language_id.predict_language(F.col("text"), prototypes).alias("found")
    return docs.select("doc_id", "held_out", found).select("doc_id", "held_out", "found.*")


def op9_jaccard_join(spark, sf_dir):
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_sharding(spark, sf_dir):
    return shard(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_exact_dedup(spark, sf_dir):
    """Half of the documents, by the hash of their ids, are history; the rest are looked up."""
    docs = _table(spark, sf_dir, "documents")
    found = exact_duplicates(docs, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


def damaged(conversations: DataFrame) -> DataFrame:
    """Messages damaged by their key's checksum modulo 20: 0 takes one away (``present`` is
    false), 1 empties it, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    bare = F.translate(blank("text"), ".!?", "")
    text = F.when(kind == 1, "").when(kind == 2, bare).otherwise(blank("text"))
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(blank("role")).alias("role"),
        text.alias("text"),
        (kind != 0).alias("present"),
        F.explode(times).alias("time"),
    ).drop("time")


def op12_conversation_repair(spark, sf_dir):
    return repair_conversations(damaged(_table(spark, sf_dir, "conversations")), present="present")


def op13_centroid_clustering(spark, sf_dir):
    return with_inertia(*cluster_vectors(_table(spark, sf_dir, "embeddings")))


def queries():
    return {
        f.__name__: f
        for f in (
            op1_decontamination,
            op2_url_filter,
            op3_secret_scan,
            op4_substring_dedup,
            op5_quality_rules,
            op6_packing,
            op7_toxicity,
            op8_language_id,
            op9_jaccard_join,
            op10_sharding,
            op11_exact_dedup,
            op12_conversation_repair,
            op13_centroid_clustering,
        )
    }


_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _split(table: str, key: str, pattern: str) -> str:
    folded = f"translate(coalesce(text, ''), {_FOLD})"
    return f"SELECT {key}, regexp_extract_all({folded}, '{pattern}') AS w FROM {table}"


_DECONTAMINATION = rf"""
WITH docs AS ({_split("documents", "doc_id", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}),
items AS ({_split("benchmark", "item_id", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + 12], ' ') AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
hits AS (SELECT DISTINCT doc_id, i, k, item_id FROM places JOIN windows USING (k, words)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_URL_FILTER = rf"""
WITH rests AS (
  SELECT page_id, html, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), {_FOLD}) AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
canonical AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '') AS url FROM parts),
rules AS (SELECT * FROM (VALUES {_RULES_SQL}) AS r(rule_host, rule_path, verdict)),
fitting AS (
  SELECT DISTINCT host, path, first(rule_host || rule_path ORDER BY length(rule_host || rule_path) DESC)
           OVER (PARTITION BY host, path) AS rule,
         first(verdict ORDER BY length(rule_host || rule_path) DESC) OVER (PARTITION BY host, path) AS said
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
listed AS (
  SELECT DISTINCT url FROM canonical
  WHERE host <> '' AND (regexp_matches(host, '{"|".join(SPAM_WORDS)}') OR length(html) < {THIN_PAGE}))
SELECT page_id, host, path, rule,
       coalesce(said, CASE WHEN url IN (SELECT url FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM canonical LEFT JOIN fitting USING (host, path)"""

_JACCARD = rf"""
WITH RECURSIVE docs AS ({_split("documents", "doc_id", r"[^\x20\x09-\x0D]+")}),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT docs.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM docs JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
LEFT JOIN sizes USING (doc_id)"""


_EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
groups AS (
  SELECT text_sha256, first(doc_id ORDER BY n DESC, doc_id) AS keep_id, count(*) AS group_size
  FROM texts GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM texts JOIN groups USING (text_sha256)"""


def _conversation_repair() -> str:
    """Cheapest edits by a forward pass: for each of four states the least "cost, then edits"
    as one text, six digits first; ``~`` stands for no way."""

    def more(x: str, cost: str, letters: str) -> str:
        total = f"lpad((({x})[1:6]::INTEGER + {cost})::VARCHAR, 6, '0')"
        return f"CASE WHEN {x} = '~' THEN '~' ELSE {total} || ({x})[7:] || '{letters}' END"

    def only(letters: str, x: str) -> str:
        return f"CASE WHEN lower(c) IN ({letters}) THEN {x} ELSE '~' END"

    e = "CASE WHEN c = upper(c) THEN 3 ELSE 0 END"
    user = "least(b[3], " + ", ".join(more(f"b[{i}]", "3", "I") for i in (1, 2, 4)) + ")"
    with_user = f"list_transform([b], lambda b: [b[1], b[2], {user}, b[4]])[1]"
    inserted = f"list_transform([{with_user}], lambda b: [b[1], b[2], b[3], least(b[4], {more('b[3]', '3', 'I')})])[1]"
    keep = lambda i: more(f"b[{i}]", e, "K")
    rerole = lambda i: only("'s','u','a','o'", more(f"b[{i}]", f"3 + {e}", "R"))
    stepped = [
        more("b[1]", "4", "D"),
        f"least({more('b[2]', '4', 'D')}, {only(chr(39) + 's' + chr(39), keep(1))})",
        f"least({more('b[3]', '4', 'D')}, "
        + ", ".join([only("'u'", keep(i)) for i in (1, 2, 4)] + [rerole(i) for i in (1, 2, 4)])
        + ")",
        f"least({more('b[4]', '4', 'D')}, {only(chr(39) + 'a' + chr(39), keep(3))}, {rerole(3)})",
    ]
    step = f"list_transform([{inserted}], lambda b: array_to_string([{', '.join(stepped)}], '|'))[1]"
    step = step.replace("list_transform([b]", "list_transform([string_split(acc, '|')]", 1)
    last = f"least(b[1], {more('b[2]', '6', 'II')}, {more('b[3]', '3', 'I')}, b[4])"
    bits = "list_reduce([xor(h, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))"
    name = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    units = f"list_transform(string_split({name}, ''), lambda u: ascii(u)::BIGINT)"
    return rf"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, {units}), lambda h, b: {bits}), 4294967295) % 20 AS k
  FROM conversations),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS time FROM raw),
placed AS (
  SELECT *, row_number() OVER w AS p, lag(role[1:1]) OVER w AS before,
         rtrim(text, E' \t\n\x0b\x0c\r') AS bare
  FROM rows_ WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, time)),
told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again FROM placed),
coded AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN bare[-1:] IN ('.', '!', '?') THEN letter
                 ELSE upper(letter) END AS c
  FROM (SELECT *, CASE WHEN role[1:1] IN ('s', 'u', 'a') THEN role[1:1] ELSE 'o' END AS letter FROM told)),
whole AS (
  SELECT conv_id, list(c ORDER BY p) AS codes, list(role ORDER BY p) AS roles, list(text ORDER BY p) AS texts,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (c = 'b') AS blank, count(*) FILTER (c = 'd') AS duplicate,
         count(*) FILTER (c IN ('S', 'U', 'A', 'O')) AS truncated,
         count(*) FILTER (before || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id),
solved AS (
  SELECT *, list_transform([string_split(list_reduce(list_prepend('000000|~|~|~', codes),
              lambda acc, c: {step}), '|')], lambda b: {last})[1] AS best FROM whole),
edits AS (
  SELECT conv_id, roles, texts, codes, best[7:] AS audit, unnest(range(1, length(best) - 5)) AS j FROM solved),
done AS (
  SELECT *, length(replace(audit[1:j], 'I', '')) AS i, length(replace(audit[1:j], 'D', '')) AS r, audit[j] AS edit,
         length(replace(split_part(audit, 'K', 1), 'D', '')) = 0
           AND lower(codes[length(split_part(audit, 'K', 1)) + 1]) = 's' AND contains(audit, 'K') AS s
  FROM edits),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN roles[i]
      WHEN (r - s::INTEGER) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
      || CASE WHEN edit = 'I' THEN '' ELSE texts[i] END, chr(10) ORDER BY j) AS repaired
  FROM done WHERE edit <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(best[1:6]::BIGINT, 0) AS cost, coalesce(best[7:], '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN lines ON lines.conv_id IS NOT DISTINCT FROM o.conv_id"""


def _clusters(rounds: int = 5, k: int = 40) -> str:
    """Every round as a table of its own; dot products of whole numbers this small are exact."""
    floor_mean = "(s - ((s % n) + n) % n) // n"
    parts = [
        f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, x, list_inner_product(x::DOUBLE[], x::DOUBLE[]) AS xx FROM (
    SELECT vec_id, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64 AND len(embedding) = 64)),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS c, x FROM (
    SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, x FROM v ORDER BY h, x LIMIT {k}))"""
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, m.c AS c, m.d::BIGINT AS d FROM (
    SELECT r, min(struct_pack(d := xx - 2 * list_inner_product(v.x::DOUBLE[], t.x::DOUBLE[])
             + list_inner_product(t.x::DOUBLE[], t.x::DOUBLE[]), c := t.c)) AS m
    FROM v, c{i} t GROUP BY r))"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT t.c, coalesce(m.x, t.x) AS x FROM c{i} t LEFT JOIN (
    SELECT c, list({floor_mean} ORDER BY pos) AS x FROM (
      SELECT c, pos, sum(e)::BIGINT AS s, count(*) AS n FROM (
        SELECT c, unnest(x) AS e, unnest(range(64)) AS pos FROM v JOIN a{i} USING (r)) GROUP BY c, pos)
    GROUP BY c) m USING (c))"""
            )
    return (
        ",\n".join(parts)
        + f"""
SELECT vec_id, c AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(t.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} t USING (c)"""
    )


def oracle_sql():
    return {
        "op1_decontamination": _DECONTAMINATION,
        "op2_url_filter": _URL_FILTER,
        "op9_jaccard_join": _JACCARD,
        "op11_exact_dedup": _EXACT_DEDUP,
        "op12_conversation_repair": _conversation_repair(),
        "op13_centroid_clustering": _clusters(),
    }
