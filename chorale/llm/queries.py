"""The operators as queries over the sample tables, with SQL where it can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.llm import align, chat, exact, jaccard, langid, merkle, mixing, neardup, packing, quality, scoring, shards, urls
from chorale.llm.common import SPACE, md5_int, ranked, table
from chorale.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query(
    "op1_chat_formatting",
    r"""WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, role || chr(10) || text || chr(10) AS line,
    '<|start|>' || regexp_replace(replace(role, '\', '\\'), '(<)(\||/?s>|/?<SYS>>)|(\[)(/?INST\])|(\|)(>)', '\1\3\5\\\2\4\6', 'g')
    || '<|sep|>' || regexp_replace(replace(text, '\', '\\'), '(<)(\||/?s>|/?<SYS>>)|(\[)(/?INST\])|(\|)(>)', '\1\3\5\\\2\4\6', 'g')
    || '<|end|>' AS marked
  FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(line, '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(marked))::BIGINT AS formatted_chars, 0::BIGINT AS rank
FROM e GROUP BY conv_id""",
)
def _(spark, d):
    """Conversations are trees without branches: each turn replies to the one before."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], rows.schema)
    placed = ranked(rows.unionByName(extra), ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")], "turns", "node")
    messages = placed.select(
        F.col("conv_id").alias("tree"),
        "node",
        F.when(F.col("node") > 0, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.when(F.col("role") == "assistant", F.length("text")).alias("score"),
    )
    done = chat.format_paths(messages)
    turns = chat.read_turns(F.col("formatted"))
    lines = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return done.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "rank",
    )


@query(
    "op2_quality_rules",
    r"""WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS win,
    unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8),
rep AS (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    {'symbols': 10000 * n_symbols // greatest(word_chars, 1), 'dup_lines': 10000 * n_dup_lines // greatest(n_lines, 1),
     'repeats': 10000 * n_repeat_words // greatest(n_words, 1), 'word_length': 1000 * word_chars // greatest(n_words, 1)} AS v
  FROM m),
f AS (
  SELECT doc_id, lang, source, k, x, (x >> e) << e AS cell, least FROM (
    SELECT *, greatest(length(bin(x)) - 7, 0) AS e FROM (
      SELECT doc_id, lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) AS k,
        unnest([v.symbols, v.dup_lines, v.repeats, v.word_length]) AS x, unnest([100, 100, 100, 500]) AS least
      FROM b WHERE NOT base_failed))),
lev AS (
  SELECT doc_id, k, x, least, cell, lang, source, unnest([0, 1, 2]) AS lv FROM f),
grp AS (
  SELECT lv, CASE WHEN lv < 2 THEN lang END AS lang, CASE WHEN lv < 1 THEN source END AS source, k, any_value(least) AS least,
    count(*) AS n, list_sort(list(cell)) AS cells FROM lev GROUP BY 1, 2, 3, 4),
fen AS (
  SELECT lv, lang, source, k, n, cells[(n + 3) // 4] AS q1, cells[(3 * n + 3) // 4] AS q3, least FROM grp),
cut AS (SELECT lv, lang, source, k, n, q1 - 4 * greatest(q3 - q1, least) AS low, q3 + 4 * greatest(q3 - q1, least) AS high FROM fen),
ver AS (
  SELECT f.doc_id, f.k, f.x NOT BETWEEN CASE WHEN a.n >= 200 THEN a.low WHEN c.n >= 200 THEN c.low ELSE e.low END
    AND CASE WHEN a.n >= 200 THEN a.high WHEN c.n >= 200 THEN c.high ELSE e.high END AS bad
  FROM f JOIN cut a ON a.lv = 0 AND a.k = f.k AND a.lang IS NOT DISTINCT FROM f.lang AND a.source IS NOT DISTINCT FROM f.source
  JOIN cut c ON c.lv = 1 AND c.k = f.k AND c.lang IS NOT DISTINCT FROM f.lang JOIN cut e ON e.lv = 2 AND e.k = f.k),
vd AS (SELECT doc_id, bool_or(bad) AS bad FROM ver GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(bad, false) AS kept
FROM b LEFT JOIN vd ON vd.doc_id = b.doc_id""",
)
def _(spark, d):
    judged = quality.judge(table(spark, d, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op7_sharding")
def _(spark, d):
    """No SQL: the order is drawn at random. Tests hold the law, and every row against its input."""
    done = shards.shuffled_shards(table(spark, d, "documents").select("doc_id", "text"), 40, "doc_id")
    return done.select(
        "row.doc_id",
        (F.coalesce(F.octet_length("row.text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op8_mixing_sources",
    r"""WITH RECURSIVE t AS (
  SELECT doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS n
  FROM documents),
s AS (SELECT source, sum(n)::BIGINT AS tokens FROM t GROUP BY source),
x AS (SELECT max(tokens)::DOUBLE AS most, min(tokens)::DOUBLE AS least, sum(tokens)::DOUBLE AS total FROM s WHERE tokens > 0),
bis AS (
  SELECT 0 AS k, CASE WHEN most / least > 1.5 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS lo, 1.0::DOUBLE AS hi FROM x
  UNION ALL
  SELECT k + 1, CASE WHEN pow(least / most, (lo + hi) / 2 - 1) > 1.5 THEN (lo + hi) / 2 ELSE lo END,
    CASE WHEN pow(least / most, (lo + hi) / 2 - 1) > 1.5 THEN hi ELSE (lo + hi) / 2 END FROM bis, x WHERE k < 50),
a AS (SELECT hi AS a FROM bis WHERE k = 50),
r AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(tokens / total, a) ELSE 0 END AS r FROM s, x, a),
w AS (SELECT source, tokens, round(r / sum(r) OVER (), 9) AS weight FROM r),
b AS (SELECT max(ceil(tokens / weight)) AS budget FROM w WHERE tokens > 0),
g AS (SELECT source, weight, tokens, greatest(tokens, floor(weight * budget)::BIGINT) AS share FROM w, b),
q AS (SELECT source, weight, CASE WHEN tokens > 0 THEN share // tokens ELSE 1 END AS passes,
  CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS rest FROM g),
d AS (SELECT doc_id, source, n, ('0x' || md5('5|block|' || doc_id)[1:8])::BIGINT % 1024 AS block FROM t),
z AS (SELECT source, block, sum(n)::BIGINT AS size FROM d GROUP BY 1, 2),
e AS (SELECT z.source, block, size, weight, passes, rest, unnest(range(0, passes + 1)) AS copy FROM z JOIN q ON q.source = z.source),
o AS (SELECT *, ('0x' || md5('5|pass|' || copy || '|' || source || '|' || block)[1:8])::BIGINT AS drawn FROM e),
p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, copy ORDER BY drawn, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  row_number() OVER (PARTITION BY source, copy ORDER BY drawn, block) - 1 AS block_at FROM o),
c AS (SELECT d.doc_id, d.source, n, p.weight, p.copy, d.block, p.block_at, p.before, p.passes, p.rest,
    ('0x' || md5('5|row|' || copy || '|' || doc_id)[1:8])::BIGINT AS tm
  FROM d JOIN p ON p.source = d.source AND p.block = d.block),
f AS (SELECT *, row_number() OVER v - 1 AS slot, sum(n) OVER v AS upto FROM c
  WINDOW v AS (PARTITION BY source, copy, block ORDER BY tm, doc_id, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT doc_id, source, n AS n_tokens, weight, copy, block, block_at, slot FROM f WHERE copy < passes OR before + upto <= rest""",
)
def _(spark, d):
    docs = table(spark, d, "documents")
    words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), SPACE), lambda w: w != ""))
    return mixing.mix(docs.select("doc_id", "source", words.alias("n_tokens")), ["doc_id"], max_repetition=1.5)


@query(
    "op10_url_filters",
    r"""WITH p AS (
  SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts,
    ('0x' || md5('fetch|' || page_id)[1:8])::BIGINT % 366 AS tm FROM pages),
h AS (SELECT DISTINCT host, ('0x' || md5('host|' || host)[1:8])::BIGINT AS n FROM p WHERE host <> ''),
e AS (
  SELECT 'block' AS list, host AS pattern, n % 300 AS tm, 'add' AS action FROM h WHERE n % 10 < 5
  UNION ALL SELECT 'block', host, n % 300 + 40, 'remove' FROM h WHERE n % 10 < 4
  UNION ALL SELECT 'block', host, n % 300 + 100, 'add' FROM h WHERE n % 10 < 2
  UNION ALL SELECT 'allow', host || '/en', n % 200, 'add' FROM h WHERE n % 3 = 0
  UNION ALL SELECT DISTINCT 'block', array_to_string(string_split(host, '.')[-2:], '.'), 200, 'add' FROM h
  UNION ALL SELECT DISTINCT 'block', array_to_string(string_split(host, '.')[-2:], '.'), 230, 'remove' FROM h
  UNION ALL SELECT DISTINCT 'block', host || '/' || array_to_string(parts, '/'), 90, 'add' FROM p
    WHERE len(parts) > 0 AND ('0x' || md5('path|' || host || '/' || array_to_string(parts, '/'))[1:8])::BIGINT % 20 = 0),
m AS (SELECT list, pattern, tm, max(action = 'add') AS "on" FROM e GROUP BY 1, 2, 3),
i AS (SELECT list, pattern, tm AS since, lead(tm) OVER (PARTITION BY list, pattern ORDER BY tm) AS until, "on" FROM m),
k AS (
  SELECT page_id, tm, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
    list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[:i], '/')))) AS pattern FROM p WHERE host <> ''),
j AS (SELECT k.page_id, k.pattern, i.list, i.since, count(*) OVER (PARTITION BY k.page_id) AS n,
    row_number() OVER (PARTITION BY k.page_id ORDER BY length(k.pattern) DESC, i.list = 'block' DESC, k.pattern DESC) AS rn
  FROM k JOIN i ON i.pattern = k.pattern AND "on" AND since <= k.tm AND (until IS NULL OR k.tm < until))
SELECT p.page_id, p.tm AS fetch_day, coalesce(j.n, 0) AS n_active, j.pattern, j.list, j.since, coalesce(j.list = 'block', false) AS blocked
FROM p LEFT JOIN j ON j.page_id = p.page_id AND rn = 1""",
)
def _(spark, d):
    """Fetch days and list entries are dealt from the pages by digest: hosts come, go and come again."""
    pages = table(spark, d, "pages").select("page_id", "url", (md5_int("fetch", F.col("page_id")) % 366).alias("at"))
    hosts = pages.select(urls.host_of(F.col("url")).alias("host")).filter("host <> ''").distinct()
    hosts = materialize(hosts.withColumn("n", md5_int("host", F.col("host"))), "hosts")
    labels = F.split("host", r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    parts = F.filter(F.split(urls.path_of(F.col("url")), "/"), lambda x: x != "")
    path = F.concat(urls.host_of(F.col("url")), F.lit("/"), F.array_join(parts, "/"))

    def entry(rows, name, pattern, at, action):
        return rows.select(F.lit(name).alias("list"), pattern.alias("pattern"), at.cast("long").alias("at"), F.lit(action).alias("action"))

    host, day = F.col("host"), F.col("n") % 300
    paths = pages.filter(F.size(parts) > 0).select(path.alias("path")).filter(md5_int("path", F.col("path")) % 20 == 0).distinct()
    entries = (
        entry(hosts.filter("n % 10 < 5"), "block", host, day, "add")
        .unionByName(entry(hosts.filter("n % 10 < 4"), "block", host, day + 40, "remove"))
        .unionByName(entry(hosts.filter("n % 10 < 2"), "block", host, day + 100, "add"))
        .unionByName(entry(hosts.filter("n % 3 = 0"), "allow", F.concat(host, F.lit("/en")), F.col("n") % 200, "add"))
        .unionByName(entry(hosts, "block", domain, F.lit(200), "add"))
        .unionByName(entry(hosts, "block", domain, F.lit(230), "remove"))
        .unionByName(entry(paths, "block", F.col("path"), F.lit(90), "add"))
    )
    return urls.judge(pages, entries).select(
        "page_id", F.col("at").alias("fetch_day"), "n_active", "pattern", "list", "since", "blocked"
    )


@query(
    "op5_exact_dedup",
    r"""WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS size FROM n GROUP BY t)
SELECT doc_id, keep_id, size AS group_size, doc_id = keep_id AS kept, sha256(n.t) AS text_sha256 FROM n JOIN g ON g.t = n.t""",
)
def _(spark, d):
    done = exact.duplicates(table(spark, d, "documents"))
    return done.select(F.col("key").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", "text_sha256")


@query("op9_packing")
def _(spark, d):
    """No SQL: it has no tokenizer. Tests hold ids against whole texts and sequences against their budget."""
    import public_tokenizers

    rows = packing.tokenized(table(spark, d, "documents"), *map(public_tokenizers.path, ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")))
    return packing.packed(rows).withColumnRenamed("key", "doc_id")


@query("op3_language_id")
def _(spark, d):
    """No SQL: EM. Tests hold accuracy on held-out rows and on made mixtures."""
    docs = table(spark, d, "documents")
    fold = F.coalesce(langid.remainder("doc_id", 4), F.lit(0))
    model = langid.fit(docs.filter(fold != 2))
    done = langid.predict(docs, model)
    held = F.coalesce(langid.remainder("key", 4) == 2, F.lit(False))
    return done.select(F.col("key").alias("doc_id"), held.alias("held_out"), "lang_pred", "score", "shares")


@query("op4_lm_scoring")
def _(spark, d):
    """No SQL for the mixed model. Tests hold the counts against brute force and the score on held-out rows."""
    docs = table(spark, d, "documents")
    fold = F.coalesce(langid.remainder("doc_id", 5), F.lit(0))
    model = scoring.fit(docs.filter(fold != 1))
    held = F.coalesce(langid.remainder("key", 5) == 1, F.lit(False)).alias("held_out")
    return scoring.score(docs, model).select(
        F.col("key").alias("doc_id"), held, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query(
    "op6_ngram_jaccard_join",
)
def _(spark, d):
    """No SQL: components of all pairs are too slow on whole tables. Tests hold it against all pairs."""
    done = jaccard.similar(table(spark, d, "documents"), words=4, share=85)
    return done.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query(
    "op11_merkle_manifest",
    r"""WITH RECURSIVE d AS (
  SELECT doc_id, source, text, list_reduce([ord(x)::BIGINT for x in string_split(doc_id::VARCHAR, '')],
      lambda c, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
        lambda a, i: xor(a >> 1, (a & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT) AS c,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents),
f AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(c, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(text) || ':'
      || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))
    ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS bent FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM f),
t AS (
  SELECT 0 AS l, source, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM r
  UNION ALL
  SELECT l + 1, source, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16) FROM t WHERE n > 1 GROUP BY l, source, i // 16),
s AS (SELECT source, h, l AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS l, i, h, n FROM s
  UNION ALL
  SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16) FROM u WHERE n > 1 GROUP BY l, i // 16),
root AS (SELECT h AS root FROM u WHERE n = 1),
g AS (
  SELECT a.l, a.source, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM t a JOIN t b ON a.l = b.l AND a.source IS NOT DISTINCT FROM b.source AND a.i // 16 = b.i // 16 WHERE a.n > 1 GROUP BY 1, 2, 3),
v AS (
  SELECT a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS lft,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS rgt
  FROM u a JOIN u b ON a.l = b.l AND a.i // 16 = b.i // 16 WHERE a.n > 1 GROUP BY 1, 2),
p AS (
  SELECT r.*, s.h AS subroot, list_transform(x.sides, lambda e: e) AS low, y.sides AS high
  FROM r JOIN s ON s.source IS NOT DISTINCT FROM r.source
  LEFT JOIN LATERAL (SELECT list({'lft': g.lft, 'rgt': g.rgt} ORDER BY g.l) AS sides FROM g
    WHERE g.source IS NOT DISTINCT FROM r.source AND g.i = r.i // (16 ** g.l)::BIGINT) x ON true
  LEFT JOIN LATERAL (SELECT list({'lft': v.lft, 'rgt': v.rgt} ORDER BY v.l) AS sides FROM v WHERE v.i = s.i // (16 ** v.l)::BIGINT) y ON true),
q AS (SELECT doc_id, leaf, bent, subroot, list_concat(coalesce(low, []), coalesce(high, [])) AS sides FROM p),
k AS (
  SELECT doc_id, leaf, subroot, 0 AS l, bent AS h, sides FROM q
  UNION ALL
  SELECT doc_id, leaf, subroot, l + 1, sha256(sides[l + 1].lft || h || sides[l + 1].rgt), sides FROM k WHERE l < len(sides))
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(sides, lambda e: e.lft || e.rgt), 'string_agg', '')) AS proof_sha256,
  h AS folded_root, h = root AS verified
FROM k, root WHERE l = len(sides)""",
)
def _(spark, d):
    docs = table(spark, d, "documents")
    text = F.col("text")
    bent = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase),
    ).otherwise(text)
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select("doc_id", "source", merkle.leaf(*head, text).alias("leaf"), merkle.leaf(*head, bent).alias("bent"))
    done = merkle.proofs(merkle.build(leaves, "source", "doc_id", carry=["bent"]))
    back = merkle.folded(F.col("row.bent"), F.col("path"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root",
        merkle.proof_digest(F.col("path")).alias("proof_sha256"), back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_cross_tokenizer_alignment")
def _(spark, d):
    """No SQL: it has no tokenizers. Tests hold it against whole texts tokenized at once and all pairs of ranges."""
    import public_tokenizers

    files = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    done = align.alignments(table(spark, d, "documents"), *files)
    return done.select(
        F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@query(
    "op12_embedding_near_dedup",
    r"""WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, vec_id = c.c AS kept
FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
)
def _(spark, d):
    done = neardup.near_duplicates(table(spark, d, "embeddings"))
    return done.select(
        F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )
