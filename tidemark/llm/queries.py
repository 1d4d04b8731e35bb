"""The thin queries opN_<name>, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, embedding_links, html_text, katz, line_dedup, ngram_join, quality, secret_scan, url_filter


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _sha(column) -> F.Column:
    return F.sha2(column.cast("binary"), 256)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules that the contract of op4 fixes: decision, host, path.
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.95)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), size=5, percent=75)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_blocks", "n_template", "n_named", "n_outside")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.judge(pages.select("page_id", "url"), url_filter.link_edges(pages), URL_RULES)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", _sha(F.col("kept_text")).alias("kept_sha256"))


def crc_remainder(modulus: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op6_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(_table(spark, sf_dir, "documents"), crc_remainder(10) == 0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [*secret_scan.BASE_RULES, *secret_scan.MORE_RULES]
    out = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), rules)
    n_base = len(secret_scan.BASE_RULES)
    names = F.array(*[F.lit(r.name) for r in rules])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rule"]), s["begin"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda i: F.size(F.filter("spans", lambda s: s["rule"] == i)).cast("long")
    base = _sha(joined(F.filter("spans", lambda s: s["rule"] < n_base)))
    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), base.alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    machine = quality.train(docs, labels.filter(crc_remainder(3) != 1))
    out = quality.score(docs.select("doc_id", "text", "n_chars"), machine)
    return out.select("doc_id", (crc_remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=8)
    items = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    n_items = F.size("items").cast("long")
    return out.select("doc_id", "n_words", decontaminate.covered_words(F.col("hits")).alias("n_hit"), n_items.alias("n_items"), _sha(items).alias("items_sha256"), (n_items >= 2).alias("contaminated"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path()
    out = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path).select("doc_id", "ids")
    out = bpe.decode(out, path)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha(bpe.ids_text(F.col("ids"))).alias("ids_sha256"), _sha(F.col("decoded")).alias("decoded_sha256"))


QUERIES = {"op1_embedding_near_dedup": op1_embedding_near_dedup, "op2_ngram_jaccard": op2_ngram_jaccard, "op3_html_text": op3_html_text, "op4_url_filter": op4_url_filter, "op5_line_dedup": op5_line_dedup, "op6_katz_lm": op6_katz_lm, "op7_secret_scan": op7_secret_scan, "op8_quality": op8_quality, "op9_decontamination": op9_decontamination, "op10_bpe": op10_bpe}

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"



def _spans_sql(n: int, rule: secret_scan.Rule) -> str:
    """Rows (doc_id, rule, b, e) of one rule's matches that count: a match begins behind all matches and gaps before it."""
    regex = rule.regex.replace("'", "''")
    return f"""SELECT doc_id, {n} AS rule, e - length(m) AS b, e FROM (
      SELECT doc_id, m, g, sum(length(m) + length(gap)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
        SELECT doc_id, unnest(ms) AS m, unnest(gs) AS g, unnest(gaps[1:len(ms)]) AS gap, unnest(range(len(ms))) AS i FROM (
          SELECT doc_id, regexp_extract_all(t, '{regex}') AS ms, regexp_extract_all(t, '{regex}', {rule.group}) AS gs, string_split_regex(t, '{regex}') AS gaps FROM d))) WHERE length(g) >= {rule.least}"""


_SPANS = "\nUNION ALL ".join(_spans_sql(i, r) for i, r in enumerate([*secret_scan.BASE_RULES, *secret_scan.MORE_RULES]))
_KINDS = ", ".join(f"'{r.name}'" for r in [*secret_scan.BASE_RULES, *secret_scan.MORE_RULES])
_RULES = ", ".join(f"('{d}', '{h}', '{p}')" for d, h, p in URL_RULES)

ORACLE_SQL = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                     WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
     r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
     n AS (SELECT a, count(*) AS n FROM p GROUP BY a), c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id""",
    "op2_ngram_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS t FROM w),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
     p AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
     r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
     m AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op4_url_filter": rf"""
WITH RECURSIVE rules AS (SELECT * FROM (VALUES {_RULES}) AS t(decision, rule_host, rule_path)),
     plain AS (SELECT url, regexp_replace(html, '(?s)<!--.*?(?:-->|\z)', ' ', 'g') AS html FROM pages WHERE contains(url, '://')),
     tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*>')) AS tag, 'link' AS kind FROM plain
              UNION ALL SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*>')), 'meta' FROM plain),
     told AS (SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^">]*)"|''([^''>]*)''|([^"''\s>]+))', 1) || regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^">]*)"|''([^''>]*)''|([^"''\s>]+))', 2) || regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^">]*)"|''([^''>]*)''|([^"''\s>]+))', 3) AS t
              FROM tags WHERE kind = 'link' AND regexp_matches(tag, '(?is)\bhref\s*=') AND list_contains(string_split_regex(lower(regexp_extract(tag, '(?is)\brel\s*=\s*(?:"([^">]*)"|''([^''>]*)''|([^"''\s/>]+))', 1) || regexp_extract(tag, '(?is)\brel\s*=\s*(?:"([^">]*)"|''([^''>]*)''|([^"''\s/>]+))', 2) || regexp_extract(tag, '(?is)\brel\s*=\s*(?:"([^">]*)"|''([^''>]*)''|([^"''\s/>]+))', 3)), '\s+'), 'canonical')
              UNION ALL SELECT url, regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM tags WHERE kind = 'meta' AND regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b') AND regexp_matches(tag, '(?is)\burl\s*=')),
     clear AS (SELECT url, trim(replace(replace(replace(replace(replace(replace(replace(replace(t, '&#x2F;', '/'), '&#47;', '/'), '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&#38;', '&'), '&amp;', '&')) AS t FROM told),
     parts AS (SELECT url, t, regexp_extract(url, '(?s)^.*?://[^/?#]*') AS start, regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS own FROM clear),
     joined AS (SELECT *, CASE WHEN starts_with(t, '/') THEN t ELSE CASE WHEN contains(own, '/') THEN regexp_replace(own, '[^/]*$', '') ELSE '/' END || t END AS j FROM parts),
     steps AS (SELECT *, string_split(regexp_extract(j, '(?s)^[^?#]*'), '/') AS segs, regexp_extract(j, '(?s)^[^?#]*(.*)$', 1) AS tail FROM joined),
     walked AS (SELECT *, list_reduce(list_transform(segs, lambda x: [x]), lambda done, x: CASE WHEN x[1] = '..' THEN done[1:greatest(len(done) - 1, 1)] WHEN x[1] = '.' THEN done ELSE done || x END) AS found FROM steps),
     links AS (SELECT url, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?):?//', 1) || ':' || t
                               WHEN t = '' OR starts_with(t, '#') OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(t, '?') THEN start || own || t
                               ELSE start || array_to_string(found, '/') || CASE WHEN segs[-1] IN ('.', '..') THEN '/' ELSE '' END || tail END AS target FROM walked),
     urls AS (SELECT url FROM pages UNION SELECT target FROM links),
     keys AS (SELECT url, CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END AS k FROM urls),
     e AS (SELECT a.k AS a, b.k AS b FROM links l JOIN keys a ON l.url = a.url JOIN keys b ON l.target = b.url WHERE a.k <> b.k),
     ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
     nodes AS (SELECT DISTINCT k, regexp_extract(k, '(?s)^[^/?#]*') AS host, regexp_extract(k, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM keys WHERE k IS NOT NULL),
     fits AS (SELECT k, rule_host || rule_path AS rule, decision, row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC, decision, rule_host || rule_path) AS i
              FROM nodes JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
     ruled AS (SELECT k, rule, decision FROM fits WHERE i = 1),
     reach AS (SELECT DISTINCT a, a AS b FROM ways UNION SELECT r.a, ways.b FROM reach r JOIN ways ON r.b = ways.a),
     spread AS (SELECT reach.a AS k, min(decision) AS inherited FROM reach JOIN ruled ON reach.b = ruled.k GROUP BY reach.a)
SELECT page_id, coalesce(nodes.host, '') AS host, coalesce(nodes.path, '') AS path, ruled.rule, coalesce(ruled.decision, spread.inherited, 'allow') AS verdict
FROM pages LEFT JOIN keys ON pages.url = keys.url LEFT JOIN nodes ON keys.k = nodes.k LEFT JOIN ruled ON ruled.k = keys.k LEFT JOIN spread ON spread.k = keys.k""",
    "op7_secret_scan": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     s AS ({_SPANS}),
     n AS (SELECT doc_id, rule, b, [{_KINDS}][rule + 1] || ':' || CAST(CAST(b AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR) AS x FROM s)
SELECT d.doc_id, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access, count(*) FILTER (WHERE rule = 2) AS n_hex,
       sha256(coalesce(string_agg(x, ',' ORDER BY b, rule) FILTER (WHERE rule < 3), '')) AS base_sha256, coalesce(string_agg(x, ',' ORDER BY b, rule), '') AS spans
FROM d LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op9_decontamination": rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     v AS (SELECT DISTINCT item_id, least(len(w), 8) AS n, array_to_string(w[k + 1:k + 8], ' ') AS x FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 7, 1))) AS k FROM i WHERE len(w) > 0)),
     p AS (SELECT doc_id, n, k, array_to_string(w[k + 1:k + n], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS k FROM w, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)),
     h AS (SELECT doc_id, k, p.n, item_id FROM p JOIN v ON p.x = v.x AND p.n = v.n),
     c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS q FROM h) GROUP BY doc_id),
     g AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN g ON g.doc_id = w.doc_id""",
    "op5_line_dedup": f"""
WITH l AS (SELECT doc_id, pos, ls[pos] AS line, translate(trim(ls[pos], {SPACE}), '{UPPER}', '{LOWER}') AS k
           FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS pos
                 FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
     g AS (SELECT k, count(DISTINCT doc_id) AS n, max(doc_id) AS last FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
     m AS (SELECT l.doc_id, l.pos, l.line, g.k IS NOT NULL AND l.doc_id <> g.last AS gone FROM l LEFT JOIN g ON l.k = g.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
}
