"""Named queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsubo.llm import decontaminate, jaccard_join, language, manifest, mixing, prefix_trie, private_terms, quality, quotes, repeats, secrets_scan, toxicity, url_filter
from tsubo.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Both queries state the linking of given messages m(conv_id, turn, role, text).
_QUOTES = r""", l AS (
  SELECT conv_id, turn, i, line, len(regexp_extract_all(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+'), '>')) AS level,
         substr(line, length(regexp_extract(line, '^[ \t]*(?:>[ \t]?)+')) + 1) AS content
  FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m WHERE text <> '')
), k AS (
  SELECT *, lower(trim(regexp_replace(content, '\s+', ' ', 'g'))) AS c, lead(level, 1, 0) OVER (PARTITION BY conv_id, turn ORDER BY i) AS next FROM l
), o AS (SELECT DISTINCT conv_id, turn, c FROM k WHERE level = 0 AND c <> ''),
q AS (SELECT k.conv_id, k.turn, k.level, k.i, max(o.turn) AS source FROM k LEFT JOIN o ON k.conv_id = o.conv_id AND k.c = o.c AND o.turn < k.turn
      WHERE k.level > 0 AND k.c <> '' GROUP BY k.conv_id, k.turn, k.level, k.i),
v AS (SELECT conv_id, turn, source, count(*) AS n FROM q WHERE level = 1 AND source IS NOT NULL GROUP BY ALL),
p AS (SELECT conv_id, turn, max(struct_pack(n := n, source := source)).source AS parent FROM v GROUP BY ALL),
r(conv_id, turn, up) AS (SELECT conv_id, turn, parent FROM p UNION ALL SELECT r.conv_id, r.turn, p.parent FROM r JOIN p ON r.conv_id = p.conv_id AND r.up = p.turn),
t AS (SELECT conv_id, turn, min(up) AS thread FROM r GROUP BY ALL),
n AS (SELECT conv_id, turn, count(*) AS n_quoted, count(source) AS n_linked FROM q GROUP BY ALL),
x AS (SELECT conv_id, turn, string_agg(content, chr(10) ORDER BY i) AS text FROM k
      WHERE level = 0 AND NOT (next > 0 AND regexp_matches(content, 'wrote:\s*$')) GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, regexp_replace(coalesce(x.text, ''), '^\s+|\s+$', '', 'g') AS text, parent, coalesce(thread, m.turn) AS thread,
       coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked
FROM m LEFT JOIN x USING (conv_id, turn) LEFT JOIN p USING (conv_id, turn) LEFT JOIN t USING (conv_id, turn) LEFT JOIN n USING (conv_id, turn)
"""


@query
def op1_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link(read_table(spark, folder, "conversations"))


ORACLES["op1_quotation_links"] = "WITH RECURSIVE m AS (SELECT conv_id, turn, role, text FROM conversations)" + _QUOTES


@query
def quoted_replies(spark: SparkSession, folder: str) -> DataFrame:
    """The same over messages that quote, derived from all given ones."""
    return quotes.link(quotes.quoting(read_table(spark, folder, "conversations")))


ORACLES["quoted_replies"] = (
    r"""WITH RECURSIVE f AS (SELECT conv_id, turn, string_split(text, chr(10))[1:2] AS lines FROM conversations),
m AS (SELECT c.conv_id, c.turn, c.role, array_to_string(
        list_transform(coalesce(b.lines, []), lambda x: '>> ' || x) || list_transform(coalesce(a.lines, []), lambda x: '> ' || x) || [c.text], chr(10)) AS text
      FROM conversations c LEFT JOIN f a ON a.conv_id = c.conv_id AND a.turn + 2 = c.turn LEFT JOIN f b ON b.conv_id = c.conv_id AND b.turn + 4 = c.turn)"""
    + _QUOTES
)


@query
def op2_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality.ledger(read_table(spark, folder, "documents"))
    return entries.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        (~quality.passes(quality.POLICIES[quality.BASE])).alias("base_failed"),
        quality.passes(quality.POLICIES[quality.CURRENT]).alias("kept"),
    )


ORACLES["op2_rule_ledger"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), triples AS (
  SELECT r, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS t FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM triples) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(l) AS BIGINT) AS n_lines
  FROM d LEFT JOIN repeated USING (r)
), f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (n_lines >= 4 AND 2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
    + 32 * (word_chars > 20 * n_words)::INT AS BIGINT) AS failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, (failed & 3) <> 0 AS base_failed, failed = 0 AS kept FROM f
"""


@query
def policy_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What each policy version keeps of all documents, from the ledger's bits."""
    return quality.apply_policies(quality.ledger(read_table(spark, folder, "documents")))


ORACLES["policy_counts"] = f"""
SELECT version, mask, CAST(count(*) FILTER ((failed & mask) = 0) AS BIGINT) AS kept, CAST(count(*) FILTER ((failed & mask) <> 0) AS BIGINT) AS rejected
FROM (VALUES (CAST(1 AS INTEGER), CAST(3 AS BIGINT)), (2, 63)) AS p(version, mask), ({ORACLES["op2_rule_ledger"]}) GROUP BY version, mask
"""


@query
def rule_ablation(spark: SparkSession, folder: str) -> DataFrame:
    """Per rule of the current policy, the documents that fail it and those that only it rejects."""
    return quality.ablation(quality.ledger(read_table(spark, folder, "documents")))


ORACLES["rule_ablation"] = f"""
SELECT bit, rule, CAST(count(*) FILTER ((failed >> bit) & 1 = 1) AS BIGINT) AS fails, CAST(count(*) FILTER (failed = CAST(1 AS BIGINT) << bit) AS BIGINT) AS fails_alone
FROM (VALUES (CAST(0 AS INTEGER), 'too_few_words'), (1, 'repeated_words'), (2, 'symbols'), (3, 'repeated_lines'), (4, 'short_words'), (5, 'long_words')) AS r(bit, rule),
     ({ORACLES["op2_rule_ledger"]}) GROUP BY bit, rule
"""


@query
def op3_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(read_table(spark, folder, "documents"))


@query
def op4_repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.repeated_ranges(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op5_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


@query
def op6_guess_cost_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_scan.report(read_table(spark, folder, "documents"))


@query
def op8_revealing_terms(spark: SparkSession, folder: str) -> DataFrame:
    return private_terms.report(read_table(spark, folder, "documents"))


@query
def op7_grouped_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.similarity_classes(read_table(spark, folder, "documents"))


@query
def op9_listed_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    return url_filter.judge(pages, url_filter.rules_table(spark), url_filter.mirrored(pages))


ORACLES["op9_listed_urls"] = r"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), c AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html?|/+)$', '') AS name FROM p
), listed AS (
  SELECT name FROM c WHERE name <> '' GROUP BY name HAVING min(url) <> max(url)
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fit AS (
  SELECT page_id, arg_max(r.h || r.p, len(r.h || r.p)) AS rule, arg_max(r.verdict, len(r.h || r.p)) AS rv
  FROM c JOIN rules r ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN name IN (SELECT name FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN fit USING (page_id)
"""


@query
def op10_contained_items(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


ORACLES["op10_contained_items"] = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
it AS (SELECT DISTINCT item_id, least(len(w), 5) AS k, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM iw WHERE len(w) > 0)),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS s
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM it) WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_item FROM it GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared FROM ds JOIN it USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING 100 * count(*) >= 80 * n_item
"""


# Unsigned CRC-32 of a decimal id as DuckDB SQL: bytes in turn, eight shifts each.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, zero: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.shared_prefixes(read_table(spark, folder, "conversations")).drop("left", "right")


ORACLES["op11_prefix_trie"] = (
    r"""
WITH t AS (
  SELECT conv_id, sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))[:32] AS g,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w, turn
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT conv_id, list(struct_pack(g := g, w := w) ORDER BY turn NULLS FIRST, g) AS seq FROM t GROUP BY conv_id
), c AS (
  SELECT conv_id, conv_id - ((conv_id % 20) + 20) % 20 AS opening, seq, """
    + _CRC32.format(id="conv_id")
    + r""" % 4 AS h FROM s
), b AS (
  SELECT c.conv_id, list_concat(coalesce(o.seq, [])[1:c.h], c.seq[c.h + 1:]) AS seq FROM c LEFT JOIN s o ON o.conv_id = c.opening
), p AS (
  SELECT conv_id, len(seq) AS n, d, array_to_string(list_transform(seq[1:d], lambda x: x.g), '') AS path, CASE WHEN d > 0 THEN seq[d].w ELSE 0 END AS w
  FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM b)
), nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM p GROUP BY path, d
), k AS (SELECT path[:32 * (d - 1)] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN k USING (path)),
under AS (
  SELECT path[:32 * up] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * w) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM counted) GROUP BY ALL
)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, x.ends_sha256
FROM counted x JOIN under USING (path) LEFT JOIN nodes u ON x.d > 0 AND u.path = x.path[:32 * (x.d - 1)]
"""
)


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.document_proofs(read_table(spark, folder, "documents"))


ORACLES["op12_merkle_manifest"] = (
    r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, """
    + "".join(f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-') || " for c in ("doc_id", "source", "lang", "n_chars"))
    + r"""'' AS head FROM documents
), t AS (
  SELECT *, sha256(head || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-')) AS leaf,
         CASE WHEN coalesce("""
    + _CRC32.format(id="doc_id")
    + r""" % 3 = 0, false) THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS now FROM d
), l AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
         sha256(head || coalesce(CAST(strlen(now) AS VARCHAR) || ':' || now, '-')) AS changed FROM t
), nodes(level, lang, spot, h) AS (
  SELECT 0, lang, spot, leaf FROM l
  UNION ALL
  SELECT level + 1, lang, spot // 8, sha256(string_agg(h, '' ORDER BY spot)) FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM nodes)
  WHERE n > 1 GROUP BY level, lang, spot // 8
), subroots AS (
  SELECT lang, level AS height, h FROM (SELECT *, count(*) OVER (PARTITION BY level, lang) AS n FROM nodes) WHERE n = 1
), tops(level, spot, h) AS (
  SELECT 0, row_number() OVER (ORDER BY lang NULLS FIRST) - 1, h FROM subroots
  UNION ALL
  SELECT level + 1, spot // 8, sha256(string_agg(h, '' ORDER BY spot)) FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, spot // 8
), places AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM subroots),
every AS (
  SELECT 0 AS part, level, lang, spot, h FROM nodes UNION ALL SELECT 1, level, '' AS lang, spot, h FROM tops
), siblings AS (
  SELECT part, level, lang, spot, count(*) OVER (PARTITION BY part, level, lang) AS n,
         coalesce(string_agg(h, '') OVER (PARTITION BY part, level, lang, spot // 8 ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (PARTITION BY part, level, lang, spot // 8 ORDER BY spot ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM every
), steps AS (
  SELECT l.lang, l.spot, s.part, s.level, s.before, s.after
  FROM l JOIN siblings s ON s.part = 0 AND s.lang IS NOT DISTINCT FROM l.lang AND s.spot = l.spot // CAST(power(8, s.level) AS BIGINT) AND s.n > 1
  UNION ALL
  SELECT l.lang, l.spot, s.part, s.level, s.before, s.after
  FROM l JOIN places p ON p.lang IS NOT DISTINCT FROM l.lang JOIN siblings s ON s.part = 1 AND s.spot = p.place // CAST(power(8, s.level) AS BIGINT) AND s.n > 1
), ways AS (
  SELECT lang, spot, string_agg(before || after, '' ORDER BY part, level) AS proof, list(struct_pack(before := before, after := after) ORDER BY part, level) AS way
  FROM steps GROUP BY lang, spot
), folds(lang, spot, i, h, way) AS (
  SELECT l.lang, l.spot, 0, l.changed, coalesce(w.way, []) FROM l LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM l.lang AND w.spot = l.spot
  UNION ALL
  SELECT lang, spot, i + 1, sha256(way[i + 1].before || h || way[i + 1].after), way FROM folds WHERE i < len(way)
), ends AS (SELECT lang, spot, h FROM folds WHERE i = len(way)),
top AS (SELECT h AS root FROM (SELECT *, count(*) OVER (PARTITION BY level) AS n FROM tops) WHERE n = 1)
SELECT l.doc_id, l.leaf, r.h AS subroot, root, sha256(coalesce(w.proof, '')) AS proof_sha256, e.h AS folded_root, e.h = root AS verified
FROM l CROSS JOIN top JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang JOIN ends e ON e.lang IS NOT DISTINCT FROM l.lang AND e.spot = l.spot
LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM l.lang AND w.spot = l.spot
"""
)


@query
def op13_factorization_machine(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
