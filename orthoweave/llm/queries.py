"""The queries of this subpackage, with production parameters over whole tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.llm import chat_format, decontaminate, langid, license_scan, lm_score, mixing, near_dedup, pii, quality, url_filter
from orthoweave.llm.common import bucket, table

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return url_filter.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.known(spark))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), bucket(F.col("doc_id"), 10) == 0)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80).drop("uid", "group")


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = bucket(F.col("doc_id"), 4) == 2
    return langid.identify(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.rotations(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_url_filter, op2_license_scan, op3_pii, op4_lm_score, op5_decontaminate, op6_near_dedup, op7_langid, op8_mixing, op9_quality, op10_chat_format)
}

_URL = """
WITH u AS (SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) AS host,
  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT u.page_id, any_value(u.host) AS host, any_value(u.path) AS path,
  arg_max(h || p, length(h || p)) AS rule, coalesce(arg_max(verdict, length(h || p)), 'allow') AS verdict
FROM u LEFT JOIN r ON (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)
GROUP BY u.page_id, u.url
"""

_CONTAMINATION = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
iw AS (SELECT item_id, least(len(ws), 13) AS n, array_to_string(ws[o:o + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS o FROM i WHERE len(ws) > 0)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, o, array_to_string(ws[o:o + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS o FROM w, ns WHERE len(ws) >= n)),
h AS (SELECT doc_id, item_id, o, dw.n FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(o, o + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN t ON w.doc_id = t.doc_id
"""

_CHAT = """
WITH r AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
  replace(translate(coalesce(role, 'unknown'), chr(13) || chr(10), '  '), '<|im_', '<\\|im_') AS speaker, replace(coalesce(text, ''), '<|im_', '<\\|im_') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, speaker AS perspective FROM r WHERE speaker <> 'system'),
t AS (SELECT r.conv_id, perspective, turn, speaker, text,
  '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user name=' || speaker END || chr(10) AS head
  FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
m AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM t),
p AS (SELECT *, row_number() OVER w - 1 AS position, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st,
  count(*) OVER (PARTITION BY conv_id, perspective) AS n_turns FROM m WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text))
SELECT conv_id, perspective, position, turn, speaker, segment, speaker = perspective AS trained, CAST(st AS BIGINT) AS "start",
  CAST(st + length(head) AS BIGINT) AS content_start, CAST(st + length(head) + length(text) AS BIGINT) AS content_end, CAST(st + length(segment) AS BIGINT) AS "end", n_turns FROM p
"""

_NEAR = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE ws END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.root AS component_id, w.doc_id = m.root AS kept FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.id = w.doc_id
"""


def _canonical(text: str) -> str:
    """The canonical form of licence scans as SQL."""
    got = f"regexp_replace(lower(coalesce({text}, '')), '(?m)^[^\\p{{L}}\\p{{N}}\\n(©]*(?:copyright\\b|\\(c\\)|©|all rights reserved)[^\\n]*$', '', 'g')"
    got = f"replace(' ' || replace(regexp_replace({got}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), chr(10), ' ' || chr(10) || ' ') || ' ', '  ', ' ')"
    for old, new in license_scan.SPELLINGS.items():
        got = f"replace(replace({got}, ' {old} ', ' {new} '), ' {old} ', ' {new} ')"
    return f"list_filter(list_transform(string_split({got}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"


def _license() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(k)}, {quoted(t)})" for k, t in [*license_scan.KNOWN.items(), *((v, k) for k, v in license_scan.NOTICES.items())])
    return f"""
WITH k AS (SELECT min(name) AS name, form FROM (SELECT name, array_to_string({_canonical("t")}, ' ') AS form FROM (VALUES {known}) v(name, t)) GROUP BY form),
d AS (SELECT doc_id, {_canonical("text")} AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS form FROM d),
f AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices, count(*) AS n FROM l JOIN k USING (form) GROUP BY doc_id)
SELECT d.doc_id, k.name AS license, coalesce(f.notices, '') AS notices, coalesce(f.n, 0) AS n_notices
FROM d LEFT JOIN k ON k.form = array_to_string(d.lines, ' ') LEFT JOIN f ON f.doc_id = d.doc_id
"""


ORACLE = {"op1_url_filter": _URL, "op2_license_scan": _license(), "op5_decontaminate": _CONTAMINATION, "op6_near_dedup": _NEAR, "op10_chat_format": _CHAT}
