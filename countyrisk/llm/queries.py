"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import jaccard_join, merkle, mixing, packing, periodic_runs, quality_classifier, quality_rules, secrets, suffix_dedup
from . import token_counts, topk, toxicity, url_filter
from .url_filter import Rule

# The rules that op4 judges by.
URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


# The tokenizer that op11 counts with.
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_report(_table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", 5)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(_table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.scan_secrets(_table(spark, sf_dir, "documents")))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_topk": op3_topk,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_token_counts": op11_token_counts,
    "op12_merkle": op12_merkle,
    "op13_periodic_runs": op13_periodic_runs,
}


def merkle_sql(levels: int = 12, group_levels: int = 4) -> str:
    """DuckDB SQL for op12, for up to 8 ^ ``levels`` rows a language and 8 ^ ``group_levels`` languages."""
    field = "coalesce({0} || ':' || {1}, '-')".format
    text = lambda t: field(f"CAST(strlen({t}) AS VARCHAR)", t)
    number = lambda c: text(f"CAST({c} AS VARCHAR)")
    leaf = lambda t: f"sha256({number('doc_id')} || {text('source')} || {text('lang')} || {number('n_chars')} || {text(t)})"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)) + 0 * z)"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {step}), 4294967295)"

    def climb(name: str, depth: int) -> str:
        parts = []
        for at in range(depth):
            around = "OVER (PARTITION BY tree, place // 8 ORDER BY place ROWS BETWEEN {})".format
            before = f"string_agg(digest, '') {around('UNBOUNDED PRECEDING AND 1 PRECEDING')}"
            after = f"string_agg(digest, '') {around('1 FOLLOWING AND UNBOUNDED FOLLOWING')}"
            parts.append(
                f"{name}_way{at} AS (SELECT tree, place, n, coalesce({before}, '') AS before, coalesce({after}, '') AS after FROM {name}{at})"
            )
            parts.append(
                f"{name}{at + 1} AS (SELECT tree, place // 8 AS place, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN"
                f" sha256(string_agg(digest, '' ORDER BY place)) ELSE any_value(digest) END AS digest FROM {name}{at} GROUP BY tree, place // 8, n)"
            )
        return ",\n".join(parts)

    def fold(name: str, depth: int, start: str, table: str, place: str) -> tuple[str, str]:
        """CTEs that fold a level each into ``h`` and ``siblings``."""
        parts, last = [], start
        for at in range(depth):
            parts.append(
                f"{name}{at} AS (SELECT d.* REPLACE (CASE WHEN w.n > 1 THEN sha256(w.before || d.h || w.after) ELSE d.h END AS h,"
                f" d.siblings || w.before || w.after AS siblings) FROM {last} d JOIN {table}_way{at} w"
                f" ON w.tree = d.{place}_tree AND w.place = d.{place} // {8**at})"
            )
            last = f"{name}{at}"
        return ",\n".join(parts), last

    inner, last = fold("f", levels, "d0", "l", "place")
    outer, end = fold("g", group_levels, "g_start", "t", "top")
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf("text")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(low)} END AS forged
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM rows
), l0 AS (SELECT tree, place, n, leaf AS digest FROM placed),
{climb("l", levels)},
t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n, digest, tree AS grp FROM l{levels}),
{climb("t", group_levels)},
d0 AS (
  SELECT p.doc_id, p.leaf, p.place, p.tree AS place_tree, t.place AS top, '' AS top_tree, t.digest AS subroot, coalesce(p.forged, p.leaf) AS h, '' AS siblings
  FROM placed p JOIN t0 t ON t.grp = p.tree
),
{inner},
g_start AS (SELECT * FROM {last}),
{outer}
SELECT doc_id, leaf, subroot, r.digest AS root, sha256(siblings) AS proof_sha256, h AS folded_root, h = r.digest AS verified
FROM {end} CROSS JOIN t{group_levels} r"""


ORACLES = {
    "op2_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 90 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id""",
    "op3_topk": """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op4_url_filter": """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
    ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT p.page_id, rule_host || rule_path AS rule, verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(rule_host || rule_path) DESC) AS k
  FROM parts p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1""",
    "op12_merkle": merkle_sql(),
}
