"""Queries of the corpus operators, with production parameters, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrain.llm import mixing, search, url_filter
from pricegrain.llm.common import crc_bucket
from pricegrain.llm.decontaminate import contaminated
from pricegrain.llm.exact import exact_duplicates
from pricegrain.llm.fingerprint import fingerprints
from pricegrain.llm.language_id import predict_language
from pricegrain.llm.licenses import license_scan
from pricegrain.llm.mixing import mix
from pricegrain.llm.repeats import LENGTH, remove_repeats
from pricegrain.llm.search import search_documents
from pricegrain.llm.simhash import near_duplicates
from pricegrain.llm.tokens import token_counts
from pricegrain.llm.toxicity import score_toxicity
from pricegrain.llm.trie import conversation_trie
from pricegrain.llm.url_filter import judge_urls
from pricegrain.session import attach


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return attach(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    return predict_language(table(spark, sf_dir, "documents"), ~held_out).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "distance")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_bucket(F.col("doc_id"), 3) == 1
    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "vote", "evidence")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).drop("trust", "distrust")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_language_id, op2_toxicity, op3_license_scan, op4_decontamination, op5_fingerprints, op6_url_filter, op7_simhash, op8_suffix_dedup, op9_token_counts, op10_mixing, op11_exact_dedup, op12_conversation_trie, op13_ranked_search)
}


def mixing_sql(block: int = mixing.BLOCK) -> str:
    """The mix in DuckDB: fill by weight, number each source's slots, permute them to blocks, join blocks by index, count each document's words.

    In which shard a slot stands makes no difference to these counts.
    """
    p, rounds = mixing.PRIME, mixing.ROUNDS

    def hashed(x: str, salt: str) -> str:
        y = f"((({x}) % {p} + 1) * {mixing.FACTOR} + (({x}) // {p}) * {mixing.HIGH} + ({salt}) * {mixing.STEP}) % {p}"
        return f"(({y}) * (({y}) + {mixing.STEP})) % {p}"

    steps, last = [], "slot_rows"
    for k in range(rounds):
        key = f"{k} + source_no * {rounds}"
        steps.append(f"p{k} AS (SELECT *, ((({hashed(key, '7')}) * {p} + ({hashed(key, '13')}) - x) % blocks + blocks) % blocks AS q FROM {last})")
        steps.append(f"g{k} AS (SELECT *, greatest(x, q) + {k * 1_000_003} AS g FROM p{k})")
        steps.append(f"h{k} AS (SELECT source_no, blocks, CASE WHEN {hashed('g', 'source_no')} % 2 = 1 THEN q ELSE x END AS x FROM g{k})")
        last = f"h{k}"
    return f"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no FROM sizes GROUP BY source),
weighed AS (SELECT *, 2e0 * source_size / weight AS ratio FROM (SELECT *, CASE source_no % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM src)),
level AS (SELECT *, 15e-1 * sum(source_size) OVER ()::DOUBLE - 2e0 * coalesce(sum(source_size) OVER w, 0)::DOUBLE AS rest, (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS heavy FROM weighed WINDOW w AS (ORDER BY ratio, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lowest AS (SELECT ratio AS r0, source_no AS s0, rest AS rest0, heavy AS heavy0 FROM level WHERE rest <= ratio * heavy ORDER BY ratio, source_no LIMIT 1),
targets AS (SELECT source, source_no, source_size, CASE WHEN r0 IS NULL OR ratio < r0 OR (ratio = r0 AND source_no < s0) THEN 2e0 * source_size ELSE weight * rest0 / heavy0 END AS target FROM level LEFT JOIN lowest ON true),
edges AS (SELECT *, ceil(source_size / {block}e0)::BIGINT AS blocks, floor(sum(target) OVER (ORDER BY source_no) / {block} + 5e-1)::BIGINT AS upper FROM targets),
plan AS (SELECT *, upper - coalesce(lag(upper) OVER (ORDER BY source_no), 0) AS slots FROM edges),
slot_rows AS (SELECT source_no, blocks, j % blocks AS x FROM (SELECT source_no, blocks, unnest(range(0, slots)) AS j FROM plan)),
{', '.join(steps)},
used AS (SELECT source_no, x AS b, count(*) AS uses FROM {last} GROUP BY ALL),
placed AS (SELECT s.doc_id, s.size, sum(s.size) OVER (PARTITION BY s.source ORDER BY s.doc_id NULLS FIRST, s.size ROWS UNBOUNDED PRECEDING)::BIGINT - s.size AS first_word, p.source_no, p.source_size, p.target FROM sizes s JOIN plan p ON p.source IS NOT DISTINCT FROM s.source),
held AS (SELECT *, unnest(range(first_word // {block}, (first_word + size - 1) // {block} + 1)) AS b FROM placed WHERE size > 0),
got AS (SELECT doc_id, first_word, source_no, sum((least(first_word + size, (b + 1) * {block}) - greatest(first_word, b * {block})) * uses)::BIGINT AS taken FROM held JOIN used USING (source_no, b) GROUP BY ALL)
SELECT p.doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM placed p LEFT JOIN got g ON g.doc_id IS NOT DISTINCT FROM p.doc_id AND g.first_word = p.first_word AND g.source_no = p.source_no AND p.size > 0"""


def url_sql() -> str:
    """Rules and propagation in DuckDB, one CTE for each round."""
    ordered = sorted(url_filter.RULES, key=lambda x: -len(x[1] + x[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    pick = lambda value: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{value(v, h, p)}'" for v, h, p in ordered) + " END"
    host = lambda u: f"translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    d, rounds, last = f"{url_filter.DAMPING:e}", [], "start"
    for k in range(url_filter.ROUNDS):
        rounds.append(f"r{k} AS (SELECT kind, host, sum(score) AS score FROM (SELECT s.kind, t.dst AS host, s.score * t.step AS score FROM {last} s JOIN steps t ON t.kind = s.kind AND t.src = s.host UNION ALL SELECT kind, host, score FROM start) GROUP BY ALL)")
        last = f"r{k}"
    return f"""
WITH parts AS (SELECT page_id, html, coalesce({host('url')}, '') AS host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
judged AS (SELECT *, {pick(lambda v, h, p: h + p)} AS rule, {pick(lambda v, h, p: v)} AS by_rule FROM parts),
hosts AS (SELECT host, count(*) FILTER (by_rule = 'allow') AS trust, count(*) FILTER (by_rule = 'block') AS distrust FROM judged WHERE host <> '' GROUP BY host),
links AS (SELECT src, dst, 1e0 AS links FROM (SELECT host AS src, {host('link')} AS dst FROM (SELECT host, unnest(regexp_extract_all(html, '(?i)(?:href|src)\\s*=\\s*["'']?(https?://[^"''\\s>]+)', 1)) AS link FROM parts)) WHERE src <> dst AND src <> '' AND dst <> ''),
labels AS (SELECT string_split(host, '.') AS l FROM hosts),
chains AS (SELECT DISTINCT array_to_string(l[i + 1:], '.') AS child, array_to_string(l[i + 2:], '.') AS above, len(l[i + 2:]) AS left_labels FROM (SELECT l, unnest(range(0, greatest(len(l) - 2, 0) + 1)) AS i FROM labels)),
ties AS (SELECT child, above FROM chains WHERE left_labels >= 2),
edges AS (SELECT src, dst, sum(links) AS links FROM (SELECT * FROM links UNION ALL SELECT child, above, {url_filter.PARENT_LINKS:e} FROM ties UNION ALL SELECT above, child, {url_filter.PARENT_LINKS:e} FROM ties) GROUP BY ALL),
directed AS (SELECT 'trust' AS kind, src, dst, links FROM edges UNION ALL SELECT 'distrust', dst, src, links FROM edges),
steps AS (SELECT kind, src, dst, {d} * links / sum(links) OVER (PARTITION BY kind, src) AS step FROM directed),
marks AS (SELECT 'trust' AS kind, host, trust AS n FROM hosts WHERE trust > 0 UNION ALL SELECT 'distrust', host, distrust FROM hosts WHERE distrust > 0),
start AS (SELECT kind, host, (1 - {d}) * n / sum(n) OVER (PARTITION BY kind) AS score FROM marks),
{', '.join(rounds)},
scores AS (SELECT host, coalesce(sum(score) FILTER (kind = 'trust'), 0) AS t, coalesce(sum(score) FILTER (kind = 'distrust'), 0) AS d FROM {last} GROUP BY host)
SELECT page_id, j.host, path, rule, coalesce(by_rule, CASE WHEN d > {url_filter.BLOCK_FROM:e} * (t + d) THEN 'block' ELSE 'allow' END) AS verdict FROM judged j LEFT JOIN scores s ON s.host = j.host"""


def repeats_sql() -> str:
    """All 100-byte windows as hexadecimal text; fit for small tables only."""
    n = LENGTH
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * n}) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - {n} + 1)) AS p FROM d)),
g AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY md5(s) ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
r AS (SELECT doc_id, min(p) AS a, max(p) + {n} AS z FROM (SELECT *, sum(CASE WHEN p <= before + {n} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT *, coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000000) AS before FROM g)) GROUP BY doc_id, run),
e AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) AS back FROM r),
k AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)) || CASE WHEN back = 1 THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY a) AS kept FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""


EXACT_SQL = """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n_chars, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size, row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


#: Unsigned crc32 of a decimal, bit by bit: each character is followed by seven zeros.
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [unicode(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"

TRIE_SQL = f"""
WITH t AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, own, conv_id - conv_id % 20 AS base, {CRC} % 4 AS head FROM (SELECT conv_id, max(pos) AS own FROM t GROUP BY conv_id)),
cs AS (SELECT c.*, least(head, coalesce(b.own, 0)) AS taken, taken + greatest(c.own - head, 0) AS len FROM c LEFT JOIN (SELECT conv_id AS b, own FROM c) b ON b.b = base),
s AS (SELECT t.conv_id, pos - head + taken AS d, role, text FROM t JOIN cs USING (conv_id) WHERE pos > head UNION ALL SELECT cs.conv_id, pos, role, text FROM cs JOIN t ON t.conv_id = base AND pos <= taken),
p AS (SELECT conv_id, d, list([role, text]) OVER (PARTITION BY conv_id ORDER BY d) AS key, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM s UNION ALL SELECT conv_id, 0, []::VARCHAR[][], 0 FROM cs),
n AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM p GROUP BY key, d),
children AS (SELECT key[1:d - 1] AS key, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN children USING (key)),
sub AS (SELECT key[1:a] AS key, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY 1),
ends AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM p JOIN cs USING (conv_id) WHERE d = len GROUP BY key)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM full_nodes v JOIN sub USING (key) LEFT JOIN ends USING (key) LEFT JOIN n u ON v.d > 0 AND u.key = v.key[1:v.d - 1]"""


def search_sql() -> str:
    terms = f"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{search.TERM}')"
    return f"""
WITH q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
held AS (SELECT doc_id, r, terms, len(terms) AS n FROM (SELECT doc_id, row_number() OVER () AS r, {terms} AS terms FROM documents) WHERE len(terms) > 0),
totals AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM held),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM held) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, totals GROUP BY term, nn),
scored AS (SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // l))))::BIGINT AS score FROM q JOIN p USING (term) JOIN weights USING (term) JOIN held USING (r), totals GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0) WHERE rank <= 10"""


ORACLE_SQL: dict[str, str] = {"op6_url_filter": url_sql(), "op8_suffix_dedup": repeats_sql(), "op10_mixing": mixing_sql(), "op11_exact_dedup": EXACT_SQL, "op12_conversation_trie": TRIE_SQL, "op13_ranked_search": search_sql()}
