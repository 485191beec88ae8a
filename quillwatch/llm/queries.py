"""The registered queries of this subpackage: each operator over its whole table, in the columns agreed for it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwatch.llm import (
    audit, byte_pairs, chat, decontaminate, exact, kneser_ney, lines, mixing, prefix_trie, pseudo_likelihood, simhash, substrings, urls,
)
from quillwatch.llm.tables import table

# The rules of the URL query, as (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# The conversation that the chat query adds.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.train_and_score(table(spark, folder, "documents").select("doc_id", "text"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.mark_copies(table(spark, folder, "documents"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    store = lines.insert(None, docs)
    cleaned = lines.clean(store, docs, postings=store.postings)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.union(spark.createDataFrame(CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_turns(rows))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(table(spark, folder, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"))


def op13_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    coder = byte_pairs.Coder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_pairs.round_trip(table(spark, folder, "documents").select("doc_id", "text"), coder).drop("text")


QUERIES = {
    f.__name__: f
    for f in (
        op1_pseudo_likelihood, op2_decontamination, op3_exact_dedup, op4_line_dedup, op5_mixing, op6_chat_format,
        op7_simhash, op8_substring_dedup, op9_url_filter, op10_quality, op11_filter_audit, op12_prefix_trie,
        op13_byte_pairs,
    )
}

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_decontamination": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), grams AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
        ), places AS (
            SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d WHERE len(w) > 0
        ), hits AS (
            SELECT DISTINCT p.doc_id, p.i, g.k, g.item_id
            FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
                  FROM places, (SELECT DISTINCT k FROM grams) WHERE i + k - 1 <= len(w)) p
            JOIN grams g USING (k, g)
        ), words AS (
            SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
               sha256(coalesce(items.list, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op3_exact_dedup": f"""
        WITH t AS (SELECT doc_id, sha256({_FOLD.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM t WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op4_line_dedup": rf"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
            FROM documents
        ), k AS (
            SELECT *, {_FOLD.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM l
        ), r AS (
            SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
        )
        SELECT k.doc_id, count(*) AS n_lines, count(r.key) FILTER (r.first_doc <> k.doc_id) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.key IS NULL OR r.first_doc = k.doc_id), '')) AS kept_sha256
        FROM k LEFT JOIN r USING (key) GROUP BY k.doc_id
    """,
    "op6_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        ), f AS (
            SELECT *, '([<\[])(\\*)(INST\]|/INST\]|s>|/s>|<SYS>>|</SYS>>|\|role\|>|\|text\|>|\|/text\|>)' AS controls FROM t
        ), n AS (
            SELECT *, length(regexp_replace(text, controls, '\1\\\2\3', 'g')) + CASE role
                WHEN 'user' THEN 7 + 9 WHEN 'assistant' THEN 4 + 6 WHEN 'system' THEN 8 + 10
                ELSE 9 + length(regexp_replace(role, controls, '\1\\\2\3', 'g')) + 10 + 11 END AS chars
            FROM f
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM n GROUP BY conv_id
    """,
    "op8_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), v AS (
            SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)
        ), later AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM v) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
        ), words AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
        ), kept AS (
            SELECT doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text
            FROM words LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op9_url_filter": f"""
        WITH p AS (
            SELECT page_id, {_FOLD.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1)")} AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages
        ), r(rule_host, rule_path, verdict) AS (
            VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        ), best AS (
            SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   arg_max(verdict, length(rule_host || rule_path)) AS verdict
            FROM (SELECT DISTINCT host, path FROM p) JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY host, path
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (host, path)
    """,
    "op11_filter_audit": r"""
        WITH t AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), least_ids AS (
            SELECT text, min(doc_id) AS first_id FROM t GROUP BY text
        ), known AS (
            SELECT doc_id, max(coalesce(quality, 0) = 1) AS good, max(coalesce(toxic, 0) = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
        ), fails AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, map {
                'A': len(w) < 200,
                'B': 100 * len(list_distinct(w)) < 50 * len(w),
                'C': 100 * len(regexp_extract_all(t.text, '[A-Z]')) > 3 * length(t.text),
                'D': regexp_matches(t.text, '[#$%&*|]'),
                'E': coalesce(t.doc_id > first_id, false)} AS f
            FROM t JOIN least_ids USING (text) LEFT JOIN known USING (doc_id)
        ), counts AS (
            SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM fails GROUP BY part, f
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
        ), orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
        ), steps AS (
            SELECT filter_order, step::INTEGER AS step, filter_order[step] AS x, string_split(filter_order[1:step - 1], '') AS before
            FROM orders, (SELECT unnest(range(1, 6)) AS step)
        ), seen AS (
            SELECT part, filter_order, step, x, n, good, toxic, f[x] AS hit,
                   len(list_filter(before, lambda l: l <> '' AND f[l])) > 0 AS gone,
                   len(list_filter(map_values(f), lambda v: v)) = 1 AS alone
            FROM counts, steps
        ), found AS (
            SELECT part, filter_order, step, x,
                   coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (hit AND alone), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
            FROM seen GROUP BY part, filter_order, step, x
        )
        SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM found
    """,
    "op12_prefix_trie": """
        WITH own AS (
            SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS turns
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
            GROUP BY conv_id
        ), crc AS (
            SELECT conv_id, xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                              lambda x, bit: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 6 AS h
            FROM own
        ), paths AS (
            SELECT o.conv_id, list_concat(coalesce(b.turns[1:h], []), o.turns[h + 1:]) AS path
            FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
        ), members AS (
            SELECT conv_id, path[1:depth] AS node, depth, len(path) = depth AS ends
            FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM paths)
        ), nodes AS (
            SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM members GROUP BY node, depth
        ), children AS (
            SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
        ), counted AS (
            SELECT nodes.*, coalesce(children.n, 0) AS n_children,
                   CASE WHEN nodes.depth = 0 THEN 0 ELSE (n_convs - 1) * length(nodes.node[nodes.depth].text) END AS saved
            FROM nodes LEFT JOIN children ON children.node = nodes.node AND children.depth = nodes.depth
        ), subtrees AS (
            SELECT node[1:top] AS node, top AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM counted) GROUP BY ALL
        )
        SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
        FROM counted c JOIN subtrees s ON s.node = c.node AND s.depth = c.depth
             LEFT JOIN nodes p ON p.node = c.node[1:c.depth - 1] AND p.depth = c.depth - 1
    """,
}
