"""The same results in plain SQL, written from the definitions rather than from the Spark
plans: naive self joins, whole-table windows, correlated counts."""

from __future__ import annotations

from quillwatch.plans.queries import PRESENT_TARGET, SHORT_CAP, SHORT_PAGE, TIMELINE_TARGET

ORACLES: dict[str, str] = {}


def graph_ctes(k: int) -> str:
    return f"""
topk AS (SELECT "user" FROM named GROUP BY 1 ORDER BY count(*) DESC, "user" LIMIT {k}),
kept AS (SELECT n.* FROM named n WHERE "user" IN (SELECT "user" FROM topk)),
pairs AS (
  SELECT x.article_title AS article, x."user" AS editor_a, y."user" AS editor_b, count(*)::BIGINT AS n_pairs
  FROM kept x JOIN kept y ON x.article_title = y.article_title AND x."user" < y."user"
   AND abs(floor(epoch(x.edit_timestamp))::BIGINT - floor(epoch(y.edit_timestamp))::BIGINT) <= 86400
  GROUP BY 1, 2, 3),
edges AS (
  SELECT editor_a, editor_b, sum(n_pairs)::BIGINT AS co_edit_count, count(DISTINCT article) AS shared_articles
  FROM pairs GROUP BY 1, 2),
adj AS (
  SELECT editor_a AS editor, editor_b AS neighbor, co_edit_count AS weight FROM edges
  UNION ALL SELECT editor_b, editor_a, co_edit_count FROM edges),
degrees AS (SELECT editor, count(DISTINCT neighbor) AS degree, sum(weight)::BIGINT AS total_co_edits FROM adj GROUP BY 1),
common AS (
  SELECT e.editor_a, e.editor_b, count(y.neighbor) AS common_neighbors
  FROM edges e JOIN adj x ON x.editor = e.editor_a
  LEFT JOIN adj y ON y.editor = e.editor_b AND y.neighbor = x.neighbor
  GROUP BY 1, 2),
corner AS (
  SELECT editor, sum(common_neighbors)::BIGINT AS triangle_sum
  FROM (SELECT editor_a AS editor, common_neighbors FROM common UNION ALL SELECT editor_b, common_neighbors FROM common)
  GROUP BY 1),
net AS (
  SELECT editor, degree, total_co_edits, coalesce(triangle_sum, 0)::BIGINT AS triangle_sum,
         CASE WHEN degree > 1 THEN coalesce(triangle_sum, 0) / (degree * (degree - 1))::DOUBLE ELSE 0.0 END AS clustering
  FROM degrees LEFT JOIN corner USING (editor)),
top_e AS (SELECT * FROM edges ORDER BY co_edit_count DESC, editor_a, editor_b LIMIT 200),
top_adj AS (SELECT editor_a AS editor FROM top_e UNION ALL SELECT editor_b FROM top_e),
top_deg AS (SELECT editor, count(*) AS degree FROM top_adj GROUP BY 1),
collections AS (
  SELECT 'article_edit_metrics' AS name, count(*) AS "rows" FROM features
  UNION ALL SELECT 'editor_network_metrics', count(*) FROM net
  UNION ALL SELECT 'stability_predictions', count(*) FROM predicted
  UNION ALL SELECT 'topic_comparison', count(DISTINCT topic_category) FROM known)
"""


BASE = """
rev AS (
  SELECT 'A' || json_extract_string(props, '$.k') AS article_title, event_id AS revid,
         'U' || user_id::VARCHAR AS "user", user_id AS userid, ts AS edit_timestamp,
         round(value * 100)::BIGINT AS content_length, event_type = 'error' AS is_revert
  FROM events),
raw_rev AS (
  SELECT event_id AS revid, event_id - 1 AS parentid, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
         'U' || user_id::VARCHAR AS "user", user_id AS userid,
         CASE event_type WHEN 'error' THEN 'Undid revision ' || event_id::VARCHAR WHEN 'view' THEN 'conserv fix'
                         WHEN 'click' THEN '' WHEN 'purchase' THEN 'copy edit' END AS comment,
         round(value * 100)::BIGINT AS size, 'A' || json_extract_string(props, '$.k') AS article_title,
         json_extract_string(props, '$.k')::BIGINT AS pageid
  FROM events),
views AS (
  SELECT 'A' || json_extract_string(props, '$.k') AS article_title, ts::DATE AS view_date, count(*) AS views
  FROM events WHERE event_type = 'view' GROUP BY 1, 2),
raw_views AS (
  SELECT 'en.project' AS project, article_title AS article, 'daily' AS granularity,
         strftime(view_date, '%Y%m%d') || '00' AS "timestamp", 'all-access' AS access, 'all-agents' AS agent,
         views, article_title
  FROM views),
topic_of AS (
  SELECT 'A' || p_partkey::VARCHAR AS article_title,
         CASE WHEN p_type IN ('ECONOMY', 'LARGE') THEN 'political' WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'scientific'
              WHEN p_type = 'SMALL' THEN 'cultural' END AS topic_category
  FROM part WHERE p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL')),
ent AS (
  SELECT 'A' || p_partkey::VARCHAR AS article_title, 'Q' || p_partkey::VARCHAR AS qid, p_name AS label,
         p_brand AS description, p_size::INTEGER AS claims_count, length(p_name)::INTEGER AS sitelinks_count,
         coalesce(t.topic_category, 'unknown') AS topic_category
  FROM part LEFT JOIN topic_of t ON t.article_title = 'A' || p_partkey::VARCHAR),
delta AS (
  SELECT *, lag(content_length) OVER w AS prev_length,
         content_length - coalesce(lag(content_length) OVER w, 0) AS length_change,
         floor(epoch(edit_timestamp))::BIGINT - floor(epoch(lag(edit_timestamp) OVER w))::BIGINT AS gap
  FROM rev WINDOW w AS (PARTITION BY article_title ORDER BY edit_timestamp, revid)),
totals AS (
  SELECT article_title, count(revid) AS total_edits, count(DISTINCT "user") AS unique_editors,
         count(*) FILTER (WHERE is_revert) AS revert_count, avg(abs(length_change)) AS avg_content_change,
         min(edit_timestamp) AS first_edit, max(edit_timestamp) AS last_edit,
         (datediff('day', min(edit_timestamp), max(edit_timestamp)) + 1)::INTEGER AS active_days
  FROM delta GROUP BY 1),
metrics AS (
  SELECT *, total_edits / greatest(active_days, 1)::DOUBLE AS edit_velocity,
         revert_count / greatest(total_edits, 1)::DOUBLE AS reversion_rate,
         CASE WHEN unique_editors > 1
              THEN least(log2(unique_editors) / CASE WHEN total_edits > 1 THEN log2(total_edits) ELSE 1.0 END, 1.0)
              ELSE 0.0 END AS editor_diversity
  FROM totals),
traffic AS (
  SELECT article_title, avg(views) AS avg_daily_views, max(views) AS peak_daily_views,
         stddev_samp(views) AS views_stddev, sum(views)::BIGINT AS total_views,
         max(views) / greatest(avg(views), 1)::DOUBLE AS pageview_spike_ratio
  FROM views GROUP BY 1),
joined AS (
  SELECT m.*, e.topic_category, e.claims_count, e.sitelinks_count, t.avg_daily_views, t.peak_daily_views,
         t.views_stddev, t.total_views, t.pageview_spike_ratio
  FROM metrics m LEFT JOIN ent e USING (article_title) LEFT JOIN traffic t USING (article_title)),
features AS (
  SELECT * REPLACE (
         coalesce(topic_category, 'unknown') AS topic_category, coalesce(claims_count, 0) AS claims_count,
         coalesce(sitelinks_count, 0) AS sitelinks_count, coalesce(avg_daily_views, 0) AS avg_daily_views,
         coalesce(peak_daily_views, 0) AS peak_daily_views, coalesce(views_stddev, 0) AS views_stddev,
         coalesce(total_views, 0) AS total_views, coalesce(pageview_spike_ratio, 1.0) AS pageview_spike_ratio)
  FROM joined),
labelled AS (SELECT *, CASE WHEN reversion_rate > 0.15 THEN 1.0::DOUBLE ELSE 0.0 END AS stability_label FROM features),
known AS (SELECT * FROM features WHERE topic_category IN ('political', 'scientific', 'cultural')),
named AS (SELECT article_title, "user", edit_timestamp FROM rev WHERE userid > 0 AND NOT regexp_matches("user", '(?i)bot')),
weekly AS (
  SELECT article_title, date_trunc('week', edit_timestamp)::DATE AS week_start, count(revid) AS weekly_edits,
         count(*) FILTER (WHERE is_revert) AS weekly_reverts, count(DISTINCT "user") AS weekly_editors,
         count(*) FILTER (WHERE is_revert) / count(revid)::DOUBLE AS weekly_reversion_rate
  FROM rev GROUP BY 1, 2),
wars AS (SELECT * FROM weekly WHERE weekly_reversion_rate > 0.3 AND weekly_edits >= 10),
scored AS (
  SELECT event_id, (event_id * 7919) % 1000 / 1000.0::DOUBLE AS score,
         CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0 END AS stability_label,
         CASE WHEN (event_id * 7919) % 1000 >= 500 THEN 1.0::DOUBLE ELSE 0.0 END AS prediction
  FROM events),
held_out AS (
  SELECT * FROM labelled WHERE ('0x' || substr(md5(article_title), 1, 8))::BIGINT % 100 >= 80),
predicted AS (
  SELECT m.model, article_title, stability_label,
         ('0x' || substr(md5(article_title || m.model), 1, 8))::BIGINT % 100 / 100.0::DOUBLE AS p
  FROM held_out, (VALUES ('first'), ('second')) m(model)),
outputs AS (
  SELECT 'revisions_clean' AS name, count(*) AS "rows" FROM rev
  UNION ALL SELECT 'entities_clean', count(*) FROM ent
  UNION ALL SELECT 'pageviews_clean', count(*) FROM views
  UNION ALL SELECT 'article_features', count(*) FROM features
  UNION ALL SELECT 'weekly_edit_stats', count(*) FROM weekly
  UNION ALL SELECT 'edit_wars', count(*) FROM wars),
field_checks AS (
  SELECT 'required_field:revid' AS "check", count(*) FILTER (WHERE revid IS NULL) AS observed FROM raw_rev
  UNION ALL SELECT 'required_field:comment', count(*) FILTER (WHERE comment IS NULL) FROM raw_rev)
"""

METRIC_COLUMNS = """article_title, total_edits, unique_editors, revert_count, round(avg_content_change, 6) AS avg_content_change,
  first_edit, last_edit, active_days, round(edit_velocity, 6) AS edit_velocity, round(reversion_rate, 6) AS reversion_rate,
  round(editor_diversity, 6) AS editor_diversity"""
TRAFFIC_COLUMNS = """round(avg_daily_views, 6) AS avg_daily_views, peak_daily_views, round(views_stddev, 6) AS views_stddev,
  total_views, round(pageview_spike_ratio, 6) AS pageview_spike_ratio"""
FEATURE_COLUMNS = f"{METRIC_COLUMNS}, topic_category, claims_count, sitelinks_count, {TRAFFIC_COLUMNS}"
WEEK_COLUMNS = """article_title, week_start, weekly_edits, weekly_reverts, weekly_editors,
  round(weekly_reversion_rate, 6) AS weekly_reversion_rate"""
VECTOR = (
    "edit_velocity", "unique_editors", "editor_diversity", "avg_content_change", "avg_daily_views",
    "pageview_spike_ratio", "claims_count", "sitelinks_count", "total_edits", "topic_index",
)


def oracle(name: str, body: str, k: int = 200) -> None:
    ORACLES[name] = f"WITH {BASE}, {graph_ctes(k)} {body}"


oracle("scan_revisions", "SELECT * FROM raw_rev")
oracle("scan_entities", """
  SELECT 'Q' || p_partkey::VARCHAR AS qid, 'A' || p_partkey::VARCHAR AS article_title, p_name AS label,
         p_brand AS description, p_size::INTEGER AS claims_count, length(p_name)::INTEGER AS sitelinks_count,
         'Q' || p_size::VARCHAR AS instance_of, p_type AS part_of
  FROM part""")
oracle("scan_pageviews", "SELECT * FROM raw_views")
oracle("scan_parquet", "SELECT event_id, user_id, event_type FROM events")
oracle("dim_topics", "SELECT * FROM topic_of")
oracle("flatten_revision_api", "SELECT * FROM raw_rev")
PAGES = f"""WITH RECURSIVE {BASE},
numbered AS (SELECT *, row_number() OVER (PARTITION BY article_title ORDER BY revid) - 1 AS rn FROM raw_rev),
paged AS (
  SELECT *, lead(first) OVER (PARTITION BY article_title ORDER BY first) AS next
  FROM (SELECT article_title, rn // (1 + pageid % 7) AS page, min(revid) AS first, min_by("timestamp", revid) AS first_time, count(*) AS n
        FROM numbered GROUP BY 1, 2, pageid)),
circled AS (SELECT DISTINCT article_title, 1000000000000 + 2 * pageid AS x FROM raw_rev WHERE pageid % 10 = 3),
stored AS (
  SELECT article_title, first, first_time, n, next, CASE WHEN first % 5 = 1 THEN 2 ELSE 1 END AS replies FROM paged WHERE first % 13 <> 4
  UNION ALL SELECT article_title, x, NULL, 1, x + 1, 1 FROM circled
  UNION ALL SELECT article_title, x + 1, NULL, 1, x, 1 FROM circled),
heads AS (SELECT * FROM stored s WHERE NOT EXISTS (FROM stored t WHERE t.article_title = s.article_title AND t.next = s.first)),
walk AS (
  SELECT *, first AS head, 0::BIGINT AS page_no FROM heads
  UNION ALL
  SELECT s.*, w.head, w.page_no + 1 FROM walk w JOIN stored s ON s.article_title = w.article_title AND s.first = w.next),
oldest AS (SELECT article_title, arg_min(first, (first_time, first)) AS head FROM heads GROUP BY 1),
kept AS (SELECT w.* FROM walk w JOIN oldest USING (article_title, head))
"""
ORACLES["flatten_paged_revisions"] = f"""{PAGES}
  SELECT r.revid, r.parentid, r."timestamp", r.size, article_title, r.pageid, k.page_no
  FROM kept k JOIN paged p USING (article_title, first) JOIN numbered r USING (article_title)
  WHERE r.rn // (1 + r.pageid % 7) = p.page"""
ORACLES["paging_report"] = f"""{PAGES}
  SELECT article_title, count(k.first) AS pages, coalesce(sum(k.n), 0)::BIGINT AS revisions, sum(s.replies - 1)::BIGINT AS doubled,
         count(*) FILTER (k.first IS NULL AND w.first IS NOT NULL) AS after_gap, count(*) FILTER (w.first IS NULL) AS looped,
         arg_max(s.next, k.page_no) FILTER (k.first IS NOT NULL AND s.next IS NOT NULL AND NOT EXISTS (
             FROM stored t WHERE t.article_title = s.article_title AND t.first = s.next)) AS missing_revid,
         missing_revid IS NULL AND after_gap = 0 AND looped = 0 AS complete
  FROM stored s LEFT JOIN walk w USING (article_title, first) LEFT JOIN kept k USING (article_title, first)
  GROUP BY article_title"""
oracle("flatten_entity_api", """
  SELECT 'Q' || p_partkey::VARCHAR AS qid, 'A' || p_partkey::VARCHAR AS article_title,
         CASE WHEN p_type = 'SMALL' THEN 'A' || p_partkey::VARCHAR ELSE p_name END AS label,
         CASE WHEN p_type = 'SMALL' THEN '' ELSE p_brand END AS description,
         (1 + p_size % 2)::INTEGER AS claims_count, p_size::INTEGER AS sitelinks_count
  FROM part WHERE p_type <> 'STANDARD'""")
oracle("extract_claims", """
  SELECT 'A' || p_partkey::VARCHAR AS article_title, 'P31' AS property, 'Q' || p_size::VARCHAR AS ids
  FROM part WHERE p_type <> 'STANDARD'
  UNION ALL
  SELECT 'A' || p_partkey::VARCHAR, 'P361', CASE WHEN p_size % 2 = 1 THEN 'Q' || p_size::VARCHAR ELSE '' END
  FROM part WHERE p_type <> 'STANDARD'""")
oracle("flatten_pageview_api", "SELECT * FROM raw_views")
for name, cap in (("cap_revisions", 5000), ("cap_revisions_short", SHORT_CAP)):
    oracle(name, f"""
  SELECT article_title, revid, edit_timestamp FROM rev
  QUALIFY row_number() OVER (PARTITION BY article_title ORDER BY edit_timestamp, revid) <= {cap}""")
oracle("incremental_new_keys", """
  SELECT DISTINCT article_title FROM ent WHERE article_title NOT IN (SELECT article_title FROM rev)""")
oracle("manifest_changes", """
  SELECT article_title AS path,
         CASE WHEN pageid % 4 = 0 THEN 'new' WHEN pageid % 5 = 0 THEN 'gone' WHEN pageid % 3 = 0 THEN 'changed' ELSE 'same' END AS change,
         (sum(length(revid::VARCHAR) + 1) * CASE WHEN pageid % 5 <> 0 AND pageid % 3 = 0 THEN 2 ELSE 1 END)::BIGINT AS length
  FROM raw_rev WHERE pageid % 4 <> 0 OR pageid % 5 <> 0 GROUP BY article_title, pageid""")
oracle("ingest_counts", """
  SELECT '100% ' || article_title || ': why?' AS safe_title, count(*) AS records, count(revid) AS keyed_records,
         0::BIGINT AS unreadable FROM rev GROUP BY 1""")
oracle("file_manifest", """
  SELECT 'titles' AS dataset, sum(octet_length(article_title::BLOB) + 1)::BIGINT AS bytes, true AS files_named FROM rev""")
oracle("scan_xml_dump", "SELECT * FROM raw_rev")

oracle("sink_parquet", f"SELECT {FEATURE_COLUMNS} FROM features")
oracle("sink_partitioned_raw", "SELECT article_title AS safe_title, article_title, revid FROM rev")
oracle("publish_documents", """
  SELECT name AS collection, "rows" AS documents FROM collections UNION ALL SELECT 'not_computed', 0""")
oracle("document_store", """
  SELECT article_title, total_edits, topic_category, (SELECT count(*) FROM features) AS documents FROM features""")
oracle("predictions_union", """
  SELECT model, article_title, stability_label, CASE WHEN p >= 0.5 THEN 1.0::DOUBLE ELSE 0.0 END AS prediction,
         round(1 - p, 6) AS p_stable, round(p, 6) AS p_unstable
  FROM predicted""")

oracle("clean_revisions", """
  SELECT article_title, pageid, revid, parentid, date_trunc('second', edit_timestamp) AS edit_timestamp, r."user", r.userid,
         comment, size AS content_length,
         coalesce(regexp_matches(comment, '(?i)(revert|reverted|rv |undid|undo|rollback|restored|reverting|undone)'), false) AS is_revert
  FROM raw_rev r JOIN (SELECT event_id AS revid, ts AS edit_timestamp FROM events) USING (revid)""")
oracle("revert_flag", """
  SELECT doc_id, coalesce(regexp_matches(text, '(?i)(revert|reverted|rv |undid|undo|rollback|restored|reverting|undone)'), false) AS is_revert
  FROM documents""")
oracle("clean_pageviews", "SELECT article_title, view_date, views FROM views")
oracle("clean_entities", "SELECT * FROM ent")
oracle("filter_named_humans", "SELECT * FROM named")
oracle("filter_edit_war", f"SELECT {WEEK_COLUMNS} FROM wars")
oracle("filter_known_topics", "SELECT article_title, topic_category FROM known")
oracle("stability_label", "SELECT article_title, round(reversion_rate, 6) AS reversion_rate, stability_label FROM labelled")
oracle("stability_label_median", """
  SELECT article_title, round(reversion_rate, 6) AS reversion_rate,
         CASE WHEN reversion_rate > (SELECT median(reversion_rate) FROM metrics) THEN 1.0::DOUBLE ELSE 0.0 END AS stability_label
  FROM metrics""")
oracle("stability_score", """
  SELECT article_title, topic_category, round(editor_diversity, 6) AS editor_diversity,
         round(1.0 - reversion_rate, 6) AS stability_score
  FROM known""")
oracle("fill_defaults", f"""
  SELECT article_title, topic_category, claims_count, sitelinks_count, {TRAFFIC_COLUMNS} FROM features""")
oracle("title_display", """
  SELECT article_title || '_' || label AS article_title, article_title || ' ' || label AS display_title,
         upper(topic_category[1]) || topic_category[2:] AS topic_label
  FROM ent""")
oracle("safe_title", r"SELECT page_id, replace(replace(url, '/', '_'), '\', '_') AS safe_title FROM pages")
oracle("article_timeline", f"""
  SELECT {WEEK_COLUMNS}, 0.3::DOUBLE AS war_threshold FROM weekly
  WHERE article_title = (
    SELECT article_title FROM weekly GROUP BY 1
    ORDER BY article_title = '{TIMELINE_TARGET}' DESC, count(*) DESC, article_title LIMIT 1)""")

oracle("article_timeline_of", f"""
  SELECT {WEEK_COLUMNS}, 0.3::DOUBLE AS war_threshold FROM weekly WHERE article_title = '{PRESENT_TARGET}'""")

oracle("join_features", f"SELECT {FEATURE_COLUMNS} FROM joined")
oracle("assign_topic", """
  SELECT article_title, revid, coalesce(topic_category, 'unknown') AS topic_category
  FROM rev LEFT JOIN topic_of USING (article_title)""")
oracle("topk_editor_filter", 'SELECT article_title, "user", edit_timestamp FROM kept')
oracle("coedit_pairs", "SELECT * FROM pairs")
oracle("edge_neighbour_join", """
  , lists AS (SELECT editor, string_agg(neighbor, ',' ORDER BY neighbor) AS neighbors FROM adj GROUP BY 1)
  SELECT editor_a, editor_b, x.neighbors AS neighbors_a, y.neighbors AS neighbors_b
  FROM edges JOIN lists x ON x.editor = editor_a JOIN lists y ON y.editor = editor_b""")
oracle("degree_triangle_join", "SELECT editor, degree, total_co_edits, triangle_sum FROM net")
oracle("edit_wars_topic", f"""
  SELECT {WEEK_COLUMNS}, topic_category
  FROM wars LEFT JOIN (SELECT DISTINCT article_title, topic_category FROM features) USING (article_title)""")
oracle("topic_lookup", "SELECT DISTINCT article_title, topic_category FROM features")

oracle("article_metrics", f"SELECT {METRIC_COLUMNS} FROM metrics")
oracle("editor_diversity", """
  SELECT article_title, unique_editors, total_edits, round(editor_diversity, 6) AS editor_diversity FROM metrics""")
oracle("length_change", "SELECT article_title, revid, prev_length, length_change FROM delta")
oracle("pageview_features", f"SELECT article_title, {TRAFFIC_COLUMNS} FROM traffic")
oracle("editor_activity", 'SELECT "user", count(*) AS edits FROM named GROUP BY 1')
oracle("top_editors", f"""
  SELECT "user", count(*) AS edits FROM named GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 200""")
oracle("coediting_edges", "SELECT * FROM edges")
oracle("coedit_graph", "SELECT * FROM edges")
oracle("top_edges", "SELECT * FROM top_e")
oracle("symmetric_adjacency", "SELECT * FROM adj")
oracle("editor_degree", "SELECT * FROM degrees")
oracle("neighbour_lists", "SELECT editor, string_agg(neighbor, ',' ORDER BY neighbor) AS neighbors FROM adj GROUP BY 1")
_PAGES = f""", placed AS (
    SELECT editor, neighbor, (row_number() OVER (PARTITION BY editor ORDER BY neighbor) - 1) // {SHORT_PAGE} AS page
    FROM (SELECT DISTINCT editor, neighbor FROM adj)),
  pages AS (SELECT editor, page, string_agg(neighbor, ',' ORDER BY neighbor) AS neighbors, count(*)::INTEGER AS names FROM placed GROUP BY 1, 2)"""
oracle("neighbour_pages", f"{_PAGES} SELECT * FROM pages")
oracle("edge_neighbour_pages", f"""{_PAGES}
  SELECT editor_a, editor_b, e.page, coalesce(x.neighbors, '') AS neighbors_a, coalesce(y.neighbors, '') AS neighbors_b
  FROM (SELECT DISTINCT editor_a, editor_b, page FROM edges JOIN pages ON editor IN (editor_a, editor_b)) e
  LEFT JOIN pages x ON x.editor = editor_a AND x.page = e.page LEFT JOIN pages y ON y.editor = editor_b AND y.page = e.page""")
oracle("common_neighbours", "SELECT * FROM common")
oracle("editor_triangles", "SELECT * FROM corner")
oracle("clustering_coefficient", "SELECT editor, round(clustering, 6) AS clustering_coefficient FROM net")
oracle("network_metrics", """
  SELECT editor, degree, total_co_edits, triangle_sum, round(clustering, 6) AS clustering_coefficient FROM net""")
oracle("graph_summary", """
  SELECT (SELECT count(*) FROM top_deg) AS nodes, count(*) AS edges, max(co_edit_count) AS max_weight FROM top_e""")
oracle("top_degree_labels", """
  SELECT editor, degree FROM top_deg
  WHERE degree >= CASE WHEN (SELECT count(*) FROM top_deg) > 10
                       THEN (SELECT min(degree) FROM (SELECT degree FROM top_deg ORDER BY degree DESC LIMIT 10)) ELSE 0 END""")
oracle("weekly_edit_stats", f"SELECT {WEEK_COLUMNS} FROM weekly")
oracle("weeks_per_article", "SELECT article_title, count(*) AS weeks FROM weekly GROUP BY 1")
oracle("topic_comparison", """
  SELECT topic_category, round(avg(reversion_rate), 6) AS avg_reversion_rate, round(avg(edit_velocity), 6) AS avg_edit_velocity,
         round(avg(unique_editors), 6) AS avg_unique_editors, round(avg(editor_diversity), 6) AS avg_editor_diversity,
         round(avg(total_edits), 6) AS avg_total_edits, round(avg(avg_daily_views), 6) AS avg_daily_views,
         round(avg(pageview_spike_ratio), 6) AS avg_spike_ratio, count(*) AS article_count
  FROM known GROUP BY 1 ORDER BY 1""")
oracle("topic_chart_stats", """
  SELECT o.display_order::INTEGER AS display_order, o.topic_category, round(avg(reversion_rate), 6) AS avg_reversion_rate,
         round(avg(edit_velocity), 6) AS avg_edit_velocity, round(avg(unique_editors), 6) AS avg_unique_editors
  FROM (VALUES (0, 'political'), (1, 'scientific'), (2, 'cultural')) o(display_order, topic_category)
  LEFT JOIN known USING (topic_category) GROUP BY 1, 2 ORDER BY 1""")
oracle("anon_editor_pct", """
  SELECT article_title, round(avg(CASE WHEN userid = 0 THEN 1.0 ELSE 0.0 END), 6) AS anon_editor_pct FROM rev GROUP BY 1""")
oracle("time_between_revisions", """
  SELECT article_title, round(median(gap), 6) AS median_gap_seconds FROM delta GROUP BY 1""")

oracle("label_distribution", """
  SELECT count(*) FILTER (WHERE stability_label = 0) AS stable, count(*) FILTER (WHERE stability_label = 1) AS unstable,
         0.15::DOUBLE AS threshold FROM labelled""")
oracle("topic_index", """
  SELECT article_title, topic_category, topic_index
  FROM ent JOIN (SELECT topic_category, (row_number() OVER (ORDER BY count(*) DESC, topic_category) - 1)::DOUBLE AS topic_index
                 FROM ent GROUP BY 1) USING (topic_category)""")
oracle("feature_vector", """
  , indexed AS (
    SELECT l.*, topic_index FROM labelled l
    JOIN (SELECT topic_category, (row_number() OVER (ORDER BY count(*) DESC, topic_category) - 1)::DOUBLE AS topic_index
          FROM labelled GROUP BY 1) USING (topic_category))
""" + " UNION ALL ".join(
    f'SELECT article_title, stability_label, {i}::INTEGER AS position, round({c}::DOUBLE, 6) AS "value" FROM indexed'
    for i, c in enumerate(VECTOR)
))
oracle("train_test_split", """
  SELECT article_title, CASE WHEN ('0x' || substr(md5(article_title), 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS part
  FROM ent""")
for model in ("rf_classifier", "lr_classifier"):
    oracle(model, """
  SELECT article_title, stability_label, true AS predicts_the_likelier, true AS adds_up FROM predicted WHERE model = 'first'""")
oracle("feature_importance", f"""
  SELECT i::INTEGER AS rank, true AS not_negative, true AS in_order, true AS adds_up, true AS one_feature
  FROM range(1, {len(VECTOR) + 1}) r(i)""")
oracle("forest_replay", """
  SELECT article_title, stability_label, true AS same_probability, true AS same_prediction FROM predicted WHERE model = 'first'""")
oracle("forest_importance", f"""
  SELECT feature, true AS same_importance FROM (VALUES {", ".join(f"('{v}')" for v in VECTOR)}) v(feature)""")
oracle("regression_optimality", f"""
  SELECT place::INTEGER AS place, feature, true AS at_minimum
  FROM (VALUES {", ".join(f"({i}, '{v}')" for i, v in enumerate((*VECTOR, "intercept")))}) v(place, feature)""")
oracle("model_metrics", f"""
  SELECT model, true AS accuracy_agrees, true AS f1_agrees, true AS auc_agrees, {len(VECTOR)}::INTEGER AS ranked
  FROM (VALUES ('random_forest'), ('logistic_regression')) m(model)""")
oracle("probability_list", """
  SELECT article_title, 0::INTEGER AS "class", round(1 - p, 6) AS probability FROM predicted WHERE model = 'first'
  UNION ALL SELECT article_title, 1, round(p, 6) FROM predicted WHERE model = 'first'""")
oracle("evaluate_auc", """
  SELECT round((sum(r) FILTER (WHERE stability_label = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc
  FROM (SELECT stability_label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r,
               count(*) FILTER (WHERE stability_label = 1) OVER ()::DOUBLE AS p,
               count(*) FILTER (WHERE stability_label = 0) OVER ()::DOUBLE AS n
        FROM scored)
  GROUP BY p, n""")
oracle("evaluate_accuracy_f1", """
  , cells AS (
    SELECT c, count(*) FILTER (WHERE stability_label = c) AS support,
           count(*) FILTER (WHERE stability_label = c AND prediction = c) AS tp,
           count(*) FILTER (WHERE prediction = c) AS said, count(*) AS n
    FROM scored, (VALUES (0.0), (1.0)) v(c) GROUP BY 1)
  SELECT round(sum(tp) / max(n)::DOUBLE, 6) AS accuracy, round(sum(support * 2.0 * tp / (support + said)) / max(n), 6) AS f1 FROM cells""")
oracle("confusion_matrix", """
  SELECT stability_label, prediction, count(*) AS "count" FROM scored GROUP BY 1, 2 ORDER BY 1, 2""")
oracle("roc_points", """
  SELECT round(t.score, 6) AS threshold,
         round(count(*) FILTER (WHERE stability_label = 0) / max(n)::DOUBLE, 6) AS fpr,
         round(count(*) FILTER (WHERE stability_label = 1) / max(p)::DOUBLE, 6) AS tpr
  FROM (SELECT DISTINCT score FROM scored) t JOIN scored s ON s.score >= t.score,
       (SELECT count(*) FILTER (WHERE stability_label = 1) AS p, count(*) FILTER (WHERE stability_label = 0) AS n FROM scored)
  GROUP BY t.score""")

oracle("collection_counts", """
  SELECT * FROM outputs UNION ALL SELECT 'total', sum("rows")::BIGINT FROM outputs""")
oracle("dq_min_files", """
  SELECT 'min_files:revisions' AS "check", 12::BIGINT AS observed, 10::BIGINT AS expected, true AS passed
  UNION ALL SELECT 'min_files:entities', 3, 10, false
  UNION ALL SELECT 'min_files:none', 0, 10, false""")
oracle("dq_required_field", 'SELECT "check", observed, 0::BIGINT AS expected, observed = 0 AS passed FROM field_checks')
oracle("dq_outputs_present", """
  SELECT 'output:' || name AS "check", "rows" AS observed, 1::BIGINT AS expected, "rows" >= 1 AS passed FROM outputs""")
oracle("dq_collection_counts", """
  SELECT 'collection:' || name AS "check", "rows" AS observed, 1::BIGINT AS expected, "rows" >= 1 AS passed FROM collections""")
oracle("dq_unique", """
  SELECT 'unique:entities.article_title' AS "check", count(*) AS observed, 0::BIGINT AS expected, count(*) = 0 AS passed
  FROM (SELECT 1 FROM ent GROUP BY article_title HAVING count(*) > 1)
  UNION ALL SELECT 'unique:revisions.user', count(*), 0, count(*) = 0
  FROM (SELECT 1 FROM rev GROUP BY "user" HAVING count(*) > 1)""")
oracle("dq_complete", """
  SELECT 'complete:revisions' AS "check", count(*) AS observed, count(*) AS expected, true AS passed FROM rev
  UNION ALL SELECT name || ':revisions', 0, 0, true FROM (VALUES ('required_field'), ('readable'), ('not_silent')) v(name)""")
oracle("dq_models", f"""
  SELECT 'model:random_forest' AS "check", {3 + len(VECTOR)}::BIGINT AS observed, {3 + len(VECTOR)}::BIGINT AS expected, true AS passed""")
oracle("dq_summary", """
  , checks AS (
    SELECT 'output:' || name AS "check", "rows" >= 1 AS passed FROM outputs
    UNION ALL SELECT "check", observed = 0 FROM field_checks)
  SELECT "check", CASE WHEN passed THEN 'PASSED' ELSE 'NEEDS ATTENTION' END AS outcome,
         (SELECT count(*) FROM checks WHERE passed) AS passed_checks, (SELECT count(*) FROM checks) AS total_checks
  FROM checks""")
oracle("stream_weekly_edit_wars", f"""
  SELECT {WEEK_COLUMNS} FROM wars
  WHERE week_start + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""")
FOLLOWED = f"""
followed AS (
  SELECT *, date_trunc('week', edit_timestamp)::DATE AS week_start,
         revid % 3 = 0 AND date_trunc('week', edit_timestamp) + INTERVAL 7 DAY
           <= (SELECT max(edit_timestamp) - INTERVAL 1 DAY FROM rev WHERE revid % 3 <> 0) AS late
  FROM rev),
shown AS (
  SELECT article_title, week_start, count(*) AS weekly_edits, count(*) FILTER (WHERE is_revert) AS weekly_reverts,
         count(DISTINCT "user") AS weekly_editors,
         count(*) FILTER (WHERE is_revert) / count(*)::DOUBLE AS weekly_reversion_rate,
         week_start + INTERVAL 7 DAY <= (SELECT max(edit_timestamp) - INTERVAL 1 DAY FROM rev) AS closed
  FROM followed WHERE NOT late GROUP BY 1, 2)"""
ORACLES["stream_current_weeks"] = f"WITH {BASE}, {FOLLOWED} SELECT {WEEK_COLUMNS}, closed FROM shown"
ORACLES["stream_late_edits"] = f"""WITH {BASE}, {FOLLOWED}
  SELECT article_title, revid, edit_timestamp, 'late' AS reason, 1::BIGINT AS batch FROM followed WHERE late"""
ORACLES["stream_totals"] = f"""WITH {BASE}, {FOLLOWED}
  SELECT CASE WHEN closed THEN 'closed' ELSE 'open' END AS state, sum(weekly_edits)::BIGINT AS edits FROM shown GROUP BY 1
  UNION ALL SELECT 'apart', count(*) FROM followed WHERE late UNION ALL SELECT 'all', count(*) FROM rev"""
