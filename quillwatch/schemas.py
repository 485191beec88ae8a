"""Record layouts of the raw inputs.

Fixed values: the field names and types of the three raw feeds. Keys that a feed
carries beyond these (``minor``, ``anon``, ``temp``) are left out by the reader.
"""

REVISION = (
    "revid BIGINT, parentid BIGINT, timestamp STRING, user STRING, userid BIGINT, "
    "comment STRING, size BIGINT, article_title STRING, pageid BIGINT"
)

ENTITY = (
    "qid STRING, article_title STRING, label STRING, description STRING, "
    "claims_count INT, sitelinks_count INT, instance_of ARRAY<STRING>, part_of ARRAY<STRING>"
)

PAGEVIEW = (
    "project STRING, article STRING, granularity STRING, timestamp STRING, "
    "access STRING, agent STRING, views BIGINT, article_title STRING"
)

# Replies of the revision, entity and pageview web APIs, one JSON text per row.
REVISION_REPLY = (
    "query STRUCT<pages: MAP<STRING, STRUCT<revisions: ARRAY<STRUCT<"
    "revid: BIGINT, parentid: BIGINT, timestamp: STRING, user: STRING, userid: BIGINT, "
    "comment: STRING, size: BIGINT>>>>>"
)

# A reply that is one page of several names what the next page begins with.
REVISION_PAGE = "continue STRUCT<rvcontinue: STRING>, " + REVISION_REPLY

ENTITY_REPLY = (
    "entities MAP<STRING, STRUCT<missing: STRING, "
    "labels: MAP<STRING, STRUCT<value: STRING>>, "
    "descriptions: MAP<STRING, STRUCT<value: STRING>>, "
    "claims: MAP<STRING, ARRAY<STRUCT<mainsnak: STRUCT<datavalue: STRUCT<type: STRING, value: STRING>>>>>, "
    "sitelinks: MAP<STRING, STRING>>>"
)

PAGEVIEW_REPLY = (
    "items ARRAY<STRUCT<project: STRING, article: STRING, granularity: STRING, "
    "timestamp: STRING, access: STRING, agent: STRING, views: BIGINT>>"
)
