"""Landing and ledger queries.

Stand-in: each row of ``events`` is an object-created event.  The event type picks the
landing bucket (and so the partner; ``error`` comes from a non-landing bucket), the user
and the JSON ``k`` build the object key, clicks carry no etag and views no size.
Replays are real: the same (type, user, k) recurs with other event ids and times.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import keys as K
from quarry.operators import landing
from quarry.plans.registry import register
from quarry.plans.standins import table

ACCOUNT = "000000000042"
BATCH_START = _dt.datetime(2024, 1, 16)  # events before this are the existing ledger


def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    bucket = (
        F.when(F.col("event_type") == "error", F.lit(f"imgp-dev-bronze-{ACCOUNT}"))
        .when(F.col("event_type") == "view", F.lit(f"imgp-dev-landing-acme-media-{ACCOUNT}"))
        .otherwise(F.concat(F.lit("imgp-dev-landing-"), "event_type", F.lit(f"-{ACCOUNT}")))
    )
    ext = (
        F.when(F.col("event_type") == "purchase", F.lit(".ZIP"))
        .when(F.col("event_type") == "signup", F.lit(".tar.zip"))
        .when(F.col("event_type") == "click", F.lit(".jpg"))
        .otherwise(F.lit(".png"))
    )
    key = F.concat(F.lit("drops/u"), F.col("user_id").cast("string"), F.lit("/batch_"), k, ext)
    etag = F.when(F.col("event_type") != "click", F.md5(F.concat(F.col("user_id").cast("string"), F.lit("-"), k)))
    size = F.when(F.col("event_type") != "view", F.col("user_id") * 1000 + k.cast("long"))
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return e.select(
        "event_id",
        "ts",
        "event_type",
        "value",
        F.struct(
            F.struct(bucket.alias("name")).alias("bucket"),
            F.struct(key.alias("key"), size.alias("size"), etag.alias("etag")).alias("object"),
        ).alias("detail"),
        time.alias("time"),
    )


SQL_LANDING = f"""
ev AS (
  SELECT event_id, ts, event_type, value,
         CASE WHEN event_type = 'error' THEN 'imgp-dev-bronze-{ACCOUNT}'
              WHEN event_type = 'view' THEN 'imgp-dev-landing-acme-media-{ACCOUNT}'
              ELSE 'imgp-dev-landing-' || event_type || '-{ACCOUNT}' END AS src_bucket,
         'drops/u' || CAST(user_id AS VARCHAR) || '/batch_' || json_extract_string(props, '$.k') ||
         CASE event_type WHEN 'purchase' THEN '.ZIP' WHEN 'signup' THEN '.tar.zip'
                         WHEN 'click' THEN '.jpg' ELSE '.png' END AS src_key,
         CASE WHEN event_type <> 'view'
              THEN user_id * 1000 + CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE 0 END AS size_bytes,
         CASE WHEN event_type <> 'click'
              THEN md5(CAST(user_id AS VARCHAR) || '-' || json_extract_string(props, '$.k')) ELSE '' END AS etag,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time
  FROM events),
obj AS (
  SELECT *, CASE WHEN partner0 = '' THEN 'unknown' ELSE partner0 END AS partner,
         substr(event_time, 1, 10) AS ingest_date
  FROM (SELECT *, regexp_extract(src_bucket, '^imgp-[^-]+-landing-(.+)-[0-9]{{12}}$', 1) AS partner0 FROM ev)),
drops AS (
  SELECT *, partner || '#' || src_key || '#' || etag AS drop_id FROM obj)
"""

SQL_FIRST_SEEN = """
SELECT drop_id, partner, src_bucket, src_key, size_bytes, ingest_date, 'RECEIVED' AS status,
       event_time AS received_at
FROM (SELECT *, row_number() OVER (PARTITION BY drop_id ORDER BY event_time, event_id) AS rn FROM {src})
WHERE rn = 1
"""


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.normalize_events(landing_events(spark, sf_dir), seq="event_id")


@register(
    "landing_keys",
    "X2 X3 X4 X5 X7 F10",
    f"""
WITH {SQL_LANDING}
SELECT event_id, partner, src_key, size_bytes, etag, ingest_date, drop_id,
       regexp_extract(src_key, '[^/]*$', 0) AS file_name,
       CASE WHEN lower(src_key) LIKE '%.zip' THEN 'unpack' ELSE 'copy' END AS action,
       dataset,
       'partner=' || partner || '/dataset=' || dataset || '/ingest_date=' || ingest_date || '/' AS bronze_prefix
FROM (SELECT *, CASE WHEN lower(src_key) LIKE '%.zip'
                     THEN CASE WHEN regexp_matches(fname, '^.+\\.[^.]+$')
                               THEN regexp_extract(fname, '^(.+)\\.[^.]+$', 1) ELSE fname END
                     ELSE 'loose' END AS dataset
      FROM (SELECT *, regexp_extract(src_key, '[^/]*$', 0) AS fname FROM drops))
""",
)
def landing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = landing.route(_objects(spark, sf_dir))
    return o.select(
        F.col("event_seq").alias("event_id"),
        "partner",
        "src_key",
        "size_bytes",
        "etag",
        "ingest_date",
        "drop_id",
        K.file_name("src_key").alias("file_name"),
        "action",
        "dataset",
        "bronze_prefix",
    )


@register("ledger_first_seen", "R1 K10", f"WITH {SQL_LANDING}" + SQL_FIRST_SEEN.format(src="drops"))
def ledger_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.first_seen(_objects(spark, sf_dir))


@register(
    "ledger_insert_if_absent",
    "K10 J5",
    f"""
WITH {SQL_LANDING},
old AS (SELECT DISTINCT drop_id FROM drops WHERE ts < TIMESTAMP '{BATCH_START}'),
batch AS (SELECT * FROM drops WHERE ts >= TIMESTAMP '{BATCH_START}'),
cand AS ({SQL_FIRST_SEEN.format(src="batch")})
SELECT * FROM cand c WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.drop_id = c.drop_id)
""",
)
def ledger_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = landing_events(spark, sf_dir)
    existing = landing.first_seen(landing.normalize_events(ev.where(F.col("ts") < F.lit(BATCH_START)), "event_id"))
    batch = landing.first_seen(landing.normalize_events(ev.where(F.col("ts") >= F.lit(BATCH_START)), "event_id"))
    return landing.insert_if_absent(existing, batch)


# Stand-in status stream: each event is a status change of its drop, the status picked by
# the event's value band (so one drop moves through several statuses, some out of order).
STATUS_BANDS = [(20.0, "RECEIVED"), (40.0, "SUBMITTED"), (60.0, "UNPACKING"), (80.0, "DONE")]


@register(
    "ledger_latest_status",
    "K11 A6 R3",
    f"""
WITH {SQL_LANDING},
st AS (
  SELECT drop_id, ts AS updated_at, event_id,
         CASE WHEN value < 20 THEN 'RECEIVED' WHEN value < 40 THEN 'SUBMITTED'
              WHEN value < 60 THEN 'UNPACKING' WHEN value < 80 THEN 'DONE' ELSE 'FAILED' END AS status,
         CASE WHEN value >= 60 AND value < 80 THEN 'partner=' || partner || '/manifest-' || CAST(event_id AS VARCHAR) || '.json' END
           AS manifest_key
  FROM drops),
ranked AS (
  SELECT *, CASE status WHEN 'RECEIVED' THEN 0 WHEN 'SUBMITTED' THEN 1 WHEN 'UNPACKING' THEN 2 ELSE 3 END AS r
  FROM st)
SELECT drop_id,
       arg_max(status, (r, updated_at, event_id)) AS status,
       arg_max(updated_at, (r, updated_at, event_id)) AS updated_at,
       count(*) AS n_events,
       arg_max(manifest_key, (r, updated_at, event_id)) FILTER (WHERE manifest_key IS NOT NULL) AS manifest_key
FROM ranked GROUP BY drop_id
""",
)
def ledger_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = landing.normalize_events(landing_events(spark, sf_dir), seq="event_id", keep=("ts", "value"))
    status = F.lit("FAILED")
    for bound, name in reversed(STATUS_BANDS):
        status = F.when(F.col("value") < bound, F.lit(name)).otherwise(status)
    st = o.select(
        "drop_id",
        status.alias("status"),
        F.col("ts").alias("updated_at"),
        F.col("event_seq").alias("event_id"),
        F.when(
            (F.col("value") >= 60) & (F.col("value") < 80),
            F.concat(F.lit("partner="), "partner", F.lit("/manifest-"), F.col("event_seq").cast("string"), F.lit(".json")),
        ).alias("manifest_key"),
    )
    return landing.latest_status(st, order=["event_id"])


# ---------------------------------------------------------------------------------------
# Objects from pages: the URL's host and path is the landing key; ``.html`` pages arrive
# as ``.zip`` archives, everything else is a loose object.
PAGES_DATE = "2024-06-01"


def page_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    hostpath = F.regexp_extract("url", r"^[a-z]+://([^?#]*)", 1)
    key = F.regexp_replace(hostpath, r"\.html$", ".zip")
    host = F.substring_index(hostpath, "/", 1)
    label = F.substring_index(F.regexp_replace(host, r"^(m|blog)\.", ""), ".", 1)
    ev = p.select(
        "page_id",
        F.struct(
            F.struct(F.concat(F.lit("imgp-dev-landing-"), label, F.lit(f"-{ACCOUNT}")).alias("name")).alias("bucket"),
            F.struct(
                key.alias("key"), F.length("html").cast("long").alias("size"), F.lit(None).cast("string").alias("etag")
            ).alias("object"),
        ).alias("detail"),
        F.lit(f"{PAGES_DATE}T00:00:00Z").alias("time"),
    )
    return landing.normalize_events(ev, seq="page_id")


SQL_PAGES = f"""
po AS (
  SELECT page_id, regexp_replace(hp, '\\.html$', '.zip') AS src_key,
         split_part(regexp_replace(split_part(hp, '/', 1), '^(m|blog)\\.', ''), '.', 1) AS partner,
         '{PAGES_DATE}' AS ingest_date
  FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^?#]*)', 1) AS hp FROM pages)),
pf AS (SELECT *, regexp_extract(src_key, '[^/]*$', 0) AS fname FROM po)
"""


@register(
    "route_landing_objects",
    "F3 F10",
    f"""
WITH {SQL_PAGES}
SELECT page_id, partner, src_key,
       CASE WHEN lower(src_key) LIKE '%.zip' THEN 'unpack' ELSE 'copy' END AS action,
       CASE WHEN lower(src_key) LIKE '%.zip'
            THEN CASE WHEN regexp_matches(fname, '^.+\\.[^.]+$') THEN regexp_extract(fname, '^(.+)\\.[^.]+$', 1)
                      ELSE fname END
            ELSE 'loose' END AS dataset,
       CASE WHEN lower(src_key) LIKE '%.zip' THEN NULL
            ELSE 'partner=' || partner || '/dataset=loose/ingest_date=' || ingest_date || '/' || fname END AS bronze_key
FROM pf
""",
)
def route_landing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = landing.route(page_objects(spark, sf_dir))
    return r.select(F.col("event_seq").alias("page_id"), "partner", "src_key", "action", "dataset", "bronze_key")


@register(
    "loose_bronze_keys",
    "K9 X4 X7",
    f"""
WITH {SQL_PAGES}
SELECT 'partner=' || partner || '/dataset=loose/ingest_date=' || ingest_date || '/' || fname AS bronze_key,
       count(*) AS n_objects, min(src_key) AS first_src_key
FROM pf WHERE NOT lower(src_key) LIKE '%.zip'
GROUP BY 1
""",
)
def loose_bronze_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze keys of loose objects; ``n_objects > 1`` marks base-name collisions, where
    copies overwrite each other."""
    r = landing.route(page_objects(spark, sf_dir)).where(F.col("action") == "copy")
    return r.groupBy("bronze_key").agg(
        F.count(F.lit(1)).alias("n_objects"), F.min("src_key").alias("first_src_key")
    )


# ---------------------------------------------------------------------------------------
@register(
    "partner_from_bucket",
    "X1",
    f"""
SELECT c_custkey, bucket,
       CASE WHEN regexp_extract(bucket, '^imgp-[^-]+-landing-(.+)-[0-9]{{12}}$', 1) = '' THEN 'unknown'
            ELSE regexp_extract(bucket, '^imgp-[^-]+-landing-(.+)-[0-9]{{12}}$', 1) END AS partner
FROM (SELECT c_custkey,
             CASE c_mktsegment
               WHEN 'BUILDING' THEN 'imgp-dev-landing-' || lower(c_mktsegment) || '-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
               WHEN 'AUTOMOBILE' THEN 'imgp-prod-landing-acme-' || lower(c_mktsegment) || '-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
               WHEN 'MACHINERY' THEN 'imgp-dev-bronze-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0')
               WHEN 'HOUSEHOLD' THEN 'imgp-dev-landing-' || lower(c_mktsegment) || '-' || lpad(CAST(c_custkey AS VARCHAR), 11, '0')
               ELSE 'some-other-bucket' END AS bucket
      FROM customer)
""",
)
def partner_from_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    bucket = (
        F.when(seg == "BUILDING", F.concat(F.lit("imgp-dev-landing-"), F.lower(seg), F.lit("-"), F.lpad(key, 12, "0")))
        .when(
            seg == "AUTOMOBILE",
            F.concat(F.lit("imgp-prod-landing-acme-"), F.lower(seg), F.lit("-"), F.lpad(key, 12, "0")),
        )
        .when(seg == "MACHINERY", F.concat(F.lit("imgp-dev-bronze-"), F.lpad(key, 12, "0")))
        .when(seg == "HOUSEHOLD", F.concat(F.lit("imgp-dev-landing-"), F.lower(seg), F.lit("-"), F.lpad(key, 11, "0")))
        .otherwise(F.lit("some-other-bucket"))
    )
    return c.select("c_custkey", bucket.alias("bucket")).withColumn("partner", K.partner_from_bucket("bucket"))
