"""The test tables, and views that give them the shape of signals.

Each view is one SQL text that Spark and the checking database both run, with the base table as
``{events}``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from signalyard.session import configure, shared_dir

_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
_TS = "CAST(ts AS TIMESTAMP)"
_SESSION = "concat('s', user_id, '-', CAST(EXTRACT(DAY FROM ts) AS INT))"
_PURCHASE = "event_type = 'purchase'"

VIEWS: dict[str, str] = {
    "fx_track": f"""SELECT event_id AS seq, {_TS} AS ts, concat('u', user_id) AS user_id,
        concat('d', user_id % 37) AS device_id, {_SESSION} AS session_id,
        CASE event_type WHEN 'view' THEN 'Page Viewed' WHEN 'click' THEN 'Feature Used'
          WHEN 'signup' THEN 'User Signed Up' WHEN 'purchase' THEN 'Order Completed'
          ELSE 'Authentication Failed' END AS event_name,
        concat('svc', user_id % 4) AS service, value, {_K} AS k, props FROM {{events}}""",
    "fx_identify": f"""SELECT event_id AS seq, {_TS} AS ts, concat('u', user_id) AS user_id,
        CASE event_id % 3 WHEN 0 THEN 'free' WHEN 1 THEN 'pro' ELSE 'enterprise' END AS plan, {_K} AS k
        FROM {{events}} WHERE event_type = 'signup'""",
    "fx_group": f"""SELECT event_id AS seq, {_TS} AS ts, concat('u', user_id) AS user_id,
        concat('org_', {_K} % 10) AS group_id, {_K} AS k FROM {{events}} WHERE event_type = 'click'""",
    "fx_revenue": f"""SELECT event_id AS seq, {_TS} AS ts, concat('u', user_id) AS user_id, value AS amount,
        CASE user_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
        concat('ord_', event_id) AS order_id, concat('svc', user_id % 4) AS service, {_K} AS k
        FROM {{events}} WHERE {_PURCHASE}""",
    "fx_refund": f"""SELECT event_id AS seq, {_TS} + INTERVAL 1 DAY AS ts, concat('ord_', event_id) AS order_id,
        value / 2 AS amount FROM {{events}} WHERE {_PURCHASE} AND {_K} >= 80""",
    # Chains of ten users; the last of a chain links to itself.
    "fx_alias": """SELECT DISTINCT concat('u', CASE WHEN user_id % 10 = 0 THEN user_id ELSE user_id - 1 END)
        AS previous_id, concat('u', user_id) AS user_id FROM {events}""",
    "fx_log": f"""SELECT event_id AS seq, {_TS} AS ts, {_SESSION} AS session_id, CAST(event_id % 9 AS INT) AS level,
        CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS component,
        CASE user_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('svc', user_id % 4) END AS service_override,
        CASE WHEN event_id % 101 = 0 THEN '' ELSE concat('msg ', event_type) END AS message, props
        FROM {{events}}""",
    "fx_gauge": f"""SELECT event_id AS seq, {_TS} AS ts, 'app.value' AS name, event_type AS label_type, value
        FROM {{events}}""",
    "fx_counter": f"""SELECT event_id AS seq, {_TS} AS ts, 'app.k_total' AS name, concat('u', user_id) AS source,
        CAST(SUM({_K}) OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM {{events}}""",
    "fx_hist": f"""SELECT event_type AS label_type, date_trunc('day', {_TS}) AS day, COUNT(*) AS n, SUM(value) AS total,
        MIN(value) AS lo, MAX(value) AS hi, COUNT(CASE WHEN value <= 5 THEN 1 END) AS le_5,
        COUNT(CASE WHEN value <= 25 THEN 1 END) AS le_25, COUNT(CASE WHEN value <= 100 THEN 1 END) AS le_100,
        COUNT(*) AS le_inf FROM {{events}} GROUP BY event_type, date_trunc('day', {_TS})""",
    # Five consecutive events per batch; ids without a purchase never arrive, so there are gaps.
    "fx_batch": f"""SELECT CAST(floor(event_id / 5) AS BIGINT) + 1 AS batch_id, 'event' AS schema_type,
        event_id AS seq, {_TS} AS ts FROM {{events}} WHERE {_PURCHASE}""",
    "fx_bad": """SELECT event_id AS seq, CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('u', user_id) END AS user_id,
        CASE WHEN event_id % 89 = 0 THEN '' WHEN event_id % 83 = 0 THEN repeat('é', 129) ELSE event_type END
          AS event_name,
        CASE WHEN event_id % 79 = 0 THEN -1.0 * value ELSE value END AS amount,
        CASE WHEN event_id % 73 = 0 THEN '' ELSE 'USD' END AS currency,
        CASE WHEN event_id % 71 = 0 THEN '' ELSE concat('ord_', event_id) END AS order_id,
        CASE WHEN event_id % 67 = 0 THEN '' ELSE concat('org_', event_id % 7) END AS group_id FROM {events}""",
}


def view_ctes(*names: str) -> str:
    """``name AS (...)`` for each view, as the database runs it."""
    return ", ".join(f"{n} AS ({VIEWS[n].format(events='events')})" for n in names)


class Tables:
    """Access to the tables and views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def view(self, name: str) -> DataFrame:
        return self.spark.sql(VIEWS[name], events=self.base("events"))

    def stream(self, name: str, max_files: int = 1) -> DataFrame:
        """A base table as a stream of its files."""
        reader = self.spark.readStream.schema(self.base(name).schema).option("maxFilesPerTrigger", max_files)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)

    def stream_view(self, name: str) -> DataFrame:
        return self.spark.sql(VIEWS[name], events=self.stream("events"))

    def scratch(self) -> str:
        """A new folder in the shared one."""
        return f"{shared_dir(self.spark)}/runs/{uuid.uuid4().hex}"
