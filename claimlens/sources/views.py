"""Order history, scored orders, devices, users, dispositions and SDK envelopes over the given events table.

Each view is one SQL text that Spark and DuckDB read alike, so a query and its twin start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HIST = """
SELECT event_id AS order_id, user_id,
       user_id - user_id % 10 + k % 10 AS driver_id,
       CAST(floor(user_id / 10) AS BIGINT) * 25 + CAST(floor(k / 4) AS BIGINT) AS vendor_id,
       CAST(floor((user_id * 2 + k % 3) / 3) AS BIGINT) AS device_id,
       CAST(floor((user_id * 2 + k % 3) / 12) AS BIGINT) AS cluster_id,
       CASE user_id % 3 WHEN 0 THEN 'SG' WHEN 1 THEN 'ID' ELSE 'US' END AS market,
       CASE CAST(floor(k / 4) AS BIGINT) % 3 WHEN 0 THEN 'food' WHEN 1 THEN 'qcommerce' ELSE 'grocery' END AS vertical,
       CAST(round(value * 100) AS BIGINT) AS cents,
       CASE WHEN event_type IN ('purchase', 'error') THEN 'delivered' ELSE 'placed' END AS status,
       CASE WHEN event_type <> 'error' THEN '' WHEN k % 3 = 0 THEN 'missing_item'
            WHEN k % 3 = 1 THEN 'quality' ELSE 'wrong_order' END AS claim_reason,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_refund,
       ts AS event_ts, k
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events) e
"""
ORD = "SELECT * FROM hist WHERE order_id % 5 = 0"
DEV = """
SELECT user_id, device_id, min(cluster_id) AS cluster_id, max(event_ts) AS last_seen_ts,
       CAST(device_id * 37 % 100 AS DOUBLE) AS device_risk_score,
       CASE WHEN device_id % 11 = 0 THEN 1 ELSE 0 END AS is_emulator,
       CASE WHEN device_id % 7 = 0 THEN 1 ELSE 0 END AS is_cloned_app,
       CASE WHEN device_id % 13 = 0 THEN 1 ELSE 0 END AS is_gps_spoof,
       CASE WHEN device_id % 17 = 0 THEN 1 ELSE 0 END AS is_tampered
FROM hist GROUP BY user_id, device_id
"""
USR = "SELECT user_id, min(ts) AS signup_ts FROM events WHERE event_type = 'signup' AND user_id % 4 <> 0 GROUP BY user_id"
DISP = """
SELECT order_id, CASE order_id % 9 WHEN 0 THEN 'investigator_confirmed_fraud' WHEN 1 THEN 'chargeback_lost'
         WHEN 2 THEN 'bank_dispute_lost' WHEN 3 THEN 'manual_denied_abuse' WHEN 4 THEN 'manual_denied_fraud'
         WHEN 5 THEN 'blocked_auto' WHEN 6 THEN 'weak_policy_auto_grant' WHEN 7 THEN 'investigator_cleared'
         ELSE 'not_a_known_outcome' END AS disposition,
       event_ts + (order_id % 16) * INTERVAL '1' DAY AS disposition_ts
FROM ord WHERE order_id % 2 = 0
UNION ALL
SELECT order_id, 'investigator_cleared', event_ts + INTERVAL '20' DAY FROM ord WHERE order_id % 35 = 0
"""
SDK = """
SELECT order_id, CASE WHEN order_id % 10 = 0 THEN 'shield' ELSE 'claim_vision' END AS source,
       (order_id * 13 % 101) / 100.0 AS confidence, event_ts + INTERVAL '5' MINUTE AS event_ts,
       CASE WHEN order_id % 10 = 0
            THEN concat('{"risk_score":', CAST(k AS VARCHAR(10)), ',"emulator":', CAST(k % 2 AS VARCHAR(10)), ',"rooted":', CAST(k % 3 AS VARCHAR(10)), '}')
            ELSE concat('{"has_image":1,"ai_risk":', CAST(k AS VARCHAR(10)), ',"pin_required":1,"pin_verified":', CAST(k % 2 AS VARCHAR(10)), '}') END AS payload
FROM ord
UNION ALL
SELECT order_id, 'device', 0.99, event_ts - INTERVAL '1' HOUR, '{"risk_score":0.5}' FROM ord WHERE order_id % 20 = 0
"""
TEXTS = {"hist": HIST, "ord": ORD, "dev": DEV, "usr": USR, "disp": DISP, "sdk": SDK}
#: Every other view reads the history.
NEEDS = {"hist": [], "ord": ["hist"], "dev": ["hist"], "usr": [], "disp": ["hist", "ord"], "sdk": ["hist", "ord"]}


def with_views(names: str, *rest: str) -> str:
    """WITH clause over the named views (space-separated), further `name AS (...)` parts, and the final SELECT."""
    wanted: list[str] = []
    for n in names.split():
        wanted += [x for x in [*NEEDS[n], n] if x not in wanted]
    parts = [f"{n} AS ({TEXTS[n]})" for n in wanted] + list(rest[:-1])
    return "WITH " + ",\n".join(parts) + "\n" + rest[-1]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with instants in UTC, whatever kind of timestamp the file holds."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views above as a DataFrame."""
    tables = {"events": events(spark, sf_dir)}

    def build(n: str) -> DataFrame:
        if n not in tables:
            text = TEXTS[n]
            used = {x: build(x) for x in ["events", *NEEDS[n]] if f"FROM {x}" in text}
            for x in used:
                text = text.replace(f"FROM {x}", f"FROM {{{x}}}")
            tables[n] = spark.sql(text.replace('\'{"', '\'{{"').replace("}'", "}}'") if n == "sdk" else text, **used)
        return tables[n]

    return build(name)


def core_scan(spark: SparkSession, path: str, schema: str, form: str = "csv") -> DataFrame:
    """Orders, history, devices or users from files with a header, under an explicit schema."""
    reader = spark.read.schema(schema)
    return reader.option("header", True).csv(path) if form == "csv" else reader.format(form).load(path)


def ensure_columns(df: DataFrame, defaults: dict) -> DataFrame:
    """Columns that are missing, with their defaults."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank strings as null, as None, NaN and '' all mean absent."""
    clean = {c: F.when(F.trim(F.col(c)) != "", F.col(c)) for c, t in df.dtypes if t == "string"}
    clean |= {c: F.when(~F.isnan(F.col(c)), F.col(c)) for c, t in df.dtypes if t in ("double", "float")}
    return df.withColumns(clean)


def require_columns(df: DataFrame, needed: list[str]) -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def query_source(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """A feed given as SQL text over named tables ({name} in the text) and whatever the catalog holds."""
    return spark.sql(text, **tables)


def newest_file(spark: SparkSession, path: str, form: str = "parquet", **options) -> DataFrame:
    """Rows of the file of the latest modification time (the largest path of several) under path."""
    df = spark.read.options(**options).format(form).load(path)
    rows = df.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.col("_metadata.file_modification_time")})
    last = rows.select("_file", "_at").distinct().agg(F.max(F.struct("_at", "_file")).alias("last"))
    return rows.join(F.broadcast(last), F.col("_file") == F.col("last._file")).select(*df.columns)
