"""Column functions: slice keys, policy priors, vendor payloads, SDK envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import defaults as D

DEVICE_ALIASES = {
    "device_risk_score": ("device_risk_score", "risk_score", "shield_score", "fingerprint_risk"),
    "is_emulator": ("is_emulator", "emulator"), "is_cloned_app": ("is_cloned_app", "cloned_app", "app_cloners"),
    "is_gps_spoof": ("is_gps_spoof", "gps_spoof", "mock_location"), "is_tampered": ("is_tampered", "tampered", "rooted", "jailbroken"),
    "customer_courier_same_device": ("customer_courier_same_device", "same_device_as_courier"),
}
VISION_ALIASES = {
    "claim_has_image": ("claim_has_image", "has_image"), "claim_image_ai_risk": ("claim_image_ai_risk", "ai_risk", "manipulation_score", "deepfake_score"),
    "claim_in_app_capture": ("claim_in_app_capture", "in_app_capture"), "pin_required": ("pin_required",), "pin_verified": ("pin_verified",),
    "delivery_geofence_ok": ("delivery_geofence_ok", "geofence_ok"),
}


def market_key(c: Column) -> Column:
    return F.coalesce(F.nullif(F.upper(F.trim(c)), F.lit("")), F.lit("ALL"))


def vertical_key(c: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("all"))


def vertical_alias(c: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(c, F.lit("food"))))
    out = v
    for alias, name in D.VERTICAL_ALIASES.items():
        out = F.when(v == alias, F.lit(name)).otherwise(out)
    return out


def policy_features(orders: DataFrame) -> DataFrame:
    """order_id and six policy columns: the first overlay of market and vertical, else the vertical's default,
    else the fallback; hours from delivery to claim and what is left of the claim window."""
    market, vertical = F.upper(F.trim(F.coalesce("market", F.lit("")))), vertical_alias(F.col("vertical"))

    def prior(i: int) -> Column:
        out = F.lit(D.POLICY_FALLBACK[i])
        for name, values in D.POLICY_DEFAULTS.items():
            out = F.when(vertical == name, F.lit(values[i])).otherwise(out)
        for m, v, values in reversed(D.POLICY_OVERLAYS):
            out = F.when((market == m) & (vertical == v), F.lit(values[i])).otherwise(out)
        return out

    have = set(orders.columns)
    times = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have], F.lit(None).cast("timestamp"))
    delivered = F.coalesce(times("delivered_ts", "delivery_ts"), F.when(F.lower("status") == "delivered", F.col("event_ts")))
    hours = (F.unix_micros(times("claim_ts", "as_of_ts")) - F.unix_micros(delivered)) / 3.6e9
    hours = F.when(hours < 0, F.lit(0.0)).otherwise(hours)
    window = F.greatest(prior(0), F.lit(1e-6))
    left = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (window - hours) / window))
    return orders.select("order_id", *[prior(i).alias(f"policy_{k}") for i, k in enumerate(D.POLICY_KEYS)], F.when(hours.isNull(), 0.0).otherwise(hours).alias("hours_since_delivery"), F.when(hours.isNull(), 0.0).otherwise(left).alias("claim_window_remaining_frac"))


def _first(p: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_element_at(p, F.lit(n)).try_cast("double") for n in names], F.lit(0.0))


def device_signal(payload: Column) -> dict[str, Column]:
    """A map of a device vendor's names to texts -> six platform columns."""
    risk = _first(payload, DEVICE_ALIASES["device_risk_score"])
    risk = F.when((risk > 0) & (risk <= 1), risk * 100).otherwise(risk)
    out = {k: (_first(payload, v) >= 1).cast("double") for k, v in DEVICE_ALIASES.items()}
    return out | {"device_risk_score": F.greatest(F.lit(0.0), F.least(F.lit(100.0), risk))}


def vision_signal(payload: Column) -> dict[str, Column]:
    ai = _first(payload, VISION_ALIASES["claim_image_ai_risk"])
    ai = F.when(ai > 1, ai / 100).otherwise(ai)
    out = {k: (_first(payload, v) >= 1).cast("double") for k, v in VISION_ALIASES.items()}
    return out | {"claim_image_ai_risk": F.greatest(F.lit(0.0), F.least(F.lit(1.0), ai))}


def normalize_sdk(events: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Envelopes (order_id, source, confidence, event_ts, payload JSON) -> order_id, source (device or vision),
    confidence, accepted, event_ts and the twelve platform columns, 0 where not accepted or of the other source."""
    source = F.lower(F.trim("source"))
    kind = F.when(source.isin(D.SDK_SOURCES["device"]), "device").when(source.isin(D.SDK_SOURCES["vision"]), "vision")
    conf = F.coalesce(F.col("confidence").try_cast("double"), F.lit(1.0))
    conf = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(conf > 1, conf / 100).otherwise(conf)))
    out = events.select("order_id", kind.alias("source"), conf.alias("confidence"), "event_ts", F.from_json("payload", "map<string,string>").alias("_p"))
    out = out.where("source is not null and order_id is not null").withColumn("accepted", F.col("confidence") >= min_confidence)
    mine = lambda k, c: F.when(F.col("accepted") & (F.col("source") == k), c).otherwise(F.lit(0.0))
    cols = {n: mine("device", c) for n, c in device_signal(F.col("_p")).items()} | {n: mine("vision", c) for n, c in vision_signal(F.col("_p")).items()}
    return out.select("order_id", "source", "confidence", "accepted", "event_ts", *[c.alias(n) for n, c in cols.items()])


def apply_sdk(orders: DataFrame, events: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    """Orders with the latest accepted signal of each source (rows without time count as the oldest), unless the
    order already has one of higher confidence."""
    norm = normalize_sdk(events, min_confidence).where("accepted")
    last = Window.partitionBy("order_id", "source").orderBy(F.col("event_ts").desc_nulls_last(), F.col("confidence").desc())
    latest = norm.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
    out = orders
    for kind, names in (("device", DEVICE_ALIASES), ("vision", VISION_ALIASES)):
        own = latest.where(F.col("source") == kind).select("order_id", F.col("confidence").alias("_c"), *[F.col(n).alias(f"_{n}") for n in names])
        out = out.join(own, "order_id", "left")
        before = F.coalesce(F.col(f"{kind}_signal_confidence"), F.lit(0.0)) if f"{kind}_signal_confidence" in out.columns else F.lit(0.0)
        take = F.col("_c").isNotNull() & (before <= F.col("_c"))
        old = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in out.columns else F.lit(0.0) for n in names}
        out = out.withColumns({n: F.when(take, F.col(f"_{n}")).otherwise(old[n]) for n in names} | {f"{kind}_signal_confidence": F.when(take, F.col("_c")).otherwise(before)})
        out = out.drop("_c", *[f"_{n}" for n in names])
    return out


def merge_signals(orders: DataFrame, device: Column | None = None, vision: Column | None = None) -> DataFrame:
    """Payload maps laid under the order's own columns: an order's value counts where it is above 0."""
    signals = (device_signal(device) if device is not None else {}) | (vision_signal(vision) if vision is not None else {})
    own = lambda n: F.coalesce(F.col(n).try_cast("double"), F.lit(0.0)) if n in orders.columns else F.lit(0.0)
    return orders.withColumns({n: F.when(own(n) > 0, own(n)).otherwise(c) for n, c in signals.items()})


# Names under which senders put the parts of an envelope, the first that is there counts.
ENVELOPE = {"source": ("source", "kind", "signal_type"), "confidence": ("confidence", "conf"), "event_ts": ("event_ts", "captured_at", "ts"),
            "payload": ("payload", "signals", "data", "device_intelligence", "device_payload", "claim_vision", "vision_payload")}
NESTED = {"device": ("device_intelligence", "device_payload"), "vision": ("claim_vision", "vision_payload")}


def envelopes(lines: DataFrame, text: str = "value") -> DataFrame:
    """JSON texts, each one envelope, a list of them or {"events": [...]}, as order_id, source, confidence, event_ts and
    payload (JSON). A payload may be a JSON text; without a source the nested part tells it. What is no JSON or has no
    order_id gives no row."""
    whole = F.trim(F.col(text))
    listed = F.when(whole.startswith("["), F.from_json(whole, "array<string>")).otherwise(F.from_json(F.get_json_object(whole, "$.events"), "array<string>"))
    one = lines.select(F.explode(F.coalesce(listed, F.array(whole))).alias("_e"))
    part = lambda k: F.nullif(F.get_json_object("_e", f"$.{k}"), F.lit(""))
    first = {c: F.coalesce(*[part(k) for k in names]) for c, names in ENVELOPE.items()}
    kind = F.coalesce(first["source"], *[F.when(F.coalesce(*[part(k) for k in names]).isNotNull(), name) for name, names in NESTED.items()])
    out = one.select(F.trim(part("order_id")).alias("order_id"), kind.alias("source"), first["confidence"].alias("confidence"), F.to_timestamp(first["event_ts"]).alias("event_ts"), first["payload"].alias("payload"))
    return out.where("order_id <> ''")


def read_envelopes(spark, path: str, stream: bool = False) -> DataFrame:
    """Envelopes of a folder of JSON-lines files, whole or as a stream."""
    return envelopes((spark.readStream if stream else spark.read).text(path))
