"""Default settings of the risk operators; every operator takes its own as arguments."""

from __future__ import annotations

# Policy priors by vertical, overlays by market and vertical (the first match counts).
POLICY_KEYS = ("claim_window_hours", "photo_prior", "remedy_cash_bias", "returns_allowed")
POLICY_DEFAULTS = {
    "food": (36.0, 0.35, 0.40, 0.0),
    "qcommerce": (18.0, 0.55, 0.45, 0.0),
    "grocery": (72.0, 0.65, 0.55, 0.0),
}
POLICY_OVERLAYS = [
    ("US", "food", (24.0, 0.40, 0.70, 0.0)),
    ("IN", "qcommerce", (24.0, 0.60, 0.50, 0.0)),
    ("US", "qcommerce", (12.0, 0.50, 0.45, 0.0)),
]
POLICY_FALLBACK = (36.0, 0.40, 0.45, 0.0)
VERTICAL_ALIASES = {"q_commerce": "qcommerce", "quick_commerce": "qcommerce", "quickcommerce": "qcommerce", "instamart": "qcommerce", "groceries": "grocery"}

# Label columns that each disposition sets.
LABEL_COLUMNS = ("abuse_label", "abuse_label_weak", "fraud_label", "fraud_label_source", "strong_fraud_label", "weak_policy_negative")
OUTCOMES = {
    "investigator_confirmed_fraud": (1, 0, 1, "proven", 1, 0),
    "chargeback_lost": (1, 0, 1, "proven", 1, 0),
    "bank_dispute_lost": (1, 0, 1, "proven", 1, 0),
    "manual_denied_abuse": (1, 0, 0, "", 0, 0),
    "manual_denied_fraud": (1, 0, 1, "proven", 0, 0),
    "blocked_auto": (1, 1, 0, "", 0, 0),
    "weak_policy_auto_grant": (0, 0, 0, "", 0, 1),
    "investigator_cleared": (0, 0, 0, "", 0, 0),
    "step_up_granted": (0, 0, 0, "", 0, 0),
}
LAG_DAYS = 7

# Weights of labelled rows and rules of proxy labels.
WEIGHTS = {"fraud_proxy": 0.4, "fraud_discovery": 0.15, "fraud_proven": 1.0, "abuse_positive": 1.0, "abuse_weak": 0.6, "weak_negative": 0.3, "clean_negative": 1.0}
PROXY = {"cluster": 4, "accounts": 3, "lift": 1.5, "share": 0.5, "cooccur": 3, "rate": 0.35, "orders": 5, "device_risk": 70, "flags": 2}

# User-vendor edges.
EDGES = {"min_orders": 3, "min_refunds": 2, "min_lift": 2.0, "min_rate": 0.25, "shuffles": 3, "percentile": 0.95, "min_history": 40}

# Decision ladders (soft, hold, deny), overlays and head ladders.
LADDER = (35.0, 50.0, 75.0)
LADDER_OVERLAYS = [("SG", "food", (32.0, 48.0, 72.0)), ("ID", "food", (30.0, 46.0, 70.0))]
ABUSE_LADDER = (35.0, 50.0, 75.0)
FRAUD_LADDER = (30.0, 45.0, 65.0)
TIERS = ("auto_approve", "soft_friction", "hold_review", "auto_deny")
EFFECTS = ("refund_auto_grant", "refund_step_up", "refund_manual_review", "refund_block")
CHALLENGES = ("none", "payment_verify", "identity_verify", "identity_verify")
ELEVATION_DELTA = 10.0

# Ordered effect and challenge rules; the first that matches counts.
EFFECT_RULES = [
    {"id": "pin_fail_step_up", "mode": "live", "when": {"pin_required": 1, "pin_verified": 0, "min_decision_score": 25}, "effect": "refund_step_up", "reason": "EFFECT_PIN_FAIL"},
    {"id": "ai_image_review", "mode": "live", "when": {"min_claim_image_ai_risk": 0.80, "claim_in_app_capture": 0}, "effect": "refund_manual_review", "reason": "EFFECT_AI_IMAGE"},
    {"id": "same_device_collusion_block", "mode": "shadow", "when": {"customer_courier_same_device": 1, "min_decision_score": 40}, "effect": "refund_block", "reason": "EFFECT_SAME_DEVICE_SHADOW"},
    {"id": "high_device_risk_step_up", "mode": "live", "when": {"min_device_risk_score": 70}, "effect": "refund_step_up", "reason": "EFFECT_DEVICE_RISK"},
]
CHALLENGE_RULES = [
    {"id": "soft_payment_verify", "mode": "live", "when": {"tiers": ["soft_friction"], "min_decision_score": 30}, "challenge": "payment_verify", "reason": "CHALLENGE_SOFT_PAYMENT"},
    {"id": "hold_identity_verify", "mode": "live", "when": {"tiers": ["hold_review"], "min_decision_score": 45}, "challenge": "identity_verify", "reason": "CHALLENGE_HOLD_IDENTITY"},
    {"id": "collusion_identity_shadow", "mode": "shadow", "when": {"min_uv_mo_possible_collusion": 1, "min_decision_score": 35}, "challenge": "identity_verify", "reason": "CHALLENGE_COLLUSION_SHADOW"},
    {"id": "ai_image_in_app_capture", "mode": "live", "when": {"min_claim_image_ai_risk": 0.75, "tiers": ["soft_friction", "hold_review"]}, "challenge": "in_app_capture", "reason": "CHALLENGE_IN_APP_CAPTURE"},
]

# Refund budget.
BUDGET = {"auto": 3, "gmv": 0.35, "count": 5, "elevated": "refund_step_up", "exhausted": "refund_manual_review"}

# Behaviour baselines.
KIND_HEADS = {"user": "abuse", "uv": "abuse", "driver": "fraud", "vendor": "fraud", "device": "fraud", "ud": "fraud", "vd": "fraud", "uvd": "fraud"}
BASELINE = {"under_abuse": 35.0, "under_fraud": 30.0, "settled": ("delivered", "claim", "refunded", "completed"), "min_obs": 10, "min_under_rate": 0.80, "events": 50, "days": 30, "revoke": 0.50, "pair_min": 3,
            "delta": 15.0, "lift": 1.5, "streak": 2, "max_discount": 0.10, "per_lift": 0.04, "relax_per_pp": 1.0, "max_relax": 5.0, "trust_abuse": 25.0, "trust_fraud": 20.0, "tighten": 5.0,
            "cohort_support": 30, "cohort_events": 500, "cohort_lift": 1.5, "cohort_delta": 15.0, "new_days": 14, "mid_days": 90, "target": 0.98}

# Evidence checks (code, metric, floor) and weights of contributions.
EVIDENCE = [
    ("USER_REFUND_COUNT_7D", "user_refund_count_7d", 2.0), ("USER_REFUND_RATE_30D", "user_refund_rate_30d", 0.15),
    ("USER_REFUND_GMV_PCT_30D", "user_refund_gmv_pct_30d", 0.15), ("USER_LIFETIME_REFUNDS", "user_lifetime_refund_count", 3.0),
    ("USER_REFUND_TO_LTV_SOFT", "user_refund_to_ltv_ratio", 0.25), ("COMBINED_REFUND_COUNT", "combined_refund_count_30d", 3.0),
    ("RELATED_REFUND_COUNT", "related_refund_count_30d", 2.0), ("RELATED_MAX_RATE", "related_max_refund_rate_30d", 0.25),
    ("UVD_REFUND_LIFT", "uvd_refund_lift", 1.5), ("UVD_REFUND_SHARE", "uvd_refund_share", 0.4),
    ("DEVICE_MULTI_ACCOUNT", "accounts_per_device", 2.0), ("DEVICE_CLUSTER_SIZE", "device_cluster_size", 3.0),
    ("REASON_REPEAT_RATE", "reason_repeat_rate_30d", 0.6), ("ABUSE_HEAD", "abuse_score", 35.0), ("FRAUD_HEAD", "fraud_score", 30.0),
]
EVIDENCE_WEIGHTS = {"user": 0.25, "driver": 0.15, "vendor": 0.15, "ud": 0.10, "uv": 0.10, "vd": 0.08, "uvd": 0.12, "device": 0.05}

# Promotion ceilings (decision quality and operations).
CEILINGS = {"decision_ece": 0.20, "decision_brier": 0.25, "psi_train_test": 0.35, "hold_rate": 0.55, "live_override_rate": 0.35, "shadow_override_rate": 0.40, "refund_grant_rate": 0.90, "refund_dollar_per_order": 12.0, "cs_queue_depth": 500.0}
MAX_SNAPSHOT_HOURS = 24
PACK_FLOORS = {"min_pack_n": 60, "min_proven": 3}
SDK_SOURCES = {"device": ["device", "device_intelligence", "fingerprint", "shield", "incognia"], "vision": ["vision", "claim_vision", "image", "media", "pin"]}

# Floors of an out-of-time evaluation.
OOT_FLOORS = {"min_holdout_n": 30, "min_proven_positives": 3, "min_fraud_proven_average_precision": 0.20, "min_fraud_proven_precision_at_soft": 0.10, "max_decision_ece": 0.35}

# Curves per slice, multi-pass training, edge reconstruction.
CALIBRATION = {"min_n": 40, "min_pos": 5, "steps": 8}
MULTIPASS = {"passes": 10, "delta": 0.05, "patience": 2, "self_train": 80.0}
RECONSTRUCTION = {"alpha": 1.0, "edge_z": 2.5, "node_z": 2.5, "structure": 0.25, "proposals": 50}
