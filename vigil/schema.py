"""Declared schemas of the pipeline's tables and messages."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# These must equal the reference's for the same results.
# ---------------------------------------------------------------------------
N_FEATURES_DEFAULT = 115
BENIGN = "benign"
UNKNOWN_ATTACK = "unknown"
FALLBACK_ATTACK = "attack"
# Capture sources of the global dataset: (capture, feature file, label file).
REFERENCE_SOURCES = [
    ("Mirai", "Mirai_dataset.csv", "Mirai_labels.csv"),
    ("Fuzzing", "Fuzzing_dataset.csv", "Fuzzing_labels.csv"),
    ("OS_Scan", "OS_Scan_dataset.csv", "OS_Scan_labels.csv"),
    ("SYN_DoS", "SYN_DoS_dataset.csv", "SYN_DoS_labels.csv"),
    ("MitM", "MitM_dataset.csv", "MitM_labels.csv"),
    ("Video_Injection", "Video_Injection_dataset.csv", "Video_Injection_labels.csv"),
    ("SSL_Renegotiation", "SSL_Renegotiation_dataset.csv", "SSL_Renegotiation_labels.csv"),
    ("SSDP_Flood", "SSDP_Flood_dataset.csv", "SSDP_Flood_labels.csv"),
    ("Active_Wiretap", "Active_Wiretap_dataset.csv", "Active_Wiretap_labels.csv"),
]
# Rules and alert layer.
SIMPLE_RULE_F1 = 1500.0                 # rule_alert = f1 > 1500
COMPOUND_RULE_F1 = 1400.0               # rule_alert = f1 > 1400 or f2 > 100000
COMPOUND_RULE_F2 = 100000.0
ANOMALY_THRESHOLD = 0.70                # suspect = 1 - p(benign) >= 0.70
CONFIDENCE_THRESHOLD = 0.70             # ALERT_HIGH when max probability >= 0.70
ALERT_HIGH, ALERT_LOW, ALERT_NONE = "ALERT_HIGH", "ALERT_LOW", "BENIGN"
SEVERITY_HIGH, SEVERITY_MEDIUM, SEVERITY_NONE = "high", "medium", "none"
# Streaming.
METRICS_WINDOW = "1 minute"
WATERMARK_DELAY = "5 minutes"
MAX_OFFSETS_PER_TRIGGER = 20000
# Random forest.
RF_NUM_TREES, RF_MAX_DEPTH, RF_SEED = 80, 12, 42
# Isolation forest / ensemble.
ISO_TREES, ISO_CONTAMINATION, ISO_MAX_SAMPLES = 200, 0.01, 256
BENIGN_CAP, BENIGN_MIN = 300_000, 10_000
PER_CLASS_CAP = 80_000
LR_MAX_ITER = 2000
GBT_ROUNDS, GBT_DEPTH, GBT_STEP, GBT_SUBSAMPLE = 300, 8, 0.1, 0.8
# ---------------------------------------------------------------------------


def feature_names(n: int = N_FEATURES_DEFAULT) -> list[str]:
    return [f"f{i}" for i in range(n)]


def feature_schema(n: int = N_FEATURES_DEFAULT, prefix_index: bool = False) -> StructType:
    """Headerless capture CSV: n doubles, optionally led by an index column."""
    fields = [StructField("_index", DoubleType(), True)] if prefix_index else []
    fields += [StructField(c, DoubleType(), True) for c in feature_names(n)]
    return StructType(fields)


def labelled_schema(n: int = N_FEATURES_DEFAULT, label: str = "label") -> StructType:
    """Global labelled table: f0..fN-1, label, attack_name."""
    return StructType(
        [StructField(c, DoubleType(), True) for c in feature_names(n)]
        + [StructField(label, IntegerType(), True),
           StructField("attack_name", StringType(), True)])


def raw_event_schema(n: int = N_FEATURES_DEFAULT, label_type=IntegerType()) -> StructType:
    """JSON payload of one event: features, optional label / attack / ts."""
    return StructType(
        [StructField(c, DoubleType(), True) for c in feature_names(n)]
        + [StructField("label", label_type, True),
           StructField("attack_name", StringType(), True),
           StructField("ts", DoubleType(), True)])


METRICS_COLUMNS = ["window_start", "window_end", "fp", "fn", "tp", "tn", "total",
                   "fp_rate", "fn_rate", "attack_true_rate", "attack_pred_rate"]

ENRICHED_COLUMNS = [
    "processing_ts", "event_id", "topic", "kafka_ts", "partition", "offset",
    "raw_input", "model_version", "predicted_attack", "confidence", "p_benign",
    "anomaly_score", "suspect", "rule_alert", "severity", "label", "attack_name",
    "true_class", "is_attack_true", "is_attack_pred", "fp", "fn", "tp", "tn",
]

ENSEMBLE_COLUMNS = ["kafka_ts", "kafka_topic", "kafka_partition", "kafka_offset",
                    "kafka_key", "rule_alert", "iso_score", "iso_is_anom",
                    "pred_lr", "pred_xgb", "pred_final"]
