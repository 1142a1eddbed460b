"""Feature engineering: projections only, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlab.functions import (
    any_positive,
    bytes_per_packet,
    coef_variation,
    packet_rate,
    present,
    safe_ratio,
)
from flowlab.operators.cleaning import drop_identifiers
from flowlab.schema import CIC_NAMES, FlowNames

# Destination services and their ports.
SERVICES = {
    "http": (80, 8080, 8000, 8888),
    "https": (443,),
    "ssh": (22,),
    "ftp": (20, 21),
    "smtp": (25, 587, 465),
    "dns": (53,),
    "telnet": (23,),
    "smb": (139, 445),
    "rdp": (3389,),
    "mysql": (3306,),
    "postgres": (5432,),
}
PROTOCOLS = ("tcp", "udp", "icmp")
FIRST_REGISTERED_PORT = 1024
FIRST_EPHEMERAL_PORT = 49152


def parsed_time(df: DataFrame, ts: str, formats: Sequence[str] = ()):
    """The time column, parsed when it is text; text that does not parse gives null."""
    if not isinstance(df.schema[ts].dataType, T.StringType):
        return F.col(ts)
    tries = [F.try_to_timestamp(F.col(ts), F.lit(f)) for f in formats]
    return F.coalesce(*tries, F.try_to_timestamp(F.col(ts)))


def temporal_features(df: DataFrame, ts: str = "Timestamp", formats: Sequence[str] = ()) -> DataFrame:
    """Hour, weekday (Sunday is 1), minute and the business-hours flag (9 to 17 inclusive)."""
    when = parsed_time(df, ts, formats)
    hour = F.hour(when)
    return df.withColumns({
        "ts": when,
        "hour_of_day": hour,
        "day_of_week": F.dayofweek(when),
        "minute_of_hour": F.minute(when),
        "is_business_hours": F.when(hour.between(9, 17), 1).otherwise(0),
    })


def ratio_features(df: DataFrame, names: FlowNames = CIC_NAMES) -> DataFrame:
    n = names
    return df.withColumns({
        "fwd_bwd_pkt_ratio": safe_ratio(n.fwd_pkts, n.bwd_pkts),
        "bytes_per_pkt": bytes_per_packet(n.fwd_bytes, n.bwd_bytes, n.fwd_pkts, n.bwd_pkts),
        "pkt_rate": packet_rate(n.fwd_pkts, n.bwd_pkts, n.duration),
    })


def statistical_features(df: DataFrame, names: FlowNames = CIC_NAMES) -> DataFrame:
    return df.withColumns({
        "pkt_len_cv": coef_variation(names.len_std, names.len_mean),
        "iat_cv": coef_variation(names.iat_std, names.iat_mean),
    })


def flag_features(df: DataFrame, names: FlowNames = CIC_NAMES) -> DataFrame:
    return df.withColumns({
        "syn_fin_ratio": safe_ratio(names.syn, names.fin),
        "has_urgent_pkts": any_positive(names.fwd_urg, names.bwd_urg),
    })


def log1p_features(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``<column>_log`` for each listed column that exists; null where x <= -1."""
    cols = CIC_NAMES.skewed if cols is None else cols
    return df.withColumns({f"{c}_log": F.log1p(F.col(c)) for c in cols if c in df.columns})


def engineer_features(
    df: DataFrame, names: FlowNames = CIC_NAMES, formats: Sequence[str] = ()
) -> DataFrame:
    """All flow features; the time columns are dropped at the end."""
    return (
        df.transform(temporal_features, names.timestamp, formats)
        .transform(ratio_features, names)
        .transform(statistical_features, names)
        .transform(flag_features, names)
        .transform(log1p_features, names.skewed)
        .transform(drop_identifiers, (names.timestamp, "ts"))
    )


def service_flags(
    df: DataFrame, port: str = "dst_port", services: Mapping[str, Sequence[int]] = SERVICES
) -> DataFrame:
    """One 0/1 column per destination service; a null port is in none."""
    return df.withColumns({
        f"dst_port_{name}": F.coalesce(F.col(port).isin(*ports), F.lit(False)).cast("int")
        for name, ports in services.items()
    })


def _flag(condition):
    return F.coalesce(condition, F.lit(False)).cast("int")


def port_range_onehot(df: DataFrame, port: str = "dst_port") -> DataFrame:
    p = F.col(port)
    return df.withColumns({
        "dst_port_cat_well_known": _flag(p < FIRST_REGISTERED_PORT),
        "dst_port_cat_registered": _flag((p >= FIRST_REGISTERED_PORT) & (p < FIRST_EPHEMERAL_PORT)),
        "dst_port_cat_ephemeral": _flag(p >= FIRST_EPHEMERAL_PORT),
    })


def src_port_flags(df: DataFrame, port: str = "src_port") -> DataFrame:
    return df.withColumns({
        "src_port_is_privileged": _flag(F.col(port) < FIRST_REGISTERED_PORT),
        "src_port_is_ephemeral": _flag(F.col(port) >= FIRST_EPHEMERAL_PORT),
    })


def protocol_onehot(
    df: DataFrame, protocol: str = "protocol", values: Sequence[str] = PROTOCOLS
) -> DataFrame:
    """Case-insensitive one-hot; null is in none."""
    return df.withColumns({
        f"protocol_{v}": _flag(F.upper(F.col(protocol)) == v.upper()) for v in values
    })


def connection_features(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Port and protocol encodings of the text layout; their source columns are dropped."""
    return (
        df.transform(service_flags)
        .transform(port_range_onehot)
        .transform(src_port_flags)
        .transform(protocol_onehot)
        .drop(*[c for c in ("dst_port", "src_port", "protocol") if c not in keep])
    )


def binary_target(
    df: DataFrame,
    label: str = "label",
    benign: str = "Benign",
    case_sensitive: bool = False,
    out: str = "is_attack",
) -> DataFrame:
    """0 for benign, 1 for anything else, null label included.

    Case-sensitive compares the raw text; otherwise text is trimmed and lowered first.
    """
    text, want = F.col(label), benign
    if not case_sensitive:
        text, want = F.lower(F.trim(text)), benign.lower()
    return df.withColumn(out, F.when(text == want, 0).otherwise(1))


MAX_CLASSES = 10_000


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class. A label column with more than MAX_CLASSES classes is an error."""
    rows = df.groupBy(label).agg(F.count("*").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return {r[0]: r[1] for r in rows}


def fit_label_codes(df: DataFrame, label: str = "label") -> dict[str, int]:
    """Sorted distinct labels numbered from 0; null is no class."""
    names = sorted(name for name in class_counts(df, label) if name is not None)
    return {name: code for code, name in enumerate(names)}


def codes_frame(spark: SparkSession, codes: Mapping[str, int], label: str, out: str) -> DataFrame:
    return spark.createDataFrame(list(codes.items()), f"`{label}` string, `{out}` int")


def apply_label_codes(
    df: DataFrame, codes: Mapping[str, int], label: str = "label", out: str = "label_code"
) -> DataFrame:
    """Attach the code; an unknown or null label gets null. At most MAX_CLASSES rows are broadcast."""
    small = codes_frame(df.sparkSession, codes, label, out)
    return df.join(F.broadcast(small), label, "left").select(*df.columns, out)


def invalid_rows(df: DataFrame, cols: Sequence[str]):
    """Condition: any of the columns is missing or infinite."""
    bad = F.lit(False)
    for c in cols:
        x = present(df, c).cast("double")
        bad = bad | x.isNull() | (F.abs(x) == float("inf"))
    return bad
