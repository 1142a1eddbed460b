from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowlab.operators import features
from flowlab.schema import CIC_SCHEMA

SAMPLE = [
    ("2018-02-14 10:30:00", 100, 50, 10000.0, 5000.0, 1000000.0, 100.0, 20.0, 10000.0, 2000.0, 2, 4, 0, 0, "Benign"),
    ("2018-02-14 14:45:00", 200, 100, 20000.0, 10000.0, 2000000.0, 150.0, 30.0, 15000.0, 3000.0, 0, 3, 0, 1, "Bot"),
]
SCHEMA = """`Timestamp` string, `Tot Fwd Pkts` int, `Tot Bwd Pkts` int, `TotLen Fwd Pkts` double,
  `TotLen Bwd Pkts` double, `Flow Duration` double, `Pkt Len Mean` double, `Pkt Len Std` double,
  `Flow IAT Mean` double, `Flow IAT Std` double, `FIN Flag Cnt` int, `SYN Flag Cnt` int,
  `Fwd URG Flags` int, `Bwd URG Flags` int, `Label` string"""


@pytest.fixture
def sample(frame):
    return frame(SAMPLE, SCHEMA)


def test_temporal_golden_values(sample):
    rows = features.temporal_features(sample).collect()
    assert [r.hour_of_day for r in rows] == [10, 14]
    assert [r.minute_of_hour for r in rows] == [30, 45]
    assert [r.day_of_week for r in rows] == [4, 4]
    assert [r.is_business_hours for r in rows] == [1, 1]


@pytest.mark.parametrize("hour,flag", [(8, 0), (9, 1), (17, 1), (18, 0)])
def test_business_hours_borders(frame, hour, flag):
    df = frame([(f"2018-02-14 {hour:02d}:59:00",)], "Timestamp string")
    assert features.temporal_features(df).first().is_business_hours == flag


def test_ratio_golden_values(sample):
    rows = features.ratio_features(sample).collect()
    assert [r.fwd_bwd_pkt_ratio for r in rows] == [2.0, 2.0]
    assert [r.bytes_per_pkt for r in rows] == [100.0, 100.0]
    assert [r.pkt_rate for r in rows] == pytest.approx([150.0, 150.0])


def test_statistical_and_flag_golden_values(sample):
    rows = sample.transform(features.statistical_features).transform(features.flag_features).collect()
    assert [r.pkt_len_cv for r in rows] == [0.2, 0.2]
    assert [r.iat_cv for r in rows] == [0.2, 0.2]
    assert [r.syn_fin_ratio for r in rows] == [2.0, 0.0]
    assert [r.has_urgent_pkts for r in rows] == [0, 1]


def test_engineer_features_drops_time_and_adds_logs(sample):
    out = features.engineer_features(sample)
    assert not {"Timestamp", "ts"} & set(out.columns)
    assert {"Flow Duration_log", "Tot Fwd Pkts_log", "pkt_rate", "hour_of_day"} <= set(out.columns)
    assert "Flow Byts/s_log" not in out.columns


def test_log_of_values_at_or_below_minus_one_is_null(frame):
    out = features.log1p_features(frame([(-2.0,), (-1.0,), (0.0,)], "x double"), ["x"])
    assert [r.x_log for r in out.collect()] == [None, None, 0.0]


def test_day_first_times_parse_and_bad_ones_are_null(frame):
    df = frame([("14/02/2018 08:31:01",), ("never",)], "Timestamp string")
    rows = features.temporal_features(df, formats=["dd/MM/yyyy HH:mm:ss"]).collect()
    assert [r.hour_of_day for r in rows] == [8, None]


def test_ports(frame):
    ports = [80, 443, 22, 20, 465, 53, 23, 139, 3389, 3306, 5432, 1023, 1024, 49151, 49152, None]
    df = frame([(p, p) for p in ports], "dst_port int, src_port int")
    out = df.transform(features.service_flags).transform(features.port_range_onehot).transform(features.src_port_flags)
    rows = {r.dst_port: r for r in out.collect()}
    for port, service in zip(ports, features.SERVICES, strict=False):
        assert rows[port][f"dst_port_{service}"] == 1
    assert rows[1023].dst_port_cat_well_known == 1 and rows[1024].dst_port_cat_registered == 1
    assert rows[49151].dst_port_cat_registered == 1 and rows[49152].dst_port_cat_ephemeral == 1
    assert rows[1023].src_port_is_privileged == 1 and rows[49152].src_port_is_ephemeral == 1
    assert all(v == 0 for c, v in rows[None].asDict().items() if c not in ("dst_port", "src_port"))


def test_protocol_ignores_case_and_null(frame):
    out = features.protocol_onehot(frame([("Tcp",), (None,)], "protocol string")).collect()
    assert [(r.protocol_tcp, r.protocol_udp) for r in out] == [(1, 0), (0, 0)]


def test_label_codes_are_sorted(frame):
    df = frame([("b",), ("a",), (None,), ("c",), ("a",)], "label string")
    codes = features.fit_label_codes(df)
    assert codes == {"a": 0, "b": 1, "c": 2}
    out = features.apply_label_codes(df, codes).agg(F.sum("label_code").alias("s"), F.count("*").alias("n")).first()
    assert (out.s, out.n) == (3, 5)


def test_binary_target_case(frame):
    df = frame([("Benign",), (" BENIGN ",), ("Bot",), (None,)], "label string")
    assert [r.is_attack for r in features.binary_target(df, case_sensitive=True).collect()] == [0, 1, 1, 1]
    assert [r.is_attack for r in features.binary_target(df).collect()] == [0, 0, 1, 1]


def test_schema_has_the_declared_types():
    kinds = [f.dataType.simpleString() for f in CIC_SCHEMA.fields]
    assert (len(kinds), kinds.count("double"), kinds.count("int"), kinds.count("string")) == (80, 54, 24, 2)
