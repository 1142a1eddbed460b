"""Declared schemas and column-name sets of the two flow layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names and types of the CIC flow export, in file order (CSV is read by position).
CIC_COLUMNS = """
Dst Port: int
Protocol: int
Timestamp: string
Flow Duration: double
Tot Fwd Pkts: int
Tot Bwd Pkts: int
TotLen Fwd Pkts: double
TotLen Bwd Pkts: double
Fwd Pkt Len Max: double
Fwd Pkt Len Min: double
Fwd Pkt Len Mean: double
Fwd Pkt Len Std: double
Bwd Pkt Len Max: double
Bwd Pkt Len Min: double
Bwd Pkt Len Mean: double
Bwd Pkt Len Std: double
Flow Byts/s: double
Flow Pkts/s: double
Flow IAT Mean: double
Flow IAT Std: double
Flow IAT Max: double
Flow IAT Min: double
Fwd IAT Tot: double
Fwd IAT Mean: double
Fwd IAT Std: double
Fwd IAT Max: double
Fwd IAT Min: double
Bwd IAT Tot: double
Bwd IAT Mean: double
Bwd IAT Std: double
Bwd IAT Max: double
Bwd IAT Min: double
Fwd PSH Flags: int
Bwd PSH Flags: int
Fwd URG Flags: int
Bwd URG Flags: int
Fwd Header Len: int
Bwd Header Len: int
Fwd Pkts/s: double
Bwd Pkts/s: double
Pkt Len Min: double
Pkt Len Max: double
Pkt Len Mean: double
Pkt Len Std: double
Pkt Len Var: double
FIN Flag Cnt: int
SYN Flag Cnt: int
RST Flag Cnt: int
PSH Flag Cnt: int
ACK Flag Cnt: int
URG Flag Cnt: int
CWE Flag Count: int
ECE Flag Cnt: int
Down/Up Ratio: double
Pkt Size Avg: double
Fwd Seg Size Avg: double
Bwd Seg Size Avg: double
Fwd Byts/b Avg: double
Fwd Pkts/b Avg: double
Fwd Blk Rate Avg: double
Bwd Byts/b Avg: double
Bwd Pkts/b Avg: double
Bwd Blk Rate Avg: double
Subflow Fwd Pkts: int
Subflow Fwd Byts: double
Subflow Bwd Pkts: int
Subflow Bwd Byts: double
Init Fwd Win Byts: int
Init Bwd Win Byts: int
Fwd Act Data Pkts: int
Fwd Seg Size Min: int
Active Mean: double
Active Std: double
Active Max: double
Active Min: double
Idle Mean: double
Idle Std: double
Idle Max: double
Idle Min: double
Label: string
"""

_TYPES = {"int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType()}


def get_schema() -> T.StructType:
    """The 80-field CIC schema; every field is nullable."""
    schema = T.StructType()
    for line in CIC_COLUMNS.strip().splitlines():
        name, kind = line.rsplit(": ", 1)
        schema.add(name, _TYPES[kind], True)
    return schema


CIC_SCHEMA = get_schema()


@dataclass(frozen=True)
class FlowNames:
    """Column names the feature operators read; one instance per flow layout."""

    timestamp: str = "Timestamp"
    label: str = "Label"
    duration: str = "Flow Duration"
    fwd_pkts: str = "Tot Fwd Pkts"
    bwd_pkts: str = "Tot Bwd Pkts"
    fwd_bytes: str = "TotLen Fwd Pkts"
    bwd_bytes: str = "TotLen Bwd Pkts"
    byte_rate: str = "Flow Byts/s"
    packet_rate: str = "Flow Pkts/s"
    len_mean: str = "Pkt Len Mean"
    len_std: str = "Pkt Len Std"
    iat_mean: str = "Flow IAT Mean"
    iat_std: str = "Flow IAT Std"
    fin: str = "FIN Flag Cnt"
    syn: str = "SYN Flag Cnt"
    fwd_urg: str = "Fwd URG Flags"
    bwd_urg: str = "Bwd URG Flags"
    dst_port: str = "Dst Port"

    @property
    def skewed(self) -> list[str]:
        """Right-skewed columns that get a log twin."""
        return [self.duration, self.fwd_pkts, self.bwd_pkts, self.fwd_bytes, self.bwd_bytes,
                self.byte_rate, self.packet_rate]


CIC_NAMES = FlowNames()

SNAKE_NAMES = FlowNames(
    timestamp="flow_ts", label="label", duration="flow_duration", fwd_pkts="tot_fwd_pkts",
    bwd_pkts="tot_bwd_pkts", fwd_bytes="totlen_fwd_pkts", bwd_bytes="totlen_bwd_pkts",
    byte_rate="flow_byts_s", packet_rate="flow_pkts_s", len_mean="pkt_len_mean",
    len_std="pkt_len_std", iat_mean="flow_iat_mean", iat_std="flow_iat_std",
    fin="fin_flag_cnt", syn="syn_flag_cnt", fwd_urg="fwd_urg_flags", bwd_urg="bwd_urg_flags",
    dst_port="dst_port",
)
