"""The ``flows`` relation: network-flow columns derived from the ``events`` table.

One SQL text serves Spark and the check engine, so both read identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FLOWS_SQL = """
WITH b AS (SELECT event_id, ts, user_id, event_type, value,
                  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM {events})
SELECT event_id AS flow_id, ts AS flow_ts, user_id AS src_id,
  CASE k % 12 WHEN 0 THEN 80 WHEN 1 THEN 443 WHEN 2 THEN 22 WHEN 3 THEN 21 WHEN 4 THEN 587 WHEN 5 THEN 53
              WHEN 6 THEN 23 WHEN 7 THEN 445 WHEN 8 THEN 3389 WHEN 9 THEN 3306 WHEN 10 THEN 5432 ELSE 49152 + k END AS dst_port,
  CAST(event_id * 37 % 65536 AS INT) AS src_port,
  CASE WHEN event_type IN ('click','view') THEN 'tcp' WHEN event_type = 'error' THEN 'ICMP' ELSE 'UDP' END AS protocol,
  CASE WHEN k % 10 = 0 THEN 0e0 ELSE value * 1e4 END AS flow_duration,
  k AS tot_fwd_pkts, (k * 7) % 13 AS tot_bwd_pkts,
  value * k AS totlen_fwd_pkts, value * ((k * 7) % 13) AS totlen_bwd_pkts,
  CASE WHEN k % 9 = 0 THEN 0e0 ELSE value END AS pkt_len_mean, value / (1 + k % 5) AS pkt_len_std,
  CASE WHEN k % 14 = 0 THEN 0e0 ELSE value * 3e0 END AS flow_iat_mean, value / (1 + k % 3) AS flow_iat_std,
  k % 3 AS fin_flag_cnt, k % 4 AS syn_flag_cnt,
  CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END AS fwd_urg_flags, CASE WHEN k % 31 = 0 THEN 1 ELSE 0 END AS bwd_urg_flags,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN CAST('NaN' AS DOUBLE) WHEN k % 17 = 0 THEN CAST('Infinity' AS DOUBLE)
       WHEN k % 19 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS flow_byts_s,
  CASE WHEN k % 16 = 0 THEN 'not a complete handshake' ELSE CAST(k AS VARCHAR(10)) END AS delta_start,
  CASE WHEN k % 37 = 0 THEN NULL WHEN event_type <> 'error' THEN CASE WHEN k % 5 = 0 THEN ' BENIGN ' ELSE 'Benign' END
       WHEN k % 3 = 0 THEN 'Bot' WHEN k % 3 = 1 THEN ' DoS' ELSE 'Infiltration' END AS label
FROM b
"""


def flows_from(events: DataFrame) -> DataFrame:
    """Flow columns over an events frame, batch or streaming."""
    return events.sparkSession.sql(FLOWS_SQL, events=events)


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_from(spark.read.parquet(f"{sf_dir}/events.parquet"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_flows(query: str) -> str:
    """Oracle text: ``query`` with ``flows`` defined in front of it."""
    query = query.strip()
    head = f"WITH flows AS ({FLOWS_SQL.format(events='events').strip()})"
    if query[:5].upper() == "WITH ":
        return f"{head}, {query[5:]}"
    return f"{head} {query}"


# Flows with a trimmed label and the binary target, null labels removed.
LABELED_SQL = """
labeled AS (SELECT * REPLACE (trim(label) AS label),
                   CASE WHEN lower(trim(label)) = 'benign' THEN 0 ELSE 1 END AS is_attack,
                   trim(label) AS attack_type
            FROM flows WHERE label IS NOT NULL)"""

# A deterministic prediction table with heavy score ties.
SCORED_SQL = LABELED_SQL + """,
scored AS (SELECT flow_id, flow_ts, src_id, attack_type, is_attack, tot_fwd_pkts / 100e0 AS p,
                  CASE WHEN tot_fwd_pkts / 100e0 >= 0.5e0 THEN 1 ELSE 0 END AS prediction
           FROM labeled)"""


def with_labeled(query: str) -> str:
    return with_flows(f"WITH {LABELED_SQL.strip()} {query.strip()}"
                      if query.strip()[:5].upper() != "WITH "
                      else f"WITH {LABELED_SQL.strip()}, {query.strip()[5:]}")


def with_scored(query: str) -> str:
    query = query.strip()
    if query[:5].upper() == "WITH ":
        return with_flows(f"WITH {SCORED_SQL.strip()}, {query[5:]}")
    return with_flows(f"WITH {SCORED_SQL.strip()} {query}")
