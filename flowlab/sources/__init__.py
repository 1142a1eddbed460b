"""Sources and sinks."""

from flowlab.sources.readers import (  # noqa: F401
    combine,
    from_json_flows,
    read_flows_csv,
    read_scoring_csv,
    read_table,
    to_json_flows,
)
from flowlab.sources.writers import write_csv, write_json, write_parquet, write_splits  # noqa: F401
from flowlab.sources.bucketed import read_bucketed, write_bucketed  # noqa: F401
from flowlab.sources.lines import count_lines, slice_lines  # noqa: F401
