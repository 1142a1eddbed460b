"""Column functions: no DataFrame, no action, JVM expressions only."""

from flowlab.functions.columns import (  # noqa: F401
    any_positive,
    bytes_per_packet,
    coef_variation,
    finite,
    hash_hex,
    hash_uniform,
    is_missing,
    packet_rate,
    present,
    safe_ratio,
)
