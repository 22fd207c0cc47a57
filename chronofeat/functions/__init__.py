"""Column-level helpers: time normalization and on-demand transforms."""

from .timecols import (  # noqa: F401
    bucket_of,
    epoch_micros,
    is_time_type,
    micros_literal,
    python_to_micros,
    to_instant,
    ttl_micros,
)
