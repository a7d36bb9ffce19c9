"""Column expressions shared by the operators."""

from flowlake.functions.columns import (  # noqa: F401
    content_hash,
    is_nonfinite,
    join_flag_names,
    json_payload,
    label_display,
    map_lookup,
    positive_probability,
    replace_nonfinite,
    round_probability,
    safe_ratio,
    snap,
)
