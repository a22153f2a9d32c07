"""DataFrame -> DataFrame operators (batch and streaming alike unless noted)."""

from verdant.operators.decode import accepted, batch_events_with_time, decode_events, rejects  # noqa: F401
from verdant.operators.latest import latest_by_key  # noqa: F401
from verdant.operators.normalize import (  # noqa: F401
    add_source_metadata,
    latest_observation,
    member_or_first,
    normalize_crop_rows,
    normalize_observations,
    valid_events,
)
from verdant.operators.ordinals import number_rows_in_files, split_columns, with_file_ordinals  # noqa: F401
from verdant.operators.serving import (  # noqa: F401
    cap_rows,
    column_sums,
    multi_select,
    reduce_series,
    relative_range,
    table_count,
    table_head,
    time_range,
    weighted_rollup,
    with_band,
)
from verdant.operators.union import union_sources  # noqa: F401
from verdant.operators.windows import (  # noqa: F401
    GREENHOUSE_KEYS,
    SOURCE_KEYS,
    finish_window_sums,
    rollup_window_sums,
    window_metrics,
    window_metrics_by_source,
    window_sums,
)
