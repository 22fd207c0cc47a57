"""DataFrame operators: frame operators and the point-in-time join."""

from .frame import (  # noqa: F401
    add_static_column,
    columns_list,
    detect_event_timestamp_column,
    drop_columns,
    drop_df_duplicates,
    drop_duplicates_keep_last,
    event_timestamp_range,
    filter_time_range,
    filter_ttl,
    join_left,
    keep_latest,
    rename_columns,
    select_columns,
    select_dtypes_columns,
    sort_columns,
    sort_positions,
    sort_values,
    with_sort_position,
)
from .asof import (  # noqa: F401,E402
    AsofPass,
    AsofPlanStats,
    AsofView,
    asof_plan_stats,
    point_in_time_join,
    point_in_time_join_many,
    point_in_time_join_passes,
)
