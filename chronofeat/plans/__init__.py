"""Execution plans: historical retrieval and materialization."""

from .snapshot import (  # noqa: F401
    get_online_features,
    materialize,
    merge_snapshots,
    persist,
    pull_all_from_table_or_query,
    pull_latest_from_table_or_query,
    view_latest,
)
from .retrieval import (  # noqa: F401
    feature_projection,
    get_historical_features,
    prepare_entity_df,
    prepare_view_source,
    retrieval_metadata,
    spine_time_bounds,
)
