"""chronofeat: point-in-time feature retrieval and materialization on Spark."""

from .model import (  # noqa: F401
    DEFAULT_EVENT_TIMESTAMP_COL,
    DUMMY_ENTITY_ID,
    DUMMY_ENTITY_VAL,
    BucketedTableSource,
    CsvSource,
    DataFrameSource,
    DataSource,
    DeltaSource,
    Entity,
    FeatureView,
    Field,
    IcebergSource,
    OnDemandFeatureView,
    ParquetSource,
    parse_feature_ref,
)
from .plans import (  # noqa: F401
    get_historical_features,
    get_online_features,
    materialize,
    merge_snapshots,
    persist,
    prepare_entity_df,
    pull_all_from_table_or_query,
    pull_latest_from_table_or_query,
)
from .store import FeatureStore  # noqa: F401,E402
