"""Definitions: data sources, feature views, projections and feature references.

Everything here is plain, immutable metadata.  No Spark work happens in this
module; readers live in :mod:`chronofeat.sources` and the execution plans in
:mod:`chronofeat.plans`.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import timedelta
from typing import Any, Iterable, Mapping, Optional, Sequence, Union

# Fixed values shared with the feature-store conventions this engine follows.
DEFAULT_EVENT_TIMESTAMP_COL = "event_timestamp"
DUMMY_ENTITY_ID = "__dummy_id"
DUMMY_ENTITY_VAL = ""
FULL_NAME_SEPARATOR = "__"


def _frozen_map(m: Optional[Mapping[str, str]]) -> tuple:
    return tuple(sorted((m or {}).items()))


@dataclass(frozen=True, kw_only=True)
class DataSource:
    """Common part of every source.

    ``timestamp_field`` is the event time of a row, ``created_timestamp_column``
    (optional) the time the row was written; it outranks the event time when
    picking the latest row.  ``field_mapping`` renames raw columns
    (simultaneously) before anything else looks at them.

    ``date_partition_column`` alone only names a column.  With
    ``date_partition_grain`` (``"day"``, ``"month"`` or ``"year"``) its value
    is declared to be the period of the row's event time, and reads bounded
    in time skip the partitions of other periods.

    ``timestamp_text="iso"`` declares that a text time column begins with
    ``yyyy-MM-dd`` (four, two and two digits) in every row, so that its texts
    sort as its days do and reads bounded in time can skip row groups.
    """

    timestamp_field: str
    created_timestamp_column: Optional[str] = None
    field_mapping: tuple = ()
    date_partition_column: Optional[str] = None
    date_partition_grain: Optional[str] = None
    timestamp_text: Optional[str] = None
    name: str = ""
    description: str = ""
    tags: tuple = ()
    owner: str = ""

    def __post_init__(self):
        if self.date_partition_grain not in (None, "day", "month", "year"):
            raise ValueError(f"unknown date_partition_grain {self.date_partition_grain!r}")
        if self.timestamp_text not in (None, "iso"):
            raise ValueError(f"unknown timestamp_text {self.timestamp_text!r}")
        if isinstance(self.field_mapping, Mapping):
            object.__setattr__(self, "field_mapping", _frozen_map(self.field_mapping))
        if isinstance(self.tags, Mapping):
            object.__setattr__(self, "tags", _frozen_map(self.tags))

    @property
    def mapping(self) -> dict:
        return dict(self.field_mapping)


@dataclass(frozen=True, kw_only=True)
class FileSource(DataSource):
    path: str
    s3_endpoint_override: Optional[str] = None


@dataclass(frozen=True, kw_only=True)
class ParquetSource(FileSource):
    """Parquet file or dataset directory."""


@dataclass(frozen=True, kw_only=True)
class CsvSource(FileSource):
    """CSV files.  ``schema`` (DDL string) gives typed columns without an
    inference pass; without it every column is read as a string and only the
    timestamp columns are parsed (``infer_schema=True`` asks Spark to infer,
    which costs one extra pass over the data).

    ``bad_rows`` says what happens to rows that do not fit ``schema`` (a value
    of another type, too many or too few fields): ``"fail"`` (default) ends the
    read with an error that quotes the row, ``"null"`` keeps them with NULL for
    what cannot be read, ``"drop"`` leaves them out;
    :func:`chronofeat.sources.read_csv_with_rejects` gives those it leaves out.
    With ``"fail"`` and ``"null"`` a row is judged by the columns that a query
    needs, with ``"drop"`` as a whole."""

    delimiter: str = ","
    header: bool = True
    schema: Optional[str] = None
    infer_schema: bool = False
    timestamp_format: Optional[str] = None
    escape: str = "\\"
    bad_rows: str = "fail"

    def __post_init__(self):
        super().__post_init__()
        if self.bad_rows not in ("fail", "null", "drop"):
            raise ValueError(f"unknown bad_rows {self.bad_rows!r}")


@dataclass(frozen=True, kw_only=True)
class DeltaSource(FileSource):
    """Delta table directory (needs the Delta connector on the classpath).

    ``range_join`` (seconds) is the bucket width of the as-of join."""

    range_join: Optional[int] = None


@dataclass(frozen=True, kw_only=True)
class IcebergSource(FileSource):
    """Iceberg table; ``path`` is a catalog table name or a table location."""

    range_join: Optional[int] = None


@dataclass(frozen=True, kw_only=True)
class BucketedTableSource(DataSource):
    """A catalog table that :func:`chronofeat.sources.write_bucketed` wrote:
    bucketed by entity keys, sorted by keys and time.  As-of joins on exactly
    those keys read it without shuffling it."""

    table: str


@dataclass(frozen=True, kw_only=True, eq=False)
class DataFrameSource(DataSource):
    """A source that is already a (lazy) Spark DataFrame, e.g. a filtered or
    derived view of a table.  Filters on it still reach the underlying scan."""

    df: Any


AnySource = Union[DataSource, FileSource]


@dataclass(frozen=True)
class Entity:
    """A named entity whose source column is ``join_key`` (default: its name)."""

    name: str
    join_key: Optional[str] = None


@dataclass(frozen=True)
class Field:
    name: str
    dtype: Optional[str] = None


@dataclass(frozen=True, kw_only=True)
class FeatureView:
    """A set of features read from one source and joined on ``entities``.

    ``ttl``: ``None`` or zero means no time bound at all (latest row overall,
    future rows included); otherwise the feature row must satisfy
    ``event_ts - ttl <= ts <= event_ts`` (both ends inclusive).
    ``projection_name`` / ``join_key_map`` form the projection used to join the
    same view in several roles.
    """

    name: str
    source: Any
    entities: tuple = ()
    ttl: Optional[timedelta] = None
    schema: tuple = ()
    online: bool = True
    tags: tuple = ()
    projection_name: Optional[str] = None
    join_key_map: tuple = ()

    def __post_init__(self):
        # views work with the entities' join keys
        object.__setattr__(self, "entities", tuple(
            (e.join_key or e.name) if isinstance(e, Entity) else e for e in (self.entities or ())))
        object.__setattr__(self, "schema", tuple(
            f if isinstance(f, Field) else Field(f) for f in (self.schema or ())))
        if isinstance(self.join_key_map, Mapping):
            object.__setattr__(self, "join_key_map", _frozen_map(self.join_key_map))
        if isinstance(self.tags, Mapping):
            object.__setattr__(self, "tags", _frozen_map(self.tags))
        if self.ttl is not None and not isinstance(self.ttl, timedelta):
            object.__setattr__(self, "ttl", timedelta(seconds=float(self.ttl)))

    # -- projection -------------------------------------------------------
    def name_to_use(self) -> str:
        return self.projection_name or self.name

    def with_name(self, name: str) -> "FeatureView":
        return replace(self, projection_name=name)

    def with_join_key_map(self, mapping: Mapping[str, str]) -> "FeatureView":
        return replace(self, join_key_map=_frozen_map(mapping))

    @property
    def key_map(self) -> dict:
        return dict(self.join_key_map)

    @property
    def join_keys(self) -> list:
        """Join keys as spine column names (after the projection's key map)."""
        m = self.key_map
        return [m.get(k, k) for k in self.entities]

    @property
    def feature_names(self) -> list:
        keys = set(self.entities)
        return [f.name for f in self.schema if f.name not in keys]

    @property
    def ttl_seconds(self) -> Optional[float]:
        if self.ttl is None:
            return None
        s = self.ttl.total_seconds()
        return s if s != 0 else None


@dataclass(frozen=True)
class OnDemandFeatureView:
    """Derived columns computed on the retrieved rows.

    ``transform`` is either a function ``DataFrame -> DataFrame`` built from
    column expressions (preferred: stays in the JVM) or, with ``pandas=True``,
    a function ``pandas.DataFrame -> pandas.DataFrame`` run with
    ``mapInPandas``; then ``output_schema`` (DDL of the added columns) is
    required.  ``features`` lists its inputs as ``"view:feature"`` refs; they
    are retrieved with it and stay in the result.
    """

    name: str
    transform: Any
    features: tuple = ()
    pandas: bool = False
    output_schema: Optional[str] = None


def parse_feature_ref(ref: Union[str, tuple]) -> tuple:
    """``"view:feature"`` -> ``("view", "feature")``."""
    if isinstance(ref, tuple):
        return ref
    if ":" not in ref:
        raise ValueError(f"feature reference {ref!r} is not of the form 'view:feature'")
    view, feat = ref.split(":", 1)
    return view, feat


def group_feature_refs(refs: Iterable, views: Sequence[FeatureView],
                       on_demand: Sequence[OnDemandFeatureView] = ()) -> tuple:
    """Resolve references to ``[(view, [features])]`` in request order, plus
    the on-demand views requested."""
    by_name = {}
    for v in views:
        by_name.setdefault(v.name_to_use(), v)
        by_name.setdefault(v.name, v)
    od_names = {o.name: o for o in on_demand}
    order: list = []
    feats: dict = {}
    ods: list = []
    work = list(refs)
    for r in work:
        vn, f = parse_feature_ref(r)
        if vn in od_names:
            if od_names[vn] not in ods:
                ods.append(od_names[vn])
                work += od_names[vn].features       # its inputs, after what was asked for
            continue
        if vn not in by_name:
            raise ValueError(f"feature view {vn!r} is not defined")
        v = by_name[vn]
        if v.schema and f not in {fl.name for fl in v.schema}:
            raise ValueError(f"feature {f!r} is not in the schema of view {vn!r}")
        if v not in feats:
            order.append(v)
            feats[v] = []
        if f not in feats[v]:
            feats[v].append(f)
    return [(v, feats[v]) for v in order], ods
