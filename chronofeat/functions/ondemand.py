"""On-demand feature views: derived columns over the retrieved rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..model import OnDemandFeatureView


def apply_on_demand(df: DataFrame, odfv: OnDemandFeatureView) -> DataFrame:
    """Apply one on-demand view.

    Column-expression transforms (``DataFrame -> DataFrame``) stay in the JVM
    and in whole-stage codegen.  A pandas transform runs batch-wise through
    Arrow with ``mapInPandas``, partition by partition, never on the driver."""
    if not odfv.pandas:
        return odfv.transform(df)
    if not odfv.output_schema:
        raise ValueError(f"on-demand view {odfv.name!r}: a pandas transform needs output_schema")
    added = T.StructType.fromDDL(odfv.output_schema)
    if not isinstance(added, T.StructType):
        raise ValueError("output_schema must describe the added columns as a struct")
    schema = T.StructType(list(df.schema.fields) + list(added.fields))
    fn = odfv.transform

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema=schema)
