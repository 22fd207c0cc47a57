"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import os
import string
import tempfile
import zipfile
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: White space of the word rules: space and \x09-\x0D, as a regular-expression class.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files every executor reaches, so a lost executor
    costs its own tasks only, and a result used by several branches is
    computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda's variable)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(col: Column) -> Column:
    """``col`` with A-Z lower-cased and every other character as it is."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def own_names_aside(op: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For operators that return their table's own columns: columns whose names
    the operator uses itself (``__cf_...``), or that need quoting (a dot, a
    backtick), are called otherwise while it runs and come out as they were."""
    @functools.wraps(op)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        odd = [c for c in docs.columns if c.lower().startswith("__cf_") or "." in c or "`" in c]
        if not odd:
            return op(docs, *args, **kwargs)
        prefix = "aside_"
        while any(c.lower().startswith(prefix) for c in docs.columns):
            prefix += "_"
        names = {c: f"{prefix}{k}" for k, c in enumerate(odd)}

        def named(x):
            return names.get(x, x) if isinstance(x, str) else x

        out = op(docs.toDF(*[named(c) for c in docs.columns]), *map(named, args), **{k: named(v) for k, v in kwargs.items()})
        back = {v: k for k, v in names.items()}
        return out.toDF(*[back.get(c, c) for c in out.columns])
    return run


_SHIPPED = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application
    (Spark's own file distribution; nothing to install or to set there)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)
