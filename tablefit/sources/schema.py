"""Schema introspection and repair."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType


def rename_strict(df: DataFrame, mapping: Mapping[str, str | Iterable[str]],
                  missing_ok: bool = False) -> DataFrame:
    """Rename columns; fail on an absent source column.

    ``withColumnRenamed`` silently ignores an absent (or differently cased)
    name, which only surfaces later as an unresolved column.  A value of the
    mapping may also be a list of accepted source spellings for one target,
    e.g. ``{"label": ["DEFAULT", "default.payment.next.month"]}``: the key is
    the target name then.
    """
    present = {c.lower(): c for c in df.columns}
    if len(present) < len(df.columns):
        raise ValueError(f"column names that differ only by case: {df.columns}")
    renames: dict[str, str] = {}
    for src, dst in mapping.items():
        if isinstance(dst, str):
            candidates, target = [src], dst
        else:
            candidates, target = list(dst), src
        hit = next((present[c.lower()] for c in candidates if c.lower() in present), None)
        if hit is None:
            if missing_ok:
                continue
            raise KeyError(f"cannot rename {candidates} -> {target!r}: no such column in {df.columns}")
        renames[hit] = target
    after = [renames.get(c, c).lower() for c in df.columns]
    if len(set(after)) < len(after):
        raise ValueError(f"renaming {renames} makes two columns of one name")
    if not renames:
        return df
    # one projection: renames that hand a name on (a -> b, b -> c) must not be chained
    return df.select(*[F.col("`" + c.replace("`", "``") + "`").alias(renames.get(c, c)) for c in df.columns])


def schema_frame(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df.schema`` as a frame ``(position, column, type, nullable)``; metadata only."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def numeric_columns(schema: StructType, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns of a schema, minus ``exclude`` (label, keys, categoricals).

    Unlike "all columns minus label minus categoricals", a stray string column
    cannot slip into the numeric list.
    """
    skip = set(exclude)
    return [f.name for f in schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]


def column_roles(df: DataFrame, label: str, categorical: Iterable[str] = (),
                 ids: Iterable[str] = ()) -> dict[str, list[str]]:
    """Split the columns of ``df`` into id / label / categorical / numeric / other."""
    categorical = list(categorical)
    ids = list(ids)
    numeric = numeric_columns(df.schema, exclude=[label, *categorical, *ids])
    taken = {label, *categorical, *ids, *numeric}
    return {
        "id": ids,
        "label": [label],
        "categorical": categorical,
        "numeric": numeric,
        "other": [c for c in df.columns if c not in taken],
    }


def suffixed(names: Iterable[str], suffix: str) -> list[str]:
    return [f"{n}{suffix}" for n in names]


def cast_like(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the fields of ``schema`` from ``df`` by name, cast to its types
    (schema repair after an inferred load)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
