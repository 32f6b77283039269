"""Schema changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The type changes that lose nothing.
WIDENINGS = {("int", "bigint"), ("float", "double")}


def missing_columns(
    inferred: list[tuple[str, str]], existing: list[str]
) -> list[tuple[str, str]]:
    """Columns of a file that the table does not have yet, in file order."""
    known = {name.lower() for name in existing}
    return [(name, t) for name, t in inferred if name not in known]


def united(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames; a column that a frame lacks reads as NULL there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def reconcile(
    df: DataFrame,
    drop: list[str] | None = None,
    rename: dict[str, str] | None = None,
    widen: dict[str, str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Drop, rename, widen (int to bigint, float to double) and reorder columns in one projection.

    ``drop``, ``rename`` and ``widen`` use the old names, ``order`` the new ones; columns that
    ``order`` leaves out keep their place behind it.
    """
    rename, widen, dropped = rename or {}, widen or {}, set(drop or [])
    types = dict(df.dtypes)
    out: dict[str, Column] = {}
    for name in df.columns:
        if name in dropped:
            continue
        value = F.col(name)
        if name in widen:
            if (types[name], widen[name]) not in WIDENINGS:
                raise ValueError(f"cannot widen {name} from {types[name]} to {widen[name]}")
            value = value.cast(widen[name])
        new_name = rename.get(name, name)
        out[new_name] = value.alias(new_name)
    first = order or []
    rest = [n for n in out if n not in first]
    return df.select(*[out[n] for n in [*first, *rest]])
