"""Schema shaping: flattening, renames, typed defaults, wide and long forms."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    NullType,
    StructType,
)


def _struct_at(schema: StructType, path: str) -> StructType | None:
    found: DataType = schema
    for step in path.split("."):
        if not isinstance(found, StructType) or step not in found.fieldNames():
            return None
        found = found[step].dataType
    return found if isinstance(found, StructType) else None


def flatten_struct(df: DataFrame, path: str, *, prefix: str = "", skip: Sequence[str] = ()) -> DataFrame:
    """Lift the fields of a struct to the top level in one projection.

    A field is left where it is when its plain or prefixed name is already a
    column, so earlier flattenings win.
    """
    struct = _struct_at(df.schema, path)
    if struct is None:
        return df
    taken = set(df.columns)
    lifted = [
        F.col(f"{path}.`{f}`").alias(prefix + f)
        for f in struct.fieldNames()
        if f not in skip and f not in taken and prefix + f not in taken
    ]
    return df.select("*", *lifted)


def extract_json_paths(df: DataFrame, source: str, paths: Mapping[str, str]) -> DataFrame:
    """Text values at JSON paths of a struct or JSON-text column.

    A path that the struct schema has is read as a field; the rest goes
    through JSON. Columns that exist already are kept.
    """
    wanted = {name: path for name, path in paths.items() if name not in df.columns}
    if source not in df.columns:
        return df.withColumns({name: F.lit(None).cast("string") for name in wanted})
    kind = df.schema[source].dataType
    text = F.col(source) if kind.typeName() == "string" else F.to_json(source)
    added = {}
    for name, path in wanted.items():
        steps = path.removeprefix("$.").split(".")
        parent = _struct_at(df.schema, ".".join([source, *steps[:-1]]))
        if parent is not None and steps[-1] in parent.fieldNames() and not isinstance(parent[steps[-1]].dataType, StructType):
            added[name] = F.col(".".join([source, *steps])).cast("string")
        else:
            added[name] = F.get_json_object(text, path)
    return df.withColumns(added)


def ensure_columns(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns})


def with_defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add absent columns as constants."""
    return df.withColumns({c: F.lit(v) for c, v in values.items() if c not in df.columns})


def coalesce_columns(df: DataFrame, target: str, sources: Sequence[str]) -> DataFrame:
    """Add ``target`` from the sources that exist, unless it is there already."""
    present = [F.col(c) for c in sources if c in df.columns]
    if target in df.columns or not present:
        return df
    return df.withColumn(target, F.coalesce(*present))


def normalize_names(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``rule``; names starting with ``_`` are metadata and stay."""
    return df.withColumnsRenamed({c: rule(c) for c in df.columns if not c.startswith("_")})


def conform_names(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename old columns; an old column is dropped when its new name is taken."""
    renames, surplus, taken = {}, [], set(df.columns)
    for old, new in mapping.items():
        if old not in df.columns or old == new:
            continue
        if new in taken:
            surplus.append(old)
        else:
            renames[old] = new
            taken.add(new)
    return df.drop(*surplus).withColumnsRenamed(renames)


def cast_columns(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast the columns that exist; values that do not fit become null."""
    casts = {c: F.col(c).cast("string").try_cast(t) if t == "date" and df.schema[c].dataType.typeName() == "string" else F.col(c).try_cast(t) for c, t in kinds.items() if c in df.columns}
    return df.withColumns(casts)


def project_existing(df: DataFrame, columns: Sequence[str], prefixes: Sequence[str] = ()) -> DataFrame:
    """Ordered projection of the wanted columns that exist, then any by prefix."""
    kept = [c for c in columns if c in df.columns]
    kept += [c for c in df.columns if c not in kept and c.startswith(tuple(prefixes))] if prefixes else []
    return df.select(*kept)


def drop_null_typed(df: DataFrame) -> DataFrame:
    """Drop columns that never got a type."""
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, NullType)])


def widen_map(df: DataFrame, source: str, names: Mapping[str, str], kind: str = "double") -> DataFrame:
    """Map keys (or struct fields) to named columns; a missing key is null."""
    struct = _struct_at(df.schema, source)
    if struct is not None:
        have = struct.fieldNames()
        wide = {n: F.col(f"{source}.`{k}`").cast(kind) if k in have else F.lit(None).cast(kind) for k, n in names.items()}
    else:
        wide = {n: F.col(source).getItem(k).cast(kind) for k, n in names.items()}
    return df.withColumns(wide).drop(source)


def pack_map(columns: Mapping[str, Column], default: int = 0) -> Column:
    """Columns to one map, nulls as ``default``."""
    entries = [part for key, c in columns.items() for part in (F.lit(key), F.coalesce(c.cast("int"), F.lit(default)))]
    return F.create_map(*entries)


def unpivot_measures(df: DataFrame, ids: Sequence[str], measures: Mapping[str, Column], label: str, value: str) -> DataFrame:
    """Long form: one row per id and labelled expression."""
    wide = df.select(*ids, *[c.alias(name) for name, c in measures.items()])
    return wide.unpivot([*ids], [f"`{m}`" for m in measures], label, value)


def pivot_measures(df: DataFrame, ids: Sequence[str], column: str, values: Sequence[str], measure: Column) -> DataFrame:
    """Wide form with an explicit value list, so no extra pass finds the values."""
    return df.groupBy(*ids).pivot(column, list(values)).agg(measure)


def one_hot(
    df: DataFrame, column: str, rule: Callable[[str], str], prefix: str = "cat_", labels: Sequence[str] | None = None, labels_from: DataFrame | None = None
) -> DataFrame:
    """One 0/1 column per distinct label, in label order; labels that ``rule`` names alike share one.

    Column names come from the data, so the labels are read first; ``labels_from`` may name a
    cheaper frame that holds all labels of ``df``. Where labels are many or open-ended, ``labels``
    names those that get columns, found or not, and every other one is a key of the map
    ``<prefix>other``, which is always there and empty for rows of the named labels. Neither form
    depends on how many labels the data has.
    """
    wanted = labels
    if wanted is None:
        source = df if labels_from is None else labels_from
        wanted = [row[0] for row in source.select(column).filter(F.col(column).isNotNull()).distinct().collect()]
    groups: dict[str, list[str]] = {}
    for label in sorted(set(wanted)):
        groups.setdefault(prefix + rule(label), []).append(label)
    flags = {name: F.when(F.col(column).isin(same), 1).otherwise(0).cast("int") for name, same in groups.items()}
    if labels is not None:
        other = F.col(column).isNotNull() & ~F.col(column).isin(*labels)
        flags[f"{prefix}other"] = F.map_filter(F.create_map(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(1)), lambda _, v: other & v.isNotNull())
    return df.withColumns(flags)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; absent columns are null."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def sanitize_floats(df: DataFrame) -> DataFrame:
    """NaN and infinities to null at any nesting depth."""
    return df.select(*[_clean(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def _has_floats(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_floats(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _has_floats(kind.elementType)
    return _has_floats(kind.valueType) if isinstance(kind, MapType) else isinstance(kind, (DoubleType, FloatType))


def _clean(value: Column, kind: DataType) -> Column:
    if not _has_floats(kind):
        return value
    if isinstance(kind, (DoubleType, FloatType)):
        return F.when(F.abs(value) < float("inf"), value)  # NaN is larger than any number
    if isinstance(kind, StructType):
        rebuilt = F.struct(*[_clean(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), rebuilt)
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _clean(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, x: _clean(x, kind.valueType))
    return value
