"""Changes of a table's schema: what is added, what is widened, what is
refused, each reported.

Incoming rows may lack columns (NULL) and bring new ones, which are added at
the end; a column's type may grow, in which case stored files are written anew
with the wider type; a narrower incoming type is cast up. A type that can hold
neither the other is refused, and nothing is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField,
                               StructType, TimestampNTZType)

from .versions import NULL_PARTITION, WHOLE, Change, Table, Version

_WHOLE_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}   # digits a type's values have at most
_ORDER = [ByteType, ShortType, IntegerType, LongType]


class Narrowing(ValueError):
    """A column's incoming type can hold neither all stored values nor be held by their type."""


@dataclass(frozen=True)
class Drift:
    table: str
    column: str
    change: str          # added, missing, widened, cast, refused
    stored: str | None
    incoming: str | None


def wider(a: DataType, b: DataType) -> DataType | None:
    """A type that holds every value of both, of the two or a decimal; None
    if there is none."""
    if a == b:
        return a
    if type(a) in _ORDER and type(b) in _ORDER:
        return max(a, b, key=lambda t: _ORDER.index(type(t)))
    kinds = {type(a), type(b)}
    if kinds == {FloatType, DoubleType} or kinds <= {DoubleType, ByteType, ShortType, IntegerType} | {FloatType} and DoubleType in kinds:
        return DoubleType()
    if kinds <= {FloatType, ByteType, ShortType}:
        return FloatType()
    if kinds == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if DecimalType in kinds and kinds <= {DecimalType, *_WHOLE_DIGITS}:
        def digits(t: DataType) -> tuple[int, int]:
            return (t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_WHOLE_DIGITS[type(t)], 0)
        whole, scale = (max(x) for x in zip(digits(a), digits(b)))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def reconcile(table: str, stored: StructType, incoming: StructType, partition: str | None = None) -> tuple[StructType, list[Drift]]:
    """The schema that holds both, and how they differ. Names don't tell
    cases apart. The partition column's type is fixed by the folders."""
    news = {f.name.lower(): f for f in incoming.fields}
    fields, drifts = [], []
    for f in stored.fields:
        new = news.pop(f.name.lower(), None)
        old = f.dataType.simpleString()
        if new is None:
            drifts.append(Drift(table, f.name, "missing", old, None))
            fields.append(f)
            continue
        kind = f.dataType if f.name == partition and wider(f.dataType, new.dataType) == f.dataType else wider(f.dataType, new.dataType)
        if kind is None or f.name == partition and kind != f.dataType:
            drifts.append(Drift(table, f.name, "refused", old, new.dataType.simpleString()))
            fields.append(f)
            continue
        if kind != f.dataType:
            drifts.append(Drift(table, f.name, "widened", old, kind.simpleString()))
        elif kind != new.dataType:
            drifts.append(Drift(table, f.name, "cast", old, new.dataType.simpleString()))
        fields.append(StructField(f.name, kind, True))
    for f in news.values():
        drifts.append(Drift(table, f.name, "added", None, f.dataType.simpleString()))
        fields.append(StructField(f.name, f.dataType, True))
    return StructType(fields), drifts


def conform_to(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the schema's columns and types; NULL where it has none."""
    own = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def evolve(change: Change, name: str, incoming: StructType) -> list[Drift]:
    """Bring the stored table to a schema that holds ``incoming`` too. Added
    columns cost nothing (older files read as NULL); a widened one has the
    table's files written anew. Raises ``Narrowing``, before anything is
    written, if a column is refused."""
    if name not in change:
        return []
    old = change.tables[name]
    schema, drifts = reconcile(name, old.struct(), incoming, old.partition)
    refused = [d for d in drifts if d.change == "refused"]
    if refused:
        raise Narrowing("; ".join(f"{d.table}.{d.column}: {d.stored} cannot take {d.incoming}" for d in refused))
    if any(d.change == "widened" for d in drifts):
        change.replace(name, conform_to(change.read(name), schema), old.partition)
    elif any(d.change == "added" for d in drifts):
        change._put(name, Table(schema.json(), old.partition, old.parts, old.facts))
    return drifts


def append_evolving(change: Change, name: str, df: DataFrame) -> list[Drift]:
    """Append rows whose schema may differ from the stored one's."""
    drifts = evolve(change, name, df.schema)
    change.append(name, conform_to(df, change.tables[name].struct()) if name in change else df)
    return drifts


def republish(spark: SparkSession, database: str, root: str, at: Version) -> list[Drift]:
    """Bring the catalog's tables to a version without dropping those whose
    columns stay or only gain some: new columns are added to the definition,
    folders are set anew. Tables of other changes are replaced; each change
    is reported."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{root}/_catalog'")
    drifts = []
    for name, t in at.tables.items():
        full = f"`{database}`.`{name}`"
        folders = {p: f"{root}/{f[0]}" for p, f in t.parts.items() if len(f) == 1}
        if len(folders) < len(t.parts) or t.partition is None and WHOLE not in folders:
            raise ValueError(f"{name} has parts in several folders: publish_version writes them as one")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.struct().fields)
        place = folders[WHOLE] if t.partition is None else f"{root}/{name}"
        by = f" PARTITIONED BY (`{t.partition}`)" if t.partition else ""
        own: list[Drift] = []
        if spark.catalog.tableExists(f"{database}.{name}"):
            _, own = reconcile(name, spark.table(full).schema, t.struct(), t.partition)
            if all(d.change == "added" for d in own) and not (t.partition and own):
                if own:
                    spark.sql(f"ALTER TABLE {full} ADD COLUMNS ({', '.join(f'`{d.column}` {d.incoming}' for d in own)})")
                if t.partition is None:
                    spark.sql(f"ALTER TABLE {full} SET LOCATION '{place}'")
                else:
                    _set_parts(spark, full, t, folders)
                drifts += own
                continue
            spark.sql(f"DROP TABLE {full}")
        spark.sql(f"CREATE TABLE {full} ({columns}) USING PARQUET{by} LOCATION '{place}'")
        if t.partition:
            _set_parts(spark, full, t, folders)
        drifts += own
    return drifts


def _set_parts(spark: SparkSession, full: str, t: Table, folders: dict[str, str]) -> None:
    def spec(p: str) -> str:
        return f"PARTITION (`{t.partition}`={'NULL' if p == NULL_PARTITION else repr(p)})"

    held = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {full}").collect()}
    for p in held - folders.keys():
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS {spec(p)}")
    for p in held & folders.keys():
        spark.sql(f"ALTER TABLE {full} {spec(p)} SET LOCATION '{folders[p]}'")
    fresh = [f"{spec(p)} LOCATION '{place}'" for p, place in folders.items() if p not in held]
    if fresh:
        spark.sql(f"ALTER TABLE {full} ADD {' '.join(fresh)}")


def drift_rows(spark: SparkSession, drifts: Sequence[Drift]) -> DataFrame:
    """The changes as a table."""
    return spark.createDataFrame([tuple(asdict(d).values()) for d in drifts], "table string, column string, change string, stored string, incoming string")


__all__ = ["Drift", "Narrowing", "append_evolving", "conform_to", "drift_rows", "evolve", "reconcile", "republish", "wider"]
