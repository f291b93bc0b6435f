"""Keys, references, ordering and upserts between tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..catalog import TABLES, TableSpec
from .order import numbered


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, and how often. Counts are summed before the shuffle, so a hot key is no hot task."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


def null_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.where(" OR ".join(f"`{c}` IS NULL" for c in key))


def orphans(child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str], nullable: bool = False) -> DataFrame:
    """Rows of ``child`` without a parent. A NULL key is an orphan unless ``nullable``."""
    keys = parent.select(*(F.col(p).alias(f"_{c}") for c, p in zip(columns, parent_columns, strict=True)))
    same = [child[c] == keys[f"_{c}"] for c in columns]
    found = child.join(keys, same, "left_anti")
    return found.dropna(subset=list(columns)) if nullable else found


def delete_cascade(tables: Mapping[str, DataFrame], start: str, doomed: DataFrame, specs: Mapping[str, TableSpec] = TABLES) -> dict[str, DataFrame]:
    """The tables without the rows of ``start`` whose key is in ``doomed`` (the key's columns), nor any row that refers to one that went, through any number of tables."""
    out = dict(tables)
    gone: dict[str, DataFrame] = {}

    def remove(name: str, rows: DataFrame, on: Sequence[str]) -> None:
        table = out[name]
        gone[name] = table.join(rows, list(on), "left_semi")
        out[name] = table.join(rows, list(on), "left_anti")
        for child, spec in specs.items():
            for fk in spec.foreign_keys:
                if fk.parent == name and child in out:
                    lost = gone[name].select(*(F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns, strict=True))).distinct()
                    remove(child, lost, fk.columns)

    remove(start, doomed.distinct(), doomed.columns)
    return out


def latest(df: DataFrame, key: Sequence[str], by: str, *ties: str) -> DataFrame:
    """One row for each key, that of the highest ``by``; among equals that of the highest ``ties``. An aggregate, so copies of a key are reduced before the shuffle."""
    order = F.struct(*(F.col(c) for c in (by, *ties)))
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*(F.col(c) if c in key else F.col(f"_row.{c}") for c in df.columns))


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str], by: str) -> DataFrame:
    """Both tables' rows with the latest of each key."""
    return latest(current.unionByName(changes), key, by)


def ordered(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.orderBy(*spec.order_by())


def positions(df: DataFrame, spec: TableSpec, *ties: str) -> DataFrame:
    """All rows with their place, from 0, in the table's declared order, and among equals by ``ties``; see :func:`.order.numbered`."""
    return numbered(df, *("-" * down + c for c, down in spec.ordering), *ties)


def ranked(df: DataFrame, partition: Sequence[str], *order: Column) -> DataFrame:
    """Rows numbered from 1 within each partition."""
    return df.withColumn("position", F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))


def mixed_kinds(entities: DataFrame, message: str, kind: str) -> DataFrame:
    """Messages whose entities are of more than one kind, and how many kinds."""
    return entities.groupBy(message).agg(F.count_distinct(kind).alias("kinds")).where("kinds > 1")
