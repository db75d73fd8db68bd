"""Nested documents from flat tables, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_first(parents: DataFrame, children: DataFrame, key: str, child_key: str, values: Sequence[str], tie: str) -> DataFrame:
    """``parents`` with some columns of their first child by ``tie``; null where there is none."""
    first = children.groupBy(F.col(child_key).alias(key)).agg(F.min_by(F.struct(*values), tie).alias("__first"))
    return parents.join(first, key, "left").select(*parents.columns, *[F.col(f"__first.{v}").alias(v) for v in values])


def attach_list(parents: DataFrame, children: DataFrame, key: str, child_key: str, fields: dict[str, Column], order: str, name: str) -> DataFrame:
    """``parents`` with an array of structs of their children, sorted by the field ``order`` first; empty where there are none."""
    struct = F.struct(fields[order].alias(order), *[c.alias(n) for n, c in fields.items() if n != order])
    lists = children.groupBy(F.col(child_key).alias(key)).agg(F.array_sort(F.collect_list(struct)).alias(name))
    kind = lists.schema[name].dataType.simpleString()
    return parents.join(lists, key, "left").withColumn(name, F.coalesce(name, F.from_json(F.lit("[]"), kind)))


def to_document(column: Column) -> Column:
    """JSON with null fields kept."""
    return F.to_json(column, {"ignoreNullFields": "false"})


def field(document: Column, path: str) -> Column:
    """A field of a JSON text by path; null if missing or if the text is not JSON."""
    return F.get_json_object(document, path)


def canonical_agents(df: DataFrame, key: str, layouts: Sequence[tuple[str, dict[str, str]]], roles: dict[str, str], name: str = "agents") -> DataFrame:
    """Alternative layouts of one list as one: the first of several array columns that has rows, its fields renamed, its roles mapped.

    ``layouts`` gives for each array column the source names of the fields
    ``name``, ``role`` and ``status``; columns that ``df`` lacks are passed over.
    """
    table = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv])

    def made(column: str, names: dict[str, str]) -> Column:
        get = lambda x, f: x[names[f]] if names.get(f) else F.lit(None).cast("string")
        return F.transform(F.col(column), lambda x: F.struct(
            get(x, "name").alias("name"), F.coalesce(F.element_at(table, F.lower(get(x, "role"))), get(x, "role")).alias("role"), get(x, "status").alias("status"),
        ))

    choices = [F.when(F.size(F.col(column)) > 0, made(column, names)) for column, names in layouts if column in df.columns]
    empty = F.from_json(F.lit("[]"), "array<struct<name: string, role: string, status: string>>")
    return df.select(key, F.coalesce(*choices, empty).alias(name))
