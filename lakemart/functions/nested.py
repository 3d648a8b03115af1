"""Expressions over nested records: action lists, audiences, creatives, struct flattening."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakemart.functions.casts import lenient_double, quoted

AUDIENCE_SEPARATOR = " | "
AUDIENCE_ID_PREFIX = "CA:"


def _non_empty(text: Column) -> Column:
    return F.nullif(text.cast("string"), F.lit(""))


def _first_where(items: Column, condition) -> Column:
    return F.get(F.filter(items, condition), F.lit(0))


def action_value(actions: Column, action_type: str) -> Column:
    """Value of the first action of that type as double; missing or unparsable gives 0."""
    first = _first_where(actions, lambda action: action["action_type"] == action_type)
    return F.coalesce(lenient_double(F.trim(first["value"].cast("string"))), F.lit(0.0))


def action_count(actions: Column, action_type: str) -> Column:
    """``action_value`` cut to a whole number."""
    return F.coalesce(action_value(actions, action_type).try_cast("bigint"), F.lit(0).cast("bigint"))


def audience_label(targeting: Column) -> Column:
    """Names of the included audiences, then ``CA:<id>`` of the unnamed ones, each part sorted."""
    nested = F.transform(
        F.coalesce(targeting["flexible_spec"], F.array()), lambda item: item["custom_audiences"]
    )
    everyone = F.concat(
        F.coalesce(targeting["custom_audiences"], F.array()),
        F.flatten(F.filter(nested, lambda group: group.isNotNull())),
    )
    names = F.transform(everyone, lambda who: _non_empty(who["name"]))
    unnamed = F.transform(
        F.filter(everyone, lambda who: _non_empty(who["name"]).isNull()), lambda who: _non_empty(who["id"])
    )
    labels = F.concat(
        F.array_sort(F.array_distinct(F.array_compact(names))),
        F.transform(
            F.array_sort(F.array_distinct(F.array_compact(unnamed))),
            lambda ident: F.concat(F.lit(AUDIENCE_ID_PREFIX), ident),
        ),
    )
    return F.coalesce(F.array_join(labels, AUDIENCE_SEPARATOR), F.lit(""))


def creative_video_id(creative: Column) -> Column:
    """Video id of the story, else the first one in the asset feed."""
    feed = _first_where(
        creative["asset_feed_spec"]["videos"], lambda video: _non_empty(video["video_id"]).isNotNull()
    )
    return F.coalesce(
        _non_empty(creative["object_story_spec"]["video_data"]["video_id"]), _non_empty(feed["video_id"])
    )


def creative_post_id(creative: Column) -> Column:
    """Post id of the creative: the effective story first."""
    return F.coalesce(
        _non_empty(creative["effective_object_story_id"]), _non_empty(creative["object_story_id"])
    )


def thumbnail_url(picture: Column, thumbnails: Column) -> Column:
    """The picture, else the first thumbnail, else ``""``."""
    first = F.get(thumbnails["data"], F.lit(0))["uri"]
    return F.coalesce(_non_empty(picture), _non_empty(first), F.lit(""))


def flatten_record(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Select nested fields by path under flat names; a missing parent gives null."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def flatten_structs(df: DataFrame) -> DataFrame:
    """Every leaf as ``a_b_c``, lists and values of several types as JSON text; of two equal names the later one wins."""
    leaves: dict[str, Column] = {}

    def visit(prefix: str, name: str, data_type: T.DataType, column: Column) -> None:
        flat = prefix + name
        if isinstance(data_type, T.StructType):
            for child in data_type.fields:
                visit(flat + "_", child.name, child.dataType, column.getField(child.name))
        elif isinstance(data_type, (T.ArrayType, T.VariantType)):
            leaves[flat] = F.to_json(column)
        else:
            leaves[flat] = column

    for field in df.schema.fields:
        visit("", field.name, field.dataType, F.col(quoted(field.name)))
    return df.select(*[column.alias(name) for name, column in leaves.items()])


def open_schema(records: DataFrame, column: str) -> T.StructType:
    """The fields that objects in a variant column have, their types merged over all rows.

    Numbers of several kinds widen; values of types that do not go together stay variants; nothing but nulls is text.
    """
    ddl = records.agg(F.schema_of_variant_agg(F.col(quoted(column)))).first()[0]
    merged = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", ddl))

    def settled(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(field.name, settled(field.dataType)) for field in kind.fields])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(settled(kind.elementType))
        return T.StringType() if isinstance(kind, T.NullType) else kind

    if not isinstance(merged, T.StructType):
        raise ValueError(f"the records of {column} are no objects but {ddl}")
    return settled(merged)


def flatten_variant(records: DataFrame, column: str) -> DataFrame:
    """The objects of a variant column as flat columns, every field that any of them has.

    Fields whose flat names are equal (``a.b`` and ``a_b``, or in another case) get numbers from the second one on.
    """
    schema = open_schema(records, column)
    names: dict[str, int] = {}
    leaves: list[Column] = []

    def visit(flat: str, kind: T.DataType, value: Column) -> None:
        if isinstance(kind, T.StructType):
            for field in kind.fields:
                visit(f"{flat}_{field.name}" if flat else field.name, field.dataType, value.getField(field.name))
            return
        number = names[flat.lower()] = names.get(flat.lower(), 0) + 1
        text = isinstance(kind, (T.ArrayType, T.VariantType))
        leaves.append((F.to_json(value) if text else value).alias(flat if number == 1 else f"{flat}_{number}"))

    whole = F.variant_get(F.col(quoted(column)), "$", schema.simpleString())
    visit("", schema, F.col("_object"))
    return records.select(whole.alias("_object")).select(*leaves)
