"""Which columns the files of a folder have, kept beside them so that no reader opens footers to find out.

A folder ``_columns`` holds one small file per distinct list of columns, numbered in the order they came.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from ontarmac.sources.storage import Folder

FOLDER = "_columns"


def union(schemas: list[StructType]) -> StructType:
    """All columns in the order they come, told apart without regard to case; one name has one type."""
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema.fields:
            held = fields.setdefault(field.name.lower(), StructField(field.name, field.dataType))
            if held.dataType != field.dataType:
                raise ValueError(f"column {field.name} is {field.dataType.simpleString()}, and {held.dataType.simpleString()} elsewhere")
    return StructType(list(fields.values()))


def registered(spark: SparkSession, root: str) -> list[StructType]:
    """The lists of columns registered so far; empty for a folder that was written without."""
    folder = Folder(spark, f"{root.rstrip('/')}/{FOLDER}")
    return [StructType.fromJson(json.loads(folder.read(n))) for n in folder.names() if n.endswith(".json")]


def register(spark: SparkSession, root: str, schema: StructType) -> None:
    """Add a list of columns unless those registered hold all of it; a clash of types is an error."""
    plain = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    folder = Folder(spark, f"{root.rstrip('/')}/{FOLDER}")
    while True:
        known = registered(spark, root)
        held = union(known)
        if known and union([held, plain]) == held:
            return
        if folder.publish(f"{len(known):06d}.json", json.dumps(plain.jsonValue())):
            return
