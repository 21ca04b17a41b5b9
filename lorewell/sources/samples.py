"""A small world to try queries on, used where no dump is named: instruments of an orchestra by family."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas

#: Id, name, family (a category), rank (of instruments only).
WORLD = [
    (101, "Viola", "Strings", 310),
    (102, "Cello", "Strings", 845),
    (103, "Harp", "Strings", 520),
    (104, "Oboe", "Woodwinds", 275),
    (105, "Bassoon", "Woodwinds", 190),
    (106, "Timpani", "Percussion", 160),
    (201, "Strings", "Instruments", None),
    (202, "Woodwinds", "Instruments", None),
    (203, "Percussion", "Instruments", None),
    (204, "Instruments", None, None),
]
_IDS = {name: k for k, name, _, _ in WORLD}
_FAMILIES = {name for _, name, _, rank in WORLD if rank is None}


def links(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, family, "subcat" if name in _FAMILIES else "page") for k, name, family, _ in WORLD if family], schemas.CATEGORY_LINK)


def pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, name, schemas.CATEGORY_NAMESPACE if name in _FAMILIES else 0, False) for k, name, _, _ in WORLD], schemas.PAGE)


def entities(spark: SparkSession) -> DataFrame:
    """Instruments are instances of their family, families subclasses of theirs."""

    def row(k: int, name: str, family: str | None) -> tuple:
        claim = schemas.SUBCLASS_OF if name in _FAMILIES else schemas.INSTANCE_OF
        return k, (schemas.CATEGORY_PREFIX if name in _FAMILIES else "") + name, name.lower(), 1, [], {claim: [_IDS[family]]} if family else {}

    return spark.createDataFrame([row(k, name, family) for k, name, family, _ in WORLD], schemas.ENTITY)


def ranks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, rank) for k, _, _, rank in WORLD if rank is not None], schemas.RANK)
