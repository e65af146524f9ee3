"""Keyed writes into lake tables: the jobs behind upserts and inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import UPSERT_COLUMNS
from tidemark.schemas import ENTITIES, Entity
from tidemark.sinks.keyed import KeyedTable, Merged


def lake_table(spark: SparkSession, data_dir: str, entity: Entity | str) -> KeyedTable:
    """The copy of an entity that keyed writes change, ``keyed/<table>``."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    return KeyedTable(spark, f"{data_dir.rstrip('/')}/keyed/{entity.name}", entity.key)


def _latest(rows: DataFrame, entity: Entity) -> list:
    name = entity.version_column
    return [F.col(name)] if name in rows.columns else []


def upsert_rows(spark: SparkSession, data_dir: str, entity: Entity | str, rows: DataFrame) -> Merged:
    """Rows of known keys overwrite the entity's upsert columns, unknown keys are added. Of
    several rows of a key the one with the latest version counts. Taking in the same rows
    again changes nothing and writes nothing."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    table = lake_table(spark, data_dir, entity)
    return table.upsert(rows, UPSERT_COLUMNS[entity.name], _latest(rows, entity))


def insert_rows(spark: SparkSession, data_dir: str, entity: Entity | str, rows: DataFrame) -> Merged:
    """Rows of unknown keys are added; known keys stay as they are."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    return lake_table(spark, data_dir, entity).insert_absent(rows, _latest(rows, entity))
