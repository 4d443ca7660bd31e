"""Entities, relations, entity sets, aliases and catalog lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.numbering import next_id, with_dense_ids


def create_missing_entities(entities: DataFrame, names: DataFrame, now: Column, after: Column | int | None = None) -> DataFrame:
    """Entities to append: the distinct ``name`` values not known yet, with ids counted on from ``after`` or from the largest known."""
    wanted = names.select("name").filter(F.col("name").isNotNull()).distinct()
    new = wanted.join(entities.select("name"), "name", "left_anti")
    return with_dense_ids(new, "name", after=next_id(entities) if after is None else after).select("id", "name", now.alias("created"))


def with_missing_entities(entities: DataFrame, names: DataFrame, now: Column) -> DataFrame:
    return entities.unionByName(create_missing_entities(entities, names, now))


def resolve_entities(rows: DataFrame, entities: DataFrame, name_column: str = "entity") -> DataFrame:
    """Replace the entity name by ``entity_id``; every name must be in ``entities``."""
    ids = entities.select(F.col("id").alias("entity_id"), F.col("name").alias(name_column))
    return rows.join(ids, name_column).drop(name_column)


def relation_materialize(edges: DataFrame) -> DataFrame:
    """Unique (source, target) pairs."""
    return edges.select("source_id", "target_id").distinct()


def relation_violations(relation: DataFrame, cardinality: str) -> DataFrame:
    """Ids that have more partners than the declared cardinality allows."""
    single_target = cardinality in ("one-to-one", "many-to-one")
    single_source = cardinality in ("one-to-one", "one-to-many")
    if not (single_target or single_source):
        raise ValueError(f"unknown cardinality: {cardinality!r}")

    def crowded(side: str) -> DataFrame:
        return (
            relation.groupBy(F.lit(side).alias("side"), F.col(f"{side}_id").cast("bigint").alias("id"))
            .agg(F.count(F.lit(1)).alias("partners"))
            .filter(F.col("partners") > 1)
        )

    sides = [side for side, wanted in (("source", single_target), ("target", single_source)) if wanted]
    found = crowded(sides[0])
    return found.unionByName(crowded(sides[1])) if len(sides) == 2 else found


def virtual_entity_update(entities: DataFrame, view: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """New entities for the names of a view, and their number as a one-row frame."""
    created = create_missing_entities(entities, view, now)
    return created, created.agg(F.count(F.lit(1)).alias("created"))


def full_set_name(name: str = "name", group: str = "group", owner: str = "owner") -> Column:
    return F.concat_ws("_", F.col(name), F.col(group), F.col(owner))


def invalid_members(requested: DataFrame, entities: DataFrame) -> DataFrame:
    """Requested ``(set_id, name)`` rows whose name is not an entity."""
    return requested.join(entities.select("name"), "name", "left_anti").select("set_id", "name")


def existing_sets(sets: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested sets whose (owner, name) is taken."""
    return requested.join(sets.select("owner", "name"), ["owner", "name"], "left_semi")


def create_sets(sets: DataFrame, requested: DataFrame, now: Column) -> DataFrame:
    """Set rows to append for ``name, group, source_entity_type, owner, description`` requests.

    A request whose (owner, name) exists is left out.
    """
    keys = ["owner", "name"]
    details = ["group", "source_entity_type", "description"]
    new = (
        requested.join(sets.select(*keys), keys, "left_anti")
        .groupBy(*keys)
        .agg(F.min(F.struct(*details)).alias("row"))
        .select(*keys, "row.*")
    )
    numbered = with_dense_ids(new, keys, after=next_id(sets))
    return numbered.select(
        "id", "name", full_set_name().alias("fullname"), "group", "source_entity_type", "owner", "description",
        F.to_date(now).cast("string").alias("last_update"),
    )


def create_sets_with_members(
    sets: DataFrame, requested: DataFrame, names: DataFrame, entities: DataFrame, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Set rows and ``(source_id, target_id)`` members to append, for requests that can be met whole.

    ``requested`` as in :func:`create_sets`, ``names`` is ``owner, set_name, name``: the entities each set is to hold. A request is left
    out with all its members if its (owner, name) is taken or one of its names is no entity.
    """
    unknown = names.join(entities.select("name"), "name", "left_anti").select("owner", F.col("set_name").alias("name")).distinct()
    created = create_sets(sets, requested.join(unknown, ["owner", "name"], "left_anti"), now)
    ids = created.select(F.col("id").alias("set_id"), F.col("name").alias("set_name"), "owner")
    return created, _edges(names.join(ids, ["owner", "set_name"]).select("set_id", "name"), entities)


def valid_sets(requested: DataFrame, entities: DataFrame) -> DataFrame:
    """Requested ``(set_id, name)`` rows of those sets in which every name is an entity."""
    bad = invalid_members(requested, entities).select("set_id").distinct()
    return requested.join(bad, "set_id", "left_anti")


def _edges(requested: DataFrame, entities: DataFrame) -> DataFrame:
    ids = entities.select(F.col("id").alias("source_id"), "name")
    return requested.join(ids, "name").select("source_id", F.col("set_id").alias("target_id")).distinct()


def change_members(members: DataFrame, requested: DataFrame, entities: DataFrame, guarded: bool = False) -> DataFrame:
    """Membership with the sets named in ``requested`` holding exactly the requested entities.

    ``guarded`` leaves a set as it was when one of its names is unknown.
    """
    wanted = valid_sets(requested, entities) if guarded else requested
    changed = wanted.select(F.col("set_id").alias("target_id")).distinct()
    return members.join(changed, "target_id", "left_anti").select("source_id", "target_id").unionByName(
        _edges(wanted, entities)
    )


def add_members(members: DataFrame, requested: DataFrame, entities: DataFrame) -> DataFrame:
    """Membership with the requested entities added; members already there stay single."""
    return members.select("source_id", "target_id").unionByName(_edges(requested, entities)).distinct()


def remove_members(members: DataFrame, requested: DataFrame, entities: DataFrame) -> DataFrame:
    """Membership without the requested entities."""
    return members.join(_edges(requested, entities), ["source_id", "target_id"], "left_anti")


def touch_sets(sets: DataFrame, changed: DataFrame, now: Column) -> DataFrame:
    """Sets with ``last_update`` renewed where their ``set_id`` is in ``changed``."""
    flag = changed.select(F.col("set_id").alias("id")).distinct().withColumn("__hit", F.lit(True))
    renewed = F.when(F.col("__hit"), F.to_date(now).cast("string")).otherwise(F.col("last_update"))
    return sets.join(flag, "id", "left").withColumn("last_update", renewed).select(*sets.columns)


def set_members(members: DataFrame, sets: DataFrame, entities: DataFrame) -> DataFrame:
    """``(set_id, set_name, owner, member)``, one row per member.

    A set may hold any number of entities, so members stay rows and are never gathered into
    one array. Filter on ``set_id`` or ``(set_name, owner)`` for a single set.
    """
    ids = entities.select(F.col("id").alias("source_id"), F.col("name").alias("member"))
    described = sets.select(F.col("id").alias("target_id"), F.col("name").alias("set_name"), "owner")
    return members.join(ids, "source_id").join(described, "target_id").select(
        F.col("target_id").alias("set_id"), "set_name", "owner", "member"
    )


def alias_refresh(definition: DataFrame) -> DataFrame:
    """Alias table contents from its defining view."""
    return definition.select("entity_id", "alias").distinct()


def alias_lookup(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """Entities with their alias, NULL where they have none."""
    return entities.join(aliases.select(F.col("entity_id").alias("id"), "alias"), "id", "left")


def find_trends(table_trends: DataFrame, view_trends: DataFrame, granularity: str = "15m") -> DataFrame:
    """Distinct trend names per entity type at one granularity: of tables, then of views."""
    def of(trends: DataFrame, origin: str) -> DataFrame:
        return trends.filter(F.col("granularity") == granularity).select(
            "entity_type", F.lit(origin).alias("origin"), "name"
        ).distinct()

    return of(table_trends, "table").unionByName(of(view_trends, "view")).orderBy("entity_type", "origin", "name")


def get_settings(settings: DataFrame, wanted: DataFrame) -> DataFrame:
    """Value of each wanted setting (``name, default``), or its default."""
    return wanted.join(settings.select("name", "value"), "name", "left").select(
        "name", F.coalesce("value", "default").alias("value")
    )


def put_settings(settings: DataFrame, changes: DataFrame) -> DataFrame:
    """Settings with the changed values inserted or replaced."""
    new = changes.select("name", F.col("value").alias("new"))
    return settings.select("name", "value").join(new, "name", "full_outer").select(
        "name", F.coalesce("new", "value").alias("value")
    )
