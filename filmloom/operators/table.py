"""Keyed maintenance of snapshot tables: each function returns the next snapshot.

The key sides are aggregated or ranked before they meet, and every merge is one equi-join on the keys. Keys that are null,
or have a null part, equal nothing, as in SQL's unique keys: such rows of the target stay, those of the source are all
added. `filmloom.sources.snapshots` publishes the next snapshot; on its bucketed tables the target isn't shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.operators.window import first_per_key, last_per_key, last_values


def _named(keys: list[str]) -> Column:
    """Whether no part of the key is null."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """What exists stays; of the source the first row of each new key is added, and every row whose key is null."""
    named = _named(keys)
    first = first_per_key(source.where(named), keys, *[F.col(x) for x in order]).select(*target.columns)
    new = first.join(target.select(*keys), keys, "left_anti").select(*target.columns)
    return target.unionByName(new).unionByName(source.where(~named).select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[str], update: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The source's last row of each key overwrites the columns `update` (all but the keys and `keep`), or is added."""
    others = [c for c in target.columns if c not in keys]
    update = [c for c in others if c not in keep] if update is None else update
    rows = source.select(*dict.fromkeys([*target.columns, *order]))
    last = last_per_key(rows.where(_named(keys)), keys, *order).select(*target.columns)
    last = last.unionByName(rows.where(~_named(keys)).select(*target.columns))
    # a mark beside the columns tells a side's row from none, also where all of its columns are null
    s = last.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(F.lit(True).alias("_is"), *others).alias("_s"))
    t = target.select(*keys, F.struct(F.lit(True).alias("_is"), *others).alias("_t"))
    joined = t.join(s, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys]), "full_outer")
    made = [F.coalesce(F.col(k), F.col(f"_{k}")).alias(k) for k in keys]
    for c in others:
        new, old = F.col(f"_s.{c}"), F.col(f"_t.{c}")
        wins = F.col("_s").isNotNull() if c in update else F.col("_t").isNull()
        made.append(F.when(wins, new).otherwise(old).alias(c))
    return joined.select(*made).select(*target.columns)


def upsert_two_keys(target: DataFrame, source: DataFrame, first: str, second: list[str], *order: str) -> DataFrame:
    """Rows that match by the first key, else by the second one, are replaced; the rest of the source is added.

    Two equi-joins: never a join with OR. A source row that matches two target rows replaces both. Of source rows with
    an equal first key, then of those with an equal second one, the last by `order` counts; null keys equal nothing.
    """
    for keys in ([first], second):
        named = _named(keys)
        by = [x for x in order if x not in keys] or [x for x in target.columns if x not in keys]
        rows = source.select(*dict.fromkeys([*target.columns, *order]))
        source = last_per_key(rows.where(named), keys, *by).unionByName(rows.where(~named))
    # an anti-join needs no distinct keys: an aggregate there would hold them in the task a second time
    kept = target.join(source.select(first), first, "left_anti")
    kept = kept.join(source.select(*second), second, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def replace_children(children: DataFrame, new_parents: DataFrame, new_children: DataFrame, parent: str, url: str) -> DataFrame:
    """Parents with a list of sources lose their children and get the new ones; a URL of another parent is left alone."""
    rest = children.join(new_parents.select(parent).distinct(), parent, "left_anti").select(*children.columns)
    fresh = new_children.join(rest.select(url), url, "left_anti").select(*children.columns)
    return rest.unionByName(fresh)


def fill_missing(target: DataFrame, details: DataFrame, key: str, columns: list[str], *order: str) -> DataFrame:
    """Columns that came non-empty are set, for every row of a key; `changed` tells where.

    Several details of a key are applied one after another (see last_values): in their order, else by their values.
    """
    d = last_values(details, [key], columns, *order).select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    joined = target.join(d, F.col(key) == F.col("_k"), "left")
    value = {c: F.coalesce(F.col(f"_{c}"), F.col(c)) for c in columns}
    changed = None
    for c, v in value.items():
        here = ~v.eqNullSafe(F.col(c))
        changed = here if changed is None else changed | here
    return joined.withColumn("changed", changed).withColumns(value).select(*target.columns, "changed")


def delete_keys(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return target.join(keys.select(*on).distinct(), on, "left_anti").select(*target.columns)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition isn't true; NULL keeps a row."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def cleanup(target: DataFrame, drop: Column, changes: dict[str, Column]) -> DataFrame:
    """One pass of deletion and normalisation."""
    return delete_where(target, drop).withColumns(changes)


def migrate_rows(source: DataFrame, target: DataFrame, moves: Column, reshape: Callable[[DataFrame], DataFrame], keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The source without the rows that move, and the target with them."""
    return delete_where(source, moves), upsert(target, reshape(source.where(moves)), keys, order)


def replace_rows(target: DataFrame, source: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Whole rows replaced; nothing of an old one is kept. Of several source rows of a key the last by `order` counts."""
    rows = source.select(*dict.fromkeys([*target.columns, *order]))
    last = last_per_key(rows.where(_named(keys)), keys, *order).select(*target.columns)
    return delete_keys(target, source, keys).unionByName(last).unionByName(rows.where(~_named(keys)).select(*target.columns))
