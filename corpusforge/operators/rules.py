"""Curated overlays, checked lookups, and recomputation by content hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.session import small


def overlay(base: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of the patch replace the named columns of base rows with their key; a null in the patch leaves the base's value."""
    p = patch.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    joined = base.join(small(p), key, "left")
    return joined.select(*(F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in base.columns))


def patch_once(text: Column, old: Column, new: Column) -> Column:
    """K7: replaces `old`, which must stand exactly once; anything else is an error."""
    n = (F.length(text) - F.length(F.replace(text, old, F.lit("")))) / F.length(old)
    return F.when(n == 1, F.replace(text, old, F.coalesce(new, F.lit("")))).otherwise(F.raise_error(F.concat(F.lit("patch matches "), n.cast("int").cast("string"), F.lit(" times"))))


def alias_lookup(rows: DataFrame, key: Column, aliases: DataFrame, known: DataFrame) -> DataFrame:
    """By the alias's target if there is one, else by the key itself; aliases(alias, target), known(key, ...)."""
    named = rows.withColumn("_key", key).join(small(aliases.select(F.col("alias").alias("_key"), "target")), "_key", "left")
    return named.withColumn("_key", F.coalesce("target", "_key")).drop("target").join(known.withColumnRenamed("key", "_key"), "_key", "left").withColumnRenamed("_key", "matched_key")


def fallback_lookup(rows: DataFrame, id: str, candidates: Column, table: DataFrame) -> DataFrame:
    """The value of the first candidate key that the table (key, value) has; null if it has none."""
    tried = rows.select(id, F.posexplode(candidates).alias("at", "key")).join(small(table), "key")
    found = tried.groupBy(id).agg(F.min_by("value", "at").alias("value"), F.min_by("key", "at").alias("matched"))
    return rows.join(found, id, "left")


def exactly_one(names: DataFrame, rows: DataFrame, name: str, id: str) -> DataFrame:
    """For every name how many rows have it, and the id if it is one; error says what is wrong."""
    found = rows.join(small(names), name, "left_semi").groupBy(name).agg(F.count("*").alias("_n"), F.min(id).alias("_id"))
    n = F.coalesce("_n", F.lit(0))
    return names.join(found, name, "left").select(name, n.alias("n"), F.when(n == 1, F.col("_id")).alias("id"), F.when(n == 0, "missing").when(n > 1, "ambiguous").alias("error"))


def missing(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows without a partner."""
    return rows.join(table.select(key).distinct(), key, "left_anti")


def require_empty(rows: DataFrame, what: str) -> None:
    """A hard error that names up to five offenders."""
    found = rows.limit(5).collect()
    if found:
        raise ValueError(f"{what}: {found}")


def content_key(*columns: Column) -> Column:
    """SHA-256 over the columns written as JSON."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def recompute(rows: DataFrame, cache: DataFrame, key: str, compute) -> DataFrame:
    """Cached results for keys that the cache has, computed ones for the others; keys that no row has any more go."""
    kept = cache.join(rows.select(key).distinct(), key, "left_semi")
    fresh = compute(rows.join(cache.select(key), key, "left_anti"))
    return kept.unionByName(fresh.select(kept.columns))
