"""Replay of a corrections log in log order: compaction to one last event per id, and chains of replacements.

An entry retires record ids and adds replacement units. The log is an upsert log: an entry whose ``correction_id`` was there
before takes the older one's place with its own content, and only entries with an applied status count. For each record id the
last event in log order decides, whatever came before; so an id that a later entry retires is gone even if an earlier one added
it, and a second run over the result changes nothing.

Order columns may be of any type that sorts, such as the long line number or the struct that ``read_corrections`` gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle

# fixed value: statuses of entries that have taken effect begin so
APPLIED = "applied"


def compact_log(log: DataFrame, order: str = "seq", entry: str = "correction_id") -> DataFrame:
    """One row per entry: its last content, at the place of its first; entries without an id stand for themselves."""
    known = log.where(F.col(entry).isNotNull())
    last = known.groupBy(entry).agg(F.min(order).alias("_place"), F.max_by(F.struct(*[c for c in log.columns if c != entry]), order).alias("_r"))
    columns = [F.col("_place").alias(order) if c == order else F.col(entry) if c == entry else F.col(f"_r.`{c}`").alias(c) for c in log.columns]
    return last.select(*columns).unionByName(log.where(F.col(entry).isNull()))


def applied(status: str = "status") -> Column:
    return F.coalesce(F.col(status).startswith(APPLIED), F.lit(False))


def log_events(log: DataFrame, key: str = "record_id", order: str = "seq", entry: str = "correction_id") -> DataFrame:
    """(key, order, adds, entry, unit): what the applied entries of the compacted log do to each id, units without an id left out.

    Inside an entry ids are retired first, so an entry may replace an id by a unit of the same id.
    """
    entries = compact_log(log, order, entry).where(applied()) if "status" in log.columns else compact_log(log, order, entry)
    unit = F.lit(None).cast(entries.schema["replacement_units"].dataType.elementType)
    gone = entries.select(F.explode("obsolete_record_ids").alias(key), order, F.lit(False).alias("adds"), entry, unit.alias("unit"))
    fresh = entries.select(order, entry, F.posexplode("replacement_units").alias("_nth", "unit"))
    # of units of one id in one entry the last counts
    fresh = fresh.select(F.element_at("unit", F.lit(key)).alias(key), order, F.lit(True).alias("adds"), entry, "unit", "_nth")
    fresh = fresh.groupBy(key, order, "adds", entry).agg(F.max_by("unit", "_nth").alias("unit"))
    return gone.dropDuplicates([key, order, entry]).unionByName(fresh).where(F.col(key).isNotNull())


def final_states(log: DataFrame, key: str = "record_id", order: str = "seq", entry: str = "correction_id") -> DataFrame:
    """One row per id that the log names: (key, adds, unit, entry) of its last event."""
    events = log_events(log, key, order, entry)
    last = F.max_by(F.struct("adds", "unit", entry), F.struct(order, "adds"))
    return events.groupBy(key).agg(last.alias("_l")).select(key, "_l.adds", "_l.unit", f"_l.{entry}")


def apply_corrections(df: DataFrame, log: DataFrame, key: str = "record_id", order: str = "seq", entry: str = "correction_id") -> DataFrame:
    """The records after the whole log: retired ids are gone, units are there with their missing columns blank.

    Units replace a record of their id, so applying the log once more, or to records that already hold some of its units,
    gives the same rows. A log without an order column is one in which no id is named by two entries.
    """
    if order not in log.columns:
        log = log.withColumn(order, F.lit(0))
    if entry not in log.columns:
        log = log.withColumn(entry, F.lit(None).cast("string"))
    # read twice, by the ids that are replaced and by the units, so settled once
    state = settle(final_states(log, key, order, entry), "states")
    units = state.where("adds").select(*[F.element_at("unit", F.lit(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    return df.join(state.select(key), key, "left_anti").select(*df.columns).unionByName(units)


def lineage(log: DataFrame, key: str = "record_id", order: str = "seq", entry: str = "correction_id") -> DataFrame:
    """(key, retired_at, current_id, links): for every retirement, the ids that stand for the record after all later entries.

    One row with ``current_id`` NULL if nothing does. ``links`` is the length of the shortest chain of entries to it. A chain is
    followed by pointer doubling: each round joins every open end with the pairs found so far, so the number of rounds is the
    logarithm of the longest chain; a unit that was re-added after its retirement is a new link, since pairs carry the place
    in the log at which the unit came.
    """
    events = settle(log_events(log, key, order, entry), "events")
    # a unit lives until the next retirement of its id; an id has as many events as entries name it
    later = Window.partitionBy(key).orderBy(F.col(order).desc(), F.col("adds").desc()).rowsBetween(Window.unboundedPreceding, -1)
    lives = events.withColumn("until", F.last(F.when(~F.col("adds"), F.col(order)), ignorenulls=True).over(later))
    added = lives.where("adds").select(F.col(key).alias("to_id"), "until", entry)
    retired = events.where("NOT adds").select(key, F.col(order).alias("retired_at"), entry)
    links = F.when(F.col("to_id").isNotNull(), F.lit(1)).otherwise(0)
    pairs = retired.join(added, entry, "left").select(key, "retired_at", "to_id", "until", links.alias("links"))
    now = settle(pairs.distinct(), "pairs")
    while not now.where("until IS NOT NULL").isEmpty():
        on = now.select(F.col(key).alias("to_id"), F.col("retired_at").alias("until"), F.col("to_id").alias("_to"),
                        F.col("until").alias("_until"), F.col("links").alias("_links"))
        further = now.where("until IS NOT NULL").join(on, ["to_id", "until"]).select(
            key, "retired_at", F.col("_to").alias("to_id"), F.col("_until").alias("until"), (F.col("links") + F.col("_links")).alias("links"))
        both = now.where("until IS NULL").unionByName(further)
        now = settle(both.groupBy(key, "retired_at", "to_id", "until").agg(F.min("links").alias("links")), "pairs")
    best = now.groupBy(key, "retired_at", F.col("to_id").alias("current_id")).agg(F.min("links").alias("links"))
    # an end without a successor says nothing where another branch of the same retirement has one
    some = best.groupBy(key, "retired_at").agg(F.count("current_id").alias("_some"))
    kept = best.join(some, [key, "retired_at"]).where((F.col("_some") == 0) | F.col("current_id").isNotNull())
    return kept.select(key, "retired_at", "current_id", "links")


def log_issues(df: DataFrame, log: DataFrame, key: str = "record_id", order: str = "seq", entry: str = "correction_id") -> DataFrame:
    """(entry, key, issue): ids retired that neither the records nor an earlier entry hold, and units added over a living id.

    ``df`` are the records before the log. Each id's events are looked at in log order.
    """
    events = log_events(log, key, order, entry)
    before = Window.partitionBy(key).orderBy(order, "adds")
    base = df.select(key).distinct().withColumn("_base", F.lit(True))
    steps = events.withColumn("_was", F.lag("adds").over(before)).join(base, key, "left")
    there = F.coalesce("_was", "_base", F.lit(False))
    issue = F.when(~F.col("adds") & ~there, "retired_but_absent").when(F.col("adds") & there, "added_over_living")
    return steps.select(entry, key, issue.alias("issue")).where("issue IS NOT NULL")
