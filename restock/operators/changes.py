"""Change events: parse, keep known fields, and fold many events per key into a stored table.

The fold gives what applying the events one after the other would give, without ordering a key's events in one
task: every figure it needs is a combining aggregate (last reset, first update, last change of each column).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from restock.session import stage

OPERATIONS = ("INSERT", "UPDATE", "DELETE")
ENVELOPE = "table string, type string, shardingKey string, data string, oldData string"
FIELDS = "map<string,string>"
POSITION = ("partition", "offset")


def messages(envelopes: DataFrame, table: str) -> DataFrame:
    """Messages of one table, and those that name none: position, text, key, operation and field maps.

    A nested object may be written as an object or as text holding one; both parse the same.  ``broken`` tells whether there
    is a nested text that is no object.
    """
    # What is parsed is spread into columns, so that it is parsed once however often it is used.
    message = F.from_json(F.col("value").cast("string"), ENVELOPE)
    spread = envelopes.select(
        F.struct(*POSITION).alias("seq"), F.col("value").cast("string").alias("text"), F.inline(F.array(message))
    ).filter((F.col("table") == table) | F.col("table").isNull())
    fields = F.struct(F.from_json("data", FIELDS).alias("fields"), F.from_json("oldData", FIELDS).alias("old_fields"))
    broken = [F.col(text).isNotNull() & F.col(found).isNull() for text, found in (("data", "fields"), ("oldData", "old_fields"))]
    return spread.select("*", F.inline(F.array(fields))).select(
        "seq",
        "text",
        "table",
        F.col("shardingKey").alias("key"),
        F.upper("type").alias("op"),
        F.col("fields").alias("data"),
        F.col("old_fields").alias("old"),
        reduce(or_, broken).alias("broken"),
    )


def parse(envelopes: DataFrame, table: str) -> DataFrame:
    """Events of one table: position, key, operation and field maps."""
    return messages(envelopes, table).filter(F.col("table") == table).select("seq", "key", "op", "data", "old")


def checked(envelopes: DataFrame, table: str, schema: StructType, key: str) -> DataFrame:
    """Events with their known fields, and the ``reason`` for which an event cannot be applied, NULL if it can.

    No value is lost or made NULL to fit: a message that is not read in full, an unknown operation, a key or a value that
    its column cannot hold keeps the whole event out.
    """
    types = {f.name.lower(): f.dataType for f in schema.fields}
    events = normalise(messages(envelopes, table), list(types))

    def unfit(value: Column, kind: DataType) -> Column:
        return value.isNotNull() & value.try_cast(kind).isNull()

    values = [unfit(F.try_element_at("data", F.lit(c)), kind) for c, kind in types.items()]
    reason = (
        F.when(F.col("table").isNull() | F.col("op").isNull(), "message")
        .when(~F.col("op").isin(*OPERATIONS), "operation")
        .when(F.col("broken"), "data")
        .when(F.col("key").isNull() | unfit(F.col("key"), types[key.lower()]), "key")
        .when(reduce(or_, values), "value")
    )
    return events.withColumn("reason", reason)


def accepted(events: DataFrame) -> DataFrame:
    """The checked events that can be applied, with their changed fields."""
    return changed_fields(events.filter(F.col("reason").isNull()).select("seq", "key", "op", "data", "old"))


def rejected(events: DataFrame) -> DataFrame:
    """The others: position, reason and the message as it came."""
    return events.filter(F.col("reason").isNotNull()).select("seq.*", "reason", "text")


def known_fields(fields: Column, columns: Sequence[str]) -> Column:
    """Fields of the target table, names in lower case.  Of names differing only in case the last counts."""
    entries = F.map_entries(fields)

    def last(name: str) -> Column:
        return F.try_element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), F.lit(-1))

    found = [(name, last(name)) for name in dict.fromkeys(c.lower() for c in columns)]
    pairs = [F.when(e.isNotNull(), F.struct(F.lit(name).alias("key"), e["value"].alias("value"))) for name, e in found]
    known = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p.isNotNull()))
    return F.when(fields.isNotNull(), known).otherwise(F.create_map().cast(FIELDS))


def normalise(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Events with their known fields only; these are computed once, whatever uses them."""
    known = F.struct(*[known_fields(F.col(c), columns).alias(c) for c in ("data", "old")])
    return events.select(*[c for c in events.columns if c not in ("data", "old")], F.inline(F.array(known)))


def changed_fields(events: DataFrame) -> DataFrame:
    """Add ``changed``: for updates the fields whose value differs from the old one, empty for other events."""
    differs = F.map_filter("data", lambda k, v: ~v.eqNullSafe(F.try_element_at(F.col("old"), k)))
    none = F.map_filter("data", lambda k, v: F.lit(False))
    changed = F.when(F.col("op") == "UPDATE", differs).otherwise(none)
    return events.select("*", F.inline(F.array(F.struct(changed.alias("changed")))))


def fold(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per key from its events: what happened last and the value each column ends with.

    ``reset`` is the operation of the last DELETE, or INSERT with any known field; ``exists`` tells whether the
    key has a row afterwards (NULL: only if it was stored before); ``c_<column>`` is a struct whose ``set`` tells
    whether the events determine the column, ``n_<column>`` the value for a row that did not exist before.
    """
    names = [c.lower() for c in columns]
    usable = F.size("data") > 0
    is_update = (F.col("op") == "UPDATE") & usable
    is_reset = (F.col("op") == "DELETE") | ((F.col("op") == "INSERT") & usable)

    def last_change(name: str) -> Column:
        hit = is_update & F.map_contains_key("changed", name)
        return F.max(F.when(hit, F.struct("seq", F.try_element_at("changed", F.lit(name)).alias("value"))))

    summary = events.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.max_by(F.struct("seq", "op", "data"), F.when(is_reset, F.col("seq"))).alias("reset"),
        F.min_by(F.col("data"), F.when(is_update, F.col("seq"))).alias("first_update"),
        F.max(F.when(is_update, F.col("seq"))).alias("last_update_seq"),
        F.max(usable | (F.col("op") == "DELETE")).alias("counts"),
        *[last_change(n).alias(f"last_{n}") for n in names],
    )
    summary = stage(summary.filter("counts").drop("counts"), "events-by-key")

    # A key updated again after its last DELETE starts from the first update after it.
    reborn = summary.filter((F.col("reset.op") == "DELETE") & (F.col("last_update_seq") > F.col("reset.seq"))).select(
        "key", F.col("reset.seq").alias("reset_seq")
    )
    restart = (
        events.filter(is_update)
        .select("key", "seq", "data")
        .join(reborn, "key")
        .filter(F.col("seq") > F.col("reset_seq"))
        .groupBy("key")
        .agg(F.min_by("data", "seq").alias("restart"))
    )
    rows = summary.join(restart, "key", "left")

    inserted = F.coalesce(F.col("reset.op") == "INSERT", F.lit(False))
    deleted = F.coalesce(F.col("reset.op") == "DELETE", F.lit(False))
    start = (
        F.when(inserted, F.col("reset.data")).when(deleted, F.col("restart")).otherwise(F.col("first_update"))
    )
    exists = F.when(inserted, True).when(deleted, F.col("restart").isNotNull())

    def outcome(name: str) -> list[Column]:
        last = F.col(f"last_{name}")
        patched = last.isNotNull() & (F.col("reset.seq").isNull() | (last["seq"] > F.col("reset.seq")))
        fresh = F.when(patched, last["value"]).otherwise(F.try_element_at(F.col("start"), F.lit(name)))
        return [patched.alias(f"p_{name}"), fresh.alias(f"v_{name}")]

    return rows.withColumn("start", start).select(
        "key", exists.alias("exists"), *[c for n in names for c in outcome(n)]
    )


def apply(stored: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """The stored table after all events (as ``changed_fields`` gives them), one row per key.

    The stored table is not shuffled unless the set of changed keys is too large to broadcast.
    """
    columns = stored.columns
    outcome = stage(fold(events, columns), "outcome")
    types = {f.name: f.dataType for f in stored.schema.fields}
    on_key = F.col(key).cast("string") == F.col("key")

    def fitted(text: Column, c: str) -> Column:
        """The text as the column's type; what does not fit stops the job instead of turning NULL."""
        cast = text.try_cast(types[c])
        bad = F.raise_error(F.concat(F.lit(f"{c} cannot hold "), text)).cast(types[c])
        return F.when(text.isNull() | cast.isNotNull(), cast).otherwise(bad)

    def value(c: str) -> Column:
        return fitted(F.col(f"v_{c.lower()}"), c)

    # Keys stored before: patched in place, or replaced if the events hold a reset.
    def updated(c: str) -> Column:
        if c == key:
            return F.col(c)
        return F.when(F.col("exists") | F.col(f"p_{c.lower()}"), value(c)).otherwise(F.col(c))

    kept = (
        stored.join(outcome, on_key, "left")
        .filter(F.col("key").isNull() | F.coalesce(F.col("exists"), F.lit(True)))
        .select(*[updated(c).alias(c) for c in columns])
    )
    # Keys not stored before.
    present = stored.select(F.col(key).cast("string").alias("key")).join(outcome.select("key"), "key", "left_semi")
    added = (
        outcome.filter(F.coalesce(F.col("exists"), F.lit(True)))
        .join(present, "key", "left_anti")
        .select(*[(fitted(F.col("key"), c) if c == key else value(c)).alias(c) for c in columns])
    )
    return kept.unionByName(added)
