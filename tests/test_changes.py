"""The fold against applying the events one by one in plain Python."""

import json
import random

import pytest

from restock.operators import changes as CH
from restock.streaming.replica import Replica

COLUMNS = ["id", "a", "b"]
SCHEMA = "id bigint, a string, b bigint"


def replay(stored: dict, events: list[dict]) -> dict:
    table = {k: dict(v) for k, v in stored.items()}
    for e in events:
        key, op = e["shardingKey"], e["type"]
        data = {k.lower(): v for k, v in (e.get("data") or {}).items() if k.lower() in COLUMNS}
        old = {k.lower(): v for k, v in (e.get("oldData") or {}).items() if k.lower() in COLUMNS}
        if op == "DELETE":
            table.pop(key, None)
        elif not data:
            continue
        elif op == "INSERT" or key not in table:
            table[key] = {c: data.get(c) for c in COLUMNS}
        else:
            table[key].update({c: v for c, v in data.items() if v != old.get(c)})
        if key in table:
            table[key]["id"] = key
    return table


def random_events(rng: random.Random, n: int, keys: int) -> list[dict]:
    events = []
    for _ in range(n):
        key = "0" if rng.random() < 0.35 else str(rng.randrange(keys))  # one hot key
        op = rng.choice(["INSERT", "UPDATE", "UPDATE", "UPDATE", "DELETE"])
        fields = {"A": rng.choice(["x", "y", None]), "b": rng.choice(["1", "2", "3"]), "extra": "e"}
        data = {"ID": key, **{k: v for k, v in fields.items() if rng.random() < 0.7}}
        if rng.random() < 0.1:
            data = {"extra": "only"}
        if rng.random() < 0.05:
            data = {}
        old = {"id": key, "a": rng.choice(["x", "y", None]), "B": rng.choice(["1", "2"])} if rng.random() < 0.8 else None
        e = {"table": "t", "type": op, "shardingKey": key, "data": data}
        if old is not None:
            e["oldData"] = old
        events.append(e)
    return events


def envelopes(spark, events, start=0):
    def text(e):
        if e["shardingKey"].endswith("3"):  # nested as text
            e = {**e, "data": json.dumps(e["data"])}
        return json.dumps(e)

    rows = [(0, start + i, text(e)) for i, e in enumerate(events)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "partition int, offset bigint, value string")


def as_dict(df) -> dict:
    rows = df.collect()
    found = {str(r.id): {"id": str(r.id), "a": r.a, "b": None if r.b is None else str(r.b)} for r in rows}
    assert len(found) == len(rows)
    return found


def stored_rows(spark, table: dict):
    rows = [(int(k), v["a"], None if v["b"] is None else int(v["b"])) for k, v in table.items()]
    return spark.createDataFrame(rows, SCHEMA)


START = {str(k): {"id": str(k), "a": "s", "b": "9"} for k in range(0, 40, 2)}


@pytest.mark.parametrize("seed,n", [(1, 40), (2, 200), (3, 600)])
def test_fold_equals_replay(spark, seed, n):
    events = random_events(random.Random(seed), n, 45)
    parsed = CH.changed_fields(CH.normalise(CH.parse(envelopes(spark, events), "t"), COLUMNS))
    once = CH.apply(stored_rows(spark, START), parsed, "id")
    assert as_dict(once) == replay(START, events)


def test_insert_only_of_unknown_fields_is_ignored(spark):
    events = [{"table": "t", "type": "INSERT", "shardingKey": "1", "data": {"zz": 1}}]
    parsed = CH.changed_fields(CH.normalise(CH.parse(envelopes(spark, events), "t"), COLUMNS))
    assert as_dict(CH.apply(stored_rows(spark, START), parsed, "id")) == START


def test_delete_without_data_and_other_tables(spark):
    events = [
        {"table": "t", "type": "DELETE", "shardingKey": "2", "data": {}},
        {"table": "other", "type": "DELETE", "shardingKey": "4", "data": {}},
    ]
    parsed = CH.changed_fields(CH.normalise(CH.parse(envelopes(spark, events), "t"), COLUMNS))
    left = as_dict(CH.apply(stored_rows(spark, START), parsed, "id"))
    assert left == {k: v for k, v in START.items() if k != "2"}


def test_names_differing_in_case(spark):
    events = [{"table": "t", "type": "INSERT", "shardingKey": "1", "data": {"A": "first", "a": "last"}}]
    rows = CH.normalise(CH.parse(envelopes(spark, events), "t"), COLUMNS).collect()
    assert rows[0].data == {"a": "last"}


def test_replica_replays_batches_and_compacts(spark, tmp_path):
    events = random_events(random.Random(7), 300, 30)
    replica = Replica(spark, str(tmp_path / "r"), "t", "id", stored_rows(spark, START).schema)
    replica.create(stored_rows(spark, START))
    parts = [events[:100], events[100:200], events[200:]]
    for i, part in enumerate(parts):
        replica.append(envelopes(spark, part, 100 * i), i)
    replica.append(envelopes(spark, parts[1], 100), 1)  # delivered twice
    expected = replay(START, events)
    assert as_dict(replica.current()) == expected
    replica.compact(1)
    assert as_dict(replica.current()) == expected
    replica.compact(2)
    assert as_dict(replica.current()) == expected


def test_replica_stream_resumes(spark, tmp_path):
    events = random_events(random.Random(8), 120, 20)
    queue = str(tmp_path / "queue")
    replica = Replica(spark, str(tmp_path / "r"), "t", "id", stored_rows(spark, START).schema)
    replica.create(stored_rows(spark, START))
    for i in (0, 60):
        messages = envelopes(spark, events[i : i + 60], i)
        messages.write.mode("append").parquet(queue)
        stream = spark.readStream.schema(messages.schema).parquet(queue)
        replica.run(stream, str(tmp_path / "checkpoint")).awaitTermination()
        assert as_dict(replica.current()) == replay(START, events[: i + 60])


def test_what_cannot_be_applied_is_kept_apart(spark):
    good = {"table": "t", "type": "INSERT", "shardingKey": "1", "data": {"id": "1", "a": "x", "b": "7"}}
    bad = [
        "not json", "{\"table\":\"t\"}", json.dumps({**good, "type": "MERGE"}), json.dumps({**good, "data": "{oops"}),
        json.dumps({**good, "shardingKey": "one"}), json.dumps({**good, "shardingKey": None}),
        json.dumps({**good, "data": {"id": "1", "b": "seven"}}),
    ]
    texts = [json.dumps(good), *bad, json.dumps({**good, "table": "other"}), None]
    rows = spark.createDataFrame([(0, i, x) for i, x in enumerate(texts)], "partition int, offset bigint, value string")
    events = CH.checked(rows, "t", spark.createDataFrame([], SCHEMA).schema, "id")
    assert [r.seq.offset for r in CH.accepted(events).collect()] == [0]
    reasons = {r.offset: r.reason for r in CH.rejected(events).collect()}
    assert reasons == {1: "message", 2: "message", 3: "operation", 4: "data", 5: "key", 6: "key", 7: "value", 9: "message"}


def test_a_value_that_does_not_fit_stops_the_fold(spark):
    events = [{"table": "t", "type": "UPDATE", "shardingKey": "2", "data": {"b": "abc"}}]
    unchecked = CH.changed_fields(CH.normalise(CH.parse(envelopes(spark, events), "t"), COLUMNS))
    with pytest.raises(Exception, match="b cannot hold abc"):
        CH.apply(stored_rows(spark, START), unchecked, "id").collect()


def test_names_differing_in_case_need_no_setting(spark):
    fields = spark.sql("select map('A', '1', 'a', '2', 'c', '3') as f union all select null")
    assert spark.conf.get("spark.sql.mapKeyDedupPolicy") == "EXCEPTION"
    assert sorted(str(r[0]) for r in fields.select(CH.known_fields(fields["f"], ["a", "b"])).collect()) == ["{'a': '2'}", "{}"]


def test_a_new_checkpoint_logs_after_the_old_one(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), "t", "id", spark.createDataFrame([], SCHEMA).schema)
    replica.create(stored_rows(spark, START))
    events = [{"table": "t", "type": "INSERT", "shardingKey": str(k), "data": {"id": str(k), "b": "5"}} for k in (51, 52)]
    for i, e in enumerate(events):
        queue = str(tmp_path / f"q{i}")
        envelopes(spark, [e], i).write.parquet(queue)
        stream = spark.readStream.schema("partition int, offset bigint, value string").parquet(queue)
        replica.run(stream, str(tmp_path / f"c{i}")).awaitTermination()
    assert {"51", "52"} <= set(as_dict(replica.current()))
    assert replica.rejects().count() == 0


def test_a_stream_started_anew_logs_nothing_twice(spark, tmp_path):
    """Three partitions, gaps in the offsets, messages that are rejected, and a second checkpoint that reads from the beginning."""
    events = random_events(random.Random(9), 90, 20)
    texts = [json.dumps(e) for e in events] + ['{"table":"t","type":"UPDATE","shardingKey":"1","data":{"b":"no number"}}', "broken"]
    rows = [(i % 3, 10 * i if i % 3 == 2 else i, t) for i, t in enumerate(texts)]
    messages = spark.createDataFrame(rows, "partition int, offset bigint, value string")
    queue = str(tmp_path / "queue")
    replica = Replica(spark, str(tmp_path / "r"), "t", "id", stored_rows(spark, START).schema)
    replica.create(stored_rows(spark, START))

    def run(checkpoint):
        stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(queue)
        replica.run(stream, str(tmp_path / checkpoint)).awaitTermination()
        log = spark.read.parquet(f"{replica.root}/log")
        return log.count(), replica.rejects().count(), sorted(map(str, replica.current().collect()))

    messages.filter("offset < 40").coalesce(1).write.parquet(queue)
    first = run("one")
    messages.filter("offset >= 40").repartition(2).write.mode("append").parquet(queue)
    both = run("one")
    assert first[0] + first[1] == messages.filter("offset < 40").count() and both[0] + both[1] == len(rows) and both[1] == 2
    assert run("two") == both
    messages.filter("offset < 3").withColumn("offset", messages["offset"] + 5_000).write.mode("append").parquet(queue)
    assert run("two")[0] == both[0] + messages.filter("offset < 3").count()


def test_no_messages(spark, tmp_path):
    replica = Replica(spark, str(tmp_path / "r"), "t", "id", stored_rows(spark, START).schema)
    replica.create(stored_rows(spark, START))
    replica.append(envelopes(spark, []), 0)
    replica.append(envelopes(spark, []), 1)
    assert as_dict(replica.current()) == START
