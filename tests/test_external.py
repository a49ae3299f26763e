import asyncio
import json
import sys
import time

import pytest
from pyspark import cloudpickle

from dimweave import Lookup, external_lookup_join, lookup_join
from dimweave.operators import Overlap, fetch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYED = {"left_field": "u", "key_expr": "tp_%s"}


class FileStore:
    """A store in a JSON file that writes down what it was asked for."""

    def __init__(self, folder):
        self.folder = folder
        with open(f"{folder}/store.json") as f:
            self.values = json.load(f)

    def get_many(self, keys):
        assert len(keys) == len(set(keys)) <= 3
        with open(f"{self.folder}/asked.txt", "a") as f:
            f.write("".join(k + "\n" for k in keys))
        if "tp_bad" in keys:
            raise OSError("store is down")
        return {k: self.values[k] for k in keys if k in self.values}

    def close(self):
        with open(f"{self.folder}/closed.txt", "a") as f:
            f.write("closed\n")


@pytest.fixture
def store(tmp_path):
    folder = str(tmp_path)

    def fill(values):
        (tmp_path / "store.json").write_text(json.dumps(values))
        (tmp_path / "asked.txt").write_text("")
        return lambda: FileStore(folder)

    fill.asked = lambda: (tmp_path / "asked.txt").read_text().split()
    fill.closed = lambda: (tmp_path / "closed.txt").read_text().split()
    return fill


def lines_of(spark, users, partitions=1):
    rows = [(i, f"u={u}|i={i}") for i, u in enumerate(users)]
    return spark.createDataFrame(rows, "id int, line string").coalesce(partitions)


def texts(frame):
    return sorted(r["enriched"] for r in frame.collect())


def test_same_as_a_table(spark, store):
    values = {"tp_1": "n=one", "tp_2": "", "tp_3": "junk"}
    dim = spark.createDataFrame(list(values.items()), "dim_key string, dim_value string")
    lines = lines_of(spark, [1, 2, 3, 4, 1, 1, 2], 2)
    for options in (
        {}, {"how": "inner"}, {"how": "inner", "blank_is_miss": False}, {"on_miss": "blank_row"},
    ):
        want = texts(lookup_join(lines, dim, **KEYED, **options))
        for distinct in (False, True):
            got = external_lookup_join(
                lines, store(values), batch_size=3, distinct_keys=distinct, **KEYED, **options
            )
            assert texts(got) == want


def test_asks_once_per_key(spark, store):
    lines = lines_of(spark, [1, 2, 1, 1, 5, 2, 7, 8] * 20)
    got = external_lookup_join(lines, store({"tp_1": "n=1"}), batch_size=3, **KEYED)
    assert sum("n=1" in t for t in texts(got)) == 60
    assert sorted(store.asked()) == ["tp_1", "tp_2", "tp_5", "tp_7", "tp_8"]
    assert store.closed() == ["closed"]


def test_batches_follow_the_arrow_limit(spark, store, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    lines = lines_of(spark, [1] * 40)
    texts(external_lookup_join(lines, store({}), batch_size=3, **KEYED))
    assert store.asked() == ["tp_1"] * 4


def test_hash_values(spark, store):
    opened = store({"tp_1": {"b": "2", "a": "1"}, "tp_2": {}})
    lines = lines_of(spark, [1, 2, 3])
    lookup = Lookup(dim_kind="hash", **KEYED)
    got = external_lookup_join(lines, opened, lookup, batch_size=3)
    assert texts(got) == ["u=1|i=0|b=2|a=1", "u=2|i=1", "u=3|i=2"]


def test_errors(spark, store):
    lines = lines_of(spark, [1, "bad"])
    opened = store({"tp_1": "n=1"})
    with pytest.raises(Exception, match="store is down"):
        external_lookup_join(lines, opened, batch_size=3, **KEYED).collect()
    got = external_lookup_join(lines, opened, batch_size=1, on_error="miss", **KEYED)
    assert texts(got) == ["u=1|i=0|n=1", "u=bad|i=1"]
    with pytest.raises(ValueError):
        fetch(lines, opened, on_error="ignore")
    with pytest.raises(ValueError):
        fetch(lines, opened, batch_size=0)


def test_plain_function(spark):
    def open_store():
        return lambda keys: {k: "k=" + k for k in keys}

    got = external_lookup_join(lines_of(spark, [4]), open_store, **KEYED)
    assert texts(got) == ["u=4|i=0|k=tp_4"]


class SlowStore:
    """Answers after a while; notes how many requests are under way at once, and each attempt."""

    def __init__(self, folder, delay, fails=0):
        self.folder, self.delay, self.fails = folder, delay, fails
        self.now = 0

    def note(self, name, text):
        with open(f"{self.folder}/{name}", "a") as f:
            f.write(f"{text}\n")

    async def get_many(self, keys):
        self.now += 1
        self.note("at_once", self.now)
        self.note("attempts", keys[0])
        try:
            slow = "tp_slow" in keys
            await asyncio.sleep(30 if slow else self.delay)
            if "tp_flaky" in keys and self.fails > 0:
                self.fails -= 1
                raise OSError("no answer just now")
            return {k: "n=" + k for k in keys if not k.endswith("0")}
        finally:
            self.now -= 1

    async def close(self):
        self.note("closed", "closed")


def noted(folder, name):
    path = folder / name
    return path.read_text().split() if path.exists() else []


def slow_lookup(spark, folder, users, overlap, delay=0.05, fails=0, **options):
    path = str(folder)

    async def open_store():
        return SlowStore(path, delay, fails)

    return external_lookup_join(
        lines_of(spark, users), open_store, batch_size=1, overlap=overlap, **KEYED, **options
    )


def test_requests_overlap(spark, tmp_path):
    users = [u for u in range(1, 201)] * 2
    texts(slow_lookup(spark, tmp_path, [1], Overlap()))  # workers are up
    start = time.monotonic()
    got = texts(slow_lookup(spark, tmp_path, users, Overlap(in_flight=40)))
    spent = time.monotonic() - start
    want = [f"u={u}|i={i}" + ("" if u % 10 == 0 else f"|n=tp_{u}") for i, u in enumerate(users)]
    assert got == sorted(want)
    assert len(noted(tmp_path, "attempts")) == 201
    assert max(map(int, noted(tmp_path, "at_once"))) == 40
    assert spent < 200 * 0.05  # one after the other they would take longer
    assert noted(tmp_path, "closed") == ["closed"] * 2


def test_timeout_is_a_miss_or_fails(spark, tmp_path):
    hasty = Overlap(in_flight=5, timeout=0.5)
    got = slow_lookup(spark, tmp_path, [1, "slow", 2], hasty, on_error="miss")
    assert texts(got) == ["u=1|i=0|n=tp_1", "u=2|i=2|n=tp_2", "u=slow|i=1"]
    with pytest.raises(Exception, match="TimeoutError"):
        slow_lookup(spark, tmp_path, [1, "slow", 2], hasty).collect()


def test_retries(spark, tmp_path):
    patient = Overlap(retries=3, backoff=0.01)
    got = slow_lookup(spark, tmp_path, ["flaky"], patient, fails=3)
    assert texts(got) == ["u=flaky|i=0|n=tp_flaky"]
    assert len(noted(tmp_path, "attempts")) == 4
    with pytest.raises(Exception, match="no answer just now"):
        slow_lookup(spark, tmp_path, ["flaky"], patient, fails=4).collect()


@pytest.mark.parametrize("bad", [{"in_flight": 0}, {"timeout": 0}, {"retries": -1}, {"backoff": -1}])
def test_overlap_is_checked(bad):
    with pytest.raises(ValueError):
        Overlap(**bad)
