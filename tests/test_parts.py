"""Tables of many parts: bounded files, one snapshot, compaction that breaks off."""

import os

import pandas as pd
import pytest
from pyspark.sql.types import StructType

from streams import as_stream, rows
from tidewatch.streaming import incremental, parts

SCHEMA = StructType().add("x", "long").add("name", "string")


def add_part(table, number, n=3):
    folder = f"{table}/batch={number}"
    os.makedirs(folder)
    pd.DataFrame({"x": [number * 10 + i for i in range(n)], "name": [None, "a", "b"][:n]}).astype({"x": "int64", "name": "object"}).to_parquet(f"{folder}/part-0.parquet")


def expected(numbers):
    return sorted((k * 10 + i, name, k) for k in numbers for i, name in enumerate((None, "a", "b")))


def held(spark, table):
    return sorted(tuple(r) for r in parts.read(spark, table, SCHEMA).collect())


def files_below(table):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(table) for name in names)


def test_files_stay_few_over_a_hundred_batches(spark, tmp_path):
    table, most = str(tmp_path / "rows"), 0
    for k in range(101):
        add_part(table, k)
        if k % 4 == 0:
            parts.compact(spark, table, SCHEMA, k, fan=4)
            most = max(most, files_below(table))
    assert held(spark, table) == expected(range(101))
    # Three of each size, those of the newest batches, and what the last manifest has replaced.
    assert most <= 3 * 4 + 5 + 4 * 4
    assert len([n for n in os.listdir(f"{table}/_manifest") if n.endswith(".json")]) <= 2


def test_empty_and_missing_tables(spark, tmp_path):
    table = str(tmp_path / "rows")
    assert held(spark, table) == [] and parts.read(spark, table, SCHEMA).columns == ["x", "name", "batch"]
    parts.compact(spark, table, SCHEMA, 5, fan=2)
    for k in range(4):
        add_part(table, k, 0 if k < 2 else 3)
    parts.compact(spark, table, SCHEMA, 4, fan=2)
    assert held(spark, table) == expected((2, 3))


def test_parts_that_are_being_written_are_not_read(spark, tmp_path):
    table = str(tmp_path / "rows")
    for k in range(3):
        add_part(table, k)
    os.makedirs(f"{table}/batch=2/_temporary")
    assert held(spark, table) == expected((0, 1))


@pytest.mark.parametrize("broken", ["write_json", "file_system"])
def test_compaction_that_breaks_off(spark, tmp_path, monkeypatch, broken):
    """Before the manifest is there the table is as it was; after it, only the deletion of the old parts is left over."""
    table = str(tmp_path / "rows")
    for k in range(5):
        add_part(table, k)

    real, calls = getattr(parts, broken), []

    def breaks(spark, path, *rest):
        if broken == "write_json" or "/merged/" in str(path):
            calls.append(path)
            raise RuntimeError("lost")
        return real(spark, path, *rest)

    with monkeypatch.context() as patched:
        patched.setattr(parts, broken, breaks)
        if broken == "file_system":  # one compaction is done, the next one finds a merged part among its own
            patched.undo()
            parts.compact(spark, table, SCHEMA, 2, fan=2)
            patched.setattr(parts, broken, breaks)
        with pytest.raises(RuntimeError):
            parts.compact(spark, table, SCHEMA, 4, fan=2)
    assert calls and held(spark, table) == expected(range(5))
    parts.compact(spark, table, SCHEMA, 4, fan=2)
    assert held(spark, table) == expected(range(5))
    _, manifest = parts._manifest(spark, table)
    assert [p["size"] for p in manifest["parts"]] == [2]
    # A reader of the snapshot before still finds its parts; nothing that broke off is left beside them.
    add_part(table, 5)
    before = parts.read(spark, table, SCHEMA)
    parts.compact(spark, table, SCHEMA, 6, fan=2)
    assert sorted(tuple(r) for r in before.collect()) == expected(range(6)) == held(spark, table)
    parts_now = {p["folder"].removeprefix("merged/") for p in parts._manifest(spark, table)[1]["parts"] + manifest["parts"]}
    assert set(os.listdir(f"{table}/merged")) <= parts_now | {f.removeprefix("merged/") for f in manifest["gone"]} | {
        f.removeprefix("merged/") for f in parts._manifest(spark, table)[1]["gone"]}


def test_streams_put_their_parts_together(spark, tmp_path, monkeypatch):
    """A stream of eight batches with a fan of two has the results of one with a part for each."""
    logins = pd.DataFrame({
        "user_id": [1, 1, 2, 1, 2, 2, 1, 1] * 5, "event_type": ["fail"] * 40, "arrival": range(40), "us": [k * 2_000_000 for k in range(40)],
    })
    told = []
    for name, fan in (("plain", 100), ("fanned", 2)):
        monkeypatch.setattr(parts, "FAN", fan)
        stream = as_stream(spark, logins, str(tmp_path / f"in-{name}"), batches=8)
        job = incremental.failures(stream, str(tmp_path / name), delay_s=0)
        job.writer.trigger(availableNow=True).start().awaitTermination()
        job.finish()
        told.append(rows(job.read(spark), "user_id", "first_us", "last_us"))
        assert rows(job.changes(spark), "user_id", "first_us", "last_us") == told[-1]
    assert told[0] == told[1] and told[0]
    assert len(os.listdir(tmp_path / "plain" / "rows")) > 6 and parts._manifest(spark, str(tmp_path / "fanned" / "rows"))[0] >= 1
