from __future__ import annotations

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from siltstone.sources import TableStore
from siltstone.sources.tables import ConcurrentWrite


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def content(store, table="t"):
    return sorted(tuple(r) for r in store.read(table).collect())


def test_append_keeps_old_rows_and_aligns_by_name(store, rows_of):
    store.append("t", rows_of("a bigint, b string", (1, "x")))
    store.append("t", rows_of("b string, a int", ("y", 2)))
    store.append("t", rows_of("a bigint", (3,)))
    assert content(store) == [(1, "x"), (2, "y"), (3, None)]
    with pytest.raises(ValueError, match="columns not in target"):
        store.append("t", rows_of("a bigint, z string", (1, "x")))


def test_append_of_nothing_commits_nothing(store, rows_of):
    assert store.append("t", rows_of("a bigint")) == 0
    assert not store.exists("t")


def test_repeating_a_batch_replaces_it(store, rows_of):
    store.append("t", rows_of("a bigint", (1,)), batch="day 1")
    store.append("t", rows_of("a bigint", (2,)), batch="day 2")
    store.append("t", rows_of("a bigint", (3,)), batch="day 2")
    assert content(store) == [(1,), (3,)]
    assert store.row_count("t") == 2


def test_two_writers_lose_nothing(store, rows_of, monkeypatch):
    """A second writer commits between the first one's read and its commit."""
    store.append("t", rows_of("a bigint", (0,)))
    write = TableStore._write_part

    def interrupted(self, table, rows, *rest):
        part = write(self, table, rows, *rest)
        monkeypatch.setattr(TableStore, "_write_part", write)
        self.append(table, rows_of("a bigint", (100,)), batch="other")
        return part

    monkeypatch.setattr(TableStore, "_write_part", interrupted)
    store.append("t", rows_of("a bigint", (10,)), batch="own")
    assert content(store) == [(0,), (10,), (100,)]
    monkeypatch.setattr(TableStore, "_write_part", interrupted)
    with pytest.raises(ConcurrentWrite):
        store.replace("t", rows_of("a bigint", (5,)))
    assert content(store) == [(0,), (10,), (100,)]


def test_many_writers_at_once(store, rows_of):
    frames = [rows_of("a bigint", (n,)) for n in range(8)]
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda rows: store.append("t", rows), frames))
    assert content(store) == [(n,) for n in range(8)]


def test_watermark_comes_from_the_manifest(store, rows_of):
    schema = "a bigint, created_at timestamp_ntz, updated_at timestamp_ntz"
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 3, 4, 5, 600)
    store.append("t", rows_of(schema, (1, None, None)))
    assert store.watermark("t") is None
    store.append("t", rows_of(schema, (2, early, None), (3, early, late)), batch="b", after=early)
    assert store.watermark("t") == late
    assert store.batch_start("t", "b") == early
    assert store.batch_start("t", "c") is None


def test_text_is_no_partition_column(store, rows_of):
    with pytest.raises(ValueError, match="empty text"):
        store.replace("t", rows_of("a bigint, s string", (1, "")), partition_by=["s"])


def test_empty_replacement(store, rows_of):
    some, none = rows_of("a bigint", (1,)), rows_of("a bigint")
    assert store.replace_unless_empty("t", some) == 1
    assert store.replace_unless_empty("t", none) == 0
    assert content(store) == [(1,)]
    assert store.replace("t", none) == 0
    assert content(store) == []
    assert store.read("t").schema.names == ["a"]


def test_a_table_can_be_replaced_from_itself(store, rows_of):
    store.replace("t", rows_of("a bigint", (1,), (2,)))
    store.replace("t", store.read("t").withColumn("a", F.col("a") + 1))
    assert content(store) == [(2,), (3,)]


def test_a_failed_write_leaves_the_old_content(store, rows_of):
    store.replace("t", rows_of("a bigint", (1,)))
    bad = rows_of("a bigint", (5,)).select(F.when(F.col("a") == 5, F.raise_error(F.lit("no"))).cast("bigint").alias("a"))
    with pytest.raises(Exception, match="no"):
        store.replace("t", bad)
    assert content(store) == [(1,)]


def test_a_commit_on_an_old_snapshot_fails_and_leaves_nothing(store, rows_of):
    store.replace("t", rows_of("a bigint", (1,)))
    seen = store.snapshot("t")
    store.append("t", rows_of("a bigint", (2,)))
    folders = set(os.listdir(f"{store.root}/t"))
    labelled = rows_of("a bigint, _label string", (3, "x"))
    with pytest.raises(ConcurrentWrite):
        store.replace("t", rows_of("a bigint", (3,)), base=seen)
    with pytest.raises(ConcurrentWrite):
        store.revise(seen, lambda part: True, labelled, {"x": "x"})
    assert set(os.listdir(f"{store.root}/t")) == folders
    assert sorted(tuple(r) for r in seen.rows().collect()) == [(1,)] and content(store) == [(1,), (2,)]


def test_revise_writes_several_parts_in_one_commit(store, rows_of):
    store.append("t", rows_of("a bigint", (1,)), batch="old")
    store.append("t", rows_of("a bigint", (2,)), batch="kept")
    rows = rows_of("a bigint, _label string", (3, "x"), (5, "x"), (4, "y"))
    base = store.snapshot("t")
    found = store.revise(base, lambda p: p["batch"] == "kept", rows, {"x": "a", "y": "b", "z": "b"}, spans=["a"])
    assert found == {"x": 2, "y": 1, "z": 0} and content(store) == [(2,), (3,), (4,), (5,)]
    after = store.snapshot("t")
    assert after.version == base.version + 1 and after.row_count == 4
    assert [p["spans"]["a"] for p in after.parts if p["batch"] == "a"] == [["3", "5"]]
    assert [r.a for r in after.batch("b").collect()] == [4]
    store.replace("t", rows_of("a bigint", (9,)))
    assert store.vacuum("t", keep=1, min_age_hours=-1) == 3


def test_partitioned_table(store, rows_of):
    store.replace("t", rows_of("a bigint, m int", (1, 1), (2, 2)), partition_by=["m"])
    assert content(store) == [(1, 1), (2, 2)]
    store.replace("t", rows_of("a bigint, m int"), partition_by=["m"])
    assert content(store) == []


def test_vacuum_spares_live_and_young_parts(store, rows_of):
    for n in range(4):
        store.replace("t", rows_of("a bigint", (n,)))
    assert store.vacuum("t", keep=2) == 0
    assert store.vacuum("t", keep=2, min_age_hours=-1) == 2
    assert content(store) == [(3,)]


def test_digests_tell_states_apart(store, rows_of):
    """Order, files and load times don't matter; a changed, doubled, swapped or missing row does."""
    schema = "a bigint, b bigint, s string, load_timestamp timestamp_ntz"
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    rows = [(1, 2, "x", early), (3, None, "", early), (None, 3, None, early)]

    def digest(*given):
        store.replace("t", rows_of(schema, *given))
        return store.digest("t")

    first = digest(*rows)
    assert first.rows == 3 and digest(*[(*r[:3], late) for r in reversed(rows)]) == first
    store.replace("t", rows_of(schema, rows[0]))
    store.append("t", rows_of(schema, *rows[1:]))
    assert store.digest("t") == first
    others = [
        rows[:2],
        [*rows, rows[0]],
        [*rows, rows[0], rows[0]],
        [(2, 1, "x", early), *rows[1:]],
        [rows[0], (None, 3, "", early), rows[2]],
        [(1, None, "x", early), (3, 2, "", early), rows[2]],
        [],
    ]
    found = [digest(*other) for other in others]
    assert first not in found and len(set(found)) == len(found)
