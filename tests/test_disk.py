"""What a load of changes leaves on disk, and holds there meanwhile."""

from __future__ import annotations

import datetime as dt
import os

from siltstone import session
from siltstone.functions.dates import AsOf
from siltstone.functions.text import blank_to_null
from siltstone.operators.cleanse import TableSpec
from siltstone.plans import changes, loads
from siltstone.sources import TableStore

SCHEMA = "a bigint, s string, more string, created_at timestamp_ntz, updated_at timestamp_ntz, load_timestamp timestamp_ntz, source_system string"
SPEC = TableSpec("t", ("a",), ("a", "s"), clean={"s": blank_to_null}, required=("s",))


def at(day):
    return dt.datetime(2024, 1, day)


def test_a_load_of_changes_keeps_one_copy_of_a_row(spark, rows_of, tmp_path, monkeypatch):
    """Its intermediate tables go with their table, winners that have been replaced go at once, and raw values aren't held twice."""
    monkeypatch.setattr(loads, "SPECS", {"t": SPEC})
    monkeypatch.setattr(loads, "PROFILES", {})
    kept, columns, run = [], {}, loads.TableChange.run
    keep = session.Stage.keep

    def noted(self, name, rows):
        found = keep(self, name, rows)
        columns[name] = found.columns
        return found

    def ran(self, *given):
        done = run(self, *given)
        kept.extend(os.listdir(self.stage.root))
        return done

    monkeypatch.setattr(session.Stage, "keep", noted)
    monkeypatch.setattr(loads.TableChange, "run", ran)
    store = TableStore(spark, str(tmp_path))
    rows = [(1, " x", "m", at(1), at(1), at(1), "crm"), (2, " ", "n", at(1), at(1), at(1), "crm")]
    store.append("bronze.t", rows_of(SCHEMA, *rows))
    loads.load_silver_changes(store, AsOf(at(2)))
    assert columns["verdicts_t"] == ["a", "s", "created_at", "updated_at", "load_timestamp", "source_system", "_raw", "reason"]
    assert "newest_t" not in columns and kept == []
    store.append("bronze.t", rows_of(SCHEMA, (2, "y ", "o", at(1), at(2), at(2), "crm")))
    loads.load_silver_changes(store, AsOf(at(3)))
    assert kept == []
    assert sorted((r.a, r.s) for r in store.read("silver.t").collect()) == [(1, "x"), (2, "y")]
    winners = store.read("winners.t")
    assert sorted((r.a, r.s, r.more, r[changes.ACCEPTED]) for r in winners.collect()) == [(1, " x", "m", True), (2, "y ", "o", True)]
    folders = [f for f in os.listdir(tmp_path / "winners.t") if f.startswith("part-")]
    assert folders == [p["dir"] for p in store.snapshot("winners.t").parts]


def test_a_long_write_frees_shuffles(spark, rows_of, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(session, "LONG_WRITE", -1)
    monkeypatch.setattr(session, "free", lambda spark: asked.append(1))
    TableStore(spark, str(tmp_path)).replace("t", rows_of("a bigint", (1,)))
    session.Stage(spark, str(tmp_path), compact=True).keep("x", rows_of("a bigint", (1,)))
    assert len(asked) == 2
