"""The stored alert board against a replay of the whole topic."""

from __future__ import annotations

import json
import random

import pytest

from tidewarden.plans import board_store
from tidewarden.plans.board import current_alerts
from tidewarden.schemas import MESSAGE
from tidewarden.sources.messages import landed_replay


def alert(key, version, **more):
    return json.dumps({"alert_id": key, "msg": f"v{version}", "severity": "Red", **more}).encode()


@pytest.fixture
def topic(spark, tmp_path):
    """Lands messages given as (partition, offset, value) and refreshes a board from them."""
    class Topic:
        folder, path, asked = str(tmp_path / "topic"), str(tmp_path / "board"), []

        def land(self, *rows):
            spark.createDataFrame([("alerts", p, o, None, None, v) for p, o, v in rows], MESSAGE) \
                .coalesce(1).write.mode("append").parquet(self.folder)

        def refresh(self, *rows):
            if rows:
                self.land(*rows)
            read = board_store.landed_reader(spark, self.folder)

            def noted(reached):
                self.asked.append(dict(reached))
                return read(reached)

            return shown(board_store.refresh_board(spark, self.path, noted))

        def replay(self):
            return {r.alert_id: r.msg for r in current_alerts(landed_replay(spark, self.folder)).collect()}

    return Topic()


def shown(board):
    return ({r.alert_id: r.msg for r in board.alerts.collect()},
            {r.alert_id for r in board.new.collect()})


def test_refreshes_take_in_what_is_new(topic):
    assert topic.refresh((0, 0, alert("a", 1)), (1, 0, alert("b", 1))) == (
        {"a": "v1", "b": "v1"}, set())
    # A later version, a new alert, and messages that count for nothing.
    assert topic.refresh((0, 1, alert("a", 2)), (0, 2, alert("c", 1)), (0, 3, b'{"alert_id": "a", "msg"'),
                         (1, 1, b"[]"), (1, 2, None), (1, 3, alert("", 9)), (1, 4, alert(None, 9)),
                         (1, 5, b"\xff")) == ({"a": "v2", "b": "v1", "c": "v1"}, {"c"})
    assert topic.asked == [{}, {0: 1, 1: 1}]
    assert topic.refresh() == ({"a": "v2", "b": "v1", "c": "v1"}, set())
    # A partition that wasn't there before.
    assert topic.refresh((2, 0, alert("d", 1))) == ({"a": "v2", "b": "v1", "c": "v1", "d": "v1"}, {"d"})
    assert topic.asked[2:] == [{0: 4, 1: 6}, {0: 4, 1: 6}]


def test_messages_taken_in_before_are_passed_over(topic):
    topic.refresh((0, 5, alert("a", 5)))
    assert topic.refresh((0, 4, alert("a", 4)), (0, 5, alert("a", 0)))[0] == {"a": "v5"}


def test_a_failed_refresh_is_taken_up_again(spark, topic, monkeypatch):
    topic.refresh((0, 0, alert("a", 1)))
    topic.land((0, 1, alert("b", 1)))

    def broken(*rows):
        raise OSError("lost")

    monkeypatch.setattr(board_store, "_POSITIONS", None)
    with pytest.raises(Exception):
        topic.refresh()
    monkeypatch.undo()
    assert shown(board_store.read_board(spark, topic.path)) == ({"a": "v1"}, set())
    assert topic.refresh() == ({"a": "v1", "b": "v1"}, {"b"})


def test_random_increments_equal_a_replay(topic):
    chance = random.Random(2)
    offsets, before = [0, 0, 0], set()
    for step in range(4):
        rows = []
        for _ in range(60):
            key = chance.randrange(40)
            p = key % 3
            rows.append((p, offsets[p], chance.choice([alert(f"k{key}", f"{step}.{offsets[p]}"), b"{", b"null"])))
            offsets[p] += 1
        alerts, new = topic.refresh(*rows)
        assert alerts == topic.replay()
        assert new == (set(alerts) - before if step else set())
        before = set(alerts)


def test_only_files_beyond_the_positions_are_read(spark, topic):
    for i in range(4):
        topic.refresh((0, i, alert(f"a{i}", 1)))
    rows = board_store.landed_reader(spark, topic.folder)(board_store.positions(spark, topic.path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(offset,4)" in plan and rows.count() == 0


def test_empty_store(spark, tmp_path):
    assert shown(board_store.read_board(spark, str(tmp_path / "none"))) == ({}, set())
    assert board_store.positions(spark, str(tmp_path / "none")) == {}
