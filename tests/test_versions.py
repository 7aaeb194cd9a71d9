"""Versioned tables: the frames, and the statements as an in-process engine runs them."""

import random

import duckdb
import pytest

from tests.test_changelog import applied, frame
from tests.test_streaming import random_changes
from tideline.sinks import rows as sink
from tideline.streaming import apply


class Database:
    """Takes what the JDBC writer would send."""

    def __init__(self):
        self.con = duckdb.connect()
        self.con.execute("CREATE TABLE t (id BIGINT, v VARCHAR, row_version BIGINT, row_removed BOOLEAN)")
        self.stagings = []

    def merge(self, rows, url, table, staging, keys, **options):
        assert (url, table, options) == ("jdbc:x", "t", {"user": "u"})
        self.stagings.append(staging)
        self.con.execute(f"CREATE OR REPLACE TABLE {staging} AS SELECT * FROM t LIMIT 0")
        values = [tuple(r) for r in rows.collect()]
        if values:
            self.con.executemany(f"INSERT INTO {staging} VALUES (?, ?, ?, ?)", values)
        for statement in sink.merge_statements(table, rows.columns, keys, staging):
            self.con.execute(statement)
        self.con.execute(f"DROP TABLE {staging}")

    def rows(self):
        return sorted(self.con.execute(sink.current_rows("t", ["id", "v"])).fetchall())


@pytest.fixture
def database(monkeypatch):
    found = Database()
    monkeypatch.setattr(apply, "merge_rows_jdbc", found.merge)
    return found


def send(env, batch):
    apply.apply_versions_jdbc(env, batch, "jdbc:x", "t", "s", ["id"], "pos", user="u")


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_batches(spark, database, seed):
    changes = random_changes(seed)
    expected = applied(frame(spark, *changes))
    random.Random(seed).shuffle(changes)
    batches = [frame(spark, *changes[i::4]) for i in range(4)]
    for i, env in enumerate([*batches, batches[1], batches[0]]):  # two of them come again
        send(env, i)
    assert database.rows() == expected
    assert database.stagings == [f"s_{i}" for i in range(6)]


def test_late_change_of_a_removed_key(spark, database):
    send(frame(spark, ("d", (1, "a"), None, 5)), 0)
    send(frame(spark, ("u", (1, "a"), (1, "b"), 3), ("c", None, (2, "x"), 4)), 1)
    assert database.rows() == [(2, "x")]
    send(frame(spark, ("c", None, (1, "again"), 6)), 2)
    assert database.rows() == [(1, "again"), (2, "x")]
    send(frame(spark, ("c", None, (1, "again"), 6)).limit(0), 3)
    assert database.rows() == [(1, "again"), (2, "x")]


def test_statements():
    delete, insert = sink.merge_statements("db.t", ["a", "b", "v"], ["a", "b"], "db.s")
    assert delete == (
        "DELETE FROM db.t WHERE EXISTS (SELECT 1 FROM db.s WHERE db.s.a = db.t.a AND db.s.b = db.t.b"
        " AND db.s.row_version > db.t.row_version)"
    )
    assert insert == (
        "INSERT INTO db.t (a, b, v) SELECT a, b, v FROM db.s"
        " WHERE NOT EXISTS (SELECT 1 FROM db.t WHERE db.s.a = db.t.a AND db.s.b = db.t.b)"
    )
