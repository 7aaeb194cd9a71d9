from pyspark.sql import functions as F

from tideline.operators.changelog import (
    apply_changelog,
    delete_keys,
    effective_key,
    fan_out,
    primary_key_map,
    to_row_kinds,
)

FRAME = (
    "before STRUCT<id: BIGINT, v: STRING>, after STRUCT<id: BIGINT, v: STRING>, "
    "source STRUCT<db: STRING, table: STRING, ts_ms: BIGINT>, op STRING, ts_ms BIGINT, transaction STRING, pos BIGINT"
)


def frame(spark, *changes):
    """Changes as (op, before, after, pos[, db, table])."""
    rows = []
    for op, before, after, pos, *name in changes:
        db, table = name or ("d", "t")
        rows.append((before, after, (db, table, pos), op, pos, None, pos))
    return spark.createDataFrame(rows, FRAME)


def applied(env, base=None, keys=("id",)):
    return sorted(tuple(r) for r in apply_changelog(base, env, list(keys), ["ts_ms", "pos"]).collect())


def test_effective_key(spark):
    env = frame(
        spark,
        ("c", None, (1, "a"), 1),
        ("d", (2, "b"), None, 2),
        ("u", (3, "b"), (4, "c"), 3),
        ("c", None, (5, "a"), 4, "d", "unknown"),
        ("c", None, (6, "a"), 5, " d ", " t "),
        ("c", None, (None, "a"), 6),
        ("c", None, (7, "q"), 7, "d", "other"),
    )
    keys = {"d.t": "id", "d.other": "nothing"}
    got = {r.pos: r.key_value for r in effective_key(env, keys).collect()}
    assert got == {1: "1", 2: "2", 3: "4", 4: "", 5: "6", 6: "", 7: ""}


def test_effective_key_of_mixed_tables(spark):
    env = frame(spark, ("c", None, (1, "a"), 1), ("d", (2, "b"), None, 2))
    texts = env.withColumns({c: F.to_json(c) for c in ("before", "after")})

    def as_map(c):
        return F.when(F.col(c).isNotNull(), F.create_map(F.lit("id"), F.col(c)["id"].cast("string")))

    maps = env.withColumns({c: as_map(c) for c in ("before", "after")})
    for df in (texts, maps):
        assert {r.pos: r.key_value for r in effective_key(df, {"d.t": "id"}).collect()} == {1: "1", 2: "2"}
        assert {r.key_value for r in effective_key(df, {"d.t": "none"}).collect()} == {""}


def test_row_kinds(spark):
    env = frame(spark, ("r", None, (1, "a"), 1), ("u", (1, "a"), (1, "b"), 2), ("d", (1, "b"), None, 3), ("u", None, (9, "x"), 4))
    got = [(r.pos, r.row_kind, r.id, r.v) for r in to_row_kinds(env, ["pos"]).collect()]
    assert sorted(got) == [
        (1, "+I", 1, "a"),
        (2, "+U", 1, "b"),
        (2, "-U", 1, "a"),
        (3, "-D", 1, "b"),
        (4, "+U", 9, "x"),
    ]


def test_delete_keys(spark):
    env = frame(spark, ("c", None, (1, "a"), 1), ("u", (2, "a"), (3, "b"), 2), ("d", (2, "b"), None, 3))
    kinds = to_row_kinds(env)
    assert [r.id for r in delete_keys(kinds).collect()] == [2]
    assert sorted(r.v for r in delete_keys(kinds, "v").collect()) == ["a", "b"]


def test_apply(spark):
    base = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "id BIGINT, v STRING")
    env = frame(
        spark,
        ("u", (1, "old"), (1, "new"), 1),
        ("d", (2, "old"), None, 2),
        ("c", None, (4, "x"), 3),
        ("c", None, (4, "again"), 4),
        ("d", (5, "never seen"), None, 5),
    )
    assert applied(env, base) == [(1, "new"), (3, "old"), (4, "again")]


def test_late_change_does_not_revive(spark):
    env = frame(spark, ("d", (1, "b"), None, 9), ("u", (1, "a"), (1, "b"), 3))
    assert applied(env) == []


def test_insert_after_delete(spark):
    env = frame(spark, ("c", None, (1, "c"), 3), ("d", (1, "b"), None, 2), ("c", None, (1, "a"), 1))
    assert applied(env) == [(1, "c")]


def test_key_change(spark):
    base = spark.createDataFrame([(1, "old"), (3, "keep")], "id BIGINT, v STRING")
    env = frame(spark, ("u", (1, "old"), (2, "moved"), 1))
    assert applied(env, base) == [(2, "moved"), (3, "keep")]
    back = frame(spark, ("u", (1, "old"), (2, "moved"), 1), ("u", (2, "moved"), (1, "back"), 2))
    assert applied(back, base) == [(1, "back"), (3, "keep")]


def test_key_list(spark):
    env = frame(spark, ("c", None, (1, "a"), 1), ("c", None, (1, "b"), 2), ("d", (1, "a"), None, 3))
    assert applied(env, keys=("id", "v")) == [(1, "b")]


def test_delete_without_images_is_tolerated(spark):
    env = frame(spark, ("d", None, (1, "a"), 2), ("c", None, (1, "a"), 1), ("c", None, (2, "a"), 1))
    assert applied(env) == [(2, "a")]


def test_primary_key_map(spark):
    rows = [
        ("d.a", 1, "id", "PRI"),
        ("d.a", 2, "name", ""),
        ("d.b", 1, "x", " pri "),
        ("d.b", 2, "y", "PRI"),
        ("d.c", 1, "z", "MUL"),
    ]
    desc = spark.createDataFrame(rows, "table STRING, ordinal INT, Field STRING, Key STRING")
    assert {r.db_table: r.pk_column for r in primary_key_map(desc).collect()} == {"d.a": "id", "d.b": "y"}


def test_fan_out(spark, tmp_path):
    env = frame(
        spark,
        ("c", None, (1, "a"), 1, "d", "t1"),
        ("c", None, (2, "a"), 2, "d", "t2"),
        ("c", None, (3, "a"), 3, "e", "t1"),
    )
    fan_out(env, str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all" / "db=e" / "table=t1")).first().after.id == 3
    fan_out(env, str(tmp_path / "all"), ["d.t2"], mode="overwrite")
    assert sorted(r.pos for r in spark.read.parquet(str(tmp_path / "all")).collect()) == [1, 2, 3]
    fan_out(env, str(tmp_path / "all"), ["d.t2"])
    assert sorted(r.pos for r in spark.read.parquet(str(tmp_path / "all")).collect()) == [1, 2, 2, 3]
    fan_out(env, str(tmp_path / "some"), ["d.t2"])
    assert [r.pos for r in spark.read.parquet(str(tmp_path / "some")).collect()] == [2]
