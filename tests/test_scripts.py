import pytest
from pyspark.errors import AnalysisException

from tideline.plans.run_sql import main
from tideline.plans.scripts import read_script, run_script, split_statements


def test_split():
    text = """
    -- first; comment
    CREATE VIEW a AS SELECT ';' AS x, "--" AS y; ;
    /* block ; */ SELECT `odd;name` FROM a -- tail
    ; SELECT 'it\\'s; fine'
    """
    assert split_statements(text) == [
        "CREATE VIEW a AS SELECT ';' AS x, \"--\" AS y",
        "SELECT `odd;name` FROM a",
        "SELECT 'it\\'s; fine'",
    ]


def test_split_keeps_hints_and_takes_literal_delimiters():
    assert split_statements("SELECT /*+ BROADCAST(b) */ 1 || SELECT 2|3", "||") == [
        "SELECT /*+ BROADCAST(b) */ 1",
        "SELECT 2|3",
    ]
    assert split_statements("-- only a comment") == []


def script(path):
    return f"""
    CREATE TABLE job_out (n BIGINT, s STRING) USING parquet LOCATION '{path}';
    InSeRt InTo job_out SELECT count(*), 'view' FROM job_view;
    -- the view comes after the insert that reads it
    CREATE OR REPLACE TEMPORARY VIEW job_view AS SELECT * FROM range(5);
    INSERT INTO job_out VALUES (1, 'a;b')
    """


@pytest.fixture
def no_tables(spark):
    def drop():
        for t in ("job_out", "job_a", "job_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
        spark.catalog.dropTempView("job_view")

    drop()
    yield
    drop()


def test_batch_defers_inserts(spark, tmp_path, no_tables):
    assert run_script(spark, script(tmp_path / "t")) == 4
    assert sorted(tuple(r) for r in spark.table("job_out").collect()) == [(1, "a;b"), (5, "view")]


def test_immediate_keeps_order(spark, tmp_path, no_tables):
    with pytest.raises(AnalysisException):
        run_script(spark, script(tmp_path / "t"), mode="immediate")
    with pytest.raises(ValueError):
        run_script(spark, "SELECT 1", mode="other")


def test_parallel_inserts_and_parameters(spark, tmp_path, no_tables):
    text = f"""
    CREATE TABLE job_a (n BIGINT) USING parquet LOCATION '{tmp_path / "a"}';
    CREATE TABLE job_b (n BIGINT) USING parquet LOCATION '{tmp_path / "b"}';
    INSERT INTO job_a SELECT id FROM range(10) WHERE id < :top;
    INSERT INTO TABLE job_b SELECT id FROM range(4);
    INSERT INTO `job_a` VALUES (99)
    """
    run_script(spark, text, args={"top": 3}, parallel=2)
    assert sorted(r.n for r in spark.table("job_a").collect()) == [0, 1, 2, 99]
    assert spark.table("job_b").count() == 4


def test_failing_insert_fails_the_job(spark, tmp_path, no_tables):
    with pytest.raises(AnalysisException):
        run_script(spark, "INSERT INTO job_nowhere SELECT 1; INSERT INTO job_nowhere2 SELECT 1", parallel=2)


def test_read_script(spark, tmp_path):
    path = tmp_path / "job.sql"
    path.write_text("SELECT 1;\nSELECT 2")
    assert split_statements(read_script(spark, str(path))) == ["SELECT 1", "SELECT 2"]


def test_command_line(spark, tmp_path, no_tables):
    script_file = tmp_path / "job.sql"
    script_file.write_text(
        f"CREATE TABLE job_a (s STRING) USING parquet LOCATION '{tmp_path / 'a'}' | INSERT INTO job_a VALUES (:word)"
    )
    assert main(["--sql-path", str(script_file), "--sql-delimiter", "|", "--arg", "word=x;y"]) == 2
    assert spark.table("job_a").first().s == "x;y"


SHARED = """
CREATE TABLE share_a (n BIGINT) USING parquet LOCATION '{path}/a';
CREATE TABLE share_b (n BIGINT, t BIGINT) USING parquet LOCATION '{path}/b';
INSERT INTO share_a SELECT id FROM share_src WHERE id < 5;
INSERT INTO share_b SELECT id, twice FROM share_src WHERE EXISTS (SELECT 1 FROM share_src s WHERE s.id = 3 AND s.other = 'o');
INSERT INTO share_a (n) SELECT count(*) FROM share_src
"""


@pytest.mark.parametrize("share, scans", [(True, 1), (False, 4)])
def test_inserts_share_one_scan(spark, tmp_path, share, scans):
    from pyspark.sql import functions as F
    from pyspark.sql.types import LongType

    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return 2 * x

    source = spark.range(0, 20, 1, 2).withColumn("twice", F.udf(count, LongType()).asNondeterministic()("id")).withColumn("other", F.lit("o"))
    source.createOrReplaceTempView("share_src")
    for t in ("share_a", "share_b"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    try:
        run_script(spark, SHARED.format(path=tmp_path), share=share)
        assert sorted(r.n for r in spark.table("share_a").collect()) == [0, 1, 2, 3, 4, 20]
        assert spark.table("share_b").count() == 20
        assert seen.value == 20 if share else seen.value >= 20
        # the view is what it was
        assert spark.table("share_src").columns == ["id", "twice", "other"] and not spark.catalog.isCached("share_src")
    finally:
        for t in ("share_a", "share_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_shared_tables_are_shadowed_and_come_back(spark, tmp_path):
    from tideline.plans.scripts import shared_sources

    spark.sql("DROP TABLE IF EXISTS share_t")
    spark.sql(f"CREATE TABLE share_t (a INT, b INT, c INT) USING parquet LOCATION '{tmp_path}'")
    try:
        inserts = ["INSERT INTO x SELECT a FROM share_t", "insert into y (p) (SELECT b FROM share_t)", "INSERT INTO z VALUES (1)"]
        with shared_sources(spark, inserts) as names:
            assert names == ["share_t"] and spark.table("share_t").columns == ["a", "b"] and spark.catalog.isCached("share_t")
        assert spark.table("share_t").columns == ["a", "b", "c"]
        with shared_sources(spark, [*inserts, "INSERT INTO share_t SELECT 1, 2, 3"]) as names:
            assert names == []
    finally:
        spark.sql("DROP TABLE IF EXISTS share_t")


STREAMS = """
CREATE TABLE IF NOT EXISTS str_out (a BIGINT, s STRING, day INT) USING parquet PARTITIONED BY (day) LOCATION '{path}/out';
CREATE TABLE IF NOT EXISTS str_fixed (a BIGINT) USING parquet LOCATION '{path}/fixed';
INSERT INTO str_fixed VALUES (7);
INSERT INTO str_out SELECT id, :word, 1 FROM str_in WHERE id % 2 = 0;
INSERT INTO str_out (day, a) SELECT 2, id FROM str_in WHERE id % 2 = 1
"""


def test_scripts_over_streams(spark, tmp_path):
    from tideline.plans.scripts import start_script

    def more(a, b):
        spark.range(a, b, 1, 1).write.mode("append").parquet(f"{tmp_path}/in")

    more(0, 4)
    spark.readStream.schema("id BIGINT").parquet(f"{tmp_path}/in").createOrReplaceTempView("str_in")
    try:
        for top in (4, 6, 6):
            if top == 6:
                more(4, 6) if spark.read.parquet(f"{tmp_path}/in").count() == 4 else None
            [query] = start_script(spark, STREAMS.format(path=tmp_path), f"{tmp_path}/check", args={"word": "even"})
            query.awaitTermination()
            got = sorted(map(tuple, spark.table("str_out").select("a", "s", "day").collect()))
            # rows come once, however often the script runs
            assert got == [(i, None, 2) if i % 2 else (i, "even", 1) for i in range(top)]
        assert spark.table("str_fixed").count() == 3
        with pytest.raises(ValueError, match="from streams and from tables: str_out"):
            start_script(spark, "INSERT INTO str_out SELECT id, 'x', 1 FROM str_in; INSERT INTO str_out VALUES (1, 'y', 2)", f"{tmp_path}/c")
        with pytest.raises(ValueError, match="has 1 columns, not 3"):
            start_script(spark, "INSERT INTO str_out SELECT id FROM str_in", f"{tmp_path}/c")
    finally:
        for t in ("str_out", "str_fixed"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
