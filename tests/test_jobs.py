import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidelog import USERS, Settings, cli, schemas
from tidelog.operators import parse_events, seed_users
from tidelog.plans import jobs, reports
from tidelog.sinks import append_rows, bootstrap, create_if_absent, replace_table
from tidelog.sinks.tables import merge_into
from tidelog.sources import discover, has_table, read_change_log, read_jdbc
from tidelog.sources.change_log import starting_offsets

DAY = 86_400_000


@pytest.fixture
def stored_log(log, tmp_path):
    path = str(tmp_path / "log")
    records = [
        log.record("r", i, DAY * 19_000, name=f"USER {i}", email=f"u{i}@d{i % 30}.com")
        for i in range(1, 41)
    ]
    records += [log.record("u", 1, DAY * 19_001, name=" B "), log.record("d", 2, DAY * 19_002)]
    log.frame(records).write.parquet(path)
    return path


def test_whole_chain_and_repeat(lake, spark, stored_log):
    def change_log():
        return read_change_log(spark, USERS, path=stored_log)

    first = jobs.run_all(change_log, lake)
    assert first["bronze"] == 42
    assert first["verify"] == {
        "bronze.users_raw": 42,
        "silver.users_clean": 39,
        "gold.users_email_domain": 31,
        "gold.users_daily_changes": 3,
    }
    again = jobs.run_all(change_log, lake)
    assert again["bronze"] == 0
    assert again["verify"] == first["verify"]


def test_transform_layers(lake, spark, stored_log):
    jobs.ingest(read_change_log(spark, USERS, path=stored_log), lake)
    assert jobs.transform(lake, "silver") == {"silver": 40}  # one deleted key included
    assert jobs.transform(lake, "silver") == {"silver": None}
    assert jobs.transform(lake, "gold") == {"gold_daily": 3, "gold_domain": 31}
    assert jobs.transform(lake, "all", full=True) == {
        "silver": 40,
        "gold_daily": 3,
        "gold_domain": 31,
    }
    with pytest.raises(ValueError, match="layer"):
        jobs.transform(lake, "bronze")
    with pytest.raises(ValueError, match="dedupe"):
        jobs.ingest(read_change_log(spark, USERS, path=stored_log), lake, dedupe="maybe")


def test_failed_stage_does_not_hide_and_does_not_stop_the_rest():
    done = []

    def fail():
        raise RuntimeError("no source")

    with pytest.raises(jobs.JobFailed, match="bronze: no source") as raised:
        jobs.run_stages({"bronze": fail, "silver": lambda: done.append("silver")})
    assert list(raised.value.failures) == ["bronze"]
    assert done == ["silver"]


def test_reports_by_section(lake, spark, stored_log, capsys):
    assert reports.run(spark, USERS, None, lake.prefix) == {}
    jobs.ingest(read_change_log(spark, USERS, path=stored_log), lake)
    lake.register()
    assert set(reports.run(spark, USERS, "silver", lake.prefix)) == set()
    jobs.transform(lake)
    lake.register()

    every = reports.run(spark, USERS, None, lake.prefix)
    kpis = every["silver KPIs"].first()
    assert (kpis.total_users, kpis.unique_domains) == (39, 31)
    quality = every["data quality"].first().asDict()
    assert quality == {"null_names": 0, "null_emails": 0, "bad_emails": 0, "total_rows": 39}
    mix = [(r.op_type, r.event_count) for r in every["operation mix"].collect()]
    assert mix == [("SNAPSHOT", 40), ("DELETE", 1), ("UPDATE", 1)]
    shares = every["top 20 domains"].collect()
    assert len(shares) == 20
    assert shares[0].pct == round(shares[0].user_count * 100 / 39, 2)
    newest = every["latest 20 events"].collect()
    assert [r.op_type for r in newest[:2]] == ["DELETE", "UPDATE"]
    assert [r.id for r in every["sample rows (first 20 by key)"].collect()][:2] == [1, 3]
    fresh = every["freshness"].first()
    assert fresh.bronze_last_ingest <= fresh.silver_last_build <= fresh.gold_last_build
    assert set(reports.run(spark, USERS, "gold", lake.prefix)) == {
        "top 20 domains",
        "daily change tally",
    }
    with pytest.raises(ValueError, match="section"):
        reports.run(spark, USERS, "copper", lake.prefix)

    silver = spark.table(lake.prefix + USERS.silver_table)
    approximate = reports.silver_kpis(silver, USERS, approximate=True).first()
    assert abs(approximate.unique_domains - 31) <= 3
    reports.show({"all": silver, "none": silver.limit(0)}, rows=25)
    shown = capsys.readouterr().out
    assert "... (14 more rows)" in shown
    assert "(no rows)" in shown


def test_quality_of_an_empty_table_is_null_not_zero(spark):
    empty = spark.createDataFrame([], schemas.silver(USERS))
    row = reports.quality_checks(empty).first()
    assert (row.null_names, row.total_rows) == (None, 0)


def test_quality_ignores_null_addresses(spark):
    rows = spark.createDataFrame(
        [(None, "x@y"), ("n", None), ("n", "bad")], "name string, email string"
    )
    assert tuple(reports.quality_checks(rows).first()) == (1, 1, 1, 3)


def test_catalog_discovery(lake, spark, stored_log):
    jobs.ingest(read_change_log(spark, USERS, path=stored_log), lake)
    lake.register()
    layer = lake.prefix + "bronze"
    assert "spark_catalog" in [r.catalog for r in discover(spark, "catalogs").collect()]
    assert layer in [r.namespace for r in discover(spark, "schemas").collect()]
    found = discover(spark, "tables", layer, like="users_*").collect()
    assert [r.tableName for r in found] == ["users_raw"]
    assert discover(spark, "tables", layer, like="nothing'").count() == 0
    assert has_table(spark, f"{layer}.users_raw")
    assert not has_table(spark, f"{layer}.nothing")
    assert not has_table(spark, "no_such_schema.nothing")
    with pytest.raises(ValueError, match="what"):
        discover(spark, "columns")


def test_catalog_tables(spark, log):
    tables = bootstrap(spark, USERS)
    assert tables[0] == USERS.bronze_table
    events = parse_events(log.frame([log.record("c", 1, 1)]), USERS)
    append_rows(events, USERS.bronze_table)
    bootstrap(spark, USERS)  # leaves the content
    append_rows(events, USERS.bronze_table)
    assert spark.table(USERS.bronze_table).count() == 2

    counts = spark.createDataFrame([("a.com", 1)], "email_domain string, user_count bigint")
    counts = counts.withColumn("gold_built_at", F.current_timestamp())
    for _ in range(2):
        replace_table(counts, USERS.domain_table)
    assert spark.table(USERS.domain_table).count() == 1

    # A failing append must not replace the history.
    with pytest.raises(AnalysisException):
        append_rows(events.select("id"), USERS.bronze_table)
    assert spark.table(USERS.bronze_table).count() == 2
    # Parquet tables take no row-level commands; the lake layout merges instead.
    with pytest.raises(Exception, match="UNSUPPORTED|not support|MERGE"):
        merge_into(events, USERS, USERS.silver_table)
    create_if_absent(spark, "default.with_properties", schemas.gold_daily(), "parquet", {"a": "b"})
    assert has_table(spark, "default.with_properties")
    for table in [*tables, "default.with_properties"]:
        spark.sql(f"DROP TABLE {table}")
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE {layer}")


def test_seed(spark):
    people = spark.createDataFrame(
        [(1, " ADA ", "LOVELACE "), (2, None, "X")], "actor_id int, first string, last string"
    )
    seeded = seed_users(people, "actor_id", "first", "last").collect()
    assert tuple(seeded[0]) == (1, "ADA LOVELACE", "ada.lovelace@example.com")
    assert tuple(seeded[1]) == (2, None, None)

    rows = seed_users(people, "actor_id", "first", "last")
    for _ in range(2):
        jobs.seed(spark, rows, "default.seeded_users", ["id"])
    assert spark.table("default.seeded_users").count() == 2
    spark.sql("DROP TABLE default.seeded_users")


def test_seed_again_without_the_catalog_entry(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A", "a@x.com"), (2, "B", "b@x.com")], "id int, name string, email string")
    for _ in range(2):
        jobs.seed(spark, rows, "default.seeded_again", ["id"], str(tmp_path / "seeded"))
        spark.sql("DROP TABLE default.seeded_again")  # what a new session knows of it
    assert spark.read.parquet(str(tmp_path / "seeded")).count() == 2


def test_starting_offsets_follow_the_marks(spark):
    marks = spark.createDataFrame(
        [("t", 1, 9), ("t", 0, 4), ("other", 0, 7)], "kafka_topic string, kafka_partition int, kafka_offset bigint"
    )
    assert starting_offsets(marks, "t") == '{"t": {"0": 5, "1": 10}}'
    assert starting_offsets(marks, "none") is None


def test_jdbc_needs_an_address(spark):
    with pytest.raises(ValueError, match="JDBC"):
        read_jdbc(spark, "SELECT 1", Settings())


def test_stream_needs_a_checkpoint(lake, log):
    with pytest.raises(ValueError, match="CHECKPOINT"):
        jobs.stream(log.frame([]), lake, Settings())


def test_command_line(lake, spark, stored_log, tmp_path, monkeypatch, capsys):
    """Every mode on the test session, which must outlive the command."""

    class Kept:
        def __init__(self, session):
            self._session = session

        def __getattr__(self, name):
            return getattr(self._session, name)

        def stop(self):
            pass

    monkeypatch.setattr(cli, "build_session", lambda app: Kept(spark))
    root = str(tmp_path / "cli_lake")
    common = ["--root", root, "--buckets", "4", "--source-path", stored_log]
    assert cli.main(["--mode", "reports", "--show-config"]) == 0
    assert cli.main(["--mode", "kafka", *common]) == 0
    assert cli.main(["--mode", "transform", "--layer", "all", *common]) == 0
    assert cli.main(["--mode", "trino", "--section", "gold", *common]) == 0
    assert "top 20 domains" in capsys.readouterr().out
    assert cli.main(["--mode", "all", *common]) == 0
    assert cli.main(["--mode", "maintain", *common]) == 0
    stream = ["--available-now", "--checkpoint-dir", str(tmp_path / "cp")]
    root2 = ["--root", str(tmp_path / "cli_lake_2"), *common[2:]]
    assert cli.main(["--mode", "streaming", *root2, *stream]) == 0
    assert cli.main(["--mode", "reports", *root2]) == 0
    assert "39" in capsys.readouterr().out
    root3 = ["--root", str(tmp_path / "cli_lake_3"), *common[2:]]
    stream[-1] += "3"
    assert cli.main(["--mode", "kafka", "--consume-mode", "streaming", *root3, *stream]) == 0
    with pytest.raises(ValueError, match="unknown topic"):
        cli.main(["--mode", "all", "--topic", "nope", *common])
    with pytest.raises(SystemExit):
        cli.main(["--mode", "nothing"])
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")
