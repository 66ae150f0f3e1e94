"""Sources, sinks, inventory and the daily run over a written lake."""

import json
from datetime import date, datetime

import pytest

from clicklake import cli
from clicklake.operators.activity import run_statistics
from clicklake.plans.batch import write_batch_reports
from clicklake.plans.catalogue import used_catalogue
from clicklake.plans.daily import write_daily_reports
from clicklake.session import sized_shuffles
from clicklake.sources import files, inventory, sinks
from clicklake.streaming.archive import archive_rows
from workload import queries


def event(i, user, product, kind, category, time):
    return json.dumps(
        {"event_id": str(i), "user_id": user, "product_id": product, "event_type": kind, "category": category, "timestamp": time}
    )


DAYS = ["2026-05-10", "2026-05-11", "2026-05-13"]  # the 12th has no events
FEED = [
    event(f"{day}-{i}", f"u{i % 4}", f"E{i % 7}", ("view", "view", "purchase")[i % 3], ("A", "B", None)[i % 3], f"{day}T{i % 24:02d}:00:00")
    for day in DAYS
    for i in range(40)
]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    messages = spark.createDataFrame([(v,) for v in FEED], "value string")
    sinks.write_table(archive_rows(messages), files.lake_path(root), day="event_date")
    return root


def test_range_read_prunes_partitions(spark, root, plan):
    part = files.read_lake(spark, root, "2026-05-11", "2026-05-13")
    assert {str(r.event_date) for r in part.select("event_date").distinct().collect()} == {"2026-05-11", "2026-05-13"}
    assert part.count() == 80
    partition_filters = plan(part).split("PartitionFilters: [")[1].split("]")[0]
    assert "event_date" in partition_filters


def test_missing_day_is_empty_not_an_error(spark, root):
    assert files.read_lake(spark, root, date(2026, 5, 12), date(2026, 5, 12)).count() == 0


@pytest.mark.parametrize(("first", "last"), [("2026-5-9", "2026-5-11"), ("2026-05-09", date(2026, 5, 11)), (datetime(2026, 5, 9, 23), "2026-5-11T08:30")])
def test_every_form_of_a_day_reads_the_same_days(spark, root, first, last):
    assert files.read_lake(spark, root, first, last).count() == 80
    assert files.read_lake(spark, root, last=last).count() == 80 and files.read_lake(spark, root, first).count() == 120
    assert inventory.lake_bytes(spark, root, first, last) == inventory.lake_bytes(spark, root, "2026-05-09", "2026-05-11") > 0
    assert inventory.partition_presence(inventory.partition_metadata(spark, root), first, last).count() == 3


@pytest.mark.parametrize("day", ["yesterday", "2026-13-01", "2026-05", "2026-05-10x", "", "2026-05-10T25:00", 20260510])
def test_a_bound_that_is_no_day_raises(spark, root, day):
    with pytest.raises(ValueError):
        files.read_lake(spark, root, day)
    with pytest.raises(ValueError):
        sinks.write_table(spark.createDataFrame([(DAYS[0], 1)], "report_date string, n int"), f"{root}-unused", days=(day, day))


def test_a_rerun_by_an_unpadded_range_removes_what_became_empty(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "report_date date, n int"
    sinks.write_table(spark.createDataFrame([(date(2026, 5, d), 1) for d in (9, 10, 11)], schema), path)
    sinks.write_table(spark.createDataFrame([(date(2026, 5, 9), 2)], schema), path, days=("2026-5-9", "2026-5-10"))
    assert set(files.days_below(spark, path, "report_date")) == {date(2026, 5, 9), date(2026, 5, 11)}


def test_rows_without_a_day_do_not_stop_a_rerun(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "report_date date, n int"
    sinks.write_table(spark.createDataFrame([(None, 1), (date(2026, 5, 9), 1)], schema), path)
    sinks.write_table(spark.createDataFrame([(None, 2)], schema), path, days=("2026-05-01", "2026-05-31"))
    assert [r.n for r in spark.read.parquet(path).collect()] == [2]


def test_other_files_in_the_lake_are_ignored(spark, root):
    before = files.read_lake(spark, root).count()
    with open(f"{root}/raw-events/event_date=2026-05-10/notes.txt", "w") as f:
        f.write("no parquet")
    assert files.read_lake(spark, root).count() == before == len(FEED)


def test_inventory(spark, root, plan):
    metadata = inventory.partition_metadata(spark, root)
    assert "content" not in plan(metadata)
    rows = {str(r.event_date): r for r in metadata.collect()}
    assert set(rows) == set(DAYS) and all(r.file_count == 1 and r.total_size_mb >= 0 for r in rows.values())
    presence = inventory.partition_presence(metadata, "2026-05-09", "2026-05-13").orderBy("event_date").collect()
    assert [r.exists for r in presence] == [False, True, True, False, True]
    assert presence[0].partition == "event_date=2026-05-09" and presence[0].file_count is None


def test_shuffles_are_sized_by_the_input(spark, root):
    assert inventory.lake_bytes(spark, root, "2026-05-12", "2026-05-12") == 0
    one, all_days = (inventory.lake_bytes(spark, root, DAYS[0], last) for last in (DAYS[0], DAYS[-1]))
    assert 0 < one < all_days == inventory.input_bytes(spark, root, "*.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, all_days) as now:
        assert now == int(before) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    with pytest.raises(KeyError), sized_shuffles(spark, 100 * 2**40) as now:
        assert now == 51_200 == int(spark.conf.get("spark.sql.shuffle.partitions"))
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_range_lists_its_own_days(spark, root):
    part = files.read_lake(spark, root, "2026-05-11", "2026-05-12")
    assert part.inputFiles() and all("event_date=2026-05-11" in f for f in part.inputFiles())


def test_a_stream_written_root_takes_no_batch_rows(spark, tmp_path):
    (tmp_path / "t" / "_spark_metadata").mkdir(parents=True)
    frame = spark.createDataFrame([("p", date(2026, 5, 10))], "product_id string, report_date date")
    with pytest.raises(ValueError, match="stream"):
        sinks.write_table(frame, str(tmp_path / "t"))


@pytest.mark.parametrize("write", ["table", "json", "csv", "text"])
def test_a_rerun_of_a_range_removes_days_that_became_empty(spark, tmp_path, write):
    path, schema = str(tmp_path / "t"), "report_date date, line_no int, line string"
    days = [date(2026, 5, d) for d in (10, 11, 12, 20)]
    first = spark.createDataFrame([(d, 1, "old") for d in days], schema)
    second = spark.createDataFrame([(days[1], 1, "new")], schema)
    sink = {"table": sinks.write_table, "json": sinks.write_json_report, "csv": sinks.write_csv_report, "text": sinks.write_text_report}[write]
    sink(first, path)
    sink(second, path, days=("2026-05-10", date(2026, 5, 12)))
    assert set(files.days_below(spark, path, "report_date")) == {days[1], days[3]}
    sink(second.limit(0), path, days=("2026-05-01", "2026-05-31"))
    assert not files.days_below(spark, path, "report_date")


def test_inventory_of_many_days(spark, root, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    out = str(tmp_path / "inventory")
    cli.main(["inventory", "--lake", root, "--first", "2000-01-01", "--last", "2029-12-31", "--output", out])
    found = spark.read.json(out)
    assert found.count() == 10_958 and found.where("exists").count() == len(DAYS)


def test_json_directory_with_given_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(FEED[:3]) + "\nnot json\n")
    rows = files.read_json_events(spark, str(tmp_path)).collect()
    assert len(rows) == 4 and [r.event_id for r in rows][:3] == ["2026-05-10-0", "2026-05-10-1", "2026-05-10-2"]
    assert rows[3].event_id is None


def test_rerun_replaces_its_days_only(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    schema = "user_id string, views bigint, report_date date"
    first = spark.createDataFrame([("a", 1, date(2026, 5, 10)), ("b", 2, date(2026, 5, 11)), ("c", 3, date(2026, 5, 11))], schema)
    second = spark.createDataFrame([("b", 9, date(2026, 5, 11))], schema)
    for fmt in ("parquet", "json"):
        sinks.write_table(first, path + fmt, fmt)
        sinks.write_table(second, path + fmt, fmt)
        got = spark.read.schema(schema).format(fmt).load(path + fmt)
        assert rows(got) == [("a", 1, date(2026, 5, 10)), ("b", 9, date(2026, 5, 11))]


def test_long_lines_are_made_after_the_gathering(spark, tmp_path, rows, plan, monkeypatch):
    kinds = [("view", "x" * 2_000), ("view", "x" * 2_000), ("click", "y"), (None, "z"), ("click", None)]
    events = [(i, datetime(2026, 5, 1 + i % 3) if i % 4 else None, i, kinds[i % 5][0], 1.0, kinds[i % 5][1]) for i in range(120)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).repartition(4).write.parquet(f"{tmp_path}/events.parquet")
    put, written = sinks._replace_days, []
    monkeypatch.setattr(sinks, "_replace_days", lambda lines, *more, **named: (written.append(lines), put(lines, *more, **named)))
    found = rows(queries.partition_metadata(spark, str(tmp_path)))

    sizes = {}
    for _, at, _, kind, _, props in events:
        day = at and at.date()
        sizes[day] = sizes.get(day, 0) + (len(kind) + 1 + 400 * len(props) if kind and props else 0) + 1
    assert found == sorted(((d, round(n / 2**20, 2), True, True) for d, n in sizes.items()), key=repr)

    (lines,) = written
    shown = plan(lines)
    assert shown.index("repeat(") < shown.index("Sort [") < shown.index("Exchange ") and shown.count("repeat(") == 1
    lines.createOrReplaceTempView("long_lines")
    spark.sql(f"CREATE TABLE long_lines_by_day (line string, event_date date) USING text PARTITIONED BY (event_date) LOCATION '{tmp_path}/t'")
    shown = spark.sql("EXPLAIN INSERT INTO long_lines_by_day SELECT line, event_date FROM long_lines").first()[0]
    spark.sql("DROP TABLE long_lines_by_day")
    assert "WriteFiles" in shown and shown.count("Sort [") == 1


def test_text_report_is_one_ordered_file_per_day(spark, tmp_path):
    lines = [(date(2026, 5, d), n, f"{d} line {n:03d}") for d in range(1, 9) for n in range(60, 0, -1)]
    frame = spark.createDataFrame(lines, "report_date date, line_no int, line string").repartition(5)
    sinks.write_text_report(frame, str(tmp_path / "t"))
    for d in range(1, 9):
        (file,) = (tmp_path / "t" / f"report_date=2026-05-{d:02d}").glob("*.txt")
        assert file.read_text().splitlines() == [f"{d} line {n:03d}" for n in range(1, 61)]


def test_csv_report_has_a_header(spark, tmp_path):
    frame = spark.createDataFrame([("p", 3, 1, date(2026, 5, 10)), ("q", 2, 2, date(2026, 5, 10))], "product_id string, view_count bigint, rank int, report_date date")
    sinks.write_csv_report(frame, str(tmp_path / "c"), "rank")
    (file,) = (tmp_path / "c" / "report_date=2026-05-10").glob("*.csv")
    assert file.read_text().splitlines() == ["product_id,view_count,rank", "p,3,1", "q,2,2"]


def test_used_catalogue(spark, rows):
    catalogue = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "product_id string, category string")
    events = spark.createDataFrame([("a",)] * 50 + [("c",), ("z",), (None,)], "product_id string")
    assert rows(used_catalogue(events, catalogue)) == [("a", "A"), ("c", "C")]


@pytest.fixture(scope="module")
def reports(spark, root, tmp_path_factory):
    return write_daily_reports(spark, root, DAYS[0], DAYS[-1], report_root=str(tmp_path_factory.mktemp("out")))


def test_daily_run_writes_every_report_for_every_day(spark, reports):
    for name, fmt in [
        ("user_segments", "parquet"), ("segment_summary", "text"), ("top_products_json", "json"), ("top_products_csv", "csv"),
        ("category_conversion_json", "json"), ("category_conversion_csv", "csv"), ("top_products_text", "text"),
        ("category_conversion_text", "text"), ("body", "json"),
    ]:
        days = {str(r.report_date) for r in reports.read(spark, name, fmt).select("report_date").distinct().collect()}
        assert days == set(DAYS), name


def test_daily_run_results(spark, reports):
    segments = reports.read(spark, "user_segments").where("report_date = '2026-05-10'").collect()
    expected = {}
    for line in FEED[:40]:
        e = json.loads(line)
        views, purchases = expected.get(e["user_id"], (0, 0))
        expected[e["user_id"]] = (views + (e["event_type"] == "view"), purchases + (e["event_type"] == "purchase"))
    assert {r.user_id: (r.views, r.purchases) for r in segments} == expected
    assert all(r.segment == "Buyer" and r.segment_two_way == "Buyer" for r in segments)
    top = reports.read(spark, "top_products_json", "json").where("report_date = '2026-05-10'").orderBy("rank").collect()
    counts = {}
    for line in FEED[:40]:
        e = json.loads(line)
        if e["event_type"] == "view":
            counts[e["product_id"]] = counts.get(e["product_id"], 0) + 1
    assert [(r.product_id, r.view_count) for r in top] == sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:5]


def test_batch_run(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(FEED))
    for _ in range(2):  # a rerun replaces
        paths = write_batch_reports(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2026-05-14", k=3)
    top = paths.read(spark, "batch_top_products", "json").collect()
    assert [r.product_id for r in top] == sorted([r.product_id for r in top], key=lambda p: [-x.view_count for x in top if x.product_id == p])
    assert len(top) == 3 and {str(r.report_date) for r in top} == {"2026-05-14"}
    assert paths.read(spark, "batch_user_segments", "json").count() == 4
    statistics = paths.read(spark, "batch_statistics", "json").first()
    assert (statistics.records_processed, statistics.unique_products, statistics.unique_users) == (120, 7, 4)


def test_inventory_job(spark, root, monkeypatch, capsys, tmp_path):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    out = str(tmp_path / "days")
    cli.main(["inventory", "--lake", root, "--first", "2026-05-12", "--last", "2026-05-13", "--output", out])
    assert capsys.readouterr().out.strip().endswith(out)
    assert [(r["partition"], r["exists"]) for r in spark.read.json(out).orderBy("event_date").collect()] == [
        ("event_date=2026-05-12", False), ("event_date=2026-05-13", True),
    ]


def test_daily_job(spark, root, monkeypatch, tmp_path):
    monkeypatch.setattr(cli, "build_session", lambda name: spark)
    cli.main(["daily", "--lake", root, "--first", "2026-05-13", "--reports", str(tmp_path)])
    assert spark.read.json(f"{tmp_path}/reports/top_products_json").count() == 5


def test_an_unpadded_range_gives_the_same_reports(spark, root, reports, rows, tmp_path):
    other = write_daily_reports(spark, root, "2026-5-10", "2026-5-13", report_root=str(tmp_path))
    for name in ("segment_summary", "top_products_text", "category_conversion_text"):
        assert rows(other.read(spark, name, "text")) == rows(reports.read(spark, name, "text")) != []


def test_statistics_of_the_daily_run_equal_those_of_the_events(spark, root, reports, rows):
    schema = "records_processed long, unique_products long, unique_users long, report_date date"
    expected = run_statistics(files.read_lake(spark, root), "event_date").select("records_processed", "unique_products", "unique_users", "event_date")
    assert rows(reports.read(spark, "run_statistics", "json", schema)) == rows(expected) != []


def reads_of(spark, monkeypatch, job, name):
    """How many scans of this source the plans of the job's writes hold."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, save = [], DataFrameWriter.parquet

    def spied(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return save(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    job()
    return sum(p.count(name) for p in plans)


def test_the_daily_run_reads_the_lake_twice_and_the_batch_run_parses_once(spark, root, monkeypatch, tmp_path):
    daily = lambda: write_daily_reports(spark, root, DAYS[0], DAYS[-1], report_root=str(tmp_path / "d"))
    assert reads_of(spark, monkeypatch, daily, "raw-events") == 2
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(FEED))
    batch = lambda: write_batch_reports(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2026-5-14")
    assert reads_of(spark, monkeypatch, batch, "FileScan json") == 1


def test_daily_rerun_changes_nothing(spark, root, reports, rows):
    before = {n: rows(reports.read(spark, n, "text")) for n in ("segment_summary", "top_products_text", "category_conversion_text")}
    write_daily_reports(spark, root, DAYS[1], DAYS[1], report_root=reports.root)
    assert before == {n: rows(reports.read(spark, n, "text")) for n in before}
