"""CSV deliveries and the lake."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from borderlake.operators.set_checks import collapse_copies
from borderlake.sources.delivery import read_csv, write_csv
from borderlake.sources.lake import Lake, shared_folder
from borderlake.sources.quoted import assemble, true_states
from borderlake.sources.publish import open_published, publications, publish, published_folder, table_catalog

AT = "2026-01-01T00:00:00+00:00"


def deliver(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    return str(folder)


def test_text_comes_in_as_it_is(spark, tmp_path):
    path = deliver(tmp_path / "with space", one='id,name,note\n007,NA,\n2," padded ","say ""hi"", ok"\n3,null,""\n\n4,x\n')
    found = read_csv(spark, path, AT)
    assert found.columns == ["id", "name", "note", "_ingested_at", "_source_file"]
    assert sorted(tuple(r) for r in found.collect()) == [
        ("007", "NA", "", AT, "one.csv"),
        ("2", " padded ", 'say "hi", ok', AT, "one.csv"),
        ("3", "null", "", AT, "one.csv"),
        ("4", "x", "", AT, "one.csv"),
    ]
    assert all(t == "string" for _, t in found.dtypes)


def test_line_breaks_in_fields_need_no_declaration(spark, tmp_path):
    path = deliver(tmp_path / "d", plain="id,t\n1,a\n2,b\n", broken='id,t\n3,"two\nlines"\n4,c\n')
    found = {(r.id, r.t, r._source_file) for r in read_csv(spark, path, AT).collect()}
    assert found == {
        ("1", "a", "plain.csv"), ("2", "b", "plain.csv"), ("3", "two\nlines", "broken.csv"), ("4", "c", "broken.csv"),
    }


def test_a_record_with_too_many_fields_fails_the_load(spark, tmp_path):
    fine = deliver(tmp_path / "fine", f='id,t\n1,"a,b"\n2,"x,""y"",z"\n')
    assert read_csv(spark, fine, AT).count() == 2
    long = deliver(tmp_path / "long", f="id,t\n1,a\n2,b,c\n")
    with pytest.raises(Exception, match="more than 2 fields in f.csv"):
        read_csv(spark, long, AT).collect()


def test_a_header_that_differs_fails_the_load(spark, tmp_path):
    path = deliver(tmp_path / "d", a="id,t\n1,a\n", b="t,id\nb,2\n")
    with pytest.raises(Exception):
        read_csv(spark, path, AT).collect()


@pytest.fixture
def tiny_splits(spark):
    """Files are cut every few bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def cut(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield cut
    for n, value in before.items():
        spark.conf.set(n, value)


def plain_csv(text):
    """The rows of a delivery as the csv module reads them, short ones filled."""
    (width, *_), *records = [(len(r), r) for r in csv.reader(io.StringIO(text, newline="")) if r and "".join(r).strip()]
    return sorted(tuple([*r, *[""] * (width - len(r))]) for _, r in records)


def awkward_csv(seed, end="\n"):
    """Records with commas, quotes and line breaks in quoted fields, some very long."""
    rng = random.Random(seed)
    cells = ["", "a", "NA", "x,y", 'say ""hi""', "two\nlines", "\n\n", '""', ',"",', "\n,\n", "é🎉", " ", "end\r\n", '""\n""']
    lines = ["id,s,t"]
    for i in range(50):
        made = [rng.choice(cells) * (40 if rng.random() < 0.05 else 1) for _ in range(rng.choice([1, 2, 2, 2]))]
        quoted = [f'"{c}"' if any(x in c for x in ',"\n\r') or rng.random() < 0.3 else c for c in made]
        lines.append(",".join([str(i), *quoted]))
        if rng.random() < 0.1:
            lines.append("")
    return end.join(lines) + (end if seed % 2 else "")


@pytest.mark.parametrize(("size", "seed"), [(71, 1), (500, 2), (1 << 20, 3)])
def test_files_cut_anywhere_read_as_a_whole(spark, tmp_path, tiny_splits, size, seed):
    text, other = awkward_csv(seed), awkward_csv(seed + 10, "\r\n")
    path = deliver(tmp_path / "d", one=text, two=other)
    tiny_splits(size)
    assert size > 100_000 or spark.read.text(path, lineSep="\n").rdd.getNumPartitions() > 5
    found = read_csv(spark, path, AT).collect()
    for name, whole in (("one.csv", text), ("two.csv", other)):
        assert sorted((r.id, r.s, r.t) for r in found if r._source_file == name) == plain_csv(whole)


def test_a_wrong_guess_is_found_and_mended(spark, tmp_path, tiny_splits):
    """Inside the field, quotes stand as if fields were opened and closed by them."""
    field = "\n".join(f'k{i},""v{i}"",w' for i in range(40)).replace('""', '""""')
    inner = "\n".join('"",""' for _ in range(60))
    text = f'id,t\n1,"{inner}"\n2,b\n3,"{field}"\n4,d\n'
    path = deliver(tmp_path / "d", f=text)
    tiny_splits(50)
    states = {}
    borders = assemble(spark, path, states).filter("kind = 2").select("file", "border.*")
    assert true_states(borders).filter("state <> guess").count() > 0
    assert sorted((r.id, r.t) for r in read_csv(spark, path, AT).collect()) == plain_csv(text)


def test_a_field_over_many_splits_and_one_never_closed(spark, tmp_path, tiny_splits):
    tiny_splits(64)
    long = "\n".join(f"line {i}" for i in range(300))
    path = deliver(tmp_path / "long", f=f'id,t\n1,"{long}"\n2,b\n')
    assert sorted((r.id, r.t) for r in read_csv(spark, path, AT).collect()) == [("1", long), ("2", "b")]
    bad = deliver(tmp_path / "bad", f=f'id,t\n1,"{long}\n2,b\n')
    with pytest.raises(Exception, match="not closed in f.csv"):
        read_csv(spark, bad, AT)
    top = deliver(tmp_path / "top", f='id,"t\nu"\n1,a\n')
    assert read_csv(spark, top, AT).select("id", "`t\nu`").collect() == [("1", "a")]


def test_old_line_ends_and_files_without_records(spark, tmp_path):
    path = deliver(tmp_path / "d", mac='id,t\r1,"a\rb"\r2,c\r', none="id,t\n")
    assert sorted((r.id, r.t) for r in read_csv(spark, path, AT).collect()) == [("1", "a\rb"), ("2", "c")]


def test_written_deliveries_read_back(spark, tmp_path):
    rows = [("1", "", " a "), ("2", "x,y", 'q"q'), ("3", "line\nbreak", "é")]
    frame = spark.createDataFrame(rows, "id string, a string, b string")
    write_csv(frame, ["id", "b", "a"], f"{tmp_path}/out.csv")
    found = read_csv(spark, f"{tmp_path}/out.csv", AT)
    assert found.columns[:3] == ["id", "b", "a"]
    assert sorted((r.id, r.a, r.b) for r in found.collect()) == rows


def test_copies_collapse_to_their_first_lineage(spark):
    rows = [("1", "a", "f2", "t1"), ("1", "a", "f1", "t2"), ("1", "b", "f3", "t3")]
    table = spark.createDataFrame(rows, "k string, v string, _source_file string, _ingested_at string")
    assert sorted(tuple(r) for r in collapse_copies(table).collect()) == [("1", "a", "f1", "t1"), ("1", "b", "f3", "t3")]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), prefix=f"t{abs(hash(str(tmp_path))) % 10**9}_")


def test_replace_counts_and_may_read_the_table_it_replaces(spark, lake):
    table, seen = lake.replace(spark.range(5), "silver", "x", evens=F.count_if(F.col("id") % 2 == 0))
    assert seen == {"rows": 5, "evens": 3}
    table, seen = lake.replace(table.filter("id > 1"), "silver", "x")
    assert seen["rows"] == 3 and sorted(r.id for r in lake.table("silver", "x").collect()) == [2, 3, 4]


def test_a_failed_build_leaves_the_old_table(spark, lake):
    lake.replace(spark.range(3), "gold", "x")
    with pytest.raises(Exception):
        lake.replace(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), "gold", "x")
    assert lake.table("gold", "x").count() == 3


def test_a_failed_build_keeps_the_version_before_and_goes_itself(spark, lake):
    for n in (1, 2):
        lake.replace(spark.range(n), "gold", "x")
    good = lake._folders(f"{lake.root}/gold/x")
    with pytest.raises(Exception):
        lake.replace(spark.range(9).select(F.raise_error(F.lit("no")).cast("long").alias("id")), "gold", "x")
    assert len(lake._folders(f"{lake.root}/gold/x")) == 3
    lake.replace(spark.range(4), "gold", "x")
    left = lake._folders(f"{lake.root}/gold/x")
    assert len(left) == 2 and left[0] == good[1] and lake.table("gold", "x").count() == 4


def test_readers_always_find_the_table(spark, lake):
    import threading

    frame = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, n int")
    lake.replace(frame, "silver", "q", partition_by=("dataset",))
    lake.replace(spark.range(3), "silver", "x")
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append((lake.table("silver", "x").schema.names, spark.catalog.tableExists(lake.name("silver", "q"))))
            except Exception as error:  # noqa: BLE001
                seen.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(4):
        lake.replace(spark.range(3 + n), "silver", "x")
        lake.replace(frame.withColumn("n", F.col("n") + n), "silver", "q", partition_by=("dataset",))
    done.set()
    reader.join()
    assert seen and all(s == (["id"], True) for s in seen)
    assert lake.table("silver", "x").count() == 6
    assert sorted(map(tuple, lake.table("silver", "q").select("dataset", "n").collect())) == [("a", 4), ("b", 5)]


def numbers(table):
    return sorted(r.n for r in table.select("n").collect())


def test_a_reader_in_the_middle_of_a_build_sees_one_build(spark, lake):
    def build(n, pause=lambda: None):
        with lake.build():
            lake.replace(spark.createDataFrame([("a", n), (f"only{n}", n)], "dataset string, n int"), "silver", "q", ("dataset",))
            lake.replace(spark.createDataFrame([(n,)], "n int"), "staging", "s")
            pause()
            assert numbers(lake.table("silver", "q")) == [n, n]  # the build sees its own
            lake.replace(lake.table("silver", "q").select("n").distinct(), "gold", "x")

    build(1)
    reader = Lake(spark, lake.root, prefix=lake.prefix + "reader_")
    held = reader.snapshot()
    seen = []

    def look():
        for source in (reader, reader.snapshot(), held):
            seen.append((numbers(source.table("silver", "q")), numbers(source.table("gold", "x"))))
        seen.append((numbers(spark.table(lake.name("silver", "q"))), numbers(spark.table(lake.name("gold", "x")))))

    build(2, look)
    assert seen == [([1, 1], [1])] * 4
    assert numbers(reader.table("silver", "q")) == [2, 2] and numbers(reader.table("gold", "x")) == [2]
    assert numbers(spark.table(lake.name("silver", "q"))) == [2, 2]
    assert numbers(held.table("silver", "q")) == [1, 1]  # the build before is still there
    assert held.tables("silver", "gold") == [("silver", "q"), ("gold", "x")]
    assert held.views("old_") == ["old_gold_x", "old_silver_q"]
    assert spark.sql("SELECT count(*) FROM old_silver_q JOIN old_gold_x USING (n)").first()[0] == 2
    assert not lake._folders(f"{lake.root}/staging")


def test_a_build_that_fails_changes_nothing(spark, lake):
    lake.replace(spark.range(3).withColumnRenamed("id", "n"), "silver", "x")
    with pytest.raises(ZeroDivisionError):
        with lake.build():
            lake.replace(spark.range(5).withColumnRenamed("id", "n"), "silver", "x")
            lake.replace(spark.range(5).withColumnRenamed("id", "n"), "staging", "raw")
            raise ZeroDivisionError
    assert numbers(lake.table("silver", "x")) == numbers(spark.table(lake.name("silver", "x"))) == [0, 1, 2]
    assert not lake._folders(f"{lake.root}/staging")
    again = Lake(spark, lake.root, prefix=lake.prefix + "again_")
    again.attach()  # goes by the record, not by the latest folder
    assert numbers(spark.table(again.name("silver", "x"))) == [0, 1, 2]
    lake.replace(spark.range(2).withColumnRenamed("id", "n"), "silver", "x")
    assert numbers(again.table("silver", "x")) == [0, 1]


def test_two_writers_both_get_their_tables_in(spark, lake):
    other = Lake(spark, lake.root, prefix=lake.prefix)
    with lake.build():
        lake.replace(spark.range(1).withColumnRenamed("id", "n"), "silver", "one")
        other.replace(spark.range(2).withColumnRenamed("id", "n"), "silver", "two")
    assert lake.snapshot().tables("silver") == [("silver", "one"), ("silver", "two")]
    assert not lake._write_record(f"{lake.snapshot().number:012d}", {})  # a number is taken once


def test_a_partition_may_go_and_come(spark, lake):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, n int")
    for rows in (frame, frame.filter("n = 1"), frame.withColumn("n", F.lit(7))):
        lake.replace(rows, "silver", "q", partition_by=("dataset",))
        assert sorted(map(tuple, lake.table("silver", "q").select("dataset", "n").collect())) == sorted(map(tuple, rows.collect()))


def test_partitions_old_versions_and_a_new_session(spark, lake):
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, n int")
    for _ in range(4):
        lake.replace(frame, "silver", "q", partition_by=("dataset",))
    lake.append(spark.range(1), "ops", "log")
    lake.append(spark.range(1), "ops", "log")
    assert len(lake._folders(f"{lake.root}/silver/q")) == 2
    plan = lake.table("silver", "q").filter("dataset = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan
    again = Lake(spark, lake.root, prefix=lake.prefix + "again_")
    again.attach()
    assert again.tables("silver", "ops") == [("silver", "q"), ("ops", "log")]
    assert sorted(map(tuple, again.table("silver", "q").select("dataset", "n").collect())) == [("a", 1), ("b", 2)]
    assert again.table("ops", "log").count() == 2


def test_only_silver_and_gold_are_published(spark, lake, tmp_path):
    lake.replace(spark.range(3), "bronze", "raw")
    lake.replace(spark.range(3), "staging", "raw")
    lake.replace(spark.range(2).select(F.lit("1.50").cast("decimal(12,2)").alias("m")), "silver", "s")
    lake.replace(spark.range(4), "gold", "g")
    target = str(tmp_path / "site")
    manifest = publish(lake, target)
    assert [(r.schema, r.table, r.rows) for r in manifest.collect()] == [("silver", "s", 2), ("gold", "g", 4)]
    views = open_published(spark, target)
    assert sorted(views) == ["gold_g", "silver_s"]
    assert views["silver_s"].dtypes == [("m", "double")]
    listed = table_catalog(lake, "silver", "gold").collect()
    assert [(r.table_schema, r.table_name, r.position, r.column_name, r.data_type) for r in listed] == [
        ("silver", "s", 1, "m", "decimal(12,2)"), ("gold", "g", 1, "id", "bigint"),
    ]


def test_a_failed_publication_leaves_the_one_before(spark, lake, tmp_path):
    target = str(tmp_path / "site")
    with pytest.raises(ValueError, match="nothing is published"):
        open_published(spark, target)
    lake.replace(spark.range(2), "gold", "g")
    publish(lake, target)
    first = published_folder(spark, target)
    lake.replace(spark.range(5), "gold", "g")

    def broken(folder, build):
        assert spark.read.parquet(f"{folder}/gold.g.parquet").count() == 5  # written, but not yet published
        raise ZeroDivisionError

    with pytest.raises(ZeroDivisionError):
        publish(lake, target, broken)
    assert published_folder(spark, target) == first
    assert open_published(spark, target)["gold_g"].count() == 2
    publish(lake, target)
    assert open_published(spark, target)["gold_g"].count() == 5
    assert spark.read.parquet(f"{first}/gold.g.parquet").count() == 2  # readers may still be at it
    publish(lake, target)
    assert len(publications(spark, target)) == 2 and first not in publications(spark, target)


def test_the_shared_folder_comes_from_the_session(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/x-")
