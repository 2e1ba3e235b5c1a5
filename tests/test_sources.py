"""Scans, pages, sinks and the stream."""

import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from comarca.plans import marts
from comarca.session import new_folder
from comarca.sources import csvs, dims, files, grids, lineage, tables, web
from comarca.streaming import arrivals


def test_text_grid_roundtrip(spark, tmp_path, rows):
    (tmp_path / "2020_01.txt").write_text("[PARO LUGO]\na;;c\n;;\n[PARO JAEN]\nx;y;z\n")
    got = grids.read_text_grid(spark, str(tmp_path))
    assert rows(got) == [("2020_01.txt", 0, "PARO LUGO", 0, ["a", None, "c"]),
                         ("2020_01.txt", 0, "PARO LUGO", 1, [None, None, None]),
                         ("2020_01.txt", 1, "PARO JAEN", 0, ["x", "y", "z"])]
    folder = new_folder(spark, "test-grid")
    grids.write_text_grid(got, folder)
    assert rows(grids.read_text_grid(spark, folder), *got.columns) == rows(got)


@pytest.mark.parametrize("split", ["128m", "40b"])
def test_text_workbook_over_splits(spark, tmp_path, rows, split):
    draw, want = random.Random(9), []
    for name in ("a.txt", "b.txt"):
        text = ["above", "the first title"]
        for sheet in range(6):
            text.append(f"[S {sheet}]" + " " * (sheet % 2))
            for i in range(draw.choice([0, 1, 9])):
                cells = [draw.choice(["", "x", "[no] y", "long " * 12]) for _ in range(draw.randint(1, 4))]
                text.append(";".join(cells))
                want.append((name, sheet, f"S {sheet}", i, [c or None for c in cells]))
        (tmp_path / name).write_text("\r\n".join(text) + "\r\n" * (name == "a.txt"))
    (tmp_path / "empty.txt").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows(grids.read_text_grid(spark, str(tmp_path))) == sorted(
            want, key=lambda r: tuple((v is None, str(v)) for v in r))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_workbook_decoders_fall_back_and_report(spark, tmp_path, rows):
    def decode_json(content: bytes):
        for number, (name, lines) in enumerate(json.loads(content).items()):
            for i, cells in enumerate(lines):
                yield number, name, i, cells

    def refuse(content: bytes):
        raise ValueError("unknown format")

    (tmp_path / "good.xls").write_text(json.dumps({"S": [["a", 1], [None, "b"]]}))
    (tmp_path / "bad.xls").write_text("{")
    (tmp_path / "other.txt").write_text("{}")
    got = grids.read_workbooks(spark, str(tmp_path), [refuse, decode_json], rows_per_batch=1)
    good = got.where("sheet is not null")
    assert rows(good) == [("good.xls", 0, "S", 0, ["a", "1"]), ("good.xls", 0, "S", 1, [None, "b"])]
    bad = got.where("sheet is null").first()
    assert bad.source_file == "bad.xls" and bad.cells[0] == "ValueError: unknown format" and len(bad.cells) == 2


def test_csv_keeps_bad_lines_and_skips_empty_files(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("k,v\n1,x\nno,y\n")
    (tmp_path / "b.csv").write_text("k,v\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text('v,extra,k\n"p, ""q""",1,7\nshort,1\n')
    df = csvs.read_csv(spark, str(tmp_path), "k int, v string")
    assert rows(csvs.good_rows(df)) == [(1, "x", "a.csv"), (7, 'p, "q"', "d.csv")]
    assert rows(csvs.good_rows(df).select("v")) == [('p, "q"',), ("x",)]
    assert rows(csvs.bad_rows(df)) == [("a.csv", "no,y"), ("d.csv", "short,1")]
    assert csvs.good_rows(df).count() == 2


def test_drifting_csv_headers(spark, tmp_path, rows):
    (tmp_path / "pobmun98.csv").write_text("CPRO,NOMBRE,pob98,NOMBRE\n01,a,5,x\n")
    (tmp_path / "pobmun99.csv").write_text("CPRO,NOMBRE,pob98,NOMBRE\n02,b,6,y\n")
    (tmp_path / "pobmun00.csv").write_text("Total,Municipio,Isla\n7,c,z\n")
    (tmp_path / "pobmun01.csv").write_text("Total,Municipio,Isla\n")
    got = csvs.read_drifting_csv(spark, str(tmp_path))
    assert rows(got, "source_file", "province_code", "municipality_name", "municipality_name_1",
                "population_total", "island") == [
        ("pobmun00.csv", None, "c", None, "7", "z"), ("pobmun98.csv", "01", "a", "x", "5", None),
        ("pobmun99.csv", "02", "b", "y", "6", None)]


def test_drifting_csv_quotes_two_meanings_and_bad_lines(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('CPRO,"Ambos, sexos",Varones\n01,9,4\n02,5\n03,1,2,3\n')
    (tmp_path / "b.csv").write_text("province,total\n04,1\n")
    (tmp_path / "c.csv").write_text("province,total\n05,1\nSoria,2\n")
    (tmp_path / "d.csv").write_text("")
    got = csvs.read_drifting_csv(spark, str(tmp_path))
    assert rows(csvs.good_rows(got), "source_file", "province_code", "province_name", "population_male") == [
        ("a.csv", "01", None, "4"), ("b.csv", "04", None, None), ("c.csv", None, "05", None),
        ("c.csv", None, "Soria", None)]
    assert rows(csvs.bad_rows(got)) == [("a.csv", "02,5"), ("a.csv", "03,1,2,3")]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    assert csvs.read_drifting_csv(spark, str(tmp_path / "empty")).count() == 0


def by_reader(path):
    """Rows of Python's own CSV reader below the header."""
    with open(path, newline=None, encoding="utf-8") as f:
        return [tuple(c or None for c in r) for r in list(csv.reader(f))[1:] if r]


@pytest.mark.parametrize("split", ["128m", "150b"])
def test_csv_cells_with_line_breaks_over_splits(spark, tmp_path, rows, split):
    draw = random.Random(8)
    pieces = ["x", "\n", '"', ",", "y y", "\n\n", "ñ", "", "k,v"]
    for name in "abc":
        with open(tmp_path / f"{name}.csv", "w", encoding="utf-8", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(["k", "v"])
            for k in range(40):
                out.writerow([k, "".join(draw.choices(pieces, k=draw.randint(0, 5)))])
    (tmp_path / "plain.csv").write_text("v,k\np,1\n\nq,2\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = csvs.read_csv(spark, str(tmp_path), "k int, v string")
        assert csvs.bad_rows(got).count() == 0
        want = [(int(k), v, f"{n}.csv") for n in "abc" for k, v in by_reader(tmp_path / f"{n}.csv")]
        assert rows(got, "k", "v", "source_file") == sorted(
            [*want, (1, "p", "plain.csv"), (2, "q", "plain.csv")], key=lambda r: tuple((v is None, str(v)) for v in r))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_of_stray_and_open_quotes(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('k,v\n1,5" pipe\n2,"a\nb"\n3,it\'s 3"x4\n4,""\n')
    (tmp_path / "b.csv").write_text('k,v\n1,"never closed\n2,x\n3,y\n')  # odd: line by line
    (tmp_path / "c.csv").write_text('k,v\n1,"open\n' + "2,x\n" * 20 + '3,"open again\n4,z\n')
    df = csvs.read_csv(spark, str(tmp_path), "k int, v string")
    good, bad = csvs.good_rows(df), csvs.bad_rows(df)
    assert rows(good.where("source_file = 'a.csv'"), "k", "v") == [
        (1, '5" pipe'), (2, "a\nb"), (3, 'it\'s 3"x4'), (4, None)]
    assert rows(good.where("source_file = 'b.csv'"), "k", "v") == [(2, "x"), (3, "y")]
    assert rows(bad.where("source_file = 'b.csv'"), csvs.CORRUPT) == [('1,"never closed',)]
    assert rows(good.where("source_file = 'c.csv'"), "k", "v") == [(4, "z")]
    assert bad.where("source_file = 'c.csv'").count() == 1
    short = csvs.records(spark, str(tmp_path / "c.csv"), max_lines=10)
    assert short.count() == 24  # a record of 22 lines is left as lines


def test_csv_line_of_a_hundred_thousand_quoted_cells(spark, tmp_path):
    n = 100_000
    (tmp_path / "wide.csv").write_text(",".join(f"c{i}" for i in range(n)) + "\n"
                                       + ",".join(f'"a ""{i}"", b"' for i in range(n)) + "\n")
    row = csvs.read_csv(spark, str(tmp_path), f"c0 string, c{n - 1} string").collect()
    assert [tuple(r)[:3] for r in row] == [('a "0", b', f'a "{n - 1}", b', None)]


def test_inventory_and_unprocessed(spark, tmp_path, rows):
    (tmp_path / "a.xls").write_bytes(b"x" * 1024 * 1024)
    (tmp_path / "b.txt").write_bytes(b"x")
    got = files.file_inventory(spark, str(tmp_path), "*.xls")
    assert rows(got, "filename", "size_mb") == [("a.xls", 1.0)]
    inputs = spark.createDataFrame([(1,), (2,)], "k int")
    done = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(files.unprocessed(inputs, done, ["k"])) == [(2,)]
    assert rows(files.unprocessed(inputs, done, ["k"], force=True)) == [(1,), (2,)]


def test_pages(spark, rows):
    pages = spark.createDataFrame([
        (1, "u", '<a href="/m/2020/mayo-2020.html">x</a><a href="/m/2020/mayo-2020.html">y</a><a href="/z/2020/a">'),
        (2, "u", '<a href="/a.xls">1</a> Libro COMPLETO <a href="/b.XLS?x">2</a>'),
        (3, "u", 'libro completo <a href="/a.pdf">'),
        (4, "u", '<p>no table</p>'),
        (5, "u", '<TABLE><tr><td> a </td><th><b>b</b></th></tr><tr></tr><tr><td>1</td><td></td><td>3</td></tr></TABLE>')],
        "page_id int, url string, html string")
    assert rows(web.links_by_year(pages, "/m/", "http://h")) == [(2020, "mayo-2020", "http://h/m/2020/mayo-2020.html")]
    picked = web.pick_attachment(pages, "libro completo", base="http://h").where("page_id in (2, 3)")
    assert rows(picked, "page_id", "attachment_url") == [(2, "http://h/b.XLS?x"), (3, None)]
    assert rows(web.html_table_rows(pages)) == [(5, 1, 0, "a", "1"), (5, 1, 1, "b", ""), (5, 1, 2, None, "3")]


def test_pages_of_odd_markup(spark, rows):
    deep = "<table>" * 300 + "x" + "</table>" * 300
    pages = spark.createDataFrame([
        (1, '<!-- <a href="no.xls"> --><a title="a>b" href="x.xls"><a\nclass=c\thref=\'y.xls\'><link/href=z data-href="no">'),
        (2, '<a title=\'href="no"\' href = " /p?a&amp;b&#8364;&#x1F600;&uuml;&ccedil;&Ntilde;&#150;&#0;&#xD800;&amp " >'),
        (3, "<table><tr><td>1<td>2<tr><td>3"),
        (4, f"<table><tr><td>a<td>{deep}</td><td>c</td></tr><tr><td>b</table><table><tr><td>no"),
        (5, "<a " + 'k="v>" ' * 30_000 + 'href="long">' + "<" * 2000 + "&" * 2000),
        (6, None), (7, ""), (8, "<table>"), (9, "</table><p title=\"open>"),
        (10, "<table><tr>" + "<td>x" * 3000 + "<tr>" + "<td colspan=3>y" * 1000)], "page_id int, html string")
    links = {}
    for page, href in rows(web.page_links(pages)):
        links.setdefault(page, set()).add(href)
    assert links == {1: {"x.xls", "y.xls", "z"}, 5: {"long"},
                     2: {"/p?a&b\u20ac\U0001f600\u00fc\u00e7\u00d1\u2013\ufffd\ufffd&amp"}}
    cells = rows(web.html_table_rows(pages.where("page_id <> 10")))
    assert cells == [(3, 1, 0, "1", "3"), (4, 1, 0, "a", "b")]
    wide = web.html_table_rows(pages.where("page_id = 10"))
    assert wide.where("header = 'x' and value = 'y'").count() == 3000


def test_lineage(spark):
    df = lineage.stamp(spark.range(1), "economy", F.lit("f.csv"))
    row = df.first()
    assert row.data_source == "Banco de España" and row.source_file == "f.csv" and row.ingestion_timestamp
    with pytest.raises(KeyError):
        lineage.source_config("weather")


def test_upsert_and_schema_sync(spark, rows):
    target = spark.createDataFrame([(1, 2000, "a", 1), (1, 2001, "b", 2), (2, 2001, "c", 3)],
                                   "k int, y int, v string, old int")
    batch = spark.createDataFrame([(1, 2001, "B", 1.5), (3, 2002, "d", 2.5)], "k int, y int, v string, new double")
    want = [(1, 2000, "a", None), (1, 2001, "B", 1.5), (2, 2001, "c", None), (3, 2002, "d", 2.5)]
    assert rows(tables.upsert(target, batch, ["k", "y"]), "k", "y", "v", "new") == want
    assert rows(tables.upsert(target, batch, ["k", "y"], touched=F.col("y") >= 2001), "k", "y", "v", "new") == want
    assert tables.refresh_start(target, "y", 1990) == 2000
    assert tables.refresh_start(target.limit(0), "y", 1990) == 1989


def test_stored_merge_follows_the_schema(spark, rows):
    folder = new_folder(spark, "test-merge")
    read = lambda *columns: rows(tables.read_stored(spark, folder), *columns)
    make = spark.createDataFrame
    tables.store_partitions(make([(1, 2000, "a", 1), (2, 2001, "b", 2), (None, None, "n", 3)],
                                 "k int, y int, v string, old int"), folder, "y")
    merge = lambda df, keys=("k", "y"): tables.merge_partitions(df, folder, list(keys), "y")
    for _ in range(2):  # a new column, one gone, null keys, a new partition
        merge(make([(2, 2001, "B", 1.5), (3, 2002, "c", 2.5), (None, None, "N", 3.5)], "k int, y int, v string, new double"))
    assert read("k", "y", "v", "new") == [(1, 2000, "a", None), (2, 2001, "B", 1.5), (3, 2002, "c", 2.5),
                                          (None, None, "N", 3.5)]
    assert tables.read_stored(spark, folder).columns == ["k", "v", "new", "y"]
    # the column that went comes back with another type: its old values do not
    merge(make([(4, 2002, "d", 0.5, "x")], "k int, y int, v string, new double, old string"))
    assert read("k", "y", "old") == [(1, 2000, None), (2, 2001, None), (3, 2002, None), (4, 2002, "x"), (None, None, None)]
    # a column changes its type; keys without the partition are found in every partition, which may run empty
    merge(make([(1, 2002, "A", "new", "y"), (2, 2000, "B", "z", None)], "k int, y int, v string, new string, old string"), ["k"])
    assert read("k", "y", "v", "new") == [(1, 2002, "A", "new"), (2, 2000, "B", "z"), (3, 2002, "c", "2.5"),
                                          (4, 2002, "d", "0.5"), (None, None, "N", "3.5")]
    merge(make([(9, 2000, "q")], "k int, y int, v string").limit(0))
    assert read("k", "y", "v")[0] == (1, 2002, "A") and tables.stored_schema(spark, folder)[1] == ["new", "old"]


def test_merge_that_fails_leaves_the_old_rows(spark, rows):
    folder = new_folder(spark, "test-merge")
    tables.store_partitions(spark.createDataFrame([(1, 2000), (2, 2001)], "k int, y int"), folder, "y")
    bad = spark.createDataFrame([(1, 2000), (0, 2001)], "k int, y int").withColumn(
        "n", F.when(F.col("k") == 0, F.raise_error(F.lit("bad row"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="bad row"):
        tables.merge_partitions(bad, folder, ["k"], "y")
    assert rows(tables.read_stored(spark, folder)) == [(1, 2000), (2, 2001)]


def test_partition_overwrite_and_consolidate(spark, rows):
    folder = new_folder(spark, "test-parts")
    schema = "k int, y int"
    tables.overwrite_partitions(spark.createDataFrame([(1, 2000), (2, 2001)], schema), folder, "y")
    tables.overwrite_partitions(spark.createDataFrame([(9, 2001)], schema), folder, "y")
    assert rows(spark.read.parquet(folder)) == [(1, 2000), (9, 2001)]
    done = spark.read.parquet(folder)
    tables.consolidate(spark.createDataFrame([(5, 2001), (6, 2002)], schema), folder, ["y"], skip_existing=done)
    assert rows(spark.read.parquet(folder)) == [(1, 2000), (6, 2002), (9, 2001)]


def test_incremental_equals_full_build(spark, rows):
    years = range(2000, 2006)
    pop = [(1, m, y, 1000 + 10 * m + (y % 3), 0.5 * m, "growth", 1, f"n{m}") for m in (1, 2, 3) for y in years]
    people = spark.createDataFrame(pop, "province_code int, municipality_code bigint, data_year int, total_population "
                                        "bigint, population_change_pct double, population_trend string, "
                                        "autonomous_community_code int, municipality_name string")
    work = people.select("province_code", "municipality_code", "data_year", "municipality_name",
                         (F.col("data_year") * 7 % 50 + 1).cast("bigint").alias("primary_total_unemployment"),
                         F.lit(1.0).alias("unemployment_change_pct"), F.lit("stable").alias("unemployment_trend"),
                         F.lit("complete").alias("data_coverage_quality"))
    full = marts.unemployment_rates(people, work, (2001, 2005))
    target = marts.unemployment_rates(people, work, (2001, 2004))
    start = tables.refresh_start(target, "data_year", 2001)
    batch = marts.unemployment_rates(people, work, (2001, 2005), since=start)
    got = tables.upsert(target, batch, marts.PLACE_YEAR)
    assert start == 2003 and rows(got, *full.columns) == rows(full)


def test_full_refresh_keeps_views(spark):
    folder = new_folder(spark, "test-refresh")
    name = "t_" + folder[-10:]
    tables.full_refresh(spark.createDataFrame([(1, "a")], "k int, v string"), name, folder)
    spark.sql(f"CREATE VIEW {name}_v AS SELECT k FROM {name}")
    tables.full_refresh(spark.createDataFrame([("b", 2), ("c", 3)], "v string, k int"), name)
    assert sorted(r.k for r in spark.table(f"{name}_v").collect()) == [2, 3]


def test_stream_reads_every_file_once(spark, rows):
    folder = new_folder(spark, "test-stream")
    schema = "k int, v string"
    arrive = lambda data: spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run = lambda: arrivals.intake(spark, f"{folder}/in", schema, f"{folder}/sink", f"{folder}/state")
    arrive([(1, "a"), (2, "b")])
    run()
    run()
    assert spark.read.parquet(f"{folder}/sink").count() == 2
    arrive([(2, "B"), (3, "c")])
    run()
    assert spark.read.parquet(f"{folder}/sink").count() == 4
    assert rows(arrivals.current_rows(spark, f"{folder}/sink", ["k"])) == [(1, "a"), (2, "B"), (3, "c")]


def test_current_state_follows_the_files(spark, rows, tmp_path):
    folder = new_folder(spark, "test-current")
    schema = "k int, y int, v string"

    def deliver(day, name, lines):
        (tmp_path / day).mkdir(exist_ok=True)
        (tmp_path / day / name).write_text("".join(f"{line}\n" for line in lines))

    def take_in():
        arrivals.intake_current(spark, str(tmp_path), schema, f"{folder}/t", f"{folder}/log", f"{folder}/state",
                                ["k", "y"], "y", fmt="csv", glob="*.csv")
        return rows(tables.read_stored(spark, f"{folder}/t"), "k", "y", "v", "source_file")

    log = lambda: rows(spark.read.schema(arrivals.LOG_SCHEMA).parquet(f"{folder}/log"), "batch_id", "source_file", "status")
    deliver("d1", "a.csv", ["1,2000,a", "2,2001,b", ",2001,n", "1,2000,z"])
    deliver("d1", "copy.csv", ["2,2001,b", "1,2000,a", "1,2000,z", ",2001,n"])
    assert take_in() == [(1, 2000, "z", "a.csv"), (2, 2001, "b", "a.csv"), (None, 2001, "n", "a.csv")]
    assert take_in() and log() == [(0, "a.csv", "new"), (0, "copy.csv", "redelivered")]
    deliver("d2", "a.csv", ["2,2001,B", "3,2002,c"])  # the same name, other content
    deliver("d2", "b.csv", ["2,2001,b", "1,2000,a", "1,2000,z", ",2001,n"])  # old content, another name
    assert take_in() == [(1, 2000, "z", "a.csv"), (2, 2001, "B", "a.csv"), (3, 2002, "c", "a.csv"), (None, 2001, "n", "a.csv")]
    assert log()[2:] == [(1, "a.csv", "changed"), (1, "b.csv", "redelivered")]
    with pytest.raises(ValueError, match="one of the keys"):
        arrivals.intake_current(spark, str(tmp_path), schema, "t", "l", "s", ["k"], "y")


def test_seed_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('autonomous_community_code,autonomous_community_name,province_code,province_name\n'
                    '12,Galicia,15,"Coruña, A"\n', encoding="utf-8")
    row = dims.read_seed(spark, str(path), dims.PROVINCE_SCHEMA).first()
    assert tuple(row) == (12, "Galicia", 15, "Coruña, A")
