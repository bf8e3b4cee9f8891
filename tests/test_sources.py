"""Files: discovery, sheets, lake, CSV."""

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from conftest import rows
from panelforge.operators import history as H
from panelforge.operators import profiling as P
from panelforge.operators import schema as S
from panelforge.session import shared_dir, stage
from panelforge.sources import delimited, discovery, grids, lake


@pytest.mark.parametrize("name, category, year", [
    ("estudiantes_matriculados_primer_anho_2020.csv", "matriculados_primer_anho", "2020"),
    ("Estudiantes_MATRICULADOS_2019.csv", "matriculados", "2019"),
    ("graduados_2001-2017.csv", "graduados", "2001_2017"),
    ("docentes.csv", "docentes", None),
    ("otros_1999_2014_2015.csv", "unknown", "2014"),
])
def test_names(spark, name, category, year):
    df = discovery.describe_files(spark.createDataFrame([(f"/a/{name}",)], "path string"))
    assert rows(df.select("filename", "category", "year")) == [(name, category, year)]


SHEET = "Título;;;;;\n;;;;;\nAño 2020;;;;;\nCódigo de la Institución;Sector IES;Unnamed: 2;Semestre;Sexo;Inscritos\n" \
        "1;Oficial;;1;F;5\n;;x;;;\n2;Privado;;2;M;7\n"


@pytest.fixture(scope="module")
def root(spark):
    root = shared_dir(spark, "books")
    for book, sheets in {"a": {"0_indice.csv": "Índice\ninscritos\n", "1.csv": SHEET}, "b": {"only.csv": SHEET},
                         "c": {"0.csv": "\n", "1.csv": "x;y\n1;2"}}.items():
        os.makedirs(f"{root}/{book}")
        for name, text in sheets.items():
            with open(f"{root}/{book}/{name}", "w", encoding="utf-8") as f:
                f.write(text)
    return root


@pytest.fixture(scope="module")
def books(spark, root):
    return grids.read_sheets(spark, root).withColumn("file", F.element_at(F.split("file", "/"), -1))


def test_discovery_lists_files(spark, root):
    found = discovery.discover_files(spark, root)
    assert sorted(r["filename"] for r in found.collect()) == ["0.csv", "0_indice.csv", "1.csv", "1.csv", "only.csv"]


def test_pick_sheet(books):
    got = rows(grids.pick_sheet(books, ";"), "file")
    # the index scores 1, the data sheet 5 (title year counts as no keyword cell); one sheet scores 0
    assert got[0][:2] == ("a", "1.csv") and got[0][2] > 1
    assert got[1] == ("b", "only.csv", 0, 1)
    assert got[2] == ("c", "0.csv", 0, 2)


def test_promote_header(books):
    done = grids.promote_header(books, ";")
    got = {(r["file"], r["sheet"]): r for r in done.collect()}
    good = got["a", "1.csv"]
    assert good["status"] == "success" and good["header_row"] == 3 and good["n_columns"] == 5
    assert good["columns"] == ["Código de la Institución", "Sector IES", None, "Semestre", "Sexo", "Inscritos"]
    assert len(good["records"]) == 2  # the row with a value in the dropped column only is empty
    assert got["c", "0.csv"]["status"] == "skipped_empty"
    assert got["c", "1.csv"]["status"] == "skipped_insufficient_data"
    table = grids.table_of(done.filter("file = 'b'"), ["Sector IES", "Inscritos", "absent"])
    assert rows(table, "Inscritos") == [("Oficial", "5", None), ("Privado", "7", None)]
    long = grids.cells_long(done.filter("file = 'b'"), ["file"])
    assert rows(long.filter("record = 1").select("name", "value"), "name")[0] == ("Código de la Institución", "2")


@pytest.mark.parametrize("text, row", [
    ("a;b\nies;sector\nies;programa\n", 1),          # equal score and density: the earlier row
    ("ies;;\nx;sector;y\n", 1),                       # equal score: the denser row
    ("\n" * 19 + "ies;sector\n", 19), ("\n" * 20 + "ies;sector\n", 0),  # beyond the scan nothing is found
    ("mano;b\naño;c\n", 1),                           # a whole-cell keyword
])
def test_header_rules(spark, text, row):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(grids.header_index(grids.lines_of("t"), ";")["row"]).first()[0] == row


def brute_score(text, keywords, whole, sep=";"):
    fold = lambda s: s.lower().strip(" ").translate(str.maketrans("áéíóúñ", "aeioun"))
    return [sum(any(k in fold(c) for k in keywords) or fold(c) in whole for c in line.split(sep)) for line in text.split("\n")]


def test_line_score_counts_cells(spark):
    text = "ies ies;x ies;;IES\nárea;AREA;a re a\n año ;ano;anos;x año\n;;\ndocentés ies"
    df = spark.createDataFrame([(text,)], "t string").select(F.explode(grids.lines_of("t")).alias("l"))
    got = [r[0] for r in df.select(grids.line_score(F.col("l"), ";", ["ies", "área", "docentes"], ["año"])).collect()]
    assert got == brute_score(text, ["ies", "area", "docentes"], ["ano"])


def test_profiles_take_each_header(spark):
    root = shared_dir(spark, "profiles")
    os.makedirs(f"{root}/x/y")
    for name, data in {"x/a.csv": '\ufeff"Nota, libre",INSCRITOS\r\n1,2\r\n\r\n3,4\r\n'.encode(), "x/y/b.csv": b"\n",
                       "c.csv": "Código,x\n1,2\n".encode("latin-1"), "d.csv": b"Sexo"}.items():
        with open(f"{root}/{name}", "wb") as f:
            f.write(data)
    got = {r["path"][-5:]: tuple(r)[1:] for r in P.file_profiles(spark, root).collect()}
    assert got == {"a.csv": ("ok", 2, 2, ["Nota, libre", "INSCRITOS"], ["Nota, libre"]), "b.csv": ("empty", 0, 0, [], []),
                   "c.csv": ("error", 1, 0, [], []), "d.csv": ("ok", 0, 1, ["SEXO"], [])}


def test_profiles_of_headers_with_line_breaks(spark):
    root = shared_dir(spark, "profiles")
    os.makedirs(root)
    head = '"Código de \nla Institución",Semestre,Sector IES\n'
    with open(f"{root}/a.csv", "w", encoding="utf-8") as f:
        f.write(head + '1,1,"a\n\n \nb"\n\n2,2,oficial\n')
    got = [tuple(r)[1:] for r in P.file_profiles(spark, root).collect()]
    assert got == [("ok", 2, 3, ["CÓDIGO DE LA INSTITUCIÓN", "SEMESTRE", "SECTOR IES"], [])]


def test_exports_begin_with_a_mark(spark):
    root = shared_dir(spark, "export")
    df = spark.createDataFrame([(1, 'a "b", c\u00f1')], "id long, t string")
    paths = delimited.export_tables({"one": df, "two": df.where("false")}, root, bom=True)
    assert paths == [f"{root}/one", f"{root}/two"]
    held = spark.read.option("header", True).option("escape", '"').csv(paths[0])
    assert held.columns == ["id", "t"] and rows(held) == [("1", 'a "b", c\u00f1')]
    part = next(f for f in os.listdir(paths[0]) if f.startswith("part-"))
    with open(f"{paths[0]}/{part}", "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"


def test_quoted_cells(spark):
    text = ('Título;"abierto\n"Código de \nla Institución";"Departamento; IES";Sexo;Semestre;Inscritos\n'
            '"1";"a;b";"x\r\ny";"dice ""no""";""\n;"";;;\n2;5" x;"mal"z;q;7')
    done = grids.promote_header(spark.createDataFrame([("f", text), ("n", None), ("e", "")], "file string, text string"), ";")
    got = {r["file"]: r for r in done.collect()}
    assert got["f"]["header_row"] == 1 and got["f"]["status"] == "success"
    assert got["f"]["columns"] == ["Código de \nla Institución", "Departamento; IES", "Sexo", "Semestre", "Inscritos"]
    assert got["f"]["records"] == [["1", "a;b", "x\r\ny", 'dice "no"', ""], ["2", '5" x', '"mal"z', "q", "7"]]
    assert got["n"]["status"] == got["e"]["status"] == "skipped_empty"
    plain = grids.promote_header(spark.createDataFrame([('ies;"a;b";c;d;e\n1;2;3;4;5;6',)], "text string"), ";", quote=None)
    assert plain.first()["n_columns"] == 6


def test_lake_round_trip_and_idempotent_append(spark):
    root = shared_dir(spark, "lake")
    df = spark.createDataFrame([(1, 2013, "x"), (2, 2013, "x"), (3, 2014, "x"), (4, None, "x")], f"v int, `{S.YEAR}` int, _m string")
    done = lake.write_category(df, root, "inscritos")
    assert (done["status"], done["n_rows"], done["n_years"]) == ("success", 4, 2)
    more = spark.createDataFrame([(9, 2014, 1), (8, 2015, 1)], f"v int, `{S.YEAR}` int, extra int")
    for _ in range(2):
        done = lake.write_category(more, root, "inscritos", mode="replace_years")
        assert (done["n_rows"], done["n_years"]) == (2, 2)
    held = lake.read_category(spark, root, "inscritos")
    assert sorted(held.columns) == sorted(["v", "extra", S.YEAR])
    assert sorted(r["v"] for r in held.collect()) == [1, 2, 4, 8, 9]
    assert [r["v"] for r in lake.read_category(spark, root, "inscritos", [2015]).collect()] == [8]
    assert rows(lake.integrity_report(spark, root)) == [("inscritos", "ok", 3, "2013,2014,2015", 5)]
    assert lake.write_category(df.drop(S.YEAR), root, "admitidos")["status"] == "error"
    with pytest.raises(ValueError):
        lake.write_category(df, root, "inscritos", mode="merge")


def test_year_filter_prunes_partitions(spark):
    root = shared_dir(spark, "lake")
    lake.write_category(spark.range(10).withColumn(S.YEAR, (F.col("id") % 5 + 2013).cast("int")), root, "inscritos")
    plan = lake.read_category(spark, root, "inscritos", [2014])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2014" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_skewed_year_is_split(spark):
    """One year with most rows is written by several tasks, small years by one each."""
    root = shared_dir(spark, "lake")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(0, 60000, 1, 8).select(F.rand(1).alias("v"), F.when(F.col("id") % 10 < 8, 2013).otherwise(2014 + F.col("id") % 2).cast("int").alias(S.YEAR))
        lake.write_category(df, root, "inscritos")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = lake.read_category(spark, root, "inscritos").inputFiles()
    assert sum("2013" in f for f in files) > 1


def test_load_lake_from_prepared_files(spark):
    src, root = shared_dir(spark, "prepared"), shared_dir(spark, "lake")
    for year, code in (("2018", "1"), ("2019", "2")):
        (spark.createDataFrame([(code, "10", "f", "1", "7")], "`Código de la Institución` string, "
                               "`Código SNIES del programa` string, sexo string, semestre string, inscritos string")
         .write.parquet(f"{src}/{year}"))
    files = {"inscritos": [(y, f"{src}/{y}") for y in ("2018", "2019", "2020")]}  # 2020 is not there
    written, report, told = H.load_lake(spark, files, root)
    assert sorted((r["year"], r["status"]) for r in told) == [("2018", "processed"), ("2019", "processed"), ("2020", "error")]
    assert all(r["reason"] for r in told if r["status"] == "error")
    assert [(w["status"], w["n_rows"]) for w in written] == [("success", 2)]
    assert rows(report) == [("inscritos", "ok", 2, "2018,2019", 2)]
    H.load_lake(spark, files, root, mode="replace_years", years=[2019])
    assert rows(lake.integrity_report(spark, root)) == [("inscritos", "ok", 2, "2018,2019", 2)]
    _, reports = H.merge_category(spark, "inscritos", files["inscritos"])
    assert sorted(r["status"] for r in reports) == ["error", "processed", "processed"]


def test_years_of_any_century_are_counted(spark):
    root = shared_dir(spark, "lake")
    df = spark.createDataFrame([(1, 1200), (2, 1849), (3, 2150), (4, 99999), (5, None)], f"v int, `{S.YEAR}` int")
    done = lake.write_category(df, root, "inscritos")
    assert (done["n_rows"], done["n_years"]) == (5, 4)
    assert rows(lake.integrity_report(spark, root)) == [("inscritos", "ok", 4, "1200,1849,2150,99999", 5)]
    assert rows(lake.read_category(spark, root, "inscritos", [1849]).select("v")) == [(2,)]


def test_a_write_that_breaks_off_leaves_the_old_version(spark, monkeypatch):
    root = shared_dir(spark, "lake")
    df = spark.createDataFrame([(1, 2020), (2, 2021)], f"v int, `{S.YEAR}` int")
    lake.write_category(df, root, "inscritos")
    bad = df.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v") + 10))
    for mode in lake.MODES:
        with pytest.raises(Exception, match="stop"):
            lake.write_category(bad, root, "inscritos", mode=mode)
        assert sorted(rows(lake.read_category(spark, root, "inscritos"))) == [(1, 2020), (2, 2021)]
    monkeypatch.setattr(lake, "_commit", lambda *a: 1 / 0)  # all files written, the version not
    with pytest.raises(ZeroDivisionError):
        lake.write_category(df.withColumn("v", F.col("v") + 10), root, "inscritos")
    monkeypatch.undo()
    assert sorted(rows(lake.read_category(spark, root, "inscritos"))) == [(1, 2020), (2, 2021)]
    assert lake.versions(spark, root, "inscritos") == [1]
    os.makedirs(f"{root}/{lake.VERSIONS}/category=inscritos/version=2/_temporary")  # a commit that broke off
    lake.write_category(df.withColumn("v", F.col("v") + 10), root, "inscritos")
    assert lake.versions(spark, root, "inscritos") == [1, 2]


def test_a_version_is_switched_in_one_step_and_earlier_ones_stay(spark):
    root = shared_dir(spark, "lake")
    frame = lambda *r: spark.createDataFrame(list(r), f"v int, `{S.YEAR}` int")
    lake.write_category(frame((1, 2020), (2, 2021)), root, "inscritos")
    reader = lake.read_category(spark, root, "inscritos")
    lake.write_category(frame((3, 2021), (4, 2022)), root, "inscritos", mode="replace_years")
    assert sorted(r["v"] for r in reader.collect()) == [1, 2]  # what was opened before stays whole
    assert sorted(r["v"] for r in lake.read_category(spark, root, "inscritos").collect()) == [1, 3, 4]
    lake.write_category(frame((9, 2000)), root, "inscritos")
    assert [sorted(r["v"] for r in lake.read_category(spark, root, "inscritos", version=n).collect()) for n in (1, 2, 3)] == [[1, 2], [1, 3, 4], [9]]
    with pytest.raises(FileNotFoundError):
        lake.read_category(spark, root, "inscritos", version=7)
    with pytest.raises(Exception, match="version=3"):  # another writer was first
        lake._commit(spark, root, "inscritos", 3, [])


def test_a_read_of_one_year_opens_only_its_files(spark):
    root = shared_dir(spark, "lake")
    df = spark.range(40).select(F.col("id").alias("v"), (F.col("id") % 4 + 2010).cast("int").alias(S.YEAR))
    lake.write_category(df, root, "inscritos")
    lake.write_category(df.where("v < 8").withColumn("extra", F.lit("x")), root, "inscritos", mode="replace_years", years=[2011])
    one = lake.read_category(spark, root, "inscritos", [2011])
    assert all(f"{S.YEAR}=2011" in f or "=2011" in f for f in one.inputFiles()) and one.inputFiles()
    assert one.columns == ["v", S.YEAR, "extra"] and sorted(r["v"] for r in one.collect()) == [1, 5]
    assert lake.read_category(spark, root, "inscritos", [1999]).count() == 0
    two = lake.read_category(spark, root, "inscritos", [2012])
    assert two.columns == ["v", S.YEAR, "extra"] and len(two.inputFiles()) == 1


def test_kept_ranges_skip_files(spark):
    root = shared_dir(spark, "lake")
    for low in (0, 1000, 2000):
        part = spark.range(low, low + 100).select(F.col("id").alias("v"), F.lit(2020).alias(S.YEAR), F.lit("a b").alias("t"))
        lake.write_category(part, root, "inscritos", mode="append", ranges=["v"] if low != 2000 else [])
    some = lake.read_category(spark, root, "inscritos", between={"v": (1010, 1019)})
    assert sorted(r["v"] for r in some.collect()) == list(range(1010, 1020))
    assert len(some.inputFiles()) == 2  # the one that fits, and the one without ranges
    assert lake.read_category(spark, root, "inscritos", between={"v": (5000, 6000)}).count() == 0
    both = lake.read_category(spark, root, "inscritos", [2020], between={"v": (50, 1049)})
    assert both.count() == 100 and len(both.inputFiles()) == 3


def test_unreadable_files_are_in_the_report(spark):
    root = shared_dir(spark, "lake")
    df = spark.createDataFrame([(1, 2020)], f"v int, `{S.YEAR}` int")
    lake.write_category(df, root, "good")
    lake.write_category(df, root, "bad")
    for f in lake.read_category(spark, root, "bad").inputFiles():
        with open(unquote(f.removeprefix("file://")), "wb") as out:
            out.write(b"no parquet")
    assert [r[:2] for r in rows(lake.integrity_report(spark, root), "category")] == [("bad", "error"), ("good", "ok")]


def test_append_adds_and_empty_tables_report_nothing(spark):
    root = shared_dir(spark, "lake")
    df = spark.createDataFrame([(1, 2020)], f"v int, `{S.YEAR}` int")
    assert lake.write_category(df.where("false"), root, "admitidos")["n_rows"] == 0
    for _ in range(2):
        assert lake.write_category(df, root, "inscritos", mode="append")["n_rows"] == 1
    assert lake.read_category(spark, root, "inscritos").count() == 2


def test_only_graduates_lose_years_of_the_multi_year_file(spark):
    df = spark.createDataFrame([("2001_2017", 2012), ("2001_2017", 2014), ("2018", 2018)], f"_source_year string, `{S.YEAR}` int")
    assert H.wanted_years(df, "inscritos").count() == 3 and H.wanted_years(df, "graduados").count() == 2


def test_export_by_position(spark):
    path = shared_dir(spark, "csv")
    df = spark.createDataFrame([("7", "p", "Núñez", "1.5", "2013"), ("x", "p", "b", "", "n/a")], "`CËD` string, b string, c string, m string, `AÐO` string")
    delimited.write_csv(df, path, encoding=delimited.LATIN)
    out = delimited.read_export(spark, path, "METRIC", positions={0: "COD_IES", 2: "NOMBRE_IES"})
    assert rows(out.select("COD_IES", "NOMBRE_IES", "METRIC", S.YEAR), "NOMBRE_IES") == [(7.0, "Núñez", 1.5, 2013.0), (None, "b", None, None)]


def test_many_files_in_few_layouts_are_few_scans(spark):
    """Files of one layout are one scan, with the year of each row from its file."""
    src = shared_dir(spark, "prepared")
    base = "`Código de la Institución` string, `Código SNIES del programa` string, semestre string"
    files = []
    for i in range(45):
        extra = [", `Inscritos` string", ", `Inscripciones 2018` string", ", `Inscritos` string, `Año` string"][i % 3]
        values = [str(i), "10", "1", "7", "2016"][:4 + (i % 3 == 2)]
        path = f"{src}/f {i}"
        spark.createDataFrame([tuple(values)], base + extra).coalesce(1).write.parquet(path)
        files.append((str(2014 + i % 5), path))
    merged, reports = H.merge_category(spark, "inscritos", files)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("] parquet") == 3 and len(reports) == 45
    got = sorted((int(r[0]), r[1], r[2]) for r in merged.select(S.INSTITUTION_CODE, S.YEAR, "INSCRITOS").collect())
    assert got == [(i, 2016 if i % 3 == 2 else 2014 + i % 5, 7) for i in range(45)]


def test_stage_reads_back_the_same(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    assert rows(stage(df), "id") == rows(df, "id")
