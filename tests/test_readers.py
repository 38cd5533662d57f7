"""Readers on real landed files: FX1 as a ';' latin-1 CSV sheet, FX4 as the indicator CSV."""

from tallyframe.plans import election as EL
from tallyframe.plans import indicators as IN
from tallyframe.sources import readers

FX1_CSV = """Code du département;Libellé du département;Inscrits;Votants;Exprimés;DUPONT_VOIX;DUPONT_EXP;LE_GALL_VOIX
75;Paris ;1000;800;780;400;51,28;380
77.0;Seine-et-Marne;0;50;;;60;10
13;Bouches-du-Rhône;9;9;9;9;9;9
92;Hauts-de-Seine;200;100;90;;50;
"""

FX4_CSV = """codgeo;variable;sous_champ;A2007;A2012;A2017;A2022
75;taux_chom_bit;total;8,1;;8,0;6,5
75;taux_chom_bit;hommes;9;9;9;9
75;niveau_vie_median;;25000;26 000;;N/A
77;part_pls;;; ;16,5;17
75;taux_chom_bit;total ;8,3;;;
13;part_pls;;1;1;1;1
"""


def test_wide_sheet_csv(spark, tmp_path):
    p = tmp_path / "2012.csv"
    p.write_bytes(FX1_CSV.encode("latin-1"))
    sheets = readers.read_wide_results(spark, {2012: str(p)}, sep=";", encoding="ISO-8859-1")
    out = {(r.dept_code, r.candidate_name): r for r in EL.collect_results(spark, sheets).collect()}
    assert set(out) == {("75", "DUPONT"), ("75", "LE GALL"), ("77", "DUPONT"), ("92", "DUPONT")}
    assert out[("75", "DUPONT")].vote_share == 0.512821 and out[("92", "DUPONT")].votes == 45


def test_indicator_csv(spark, tmp_path):
    p = tmp_path / "ind.csv"
    p.write_bytes(FX4_CSV.encode("latin-1"))
    wide = readers.read_indicator_file(spark, str(p))
    specs = readers.spec_tables(spark)["indicator_specs"]
    got = {(r.indicator_code, r.insee_code, r.year): r.value
           for r in IN.extract_values(wide, specs, "ordinal").collect()}
    assert got[("unemployment_rate", "75000", 2007)] == 8.3 and len(got) == 7
    aligned = IN.collect_indicator_values(spark, wide, "ordinal")
    assert aligned.count() == 10


def test_dashboard_and_export_sinks(spark, tmp_path):
    from tallyframe.sources.sinks import export_clean, write_dashboard_tables

    df = spark.createDataFrame([("92", 2017, 1.0), ("75", 2012, None), ("75", 2007, 3.0)],
                               "dept_code string, year int, value double")
    [p] = write_dashboard_tables({"trend": df}, str(tmp_path / "dash"), sort_by={"trend": ["dept_code", "year"]})
    back = spark.read.parquet(p).collect()
    assert [(r.dept_code, r.year) for r in back] == [("75", 2007), ("75", 2012), ("92", 2017)]
    export_clean(df, str(tmp_path / "csv"), partition_by=["dept_code"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def test_quoted_station_rows(spark, tmp_path):
    from test_election import STATION_TEXT

    lines = STATION_TEXT.split("\n")
    plain = tmp_path / "plain.txt"
    plain.write_bytes(STATION_TEXT.encode("latin-1"))
    quoted = [";".join(f'"{t}"' if i % 2 == 0 else t for i, t in enumerate(x.split(";"))) if x and k else x
              for k, x in enumerate(lines)]
    path = tmp_path / "quoted.txt"
    path.write_bytes("\n".join(quoted).encode("latin-1"))
    want = sorted(map(str, (r.asDict() for r in readers.read_station_file(spark, str(plain)).drop("ordinal").collect())))
    got = sorted(map(str, (r.asDict() for r in readers.read_station_file(spark, str(path)).drop("ordinal").collect())))
    assert got == want and len(got) > 0


def test_split_line_keeps_separators_inside_quotes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([('a;"b;c";"d ""e""";;',), ("x;y",), ("",)], "line string")
    got = [r[0] for r in df.select(readers.split_line(F.col("line"))).collect()]
    assert got == [["a", "b;c", 'd "e"', "", ""], ["x", "y"], [""]]


def test_blank_and_repeated_headers_are_no_candidates(spark, tmp_path):
    import pytest

    p = tmp_path / "2022.csv"
    p.write_text("Département;Participation;Exprimés;Blancs;Blancs;DUPONT;;MARTIN;DUPONT; \n"
                 "Paris;80;1000;1;2;60;5;40;7;9\n")
    with pytest.warns(UserWarning, match="occurs again"):
        sheets = readers.read_wide_results(spark, {2022: str(p)}, sep=";")
    got = {r.candidate_name: r.votes for r in EL.collect_results(spark, sheets).collect()}
    assert got == {"DUPONT": 600, "MARTIN": 400}


def test_ordinal_follows_files_and_lines(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    (d / "a.txt").write_text("\n".join(f"a{i}" for i in range(50)))
    (d / "b.txt").write_text("\n".join(f"b{i:05d}" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = [r.line for r in readers.read_lines(spark, str(d)).orderBy("ordinal").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert lines == [f"a{i}" for i in range(50)] + [f"b{i:05d}" for i in range(20000)]


def test_file_order_is_one_decimal(spark, tmp_path):
    """Several files (one with a space in its name), small splits: the ordinal is the order of rows in the files."""
    d = tmp_path / "in put"
    d.mkdir()
    want = []
    for name, n in (("b x.txt", 300), ("a.txt", 700), ("c.txt", 1)):
        (d / name).write_text("".join(f"{name}:{i:05}\n" for i in range(n)))
    for name, n in (("a.txt", 700), ("b x.txt", 300), ("c.txt", 1)):
        want += [f"{name}:{i:05}" for i in range(n)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        lines = readers.read_lines(spark, str(d))
        assert lines.schema["ordinal"].dataType.simpleString() == "decimal(38,0)"
        assert [r.line for r in lines.orderBy("ordinal").collect()] == want
        assert lines.select("ordinal").distinct().count() == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rollup_takes_the_first_row_of_a_unit_and_the_earliest_name(spark):
    from tallyframe.operators import aggregate as A

    rows = [("75", "c1", "b1", 5, 10, "late"), ("75", "c1", "b1", 9, 99, "dup"), ("75", "c2", "b1", 2, 7, "Paris"),
            ("77", None, "b1", 1, None, None), ("77", None, "b1", 3, 4, "x")]
    df = spark.createDataFrame(rows, "g string, c string, b string, at long, n long, name string")
    got = {r.g: (r.n, r.name) for r in A.rollup_headers(df, ["g", "c", "b"], "g", "at", ["n"], "name").collect()}
    assert got == {"75": (17, "Paris"), "77": (0, None)}
    assert {r.g: r.n for r in A.rollup_headers(df, ["g", "c", "b"], "g", "at", ["n"]).collect()} == {"75": 17, "77": 0}
