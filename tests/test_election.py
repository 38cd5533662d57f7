"""FX1, FX2, FX3, FX6: wide sheets, the ragged station file and duplicate collapse."""

from tallyframe.config import JobConfig
from tallyframe.plans import election as EL
from tallyframe.sources import readers


def rows(df, cols=("dept_code", "candidate_name")):
    return {tuple(r[c] for c in cols): r.asDict() for r in df.collect()}


def test_fx1_layout_a(spark):
    cols = ["Code du département", "Libellé du département", "Inscrits", "Votants", "Exprimés",
            "DUPONT_VOIX", "DUPONT_EXP", "LE_GALL_VOIX"]
    data = [("75", "Paris ", "1000", "800", "780", "400", "51,28", "380"),
            ("77.0", "Seine-et-Marne", "0", "50", "", "", "60", "10"),
            ("13", "Bouches-du-Rhône", "9", "9", "9", "9", "9", "9"),
            ("92", "Hauts-de-Seine", "200", "100", "90", "", "50", "")]
    sheet = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    ext = EL.extract_wide_sheet(spark, sheet, 2012)
    r = rows(ext)
    assert set(r) == {("75", "DUPONT"), ("75", "LE GALL"), ("77", "DUPONT"), ("92", "DUPONT")}
    assert r[("75", "DUPONT")]["vote_share"] == 0.5128 and r[("75", "LE GALL")]["vote_share"] == 0.487179
    assert r[("75", "DUPONT")]["turnout_rate"] == 0.8 and r[("75", "DUPONT")]["dept_name"] == "Paris"
    assert r[("77", "DUPONT")]["votes"] is None and r[("77", "DUPONT")]["turnout_rate"] is None
    assert r[("92", "DUPONT")]["votes"] == 45
    final = rows(EL.finalize_results(ext))
    assert final[("75", "DUPONT")]["vote_share"] == 0.512821
    assert final[("77", "DUPONT")]["vote_share"] == 0.6


def test_fx2_layout_b(spark):
    cols = ["Département", "Participation", "Exprimés", "Blancs", "Dupont", "Le Gall", "Unnamed: 6"]
    data = [("VAL D'OISE", "75,5 %", "10", "1", "25", "35,0", "3"),
            ("Essonne", "", "", "", "12,5", "n/a", "")]
    sheet = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    ext = EL.extract_wide_sheet(spark, sheet, 1974)
    r = rows(ext)
    assert set(r) == {("95", "DUPONT"), ("95", "LE GALL"), ("91", "DUPONT")}
    assert (r[("95", "DUPONT")]["votes"], r[("95", "LE GALL")]["votes"]) == (2, 4)
    assert r[("95", "DUPONT")]["turnout_rate"] == 0.755 and r[("91", "DUPONT")]["votes"] is None
    assert r[("95", "DUPONT")]["registered"] is None
    final = rows(EL.finalize_results(ext))
    assert final[("95", "DUPONT")]["vote_share"] == 0.2 and final[("95", "LE GALL")]["vote_share"] == 0.4
    assert final[("91", "DUPONT")]["vote_share"] == 0.125


STATION_TEXT = """Code du département;Libellé du département;Code de la commune;Code du b.vote;Inscrits;Votants;Exprimés;N°Panneau;Sexe;Nom;Prénom;Voix;% Voix/Ins;% Voix/Exp
75;Paris;056;0001;100;80;78;1;M;DUPONT;Jean;50;0;0;2;F;LE GALL;Anne;28;0;0
75;Paris;056;0001;100;80;78;1;M;DUPONT;Jean;5;0;0
75;Paris;056;0002;50;20;20;1;M;DUPONT;Jean;12;0;0;;F;LE GALL;Anne;8;0;0
77;;001;0001;10;5;5;1;M;DUPONT;Jean;5;0;0
13;Bouches-du-Rhône;001;0001;9;9;9;1;M;DUPONT;Jean;9;0;0
75;Paris;056
"""


def test_fx3_station_file(spark, tmp_path):
    path = tmp_path / "stations.txt"
    path.write_bytes(STATION_TEXT.encode("latin-1"))
    parsed = readers.read_station_file(spark, str(path))
    r = rows(EL.extract_station_rows(spark, parsed, 2017))
    assert set(r) == {("75", "DUPONT"), ("75", "LE GALL"), ("77", "DUPONT")}
    d = r[("75", "DUPONT")]
    assert (d["registered"], d["votes_cast"], d["votes_valid"], d["votes"]) == (150, 100, 98, 67)
    assert d["vote_share"] == 0.683673 and d["turnout_rate"] == 0.666667
    assert r[("75", "LE GALL")]["votes"] == 28 and r[("75", "LE GALL")]["vote_share"] == 0.285714
    assert r[("77", "DUPONT")]["dept_name"] == "Seine-et-Marne" and r[("77", "DUPONT")]["vote_share"] == 1.0
    dedup = rows(EL.extract_station_rows(spark, parsed, 2017, JobConfig(dedupe_measures=True)))
    assert dedup[("75", "DUPONT")]["votes"] == 62


def test_fx6_collapse(spark):
    from tallyframe import schema as SC

    data = [(2002, "75", "Paris", "A", 100, 80, 50, 10, 0.9, None),
            (2002, "75", "Paris", "A", None, 90, 50, None, 0.1, 0.8),
            (2002, "75", "Paris", "B", 100, 80, 50, None, 0.3, 0.8)]
    df = spark.createDataFrame(data, SC.RESULTS)
    r = {x.candidate_name: x for x in EL.finalize_results(df).collect()}
    a, b = r["A"], r["B"]
    assert (a.registered, a.votes_cast, a.votes_valid, a.votes, a.vote_share, a.turnout_rate) == (
        100, 90, 50, 10, 0.2, 0.8)
    assert b.votes is None and b.vote_share == 0.3


def test_empty_input_keeps_schema(spark):
    from tallyframe import schema as SC

    out = EL.collect_results(spark, {})
    assert out.schema == SC.RESULTS and out.isEmpty()
    f = EL.finalize_results(spark.createDataFrame([], SC.RESULTS))
    assert f.columns == SC.RESULTS.fieldNames() and f.isEmpty()


def test_q20t_zero_valid_and_mixed_years(spark):
    cols_b = ["Département", "Participation", "Exprimés", "Dupont"]
    sheet_b = spark.createDataFrame([("Paris", "50", "0", "40")], ", ".join(f"`{c}` string" for c in cols_b))
    cols_a = ["Code du département", "Inscrits", "Votants", "Exprimés", "DUPONT_VOIX", "DUPONT_EXP"]
    sheet_a = spark.createDataFrame([("75", "10", "5", "0", "", "40")], ", ".join(f"`{c}` string" for c in cols_a))
    b = EL.extract_wide_sheet(spark, sheet_b, 1974).collect()[0]
    a = EL.extract_wide_sheet(spark, sheet_a, 1981).collect()[0]
    assert b.votes == 0 and b.vote_share == 0.4      # layout B: valid 0 still derives votes
    assert a.votes is None and a.vote_share == 0.4   # layout A: valid 0 derives nothing
    assert a.dept_name == "Paris" and a.turnout_rate == 0.5
    both = EL.collect_results(spark, {1981: sheet_a, 1974: sheet_b}).orderBy("year").collect()
    assert [(r.year, r.dept_code, r.candidate_name) for r in both] == [(1974, "75", "DUPONT"), (1981, "75", "DUPONT")]
