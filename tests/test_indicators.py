"""FX4, FX5: indicator extraction (series selection, keep-last) and backward as-of alignment."""

from tallyframe.plans import indicators as IN
from tallyframe.sources import readers

FX4 = [("75", "taux_chom_bit", "total", "8,1", None, "8,0", "6,5", 1),
       ("75", "taux_chom_bit", "hommes", "9", "9", "9", "9", 2),
       ("75", "niveau_vie_median", None, "25000", "26 000", None, "N/A", 3),
       ("77", "part_pls", None, None, " ", "16,5", "17", 4),
       ("75", "taux_chom_bit", "total ", "8,3", None, None, None, 5),
       ("13", "part_pls", None, "1", "1", "1", "1", 6)]
SCHEMA = ("codgeo string, variable string, sous_champ string, A2007 string, A2012 string, "
          "A2017 string, A2022 string, ordinal long")


def values(spark):
    specs = readers.spec_tables(spark)["indicator_specs"]
    return IN.extract_values(spark.createDataFrame(FX4, SCHEMA), specs, "ordinal")


def test_fx4_extract(spark):
    got = {(r.indicator_code, r.insee_code, r.year): r.value for r in values(spark).collect()}
    assert got == {
        ("unemployment_rate", "75000", 2007): 8.3, ("unemployment_rate", "75000", 2017): 8.0,
        ("unemployment_rate", "75000", 2022): 6.5, ("median_standard_of_living", "75000", 2007): 25000.0,
        ("median_standard_of_living", "75000", 2012): 26000.0, ("social_housing_share", "77000", 2017): 16.5,
        ("social_housing_share", "77000", 2022): 17.0}


def test_fx4_empty_specs(spark):
    specs = readers.spec_tables(spark)["indicator_specs"]
    rows = IN.scope_indicator_rows(spark.createDataFrame(FX4, SCHEMA))
    empty = {r.indicator_code for r in IN.empty_specs(IN.select_series(rows, specs), specs).collect()}
    assert empty == {"poverty_rate", "no_diploma_rate_20_24"}


def test_fx5_align(spark):
    a = IN.align_values(values(spark), [1969, 1974, 1981, 1988, 1995, 2002, 2007, 2012, 2017, 2022])
    got = {(r.indicator_code, r.insee_code, r.year): (r.value, r.source_file.endswith("]")
                                                      and r.source_file[-5:-1]) for r in a.collect()}
    assert len(got) == 10
    assert got[("unemployment_rate", "75000", 2012)] == (8.3, "2007")
    assert got[("unemployment_rate", "75000", 2017)] == (8.0, False)
    assert got[("median_standard_of_living", "75000", 2022)] == (26000.0, "2012")
    assert ("social_housing_share", "77000", 2012) not in got


def test_asof_never_looks_forward(spark):
    a = IN.align_values(values(spark), [2000, 2010, 2030]).collect()
    src = {(r.indicator_code, r.insee_code, r.year): r.value for r in values(spark).collect()}
    for r in a:
        prior = [y for (c, g, y) in src if c == r.indicator_code and g == r.insee_code and y <= r.year]
        assert prior and src[(r.indicator_code, r.insee_code, max(prior))] == r.value


def test_asof_align_one_form_for_any_list_and_span(spark):
    from tallyframe.operators import joins as J

    rows = [("a", t, float(t)) for t in (1991, 1992, 2003, 2004, 2030)] + [(None, 1995, 5.0), (None, 2010, 10.0), ("b", 2020, 2.0)]
    v = spark.createDataFrame(rows, "k string, year int, value double")
    targets = [1980, *range(1990, 2030), 2050]
    want = set()
    for k in ("a", None, "b"):
        for t in targets:
            past = [r for r in rows if r[0] == k and r[1] <= t]
            if past:
                best = max(past, key=lambda r: r[1])
                want.add((k, best[1], best[2], t))
    for span in (1, 3, 16, 1000):
        got = J.asof_align(v, ["k"], "year", targets, "t", span=span).collect()
        assert len(got) == len(want) and {(r.k, r.year, r.value, r.t) for r in got} == want
