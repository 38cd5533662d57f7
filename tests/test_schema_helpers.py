"""H1-H7 plan-time helpers and job parameters (no Spark job involved)."""

import warnings

import pytest

from tallyframe.config import JobConfig
from tallyframe.sources import schema as H


def test_resolve_column_first_match_and_warning():
    cols = ["Libellé du département", "Département", "Code du département"]
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert H.resolve_column(cols, {"departement", "libelledudepartement"}) == "Libellé du département"
        assert w  # Q14t: duplicate role match warns
    assert H.resolve_column(cols, {"inscrits"}) is None


def test_discover_pairs_case_insensitive_partner():
    cols = ["DUPONT_VOIX", "dupont_exp", "Le_Gall_voix", "X"]
    assert H.discover_pairs(cols) == [("DUPONT_VOIX", "dupont_exp"), ("Le_Gall_voix", None)]


def test_discover_measures_skips_metadata_and_unnamed():
    cols = ["Département", "Participation", "Exprimés", "Blancs", "Dupont", "Unnamed: 6", "Nuls"]
    assert H.discover_measures(cols) == ["Dupont"]


def test_discover_periods_numeric_order():
    assert H.discover_periods(["A2012", "codgeo", "A1999", "A20", "XA2000", "A2007"]) == ["A1999", "A2007", "A2012"]


def test_require_columns():
    H.require_columns(["Code du département", "Inscrits"], ["codedudepartement", "inscrits"])
    with pytest.raises(ValueError, match="votants"):
        H.require_columns(["Inscrits"], ["inscrits", "votants"])


def test_normalize_name():
    assert H.normalize_name("N°Panneau") == "npanneau" and H.normalize_name(None) == ""


def test_job_config_from_strings():
    cfg = JobConfig.from_strings(" 75, 92,,", "no")
    assert cfg.target_codes == ("75", "92") and cfg.align_to_election_years is False
    assert JobConfig.from_strings(align="TRUE").align_to_election_years is True


def test_job_config_rejects_unknown_text():
    import pytest

    with pytest.raises(ValueError):
        JobConfig.from_strings(align="maybe")
    with pytest.raises(ValueError):
        JobConfig.from_strings(codes=" , ")
