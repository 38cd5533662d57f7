"""Domain configuration of the election/indicator use case.

Operators take tables and column names as parameters; the values below are the
election domain's configuration of them.  Everything in the FIXED VALUES block
must equal the public source conventions for right results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (public source conventions; keep in this natural order)
# ---------------------------------------------------------------------------

# Departments of the Ile-de-France region: code -> name.
DEPARTMENTS = {
    "75": "Paris",
    "77": "Seine-et-Marne",
    "78": "Yvelines",
    "91": "Essonne",
    "92": "Hauts-de-Seine",
    "93": "Seine-Saint-Denis",
    "94": "Val-de-Marne",
    "95": "Val-d'Oise",
}

# Extra spellings found in result sheets: alias -> code.
DEPARTMENT_ALIASES = {
    "SEINE ET MARNE": "77",
    "HAUTS DE SEINE": "92",
    "SEINE SAINT DENIS": "93",
    "VAL DE MARNE": "94",
    "VAL D OISE": "95",
    "VAL D'OISE": "95",
}

# First-round date of each presidential election.
ELECTION_DATE_BY_YEAR = {
    1969: "1969-06-01",
    1974: "1974-05-05",
    1981: "1981-04-26",
    1988: "1988-04-24",
    1995: "1995-04-23",
    2002: "2002-04-21",
    2007: "2007-04-22",
    2012: "2012-04-22",
    2017: "2017-04-23",
    2022: "2022-04-10",
}

ELECTION_TYPE = "presidentielle"
ELECTION_ROUND = 1
ELECTION_SCOPE = "departement"

INDICATOR_SOURCE_LABEL = "INSEE - Indicateurs territoriaux de developpement durable (ODD_DEP)"

# Indicator series: (indicator_code, indicator_name, unit, variable, sous_champ).
INDICATOR_SPECS = [
    ("unemployment_rate", "Taux de chomage BIT (15-64 ans)", "%", "taux_chom_bit", "total"),
    ("poverty_rate", "Taux de pauvrete", "%", "taux_pvt", "total"),
    ("median_standard_of_living", "Niveau de vie median", "EUR", "niveau_vie_median", None),
    ("no_diploma_rate_20_24", "Part des 20-24 ans sortis d'etudes sans diplome", "%",
     "part_20_24_sortis_nondip", None),
    ("social_housing_share", "Part des logements sociaux", "%", "part_pls", None),
]

TURNOUT_INDICATOR = ("turnout_rate", "Taux de participation", "%", "Resultats election data.gouv")
TURNOUT_SOURCE_FILE = "data.gouv - presidentielle premier tour"

# Normalized header names that are metadata, never candidates (share-only layout).
METADATA_COLUMNS = {
    "departement", "depnom", "depcode", "codedudepartement", "libelledudepartement",
    "participation", "inscrits", "ins", "abstentions", "votants", "blancs", "nuls",
    "exprimes", "exp", "etatsaisie", "deptcode", "deptname",
}

# Accepted normalized header names per column role.
ROLE_ALIASES = {
    "dept_code": {"depcode", "codedudepartement"},
    "dept_name": {"depnom", "departement", "libelledudepartement"},
    "registered": {"inscrits", "ins"},
    "votes_cast": {"votants"},
    "votes_valid": {"exprimes", "exp"},
    "participation": {"participation"},
}

# Station file: required normalized header names and the candidate group layout.
STATION_REQUIRED = [
    "codedudepartement", "libelledudepartement", "codedelacommune", "codedubvote",
    "inscrits", "votants", "exprimes", "npanneau",
]
STATION_GROUP_STRIDE = 7
STATION_PANEL_OFFSET = 0
STATION_NAME_OFFSET = 2
STATION_VOTES_OFFSET = 4

PERIOD_COLUMN_REGEX = r"A\d{4}"

# ---------------------------------------------------------------------------


def code_list(text: str) -> tuple[str, ...]:
    """'75, 92' -> ('75', '92'); an empty list is an error."""
    codes = tuple(code for code in map(str.strip, text.split(",")) if code)
    if not codes:
        raise ValueError(f"no area code in {text!r}")
    return codes


_SWITCH = {"on": True, "true": True, "yes": True, "1": True, "off": False, "false": False, "no": False, "0": False}


def switch(text: str) -> bool:
    """A yes/no word as a boolean; anything else is an error."""
    try:
        return _SWITCH[text.strip().lower()]
    except KeyError:
        raise ValueError(f"expected one of {sorted(_SWITCH)}, got {text!r}") from None


@dataclass(frozen=True)
class JobConfig:
    """Run parameters.  ``target_codes`` None keeps every area."""

    target_codes: tuple[str, ...] | None = tuple(DEPARTMENTS)
    align_to_election_years: bool = True
    target_years: tuple[int, ...] = tuple(sorted(ELECTION_DATE_BY_YEAR))
    dedupe_measures: bool = False

    def in_scope(self, code: Column) -> Column:
        return F.lit(True) if self.target_codes is None else code.isin(list(self.target_codes))

    @classmethod
    def from_strings(cls, codes: str | None = None, align: str | None = None) -> "JobConfig":
        """Parameters given as text (a command line, a scheduler); None keeps the default."""
        given = {}
        if codes is not None:
            given["target_codes"] = code_list(codes)
        if align is not None:
            given["align_to_election_years"] = switch(align)
        return cls(**given)
