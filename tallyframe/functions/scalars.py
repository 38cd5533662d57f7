"""Scalar cleaning expressions (F1-F20), all native Column expressions.

Every function takes and returns a ``Column``; none is a Python UDF, so they
stay inside whole-stage codegen and run where the data is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fold import fold_accents, is_ascii, let, one_pass

# Unicode whitespace exactly as Python's ``str.isspace`` (generated, not listed).
WHITESPACE = "".join(chr(cp) for cp in range(0x3100) if chr(cp).isspace())


def _ranges_class(chars: str) -> str:
    """Regex class with consecutive code points merged into ranges (few items to test per char)."""
    cps = sorted(ord(c) for c in chars)
    items, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [None]:
        if cp is not None and cp == prev + 1:
            prev = cp
            continue
        items.append(f"\\x{{{start:X}}}" + (f"-\\x{{{prev:X}}}" if prev > start else ""))
        if cp is not None:
            start = prev = cp
    return "[" + "".join(items) + "]"


UNICODE_SPACE_RUN = _ranges_class(WHITESPACE) + "+"

# A plain decimal number: what the localized parsers accept after cleaning.
NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c, dtype: str) -> Column:
    """Cast that yields null instead of failing (ANSI mode is on)."""
    return col_(c).try_cast(dtype)


def ustrip(c) -> Column:
    """Strip Unicode whitespace at both ends (Spark ``trim`` only removes U+0020)."""
    return F.btrim(col_(c), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    s = ustrip(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)


# F1 -------------------------------------------------------------------------
def normalize_key(c) -> Column:
    """null -> '', strip, NFKD, drop combining marks, lower, delete [^a-z0-9]+.

    (Stripping is implied: whitespace never folds to [a-z0-9] and is deleted.)
    """
    s = F.coalesce(col_(c).cast("string"), F.lit(""))

    def change(ch: str) -> str:
        return ch if not ch.isascii() else ch.lower() if ch.isalnum() else ""

    longer = F.regexp_replace(F.lower(fold_accents(s)), "[^a-z0-9]+", "")
    return let(one_pass(s, change), lambda short: F.when(is_ascii(short), short).otherwise(longer))


# F2 -------------------------------------------------------------------------
def _zfill2(s: Column) -> Column:
    return (F.when(s.rlike(r"^[+-]$"), F.concat(s, F.lit("0")))
            .when(F.length(s) < 2, F.lpad(s, 2, "0"))
            .otherwise(s))


def normalize_area_code(c) -> Column:
    """Blank -> null; numeric text -> truncated integer zero-padded to 2; else upper + pad."""
    t = ustrip(col_(c).cast("string"))
    as_int = try_cast(try_cast(t, "double"), "bigint").cast("string")
    return (F.when(t.isNull() | (t == ""), F.lit(None).cast("string"))
            .when(t.rlike(NUM) & as_int.isNotNull(), _zfill2(as_int))
            .otherwise(_zfill2(F.upper(t))))


# F3-F5 ----------------------------------------------------------------------
def _clean_number_text(c) -> Column:
    """Strip; drop no-break (U+00A0), narrow no-break (U+202F) and plain spaces; ',' -> '.'; drop '%'."""
    t = ustrip(col_(c).cast("string"))
    t = F.translate(t, "\u00a0\u202f ", "")
    return F.translate(t, ",%", ".")


def _number_text(c) -> Column:
    """Cleaned text if it is a plain decimal number, else '' (one pass, no repeated cleaning)."""
    return F.regexp_extract(_clean_number_text(c), NUM, 0)


def parse_float_fr(c) -> Column:
    """Localized float: drop (narrow) no-break spaces and spaces, ',' -> '.', drop '%'."""
    return try_cast(_number_text(c), "double")


def parse_int_fr(c) -> Column:
    """Localized integer, rounded half-to-even like Python ``round``."""
    return try_cast(F.bround(parse_float_fr(c), 0), "bigint")


def parse_ratio_fr(c) -> Column:
    """Percent text -> ratio: always divided by 100, rounded to 6 decimals (half-up).

    Exact in decimals; numbers that a decimal(38,18) can't hold (1e20 and more) go through doubles.
    """
    text = _number_text(c)
    exact = F.round(try_cast(text, "decimal(38,18)") / F.lit(100), 6).cast("double")
    return F.coalesce(exact, try_cast(text, "double") / F.lit(100.0))


# F6 -------------------------------------------------------------------------
def canonical_label(c) -> Column:
    """Strip trailing _VOIX/_EXP, '_' -> ' ', fold accents, collapse spaces, upper."""
    s = F.coalesce(col_(c).cast("string"), F.lit(""))
    # the suffix, with a line end behind it, lies in the last seven characters
    s = F.concat(F.left(s, F.greatest(F.length(s) - 7, F.lit(0))), F.regexp_replace(F.right(s, F.lit(7)), r"(?i)_(VOIX|EXP)$", ""))

    def change(ch: str) -> str:
        return " " if ch == "_" or ch in WHITESPACE else ch.upper() if ch.isascii() else ch

    def label(text: Column) -> Column:
        longer = F.upper(ustrip(F.regexp_replace(fold_accents(F.translate(text, "_", " ")), UNICODE_SPACE_RUN, " ")))

        def finish(short: Column) -> Column:
            one_space = F.when(F.contains(short, F.lit("  ")), F.regexp_replace(short, " {2,}", " ")).otherwise(short)
            return F.when(is_ascii(short), F.btrim(one_space)).otherwise(longer)

        return let(one_pass(text, change, also=WHITESPACE), finish)

    return let(s, label)


# F7/F8 ----------------------------------------------------------------------
def geo_key(c) -> Column:
    return F.concat(col_(c), F.lit("000"))


def geo_code(c) -> Column:
    return F.substring(col_(c), 1, 2)


def code2(c) -> Column:
    """Integer key -> 2-character area code."""
    return _zfill2(col_(c).cast("string"))


# F9 -------------------------------------------------------------------------
def micro_ratio(n, d) -> Column:
    """round(n/d, 6) * 1e6 for non-negative integer counts (half-up), null if d is 0 or either is null.

    Integer division of decimals, so exact for every bigint count.
    """
    n, d = col_(n).cast("decimal(20,0)"), col_(d).cast("decimal(20,0)")
    num = n * F.lit(2000000).cast("decimal(7,0)") + d
    return F.when(n.isNotNull() & d.isNotNull() & (d != 0),
                  F.call_function("div", num, d * F.lit(2).cast("decimal(1,0)")))


def safe_ratio(n, d) -> Column:
    """Guarded ratio rounded to 6 decimals: null unless both present and d != 0."""
    return micro_ratio(n, d) / F.lit(1000000.0)


def to_micro(c) -> Column:
    """6-decimal ratio (double) -> exact integer millionths."""
    return F.round(col_(c) * F.lit(1000000.0), 0).cast("bigint")


# F10/F11/F13 ----------------------------------------------------------------
def turnout(cast_n, registered, participation=None) -> Column:
    """Participation column wins when the role exists (even if its cell is null)."""
    if participation is not None:
        return parse_ratio_fr(participation)
    return safe_ratio(cast_n, registered)


def abstention(turnout_rate) -> Column:
    return F.lit(1.0) - col_(turnout_rate)


def to_pct(c) -> Column:
    return col_(c) * F.lit(100)


# F12 ------------------------------------------------------------------------
def backfill_share(votes, valid, share) -> Column:
    """share <- votes/valid when missing (valid truthy)."""
    v, d = col_(votes), col_(valid)
    return F.coalesce(col_(share), F.when(v.isNotNull() & (d != 0), safe_ratio(v, d)))


def backfill_votes(votes, valid, share) -> Column:
    """votes <- round_half_even(valid * share) when missing (valid truthy)."""
    d, s = col_(valid), col_(share)
    derived = F.when(s.isNotNull() & d.isNotNull() & (d != 0),
                     try_cast(F.bround(d * s, 0), "bigint"))
    return F.coalesce(col_(votes), derived)


# F14 ------------------------------------------------------------------------
def coalesce_name(name, looked_up, code) -> Column:
    return F.coalesce(blank_to_null(name), blank_to_null(looked_up), col_(code))


# F15 ------------------------------------------------------------------------
def lineage_label(label: str, variable, sous_champ) -> Column:
    v, s = col_(variable), col_(sous_champ)
    inner = F.when(s.isNull(), F.concat(F.lit("variable="), v)).otherwise(
        F.concat(F.lit("variable="), v, F.lit(",sous_champ="), s))
    return F.concat(F.lit(label + " ("), inner, F.lit(")"))


def aligned_from(source_file, source_year, target_year) -> Column:
    return F.when(col_(source_year) == col_(target_year), col_(source_file)).otherwise(
        F.concat(col_(source_file), F.lit(" [aligned_from="),
                 col_(source_year).cast("string"), F.lit("]")))


# F16/F17/F20 ----------------------------------------------------------------
def coerce_numeric(c) -> Column:
    return try_cast(col_(c), "double")


def nan_to_null(c) -> Column:
    return F.nanvl(col_(c).cast("double"), F.lit(None).cast("double"))


def to_storage_share(c) -> Column:
    """6-decimal frame share -> decimal(6,5) storage (half-up, null when out of range)."""
    return try_cast(col_(c), "decimal(6,5)")
