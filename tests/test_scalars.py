"""FX9: scalar cleaning expressions reproduce the reference's Python helpers."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import scalars as S


def run(spark, fn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_normalize_key(spark):
    vals = ["Val-d'Oise", " VAL D OISE ", "N°Panneau", "Exprimés", None, "ﬁn ½", "Ǆemal"]
    assert run(spark, S.normalize_key, vals) == ["valdoise", "valdoise", "npanneau", "exprimes", "", "fin12", "dzemal"]


def test_normalize_key_on_compatibility_characters(spark):
    vals = ["Élodie Ñúñez Grüße", "Œuvre & Æther", "ḾḺḉ №5 ™ ①", "Ångström ½ ¾", "ŉ ſ ǅ", "각나 한국 a", "\U0002F800x\U0002FA1D"]
    want = ["elodienunezgrue", "uvrether", "mlcno5tm1", "angstrom1234", "nsdz", "a", "x"]
    assert run(spark, S.normalize_key, vals) == want


def test_fold_covers_all_of_unicode(spark):
    """Every assigned character folds as NFKD without combining marks does, in Spark and in Python."""
    import sys

    from tallyframe.functions.fold import fold_accents, fold_text

    chars = [chr(c) for c in range(0x20, sys.maxunicode + 1, 1) if not 0xD800 <= c < 0xE000 and unicodedata.normalize("NFKD", chr(c)) != chr(c)]
    blocks = ["".join(chars[i:i + 40]) for i in range(0, len(chars), 40 * 7)] + ["각나힣가", "plain", "", "é…½™x…"]
    want = ["".join(c for c in unicodedata.normalize("NFKD", b) if not unicodedata.combining(c)) for b in blocks]
    assert [fold_text(b) for b in blocks] == want
    assert run(spark, fold_accents, blocks) == want


def test_fold_cost_of_one_special_character(spark):
    """A text with one multi-character fold costs about as much as one without."""
    import time

    from tallyframe.functions.fold import fold_accents

    def seconds(extra):
        df = spark.range(3000).select(F.concat(F.repeat(F.lit("some words of a long text "), 200), F.lit(extra)).alias("t"))
        best = 1e9
        for _ in range(3):
            t0 = time.perf_counter()
            df.select(F.sum(F.length(fold_accents(F.col("t"))))).collect()
            best = min(best, time.perf_counter() - t0)
        return best

    plain = seconds(".")
    assert seconds("…") < 4 * plain + 0.5  # 1,153 replacements a text made it ten times as dear


def test_normalize_area_code(spark):
    vals = ["75", "75.0", "1", "2a", "075", "75.9", "971", "ZA", "", "  ", None, "inf", "-"]
    assert run(spark, S.normalize_area_code, vals) == [
        "75", "75", "01", "2A", "75", "75", "971", "ZA", None, None, None, "INF", "-0"]


def test_parse_int(spark):
    vals = ["1 234,5", "1 235,5", "12 %", "2,5", "3,5", "n/a", "", "1d", "1.234.567", "1 000"]
    assert run(spark, S.parse_int_fr, vals) == [1234, 1236, 12, 2, 4, None, None, None, None, 1000]


def test_parse_float(spark):
    assert run(spark, S.parse_float_fr, ["8,1", "26 000", "N/A", " ", "nan", "-5e1"]) == [
        8.1, 26000.0, None, None, None, -50.0]


def test_parse_ratio(spark):
    assert run(spark, S.parse_ratio_fr, ["51,28 %", "25", "12,5", "0,25", "x"]) == [
        0.5128, 0.25, 0.125, 0.0025, None]


def test_canonical_label(spark):
    vals = ["LE_GALL_VOIX", "Hervé  Dupré_exp", "_VOIX", None, "Dupont", "straße_VOIX"]
    assert run(spark, S.canonical_label, vals) == ["LE GALL", "HERVE DUPRE", "", "", "DUPONT", "STRASSE"]


def test_header_and_data_labels_agree(spark):
    from tallyframe.sources.schema import canonical_header

    vals = ["LE_GALL_VOIX", "Hervé  Dupré_exp", "_VOIX", "Dupont", "straße_VOIX", "Ångström_½_Exp", " a\u00a0b "]
    assert run(spark, S.canonical_label, vals) == [canonical_header(v) for v in vals]


def test_ratio_is_exact_and_does_not_overflow(spark):
    import random
    from fractions import Fraction

    rng = random.Random(1)
    rows = [(rng.randrange(1, 10 ** e), rng.randrange(1, 10 ** e)) for e in (4, 9, 12, 15, 18) for _ in range(40)]
    rows = [(min(a, b), max(a, b)) for a, b in rows]
    out = spark.createDataFrame(rows, "n long, d long").select("n", "d", S.micro_ratio("n", "d").alias("m")).collect()
    assert all(r.m == int(Fraction(2 * r.n * 10 ** 6 + r.d, 2 * r.d)) for r in out)


def test_ratio_text_beyond_decimals(spark):
    got = run(spark, S.parse_ratio_fr, ["1e20", "1e22", "12345678901234567890123"])
    assert got == pytest.approx([1e18, 1e20, 1.2345678901234568e20])


def test_safe_ratio_and_storage(spark):
    df = spark.createDataFrame([(1, 3, 0.123455), (2, 0, 12.5), (None, 5, 0.1)], "n long, d long, s double")
    out = df.select(S.safe_ratio("n", "d").alias("r"), S.to_storage_share("s").alias("st")).collect()
    assert out[0].r == 0.333333 and out[1].r is None and out[2].r is None
    assert str(out[0].st) == "0.12346" and out[1].st is None


def test_backfill(spark):
    df = spark.createDataFrame([(None, 10, 0.25), (5, 10, None), (None, 0, 0.5), (None, None, None)],
                               "votes long, valid long, share double")
    s = df.select("*", S.backfill_share("votes", "valid", "share").alias("s2"))
    out = s.select(S.backfill_votes("votes", "valid", "s2").alias("v"), "s2").collect()
    assert [(r.v, r.s2) for r in out] == [(2, 0.25), (5, 0.5), (None, 0.5), (None, None)]


def test_geo_key_roundtrip(spark):
    out = run(spark, lambda c: S.geo_code(S.geo_key(c)), ["75", "2A"])
    assert out == ["75", "2A"]


@pytest.mark.parametrize("text", ["a b", " x　", "\x1fy\x1c"])
def test_unicode_strip(spark, text):
    assert run(spark, S.ustrip, [text]) == [text.strip()]


def test_short_and_long_paths_agree(spark):
    """Texts that are ASCII after one pass, and the same with a character that needs the long path."""
    import re
    import unicodedata

    def plain(text):
        return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))

    texts = ["Éa_b\tc 　 d e_voix\n", "x__y_EXP\r\n", "_exp", "VOIX", "a_voix_voix", "\x1c\u0085q ", "İıK Å_ exp", "É", "  ",
             "ab" * 3000 + "é", "Ĳ_VOIX", "１２３ ａｂ", "á̂b", "日本_exp", "voix_VOIX "]
    texts += [t + "’…½ß가" for t in texts] + [f"{t}…_Voix" for t in texts]
    keys = [re.sub(r"[^a-z0-9]+", "", plain(t).lower()) for t in texts]
    assert run(spark, S.normalize_key, texts) == keys
    labels = [" ".join(plain(re.sub(r"(?i)_(VOIX|EXP)(?=(\r\n|[\n\r\u0085  ])?\Z)", "", t).replace("_", " ")).split()).upper() for t in texts]
    assert run(spark, S.canonical_label, texts) == labels
