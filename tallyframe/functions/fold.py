"""Accent / compatibility folding as native Spark expressions.

Spark has no Unicode-normalize function, so the NFKD-then-drop-combining-marks
fold is generated by rule from ``unicodedata`` on the driver, over all of Unicode:

* characters whose fold is one character (or nothing) go into one ``translate``;
* Hangul syllables are taken apart by arithmetic, as Unicode defines them;
* the other characters whose fold is several characters (ligatures, fractions,
  squared units, ...) are looked up in a map literal.

A string that is ASCII after the first step needs no other.  Else it loses all characters of the first step at once,
and the distinct ones of what is left are looked at.  ``one_pass`` puts a further change of each
character (case, deletion) into the same step.  ``fold_text`` is the same fold for a Python string, from the same tables.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_HANGUL = range(0xAC00, 0xD7A4)
_LEADS = "".join(map(chr, range(0x1100, 0x1113)))
_VOWELS = "".join(map(chr, range(0x1161, 0x1176)))
_TAILS = "".join(map(chr, range(0x11A8, 0x11C3)))


def _fold_char(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


@functools.lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """(translate_from, translate_to, multi_char_map), without Hangul syllables."""
    one, none, multi = {}, [], {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp < 0xE000 or cp in _HANGUL:
            continue
        ch = chr(cp)
        folded = _fold_char(ch)
        if folded == "":
            none.append(ch)
        elif folded != ch:
            (one if len(folded) == 1 else multi)[ch] = folded
    # translate() deletes the characters of `from` that have no counterpart in `to`
    return "".join(one) + "".join(none), "".join(one.values()), multi


@functools.lru_cache(maxsize=1)
def _python_table() -> dict[int, str]:
    src, dst, multi = fold_tables()
    table = {ord(c): dst[i] if i < len(dst) else "" for i, c in enumerate(src)}
    return table | {ord(k): v for k, v in multi.items()} | {cp: _fold_char(chr(cp)) for cp in _HANGUL}


def fold_text(text: str) -> str:
    return text.translate(_python_table())


_PAIR, _KV = "\u0002", "\u0003"


@functools.lru_cache(maxsize=1)
def _mapping_text() -> str:
    """The multi-character fold map packed into one string (one literal, parsed once by str_to_map)."""
    return _PAIR.join(k + _KV + v for k, v in sorted(fold_tables()[2].items()))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value evaluated once (Spark would repeat a long expression in each branch)."""
    return F.transform(F.array(value), body)[0]


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def one_pass(c: Column, change: Callable[[str], str], also: str = "") -> Column:
    """The one-character folds and `change` of each result, in one ``translate``.

    `change` gives at most one character and keeps what is not ASCII; `also` are characters to change
    that don't fold.  The result is right where it is ASCII: characters that need more stay as they are.
    """
    src, dst, _ = fold_tables()
    table = {ch: change(ch) for ch in [*map(chr, range(1, 0x80)), *also]}
    table |= {ch: change(dst[i]) if i < len(dst) else "" for i, ch in enumerate(src) if ch not in table}
    kept = {k: v for k, v in table.items() if len(v) == 1 and v != k}
    gone = "".join(k for k, v in table.items() if v == "")
    return F.translate(c, "".join(kept) + gone, "".join(kept.values()))


def _syllable(ch: Column) -> Column:
    i = F.ascii(ch) - _HANGUL[0]
    tail = F.pmod(i, F.lit(28))
    return F.concat(F.substring(F.lit(_LEADS), (F.floor(i / 588) + 1).cast("int"), F.lit(1)),
                    F.substring(F.lit(_VOWELS), (F.floor(F.pmod(i, F.lit(588)) / 28) + 1).cast("int"), F.lit(1)),
                    F.when(tail > 0, F.substring(F.lit(_TAILS), tail.cast("int"), F.lit(1))).otherwise(F.lit("")))


def fold_accents(c: Column) -> Column:
    """NFKD + drop combining marks, as JVM expressions (no Python UDF).

    The rewriting looks at the characters of the given string: no fold brings forth a
    character that has to be folded again.
    """
    src, dst, multi = fold_tables()
    mapping = F.str_to_map(F.lit(_mapping_text()), F.lit(_PAIR), F.lit(_KV))
    keys = F.lit("".join(sorted(multi)))
    def syllable(ch):
        return (ch >= chr(_HANGUL[0])) & (ch <= chr(_HANGUL[-1]))

    ascii_chars = "".join(map(chr, range(1, 0x80)))

    def rest(ones):
        present = F.filter(F.array_distinct(F.split(F.translate(ones, ascii_chars, ""), "")),
                           lambda ch: (ch != "") & (syllable(ch) | (F.instr(keys, ch) > 0)))
        return F.aggregate(present, ones, lambda acc, ch: F.replace(
            acc, ch, F.when(syllable(ch), _syllable(ch)).otherwise(mapping[ch])))

    def folded(text):
        ones = F.when(is_ascii(text), text).otherwise(F.translate(text, src, dst))
        return let(ones, lambda x: F.when(is_ascii(x), x).otherwise(rest(x)))

    return let(c, folded)
