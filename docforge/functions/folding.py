"""ASCII folding of lower-case Latin text, from the character names and decompositions of Unicode (TXT-3).

A small letter of any Latin block, with whatever marks, strokes, hooks or tails it has, folds to the one or two letters of its name
(``LATIN SMALL LETTER U WITH HORN AND ACUTE`` -> ``u``, ``LATIN SMALL LETTER AE`` -> ``ae``); full-width letters and digits,
ligatures and ordinal signs fold to their compatibility decomposition. Only letters and digits are folded, to letters
and digits, so the words of a text are the same before and after. Turned, reversed and small-capital letters, which are letters
of their own, stay.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = re.compile(r"LATIN SMALL (?:LETTER|LIGATURE) ([A-Z]{1,2}|[A-Z]+(?: [A-Z])?|MIDDLE-WELSH [A-Z]+)(?: WITH .+| PRECEDED BY APOSTROPHE)?")
# Letters whose names are not what they fold to.
NAMED = {"DOTLESS I": "i", "DOTLESS J": "j", "ENG": "n", "ETH": "d", "KRA": "q", "LONG S": "s", "MIDDLE-WELSH LL": "ll",
         "MIDDLE-WELSH V": "v", "OPEN E": "e", "SCHWA": "a", "SHARP S": "ss", "THORN": "th"}
# Letters named after a sound that they don't spell.
NOT_SPELT = {"OI", "ET", "IS", "UM"}
_FORMS = ("LATIN SMALL LIGATURE ", "LATIN SMALL LETTER ", "FULLWIDTH LATIN SMALL LETTER ", "FULLWIDTH DIGIT ", "FEMININE ORDINAL", "MASCULINE ORDINAL")


def _target(char: str) -> str | None:
    name = unicodedata.name(char, "")
    if not name.startswith(_FORMS) or unicodedata.category(char)[0] not in "LN":
        return None
    found = _NAME.fullmatch(name)
    if found:
        base = found[1]
        if base in NAMED:
            return NAMED[base]
        if len(base) <= 2 and base not in NOT_SPELT:
            return base.lower()
    plain = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)).lower()
    return plain if plain.isascii() and plain.isalnum() else None


def _table() -> dict[str, str]:
    blocks = (range(0x80, 0x2E80), range(0xA640, 0xAC00), range(0xFB00, 0x10000), range(0x10780, 0x107C0), range(0x1DF00, 0x1E000))
    pairs = ((chr(n), _target(chr(n))) for block in blocks for n in block)
    return {char: goal for char, goal in pairs if goal is not None}


TABLE = _table()
SINGLE = {c: t for c, t in TABLE.items() if len(t) == 1}
#: Letters that become two or three, those of living orthographies first.
COMMON = {c: TABLE[c] for c in "ßæœþ"}
RARE = {c: t for c, t in TABLE.items() if len(t) > 1 and c not in COMMON}
FROM, TO = "".join(SINGLE), "".join(SINGLE.values())


def _ranges(chars: str, gap: int = 64) -> str:
    """A character class of few ranges that holds ``chars`` (and some between them)."""
    codes = sorted(map(ord, chars))
    runs = [[codes[0], codes[0]]]
    for code in codes[1:]:
        if code - runs[-1][1] <= gap:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in runs) + "]"


RARE_CLASS = _ranges("".join(RARE))


def fold(col: Column) -> Column:
    """ASCII folding of lower-case text (``kovács`` -> ``kovacs``). ASCII texts are returned as they are, and the letters that become
    several are replaced one by one only in texts that may hold one."""
    out = F.translate(col, FROM, TO)
    for source, goal in COMMON.items():
        out = F.replace(out, F.lit(source), F.lit(goal))
    rare = out
    for source, goal in RARE.items():
        rare = F.replace(rare, F.lit(source), F.lit(goal))
    return F.when(F.octet_length(col) == F.length(col), col).when(col.rlike(RARE_CLASS), rare).otherwise(out)


def fold_sql(expr: str) -> str:
    """The same folding as SQL text (used by the DuckDB oracle)."""
    out = f"translate({expr}, '{FROM}', '{TO}')"
    for source, goal in (COMMON | RARE).items():
        out = f"replace({out}, '{source}', '{goal}')"
    return out
