"""Hungarian stemmer: the rules of the published Snowball algorithm, compiled by :mod:`docforge.functions.snowball`.

R1 begins after the first consonant (a digraph counts as one) of a word that begins with a vowel, else after the first vowel.
"""

from __future__ import annotations

from docforge.functions import snowball
from docforge.functions.porter import Dialect
from docforge.functions.snowball import Rule, Step

STATE = snowball.STATE

# Vowels, digraphs, doubled consonants, and the endings of each step.
VOWELS = "aáeéiíoóöőuúüű"
DIGRAPHS = "dzs|cs|gy|ly|ny|sz|ty|zs"
DOUBLED = "bb|cc|ccs|dd|ff|gg|ggy|jj|kk|ll|lly|mm|nn|nny|pp|rr|ss|ssz|tt|tty|vv|zz|zzs"
CASES = ("ban ben ba be ra re nak nek val vel tól től ról ről ból ből hoz hez höz nál nél ig at et ot öt ért képp képpen kor ul ül vá vé "
         "onként enként anként ként en on an ön n t")
OWNED = "oké öké aké eké ké éi é"
SING_OWNER = "ünk unk nk juk jük uk ük em om am m od ed ad öd d ja je a e o"
PLUR_OWNER = ("jaim jeim aim eim im jaid jeid aid eid id jai jei ai ei i jaink jeink eink aink ink jaitok jeitek aitok eitek itek "
              "jeik jaik aik eik ik")
PLURAL = "ök ok ek ak k"

#: A long vowel before an ending is the lengthened last letter of the word.
_LENGTHENED = Step({1: (Rule("á", "a", "R1"), Rule("é", "e", "R1"))})
#: A consonant doubled by an ending is single without it: the letter before the last goes.
_SINGLE = {"w": "CASE WHEN {f} = 1 THEN left({w}, length({w}) - 2) || right({w}, 1) ELSE {w} END"}


def _step(gone: str, to_a: str, to_e: str) -> Step:
    return Step({None: (Rule(gone, "", "R1"), Rule(to_a, "a", "R1"), Rule(to_e, "e", "R1"))})


def _doubling(endings: str) -> Step:
    return Step({None: (Rule(endings, "", "R1", before=f"({DOUBLED})"),)})


PROGRAM = [
    *snowball.regions(R1=f"[{VOWELS}]+({DIGRAPHS}|[^{VOWELS}])|[^{VOWELS}]+[{VOWELS}]"),
    _doubling("al el"), _SINGLE,
    Step({None: (Rule(CASES, "", "R1"),)}), _LENGTHENED,
    Step({None: (Rule("én", "e", "R1"), Rule("án ánként", "a", "R1"))}),
    _step("astul estül stul stül", "ástul", "éstül"),
    _doubling("á é"), _SINGLE,
    _step(OWNED, "áké áéi", "éké ééi éé"),
    _step(SING_OWNER, "ánk ájuk ám ád á", "énk éjük ém éd é"),
    _step(PLUR_OWNER, "áim áid ái áink áitok áik", "éim éid éi éink éitek éik"),
    _step(PLURAL, "ák", "ék"),
]


def stages(d: Dialect, **names: str) -> list[dict[str, str]]:
    return snowball.compile_steps(d, PROGRAM, names)
