"""French stemmer: the rules of the published Snowball algorithm, compiled by :mod:`docforge.functions.snowball`.

Letters that stand as consonants are written in upper case first (u and i between vowels, y beside one, u after q), and ë and ï as
He and Hi. RV begins after the third letter if the word begins with two vowels (or with one of three exceptions), else after
the first vowel behind the first letter; R1 after the first consonant that follows a vowel, R2 after the next such.
"""

from __future__ import annotations

from docforge.functions import snowball
from docforge.functions.porter import Dialect
from docforge.functions.snowball import Rule, Step

STATE = snowball.STATE
#: Of four stages the largest generated method has 8.8 KB, of two 5.0 KB.
CODEGEN_STAGES = 2

# Vowels, beginnings that define RV, and the endings of each step.
VOWELS = "aeiouyâàëéêèïîôûù"
BEGINNINGS = "par|col|tap"
PLAIN = "ance iqUe isme able iste eux ances iqUes ismes ables istes"
AGENT = "atrice ateur ation atrices ateurs ations"
I_VERBS = ("îmes ît îtes i ie ies ir ira irai iraIent irais irait iras irent irez iriez irions irons iront is issaIent issais issait issant "
           "issante issantes issants isse issent isses issez issiez issions issons it")
E_VERBS = "é ée ées és èrent er era erai eraIent erais erait eras erez eriez erions erons eront ez iez Iez"
A_VERBS = "âmes ât âtes a ai aIent ais ait ant ante antes ants as asse assent asses assiez assions"
DOUBLED = "enn onn ett ell eill"

_V, _C = f"[{VOWELS}]", f"[^{VOWELS}]"

STANDARD = Step({None: (
    Rule(PLAIN, "", "R2"), Rule(AGENT, "", "R2", label=2), Rule("logie logies", "log", "R2"), Rule("usion ution usions utions", "u", "R2"),
    Rule("ence ences", "ent", "R2"), Rule("ement ements", "", "RV", label=3), Rule("ité ités", "", "R2", label=4),
    Rule("if ive ifs ives", "", "R2", label=5), Rule("eaux", "eau"), Rule("aux", "al", "R1"), Rule("euse euses", "", "R2"), Rule("euse euses", "eux", "R1"),
    Rule("issement issements", "", "R1", before=_C), Rule("amment", "ant", "RV", label=6), Rule("emment", "ent", "RV", label=6),
    Rule("ment ments", "", before=_V, before_in="RV", label=6),
)}, done=frozenset(range(1, 6)))  # verb endings are looked for after label 6

#: What may stand before a standard ending that went, by that ending's label; 7 and 8 lead to one more.
BEFORE = Step({
    2: (Rule("ic", "", "R2"), Rule("ic", "iqU")),
    3: (Rule("iv", "", "R2", label=7), Rule("eus", "", "R2"), Rule("eus", "eux", "R1"), Rule("abl iqU", "", "R2"), Rule("ièr Ièr", "i", "RV")),
    4: (Rule("abil", "", "R2"), Rule("abil", "abl"), Rule("ic", "", "R2"), Rule("ic", "iqU"), Rule("iv", "", "R2")),
    5: (Rule("at", "", "R2", label=8),),
})
BEFORE_THAT = Step({7: (Rule("at", "", "R2"),), 8: (Rule("ic", "", "R2"), Rule("ic", "iqU"))})
I_VERB = Step({None: (Rule(I_VERBS, "", before="[^HVOWELS]".replace("VOWELS", VOWELS), before_in="RV"),)}, within="RV", until_done=True, done=frozenset({1}))
VERB = Step({None: (Rule("ions", "", "R2"), Rule(E_VERBS), Rule(A_VERBS, label=2))}, within="RV", until_done=True, done=frozenset({1, 2}))
VERB_E = Step({2: (Rule("e"),)}, within="RV")
FINAL_S = Step({None: (Rule("s", before=r"(Hi|[^aiouès])"),)}, until_done=True)
RESIDUAL = Step({None: (Rule("ion", "", "R2", before="[st]", before_in="RV"), Rule("ier ière Ier Ière", "i"), Rule("e"))}, within="RV", until_done=True)


def stages(d: Dialect, **names: str) -> list[dict[str, str]]:
    def marked(letter: str, left: str, right: str) -> dict[str, str]:
        return snowball.replaced(d, f"({left}){letter}({right})", f"#1{letter.upper()}#2")

    last = "left({w}, length({w}) - 1)"
    program = [
        marked("u", "q", ""),
        marked("i", _V, f"u{_V}"), marked("u", _V, "y"), marked("i", _V, "y"),  # of two neighbours the first is marked
        marked("y", _V, ""), marked("y", "", _V),
        *([marked("u", _V, _V), marked("i", _V, _V)] * 2),  # neighbours share a vowel, so one pass may leave every second one
        {"w": "replace(replace({w}, 'ë', 'He'), 'ï', 'Hi')"},
        *snowball.regions(RV=f"{_V}{_V}.|{BEGINNINGS}|.{_C}*{_V}", R1=f"{_C}*{_V}+{_C}", R2=f"{_C}*{_V}+{_C}{_C}*{_V}+{_C}"),
        STANDARD, BEFORE, BEFORE_THAT, I_VERB, VERB, VERB_E,
        {"w": f"CASE WHEN NOT {{g}} THEN {{w}} WHEN right({{w}}, 1) = 'Y' THEN {last} || 'i' WHEN right({{w}}, 1) = 'ç' THEN {last} || 'c' ELSE {{w}} END"},
        FINAL_S, RESIDUAL,
        {"w": f"CASE WHEN {d.rx('{w}', '(' + DOUBLED.replace(' ', '|') + ')$')} THEN {last} ELSE {{w}} END"},
        snowball.replaced(d, f"[éè]({_C}+)$", "e#1"),
        {"w": "replace(replace(replace(translate({w}, 'IUY', 'iuy'), 'He', 'ë'), 'Hi', 'ï'), 'H', '')"},
    ]
    return snowball.compile_steps(d, program, names)
