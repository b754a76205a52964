"""Spanish stemmer (the published Snowball algorithm) as plain SQL expressions.

Built like the German one, with longer suffix lists: the suffix found is kept as text. Regions are tests of what stands before a suffix. RV begins after the third letter, the next
vowel or the next consonant, depending on the first two letters; a suffix lies in RV if the letters up to there stand before
it. R1 and R2 are as in German, without the least length.
"""

from __future__ import annotations

from docforge.functions.porter import Dialect

# Vowels, and the suffixes each step looks for.
VOWELS = "aeiouáéíóúü"
PRONOUNS = "me se sela selo selas selos la le lo las les los nos"
ACCENTED, BARE = "iéndo ándo ár ér ír", "iendo ando ar er ir"
PLAIN = ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas "
         "amiento amientos imiento imientos")
AGENT = "adora ador ación acion adoras adores aciones ante antes ancia ancias"
OTHER = "logía logías ución ucion uciones encia encias amente mente idad idades iva ivo ivas ivos"
Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos"
E_VERBS = "en es éis emos"
VERBS = ("arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá "
         "eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an "
         "aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis "
         "abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos")

_PAIR = f"[{VOWELS}][^{VOWELS}]"
_RV = f"^(.[^{VOWELS}]+[{VOWELS}]|[{VOWELS}][{VOWELS}]+[^{VOWELS}]|[^{VOWELS}][{VOWELS}].)"


def _found(text: str, suffixes: str) -> str:
    """The longest of the suffixes that the text ends in (of several the leftmost match is the longest), or ''."""
    return f"regexp_extract({text}, '({suffixes.replace(' ', '|')})$', 1)"


def _list(words: str) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words.split()) + ")"


def stages(d: Dialect, w: str = "w", flag: str = "f", k: str = "k") -> list[dict[str, str]]:
    rv = lambda word: f"CASE WHEN {d.rx(word, _RV)} THEN regexp_replace({word}, '{_RV}', '') ELSE '' END"
    r1 = lambda head: d.rx(head, _PAIR)
    r2 = lambda head: d.rx(head, f"{_PAIR}.*{_PAIR}")
    rest = f"left({w}, length({w}) - length({k}))"  # the word without the suffix found
    last = f"left({w}, length({w}) - 1)"
    out: list[dict[str, str]] = []
    # step 0: a pronoun after a gerund or infinitive in RV; the flag holds RV of what stands before it
    out.append({k: _found(w, PRONOUNS)})
    out.append({flag: f"CASE WHEN {k} = '' THEN '' ELSE {rv(rest)} END"})
    accented = _found(flag, ACCENTED)
    out.append({w: (f"CASE WHEN {accented} <> '' THEN left({rest}, length({rest}) - length({accented})) || translate({accented}, 'áéí', 'aei') "
                    f"WHEN {_found(flag, BARE)} <> '' OR ({d.ends(flag, 'yendo')} AND {d.ends(rest, 'uyendo')}) THEN {rest} ELSE {w} END")})
    # step 1: standard suffixes
    out.append({k: _found(w, f"{PLAIN} {AGENT} {OTHER}")})
    out.append({flag: f"{k} <> '' AND CASE WHEN {k} = 'amente' THEN {r1(rest)} ELSE {r2(rest)} END"})
    out.append({w: (f"CASE WHEN NOT {flag} THEN {w} WHEN {k} IN ('logía', 'logías') THEN {rest} || 'log' "
                    f"WHEN {k} IN ('ución', 'ucion', 'uciones') THEN {rest} || 'u' WHEN {k} IN ('encia', 'encias') THEN {rest} || 'ente' "
                    f"ELSE {rest} END")})
    # one more suffix before some of them (marked with + after -amente, where -at- may stand before -iv- too)
    out.append({k: (f"CASE WHEN NOT {flag} THEN '' WHEN {k} IN {_list(AGENT)} THEN {_found(w, 'ic')} "
                    f"WHEN {k} = 'amente' THEN '+' || {_found(w, 'iv os ic ad')} WHEN {k} = 'mente' THEN {_found(w, 'ante able ible')} "
                    f"WHEN {k} IN ('idad', 'idades') THEN {_found(w, 'abil ic iv')} "
                    f"WHEN {k} IN ('iva', 'ivo', 'ivas', 'ivos') THEN {_found(w, 'at')} ELSE '' END")})
    before = f"left({w}, length({w}) - length(replace({k}, '+', '')))"
    out.append({w: f"CASE WHEN {k} NOT IN ('', '+') AND {r2(before)} THEN {before} ELSE {w} END",
                k: f"CASE WHEN {k} = '+iv' AND {r2(before)} THEN 'at' ELSE '' END"})
    out.append({w: f"CASE WHEN {k} = 'at' AND {d.ends(w, 'at')} AND {r2(rest)} THEN {rest} ELSE {w} END"})
    # step 2a, where step 1 took nothing: verb endings that begin with y, after u
    out.append({k: f"CASE WHEN {flag} THEN '' ELSE {_found(rv(w), Y_VERBS)} END"})
    out.append({w: f"CASE WHEN {k} <> '' AND {d.ends(rest, 'u')} THEN {rest} ELSE {w} END",
                flag: f"{flag} OR ({k} <> '' AND {d.ends(rest, 'u')})"})
    # step 2b, where 2a took nothing either
    out.append({k: f"CASE WHEN {flag} THEN '' ELSE {_found(rv(w), f'{VERBS} {E_VERBS}')} END"})
    out.append({w: rest, flag: f"{k} IN {_list(E_VERBS)}"})
    out.append({w: f"CASE WHEN {flag} AND {d.ends(w, 'gu')} THEN {last} ELSE {w} END"})
    # step 3: what is left of an ending
    out.append({k: _found(rv(w), "os a o á í ó e é")})
    out.append({flag: f"{k} IN ('e', 'é') AND {d.ends(last, 'gu')} AND {d.rx(rv(w), 'u.$')}"})
    out.append({w: f"CASE WHEN {flag} THEN left({w}, length({w}) - 2) ELSE {rest} END"})
    out.append({w: f"translate({w}, 'áéíóú', 'aeiou')"})
    return out
