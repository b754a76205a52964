"""German stemmer (the published Snowball algorithm) as plain SQL expressions.

Stated like the English one: a list of stages, each one SQL expression over the stage before, rendered for Spark
and DuckDB. A region test becomes a test of what stands before the suffix: the suffix lies in R1 if a
non-vowel follows a vowel there and at least three letters do, in R2 if that happens twice. Suffixes are only cut off,
so the test on the shortened word gives the same answer as positions found at the start.
"""

from __future__ import annotations

from docforge.functions.porter import Dialect

# Vowels, valid endings before -s and -st, suffixes by step.
VOWELS = "aeiouyäöü"
S_ENDING, ST_ENDING = "bdfghklmnrt", "bdfghklmnt"
STEP1 = ("ern", "em", "er", "en", "es", "e", "s")
STEP2 = ("est", "en", "er", "st")
STEP3 = ("isch", "lich", "heit", "keit", "end", "ung", "ig", "ik")

_PAIR = f"[{VOWELS}][^{VOWELS}]"


def _in_r1(d: Dialect, head: str) -> str:
    return f"(length({head}) >= 3 AND {d.rx(head, _PAIR)})"


def _in_r2(d: Dialect, head: str) -> str:
    return d.rx(head, f"{_PAIR}.*{_PAIR}")


def _pick(d: Dialect, w: str, suffixes: tuple[str, ...]) -> str:
    """Number of the longest suffix the word ends in (suffixes are listed longest first), 0 for none."""
    return "CASE " + " ".join(f"WHEN {d.ends(w, s)} THEN {n}" for n, s in enumerate(suffixes, 1)) + " ELSE 0 END"


def _head(w: str, suffix: str) -> str:
    return f"left({w}, length({w}) - {len(suffix)})"


def _cut(w: str, k: str, suffixes: tuple[str, ...], condition) -> str:
    """The word without the picked suffix where its condition holds."""
    return "CASE " + " ".join(f"WHEN {k} = {n} AND {condition(s, _head(w, s))} THEN {_head(w, s)}"
                              for n, s in enumerate(suffixes, 1)) + f" ELSE {w} END"


def stages(d: Dialect, w: str = "w", flag: str = "f", k: str = "k") -> list[dict[str, str]]:
    between = f"([{VOWELS}])%s([{VOWELS}])"
    one, two = ("$1", "$2") if d.regex_fn == "regexp_like" else ("\\1", "\\2")
    every = "" if d.regex_fn == "regexp_like" else ", 'g'"
    out: list[dict[str, str]] = [{w: f"replace({w}, 'ß', 'ss')"}]
    for _ in range(2):  # neighbours share a vowel, so one pass may leave every second one
        for letter in "uy":
            out.append({w: f"regexp_replace({w}, '{between % letter}', '{one}{letter.upper()}{two}'{every})"})
    # step 1
    out.append({k: _pick(d, w, STEP1)})
    out.append({w: _cut(w, k, STEP1, lambda s, head: _in_r1(d, head) + (f" AND {d.rx(head, f'[{S_ENDING}]$')}" if s == "s" else "")),
                flag: f"{k} IN (4, 5, 6)"})
    # after -en, -es or -e went, -niss loses its last letter; "nisse" can't keep the -e, as R1 begins before it
    out.append({w: f"CASE WHEN {flag} AND {d.ends(w, 'niss')} THEN {_head(w, 's')} ELSE {w} END"})
    # step 2
    out.append({k: _pick(d, w, STEP2)})
    out.append({w: _cut(w, k, STEP2, lambda s, head: _in_r1(d, head) + (
        f" AND {d.rx(head, f'...[{ST_ENDING}]$')}" if s == "st" else ""))})
    # step 3
    out.append({k: _pick(d, w, STEP3)})

    def derived(s: str, head: str) -> str:
        return _in_r2(d, head) + (f" AND NOT {d.ends(head, 'e')}" if s in ("ig", "ik", "isch") else "")

    out.append({w: _cut(w, k, STEP3, derived), flag: "CASE " + " ".join(
        f"WHEN {k} = {n} THEN {derived(s, _head(w, s))}" for n, s in enumerate(STEP3, 1)) + " ELSE false END"})
    number = {s: n for n, s in enumerate(STEP3, 1)}
    ig, er, lich = _head(w, "ig"), _head(w, "er"), _head(w, "lich")
    out.append({w: (f"CASE WHEN NOT {flag} THEN {w} "
                    f"WHEN {k} IN ({number['end']}, {number['ung']}) AND {d.ends(w, 'ig')} AND {_in_r2(d, ig)} AND NOT {d.ends(ig, 'e')} THEN {ig} "
                    f"WHEN {k} IN ({number['lich']}, {number['heit']}) AND ({d.ends(w, 'er')} OR {d.ends(w, 'en')}) AND {_in_r1(d, er)} THEN {er} "
                    f"WHEN {k} = {number['keit']} AND {d.ends(w, 'lich')} AND {_in_r2(d, lich)} THEN {lich} "
                    f"WHEN {k} = {number['keit']} AND {d.ends(w, 'ig')} AND {_in_r2(d, ig)} THEN {ig} ELSE {w} END")})
    out.append({w: f"translate({w}, 'UYäöü', 'uyaou')"})
    return out
