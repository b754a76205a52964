"""English (Porter, 1980) stemmer as plain SQL expressions.

The algorithm is stated as a list of stages; every stage is one SQL ``CASE``
over the previous stage's column, so it runs as native expressions inside
whole-stage codegen (no Python UDF). The same stages are rendered for
DuckDB, which is how the oracle checks the Spark result.

Semantics follow the published algorithm with its two common revisions
(``bli -> ble``, ``logi -> log``). Measures use the classic regular
expressions over the consonant/vowel structure, with an initial ``y``
marked as ``Y`` (a consonant) and restored at the end. Within a step the
longest matching suffix is tried and the step stops at the first suffix
hit, even when its condition fails. Words shorter than three characters
are returned unchanged.
"""

from __future__ import annotations

# The consonant/vowel building blocks of the measure m.
_C = "[^aeiou][^aeiouy]*"  # consonant sequence
_V = "[aeiouy][aeiou]*"  # vowel sequence
_v = "[aeiouy]"
M_GT0 = f"^({_C})?{_V}{_C}"
M_EQ1 = f"^({_C})?{_V}{_C}({_V})?$"
M_GT1 = f"^({_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^({_C})?{_v}"
CVC_M1 = f"^{_C}{_v}[^aeiouwxy]$"  # m = 1 and ends consonant-vowel-consonant

# Step 1b double consonants that lose one letter (not l, s, z).
DOUBLE_END = "(" + "|".join(ch * 2 for ch in "bcdfghjkmnpqrtvwx0123456789") + ")$"

# Suffix rules of steps 2, 3 and 4 (suffix, replacement).
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
STEP3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]


class Dialect:
    def __init__(self, regex_fn: str, ends_fn: str):
        self.regex_fn = regex_fn
        self.ends_fn = ends_fn

    def rx(self, expr: str, pattern: str) -> str:
        return f"{self.regex_fn}({expr}, '{pattern}')"

    def ends(self, w: str, suffix: str) -> str:
        return f"{self.ends_fn}({w}, '{suffix}')"

    def at(self, array_sql: str, index: str) -> str:
        """1-based element of a literal array."""
        if self.regex_fn == "regexp_matches":
            return f"{array_sql.replace('array(', '[', 1)[:-1]}][{index}]"
        return f"element_at({array_sql}, {index})"


SPARK = Dialect("regexp_like", "endswith")
DUCKDB = Dialect("regexp_matches", "ends_with")


def _head(w: str, k: int) -> str:
    return f"left({w}, length({w}) - {k})"


def _rule_stages(d: Dialect, w: str, k: str, rules, measure: str, extra=None) -> list[dict[str, str]]:
    """Two small projections for one suffix step (keeps generated code small
    enough to be JIT-compiled): first the index of the longest matching
    suffix (0 = none), then the rewrite for that one suffix."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    pick = "CASE " + " ".join(f"WHEN {d.ends(w, sfx)} THEN {i + 1}" for i, (sfx, _) in enumerate(ordered)) + " ELSE 0 END"
    lens = "array(" + ", ".join(str(len(sfx)) for sfx, _ in ordered) + ")"
    repls = "array(" + ", ".join(f"'{r}'" for _, r in ordered) + ")"
    # greatest(k, 1): the index is only read when k > 0, but a hoisted common
    # subexpression must never see index 0
    stem = f"left({w}, length({w}) - {d.at(lens, f'greatest({k}, 1)')})"
    cond = d.rx(stem, measure)
    if extra is not None:
        cond = f"({extra(ordered, stem, k)}) AND {cond}"
    rewrite = f"CASE WHEN {k} = 0 THEN {w} WHEN {cond} THEN {stem} || {d.at(repls, f'greatest({k}, 1)')} ELSE {w} END"
    return [{k: pick}, {w: rewrite}]


def stages(d: Dialect, w: str = "w", flag: str = "f", k: str = "k") -> list[dict[str, str]]:
    """Ordered stages; each maps output column -> SQL over the previous stage.

    Column ``w`` is the word being stemmed; ``f`` is the step-1b flag and
    ``k`` the matched-suffix index of steps 2-4.
    """
    out: list[dict[str, str]] = []
    # mark an initial y as a consonant
    out.append({w: f"CASE WHEN left({w}, 1) = 'y' THEN 'Y' || substr({w}, 2) ELSE {w} END"})
    # step 1a
    out.append({w: (f"CASE WHEN {d.ends(w, 'sses')} THEN {_head(w, 2)} "
                    f"WHEN {d.ends(w, 'ies')} THEN {_head(w, 2)} "
                    f"WHEN {d.ends(w, 'ss')} THEN {w} "
                    f"WHEN {d.ends(w, 's')} THEN {_head(w, 1)} ELSE {w} END")})
    # step 1b: eed / ed / ing. First classify (k: 1 = eed with m > 0,
    # 2 = ed, 3 = ing, each with its condition met), then rewrite and set the
    # clean-up flag; two small projections instead of one large one.
    out.append({k: (f"CASE WHEN {d.ends(w, 'eed')} THEN CASE WHEN {d.rx(_head(w, 3), M_GT0)} THEN 1 ELSE 0 END "
                    f"WHEN {d.ends(w, 'ed')} THEN CASE WHEN {d.rx(_head(w, 2), HAS_VOWEL)} THEN 2 ELSE 0 END "
                    f"WHEN {d.ends(w, 'ing')} THEN CASE WHEN {d.rx(_head(w, 3), HAS_VOWEL)} THEN 3 ELSE 0 END "
                    f"ELSE 0 END")})
    out.append({w: (f"CASE WHEN {k} = 1 THEN {_head(w, 1)} WHEN {k} = 2 THEN {_head(w, 2)} "
                    f"WHEN {k} = 3 THEN {_head(w, 3)} ELSE {w} END"),
                flag: f"{k} >= 2"})
    out.append({w: (f"CASE WHEN NOT {flag} THEN {w} "
                    f"WHEN right({w}, 2) IN ('at', 'bl', 'iz') THEN {w} || 'e' "
                    f"WHEN {d.rx(w, DOUBLE_END)} THEN {_head(w, 1)} "
                    f"WHEN {d.rx(w, CVC_M1)} THEN {w} || 'e' ELSE {w} END")})
    # step 1c
    out.append({w: f"CASE WHEN {d.ends(w, 'y')} AND {d.rx(_head(w, 1), HAS_VOWEL)} THEN {_head(w, 1)} || 'i' ELSE {w} END"})
    # steps 2 and 3 (m > 0)
    out += _rule_stages(d, w, k, STEP2, M_GT0)
    out += _rule_stages(d, w, k, STEP3, M_GT0)
    # step 4 (m > 1); -ion only after s or t
    ion = [i + 1 for i, (sfx, _) in enumerate(sorted([(x, "") for x in STEP4], key=lambda r: -len(r[0])))
           if sfx == "ion"][0]

    def ion_rule(ordered, stem, kcol):
        return f"{kcol} <> {ion} OR {d.ends(w, 'sion')} OR {d.ends(w, 'tion')}"

    out += _rule_stages(d, w, k, [(x, "") for x in STEP4], M_GT1, extra=ion_rule)
    # step 5a, 5b
    head1 = _head(w, 1)
    out.append({w: (f"CASE WHEN {d.ends(w, 'e')} AND ({d.rx(head1, M_GT1)} OR "
                    f"({d.rx(head1, M_EQ1)} AND NOT {d.rx(head1, CVC_M1)})) THEN {head1} ELSE {w} END")})
    out.append({w: f"CASE WHEN {d.ends(w, 'll')} AND {d.rx(w, M_GT1)} THEN {head1} ELSE {w} END"})
    # restore the initial y
    out.append({w: f"CASE WHEN left({w}, 1) = 'Y' THEN 'y' || substr({w}, 2) ELSE {w} END"})
    return out


def state_names(module, prefix: str) -> dict[str, str]:
    """Columns that a stemmer's stages work on: the word first; those beyond three are the module's own ``STATE``."""
    own = getattr(module, "STATE", ())
    return {"w": f"{prefix}w", "f" if own else "flag": f"{prefix}f", "k": f"{prefix}k"} | {c: f"{prefix}{c}" for c in own}


def duckdb_stem_query(inner_sql: str, keep: list[str], token: str = "token", module=None, least: int = 3) -> str:
    """Wrap ``inner_sql`` (which has ``keep`` columns and ``token``) so that
    ``token`` comes out stemmed, by one nested SELECT per stage."""
    cols = ", ".join(keep)
    t0, names = "stem_t0", state_names(module, "stem_")
    w = names["w"]
    rest = ", ".join(f"0 AS {c}" for c in names.values() if c != w)
    sql = f"SELECT {cols}, {token} AS {t0}, {token} AS {w}, {rest} FROM ({inner_sql}) s0"
    for i, stage in enumerate((module.stages if module else stages)(DUCKDB, **names)):
        exprs = ", ".join(f"{stage.get(c, c)} AS {c}" for c in names.values())
        sql = f"SELECT {cols}, {t0}, {exprs} FROM ({sql}) s{i + 1}"
    return f"SELECT {cols}, CASE WHEN length({t0}) < {least} THEN {t0} ELSE {w} END AS {token} FROM ({sql}) sz"
