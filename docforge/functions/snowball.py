"""Compiler of suffix rules in the manner of the published Snowball algorithms.

A stemmer is data: patterns that mark the regions, and steps of rules. :func:`compile_steps` turns them into the list of
small SQL stages that :func:`docforge.functions.text.stem_column` runs and the DuckDB twin repeats.

A step looks for the longest of its suffixes (in the whole word, or only within a region) and does what the first rule says that
lists this suffix and whose condition holds; if none does, shorter suffixes are not tried. A region is kept as the number of
letters before it, so a suffix lies in it if that many letters are left. A step becomes three stages: the suffix found,
the number of the rule, the new word.

Columns of a stage: ``w`` word, ``k`` suffix found, ``f`` label of the rule that the last step applied (0: none), ``g``
whether an ending went, ``p0`` to ``p2`` letters before RV, R1 and R2.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from docforge.functions.porter import Dialect

STATE = ("p0", "p1", "p2", "g")
_REGION = {"RV": "p0", "R1": "p1", "R2": "p2"}


@dataclass(frozen=True)
class Rule:
    suffixes: str  # separated by blanks
    to: str = ""  # what the suffix becomes
    region: str | None = None  # the suffix has to lie in it
    before: str | None = None  # pattern of what stands before the suffix (within ``before_in``)
    before_in: str | None = None
    label: int = 1


@dataclass(frozen=True)
class Step:
    """``rules`` by the label that the step before has to have left (None: any word)."""

    rules: dict[int | None, tuple[Rule, ...]]
    within: str | None = None  # suffixes are looked for in this region only
    until_done: bool = False  # runs only where no ending went so far
    done: frozenset[int] = field(default_factory=frozenset)  # labels that count as an ending gone


def regions(**patterns: str) -> list[dict[str, str]]:
    """Stage that measures the regions: each pattern is what stands before its region; none if it doesn't match."""
    out = {}
    for name, pattern in patterns.items():
        found = f"regexp_extract({{w}}, '^({pattern})', 1)"
        out[_REGION[name]] = f"CASE WHEN {found} = '' THEN length({{w}}) ELSE length({found}) END"
    return [out]


def _in(names: dict[str, str], word: str, region: str) -> str:
    return f"substr({word}, {names[_REGION[region]]} + 1)"


def _list(words: str) -> str:
    return "(" + ", ".join(f"'{s}'" for s in words.split()) + ")"


def compile_step(d: Dialect, step: Step, names: dict[str, str]) -> list[dict[str, str]]:
    w, k, f, g = names["w"], names["k"], names["f"], names["g"]
    rest = f"left({w}, length({w}) - length({k}))"
    text = w if step.within is None else _in(names, w, step.within)

    def holds(after: int | None) -> str:
        tests = ([f"NOT {g}"] if step.until_done else []) + ([] if after is None else [f"{f} = {after}"])
        return " AND ".join(tests) or "true"

    looked, chosen, written, labels = [], [], [], []
    for after, rules in step.rules.items():
        suffixes = "|".join(dict.fromkeys(s for r in rules for s in r.suffixes.split()))
        looked.append(f"WHEN {holds(after)} THEN regexp_extract({text}, '({suffixes})$', 1)")
        for rule in rules:
            tests = ([] if after is None else [f"{f} = {after}"]) + [f"{k} IN {_list(rule.suffixes)}"]
            if rule.region is not None:
                tests.append(f"length({w}) - length({k}) >= {names[_REGION[rule.region]]}")
            if rule.before is not None:
                tests.append(d.rx(rest if rule.before_in is None else _in(names, rest, rule.before_in), f"{rule.before}$"))
            number = len(written) + 1
            chosen.append(f"WHEN {' AND '.join(tests)} THEN {number}")
            written.append((number, rule.to))
            labels.append((number, rule.label))
    goals: dict[str, list[int]] = {}
    for number, to in written:
        goals.setdefault(to, []).append(number)
    word = " ".join(f"WHEN {f} IN ({', '.join(map(str, ns))}) THEN {rest}" + (f" || '{to}'" if to else "") for to, ns in goals.items())
    marks: dict[int, list[int]] = {}
    for number, label in labels:
        marks.setdefault(label, []).append(number)
    mark = " ".join(f"WHEN {f} IN ({', '.join(map(str, ns))}) THEN {label}" for label, ns in marks.items())
    ends = [str(n) for n, label in labels if label in step.done]
    last = {w: f"CASE {word} ELSE {w} END", f: f"CASE {mark} ELSE 0 END"}
    if ends:
        last[g] = f"{g} OR {f} IN ({', '.join(ends)})"
    return [{k: f"CASE {' '.join(looked)} ELSE '' END"}, {f: f"CASE {' '.join(chosen)} ELSE 0 END"}, last]


def compile_steps(d: Dialect, program: list, names: dict[str, str]) -> list[dict[str, str]]:
    """Stages of a program: steps, and dictionaries of plain SQL over ``{w}``, ``{g}`` and the like."""
    out: list[dict[str, str]] = [{names["g"]: "false"}]
    for part in program:
        if isinstance(part, Step):
            out += compile_step(d, part, names)
        else:
            out.append({names[c]: sql.format(**names) for c, sql in part.items()})
    return out


def replaced(d: Dialect, pattern: str, to: str, column: str = "w") -> dict[str, str]:
    """All matches of a pattern replaced; ``to`` names groups as #1, #2."""
    mark, every = ("$", "") if d.regex_fn == "regexp_like" else ("\\", ", 'g'")
    return {column: f"regexp_replace({{w}}, '{pattern}', '{to.replace('#', mark)}'{every})"}
