"""Word segmentation by the rules of Unicode's text segmentation annex (TXT-1), as one pattern per engine.

The classes are those of the annex, written with the properties that a regular expression engine knows; the transitions between them are
the pattern:

* letters and digits join freely; a letter joins the next letter through ``MID_LETTER`` (``can't``, ``e.g``), a digit the next digit
  through ``MID_NUMBER`` (``3,000``, ``3.14``); connectors (``_``) join whatever they touch, but are no word alone;
* combining marks and format characters belong to what they follow;
* an ideograph or Hiragana letter is a word of its own, a run of Katakana is one, and so is a run of Thai, Lao, Khmer or Burmese,
  which need a dictionary to go further;
* an emoji with its modifiers and joined parts is one word, and so is a flag.

Not covered: a Hebrew letter before a quotation mark, or between two double ones.

Every loop over a group is possessive, which this engine runs without recursion: a word may be as long as a text.
"""

from __future__ import annotations

# Word-break classes (characters with no property that says it).
LETTER_SIGNS = (r"\x{2C2}-\x{2C5}\x{2D2}-\x{2D7}\x{2DE}\x{2DF}\x{2E5}-\x{2EB}\x{2ED}\x{2EF}-\x{2FF}\x{55A}-\x{55C}\x{55E}\x{58A}\x{5F3}"
                r"\x{A708}-\x{A716}\x{A720}\x{A721}\x{A789}\x{A78A}\x{AB5B}")
MID_BOTH = r".'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
MID_LETTER = r":\x{B7}\x{387}\x{55F}\x{5F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}" + MID_BOTH
MID_NUMBER = r",;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}" + MID_BOTH
KATAKANA_SIGNS = r"\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}\x{30FC}\x{FF70}"
IDEOGRAPHS = (r"\x{3006}\x{3007}\x{3021}-\x{3029}\x{3038}-\x{303A}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}"
              r"\x{17000}-\x{18CFF}\x{1B170}-\x{1B2FB}\x{20000}-\x{3FFFD}")
EXTENDING = r"\p{M}\x{200C}\x{FF9E}\x{FF9F}\x{1F3FB}-\x{1F3FF}"
FORMATS = r"\x{AD}\x{61C}\x{180E}\x{200E}\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{206F}\x{FEFF}\x{FFF9}-\x{FFFB}\x{E0001}-\x{E007F}"
CONNECTORS = r"\p{Pc}\x{202F}"
UNSPACED = ("Thai", "Lao", "Myanmar", "Khmer", "Tai_Le", "New_Tai_Lue", "Tai_Tham", "Tai_Viet")
FLAG_LETTERS = r"\x{1F1E6}-\x{1F1FF}"
EMOJI = (r"\x{231A}\x{231B}\x{23E9}-\x{23EC}\x{23F0}\x{23F3}\x{25FD}\x{25FE}\x{2614}\x{2615}\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}"
         r"\x{26AA}\x{26AB}\x{26BD}\x{26BE}\x{26C4}\x{26C5}\x{26CE}\x{26D4}\x{26EA}\x{26F2}\x{26F3}\x{26F5}\x{26FA}\x{26FD}\x{2705}"
         r"\x{270A}\x{270B}\x{2728}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2795}-\x{2797}\x{27B0}\x{27BF}\x{2B1B}\x{2B1C}\x{2B50}"
         r"\x{2B55}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F201}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F236}\x{1F238}-\x{1F23A}"
         r"\x{1F250}\x{1F251}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F7E0}-\x{1F7EB}\x{1F7F0}\x{1F90C}-\x{1F9FF}\x{1FA70}-\x{1FAFF}")
# signs that are emoji only with the variation selector behind them
EMOJI_SIGNS = r"#*\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{21AA}\x{2300}-\x{23FF}\x{25A0}-\x{27BF}\x{2934}\x{2935}\x{2B00}-\x{2BFF}\x{3030}\x{303D}\x{3297}\x{3299}"


def _pattern(letter: str, number: str, katakana: str, single: str, unspaced: str, own: str, behind: str) -> str:
    """The transitions over the given classes. ``own`` is the possessive sign of an engine that backtracks, ``behind`` what must not
    precede a connector that begins a word."""
    extend = f"[{EXTENDING}{FORMATS}\\x{{200D}}]"
    join = f"[{EXTENDING}{FORMATS}]"
    letters = f"{letter}[{letter[1:-1]}{extend[1:-1]}]*{own}(?:[{MID_LETTER}]{extend}*{own}{letter}[{letter[1:-1]}{extend[1:-1]}]*{own})*{own}"
    numbers = f"{number}[{number[1:-1]}{extend[1:-1]}]*{own}(?:[{MID_NUMBER}]{extend}*{own}{number}[{number[1:-1]}{extend[1:-1]}]*{own})*{own}"
    core = f"(?:(?:{letters}|{numbers})+{own}" + (f"|{katakana}[{katakana[1:-1]}{extend[1:-1]}]*{own})" if katakana else ")")
    tie = f"[{CONNECTORS}][{CONNECTORS}{EXTENDING}{FORMATS}\\x{{200D}}]*{own}"
    word = f"(?:{behind}{tie})?{own}{core}(?:{tie}(?:{core})?{own})*{own}"
    face = f"(?:[{EMOJI}]|[{EMOJI_SIGNS}]\\x{{FE0F}}){join}*{own}"
    emoji = f"{face}(?:\\x{{200D}}{face})*{own}"
    return "|".join(p for p in (word, single and f"{single}{extend}*{own}", unspaced, f"[{FLAG_LETTERS}]{{2}}", emoji) if p)


_SCRIPTS = "".join(f"\\p{{Is{s}}}" for s in UNSPACED)
#: For Java's engine, which can take classes from each other.
# Before the rules, what they amount to for most characters: a run of a-z before a blank or comma, or a full stop and one of them, is a word, and no
# word begins with another ASCII sign than these.
SPARK_PATTERN = r"[a-z]++(?=\.?[ ,\n])|(?=[a-zA-Z0-9_#*]|[^\x00-\x7F])(?:" + _pattern(
    letter=(r"[a-z" + rf"[\p{{IsAlphabetic}}{LETTER_SIGNS}&&[^\p{{M}}\p{{IsIdeographic}}\p{{IsHiragana}}\p{{IsKatakana}}{KATAKANA_SIGNS}{_SCRIPTS}]]]"),
    number=r"[0-9\p{Nd}\x{66B}]", katakana=rf"[\p{{IsKatakana}}{KATAKANA_SIGNS}]", single=r"[\p{IsIdeographic}\p{IsHiragana}]",
    unspaced=rf"[{_SCRIPTS}&&[\p{{L}}\p{{M}}]]++", own="+", behind=rf"(?<![{CONNECTORS}])") + ")"

#: The same rules for a text of ASCII alone, where none of the other classes has a character; several times faster.
ASCII_PATTERN = (r"[a-z]++(?=\.?[ ,\n])|(?=[a-z0-9_])(?:(?<!_)_++)?+(?:[a-z]++(?:[.':][a-z]++)*+|[0-9]++(?:[.',;][0-9]++)*+)++"
                 r"(?:_++(?:[a-z]++(?:[.':][a-z]++)*+|[0-9]++(?:[.',;][0-9]++)*+)*+)*+")


def words_sql(text: str) -> str:
    """The words as a list, for an engine that can't take classes from each other: single letters and runs of other scripts are set
    apart by spaces first."""
    extend = f"[{EXTENDING}{FORMATS}\\x{{200D}}]"
    scripts = "".join(f"\\p{{{s}}}" for s in UNSPACED)
    apart = f"([{IDEOGRAPHS}\\p{{Hiragana}}]{extend}*|[\\p{{Katakana}}{KATAKANA_SIGNS}][\\p{{Katakana}}{KATAKANA_SIGNS}{extend[1:-1]}]*|[{scripts}]+)"
    pattern = _pattern(letter=rf"[a-z\p{{L}}\p{{Nl}}\x{{24B6}}-\x{{24E9}}{LETTER_SIGNS}{KATAKANA_SIGNS}]", number=r"[0-9\p{Nd}\x{66B}]",
                       katakana="", single="", unspaced="", own="", behind="")
    quoted = pattern.replace("'", "''")
    return f"regexp_extract_all(regexp_replace({text}, '{apart}', ' \\1 ', 'g'), '{quoted}')"
