"""BPE encoding and decoding by a prefix-sharing trie of the distinct words.

A text is cut into words by the tokenizer's own pattern (here: array operations on the character classes, which
the pattern's runs amount to). Only words not met before are encoded: they are put into a trie, which is walked
depth first. A trie node is a prefix; its state is the last token of the prefix's encoding, and

    encoding(prefix) = encoding(prefix without its last token) + [last token]

so the encoding of a prefix is computed once for all words that share it. The last token of a prefix is the one
token ending there that the last token of the rest may precede: ``BpeModel.may_follow`` decides that from the
merge ranks alone. Ids of known words are kept in an open-addressing table of bounded size, one a worker.

Defined results: a null text encodes as the empty text (no ids). Special-token strings in a text become their id, as
the library does by default. Truncation and padding are not applied. Characters unknown to the library's own
Unicode version count as it counts them, since the character classes are taken from it.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
from tokenizers import Regex, normalizers, pre_tokenizers

from docforge.llm.common import KEPT, WordHash, gather

#: Words kept in a worker's table (about 40 bytes each); beyond it the table starts anew. Bounds memory only.
TABLE_WORDS = 1 << 20
#: Pairs of tokens kept with their verdict; beyond it the memory starts anew.
PAIR_MEMO = 1 << 19
#: A longer text is cut where a word is bound to begin, so that the arrays of one piece stay small.
PIECE_CHARS = 1 << 20

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point, as the tokenizers library's regular expressions see it."""
    chars = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    classes = np.full(0x110000, OTHER, np.uint8)
    for name, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        found = pre_tokenizers.Split(Regex(name), "removed", invert=True).pre_tokenize_str(chars)
        points = np.frombuffer("".join(x for x, _ in found).encode("utf-32-le"), np.uint32)
        classes[points] = value
    return classes


@lru_cache(maxsize=1)
def odd_lower() -> dict[str, str]:
    """Characters whose lower case is another one in the library's Unicode version than in Python's (of planes 0 and 1; no others have case)."""
    letters = [chr(c) for c in range(0x20000) if c != 10 and not 0xD800 <= c < 0xE000]
    lowered = normalizers.Lowercase().normalize_str("\n".join(letters)).split("\n")
    return {c: small for c, small in zip(letters, lowered) if c.lower() != small}


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 is itself, the rest follow 0x100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class BpeModel:
    """Vocabulary and merge ranks of a tokenizer file; encodes single words."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lowercase = "Lowercase" in json.dumps(spec["normalizer"])
        #: the word-end form keeps digits single and drops white space; the other keeps a space before a word
        self.drops_space = bool(self.suffix)
        strings = {i: s for s, i in model["vocab"].items()}
        self.size = max(max(strings), *self.special.values()) + 1
        self.raw: list[bytes] = [b""] * self.size
        self.symbols: list[str] = [""] * self.size  # one character a byte; a word's last byte is shifted by 256
        for i, s in strings.items():
            end = bool(self.suffix) and s.endswith(self.suffix)
            body = bytes(alphabet[c] for c in (s[: -len(self.suffix)] if end else s))
            self.raw[i] = body + b" " * end  # the library's own decode writes the suffix as text; only bytes matter here
            marks = "".join(map(chr, body))
            self.symbols[i] = marks[:-1] + chr(ord(marks[-1]) + 256) if end else marks
        for s, i in self.special.items():
            self.raw[i] = s.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(merges):
            x, y, t = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.rank[x, y] = r
            parts.setdefault(t, (x, y, r))
        # Edge history of a token: the pieces that touched its right (left) end while it was built, each with the
        # rank of the merge that swallowed it (infinite for the token itself).
        never = len(merges) + 1
        self.right: list[list[tuple[int, int]]] = [[]] * self.size
        self.left: list[list[tuple[int, int]]] = [[]] * self.size
        usable: dict[str, int] = {}
        made: set[int] = set()
        order = [i for i in strings if i not in parts] + sorted(parts, key=lambda i: parts[i][2])
        for t in order:
            if t not in parts:
                self.right[t] = self.left[t] = [(t, never)]
            else:
                x, y, r = parts[t]
                if not (x in made and y in made):
                    continue
                self.right[t] = [*self.right[y][:-1], (y, r), (t, never)]
                self.left[t] = [*self.left[x][:-1], (x, r), (t, never)]
                if self._crossed(x, y, r):
                    continue  # its own text never encodes to it, so no text does
            made.add(t)
            usable[self.symbols[t]] = t
        self.usable = usable
        self.longest = max(map(len, usable))
        self._memo: dict[int, bool] = {}

    def _crossed(self, x: int, y: int, until: int) -> bool:
        """Whether a merge of rank below ``until`` would join the end of ``x`` and the start of ``y``.

        Ranks grow along an edge history, so both histories are walked in rank order; at each moment the two
        pieces that touch are compared with the merges that would swallow them. Of equal ranks the left goes first.
        """
        rank, ends, starts = self.rank, self.right[x], self.left[y]
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = ends[i], starts[j]
            r = rank.get((a, b))
            if r is not None and r < until and r < a_until and r <= b_until:
                return True
            if a_until <= b_until:
                i += 1
                if i == len(ends):
                    return False
            else:
                j += 1
                if j == len(starts):
                    return False

    def may_follow(self, x: int, y: int) -> bool:
        key = x * self.size + y
        known = self._memo.get(key)
        if known is None:
            if len(self._memo) >= PAIR_MEMO:
                self._memo.clear()
            known = self._memo[key] = not self._crossed(x, y, 1 << 60)
        return known

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by a depth-first walk of the trie of all of them.

        The words are visited in sorted order, which is the depth-first order of their trie; ``last`` is the path
        from the root to the present node, so nodes shared with the word before are not computed again.
        """
        if self.suffix:
            marked = []
            for w in words:
                s = w.encode().decode("latin-1")
                marked.append(s[:-1] + chr(ord(s[-1]) + 256))
        else:
            marked = [w.encode().decode("latin-1") for w in words]
        order = sorted(range(len(words)), key=marked.__getitem__)
        usable, size, longest, may = self.usable, self.size, self.longest, self._memo
        out: list[list[int]] = [[]] * len(words)
        path: list[int] = [-1]  # last token at each depth
        lens: list[int] = [0]
        before = ""
        for k in order:
            word = marked[k]
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            del path[shared + 1 :], lens[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                for start in range(depth - 1, max(-1, depth - longest - 1), -1):  # just one fits, so the order is free
                    token = usable.get(word[start:depth])
                    if token is None:
                        continue
                    rest = path[start]
                    if rest < 0:
                        break
                    ok = may.get(rest * size + token)
                    if ok if ok is not None else self.may_follow(rest, token):
                        break
                path.append(token)
                lens.append(depth - start)
            ids, depth = [], len(word)
            while depth:
                ids.append(path[depth])
                depth -= lens[depth]
            ids.reverse()
            out[k] = ids
            before = word
        return out


class WordTable:
    """Open-addressing table from word hash to a slice of ids."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.bits = int(words).bit_length() + 1
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.zeros(1 << self.bits, np.int32)
        self.offset, self.length, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.length)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key's entry, or -1."""
        mask = (1 << self.bits) - 1
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        there = self.keys[slot]
        out = np.where(there == keys, self.at[slot], -1).astype(np.int64)
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            there = self.keys[slot[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.at[slot[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
        return out

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        """New, distinct keys with their ids."""
        first = len(self)
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        self.offset = np.concatenate([self.offset, len(self.pool) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.pool = np.concatenate([self.pool, np.fromiter((x for e in ids for x in e), np.int32, int(length.sum()))])
        mask = (1 << self.bits) - 1
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            free = open_[self.keys[slot[open_]] == 0]
            self.keys[slot[free]] = keys[free]  # of several that want a slot one stays
            won = free[self.keys[slot[free]] == keys[free]]
            self.at[slot[won]] = (first + won).astype(np.int32)
            lost = np.ones(len(keys), bool)
            lost[won] = False
            open_ = open_[lost[open_]]
            slot[open_] = (slot[open_] + 1) & mask


class Encoder:
    """Whole texts to ids and back; one a worker and tokenizer file."""

    def __init__(self, path: str) -> None:
        self.model = BpeModel(path)
        self.classes = char_classes()
        self.hash = WordHash(0x5EED, 0x110000)
        self.table = WordTable(TABLE_WORDS)
        self.special = re.compile("(" + "|".join(map(re.escape, self.model.special)) + ")") if self.model.special else None
        self.odd = tuple(odd_lower()) if self.model.lowercase else ()
        lens = np.fromiter(map(len, self.model.raw), np.int64, self.model.size)
        self.raw_length, self.raw_offset = lens, np.cumsum(lens) - lens
        self.raw = np.frombuffer(b"".join(self.model.raw), np.uint8)

    # -- words ------------------------------------------------------------------------------------------------

    def _normal(self, text: str) -> str:
        if not self.model.lowercase:
            return text
        if not text.isascii():
            # the library lower-cases each character by itself, so a final sigma is no special case
            text = unicodedata.normalize("NFC", text)
            if any(c in text for c in self.odd):  # at once for a text without wide characters
                other = odd_lower()
                return "".join(other.get(c) or c.lower() for c in text)
            text = text.replace("Σ", "σ")
        return text.lower()

    def _pieces(self, text: str) -> list[str]:
        """The text cut where a word is bound to begin, if it is long."""
        out, at = [], 0
        while len(text) - at > PIECE_CHARS:
            cut = _SAFE_CUT.search(text, at + PIECE_CHARS)
            if cut is None:
                break
            out.append(text[at : cut.start()])
            at = cut.start()
        out.append(text[at:])
        return out

    def _spans(self, points: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word. ``first`` marks the first character of each piece."""
        n = len(points)
        kind = self.classes[points]
        space = kind == SPACE
        begin = first.copy()
        begin[1:] |= kind[1:] != kind[:-1]
        if self.model.drops_space:
            begin |= kind == NUMBER
        else:
            # the last of several spaces stands alone or before a word
            begin[:-1] |= space[:-1] & ~space[1:] & ~first[1:]
            begin[1:] &= space[1:] | first[1:] | (points[:-1] != 32)
        quote = np.flatnonzero((points == 39) & begin)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~first[quote + 1]]
        if len(quote):
            one = points[quote + 1]
            third = np.minimum(quote + 2, n - 1)
            two = np.where((quote + 2 < n) & ~first[third], points[third], 0)
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((two == ord("l")) & (one == ord("l")))
            quote, size = quote[short | long], np.where(short, 1, 2)[short | long]
            begin[quote + 1] = False
            after = quote + 1 + size
            after = after[after < n]
            begin[after[kind[after] == LETTER]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], n)
        if self.model.drops_space:
            keep = ~space[start]
            start, end = start[keep], end[keep]
        return start, end

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and where each piece's ids begin (with the end)."""
        joined = "".join(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        begins = np.cumsum(sizes) - sizes
        if not joined:
            return np.zeros(0, np.int32), np.zeros(len(pieces) + 1, np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.zeros(len(points), bool)
        first[begins[sizes > 0]] = True
        start, end = self._spans(points, first)
        keys = self.hash.spans(points, start, end) | np.uint64(1)
        at = self.table.find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            if len(self.table) + len(new) > self.table.words:
                self.table.clear()
                if len(keys) > self.table.words:  # more words in one piece than the table holds
                    self.table = WordTable(2 * len(keys))
                missing = np.arange(len(keys))
                new, where = np.unique(keys, return_index=True)
            chosen = missing[where]
            words = [joined[s:e] for s, e in zip(start[chosen].tolist(), end[chosen].tolist())]
            self.table.add(new, self.model.encode_words(words))
            at[missing] = self.table.find(keys[missing])
        length = self.table.length[at]
        ids = self.table.pool[gather(self.table.offset[at], length)]
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
        return ids, before[np.searchsorted(start, np.append(begins, len(points)))]

    # -- texts ------------------------------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (int32), and the offsets at which each text's ids begin, with the end."""
        pieces: list[str] = []
        owner: list[int] = []
        special: dict[int, int] = {}  # piece -> id
        for k, text in enumerate(texts):
            if not text:
                continue
            parts = self.special.split(text) if any(s in text for s in self.model.special) else [text]
            for part in parts:
                if part in self.model.special and len(parts) > 1:
                    special[len(pieces)] = self.model.special[part]
                    pieces.append("")
                    owner.append(k)
                elif part:
                    cut = self._pieces(self._normal(part))
                    pieces += cut
                    owner += [k] * len(cut)
        ids, begins = self._encode_pieces(pieces)
        if special:
            where = np.fromiter(special, np.int64, len(special))
            ids = np.insert(ids, begins[where], np.fromiter(special.values(), np.int32, len(special)))
            added = np.zeros(len(pieces) + 1, np.int64)
            added[where + 1] = 1
            begins = begins + np.cumsum(added)
        counts = np.bincount(np.asarray(owner, np.int64), np.diff(begins), minlength=len(texts)) if owner else np.zeros(len(texts))
        return ids, np.concatenate([np.zeros(1, np.int64), np.cumsum(counts.astype(np.int64))])

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        length = self.raw_length[ids]
        return self.raw[gather(self.raw_offset[ids], length)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no UTF-8 become the replacement character, as the library does."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; its table of known words outlives a task."""
    return Encoder(path)


KEPT["encoder"] = encoder
