"""Language identification by error-correcting output codes.

Every language has a codeword; each bit of the code is a binary n-gram classifier, which tells the languages whose bit is
set from the others (log-likelihood ratio of hashed character trigrams). The margins of a text's bits are decoded with a
loss: the codeword with the least sum of weighted logistic losses wins, each bit weighted by how well it separates its
two sides. The score is the winner's share of exp(-loss); a small lead over the next codeword flags the text as ambiguous.

The trigram counts are sums over all labelled rows of the training side, combined in every task before they are shuffled. Every label
is learned: the two sides of each bit are summed over the languages in Spark, by bucket, so the driver gets
``BUCKETS`` * bits numbers and one codeword a language. Prediction is a narrow step. Every text counts as ``DOC_WEIGHT`` trigrams, so that no long document or group of long ones rules a language.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not ambiguous. Ties between
languages go to the first in alphabetical order. With one learned language every other text is that; with none all are
``und``. Labels without a trigram are not learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docforge.llm.bpe import LETTER, char_classes
from docforge.llm.common import small_batches, stored, text_batches, tidy

BUCKETS = 1 << 13
#: Languages a task counts before it hands their sums on.
HELD_LANGUAGES = 200
#: Scores of texts times languages at once.
SCORES = 1 << 22
#: Shares of a language's trigrams are summed in these units, so that sums are the same in any order.
UNIT = 1 << 44
DOC_WEIGHT = 1 << 10
CHARS = 1 << 19
#: Exhaustive codes up to so many languages, above them random ones of CODE_BITS bits.
EXHAUSTIVE, CODE_BITS = 6, 63
#: Trigrams that count as independent evidence at most, and the lead in score below which a text is ambiguous.
EVIDENCE, LEAD = 40.0, 0.2
UNKNOWN = "und"


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every trigram of all texts (letters in lower case, all else a blank; blanks only: none),
    and whether each text has a letter."""
    lowered = [" " + (t or "").lower() + "  " for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = char_classes()[points] == LETTER
    owner = np.repeat(np.arange(len(texts)), sizes)
    has = np.bincount(owner, letter, len(texts)) > 0
    marks = np.where(letter, points, 32)
    keep = np.ones(len(marks), bool)  # runs of blanks count as one
    keep[1:] = letter[1:] | letter[:-1] | (owner[1:] != owner[:-1])
    marks, owner = marks[keep].astype(np.uint32), owner[keep]
    if len(marks) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), has
    code = (marks[:-2] * np.uint32(0x9E3779B1)) ^ (marks[1:-1] * np.uint32(0x85EBCA77)) ^ (marks[2:] * np.uint32(0xC2B2AE3D))
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    same = (owner[2:] == owner[:-2]) & ((marks[:-2] != 32) | (marks[1:-1] != 32) | (marks[2:] != 32))
    return (code >> np.uint32(19)).astype(np.int64)[same], owner[2:][same], has


assert 1 << (32 - 19) == BUCKETS


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # (languages, bits) of -1 and 1
    weights: np.ndarray  # (BUCKETS, bits) log-likelihood ratios
    bit_weight: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score and ambiguity of each text, and whether it has a letter."""
        n = len(texts)
        bucket, owner, has = trigrams(texts)
        count = np.bincount(owner, minlength=n)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool), has
        margins = np.empty((n, self.code.shape[1]))
        for b in range(self.code.shape[1]):
            margins[:, b] = np.bincount(owner, self.weights[bucket, b], n) / np.maximum(count, 1) * np.minimum(count, EVIDENCE)
        step = max(1, SCORES // len(self.languages))
        decoded = [self.decode(margins[at:at + step]) for at in range(0, n, step)]
        best, score, lead = (np.concatenate([d[k] for d in decoded]) for k in range(3)) if decoded else (np.zeros(0, int),) * 3
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, has)]
        return names, np.where(has, score, 0.0), has & (lead < LEAD), has

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The codeword of least loss for each row of margins, its share and its lead over the next one."""
        n = len(margins)
        loss = np.zeros((n, len(self.languages)))
        for b in range(self.code.shape[1]):
            loss += self.bit_weight[b] * np.logaddexp(0, -np.outer(margins[:, b], self.code[:, b]))
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        score = share[np.arange(n), best]
        next_best = np.partition(share, -2, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(n)
        return best, score, score - next_best


def codewords(languages: int) -> np.ndarray:
    """Rows of -1 and 1: the exhaustive code for few languages, else fixed random words, all columns useful and distinct."""
    if languages < 2:
        return np.zeros((languages, 0))
    if languages <= EXHAUSTIVE:
        columns = range(1, 1 << (languages - 1))  # the last language's bit is always clear, so no column is another's mirror
        return np.array([[1 if c >> k & 1 else -1 for c in columns] for k in range(languages)])
    rng = np.random.default_rng(languages)
    code = rng.choice([-1, 1], (languages, CODE_BITS))
    for b in range(CODE_BITS):
        while abs(code[:, b].sum()) == languages:
            code[:, b] = rng.choice([-1, 1], languages)
    return code


def fit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Model:
    """The model of all rows with a label and a text."""
    small_batches(docs.sparkSession)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for t in text_batches(batches, CHARS):
            bucket, owner, _ = trigrams(t["text"].to_pylist())
            langs = t["lang"].to_pylist()
            count = np.bincount(owner, minlength=len(langs))
            # fixed-point shares: sums are the same in any order
            share = (DOC_WEIGHT * 1024 // np.maximum(count, 1))[owner]
            for lang in set(langs):
                of = np.fromiter((x == lang for x in langs), bool, len(langs))[owner]
                one = np.bincount(bucket[of], share[of], BUCKETS).astype(np.int64)
                held[lang] = held[lang] + one if lang in held else one
            if len(held) > HELD_LANGUAGES:
                yield from rows(held)
                held = {}
        yield from rows(held)

    def rows(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, c in held.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                                             names=["lang", "bucket", "n"])

    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    sums = stored(labelled.mapInArrow(tidy(counts), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language_counts")
    totals = {r["lang"]: r["n"] for r in sums.groupBy("lang").agg(F.sum("n").alias("n")).collect()}  # a row a label
    names = sorted(totals)
    code = codewords(len(names))
    bits = code.shape[1]
    shared = docs.sparkSession.sparkContext.broadcast(({name: k for k, name in enumerate(names)}, code > 0, [totals[name] for name in names]))

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ones, total = shared.value
        total = np.array(total, np.float64)
        found: dict[int, np.ndarray] = {}
        for t in batches:
            at = np.fromiter((place[x] for x in t.column(0).to_pylist()), np.int64, t.num_rows)
            rate = np.rint(t.column(2).to_numpy() / total[at] * UNIT).astype(np.int64)
            bucket = t.column(1).to_numpy()
            order = np.argsort(bucket, kind="stable")
            starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else order
            both = np.concatenate([rate[:, None], rate[:, None] * ones[at]], axis=1)[order]
            for b, row in zip(bucket[order][starts], np.add.reduceat(both, starts, axis=0) if len(starts) else both):
                found[b] = found[b] + row if b in found else row
        if found:
            rows = list(found.values())
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))],
                                             names=["bucket", "rates"])

    # every bucket is in one task, which holds BUCKETS * bits numbers at most
    both = np.zeros((BUCKETS, bits + 1), np.int64)
    for r in sums.repartition("bucket").mapInArrow(tidy(sides), "bucket int, rates array<bigint>").collect():
        both[r["bucket"]] = r["rates"]
    floor = 1e-6
    members = np.maximum((code > 0).sum(axis=0), 1), np.maximum((code < 0).sum(axis=0), 1)
    weights, separation = np.zeros((BUCKETS, bits), np.float32), np.zeros(bits)
    for b in range(bits):
        ahead = (both[:, b + 1] / UNIT / members[0][b] + floor) / (1 + floor * BUCKETS)
        behind = ((both[:, 0] - both[:, b + 1]) / UNIT / members[1][b] + floor) / (1 + floor * BUCKETS)
        ratio = np.log(ahead / behind)
        weights[:, b] = ratio
        separation[b] = ((ahead - behind) * ratio).sum()  # symmetric divergence of the two sides
    return Model(tuple(names), code, weights, separation / separation.sum() if len(separation) and separation.sum() else separation)


def identify(docs: DataFrame, model: Model, *, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score``, ``ambiguous`` and ``has_letter`` of every row. A kept column of one of
    these names is replaced. ``und`` doesn't tell texts without a letter: every text is that if no language was learned. A kept
    text column goes to Python once."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * bits numbers
    keep = tuple(c for c in keep if c not in ("lang_pred", "score", "ambiguous", "has_letter"))
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    text = text_col if text_col in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in text_batches(batches, CHARS, text):
            names, score, unsure, has = shared.value.predict(t[text].to_pylist())
            yield pa.RecordBatch.from_arrays([*(t[c].combine_chunks() for c in keep), pa.array(names, pa.string()), pa.array(score),
                                              pa.array(unsure), pa.array(has)],
                                             names=[*keep, "lang_pred", "score", "ambiguous", "has_letter"])

    read = [F.col(f"`{c}`") for c in keep] + ([] if text_col in keep else [F.col(text_col).alias("__text")])
    return docs.select(*read).mapInArrow(
        tidy(run), kinds + "lang_pred string, score double, ambiguous boolean, has_letter boolean")
