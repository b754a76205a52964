"""The fitted classifiers and their decoding against a plain recomputation; any number of labels; long texts and ties."""

import math

import numpy as np

from docforge.llm import langid

TEXTS = {"de": "der hund und die katze schlafen nicht", "en": "the dog and the cat do not sleep", "es": "el perro y el gato no duermen",
         "fr": "le chien et le chat ne dorment pas"}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def _plain(rows, model, text):
    """Scores of all languages for one text, from counts of trigrams one by one."""
    def counts(t):
        bucket, _, has = langid.trigrams([t])
        return bucket.tolist(), bool(has[0])

    rate = {}
    for name in model.languages:
        weight = {}
        for _, t, lang in rows:
            if lang == name:
                buckets, _ = counts(t)
                for b in buckets:
                    weight[b] = weight.get(b, 0) + langid.DOC_WEIGHT * 1024 // len(buckets)
        total = sum(weight.values())
        rate[name] = [(weight.get(b, 0) / total + 1e-6) / (1 + 1e-6 * langid.BUCKETS) for b in range(langid.BUCKETS)]
    buckets, has = counts(text)
    losses, importance = [0.0] * len(model.languages), []
    margins = []
    for bit in range(model.code.shape[1]):
        sides = [[rate[n] for n, c in zip(model.languages, model.code[:, bit]) if c == sign] for sign in (1, -1)]
        ahead, behind = ([sum(col) / len(side) for col in zip(*side)] for side in sides)
        ratio = [math.log(a / b) for a, b in zip(ahead, behind)]
        importance.append(sum((a - b) * r for a, b, r in zip(ahead, behind, ratio)))
        margins.append(sum(ratio[b] for b in buckets) / max(len(buckets), 1) * min(len(buckets), langid.EVIDENCE))
    for bit, margin in enumerate(margins):
        for k in range(len(losses)):
            losses[k] += importance[bit] / sum(importance) * math.log1p(math.exp(-margin * model.code[k, bit]))
    shares = [math.exp(min(losses) - x) for x in losses]
    return [x / sum(shares) for x in shares] if has else None


def test_fit_and_decoding_equal_a_plain_recomputation(spark):
    rows = [(n, f"{t} {n % 3}", lang) for n in range(3) for lang, t in TEXTS.items()]
    model = langid.fit(_rows(spark, rows).repartition(4))
    assert model.languages == tuple(sorted(TEXTS))
    asked = ["the hund and el chat", "der", "katze perro", "", None, "123", "le le le", "the dog " * 5000]
    got = {r["doc_id"]: r for r in langid.identify(_rows(spark, list(zip(range(8), asked, [None] * 8))), model).collect()}
    for n, text in enumerate(asked):
        shares = _plain(rows, model, text)
        if shares is None:
            assert (got[n]["lang_pred"], got[n]["score"], got[n]["ambiguous"]) == ("und", 0.0, False)
            continue
        order = sorted(range(len(shares)), key=lambda k: -shares[k])
        assert got[n]["lang_pred"] == model.languages[order[0]] and abs(got[n]["score"] - shares[order[0]]) < 1e-5
        assert got[n]["ambiguous"] == (shares[order[0]] - shares[order[1]] < langid.LEAD)


def test_every_label_is_learned(spark):
    letters = "bcdfghjklmnpqrstvwxz"
    names = [(f"l{n:03d}", letters[n % 20] + "aeiou"[n // 20 % 5] + letters[n // 100 + 3]) for n in range(300)]
    rows = [(n, f"{w}{w}{w} {w}{w} {w}" * 4, name) for n, (name, w) in enumerate(names)]
    model = langid.fit(_rows(spark, rows))
    assert len(model.languages) == 300 and model.weights.shape == (langid.BUCKETS, langid.CODE_BITS)
    got = langid.identify(_rows(spark, rows), model, keep=("doc_id", "lang")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 290


def test_same_model_in_any_order_and_ties_alphabetical(spark):
    rows = [(n, t, lang) for n, (lang, t) in enumerate(TEXTS.items())] * 3
    a, b = langid.fit(_rows(spark, rows)), langid.fit(_rows(spark, rows[::-1]).repartition(7))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.bit_weight, b.bit_weight)
    same = langid.fit(_rows(spark, [(1, "one text", "b"), (2, "one text", "a"), (3, None, "c"), (4, "7", "d")]))
    assert same.languages == ("a", "b")
    assert {r["lang_pred"] for r in langid.identify(_rows(spark, [(1, "one text", None), (2, "else", None)]), same).collect()} == {"a"}
