import math
import random

import numpy as np
from helpers import EDGES, SCHEMA, clashing, docs

from starload.llm.language import FEATURES, SCALE, Model, codewords, identify, ngrams, train
from starload.llm.text import fold

SYLLABLES = {
    "en": "the and ing tion ly er of th sh wh", "de": "der und ung sch ä ö keit pf tz ein",
    "fr": "le eau eux é è que ment tion oi un", "es": "el ción ado ñ ll rr que os mente ía",
    "it": "il zione are gli chi sc ò amo etto ssi", "pl": "szcz ość ł ż prze nie ów cz ki ych",
    "sv": "och ning å ä ö sk het för att lig",
}


def prose(lang, words, rng):
    parts = SYLLABLES[lang].split()
    return " ".join(
        "".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words)
    )


def corpus(spark, langs, per, seed=0):
    rng = random.Random(seed)
    rows = [
        (i, prose(lang, rng.randint(5, 80), rng), lang, "s", None)
        for i, lang in enumerate(langs * per)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def accuracy(df):
    rows = df.collect()
    return sum(r["lang"] == r["language"]["lang_pred"] for r in rows) / len(rows)


def test_held_out_accuracy(spark):
    for langs in (["en", "de"], list(SYLLABLES)):
        df = corpus(spark, langs, 80)
        model = train(df.where(fold("doc_id", 4) != 2))
        assert accuracy(identify(df.where(fold("doc_id", 4) == 2), model)) > 0.97


def test_a_small_sample_still_learns(spark):
    df = corpus(spark, list(SYLLABLES), 80)
    model = train(df, rows_per_lang=20)
    assert accuracy(identify(df, model)) > 0.95


def test_codewords_tell_languages_apart():
    for n in (2, 3, 4, 5, 6, 20, 60):
        code = codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        assert (abs(code.sum(0)) < n).all()
        apart = (code.shape[1] - code @ code.T) / 2
        assert apart[~np.eye(n, dtype=bool)].min() >= (3 if n > 3 else 1)


def test_slices_see_every_ngram(monkeypatch):
    import starload.llm.language as module

    text = "".join(random.Random(1).choice("abcé 12") for _ in range(1000))
    whole = np.sort(np.concatenate(list(ngrams(text))))
    monkeypatch.setattr(module, "SLICE", 64)
    assert (np.sort(np.concatenate(list(ngrams(text)))) == whole).all()


def test_edges(spark):
    df = clashing(docs(spark, EDGES + ["123 456", "?!", "ß"]))
    model = train(corpus(spark, ["en", "fr"], 30))
    for r in identify(df, model).collect():
        none = not r["text"] or not any(c.isalpha() for c in r["text"])
        assert (r["language"]["lang_pred"] == "und") == none
        assert 0 <= r["language"]["score"] <= 1


def test_nothing_or_one_language_learned(spark):
    df = docs(spark, ["some text", None])
    for rows, want in ((df.limit(0), "und"), (df, "en")):
        model = train(rows)
        assert isinstance(model, Model)
        assert {r["language"]["lang_pred"] for r in identify(df, model).collect()} == {want, "und"}
    assert identify(df.limit(0), model).count() == 0


def brute_features(text):
    """Feature numbers of all n-grams, one at a time."""
    raw = [b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode()]
    found = []
    for n in (1, 2, 3):
        for i in range(len(raw) - n + 1):
            gram, code = raw[i : i + n], 0
            for b in gram:
                code = (code * 257 + b + 1) % 2**32
            mixed = code * 2654435761 % 2**32
            mixed ^= mixed >> 15
            found.append(0 if set(gram) == {32} else 1 + mixed % (FEATURES - 1))
    return found


def brute_decoder(rows):
    """``decode(text)``: learns one classifier per bit and tries every codeword."""
    languages = sorted({lang for _, lang in rows})
    counts = [[0.5] * FEATURES for _ in languages]
    for text, lang in rows:
        for f in brute_features(text):
            counts[languages.index(lang)][f] += f > 0
    share = [[n / sum(own) for n in own] for own in counts]
    code = codewords(len(languages)).tolist()
    bits = range(len(code[0]))
    weights = []
    for bit in bits:
        up, down = ([s for s, row in zip(share, code) if row[bit] == side] for side in (1, -1))
        weights.append(
            [0.0]
            + [
                math.log(sum(s[f] for s in up) / len(up)) - math.log(sum(s[f] for s in down) / len(down))
                for f in range(1, FEATURES)
            ]
        )
    reach = [
        min(row[bit] * sum(a * b for a, b in zip(s, weights[bit])) for s, row in zip(share, code))
        for bit in bits
    ]
    trust = [max(r, 0.05) for r in reach]
    trust = [t * len(trust) / sum(trust) for t in trust]

    def decode(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        found = brute_features(text)
        n = max(sum(f > 0 for f in found), 1)
        margins = [SCALE * sum(w[f] for f in found) / n for w in weights]
        losses = [
            sum(t * math.log1p(math.exp(-c * m)) for t, c, m in zip(trust, row, margins)) for row in code
        ]
        near = [math.exp(min(losses) - loss) for loss in losses]
        best = losses.index(min(losses))
        return languages[best], near[best] / sum(near)

    return decode


def test_decoder_against_brute_force(spark):
    langs = ["en", "de", "fr", "es", "it", "pl"]
    learned = corpus(spark, langs, 12, seed=3)
    decode = brute_decoder([(r["text"], r["lang"]) for r in learned.collect()])
    texts = [r["text"] for r in corpus(spark, langs, 4, seed=4).collect()] + ["", None, "12 ?", "ß", "le der"]
    for r in identify(docs(spark, texts), train(learned)).collect():
        lang, score = decode(r["text"])
        assert r["language"]["lang_pred"] == lang
        assert abs(r["language"]["score"] - score) < 1e-3
