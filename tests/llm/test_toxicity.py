import random

from helpers import EDGES, SCHEMA, clashing, docs

from starload.llm.toxicity import (
    INSULT,
    NEGATION,
    OTHER,
    REPORT,
    TARGET,
    THREAT,
    Model,
    _reaching,
    compose,
    grammar,
    scored,
    strength,
    train,
)

WORDS = "the and of river stone walks green quiet with from house over small light".split()
BAD = ["idiot", "scumbag", "vequa", "lowei"]


def corpus(spark, n, seed=0, noise=0.0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 3)):
                stem = rng.choice(BAD)
                words.insert(rng.randrange(len(words)), stem + rng.choice(["", "s", "té", "ent"]))
        rows.append((i, " ".join(words) + ".", "en", "s", None))
        labels.append((i, int(toxic != (rng.random() < noise))))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")


def auc(pairs):
    good = [s for s, y in pairs if y == 0]
    bad = [s for s, y in pairs if y == 1]
    return sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))


def test_held_out(spark):
    df, label = corpus(spark, 1200, noise=0.03)
    model = train(df.where("doc_id % 5 > 0"), label.where("doc_id % 5 > 0"))
    fresh, truth = corpus(spark, 300, seed=1)
    rows = scored(fresh, model).join(truth, "doc_id").collect()
    assert auc([(r["score"], r["toxic"]) for r in rows]) > 0.98
    assert sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows) > 290


def test_unseen_forms_match_by_their_stem(spark):
    df, label = corpus(spark, 1200)
    model = train(df, label)
    lexicon, machine = model.prepare()
    assert strength("you are lowei-like and a loweischaft", lexicon, machine)[0] > 0
    assert strength("a river and a stone", lexicon, machine) == (0.0, 0.0)


def test_the_composed_machine_is_the_chain_of_its_parts():
    harm = (INSULT, THREAT)
    parts = [
        _reaching(REPORT, harm, 6, 0.6),
        _reaching(NEGATION, (*harm, 6), 7, 0.4),
        _reaching(TARGET, harm, 8, 1.3),
    ]
    machine = compose(compose(parts[0], parts[1]), parts[2])
    rng = random.Random(3)
    for _ in range(300):
        states, state = [0, 0, 0], 0
        for _ in range(12):
            kind = rng.choice([OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT])
            out, factor = kind, 1.0
            for i, part in enumerate(parts):
                states[i], out, x = part[states[i], out]
                factor *= x
            state, got, weight = machine[state, kind]
            assert (got, round(weight, 9)) == (out, round(factor, 9))


def test_context_changes_the_weight_of_a_clause():
    model = Model({"idiot": 4.0})
    lexicon, machine = model.prepare()

    def of(text):
        return strength(text, lexicon, machine)[0]

    plain = of("what an idiot")
    assert of("you are an idiot") > plain > of("he said an idiot") > of("he said not an idiot") > 0
    assert of("not an idiot") < plain
    assert of("not. an idiot") == plain == of("not\nan idiot")
    assert grammar()[0, OTHER][2] == 0


def test_edges(spark):
    df = clashing(docs(spark, EDGES))
    label = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    for model in (train(df, label), train(df, label.limit(0)), Model({"word": 3.0})):
        got = scored(df, model)
        assert got.columns == [*df.columns, "score"]
        assert all(0 <= r["score"] <= 1 for r in got.collect())
    assert scored(df.limit(0), model).count() == 0
