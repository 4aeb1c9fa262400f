import random
import re

import corpus_pipeline
from helpers import clashing, docs

from starload.llm import components, exact_dedup, mixing, simhash
from starload.llm.exact_dedup import exact_groups
from starload.llm.mixing import mix_table
from starload.llm.packing import pack
from starload.llm.simhash import near_groups


def test_stages_in_order(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mixing", "packing"]


def test_each_stage_on_what_the_last_one_kept(spark):
    rng = random.Random(2)
    words = "the and of with from this that there where when".split()
    texts = [" ".join(rng.choice(words) + str(rng.randrange(9)) for _ in range(60)) for _ in range(60)]
    texts += [texts[0], texts[0] + " ", texts[1].replace(" ", "  "), "12 34", None, ""]
    texts += [t + " more" for t in texts[2:8]]
    df = clashing(docs(spark, texts, [rng.choice("abc") for _ in texts]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, df, "")
        assert after.columns == df.columns
        before = {r["doc_id"] for r in df.collect()}
        ids = sorted(r["doc_id"] for r in after.collect())
        if name == "language_id":
            assert before - set(ids) == {63, 64, 65}
        if name == "exact_dedup":
            assert ids == sorted(r["doc_id"] for r in exact_groups(df).where("kept").collect())
        if name == "near_dedup":
            groups = near_groups(df).where("doc_id = component_id").collect()
            assert ids == sorted(r["doc_id"] for r in groups)
        if name == "mixing":
            want = mix_table(df).collect()
            assert ids == sorted(r["doc_id"] for r in want for _ in range(r["copies"]))
        df = after
    packed = corpus_pipeline.STAGES[-1][1](spark, df, "")
    assert sorted(packed.collect()) == sorted(pack(df).collect())


def broadcast(text):
    """What stands below each broadcast of a plan."""
    lines, found = text.split("\n"), []
    depths = [len(re.match(r"[\s:|*+-]*", line)[0]) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depths[j] <= depths[i]), len(lines))
            found.append("\n".join(lines[i + 1 : end]))
    return found


def test_nothing_exploded_is_broadcast(spark, plan, monkeypatch):
    """Spark sizes it by the rows before, so that a table of some 10 MB may fill the driver."""
    plans, write = [], simhash.materialize

    def kept(df, label="table"):
        plans.append(plan(df))
        return write(df, label)

    for module in (components, exact_dedup, mixing, simhash):
        monkeypatch.setattr(module, "materialize", kept)
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(40)) for _ in range(50)]
    df = write(docs(spark, texts, [rng.choice("abc") for _ in texts]))
    for stage in (corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup, corpus_pipeline.mixing):
        df = stage(spark, df, "")
        plans.append(plan(df))
        df = write(df)
    below = [part for text in plans for part in broadcast(text)]
    assert below and any("Generate explode" in text for text in plans)
    assert not [part for part in below if "Generate explode" in part]


def test_an_empty_table(spark):
    df = docs(spark, ["a"]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        after = stage(spark, df, "")
        assert after.count() == 0
        df = after if after.columns == df.columns else df
