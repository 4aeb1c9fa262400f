import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, clashing, docs
from pyspark.sql import functions as F

from starload.llm.infill import MARKS, Pipeline, fill_in_middle, op12_fill_in_middle, restored

MARKED = ["a <P> b", "<S>", "x<M>", "<", "<S", "P>", "<P", "<<P", "M><", "<P <S <M"]
UNIT = {"char": r"(?s).", "word": r"(?s)[ \t-\r]*[^ \t-\r]+[ \t-\r]*", "line": r"(?s)[^\n]*\n|[^\n]+"}


def units(text, unit):
    if unit != "word":
        return re.findall(UNIT[unit], text)
    lead = re.match(r"[ \t-\r]*", text).group()
    return [u for u in [lead, *re.findall(r"[^ \t-\r]+[ \t-\r]*", text[len(lead) :])] if u]


def brute(i, text, unit="char", seed=1):
    text = text or ""
    sha = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(sha[8 * k : 8 * k + 8], 16) for k in range(4)]
    parts = units(text, unit)
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= 90:
        return (i, n, "plain", None, None, text)
    if h[3] % 100 < 20:
        return (i, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (i, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def texts():
    rng = random.Random(5)
    alphabet = "ab \n\té日😀\x00<>PSM"
    return EDGES + MARKED * 3 + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)
    ]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
@pytest.mark.parametrize("chunk", [1, 7, 1000, 1 << 20])
def test_units_against_brute_force(unit, chunk):
    plain = [t[1] if isinstance(t, tuple) else t for t in texts()]
    rows = [t or "" for t in plain if len(t or "") < (300 if chunk < 1000 else 10**7)]
    rows = rows[:60] if chunk == 1 else rows
    # A slice, as a batch may be one.
    pipeline = Pipeline(pa.array(["before", *rows, "behind"]).slice(1, len(rows)), unit, chunk)
    split = [units(t, unit) for t in rows]
    counts = pipeline.counts()
    assert counts.tolist() == [len(u) for u in split]
    rng = random.Random(chunk)
    cuts = [sorted(rng.randint(0, len(u)) for _ in range(2)) for u in split]
    found = pipeline.cut(np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts]))
    for u, (a, b), p, m, s in zip(split, cuts, *[f.to_pylist() for f in found]):
        assert (p, m, s) == ("".join(u[:a]), "".join(u[a:b]), "".join(u[b:]))


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_rows_against_brute_force(spark, unit):
    df = docs(spark, texts())
    got = fill_in_middle(clashing(df), unit=unit, chunk=200)
    expected = [brute(r["doc_id"], r["text"], unit) for r in df.collect()]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}


def test_texts_come_back(spark):
    df = docs(spark, [t for t in texts() if not isinstance(t, tuple)])
    got = fill_in_middle(df).withColumn("back", restored("output", "form"))
    both = got.join(df, "doc_id").where(F.col("back") != F.coalesce("text", F.lit("")))
    assert both.count() == 0


def test_other_marks_and_shares(spark):
    df = docs(spark, [f"text number {i}" for i in range(50)] + ["a [M] b"])
    marks = ("[P]", "[S]", "[M]")
    got = fill_in_middle(df, marks=marks, cut=100, suffix_first=100)
    assert {r["form"] for r in got.where("doc_id < 50").collect()} == {"spm"}
    assert got.where("doc_id = 50").first()["form"] == "plain"
    assert got.where("output like '[S]%[P]%[M]%' and doc_id < 50").count() == 50
    for wrong in ({"unit": "page"}, {"marks": ("a", "a", "b")}):
        with pytest.raises(ValueError):
            fill_in_middle(df, **wrong)


def test_empty_table(spark):
    assert fill_in_middle(docs(spark, EDGES).limit(0)).count() == 0


def test_query_columns(spark):
    got = op12_fill_in_middle(spark, "/root/testdata/sf0.001")
    assert got.columns == [
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256",
    ]
