import hashlib
import re
from collections import defaultdict

from helpers import EDGES, clashing, docs

from starload.llm.exact_dedup import drop_exact_copies, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        squeezed = re.sub("[\x20\x09-\x0d]", "", t or "")
        groups[squeezed].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for text, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for place, m in enumerate(members):
            sha = hashlib.sha256(text.encode()).hexdigest()
            out.append((m[3], members[0][3], len(members), place == 0, sha))
    return sorted(out, key=str)


def test_groups_against_brute_force(spark):
    texts = EDGES + [f"copy {i % 7}" + " " * (i % 3) for i in range(200)]
    df = docs(spark, texts)
    got = sorted((tuple(r) for r in exact_groups(clashing(df)).collect()), key=str)
    assert got == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_a_crowded_filter_gives_the_same_result(spark):
    df = docs(spark, [f"text {i % 150}" for i in range(400)])
    small = exact_groups(df, max_bits=1, bits_per_row=1)
    assert sorted(small.collect()) == sorted(exact_groups(df).collect())


def test_kept_rows_keep_all_columns(spark):
    df = clashing(docs(spark, EDGES + ["b c", "bc ", "b  c"] * 40))
    kept = drop_exact_copies(df)
    assert kept.columns == df.columns
    groups = exact_groups(df)
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(
        r["doc_id"] for r in groups.where("kept and doc_id is not null").collect()
    )
    assert kept.count() == groups.where("kept").count()


def test_ids_of_any_type(spark):
    low = -(2**63)
    df = docs(spark, [(low, "a b"), (5, "ab"), (low, "c"), (3, "c "), (-7, "d"), (2**63 - 1, " d")])
    for kind in ("long", "string", "decimal(20,0)"):
        typed = df.withColumn("doc_id", df.doc_id.cast(kind))
        got = {(int(r["doc_id"]), int(r["keep_id"])) for r in exact_groups(typed).collect()}
        top = 2**63 - 1
        assert got == {(low, low), (5, low), (low, 3), (3, 3), (-7, top), (top, top)}
        kept = sorted(int(r["doc_id"]) for r in drop_exact_copies(typed).collect())
        assert kept == [low, 3, top]


def test_empty_table(spark):
    df = docs(spark, EDGES).limit(0)
    assert exact_groups(df).count() == 0
    assert drop_exact_copies(df).count() == 0
