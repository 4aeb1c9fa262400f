import random
import time
from pathlib import Path

import numpy as np
from helpers import EDGES, clashing, docs

from starload.llm import passages as module
from starload.llm.passages import (
    SHINGLE,
    WordHashes,
    compact_windows,
    repeated_passages,
    shared_passages,
    shingles,
    sliding_minimum,
    window_keys,
)
from starload.tables import run_folder


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_compact_windows_group_all_subsequences():
    """Every subsequence of enough places lies in one window, that of a smallest value of it."""
    rng = np.random.default_rng(1)
    for n in (3, 12, 40):
        for top in (5, 10**6):
            values = rng.integers(0, top, n).astype(np.uint64) << np.uint64(32)
            for width in (1, 3, 7):
                windows = compact_windows(values, width)
                assert all(r - left + 1 >= width for left, _, r in windows)
                for i in range(n):
                    for j in range(i + width - 1, n):
                        inside = [c for left, c, r in windows if left <= i <= c <= j <= r]
                        assert [values[c] for c in inside] == [values[i : j + 1].min()]


def test_keys_are_the_hashes_of_the_windows():
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 2**63, 300).astype(np.uint64)
    assert len(window_keys(marks, 46)) < 5 * 3 * 300 / 46
    assert len(window_keys(marks[:45], 46)) == 0
    assert (sliding_minimum(marks, 7) == [marks[i : i + 7].min() for i in range(294)]).all()


def brute(a, b, words=50):
    """Whether some passage of ``words`` words of a stands in b word for word."""
    spans = {tuple(b[i : i + words]) for i in range(len(b) - words + 1)}
    return any(tuple(a[i : i + words]) in spans for i in range(len(a) - words + 1))


def test_recall_of_exact_and_near_passages(spark):
    rng = random.Random(3)
    texts, planted = [], {}
    for i in range(120):
        words = prose(rng, rng.randint(30, 300))
        if i % 4 == 1:  # a passage of document i - 1, some of it changed in every other case
            source = texts[i - 1]
            passage = list(source[: min(len(source), rng.randint(55, 90))])
            if len(passage) >= 55:
                if i % 8 == 1:
                    passage[len(passage) // 2] = "changed"
                at = rng.randrange(len(words))
                words[at:at] = passage
                planted[i] = i - 1
        texts.append(words)
    for i in range(100, 112):  # one passage that many share
        texts[i][10:10] = texts[0][:30] + prose(random.Random(9), 60)
    df = docs(spark, [" ".join(t) for t in texts])
    rows = repeated_passages(df).collect()
    found = {(r["doc_id"], r["other_id"]) for r in rows}
    for i, j in planted.items():
        if brute(texts[i], texts[j]) or len(texts[j]) >= 55:
            assert (i, j) in found
    for i in range(101, 112):
        assert (i, 100) in found
    for r in rows:
        a, b = texts[r["doc_id"]], texts[r["other_id"]]
        left, right = a[r["start"] : r["end"]], b[r["other_start"] : r["other_end"]]
        assert min(len(left), len(right)) >= 50

        def sets(w):
            return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

        one, other = sets(left), sets(right)
        assert abs(len(one & other) / len(one | other) - r["similarity"]) < 1e-9
        assert r["similarity"] >= 0.8 and r["doc_id"] > r["other_id"]
    touched = {i for p in found for i in p}
    allowed = set(planted) | set(planted.values()) | set(range(100, 112)) | {0}
    assert touched <= allowed


def test_short_common_lines_are_left_alone(spark):
    rng = random.Random(4)
    line = " ".join(prose(rng, 30))
    df = docs(spark, [line + "\n" + " ".join(prose(rng, 120)) for _ in range(40)])
    assert repeated_passages(df).count() == 0


def test_a_repeated_line_inside_both_texts():
    rng = random.Random(5)
    line = prose(rng, 7)
    known = WordHashes()
    a = shingles(" ".join(line * 30), known)
    b = shingles(" ".join(prose(rng, 40) + line * 20 + prose(rng, 40)), known)
    assert shared_passages(a, b)


def test_repeated_words_stay_linear():
    import time

    known = WordHashes()
    began = time.time()
    a, b = shingles("a " * 40_000, known), shingles("b " * 9 + "a " * 30_000, known)
    assert shared_passages(a, b)
    line = " ".join(prose(random.Random(8), 9)) + " "
    a, b = shingles(line * 3000, known), shingles("x " + line * 2500, known)
    assert shared_passages(a, b)
    assert time.time() - began < 60


def test_copies_and_edges(spark):
    rng = random.Random(6)
    copy = " ".join(prose(rng, 200))
    df = docs(spark, EDGES + [(100, copy), (101, copy), (102, copy.upper()), (None, copy), (101, copy)])
    rows = repeated_passages(clashing(df)).collect()
    got = {(r["doc_id"], r["other_id"], r["start"], r["end"], r["similarity"]) for r in rows if r["doc_id"] > 99}
    assert got == {(101, 100, 0, 200, 1.0), (102, 100, 0, 200, 1.0)}
    assert len(rows) == len(set(rows))
    assert repeated_passages(df.limit(0)).count() == 0


def test_a_first_document_with_a_part_does_not_end_the_group(spark):
    rng = random.Random(11)
    texts = []
    for k in range(12):  # three documents each; the first has 45 words, or every 20th changed
        passage = prose(rng, 60)
        part = list(passage[:45])
        if k % 2:
            part = list(passage)
            for i in range(8, 60, 20):
                part[i] = f"changed{k}_{i}"
        for middle in (part, passage, passage):
            texts.append(prose(rng, 80) + middle + prose(rng, 80))
    rows = repeated_passages(docs(spark, [" ".join(t) for t in texts])).collect()
    found = {(r["doc_id"], r["other_id"]) for r in rows}
    assert found == {(3 * k + 2, 3 * k + 1) for k in range(12)}


def test_a_passage_of_frequent_lines(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(60):  # every line of the passage has another first document
        lines = [prose(rng, 12) for _ in range(5)]
        texts += [prose(rng, 60) + line + prose(rng, 60) for line in lines]
        passage = [w for line in lines for w in line]
        texts += [prose(rng, 60) + passage + prose(rng, 60) for _ in range(2)]
    rows = repeated_passages(docs(spark, [" ".join(t) for t in texts])).collect()
    found = {(r["doc_id"], r["other_id"]) for r in rows}
    assert found == {(7 * k + 6, 7 * k + 5) for k in range(60)}


def test_passages_near_repeats_and_edits():
    """The passage behind its own opening, and with words put into its middle."""
    rng, known = random.Random(13), WordHashes()
    for _ in range(20):
        for opening, apart, size in ((20, 10, 60), (20, 40, 60), (6, 15, 55), (30, 5, 70)):
            passage = prose(rng, size)
            a = prose(rng, 90) + passage + prose(rng, 90)
            b = prose(rng, 90) + passage[:opening] + prose(rng, apart) + passage + prose(rng, 90)
            assert brute(a, b)
            for one, other in ((a, b), (b, a)):
                found = shared_passages(*(shingles(" ".join(t), known) for t in (one, other)))
                assert any(e - s >= size for s, e, *_ in found)
    for size, more in ((88, 12), (200, 30), (120, 17)):
        passage = prose(rng, size)
        edited = passage[: size // 2] + prose(rng, more) + passage[size // 2 :]
        a, b = prose(rng, 60) + passage + prose(rng, 60), prose(rng, 60) + edited + prose(rng, 60)
        found = shared_passages(*(shingles(" ".join(t), known) for t in (a, b)))
        assert [(s, e) for s, e, *_ in found] == [(60, 60 + size)]
        assert found[0][4] >= 0.8


def brute_chains(rows, partners):
    """What ``_chains_of_runs`` says it does, run by run; the first of equally good runs is taken."""
    cells, runs = set(zip(rows, partners)), []
    for i, j in cells:
        if (i - 1, j - 1) not in cells:
            n = 1
            while (i + n, j + n) in cells:
                n += 1
            runs.append((i, j, n))
    runs.sort(key=lambda x: (x[0] + x[2], x[1], x[1] - x[0]))
    score, before = [], []
    for t, (i, j, n) in enumerate(runs):
        most, best = 0, -1
        for s, (i2, j2, n2) in enumerate(runs[:t]):
            skip = max(i2 + n2 - i, j2 + n2 - j, 0)
            gap = i + skip - i2 - n2 + j + skip - j2 - n2
            gain = score[s] - skip - module.GAP_COST * gap
            if skip < n and gain > most:
                most, best = gain, s
        score.append(n + most)
        before.append(best)
    chains, used = [], set()
    for t in sorted(range(len(runs)), key=lambda t: -score[t]):
        path = []
        while t >= 0 and (path or t not in used):
            path.append(t)
            t = before[t]
        if sum(runs[x][2] for x in path if x not in used) >= SHINGLE:
            used |= set(path)
            chain, at, at_b = [], 0, 0
            for i, j, n in (runs[x] for x in reversed(path)):
                chain += [(i + k, j + k) for k in range(max(at - i, at_b - j, 0), n)]
                at, at_b = i + n, j + n
            chains.append(chain)
    return chains


def test_chains_of_runs_against_each_run():
    rng = random.Random(16)
    for size, top in ((20, 3), (30, 5), (50, 12), (60, 30)):
        for _ in range(6):
            a, b = ([rng.randrange(top) for _ in range(size)] for _ in range(2))
            cells = [(i, j) for i in range(size) for j in range(size) if a[i] == b[j]]
            rows, partners = np.array(cells).T
            got = [list(zip(*(x.tolist() for x in c))) for c in module._chains_of_runs(rows, partners)]
            want = brute_chains(*np.array(cells).T.tolist())
            assert sorted(got) == sorted(want)


def test_windows_are_laid_out_for_common_hashes_only(monkeypatch):
    rng, known = random.Random(17), WordHashes()
    shared = prose(rng, 80)
    a, b = (shingles(" ".join(prose(rng, 300) + shared), known) for _ in range(2))
    other = shingles(" ".join(prose(rng, 300)), known)
    laid, extents = [], module._extents

    def counted(*given):
        laid.append(given)
        return extents(*given)

    monkeypatch.setattr(module, "_extents", counted)
    assert shared_passages(a, other) == []
    assert not laid
    assert shared_passages(a, b) == shared_passages(a, b, b_windows=module.windows_of(b, 46)) != []


def shuffled(spark):
    """Bytes of the shuffle files that are on disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    folders = [Path(str(f)) for f in blocks.diskBlockManager().localDirs()]
    return sum(f.stat().st_size for d in folders for f in d.glob("*/shuffle_*") if f.exists())


def test_tables_of_windows_are_removed_when_the_pairs_are_made(spark):
    rng = random.Random(15)
    shared = prose(rng, 70)
    texts = [prose(rng, 80) + shared + prose(rng, 80) for _ in range(6)]
    before = set(Path(run_folder(spark).removeprefix("file:")).glob("*"))
    rows = repeated_passages(docs(spark, [" ".join(t) for t in texts]))
    left = set(Path(run_folder(spark).removeprefix("file:")).glob("*")) - before
    assert {f.name.split("-")[0] for f in left} == {"copied", "marked", "gone", "pairs", "texts", "passages"}
    assert {(i, 0) for i in range(1, 6)} <= {(r["doc_id"], r["other_id"]) for r in rows.collect()}


def test_no_shuffle_outlives_the_step_that_made_it(spark):
    rng = random.Random(14)
    shared = prose(rng, 70)
    texts = [prose(rng, 200) + shared * (i % 2) + prose(rng, 200) for i in range(60)]
    df = docs(spark, [" ".join(t) for t in texts])
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), shuffled(spark)
    rows = repeated_passages(df)
    until = time.time() + 10  # files go in the background
    while shuffled(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffled(spark) <= before
    assert spark.conf.get(name, None) == setting
    assert {(i, 1) for i in range(3, 60, 2)} <= {(r["doc_id"], r["other_id"]) for r in rows.collect()}
