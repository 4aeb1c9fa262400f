"""The whole pipeline against one written without Spark."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from helpers import SCHEMA
from starload.llm.language import AMBIGUOUS
from test_exact_dedup import brute as exact_brute
from test_language import brute_decoder, prose
from test_mixing import shared
from test_packing import classic
from test_simhash import brute_fingerprint
from tokenizers import Tokenizer


def rows():
    rng = random.Random(21)
    made = []
    for i in range(90):
        lang = rng.choice(["en", "de", "fr"])
        made.append([i, prose(lang, rng.choice([5, 30, 200, 900]), rng), lang, rng.choice("aab")])
    for i, row in zip(range(90, 110), made):  # copies, some with other blanks
        made.append([i, row[1] if i % 2 else row[1].replace(" ", "  "), row[2], "c"])
    for i, row in zip(range(110, 120), made[30:]):  # near copies
        made.append([i, row[1] + " more", row[2], None])
    made += [[120, "12 34 !", "en", "a"], [121, None, None, "a"], [122, "", None, "b"]]
    made += [[123, made[5][1] + " le the der", None, "b"]]
    return [(*row, len(row[1] or "")) for row in made]


def language_brute(docs):
    learned = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2 and d[2] and d[1] is not None]
    decode = brute_decoder([(d[1], d[2]) for d in learned])
    found = [(d, *decode(d[1])) for d in docs]
    # Not so near the limit that rounding decides.
    assert all(abs(score - AMBIGUOUS) > 1e-3 for _, _, score in found)
    return [d for d, lang, score in found if lang != "und" and score >= AMBIGUOUS]


def near_brute(docs):
    fps = {d[0]: brute_fingerprint(d[1]) for d in docs}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in fps.items():
        for j, b in fps.items():
            if i < j and (a ^ b).bit_count() <= 4:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [d for d in docs if find(d[0]) == d[0]]


def mixing_brute(docs):
    def size(d):
        return len([w for w in (d[1] or "").translate({c: 32 for c in range(9, 14)}).split(" ") if w])

    sizes = defaultdict(int)
    for d in docs:
        sizes[d[3]] += size(d)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = shared(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    taken = []
    for source in order:
        own = [d for d in docs if d[3] == source]
        copies = min(2.0, target[source] / sizes[source]) if sizes[source] else 0.0
        sure, p = math.floor(copies), copies - math.floor(copies)
        taken += own * sure
        gap = math.floor(target[source] - sure * sizes[source] + 1e-6)
        if not p:
            continue

        def place(d):
            u = (int(hashlib.md5(f"mix:{d[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            return (u * (1 - p)) / ((1 - u) * p)

        left = []
        for d in sorted((d for d in own if size(d)), key=place):
            if size(d) <= gap:
                taken.append(d)
                gap -= size(d)
            else:
                left.append(d)
        taken += [d for d in left if size(d) < 2 * gap][:1]
    return taken


def packing_brute(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = Counter()
    for d in docs:
        ids = tokenizer.encode(d[1] or "", add_special_tokens=False).ids + [2]
        at, take = 0, len(ids) % 1024 or 1024
        number = 0
        while at < len(ids):
            crc = zlib.crc32(np.array(ids[at : at + take], "<u4").tobytes())
            pieces[d[0], number, at, take, crc] += 1
            at, take, number = at + take, 1024, number + 1
    return pieces


def test_the_whole_against_brute_force(spark, tmp_path):
    docs = rows()
    spark.createDataFrame(docs, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    kept = language_brute(docs)
    assert 0 < len(kept) < len(docs)
    stay = {i for i, keep, _, stays, _ in exact_brute([d[:2] for d in kept]) if stays}
    kept = [d for d in kept if d[0] in stay]
    near = near_brute(kept)
    assert len(near) < len(kept)
    pieces = packing_brute(mixing_brute(near))

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(tuple(r[n] for n in names) for r in got) == pieces
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == classic([r["length"] for r in got], 1024)
