import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import EDGES, clashing, docs
from tokenizers import Tokenizer

from starload.llm.packing import WordIds, best_fit, load_encoder, pack


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


ODD = [
    "two  spaces", "three   spaces\n b", " lead", "trail ", "trail  ", "a \n b\n\n c", "\n b",
    "it's we'll I'D x's", "\t tab \t", "\x1c x \x1d", "a b   c", "<|endoftext|> x", "  ",
]


def test_words_give_the_ids_of_the_whole_text(encode):
    rng = random.Random(3)
    mixed = ["".join(rng.choice("ab'\n\t  .,1é \x1cs") for _ in range(40)) for _ in range(500)]
    known = WordIds(encode, limit=50)
    for text in [t for t in EDGES if isinstance(t, str)] + ODD + mixed:
        assert np.frombuffer(known.text(text), "<u4").tolist() == encode(text), text


def test_ranks_give_the_same_ids(encode):
    ranks = WordIds(load_encoder("byte_bpe_50k.tiktoken"))
    for text in ODD:
        assert np.frombuffer(ranks.text(text), "<u4").tolist() == encode(text)


def classic(lengths, capacity):
    """Best-fit decreasing, one piece at a time."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= length), default=None)
        if fit is None:
            gaps.append(capacity - length)
        else:
            gaps[gaps.index(fit)] -= length
    return len(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_in_runs_equals_single_pieces(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    n, top = rng.randint(1, 300), rng.choice([3, capacity // 2, capacity])
    lengths = [rng.randint(1, top) for _ in range(n)]
    counts = {x: lengths.count(x) for x in set(lengths)}
    runs, used = best_fit(counts, capacity)
    filled = defaultdict(list)
    for length, _, n, sequence, width, offset in runs:
        for i in range(n):
            filled[sequence + i % width].append((offset + i // width * length, length))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == used == classic(lengths, capacity)
    ranks = defaultdict(list)
    for length, first, n, *_ in runs:
        ranks[length] += range(first, first + n)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(v)) for k, v in counts.items()}


def test_pack(spark, encode):
    df = docs(spark, EDGES + ODD + ["some words " * k for k in range(0, 900, 37)])
    rows = pack(clashing(df), keep_ids=True).collect()
    whole = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["piece"]):
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        assert r["length"] == len(r["ids"]) <= 1024
        whole[r["doc_id"]].append(r)
    for d in df.where("doc_id is not null and doc_id <> 8").collect():
        ids = [x for r in whole[d["doc_id"]] for x in r["ids"]]
        assert ids == encode(d["text"] or "") + [2]
        assert [r["piece"] for r in whole[d["doc_id"]]] == list(range(len(whole[d["doc_id"]])))
        assert [r["start"] for r in whole[d["doc_id"]]][0] == 0
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) == classic([r["length"] for r in rows], 1024)


def test_empty_table(spark):
    assert pack(docs(spark, EDGES).limit(0)).count() == 0


def test_no_cut_beside_other_whitespace():
    """Against the tokenizer file at its defaults."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def whole(text):
        return tokenizer.encode(text, add_special_tokens=False).ids

    rng = random.Random(7)
    mixed = ["".join(rng.choice("ab, \xa0\n\u2003\u3000\x85\x1f") for _ in range(40)) for _ in range(500)]
    known = WordIds(load_encoder("byte_bpe_50k.tiktoken"))
    for text in ["a \xa0 \xa0 b", "a" + " \xa0" * 8 + " b", "a\xa0 \xa0 b", " \xa0 \xa0 "] + mixed:
        assert np.frombuffer(known.text(text), "<u4").tolist() == whole(text), text


def test_special_tokens_in_a_text(encode):
    """The one id of the tokenizer file at its defaults, in which it parts the text."""
    known = WordIds(load_encoder("byte_bpe_50k.tiktoken"))
    assert np.frombuffer(known.text("a<|endoftext|>b"), "<u4").tolist() == [64, 50256, 65]
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|endoftext|", "<|", "|>", "a", " ", "b c", "\n", "\xa0", "don't"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8)))
        assert np.frombuffer(known.text(text), "<u4").tolist() == encode(text), text
    none = WordIds(load_encoder("byte_bpe_50k.tiktoken"), special={})
    assert 50256 not in np.frombuffer(none.text("a<|endoftext|>b"), "<u4")
