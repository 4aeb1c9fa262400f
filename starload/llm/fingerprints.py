"""Document fingerprints by order MinHash, with built-in column functions alone.

A text is a sequence of tokens (words cut to pieces of at most six characters; a Chinese or
Japanese character is a token). Every ``k`` tokens in a row are a k-mer, and k-mers are numbered by
occurrence, so that a repeated line counts as often as it stands there. A hash of k-mer and number
deals the occurrences to ``sketches`` sketches and orders them; a sketch selects its ``picks``
smallest, puts them back into text order and hashes the tuple. Two sketches agree if the same k-mers
were selected in the same order, which makes the signature sensitive to edit distance and not only
to the set of k-mers. Likeness is the share of sketches that agree among those that hold anything
in either text, to the power ``1 / picks``.

Everything is computed row by row where the text lies: the arrays of a text are sorted as 64-bit
numbers that hold hash and position, no k-mer is exploded or shuffled.

Defined cases: a null text counts as empty; a text without tokens has the empty fingerprint, and two
such are alike (1); the next document of the last one, ordered by id (null last), then length, then
hash, is the first; rows equal in id and text are one document and return one row each; an only
document is its own next. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.text import documents, let, whole_text
from starload.operators.keys import dense_key
from starload.tables import materialize

K = 3
SKETCHES = 32
PICKS = 2
_SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}"
_TOKEN = rf"[{_SCRIPTS}]|[^\x20\x09-\x0D{_SCRIPTS}]{{1,6}}"
#: A number holds a hash above and a position of up to 2^27 tokens below.
_PLACE = 27
_HASH = 63 - _PLACE
_PLACES = (1 << _PLACE) - 1


def _kept_bits(value: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(value, 64 - _HASH), _PLACE)


def _above(value: Column, bits: int) -> Column:
    return F.shiftright(value, bits)


def signature(
    text: Column, k: int = K, sketches: int = SKETCHES, picks: int = PICKS
) -> Column:
    """The filled sketches of a text, each as two hex digits for its number and eight of hash.

    ``sketches`` is a power of two, 256 at most.
    """
    low = 63 - (sketches.bit_length() - 1)  # bits below the number of the sketch

    def kmers(tokens: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            before = [F.get(tokens, i - back) for back in range(k - 1, 0, -1)]
            return _kept_bits(F.xxhash64(*before, token)).bitwiseOR(i.cast("long"))

        return F.sort_array(F.transform(tokens, one))

    def dealt(kmer: Column, number: Column) -> Column:
        code = _kept_bits(F.xxhash64(_above(kmer, _PLACE), number.cast("long")))
        return code.bitwiseOR(kmer.bitwiseAND(F.lit(_PLACES)))

    def indexes(array: Column) -> Column:
        return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(
            F.array().cast("array<int>")
        )

    def firsts(array: Column, bits: int) -> Column:
        """Where a new value begins above ``bits``."""

        def begins(i: Column) -> Column:
            return (i == 0) | (_above(F.get(array, i), bits) != _above(F.get(array, i - 1), bits))

        return F.filter(indexes(array), begins)

    def numbered(sorted_kmers: Column) -> Column:
        def runs(starts: Column) -> Column:
            def run(start: Column, j: Column) -> Column:
                end = F.coalesce(F.get(starts, j + 1), F.size(sorted_kmers))
                return F.transform(F.slice(sorted_kmers, start + 1, end - start), dealt)

            alone = F.transform(sorted_kmers, lambda x: dealt(x, F.lit(0)))
            return F.when(F.size(starts) == F.size(sorted_kmers), alone).otherwise(
                F.flatten(F.transform(starts, run))
            )

        return F.sort_array(let(firsts(sorted_kmers, _PLACE), runs))

    def smallest(codes: Column) -> Column:
        def picked(x: Column, i: Column) -> Column:
            return (i < picks) | (_above(F.get(codes, i - picks), low) != _above(x, low))

        return F.filter(codes, picked)

    def tuples(chosen: Column) -> Column:
        def entry(i: Column) -> Column:
            number = _above(F.get(chosen, i), low)
            own = F.filter(F.slice(chosen, i + 1, picks), lambda x: _above(x, low) == number)
            turned = F.transform(
                own,
                lambda x: F.shiftleft(x.bitwiseAND(F.lit(_PLACES)), _HASH).bitwiseOR(
                    _above(x, _PLACE)
                ),
            )
            ordered = F.transform(
                F.sort_array(turned), lambda x: x.bitwiseAND(F.lit((1 << _HASH) - 1))
            )
            digest = F.lower(F.hex(F.xxhash64(ordered)))
            return F.concat(
                F.lpad(F.lower(F.hex(number)), 2, "0"), F.lpad(digest, 16, "0").substr(1, 8)
            )

        return F.transform(firsts(chosen, low), entry)

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    sorted_kmers = let(tokens, kmers)
    codes = let(sorted_kmers, numbered)
    return let(let(codes, smallest), tuples)


def likeness(one: Column, other: Column, picks: int = PICKS) -> Column:
    """0 to 1, from two signatures."""

    def numbers(signature: Column) -> Column:
        return F.transform(signature, lambda e: e.substr(1, 2))

    filled = F.size(F.array_union(numbers(one), numbers(other)))
    same = F.size(F.array_intersect(one, other))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.pow(same / filled, F.lit(1.0 / picks)))


def edited_fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every text and of its edit, and their likeness (see ``op8``).

    The texts are shuffled once, by key; what else moves are the heads that go to the document
    before, ids, lengths and signatures.
    """
    text = whole_text(text_col)
    named = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    keys = [F.xxhash64(F.lit(seed), named, text).alias(name) for seed, name in ((1, "k1"), (2, "k2"))]
    key = ["k1", "k2"]
    narrow = df.select(*keys, F.col(id_col).alias("id"), F.char_length(text).cast("long").alias("n"))
    narrow = narrow.groupBy(*key).agg(F.first("id").alias("id"), F.first("n").alias("n"))
    ranked = dense_key(narrow, [F.col("id").asc_nulls_last()], "rank", start=0, ties=["n", *key])
    rows = ranked.count()
    following = ranked.select(
        F.pmod(F.col("rank") - 1, F.lit(max(rows, 1))).alias("rank"),
        F.col("k1").alias("next1"),
        F.col("k2").alias("next2"),
    )
    order = materialize(ranked.join(following, "rank").drop("rank"), "order")

    texts = df.select(*keys, text.alias("text"))
    wanted = order.select(
        F.col("next1").alias("k1"),
        F.col("next2").alias("k2"),
        F.col("k1").alias("for1"),
        F.col("k2").alias("for2"),
        F.floor(F.col("n") / 4).cast("int").alias("length"),
    )
    heads = texts.join(wanted, key).select(
        F.col("for1").alias("k1"),
        F.col("for2").alias("k2"),
        F.expr("substring(text, 1, length)").alias("head"),
    )
    heads = heads.groupBy(*key).agg(F.first("head").alias("head"))
    stays = F.char_length("text") - F.floor(F.char_length("text") / 4).cast("int")
    both = texts.join(heads, key).select(
        *key, "text", F.concat(F.substring("text", F.lit(1), stays), "head").alias("edited")
    )
    signed = both.select(
        *key,
        F.sha2("edited", 256).alias("edited_sha256"),
        signature(F.col("text")).alias("own"),
        signature(F.col("edited")).alias("changed"),
    )
    signed = materialize(signed, "signatures")
    after = signed.groupBy(F.col("k1").alias("next1"), F.col("k2").alias("next2")).agg(
        F.first("own").alias("after")
    )
    return (
        signed.join(order, key)
        .join(after, ["next1", "next2"])
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_chars"),
            "edited_sha256",
            F.array_join("own", "").alias("fingerprint"),
            F.array_join("changed", "").alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("after")).alias("near_next"),
        )
    )


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


QUERIES = {"op8_order_minhash": op8_order_minhash}
TWINS: dict[str, str] = {}
