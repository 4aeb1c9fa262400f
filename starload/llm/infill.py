"""Fill-in-middle: each text is cut into prefix, middle and suffix and written in another order.

All cutting is one pyarrow.compute pipeline per batch, no loop over texts or units: the bytes of a
chunk of texts are split into units (list arrays of a text's units), flattened with the index of
the text that each came from, numbered within their text, given a role by comparing that number
with the text's two cuts, filtered by role, rebuilt as lists and joined into pieces by binary_join.
The cuts and the form come from a hash of the id, computed in Spark's own columns, so reruns
agree. A chunk holds ``CHUNK`` bytes of texts; a longer text is piped in several chunks whose
numbers go on, so memory is bounded by the batch and the longest text, not by its units.

The unit is ``"char"`` (a code point), ``"word"`` (a word and the blanks after it; blanks before the
first word are a unit) or ``"line"`` (up to and including its line feed).

Defined cases: a null text counts as empty and has the form ``plain``; so has a text that contains
one of the marks, which could not be told from the marks of the form; a null id counts as the
empty id; repeated rows and ids are cut alike; an empty table gives an empty result; of the other
columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starload.llm.text import BLANKS, documents, whole_text

#: The marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 1
#: Of 100 texts so many are transformed, and of 100 of these so many as suffix-prefix-middle.
CUT, SUFFIX_FIRST = 90, 20
#: Bytes of text that are in one turn of the pipeline.
CHUNK = 1 << 20
UNITS = ("char", "word", "line")

PLAIN, PSM, SPM = "plain", "psm", "spm"


def _starts(values: np.ndarray, before: int, unit: str) -> pa.Array:
    """Whether a unit starts at each byte; ``before`` is the byte before the first, or -1.

    Blanks and line ends are single bytes in UTF-8, and no other character contains them.
    """
    now = pa.array(values)
    if unit == "char":
        return pc.not_equal(pc.bit_wise_and(now, pa.scalar(0xC0, pa.uint8())), 0x80)
    last = pa.array(np.append(np.uint8(max(before, 0)), values)[:-1])
    if unit == "line":
        return pc.equal(last, ord("\n"))
    blanks = pa.array(list(BLANKS.encode()), pa.uint8())
    return pc.and_(pc.is_in(last, blanks), pc.invert(pc.is_in(now, blanks)))


def _segments(offsets: np.ndarray, chunk: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, first byte, end) of at most ``chunk`` bytes together."""
    group, size = [], 0
    for text, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        while True:
            end = min(high, low + chunk - size)
            group.append((text, low, end))
            size += end - low
            if size >= chunk:
                yield group
                group, size = [], 0
            if end == high:
                break
            low = end
    if group:
        yield group


class Pipeline:
    """Counts the units of the texts of one array and cuts each into three pieces."""

    def __init__(self, texts: pa.Array, unit: str, chunk: int = CHUNK):
        texts = pa.concat_arrays([texts.cast(pa.binary())])
        self.size, self.unit = len(texts), unit
        _, offsets, data = texts.buffers()
        start = texts.offset
        self.offsets = np.frombuffer(offsets, "<i4")[start : start + self.size + 1].astype("i8")
        self.values = np.frombuffer(data or b"", "u1")
        self.groups = list(_segments(self.offsets, chunk))

    def _units(self, group) -> tuple[pa.ListArray, np.ndarray]:
        """The units of each segment as a list array, and whether the first goes on an earlier one."""
        low, high = group[0][1], group[-1][2]
        values = self.values[low:high]
        text, first, end = (np.array(c, "i8") for c in zip(*group))
        head = first == self.offsets[text]
        starts = _starts(values, int(self.values[low - 1]) if low else -1, self.unit)
        mask = starts.to_numpy(zero_copy_only=False).copy()
        there = first < end
        own = np.zeros(len(group), bool)
        own[there] = mask[first[there] - low]
        mask[first[there] - low] = True  # a text, or what follows of it, begins a unit here
        at = pc.indices_nonzero(pa.array(mask)).cast(pa.int32()).to_numpy()
        bounds = np.append(at, high - low).astype("<i4")
        units = pa.Array.from_buffers(
            pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(values)]
        )
        lists = np.searchsorted(at, np.append(first, high) - low).astype("i4")
        return pa.ListArray.from_arrays(pa.array(lists), units), ~head & ~own & there

    def counts(self) -> np.ndarray:
        """How many units each text has."""
        found = np.zeros(self.size, "i8")
        for group in self.groups:
            lists, goes_on = self._units(group)
            lengths = pc.list_value_length(lists).to_numpy() - goes_on
            np.add.at(found, [text for text, _, _ in group], lengths)
        return found

    def cut(self, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
        """Prefix, middle and suffix of every text; they end after ``first`` and ``second`` units."""
        done = np.zeros(self.size, "i8")
        parts: list[list[pa.Array]] = [[], [], []]
        owners = []
        for group in self.groups:
            lists, goes_on = self._units(group)
            text = np.array([t for t, _, _ in group])
            lengths = pc.list_value_length(lists).to_numpy()
            # Several segments of one group are of different texts.
            base = pa.array(done[text] - goes_on)
            flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
            places = pa.array(np.arange(len(flat), dtype="i8"))
            zero = pa.array(lists.offsets.to_numpy()[:-1].astype("i8"))
            ordinal = pc.add(pc.subtract(places, pc.take(zero, parent)), pc.take(base, parent))
            cuts = [pc.take(pa.array(cut[text]), parent) for cut in (first, second)]
            role = pc.add(*[pc.greater_equal(ordinal, cut).cast(pa.int8()) for cut in cuts])
            for kind, pieces in enumerate(parts):
                chosen = pc.equal(role, kind)
                owner = pc.filter(parent, chosen).to_numpy()
                bounds = np.searchsorted(owner, np.arange(len(group) + 1)).astype("i4")
                rebuilt = pa.ListArray.from_arrays(pa.array(bounds), pc.filter(flat, chosen))
                pieces.append(pc.binary_join(rebuilt, b""))
            owners.append(text)
            np.add.at(done, text, lengths - goes_on)
        if not owners:
            return [pa.array([], pa.string())] * 3
        owner = np.concatenate(owners)
        bounds = pa.array(np.searchsorted(owner, np.arange(self.size + 1)).astype("i4"))
        return [
            pc.binary_join(pa.ListArray.from_arrays(bounds, pa.concat_arrays(p)), b"").cast(
                pa.string()
            )
            for p in parts
        ]


def transform(
    texts: pa.Array, hashes: Sequence[pa.Array], unit: str, marks: Sequence[str], cut: int,
    suffix_first: int, chunk: int = CHUNK,
) -> dict[str, pa.Array]:
    """n, form, prefix and middle units and the output of texts without null; ``hashes`` are four
    arrays of unsigned 32-bit numbers."""
    pipeline = Pipeline(texts, unit, chunk)
    n = pipeline.counts()
    h1, h2, h3, h4 = (h.to_numpy().astype("i8") for h in hashes)
    first, second = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    marked = pc.equal(pc.binary_length(texts), 0)
    for mark in marks:
        marked = pc.or_(marked, pc.match_substring(texts, mark))
    plain = pc.or_(marked, pa.array(h3 % 100 >= cut))
    prefix, middle, suffix = pipeline.cut(first, second)
    p, s, m = marks
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")
    spm_first = pa.array(h4 % 100 < suffix_first)
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n),
        "form": pc.if_else(plain, PLAIN, pc.if_else(spm_first, SPM, PSM)),
        "prefix_units": pc.if_else(plain, none, pa.array(first)),
        "middle_units": pc.if_else(plain, none, pa.array(second - first)),
        "output": pc.if_else(plain, texts, pc.if_else(spm_first, spm, psm)),
    }


def _hashes(doc_id: str, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of the id's sha256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    sha = F.sha2(text, 256)
    return [F.conv(F.substring(sha, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit: str = "char",
    seed: int = SEED,
    marks: Sequence[str] = MARKS,
    cut: int = CUT,
    suffix_first: int = SUFFIX_FIRST,
    chunk: int = CHUNK,
) -> DataFrame:
    """(id, n, form, prefix_units, middle_units, output) of every row.

    ``n`` counts the text's units; the prefix is its first ``prefix_units``, the middle the next
    ``middle_units``, the suffix the rest (both null where the form is ``plain``).
    """
    if unit not in UNITS:
        raise ValueError(f"unit: {unit}")
    if len(set(marks)) != 3 or "" in marks:
        raise ValueError(f"marks: {marks}")
    schema = StructType(
        [
            StructField(id_col, df.schema[id_col].dataType),
            StructField("n", LongType()),
            StructField("form", StringType()),
            StructField("prefix_units", LongType()),
            StructField("middle_units", LongType()),
            StructField("output", StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            # Rows are taken together up to a chunk's bytes, so that little is held at a time.
            low = 0
            while low < batch.num_rows:
                done = ends[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(ends, done + chunk, "right")))
                rows = [column.slice(low, high - low) for column in batch.columns]
                out = transform(
                    texts.slice(low, high - low), rows[2:], unit, marks, cut, suffix_first, chunk
                )
                yield pa.RecordBatch.from_arrays([rows[0], *out.values()], [id_col, *out])
                low = high

    hashes = [h.alias(f"h{i}") for i, h in enumerate(_hashes(id_col, seed))]
    rows = df.select(F.col(id_col), whole_text(text_col).alias("text"), *hashes)
    return rows.mapInArrow(run, schema)


def restored(output: str | Column, form: str | Column, marks: Sequence[str] = MARKS) -> Column:
    """The text, rebuilt from what was written and its form.

    A text that was cut contains no mark, so the first of each mark is the one that was set, as
    long as no mark can begin inside another (``MARKS`` cannot).
    """
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    p, s, m = marks

    def parts(one: str, two: str) -> tuple[Column, Column, Column]:
        """What stands after mark ``one``, after mark ``two`` and after the middle's mark."""
        body = F.substring(output, F.lit(len(one) + 1), F.char_length(output))
        first = F.substring_index(body, two, 1)
        rest = F.substring(body, F.char_length(first) + F.lit(len(two) + 1), F.char_length(body))
        second = F.substring_index(rest, m, 1)
        third = F.substring(rest, F.char_length(second) + F.lit(len(m) + 1), F.char_length(rest))
        return first, second, third

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )


OP12_SQL = """
with hashed as (
    select doc_id, coalesce(text, '') as text,
        sha256('1:' || coalesce(cast(doc_id as varchar), '')) as sha
    from documents
),
numbers as (
    select doc_id, text, length(text) as n,
        cast('0x' || substr(sha, 1, 8) as bigint) as h1,
        cast('0x' || substr(sha, 9, 8) as bigint) as h2,
        cast('0x' || substr(sha, 17, 8) as bigint) as h3,
        cast('0x' || substr(sha, 25, 8) as bigint) as h4
    from hashed
),
cuts as (
    select doc_id, text, n,
        least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case
            when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                or h3 % 100 >= 90 then 'plain'
            when h4 % 100 < 20 then 'spm'
            else 'psm'
        end as form
    from numbers
),
pieces as (
    select *, substr(text, 1, a) as prefix, substr(text, a + 1, b - a) as middle,
        substr(text, b + 1) as suffix
    from cuts
)
select doc_id, n, form,
    case when form <> 'plain' then a end as prefix_chars,
    case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form
        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
        else text
    end) as output_sha256,
    sha256(text) as restored_sha256
from pieces
"""

QUERIES = {"op12_fill_in_middle": op12_fill_in_middle}
TWINS = {"op12_fill_in_middle": OP12_SQL}
