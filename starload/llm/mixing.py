"""Mix sources to target weights by Pareto order sampling.

Each source has a share of the total by its weight, stopped at ``max_copies`` times its size; what
it cannot take is shared again by weight. Within a source a document's expected copies follow its
weight (all alike by default), also stopped at ``max_copies``. The whole part of the expectation is
taken for certain. For the rest, documents are ranked by Pareto order sampling,
``U / (1 - U)`` divided by ``p / (1 - p)``, where ``U`` is a hash of the id and ``p`` the fraction
left. In that order each document is taken that still fits into the words its source lacks, to the
end of the order; then the first of those left is taken that brings the source nearer to its
target. What a source takes differs from its target by less than its longest document over 2 (and
one word).

The order is one range sort; running word counts are offsets of the sorted partitions plus a
window inside one partition and source, so a hot source is spread over all tasks. The first
documents of the order, up to the first that does not fit, are found that way at once. What is
lacking then is less than one document, and few more are needed: the next ``CHUNK`` documents of
each source that would still fit are looked at one by one, and so on until none fits. What a source
decides is one row (the places its heads end at) that is joined to the documents.

Defined cases: a null text has size 0 and takes nothing; a null source is a source and comes last;
rows that repeat are counted and drawn singly (which of them is not defined), equal ids are ordered
by size; a null id draws as the empty text. An empty table gives an empty result. Other columns are
kept by ``mix``.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from starload.llm.text import documents, whole_text
from starload.operators.keys import dense_key
from starload.tables import materialize

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MAX_COPIES = 2
#: Sources whose decisions may be broadcast (a few dozen bytes each, names apart).
BROADCAST_SOURCES = 20_000
#: Documents of a source that one step of filling up looks at.
CHUNK = 1024
_HEX_DIGITS = 13


def words_in(text: str | Column) -> Column:
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(doc_id: str | Column, seed: str) -> Column:
    """A number above 0 and below 1 that depends on the id alone."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("")))
    digits = F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("double")
    return (digits + 0.5) / float(16**_HEX_DIGITS)


def source_targets(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """(source, source_size, target) of the written ``rows`` (source, size).

    Sources are numbered over the cluster in the order of their code points, null last. The level
    of the shares rises until no further source is above its stop; each round is one aggregate over
    the written table of sources, of which three sums reach the driver.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    numbered = dense_key(sizes, [F.col("source").asc_nulls_last()], "_number", start=0)
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("_number") % len(weights)).cast("int"))
    numbered = numbered.withColumn("_weight", weight)
    stop = F.col("source_size") * max_copies
    everything = numbered.agg(F.sum("source_size")).first()[0] or 0
    wanted, level, stopped = total * everything, 0.0, -1
    while True:
        over = stop < F.lit(level) * F.col("_weight")
        full, weighed, now = numbered.agg(
            F.coalesce(F.sum(F.when(over, stop)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
        ).first()
        if now == stopped:
            break
        stopped = now
        if weighed:
            level = max(level, (wanted - full) / weighed)
    target = F.least(stop.cast("double"), F.lit(level) * F.col("_weight"))
    return numbered.select("source", "source_size", target.alias("target"))


def document_levels(rows: DataFrame, sources: DataFrame, max_copies: int) -> DataFrame:
    """``sources`` with ``level``: a document expects ``least(max_copies, level * weight)`` copies.

    With equal weights the first level is right; otherwise it rises in rounds, as for sources.
    """
    stop = F.lit(float(max_copies))
    now, stopped = sources.withColumn("level", F.lit(0.0)), None
    while True:
        over = stop <= F.col("level") * F.col("weight")
        sums = _with_source(rows, now.select("source", "level")).groupBy("source").agg(
            F.sum(F.when(over, stop * F.col("size")).otherwise(0.0)).alias("full"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight") * F.col("size"))).alias("open"),
            F.sum(over.cast("long")).alias("stopped"),
        )
        sums = materialize(sums, "levels")
        count = sums.agg(F.sum("stopped")).first()[0]
        if count == stopped:
            return now
        stopped = count
        rest = (F.col("target") - F.col("full")) / F.col("open")
        level = F.when(F.col("open") > 0, F.greatest("level", rest)).otherwise(F.col("level"))
        joined = _with_source(now, sums.drop("stopped"))
        now = materialize(joined.select(*sources.columns, level.alias("level")), "levels")


def _with_source(rows: DataFrame, table: DataFrame, few: bool | None = None) -> DataFrame:
    """Join what a source decided; null is a source. Broadcast only up to a checked count (``few``:
    whether there are no more sources than that, where that is known)."""
    side = table.withColumnRenamed("source", "_source")
    if _few(side) if few is None else few:
        side = F.broadcast(side)
    return rows.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _few(table: DataFrame) -> bool:
    return table.count() <= BROADCAST_SOURCES


def _rank(p: Column, chance: Column) -> Column:
    """Null where nothing is left to draw."""
    return F.try_divide(chance * (1 - p), (1 - chance) * p)


def decisions(
    rows: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """One row per source of the written ``rows`` (id, source, size, weight, chance): ``source``,
    ``source_size``, ``target``, ``level`` and ``fills``.

    A fill has the words that were lacking (``gap``), the place up to which all that fits was taken
    (``last``), and a place of which only ``k`` of ``n`` equal rows were taken (``part``).
    """
    sources = document_levels(rows, source_targets(rows, weights, total, max_copies), max_copies)
    certain, p = expected(max_copies)
    few = _few(sources)
    open_rows = _with_source(rows, sources.select("source", "target", "level"), few)
    open_rows = open_rows.withColumn("certain", certain).withColumn("p", p)
    sure = open_rows.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("sure"))
    places = open_rows.where("p > 0 and size > 0").groupBy(
        "source", _rank(F.col("p"), F.col("chance")).alias("rank"), "id", "size"
    )
    ranked = places.agg(F.count(F.lit(1)).alias("n")).orderBy("source", *_PLACE)
    ranked = materialize(ranked.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    ranked = ranked.withColumn("_part", F.shiftright("_place", 33))
    gap = F.floor(F.col("target") - F.col("sure") + F.lit(1e-6)).cast("long")
    nowhere = F.lit(None).cast(ranked.select(F.struct(*_PLACE).alias("x")).schema["x"].dataType)
    lacking = _with_source(sources, materialize(sure, "sure"), few)
    lacking = materialize(lacking.select("source", gap.alias("gap"), nowhere.alias("last")), "lacking")
    filled = _fill(ranked, lacking, few)
    fills = [filled.select("source", "gap", "last", "part", "k", "n")]
    lacking = _after(lacking, filled.select("source", "words", "last"))
    while True:
        step = _next_fills(ranked, lacking, few)
        if step.isEmpty():
            break
        fills.append(step.select("source", F.inline("fills")))
        lacking = _after(lacking, step.select("source", "words", "last"))
    taken = _fills_by_source(fills, lacking, nowhere)
    fills.append(_nearest(ranked, lacking, taken, nowhere, few))
    return materialize(
        _with_source_left(sources, _fills_by_source(fills, lacking, nowhere)), "decisions"
    )


_PLACE = ["rank", "id", "size"]


def _fills_by_source(fills: list[DataFrame], lacking: DataFrame, nowhere: Column) -> DataFrame:
    """(source, fills) of the sources that have any."""
    none = lacking.limit(0).select(
        "source", "gap", nowhere.alias("last"), nowhere.alias("part"),
        F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("n"),
    )
    every = reduce(DataFrame.unionByName, fills, none).groupBy("source")
    return materialize(
        every.agg(F.collect_list(F.struct("gap", "last", "part", "k", "n")).alias("fills")), "fills"
    )


def _with_source_left(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Join the few rows of one table of sources to those of another."""
    side = table.withColumnRenamed("source", "_source")
    return rows.join(side, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _after(lacking: DataFrame, filled: DataFrame) -> DataFrame:
    """What is lacking behind the words and the last place that were taken."""
    step = _with_source_left(lacking, filled.withColumnRenamed("last", "_last"))
    left = F.col("gap") - F.coalesce("words", F.lit(0))
    step = step.select("source", left.alias("gap"), F.coalesce("_last", "last").alias("last"))
    return materialize(step, "lacking")


def _open(ranked: DataFrame, lacking: DataFrame, few: bool) -> DataFrame:
    """The places behind the last one whose rows fit, with their source's gap."""
    behind = F.col("last").isNull() | (F.struct(*_PLACE) > F.col("last"))
    fitting = _with_source(ranked, lacking, few).where((F.col("size") <= F.col("gap")) & behind)
    return fitting.drop("last")


def _next_fills(ranked: DataFrame, lacking: DataFrame, few: bool) -> DataFrame:
    """source, words, last place looked at and fills of the next ``CHUNK`` places that fit."""
    order = Window.partitionBy("source").orderBy(*_PLACE)
    found = _open(ranked, lacking, few).select("source", *_PLACE, "n", "gap")
    found = found.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= CHUNK)
    place = f"struct<rank:double,id:{dict(ranked.dtypes)['id']},size:bigint>"
    fill = f"struct<gap:bigint,last:{place},part:{place},k:bigint,n:bigint>"
    columns = found.withColumn("place", F.struct(*_PLACE)).select("source", "place", "n", "gap")
    schema = StructType.fromDDL(f"words bigint, last {place}, fills array<{fill}>")
    schema = StructType([ranked.schema["source"], *schema.fields])
    arrow = to_arrow_schema(schema)

    def fill_up(table: pa.Table) -> pa.Table:
        rows = sorted(
            table.select(["place", "n"]).to_pylist(),
            key=lambda r: (r["place"]["rank"], r["place"]["id"] is not None, r["place"]["id"] or 0, r["place"]["size"])
            if not isinstance(r["place"]["id"], str)
            else (r["place"]["rank"], True, r["place"]["id"].encode(), r["place"]["size"]),
        )
        gap = had = head = table["gap"][0].as_py()
        last, fills = None, []
        for row in rows:
            place, n = row["place"], row["n"]
            k = min(n, gap // place["size"])
            gap -= k * place["size"]
            if k == n:
                last = place
                continue
            # A place that does not fit whole ends a head.
            if last or k:
                part, of = (place, n) if k else (None, None)
                fills.append({"gap": head, "last": last, "part": part, "k": k or None, "n": of})
            head, last = gap, None
        if last:
            fills.append({"gap": head, "last": last, "part": None, "k": None, "n": None})
        row = {"words": had - gap, "last": rows[-1]["place"], "fills": fills}
        row["source"] = table["source"][0].as_py()
        return pa.Table.from_pylist([row], schema=arrow)

    return materialize(columns.groupBy("source").applyInArrow(fill_up, schema), "filled")


def _fill(ranked: DataFrame, lacking: DataFrame, few: bool) -> DataFrame:
    """The next head that fits into the gap, for each source that has one: source, gap, ``last``
    place taken whole, place taken in part with ``k`` of its ``n`` rows, and words taken."""
    place = F.struct(*_PLACE)
    fitting = _open(ranked, lacking, few).withColumn("words", F.col("size") * F.col("n"))
    sums = fitting.groupBy("source", "_part").agg(F.sum("words").alias("_words"))
    ahead = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(
        sums.select(
            F.col("source").alias("_source"),
            F.col("_part").alias("_p"),
            F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_ahead"),
        ),
        "offsets",
    )
    inside = Window.partitionBy("source", "_part").orderBy("_place")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = fitting.join(
        sums, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_p"))
    ).withColumn("before", F.col("_ahead") + F.sum("words").over(inside) - F.col("words"))
    # All places whose rows fit, and the first whose rows do not all fit.
    room = F.col("gap") - F.col("before")
    whole = F.col("words") <= room
    k = F.floor(room / F.col("size")).cast("long")
    head = running.where(room > 0).withColumn("k", F.when(whole, F.col("n")).otherwise(k))
    head = head.withColumn("whole", whole).groupBy("source", "gap").agg(
        F.max(F.when(F.col("whole"), place)).alias("last"),
        F.min(F.when(~F.col("whole") & (F.col("k") > 0), F.struct(place.alias("at"), "k", "n"))).alias("cut"),
        F.sum(F.col("k") * F.col("size")).alias("words"),
    )
    return materialize(
        head.where("words > 0").select(
            "source", "gap", "last", "words", F.col("cut.at").alias("part"), "cut.k", "cut.n"
        ),
        "filled",
    )


def _nearest(
    ranked: DataFrame, lacking: DataFrame, taken: DataFrame, nowhere: Column, few: bool
) -> DataFrame:
    """One more row for each source: the first place in order that is not taken whole and brings
    the source nearer to its target."""
    open_places = _with_source(ranked, lacking.drop("last"), few).where(F.col("size") < 2 * F.col("gap"))
    side = taken.withColumnRenamed("source", "_source")
    joined = open_places.join(side, F.col("source").eqNullSafe(F.col("_source")), "left")
    left = joined.where(_taken_of_place() < F.col("n"))
    first = left.groupBy("source", "gap").agg(
        F.min(F.struct(F.struct(*_PLACE).alias("at"), "n")).alias("next")
    )
    return materialize(
        first.select(
            "source", "gap", nowhere.alias("last"), F.col("next.at").alias("part"),
            F.lit(1).cast("long").alias("k"), F.col("next.n").alias("n"),
        ),
        "nearest",
    )


def _taken_of_place() -> Column:
    """How many of the rows at the place of this row (rank, id, size) its source's fills take."""
    place = F.struct(*_PLACE)
    whole = F.exists("fills", lambda f: (F.col("size") <= f["gap"]) & (place <= f["last"]))
    none = F.lit(0).cast("long")
    parts = F.aggregate(
        "fills", none, lambda k, f: k + F.when(f["part"] == place, f["k"]).otherwise(none)
    )
    everything = F.lit(1 << 62)
    return F.when(F.coalesce(whole, F.lit(False)), everything).otherwise(F.coalesce(parts, none))


def expected(max_copies: int) -> tuple[Column, Column]:
    """(certain copies, fraction left) from the columns ``level`` and ``weight``."""
    copies = F.least(F.lit(float(max_copies)), F.col("level") * F.col("weight"))
    certain = F.floor(copies)
    return certain, copies - certain


def _prepared(
    df: DataFrame, id_col: str, text_col: str, source_col: str, weight_col: str | None, seed: str
) -> list[Column]:
    return [
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        words_in(text_col).alias("size"),
        (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("weight"),
        draw(id_col, seed).alias("chance"),
    ]


def _copies(rows: DataFrame, chosen: DataFrame, max_copies: int) -> DataFrame:
    """``rows`` with ``copies``. Of equal rows of which only some are taken (rare; they are written
    and numbered over the cluster) the first ones are."""
    certain, p = expected(max_copies)
    joined = _with_source(rows, chosen).withColumn("_p", p).withColumn("_certain", certain)
    joined = joined.withColumn("rank", _rank(F.col("_p"), F.col("chance")))
    drawn = F.when((F.col("_p") > 0) & (F.col("size") > 0), _taken_of_place())
    joined = joined.withColumn("_k", F.coalesce(drawn, F.lit(0).cast("long")))
    split = F.exists("fills", lambda f: f["k"] < f["n"])
    if chosen.where(split).isEmpty():
        extra = (F.col("_k") > 0).cast("int")
        return joined.withColumn("copies", (F.col("_certain") + extra).cast("int"))
    place = F.struct(*_PLACE)
    among = F.exists("fills", lambda f: (f["part"] == place) & (F.col("_k") < f["n"]))
    among = F.coalesce((F.col("_k") > 0) & among, F.lit(False))
    joined = joined.withColumn("_among", among)
    clear = joined.where(~F.col("_among")).withColumn("_extra", F.col("_k") > 0)
    tied = dense_key(joined.where("_among"), ["source", *_PLACE], "_nth", start=0)
    firsts = tied.groupBy(F.col("source").alias("_s"), place.alias("_at")).agg(
        F.min("_nth").alias("_zero")
    )
    firsts = materialize(firsts, "ties")
    same = F.col("source").eqNullSafe(F.col("_s")) & place.eqNullSafe(F.col("_at"))
    some = tied.join(firsts, same).withColumn("_extra", F.col("_nth") - F.col("_zero") < F.col("_k"))
    both = clear.unionByName(some.drop("_nth", "_s", "_at", "_zero"))
    return both.withColumn("copies", (F.col("_certain") + F.col("_extra").cast("int")).cast("int"))


def mix_table(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    max_copies: int = MAX_COPIES,
    seed: str = "mix",
) -> DataFrame:
    """id, size, source_size, target, copies, taken of every document."""
    columns = _prepared(df, id_col, text_col, source_col, weight_col, seed)
    rows = materialize(df.select(*columns), "sizes")
    chosen = decisions(rows, weights, total, max_copies)
    return _copies(rows, chosen, max_copies).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    max_copies: int = MAX_COPIES,
    seed: str = "mix",
) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them; texts are not shuffled for it."""
    columns = _prepared(df, id_col, text_col, source_col, weight_col, seed)
    rows = materialize(df.select(*columns), "sizes")
    chosen = decisions(rows, weights, total, max_copies)
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    copies = _copies(df.select(whole, *columns), chosen, max_copies)
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return copies.select("_row", each.alias("_copy")).select("_row.*")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_table(documents(spark, sf_dir))


OP2_SQL = """
with sized as (
    select doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 13))::bigint + 0.5)
               / 4503599627370496.0 as chance
    from documents
), by_source as (
    select source, sum(size)::bigint as source_size,
           row_number() over (order by source nulls last) - 1 as number
    from sized group by source
), weighed as (
    select *, case number % 3 when 0 then 3 when 1 then 1 else 2 end as weight,
           sum(source_size) over () * 1.5 as wanted
    from by_source
), sorted as (
    select *,
           (wanted - coalesce(sum(2 * source_size) over before, 0))
               / sum(weight) over after as level,
           row_number() over (order by 2.0 * source_size / weight, number) as place
    from weighed
    window before as (order by 2.0 * source_size / weight, number
                      rows between unbounded preceding and 1 preceding),
           after as (order by 2.0 * source_size / weight, number
                     rows between current row and unbounded following)
), chosen as (
    -- The first source that is not stopped at the level it would have with all before it stopped.
    select coalesce(arg_min(level, place) filter (where level * weight <= 2 * source_size), 1e300)
               as level
    from sorted
), targets as (
    select source, source_size, least(2.0 * source_size, chosen.level * weight) as target
    from sorted, chosen
), expected as (
    select sized.*, source_size, target,
           case when source_size > 0 then least(2.0, target / source_size) else 0.0 end as copies
    from sized join targets on sized.source is not distinct from targets.source
), ranked as (
    select *, floor(copies) as sure, copies - floor(copies) as p,
           (chance * (1 - (copies - floor(copies))))
               / nullif((1 - chance) * (copies - floor(copies)), 0) as pareto
    from expected
), ordered as (
    select *, row_number() over (partition by source order by pareto, doc_id, size) as k
    from ranked where p > 0 and size > 0
), gaps as (
    select source, cast(floor(any_value(target) - sum(sure * size) + 1e-6) as bigint) as gap
    from ranked group by source
), walk as (
    -- Document by document, what fits into the words that are still lacking.
    with recursive steps as (
        select source, 0::bigint as k, gap, 0::bigint as size, false as fits from gaps
        union all
        select steps.source, ordered.k,
               steps.gap - case when ordered.size <= steps.gap then ordered.size else 0 end,
               ordered.size, ordered.size <= steps.gap
        from steps join ordered
            on ordered.source is not distinct from steps.source and ordered.k = steps.k + 1
    )
    select *, min(gap) over (partition by source) as lacking from steps
), nearest as (
    select source, min(k) as k from walk
    where k > 0 and not fits and size < 2 * lacking group by source
), taken as (
    select source, k from walk where fits union all select source, k from nearest
)
select doc_id, size, source_size, target, (sure + (k is not null)::int)::int as copies,
       ((sure + (k is not null)::int) * size)::bigint as taken
from (
    select ranked.doc_id, ranked.size, ranked.source_size, ranked.target, ranked.sure, null as k
    from ranked where not (p > 0 and size > 0)
    union all
    select ordered.doc_id, ordered.size, ordered.source_size, ordered.target, ordered.sure, taken.k
    from ordered left join taken
        on taken.source is not distinct from ordered.source and taken.k = ordered.k
)
"""

QUERIES = {"op2_source_mixing": op2_source_mixing}
TWINS = {"op2_source_mixing": OP2_SQL}
