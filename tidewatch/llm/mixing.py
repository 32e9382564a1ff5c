"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, then a seeded choice of blocks.

Everything is DataFrame expressions. A source's words form circular streams, one per cell (a hash
class of its documents, in a seeded order). Sources get blocks by highest quotients of their targets,
and a source's blocks are dealt to its cells by highest quotients of their words. A cell takes its
quota as one run of blocks from a seeded start, as often around as it needs, so that nearly all
documents are taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.shared import durable

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 4096  # cells of all sources together, about
CELL_WORDS = 4096  # and at least so many words in each, about


def _number(text: Column) -> Column:
    """The first eight hex digits as a number."""
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long")


def apportion(parties: DataFrame, group: list[str], votes: str, seats: str, order: str) -> DataFrame:
    """``parties`` with ``quota``: each group's ``seats`` given to the highest ``votes / (2 n + 1)``.

    Ties go to the smaller ``order``. A divisor below and one above the right one bound every party's
    quota, so only quotients in between, about four per party, are put in order.
    """
    of = Window.partitionBy(*group)
    total, n = F.sum(votes).over(of), F.count(F.lit(1)).over(of)
    bounded = parties.withColumns({"__total": total, "__n": n})
    share = lambda shift: F.floor(
        F.coalesce(F.col(votes) * (F.col(seats) + shift) / F.nullif(F.col("__total"), F.lit(0)), F.lit(0.0)) + 0.5
    )
    half = F.col("__n") / 2
    bounded = bounded.withColumn("__low", F.greatest(share(-half) - 1, F.lit(0).cast("long")))
    bounded = bounded.withColumn("__high", F.greatest(share(half) + 1, F.col("__low")))
    given = bounded.withColumn("__given", F.sum("__low").over(of))
    quotients = given.where(F.col(votes) > 0).select(
        *group, order, seats, F.explode(F.sequence("__low", "__high")).alias("__k"),
        F.col(votes).cast("double").alias("__votes"), "__given",
    )
    quotients = quotients.withColumn(
        "__rank",
        F.row_number().over(of.orderBy((F.col("__votes") / (2 * F.col("__k") + 1)).desc(), F.col(order), F.col("__k"))),
    )
    won = quotients.where(F.col("__rank") <= F.col(seats) - F.col("__given")).groupBy(*group, order)
    won = won.agg(F.count(F.lit(1)).alias("__won"))
    quota = F.col("__low") + F.coalesce("__won", F.lit(0))
    result = bounded.join(won, [*group, order], "left").withColumn("quota", quota)
    return result.drop("__total", "__n", "__low", "__high", "__won")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: int) -> DataFrame:
    """One row per source: position, source_size, target and the size of all sources.

    Positions follow code points, null last. A target is the source's weighted part, at most
    ``limit`` times its size; what is above is shared by weight among the others, which ends at one
    common level per unit of weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    sources = sources.withColumn("position", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("position") - 1) % len(weights) + 1)
    sources = sources.withColumns({"weight": weight, "cap": limit * F.col("source_size")})
    sources = sources.withColumns({
        "total": F.sum("source_size").over(everything), "weights": F.sum("weight").over(everything),
        "ratio": F.col("cap") / F.col("weight"),
    })
    before = Window.orderBy("ratio", "position").rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = left / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    sources = sources.withColumn("level", level)
    fits = F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "position", "level"))
    sources = sources.withColumn("common", F.min(fits).over(everything)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("common"))
    return sources.select("source", "position", "source_size", "total", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, limit: int = 2,
    block_words: int = 16, seed: str = "mix", keep: tuple[str, ...] = (),
) -> DataFrame:
    """What a mix takes of every document: doc_id, source, size, source_size, target, taken and its parts.

    ``size`` is the number of words ``[^\\x20\\x09-\\x0D]+`` (null: 0), ``target`` the words to take
    from the document's source, ``taken`` the words taken of this one, repeats counted: ``copies``
    whole passes, ``n_first`` words from word ``first`` on, and ``n_second`` words from its begin.
    A source's taken words are its quota of blocks, so within half a block of the target (a source
    near its limit may miss a block for each cell). No document exceeds ``limit`` times its size,
    for which ``share`` must not exceed ``limit``. The choice depends on the rows and ``seed`` alone.

    A null source is a source of its own, after all others. A null ``doc_id`` is an id. Repeated rows
    are documents of their own. Sizes of zero take nothing; an empty table gives no row. Only the
    columns named are read; ``keep`` are carried along.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"), *keep,
    )
    sized = durable(sized) if not keep else sized
    sources = durable(source_targets(sized if not keep else sized.select("source", "size"), weights, share, limit))
    total, = sources.agg(F.max("total")).first()
    blocks = int(share * (total or 0) / block_words + 0.5)
    sources = apportion(sources.withColumn("blocks", F.lit(blocks).cast("long")), [], "target", "blocks", "position")
    words = max(CELL_WORDS, -(-(total or 0) // CELLS))
    sources = sources.select(
        F.col("source").alias("__source"), "position", "source_size", "target", F.col("quota").alias("source_blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / words)).alias("cells"),
    )
    dealt = sized.join(sources, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    dealt = dealt.withColumn("cell", F.pmod(_number(F.col("key")), F.col("cells")))

    cells = dealt.groupBy("position", "cell", "source_blocks").agg(F.sum("size").alias("cell_size"))
    cells = apportion(cells, ["position"], "cell_size", "source_blocks", "cell")
    wanted = F.least(F.col("quota") * block_words, limit * F.col("cell_size"))
    start = _number(F.md5(F.concat_ws(":", F.lit(seed), "position", "cell"))) % F.col("cell_size")
    cells = cells.where("cell_size > 0").select(
        "position", "cell", "cell_size", wanted.alias("wanted"), start.alias("begin"),
    ).withColumns({
        "copies": F.expr("wanted div cell_size"), "run": F.expr("wanted % cell_size"),
    })
    placed = dealt.join(cells, ["position", "cell"], "left")
    order = Window.partitionBy("position", "cell").orderBy(F.substring("key", 9, 24), "doc_id", "size")
    end = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = placed.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    zero = F.lit(0).cast("long")
    first = F.greatest(F.col("begin"), F.col("start"))
    until = F.col("begin") + F.col("run")
    placed = placed.withColumns({
        "copies": F.coalesce("copies", zero),
        "first": F.coalesce(first - F.col("start"), zero),
        "n_first": F.coalesce(F.greatest(F.least(F.col("end"), until) - first, zero), zero),
        "n_second": F.coalesce(
            F.greatest(F.least(F.col("end"), until - F.col("cell_size")) - F.col("start"), zero), zero
        ),
    })
    taken = F.col("copies") * F.col("size") + F.col("n_first") + F.col("n_second")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
        "copies", "first", "n_first", "n_second", *keep,
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of documents: a row for each whole copy, and one for each part.

    A part is its words with single spaces between; a document taken as a whole keeps its text.
    """
    plan = mix_sources(docs, keep=("text", "lang"), **options)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    part = lambda first, n: F.when(F.col(n) == F.col("size"), F.col("text")).otherwise(
        F.array_join(F.slice(words, first + 1, F.col(n)), " ")
    )
    some = lambda first, n: F.when(F.col(n) > 0, F.array(part(first, n))).otherwise(F.array().cast("array<string>"))
    texts = F.concat(
        F.array_repeat("text", F.col("copies").cast("int")),
        some(F.col("first"), "n_first"), some(F.lit(0), "n_second"),
    )
    mixed = plan.where("taken > 0").select("doc_id", F.explode(texts).alias("text"), "lang", "source")
    return mixed.withColumn("n_chars", F.length("text").cast("long"))
