"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target of words. Its rate, target over size, splits into whole copies of
every document, which are certain, and a rest that is sampled: documents are ranked by the
odds of a random number over their inclusion odds, and the first of them are taken until the
rest is filled. The sample is fixed in size, measured in words, and longer documents are
likelier in it, which is what spares the mix a long tail of fragments.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import document_keys, join_small, stored, words


@dataclass(frozen=True)
class MixConfig:
    """``share`` of all words to take; ``cap``: most copies of a document; ``weights`` repeat over the sources.

    ``reach``: so many documents from the first one that does not fit are tried in one pass over a source; passes
    go on until nothing left fits, so it changes no result.
    """

    share: float = 1.5
    cap: float = 2.0
    weights: tuple[int, ...] = (3, 1, 2)
    reach: int = 1000
    rows_per_bucket: int = 1000
    seed: str = "mix"


def random_number(seed: str) -> Column:
    """52 random bits of a document as a number strictly between 0 and 1, the same in every run.

    From id and text, so that documents without an id, or with one id, draw for themselves.
    """
    named = f"concat('{seed}:', coalesce(CAST(doc_id AS STRING), 'null'), ':', md5(coalesce(text, '')))"
    return F.expr(f"(CAST(conv(substr(md5({named}), 1, 13), 16, 10) AS BIGINT) + 0.5D) / 4503599627370496D")


def sized(docs: DataFrame, config: MixConfig) -> DataFrame:
    """``docs`` with ``size`` (words), ``draw`` and the keys ``id`` and ``twin``; equal ones are equal rows of one source."""
    id_, twin = document_keys(F.col("source").isNull(), F.col("source"))
    return docs.withColumns(
        {"size": F.size(words(F.col("text"))).cast("long"), "draw": random_number(config.seed), "id": id_, "twin": twin}
    )


def source_targets(sizes: DataFrame, config: MixConfig) -> DataFrame:
    """One row per source: source_size, target, whole copies, quota of words for the sample, mean size, buckets.

    Targets rise together in proportion to the weights; a source leaves at its cap and the others go on. With the
    sources in order of cap per weight, the common level is the largest that any source would need if it were
    the first one not capped. The windows run over sources, one row each, not over documents.
    """
    everywhere = Window.partitionBy()
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, config.weights)), (rank % len(config.weights) + 1).cast("int"))
    weighted = (
        totals.withColumn("weight", weight)
        .withColumn("room", F.lit(config.cap) * F.col("source_size"))
        .withColumn("fullness", F.col("room") / F.col("weight"))
        .withColumn("wanted", F.least(F.lit(config.share), F.lit(config.cap)) * F.sum("source_size").over(everywhere))
        .withColumn("all_docs", F.sum("source_docs").over(everywhere))
    )
    order = Window.orderBy("fullness", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("wanted") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    target = F.least("room", F.max("level").over(everywhere) * F.col("weight"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        weighted.withColumn("level", level)
        .withColumn("target", target)
        .withColumn("rate", copies)
        .withColumn("whole", F.floor("rate"))
        .withColumn("part", F.col("rate") - F.col("whole"))
        .withColumn("quota", F.floor(F.col("target") - F.col("whole") * F.col("source_size")))
        .withColumn("mean_size", F.col("source_size") / F.col("source_docs"))
        .withColumn("buckets", F.greatest(F.lit(64), F.ceil(F.col("all_docs") / config.rows_per_bucket)))
        .select("source", "source_size", "target", "whole", "part", "quota", "mean_size", "buckets")
    )


def ranked(rows: DataFrame, targets: DataFrame, config: MixConfig) -> DataFrame:
    """``rows`` (source, draw, size) with their source's targets, ``rank_key`` and its ``bucket`` in rank order.

    A key q falls into the bucket of q / (1 + q), which grows with q and stays below 1.
    """
    known = rows.join(targets, rows["source"].eqNullSafe(targets["source"]), "left").drop(targets["source"])
    draw = F.col("draw")
    odds = F.col("part") / (1 - F.col("part")) * F.sqrt(F.col("size") / F.col("mean_size"))
    key = F.when((F.col("size") > 0) & (F.col("part") > 0), draw / (1 - draw) / odds)
    return known.withColumn("rank_key", key).withColumn(
        "bucket", F.least(F.floor(F.col("rank_key") / (1 + F.col("rank_key")) * F.col("buckets")), F.col("buckets") - 1)
    )


def boundaries(pool: DataFrame, config: MixConfig) -> DataFrame:
    """Per source the bucket in which what is left runs out, the words left there, and the last bucket of this pass.

    ``pool``: documents not decided yet, none larger than the ``left`` of its source. No row: all of them fit.
    """
    bucketed = pool.groupBy("source", "bucket", "left").agg(
        F.sum("size").alias("bucket_words"), F.count(F.lit(1)).alias("bucket_docs")
    )
    upto = Window.partitionBy("source").orderBy("bucket")
    summed = bucketed.withColumns(
        {"words_upto": F.sum("bucket_words").over(upto), "docs_upto": F.sum("bucket_docs").over(upto)}
    ).withColumn("over", F.col("words_upto") > F.col("left"))
    first = summed.filter("over").groupBy("source").agg(
        F.min_by(F.struct("bucket", (F.col("left") - F.col("words_upto") + F.col("bucket_words")).alias("left"),
                          "docs_upto"), "bucket").alias("first")
    ).select("source", "first.*")
    ends = summed.alias("s").join(first.alias("f"), F.col("s.source").eqNullSafe(F.col("f.source"))).filter(
        "s.docs_upto - s.bucket_docs < f.docs_upto + " + str(config.reach)
    )
    return ends.groupBy(F.col("f.source").alias("source"), F.col("f.bucket").alias("first_bucket"), "f.left").agg(
        F.max("s.bucket").alias("last_bucket")
    )


def fill(tail: DataFrame) -> DataFrame:
    """(source, last_bucket, left, docs, extra) of the few buckets of a pass: documents in order, if they fit.

    A source gathers the documents of these buckets only, about rows_per_bucket + reach.
    """
    listed = tail.groupBy("source", "last_bucket", "left").agg(
        F.sort_array(F.collect_list(F.struct("rank_key", "id", "size", "twin"))).alias("docs")
    )
    step = (
        "aggregate(docs, struct(left AS left, CAST(array() AS ARRAY<INT>) AS extra), "
        "(a, d) -> CASE WHEN d.size <= a.left THEN struct(a.left - d.size AS left, concat(a.extra, array(1)) AS extra) "
        "ELSE struct(a.left AS left, concat(a.extra, array(0)) AS extra) END)"
    )
    return listed.withColumn("end", F.expr(step)).select("source", "last_bucket", "end.left", "docs", "end.extra")


def passes(keyed: DataFrame, targets: DataFrame, config: MixConfig) -> tuple[DataFrame, DataFrame]:
    """(source, passes) and (id, twin, extra) of the documents that were looked up.

    Each pass takes a source's buckets up to the one where what is left runs out, fills that one and a few more in
    order, and leaves the later ones to the next, which sees only documents that still fit. A pass is a scan of
    narrow rows. It holds ``after`` and ``last``, its buckets, ``first``, from where documents are looked up, and
    ``left`` at its start.
    """
    done, looked_up = [], []
    state = targets.select("source", F.lit(-1).cast("long").alias("after"), F.col("quota").alias("left"))
    while True:
        pool = keyed.join(state.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        pool = pool.drop("_source").filter("rank_key IS NOT NULL AND bucket > after AND size <= left")
        limits = stored(boundaries(pool, config), "limits").withColumnsRenamed({"source": "_source", "left": "_left"})
        done.append(
            state.join(limits, state["source"].eqNullSafe(limits["_source"]), "left").select(
                "source", F.struct("after", F.col("first_bucket").alias("first"), F.col("last_bucket").alias("last"), "left").alias("pass")
            )
        )
        if limits.isEmpty():
            break
        tail = pool.drop("left").join(limits, F.col("source").eqNullSafe(F.col("_source"))).withColumnRenamed("_left", "left")
        filled = stored(fill(tail.filter("bucket BETWEEN first_bucket AND last_bucket")), "filled")
        looked_up.append(filled.select(F.explode(F.arrays_zip("docs", "extra")).alias("row")).select(
            "row.docs.id", "row.docs.twin", "row.extra"
        ))
        state = filled.select("source", F.col("last_bucket").alias("after"), "left")
    every = reduce(DataFrame.unionAll, done).groupBy("source").agg(F.collect_list("pass").alias("passes"))
    none = keyed.filter("false").select("id", "twin", F.lit(0).alias("extra"))
    return stored(every, "passes"), stored(reduce(DataFrame.unionAll, looked_up, none), "looked_up")


def decide(sizes: DataFrame, rows: DataFrame, config: MixConfig) -> DataFrame:
    """``rows`` (source, size, draw, id, twin and any others) with source_size, target and ``copies``.

    ``sizes`` holds the same documents, stored. Equal rows count as one document with all their words. What fits
    below the bucket where a pass runs out is taken, and the documents from there to its end are looked up.
    """
    targets = stored(source_targets(sizes, config), "targets")
    once = sizes.groupBy("source", "id", "twin").agg(F.first("size").alias("size"), F.first("draw").alias("draw"), F.count(F.lit(1)).alias("rows"))
    once = stored(once, "once")
    keyed = ranked(once, targets, config).withColumn("size", F.col("size") * F.col("rows")).drop("rows")
    limits, filled = passes(keyed, targets, config)
    repeated = stored(once.filter("rows > 1").select("id", "twin", "rows"), "repeated")
    placed = ranked(rows, targets, config)
    placed = placed.join(limits, placed["source"].eqNullSafe(limits["source"]), "left").drop(limits["source"])
    placed = join_small(placed, repeated, ["id", "twin"], "left")
    total = F.col("size") * F.coalesce("rows", F.lit(1))
    found = join_small(placed, filled, ["id", "twin"], "left").withColumn(
        "pass", F.expr("filter(passes, p -> bucket > p.after AND (p.last IS NULL OR bucket <= p.last))[0]")
    )
    # beyond the last pass nothing fits; a pass without a boundary takes all that fits at its start
    extra = F.when(F.col("rank_key").isNull() | F.col("pass").isNull() | (total > F.col("pass.left")), 0).when(
        F.col("pass.first").isNull() | (F.col("bucket") < F.col("pass.first")), 1
    ).otherwise(F.coalesce("extra", F.lit(0)))
    return found.withColumn("copies", (F.coalesce("whole", F.lit(0)) + extra).cast("long"))


def mix_sources(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, the words the mix takes of it.

    Null text: size 0, nothing taken. Null source: a source, last in order. Documents of a null or repeated id draw
    for themselves. Rows equal in id, text and source are taken together, if all of them fit. Empty table, or only empty
    texts: targets 0. A source ends where no document left out fits below its target. Only doc_id, text and source are read.
    """
    sizes = stored(sized(docs.select("doc_id", "text", "source"), config).drop("text"), "sizes")
    return decide(sizes, sizes, config).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mix_documents(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix itself: rows of ``docs`` with exactly their columns, each as often as it is taken.

    Empty texts are in it as often as the whole copies of their source say. Null ids and repeated rows as in ``mix_sources``.
    """
    sizes = stored(sized(docs.select("doc_id", "text", "source"), config).drop("text"), "sizes")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "doc_id", "text", "source")
    decided = decide(sizes, sized(rows, config).drop("text"), config).filter("copies > 0")
    return decided.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("doc.*")
