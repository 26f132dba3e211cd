"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sources in code point order (null last) weigh ``weights``, repeating, and share the words of
all documents. No target is above ``most`` times its source's words; what is left over is
shared by weight among the others until none is above.

Within a source at rate r = target / words, every document gets floor(r) certain whole copies.
The rest f of the rate is a Pareto order sample. A document of s words in a source whose documents
have m words on average has inclusion odds f / (1 - f) * m / (m + s): longer ones are less likely,
so that the same words come from more documents. It draws u from a hash of its id, its rank is the
odds of u over its inclusion odds, and documents are taken by ascending rank for as long as that
brings the words nearer to what is wanted; a cut anywhere multiplies all inclusion odds of the
source by one number and leaves their proportions. Documents of more than a fiftieth of what is
wanted are a stratum of their own, sampled first up to its share of the words, and the others
make up what is missing, so that one long document does not decide how near a source comes. The
last one of that stratum is whichever of those left lets the others come nearest, if any does.

The place where a source's ranks are cut off is found by radix selection: sums by rank digit,
4,096 of them for each source, then within one digit. No task ever holds a source's documents,
whatever its share, and texts are read once.

Defined cases: a null text has size 0, and a size of 0 is taken 0 times whatever its copies.
A null source is a source, the last. An empty table gives an empty mix. Rows with the same
doc_id draw the same number, and those of one size are taken or left together; a null doc_id
counts as one id. Reruns agree, as nothing but ids, sources and sizes decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.worktables import WorkTables

WORD = r"[^\x20\x09-\x0D]+"
# ranks have two digits of 12 bits; what shares both is told apart by the draw itself
DIGIT = 1 << 12
RANKS = DIGIT * DIGIT
LARGE = 50


def draw(doc_id: Column) -> Column:
    """A number in (0, 1) with 48 random bits from the id's text."""
    text = F.coalesce(doc_id.cast("string"), F.lit("null"))
    bits = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 48))


def word_count(text: Column) -> Column:
    """The words of a text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _with_sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column], work: WorkTables, name: str) -> DataFrame:
    """Sums over all rows that come earlier in ``order``, without one task for all rows.

    By range of the order, and within the range; only the totals of ranges, one for each
    partition, meet in a task.
    """
    ranged = work.store(
        rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), name
    )
    parts = ranged.groupBy("part").agg(*[F.sum(c).alias(f"{n}_all") for n, c in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", *[F.coalesce(F.sum(f"{n}_all").over(earlier), F.lit(0)).alias(f"{n}_base") for n in sums])
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select("*", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"{n}_in") for n, c in sums.items()])
    return inside.join(base, "part").select(
        *rows.columns, *[(F.col(f"{n}_base") + F.col(f"{n}_in")).alias(n) for n in sums]
    )


def source_targets(sized: DataFrame, work: WorkTables, weights: tuple[int, ...], most: int) -> DataFrame:
    """number, source, source_size, mean_size and target of every source of (source, size).

    Sources are ordered by cap over weight. If the first k of them stop at their caps, the others
    share what is left by weight; the true share is the greatest of these over all k.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.avg("size").alias("mean_size"))
    by_source = [F.col("source").asc_nulls_last()]
    numbered = _with_sums_before(sums, by_source, {"number": F.lit(1).cast("long")}, work, "sources")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int"))
    weighed = work.store(
        numbered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most), "weighed"
    )
    total, heavy = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    by_cap = [F.col("cap") / F.col("weight"), F.col("number")]
    earlier = {"cap_before": F.col("cap"), "weight_before": F.col("weight")}
    shares = (F.lit(total or 0) - F.col("cap_before")).cast("double") / (F.lit(heavy or 0.0) - F.col("weight_before"))
    share = _with_sums_before(weighed, by_cap, earlier, work, "by-cap").agg(F.max(shares)).first()[0]
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(share or 0.0))
    return weighed.select("number", "source", "source_size", "mean_size", target.alias("target"))


def _first_above(sums: DataFrame, name: str) -> DataFrame:
    """The first digit of each source at which the running sum goes above the budget."""
    running = F.sum("words").over(Window.partitionBy("number").orderBy("digit"))
    return (
        sums.withColumn("running", running + F.col("base"))
        .where((F.col("running") > F.col("budget")) & (F.col("running") - F.col("words") <= F.col("budget")))
        .select("number", "budget", F.col("digit").alias(name), (F.col("running") - F.col("words")).alias("base"))
    )


def _cutoff(rows: DataFrame, budgets: DataFrame, work: WorkTables, name: str, fit: bool) -> DataFrame:
    """Where the ranks of each source are cut off, and what is picked from there on.

    ``rows`` has number, rank, u, id and size; ``budgets`` has number, budget, goal and rest.
    What ranks before the cut fits into the budget. Then one more is picked if that helps: the
    next one or, with ``fit``, whichever of all that follow; it is the one after which ``rest``
    more words can come nearest to ``goal``, then the one nearest to ``budget``, then the first.
    A source whose rows all fit has no row in the result.
    """
    high = rows.groupBy("number", F.floor(F.col("rank") / DIGIT).alias("digit")).agg(F.sum("size").alias("words"))
    first = work.store(
        _first_above(
            high.join(budgets.select("number", "budget"), "number").withColumn("base", F.lit(0).cast("long")), "high"
        ),
        f"{name}-high",
    )
    inside = rows.join(first, "number").where(F.floor(F.col("rank") / DIGIT) == F.col("high"))
    low = inside.groupBy("number", "high", "budget", "base", F.col("rank").alias("digit")).agg(
        F.sum("size").alias("words")
    )
    second = work.store(_first_above(low, "cut"), f"{name}-low")
    # what shares its rank with the cut
    ties = rows.join(second, "number").where(F.col("rank") == F.col("cut"))
    peers = ties.groupBy("number", "cut", "budget", "base", "u", "id").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("number").orderBy("u", "id"))
    edge = (
        peers.withColumn("running", running + F.col("base"))
        .where((F.col("running") > F.col("budget")) & (F.col("running") - F.col("words") <= F.col("budget")))
    )
    edge = work.store(
        edge.join(budgets.select("number", "goal", "rest"), "number").select(
            "number", F.struct(F.col("cut").alias("rank"), "u", "id").alias("cut"), "words",
            (F.col("running") - F.col("words")).alias("before"), "budget", "goal", "rest",
        ),
        f"{name}-edge",
    )
    after = edge.select("number", F.col("cut").alias("place"), "words")
    if fit:
        place = F.struct("rank", "u", "id").alias("place")
        after = (
            rows.join(edge.select("number", "cut"), "number").where(place >= F.col("cut"))
            .groupBy("number", place).agg(F.sum("size").alias("words"))
        )
    total = F.col("before") + F.col("words")
    picks = after.join(edge.drop("words"), "number").select(
        "number", F.struct(*_distance(total), "place", "words").alias("pick")
    )
    best = picks.groupBy("number").agg(F.min("pick").alias("pick"))
    helps = F.struct("pick.error", "pick.far") < F.struct(*_distance(F.col("before")))
    chosen = edge.join(best, "number").withColumn("pick", F.when(helps, F.col("pick")))
    return work.store(
        chosen.select(
            "number", "cut", F.col("pick.place").alias("pick"),
            (F.col("before") + F.coalesce("pick.words", F.lit(0))).alias("got"),
        ),
        f"{name}-cut",
    )


def _distance(words: Column) -> tuple[Column, Column]:
    """How far from goal the words end when up to rest more may come, and how far from budget."""
    over = F.greatest(F.lit(0.0), words - F.col("goal"))
    short = F.greatest(F.lit(0.0), F.col("goal") - words - F.col("rest"))
    return (over + short).alias("error"), F.abs(words - F.col("budget")).alias("far")


def _taken_by_cut() -> Column:
    place = F.struct("rank", "u", "id")
    picked = F.col("pick").isNotNull() & (place == F.col("pick"))
    return F.col("cut").isNull() | (place < F.col("cut")) | picked


def mix_sources(
    documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row.

    ``documents`` has doc_id, text and source. ``copies`` is how often the mix has the row,
    ``taken`` the words that makes.
    """
    spark: SparkSession = documents.sparkSession
    work = WorkTables(spark, "mix")
    sized = work.store(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sized"
    )
    targets = source_targets(sized, work, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(rate), F.lit(most)).cast("long")
    planned = targets.select(
        "number",
        F.col("source").alias("its_source"),
        "source_size",
        "mean_size",
        "target",
        whole.alias("whole"),
        (rate - whole).alias("odds_of"),
        (F.col("target") - whole * F.col("source_size")).alias("wanted"),
    )
    joined = sized.join(planned, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    u, p = draw(F.col("doc_id")), F.col("odds_of")
    source_odds = p / (1 - p)
    inclusion_odds = source_odds * (F.col("mean_size") / (F.col("mean_size") + F.col("size")))
    pareto = (F.col("u") / (1 - F.col("u"))) / inclusion_odds
    # ascending with the Pareto rank; measured by the source's own odds, so that the digits of a
    # source that is taken nearly whole or hardly at all spread like any other's
    scaled = pareto * source_odds
    drawn = (p > 0) & (F.col("size") > 0)
    rank = F.floor(F.when(drawn, scaled / (1 + scaled)).otherwise(F.col("u")) * F.lit(float(RANKS)))
    rows = work.store(
        joined.withColumn("u", u)
        .withColumn("rank", F.least(rank.cast("long"), F.lit(RANKS - 1)))
        .withColumn("large", F.col("size") * LARGE > F.col("wanted"))
        .withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
        "ranked",
    )
    sampled = rows.where((F.col("odds_of") > 0) & (F.col("size") > 0))
    wanted = sampled.groupBy("number", "odds_of", "wanted").agg(
        F.coalesce(F.sum(F.when(F.col("large"), F.col("size"))), F.lit(0)).alias("large_size"),
        F.coalesce(F.sum(F.when(~F.col("large"), F.col("size"))), F.lit(0)).alias("rest"),
    )
    wanted = work.store(wanted, "wanted")
    large = sampled.where("large")
    share = (F.col("odds_of") * F.col("large_size")).alias("budget")
    large_cut = _cutoff(
        large, wanted.select("number", share, F.col("wanted").alias("goal"), "rest"), work, "large", fit=True
    )
    # a source whose large documents all fit has no cut, and has then taken them all
    left = wanted.join(large_cut.select("number", "got"), "number", "left").select(
        "number", (F.col("wanted") - F.coalesce("got", "large_size")).alias("budget")
    )
    # nothing follows the small ones: what they come near to is the budget itself
    ends = left.where("budget >= 0").select("number", "budget", F.col("budget").alias("goal"), F.lit(0).alias("rest"))
    small_cut = _cutoff(sampled.where(~F.col("large")), ends, work, "small", fit=False)
    cuts = large_cut.withColumn("large", F.lit(True)).union(small_cut.withColumn("large", F.lit(False)))
    over = left.where("budget < 0").select("number", F.lit(True).alias("over"))
    chosen = (
        rows.join(cuts, ["number", "large"], "left").join(over, "number", "left")
        .withColumn(
            "extra",
            F.when(
                (F.col("odds_of") > 0) & (F.col("size") > 0) & _taken_by_cut()
                & (F.col("large") | F.col("over").isNull()),
                1,
            ).otherwise(0),
        )
    )
    copies = F.col("whole") + F.col("extra")
    return chosen.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )
