"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree (native).

Every source's documents are put in a fixed random order (md5 of id, source and size) and cut into
blocks of about ``block_docs``. A source's target fixes its quota of block draws: whole passes over the
source, then the leading blocks of one more pass, whose documents are taken up to the one at the target,
and that one whole or not at all, whichever comes nearer. The exact quotas are split among the output shards,
from the root of a binary tree down: at each node the left child's share of every source is drawn from the
multivariate hypergeometric distribution given by both children's capacities. A shard's draws of a source are
disjoint, contiguous runs of the permuted blocks; a document is in the mix once for each draw of its block that
takes it. A draw's place, a hash of the document's ``local_key``, its text and the number of the draw, orders a
shard: the local shuffle, in which the mix's documents are laid out. The tree has as many levels as leave about
``SHARD_DOCS`` documents a shard, 4 at least.

Only DataFrame functions are used. No window holds a whole source: prefix sums over blocks go through
super-blocks, documents meet only their own block, and draws find their shard in cells of ``CELL`` draws.
A node of the tree is one row with a count for each source, so sources may number in the thousands.

Defined cases: a null source is a source of its own, last in order; null or empty text has size 0 and
is taken 0 times (the mix repeats it with the whole passes); rows that repeat are separate documents; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, materialize, tidied

WORD = r"[^\x20\x09-\x0D]+"
SUPER, CELL = 256, 256
SHARD_DOCS = 1 << 17


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _lgamma(x: Column) -> Column:
    """log Gamma for x >= 1 by Stirling's series after a shift by 4 (error under 1e-9)."""
    return _let(x, lambda x: _let(x + 4.0, lambda y: (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) - F.log(x * (x + 1.0) * (x + 2.0) * (x + 3.0))))


def _hypergeometric(good: Column, total: Column, draws: Column, u: Column) -> Column:
    """Inverse-CDF draw of how many of ``draws`` are among ``good`` of ``total`` (longs).

    The support is walked within 9 standard deviations of the mean (mass outside is below 1e-16)."""

    def weight(p: Column, k: Column) -> Column:
        return -_lgamma(k + 1.0) - _lgamma(p["g"] - k + 1.0) - _lgamma(p["d"] - k + 1.0) - _lgamma(p["n"] - p["g"] - p["d"] + k + 1.0)

    def spread(p: Column) -> Column:
        sd = F.sqrt(F.greatest(p["mean"] * (1 - p["g"] / p["n"]) * (p["n"] - p["d"]) / F.greatest(p["n"] - 1, F.lit(1.0)), F.lit(0.0)))
        return F.struct(p["g"].alias("g"), p["n"].alias("n"), p["d"].alias("d"), p["mean"].alias("mean"), p["least"].alias("least"), p["most"].alias("most"), (9 * sd + 2).alias("wide"))

    def ends(p: Column) -> Column:
        lo = F.greatest(p["least"], F.floor(p["mean"] - p["wide"])).cast("long")
        hi = F.least(p["most"], F.ceil(p["mean"] + p["wide"])).cast("long")
        mode = F.least(p["most"], F.greatest(p["least"], F.floor(p["mean"]))).cast("double")
        return F.struct(p["g"].alias("g"), p["n"].alias("n"), p["d"].alias("d"), lo.alias("lo"), F.greatest(lo, hi).alias("hi"), weight(p, mode).alias("top"))

    def pick(p: Column) -> Column:
        steps = F.transform(F.sequence(p["lo"], p["hi"]), lambda k: F.exp(weight(p, k.cast("double")) - p["top"]))
        return _let(steps, lambda w: _let(u * F.aggregate(w, F.lit(0.0), lambda a, x: a + x), lambda goal: p["lo"] + F.aggregate(
            w,
            F.struct(F.lit(0.0).alias("cum"), F.lit(0).cast("long").alias("n")),
            lambda a, x: F.struct((a["cum"] + x).alias("cum"), (a["n"] + F.when(a["cum"] + x < goal, 1).otherwise(0)).cast("long").alias("n")),
        )["n"]))

    g, n, d = good.cast("double"), F.greatest(total.cast("double"), F.lit(1.0)), draws.cast("double")
    start = F.struct(g.alias("g"), n.alias("n"), d.alias("d"), (g * d / n).alias("mean"), F.greatest(F.lit(0).cast("long"), draws - total + good).alias("least"), F.least(good, draws).alias("most"))
    drawn = _let(start, lambda p: _let(spread(p), lambda p: _let(ends(p), pick)))
    return F.greatest(F.greatest(F.lit(0).cast("long"), draws - total + good), F.least(F.least(good, draws), drawn))


def source_targets(sources: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sources(skey, source, source_size)`` with ``target``: shares by weight, capped at ``most`` times
    the source's size; what a cap frees is dealt again by weight (water filling, in closed form)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("w"))
    by = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = (
        s.withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("w_left"))
        .withColumn("capped", F.col("ratio") <= F.col("level"))
    )
    # the level at the first source that isn't capped holds for all that follow
    first = F.max(F.when(~F.col("capped"), F.struct(-F.col("ratio"), F.col("w_left"), F.col("level")))).over(everything)["level"]
    return s.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.col("w") * first).cast("double")).select(*sources.columns, "target")


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """``quotas(skey, draws)`` split exactly among ``2**levels`` shards: rows ``(skey, shard, n)``.

    A node is one row with its sources' counts; a level turns each node into its two children."""
    part = "array<struct<skey:string,n:bigint>>"
    nodes = quotas.filter("draws > 0").agg(F.array_sort(F.collect_list(F.struct("skey", F.col("draws").alias("n")))).cast(part).alias("have"))
    nodes = nodes.select(F.lit(0).cast("long").alias("node"), "have", F.aggregate("have", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("total"))
    for level in range(levels):
        width, shards = 1 << (levels - level), 1 << levels

        def before(shard: Column) -> Column:
            return F.floor(shard * F.col("total") / shards).cast("long")

        first = F.col("node") * width
        left = before(first + width // 2) - before(first)
        there = before(first + width) - before(first)

        def draw(a: Column, x: Column) -> Column:
            u = (F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("node"), x["skey"]), F.lit(1 << 52)) + 0.5) / float(1 << 52)  # noqa: B023
            return _let(_hypergeometric(x["n"], a["all"], a["left"], u), lambda take: F.struct(
                (a["all"] - x["n"]).alias("all"), (a["left"] - take).alias("left"),
                F.concat(a["out"], F.array(F.struct(x["skey"].alias("skey"), x["n"].alias("n"), take.alias("take")))).alias("out"),
            ))

        empty = F.array().cast("array<struct<skey:string,n:bigint,take:bigint>>")
        drawn = F.aggregate("have", F.struct(there.alias("all"), left.alias("left"), empty.alias("out")), draw)["out"]

        def child(d: Column, right: bool) -> Column:
            mine = F.transform(d, lambda x: F.struct(x["skey"].alias("skey"), (x["n"] - x["take"] if right else x["take"]).alias("n")))
            return F.struct((F.col("node") * 2 + int(right)).alias("node"), F.filter(mine, lambda x: x["n"] > 0).cast(part).alias("have"))

        nodes = nodes.select("total", F.explode(_let(drawn, lambda d: F.array(child(d, False), child(d, True)))).alias("x")).select("x.*", "total")  # noqa: B023
        if level % 4 == 3 and level + 1 < levels:
            nodes = nodes.repartition("node")
    return nodes.select(F.col("node").alias("shard"), F.explode("have").alias("x")).select("x.skey", "shard", "x.n")


def _sized(docs: DataFrame, carry: list[str]) -> DataFrame:
    """Rows with source key, size and permutation key; ``carry`` keeps the named input columns as ``in_*``."""
    d = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.xxhash64("text").alias("body"),
        *[F.col(c).alias(f"in_{c}") for c in carry],
    )
    text = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("source"), F.lit("")), F.col("size").cast("string"))
    return d.withColumn("skey", F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))).withColumn("key", F.md5(text.cast("binary")))


def _blocked(d: DataFrame, per_source: DataFrame, n_sources: int) -> DataFrame:
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    return d.join(bounded(per_source.select("skey", "n_blocks"), n_sources), "skey").withColumn("block", F.floor(place * F.col("n_blocks") / F.lit(1 << 32)).cast("long")).drop("n_blocks")


def _shards_of(draws: DataFrame, shares: DataFrame) -> DataFrame:
    """``draws(skey, block, draws)``, arrays of draw numbers, with ``shards``: the shard that holds each, by ``shares(skey, shard, n)``."""
    upto = Window.partitionBy("skey").orderBy("shard")
    runs = shares.withColumn("to", F.sum("n").over(upto)).withColumn("cell", F.explode(F.sequence(F.floor((F.col("to") - F.col("n")) / CELL), F.floor((F.col("to") - 1) / CELL))))
    cells = runs.groupBy("skey", "cell").agg(F.array_sort(F.collect_list(F.struct("to", "shard"))).alias("runs"))
    each = draws.select("skey", "block", F.posexplode("draws").alias("nth", "draw")).withColumn("cell", F.floor(F.col("draw") / CELL))
    there = each.join(cells, ["skey", "cell"]).withColumn("shard", F.filter("runs", lambda x: F.col("draw") < x["to"])[0]["shard"].cast("int"))
    return there.groupBy("skey", "block").agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "shard"))), lambda x: x["shard"]).alias("shards"))


@tidied
def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, shard_levels: int | None = None, block_docs: int = 64, seed: int = 7, carry: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, block, shards, places, draws, local_key and ``in_*``.

    ``draws`` are the shard of each draw of the document's block that takes the document, whole passes first, with
    the draw's place there; ``taken`` is its size times their number; ``shards`` and ``places`` are those of
    documents that have words."""
    sized = materialize(_sized(docs, []), "mix-sizes")
    per_source = materialize(
        sized.groupBy("skey", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")).withColumn("n_blocks", F.ceil(F.col("n_docs") / block_docs).cast("long")),
        "mix-sources",
    )
    n_sources, n_docs = per_source.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    levels = levels_for(n_docs * share) if shard_levels is None else shard_levels
    targets = source_targets(per_source, weights, share, most)
    goal = F.round("target").cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    targets = materialize(targets.withColumn("passes", F.floor(goal / size).cast("long")).withColumn("rest", goal - F.col("passes") * F.col("source_size")), "mix-targets")

    placed = _blocked(sized, per_source, n_sources)
    blocks = materialize(placed.groupBy("skey", "block").agg(F.sum("size").alias("words")).withColumn("upper", F.floor(F.col("block") / SUPER).cast("long")), "mix-blocks")
    upper = blocks.groupBy("skey", "upper").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("skey").orderBy("upper").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.select("skey", "upper", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"))
    inside = Window.partitionBy("skey", "upper").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocks.withColumn("w1", F.coalesce(F.sum("words").over(inside), F.lit(0))).withColumn("c1", F.coalesce(F.count("words").over(inside), F.lit(0)))
        .join(upper, ["skey", "upper"])
        .select("skey", "block", (F.col("w0") + F.col("w1")).alias("first_word"), (F.col("c0") + F.col("c1")).alias("rank"))
    )
    blocks = materialize(blocks.join(bounded(targets, n_sources), "skey"), "mix-ranks")

    drawn = blocks.groupBy("skey").agg(
        (F.first("passes") * F.count(F.lit(1)) + F.sum((F.col("first_word") < F.col("rest")).cast("long"))).alias("draws"), F.count(F.lit(1)).alias("blocks_there")
    )
    drawn = materialize(drawn, "mix-quotas")
    shares = materialize(split_quotas(drawn.select("skey", "draws"), levels, seed), "mix-shares")
    passes = F.col("passes") + (F.col("first_word") < F.col("rest")).cast("long")
    numbers = F.when(passes > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(passes - 1, F.lit(0).cast("long"))), lambda t: t * F.col("blocks_there") + F.col("rank")))
    numbered = blocks.join(bounded(drawn.select("skey", "blocks_there"), n_sources), "skey").select("skey", "block", numbers.alias("draws"))
    blocks = blocks.join(_shards_of(numbered, shares), ["skey", "block"], "left").select(
        "skey", "block", "source_size", "target", "passes", "rest", "first_word", F.coalesce("shards", F.array().cast("array<int>")).alias("block_shards")
    )
    blocks = materialize(blocks, "mix-plan")
    rows = placed if not carry else _blocked(_sized(docs, list(carry)), per_source, n_sources)
    inside = Window.partitionBy("skey", "block").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("in_block", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(blocks, ["skey", "block"])
    # of the last pass, what lies by its larger part before the rest
    partial = (F.col("size") > 0) & (2 * (F.col("first_word") + F.col("in_block")) + F.col("size") < 2 * F.col("rest"))
    rows = rows.withColumn("local_key", F.md5(F.concat_ws("|", F.lit(str(seed)), "key").cast("binary")))
    to = F.slice("block_shards", F.lit(1), (F.col("passes") + partial.cast("long")).cast("int"))
    draws = F.transform(to, lambda s, i: F.struct(s.alias("shard"), F.xxhash64("local_key", "body", i).alias("place")))
    rows = rows.withColumn("draws", draws)

    def taking(field: str, kind: str) -> Column:
        return F.when(F.col("size") == 0, F.array().cast(kind)).otherwise(F.col("draws")[field])

    return rows.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("draws")).cast("long").alias("taken"), "passes", "block",
        taking("shard", "array<int>").alias("shards"), taking("place", "array<bigint>").alias("places"), "draws", "local_key", *[f"in_{c}" for c in carry],
    )


def levels_for(draws: float) -> int:
    """Levels of the tree that leave about ``SHARD_DOCS`` documents a shard."""
    return max(4, math.ceil(math.log2(max(1.0, draws / SHARD_DOCS))))


@tidied
def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of documents: each draw repeats its row.

    Partitions are consecutive stretches of the shards, each in order of its places; large shards have several."""
    names = docs.columns
    got = mix(docs, carry=tuple(names), **options)
    rows = got.select("*", F.explode("draws").alias("x")).select("x.shard", "x.place", *[f"in_{c}" for c in names])
    levels = options.get("shard_levels") or levels_for(docs.count() * options.get("share", 1.5))
    shards = 1 << levels
    each = max(1, -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards))
    part = F.floor((F.shiftright("place", 32) + (1 << 31)) * each / F.lit(1 << 32))  # the place's stretch of its shard
    laid = rows.repartitionById(shards * each, (F.col("shard") * each + part).cast("int")).sortWithinPartitions("shard", "place")
    return laid.select(*[F.col(f"in_{c}").alias(c) for c in names])
