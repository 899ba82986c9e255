"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are permuted by a hash and cut into blocks of about
``block_words`` words.  Its target says how often the permuted sequence of
blocks is run through: whole rounds, and a part of one more.  The part ends
where the words taken come nearest to the target; large documents are settled
first and the small ones make up for what those miss, so documents stay whole.

The exact block quotas of all sources are dealt to the output shards by a
binary tree: the left half of a node's shards gets its share of the node's
blocks, composed as a multivariate-hypergeometric draw, the right half gets the
rest.  The draw is made source by source, by inversion of the hypergeometric
distribution.  Sources may be many: groups of them are dealt first, then the
sources of a group among the blocks that each shard has of the group.  A leaf
owns a run of each source's permuted blocks, disjoint from all others, and its
documents are shuffled locally.  A draw is one that a leaf owns.

All of it is DataFrame code.  Tables with one row per source, or one number per
source and shard that has blocks of it, are broadcast if they are small, which
is measured, and joined with salted keys otherwise.  Only the targets are worked
out in one task, from a few numbers per source.

Defined cases: a NULL text has no words; a NULL source is a source of its own,
the last one; documents without words are drawn as often as their place says
and add nothing; an empty table gives no rows; rows that repeat an id share
their place; other columns are carried along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..limits import DEFAULT, Limits
from ..operators.skew import is_small, skew_join
from ..scratch import materialize
from .common import WORDS

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
MOST = 3  # no document is taken more often
SEED = "mix-1"
BLOCK_WORDS = 16_384
SHARD_WORDS = 8_000_000
MOST_SHARDS = 16_384  # beyond it shards grow, and each is written by several tasks
BUCKETS = 1 << 16  # of the permutation, to find where the last round ends
PARTS = 4  # tasks that write a shard
FAN = 128  # sources that are dealt in one row
_PLACES = 60  # bits of a place in the permutation


def _key(source_col: str) -> Column:
    source = F.col(f"`{source_col}`").cast("string")
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))  # NULL is a key of its own


def word_count(text_col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORDS)).cast("long")


def _place(id_col: str, seed: str) -> Column:
    """The place of a document in its source's permutation: 60 bits of a digest of its id."""
    name = F.concat(F.lit(seed + "|"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def with_places(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: str = SEED) -> DataFrame:
    """Add _key, _size and _place."""
    return docs.withColumns({"_key": _key(source_col), "_size": word_count(text_col), "_place": _place(id_col, seed)})


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: words, documents and the target, of which nothing exceeds ``most`` times the words.

    Sorted by the level at which they are full, the full sources are the first
    ones; the others share the rest by weight.  One row per source is sorted.
    """
    by_name = Window.orderBy(F.col("_key") == "n", "_key")
    level = Window.orderBy(F.col("cap") / F.col("w"), "_key")
    before, after = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = sizes.groupBy("_key").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("docs"))
    per = per.withColumn("w", F.element_at(F.lit(list(weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("long"))
    per = per.withColumn("cap", F.col("words") * most).withColumn("total", F.sum("words").over(every))
    per = per.withColumns(
        {
            "rank": F.row_number().over(level),
            "left": F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "share": F.sum("w").over(after),
        }
    )
    free = F.col("cap").cast("double") * F.col("share") > F.col("w").cast("double") * F.col("left")
    first = F.min(F.when(free, F.struct("rank", "left", "share"))).over(every)
    per = per.withColumn("first", first)
    rest = (F.col("w") * F.col("first.left")).cast("double") / F.col("first.share")
    full = F.col("first").isNull() | (F.col("rank") < F.col("first.rank"))
    return per.select("_key", "words", "docs", "total", F.when(full, F.col("cap").cast("double")).otherwise(rest).alias("target"))


def _ends(rows: DataFrame, goals: DataFrame, buckets: int, limits: Limits, small: bool) -> DataFrame:
    """Where each source's prefix (by place) of about ``goal`` words ends: _key, end, got.

    Sums per bucket of the permutation show the bucket in which it ends; only
    that bucket's documents are put in order.  ``small``: a row per source may be broadcast.
    """
    shift = _PLACES - int(math.log2(buckets))
    bucket = F.shiftright("_place", shift)
    order = Window.partitionBy("_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_key", bucket.alias("bucket")).agg(F.sum("_size").alias("n"))
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    last = (
        skew_join(sums, goals, "_key", "inner", limits, small=small)
        .filter(F.col("before") <= F.greatest("goal", F.lit(0.0)))
        .groupBy("_key", "goal")
        .agg(F.max(F.struct("bucket", "before")).alias("b"))
        .select("_key", "goal", "b.bucket", "b.before")
    )
    last = materialize(last, "mix_last")
    inside = (
        skew_join(rows.withColumn("bucket", bucket), last, ["_key", "bucket"], "inner", limits, small=small)
        .groupBy("_key", "goal", "bucket", "before", "_place")
        .agg(F.sum("_size").alias("n"))
    )
    upto = Window.partitionBy("_key").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(upto), F.lit(0)))
    taken = 2 * F.col("start") + F.col("n") <= 2 * F.col("goal")
    found = inside.groupBy("_key", "bucket", "before").agg(
        F.max(F.when(taken, F.col("_place"))).alias("at"), F.max(F.when(taken, F.col("start") + F.col("n"))).alias("got")
    )
    below = F.col("bucket") * F.lit(1 << shift) - 1
    return found.select("_key", F.coalesce("at", below).alias("end"), F.coalesce("got", "before").alias("got"))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once, however often ``then`` mentions it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _log_factorials(values: list[Column]) -> Column:
    """An array of logarithms of factorials: Stirling's series, and exact values below 16."""
    small = F.lit([math.lgamma(i + 1) for i in range(16)])

    def one(x: Column) -> Column:
        y = x.cast("double")
        large = y * F.ln(y) - y + 0.5 * F.ln(2 * math.pi * y) + 1 / (12 * y) - 1 / (360 * y * y * y)
        return F.when(x < 16, F.element_at(small, F.least(x, F.lit(15)).cast("int") + 1)).otherwise(large)

    return F.transform(F.array(*values), one)


def hypergeometric(u: Column, total: Column, good: Column, drawn: Column) -> Column:
    """The number of good ones among ``drawn`` of ``total``, by inversion at ``u`` in [0, 1).

    The sum starts ten standard deviations below the mean, beyond which nothing counts in doubles.
    """
    given = F.struct(u.alias("u"), total.alias("t"), good.alias("g"), drawn.alias("d"))

    def ends(x: Column) -> Column:
        safe = F.greatest(x["t"], F.lit(2)).cast("double")
        mean = x["d"] * (x["g"] / safe)
        sd = F.sqrt(F.greatest(mean * (1 - x["g"] / safe) * ((safe - x["d"]) / (safe - 1)), F.lit(0.0)))
        low, high = F.greatest(F.lit(0), x["d"] + x["g"] - x["t"]), F.least(x["d"], x["g"])
        span = _let(F.struct(mean.alias("mean"), (10 * sd + 10).alias("far"), low.alias("low"), high.alias("high")), bounds)
        return F.struct(x.alias("x"), span.alias("s"))

    def bounds(m: Column) -> Column:
        first = F.greatest(m["low"], F.floor(m["mean"] - m["far"]).cast("long"))
        last = F.greatest(m["low"], F.least(m["high"], F.ceil(m["mean"] + m["far"]).cast("long")))
        return F.struct(m["low"].alias("low"), m["high"].alias("high"), first.alias("first"), F.greatest(first, last).alias("last"))

    def invert(y: Column) -> Column:
        x, s = y["x"], y["s"]
        t, g, d, k0 = x["t"], x["g"], x["d"], s["first"]
        parts = [g, k0, g - k0, t - g, d - k0, t - g - d + k0, t, d, t - d]
        logs = _log_factorials(parts)
        signs = F.lit([1.0, -1.0, -1.0, 1.0, -1.0, -1.0, -1.0, 1.0, 1.0])
        log_p = F.aggregate(F.zip_with(logs, signs, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

        def step(acc: Column, k: Column) -> Column:
            cum = acc["cum"] + acc["p"]
            ratio = (g - k).cast("double") * (d - k) / ((k + 1).cast("double") * (t - g - d + k + 1))
            hit = acc["at"].isNull() & (x["u"] < cum)
            return F.struct((acc["p"] * ratio).alias("p"), cum.alias("cum"), F.when(hit, k).otherwise(acc["at"]).alias("at"))

        start = F.struct(F.exp(log_p).alias("p"), F.lit(0.0).alias("cum"), F.lit(None).cast("long").alias("at"))
        found = F.aggregate(F.sequence(k0, s["last"]), start, step)["at"]
        return F.when(s["low"] >= s["high"], s["low"]).otherwise(F.coalesce(found, s["last"]))

    return _let(_let(given, ends), invert)


def _draw(quotas: Column, room: Column, name: Column) -> Column:
    """A multivariate-hypergeometric draw of ``room`` blocks from ``quotas`` (an array), source by source."""
    whole = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)

    def step(acc: Column, i: Column) -> Column:
        q = F.element_at(quotas, i)
        u = F.shiftrightunsigned(F.xxhash64(name, i), 11) / float(1 << 53)

        def after(x: Column) -> Column:
            out = F.concat(acc["out"], F.array(x))
            return F.struct((acc["total"] - q).alias("total"), (acc["room"] - x).alias("room"), out.alias("out"))

        return _let(hypergeometric(u, acc["total"], q, acc["room"]), after)

    start = F.struct(whole.alias("total"), room.alias("room"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.size(quotas)), start, step)["out"]


def _split(nodes: DataFrame, levels: int, seed: str) -> DataFrame:
    """Halve the shards of every node (group, items: name and quota, rooms: shard and n) until each has one.

    The left half draws its room from the items, the right half gets the rest; items without blocks are left out.
    """
    for _ in range(levels):
        half = F.shiftright(F.size("rooms"), 1)
        one = F.size("rooms") <= 1
        nodes = nodes.withColumns(
            {
                "quotas": F.transform("items", lambda i: i["quota"]),
                "first": F.slice("rooms", F.lit(1), half),
                "last": F.slice("rooms", half + 1, F.size("rooms")),
            }
        )
        room = F.aggregate("first", F.lit(0).cast("long"), lambda a, r: a + r["n"])
        ends = [F.element_at("rooms", i)["shard"].cast("string") for i in (1, -1)]
        name = F.concat_ws("|", F.lit(seed), F.col("group"), *ends)
        nodes = nodes.withColumn("got", F.when(one, F.col("quotas")).otherwise(_draw(F.col("quotas"), room, name)))
        left = F.zip_with("items", "got", lambda i, x: F.struct(i["name"].alias("name"), x.alias("quota")))
        right = F.zip_with("items", "got", lambda i, x: F.struct(i["name"].alias("name"), (i["quota"] - x).alias("quota")))
        sides = [
            F.struct("group", F.filter(items, lambda i: i["quota"] > 0).alias("items"), rooms.alias("rooms"))
            for items, rooms in ((left, F.when(one, F.col("rooms")).otherwise(F.col("first"))), (right, F.col("last")))
        ]
        nodes = nodes.select(F.explode(F.when(one, F.array(sides[0])).otherwise(F.array(*sides))).alias("n")).select("n.*")
    return nodes


def deal(quotas: DataFrame, shards: int, seed: str = SEED, fan: int = FAN) -> DataFrame:
    """Deal exact quotas (``_key``, ``quota``: one row per source) to shards of equal room: _key, shard, n above 0.

    More than ``fan`` sources are dealt by groups: a group's blocks in a shard are the room its sources draw for.
    """
    some = quotas.filter("quota > 0").select(F.col("_key").alias("name"), "quota")
    count, whole = some.agg(F.count(F.lit(1)), F.coalesce(F.sum("quota"), F.lit(0))).first()
    groups = max(1, math.ceil(count / fan))
    group = F.pmod(F.xxhash64("name"), F.lit(groups)).cast("string")
    nodes = some.groupBy(group.alias("group")).agg(F.array_sort(F.collect_list(F.struct("name", "quota"))).alias("items"))
    if groups > 1:
        sums = some.groupBy(group.alias("_key")).agg(F.sum("quota").alias("quota"))
        above = materialize(deal(sums, shards, f"{seed}/{groups}", fan), "mix_rooms")
        rooms = above.groupBy(F.col("_key").alias("group")).agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("rooms"))
        tasks = min(groups, int(quotas.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        nodes = nodes.join(rooms.hint("merge"), "group").repartition(tasks, "group")
    else:
        upto = lambda i: F.floor(F.lit(whole) * i / F.lit(shards)).cast("long")
        each = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(i.alias("shard"), (upto(i + 1) - upto(i)).alias("n")))
        nodes = nodes.withColumn("rooms", F.filter(each, lambda r: r["n"] > 0))
    leaves = _split(nodes, max(0, math.ceil(math.log2(shards))), seed)
    dealt = leaves.select(F.element_at("rooms", 1)["shard"].alias("shard"), F.explode("items").alias("i"))
    return dealt.select(F.col("i.name").alias("_key"), "shard", F.col("i.quota").alias("n"))


def plan_mix(
    sizes: DataFrame,
    weights=WEIGHTS,
    most: int = MOST,
    seed: str = SEED,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    buckets: int = BUCKETS,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """One row per source (from _key, _size, _place): what its documents need to know to find their draws."""
    goal = materialize(targets(sizes, weights, most), "mix_targets")
    few = is_small(goal, limits)
    share = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0))
    rounds = F.least(F.floor(share), F.lit(most)).cast("long")
    goal = goal.withColumn("rounds", rounds).withColumn("part", share - F.col("rounds"))
    marked = skew_join(sizes, goal.select("_key", "words", "docs"), "_key", "inner", limits, small=few)
    large = 2 * F.col("_size") * F.col("docs") > F.col("words")
    big, small = marked.filter(large), marked.filter(~large)
    big_words = big.groupBy("_key").agg(F.sum("_size").alias("big"))
    big_goal = goal.join(big_words, "_key").select("_key", (F.col("part") * F.col("big")).alias("goal"))
    ends_big = materialize(_ends(big, materialize(big_goal, "mix_goal"), buckets, limits, few), "mix_big")
    open_words = F.col("part") * F.col("words") - F.coalesce("got", F.lit(0))
    small_goal = goal.join(ends_big, "_key", "left").select("_key", open_words.alias("goal"))
    ends_small = materialize(_ends(small, materialize(small_goal, "mix_goal"), buckets, limits, few), "mix_small")
    none = F.lit(-1).cast("long")
    plan = (
        goal.join(ends_big.select("_key", F.col("end").alias("end_big")), "_key", "left")
        .join(ends_small.select("_key", F.col("end").alias("end_small")), "_key", "left")
        .fillna(-1, ["end_big", "end_small"])
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("words") / block_words)).cast("long"))
    )
    # A source without a part of a round has no use for an end.
    ends = {c: F.when(F.col("part") > 0, F.col(c)).otherwise(none) for c in ("end_big", "end_small")}
    plan = plan.withColumns(ends)
    over = F.greatest("end_big", "end_small")
    extra = F.when(over < 0, F.lit(0)).otherwise(_block(over) + 1)
    plan = materialize(plan.withColumn("quota", F.col("rounds") * F.col("blocks") + extra), "mix_plan")
    total = plan.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    shards = min(MOST_SHARDS, max(1, math.ceil(total / shard_words)))
    # The first block after each shard's run; a shard without blocks of the source has none.
    upto = Window.partitionBy("_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    run = F.array_sort(F.collect_list(F.struct(F.col("end"), F.col("shard"))))
    runs = deal(plan, shards, seed).withColumn("end", F.sum("n").over(upto)).groupBy("_key").agg(run.alias("runs"))
    runs = runs.select("_key", F.col("runs.end").alias("shard_ends"), F.col("runs.shard").alias("shard_ids"))
    none_yet = {"shard_ends": F.coalesce("shard_ends", F.array().cast("array<long>")), "shard_ids": F.coalesce("shard_ids", F.array().cast("array<int>"))}
    whole = skew_join(plan, runs, "_key", "left", limits, hot={}, small=False)  # one row per source on both sides
    return materialize(whole.withColumns(none_yet).withColumn("shards", F.lit(shards)), "mix_plan")


def _block(place: Column) -> Column:
    return F.floor(place / float(1 << _PLACES) * F.col("blocks")).cast("long")


def _passed(ends: Column, at: Column, most: int) -> Column:
    """How many of at most ``most`` ascending ends are not above ``at``, by bisection."""
    steps = F.lit([1 << i for i in reversed(range(most.bit_length()))])

    def step(n: Column, more: Column) -> Column:
        return F.when(F.get(ends, n + more - 1) <= at, n + more).otherwise(n)  # NULL beyond the last end

    return F.aggregate(steps, F.lit(0), step)


def draw(rows: DataFrame, plan: DataFrame, seed: str = SEED, id_col: str = "doc_id", limits: Limits = DEFAULT) -> DataFrame:
    """Add _words, _target and _draws (array of round, shard and place in the shard) to rows that have
    _key, _size and _place.  No row moves unless the plan is too large to be broadcast."""
    sources, numbers, longest = plan.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.size("shard_ends")), F.lit(0)), F.coalesce(F.max(F.size("shard_ends")), F.lit(0))
    ).first()
    wanted = plan.select("_key", "words", "docs", "target", "rounds", "end_big", "end_small", "blocks", "shard_ends", "shard_ids")
    wanted = wanted.toDF("_key", *[f"_{c}" for c in wanted.columns[1:]])
    small = sources * 512 + numbers * 16 <= limits.broadcast_bytes
    joined = skew_join(rows, wanted, "_key", "inner", limits, small=small)
    large = 2 * F.col("_size") * F.col("_docs") > F.col("_words")
    end = F.when(large, F.col("_end_big")).otherwise(F.col("_end_small"))
    times = F.col("_rounds") + (F.col("_place") <= end).cast("long")
    block = F.floor(F.col("_place") / float(1 << _PLACES) * F.col("_blocks")).cast("long")

    def one(k: Column) -> Column:
        return F.struct(
            k.alias("round"),
            F.get("_shard_ids", _passed(F.col("_shard_ends"), k * F.col("_blocks") + block, longest)).alias("shard"),
            F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"), k).alias("order"),
        )

    draws = F.when(times > 0, F.transform(F.sequence(F.lit(0).cast("long"), times - 1), one)).otherwise(F.array())
    owned = F.filter(draws, lambda d: d["shard"].isNotNull())
    gone = ["_docs", "_rounds", "_end_big", "_end_small", "_blocks", "_shard_ends", "_shard_ids"]
    return joined.withColumn("_draws", owned).drop(*gone)


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", limits: Limits = DEFAULT, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, one output shard after another,
    shuffled inside each.  The columns are those of ``docs``."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = [F.col(f"`{c}`").alias(a) for c, a in ((id_col, "_id"), (text_col, "_text"), (source_col, "_source"))]
    placed = with_places(docs.select(whole.alias("_document"), *named), "_id", "_text", "_source")
    plan = plan_mix(materialize(placed.select("_key", "_size", "_place"), "mix_sizes"), limits=limits, **options)
    drawn = draw(placed, plan, id_col="_id", limits=limits)
    rows = drawn.select("_document", F.explode("_draws").alias("_draw"))
    part = F.pmod(F.col("_draw.order"), F.lit(PARTS))  # a shard is written by a few tasks, of random rows each
    dealt = rows.withColumns({"_shard": F.col("_draw.shard"), "_part": part, "_order": F.col("_draw.order")})
    # As many partitions as shards and parts, so a task's rows do not grow with the table.
    tasks = PARTS * (plan.agg(F.max("shards")).first()[0] or 1)
    dealt = dealt.repartition(tasks, "_shard", "_part").sortWithinPartitions("_shard", "_part", "_order")
    return dealt.select("_document.*")
