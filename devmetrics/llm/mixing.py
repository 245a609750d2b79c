"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken ``target / source_size`` times. The
whole part of that is certain; the fraction is a probability that has to
become 0 or 1. Pivotal rounding pairs two sides and moves probability mass,
measured in words, from one to the other until one of them is integral: which
way is random, with chances that leave each document's expectation unchanged.
The words of the source stay the same in every step.

Here documents go into blocks of some ``FANOUT``. A block is folded from its
largest document on: the undecided one meets the next smaller one, and the one
that is still fractional goes on. Neighbours in that order are of similar size,
so each meeting decides either of them with a fair chance. An undecided document
over ``FAR`` times as large as the next meets all that are left together, since
many small ones are needed to balance it. A block passes on the one left over
and, so that the last meetings are of small documents, its ``HELD`` smallest
ones untouched. The residuals of one level are the documents of the next, in a
reduction tree; the last one of a source is drawn alone. The taken words differ
from the target by less than the size of that one document, which is one of the
smaller ones of its source, though not always the smallest. Every draw is a hash
of seed, level and document: reruns agree.

Defined cases: a null or empty text has size 0 and is taken once for each
whole time of its source, without words. Null is a source of its own. Equal
rows are drawn one by one. A source without words has target 0. An empty table
gives an empty result. Other columns pass through ``mix_rows`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace
from devmetrics.llm.text import word_count

# Documents that one block pairs, about.
FANOUT = 128
# An undecided document this many times as large as the next one meets the whole rest.
FAR = 1.5
# The smallest documents of a block that it passes on undecided, and the blocks that then join.
HELD = 8
JOINED = FANOUT // (HELD + 1)
# Weights by rank of the source, repeating, and the most a source is repeated.
WEIGHTS = (1, 2, 3)
MOST = 3

_ITEM = "struct<doc_id:bigint,fp:bigint,k:bigint,size:bigint,mass:double>"
_DONE = f"array<struct<item:{_ITEM},taken:boolean>>"
# Copies of one row that one generator step holds in memory.
REPEAT_BLOCK = 10_000
# A fraction this near to 0 or 1 counts as whole.
_NEAR = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: ``source_size``, ``target``; in: source, size, rows.

    Sources rank by code point with null last; they weigh ``weights`` in turn
    and share all words. Where a source would exceed ``most`` times its own
    size it stops there, and the rest is shared again: sources fill up in order
    of size per weight, so one running sum finds the level of the others. The
    windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(_over(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("double"))
    filled = F.col("source_size") / F.col("weight")
    order = (filled, F.col("source").asc_nulls_last())
    before = _over(*order).rowsBetween(-(2**63), -1)
    rest = _over(*order).rowsBetween(0, 2**63 - 1)
    everything = _over(*order).rowsBetween(-(2**63), 2**63 - 1)
    # The level if this source and all after it were below their limit.
    level = (
        F.sum("source_size").over(everything)
        - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("weight").over(rest)
    per = per.withColumn("level", level)
    # The first source that is below its limit at its own level sets the level for all the rest.
    free = F.when(F.col("level") <= most * filled, F.col("level"))
    per = per.withColumn("free", F.first(free, ignorenulls=True).over(everything))
    target = F.least(most * F.col("source_size"), F.col("weight") * F.col("free"))
    return per.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _over(*order):
    from pyspark.sql import Window

    return Window.orderBy(*order)


def _draw(level: int, seed: int, *of: Column) -> Column:
    """A number in [0, 1) that depends on the arguments only."""
    bits = F.xxhash64(F.lit(seed), F.lit(level), *of).bitwiseAND(F.lit((1 << 52) - 1))
    return bits / F.lit(float(1 << 52))


def _paired(items: Column, level: int, seed: int) -> Column:
    """A block folded from its largest document on: (the undecided one or null, the decided ones).

    The documents still to come, the pool, have ``size`` words in all and mass
    ``mass``. A change of the pool's mass is the same linear map of all their
    masses, ``scale * mass + lift * size``, and is kept as such.
    """
    none = F.expr(f"CAST(NULL AS {_ITEM})")
    zero, one = F.lit(0.0), F.lit(1.0)

    def state(size, mass, scale, lift, carry, done):
        return F.struct(
            size.alias("size"), mass.alias("mass"), scale.alias("scale"), lift.alias("lift"),
            carry.alias("carry"), done.alias("done"),
        )

    def item(x, mass):
        return F.struct(x["doc_id"], x["fp"], x["k"], x["size"], mass.alias("mass"))

    def decided(x):
        return F.array(F.struct(x.alias("item"), (x["mass"] > _NEAR).alias("taken")))

    def is_open(x):
        return (x["mass"] > _NEAR) & (x["mass"] < x["size"] - _NEAR)

    def moved(mass, size, other, room, x, salt):
        """Mass that goes from (``other``, with ``room`` left) to (``mass`` of ``size``); below 0 the other way."""
        gain, loss = F.least(size - mass, other), F.least(mass, room)
        up = _draw(level, seed, x["doc_id"], x["fp"], x["k"], F.lit(salt)) * (gain + loss) < loss
        return F.when(gain + loss <= _NEAR, zero).when(up, gain).otherwise(-loss)

    def against_pool(acc, x):
        """The carried document meets all that are left together, if it is much larger than the next."""
        a, size, mass = acc["carry"], acc["size"], acc["mass"]
        far = F.coalesce(a["size"] > FAR * x["size"], F.lit(False))
        step = F.when(far, moved(a["mass"], a["size"], mass, size - mass, x, 1)).otherwise(zero)
        # The pool loses ``step``: its masses shrink, or their distances to full do.
        shrink = F.when(step > 0, (mass - step) / mass).when(step < 0, (size - mass + step) / (size - mass))
        shrink = F.coalesce(shrink, one)
        lift = acc["lift"] * shrink + F.when(step < 0, one - shrink).otherwise(zero)
        carry = F.when(a.isNotNull(), item(a, a["mass"] + step))
        return state(size, mass - step, acc["scale"] * shrink, lift, carry, acc["done"])

    def next_one(acc, x):
        """Takes ``x`` out of the pool; what is carried meets it if still open."""
        full = x["size"].cast("double")
        own = F.least(full, F.greatest(zero, acc["scale"] * x["mass"] + acc["lift"] * full))
        size = acc["size"] - full
        a = acc["carry"]
        step = F.when(is_open(a), moved(a["mass"], a["size"], own, full - own, x, 0)).otherwise(zero)
        mine, theirs = item(a, a["mass"] + step), item(x, own - step)
        done = F.concat(
            acc["done"],
            F.when(a.isNotNull() & ~is_open(mine), decided(mine)).otherwise(F.array().cast(_DONE)),
            F.when(~is_open(theirs), decided(theirs)).otherwise(F.array().cast(_DONE)),
        )
        # A meeting leaves one of the two integral, so they are never both open.
        carry = F.when(is_open(theirs), theirs).when(a.isNotNull() & is_open(mine), mine)
        mass = F.least(size, F.greatest(zero, acc["mass"] - own))
        return state(size, mass, acc["scale"], acc["lift"], carry, done)

    def bound(value, then):
        """``then`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    start = state(
        F.aggregate(items, zero, lambda s, x: s + x["size"]),
        F.aggregate(items, zero, lambda s, x: s + x["mass"]),
        one, zero, none, F.expr(f"CAST(array() AS {_DONE})"),
    )
    return F.aggregate(
        items,
        start,
        lambda acc, x: bound(against_pool(acc, x), lambda met: next_one(met, x)),
        lambda acc: F.struct(acc["carry"], acc["done"]),
    )


def repeated(df: DataFrame, times: str, k: str) -> DataFrame:
    """Each row ``times`` times, numbered ``k`` from 1; generated in blocks of bounded size."""
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({times} - 1) div {REPEAT_BLOCK}")))
    first = F.col("__block") * REPEAT_BLOCK
    numbers = F.sequence(first + 1, F.least(F.col(times).cast("bigint"), first + REPEAT_BLOCK))
    return df.withColumn("__block", block).withColumn(k, F.explode(numbers)).drop("__block")


def draw_copies(rows: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """Copies of each row; in: doc_id, source, fp, size, times (equal rows); out: one row per row.

    Columns: doc_id, source, fp, size, source_size, target, copies.
    """
    work = Workspace(rows.sparkSession)
    counts = rows.filter("size > 0").groupBy("source").agg(F.sum("times").alias("n"))
    counts = counts.select(F.col("source").alias("s"), F.ceil(F.col("n") / FANOUT).alias("blocks"))
    plan = targets.join(counts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    plan = work.write(plan.withColumnRenamed("source", "plan_source"), "plan")
    blocks = plan.agg(F.max("blocks")).first()[0] or 0

    df = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    df = df.withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + _NEAR))
    df = repeated(df, "times", "k")
    part = F.col("rate") - F.col("whole")
    keep = ["doc_id", "source", "fp", "k"]
    staged = work.write(
        df.select(
            *keep, "size", "source_size", "target", "whole",
            (part * F.col("size")).alias("mass"),
            F.when((F.col("size") > 0) & (part > _NEAR), F.pmod(F.xxhash64("doc_id", "fp", "k"), "blocks"))
            .alias("block"),
        ),
        "rows",
    )
    pending = staged.filter("block IS NOT NULL").select(*keep, "size", "mass", "block")

    taken, level = [], 0
    while blocks:
        item = F.struct("size", "doc_id", "fp", "k", "mass")
        grouped = pending.groupBy("source", "block").agg(
            F.sort_array(F.collect_list(item), asc=False).alias("items")
        )
        items = F.transform(
            "items", lambda x: F.struct(x["doc_id"], x["fp"], x["k"], x["size"], x["mass"])
        )
        # On the last level every document is folded; before it each block keeps its smallest back.
        folds = F.greatest(F.lit(0), F.size("items") - F.lit(HELD if blocks > 1 else 0))
        folded = grouped.select("source", "block", items.alias("items"), folds.alias("folds")).select(
            "source", "block",
            _paired(F.slice("items", F.lit(1), F.col("folds")), level, seed).alias("f"),
            F.slice("items", F.col("folds") + 1, F.size("items")).alias("held"),
        )
        open_ones = F.filter(F.concat(F.array("f.carry"), "held"), lambda x: x.isNotNull())
        left = F.transform(open_ones, lambda x: F.struct(x.alias("item"), F.lit(None).cast("boolean").alias("taken")))
        out = folded.select("source", "block", F.explode(F.concat("f.done", left)).alias("x"))
        out = work.write(out.select("source", "block", "x.item.*", "x.taken"), f"level{level}")
        taken.append(out.filter("taken").select(*keep))
        pending = out.filter("taken IS NULL").withColumn("block", F.expr(f"block div {JOINED}"))
        blocks, level = (0 if blocks == 1 else -(-blocks // JOINED)), level + 1
    # One document at most is left in a source: it is drawn alone.
    alone = _draw(level, seed, "doc_id", "fp", "k") * F.col("size") < F.col("mass")
    chosen = pending.filter(alone).select(*keep) if taken else pending.select(*keep)
    for part in taken:
        chosen = chosen.unionByName(part)
    chosen = chosen.select(*(F.col(c).alias(f"c_{c}") for c in keep), F.lit(1).alias("drawn"))
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in keep]
    return staged.join(chosen, same, "left").select(
        "doc_id", "source", "fp", "size", "source_size", "target",
        (F.col("whole") + F.coalesce("drawn", F.lit(0))).cast("bigint").alias("copies"),
    )


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Distinct rows with their size and how often they occur."""
    every = [F.col(f"`{c}`") for c in docs.columns]
    return (
        docs.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            F.col(source).alias("source"),
            F.xxhash64(*every).alias("fp"),
            word_count(F.col(text)).alias("size"),
        )
        .groupBy("doc_id", "source", "fp", "size")
        .agg(F.count(F.lit(1)).alias("times"))
    )


def mix(docs: DataFrame, seed: int = 7, **columns: str) -> DataFrame:
    """How often the mix takes each row: doc_id, source, size, source_size, target, copies, taken."""
    rows = Workspace(docs.sparkSession).write(sized(docs, **columns), "sized")
    targets = source_targets(rows.select("source", (F.col("size") * F.col("times")).alias("size")))
    return draw_copies(rows, targets, seed).withColumn("taken", F.col("size") * F.col("copies"))


def mix_rows(docs: DataFrame, seed: int = 7, **columns: str) -> DataFrame:
    """The rows of the mix themselves, each as often as it is taken.

    Equal rows meet in one row before the join; it is written out as often as
    all of them together are taken.
    """
    doc_id = columns.get("doc_id", "doc_id")
    every = [F.col(f"`{c}`") for c in docs.columns]
    taken = (
        mix(docs, seed, **columns)
        .filter("copies > 0")
        .groupBy(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"))
        .agg(F.sum("copies").alias("__copies"))
    )
    once = docs.groupBy(F.col(doc_id).cast("bigint").alias("__key"), F.xxhash64(*every).alias("__print")).agg(
        F.first(F.struct("*")).alias("__row")
    )
    met = once.join(taken, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__print") == F.col("__fp")))
    return repeated(met, "__copies", "__k").select("__row.*")
