"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words; a document is to be copied target / source size times. Whole copies are given at once.
The fractions are rounded in pairs: mass moves at random from one document to another until one of the two is integral,
and the other goes on. Pairs meet in blocks of one source and of like sizes, so that the words taken stay near the target;
what a block leaves over, one document at most, meets the rest of other blocks on the next level of a reduction tree.

Cases: a null text has no words; size 0 takes nothing; a null source is a source of its own and the last; rows with equal
id, source and size are rounded as one unit and share its copies as evenly as can be; empty input gives no rows; the
outcome depends on the rows and the seed only, not on their order or partitions; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orthoweave.llm.common import OWN, SPACE, materialize

#: Sources up to this number are sent to every executor.
BROADCAST_SOURCES = 50_000
#: Bits of the documents' hash that one level of the tree takes away, and documents that share a leaf on average.
LEVEL_BITS, LEAF = 6, 64
#: A fraction this near to 0 or 1 is integral.
NEAR = 1e-9


def size_of(text: Column) -> Column:
    """Words of a text. split leaves an empty piece at an end that begins or ends with white space."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    edge = lambda at: (F.element_at(parts, at) == "").cast("int")
    return (F.size(parts) - edge(1) - F.when(F.size(parts) > 1, edge(-1)).otherwise(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target from source and source_size, one row a source.

    Filling by weight with a cap of ``most`` times a source's size: in the order of cap over weight, the first source
    that its share does not fill sets the level for all that follow. The windows go over sources, never over documents.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    got = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most)).withColumn("ratio", F.col("cap") / F.col("weight"))
    fill = W.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) * float(share) - F.coalesce(F.sum("cap").over(fill), F.lit(0.0))
    got = got.withColumn("level", left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(fill), F.lit(0.0))))
    level = F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source"))).over(everything)
    return got.withColumn("fill", level).select("source", "source_size", F.when(F.col("fill").isNull() | (F.col("fill") >= F.col("ratio")), F.col("cap")).otherwise(F.col("fill") * F.col("weight")).alias("target"))


def _uniform(seed: int, level: int, *of: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *of), F.lit(2**53)) / float(2**53)


def _fold(units: Column, unit_type: str) -> Column:
    """Pivotal rounding along an array of units (unit struct, p, u): {done: [(unit, up)], rest: unit, p}."""
    start = F.struct(F.lit(None).cast(unit_type).alias("rest"), F.lit(0.0).alias("p"), F.array().cast(f"array<struct<unit:{unit_type},up:int>>").alias("done"))
    out = lambda unit, up: F.array(F.struct(unit.alias("unit"), F.lit(up).alias("up")))

    def state(rest, p, done):
        return F.struct(rest.alias("rest"), p.alias("p"), done.alias("done"))

    def step(s, x):
        both = s["p"] + x["p"]
        keep_next = x["u"] * both < x["p"]  # below 1, the mass stays with one in proportion to what it had
        first_up = x["u"] * (2 - both) < 1 - x["p"]
        nothing, none = F.lit(None).cast(unit_type), F.lit(0.0)
        return (
            F.when(s["rest"].isNull(), state(x["unit"], x["p"], s["done"]))
            .when(F.abs(both - 1) < NEAR, F.when(x["u"] < x["p"], state(nothing, none, F.concat(s["done"], out(s["rest"], 0), out(x["unit"], 1)))).otherwise(state(nothing, none, F.concat(s["done"], out(s["rest"], 1), out(x["unit"], 0)))))
            .when(both < 1, F.when(keep_next, state(x["unit"], both, F.concat(s["done"], out(s["rest"], 0)))).otherwise(state(s["rest"], both, F.concat(s["done"], out(x["unit"], 0)))))
            .otherwise(F.when(first_up, state(x["unit"], both - 1, F.concat(s["done"], out(s["rest"], 1)))).otherwise(state(s["rest"], both - 1, F.concat(s["done"], out(x["unit"], 1)))))
        )

    return F.aggregate(units, start, step)


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row for each row of docs."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"))
    units = materialize(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    goals = materialize(targets(sizes.drop("rows"), weights, share, most), "targets")
    total = units.agg(F.count("*"), F.countDistinct("source")).first()
    goal = goals.select(F.col("source").alias("of"), "source_size", "target")
    units = units.join(F.broadcast(goal) if total[1] <= BROADCAST_SOURCES else goal, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    exact = F.col("n") * F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    exact = F.when(F.col("size") > 0, exact).otherwise(0.0)
    units = units.withColumn("exact", exact).withColumn("whole", F.floor(F.col("exact") + NEAR)).withColumn("p", F.greatest(F.lit(0.0), F.col("exact") - F.col("whole")))
    units = units.withColumn("p", F.when(F.col("p") < NEAR, 0.0).otherwise(F.col("p")))
    fields = ["doc_id", "source", "size", "n", "source_size", "target", "whole"]
    unit = F.struct(*fields)
    unit_type = units.select(unit.alias("u")).schema["u"].dataType.simpleString()
    done = units.filter("p = 0").select(unit.alias("unit"), F.lit(0).alias("up"))
    bits = max(0, math.ceil(math.log2(max(1, total[0]) / LEAF)))
    band = F.floor(F.log2(F.col("size") + 1.0) * 4)
    open_ = units.filter("p > 0").select(unit.alias("unit"), "p", F.col("source").alias("s"), band.alias("band"), F.pmod(F.xxhash64("doc_id", "source", "size"), F.lit(2**bits)).alias("leaf"))
    level = 0
    while True:
        # Leaves of one source and size band are put together by and by; the bands of a source come last.
        last = bits == 0 and level > 0
        if last:
            open_ = open_.withColumn("band", F.lit(0).cast("long"))
        u = _uniform(seed, level, F.col("unit.doc_id"), F.col("unit.source"), F.col("unit.size"))
        member = F.struct(F.col("unit.size").alias("size"), u.alias("u"), "unit", "p")
        blocks = open_.groupBy("s", "band", "leaf").agg(F.array_sort(F.collect_list(member)).alias("members"))
        folded = materialize(blocks.select("s", "band", "leaf", _fold(F.col("members"), unit_type).alias("f")), f"level{level}")
        done = done.unionByName(folded.select(F.explode("f.done").alias("d")).select("d.unit", "d.up"))
        open_ = folded.filter("f.rest is not null").select("f.rest", "f.p", "s", "band", "leaf").withColumnRenamed("rest", "unit")
        if last:
            break
        bits = max(0, bits - LEVEL_BITS)
        open_ = open_.withColumn("leaf", F.pmod("leaf", F.lit(2**bits)))
        level += 1
    end = (_uniform(seed, -1, F.col("unit.source")) < F.col("p")).cast("int")
    done = done.unionByName(open_.select("unit", end.alias("up")))
    all_copies = F.col("unit.whole") + F.col("up")
    done = done.select("unit.*", all_copies.alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("unit.n") - 1)).alias("row"))
    copies = F.floor(F.col("all") / F.col("n")) + (F.col("row") < F.col("all") % F.col("n")).cast("long")
    return done.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of docs that the mix takes, with their columns and size, target, copies and taken.

    Of rows with equal id, source and size, the first by text takes a copy before the next one does.
    """
    got = mix(docs, doc_id=doc_id, text=text, source=source, **options).groupBy("doc_id", "source", "size", "source_size", "target").agg(F.sum("copies").alias("all"), F.count("*").alias("n")).filter("all > 0")
    got = got.select(*[F.col(c).alias(OWN + c) for c in got.columns])
    sized = docs.withColumn(OWN + "own", size_of(F.col(text)))
    rows = sized.join(got, F.col(doc_id).eqNullSafe(F.col(OWN + "doc_id")) & F.col(source).eqNullSafe(F.col(OWN + "source")) & (F.col(OWN + "own") == F.col(OWN + "size")))
    place = F.row_number().over(W.partitionBy(OWN + "doc_id", OWN + "source", OWN + "size").orderBy(text)) - 1
    rows = rows.withColumn(OWN + "row", place)
    copies = F.floor(F.col(OWN + "all") / F.col(OWN + "n")) + (F.col(OWN + "row") < F.col(OWN + "all") % F.col(OWN + "n")).cast("long")
    new = {"size": F.col(OWN + "size"), "source_size": F.col(OWN + "source_size"), "target": F.col(OWN + "target"), "copies": copies, "taken": copies * F.col(OWN + "size")}
    return rows.withColumn(OWN + "copies", copies).filter(F.col(OWN + "copies") > 0).select(*[c for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])
