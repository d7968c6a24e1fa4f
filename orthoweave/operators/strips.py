"""Operators along a strip of frames: neighbours, windows that grow with what was accepted, chains and offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def bracketing(frames: DataFrame, *, by: list[str], done: str) -> DataFrame:
    """frames with lower, upper and alpha: the nearest finished frames on both sides, and where between them it lies.

    Null unless there is one on each side; a finished frame is not its own neighbour.
    """
    order = W.partitionBy(*by).orderBy("frame")
    before, after = order.rangeBetween(W.unboundedPreceding, -1), order.rangeBetween(1, W.unboundedFollowing)
    got = F.when(F.col(done), F.col("frame"))
    rows = frames.withColumn("lower", F.max(got).over(before)).withColumn("upper", F.min(got).over(after))
    both = F.col("lower").isNotNull() & F.col("upper").isNotNull()
    return rows.select(*frames.columns, *[F.when(both, F.col(c)).alias(c) for c in ("lower", "upper")], F.when(both, (F.col("frame") - F.col("lower")) / F.greatest(F.lit(1), F.col("upper") - F.col("lower"))).alias("alpha"))


def extrapolated_centre(frames: DataFrame, *, by: list[str], done: str) -> DataFrame:
    """frames with x, y: on the line through the two nearest accepted frames' centres (cx, cy); from one, its centre.

    Of frames equally near the lower one counts as nearer. Each accepted frame carries the one before
    it and the one after, so that windows find two on either side of any frame; frames of a strip must be distinct.
    """
    order = W.partitionBy(*by).orderBy("frame")
    among = W.partitionBy(*by, done).orderBy("frame")
    own = F.struct("frame", "cx", "cy")
    two = lambda other: F.when(F.col(done), F.array(own, other(own, 1).over(among)))
    rows = frames.withColumn("back", two(F.lag)).withColumn("ahead", two(F.lead))
    rows = rows.withColumn("back", F.last("back", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))).withColumn("ahead", F.first("ahead", ignorenulls=True).over(order.rowsBetween(1, W.unboundedFollowing)))
    none = F.array().cast(rows.schema["back"].dataType)
    near = F.filter(F.concat(F.coalesce("back", none), F.coalesce("ahead", none)), lambda x: x.isNotNull())
    ranked = F.array_sort(F.transform(near, lambda x: F.struct(F.abs(x["frame"] - F.col("frame")).alias("d"), x["frame"].alias("f"), x["cx"].alias("x"), x["cy"].alias("y"))))
    rows = rows.withColumn("near", ranked)
    a, b = F.get("near", F.lit(0)), F.get("near", F.lit(1))
    on_line = lambda v: F.when(b.isNull(), a[v]).otherwise(a[v] + (b[v] - a[v]) / (b["f"] - a["f"]) * (F.col("frame") - a["f"]))
    return rows.select(*frames.columns, on_line("x").alias("x"), on_line("y").alias("y"))


def grown_window(jobs: DataFrame, *, by: list[str], done: str, margin: float = 0.18) -> DataFrame:
    """jobs with the reference window grown by the boxes of earlier accepted jobs, by order of frame."""
    earlier = W.partitionBy(*by).orderBy("frame", "entity_id").rowsBetween(W.unboundedPreceding, -1)
    low = lambda c: F.least(F.col("win_" + c), F.min(F.when(F.col(done), F.col(c) - margin)).over(earlier)).alias("grown_" + c)
    high = lambda c: F.greatest(F.col("win_" + c), F.max(F.when(F.col(done), F.col(c) + margin)).over(earlier)).alias("grown_" + c)
    return jobs.select(*jobs.columns, low("west"), low("south"), high("east"), high("north"))


def secondary_references(jobs: DataFrame, *, by: list[str], done: str, keep: int = 2) -> DataFrame:
    """jobs with refs: the last accepted jobs before each, the latest first."""
    earlier = W.partitionBy(*by).orderBy("frame", "entity_id").rowsBetween(W.unboundedPreceding, -1)
    among = W.partitionBy(*by, done).orderBy("frame", "entity_id")
    chain = F.when(F.col(done), F.array("entity_id", *[F.lag("entity_id", k).over(among) for k in range(1, keep)]))
    rows = jobs.withColumn("refs", chain)
    last = F.coalesce(F.last("refs", ignorenulls=True).over(earlier), F.array().cast(rows.schema["refs"].dataType))
    return rows.select(*jobs.columns, F.filter(last, lambda x: x.isNotNull()).alias("refs"))


def right_neighbours(matches: DataFrame, *, by: str) -> DataFrame:
    """by, i, j, overlap: each frame's best right neighbour; of frames that claim one neighbour the stronger has it."""
    first = F.row_number().over(W.partitionBy(by, "i").orderBy(F.desc("overlap"), "j"))
    best = matches.withColumn("rank", first).filter("rank = 1").drop("rank")
    claim = F.row_number().over(W.partitionBy(by, "j").orderBy(F.desc("overlap"), "i"))
    return best.withColumn("rank", claim).filter("rank = 1").drop("rank")


def frame_order(frames: DataFrame, links: DataFrame, *, by: str) -> DataFrame:
    """by, i, seq, overlap: every frame of frames (by, i) once, in the order of its strip, and its overlap with the one before.

    links (by, i, j, overlap) give a frame one right neighbour at most. The chain begins at the first frame that is nobody's
    right neighbour, or where there is none, in a cycle, at the strongest link, of equal ones at the first; it ends at a
    frame without link or one that it has passed. Frames that it doesn't reach follow in their own order, with overlap 0.
    A strip's frames are one row while they are put in order; the walk is as long as the strip has frames.
    """
    strips = frames.select(by, "i").unionByName(links.select(by, "i")).unionByName(links.select(by, F.col("j").alias("i"))).distinct().groupBy(by).agg(F.array_sort(F.collect_list("i")).alias("all"))
    link = F.struct("i", F.struct("j", "overlap").alias("to"))
    right = links.groupBy(by).agg(F.map_from_entries(F.collect_list(link)).alias("right"), F.collect_set("j").alias("claimed"), F.min_by("i", F.struct(-F.col("overlap"), F.col("i"))).alias("strongest"))
    rows = strips.join(right, by, "left")
    free = F.when(F.col("right").isNull(), F.col("all")).otherwise(F.array_except("all", "claimed"))
    rows = rows.withColumn("start", F.coalesce(F.get(free, F.lit(0)), F.col("strongest")))
    kind = dict(links.dtypes)["overlap"]
    place = lambda i, overlap: F.struct(i.alias("i"), overlap.cast(kind).alias("overlap"))

    def step(path, _):
        to = F.try_element_at("right", F.element_at(path, -1)["i"])
        ends = to.isNull() | F.exists(path, lambda x: x["i"] == to["j"])
        return F.when(ends, path).otherwise(F.concat(path, F.array(place(to["j"], to["overlap"]))))

    rows = rows.withColumn("path", F.aggregate("all", F.array(place(F.col("start"), F.lit(0))), step))
    passed = F.transform("path", lambda x: x["i"])
    left = F.transform(F.array_except("all", passed), lambda i: place(i, F.lit(0)))
    return rows.select(by, F.posexplode(F.concat("path", left)).alias("seq", "at")).select(by, "at.i", "seq", "at.overlap")


def offsets(frames: DataFrame, *, by: str) -> DataFrame:
    """frames (seq, width, overlap with the next) with x: where each begins on the strip's canvas."""
    before = W.partitionBy(by).orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    return frames.withColumn("x", F.coalesce(F.sum(F.col("width") - F.col("overlap")).over(before), F.lit(0)))


def chained_shifts(pairs: DataFrame, *, by: str) -> DataFrame:
    """pairs (seq, dx to the one before, null is none) with total: shifts summed along the strip, zero at its middle."""
    order = W.partitionBy(by).orderBy("seq")
    rows = pairs.withColumn("run", F.sum(F.coalesce("dx", F.lit(0.0))).over(order.rowsBetween(W.unboundedPreceding, 0))).withColumn("n", F.count("*").over(W.partitionBy(by))).withColumn("k", F.row_number().over(order) - 1)
    anchor = F.max(F.when(F.col("k") == F.floor(F.col("n") / 2), F.col("run"))).over(W.partitionBy(by))
    return rows.withColumn("total", F.col("run") - anchor).drop("run", "n", "k")


def islands(rows: DataFrame, *, by: str, at: str, gap: float) -> DataFrame:
    """by, island, n, median: runs of positions no further than a gap apart, and the middle of each."""
    order = W.partitionBy(by).orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(order) > gap, 1).otherwise(0)
    marked = rows.withColumn("new", new).withColumn("island", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return marked.groupBy(by, "island").agg(F.count("*").alias("n"), F.percentile(at, F.lit(0.5)).alias("median"))


def two_frame_order(n_ab, n_ba, overlap_ab, overlap_ba):
    """Whether two frames are to be swapped: by a fifth more matches, ten at least, else by the larger overlap."""
    return F.when((n_ba > n_ab * 1.2) & (n_ba >= 10), True).when((n_ab >= n_ba * 1.2) & (n_ab >= 10), False).otherwise((overlap_ba > overlap_ab) & (overlap_ba > 0))


def reversed_strips(matches: DataFrame, *, by: str, margin: float = 1.05) -> DataFrame:
    """by, forward, backward, reverse: overlaps summed along a strip both ways; the reverse wins only by a margin."""
    way = lambda step: F.coalesce(F.sum(F.when(F.col("j") - F.col("i") == step, F.col("overlap"))), F.lit(0))
    got = matches.groupBy(by).agg(way(1).alias("forward"), way(-1).alias("backward"))
    return got.withColumn("reverse", F.col("backward") > F.col("forward") * margin)


def validated_siblings(frames: DataFrame, *, by: list[str], done: str) -> DataFrame:
    """entity_id, siblings: how many other frames of its strip are validated."""
    n = F.count_if(done).over(W.partitionBy(*by))
    return frames.select("entity_id", (n - F.col(done).cast("long")).alias("siblings"))
