"""MinHash near-dedup: chosen-path set similarity join.

Documents are sets of word shingles. In each of TREES independent trees a document follows the path of its minwise
tokens; a node branches until it holds LEAF documents at most. The documents of a small node are compared exhaustively
by sketches of their minhashes; likely pairs form clusters, whose spanning links are confirmed on full sets.

Clusters that then still lie in several components, and nodes that no level splits, become families. In a family each
document is held as its difference from the consensus, the shingles that most of the family have. Two documents with
differences x and y are alike enough if x and y share (excess(x) + excess(y)) / 2 shingles, where the excess is the size of
the difference less what the limit allows a set of that size. So the document of least excess is linked with all that need
no shared difference, and the others meet by the rarest shingles of their differences, cut to the prefix that a link must
touch, with a bound on positions: all links of a family are found, while copies of one text make no pairs.

A pair at the limit of 0.8 follows one path to depth d with probability 0.8^d in each of 16 trees: it is missed with
probability 8e-8 at depth 2 and 2e-4 at depth 4. The sketch drops it with probability 1e-7. Equal sets are put together
beforehand. A node that no level splits is dealt out in blocks by a hash for the first links.

Cases: null text and text without a word: an empty set, linked with nothing; fewer words than a shingle: the words as one
shingle; a very long text has to fit in a worker's memory; rows of one doc_id are one document; rows with a null doc_id, or
one that is no integer, are compared as well, and their group has the smallest id of the others, or null; equal texts are
linked whatever their number; of ties the smallest id counts; no rows give none; extra columns are ignored. Words and
shingles are compared by 64-bit hashes, equal sets by 128 bits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import bounded_batches, materialize
from orthoweave.llm.components import components

#: Trees, levels of a tree, documents of a small node; agreeing minhashes (of TREES * LEVELS) that make a pair likely.
TREES, LEVELS, LEAF, LIKELY = 16, 4, 64, 32
#: A shingle is known to be frequent in a family if one in so many of its documents has it; shingles dealt to a task at once.
FREQUENT, SEAT = 16, 1 << 16
#: Ids of rows without one start here.
NAMELESS = 2**62
#: Hashed words that a task remembers.
REMEMBERED = 1 << 16


def uid(doc_id: Column, text: Column) -> Column:
    return F.coalesce(doc_id.try_cast("long"), F.lit(NAMELESS) + F.pmod(F.xxhash64(text), F.lit(2**61)))


@functools.cache
def _factors() -> np.ndarray:
    return np.random.default_rng(20240229).integers(0, 2**31, TREES * LEVELS, np.uint32) * np.uint32(2) + np.uint32(1)


class Shingler:
    """Sorted distinct 64-bit shingles of a text."""

    def __init__(self, k: int):
        self.k, self.seen = k, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        seen = self.seen
        if len(seen) > REMEMBERED:
            seen.clear()
        hashed = np.fromiter((seen[w] if w in seen else seen.setdefault(w, xxhash.xxh3_64_intdigest(w)) for w in words), np.uint64, len(words))
        k = min(self.k, len(words))
        got = np.full(len(words) - k + 1, k, np.uint64)
        for i in range(k):
            got = (got ^ hashed[i : len(words) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            got ^= got >> np.uint64(29)
        return np.unique(got)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    least = np.full(TREES * LEVELS, 2**32 - 1, np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(least, (low[at : at + 2048, None] * _factors()[None, :]).min(0), out=least)
    return least


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        for batch in batches:
            ns, digests, sigs = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle(text)
                ns.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("uid"), pa.array(ns, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "uid", "n", "digest", "sig"])
            pa.default_memory_pool().release_unused()

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(k)
        for batch in batches:
            got = [shingle(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"uid": batch.column("uid"), "set": pa.array([s.tobytes() for s in got], pa.binary())})
            pa.default_memory_pool().release_unused()

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (x, y) if len(x) < len(y) else (y, x)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0
                keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield batch.drop_columns(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _sketches(column: pa.Array) -> np.ndarray:
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), TREES * LEVELS // 2)
    return np.concatenate([packed & 15, packed >> 4], 1)


def _likely(node: np.ndarray, n: np.ndarray, sketch: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of places within runs of equal nodes whose sizes and sketches allow for a link, and how far sketches agree."""
    for d in range(1, len(node)):
        i = np.flatnonzero(node[:-d] == node[d:])
        if not len(i):
            return
        lo, hi = np.minimum(n[i], n[i + d]), np.maximum(n[i], n[i + d])
        i = i[100 * lo >= percent * hi]
        for at in range(0, len(i), 65536):
            part = i[at : at + 65536]
            alike = (sketch[part] == sketch[part + d]).sum(1)
            part, alike = part[alike >= LIKELY], alike[alike >= LIKELY]
            if len(part):
                yield part, part + d, alike


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of rows sorted by node, cut so that none parts a node."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        node = batch.column("node").to_numpy()
        cut = int(np.searchsorted(node, node[-1])) if len(node) else 0
        held = batch.slice(cut)
        if cut:
            yield batch.slice(0, cut)
    if held is not None and held.num_rows:
        yield held


def _cluster(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _runs(batches):
            node, rep, n = (batch.column(c).to_numpy() for c in ("node", "rep", "n"))
            top: dict[int, int] = {}

            def root(i: int) -> int:
                while (j := top.get(i, i)) != i:
                    top[i] = top.get(j, j)
                    i = j
                return i

            # The most alike first, so that the spanning links are those most likely to be confirmed.
            found = list(_likely(node, n, _sketches(batch.column("sketch")), percent))
            x, y, alike = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (node[:0].astype(np.int64),) * 3
            order = np.argsort(-alike, kind="stable")
            edges = []
            for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
                a, b = root(i), root(j)
                if a != b:
                    top[max(a, b)] = min(a, b)
                    edges.append((i, j))
            i = np.array([e[0] for e in edges], np.int64)
            j = np.array([e[1] for e in edges], np.int64)
            first = np.array([root(e) for e in i.tolist()], np.int64)
            yield pa.record_batch({"node": pa.array(node[i]), "first": pa.array(rep[first] if len(i) else rep[:0]), "a": pa.array(np.minimum(rep[i], rep[j])), "b": pa.array(np.maximum(rep[i], rep[j]))})

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a batch's documents of each family have a shingle."""
    for batch in batches:
        main = batch.column("main").to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("set")]
        for m in np.unique(main):
            token, count = np.unique(np.concatenate([sets[i] for i in np.flatnonzero(main == m)]), return_counts=True)
            yield pa.record_batch({"main": pa.array(np.full(len(token), m)), "token": pa.array(token), "c": pa.array(count.astype(np.int64))})


def _differences(percent: int):
    """Rows sorted by seat, in each first the frequent shingles of its family: every set's difference from the consensus.

    Rare shingles come first: those added to the consensus by their count (0 if not frequent), those that are missing from
    it, as complements, by the number of documents that miss them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = count = agreed = None
        size = 0
        for batch in batches:
            got = []
            for i, (of, tokens) in enumerate(zip(batch.column("size").to_pylist(), batch.column("tokens"), strict=True)):
                if tokens.is_valid:
                    size, known, count = of, tokens.values.to_numpy(), batch.column("counts")[i].values.to_numpy()
                    order = np.argsort(known)
                    known, count = known[order], count[order]
                    agreed = 2 * count > size
                    continue
                own = np.sort(np.frombuffer(batch.column("set")[i].as_buffer(), np.int64))
                spot = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
                there = known[spot] == own if len(known) else np.zeros(len(own), bool)
                extra = ~there | ~agreed[spot] if len(known) else ~there
                missed = agreed.copy()
                missed[spot[there]] = False
                rank = np.concatenate([np.where(there, count[spot] if len(known) else 0, 0)[extra], size - count[missed]])
                token = np.concatenate([own[extra], ~known[missed]])
                token = token[np.lexsort((token, rank))]
                got.append((i, (100 + percent) * len(token) - (100 - percent) * len(own), token.tobytes()))
            at = pa.array([g[0] for g in got], pa.int64())
            yield pa.record_batch({**{c: batch.column(c).take(at) for c in ("main", "rep", "label")}, "excess": pa.array([g[1] for g in got], pa.int64()), "delta": pa.array([g[2] for g in got], pa.binary())})

    return run


def _prefixes(percent: int):
    """Rows that ask and rows that are told: the shingles of differences one of which a linked pair shares.

    Documents that aren't linked with the one of least excess ask all the others (kind 0) and one another (kind 1).
    """
    unit = 2 * (100 + percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list[np.ndarray]] = [[] for _ in range(4)]
            for i, (main, excess, asks, least, next_) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("main", "excess", "asks", "least", "next")), strict=True)):
                token = np.frombuffer(batch.column("delta")[i].as_buffer(), np.uint64)
                for kind, ask, other in ((0, True, least), (1, True, next_), (1, False, next_)) if asks else ((0, False, next_),):
                    if other is None:
                        continue
                    n = max(0, len(token) - max(1, -(-(excess + other) // unit)) + 1)
                    key = (token[:n] ^ np.uint64((main * 2 + kind) % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
                    cols[0].append((key ^ (key >> np.uint64(31))).view(np.int64))
                    cols[1].append(np.full(n, i))
                    cols[2].append(len(token) - np.arange(n))
                    cols[3].append(np.full(n, ask))
            key, row, left, ask = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
            row = pa.array(row, pa.int64())
            yield pa.record_batch({"key": pa.array(key), **{c: batch.column(c).take(row) for c in ("main", "rep", "now", "excess")}, "left": pa.array(left, pa.int64()), "ask": pa.array(ask.astype(bool))})

    return run


def leaves(reps: DataFrame, levels: int = LEVELS, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """(rep, node) of the small nodes, and those of nodes that no level splits with their number of documents."""
    tree = reps.select("rep", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig")
    rows = tree.select("rep", F.expr(f"substring(sig, tree * {4 * LEVELS} + 1, {4 * LEVELS})").alias("path"), F.col("tree").cast("long").alias("node"))
    small, none = None, None
    for level in range(levels):
        rows = rows.withColumn("node", F.xxhash64("node", F.expr(f"substring(path, {4 * level + 1}, 4)")))
        large = materialize(rows.groupBy("node").agg(F.count("*").alias("size")).filter(F.col("size") > leaf).select(F.col("node").alias("of"), "size"), f"large{level}")
        part = rows.join(large, rows["node"] == large["of"], "left_anti").select("rep", "node")
        small = part if small is None else small.unionByName(part)
        none = materialize(rows.join(large, rows["node"] == large["of"]).select("rep", "path", "node", "size"), f"level{level}")
        rows = none.drop("size")
        if large.isEmpty():
            break
    return small, none.select("rep", "node", "size")


def _sets_of(wanted: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """uid, set of the documents whose uid is in wanted (column w)."""
    texts = docs.join(wanted, docs["uid"] == wanted["w"], "left_semi")
    return materialize(texts.mapInArrow(_sets(k), "uid long, set binary"), "sets")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    x = sets.select(F.col("uid").alias("ux"), F.col("set").alias("x"))
    y = sets.select(F.col("uid").alias("uy"), F.col("set").alias("y"))
    both = pairs.join(x, F.col("a") == F.col("ux")).drop("ux").join(y, F.col("b") == F.col("uy")).drop("uy")
    return materialize(both.mapInArrow(_confirm(percent), pairs.schema), "links")


def family_links(family: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: labels of a family's documents (main, rep, label, n) that are linked, of all pairs with different labels."""
    sizes = family.groupBy("main").agg(F.count("*").alias("size"), (F.sum("n") / SEAT).cast("long").alias("seats"))
    sizes = materialize(sizes.withColumnRenamed("main", "of"), "sizes")
    seated = family.join(sizes, family["main"] == sizes["of"]).withColumn("seat", F.xxhash64("main", F.pmod(F.xxhash64("rep"), F.col("seats") + 1))).drop("of", "seats", "n")
    held = materialize(seated.join(sets, seated["rep"] == sets["uid"]).drop("uid"), "held")
    counts = held.select("main", "set").mapInArrow(_counts, "main long, token long, c long").groupBy("main", "token").agg(F.sum("c").alias("c"))
    often = counts.join(sizes, counts["main"] == sizes["of"]).filter(F.col("c") * FREQUENT >= F.col("size"))
    often = often.groupBy("main", "size", "seats").agg(F.collect_list(F.struct("token", "c")).alias("known"))
    often = often.withColumn("salt", F.explode(F.expr("sequence(0L, seats)"))).select(F.xxhash64("main", "salt").alias("seat"), "main", "size", F.col("known.token").alias("tokens"), F.col("known.c").alias("counts"))
    rows = held.unionByName(often, allowMissingColumns=True).repartition("seat").sortWithinPartitions("seat", F.col("rep").isNotNull())
    delta = materialize(rows.mapInArrow(_differences(percent), "main long, rep long, label long, excess long, delta binary"), "differences")

    plain = delta.select("main", "rep", "label", "excess")
    first = plain.groupBy("main").agg(F.min(F.struct("excess", "rep", "label")).alias("p")).select(F.col("main").alias("of"), F.col("p.excess").alias("least"), F.col("p.label").alias("lead"))
    first = materialize(first, "leads")
    # now: the label after the links with the document of least excess.
    near = F.col("excess") + F.col("least") <= 0
    now = F.when(near, F.col("lead")).otherwise(F.col("label"))
    told = lambda df: df.join(first, df["main"] == first["of"]).drop("of").withColumn("now", now).withColumn("asks", F.col("now") != F.col("lead"))
    found = told(plain)
    links = found.filter(near & (F.col("label") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("label").alias("b"))
    after = materialize(found.filter("asks").groupBy("main").agg(F.min("excess").alias("next")).withColumnRenamed("main", "of"), "after")
    left = told(delta)
    rows = left.join(after, left["main"] == after["of"]).mapInArrow(_prefixes(percent), "key long, main long, rep long, now long, excess long, left long, ask boolean")
    rows = materialize(rows, "prefixes")
    x = rows.filter("ask").select("key", *[F.col(c).alias(f"x_{c}") for c in ("main", "rep", "now", "excess", "left")])
    y = rows.filter("not ask").select(F.col("key").alias("at"), *[F.col(c).alias(f"y_{c}") for c in ("main", "rep", "now", "excess", "left")])
    meet = (x["key"] == y["at"]) & (F.col("x_main") == F.col("y_main")) & (F.col("x_now") != F.col("y_now"))
    meet &= F.least("x_left", "y_left") * 2 * (100 + percent) >= F.col("x_excess") + F.col("y_excess")
    pairs = x.join(y, meet).select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b"), F.when(F.col("x_rep") < F.col("y_rep"), F.col("x_now")).otherwise(F.col("y_now")).alias("la"), F.when(F.col("x_rep") < F.col("y_rep"), F.col("y_now")).otherwise(F.col("x_now")).alias("lb"))
    more = _links(materialize(pairs.distinct(), "pairs"), sets, percent)
    return materialize(links.unionByName(more.select(F.col("la").alias("a"), F.col("lb").alias("b"))).distinct(), "family-links")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, levels: int = LEVELS, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and uid (the id, or what stands for it), one row for each of docs."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).try_cast("long").alias("doc_id"), uid(F.col(doc_id), F.col(text)).alias("uid"), F.col(text).alias("text"))
    signed = materialize(rows.mapInArrow(_sign(shingle), "doc_id long, uid long, n long, digest binary, sig binary"), "signed")
    first = materialize(signed.filter("n > 0").groupBy("digest").agg(F.min("uid").alias("rep")).withColumnRenamed("digest", "d"), "first")
    member = signed.join(first, signed["digest"] == first["d"], "left").drop("d", "digest")
    member = materialize(member.withColumn("sig", F.when(F.col("uid") == F.col("rep"), F.col("sig"))), "members")
    # Of equal rows one stands for all; its path and sketch are what the trees use.
    reps = member.filter("sig is not null").dropDuplicates(["rep", "n", "sig"]).select("rep", "n", "sig")
    reps = materialize(reps, "reps")

    small, unsplit = leaves(reps, levels, leaf)
    unsplit = unsplit.withColumn("salt", F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("size") / leaf)))
    seats = small.unionByName(unsplit.select("rep", F.xxhash64("node", "salt").alias("node")))
    nibbles = "to_binary(" + "||".join(f"substring(hex(sig), {8 * i + 2}, 1)||substring(hex(sig), {8 * (i + TREES * LEVELS // 2) + 2}, 1)" for i in range(TREES * LEVELS // 2)) + ", 'hex')"
    looks = materialize(reps.select(F.col("rep").alias("r"), "n", F.expr(nibbles).alias("sketch")), "sketches")
    seated = seats.join(looks, seats["rep"] == looks["r"]).select("node", "rep", "n", "sketch")
    clustered = seated.repartition("node").sortWithinPartitions("node").mapInArrow(_cluster(percent), "node long, first long, a long, b long")
    clusters = materialize(clustered, "clusters")
    edges = clusters.select("a", "b").distinct()
    wanted = clusters.select(F.explode(F.array("a", "b")).alias("w")).unionByName(unsplit.select(F.col("rep").alias("w"))).distinct()
    sets = _sets_of(materialize(wanted, "wanted"), rows.select("uid", "text"), shingle)
    label = materialize(components(_links(edges, sets, percent)), "components1")

    inside = clusters.select("node", "first", F.explode(F.array("a", "b")).alias("rep")).distinct().unionByName(unsplit.select("node", F.col("node").alias("first"), "rep"))
    inside = inside.join(label, inside["rep"] == label["node"], "left").select(inside["node"], "first", "rep", F.coalesce("component", "rep").alias("label"))
    inside = materialize(inside, "inside")
    top = inside.groupBy("node", "first", "label").agg(F.count("*").alias("c")).groupBy("node", "first").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("size"), F.count("*").alias("labels"))
    # Two documents of a cluster have been compared already.
    over = materialize(top.filter("labels > 1 and size > 2").select(F.col("node").alias("on"), F.col("first").alias("of"), F.col("top.label").alias("main")), "over")
    if not over.isEmpty():
        family = inside.join(over, (inside["node"] == over["on"]) & (inside["first"] == over["of"])).select("main", "rep", "label").distinct()
        family = materialize(family.join(looks.select("r", "n"), family["rep"] == F.col("r")).drop("r"), "family")
        joined = components(family_links(family, sets, percent)).select(F.col("node").alias("old"), F.col("component").alias("new"))
        label = label.unionByName(joined.select(F.col("old").alias("node"), F.col("old").alias("component"))).distinct()
        label = materialize(label.join(joined, label["component"] == joined["old"], "left").select("node", F.coalesce("new", "component").alias("component")).distinct(), "components2")

    got = member.join(label, member["rep"] == label["node"], "left")
    component = F.coalesce("component", "rep", "uid")
    component = F.when(component < NAMELESS, component)
    return got.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"), "uid", F.coalesce("component", "rep", "uid").alias("group"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group, with all columns: the one of the smallest id. Documents without a word all stay."""
    got = near_duplicates(docs, doc_id=doc_id, text=text, **options)
    gone = got.filter((F.col("uid") != F.col("group")) & (F.col("n_shingles") > 0)).select(F.col("uid").alias("gone")).distinct()
    left = docs.join(gone, uid(docs[doc_id], docs[text]) == F.col("gone"), "left_anti")
    # Rows of one id are one document; only these are dealt out anew.
    twice = materialize(got.filter("n_shingles > 0").groupBy("uid").agg(F.count("*").alias("c")).filter("c > 1").select(F.col("uid").alias("twice")), "twice")
    if twice.isEmpty():
        return left
    own = uid(left[doc_id], left[text])
    again = left.join(twice, own == F.col("twice")).dropDuplicates(["twice"]).drop("twice")
    return left.join(twice, own == F.col("twice"), "left_anti").unionByName(again)
