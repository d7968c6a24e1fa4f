"""LM scoring by context-tree weighting over bytes.

Each byte is eight binary decisions, and each of the 255 decisions has its own context tree over the bytes before it, up
to DEPTH of them. A node keeps a Krichevsky-Trofimov estimate of its bit; its weighted probability is half its own
estimate and half the product of its children's, so a prediction mixes all depths by their posterior weights. A text is
scored as its A-Z lower-cased UTF-8 bytes between END bytes, which no text holds; the END after it is predicted too.

Counts come from all training texts. Documents are dealt into chunks of about CHUNK bytes. A chunk sends each of its
distinct words and byte n-grams once, packed by part of the key space. Parts of the words sum them and answer each chunk.
The n-grams of a part, which share their last two bytes of context, are summed in a tree, FAN chunks at a time and then FAN
sums, since a frequent context occurs in every chunk: no task meets more than FAN lists of distinct keys. The part's tree
is weighed once, and its figures go back to FAN chunks at a time. So neither vocabulary nor tree is ever held in one place;
only depths 0 and 1, at most 256 * 255 nodes, are broadcast.

Cases: a null text is an empty one, scored as its END; if nothing was learned, every bit has probability 1/2; words are
told apart by 64-bit hashes; equal rows get equal scores; a chunk has to fit in a worker's memory, and so has any one
text; no rows give none; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import materialize

#: Bytes of context, bytes of a chunk and of the text whose keys one part gets, lists summed at a time, bytes looked at at
#: once, and the end.
DEPTH, CHUNK, PER_PART, FAN, AT_ONCE, END = 4, 8 << 20, 64 << 20, 32, 1 << 20, b"\xff"
WORDS, GRAMS = 0, 1
#: The key of the end token among words, and one that no n-gram has.
END_KEY, SKIP = 0, np.uint64(1 << 63)


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) or 1


def gram_keys(raws: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: first, last + 1, the keys (DEPTH bytes and the next) of all their places, where each text's begin.

    A text's keys are len + 1 in number; the DEPTH keys after them, which run into the next text, are SKIP.
    """
    at = 0
    while at < len(raws):
        to, size = at, 0
        while to < len(raws) and (to == at or size + len(raws[to]) <= AT_ONCE):
            size += len(raws[to])
            to += 1
        data = np.frombuffer(b"".join(END * DEPTH + r + END for r in raws[at:to]) + END * DEPTH, np.uint8)
        n = len(data) - DEPTH
        keys = np.zeros(n, np.uint64)
        for d in range(DEPTH + 1):
            keys = keys << np.uint64(8) | data[d : d + n]
        lengths = np.array([len(r) + 1 + DEPTH for r in raws[at:to]])
        ends = np.cumsum(lengths)
        for d in range(1, DEPTH + 1):
            keys[ends - d] = SKIP
        yield at, to, keys, ends - lengths
        at = to


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def chunk_grams(train: list[bytes], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often the training texts have them."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for raws, weight in ((train, 1), (others, 0)):
        for _, _, got, _ in gram_keys(raws):
            k, c = np.unique(got, return_counts=True)
            keys.append(k[k < SKIP])
            counts.append(c[k < SKIP] * weight)
            if len(keys) > 8:
                keys, counts = ([x] for x in _sum(np.concatenate(keys), np.concatenate(counts)))
    return _sum(np.concatenate(keys), np.concatenate(counts))


def chunk_words(train: list[bytes], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the distinct words and how often the training texts have them; no list of all words is made."""
    counted = Counter(chain.from_iterable(map(bytes.split, train)))
    rest = set(chain.from_iterable(map(bytes.split, others))) - counted.keys()
    keys = np.fromiter(chain([END_KEY], map(word_key, counted), map(word_key, rest)), np.uint64, 1 + len(counted) + len(rest))
    counts = np.r_[np.int64(len(train)), np.fromiter(counted.values(), np.int64, len(counted)), np.zeros(len(rest), np.int64)]
    return _sum(keys, counts)


def part_of(kind: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """Keys that share their last two bytes of context are in one part."""
    if kind == GRAMS:
        keys = keys >> np.uint64(8) & np.uint64(0xFFFF)
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)


def _texts(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in table.column("text").to_pylist()]
    return raws, table.column("learn").to_numpy(zero_copy_only=False).astype(bool)


def _gather(parts: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        raws, learn = _texts(table)
        pick = lambda yes: [r for r, x in zip(raws, learn, strict=True) if x == yes]
        train, others = pick(True), pick(False)
        rows = {"chunk": [], "kind": [], "part": [], "keys": [], "ns": []}
        for kind, (keys, ns) in ((GRAMS, chunk_grams(train, others)), (WORDS, chunk_words(train, others))):
            part = part_of(kind, keys, parts)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]]) if len(part) else []
            for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
                at = order[a:b]
                for name, v in zip(rows, (key[0].as_py(), kind, int(part[at[0]]), keys[at].tobytes(), ns[at].astype(np.uint32).tobytes()), strict=True):
                    rows[name].append(v)
        return pa.table(rows, pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("keys", pa.binary()), ("ns", pa.binary())]))

    return run


def _unpack(table: pa.Table) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Chunks, their keys, and of all keys the distinct ones, their counts and each key's place among them."""
    each = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
    ns = np.concatenate([np.frombuffer(n, np.uint32) for n in table.column("ns").to_pylist()])
    keys, place = np.unique(np.concatenate(each), return_inverse=True)
    return table.column("chunk").to_pylist(), each, keys, np.bincount(place, ns, len(keys)).astype(np.int64), place  # exact below 2**53


def _answer(part: int, kind: int, chunks: list[int], each: list[np.ndarray], values: np.ndarray) -> pa.Table:
    cuts = np.cumsum([len(x) for x in each])[:-1]
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "kind": pa.array([kind] * len(chunks), pa.int32()), "part": pa.array([part] * len(chunks), pa.int64()), "values": pa.array([v.tobytes() for v in np.split(values, cuts)], pa.binary())})


def _sum_words(key: tuple, table: pa.Table) -> pa.Table:
    chunks, each, _, counts, place = _unpack(table)
    got = _answer(key[0].as_py(), WORDS, chunks, each, counts[place])
    first = np.arange(len(chunks)) == 0
    return got.append_column("tokens", pa.array(np.where(first, counts.sum(), 0), pa.int64())).append_column("types", pa.array(np.where(first, (counts > 0).sum(), 0), pa.int64()))


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    half = lambda n: _lgamma(n + 0.5) - math.lgamma(0.5)
    return half(n0) + half(n1) - _lgamma(n0 + n1 + 1.0)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, moved up by 8 for accuracy."""
    x = np.asarray(x, np.float64)
    low = np.ones_like(x)
    for i in range(8):
        low *= x + i
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(low)


def _nodes(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tree nodes of the deepest contexts: id (context and decision), zeros, ones; for each key and bit the node's place."""
    keys = keys.astype(np.int64)
    byte, context = keys & 0xFF, keys >> 8
    ids = np.stack([context << 8 | (256 | byte) >> (8 - b) for b in range(8)], 1)
    bits = np.stack([byte >> (7 - b) & 1 for b in range(8)], 1)
    node, place = np.unique(ids.ravel(), return_inverse=True)
    weight = np.repeat(counts, 8)
    ones = np.bincount(place, weight * bits.ravel(), len(node))
    return node, np.bincount(place, weight, len(node)) - ones, ones, place.reshape(-1, 8)


def _up(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """Nodes a depth above: id, zeros, ones, log of the weighted probability; and each lower node's parent."""
    above, parent = np.unique((node >> 8 & (1 << 8 * (depth - 1)) - 1) << 8 | node & 0xFF, return_inverse=True)
    z, o = np.bincount(parent, zeros, len(above)), np.bincount(parent, ones, len(above))
    own, below = log_kt(z, o), np.bincount(parent, weighted, len(above))
    return above, z, o, np.logaddexp(own, below) - math.log(2), own, parent


def _tree(keys: np.ndarray, counts: np.ndarray):
    node, zeros, ones, place = _nodes(keys, counts)
    deepest = log_kt(zeros, ones)
    levels = [(node, zeros, ones, deepest, deepest, None)]
    for depth in range(DEPTH, 2, -1):
        levels.append(_up(*levels[-1][:4], depth))
    return levels, place


def _sum_grams(key: tuple, table: pa.Table) -> pa.Table:
    """One list of the distinct keys of some lists, with their counts."""
    wide = lambda k, n: np.frombuffer(n, np.uint32 if 2 * n.size == k.size else np.int64).astype(np.int64)
    held = [(k.as_buffer(), n.as_buffer()) for k, n in zip(table.column("keys"), table.column("ns"), strict=True)]
    keys, ns = _sum(np.concatenate([np.frombuffer(k, np.uint64) for k, _ in held]), np.concatenate([wide(k, n) for k, n in held]))
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "lot": pa.array([key[1].as_py()], pa.int64()), "keys": pa.array([keys.tobytes()], pa.binary()), "ns": pa.array([ns.tobytes()], pa.binary())})


def summed_grams(grams: DataFrame, chunks: int) -> DataFrame:
    """part, keys, ns: one row a part, from lists by part and chunk."""
    lists, lots = grams.select("part", F.col("chunk").alias("lot"), "keys", "ns"), None
    while lots != 1:
        lists = lists.withColumn("lot", F.expr(f"lot div {FAN}")).groupBy("part", "lot").applyInArrow(_sum_grams, "part long, lot long, keys binary, ns binary")
        lots = -(-(lots or chunks) // FAN)
    return lists.drop("lot")


def _learned(keys: pa.Scalar, ns: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(ns.as_buffer(), np.int64)


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the contexts of two bytes of each part add to those of one byte."""
    for batch in batches:
        for keys, ns in zip(batch.column("keys"), batch.column("ns"), strict=True):
            levels, _ = _tree(*_learned(keys, ns))
            node, zeros, ones, weighted = levels[-1][:4]
            above, parent = np.unique(node & 0xFFFF, return_inverse=True)
            got = {"node": pa.array(above, pa.int64())}
            yield pa.record_batch(got | {n: pa.array(np.bincount(parent, v, len(above)), pa.float64()) for n, v in (("zeros", zeros), ("ones", ones), ("weighted", weighted))})


def top_of_tree(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[256, 256] each: the share of depths 0 and 1 in a prediction of bit 1, and the weight of what lies deeper."""
    z, o, w = (np.zeros(1 << 16) for _ in range(3))
    z[node], o[node], w[node] = zeros, ones, below
    own1 = log_kt(z, o)
    weighted1 = np.logaddexp(own1, w) - math.log(2)
    z, o, own1, weighted1 = (x.reshape(256, 256) for x in (z, o, own1, weighted1))
    z0, o0 = z.sum(0), o.sum(0)
    own0 = log_kt(z0, o0)
    weighted0 = np.logaddexp(own0, weighted1.sum(0)) - math.log(2)
    w0 = np.exp(own0 - weighted0) / 2
    w1 = np.exp(own1 - weighted1) / 2
    estimate = lambda z, o: (o + 0.5) / (z + o + 1)
    return w0 * estimate(z0, o0) + (1 - w0) * w1 * estimate(z, o), (1 - w0) * (1 - w1)


def _predict(held):
    """Each part's keys and the log10 of their probability."""

    def figures(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        levels, bit_node = _tree(keys, counts)
        share, deeper = held.value
        node, zeros, ones = levels[-1][:3]
        context = node >> 8 & 0xFF
        base, left = share[context, node & 0xFF], deeper[context, node & 0xFF]
        for i in range(len(levels) - 1, -1, -1):
            node, zeros, ones, weighted, own, _ = levels[i]
            if i < len(levels) - 1:
                parent = levels[i + 1][5]
                base, left = base[parent], left[parent]
            w = np.exp(own - weighted) / 2 if i else np.ones(len(node))
            base, left = base + left * w * (ones + 0.5) / (zeros + ones + 1), left * (1 - w)
        bits = np.stack([keys.astype(np.int64) >> (7 - b) & 1 for b in range(8)], 1)
        p = base[bit_node]
        return np.log10(np.where(bits == 1, p, 1 - p)).sum(1).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, keys, ns in zip(batch.column("part"), batch.column("keys"), batch.column("ns"), strict=True):
                logs = figures(*_learned(keys, ns))
                yield pa.record_batch({"part": pa.array([part.as_py()], pa.int64()), "keys": pa.array([keys.as_py()], pa.binary()), "logs": pa.array([logs.tobytes()], pa.binary())})

    return run


def _answer_grams(key: tuple, lists: pa.Table, figures: pa.Table) -> pa.Table:
    """The figures for the keys of some chunks of a part, one list for each of theirs."""
    known = np.frombuffer(figures.column("keys")[0].as_buffer(), np.uint64) if len(figures) else np.zeros(0, np.uint64)
    logs = np.frombuffer(figures.column("logs")[0].as_buffer(), np.float32) if len(figures) else np.zeros(0, np.float32)
    each = [np.frombuffer(k.as_buffer(), np.uint64) for k in lists.column("keys")]
    values = np.concatenate([logs[np.searchsorted(known, k)] for k in each]) if each else logs[:0]
    return _answer(key[0].as_py(), GRAMS, lists.column("chunk").to_pylist(), each, values)


def _finder(grams: np.ndarray, logs: np.ndarray):
    """The figure for each key by a table of rows per byte of context, over the bytes that occur, without any search."""
    seen = np.unique(grams.view(np.uint8)) if len(grams) else np.zeros(1, np.uint8)
    small = np.zeros(256, np.int64)
    small[seen] = np.arange(len(seen))
    a = len(seen)
    byte = lambda keys, d: small[(keys >> np.uint64(8 * (DEPTH - d)) & np.uint64(0xFF)).astype(np.int64)]
    steps, row = [], np.zeros(len(grams), np.int64)
    for d in range(DEPTH):
        at = row * a + byte(grams, d)
        contexts, row = np.unique(at, return_inverse=True)
        step = np.zeros(((steps[-1].max() if steps else 0) + 1) * a, np.int32)
        step[contexts] = np.arange(len(contexts))
        steps.append(step)
    table = np.zeros((len(np.unique(row)) or 1) * a, np.float32)
    table[row * a + byte(grams, DEPTH)] = logs

    def find(keys: np.ndarray) -> np.ndarray:
        row = np.zeros(len(keys), np.int64)
        for d, step in enumerate(steps):
            row = step[row * a + byte(keys, d)]
        return table[row.astype(np.int64) * a + byte(keys, DEPTH)].astype(np.float64)

    return find


def _score(parts: int, tokens: int, types: int):
    unknown = math.log10(0.1) - math.log10(tokens + 0.1 * (types + 1))

    def values(kind: int, keys: np.ndarray, told: dict, dtype: type) -> np.ndarray:
        part = part_of(kind, keys, parts)
        got = np.empty(len(keys), dtype)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.r_[True, part[order][1:] != part[order][:-1]]) if len(part) else []
        for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
            got[order[a:b]] = np.frombuffer(told[kind, int(part[order[a]])], dtype)
        return got

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        raws, learn = _texts(docs)
        told = {(k, p): v for k, p, v in zip(answers.column("kind").to_pylist(), answers.column("part").to_pylist(), answers.column("values").to_pylist(), strict=True)}
        pick = lambda yes: [r for r, x in zip(raws, learn, strict=True) if x == yes]

        grams, _ = chunk_grams(pick(True), pick(False))
        logs = values(GRAMS, grams, told, np.float32)
        score = np.empty(len(raws))
        find = _finder(grams, logs)
        for first, last, keys, begin in gram_keys(raws):
            score[first:last] = np.add.reduceat(np.where(keys < SKIP, find(keys), 0.0), begin)

        number: dict[bytes, int] = {}
        for w in chain.from_iterable(map(bytes.split, raws)):
            number.setdefault(w, len(number))
        hashed = np.fromiter(chain(map(word_key, number), [END_KEY]), np.uint64, len(number) + 1)
        distinct, place = np.unique(hashed, return_inverse=True)
        counts = values(WORDS, distinct, told, np.int64)[place]
        word_log = np.log10(counts + 0.1) - math.log10(tokens + 0.1 * (types + 1)) if tokens else np.full(len(counts), unknown)
        base, known, n = np.empty(len(raws)), np.empty(len(raws), np.int64), np.empty(len(raws), np.int64)
        for i, ws in enumerate(map(bytes.split, raws)):
            w = np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))
            n[i] = len(ws) + 1
            base[i] = word_log[w].sum() + word_log[-1]
            known[i] = (counts[w] > 0).sum() + (counts[-1] > 0)
        size = np.array([len(r) + 1 for r in raws])
        out = {"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(n), "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(n), tokens, np.int64)), "base_score": pa.array(base), "score": pa.array(score), "bits_per_byte": pa.array(-score / math.log10(2) / size)}
        return pa.table(out)

    return run


def score(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability), bits_per_byte.

    Learns from the rows for which ``held_out`` is not true.
    """
    spark = docs.sparkSession
    out = F.coalesce(held_out, F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), out.alias("held_out"), (~out).alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks, parts = max(least, -(-size // CHUNK)), max(least, -(-size // PER_PART))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    gathered = materialize(rows.groupBy("chunk").applyInArrow(_gather(parts), "chunk long, kind int, part long, keys binary, ns binary"), "gathered")
    words, grams = gathered.filter(F.col("kind") == WORDS), gathered.filter(F.col("kind") == GRAMS)
    summed = materialize(words.groupBy("part").applyInArrow(_sum_words, "chunk long, kind int, part long, values binary, tokens long, types long"), "words")
    total = summed.agg(F.sum("tokens"), F.sum("types")).first()
    learned = materialize(summed_grams(grams, chunks), "grams")
    tops = learned.mapInArrow(_weigh, "node long, zeros double, ones double, weighted double").groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("weighted")).toPandas().to_numpy(np.float64)
    held = spark.sparkContext.broadcast(top_of_tree(tops[:, 0].astype(np.int64), tops[:, 1], tops[:, 2], tops[:, 3]))
    told = learned.mapInArrow(_predict(held), "part long, keys binary, logs binary").withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((chunks - 1) // FAN).cast("long"))))
    asked = grams.withColumn("lot", F.expr(f"chunk div {FAN}"))
    predicted = asked.groupBy("part", "lot").cogroup(told.groupBy("part", "lot")).applyInArrow(_answer_grams, "chunk long, kind int, part long, values binary")
    answers = summed.select("chunk", "kind", "part", "values").unionByName(predicted)
    kind = dict(docs.select(doc_id).dtypes)[doc_id]
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(parts, int(total[0] or 0), int(total[1] or 0)), f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
