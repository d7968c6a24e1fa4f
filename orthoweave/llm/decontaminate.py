"""Benchmark decontamination: a prefix-filtered set join of item-sized windows with whole documents.

A window is a run of ``window`` item words (a shorter item is one window). Its word shingles are ordered by how rare they
are in the documents; as containment must be whole, the necessary prefix is the rarest shingle alone. Documents are
joined on it, the shingle's place bounds where the window can stand, and the window's words are then compared one by one.

Cases: a null text has no words and is clean; items without words have no window; equal windows of several items are
looked for once and count for each item; equal rows are judged one by one; a null item_id is left out of the list of
items; empty tables give no rows, or documents that are all clean; extra columns are ignored; a very long text is read
whole, and with many windows only the words around a likely place leave its task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orthoweave.llm.common import ascii_lower, materialize

#: Characters between words, of a text as it is written.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: More windows than these are joined by shuffle instead of being sent to every executor.
BROADCAST_WINDOWS = 100_000
#: Cells of 64 bits of the sieve that goes to every executor then, a power of two; a fuller sieve lets more through, and the
#: join that follows is exact.
SIEVE_CELLS = 1 << 18
#: A key that holds more than one in so many of all places asked for is split, so there are fewer split keys than that.
HOT = 1000
#: Parts of a split key.
SALTS = 64
#: The key of the row that stands for the document itself; a shingle with this key is told apart by its place.
SELF = -1


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), GAP)


def n_words(parts: Column) -> Column:
    """Without the empty pieces that split leaves at either end."""
    edge = lambda at: (F.element_at(parts, at) == "").cast("int")
    return (F.size(parts) - edge(1) - F.when(F.size(parts) > 1, edge(-1)).otherwise(0)).cast("long")


def _hashes(parts: Column) -> Column:
    """Unicode lower case is coarser than that of A-Z, so no equal words get apart; the comparison of windows is exact."""
    return F.transform(parts, lambda w: F.xxhash64(F.lower(w)))


def _shingle(hashes: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + i) for i in range(k)])


def item_windows(items: DataFrame, *, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """Distinct windows: words, len, k (words of a shingle), items (ids as sorted texts)."""
    parts = F.filter(_split(ascii_lower(F.col(text))), lambda w: w != "")
    got = items.select(F.col(item_id).cast("string").alias("item"), parts.alias("all")).filter(F.size("all") > 0)
    got = got.withColumn("len", F.least(F.size("all"), F.lit(window)))
    got = got.select("item", "len", "all", F.explode(F.sequence(F.lit(1), F.size("all") - F.col("len") + 1)).alias("at"))
    got = got.select("item", "len", F.slice("all", F.col("at"), F.col("len")).alias("window"))
    got = got.groupBy("window", "len").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return got.withColumn("k", F.least("len", F.lit(shingle)))


def _keys(df: DataFrame, sizes: list[int], n: Column | None, keep: list[str]) -> DataFrame:
    """A row for each place in the array h and each shingle size: keep, at, key; one more with the key SELF, unless n is None."""
    made = [_shingle(F.col("h"), F.col("at"), k) for k in sizes]
    if n is None:
        rows = df.select(*keep, "h", F.posexplode("h").alias("at", "ignored"))
        return rows.select(*keep, "at", made[0].alias("key") if len(made) == 1 else F.explode(F.array(*made)).alias("key"))
    rows = df.select(*keep, "h", F.posexplode(F.concat("h", F.array(F.lit(0).cast("long")))).alias("at", "ignored"))
    if len(made) == 1:
        return rows.select(*keep, "at", F.when(F.col("at") == n, F.lit(SELF).cast("long")).otherwise(made[0]).alias("key"))
    made = F.when(F.col("at") == n, F.array(F.lit(SELF).cast("long"))).otherwise(F.array(*made))
    return rows.select(*keep, "at", F.explode(made).alias("key"))


def _cell() -> Column:
    return F.shiftrightunsigned("key", 6).bitwiseAND(F.lit(SIEVE_CELLS - 1).cast("long"))


def _sieve(keys: DataFrame) -> DataFrame:
    """cell, bits: a bit for each key; SIEVE_CELLS rows at most, whatever the number of keys."""
    return keys.select(_cell().alias("cell"), F.expr("shiftleft(1L, cast(key & 63 AS int))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))


def _sift(rows: DataFrame, sieve: DataFrame) -> DataFrame:
    """The rows whose key may be one of the sieve's: all that are, and some others."""
    met = rows.join(F.broadcast(sieve), _cell() == F.col("cell"))
    return met.filter(F.expr("(shiftrightunsigned(bits, cast(key & 63 AS int)) & 1) = 1")).drop("cell", "bits")


def _spread(df: DataFrame, salts: Column | int) -> DataFrame:
    """Each row once for each salt below salts."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), (F.lit(salts) - 1).cast("int"))))


def _hits(spans: Column) -> Column:
    """Words in the union of spans (at, len)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda s, x: F.struct(F.greatest(s["end"], x["at"] + x["len"]).alias("end"), (s["hit"] + F.greatest(F.lit(0), x["at"] + x["len"] - F.greatest(s["end"], x["at"]))).cast("long").alias("hit")),
    )["hit"]


def _judged_by_shuffle(docs: DataFrame, places: DataFrame, sizes: list[int], *, doc_id: str, text: str, window: int) -> DataFrame:
    """doc_id, digest, n_words, n_hit, items, however many windows there are.

    A place of a document that passes the sieve is shuffled with the few words around it in which a window can stand, never
    with its document, and compared there. What is found is gathered by text, so copies count once, and joined back to the
    documents. Keys and texts that many rows share are salted.
    """
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest")
    parts = docs.select(_split(F.col(text)).alias("parts")).select(_hashes(F.col("parts")).alias("h"))
    counts = _sift(_keys(parts, sizes, None, []), _sieve(places.select("key"))).groupBy("key").agg(F.count("*").alias("n"))
    dealt = places.withColumn("salt", F.pmod(F.xxhash64("window"), F.lit(SALTS)).cast("int"))
    counts = _spread(counts.join(places.select("key").distinct(), "key"), SALTS)
    met = dealt.join(counts, ["key", "salt"]).groupBy("window", "len", "items", "places")
    # A shingle that no document holds has no row in counts; its window stands nowhere.
    rare = met.agg(F.min(F.struct("n", "key", "offset")).alias("rare"), F.count("*").alias("held")).filter("held = places")
    prefix = materialize(rare.select(F.array_join("window", " ").alias("window"), "len", "items", "rare.n", "rare.key", "rare.offset"), "prefixes")

    keys = prefix.groupBy("key").agg(F.max("n").alias("n"))
    total = keys.agg(F.sum("n")).first()[0] or 0
    hot = materialize(keys.filter(F.col("n") * HOT > total).select(F.col("key").alias("hot")), "hot-keys")
    split = lambda df: df.join(F.broadcast(hot), F.col("key") == F.col("hot"), "left")
    asked = _spread(split(prefix), F.when(F.col("hot").isNull(), 1).otherwise(SALTS)).drop("hot", "n")

    base = docs.select(F.col(doc_id).alias("doc_id"), digest, _split(F.col(text)).alias("parts"))
    rows = base.select("digest", "parts", F.xxhash64(F.col("doc_id").cast("string")).alias("seed"), _hashes(F.col("parts")).alias("h"))
    near = _sift(_keys(rows, sizes, None, ["digest", "parts", "seed"]), _sieve(prefix.select("key")))
    first = F.greatest(F.col("at") - (window - min(sizes)), F.lit(0))
    near = near.select("digest", "seed", "at", "key", first.alias("first"), F.slice("parts", first + 1, F.lit(2 * window)).alias("around"))
    salt = F.when(F.col("hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("seed", "digest", "at"), F.lit(SALTS)).cast("int"))
    near = split(near).withColumn("salt", salt).drop("hot", "seed")
    found = near.join(asked, ["key", "salt"]).withColumn("start", F.col("at") - F.col("offset"))
    # A slice ends at the text's end, and then differs from the window.
    same = ascii_lower(F.array_join(F.slice("around", F.greatest(F.col("start") - F.col("first") + 1, F.lit(1)), F.col("len")), " ")) == F.col("window")
    found = found.filter((F.col("start") >= F.col("first")) & same)
    spans, sets = F.collect_set(F.struct(F.col("start").alias("at"), "len")).alias("spans"), F.collect_set("items").alias("sets")
    hits = found.groupBy("digest").agg(spans, sets, F.count("*").alias("rows"))
    # Each copy of a text has a row for each span.
    hits = hits.select("digest", _hits(F.col("spans")).alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"), (F.col("rows") / F.size("spans")).alias("copies"))
    hits = materialize(hits, "hits")
    often = F.broadcast(hits.filter(F.col("copies") * HOT > docs.count()).select("digest", F.lit(True).alias("often")))
    hits = _spread(hits.join(often, "digest", "left"), F.when(F.col("often"), SALTS).otherwise(1)).drop("often", "copies")
    every = base.select("doc_id", "digest", n_words(F.col("parts")).alias("n_words")).join(often, "digest", "left")
    salt = F.when(F.col("often"), F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(SALTS)).cast("int")).otherwise(0)
    got = every.withColumn("salt", salt).join(hits, ["digest", "salt"], "left")
    return got.select("doc_id", "digest", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _judged(docs: DataFrame, places: DataFrame, sizes: list[int], *, doc_id: str, text: str, with_digest: bool) -> DataFrame:
    """doc_id, n_words, n_hit, items and the digest, where the windows are few enough to be sent to every executor."""
    asked = F.broadcast(places.select("key").distinct())
    parts = docs.select(_split(F.col(text)).alias("parts")).select(_hashes(F.col("parts")).alias("h"))
    counts = _keys(parts, sizes, F.size("h"), []).join(asked, "key").groupBy("key").agg(F.count("*").alias("n"))
    ranked = places.join(counts, "key", "left").groupBy("window", "len", "items").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset")).alias("rare"))
    prefix = materialize(ranked.select(F.array_join("window", " ").alias("window"), "len", "items", "rare.key", "rare.offset"), "prefixes")
    own = prefix.sparkSession.range(1).select(F.lit("").alias("window"), F.lit(0).alias("len"), F.array().cast("array<string>").alias("items"), F.lit(SELF).cast("long").alias("key"), F.lit(0).alias("offset"))
    prefix = prefix.unionByName(own).withColumnRenamed("key", "asked")

    digest = [F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("digest")] if with_digest else []
    held = ["uid", "doc_id", "parts", "n"] + ["digest"] * with_digest
    base = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"), *digest, _split(F.col(text)).alias("parts"))
    base = base.select("*", n_words(F.col("parts")).alias("n"), _hashes(F.col("parts")).alias("h"))
    met = _keys(base, sizes, F.size("h"), held)
    is_self = (F.col("len") == 0) & (F.col("at") == F.size("parts"))
    start = F.col("at") - F.col("offset")
    stands = (F.col("len") > 0) & (start >= 0) & (start + F.col("len") <= F.size("parts"))
    # Only expressions that compile, or rows would carry whole texts from here on. No word holds a blank.
    same = ascii_lower(F.array_join(F.slice("parts", F.greatest(start + 1, F.lit(1)), F.greatest("len", F.lit(0))), " ")) == F.col("window")
    found = met.join(F.broadcast(prefix), F.col("key") == F.col("asked")).filter(is_self | (stands & same))
    span = F.when(F.col("len") > 0, F.struct(start.alias("at"), F.col("len").alias("len")))
    got = found.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("n").alias("n_words"), F.collect_list(span).alias("spans"), F.collect_set("items").alias("sets"), *[F.max("digest").alias("digest")] * with_digest)
    items_of = F.array_sort(F.array_distinct(F.flatten("sets")))
    return got.select("doc_id", "n_words", _hits(F.col("spans")).alias("n_hit"), items_of.alias("items"), *["digest"] * with_digest)


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, shingle: int = 5, share: int = 20, with_digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted texts), contaminated: some word is hit, and one in ``share``."""
    windows = materialize(item_windows(items, item_id=item_id, text=item_text, window=window, shingle=shingle), "windows")
    sizes = [r[0] for r in windows.select("k").distinct().sort("k").collect()] or [shingle]  # as many values as a shingle has words
    few = windows.count() <= BROADCAST_WINDOWS

    # Every shingle of each window with its place, then its frequency in the documents: the rarest one is the prefix.
    hashed = windows.withColumn("h", _hashes(F.col("window")))
    places = None
    for k in sizes:
        part = hashed.filter(F.col("k") == k).select("window", "len", "items", "k", "h", F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("offset")).select("window", "len", "items", "k", "offset", _shingle(F.col("h"), F.col("offset"), k).alias("key"))
        places = part if places is None else places.unionByName(part)
    if few:
        got = _judged(docs, places, sizes, doc_id=doc_id, text=text, with_digest=with_digest)
    else:
        counted = places.withColumn("places", (F.col("len") - F.col("k") + 1).cast("long"))
        got = _judged_by_shuffle(docs, counted, sizes, doc_id=doc_id, text=text, window=window)
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"), *["digest"] * with_digest)


def drop_contaminated(docs: DataFrame, items: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns. A text decides alone, whatever its row's id."""
    bad = contamination(docs, items, text=text, with_digest=True, **options).filter("contaminated").select(F.col("digest").alias("bad_digest")).distinct()
    return docs.join(bad, F.md5(F.coalesce(docs[text], F.lit("")).cast("binary")) == F.col("bad_digest"), "left_anti")
