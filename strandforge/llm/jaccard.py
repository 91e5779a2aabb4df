"""Similarity join on word n-grams: rare-first prefix filtering, verified once a pair.

A document's set holds the 64-bit hashes of its distinct n-grams. Equal sets
are one class with one key, so copies never meet each other. Texts are read
once: each task cuts its classes into chunks and deals their n-grams (GRAM_BITS of the hash,
which is enough to tell them apart, and the class's number in the chunk) to buckets
of n-grams. A bucket counts how many classes have each n-gram and sends only those
of two or more classes back to the chunk. An n-gram of one class links nothing, but it has its place in
the order: sets are ordered by this exact count, rare first, then by hash.

Two sets of n and m members with a Jaccard similarity of num / den share
`overlap` = ceil(num / (num + den) (n + m)) members or more. So, in the first
n-gram that they have in common, both stand with `overlap` members left (prefix and positional
filter, joined on that n-gram); their lengths are similar (length filter); and the
members that differ, at least those that no other set has and the differences
of how many each has in four ranges of the hash, are at most
n + m - 2 overlap (suffix filter). All four are conditions of the join, so a
pair that fails one is never made. The pairs that are left are verified once
each, with all members that other sets have too.

To keep large groups of near copies from making all pairs, it goes in rounds.
Twice each n-gram's classes of similar lengths are paired with one of them, the
one with the fewest members of its own (a star); connected classes get a component.
Then only pairs of different components are made, for each n-gram those
outside its largest component against all; so no link between components is lost, and
pairs within a component, which cannot change it, are never made.

N-grams that are very common in a bounded sample of documents (SAMPLE_ROWS)
count as the most frequent of all without being counted and go to their chunk
directly, so that no bucket gets a common passage of the whole corpus; this
changes transport and speed and never the result, as the order is the same for all sets.

Defined results: null texts and texts without words have the empty set, which
is linked with nothing; texts with fewer words than an n-gram have one n-gram of all
words; a null doc_id takes part, and its component is named by the smallest
doc_id that is not null (null if there is none); rows alike are one class;
an empty table gives an empty table; other columns are ignored. A partition of
the input that is read again must give the same rows in the same order, as a table in files
does.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .shingles import Shingles

#: Words of an n-gram; similarity as num / den.
WORDS, NUM, DEN = 5, 80, 100
#: Bits of a class's number in its chunk; the other bits of an entry are the n-gram's.
CLASS_BITS = 13
GRAM_BITS = 64 - CLASS_BITS
#: Entries of a chunk (more for one text); bytes of text for a bucket of n-grams; keys that a task remembers to skip copies.
CHUNK, BUCKET_BYTES, SEEN = 1 << 20, 16 << 20, 100_000
#: Documents of the sample that finds very common n-grams, and the share of them that makes one.
SAMPLE_ROWS, COMMON = 4_000, 0.01
#: The class of frequency of a very common n-gram, the last one.
LAST = np.uint16(65535)
#: Ranges of the hash that the suffix filter compares, and bits of a range's count (a lower bound where it is full).
RANGES, RANGE_BITS = 4, 16
#: Partners of a centre that are verified together.
TOGETHER = 512


def key_of(grams: np.ndarray) -> int:
    """A signed 64-bit key of a set (its sorted hashes)."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def need_of(n, num: int, den: int):
    """The least overlap of a set of n with any other: ceil(num / den * n)."""
    return -(-n * num // den)


def overlap_of(a, b, num: int, den: int):
    """The least overlap of sets of a and b members: ceil(num / (num + den) * (a + b))."""
    return -(-(a + b) * num // (num + den))


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int, alone: tuple[int, int] = (0, 0)) -> bool:
    """den * |both| >= num * |either|; x and y sorted. alone: members of each that are left out of x and y, as no other set has them."""
    n, m = len(x) + alone[0], len(y) + alone[1]
    if not n or not m or min(n, m) * den < num * max(n, m):
        return False
    most = len(x) + len(y) - 2 * overlap_of(n, m, num, den)  # members of x and y that may differ
    if most < 0 or _differ(x, y, 3) > most:  # the suffix filter
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return den * both >= num * (n + m - both)


def _differ(x: np.ndarray, y: np.ndarray, depth: int) -> int:
    """A lower bound of how many members differ, by halving both at the same pivot."""
    if not depth or not len(x) or not len(y):
        return abs(len(x) - len(y))
    pivot = y[len(y) // 2]
    i, j = int(np.searchsorted(x, pivot)), len(y) // 2
    return _differ(x[:i], y[:j], depth - 1) + _differ(x[i:], y[j:], depth - 1)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, common.SLICE):
            yield whole.slice(at, common.SLICE)


#: Kinds of rows: a document; a chunk's n-grams in a bucket; a chunk's classes; a chunk's very common n-grams.
DOC, GRAMS, CLASSES, VERY = range(4)


def _read_schema(doc_id: T.DataType) -> T.StructType:
    long, binary = T.LongType(), T.BinaryType()
    kinds = {"kind": T.IntegerType(), "doc_id": doc_id, "n": long, "key": long, "bucket": T.IntegerType(), "chunk": long, "entries": binary, "counts": binary}
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


def _planes(x: np.ndarray) -> bytes:
    """The bytes of x, first the first byte of every number: sorted numbers compress well so."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _numbers(blob: pa.Scalar, kind: str) -> np.ndarray:
    planes = np.frombuffer(blob.as_buffer(), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _rows(arrow: pa.Schema, size: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array) else columns.get(f.name, pa.nulls(size, f.type)) for f in arrow]
    return pa.RecordBatch.from_arrays(arrays, schema=arrow)


def read_sets(docs: DataFrame, words: int, buckets: int, very: np.ndarray) -> DataFrame:
    """Rows of _read_schema: DOC (doc_id, n, key), CLASSES (keys and sizes of a chunk), GRAMS and VERY (its entries).

    very: sorted n-grams that are very common. All rows have a bucket to be dealt by.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    import xxhash

    schema = _read_schema(docs.schema["doc_id"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, part = Shingles(words), TaskContext.get().partitionId()
        edges = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets) << np.uint64(32)
        seen: set[int] = set()
        keys: list[int] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        size = made = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size, made
            if not keys:
                return
            names = np.array([keys, sizes], "<i8").tobytes()
            chunk = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(names + f"{part} {made}".encode()))))
            spread, made = (part + made) % buckets, made + 1
            yield _rows(arrow, 1, kind=[CLASSES], bucket=[spread], chunk=[chunk], entries=[names])
            entries = np.concatenate(held)
            entries.sort()
            if len(very):
                gram = entries >> np.uint64(CLASS_BITS)
                common_one = very[np.minimum(np.searchsorted(very, gram), len(very) - 1)] == gram
                if common_one.any():
                    yield _rows(arrow, 1, kind=[VERY], bucket=[spread], chunk=[chunk], entries=[_planes(entries[common_one])])
                    entries = entries[~common_one]
            cuts = [0, *np.searchsorted(entries, edges).tolist(), len(entries)]
            which = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
            yield _rows(arrow, len(which), kind=[GRAMS] * len(which), bucket=which, chunk=[chunk] * len(which), entries=[_planes(entries[cuts[k] : cuts[k + 1]]) for k in which])
            for x in (keys, sizes, held):
                x.clear()
            size = 0

        for b in _sliced(batches):
            ns, own = [], []
            for grams in shingles.many(list(common.text_bytes(b))):
                n = len(grams)
                key = key_of(grams) if n else None
                ns.append(n)
                own.append(key)
                if not n or key in seen:  # a copy; one that another task has, or that is forgotten here, only adds to counts
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                held.append((grams >> np.uint64(CLASS_BITS) << np.uint64(CLASS_BITS)) | np.uint64(len(keys)))
                keys.append(key)
                sizes.append(n)
                size += n
                if size >= CHUNK or len(keys) == 1 << CLASS_BITS:
                    yield from flush()
            yield _rows(arrow, b.num_rows, kind=[DOC] * b.num_rows, doc_id=b.column("doc_id"), n=ns, key=own, bucket=[(part + i) % buckets for i in range(b.num_rows)])
        yield from flush()

    return common.arrow_map(docs.select("doc_id", "text"), run, schema)


def _counted(blobs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a bucket that two or more classes have, sorted, and how many have them."""
    grams = np.concatenate(blobs) >> np.uint64(CLASS_BITS)
    grams.sort()
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(grams)))
    many = counts > 1
    return grams[first[many]], counts[many]


def _add(by: dict[int, list[tuple[int, np.ndarray]]], b: pa.RecordBatch) -> None:
    """Adds the GRAMS rows of b to their buckets, as (chunk, entries)."""
    grams = b.filter(pc.equal(b.column("kind"), GRAMS))
    for k, chunk, blob in zip(grams.column("bucket").to_pylist(), grams.column("chunk").to_pylist(), grams.column("entries")):
        by.setdefault(k, []).append((chunk, _numbers(blob, "<u8")))


def very_common(docs: DataFrame, words: int, rows: int, buckets: int) -> np.ndarray:
    """N-grams that COMMON of a sample of about SAMPLE_ROWS documents have: at most the mean size of a set / COMMON."""
    spark = docs.sparkSession
    chance = min(1.0, SAMPLE_ROWS / max(1, rows))
    least = max(16, COMMON * min(rows, SAMPLE_ROWS))
    sample = docs.where(F.pmod(F.xxhash64(F.lit("n-grams"), "doc_id"), F.lit(1 << 20)) < int(chance * (1 << 20)))

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[tuple[int, np.ndarray]]] = {}
        for b in batches:
            _add(by, b)
        for blobs in by.values():
            grams, counts = _counted([e for _, e in blobs])
            yield pa.RecordBatch.from_arrays([pa.array(grams[counts >= least].astype(np.int64))], names=["gram"])

    dealt = read_sets(sample, words, buckets, np.zeros(0, np.uint64)).where(F.col("kind") == GRAMS).repartition(buckets, "bucket")
    found = spark.createDataFrame([], "gram long") if rows < least else common.arrow_map(dealt, often, "gram long")
    return np.sort(np.array([r[0] for r in found.collect()], np.uint64))


def shared_grams(read: DataFrame, buckets: int) -> DataFrame:
    """read's rows, of GRAMS only the entries that two or more classes have, with their classes of frequency in counts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(read.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[tuple[int, np.ndarray]]] = {}
        for b in batches:
            _add(by, b)
            rest = b.filter(pc.not_equal(b.column("kind"), GRAMS))
            yield pa.RecordBatch.from_arrays(rest.columns, schema=arrow)
        for k in sorted(by):
            blobs = by.pop(k)
            grams, counts = _counted([e for _, e in blobs])
            if not len(grams):
                continue
            kinds = np.where(counts < 32768, counts, np.minimum(65534, 32768 + 256 * np.log2(np.maximum(counts, 1) / 32768.0))).astype("<u2")
            out: dict[str, list] = {"chunk": [], "entries": [], "counts": []}
            for chunk, entries in blobs:
                own = entries >> np.uint64(CLASS_BITS)
                at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                hit = grams[at] == own
                if hit.any():
                    out["chunk"].append(chunk)
                    out["entries"].append(_planes(entries[hit]))
                    out["counts"].append(_planes(kinds[at[hit]]))
            size = len(out["chunk"])
            yield _rows(arrow, size, kind=[GRAMS] * size, **out)

    return common.arrow_map(read.repartition(buckets, "bucket"), run, read.schema)


#: A row of the index: an n-gram of a set's prefix; the set, its members, those of its own; where the n-gram stands; how many others the set has in each range.
INDEX = ["gram", "key", "n", "own", "pos", "ranges"]
_INDEX = "gram long, key long, n int, own int, pos int, ranges long"


def prefixes(shared: DataFrame, num: int, den: int) -> DataFrame:
    """INDEX rows of all sets' prefixes, and a row (key, n, grams) for each set that has one: its members that others have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, dict[str, list]] = {}
        for b in batches:
            for kind, chunk, entries, counts in zip(b.column("kind").to_pylist(), b.column("chunk").to_pylist(), b.column("entries"), b.column("counts")):
                own = chunks.setdefault(chunk, {"classes": [], "entries": [], "counts": []})
                if kind == CLASSES:
                    own["classes"].append(np.frombuffer(entries.as_buffer(), "<i8"))
                    continue
                own["entries"].append(_numbers(entries, "<u8"))
                own["counts"].append(_numbers(counts, "<u2") if kind == GRAMS else np.full(len(own["entries"][-1]), LAST))
        for name in sorted(chunks):
            chunk = chunks.pop(name)
            if len(chunk["classes"]) != 1:
                raise RuntimeError("a partition of the documents changed when it was read again: write them to a table first")
            if chunk["entries"]:
                yield from one(*chunk["classes"][0].reshape(2, -1), np.concatenate(chunk["entries"]), np.concatenate(chunk["counts"]))

    def one(keys, n, entries, counts) -> Iterator[pa.RecordBatch]:
        whose, gram = (entries & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64), entries >> np.uint64(CLASS_BITS)
        order = np.lexsort((gram, counts, whose))
        whose, gram = whose[order], gram[order]
        size = np.bincount(whose, minlength=len(keys))
        start = np.cumsum(size) - size
        own = n - size  # members that no other set has come first
        pos = own[whose] + np.arange(len(whose)) - start[whose]
        ranges = np.bincount(whose * RANGES + (gram >> np.uint64(GRAM_BITS - 2)).astype(np.int64), minlength=RANGES * len(keys)).reshape(-1, RANGES)
        packed = (np.minimum(ranges, (1 << RANGE_BITS) - 1).astype(np.uint64) << (np.arange(RANGES, dtype=np.uint64) * np.uint64(RANGE_BITS))).sum(axis=1, dtype=np.uint64)
        kept = pos <= (n - need_of(n, num, den))[whose]
        at = whose[kept]
        long, short = (lambda x: pa.array(x.astype(np.int64))), (lambda x: pa.array(x.astype(np.int32)))
        if len(at):
            columns = [long(gram[kept]), long(keys[at]), short(n[at]), short(own[at]), short(pos[kept]), long(packed[at])]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(at), pa.binary())], names=[*INDEX, "grams"])
        has = np.unique(at)
        for some in np.array_split(has, -(-len(has) // common.SLICE)) if len(has) else []:
            blobs = [np.sort(gram[start[k] : start[k] + size[k]]).tobytes() for k in some]
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays([none, long(keys[some]), short(n[some]), short(own[some]), none.cast(pa.int32()), none, pa.array(blobs, pa.binary())], names=[*INDEX, "grams"])

    dealt = shared.where(F.col("kind") != DOC).select("kind", "chunk", "entries", "counts").repartition("chunk")
    return common.arrow_map(dealt, run, f"{_INDEX}, grams binary")


Side = Callable[[str], Column]


def possible(x: Side, y: Side, num: int, den: int) -> Column:
    """Whether two index rows of one n-gram can be a linked pair's first n-gram in common: length, positional and suffix filter."""
    n, m = x("n").cast("long"), y("n").cast("long")
    overlap = -F.floor(-(n + m) * num / (num + den))
    part = lambda side, i: F.shiftrightunsigned(side("ranges"), RANGE_BITS * i).bitwiseAND((1 << RANGE_BITS) - 1)
    differ = reduce(lambda a, b: a + b, (F.abs(part(x, i) - part(y, i)) for i in range(RANGES)), x("own") + y("own"))
    return (F.least(n, m) * den >= F.greatest(n, m) * num) & (F.least(n - x("pos"), m - y("pos")) >= overlap) & (differ <= n + m - 2 * overlap)


def _pairs(joined: DataFrame, x: Side, y: Side) -> DataFrame:
    return joined.select(F.least(x("key"), y("key")).alias("a"), F.greatest(x("key"), y("key")).alias("b")).distinct()


def star_pairs(known: DataFrame, num: int, den: int, shift: float) -> DataFrame:
    """Candidate pairs (a, b) of each n-gram's sets with one of their range of lengths, in another component.

    known: INDEX and comp. Ranges are such that lengths in one are similar; shift moves their
    borders. It is one aggregate and a join, so that a frequent n-gram's sets need not meet in a task.
    """
    ranged = known.withColumn("range", F.floor(F.log("n") / math.log(den / num) + shift))
    least = F.min(F.struct("own", "key", "comp", "n", "pos", "ranges")).alias("centre")
    centres = ranged.groupBy("gram", "range").agg(least, F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    x, y = (lambda c: F.col(f"centre.{c}")), F.col
    joined = ranged.join(centres, ["gram", "range"]).where((x("comp") != y("comp")) & possible(x, y, num, den))
    return _pairs(joined, x, y)


def cross_pairs(known: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate pairs (a, b) of sets in different components. known: INDEX and comp.

    Of the sets that have an n-gram, those outside their largest component are
    joined with all; pairs that fail a filter are not made.
    """
    sizes = known.groupBy("gram", "comp").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("gram").agg(F.max(F.struct("size", "comp"))["comp"].alias("main"), F.count("*").alias("comps")).where("comps > 1").select("gram", "main")
    every = known.join(largest, "gram")
    columns = [c for c in every.columns if c != "gram"]
    left = every.where("comp <> main").select(F.col("gram").alias("x_gram"), *[F.col(c).alias(f"x_{c}") for c in columns])
    right = every.select(F.col("gram").alias("y_gram"), *[F.col(c).alias(f"y_{c}") for c in columns])
    x, y = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
    once = (y("comp") == y("main")) | (x("key") < y("key"))
    on = (x("gram") == y("gram")) & (x("comp") != y("comp")) & once & possible(x, y, num, den)
    return _pairs(left.join(right, on), x, y)


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are linked. Each a meets TOGETHER of its partners or so at a time."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / TOGETHER).alias("_parts"))
    dealt = pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("long"))
    need = dealt.select("a", "part", F.col("b").alias("key")).unionByName(dealt.select("a", "part", F.col("a").alias("key")).distinct())
    placed = need.join(sets, "key").repartition("a", "part").sortWithinPartitions("a", "part", F.col("key") != F.col("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own, grams, alone = None, None, None, 0
        for b in batches:
            left, right = [], []
            for a, part, key, none, blob in zip(*(b.column(c).to_pylist() for c in ("a", "part", "key", "own", "grams"))):
                these = np.frombuffer(blob, "<u8")
                if key == a:
                    centre, own, grams, alone = a, part, these, none
                elif (a, part) == (centre, own) and linked(grams, these, num, den, (alone, none)):
                    left.append(a)
                    right.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return common.arrow_map(placed.select("a", "part", "key", "own", "grams"), run, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(key, comp): the smallest key that each key of edges (a, b) can reach, by alternating large and small stars."""
    e = common.staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    mark = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        e = common.staged(e, "stars")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("key"), F.col("v").alias("comp")).unionByName(e.select(F.col("v").alias("key"), F.col("v").alias("comp")).distinct())


def similarity_join(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, n, key), links (a, b) between classes, and (key, comp) of linked classes.

    links hold every verified pair: those of stars and all between components
    of stars. Pairs within a component of stars are not all listed.
    """
    spark = docs.sparkSession
    size = docs.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size["bytes"] // BUCKET_BYTES))
    very = very_common(docs, words, size["rows"], buckets)
    read = common.staged(shared_grams(read_sets(docs, words, buckets, very), buckets), "sets")
    rows = read.where(F.col("kind") == DOC).select("doc_id", "n", "key")
    made = common.staged(prefixes(read, num, den), "prefixes")
    index = made.where("gram IS NOT NULL").select(*INDEX)
    several = index.groupBy("gram").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("gram")
    index = common.staged(index.join(several, "gram", "left_semi"), "index")
    sets = made.where("grams IS NOT NULL").select("key", "own", "grams").join(index.select("key").distinct(), "key", "left_semi")
    sets = common.staged(sets.dropDuplicates(["key"]), "members")
    tried = links = comps = None
    for shift in (0.0, 0.5, None):
        known = index.withColumn("comp", F.col("key")) if comps is None else index.join(comps, "key", "left").select(*INDEX, F.coalesce("comp", "key").alias("comp"))
        pairs = cross_pairs(known, num, den) if shift is None else star_pairs(known, num, den, shift)
        pairs = common.staged(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = common.staged(verified(pairs, sets, num, den), "links")
        tried, links = (pairs, found) if tried is None else (tried.unionByName(pairs), links.unionByName(found))
        if comps is None or not found.isEmpty():
            settled = [] if comps is None else [comps.select(F.col("key").alias("a"), F.col("comp").alias("b"))]
            comps = common.staged(components(reduce(DataFrame.unionByName, settled, found)), "components")
    return rows, links, comps


def near_groups(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each row of docs."""
    rows, _, comps = similarity_join(docs, words, num, den)
    one = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("low"))
    named = one.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = common.staged(named.join(lowest, "comp").select("key", "component_id"), "named")
    return rows.join(named, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """The documents of docs of which one of each group stays: the one with the smallest doc_id.

    Of several rows with that doc_id the one with the smallest text stays. Rows
    without a doc_id stay only where no row of their group has one; those are
    told apart by their text.
    """
    groups = common.staged(near_groups(docs, words, num, den), "groups")
    stays = F.col("doc_id") == F.col("component_id")
    ids = groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.count_if(stays).alias("_rows"), F.max(F.when(stays, F.col("n_shingles"))).alias("_n"))
    # what goes is less than what stays; written, so that its size decides how it is joined
    other = common.staged(ids.where("_rows = 0 OR (_rows > 1 AND _n > 0)"), "gone")
    on = F.col("doc_id") == F.col("_id")
    single = docs.where("doc_id IS NOT NULL").join(other, on, "left_anti")
    several = docs.join(other.where("_rows > 1"), on, "left_semi")
    first = Window.partitionBy("doc_id").orderBy("text")
    several = several.withColumn("_first", F.row_number().over(first)).where("_first = 1").drop("_first")
    nameless = docs.where("doc_id IS NULL").dropDuplicates(["text"])
    return reduce(DataFrame.unionByName, [single, several, nameless])


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "text"])
    return near_groups(docs, words=4, num=85, den=100)
