"""Hierarchical packing of documents into sequences of several lengths.

A document's ids are cut into full windows of the longest tier; what remains is
routed to the shortest tier that holds it. Tiers are packed from the longest
down: each remainder opens a window of its tier, whose gap is filled with the
best fitting pieces of shorter tiers and, where none fits, by cutting one. All
windows of a block come out full. Windows of a tier are then dealt into step groups
of STEP_TOKENS tokens such that the groups' costs (sum of squared piece lengths) are
near equal.

Each task packs the rows of its own input partition in blocks of bounded size,
without a shuffle. What is left at its end (less than a window) goes with the
leftovers of GROUP - 1 other tasks into one more packing; its tail of fewer
tokens than the shortest tier is split into sequences that are powers of two,
which need no padding.

Defined results: a null text is empty and still has the closing id; repeated
rows and null doc_ids are documents of their own; an empty table gives an empty
table; other columns are ignored. Sequence ids depend on how the input is split
into partitions, and on nothing else.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, tokens

TIERS = (512, 1024, 2048, 4096)
CLOSING_ID = 2
#: Tokens of a block, of a step group; tasks whose leftovers are packed together.
BLOCK, STEP_TOKENS, GROUP = 1 << 20, 1 << 16, 64
WIDTH = tokens.WIDTH


class Packer:
    """Packs pieces (doc, start, ids) into windows; made() gives the rows so far and forgets them."""

    def __init__(self, base: int, tiers: tuple[int, ...] = TIERS, block: int = BLOCK, step_tokens: int = STEP_TOKENS) -> None:
        self.base, self.tiers, self.block, self.step_tokens = base, sorted(tiers, reverse=True), block, step_tokens
        self.docs: dict[int, tuple] = {}
        self.pool: list[tuple[int, int, int, bytes]] = []  # (length, document's number, start, ids), sorted
        self.pooled, self.docs_seen, self.sequences, self.steps = 0, 0, 0, 0
        self.windows: list[tuple[int, list]] = []
        self.ready: list[tuple] = []

    def add(self, doc_id: object, ids: bytes, start: int = 0, doc_tokens: int | None = None) -> None:
        n, longest, doc = len(ids) // WIDTH, self.tiers[0], self.docs_seen
        self.docs_seen += 1
        self.docs[doc] = (doc_id, n if doc_tokens is None else doc_tokens)
        full = n // longest * longest
        for at in range(0, full, longest):
            self.windows.append((longest, [(longest, doc, start + at, ids[at * WIDTH : (at + longest) * WIDTH])]))
        if n > full:
            insort(self.pool, (n - full, doc, start + full, ids[full * WIDTH :]))
            self.pooled += n - full
        if self.pooled >= self.block or len(self.windows) * longest >= self.block:
            self.pack()

    def fill(self, size: int, window: list) -> int:
        """Adds pieces until the window is full or the pool empty; returns the gap."""
        gap = size - sum(p[0] for p in window)
        while gap and self.pool:
            at = bisect_right(self.pool, gap, key=lambda p: p[0])
            if at:
                piece = self.pool.pop(at - 1)
            else:  # all are longer: cut the shortest
                n, doc, start, ids = self.pool.pop(0)
                piece = (gap, doc, start, ids[: gap * WIDTH])
                insort(self.pool, (n - gap, doc, start + gap, ids[gap * WIDTH :]))
            window.append(piece)
            gap -= piece[0]
        return gap

    def pack(self, last: bool = False) -> None:
        for size, shorter in zip(self.tiers, [*self.tiers[1:], 0]):
            while self.pool and self.pool[-1][0] > shorter:
                window: list = []
                n, doc, start, ids = self.pool.pop()
                if n > size:  # left by a longer tier that it could not fill: cut it
                    insort(self.pool, (n - size, doc, start + size, ids[size * WIDTH :]))
                    n, ids = size, ids[: size * WIDTH]
                window.append((n, doc, start, ids))
                if self.fill(size, window):
                    for piece in window:
                        insort(self.pool, piece)
                    break
                self.windows.append((size, window))
        if last:  # what fills no window of the tier it belongs to
            left = sum(p[0] for p in self.pool)
            while left:
                size, window = min(self.tiers[0], 1 << (left.bit_length() - 1)), []
                self.fill(size, window)
                self.windows.append((size, window))
                left -= size
        self.pooled = sum(p[0] for p in self.pool)
        self.deal()
        held = {p[1] for p in self.pool}
        self.docs = {k: v for k, v in self.docs.items() if k in held}

    def deal(self) -> None:
        """Gives windows their step groups, and makes rows of them."""
        by_tier: dict[int, list] = {}
        for size, window in self.windows:
            by_tier.setdefault(size, []).append((sum(p[0] ** 2 for p in window), self.sequences, window))
            self.sequences += 1
        for size, windows in sorted(by_tier.items()):
            groups = -(-len(windows) * size // self.step_tokens)
            for k, (_, sequence, window) in enumerate(sorted(windows, key=lambda w: (-w[0], w[1]))):
                lap, place = divmod(k, groups)  # there and back, so that each group gets costly and cheap ones
                step = self.steps + (place if lap % 2 == 0 else groups - 1 - place)
                offset = 0
                for n, doc, start, ids in window:
                    doc_id, doc_tokens = self.docs[doc]
                    self.ready.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, self.base + sequence, offset, size, self.base + step, ids))
                    offset += n
            self.steps += groups
        self.windows = []

    def made(self) -> list[tuple]:
        out, self.ready = self.ready, []
        return out

    def leftovers(self) -> list[tuple]:
        """(doc_id, start, length, crc, doc_tokens, ids) of what is in no window."""
        return [(self.docs[d][0], start, n, zlib.crc32(ids), self.docs[d][1], ids) for n, d, start, ids in self.pool]


def _schema(doc_id: T.DataType) -> T.StructType:
    long = T.LongType()
    kinds = {"doc_id": doc_id, "start": long, "length": long, "ids_crc32": long, "doc_tokens": long, "sequence_id": long, "offset": long, "tier": T.IntegerType(), "step_group": long, "ids": T.BinaryType(), "part": long, "place": long}
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def pack(docs: DataFrame, vocabulary: str, tiers: tuple[int, ...] = TIERS, closing_id: int = CLOSING_ID, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids.

    vocabulary: path of a tokenizers file, the same on all executors. tier is
    the sequence's length. ids are little-endian unsigned 32-bit ids (null
    without with_ids).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _schema(docs.schema["doc_id"].dataType)
    arrow = to_arrow_schema(schema)
    closing = closing_id.to_bytes(WIDTH, "little")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, model = Packer(part << 32, tiers), tokens.word_ids(vocabulary)

        def rows() -> list[tuple]:
            return [(*r[:-1], r[-1] if with_ids else None, part, None) for r in packer.made()]

        for whole in batches:
            for at in range(0, whole.num_rows, common.SLICE):
                batch = whole.slice(at, common.SLICE)
                texts = [raw.decode("utf-8", "replace") for raw in common.text_bytes(batch)]
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), model.encode_many(texts)):
                    packer.add(doc_id, ids + closing)
                if packer.ready:
                    yield _batch(rows(), arrow)
        model.forget()
        packer.pack()
        left = [(*r[:5], None, None, None, None, r[5], part, k) for k, r in enumerate(packer.leftovers())]
        yield _batch(rows() + left, arrow)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                groups.setdefault(r["part"] // GROUP, []).append(r)
        for group, rows in sorted(groups.items()):
            packer = Packer((1 << 62) + (group << 32), tiers)
            for r in sorted(rows, key=lambda r: (r["part"], r["place"])):
                packer.add(r["doc_id"], r["ids"], r["start"], r["doc_tokens"])
            packer.pack(last=True)
            yield _batch([(*r[:-1], r[-1] if with_ids else None, group, None) for r in packer.made()], arrow)

    made = common.staged(common.arrow_map(docs.select("doc_id", "text"), first, schema), "packed")
    left = made.where("sequence_id IS NULL").withColumn("_group", F.floor(F.col("part") / GROUP)).repartition("_group").drop("_group")
    return made.where("sequence_id IS NOT NULL").unionByName(common.arrow_map(left, second, schema)).drop("part", "place")


def op1_pack_hierarchical(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "text"])
    out = pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")
