"""Token counts by overlap resynchronisation, and ids from tokenizer files.

A text longer than a chunk is encoded in overlapping chunks. Each chunk's tokens get offsets;
in the overlap of two neighbours, a place where both have a token boundary and
which no piece of the vocabulary can straddle is a proven stable boundary: what
comes before doesn't change the tokens after it. The chunks are spliced there,
and the next one begins there. If an overlap has no such place, it is doubled until it has one or reaches the
end of the text, so a stretch without any costs in proportion to its length.

Which places are stable is proven from the vocabulary when it is loaded: a
sentencepiece BPE model without a piece that has the blank after another
character never joins a character and a blank behind it. Its normalizer must
change nothing (checked too); a model that fails a check is encoded whole.

Defined results: a null text counts as empty (0 tokens); repeated rows count
each time; columns named like a result are replaced; an empty table gives an
empty table.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common

#: Characters of a chunk (a longer text is encoded in chunks) and, at first, of an overlap.
CHUNK, OVERLAP = 4_000, 128
#: Parts of words that WordIds remembers.
STORE = 200_000
LIMIT = 4096
#: Bytes of an id.
WIDTH = 4


class Pieces:
    """A sentencepiece model, its pieces' lengths in bytes, and the proofs."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(self.model)
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.lengths = np.array([1 if self.model.is_byte(i) else len(p.replace("▁", " ").encode()) for i, p in enumerate(pieces)], np.int64)
        probe = " a  b\tc\n 　ﬁ é <s> "
        unchanged = "".join(self.model.encode(probe, out_type=str)).replace("<0x09>", "\t").replace("<0x0A>", "\n").replace("▁", " ") == " " + probe
        self.proven = unchanged and not any(re.search("[^▁]▁", p) for p in pieces)

    def count(self, raw: bytes) -> int:
        text = raw.decode("utf-8", "replace")
        if len(text) > CHUNK and self.proven and "▁" not in text:
            return self.count_in_chunks(text)
        return len(self.model.encode(text))

    def starts(self, chunk: str) -> np.ndarray:
        """Byte offsets in the chunk at which its tokens start, and last its end.

        The model puts a blank of its own before the text, so the first is -1.
        """
        ids = np.array(self.model.encode(chunk), np.int64)
        return np.concatenate([[0], np.cumsum(self.lengths[ids])]) - 1

    def count_in_chunks(self, text: str, size: int = CHUNK, overlap: int = OVERLAP) -> int:
        """As len(encode(text)), from overlapping chunks of `size` characters.

        The blank that the model puts before a chunk stands for the one at the boundary where the chunk before it ends.
        """
        total = at = 0
        while True:
            wide, spliced = overlap, None
            while spliced is None:
                chunk = text[at : at + size + wide]
                mine = self.starts(chunk)
                if at + size + wide >= len(text):
                    return total + len(mine) - 1
                spliced = self.common_boundary(chunk, mine, size)
                wide *= 2  # without a common stable boundary, a wider overlap
            place, offset = spliced
            total += int(np.searchsorted(mine, offset))
            at += place + 1

    def common_boundary(self, chunk: str, mine: np.ndarray, size: int) -> tuple[int, int] | None:
        """The first stable place where the chunk and its overlap with the next, encoded alone, both have a boundary: in characters and in bytes of the chunk."""
        over = chunk[size:]
        head, theirs = len(chunk[:size].encode()), self.starts(over)
        for m in re.finditer("(?<=[^ ]) ", over):
            offset = len(over[: m.start()].encode())
            if head + offset in mine and offset in theirs:
                return size + m.start(), head + offset
        return None


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


COUNTS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT, keep: list[str] | None = None) -> DataFrame:
    """The input's columns (or `keep`), n_bytes, n_tokens and over_limit of the whole text. No shuffle.

    vocabulary: path of a sentencepiece model, the same on all executors.
    """

    def compute():
        model = pieces(vocabulary)

        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            sizes, counts = [], []
            for raw in common.text_bytes(batch):
                sizes.append(len(raw))
                counts.append(model.count(raw) if raw else 0)
            return [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())]

        return f

    return common.with_results(docs, COUNTS, compute, keep)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "text"])
    return token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


class WordIds:
    """Ids of whole texts from a tokenizers file, each distinct part of a word encoded once.

    A text is divided only if the file's own definition proves that it may be: the
    pre-tokenizer is the one of PATTERN, which drops white space, the normalizer
    doesn't join across it, pieces end words, and no added token holds any. With
    any other file whole texts go to the library. Words of ASCII and Latin
    letters are divided into what PARTS gives; other words go to the library as
    they are. encode() returns little-endian unsigned 32-bit ids.
    """

    #: The pre-tokenizer's pattern, and the same for text in lower case of ASCII and Latin letters.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")
    PLAIN = re.compile("[\t-\r !-~À-ÖØ-öø-ÿ]*")
    BLANK = re.compile("[\t-\r ]+")

    def __init__(self, path: str, store: int = STORE) -> None:
        import json
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model, self.store = Tokenizer.from_file(path), store
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        spec = json.loads(self.model.to_str())
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        drops = any(t.get("type") == "Split" and t.get("behavior") == "Removed" and t.get("invert") and t.get("pattern", {}).get("Regex") == self.PATTERN for t in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])[:1])
        suffix = spec["model"].get("end_of_word_suffix")
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.divides = kinds == ["NFC", "Replace", "Lowercase"] and drops and bool(suffix) and all("<" in a and not self.BLANK.search(a) for a in self.added)
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        for piece, k in self.model.get_vocab().items():
            self.ends[k] = bool(suffix) and piece.endswith(suffix)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, parts: list[str]) -> None:
        """Encodes parts joined by blanks; each ends where a piece ends a word."""
        for at in range(0, len(parts), 2000):
            some = parts[at : at + 2000]
            ids = self.ids([" ".join(some)])[0]
            ends = (np.flatnonzero(self.ends[ids]) + 1) * WIDTH
            if len(ends) == len(some) and ends[-1] == len(ids) * WIDTH:
                raw, cuts = ids.tobytes(), [0, *ends.tolist()]
                self.known.update(zip(some, [raw[x:y] for x, y in zip(cuts, cuts[1:])]))
            else:
                self.known.update(zip(some, [x.tobytes() for x in self.ids(some)]))

    def plain(self, text: str) -> bool:
        return self.PLAIN.fullmatch(text) is not None and not ("<" in text and any(a in text for a in self.added))

    def units(self, text: str, odd: set[str]) -> list[str]:
        """The text's parts, and words that can't be divided, which are added to `odd`."""
        if self.plain(text):
            return self.PARTS.findall(text.lower())
        out = []
        for w in self.BLANK.split(text):
            if self.plain(w):
                out += self.PARTS.findall(w.lower())
            else:
                odd.add(w)
                out.append(w)
        return out

    def forget(self) -> None:
        self.known, self.old = {}, {}

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        if not self.divides:
            return [x.tobytes() for x in self.ids(texts)]
        if len(self.known) > self.store // 2:  # what is met again comes back from the older half
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        odd: set[str] = set()
        units = [self.units(t, odd) for t in texts]
        new = {u for u in set().union(*units) if u not in known}
        met = {u for u in new if u in old}
        known.update((w, old[w]) for w in met)
        new -= met
        if whole := list(new & odd):
            known.update(zip(whole, [x.tobytes() for x in self.ids(whole)]))
        self.learn(list(new - odd))
        return [b"".join(map(known.__getitem__, of)) for of in units]


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
