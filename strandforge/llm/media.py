"""Media columns: Netpbm and BMP images as numpy arrays, NPY tiles and difference hashes.

decode() reads binary Netpbm (P4, P5, P6; 8 or 16 bits) and uncompressed BMP (8
bits with a palette, 24, 32 bits). Images are resized by area: each target pixel is the exact mean of
the source area that it covers, from an integral image with interpolated edges.
The tile is written as an NPY file; the difference hash compares neighbouring
pixels of a 9 x 8 grey image.

Defined results: a null medium, an unknown or damaged format, and an image
without pixels give null results and say why in `error`; repeated rows count
each time; columns named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import common

#: Height and width of tiles.
TILE = (32, 32)
#: Payloads of whole texts: bytes a row of the image, and of a payload unit.
ROW, UNIT, FILL = 24, 576, 255


def _netpbm(data: bytes) -> np.ndarray:
    kind, at, values = data[:2], 2, []
    for _ in range({b"P4": 2, b"P5": 3, b"P6": 3}[kind]):
        m = re.compile(rb"(?:\s|#[^\n\r]*[\n\r])*(\d+)").match(data, at)
        if not m:
            raise ValueError("damaged Netpbm header")
        values.append(int(m[1]))
        at = m.end()
    at += 1  # one white space ends the header
    width, height = values[:2]
    if kind == b"P4":
        stride = -(-width // 8)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, stride * height, at).reshape(height, stride), axis=1)
        return (1 - bits[:, :width]) * np.uint8(255)
    if not 0 < values[2] < 65536:
        raise ValueError("damaged Netpbm header")
    depth = np.uint8 if values[2] < 256 else np.dtype(">u2")
    shape = (height, width) if kind == b"P5" else (height, width, 3)
    return np.frombuffer(data, depth, int(np.prod(shape)), at).reshape(shape)


def _bmp(data: bytes) -> np.ndarray:
    start, header, width, height, _, bits, packed = struct.unpack_from("<I", data, 10)[0], *struct.unpack_from("<IiiHHI", data, 14)
    if packed or bits not in (8, 24, 32) or width <= 0:
        raise ValueError(f"BMP with {bits} bits, compression {packed}")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        colours = struct.unpack_from("<I", data, 46)[0] or 256
        palette = np.frombuffer(data, np.uint8, 4 * colours, 14 + header).reshape(colours, 4)[:, 2::-1]
        return palette[rows[:, :width]]
    return rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    """(height, width) or (height, width, 3), in the format's own unit."""
    if data[:2] in (b"P4", b"P5", b"P6"):
        image = _netpbm(data)
    elif data[:2] == b"BM":
        image = _bmp(data)
    else:
        raise ValueError("neither Netpbm nor BMP")
    if not image.size:
        raise ValueError("no pixels")
    return image


def encode_pgm(image: np.ndarray) -> bytes:
    height, width = image.shape
    return b"P5\n%d %d\n255\n" % (width, height) + np.ascontiguousarray(image, np.uint8).tobytes()


def grey(image: np.ndarray) -> np.ndarray:
    scale = 65535.0 if image.dtype.itemsize == 2 else 255.0
    if image.ndim == 3:
        image = image.astype(np.float64) @ (0.299, 0.587, 0.114)
    return image * (255.0 / scale) if scale != 255.0 else image


def _edges(sums: np.ndarray, to: int) -> np.ndarray:
    """Rows of an integral image at the edges of `to` equal parts, interpolated within pixels."""
    n = sums.shape[0] - 1
    at = np.arange(to + 1) * (n / to)
    low = np.minimum(at.astype(np.int64), n - 1) if n else np.zeros(to + 1, np.int64)
    part = (at - low).reshape(-1, *[1] * (sums.ndim - 1))
    return sums[low] * (1 - part) + sums[low + 1] * part


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Exact area means, (height, width), as floats."""
    h, w = image.shape
    down = np.zeros((h + 1, w), np.float64)
    np.cumsum(image, axis=0, dtype=np.float64, out=down[1:])
    rows = np.diff(_edges(down, height), axis=0)
    across = np.zeros((w + 1, height), np.float64)
    np.cumsum(rows.T, axis=0, out=across[1:])
    return np.diff(_edges(across, width), axis=0).T / ((h / height) * (w / width))


def difference_hash(image: np.ndarray) -> str:
    small = np.round(resize(image, 8, 9), 6)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def tile(image: np.ndarray, shape: tuple[int, int] = TILE) -> bytes:
    """An NPY file of the resized image in 8 bits."""
    out = io.BytesIO()
    np.save(out, np.clip(np.rint(resize(image, *shape)), 0, 255).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


FEATURES = T.StructType([
    T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()), T.StructField("dhash", T.StringType()),
    T.StructField("tile_npy", T.BinaryType()), T.StructField("error", T.StringType()),
])


def media_features(media: DataFrame, column: str = "media", shape: tuple[int, int] = TILE) -> DataFrame:
    """media's columns and FEATURES of its binary column."""

    def compute():
        def one(data: bytes | None) -> tuple:
            if data is None:
                return None, None, None, None, "no medium"
            try:
                image = decode(data)
            except (ValueError, KeyError, IndexError, struct.error) as e:
                return None, None, None, None, str(e) or "damaged"
            g = grey(image)
            return *image.shape[:2], difference_hash(g), tile(g, shape), None

        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [one(x.as_py()) for x in batch.column(column)]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.string())
            return [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]

        return f

    return common.with_results(media, FEATURES, compute)


def payload_of(text: bytes) -> bytes:
    """The text's bytes filled up with 255 to a positive multiple of UNIT."""
    n = max(1, -(-len(text) // UNIT)) * UNIT
    return text + bytes([FILL]) * (n - len(text))


def image_of(payload: bytes) -> bytes:
    """A grey Netpbm image (P5) with the payload as its samples, ROW of them a row."""
    return encode_pgm(np.frombuffer(payload, np.uint8).reshape(-1, ROW))


STORED = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType()),
])
DIGESTS = T.StructType([
    T.StructField(n, T.LongType() if k == "l" else T.StringType())
    for n, k in (("n_bytes", "l"), ("payload_bytes", "l"), ("payload_sha256", "s"), ("tail_crc32", "l"), ("media_bytes", "l"), ("media_sha256", "s"), ("feature", "s"))
])


def text_media(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep's columns, n_bytes of the text, and its image as media."""

    def compute():
        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = list(common.text_bytes(batch))
            return [pa.array(map(len, texts), pa.int64()), pa.array([image_of(payload_of(x)) for x in texts], pa.binary())]

        return f

    return common.with_results(docs, STORED, compute, keep)


def media_digests(media: DataFrame, keep: list[str], column: str = "media") -> DataFrame:
    """keep's columns and DIGESTS, all from the stored bytes, which are decoded again."""

    def compute():
        def one(n: int, data: bytes) -> tuple:
            image = decode(data)
            payload = image.tobytes()
            means = resize(image, 2, 2).round(3).ravel()
            feature = difference_hash(image) + ":" + hashlib.md5(tile(image)).hexdigest()[:16] + ":" + ",".join(f"{x:.3f}" for x in means)
            return n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature

        def f(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [one(n, d.as_py()) for n, d in zip(batch.column("n_bytes").to_pylist(), batch.column(column))]
            return [pa.array(c, pa.int64() if isinstance(x.dataType, T.LongType) else pa.string()) for c, x in zip(zip(*rows) if rows else [[]] * len(DIGESTS), DIGESTS)]

        return f

    return common.with_results(media, DIGESTS, compute, keep)


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "text"])
    return media_digests(text_media(docs, ["doc_id"]), ["doc_id"])
