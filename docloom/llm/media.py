"""Media columns: payloads kept as progressive JPEG, and read back as coefficients and RGB tensors.

A payload (a text's UTF-8 bytes with zeros up to a positive multiple of 64) is stored in the coefficients, JPEG's own
lossless unit, 64 bytes a block: the first as DC (byte - 128), the others as AC (byte + 256), under a quantiser of ones.
Chroma is subsampled 4:2:0; the blocks of luma come first, then those of both chromas, which hold payload as well. The scans
are those of any progressive file: DC of all components, bands of luma's upper eight bits (spectral selection), each chroma,
and last luma's lowest bit (successive approximation). Reading accumulates the scans into the coefficient arrays again,
from which the payload, and by inverse transform and upsampling of chroma the RGB tensor, come.

Defined results: a null or empty text is one block of 64 zeros; equal texts give equal values; an empty table gives none; a
tensor table passes other columns through, but for names that start with `_rgb`, which are the operator's own and replaced.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.functions.arrow import appended
from docloom.llm.common import own
from docloom.llm.jpeg import Component, Image, Scan, decode, encode

#: DC, spectral bands of luma's upper bits, both chromas, then luma's lowest bit.
SCANS = [Scan((0, 1, 2), 0, 0, 0, 0), Scan((0,), 1, 5, 0, 1), Scan((0,), 6, 63, 0, 1), *[Scan((k,), 1, 63, 0, 0) for k in (1, 2)], Scan((0,), 1, 63, 1, 0)]
#: Blocks of an MCU: four of luma and one of each chroma.
MCU = 6
_ONES = np.ones(64, np.int32)


def padded(data: bytes) -> bytes:
    return data + b"\0" * (64 if not data else -len(data) % 64)


def store(payload: bytes) -> bytes:
    """The payload as a progressive JPEG file; its comment-free header tells the grid, the reader the length."""
    n = -(-len(payload) // (64 * MCU))
    wide = min(4, n)
    while n > wide * 4000:
        wide *= 2
    rows = -(-n // wide)
    body = np.zeros(rows * wide * MCU * 64, np.int32)
    body[: len(payload)] = np.frombuffer(payload, np.uint8)
    body = body.reshape(-1, 64)
    body[:, 0] -= 128
    body[:, 1:] += 256
    parts, at = [], 0
    for h in (2, 1, 1):
        grid = (rows * h, wide * h, 64)
        parts.append(Component(h, h, _ONES, coefs=body[at : at + grid[0] * grid[1]].reshape(grid)))
        at += grid[0] * grid[1]
    return encode(Image(rows * 16, wide * 16, parts), SCANS)


def read_back(image: Image, length: int) -> bytes:
    """The payload of an image that store() made."""
    body = np.concatenate([c.coefs.reshape(-1, 64) for c in image.parts])
    body[:, 0] += 128
    body[:, 1:] -= 256
    return body.astype(np.uint8).tobytes()[:length]


def tensor_feature(rgb: np.ndarray) -> str:
    """Shape and whole-number channel means of a tensor."""
    means = [int(rgb[:, :, k].sum(dtype=np.int64)) // max(1, rgb.shape[0] * rgb.shape[1]) for k in range(3)]
    return f"{rgb.shape[0]}x{rgb.shape[1]}x3:" + ",".join(map(str, means))


def jpeg_tensors(media: DataFrame, column: str = "jpeg") -> DataFrame:
    """A binary column of progressive JPEG files as `_rgb_height`, `_rgb_width` and `_rgb` (row-major bytes, 3 a pixel); null stays null.

    A file that can't be read gives nulls and its reason in `_rgb_error`.
    """
    media = own(media, "_rgb")
    names = media.columns

    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column(names.index(column)):
                try:
                    rgb = decode(x.as_py()).rgb() if x.is_valid else None
                    out.append((None,) * 4 if rgb is None else (rgb.shape[0], rgb.shape[1], rgb.tobytes(), None))
                except (ValueError, IndexError, KeyError, AttributeError) as e:
                    out.append((None, None, None, str(e) or type(e).__name__))
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))], names=[*names, "_rgb_height", "_rgb_width", "_rgb", "_rgb_error"])

    return media.mapInArrow(run, appended(media, "_rgb_height int, _rgb_width int, _rgb binary, _rgb_error string"))


def op10_media_columns(docs: DataFrame) -> DataFrame:
    """The contract's view; the stored form and the tensor live only inside a task, one document at a time."""
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column(1):
                data = (text.as_py() or "").encode("utf-8", "replace")
                media = store(padded(data))
                image = decode(media)
                payload = read_back(image, len(padded(data)))
                out.append((len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), tensor_feature(image.rgb())))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, appended(docs.select("doc_id"), "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"))
