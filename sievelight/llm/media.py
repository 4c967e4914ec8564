"""Media columns: payloads as lossless WebP, read back into pixel arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sievelight.llm import webp

#: Payloads are padded to a multiple of this; it is a row of 16 pixels of 4 samples.
ROW_BYTES, WIDTH = 64, 16
#: Rows of one image; longer payloads are stored as several images, one after another.
TILE_ROWS = 128
#: Payload bytes that are encoded or decoded together.
STEP = 1 << 22


def _tiles(payload: np.ndarray) -> list[np.ndarray]:
    size = ROW_BYTES * TILE_ROWS
    return [payload[i:i + size] for i in range(0, len(payload), size)]


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, sizes, files, count = [], [], [], 0
        for i, text in enumerate(batch.column(1)):
            raw = text.as_buffer() if text.is_valid else b""
            n = len(raw) if text.is_valid else 0
            payload = np.zeros(max(1, -(-n // ROW_BYTES)) * ROW_BYTES, np.uint8)
            payload[:n] = np.frombuffer(raw, np.uint8)
            rows.append(i)
            sizes.append(n)
            files.append(b"".join(webp.encode_samples(t, WIDTH) for t in _tiles(payload)))
            count += len(payload)
            if count > STEP:
                yield _media_rows(batch, rows, sizes, files)
                rows, sizes, files, count = [], [], [], 0
        if rows:
            yield _media_rows(batch, rows, sizes, files)


def _media_rows(batch, rows, sizes, files) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], ["row", "n_bytes", "media"])


def to_media(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(row, n_bytes, media)``: every whole text's UTF-8 bytes, zero-padded to rows, as lossless WebP.

    ``row`` is a struct of the columns ``keep`` (all but the text by default). A null text is empty, and an empty text is
    one row of zeros; a text longer than one image is a sequence of images. Equal texts have equal media; repeated rows
    are kept; an empty table gives an empty result.
    """
    others = keep if keep is not None else [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode, f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, media binary")


def _files(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = 8 + int.from_bytes(data[at + 4:at + 8], "little")
        out.append(data[at:at + n])
        at += n
    return out


def _feature(samples: np.ndarray) -> str:
    """Size, mean per channel (alpha, red, green, blue, in hundredths) and a histogram of 8 bins in thousandths."""
    means = samples.reshape(-1, 4).sum(axis=0, dtype=np.int64) * 100 // (len(samples) // 4)
    bins = np.bincount(samples >> 5, minlength=8) * 1000 // len(samples)
    return f"{WIDTH}x{len(samples) // ROW_BYTES}:" + ",".join(map(str, means.tolist())) + ":" + ",".join(map(str, bins.tolist()))


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[int], files: list[list[bytes]]) -> pa.RecordBatch:
        images = webp.decode_many([f for own in files for f in own])
        payloads, features, at = [], [], 0
        for own in files:
            payload = b"".join(webp.samples_of(x) for x in images[at:at + len(own)])
            at += len(own)
            payloads.append(payload)
            features.append(_feature(np.frombuffer(payload, np.uint8)))
        return pa.RecordBatch.from_arrays([
            pa.array(rows, pa.int64()), pa.array(payloads, pa.binary()), pa.array(features, pa.string())], ["i", "samples", "feature"])

    for batch in batches:
        rows, files, count = [], [], 0
        for i, data in enumerate(batch.column(1)):
            rows.append(i)
            files.append(_files(data.as_py()))
            count += len(data.as_buffer())
            if count > STEP or i + 1 == batch.num_rows:
                own = out(rows, files)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(own.column(0)), batch.column(1).take(own.column(0)), own.column(1), own.column(2)],
                    ["row", "media", "samples", "feature"])
                rows, files, count = [], [], 0


def read_media(media: DataFrame) -> DataFrame:
    """``(row, media, samples, feature)`` of ``media(row, media)``: the pixels' samples, row by row, and features of them.

    A file that is not a whole lossless WebP fails the task: stored media are never dropped silently.
    """
    kind = media.schema["row"].dataType.simpleString()
    return media.select("row", "media").mapInArrow(_decode, f"row {kind}, media binary, samples binary, feature string")
