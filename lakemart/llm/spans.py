"""Removing spans from texts: shared by the two operators that cut repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import utf8

#: Row key of a document: its id and a hash of its text, so that rows repeating
#: an id with another text are told apart (and equal rows share their spans).
KEY = "doc_id long, h long"


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def keyed_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, h, text)"""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_hash(text).alias("h"), F.col(text).alias("text"))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans: sorted, disjoint, not even touching."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    cut = np.flatnonzero(starts[1:] > ends[:-1])
    return starts[np.r_[0, cut + 1]], ends[np.r_[cut, len(ends) - 1]]


def to_blob(starts: np.ndarray, ends: np.ndarray) -> bytes:
    return np.concatenate([starts, ends]).astype(np.int64).tobytes()


def from_blobs(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The union of the spans of several blobs."""
    halves = [np.frombuffer(b, np.int64).reshape(2, -1) for b in blobs]
    return merged(np.concatenate([x[0] for x in halves]), np.concatenate([x[1] for x in halves]))


def _squeezed(carry: bool):
    """Texts compressed before they are shuffled to their spans."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = pa.array([squeeze(utf8(t.as_py())) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, *batch.columns[3:]],
                                             names=["doc_id", "h", "text", *(["row"] if carry else [])])
    return of


def cut_spans(docs: DataFrame, spans: DataFrame, cut: Callable, carry: bool = False,
              carry_text: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, h, text[, row]): doc_id, n_items,
    n_removed, n_spans, kept_text (binary), kept_sha256[, row][, text].

    ``cut(text, starts, ends)`` returns the number of items and the kept bytes.
    ``spans``: rows (doc_id, h, spans) of blobs, any number for a document.
    """
    docs = docs.mapInArrow(_squeezed(carry), KEY + ", text binary" + (
        f", row {docs.schema['row'].dataType.simpleString()}" if carry else ""))
    found = spans.groupBy("doc_id", "h").agg(F.collect_set("spans").alias("spans"))
    rows = docs.alias("d").join(found.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
                                & (F.col("d.h") == F.col("s.h")), "left")
    rows = rows.select("d.doc_id", "d.text", "s.spans", *(["d.row"] if carry else []))
    none = np.empty(0, np.int64)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for text, blobs in zip(batch.column(1), batch.column(2), strict=True):
                body, blobs = expand(text.as_py()), blobs.as_py()
                starts, ends = from_blobs(blobs) if blobs else (none, none)
                n, kept = cut(body, starts, ends)
                out.append((n, int((ends - starts).sum()), len(starts), kept, hashlib.sha256(kept).hexdigest()))
            n, removed, count, kept, sha = zip(*out, strict=True) if out else ((),) * 5
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                       pa.array(count, pa.int64()), pa.array(kept, pa.binary()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_items", "n_removed", "n_spans", "kept_text", "kept_sha256"]
            if carry:
                columns.append(batch.column(3))
                names.append("row")
            if carry_text:
                columns.append(pa.array([expand(t.as_py()) for t in batch.column(1)], pa.binary()).cast(pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    row_type = docs.schema["row"].dataType.simpleString() if carry else ""
    schema = "doc_id long, n_items long, n_removed long, n_spans long, kept_text binary, kept_sha256 string"
    if carry:
        schema += f", row {row_type}"
    if carry_text:
        schema += ", text string"
    return rows.mapInArrow(of, schema)
