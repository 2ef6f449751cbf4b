"""Token ids in raw binary shards with a minimal perfect hash index.

A shard is a file of nothing but little-endian ids, two bytes each where the vocabulary
allows it, else four, documents in ascending doc_id, shard after shard. The index is a table
of buckets of keys; a bucket holds a perfect hash and, by the index that this gives a key,
the key's fingerprint, shard, offset and length.

Files are written by the tasks themselves, so ``root`` must be a folder that all executors
share and that the Arrow file systems can open (file, hdfs, s3, gs). A file carries a fresh
name for each attempt of its task; only names that a finished task reported are ever read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.numbering import bucket_of, range_bounds
from tarnlake.llm.perfect_hash import PerfectHash, fingerprints
from tarnlake.llm.staging import Stage
from tarnlake.llm.tokens import TEXT_BYTES, encoder
from tarnlake.llm.words import slices

DOCS_PER_SHARD = 4096
KEYS_PER_BUCKET = 4096
#: Bytes of a shard that are read at once.
READ_BYTES = 8 << 20


@dataclass
class TokenStore:
    """What was written: ``entries`` has a row per document, ``shards`` one per file, ``index`` one per bucket."""

    entries: DataFrame
    shards: DataFrame
    index: DataFrame
    buckets: int
    width: int


def located(path: str) -> tuple[fs.FileSystem, str]:
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def _write(batches, root: str, path: str, end: int, width: int):
    """Rows come by (shard, doc_id); each shard is one file."""
    system, folder = located(root)
    shard = name = out = None
    offset, last_id = 0, None
    for batch in batches:
        for part in slices(batch, size=TEXT_BYTES):
            ids, bounds = encoder(path).encode(part.column("text"), end)
            raw = ids.astype(f"<u{width}")
            numbers = part.column("shard").to_numpy()
            keys = part.column("doc_id").to_pylist()
            turns = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
            offsets, names, keyed = [], [], []
            for a, b in zip(turns, np.r_[turns[1:], len(numbers)], strict=True):
                if numbers[a] != shard:
                    if out is not None:
                        out.close()
                    shard, offset, last_id = numbers[a], 0, None
                    name = f"{shard:06d}-{uuid4().hex}.ids"
                    out = system.open_output_stream(f"{folder}/{name}")
                out.write(raw[bounds[a] : bounds[b]].tobytes())
                for row in range(a, b):
                    offsets.append(offset + int(bounds[row] - bounds[a]))
                    names.append(name)
                    keyed.append(keys[row] is not None and keys[row] != last_id)
                    last_id = keys[row]
                offset += int(bounds[b] - bounds[a])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("shard"), pa.array(names), pa.array(offsets, pa.int64()),
                 pa.array(np.diff(bounds)), pa.array(keyed)],
                ["doc_id", "shard", "file", "offset", "n_tokens", "keyed"],
            )
    if out is not None:
        out.close()


def _bucket_index(table: pa.Table) -> pa.Table:
    keys = table.column("doc_id").to_numpy()
    hashed = PerfectHash.build(keys)
    order = np.argsort(hashed.index(keys))
    column = lambda name, kind: [table.column(name).to_numpy()[order].astype(kind).tobytes()]
    return pa.table({
        "bucket": table.column("bucket").slice(0, 1).combine_chunks(),
        "level_sizes": pa.array([hashed.sizes.tolist()], pa.list_(pa.int64())),
        "level_bits": [hashed.bits.tobytes()],
        "fingerprint": [fingerprints(keys[order]).astype("<u4").tobytes()],
        "shard": column("shard", "<i4"),
        "offset": column("offset", "<i8"),
        "n_tokens": column("n_tokens", "<i8"),
    })


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")


def write_tokens(docs: DataFrame, tokenizer: str, end: int, vocabulary: int) -> TokenStore:
    """Encode every whole text, add ``end`` to each, write shards and index.

    A null or empty text is the id ``end`` alone. Rows without a doc_id come first and
    rows that repeat one follow it; both are in the shards and in ``entries``, but only the
    first row of a doc_id is in the index (``keyed``). An empty table writes no shard.
    """
    stage = Stage(docs.sparkSession, "tokens")
    total = docs.count()
    bounds = range_bounds(docs, "doc_id", ceil(total / DOCS_PER_SHARD))
    width = 2 if max(vocabulary, end + 1) <= 1 << 16 else 4
    shard = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(bucket_of("doc_id", bounds)).cast("int")
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("shard", shard)
        .repartition(len(bounds) + 1, "shard")
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first())
    )
    root = stage.qualified(stage.path("shards"))
    system, folder = located(root)
    system.create_dir(folder, recursive=True)
    entries = stage.put(
        dealt.mapInArrow(
            lambda batches: _write(batches, root, tokenizer, end, width),
            "doc_id long, shard int, file string, offset long, n_tokens long, keyed boolean",
        ),
        "entries",
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = entries.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n_ids"))
    shards = stage.put(
        sizes.select(
            "shard", F.concat(F.lit(f"{root}/"), "file").alias("path"), "n_ids",
            F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"),
        ),
        "manifest",
    )
    buckets = max(1, ceil(total / KEYS_PER_BUCKET))
    index = stage.put(
        entries.where("keyed").withColumn("bucket", _bucket(buckets)).groupBy("bucket").applyInArrow(
            _bucket_index,
            "bucket int, level_sizes array<long>, level_bits binary, fingerprint binary, shard binary, "
            "offset binary, n_tokens binary",
        ),
        "index",
    )
    return TokenStore(entries, shards, index, buckets, width)


def _look_up(keys: pa.Table, index: pa.Table) -> pa.Table:
    asked = keys.column("doc_id").to_numpy()
    empty = np.zeros(0, np.int64)
    rows, shard, offset, size = empty, empty, empty, empty
    if index.num_rows and len(asked):
        row = index.to_pylist()[0]
        hashed = PerfectHash(np.asarray(row["level_sizes"], np.int64), np.frombuffer(row["level_bits"], np.uint8))
        at = hashed.index(asked)
        rows = np.flatnonzero(at >= 0)
        rows = rows[np.frombuffer(row["fingerprint"], "<u4")[at[rows]] == fingerprints(asked[rows])]
        at = at[rows]
        shard = np.frombuffer(row["shard"], "<i4")[at]
        offset = np.frombuffer(row["offset"], "<i8")[at]
        size = np.frombuffer(row["n_tokens"], "<i8")[at]
    return pa.table({"doc_id": asked[rows], "shard": shard.astype(np.int32), "offset": offset.astype(np.int64), "n_tokens": size.astype(np.int64)})


def locate(store: TokenStore, keys: DataFrame) -> DataFrame:
    """doc_id, shard, offset, n_tokens of the keys that the index holds.

    A key of no document passes with probability 2^-32 (its fingerprint happens to agree).
    """
    asked = keys.where("doc_id is not null").select("doc_id").distinct().withColumn("bucket", _bucket(store.buckets))
    by_bucket = store.index.groupBy("bucket")
    return asked.groupBy("bucket").cogroup(by_bucket).applyInArrow(
        _look_up, "doc_id long, shard int, offset long, n_tokens long"
    )


def _runs(offsets: np.ndarray, sizes: np.ndarray, paths: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of one file whose ids lie close together."""
    start = 0
    for row in range(1, len(paths) + 1):
        if row == len(paths) or paths[row] != paths[start] or offsets[row] + sizes[row] - offsets[start] > limit or offsets[row] < offsets[row - 1]:
            yield start, row
            start = row


def read_ids(store: TokenStore, places: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and the ids (or, with ``digest``, ``ids_crc32``) at ``places``.

    ``start`` counts all ids before the document's; the checksum is of four-byte ids.
    """
    width = store.width
    located_rows = places.join(store.shards.select("shard", "path", "base"), "shard")
    ordered = located_rows.repartition("shard").sortWithinPartitions("shard", "offset")

    def read(batches):
        for batch in batches:
            offsets, sizes = batch.column("offset").to_numpy(), batch.column("n_tokens").to_numpy()
            paths, found = batch.column("path").to_pylist(), []
            for a, b in _runs(offsets, sizes, paths, READ_BYTES // width):
                system, path = located(paths[a])
                with system.open_input_file(path) as file:
                    first = int(offsets[a])
                    raw = file.read_at(int(offsets[b - 1] + sizes[b - 1] - first) * width, first * width)
                ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
                for row in range(a, b):
                    mine = ids[offsets[row] - first : offsets[row] - first + sizes[row]]
                    found.append(zlib.crc32(mine.tobytes()) if digest else mine)
            values = pa.array(found, pa.int64()) if digest else pa.array([x.tolist() for x in found], pa.list_(pa.int64()))
            start = batch.column("base").to_numpy() + offsets
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(start, pa.int64()), batch.column("n_tokens"), values],
                ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"],
            )

    last = "ids_crc32 long" if digest else "ids array<long>"
    return ordered.mapInArrow(read, f"doc_id long, start long, n_tokens long, {last}")


def read_all(store: TokenStore, digest: bool = False) -> DataFrame:
    """Every document: by key through the index, the few without an own key by their entry."""
    keyed = locate(store, store.entries.where("keyed"))
    others = store.entries.where("not keyed").select("doc_id", "shard", "offset", "n_tokens")
    return read_ids(store, keyed.unionByName(others), digest)
