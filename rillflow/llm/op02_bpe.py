"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

``encode`` splits every whole text into pre-tokens.  A pre-token that is itself an entry of the rank table - that
holds for the frequent ones - has its id at once; of the others, each chunk of documents lists its distinct words
and refers to them by number, so positions travel as packed, compressed arrays of references.  One shuffle sends every
word to the bucket of its hash, where it is encoded once for the whole corpus, however many chunks ask for it; a
second one brings the ids back to the chunks and joins them to the references, by position.  ``decode`` joins ids to
the token-byte table.  The two tables have as many rows as the vocabulary, whatever the corpus is, and are broadcast.

A chunk ends after ``CHUNK_CHARS`` characters, so a task holds one chunk (or one document, if that is longer) and the
distinct words of one bucket; a word is in a chunk once, so a frequent word can't crowd a bucket.

Defined results: a null text is encoded as the empty text, without ids; repeated rows are encoded each; extra columns
pass through ``decode`` and are dropped by ``encode``; row order is not kept.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession

from .util import per_core, share

CHUNK_CHARS = 12 << 20
_PACKED = "dest long, kind int, chunk long, bucket int, keys binary, body binary"
_SEPARATOR = b"\xff"  # in no UTF-8


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank table of a .tiktoken file: on the driver's disk, or wherever Spark can read it."""
    if "://" in path:
        lines = [r.value for r in spark.read.text(path).collect()]  # as many as the vocabulary has
    else:
        lines = Path(path).read_text().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x)}


def pack(x: np.ndarray) -> bytes:
    """Numbers below 2**32 as compressed byte planes."""
    planes = x.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return struct.pack("<q", len(x)) + zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<q", data)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=4 * n), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").reshape(-1)


def pack_skewed(x: np.ndarray) -> bytes:
    """The same for numbers of which small ones are frequent: one byte below 240, else three or five."""
    high = (np.maximum(x, 240) - 240) >> 16
    first = np.where(x < 240, x, np.minimum(240 + high, 255)).astype(np.uint8)
    rest = np.ascontiguousarray((x - 240)[(first >= 240) & (first < 255)].astype("<u2").view(np.uint8).reshape(-1, 2).T)
    far = x[first == 255].astype("<u4")
    blocks = [zstandard.ZstdCompressor(3).compress(b.tobytes()) for b in (first, rest[0], rest[1], far)]
    return struct.pack("<5q", len(x), *map(len, blocks)) + b"".join(blocks)


def unpack_skewed(data: bytes) -> np.ndarray:
    n, *sizes = struct.unpack_from("<5q", data)
    at = np.cumsum([40, *sizes])
    read = lambda i, t: np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at[i] : at[i + 1]], max_output_size=4 * n + 1), t)
    first, low, high, far = read(0, np.uint8), read(1, np.uint8), read(2, np.uint8), read(3, "<u4")
    out = first.astype(np.int64)
    middle = (first >= 240) & (first < 255)
    out[middle] = 240 + ((out[middle] - 240) << 16) + (low.astype(np.int64) | high.astype(np.int64) << 8)
    out[first == 255] = far
    return out


def pack_bytes(x: bytes) -> bytes:
    return struct.pack("<q", len(x)) + zstandard.ZstdCompressor(3).compress(x)


def unpack_bytes(data: bytes) -> bytes:
    (n,) = struct.unpack_from("<q", data)
    return zstandard.ZstdDecompressor().decompress(data[8:], max_output_size=n)


@lru_cache(4)
def _splitter(pattern: str):
    import regex

    return regex.compile(pattern)


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merges of one word, lowest rank first."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 64:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over a linked list, for words of any length."""
    import heapq

    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and after[i] == j and end[i] == j and end[j] == e):
            continue
        alive[j] = False
        end[i], after[i] = e, after[j]
        if after[i] < n:
            before[after[i]] = i
            if (r := ranks.get(word[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, after[i], end[after[i]]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:e])) is not None:
            heapq.heappush(heap, (r, p, i, e))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class _Numbers(dict):
    """Numbers for keys in the order in which they are first asked for."""

    def __init__(self, known: dict, start: int):
        super().__init__(known)
        self.shift = start - len(known)

    def __missing__(self, key):
        n = self[key] = len(self) + self.shift
        return n


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text", chunk_chars: int = CHUNK_CHARS, finish: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, finished: str = "ids array<int>") -> DataFrame:
    """(doc_id, ids array<int>) for every row.

    ``finish`` turns batches of that into batches of doc_id and the columns ``finished`` in the worker that made them.
    """
    spark = docs.sparkSession
    n = per_core(spark)
    table, size = share(spark, ranks), max(ranks.values(), default=-1) + 1
    id_type = docs.schema[doc_id].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known = {k.decode(): v for k, v in table.value.items() if _is_text(k)}
        part, serial = TaskContext.get().partitionId(), 0
        find = _splitter(pattern).findall
        names, texts, chars, kind = [], [], 0, None

        def chunk() -> Iterator[pa.RecordBatch]:
            key = (part << 32) + serial
            numbers, rows = _Numbers(known, size), []
            for t in texts:
                words = find(t) if t else ()
                rows.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
            new = [w.encode() for w in islice(numbers, len(known), None)]
            # new words are numbered again by bucket and word, so a bucket's words need no numbers
            to = np.array([xxhash.xxh32_intdigest(w) for w in new], np.int64) % n
            order = np.array(sorted(range(len(new)), key=lambda i: (to[i], new[i])), np.int64)
            place = np.empty(len(new), np.int64)
            place[order] = np.arange(len(new))
            refs = np.concatenate([np.zeros(0, np.int64), *rows])
            late = refs >= size
            refs[late] = size + place[refs[late] - size]
            # and all references by falling frequency, which the counts tell
            counts = np.bincount(refs, minlength=size + len(new))
            ranked = np.empty(len(counts), np.int64)
            ranked[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
            ids = pa.array(names, kind)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", ids.type)])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([ids], ["doc_id"]))
            lengths = pack(np.array([len(r) for r in rows], np.uint32))
            head = pack_bytes(sink.getvalue().to_pybytes())
            body = pack_skewed(ranked[refs])
            yield _batch([(key, 0, key, -1, struct.pack("<2q", len(head), len(lengths)) + head + lengths + pack_skewed(counts), body)])
            cuts = np.searchsorted(to[order], np.arange(n + 1))
            out = [(b, 1, key, b, pack_bytes(_SEPARATOR.join(new[i] for i in order[cuts[b] : cuts[b + 1]])), struct.pack("<q", cuts[b])) for b in range(n) if cuts[b] < cuts[b + 1]]
            if out:
                yield _batch(out)

        for batch in batches:
            kind = batch.column(0).type
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                names.append(name)
                texts.append(t.as_py())
                chars += len(texts[-1] or "")
                if chars >= chunk_chars:
                    yield from chunk()
                    names, texts, chars, serial = [], [], 0, serial + 1
        if names:
            yield from chunk()

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, bucket, done = table.value, None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["kind"] == 0:
                    yield _batch([(r["chunk"], 0, r["chunk"], -1, r["keys"], r["body"])])
                    continue
                if r["bucket"] != bucket:
                    bucket, done = r["bucket"], {}
                ids = []
                for w in unpack_bytes(r["keys"]).split(_SEPARATOR):
                    if (x := done.get(w)) is None:
                        x = done[w] = merge(w, ranks)
                    ids.append(x)
                lengths = pack(np.array([len(x) for x in ids], np.uint32))
                flat = pack(np.fromiter(chain.from_iterable(ids), np.uint32))
                yield _batch([(r["chunk"], 1, r["chunk"], bucket, r["body"], struct.pack("<q", len(lengths)) + lengths + flat)])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, []

        def one() -> Iterator[pa.RecordBatch]:
            main = next(r for r in held if r["kind"] == 0)
            n_head, n_lengths = struct.unpack_from("<2q", main["keys"])
            cut = 16 + n_head
            names = pa.ipc.open_stream(unpack_bytes(main["keys"][16:cut])).read_all().column(0).combine_chunks()
            lengths = unpack(main["keys"][cut : cut + n_lengths]).astype(np.int64)
            order = np.argsort(-unpack_skewed(main["keys"][cut + n_lengths :]), kind="stable")
            refs = unpack_skewed(main["body"])
            # where each word's ids lie; the rank table's entries come first, each its own id
            own, flat = [np.ones(size, np.int64)], [np.arange(size, dtype=np.int32)]
            for r in sorted((r for r in held if r["kind"] == 1), key=lambda r: struct.unpack("<q", r["keys"])):
                (k,) = struct.unpack_from("<q", r["body"])
                own.append(unpack(r["body"][8 : 8 + k]).astype(np.int64))
                flat.append(unpack(r["body"][8 + k :]).astype(np.int32))
            own, flat = np.concatenate(own), np.concatenate(flat)
            first = np.cumsum(own) - own
            ends = np.cumsum(lengths)
            a = 0
            while a < len(names):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] - lengths[a] + 100_000, "right")))
                b = min(b, a + 256, len(names))
                words = order[refs[ends[a] - lengths[a] : ends[b - 1]]]
                c = own[words]
                total = np.concatenate(([0], np.cumsum(c)))
                ids = flat[np.repeat(first[words] - total[:-1], c) + np.arange(total[-1])]
                offsets = total[np.concatenate(([0], np.cumsum(lengths[a:b])))]
                yield pa.RecordBatch.from_arrays([names.slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))], ["doc_id", "ids"])
                a = b

        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["chunk"] != chunk:
                    if held:
                        yield from map(finish, one()) if finish else one()
                    chunk, held = r["chunk"], []
                held.append(r)
        if held:
            yield from map(finish, one()) if finish else one()

    packed = docs.select(doc_id, text).mapInArrow(split, _PACKED)
    words = packed.repartition(n, "dest").sortWithinPartitions("kind", "bucket")
    encoded = words.mapInArrow(encode_words, _PACKED)
    chunks = encoded.repartition(n, "dest").sortWithinPartitions("chunk")
    return chunks.mapInArrow(assemble, f"doc_id {id_type}, {finished}")


def _is_text(x: bytes) -> bool:
    try:
        x.decode()
    except UnicodeDecodeError:
        return False
    return True


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = [x.split()[0] for x in _PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def token_bytes(ranks: dict[bytes, int]) -> np.ndarray:
    """The token-byte table."""
    tokens = np.empty(max(ranks.values(), default=-1) + 1, object)
    for k, v in ranks.items():
        tokens[v] = k
    return tokens


_DECODED = "n_tokens long, ids_sha256 string, decoded binary"


def decode_ids(column: pa.ListArray, tokens: np.ndarray) -> list[pa.Array]:
    """The columns ``_DECODED`` of a batch: ids are looked up in the token-byte table, null is no ids."""
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    rows = [flat[a:b] if ok else flat[:0] for a, b, ok in zip(offsets[:-1], offsets[1:], column.is_valid().to_pylist(), strict=True)]
    return [
        pa.array([len(x) for x in rows], pa.int64()),
        pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in rows], pa.string()),
        pa.array([b"".join(tokens[x].tolist()) for x in rows], pa.binary()),
    ]


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit numbers) and ``decoded`` (bytes)."""
    table = share(encoded.sparkSession, token_bytes(ranks))
    at = encoded.columns.index(ids)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                column = pa.concat_arrays([part.column(at)])
                yield pa.RecordBatch.from_arrays([*part.columns, *decode_ids(column, table.value)], [*part.schema.names, *(x.split()[0] for x in _DECODED.split(", "))])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(join, f"{kinds}, {_DECODED}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op02_bpe(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encodes every whole text, decodes the ids, and returns digests of both."""
    import public_tokenizers

    ranks = read_ranks(docs.sparkSession, path or default_path())
    table = share(docs.sparkSession, token_bytes(ranks))

    def digests(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Decodes a batch of ids at once; only digests leave the worker."""
        n, ids, decoded = decode_ids(batch.column(1), table.value)
        return pa.RecordBatch.from_arrays([batch.column(0), n, ids, pa.array([hashlib.sha256(x.as_py()).hexdigest() for x in decoded])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encode(docs.select("doc_id", "text"), ranks, pattern or public_tokenizers.PATTERN, finish=digests, finished="n_tokens long, ids_sha256 string, decoded_sha256 string")
