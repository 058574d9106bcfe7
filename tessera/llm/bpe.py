"""Byte-level BPE encoding and decoding (operator 1).

Global distinct-word shuffle: texts are cut into pre-tokens with their
positions; the distinct pre-tokens of every chunk of documents travel to the
bucket of their hash, where each is encoded once; the ids travel back to their
chunks, and every document is put together by position.  Nothing travels word
by word: a chunk keeps its positions as arrays of word numbers, and sends each
bucket one packed list of words, for which it gets one packed list of ids.
"""

from __future__ import annotations

import base64
import heapq
import pickle
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, extended, lean, tokenizer_path

CHUNK_BYTES = 16 << 20     # text a chunk holds; a longer document is a chunk of its own
BUCKETS = 2048             # lists into which a chunk deals out its words
KNOWN = 1_000_000          # words of a bucket a task remembers
SHORT = 64                 # pre-tokens up to so many bytes are merged without a heap


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the whole pre-token if it is a token, else the
    neighbouring pair of least rank is joined, the leftmost of equals, until
    none is a token."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > SHORT:
        return _encode_long(word, ranks)
    none = len(ranks) + (1 << 40)
    get = ranks.get
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while pairs and (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap: n log n for texts without any break."""
    n = len(word)
    end = list(range(1, n + 1))                # part i spans i to end[i]
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(i):
        j = end[i]
        if j < n and (r := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        j = end[i]
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def _pack(*arrays) -> bytes:
    """Arrays of unsigned 32-bit numbers and bytes in one compressed value.
    Numbers are stored byte plane by byte plane, as small ones compress well."""
    import zstandard
    out = []
    for x in arrays:
        if isinstance(x, np.ndarray):
            x = np.ascontiguousarray(x, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
        out.append(x)
    head = np.array([len(x) for x in out], np.uint64).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(out))


def _unpack(value: bytes, kinds: str) -> list:
    """The parts of a packed value: ``n`` numbers, ``b`` bytes."""
    import zstandard
    data = zstandard.ZstdDecompressor().decompress(value)
    at, out = 8 * len(kinds), []
    for kind, size in zip(kinds, np.frombuffer(data, np.uint64, len(kinds)).tolist()):
        part = data[at:at + size]
        at += size
        if kind == "n":
            part = np.ascontiguousarray(np.frombuffer(part, np.uint8).reshape(4, -1).T
                                        ).view(np.uint32).reshape(-1)
        out.append(part)
    return out


def _split(lengths: np.ndarray, data: bytes) -> list[bytes]:
    ends = np.cumsum(lengths, dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _buckets(words: list[bytes]) -> np.ndarray:
    """Bucket of every word; the same in all tasks."""
    return np.fromiter((crc32(w) for w in words), np.uint32, len(words)) % BUCKETS


def _chunks(df: DataFrame, pattern: str) -> DataFrame:
    """(chunk, body): documents as arrays of word numbers, with the chunk's
    distinct words.  The body is one opaque value, so both uses of this table
    read the same exchange."""
    def run(batches):
        import regex
        find = regex.compile(pattern).findall
        part, made = TaskContext.get().partitionId(), 0
        ids, slots, words, size = [], [], {}, 0

        def row():
            flat = np.concatenate([np.zeros(0, np.uint32), *slots])
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            number = np.empty(len(words), np.uint32)       # frequent words get small numbers
            number[order] = np.arange(len(words), dtype=np.uint32)
            texts = [w.encode() for w in words]
            texts = [texts[i] for i in order.tolist()]
            body = _pack(pickle.dumps(ids, 5), np.array([len(s) for s in slots], np.uint32),
                         number[flat], np.array([len(w) for w in texts], np.uint32), b"".join(texts))
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), pa.array([body], pa.binary())],
                names=["chunk", "body"])

        for b in byte_blocks(batches, 0):
            for t, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = len(t.encode())
                if ids and size + n > CHUNK_BYTES:
                    yield row()
                    made += 1
                    ids, slots, words, size = [], [], {}, 0
                ids.append(i)
                slots.append(np.array([words.setdefault(w, len(words)) for w in find(t)], np.uint32))
                size += n
        if ids:
            yield row()

    return df.mapInArrow(lean(run), "chunk long, body binary").repartition("chunk")


def _open(body: bytes):
    """(ids of the documents, words in each, word numbers, words)."""
    ids, sizes, slots, lengths, data = _unpack(body, "bnnnb")
    return pickle.loads(ids), sizes, slots, _split(lengths, data)


def _sites(batches):
    """(bucket, chunk, words): every chunk's distinct words by bucket, in the
    order of their numbers."""
    for b in batches:
        for chunk, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            words = _open(body)[3]
            bucket = _buckets(words)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            rows, keys = [], []
            for at in np.split(order, cuts) if len(order) else []:
                mine = [words[i] for i in at.tolist()]
                keys.append(int(bucket[at[0]]))
                rows.append(_pack(np.array([len(w) for w in mine], np.uint32), b"".join(mine)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array([chunk] * len(keys), pa.int64()),
                 pa.array(rows, pa.binary())], names=["bucket", "chunk", "words"])


def encode(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
           vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """Ids of every whole text: ``doc_id, n_tokens, ids`` (``ids``: binary,
    little-endian unsigned 32-bit numbers).

    Every match of ``pattern`` is encoded by itself, by the ranks of
    ``vocabulary``, without special tokens.  A null text counts as empty and
    has no ids.  Repeated rows give repeated results, an empty table an empty
    one; other columns of ``df`` are not read.  A word in every document
    costs one place in a list per chunk, not one row per occurrence.
    """
    import public_tokenizers
    ranks = df.sparkSession.sparkContext.broadcast(       # fixed by the vocabulary file
        load_ranks(vocabulary or tokenizer_path("byte_bpe_multi_50k.tiktoken")))
    chunks = _chunks(df.select(F.coalesce(F.col(text), F.lit("")).alias("text"),
                               F.col(doc_id).cast("long").alias("doc_id")),
                     pattern or public_tokenizers.PATTERN)

    def encode_words(batches):
        ranked, bucket, known = ranks.value, None, {}

        def ids_of(w):
            got = known.get(w)
            if got is None:
                if len(known) >= KNOWN:
                    known.clear()
                got = known[w] = np.array(encode_word(w, ranked), np.uint32).tobytes()
            return got
        for b in batches:
            out = []
            for k, value in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if k != bucket:                            # sorted: a bucket's words meet here
                    bucket, known = k, {}
                ids = [ids_of(w) for w in _split(*_unpack(value, "nb"))]
                out.append(_pack(np.array([len(x) // 4 for x in ids], np.uint32),
                                 np.frombuffer(b"".join(ids), np.uint32)))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(0), pa.array(out, pa.binary())],
                                             names=["chunk", "bucket", "ids"])

    encoded = (chunks.mapInArrow(lean(_sites), "bucket int, chunk long, words binary")
               .repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(lean(encode_words), "chunk long, bucket int, ids binary"))

    def put_together(left: pa.Table, right: pa.Table) -> pa.Table:
        docs, sizes, slots, words = _open(left.column("body")[0].as_py())
        # lists in bucket order stand in the order in which their words were sent
        rows = sorted(zip(right.column("bucket").to_pylist(), right.column("ids").to_pylist()))
        lists = [_unpack(v, "nn") for _, v in rows]
        none = np.zeros(0, np.uint32)
        sent = np.concatenate([none, *(n for n, _ in lists)])
        if len(sent) != len(words):
            raise ValueError("words of a chunk are missing")
        flat = np.concatenate([none, *(x for _, x in lists)])
        order = np.argsort(_buckets(words), kind="stable")
        lens, starts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        lens[order] = sent
        starts[order] = np.cumsum(sent, dtype=np.int64) - sent
        out, at = [], 0
        for n in sizes.tolist():
            s = slots[at:at + n]
            at += n
            take = lens[s]
            shift = np.repeat(starts[s] - (np.cumsum(take) - take), take)
            out.append(flat[shift + np.arange(len(shift))].tobytes())
        return pa.table({"doc_id": pa.array(docs, pa.int64()),
                         "n_tokens": pa.array([len(x) // 4 for x in out], pa.int64()),
                         "ids": pa.array(out, pa.binary())})

    return (chunks.groupBy("chunk").cogroup(encoded.groupBy("chunk"))
            .applyInArrow(put_together, "doc_id long, n_tokens long, ids binary"))


def decode(df: DataFrame, ids: str = "ids", vocabulary: str | None = None,
           name: str = "decoded") -> DataFrame:
    """``df`` with the bytes its ids stand for, as column ``name`` (replaced
    if there is one).

    Ids are joined with the token-byte table, which the vocabulary fixes (some
    50,000 rows), so every task holds it and positions stay in order.  Null
    ids give null, no ids empty bytes; an id outside the table is an error.
    """
    table = load_ranks(vocabulary or tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    tokens: list = [None] * (max(table.values()) + 1)
    for b, i in table.items():
        tokens[i] = b
    shared = df.sparkSession.sparkContext.broadcast(tokens)
    names = [c for c in df.columns if c != name]
    inner = df.select(*[F.col(f"`{c}`") for c in names])
    at = names.index(ids)

    def run(batches):
        token = shared.value.__getitem__
        for b in byte_blocks(batches, at):
            out = [None if x is None else b"".join(map(token, np.frombuffer(x, np.uint32).tolist()))
                   for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())],
                                             names=[*names, name])

    return inner.mapInArrow(lean(run), extended(inner, **{name: "binary"}))
