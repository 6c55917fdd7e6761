"""Cost-balanced packing of documents into sequences of bounded length.

A document of n tokens costs ``linear * n + quadratic * n * n``, as attention
does. Documents are cut at the sequence length; the rest pieces of a chunk of
documents are then taken by descending cost, each put into the sequence of
lowest cost that has token capacity left, and cut where that capacity ends.
The chunk's capacities add up to its tokens: full sequences, and for what is
left over a few of a power of two, which need no padding.

Chunks lie within a task, so packing needs no shuffle, a hot source or a group
of copies changes nothing, and a task that is run again replaces its own output
only. Memory is bounded by ``chunk_tokens`` and the longest document.

Defined cases: a NULL text counts as empty and is one end token; repeated rows
are packed once each; an empty table gives no rows; columns other than doc_id
and text are ignored, whatever their names.
"""

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import types as T

from flowtally.llm.encoder import encoder

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
])


def capacities(tokens, size):
    """Sequence lengths that hold exactly so many tokens: full ones, then powers of two."""
    rest = tokens % size
    return [size] * (tokens // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths, size, linear, quadratic):
    """Places of a chunk's documents: (document, start, length, sequence, offset), in packing order."""
    places, rests, sequence = [], [], 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - size + 1, size):
            places.append((doc, start, size, sequence, 0))
            sequence += 1
        if n % size:
            rests.append((n % size, doc))
    room = capacities(sum(n for n, _ in rests), size)
    used = [0] * len(room)
    heap = [(0.0, s) for s in range(len(room))]
    for n, doc in sorted(rests, key=lambda x: (-x[0], x[1])):
        start = lengths[doc] - n
        while n:
            cost, s = heapq.heappop(heap)
            part = min(n, room[s] - used[s])
            places.append((doc, start, part, sequence + s, used[s]))
            used[s] += part
            if used[s] < room[s]:
                heapq.heappush(heap, (cost + linear * part + quadratic * part * part, s))
            n -= part
            start += part
    return places, sequence + len(room)


def pack(docs, tokenizer, size=2048, end_id=1, linear=1.0, quadratic=1 / 2048,
         chunk_tokens=4_000_000, with_ids=True):
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``tokenizer`` is the path of a word-level BPE file. sequence_id holds the
    task's number in its upper half. Without ``with_ids`` the ids stay NULL.
    """
    end = np.asarray([end_id], dtype="<i4").tobytes()

    def chunk(ids, codes, first):
        places, sequences = assign([len(c) // 4 for c in codes], size, linear, quadratic)
        cuts = [codes[d][4 * a:4 * (a + n)] for d, a, n, _, _ in places]
        doc, start, length, sequence, offset = (np.array(x, dtype=np.int64) for x in zip(*places))
        columns = [
            pa.array([ids[d] for d in doc], pa.int64()), pa.array(start), pa.array(length),
            pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
            pa.array([len(codes[d]) // 4 for d in doc], pa.int64()),
            pa.array(sequence + first), pa.array(offset),
        ]
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(
                pa.array(ends), pa.array(np.frombuffer(b"".join(cuts), dtype="<i4"))))
        else:
            columns.append(pa.nulls(len(doc), pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=SCHEMA.names), sequences

    def run(batches):
        encode = encoder(tokenizer)
        first = TaskContext.get().partitionId() << 32
        ids, codes, tokens = [], [], 0
        for batch in batches:
            texts = batch.column(1)
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                code = encode(texts[i].as_py() or "") + end
                ids.append(doc_id)
                codes.append(code)
                tokens += len(code) // 4
                if tokens >= chunk_tokens:
                    out, n = chunk(ids, codes, first)
                    yield out
                    first, ids, codes, tokens = first + n, [], [], 0
        if ids:
            yield chunk(ids, codes, first)[0]

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
