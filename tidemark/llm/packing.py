"""Hierarchical multi-length packing of token ids.

Documents are cut only where it helps. Whole 2048-token parts are sequences of
their own; what is left of a document goes to the tier of the shortest window
that holds it. From the longest tier down, every window begins with its own
tier's pieces, and the gap that stays is filled from shorter ones, best fit
first, with a cut only when nothing fits whole. All windows are powers of two
long and full. The sequences are then dealt to step groups of equal size and
about equal attention cost.

Each task packs the documents of its own partition as a stream with a bounded
buffer, so nothing is shuffled. What is too little for a window stays in the
buffer; at the end of a partition it is cut into powers of two.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import ENCODE_BYTES, broadcast_model, codec_of
from tidemark.llm.runtime import give_back
from tidemark.llm.textbatch import slices

TIERS = (2048, 1024, 512, 256)
#: Added after each document.
END_ID = 1
#: Tokens of a step group: eight of the longest windows.
STEP_TOKENS = 8 * TIERS[0]

#: A piece: number of its document in the buffer, first token, tokens.
Piece = tuple[int, int, int]


def pack(pieces: list[Piece], tiers: tuple[int, ...] = TIERS) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences of the tiers' lengths, and the pieces that are left."""
    out: list[list[Piece]] = []
    pool: list[tuple[int, int, int]] = []  # length, document, start: sorted
    longest = tiers[0]
    for doc, start, n in pieces:
        while n >= longest:
            out.append([(doc, start, longest)])
            start, n = start + longest, n - longest
        if n:
            pool.append((n, doc, start))
    pool.sort()
    left: list[Piece] = []
    for tier in tiers:
        floor = tier // 2 if tier != tiers[-1] else 0
        while pool and pool[-1][0] > floor:
            n, doc, start = pool.pop()
            window, gap = [(doc, start, n)], tier - n
            while gap and pool:
                fit = bisect_right(pool, (gap + 1,)) - 1
                n, doc, start = pool.pop(max(fit, 0))
                if n > gap:  # nothing fits whole: the shortest is cut
                    insort(pool, (n - gap, doc, start + gap))
                    n = gap
                window.append((doc, start, n))
                gap -= n
            if gap:
                left += window
            else:
                out.append(window)
    return out, left


def halve(pieces: list[Piece], longest: int = TIERS[0]) -> list[list[Piece]]:
    """The pieces in a row, cut into sequences of powers of two, long ones first."""
    total = sum(n for _, _, n in pieces)
    sizes = [longest] * (total // longest)
    sizes += [1 << b for b in reversed(range(longest.bit_length())) if (total % longest) >> b & 1]
    out, rest = [], list(pieces[::-1])
    for size in sizes:
        window, gap = [], size
        while gap:
            doc, start, n = rest.pop()
            take = min(n, gap)
            window.append((doc, start, take))
            gap -= take
            if n > take:
                rest.append((doc, start + take, n - take))
        out.append(window)
    return out


def step_groups(sequences: list[list[Piece]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """For each sequence the number of its step group.

    Long sequences first, each goes to the group with the least attention cost
    (sum of squared piece lengths) that has room.
    """
    sizes = [sum(n for _, _, n in s) for s in sequences]
    groups = max(1, -(-sum(sizes) // step_tokens))
    heap = [(0, g, step_tokens) for g in range(groups)]
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: -sizes[i]):
        aside = []
        while heap and heap[0][2] < sizes[i]:
            aside.append(heapq.heappop(heap))
        cost, g, room = heapq.heappop(heap) if heap else (0, groups, step_tokens)
        groups += g == groups
        out[i] = g
        heapq.heappush(heap, (cost + sum(n * n for _, _, n in sequences[i]), g, room - sizes[i]))
        for x in aside:
            if x[2]:
                heapq.heappush(heap, x)
    return out


def pack_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a training sequence.

    Columns: ``id_col``; ``start`` (the document's ids before the piece),
    ``length`` and ``ids`` (binary, little-endian unsigned 32-bit) of the piece;
    ``doc_tokens`` (the document's ids, ``end_id`` included); ``sequence_id``,
    ``offset`` (place in the sequence, without gaps from 0), ``sequence_length``
    (a power of two up to 2048; no sequence needs padding) and ``step_group``.
    Null and empty texts have the end id alone. Null and repeated ids are rows
    like any other; other columns are not read. The result depends on how the
    rows are partitioned, not on their number. An empty table gives no sequence.
    """
    model = broadcast_model(docs.sparkSession, model_path)
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value)
        base = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # id, its tokens, their number
        left: list[Piece] = []
        n_sequences = n_groups = 0

        def rows(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal n_sequences, n_groups
            groups = step_groups(sequences)
            out: list[tuple] = []
            for number, (sequence, group) in enumerate(zip(sequences, groups, strict=True)):
                size, at = sum(n for _, _, n in sequence), 0
                for doc, start, n in sequence:
                    name, tokens, first, total = held[doc]
                    raw = tokens[4 * (start - first) : 4 * (start - first + n)]
                    out.append((name, start, n, raw, total, base + n_sequences + number, at, size, base + n_groups + group))
                    at += n
            n_sequences += len(sequences)
            n_groups += max(groups, default=-1) + 1
            columns = list(zip(*out, strict=True)) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group"]
        types: list = []
        for batch in slices(batches, size=ENCODE_BYTES):
            types = [batch.schema.field("id").type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
            ids, at = codec.encode_column(batch.column("text"))
            raw = ids.astype("<u4", copy=False).tobytes()
            end = np.array([end_id], "<u4").tobytes()
            pieces = left
            for name, a, b in zip(batch.column("id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                pieces.append((len(held), 0, b - a + 1))
                held.append((name, raw[4 * a : 4 * b] + end, 0, b - a + 1))
            sequences, left = pack(pieces)
            yield rows(sequences)
            # only what is left is kept: its tokens, and where they begin in the document
            kept = []
            for doc, start, n in left:
                name, tokens, first, total = held[doc]
                kept.append((name, tokens[4 * (start - first) : 4 * (start - first + n)], start, total))
            held = kept
            left = [(i, start, n) for i, (_, start, n) in enumerate(left)]
        if left:
            yield rows(halve(left))
        give_back()

    schema = T.StructType().add("id", kind).add("start", "long").add("length", "long").add("ids", "binary")
    for name in ("doc_tokens", "sequence_id", "offset", "sequence_length", "step_group"):
        schema = schema.add(name, "long")
    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_col)
