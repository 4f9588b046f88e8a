"""SimHash fingerprints, linked by bit-sliced comparison.

A fingerprint sums up the words of a whole text in 64 bits; near-copies differ
in few of them. Equal fingerprints are one node from the start. Two different
ones within the radius agree on two of the four 16-bit blocks at least, as long
as the radius is at most two, so every pair meets in one of six buckets. Inside
a bucket the fingerprints stand as 64 bit planes: one machine word holds one bit
of 64 fingerprints, the differences to a fingerprint are counted for all of them
at once with carry-save adders, and a block whose members all exceed the radius
is left early.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components, local_roots
from tidemark.llm.runtime import batches_of, lean, ship_code, stored, stored_at, temporary
from tidemark.llm.textbatch import Names, mix, range_names, slices, utf8, words
from tidemark.session import drop_folder

SHINGLE_WORDS = 3
RADIUS = 2
#: Fingerprints of one bucket that are compared in one task; larger buckets are cut and compared block by block.
BLOCK_ROWS = 1024

#: Words in a shingle and least Jaccard coefficient of near-copies in per cent.
COPY_WORDS = 5
COPY_PERCENT = 80
#: Most 64-bit words in the parities of a set; sets of some 9 000 shingles are told apart by so many.
PARITY_WORDS = 64
#: Smallest shared hashes of a set that go along with each of its places; pairs that share one are named there only.
MEETINGS = 4
#: Rows of a batch that is handed to Python.
COPY_BATCH = 2000
#: Buckets of up to so many rows are compared pair by pair, larger ones by bit planes.
FEW_ROWS = 16
#: 64-bit words of parities that are compared at a time.
PARITY_PART = 1 << 17
#: Planes pay from so many pairs on; their steps cost the same for fewer.
PLANE_PAIRS = 1 << 16

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_TABLES = tuple(combinations(range(4), 2))
_ONES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes, begin: list[int], end: list[int], seed: int = 42) -> int:
    """Fingerprint of one lower-case text whose words are joined by single spaces.

    ``begin`` and ``end`` are where its words stand. Bit b is 1 if it is set in
    over half of the shingles' hashes, repeats included.
    """
    if not begin:
        return 0
    k = SHINGLE_WORDS - 1
    if len(begin) <= k:
        return xxhash.xxh64_intdigest(text, seed)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[a:b], seed) for a, b in zip(begin, end[k:], strict=False)], np.uint64)
    return majority(h)


def majority(h: np.ndarray) -> int:
    """The bits set in over half of the numbers."""
    counts = np.zeros((8, 8), np.int64)  # bit within the byte, byte
    for at in range(0, len(h), 255):  # sums of up to 255 bits fit a byte
        part = h[at : at + 255]
        for bit in range(8):
            lanes = ((part >> np.uint64(bit)) & _ONES).sum(dtype=np.uint64)
            counts[bit] += np.frombuffer(int(lanes).to_bytes(8, "little"), np.uint8)
    return sum(1 << (8 * byte + bit) for bit in range(8) for byte in range(8) if 2 * counts[bit, byte] > len(h))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp`` (long, the 64 bits) of every row.

    A-Z are lower-cased, words are cut at space and 0x09-0x0D, and shingles of
    three words joined by a space are hashed with XXH64 (seed 42). A text with
    fewer words is one shingle; a text without words, empty or null, has
    fingerprint 0. Other columns are not read.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words(batch.column("text"))
            raw = w.data.tobytes().translate(_LOWER)
            starts, ends, first = w.starts.tolist(), w.ends.tolist(), w.first.tolist()
            out = []
            for a, b in zip(first[:-1], first[1:], strict=True):
                joined = b" ".join([raw[x:y] for x, y in zip(starts[a:b], ends[a:b], strict=True)])
                lengths = w.ends[a:b] - w.starts[a:b]
                end = np.cumsum(lengths + 1) - 1
                out.append(fingerprint(joined, (end - lengths).tolist(), end.tolist()))
            fps = pa.array(np.array(out, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), fps], ["id", "fp"])

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType().add("id", plain.schema["id"].dataType).add("fp", "long")
    return plain.mapInArrow(lean(run), schema).withColumnRenamed("id", id_col)


class BitPlanes:
    """Fingerprints stored vertically: ``planes[b]`` has bit b of all of them.

    A fingerprint is one 64-bit number or a row of several.
    """

    def __init__(self, fps: np.ndarray):
        self.n = len(fps)
        bits = np.unpackbits(fps.astype("<u8").reshape(self.n, -1).view(np.uint8), axis=1, bitorder="little")
        padded = np.zeros((bits.shape[1], -(-self.n // 64) * 64), np.uint8)
        padded[:, : self.n] = bits.T
        self.planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")

    def within(self, fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
        """A row per fingerprint in ``fps``: which of the stored ones differ in ``radius`` bits at most.

        The distances are kept as bit-sliced counters: ``counter[i]`` has bit i
        of all of them. Planes are added two at a time, a full adder giving
        their sum and carry. A counter that overflows stays over. The rows
        whose distances all exceed the radius are dropped from what is left.
        """
        width = max(1, int(radius).bit_length())
        rows = np.arange(len(fps))
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        shape = (len(fps), self.planes.shape[1])
        counter = [np.zeros(shape, np.uint64) for _ in range(width)]
        over = np.zeros(shape, np.uint64)
        out = np.zeros((len(fps), self.n), bool)
        query = fps.astype(np.uint64).reshape(len(fps), -1)
        for b in range(0, len(self.planes), 2):
            word = query[:, b // 64]
            x, y = (self.planes[b + i] ^ np.where((word >> np.uint64((b + i) % 64)) & np.uint64(1), full, np.uint64(0))[:, None] for i in (0, 1))
            half = x ^ y
            carry = (x & y) | (counter[0] & half)
            counter[0] = counter[0] ^ half
            for i in range(1, width):
                counter[i], carry = counter[i] ^ carry, counter[i] & carry
            over |= carry
            if b % 16 == 14:
                near = ~(over | _exceeds(counter, radius))
                alive = near.any(axis=1)
                if not alive.all():
                    rows, query, over = rows[alive], query[alive], over[alive]
                    counter = [c[alive] for c in counter]
                    if not len(rows):
                        return out
        near = ~(over | _exceeds(counter, radius))
        out[rows] = np.unpackbits(near.astype("<u8").view(np.uint8).reshape(len(rows), -1), axis=1, bitorder="little")[:, : self.n].astype(bool)
        return out


def _exceeds(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the counters, read as binary numbers, are more than ``radius``."""
    more, equal = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            equal &= counter[i]
        else:
            more |= equal & counter[i]
            equal &= ~counter[i]
    return more


def near_pairs(nodes: DataFrame, fp_col: str = "fp", node_col: str = "node") -> DataFrame:
    """Edges ``a``, ``b`` that connect all nodes whose fingerprints differ in two bits at most.

    ``nodes`` has one row per fingerprint. Not all pairs are returned: each
    comparison of two blocks gives at most one edge per member, which connect
    what the pairs would connect.
    """
    ship_code(nodes.sparkSession)
    keys = F.array(*[
        F.struct(F.lit(t).alias("table"), ((_block(fp_col, i) * 65536) + _block(fp_col, j)).cast("long").alias("key"))
        for t, (i, j) in enumerate(_TABLES)
    ])
    rows = nodes.select(F.col(node_col).alias("node"), F.col(fp_col).alias("fp"), F.explode(keys).alias("k")).select("node", "fp", "k.*")
    crowded = rows.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = (
        rows.join(crowded, ["table", "key"])
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "fp")
        .repartition("table", "key", "i", "j")
        .sortWithinPartitions("table", "key", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the last bucket, which may go on in the next batch
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7)])
            if held:
                rows = np.concatenate([*held, rows], axis=1)
            new = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            cut = new[-1] if len(new) else 0
            yield from _compare(rows[:, :cut], new)
            held = [rows[:, cut:]]
        if held:
            yield from _compare(held[0], np.zeros(0, np.int64))

    return pairs.mapInArrow(lean(run), "a long, b long").distinct()


def _block(fp_col: str, i: int):
    return F.shiftrightunsigned(F.col(fp_col), 16 * i).bitwiseAND(F.lit(0xFFFF))


def _compare(rows: np.ndarray, new: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Edges within each bucket, or between the two blocks of a cut one."""
    if not rows.shape[1]:
        return
    begins = np.unique(np.concatenate(([0], new[new < rows.shape[1]])))
    ends = np.append(begins[1:], rows.shape[1])
    left, right = [], []
    two = begins[ends - begins == 2]  # most buckets: one pair
    if len(two):
        x = rows[6, two].view(np.uint64) ^ rows[6, two + 1].view(np.uint64)
        near = np.bitwise_count(x) <= RADIUS
        left.append(rows[5, two][near])
        right.append(rows[5, two + 1][near])
    for begin, end in zip(begins, ends, strict=True):
        if end - begin <= 2:
            continue
        i, j, own, node, fp = rows[2, begin], rows[3, begin], rows[4, begin:end], rows[5, begin:end], rows[6, begin:end].view(np.uint64)
        here = np.flatnonzero(own == i)
        there = here if i == j else np.flatnonzero(own == j)
        if not len(here) or not len(there):
            continue
        planes, found = BitPlanes(fp[there]), []
        for at in range(0, len(here), 256):
            x, y = np.nonzero(planes.within(fp[here[at : at + 256]]))
            found.append((here[at + x], there[y]))
        a, b = (np.concatenate(z) for z in zip(*found, strict=True))
        root = local_roots(a, b, end - begin)
        tied = np.flatnonzero(root != np.arange(end - begin))
        left.append(node[tied])
        right.append(node[root[tied]])
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` of every row.

    Rows belong together if a chain of fingerprints leads from one to the other,
    each within two bits of the next; ``component_id`` is the smallest id of the
    group. Texts without words have fingerprint 0 and are linked like any
    other. A null id is a row of its group but never names it; a group of null
    ids alone has a null component. Ids must be whole numbers. An empty table
    gives an empty one.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min(id_col).alias("node"))
    named = nodes.select("fp", F.col("node").alias("least"))
    tie = near_pairs(nodes.select("fp", F.col("fp").alias("node")))
    groups = components(tie)
    whole = named.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    whole = whole.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = whole.join(least, "component").select("fp", "component_id")
    return prints.join(labels, "fp").select(id_col, "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id.

    Rows with a null id stay. Of rows that repeat the smallest id of a group, all
    stay. All columns are returned as they are.
    """
    groups = simhash_groups(docs, id_col, text_col)
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone_id"], "left_anti")


def shingle_sets(column: pa.Array, size: int = COPY_WORDS) -> Iterator[np.ndarray]:
    """The different shingle hashes of each text, sorted.

    A-Z are lower-cased. A text of fewer words is one shingle; one without words has none.
    """
    w = words(column)
    rolling = Names(range_names(np.frombuffer(_LOWER, np.uint8)[w.data], w.starts, w.ends))
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        begin = np.arange(a, max(a, b - size) + 1) if b > a else np.zeros(0, np.int64)
        yield np.unique(rolling.ranges(begin, np.minimum(begin + size, b)))


def parities(h: np.ndarray) -> bytes:
    """For each place 1 if an odd number of hashes has it as its lowest bits.

    An element that only one of two sets has turns one place over, so parities
    differ in no more places than there are such elements. There are as
    many places as hashes at least, up to ``64 * PARITY_WORDS``.
    """
    size = 64 * min(PARITY_WORDS, 1 << max(0, (len(h) - 1) // 64).bit_length())
    odd = np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Parities:
    """Parities of some sets, of different widths, and the sizes of the sets."""

    def __init__(self, n: np.ndarray, column: pa.Array):
        self.n, (raw, at) = n, utf8(column)
        self.raw, self.at, self.width = raw.view("<u8"), at[:-1] // 8, np.diff(at) // 8

    def rows(self, index: np.ndarray, width: int, to: int) -> np.ndarray:
        """These sets' parities, all ``width`` numbers wide, folded to ``to``."""
        rows = self.raw[self.at[index][:, None] + np.arange(width)].astype(np.uint64, copy=False)
        return np.bitwise_xor.reduce(rows.reshape(len(index), width // to, to), axis=1)


def near_by_parity(a: Parities, i: np.ndarray, b: Parities, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs may have a Jaccard coefficient of ``percent``, by sizes and parities; no pair that has is lost.

    Sets of n and m elements with coefficient t differ in (n + m) (1 - t) / (1 + t) elements.
    """
    n, m = a.n[i], b.n[j]
    near = (100 * n >= percent * m) & (100 * m >= percent * n)
    widths = a.width[i] * (2 * PARITY_WORDS) + b.width[j]
    for kind in np.unique(widths[near]).tolist():
        x, y = divmod(kind, 2 * PARITY_WORDS)
        here = np.flatnonzero(near & (widths == kind))
        step = max(1, PARITY_PART // max(x, y))
        for at in range(0, len(here), step):
            part = here[at : at + step]
            far = np.bitwise_count(a.rows(i[part], x, min(x, y)) ^ b.rows(j[part], y, min(x, y))).sum(axis=1, dtype=np.int64)
            near[part] = (100 + percent) * far <= (100 - percent) * (n[part] + m[part])
    return near


def shingle_sketches(docs: DataFrame, size: int = COPY_WORDS, percent: int = COPY_PERCENT) -> DataFrame:
    """``id``, ``th``, ``n`` (shingles), ``fp`` and ``whole`` (of the set), ``prefix`` and ``bits`` for rows of ``id``, ``th``, ``text``.

    ``prefix`` has the smallest hashes of the set, so many that two sets with a
    Jaccard coefficient of ``percent`` or more share one of them at least. ``bits``
    are its :func:`parities`.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, fp, whole, least, bits = [], [], [], [], []
            for h in shingle_sets(batch.column("text"), size):
                n.append(len(h))
                fp.append(majority(h))
                whole.append(int(mix(h ^ np.uint64(size)).sum(dtype=np.uint64)))
                least.append(h[: len(h) - -(-percent * len(h) // 100) + 1])
                bits.append(parities(h))
            at = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in least]))), pa.int32())
            prefix = pa.ListArray.from_arrays(at, pa.array(np.concatenate(least).view(np.int64)))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (n, fp, whole)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), *longs, prefix, pa.array(bits, pa.binary())], ["id", "th", "n", "fp", "whole", "prefix", "bits"]
            )

    schema = T.StructType([docs.schema["id"], docs.schema["th"]])
    for name in ("n", "fp", "whole"):
        schema = schema.add(name, "long")
    return docs.mapInArrow(lean(run), schema.add("prefix", T.ArrayType(T.LongType())).add("bits", "binary"))


def _verified(pairs: DataFrame, plain: DataFrame, size: int, percent: int) -> DataFrame:
    """``id`` and ``th`` of the later row of each pair whose shingle sets have a Jaccard coefficient of ``percent`` at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(batch.column("text"), size))
            at = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in sets]))), pa.int32())
            lists = pa.ListArray.from_arrays(at, pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), lists], ["id", "th", "s"])

    schema = T.StructType([plain.schema["id"], plain.schema["th"]]).add("s", T.ArrayType(T.LongType()))
    with temporary(plain.sparkSession):
        pairs = stored(pairs.distinct(), "near-pairs")
        ends = pairs.select(F.col("x_id").alias("id"), F.col("x_th").alias("th")).union(pairs.select("id", "th")).distinct()
        # few texts of many files: dealt out anew, they fill few tasks and files
        asked = plain.join(ends, ["id", "th"], "left_semi").repartition("id", "th")
        sets = stored(asked.mapInArrow(lean(run), schema), "shingle-sets")
        first = sets.select(F.col("id").alias("x_id"), F.col("th").alias("x_th"), F.col("s").alias("x_s"))
        both = pairs.join(first, ["x_id", "x_th"]).join(sets, ["id", "th"]).withColumn("i", F.size(F.array_intersect("x_s", "s")))
        near = both.where(100 * F.col("i") >= percent * (F.size("x_s") + F.size("s") - F.col("i")))
        return stored(near.select("id", "th").distinct(), "near-copies", keep=True)


def _of_group(nodes: DataFrame) -> DataFrame:
    """Pairs of a row and the first one of its group of fingerprints; ``x_`` is the first.

    Groups are those of :func:`simhash_groups`, over the fingerprints of these sets.
    """
    prints = nodes.groupBy("fp").agg(F.min(F.struct("id", "th")).alias("k"))
    prints = stored(prints.select("fp", "k"), "copy-fingerprints")
    groups = components(near_pairs(prints.select("fp", F.col("fp").alias("node")))).withColumnRenamed("node", "fp")
    first = prints.join(groups, "fp").groupBy("component").agg(F.min("k").alias("x"))
    tied = groups.join(first, "component").select("fp", "x")
    # a fingerprint without a near one is a group of the rows that have it
    x = F.coalesce("x", "k")
    rows = nodes.select("fp", "id", "th").join(prints.join(tied, "fp", "left").select("fp", x.alias("x")), "fp")
    return rows.where(F.col("x.id") < F.col("id")).select(F.col("x.id").alias("x_id"), F.col("x.th").alias("x_th"), "id", "th")


_ENDS = ("x_id", "x_th", "id", "th")
_MET = tuple(f"m{i}" for i in range(MEETINGS))


def _with_first(left: DataFrame, percent: int) -> DataFrame:
    """Pairs of a row and the first one of one of its hashes that may be near-copies; ``x_`` is the first."""
    first = left.groupBy("h").agg(F.min(F.struct("id", "th", "n", "bits")).alias("x"))
    rows = left.join(first, "h").where(F.col("x.id") < F.col("id")).select(*(F.col(f"x.{c}").alias(f"x_{c}") for c in ("id", "th", "n", "bits")), "id", "th", "n", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.arange(batch.num_rows)
            x, y = (Parities(batch.column(f"{p}n").to_numpy(zero_copy_only=False), batch.column(f"{p}bits")) for p in ("x_", ""))
            yield batch.select(_ENDS).filter(pa.array(near_by_parity(x, at, y, at, percent)))

    return rows.mapInArrow(lean(run), T.StructType([rows.schema[c] for c in _ENDS]))


def _in_blocks(left: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows that share a hash and may be near-copies; ``x_`` has the smaller id.

    The rows of a hash are dealt to blocks, and each pair of blocks is compared
    in a task of its own. A pair that shares one of its smallest hashes is named
    there, or was compared there before, and not again at a larger hash.
    """
    crowded = left.groupBy("h").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"), F.count("*").alias("k")).where("k > 1").drop("k")
    own = F.pmod(F.xxhash64("id", "th"), F.col("blocks")).cast("int")
    rows = (
        left.join(crowded, "h")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "th", "n", "bits", *_MET)
        .repartition("h", "i", "j")
        .sortWithinPartitions("h", "i", "j")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last blocks, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if all(batch.column(c)[-1] == held[0].column(c)[0] for c in ("h", "i", "j")):
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            begins = _begins(whole)
            yield from _compare_blocks(whole.slice(0, begins[-1]), begins[:-1], percent)
            held = [whole.slice(begins[-1])]
        if held:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from _compare_blocks(whole, _begins(whole), percent)

    return rows.mapInArrow(lean(run), T.StructType([T.StructField(c, left.schema[c.removeprefix("x_")].dataType) for c in _ENDS]))


def _begins(batch: pa.RecordBatch) -> np.ndarray:
    """Where another hash or pair of blocks begins."""
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "i", "j")]
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))


def _compare_blocks(batch: pa.RecordBatch, begins: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs that may be near-copies, of rows between two of ``begins``."""
    if not batch.num_rows:
        return
    i, j, own, ids, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("i", "j", "own", "id", "n"))
    sets = Parities(n, batch.column("bits"))
    ends = np.append(begins[1:], batch.num_rows)
    sizes = ends - begins
    few = sizes <= FEW_ROWS
    group = np.repeat(np.arange(len(begins)), sizes)
    for d in range(1, int(sizes[few].max(initial=1))):
        a = np.flatnonzero((group[d:] == group[:-d]) & few[group[d:]])
        a = a[(i[a] == j[a]) | (own[a] != own[a + d])]
        yield _ordered(batch, ids, a, a + d, near_by_parity(sets, a, sets, a + d, percent))
    for begin, end in zip(begins[~few].tolist(), ends[~few].tolist(), strict=True):
        here = begin + np.flatnonzero(own[begin:end] == i[begin])
        there = begin + np.flatnonzero(own[begin:end] == j[begin])
        for x in np.unique(sets.width[here]).tolist():
            for y in np.unique(sets.width[there]).tolist():
                left, right = here[sets.width[here] == x], there[sets.width[there] == y]
                radius = (100 - percent) * int(n[left].max() + n[right].max()) // (100 + percent)
                width = min(x, y)
                if 100 * max(n[left].max(), n[right].max()) < percent * min(n[left].min(), n[right].min()):
                    continue
                planes = BitPlanes(sets.rows(right, y, width)) if radius < 64 * width and len(left) * len(right) >= PLANE_PAIRS else None
                for at in range(0, len(left), 256):
                    part = left[at : at + 256]
                    mask = planes.within(sets.rows(part, x, width), radius) if planes else np.ones((len(part), len(right)), bool)
                    a, b = np.nonzero(mask & (part[:, None] < right if i[begin] == j[begin] else True))
                    a, b = part[a], right[b]
                    yield _ordered(batch, ids, a, b, near_by_parity(sets, a, sets, b, percent))


def _ordered(batch: pa.RecordBatch, ids: np.ndarray, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """The near ones of these pairs of rows with different ids that have no smaller hash to meet at, the smaller id first."""
    near &= ids[a] != ids[b]
    a, b = a[near], b[near]
    h, *least = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", *_MET))
    near = ~np.logical_or.reduce([(x[a] < h[a]) & (x[a] == y[b]) for x in least for y in least])
    a, b = a[near], b[near]
    swap = ids[a] > ids[b]
    a, b = pa.array(np.where(swap, b, a)), pa.array(np.where(swap, a, b))
    return pa.RecordBatch.from_arrays([batch.column(c).take(k) for k in (a, b) for c in ("id", "th")], list(_ENDS))


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = COPY_WORDS, percent: int = COPY_PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when later near-copies go.

    Near-copies have sets of ``size``-word shingles with a Jaccard coefficient of
    ``percent`` at least. Of two rows that stay none is a near-copy of the other,
    and each row that goes has a near-copy with a smaller id in ``docs``. Equal
    sets are one node from the start. Fingerprints of the sets form groups as in
    :func:`simhash_groups`, and a node goes if it is a near-copy of the first one of
    its group. At such coefficients most near-copies lie outside the radius, and
    tables of more bits cost more than comparing everything; the exact way for
    the rest are candidates that share one of the smallest hashes of their sets and have
    sizes and parities that allow the coefficient, none of which loses a pair. Every
    node that is left is compared with the first one of each of its hashes,
    which then leaves the hash, until that takes few away, so that large groups
    shrink before the rest are compared with each other; the nodes of a
    hash are cut into blocks, whose parities are compared by bit planes. Texts without
    words are copies of each other. Rows with a null id stay, as do rows that
    repeat an id and are copies of each other only. Shingles are told apart by
    64-bit hashes, equal sets by two. Ids must be whole numbers. All columns are
    returned as they are.
    """
    with temporary(docs.sparkSession), batches_of(docs.sparkSession, COPY_BATCH):
        rows = stored(_near_copy_rows(docs, id_col, text_col, size, percent), "near-copy-rows", keep=True)
    there = (docs[id_col].cast("long") == rows["_gone_id"]) & (F.xxhash64(docs[text_col].cast("string")) == rows["_gone_th"])
    return docs.join(rows, there, "left_anti")


def _near_copy_rows(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``_gone_id`` and ``_gone_th`` (hash of the text) of the rows that go."""
    spark = docs.sparkSession
    named = docs.where(F.col(id_col).isNotNull())
    plain = named.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(text_col).cast("string").alias("text"))
    same = ["whole", "fp", "n"]
    sketches, path = stored_at(shingle_sketches(plain, size, percent), "shingle-sketches")
    found = stored(sketches.select("id", "th", *same), "shingle-names")
    # one row for each set: of the smallest id, any text
    nodes = sketches.groupBy(*same).agg(F.min(F.struct("id", "th")).alias("k"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    nodes = stored(nodes.select(*same, "k.*", "prefix", "bits"), "shingle-nodes")
    drop_folder(spark, path)
    gone = [_verified(_of_group(nodes), plain, size, percent)]
    rest = nodes.join(gone[0], ["id", "th"], "left_anti")
    places = rest.select("id", "th", F.explode("prefix").alias("h"))
    shared = stored(places.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "shared-shingles")
    # a set's shared hashes in order; where it has fewer than MEETINGS, the others lie above all
    lists = places.join(shared, "h").groupBy("id", "th").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    met = [F.coalesce(F.get("hs", F.lit(i)), F.lit((1 << 63) - 1)).alias(c) for i, c in enumerate(_MET)]
    left = lists.join(nodes.select("id", "th", "n", "bits"), ["id", "th"]).select(F.explode("hs").alias("h"), "id", "th", "n", "bits", *met)
    left, path = stored_at(left, "shared-places")
    while True:
        out = _verified(_with_first(left, percent), plain, size, percent)
        gone.append(out)
        taken, before = out.count(), left.select("id", "th").distinct().count()
        # the first of a hash has met all others there; what is left of a hash goes on if it is two rows at least
        first = left.groupBy("h").agg(F.min(F.struct("id", "th")).alias("x"), F.count("*").alias("k")).where("k > 2").drop("k")
        rest = left.join(first, "h").where(F.struct("id", "th") != F.col("x")).drop("x")
        old, (left, path) = path, stored_at(rest.join(out, ["id", "th"], "left_anti"), "shared-places")
        drop_folder(spark, old)
        if 100 * taken <= before:
            break
    gone.append(_verified(_in_blocks(left, percent), plain, size, percent))
    drop_folder(spark, path)
    every = reduce(DataFrame.union, gone).withColumn("late", F.lit(True))
    late = nodes.select(*same, "id", "th").join(every, ["id", "th"], "left").select(*same, F.col("id").alias("least"), "late")
    # a set that goes takes all of its rows along
    rows = found.select("id", "th", *same).join(late, same).where("late or id > least")
    return rows.select(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct()
