"""Repeated runs of lines, found by winnowing and removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.runtime import free_names, lean, ship_code, stored, temporary
from tidemark.llm.textbatch import range_names, slices, utf8, windows_by_minimum, words

#: Lines in a window. A repeated run this long always shares a fingerprint.
RUN_LINES = 3
#: Words that a shorter run must have for its content alone to tell it apart.
LEAST_WORDS = 5


def _full_lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts; begin and end of each line with a word; number of each text's first such line."""
    data, at = utf8(column)
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(len(at), np.int64)
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate((at[:-1], breaks + 1)))
    begin = begin[begin < len(data)]
    # a line ends at its line break or where the next text begins
    stop = np.append(begin[1:], len(data))
    end = stop - (data[stop - 1] == 10)
    w = words(column)
    filled = np.searchsorted(w.starts, stop) > np.searchsorted(w.starts, begin)
    begin, end = begin[filled], end[filled]
    return data, begin, end, np.searchsorted(begin, at)


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_lines: int = RUN_LINES) -> DataFrame:
    """Winnowed fingerprints of line sequences, with what stands around them.

    Each text is the sequence of its lines that hold a word. In every window of
    ``run_lines`` lines the smallest line hash is the fingerprint; neighbouring
    windows with one fingerprint are one row: ``doc_id``, ``th`` (hash of the
    text, which tells rows of one id apart), ``fingerprint``, ``at`` (number of
    its first line) and ``lines`` (hashes of the lines that the windows cover).
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, begin, end, first = _full_lines(batch.column("text"))
            names = range_names(data, begin, end) if len(begin) else np.zeros(0, np.uint64)
            text, a, b, least, _ = windows_by_minimum(names, first, run_lines, 1)
            sizes = b - a
            total = np.concatenate(([0], np.cumsum(sizes)))
            source = np.repeat(a - total[:-1], sizes) + np.arange(total[-1])
            lists = pa.ListArray.from_arrays(pa.array(total, pa.int32()), pa.array(names[source].view(np.int64)))
            pick = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pick), batch.column("th").take(pick), pa.array(least.view(np.int64)), pa.array(a - first[text], pa.int32()), lists],
                ["doc_id", "th", "fingerprint", "at", "lines"],
            )

    plain = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType().add("doc_id", "long").add("th", "long").add("fingerprint", "long").add("at", "integer").add("lines", T.ArrayType(T.LongType()))
    return plain.mapInArrow(lean(run), schema)


def repeated_windows(windows: DataFrame, run_lines: int = RUN_LINES) -> DataFrame:
    """``doc_id``, ``th`` and ``at`` of every window whose lines stand at an earlier position too.

    Positions are ordered by document, then line. Fingerprints with one position
    are dropped first. Around the others the windows are compared by a 128-bit
    hash of all their lines; the earliest position of each content is an aggregate
    with partial results, so a line that a third of all documents hold is no group
    in one task. Keys, positions and counts have a fixed width and are hashed.
    """
    twice = (
        windows.groupBy("fingerprint")
        .agg(F.count("*").alias("n"), F.max(F.size("lines")).alias("most"))
        .where(f"n > 1 or most > {run_lines}")
        .select("fingerprint")
    )

    def around(i):
        content = F.slice("lines", i + 1, run_lines)
        return F.struct((F.col("at") + i).alias("at"), F.xxhash64(content).alias("one"), F.xxhash64(F.lit("two"), content).alias("two"))

    places = F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - run_lines), around))
    spots = stored(
        windows.join(stored(twice, "repeated-fingerprints"), "fingerprint").select("doc_id", "th", places.alias("w")).select("doc_id", "th", "w.*"),
        "line-windows",
    )
    # a document's number and a line's in one decimal: the order of both, in a fixed width
    position = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("at")
    spots = spots.withColumn("position", position.cast("decimal(38,0)"))
    earliest = spots.groupBy("one", "two").agg(F.min("position").alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n")
    found = spots.join(stored(earliest, "repeated-windows"), ["one", "two"])
    return found.where("position != origin").select("doc_id", "th", "at")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_lines: int = RUN_LINES, least_words: int = LEAST_WORDS) -> DataFrame:
    """``doc_id``, ``th`` and ``at`` of every line in a run that stands at an earlier position too.

    A run is ``run_lines`` lines, fewer lines that have ``least_words`` words, or
    a whole text that has neither, which is compared with other such texts. Every
    line of a repeated run is repeated, so runs are made only of lines found twice;
    a longer run is covered by its runs of up to ``run_lines`` lines.
    """
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("text")
            data, begin, end, first = _full_lines(column)
            names = range_names(data, begin, end) if len(begin) else np.zeros(0, np.uint64)
            starts = words(column).starts
            sizes = np.searchsorted(starts, end) - np.searchsorted(starts, begin)
            at = pa.array(first, pa.int32())
            lists = [pa.ListArray.from_arrays(at, x) for x in (pa.array(names.view(np.int64)), pa.array(sizes, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), *lists], ["doc_id", "th", "lines", "sizes"])

    plain = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType().add("doc_id", "long").add("th", "long").add("lines", T.ArrayType(T.LongType())).add("sizes", T.ArrayType(T.LongType()))
    texts = stored(plain.mapInArrow(lean(run), schema).where(F.size("lines") > 0), "text-lines")
    lines = texts.select("doc_id", "th", F.posexplode("lines").alias("at", "h"), F.col("sizes"), F.size("lines").alias("n_lines"))
    lines = lines.select("doc_id", "th", "at", "h", "n_lines", F.col("sizes")[F.col("at")].alias("n_words"))
    twice = stored(lines.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-lines")
    found = stored(lines.join(twice, "h"), "lines-found-twice")
    # the repeated lines of a text by place; a run has no gap
    order = Window.partitionBy("doc_id", "th").orderBy("at")
    none = F.lit(0).cast("long")
    whole, size = F.col("at") == 0, none
    names, spots = [], []
    for k in range(run_lines):
        # a row that repeats an id and a text stands at the same places
        there = F.lead("at", k).over(order) == F.col("at") + k
        found = found.dropDuplicates(["doc_id", "th", "at"]) if not k else found
        found = found.withColumn(f"h{k}", F.when(there, F.lead("h", k).over(order))).withColumn(f"w{k}", F.when(there, F.lead("n_words", k).over(order)))
    found = stored(found.drop("h", "n_words"), "runs-of-lines")
    for k in range(run_lines):
        names.append(f"h{k}")
        size = size + F.col(f"w{k}")
        # 1: a run by its size; 2: a whole text too short for that
        kind = F.when((F.lit(k + 1) >= run_lines) | (size >= least_words), 1).when(whole & (F.col("n_lines") == k + 1), 2)
        key = [F.col(x) if x in names else none.alias(x) for x in (f"h{i}" for i in range(run_lines))]
        spots.append(found.where(F.col(f"h{k}").isNotNull()).select("doc_id", "th", "at", F.lit(k + 1).alias("size"), kind.alias("kind"), *key).where("kind is not null"))
    every = spots[0]
    for more in spots[1:]:
        every = every.union(more)
    position = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(11,0)") + F.col("at")
    every = stored(every.withColumn("position", position.cast("decimal(38,0)")), "runs-by-content")
    content = ["size", "kind", *(f"h{i}" for i in range(run_lines))]
    earliest = every.groupBy(*content).agg(F.min("position").alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = every.join(stored(earliest, "repeated-runs"), content).where("position != origin")
    return later.select("doc_id", "th", F.explode(F.sequence("at", F.col("at") + F.col("size") - 1)).alias("at"))


def remove_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_lines: int = RUN_LINES, least_words: int | None = None
) -> DataFrame:
    """``docs`` without the later copies of runs of lines, and ``n_lines``, ``n_lines_removed``.

    A line with a word is removed if it lies in a window of ``run_lines``
    such lines of its document whose lines, byte for byte, also stand in a row
    at an earlier position of any document, its own included; positions go by
    document id, then line. Windows that touch grow together to the longest
    repeated run. With ``least_words``, runs of fewer lines go as well if they have
    that many words, and so do later copies of whole texts that are shorter than
    either. Windows are judged on the input. Blank lines are no part of
    windows and stay. Rows that repeat an id with another text are judged as
    one document's texts: their positions are equal, and do not remove each
    other. Rows with a null id or a null or empty text are returned unchanged.
    Ids must be whole numbers. Equal lines are told by 64-bit hashes. Columns of ``docs`` with the names of
    the two counts are replaced; all others are kept.
    """
    ship_code(docs.sparkSession)
    counts = ("n_lines", "n_lines_removed")
    kept = [c for c in docs.columns if c not in counts]
    width = run_lines if least_words is None else 1
    th, doc, mark, at_lines = free_names(docs, "_th", "_doc", "_hash", "_spots")
    with temporary(docs.sparkSession):
        if least_words is None:
            found = repeated_windows(stored(line_windows(docs, id_col, text_col, run_lines), "line-fingerprints"), run_lines)
        else:
            found = repeated_runs(docs, id_col, text_col, run_lines, least_words)
        spots = stored(found.groupBy("doc_id", "th").agg(F.collect_set("at").alias(at_lines)), "lines-to-cut", keep=True)
    # a merge at any size: one plan for a small and a large corpus
    spots = spots.withColumnsRenamed({"doc_id": doc, "th": mark}).hint("merge")
    rows = docs.select(*kept, F.xxhash64(text_col).alias(th))
    joined = rows.join(spots, (F.col(id_col).cast("long") == F.col(doc)) & (F.col(th) == F.col(mark)), "left").select(*kept, at_lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices([big], text_col):
                texts = batch.column(text_col).to_pylist()
                _, begin, end, first = _full_lines(batch.column(text_col))
                base = utf8(batch.column(text_col))[1]
                removed = [0] * len(texts)
                for k, spots in enumerate(batch.column(at_lines).to_pylist()):
                    if spots:
                        gone = np.unique((np.array(spots)[:, None] + np.arange(width)).ravel()) + first[k]
                        texts[k] = _without(texts[k].encode(), (begin[gone] - base[k]).tolist(), (end[gone] - base[k]).tolist()).decode()
                        removed[k] = len(gone)
                columns = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64())], [*kept, *counts])

    schema = T.StructType([docs.schema[c] if c != text_col else T.StructField(c, T.StringType()) for c in kept])
    return joined.mapInArrow(lean(run), schema.add(counts[0], "long").add(counts[1], "long"))


def _without(raw: bytes, begin: list[int], end: list[int]) -> bytes:
    """The text without these lines and their line breaks."""
    out, at = [], 0
    for a, b in zip(begin, end, strict=True):
        out.append(raw[at:a])
        at = min(b + 1, len(raw))
    out.append(raw[at:])
    left = b"".join(out)
    return left[:-1] if end and end[-1] == len(raw) and left.endswith(b"\n") else left
