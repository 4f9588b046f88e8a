"""Repeated passages, found with suffix automata of reference shards and removed.

The corpus cannot be one automaton, and need not be compared with all of itself:
two equal windows of 50 words have the same smallest 8-word hash, so they meet in
one shard if passages are dealt by that hash. A shard's reference is every
different passage with that hash, each with the first document that holds it.
A suffix automaton of the reference keeps in every state the first document of
the strings that end there. The passages are streamed through it; the
matching statistics say for every word how long a match ends there and, cut to
50 words, in which document it was first. The longest spans covered by such matches
are removed from each document that is not the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.rules import let
from tidemark.llm.runtime import free_names, lean, ship_code, stored, temporary
from tidemark.llm.textbatch import Names, slices, union_of_spans, utf8, windows_by_minimum, word_names, words

WINDOW_WORDS = 50
ANCHOR_WORDS = 8
#: Different passages in a reference shard. Shards with more are compared window by window.
SHARD_PASSAGES = 512

_RUN = "array<struct<at:int,n:int,origin:long>>"


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """Runs of windows with the same anchor, the smallest hash of ``ANCHOR_WORDS`` words in a row.

    Columns: ``doc_id``, ``th`` (hash of the text), ``anchor``, ``passage`` (hash
    of the run's words), ``at`` (its first word) and ``n`` (its words).
    """
    ship_code(docs.sparkSession)
    gram = min(ANCHOR_WORDS, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words(batch.column("text"))
            text, begin, end, anchor, passage = windows_by_minimum(word_names(w), w.first, window, gram)
            pick = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pick),
                    batch.column("th").take(pick),
                    pa.array(anchor.view(np.int64)),
                    pa.array(passage.view(np.int64)),
                    pa.array(begin - w.first[text], pa.int32()),
                    pa.array(end - begin, pa.int32()),
                ],
                ["doc_id", "th", "anchor", "passage", "at", "n"],
            )

    plain = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(lean(run), "doc_id long, th long, anchor long, passage long, at int, n int")


class Reference:
    """Suffix automaton of passages, each a list of words and the document it was first in.

    Transitions are a dict per state, keyed by the word itself, so a match is a
    match of words and not of hashes.
    """

    def __init__(self, items: list[tuple[list[bytes], int]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.origin = [-1], [0], [None]
        for sequence, origin in items:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
                held = self.origin[last]
                self.origin[last] = origin if held is None else min(held, origin)
        # what ends in a longer string ends in its suffixes
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up, own = self.link[state], self.origin[state]
            if up > 0 and own is not None and (self.origin[up] is None or own < self.origin[up]):
                self.origin[up] = own

    def _add(self, length: int, link: int, to: dict[bytes, int]) -> int:
        self.next.append(to)
        self.length.append(length)
        self.link.append(link)
        self.origin.append(None)
        return len(self.length) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        copy = self._add(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        q = self.next[last].get(word)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new = self._add(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def origins(self, sequence: list[bytes], window: int) -> list[int | None]:
        """For each window of the sequence, the first document that holds it, or None.

        The match that ends at each word is kept at ``window`` words at most.
        """
        out: list[int | None] = []
        state = matched = 0
        for i, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            to = self.next[state].get(word)
            if to is None:
                state = matched = 0
            else:
                state, matched = to, matched + 1
            while state and self.length[self.link[state]] >= window:
                state = self.link[state]
            matched = min(matched, window, self.length[state])
            if i >= window - 1:
                out.append(self.origin[state] if matched == window else None)
        return out


def _runs(origins: list[int | None]) -> list[dict]:
    """Neighbouring windows with one origin as one entry."""
    out: list[dict] = []
    for i, origin in enumerate(origins):
        if origin is None:
            continue
        if out and out[-1]["origin"] == origin and out[-1]["at"] + out[-1]["n"] == i:
            out[-1]["n"] += 1
        else:
            out.append({"at": i, "n": 1, "origin": origin})
    return out


def match_shards(shards: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``anchor``, ``passage`` and ``runs`` (windows and their first document) of every passage.

    ``shards`` has ``anchor``, ``passage``, ``doc_id`` and ``words`` (joined by spaces); all of an anchor's
    passages are one reference. They are sorted by anchor, so that a task holds
    one reference at a time.
    """
    ship_code(shards.sparkSession)

    def match(rows: list[tuple]) -> list[tuple]:
        items = [(text.split(b" "), origin) for _, _, origin, text in rows]
        reference = Reference(items)
        return [(anchor, passage, _runs(reference.origins(sequence, window))) for (anchor, passage, _, _), (sequence, _) in zip(rows, items, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("passage", pa.int64()), ("runs", pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32()), ("origin", pa.int64())])))])
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    out += match(held)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(_columns(out, 3), schema.types, strict=True)], schema=schema)
            out = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(_columns(match(held), 3), schema.types, strict=True)], schema=schema)

    dealt = shards.select("anchor", "passage", "doc_id", F.col("words").cast("binary")).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "passage")
    return dealt.mapInArrow(lean(run), f"anchor long, passage long, runs {_RUN}")


def _columns(rows: list[tuple], n: int) -> list[list]:
    return [list(x) for x in zip(*rows, strict=True)] if rows else [[] for _ in range(n)]


def match_windows(shards: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """What ``match_shards`` returns, for shards too large for one automaton.

    Every window is a row, named by 128 bits of hash; the first document is an
    aggregate with partial sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "words"):
            w = words(batch.column("words"))
            values = word_names(w)
            one, two = Names(values).grams(window), Names(values, 0xC2B2AE3D27D4EB4F).grams(window)
            at = np.arange(len(one))
            text = np.searchsorted(w.first, at, side="right") - 1
            inside = at + window <= w.first[np.minimum(text + 1, len(w.first) - 1)]
            at, text = at[inside], text[inside]
            pick = pa.array(text)
            columns = [batch.column(c).take(pick) for c in ("anchor", "passage", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(at - w.first[text], pa.int32()), pa.array(one[at].view(np.int64)), pa.array(two[at].view(np.int64))],
                ["anchor", "passage", "doc_id", "at", "one", "two"],
            )

    rows = shards.select("anchor", "passage", "doc_id", "words").mapInArrow(lean(run), "anchor long, passage long, doc_id long, at int, one long, two long")
    first = stored(rows.groupBy("one", "two").agg(F.min("doc_id").alias("origin")), "first-documents")
    found = rows.join(first, ["one", "two"]).select("anchor", "passage", F.struct("at", F.lit(1).alias("n"), "origin").alias("run"))
    return found.groupBy("anchor", "passage").agg(_merged(F.sort_array(F.collect_list("run"))).alias("runs"))


def _merged(runs):
    """Neighbouring windows with one origin as one run; ``runs`` is in order.

    A run begins where the one before is no neighbour or has another origin, and
    ends where the next one begins.
    """

    def joined(runs):
        follows = lambda a, b: (a["origin"] == b["origin"]) & (a["at"] + a["n"] == b["at"])
        heads = F.filter(runs, lambda r, i: ~F.coalesce(follows(F.get(runs, i - 1), r), F.lit(False)))
        tails = F.filter(runs, lambda r, i: ~F.coalesce(follows(r, F.get(runs, i + 1)), F.lit(False)))
        whole = lambda h, t: F.struct(h["at"].alias("at"), (t["at"] + t["n"] - h["at"]).alias("n"), h["origin"].alias("origin"))
        return F.zip_with(heads, tails, whole)

    return let(runs, joined).cast(_RUN)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, shard_passages: int = SHARD_PASSAGES) -> DataFrame:
    """``doc_id``, ``th`` and ``spans`` (from word, to word) that documents with smaller ids hold too.

    Only anchors that two documents share are followed. Of these, passages with
    the same words are one; one that is alone with its anchor has nothing to be
    matched with and keeps its first document. The others form the reference shards.
    """
    found = stored(passages(docs, id_col, text_col, window), "passages")
    shared = found.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("anchor")
    found = stored(found.join(stored(shared, "shared-anchors"), "anchor"), "shared-passages")
    where = F.struct("doc_id", "th", "at", "n")
    different = stored(found.groupBy("anchor", "passage").agg(F.min(where).alias("w")).select("anchor", "passage", "w.*"), "different-passages")
    sizes = different.groupBy("anchor").agg(F.count("*").alias("members")).where("members > 1")
    several = different.join(sizes, "anchor").groupBy("doc_id", "th").agg(F.collect_list(F.struct("anchor", "passage", "at", "n", "members")).alias("cuts"))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("string").alias("text"))
    shards = stored(texts.join(several, ["doc_id", "th"]).mapInArrow(lean(_cut_out), "anchor long, passage long, doc_id long, words string, members long").dropDuplicates(["anchor", "passage"]), "reference-shards")
    matched = match_shards(shards.where(F.col("members") <= shard_passages), window).unionByName(match_windows(shards.where(F.col("members") > shard_passages), window))
    alone = different.join(sizes.select("anchor"), "anchor", "left_anti").select(
        "anchor", "passage", F.array(F.struct(F.lit(0).alias("at"), (F.col("n") - window + 1).alias("n"), F.col("doc_id").alias("origin"))).cast(_RUN).alias("runs")
    )
    runs = alone.unionByName(matched)
    span = F.struct((F.col("at") + F.col("r.at")).alias("begin"), (F.col("at") + F.col("r.at") + F.col("r.n") + window - 1).alias("end"))
    return (
        found.join(runs, ["anchor", "passage"])
        .select("doc_id", "th", "at", F.explode("runs").alias("r"))
        .where("r.origin < doc_id")
        .select("doc_id", "th", span.alias("span"))
        .groupBy("doc_id", "th")
        .agg(F.collect_set("span").alias("spans"))
    )


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the wanted passages."""
    for big in batches:
        for batch in slices([big]):
            w = words(batch.column("text"))
            raw = w.data.tobytes()
            out: list[tuple] = []
            for doc, first, cuts in zip(batch.column("doc_id").to_pylist(), w.first.tolist(), batch.column("cuts").to_pylist(), strict=False):
                for c in cuts:
                    a, b = first + c["at"], first + c["at"] + c["n"]
                    text = b" ".join([raw[x:y] for x, y in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist(), strict=True)])
                    out.append((c["anchor"], c["passage"], doc, text.decode(), c["members"]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(_columns(out, 5), kinds, strict=True)], ["anchor", "passage", "doc_id", "words", "members"])


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text_col``, and ``n_words``, ``n_words_removed``.

    A word goes if it lies in a window of ``window`` words whose words, unchanged
    and in order, also stand in a document with a smaller id. Windows are judged
    on the input. A cut begins with its first word and ends before the next
    word that stays; everything else of a text stays as it is. Null and empty texts
    have no words. Rows with a null id are returned unchanged and are no
    reference; rows that repeat an id do not remove each other. Ids must be
    whole numbers. Columns of ``docs`` with the names of the two counts are replaced.
    """
    ship_code(docs.sparkSession)
    counts = ("n_words", "n_words_removed")
    kept = [c for c in docs.columns if c not in counts]
    th, doc, mark, found = free_names(docs, "_th", "_doc", "_hash", "_spans")
    with temporary(docs.sparkSession):
        spans = stored(repeated_spans(docs, id_col, text_col, window), "passages-to-cut", keep=True)
    # a merge at any size: one plan for a small and a large corpus
    spans = spans.withColumnsRenamed({"doc_id": doc, "th": mark, "spans": found}).hint("merge")
    rows = docs.select(*kept, F.xxhash64(text_col).alias(th))
    joined = rows.join(spans, (F.col(id_col).cast("long") == F.col(doc)) & (F.col(th) == F.col(mark)), "left").select(*kept, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in slices([big], text_col):
                w = words(batch.column(text_col))
                texts = batch.column(text_col).to_pylist()
                removed = [0] * len(texts)
                base = utf8(batch.column(text_col))[1]
                for k, spans in enumerate(batch.column(found).to_pylist()):
                    if spans:
                        first, after = int(w.first[k]), int(w.first[k + 1])
                        raw = w.data[base[k] : base[k + 1]].tobytes()
                        out, at = [], 0
                        for a, b in union_of_spans([(s["begin"], s["end"]) for s in spans]):
                            removed[k] += b - a
                            out.append(raw[at : w.starts[first + a] - base[k]])
                            at = w.starts[first + b] - base[k] if first + b < after else len(raw)
                        texts[k] = (b"".join(out) + raw[at:]).decode()
                columns = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(w.first), pa.int64()), pa.array(removed, pa.int64())], [*kept, *counts])

    schema = T.StructType([docs.schema[c] if c != text_col else T.StructField(c, T.StringType()) for c in kept])
    return joined.mapInArrow(lean(run), schema.add(counts[0], "long").add(counts[1], "long"))
