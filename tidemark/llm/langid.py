"""Language identification by prediction by partial matching over bytes.

For each language a context tree counts which byte followed which context of up
to ``ORDER`` bytes. The probability of a byte is taken from the longest context
known; if the byte was not seen there, an escape is paid and the next shorter
context is asked, without the bytes already excluded, down to equal
probabilities for what is left of the 256 bytes. The counts are frozen after
training, so the code length of a byte depends on its context alone: all trees
together become one automaton whose states are contexts, with the next state and
the code length in every language for each byte. A text costs two table reads per byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.runtime import lean, ship_code
from tidemark.llm.sampling import sample_per_label
from tidemark.llm.textbatch import slices, utf8

#: Longest context in bytes.
ORDER = 3
#: Training texts per language; a bounded sample, of which whole texts are used.
SAMPLE_ROWS = 300
#: A context must have been seen this often in some language to be a node of the tree.
LEAST_COUNT = 2
#: Bytes of a text that are scored as one strand; strands of all texts advance together.
STRAND = 256

UNDECIDED = "und"


@dataclass
class ContextTrees:
    """The frozen model: ``step`` and ``cost`` are indexed by state and byte class."""

    languages: list[str]
    classes: np.ndarray  #: byte -> class; bytes never seen share the last class
    step: np.ndarray  #: (states, classes) -> state
    cost: np.ndarray  #: (states, classes, languages), bits

    def code_lengths(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits of each text in each language; ``at`` is where the texts begin, and the end."""
        total = np.zeros((len(at) - 1, len(self.languages)))
        if not len(data):
            return total
        width = self.step.shape[1]
        step, cost = self.step.ravel(), self.cost.reshape(-1, len(self.languages))
        codes = self.classes[data]
        sizes = np.diff(at)
        strands = -(-sizes // STRAND)
        owner = np.repeat(np.arange(len(sizes)), strands)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(strands) - strands, strands)
        begin = at[owner] + part * STRAND
        length = np.minimum(at[owner + 1] - begin, STRAND)
        state = np.zeros(len(owner), np.int64)
        for back in range(ORDER, 0, -1):  # a strand starts in the state that the bytes before it lead to
            warm = part > 0
            state[warm] = step[state[warm] * width + codes[begin[warm] - back]]
        order = np.argsort(-length, kind="stable")
        owner, begin, length, state = owner[order], begin[order], length[order], state[order]
        bits = np.zeros((len(owner), len(self.languages)), np.float64)
        alive = np.searchsorted(-length, -np.arange(STRAND), side="left")
        for i in range(int(length[0])):
            n = int(alive[i])
            key = state[:n] * width + codes[begin[:n] + i]
            bits[:n] += cost[key]
            state[:n] = step[key]
        np.add.at(total, owner, bits)
        return total


def count_contexts(texts: list[bytes], classes: np.ndarray, width: int) -> list[dict[int, np.ndarray]]:
    """For each order, how often each class followed each context (its classes as one number)."""
    orders: list[dict[int, np.ndarray]] = [{} for _ in range(ORDER + 1)]
    for order in range(ORDER + 1):
        keys = []
        for raw in texts:
            codes = classes[np.frombuffer(raw, np.uint8)].astype(np.int64)
            if len(codes) <= order:
                continue
            key = np.zeros(len(codes) - order, np.int64)
            for i in range(order + 1):
                key = key * width + codes[i : i + len(key)]
            keys.append(key)
        if keys:
            different, counts = np.unique(np.concatenate(keys), return_counts=True)
            rows = orders[order]
            for key, n in zip(different.tolist(), counts.tolist(), strict=True):
                context, symbol = divmod(key, width)
                row = rows.get(context)
                if row is None:
                    row = rows[context] = np.zeros(width)
                row[symbol] = n
    return orders


def train(texts: dict[str, list[bytes]]) -> ContextTrees:
    """The model of these texts by language; a text in no language is worth nothing."""
    languages = sorted(texts)
    seen = np.zeros(256, bool)
    for group in texts.values():
        for raw in group:
            seen[np.unique(np.frombuffer(raw, np.uint8))] = True
    known = np.flatnonzero(seen)
    width = len(known) + 1
    classes = np.full(256, width - 1, np.int64)
    classes[known] = np.arange(len(known))
    unseen = max(1, 256 - len(known))  # the bytes that share the last class
    counts = {x: count_contexts(texts[x], classes, width) for x in languages}

    # states: every context, of any language, that was met often enough, and its suffixes
    contexts: list[list[int]] = [[0]]
    for order in range(1, ORDER + 1):
        often: set[int] = set()
        for x in languages:
            often.update(c for c, row in counts[x][order].items() if row.sum() >= LEAST_COUNT)
        shorter = set(contexts[order - 1])
        low = width ** (order - 1)
        contexts.append(sorted(c for c in often if c % low in shorter))
    state_of = {(0, 0): 0}
    for order in range(1, ORDER + 1):
        for c in contexts[order]:
            state_of[order, c] = len(state_of)

    states = list(state_of)
    step = np.zeros((len(states), width), np.int32)
    cost = np.zeros((len(states), width, len(languages)), np.float32)
    classes_of = np.arange(width)
    for s, (order, c) in enumerate(states):
        up = state_of[order - 1, c % width ** (order - 1)] if order else -1
        if order == ORDER:
            step[s] = step[up]
            continue
        step[s] = step[up] if order else 0
        for symbol in classes_of.tolist():
            longer = state_of.get((order + 1, c * width + symbol))
            if longer is not None:
                step[s, symbol] = longer
    equal = np.full(width, 1.0)
    equal[-1] = unseen
    for k, x in enumerate(languages):
        for s, (order, c) in enumerate(states):
            cost[s, :, k] = _code_lengths(counts[x], order, c, width, equal)
    return ContextTrees(languages, classes, step, cost)


def _code_lengths(counts: list[dict[int, np.ndarray]], order: int, context: int, width: int, equal: np.ndarray) -> np.ndarray:
    """Bits of every class after a context: escapes, with exclusion, down to equal shares."""
    out = np.zeros(width)
    paid = 0.0
    left = np.ones(width, bool)  # classes not yet found in a longer context
    for k in range(order, -1, -1):
        row = counts[k].get(context % width**k if k else 0)
        if row is None:
            continue
        row = np.where(left, row, 0.0)
        kinds, total = np.count_nonzero(row), row.sum()
        if not kinds:
            continue
        here = row > 0
        out[here] = paid - np.log2(row[here] / (total + kinds))
        paid -= np.log2(kinds / (total + kinds))
        left &= ~here
    if left.any():
        share = equal[left].sum()
        out[left] = paid + np.log2(share)
    return out


def train_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> ContextTrees:
    """The model of ``rows`` texts of each language; rows without text, id or language are not used.

    The sample (at most ``rows`` times the number of languages) is counted on the driver.
    """
    chosen = sample_per_label(docs.where(F.col(text_col).isNotNull()).select(id_col, lang_col), lang_col, rows, id_col)
    sample = docs.join(F.broadcast(chosen.select(id_col, F.col(lang_col).alias("_lang")).dropDuplicates([id_col])), id_col).where(F.col(lang_col) == F.col("_lang"))
    texts: dict[str, list[bytes]] = {}
    for lang, text in sample.select("_lang", F.col(text_col).cast("string")).orderBy(id_col, "_lang").toLocalIterator():
        if text:
            texts.setdefault(lang, []).append(text.encode())
    return train(texts)


def identify(docs: DataFrame, model: ContextTrees, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    The language whose model gives the whole text the shortest code wins; of
    equal ones the first by name. ``score`` is its share of the probability that
    all models give the text, between 0 and 1. A text that is null or has no
    letter is ``und`` with score 0; so is everything if no language was learned.
    Columns of ``docs`` with these two names are replaced, all others are kept;
    only ``text_col`` is looked at. Null and repeated ids are rows like any other.
    """
    spark = docs.sparkSession
    ship_code(spark)
    names = ("lang_pred", "score")
    kept = [c for c in docs.columns if c not in names]
    frozen = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = frozen.value
        for big in batches:
            for batch in slices([big], text_col):
                column = batch.column(text_col)
                texts = column.to_pylist()
                found, scores = [UNDECIDED] * len(texts), np.zeros(len(texts))
                if trees.languages:
                    bits = trees.code_lengths(*utf8(column))
                    best = bits.argmin(axis=1)
                    share = 1.0 / np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000.0)).sum(axis=1)
                    for i, text in enumerate(texts):
                        if text and any(map(str.isalpha, text)):
                            found[i], scores[i] = trees.languages[best[i]], share[i]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(found, pa.string()), pa.array(scores)], [*kept, *names])

    plain = docs.select(*kept)
    return plain.mapInArrow(lean(run), T.StructType([*plain.schema.fields]).add(names[0], "string").add(names[1], "double"))
