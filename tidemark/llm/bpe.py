"""Exact byte-pair encoding and decoding by dynamic programming over prefixes.

A word's encoding has one property that makes it a table: for every prefix
there is exactly one token that ends the encoding of that prefix. The tokens
that can end at a position are the ones on the suffix path of a suffix
automaton of the vocabulary; of these, the right one is the token that is
compatible with the last token of the prefix before it, that is, merging the
two tokens' symbols from scratch would give these two tokens again. Following
the stored tokens back from the end of the word gives the ids.

``encode_documents`` and ``decode_documents`` are the operators; the model
file is read on the driver and broadcast as text, whose size is that of the
vocabulary whatever the corpus.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, pre_tokenizers

from tidemark.llm.memo import PieceTable
from tidemark.llm.runtime import held, ship_code
from tidemark.llm.textbatch import slices, utf8

#: Pairs of tokens whose verdict a worker remembers.
MOST_PAIRS = 450_000
#: Bytes of text encoded at a time; a longer text is taken alone.
ENCODE_BYTES = 2 << 20

# Kinds of bytes: 0 unsure (an apostrophe, or part of a longer letter), 1 letter, 2 digit, 3 sign, 4 blank.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 3
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[48:58] = 2
_KIND[[32, *range(9, 14)]] = 4
_KIND[ord("'")] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class SuffixAutomaton:
    """Suffix automaton of a set of symbol sequences (numbers under ``width``).

    ``go`` holds the transitions of all states in one dict keyed by
    ``state * width + symbol``.
    """

    def __init__(self, sequences: list[tuple[int, ...]], width: int):
        self.width = width
        self.go: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self._out: list[list[int]] = [[]]
        ends = []
        for sequence in sequences:
            last = 0
            for symbol in sequence:
                last = self._extend(last, symbol)
            ends.append(last)
        self.ends = ends
        del self._out

    def _state(self, length: int, link: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append([])
        return len(self.length) - 1

    def _clone(self, p: int, q: int, symbol: int) -> int:
        go, width = self.go, self.width
        copy = self._state(self.length[p] + 1, self.link[q])
        for x in self._out[q]:
            go[copy * width + x] = go[q * width + x]
        self._out[copy] = list(self._out[q])
        self.link[q] = copy
        while p >= 0 and go.get(p * width + symbol) == q:
            go[p * width + symbol] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, symbol: int) -> int:
        go, width = self.go, self.width
        q = go.get(last * width + symbol)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, symbol)
        new = self._state(self.length[last] + 1, 0)
        p = last
        while p >= 0 and p * width + symbol not in go:
            go[p * width + symbol] = new
            self._out[p].append(symbol)
            p = self.link[p]
        if p >= 0:
            q = go[p * width + symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, symbol)
        return new


class Codec:
    """Encoder and decoder of one model file in the JSON form of ``tokenizers``.

    Covers byte-level BPE with a word-end mark, lower-casing and a pattern that
    says what a word is, as in the public 49k word vocabulary.
    """

    def __init__(self, model_json: str):
        spec = json.loads(model_json)
        model = spec["model"]
        mark = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = token_names(model_json)
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # What a letter is depends on a library's version of Unicode. Texts beyond ASCII are
        # split by the library that the ids must agree with; it is not asked for ids.
        bare = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}))
        self._normalizer = bare.normalizer
        self._words = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self._plain_words = regex.compile(pattern)
        self._split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        if mark != "</w>" or spec["decoder"] is not None or model["unk_token"] is not None:
            raise ValueError("the model must be byte-level with the word end </w> and no decoder")

        rank = [-1] * len(self.names)
        left, right, merged = [0] * len(rank), [0] * len(rank), {}
        size = len(rank)
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            token = ids[a + b]
            rank[token], left[token], right[token] = r, ids[a], ids[b]
            merged[ids[a] * size + ids[b]] = r
        self.rank, self.left, self.right, self.merged, self.size = rank, left, right, merged, size

        letters = _byte_letters()
        self.inner = [ids[x] for x in letters]
        self.final = [ids[x + mark] for x in letters]
        symbols = {t: (t,) for t in ids.values() if rank[t] < 0}
        for token in sorted((t for t in ids.values() if rank[t] >= 0), key=rank.__getitem__):
            symbols[token] = symbols[left[token]] + symbols[right[token]]
        whole = list(symbols.items())
        automaton = SuffixAutomaton([s for _, s in whole], size)
        self.go, self.link, self.length = automaton.go, automaton.link, automaton.length
        here: list[list[tuple[int, int]]] = [[] for _ in self.length]
        for (token, sequence), state in zip(whole, automaton.ends, strict=True):
            here[state].append((len(sequence), token))
        for x in here:
            x.sort(reverse=True)
        # all tokens on the suffix path of a state, long ones first
        self.ending: list[tuple[tuple[int, int], ...]] = [()] * len(here)
        for state in sorted(range(1, len(here)), key=self.length.__getitem__):
            self.ending[state] = (*here[state], *self.ending[self.link[state]])
        self._pairs: dict[int, bool] = {}
        self._table = PieceTable(self._encode_pieces)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the symbols of ``a`` followed by those of ``b`` are encoded as ``a, b``.

        The two tokens are taken apart again, latest merge first. At each stage
        the symbols that meet at the border may not have been merged before
        either of them went into its own token; of equal merges the left one
        comes first.
        """
        rank, merged, size = self.rank, self.merged, self.size
        before_left = before_right = len(rank)
        while True:
            r = merged.get(a * size + b)
            if r is not None and r < before_left and r <= before_right:
                return False
            if rank[a] > rank[b]:
                before_left, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                before_right, b = rank[b], self.left[b]
            else:
                return True

    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of words in UTF-8, already lower case; fastest when sorted.

        The table of a word holds, for every prefix, its last token and where
        that token begins. Two neighbours with a common beginning share that
        part of the table, so it is filled only from where they differ.
        """
        go, link, length, ending, size = self.go, self.link, self.length, self.ending, self.size
        inner, final, pairs = self.inner, self.final, self._pairs
        last: list[int] = []
        begins: list[int] = []
        states: list[int] = []
        matches: list[int] = []
        out, before = [], b""
        for word in words:
            end = len(word) - 1
            same, most = 0, min(end, len(before) - 1)
            while same < most and word[same] == before[same]:
                same += 1
            before = word
            del last[same:], begins[same:], states[same:], matches[same:]
            state, matched = (states[-1], matches[-1]) if same else (0, 0)
            for i in range(same, end + 1):
                symbol = inner[word[i]] if i < end else final[word[i]]
                while (to := go.get(state * size + symbol)) is None:
                    state = link[state]
                    matched = length[state]
                state, matched = to, matched + 1
                for n, token in ending[state]:
                    if n > i:
                        if n <= matched:
                            break
                    elif n <= matched:
                        key = last[i - n] * size + token
                        fits = pairs.get(key)
                        if fits is None:
                            fits = pairs[key] = self.compatible(last[i - n], token)
                        if fits:
                            break
                last.append(token)
                begins.append(i - n)
                states.append(state)
                matches.append(matched)
            ids, i = [], end
            while i >= 0:
                ids.append(last[i])
                i = begins[i]
            out.append(tuple(ids[::-1]))
        return out

    def split(self, text: str) -> list[str]:
        """The words of a text, lower case, and its special tokens as they are."""
        out: list[str] = []
        for part in self._split.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(part)
            elif part.isascii():
                out.extend(self._plain_words.findall(part.lower()))
            else:
                out.extend(w for w, _ in self._words.pre_tokenize_str(self._normalizer.normalize_str(part)))
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        out: list[int] = []
        for word in self.split(text):
            out.extend([self.special[word]] if word in self.special else self.encode_words([word.encode()])[0])
        return out

    def _encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of different pieces that each hold whole words."""
        if len(self._pairs) > MOST_PAIRS:
            self._pairs.clear()
        simple, mixed = {}, []
        for piece in pieces:
            if piece.isalpha():  # ASCII letters only: one word
                simple[piece] = piece
            elif _one_word(text := piece.decode()):
                simple[piece] = text.lower().encode()
            else:
                mixed.append(piece)
        split = {piece: self.split(piece.decode()) for piece in mixed}
        words = set(simple.values())
        words.update(w.encode() for ws in split.values() for w in ws if w not in self.special)
        order = sorted(words)
        known = dict(zip(order, self.encode_words(order), strict=True))
        out = {piece: known[word] for piece, word in simple.items()}
        for piece, ws in split.items():
            out[piece] = tuple(i for w in ws for i in ((self.special[w],) if w in self.special else known[w.encode()]))
        return [out[piece] for piece in pieces]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after the other, and where each text's ids begin.

        Texts are cut into pieces where a word surely ends: at blanks and between
        ASCII letters, digits and signs. Each different piece is encoded once.
        """
        data, at = utf8(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        kind = _KIND[data]
        if b"<|" in data.tobytes():  # special tokens mix letters and signs
            kind[kind != 4] = 0
        else:
            data = _LOWER[data]
        blank = kind == 4
        edge = np.ones(len(data) + 1, bool)
        a, b = kind[:-1], kind[1:]
        edge[1:-1] = ((a != b) & (a > 0) & (b > 0)) | (blank[:-1] != blank[1:]) | ((a == 2) & (b == 2))
        edge[at] = True
        begin = np.flatnonzero(edge)
        begin, end = begin[:-1], begin[1:]
        full = ~blank[begin]
        begin, end = begin[full], end[full]
        ids, total = self._table.numbers(data, begin, end)
        return ids, total[np.searchsorted(begin, at)]


def _one_word(text: str) -> bool:
    """Whether the text is surely one word of letters, lower-cased as a whole.

    A sigma has no final form in the library; letters that Python does not know
    yet go the longer way.
    """
    return text.isalpha() and "Σ" not in text and unicodedata.is_normalized("NFC", text) and text.lower().isalpha()


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for the letters from 256 on.
    """
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(x) if x in plain else chr(next(rest)) for x in range(256)]


def codec_of(model_json: str) -> Codec:
    """The codec of a model, built once in a worker while its tasks use no other."""
    return held(("bpe", hash(model_json)), lambda: Codec(model_json))


def token_names(model_json: str) -> list[str]:
    """The vocabulary by id, special tokens included."""
    spec = json.loads(model_json)
    names = {i: s for s, i in spec["model"]["vocab"].items()} | {x["id"]: x["content"] for x in spec["added_tokens"]}
    if spec["decoder"] is not None:
        raise ValueError("the model must have no decoder")
    return [names.get(i, "") for i in range(max(names) + 1)]


def decode_ids(names: list[str], ids: list[int]) -> str:
    """Names of the tokens with a blank between them."""
    return " ".join([names[i] for i in ids])


def broadcast_model(spark: SparkSession, model_path: str):
    ship_code(spark)
    with open(model_path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit) of every row.

    With ``decoded`` also that column: the ids of each row decoded again, by the
    same worker, as :func:`decode_documents` would.

    Whole texts are encoded as the ``tokenizers`` library does with
    ``add_special_tokens=False``. A null or empty text has no ids; rows with
    null or repeated ids are rows like any other; other columns are not read.
    """
    model = broadcast_model(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model.value)
        for batch in slices(batches, size=ENCODE_BYTES):
            all_ids, at = codec.encode_column(batch.column("text"))
            raw = all_ids.astype("<u4", copy=False).tobytes()
            ids = [raw[4 * x : 4 * y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [batch.column("id"), pa.array(np.diff(at), pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([decode_ids(codec.names, np.frombuffer(x, "<u4").tolist()) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["id"].dataType
    schema = T.StructType().add("id", kind).add("n_tokens", "long").add("ids", "binary")
    if decoded:
        schema = schema.add("decoded", "string")
    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text that the library's ``decode`` gives for the ids.

    Special tokens are kept. Null ids give a null text; a column named
    ``decoded`` is replaced.
    """
    model = broadcast_model(encoded.sparkSession, model_path)
    kept = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(model.value)
        for batch in slices(batches, ids_col, ENCODE_BYTES):
            raw = batch.column(ids_col).to_pylist()
            texts = [None if x is None else decode_ids(names, np.frombuffer(x, "<u4").tolist()) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(texts, pa.string())], [*kept, "decoded"])

    plain = encoded.select(*kept)
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("decoded", T.StringType())]))
