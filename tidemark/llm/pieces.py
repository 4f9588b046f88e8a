"""SentencePiece BPE encoding and decoding by a table over prefixes.

The model knows pieces, each with a score. Any two neighbouring pieces whose
texts together are a piece may be merged; of all such pairs the one with the best
score goes first, of equal ones the leftmost. Two tokens stand side by side in
an encoding exactly if encoding their two texts together gives these two tokens
again, for what happens inside a token does not depend on what is around it until
something merges across its edge. So every prefix of a text has one last token:
the tokens that end there are on the suffix path of a suffix automaton of the
pieces, and the one compatible with the last token before it is stored. The ids
are read back from the end. Letters without a piece become their bytes.

A text is cut where no piece can reach across, so that words are encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import SuffixAutomaton
from tidemark.llm.memo import PieceTable
from tidemark.llm.runtime import held, ship_code
from tidemark.llm.textbatch import slices, utf8

#: Bytes of text encoded at a time; a longer text is taken alone.
ENCODE_BYTES = 2 << 20
#: Pairs of tokens whose verdict a worker remembers.
MOST_PAIRS = 500_000

# The sign for a blank, and the kinds of pieces in a model file.
BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def read_model(model_path: str) -> list[tuple[str, float, int]]:
    """Text, score and kind of every piece by id; refuses models of another make."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_path, "rb") as file:
        model.ParseFromString(file.read())
    rules, trained = model.normalizer_spec, model.trainer_spec
    kinds = {p.type for p in model.pieces}
    plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
    if trained.model_type != trained.BPE or trained.treat_whitespace_as_suffix or not plain or kinds != {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError("the model must be BPE with byte pieces, no normalization and a blank put in front")
    return [(p.piece, p.score, p.type) for p in model.pieces]


class PieceCodec:
    """Encoder and decoder of one model, given as :func:`read_model` returns it."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.kinds = [kind for _, _, kind in pieces]
        byte_ids = {int(text[3:5], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        if len(byte_ids) != 256:
            raise ValueError("the model must have a piece for every byte")
        self.byte_ids = [byte_ids[b] for b in range(256)]
        self.surface = [self._surface(i, *p, byte_ids) for i, p in enumerate(pieces)]
        self.prefixed = [kind == NORMAL and text.startswith(BLANK) for text, _, kind in pieces]

        # Tokens: the pieces by id, then letters that only occur inside longer pieces.
        letters = sorted({c for text in self.ids for c in text})
        self.names = [text for text, _, _ in pieces] + [c for c in letters if c not in self.ids]
        self.token = self.ids | {text: i for i, text in enumerate(self.names) if i >= len(pieces)}
        self.emitted = [(i,) for i in range(len(pieces))] + [self._bytes_of(text) for text in self.names[len(pieces) :]]
        place = {s: r for r, s in enumerate(sorted({s for _, s, k in pieces if k == NORMAL}, reverse=True))}
        self.merged = {text: place[pieces[i][1]] for text, i in self.ids.items() if len(text) > 1}
        self._take_apart()

        self.letter = {c: n for n, c in enumerate(letters)}
        width = len(letters)
        usable = [(len(text), t, tuple(self.letter[c] for c in text)) for text, t in self.token.items() if self.left[t] is not None or len(text) == 1]
        automaton = SuffixAutomaton([symbols for _, _, symbols in usable], width)
        self.width, self.go, self.link, self.length = width, automaton.go, automaton.link, automaton.length
        #: tokens on the suffix path of a state, long ones first
        self.ending: list[list[tuple[int, int]]] = [[] for _ in self.length]
        for (size, t, _), state in zip(usable, automaton.ends, strict=True):
            self.ending[state].append((size, t))
        for found in self.ending:
            found.sort(reverse=True)
        for state in sorted(range(1, len(self.ending)), key=self.length.__getitem__):
            self.ending[state] += self.ending[self.link[state]]

        self.reaches = self._reaches()
        self._pairs: dict[int, bool] = {}
        self._table = PieceTable(self._encode_parts)

    def _surface(self, i: int, text: str, score: float, kind: int, byte_ids: dict) -> bytes:
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return {NORMAL: text.replace(BLANK, " "), UNKNOWN: " ⁇ ", CONTROL: ""}[kind].encode()

    def _bytes_of(self, text: str) -> tuple[int, ...]:
        return tuple(self.byte_ids[b] for b in text.encode())

    # -- merging -----------------------------------------------------------

    def merge(self, parts: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """``parts`` after all merges, and the two parts of the last one. For short texts only."""
        last = None
        while True:
            best = at = None
            for i in range(len(parts) - 1):
                rank = self.merged.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts, last
            last = (parts[at], parts[at + 1])
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2 :]]

    def _take_apart(self) -> None:
        """For each piece its two parts at the last merge, None if its text is not encoded as the piece.

        ``steady`` pieces merge in the order of their scores; of the others, as are
        some runs of blanks, the scores alone do not tell when they came about.
        """
        n = len(self.names)
        self.left: list[int | None] = [None] * n
        self.right: list[int | None] = [None] * n
        self.rank = [-1] * n
        self.steady = [True] * n
        for text in sorted(self.merged, key=len):
            parts, last = self.merge(list(text))
            if len(parts) == 1:
                t, a, b = self.token[text], self.token[last[0]], self.token[last[1]]
                self.left[t], self.right[t], self.rank[t] = a, b, self.merged[text]
                self.steady[t] = self.steady[a] and self.steady[b] and max(self.rank[a], self.rank[b]) <= self.rank[t]
        size = self.size = n
        self.joined: dict[int, int] = {}
        for text, rank in self.merged.items():
            for cut in range(1, len(text)):
                a, b = self.token.get(text[:cut]), self.token.get(text[cut:])
                if a is not None and b is not None:
                    self.joined[a * size + b] = rank

    def compatible(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` followed by that of ``b`` is encoded as these two tokens.

        The two are taken apart again, what was merged last first. At each stage
        the parts at the border must not have been merged with each other before
        one of them went into its own token; equals go from left to right.
        """
        if not (self.steady[a] and self.steady[b]):
            parts, _ = self.merge(list(self.names[a] + self.names[b]))
            return parts == [self.names[a], self.names[b]]
        rank, joined, size = self.rank, self.joined, self.size
        left_gone = right_gone = 1 << 60
        while True:
            r = joined.get(a * size + b)
            if r is not None and r < left_gone and r <= right_gone:
                return False
            if rank[a] > rank[b]:
                left_gone, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                right_gone, b = rank[b], self.left[b]
            else:
                return True

    # -- encoding ----------------------------------------------------------

    def _reaches(self) -> np.ndarray:
        """For two neighbouring bytes (256 * first + second) whether a piece may hold both.

        Blanks stand for themselves. Longer letters are not told apart, but a
        text is cut before a blank if no piece has one after such a letter.
        """
        reach = np.ones((256, 256), bool)
        pairs = {text[i : i + 2].replace(BLANK, " ") for text in self.ids for i in range(len(text) - 1)}
        reach[:128, :128] = False
        for x, y in pairs:
            if x.isascii() and y.isascii():
                reach[ord(x), ord(y)] = True
        reach[128:, 32] = any(y == " " and not x.isascii() for x, y in pairs)
        return reach.ravel()

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        """Ids of texts made of known letters, blanks as ``BLANK``; fastest when sorted.

        The table of a text holds for every prefix its last token and where that
        token begins; neighbours share it as far as they begin alike.
        """
        go, link, length, ending = self.go, self.link, self.length, self.ending
        letter, width, size, pairs = self.letter, self.width, self.size, self._pairs
        emitted, pieces = self.emitted, len(self.kinds)
        if len(pairs) > MOST_PAIRS:
            pairs.clear()
        token: list[int] = []
        begin: list[int] = []
        path: list[tuple[int, int]] = []
        out, before = [], ""
        for run in runs:
            same, most = 0, min(len(run), len(before))
            while same < most and run[same] == before[same]:
                same += 1
            before = run
            del token[same:], begin[same:], path[same:]
            state, matched = path[-1] if path else (0, 0)
            for i in range(same, len(run)):
                symbol = letter[run[i]]
                while (to := go.get(state * width + symbol)) is None:
                    state = link[state]
                    matched = length[state]
                state, matched = to, matched + 1
                path.append((state, matched))
                for n, t in ending[state]:
                    if n > i:
                        if n <= matched:
                            break
                    elif n <= matched:
                        key = token[i - n] * size + t
                        fits = pairs.get(key)
                        if fits is None:
                            fits = pairs[key] = self.compatible(token[i - n], t)
                        if fits:
                            break
                token.append(t)
                begin.append(i - n)
            ids, i, spelled = [], len(run) - 1, False
            while i >= 0:
                t = token[i]
                ids.append(t)
                spelled = spelled or t >= pieces
                i = begin[i]
            ids.reverse()
            out.append([x for t in ids for x in emitted[t]] if spelled else ids)
        return out

    def _encode_parts(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of pieces of text that no token reaches beyond."""
        known = self.letter.keys()
        texts = [p.decode().replace(" ", BLANK) for p in parts]
        odd = [text for text in texts if not known >= set(text)]
        if not odd:
            return self.encode_runs(texts)
        cut = {text: _spans(text, known) for text in odd}
        runs = sorted({s for spans in cut.values() for s, ok in spans if ok} | (set(texts) - cut.keys()))
        found = dict(zip(runs, self.encode_runs(runs), strict=True))
        for text, spans in cut.items():
            found[text] = [i for s, ok in spans for i in (found[s] if ok else self._bytes_of(s))]
        return [found[text] for text in texts]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column in a row, and where each text's ids begin (one more at the end)."""
        column = pc.fill_null(column, "")
        if pc.any(pc.match_substring(column, BLANK)).as_py():
            column = pc.replace_substring(column, BLANK, " ")
        full = pc.not_equal(column, "")
        column = pc.if_else(full, pc.binary_join_element_wise(pa.scalar(" "), column, pa.scalar("")), column)
        data, at = utf8(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        edge = np.ones(len(data) + 1, bool)
        edge[1:-1] = ~self.reaches[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        edge[at] = True
        begin = np.flatnonzero(edge)
        ids, total = self._table.numbers(data, begin[:-1], begin[1:])
        return ids, total[np.searchsorted(begin, at)]

    # -- decoding ----------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """The text of some ids: the first blank goes, bytes that are no text become U+FFFD each."""
        out: list[str] = []
        held = bytearray()
        at_start = True
        for i in ids:
            if self.kinds[i] == BYTE:
                held += self.surface[i]
                continue
            if held:
                out.append(_text_of(held))
                held, at_start = bytearray(), False
            text = self.surface[i].decode()
            if at_start and self.prefixed[i]:
                text, at_start = text[1:], False
            out.append(text)
            at_start = at_start and not text
        return "".join(out) + _text_of(held)

    def decode_column(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """The texts of many lists of ids, given in a row with where each begins."""
        if not hasattr(self, "_bytes"):
            self._sizes = np.array([len(s) for s in self.surface], np.int64)
            self._bytes = np.frombuffer(b"".join(self.surface), np.uint8)
            self._places = np.cumsum(self._sizes) - self._sizes
            self._simple = np.isin(self.kinds, (NORMAL, BYTE))
            self._blank_first = np.array(self.prefixed)
        full = at[:-1] < at[1:]
        if self._simple[ids].all() and self._blank_first[ids[at[:-1][full]]].all():
            sizes, places = self._sizes[ids], self._places[ids]
            first = at[:-1][full]
            sizes[first] -= 1
            places[first] += 1
            total = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(sizes, out=total[1:])
            source = np.repeat(places - total[:-1], sizes)
            source += np.arange(total[-1])
            offsets = total[at]
            if offsets[-1] < 1 << 31:
                buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(self._bytes[source].tobytes())]
                texts = pa.StringArray.from_buffers(len(at) - 1, buffers[1], buffers[2])
                try:
                    texts.validate(full=True)
                    return texts
                except pa.ArrowInvalid:
                    pass
        return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.string())


def _spans(text: str, known) -> list[tuple[str, bool]]:
    """``text`` cut into runs of known letters (True) and single others (False)."""
    out: list[tuple[str, bool]] = []
    begin = 0
    for i, c in enumerate(text):
        if c not in known:
            out += [(text[begin:i], True)] * (i > begin) + [(c, False)]
            begin = i + 1
    return out + [(text[begin:], True)] * (begin < len(text))


def _text_of(raw: bytearray) -> str:
    out, i = [], 0
    while i < len(raw):
        size = 1 if raw[i] < 0x80 else 2 if raw[i] < 0xE0 else 3 if raw[i] < 0xF0 else 4
        try:
            out.append(bytes(raw[i : i + size]).decode())
            i += size
        except UnicodeDecodeError:
            out.append("�")
            i += 1
    return "".join(out)


def _codec(broadcast) -> PieceCodec:
    """The codec of a broadcast model, built once in a worker while its tasks use no other."""
    pieces = broadcast.value
    return held(("pieces", hash(tuple(pieces))), lambda: PieceCodec(pieces))


def _broadcast(spark: SparkSession, model_path: str):
    """The model's pieces on all workers; their size is that of the vocabulary, whatever the corpus."""
    ship_code(spark)
    return spark.sparkContext.broadcast(read_model(model_path))


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens`` and ``ids`` (array of integers) of every row.

    With ``decoded`` also that column: the ids of each row decoded again by the
    same worker, as :func:`decode_pieces` would.

    Whole texts are encoded as the ``sentencepiece`` library does without begin
    and end ids and without sampling. A null or empty text has no ids. Rows with
    null or repeated ids are rows like any other; an empty table gives an empty
    one; other columns are not read.
    """
    model = _broadcast(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in slices(batches, size=ENCODE_BYTES):
            ids, at = codec.encode_column(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32)))
            columns = [batch.column("id"), pa.array(np.diff(at), pa.int64()), lists]
            if decoded:
                columns.append(codec.decode_column(ids, at))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType().add("id", plain.schema["id"].dataType).add("n_tokens", "long").add("ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", "string")
    return plain.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text that the library's ``decode`` gives for the ids.

    Null ids give a null text; an id that is null or not in the model stops the
    job. A column named ``decoded`` is replaced.
    """
    model = _broadcast(encoded.sparkSession, model_path)
    kept = [c for c in encoded.columns if c != "decoded"]
    plain = encoded.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            column = batch.column(ids_col)
            sizes = np.asarray(column.value_lengths().fill_null(0))
            at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            texts = codec.decode_column(np.asarray(column.flatten(), np.int64), at)
            shown = pc.if_else(column.is_null(), pa.scalar(None, pa.string()), texts)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [shown], [*kept, "decoded"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("decoded", T.StringType())]))
