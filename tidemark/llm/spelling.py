"""Spelling variants: words one letter apart, found with a two-way search scheme.

The vocabulary is a text of words between delimiters. A word with one error
matches another exactly in one of its two halves. So each word is searched twice:
its first half is matched exactly and the search goes on to the right across the
second, allowing one error; its second half is matched exactly and the search
goes on to the left across the first. Both searches narrow intervals of suffix
ranks in an FM-index, one of the text and one of its reverse, which together
make the index bidirectional; as each search of the scheme extends in one
direction only, it reads one of the two.

The index is built in pieces: words are dealt by the half that must match, so a
search finds all its answers in one piece, and a half that very many words share
is cut into tiles of words asked and words searched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import ship_code, stored
from tidemark.operators.joins import lookup_join

# Fixed values of the rule: what a word is, and which of its occurrences lose a letter.
RUN = "[A-Za-zÀ-ÿ]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ERROR_EVERY = 199

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A form is this many times as frequent as the word.
FORM_RATIO = 5
#: Letters that a piece of the index is meant to hold; a half shared by more is cut into tiles of at most this.
PIECE_LETTERS = 400_000
#: Intervals up to this size are read row by row, larger ones letter by letter.
SMALL_INTERVAL = 32

_EDGE, _END = ord("$"), 0


# -- counting ----------------------------------------------------------------


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", error_every: int = ERROR_EVERY) -> DataFrame:
    """``word`` and ``n`` of all words of ``LEAST_LETTERS`` or more that occur ``LEAST_COUNT`` times or more.

    A run of letters is lower-cased in A-Z. Where ``error_every`` divides the
    CRC-32 of ``<id>:<run>`` the occurrence loses the letter at that number
    modulo the length; with a null id none does.
    """
    found = F.regexp_extract_all(F.col(text_col), F.lit(f"({RUN})"), 1)
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(found).alias("run"))
    lower = runs.where(F.length("run") >= LEAST_LETTERS).select("id", F.translate("run", CAPITALS, SMALL).alias("run"))
    marked = lower.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = F.pmod(F.col("h"), F.length("run").cast("long")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.col("h") % error_every == 0, shorter).otherwise(F.col("run"))
    words = marked.select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


# -- the index ---------------------------------------------------------------


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of some bytes in their order; a suffix that is a prefix of another comes first."""
    n = len(text)
    padded = np.concatenate((text.astype(np.uint64), np.zeros(8, np.uint64)))
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    known = 8
    while True:
        order = np.argsort(key, kind="stable")
        step = np.ones(n, np.int64)
        step[0] = 0
        step[1:] = key[order[1:]] != key[order[:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: max(n - known, 0)] = rank[known:] + 1
        key = (rank * (n + 1) + after).astype(np.uint64)
        known *= 2


class WordIndex:
    """FM-index of different words (Latin-1 bytes); searches read a pattern from left to right.

    An interval ``[lo, hi)`` of suffix ranks stands for the places of what was
    read so far; reading one more letter takes two binary searches.
    """

    def __init__(self, words: list[bytes]):
        edge = bytes([_EDGE])
        text = edge + b"".join(w[::-1] + edge for w in words) + bytes([_END])
        data = np.frombuffer(text, np.uint8)
        self.suffixes = suffix_array(data)
        self.before = data[self.suffixes - 1]
        order = np.argsort(self.before, kind="stable")
        self.n = len(data)
        self.keys = self.before[order].astype(np.int64) * self.n + order
        self.rank_of_longer = np.empty(self.n, np.int64)
        self.rank_of_longer[order] = np.arange(self.n)
        self.edges = np.flatnonzero(data == _EDGE)
        self.letters = [c for c in np.unique(data).tolist() if c not in (_EDGE, _END)]

    def read(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one more letter; empty ones where it does not follow."""
        base = np.asarray(letter, np.int64) * self.n
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def children(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """All letters that may follow: number of the interval, letter, and the interval after it."""
        size = hi - lo
        small = np.flatnonzero((size > 0) & (size <= SMALL_INTERVAL))
        each = size[small]
        which = np.repeat(small, each)
        rows = np.repeat(lo[small] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        letter, longer = self.before[rows].astype(np.int64), self.rank_of_longer[rows]
        keep = (letter != _EDGE) & (letter != _END)
        which, letter, longer = which[keep], letter[keep], longer[keep]
        order = np.argsort(which * 256 + letter, kind="stable")
        which, letter, longer = which[order], letter[order], longer[order]
        first = np.ones(len(which), bool)
        first[1:] = (which[1:] != which[:-1]) | (letter[1:] != letter[:-1])
        head = np.flatnonzero(first)
        count = np.diff(np.append(head, len(which)))
        out = [(which[head], letter[head], longer[head], longer[head] + count)]
        large = np.flatnonzero(size > SMALL_INTERVAL)
        if len(large):
            for c in self.letters:
                a, b = self.read(lo[large], hi[large], c)
                found = np.flatnonzero(b > a)
                out.append((large[found], np.full(len(found), c), a[found], b[found]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def word_at(self, rank: np.ndarray) -> np.ndarray:
        """Numbers of the words whose opening edge a whole match ended at."""
        return np.searchsorted(self.edges, self.suffixes[rank])


def one_error(index: WordIndex, asked: list[bytes], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a pattern asked and a word of the index one error apart, the first ``half`` letters alike.

    Each pair comes once: a letter may be left out only where a run of it begins,
    and put in only in front of another one.
    """
    sizes = np.array([len(w) for w in asked], np.int64)
    half = np.array(halves, np.int64)
    flat = np.frombuffer(b"".join(asked), np.uint8)
    start = np.cumsum(sizes) - sizes

    def letter_at(which: np.ndarray, place: int) -> np.ndarray:
        return flat[start[which] + place].astype(np.int64)

    live = np.arange(len(asked))
    lo, hi = index.read(np.zeros(len(asked), np.int64), np.full(len(asked), index.n, np.int64), _EDGE)
    waiting: list[tuple] = []  # with one error: pattern, interval; all have read the same number of letters
    found_pattern, found_word = [], []

    def joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not parts:
            none = np.zeros(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    for place in range(int(sizes.max(initial=0)) + 1):
        following: list[tuple] = []
        open_ = np.flatnonzero(half[live] <= place)
        if len(open_):
            who = live[open_]
            which, letter, a, b = index.children(lo[open_], hi[open_])
            owner = who[which]
            within = place < sizes[owner]
            own = np.full(len(owner), -1, np.int64)
            own[within] = letter_at(owner[within], place)
            other = letter != own
            waiting.append((owner[other], a[other], b[other]))  # one letter more than the pattern
            other &= within
            following.append((owner[other], a[other], b[other]))  # another letter in its place
            rest = open_[place < sizes[who]]
            who = live[rest]
            if place:
                fresh = (place == half[who]) | (letter_at(who, place) != letter_at(who, place - 1))
                rest, who = rest[fresh], who[fresh]
            following.append((who, lo[rest], hi[rest]))  # one letter less
        who, a, b = joined(waiting)
        done = sizes[who] == place
        if done.any():
            first, last = index.read(a[done], b[done], _EDGE)
            hit = last > first
            found_pattern.append(who[done][hit])
            found_word.append(index.word_at(first[hit]))
        who, a, b = who[~done], a[~done], b[~done]
        a, b = index.read(a, b, letter_at(who, place))
        alive = b > a
        following.append((who[alive], a[alive], b[alive]))
        waiting = following
        on = np.flatnonzero(sizes[live] > place)
        live = live[on]
        lo, hi = index.read(lo[on], hi[on], letter_at(live, place))
        alive = hi > lo
        live, lo, hi = live[alive], lo[alive], hi[alive]
    none = [np.zeros(0, np.int64)]
    return np.concatenate(found_pattern or none), np.concatenate(found_word or none)


# -- near words --------------------------------------------------------------

_FOUND = "word string, n_near long, near_n long, near string"


def _answers(group: pa.Table) -> pa.Table:
    """Of the words asked in one piece: how many near ones it holds, and the most frequent of them."""
    names = [w.encode("latin-1") for w in group.column("word").to_pylist()]
    sides, asks = group.column("side").to_pylist(), group.column("asks").to_pylist()
    counts = group.column("n").to_pylist()
    out: list[tuple] = []
    for side in (0, 1):
        held: dict[bytes, int] = {}
        asked: set[bytes] = set()
        for name, s, ask, n in zip(names, sides, asks, counts, strict=True):
            if s == side:
                if ask & 1:
                    asked.add(name)
                if ask & 2:
                    held[name] = n
        if not asked or not held:
            continue
        words, patterns = sorted(held), sorted(asked)
        turn = (lambda w: w[::-1]) if side else (lambda w: w)
        index = WordIndex([turn(w) for w in words])
        halves = [len(p) - len(p) // 2 if side else len(p) // 2 for p in patterns]
        who, which = one_error(index, [turn(p) for p in patterns], halves)
        if side:
            # found by the first search already if the first halves are alike too
            new = [words[w][: len(patterns[p]) // 2] != patterns[p][: len(patterns[p]) // 2] for p, w in zip(who.tolist(), which.tolist(), strict=True)]
            who, which = who[np.array(new, bool)], which[np.array(new, bool)]
        n = np.array([held[w] for w in words], np.int64)
        order = np.lexsort((which, -n[which], who))
        who, which = who[order], which[order]
        head = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else np.zeros(0, np.int64)
        total = np.diff(np.append(head, len(who)))
        for p, w, k in zip(who[head].tolist(), which[head].tolist(), total.tolist(), strict=True):
            out.append((patterns[p].decode("latin-1"), k, int(n[w]), words[w].decode("latin-1")))
    columns = list(zip(*out, strict=True)) if out else [[], [], [], []]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["word", "n_near", "near_n", "near"])


def _dealt(vocabulary: DataFrame, piece_letters: int) -> DataFrame:
    """Words dealt to pieces: ``piece, side, word, n`` and ``asks`` (1: is searched for, 2: can be found).

    A word of ``m`` letters asks under its first ``m // 2`` and its other letters.
    It can be found under the halves that words of ``m - 1`` to ``m + 1`` letters ask for.
    """
    m = F.length("word")
    half = [F.floor((m + d) / 2).cast("int") for d in (-1, 0, 1)]
    upper = [F.ceil((m + d) / 2).cast("int") for d in (-1, 0, 1)]

    def keys(side: int, sizes: list, own) -> list:
        text = (lambda k: F.substring(F.col("word"), F.lit(1), k)) if side == 0 else (lambda k: F.substring(F.col("word"), m - k + 1, k))
        return [F.struct(F.lit(side).alias("side"), F.when(k == own, 3).otherwise(2).alias("asks"), text(k).alias("half")) for k in sizes]

    # of three neighbouring lengths two have the same half
    own, own_upper = half[1], upper[1]
    places = F.array_distinct(F.array(*keys(0, half, own), *keys(1, upper, own_upper)))
    routed = vocabulary.withColumn("place", F.explode(places)).select("word", "n", "place.*")
    size = F.length("word") + 1
    loads = routed.groupBy("side", "half").agg(F.sum(size).alias("load"))
    total = vocabulary.agg(F.sum(4 * size)).first()[0] or 0
    pieces = max(1, -(-2 * int(total) // piece_letters))
    hot = loads.where(F.col("load") > piece_letters // 2).select("side", "half", F.ceil(F.col("load") * 2 / piece_letters).cast("int").alias("cuts"))
    placed = lookup_join(routed, hot, ["side", "half"], "left")
    plain = placed.where("cuts is null").select(
        F.concat(F.lit("p"), F.pmod(F.xxhash64("side", "half"), F.lit(pieces)).cast("string")).alias("piece"), "side", "word", "n", "asks"
    )
    tiled = placed.where("cuts is not null").withColumn("mine", F.pmod(F.xxhash64("word"), F.col("cuts")).cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    name = F.concat_ws("-", F.lit("t"), F.col("side").cast("string"), F.md5("half"), "held", "asked")
    found = tiled.select("*", F.col("mine").alias("held"), each.alias("asked")).withColumn("asks", F.lit(2))
    asking = tiled.where("asks = 3").select("*", each.alias("held"), F.col("mine").alias("asked")).withColumn("asks", F.lit(1))
    return plain.unionByName(found.unionByName(asking).select(name.alias("piece"), "side", "word", "n", "asks"))


def near_words(vocabulary: DataFrame, piece_letters: int = PIECE_LETTERS) -> DataFrame:
    """``word``, ``n_near``, and ``near`` and ``near_n``: the most frequent near word, of equals the first.

    ``vocabulary`` has different words of two letters or more up to U+00FF, and their counts ``n``.
    A task holds one piece of the index, whose size is bounded whatever the vocabulary.
    """
    ship_code(vocabulary.sparkSession)
    parts = _dealt(vocabulary, piece_letters).groupBy("piece").applyInArrow(_answers, _FOUND)
    best = F.min(F.struct((-F.col("near_n")).alias("least"), "near"))
    whole = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return whole.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.least")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of words that have a form: the last word that forms lead to.

    Each pass doubles the way; counts grow along it, so it ends.
    """
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = stored(links.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, error_every: int = ERROR_EVERY, piece_letters: int = PIECE_LETTERS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of the words of all texts.

    Words are those of :func:`count_words`. Two are near if one inserted, deleted
    or replaced letter turns one into the other. ``form`` is the near word of
    largest count (of equals the first in code-point order) if that is at least
    ``FORM_RATIO`` times the word's own, else null; ``root`` is where forms lead.
    A null or empty text has no words; repeated rows count as often as they
    stand there; a very long run is a word like any other; an empty table, or
    one without frequent words, gives no rows. Other columns are not read.
    """
    vocabulary = stored(count_words(docs, id_col, text_col, error_every), "vocabulary")
    near = near_words(vocabulary, piece_letters)
    holds = F.col("near_n") >= FORM_RATIO * F.col("n")
    judged = vocabulary.join(near, "word", "left").select(
        "word",
        F.when(holds, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(holds, F.col("near_n")).alias("form_n"),
    )
    judged = stored(judged, "near-words")
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
