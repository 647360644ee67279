"""SentencePiece BPE encoding by a merge-type prefix table, and decoding.

Because every merge yields a piece of the vocabulary with a fixed score, each prefix of a text has one
possible last piece: a piece that ends there and that may stand behind the last piece of the prefix in
front of it. Whether two pieces may stand side by side is found by taking back the merges next to their
border, once per pair. So a row of pieces of which all neighbours may stand side by side is the true one:
the longest pieces from the left on, with shorter ones where two do not fit. Where a letter has no piece,
the runs between such letters are read by a table of last pieces, filled from left to right, and the ids
are read off backwards. Both take time linear in the text.

No piece has a space mark behind another letter, so texts fall apart in front of each run of spaces;
such words are encoded one by one, with a bounded cache per worker. Words with several space marks (their
pieces share one score, which the table needs to differ) are merged directly.

Cases: a NULL or empty text has no ids and decodes to an empty text. Letters without a piece become
byte pieces. A space mark in a text is a space. Repeated rows give repeated rows; an empty table gives an
empty result. ``encode_pieces`` puts its columns behind those given and replaces a column of their names.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from statlake.llm.blocks import Cache, text_blocks

SPACE = "▁"
CACHED_WORDS, CACHED_RUNS, CACHED_LETTERS = 400_000, 60_000, 48
CACHED_PAIRS = 300_000
WORD = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # types of pieces in a model file


class Entries(Cache):
    """A bounded cache that makes what it lacks; long keys are not kept."""

    def __init__(self, make: Callable, limit: int):
        super().__init__(limit)
        self.make = make

    def __missing__(self, key: str):
        value = self.make(key)
        if len(key) <= CACHED_LETTERS:
            self.room(1)
            self[key] = value
        return value


class PieceBpe:
    """A BPE with byte fallback, read from the bytes of a ``sentencepiece`` model file."""

    def __init__(self, model: bytes):
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        rules = spec.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix:
            raise ValueError("only models that keep texts as they are, with a leading space mark")
        self.pieces = [p.piece for p in spec.pieces]
        self.types = [p.type for p in spec.pieces]
        self.ids = {p.piece: i for i, p in enumerate(spec.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in spec.pieces if p.type == NORMAL}
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(spec.pieces) if p.type == BYTE}
        unknown = (spec.trainer_spec.unk_surface or " \u2047 ").encode()
        self.bytes_of = [
            {BYTE: lambda x: bytes([int(x[1:-1], 16)]), CONTROL: lambda _: b"", UNKNOWN: lambda _: unknown}
            .get(p.type, lambda x: x.replace(SPACE, " ").encode())(p.piece)
            for p in spec.pieces
        ]
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece has a space mark behind a letter")
        if not all(letter in self.ids for piece in self.ids for letter in piece) or "\n" in self.ids:
            raise ValueError("a letter of a piece is not a piece, or a line end is")
        self.neighbours = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.automaton = ahocorasick.Automaton()
        self.valid = {piece for piece in self.ids if self.merged(piece) == [piece]}
        for piece in self.valid:
            self.automaton.add_word(piece, (len(piece), self.ids[piece]))
        self.automaton.make_automaton()
        self.id_texts = [str(i) for i in range(len(self.pieces))]
        self.sizes = [len(piece) for piece in self.pieces]
        self.shorter = [self.next_shorter(piece) for piece in self.pieces]
        self.plain = self.learn_merges()
        self.pairs = Cache(CACHED_PAIRS)
        self.words = Entries(self.entry, CACHED_WORDS)
        self.runs = Entries(self.run_ids, CACHED_RUNS)

    def next_shorter(self, piece: str) -> int:
        """The longest piece that a piece begins with and is not, or -1."""
        fronts = (piece[:end] for end in range(len(piece) - 1, 0, -1))
        return next((self.ids[front] for front in fronts if front in self.valid), -1)

    def learn_merges(self) -> bool:
        """What each piece is merged from, and when; whether no piece is merged before its parts.

        Pieces with several space marks are left out: they share one score.
        """
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[int, int] = {}
        made = [p for p in self.valid if len(p) > 1 and not p.startswith(SPACE * 2)]
        made.sort(key=lambda p: -self.scores[p])
        self.turn = [-1] * len(self.pieces)
        for turn, piece in enumerate(made):
            self.turn[self.ids[piece]] = turn
        distinct = len({self.scores[p] for p in made}) == len(made)
        for piece in made:
            a, b = self.merged(piece, until=2)
            left, right, whole = self.ids[a], self.ids[b], self.ids[piece]
            self.parts[whole] = left, right
            self.joined[left << 20 | right] = turn = self.turn[whole]
            distinct &= self.turn[left] < turn > self.turn[right]
        return distinct

    def merged(self, text: str, until: int = 1) -> list[str]:
        """The pieces of a text by merging the best neighbours, the left ones first, down to ``until`` of them."""
        symbols = list(text)
        left_over = len(symbols)
        if len(symbols) < 2:
            return symbols
        following = list(range(1, len(symbols) + 1))
        leading = list(range(-1, len(symbols) - 1))
        queue = []

        def offer(left: int, right: int) -> None:
            both = symbols[left] + symbols[right]
            score = self.scores.get(both)
            if score is not None:
                heapq.heappush(queue, (-score, left, right, both))

        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        while queue and left_over > until:
            _, left, right, both = heapq.heappop(queue)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != both:
                continue
            symbols[left], symbols[right] = both, ""
            left_over -= 1
            after = following[left] = following[right]
            if after < len(symbols):
                leading[after] = left
                offer(left, after)
            if leading[left] >= 0:
                offer(leading[left], left)
        return [s for s in symbols if s]

    def fit(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are side by side."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.pieces[left], self.pieces[right]
            if self.plain and not (a + b).startswith(SPACE * 2):
                known = self.stay(left, right)
            else:
                known = a + b not in self.valid and self.merged(a + b) == [a, b]
            self.pairs.room(1)
            self.pairs[key] = known
        return known

    def stay(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two pieces: their merges next to it are taken back, the last
        one first, and what then stands side by side must not have had its turn before."""
        joined, turn, parts, limit = self.joined, self.turn, self.parts, len(self.pieces)
        while joined.get(left << 20 | right, limit) >= limit:
            if turn[left] > turn[right]:
                limit = turn[left]
                left = parts[left][1]
            elif turn[right] >= 0:
                limit = turn[right] + 1  # of equal merges the left one is first
                right = parts[right][0]
            else:
                return True
        return False

    def by_longest(self, word: str) -> list[int] | None:
        """The ids of a word by its longest pieces from the left on, shorter ones where two do not stay side by
        side. Pieces that all stay are the true ones, and a prefix has no other; None where a letter has no piece."""
        ids, at, before, pairs = [], 0, -1, self.pairs
        for end, (size, piece) in self.automaton.iter_long(word):
            if end + 1 - size != at:
                return None
            if before >= 0:
                known = pairs.get(before << 20 | piece)
                if not known and (known is not None or not self.fit(before, piece)):
                    return self.by_shorter(word, ids, at, piece)
            ids.append(piece)
            at, before = end + 1, piece
        return ids if at == len(word) else None

    def by_shorter(self, word: str, ids: list[int], at: int, piece: int) -> list[int] | None:
        """``by_longest`` from a piece on that does not stay behind those found. A place that nothing can follow is
        never reached again, so the time is linear in the word."""
        sizes, shorter, pairs, longest, dead = self.sizes, self.shorter, self.pairs, self.automaton.iter_long, set()
        while True:
            end = at + sizes[piece]
            fits = end not in dead
            if fits and ids:
                fits = pairs.get(ids[-1] << 20 | piece)
                if fits is None:
                    fits = self.fit(ids[-1], piece)
            if fits:
                ids.append(piece)
                at = end
                if at == len(word):
                    return ids
                last, (size, piece) = next(longest(word, at), (-1, (0, -1)))
                if last + 1 - size != at:
                    return None
                continue
            piece = shorter[piece]
            while piece < 0:
                dead.add(at)
                if not ids:
                    return None
                at -= sizes[ids[-1]]
                piece = shorter[ids.pop()]

    def by_table(self, run: str) -> list[int]:
        """The ids of a run of letters that are pieces, by its prefix table."""
        last: list[int] = [-1] * (len(run) + 1)
        pairs, fit = self.pairs, self.fit
        for end, (size, piece) in self.automaton.iter(run):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start == 0:
                last[end] = piece
            elif (before := last[start]) >= 0:
                known = pairs.get(before << 20 | piece)
                if known or known is None and fit(before, piece):
                    last[end] = piece
        ids, end = [], len(run)
        while end:
            piece = last[end]
            ids.append(piece)
            end -= len(self.pieces[piece])
        ids.reverse()
        return ids

    def run_ids(self, run: str) -> list[int]:
        """The ids of a run in which all neighbours stand together in some piece, or of one letter."""
        if len(run) == 1:
            piece = self.ids.get(run)
            return [piece] if piece is not None else [self.byte_ids[b] for b in run.encode()]
        if run.startswith(SPACE * 2):
            return [self.ids[piece] for piece in self.merged(run)]
        return self.by_table(run)

    def word_ids(self, word: str) -> list[int]:
        """The ids of a word. Where letters have no piece, no merge crosses two that stand together in none."""
        found = None if word.startswith(SPACE * 2) else self.by_longest(word)
        if found is not None:
            return found
        ids, start, neighbours = [], 0, self.neighbours
        for at in range(1, len(word)):
            if word[at - 1 : at + 1] not in neighbours:
                ids += self.runs[word[start:at]]
                start = at
        return ids + self.runs[word[start:]]

    def decoded(self, ids: list[int]) -> bytes:
        """What ids stand for in UTF-8; bytes that are not UTF-8 become U+FFFD, one for each."""
        raw, good = b"".join([self.bytes_of[i] for i in ids]), []
        while raw:
            try:
                raw.decode()
                break
            except UnicodeDecodeError as bad:
                good.append(raw[: bad.start] + "\ufffd".encode())
                raw = raw[bad.start + 1 :]
        return b"".join([*good, raw])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space mark that encoding puts in front."""
        text = self.decoded(ids).decode()
        shown = next((self.pieces[i] for i in ids if self.types[i] != CONTROL), "")
        return text[1:] if shown.startswith(SPACE) else text

    def entry(self, word: str) -> tuple[str, bytes]:
        """What a word adds to a text: its ids as text, and what they decode to."""
        texts = self.id_texts
        if not word.startswith(SPACE * 2):
            ids = self.by_longest(word)
            if ids is not None:
                return ",".join([texts[i] for i in ids]), word.replace(SPACE, " ").encode()
        ids = self.word_ids(word)
        return ",".join([texts[i] for i in ids]), self.decoded(ids)

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Of each text the number of ids, and the SHA-256 of its ids and of their decoded text."""
        sums = [[0, hashlib.sha256(), hashlib.sha256()] for _ in texts]
        entry = self.words.__getitem__
        plain = [(t or "").replace(SPACE, " ") for t in texts]
        for block in text_blocks(plain):
            for row, part in block:
                if not part:
                    continue
                total = sums[row]
                words = words_of(part, first=not total[0])
                found = list(map(entry, words))
                ids = ",".join([e[0] for e in found]).encode()
                decoded = b"".join([e[1] for e in found])
                if total[0]:
                    ids = b"," + ids
                    total[0] += ids.count(b",")
                else:
                    decoded = decoded[1:]
                    total[0] = ids.count(b",") + 1
                total[1].update(ids)
                total[2].update(decoded)
        return [(n, ids.hexdigest(), decoded.hexdigest()) for n, ids, decoded in sums]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text."""
        ids, first = [], True
        for block in text_blocks([(text or "").replace(SPACE, " ")]):
            for _, part in block:
                if part:
                    for word in words_of(part, first):
                        ids += self.word_ids(word)
                    first = False
        return ids


def words_of(part: str, first: bool) -> list[str]:
    """The words of a part of a text, each with its space marks in front; line ends stand alone.

    The first part of a text gets a space mark; every other begins with a space of its own.
    """
    if "  " not in part and not (first and part[0] == " "):
        marked = part.replace(" ", " " + SPACE).replace("\n", " \n ")
        return [word for word in (SPACE + marked if first else marked).split(" ") if word]
    marked = part.replace(" ", SPACE)
    return WORD.findall(SPACE + marked if first else marked)


@functools.lru_cache(maxsize=2)
def loaded(model: bytes) -> PieceBpe:
    return PieceBpe(model)


def encode_pieces(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of each text.

    ``model`` is the path of a model file that the driver can read; its bytes (half a megabyte whatever
    the table) go to the executors.
    """
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = loaded(shared.value)
        for batch in batches:
            yield pd.DataFrame(
                bpe.digests(batch.tolist()), columns=["n_tokens", "ids_sha256", "decoded_sha256"]
            )

    names = ("n_tokens", "ids_sha256", "decoded_sha256")
    made = docs.drop(*names).withColumn("_digests", digests(F.col(text)))
    return made.select(*(c for c in made.columns if c != "_digests"), "_digests.*")


def encoded_ids(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the ids of each text."""
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = loaded(shared.value)
        for batch in batches:
            yield pd.Series([bpe.encode(t) for t in batch.tolist()], dtype=object)

    return docs.withColumn("ids", ids(F.col(text)))


def decoded_texts(docs: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of each row's ids."""
    with open(model, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = loaded(shared.value)
        for batch in batches:
            yield batch.map(lambda x: bpe.decode(list(x) if x is not None else []))

    return docs.withColumn("decoded", decoded(F.col(ids)))
