"""SentencePiece encoding and decoding by unigram Viterbi over a double-array trie.

The pieces and their log scores come from a vocabulary file. A text gets a blank
in front, blanks become the marker U+2581, and the segmentation into pieces with
the highest total score is taken. A character that is no piece costs more than
any piece and becomes the byte pieces of its UTF-8 form. Decoding puts pieces and
bytes together, markers become blanks and the blank in front goes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkspan.llm.common import sent, texts

#: Where the vocabulary file is, unless the caller says so.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What an unknown character costs beyond the worst piece.
UNKNOWN_COST = 10.0
#: Largest vocabulary that is sent to the tasks.
MOST_PIECES = 1 << 20
#: Parts of texts whose pieces a task remembers.
REMEMBERED = 1 << 18
#: Parts of at most so many characters are worked out together, so many at a time.
SHORT, AT_ONCE = 32, 1 << 13


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    #: Pieces that text can become, and the byte pieces by byte.
    normal: list[int]
    byte_ids: list[int]

    @classmethod
    def read(cls, path: str, ranks: bool = True) -> Vocabulary:
        """The pieces of a SentencePiece file, as the library reports them.

        A file made by pair merging scores its pieces by merge rank. With ``ranks``
        the log score of the piece of rank r is that of Zipf's law, -ln(r H) with
        the harmonic number H; without, the scores of the file are log scores.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if len(ids) > MOST_PIECES:
            raise ValueError(f"{len(ids)} pieces; at most {MOST_PIECES}")
        pieces = [model.id_to_piece(i) for i in ids]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
        place = {p: i for i, p in enumerate(pieces) if model.is_byte(i)}
        byte_ids = [place[f"<0x{b:02X}>"] for b in range(256)]
        normal = [i for i in ids if not special[i] and not model.is_byte(i)]
        scores = [model.get_score(i) for i in ids]
        if ranks:
            whole = math.log(sum(1 / r for r in range(1, len(normal) + 1)))
            for r, i in enumerate(sorted(normal, key=lambda i: (-scores[i], i)), 1):
                scores[i] = -math.log(r) - whole
        return cls(pieces, scores, normal, byte_ids)


class DoubleArray:
    """A trie of byte strings in two arrays: state s goes by byte c to base[s] + c if check agrees.

    Byte 0 ends a string; ``base`` of the state it leads to holds the string's number.
    """

    def __init__(self, strings: dict[bytes, int]):
        tree: dict = {}
        for string, number in strings.items():
            node = tree
            for c in string:
                node = node.setdefault(c, {})
            node[0] = number
        self.base, self.check = [0] * 1024, [-1] * 1024
        self.check[0] = 0
        free, stack = 1, [(0, tree)]
        while stack:
            state, node = stack.pop()
            codes = sorted(node)
            while self.check[free] >= 0:
                free += 1
                self._grow(free)
            base = max(1, free - codes[0])
            self._grow(base + 256)
            while any(self.check[base + c] >= 0 for c in codes):
                base += 1
                self._grow(base + 256)
            self.base[state] = base
            for c in codes:
                self.check[base + c] = state
                if c:
                    stack.append((base + c, node[c]))
                else:
                    self.base[base] = node[0]

    def _grow(self, most: int) -> None:
        while len(self.check) <= most:
            self.base += [0] * len(self.base)
            self.check += [-1] * len(self.check)

    def prefixes(self, text: bytes, start: int) -> Iterator[tuple[int, int]]:
        """(end, number) of each string that begins at ``start``, the shorter ones first."""
        base, check, state = self.base, self.check, 0
        for at in range(start, len(text)):
            following = base[state] + text[at]
            if not text[at] or check[following] != state:
                return
            state = following
            if check[base[state]] == state:
                yield at + 1, base[base[state]]


@dataclass
class Encoder:
    vocabulary: Vocabulary
    known: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        v = self.vocabulary
        self.trie = DoubleArray({v.pieces[i].encode(): i for i in v.normal})
        self.base, self.check = np.array(self.trie.base, np.int32), np.array(self.trie.check, np.int32)
        self.scores = np.array(v.scores)
        self.unknown = min(v.scores[i] for i in v.normal) - UNKNOWN_COST
        self.bytes_of = [p.replace(MARK, " ").encode() for p in v.pieces]
        for byte, i in enumerate(v.byte_ids):
            self.bytes_of[i] = bytes([byte])
        self.mark = np.array([v.byte_ids[b] for b in MARK.encode()], np.int32).tobytes()
        # No piece has a marker after another character or holds a line end, so the
        # best pieces of a text are those of its parts between such places.
        inside = re.compile(f"[^{MARK}]{MARK}|\n")
        whole = any(inside.search(v.pieces[i]) for i in v.normal)
        self.parts = re.compile("(?s).+" if whole else f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text's pieces; none for the empty text."""
        return self.encode_many([text])[0]

    def encode_many(self, many: list[str]) -> list[np.ndarray]:
        """The ids of each text's pieces, with the parts they share worked out once."""
        # A marker that is text itself must not become a blank: it goes by its bytes.
        split = [
            [self.parts.findall(run.replace(" ", MARK)) for run in (" " + text).split(MARK)] if text else []
            for text in many
        ]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = {part for runs in split for parts in runs for part in parts if part not in known}
        small = [part for part in new if len(part) <= SHORT]
        for at in range(0, len(small), AT_ONCE):
            self._remember(small[at : at + AT_ONCE])
        long = {part: self._ids(self.best(part)) for part in new if len(part) > SHORT}

        def pieces(part: str) -> bytes:
            return known.get(part) or long[part]

        return [
            np.frombuffer(self.mark.join(b"".join(map(pieces, parts)) for parts in runs), np.int32)
            for runs in split
        ]

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, np.int32).tobytes()

    def _remember(self, parts: list[str]) -> None:
        """Viterbi for many short parts: all of them step through the trie together."""
        raw = [part.encode() for part in parts]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(-sizes, kind="stable")
        raw, sizes, most = [raw[i] for i in order], sizes[order], int(sizes.max(initial=0))
        text = np.zeros((most + 1, len(raw)), np.int32)  # a row for each place in the parts
        for row, one in enumerate(raw):
            text[: sizes[row], row] = np.frombuffer(one, np.uint8)
        lengths = np.select([text < 0x80, text < 0xC0, text < 0xE0, text < 0xF0], [1, 0, 2, 3], 4)
        best = np.full((most + 1, len(raw)), -np.inf)
        best[0] = 0
        back = np.zeros((most + 1, len(raw)), np.int32)
        piece = np.full((most + 1, len(raw)), -1, np.int32)

        def offer(end: int, rows: np.ndarray, score: np.ndarray, start: int, number: np.ndarray) -> None:
            higher = score > best[end][rows]
            rows = rows[higher]
            best[end][rows], back[end][rows], piece[end][rows] = score[higher], start, number[higher]

        for start in range(most):
            rows = np.flatnonzero(lengths[start][: np.searchsorted(-sizes, -start)])
            here, after = best[start], lengths[start] + start
            lone = np.zeros(len(raw), bool)
            lone[rows] = True
            state = np.zeros(len(rows), np.int32)
            for at in range(start, most):
                byte = text[at][rows]
                following = self.base[state] + byte
                on = (self.check[following] == state) & (byte > 0)
                rows, state = rows[on], following[on]
                if not len(rows):
                    break
                last = self.base[state]
                ends = self.check[last] == state
                found, number = rows[ends], self.base[last[ends]]
                lone[found[after[found] == at + 1]] = False
                offer(at + 1, found, here[found] + self.scores[number], start, number)
            rows = np.flatnonzero(lone)
            for end in np.unique(after[rows]):
                found = rows[after[rows] == end]
                offer(end, found, here[found] + self.unknown, start, np.full(len(found), -1))
        self._trace(parts, order, raw, sizes, back, piece)

    def _trace(self, parts, order, raw, sizes, back, piece) -> None:
        """Back from the end of each part along its best pieces."""
        at, rows = sizes.copy(), np.arange(len(raw))
        steps, starts = [], []
        while (at > 0).any():
            steps.append(np.where(at > 0, piece[at, rows], -2))
            at = np.where(at > 0, back[at, rows], 0)
            starts.append(at)
        found = np.array(steps, np.int32).reshape(len(steps), len(raw)).T[:, ::-1]
        real = found > -2
        flat, ends = found[real].tobytes(), np.cumsum(real.sum(1)) * 4
        begin = 0
        for place, end in zip(order.tolist(), ends.tolist(), strict=True):
            self.known[parts[place]] = flat[begin:end]
            begin = end
        for row in np.flatnonzero((found == -1).any(1)):  # unknown characters, by their bytes
            cuts = [int(s[row]) for s in starts][: int(real[row].sum())][::-1]
            ids: list[int] = []
            for i, a, z in zip(found[row][real[row]], cuts, [*cuts[1:], sizes[row]], strict=True):
                ids += [int(i)] if i >= 0 else [self.vocabulary.byte_ids[b] for b in raw[row][a:z]]
            self.known[parts[order[row]]] = self._ids(ids)

    def best(self, part: str) -> list[int]:
        """Viterbi for one part: the highest total score; of equal ones the longest last piece."""
        text = part.encode()
        size, scores = len(text), self.vocabulary.scores
        best: list[float | None] = [None] * (size + 1)
        back: list[tuple[int, int]] = [(0, 0)] * (size + 1)
        best[0] = 0.0
        start = 0
        for character in part:
            here, after = best[start], start + len(character.encode())
            single = False
            for end, piece in self.trie.prefixes(text, start):
                single |= end == after
                score = here + scores[piece]
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (start, piece)
            if not single and (best[after] is None or here + self.unknown > best[after]):
                best[after], back[after] = here + self.unknown, (start, -1)
            start = after
        ids: list[int] = []
        while size:
            start, piece = back[size]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += [self.vocabulary.byte_ids[b] for b in reversed(text[start:size])]
            size = start
        return ids[::-1]

    def decode(self, ids: np.ndarray) -> str:
        """The text of some ids; bytes that are no UTF-8 become U+FFFD."""
        raw = b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        return raw[raw.startswith(b" "):].decode("utf-8", "replace")


#: Texts that a task encodes or decodes at a time.
_ROWS = 256


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "piece_ids"
) -> DataFrame:
    """The documents with the ids of their pieces.

    Null and empty texts have none. Repeated rows and all other columns stay as
    they are; a column of the new name is an error.
    """
    _new(docs, ids_col)
    return _worked(
        docs, vocabulary, f"`{ids_col}` array<int>",
        lambda encoder, part: _with_ids(encoder, part, text_col, ids_col),
    )


def decode(
    rows: DataFrame, vocabulary: Vocabulary, ids_col: str = "piece_ids", text_col: str = "decoded"
) -> DataFrame:
    """The rows with the text of their ids; null or no ids are the empty text."""
    _new(rows, text_col)
    return _worked(
        rows, vocabulary, f"`{text_col}` string",
        lambda encoder, part: _with_text(encoder, part, ids_col, text_col),
    )


def encode_and_decode(
    docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "piece_ids",
    decoded_col: str = "decoded",
) -> DataFrame:
    """``decode`` of ``encode``, by one encoder: a task that has two keeps a Python process for each."""
    _new(docs, ids_col, decoded_col)
    return _worked(
        docs, vocabulary, f"`{ids_col}` array<int>, `{decoded_col}` string",
        lambda encoder, part: _with_text(
            encoder, _with_ids(encoder, part, text_col, ids_col), ids_col, decoded_col
        ),
    )


def _new(rows: DataFrame, *columns: str) -> None:
    for column in columns:
        if column in rows.columns:
            raise ValueError(f"there is a column {column} already")


def _worked(
    rows: DataFrame, vocabulary: Vocabulary, fields: str,
    step: Callable[[Encoder, pa.RecordBatch], pa.RecordBatch],
) -> DataFrame:
    """The rows with new columns, by an encoder for each task."""
    get = sent(rows.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(get())
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                yield step(encoder, batch.slice(at, _ROWS))

    return rows.mapInArrow(work, f"{_fields(rows)}, {fields}")


def _with_ids(encoder: Encoder, part: pa.RecordBatch, text_col: str, ids_col: str) -> pa.RecordBatch:
    ids = encoder.encode_many(texts(part, text_col))
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays(
        [*part.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
        [*part.schema.names, ids_col],
    )


def _with_text(encoder: Encoder, part: pa.RecordBatch, ids_col: str, text_col: str) -> pa.RecordBatch:
    lists = part.column(ids_col).fill_null([]) if part.column(ids_col).null_count else part.column(ids_col)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy().cumsum()
    decoded = [encoder.decode(ids) for ids in np.split(flat, ends[:-1])] if len(ends) else []
    return pa.RecordBatch.from_arrays(
        [*part.columns, pa.array(decoded, pa.string())], [*part.schema.names, text_col]
    )


def _fields(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
