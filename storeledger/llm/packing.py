"""Operator 7: sum-of-squares online packing of tokenised documents into sequences.

Every partition of the input packs its own documents in their order. A document's whole
windows of WINDOW tokens are sequences of their own. Its rest goes to the open window whose
fill level makes the sum of the squared counts of partially filled windows, by level,
smallest afterwards; opening a window is level 0. The counts are one array over the levels.
At the partition's end the open windows stay as they were placed, the fullest first; what they
lack is cut from the emptiest, which so are used up. At most one rest is left, cut into
sequences of power-of-two lengths: nothing is padded.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from storeledger.llm import support

WINDOW = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
# Pieces of texts whose ids a worker remembers, and their most letters: some 50 MB.
REMEMBERED, LONGEST = 250_000, 40
# Texts of letters of ASCII and Latin-1, digits, blanks and single full stops and commas.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = "".join(re.findall(f"[{_LETTERS}0-9 \n.,]", "".join(map(chr, range(256))))).encode("latin-1")
_DOUBLE = ("..", ",,", ".,", ",.")
# Tabs and the ASCII marks but the apostrophe; runs of letters and of neither letters nor blanks.
_MARKED = b"\t" + bytes(b for b in range(33, 127) if not chr(b).isalnum() and b != 39)
_RUNS = re.compile(f"[{_LETTERS}]+|[^{_LETTERS} \n\t]+").findall
# Small letters of ASCII, and of Latin-1 too.
_SMALL = "".join(map(chr, range(97, 123)))
_SMALL_LATIN = _SMALL + "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
# Marks, letters, marks.
_MARKS = r"([!-&(-/:-@\[-`{-~]*)"
_PLAIN = re.compile(f"{_MARKS}([{_LETTERS}]+){_MARKS}").fullmatch
PIECE_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

_remembered: dict[str, tuple[dict[str, bytes], dict[str, bytes]]] = {}
_loaded: dict[str, tuple] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pieces(text: str) -> list[str]:
    """Pieces of a text whose ids, one after the other, are the text's ids.

    The tokenizer lower-cases; blanks, tabs and newlines always end a token and make none; a run
    of letters, and a run of marks, are never one token.
    """
    try:
        rest = text.encode("latin-1").translate(None, _SIMPLE)
    except UnicodeEncodeError:
        rest = b"'"
    if not rest and not any(d in text for d in _DOUBLE):
        return text.lower().replace(".", " . ").replace(",", " , ").replace("\n", " ").split(" ")
    if not rest.translate(None, _MARKED) and "<|" not in text:
        return _RUNS(text.lower())
    found = []
    for word in text.replace("\n", " ").replace("\t", " ").split(" "):
        plain = _PLAIN(word)
        if plain and "<|" not in word:  # which begins the tokenizer's special tokens
            before, letters, after = plain.groups()
            found += (before, letters.lower(), after)
        else:
            found.append(word)
    return found


def _takes_letters_as_they_are(tokenizer) -> bool:
    """Whether the tokenizer's model gets a run of the letters a to z unchanged and whole."""
    return _letters_taken(tokenizer, _SMALL) == list(_SMALL)


def _letters_taken(tokenizer, letters: str) -> list[str]:
    """What the tokenizer's model gets for each of the letters in a run of them; none where it does not get
    such a run whole and letter by letter."""
    normalizer, cut = tokenizer.normalizer, tokenizer.pre_tokenizer
    if any(token.content.isalpha() for token in tokenizer.get_added_tokens_decoder().values()):
        return []
    if normalizer is not None and normalizer.normalize_str(letters) != letters:
        return []
    if cut is None:
        return list(letters)
    taken = ["".join(part for part, _ in cut.pre_tokenize_str(letter)) for letter in letters]
    return taken if [part for part, _ in cut.pre_tokenize_str(letters)] == ["".join(taken)] else []


class WordIds:
    """Ids of texts, as little-endian unsigned 32-bit numbers.

    The tokenizer is asked once for the ids of a piece, as long as it is remembered: a run of small letters of
    Latin-1 goes straight to its model, in the letters that this gets for them. A worker remembers two generations of pieces. When the younger has half of
    what may be remembered, it replaces the older, whose pieces are forgotten unless they were met since.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _loaded:
            tokenizer = Tokenizer.from_file(path)
            taken = _letters_taken(tokenizer, _SMALL_LATIN)
            letters = str.maketrans(dict(zip(_SMALL_LATIN, taken))) if taken else {}
            plain = _takes_letters_as_they_are(tokenizer)
            _loaded[path] = (tokenizer, tokenizer.model, plain, letters, frozenset(map(chr, letters)))
        self.tokenizer, self.model, self.plain, self.letters, self.small = _loaded[path]
        self.known, self.older = _remembered.setdefault(path, ({}, {}))

    def __call__(self, text: str) -> bytes:
        parts = pieces(text)
        found = list(map(self.known.get, parts))
        if None in found:
            found = [self._met(piece) if own is None else own for piece, own in zip(parts, found)]
        return b"".join(found)

    def _met(self, piece: str) -> bytes:
        """Ids of a piece that the younger generation may not have."""
        known, older = self.known, self.older
        own = known.get(piece)
        if own is not None:
            return own
        own = older.get(piece)
        if own is None:
            own = self._asked(piece)
        if len(piece) <= LONGEST:
            if len(known) >= REMEMBERED // 2:
                older.clear()
                older.update(known)
                known.clear()
            known[piece] = own
        return own

    def _asked(self, piece: str) -> bytes:
        if self.plain and piece.isascii() and piece.isalpha() and piece.islower():
            return array("I", [token.id for token in self.model.tokenize(piece)]).tobytes()
        if piece and self.small.issuperset(piece):
            return array("I", [token.id for token in self.model.tokenize(piece.translate(self.letters))]).tobytes()
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()


class SumOfSquares:
    """Open windows by fill level, and how many there are of each level."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}

    def place(self, piece: tuple, length: int) -> list | None:
        """Put a piece into an open or a new window; the window's pieces, if that fills it.

        Moving a window from level f to g changes the sum of squares by
        2 * (counts[g] - counts[f] + 1); levels 0 and full have no count.
        """
        last = self.window - length
        counts = self.counts
        change = 2 * (counts[length:] - counts[: last + 1] + 1)
        change[0] = 2 * counts[length] + 1
        change[last] = 1 - 2 * counts[last] if last else 0
        usable = counts[: last + 1] > 0
        usable[0] = True
        level = int(np.argmin(np.where(usable, change, np.iinfo(np.int64).max)))
        content = []
        if level:
            content = self.open[level].pop()
            counts[level] -= 1
        content.append(piece)
        level += length
        if level == self.window:
            return content
        counts[level] += 1
        self.open.setdefault(level, []).append(content)
        return None

    def windows(self) -> list[list[tuple]]:
        """Pieces of each open window, fullest window first."""
        return [content for level in sorted(self.open, reverse=True) for content in self.open[level]]


def topped_up(windows: list[list[tuple]], window: int) -> Iterator[list[tuple]]:
    """Windows, fullest first, filled with pieces cut from the last of them; the rest in powers of two."""
    first, last, spare = 0, len(windows) - 1, []
    while first <= last:
        content = windows[first]
        room = window - sum(len(ids) // 4 for _, _, ids, _ in content)
        while room and (spare or last > first):
            if not spare:
                spare, last = windows[last][::-1], last - 1
            doc, start, ids, total = spare.pop()
            content.append((doc, start, ids[: 4 * room], total))
            if len(ids) > 4 * room:
                spare.append((doc, start + room, ids[4 * room :], total))
            room -= min(room, len(ids) // 4)
        if room:
            yield from redealt(content, window)
        else:
            yield content
        first += 1
    yield from redealt(spare[::-1], window)


def redealt(pieces: list[tuple], window: int) -> Iterator[list[tuple]]:
    """Pieces (doc, start, ids, total) in turn, cut into full windows, then into powers of two."""
    left = sum(len(ids) // 4 for _, _, ids, _ in pieces)
    room, content = 0, []
    for doc, start, ids, total in pieces:
        at = 0
        while at < len(ids):
            if not room:
                room = window if left >= window else 1 << (left.bit_length() - 1)
            part = ids[at : at + 4 * room]
            content.append((doc, start + at // 4, part, total))
            at += len(part)
            room -= len(part) // 4
            left -= len(part) // 4
            if not room:
                yield content
                content = []


def _pack(batches: Iterator[pa.RecordBatch], path: str, window: int, end_id: int) -> Iterator[pa.RecordBatch]:
    word_ids = WordIds(path)
    end = np.array([end_id], "<u4").tobytes()
    packer = SumOfSquares(window)
    sequence = TaskContext.get().partitionId() << 32
    columns: list[list] = [[] for _ in range(7)]

    def add(content: list[tuple]) -> None:
        nonlocal sequence
        offset = 0
        for doc, start, ids, total in content:
            length = len(ids) // 4
            for column, value in zip(columns, (doc, start, length, ids, total, sequence, offset)):
                column.append(value)
            offset += length
        sequence += 1

    def flushed() -> pa.RecordBatch:
        arrays = [pa.array(c, pa.binary() if i == 3 else pa.int64()) for i, c in enumerate(columns)]
        for column in columns:
            column.clear()
        return pa.RecordBatch.from_arrays(arrays, PIECE_NAMES)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = word_ids(text or "") + end
            total = len(ids) // 4
            whole = total - total % window
            for start in range(0, whole, window):
                add([(doc, start, ids[4 * start : 4 * (start + window)], total)])
            if whole < total:
                full = packer.place((doc, whole, ids[4 * whole :], total), total - whole)
                if full:
                    add(full)
        if columns[0]:
            yield flushed()
    for content in topped_up(packer.windows(), window):
        add(content)
    if columns[0]:
        yield flushed()


def pack(
    docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Documents packed into token sequences of at most `window` tokens.

    docs: `doc_id` (long), `text`; other columns are ignored. tokenizer: path of a tokenizer
    file whose tokens never cross or depend on blanks. One row for each piece: `doc_id`,
    `start` (ids of the document before it), `length`, `ids` (binary: little-endian unsigned
    32-bit), `doc_tokens` (with the end id), `sequence_id`, `offset` (in the sequence).
    Sequences have `window` tokens; the last few of an input partition have powers of two.
    Every document ends with end_id, so null and empty texts are one token. Null doc_ids and
    repeated rows are packed like others. No rows give none.

    Nothing is shuffled; a task holds its open windows only. Sequence ids come from the
    partition's number, so a task that runs again gives the same rows.
    """
    support.prepare(docs.sparkSession)
    path = tokenizer or tokenizer_path()
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _pack(batches, path, window, end_id), schema)
