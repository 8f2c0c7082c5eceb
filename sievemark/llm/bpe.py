"""Byte-pair encoding and decoding of whole texts, long ones in parallel.

The vocabulary is a tokenizer file of the `tokenizers` library, given by path. Words are encoded
once per task and looked up afterwards. A text above ``PIECE`` characters is cut into pieces that
are rows of their own, encoded wherever there is room, and put together as a tree:

* a cut before white space separates words, so the ids are simply joined;
* a cut inside unsplit text (letters or marks without white space) leaves two halves of one word. A
  window of tokens around the join is encoded again and grows until its first token is that of
  the left half and its last token is that of the right half. Neighbouring tokens
  of an encoding encode to themselves, and a row of tokens in which all neighbours do so is the
  encoding of its text; so the result is exactly that of encoding the word at once.

Defined results: null and empty texts have no tokens and decode to an empty text. Special tokens
that stand in a text are encoded as such. Repeated rows are encoded each on its own. Columns of the
input other than the text are kept.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer, models

from ..plans.durable import stored
from .grouping import beside, per_group, quoted

PIECE = 32_768  # characters in a piece
CACHE = 250_000  # words whose ids a task remembers
OUT = 1 << 20  # characters whose results leave the task together
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# Characters that the plain pattern below splits like the tokenizer: ASCII and Latin letters.
_PLAIN = re.compile(r"[\x00-\x1b\x20-\x7fÀ-ÖØ-öø-įı-ſ]*")
_PLAIN_WORD = re.compile(
    rf"{_CONTRACTIONS}|[a-zß-öø-ſ]+|[0-9]|[^ \t-\r0-9a-zß-öø-ſ]+"
)
_SPACE = frozenset(" \t\n\v\f\r")


@dataclass
class _Part:
    """Ids of a piece of text, with the tokens of its first and of its last word."""

    ids: np.ndarray
    words: int
    head: int
    tail: int
    open: bool  # the last word goes on in the next piece


class Encoder:
    """Encoding and decoding as the tokenizer file says; kept for the life of a task."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.suffix = model["end_of_word_suffix"]
        self._merges, self._vocab = merges, model["vocab"]
        self.ending = self.tokenizer.model
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.strings = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.bytes = _byte_letters()
        self.known: dict[str, bytes] = {}

    @cached_property
    def inside(self) -> models.BPE:
        """The same merges for text that goes on: its last character ends no word."""
        return models.BPE(vocab=self._vocab, merges=self._merges)

    def _letters(self, word: str) -> str:
        return "".join([self.bytes[b] for b in word.encode()])

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, as written or in byte letters."""
        if _PLAIN.fullmatch(text):
            return _PLAIN_WORD.findall(text.lower())
        normal = self.tokenizer.normalizer.normalize_str(text)
        # A space in front marks byte letters, which the plain pattern never gives.
        return [" " + w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def _word(self, word: str, ending: bool = True) -> bytes:
        letters = word[1:] if word[0] == " " else self._letters(word)
        model = self.ending if ending else self.inside
        return np.array([t.id for t in model.tokenize(letters)], np.int32).tobytes()

    def _ids(self, words: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = self._word(w)
            return b"".join([known[w] for w in words])

    def encode(self, text: str) -> np.ndarray:
        parts = self.split_special.split(text) if "<" in text else [text]
        found = [
            np.array([self.special[p]], np.int32).tobytes() if i % 2 else self._ids(self.words(p))
            for i, p in enumerate(parts)
        ]
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        strings = self.strings
        return " ".join([strings[i] for i in ids.tolist()])

    def encode_piece(self, text: str, goes_on: bool) -> _Part:
        """A piece; ``goes_on`` if its last word continues in the next piece."""
        parts = self.split_special.split(text)
        words: list[bytes] = []
        for i, part in enumerate(parts):
            if i % 2:
                words.append(np.array([self.special[part]], np.int32).tobytes())
                continue
            own = self.words(part)
            last = goes_on and i == len(parts) - 1
            whole = own[:-1] if last else own
            self._ids(whole)
            words += [self.known[w] for w in whole]
            if last and own:
                words.append(self._word(own[-1], ending=False))
        sizes = [len(w) // 4 for w in words]
        ids = np.frombuffer(b"".join(words), np.int32)
        return _Part(ids, len(words), sizes[0] if sizes else 0, sizes[-1] if sizes else 0, goes_on)

    def concatenate(self, parts: list[_Part], joins: list[bool]) -> _Part:
        """The parts of a text as one; ``joins[i]`` if part i and the one before share a word."""
        if len(parts) == 1:
            return parts[0]
        middle = len(parts) // 2
        left = self.concatenate(parts[:middle], joins[:middle])
        right = self.concatenate(parts[middle:], joins[middle:])
        if not joins[middle]:
            a, b = (left, right) if left.words and right.words else (left if left.words else right,) * 2
            return _Part(
                np.concatenate([left.ids, right.ids]),
                left.words + right.words, a.head, b.tail, right.open,
            )
        closed = right.words > 1 or not right.open
        word = self._join(
            left.ids[len(left.ids) - left.tail :], right.ids[: right.head], closed
        )
        return _Part(
            np.concatenate(
                [left.ids[: len(left.ids) - left.tail], word, right.ids[right.head :]]
            ),
            left.words + right.words - 1,
            len(word) if left.words == 1 else left.head,
            len(word) if right.words == 1 else right.tail,
            right.open,
        )

    def _join(self, left: np.ndarray, right: np.ndarray, closed: bool) -> np.ndarray:
        size = 8
        while True:
            ends = size >= len(right)
            a, b = left[max(0, len(left) - size) :], right[:size]
            letters = "".join([self.strings[i] for i in np.concatenate([a, b]).tolist()])
            if closed and ends:
                letters = letters.removesuffix(self.suffix)
            model = self.ending if closed and ends else self.inside
            window = np.array([t.id for t in model.tokenize(letters)], np.int32)
            if (size >= len(left) or window[0] == a[0]) and (ends or window[-1] == b[-1]):
                return np.concatenate([left[: len(left) - len(a)], window, right[len(b) :]])
            size *= 2

    def _kind(self, character: str, last: bool) -> str:
        """Letter, mark, digit or nothing: of the last or first that a character turns into."""
        words = self.words(character)
        if not words:
            return ""
        normal = self.tokenizer.normalizer.normalize_str(character)
        end = normal[-1] if last else normal[0]
        if end.isalpha():
            return "letter"
        return "digit" if unicodedata.category(end)[0] == "N" else "mark"

    def cuts(self, text: str, piece: int) -> Iterator[tuple[int, int, bool]]:
        """(start, stop, joined) of pieces; joined if a piece begins inside a word."""
        start, joined = 0, False
        while len(text) - start > piece:
            at, next_joined = self._cut(text, start + piece // 2, start + piece)
            if at >= len(text):
                break
            yield start, at, joined
            start, joined = at, next_joined
        yield start, len(text), joined

    def _cut(self, text: str, low: int, high: int) -> tuple[int, bool]:
        for at in range(high, low, -1):
            if text[at] in _SPACE:
                return at, False
        for at in range(high, len(text)):
            if text[at] in _SPACE:
                return at, False
            near = text[max(0, at - 16) : at + 16]
            # Not within a special token or contraction, nor where characters may combine.
            if "<|" in near or "|>" in near or "'" in near:
                continue
            pair = text[at - 1 : at + 1]
            if not pair.isascii() and not _inert(pair):
                continue
            before, after = self._kind(pair[0], True), self._kind(pair[1], False)
            if before and after:
                return at, before == after and before != "digit"
        return len(text), False


def _inert(pair: str) -> bool:
    """Whether normalizing treats the two characters apart: letters that never combine."""
    return all(
        unicodedata.category(c) in ("Lo", "Lu", "Ll")
        and not unicodedata.combining(c)
        and unicodedata.normalize("NFD", c) == c
        and not 0x1100 <= ord(c) <= 0x11FF
        for c in pair
    )


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_RESULT = "ids array<int>, decoded string"


def _emit(kept: pa.RecordBatch | pa.Table, ids: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
    sizes = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(i) for i in ids], out=sizes[1:])
    flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
    columns = [*kept.columns, pa.ListArray.from_arrays(pa.array(sizes), flat), pa.array(texts, pa.string())]
    names = [*kept.schema.names, "ids", "decoded"]
    return pa.RecordBatch.from_arrays(
        [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names
    )


def encode(
    docs: DataFrame, path: str, text_col: str = "text", piece: int = PIECE
) -> DataFrame:
    """``docs`` without its text, with ``ids`` and the ``decoded`` text of the ids; these names are replaced."""
    docs = docs.drop("ids", "decoded")
    kept = [name for name in docs.columns if name != text_col]
    rows = docs.select(
        F.struct(*[F.col(quoted(name)) for name in kept]).alias("kept") if kept else F.lit(True).alias("kept"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    short, long = (rows.where(F.char_length("text") <= piece), rows.where(F.char_length("text") > piece))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            at, held, ids, decoded = 0, 0, [], []
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                ids.append(encoder.encode(text))
                decoded.append(encoder.decode(ids[-1]))
                held += len(text)
                if held >= OUT:
                    yield _emit(batch.select(["kept"]).slice(at, i + 1 - at), ids, decoded)
                    at, held, ids, decoded = i + 1, 0, [], []
            if ids:
                yield _emit(batch.select(["kept"]).slice(at), ids, decoded)
        # Workers go on to other work, which needs the room.
        encoder.known.clear()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for number, text in zip(batch.column("number").to_pylist(), batch.column("text")):
                text = text.as_py()
                found = list(encoder.cuts(text, piece))
                joined = [j for _, _, j in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(found), pa.int64()),
                        pa.array(range(len(found)), pa.int32()),
                        pa.array([text[a:b] for a, b, _ in found], pa.string()),
                        pa.array(joined, pa.bool_()),
                        pa.array([*joined[1:], False], pa.bool_()),
                    ],
                    ["number", "piece", "text", "joined", "goes_on"],
                )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            parts = [
                encoder.encode_piece(text.as_py(), on)
                for text, on in zip(batch.column("text"), batch.column("goes_on").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("number"), batch.column("piece"), batch.column("joined"),
                    batch.column("goes_on"), pa.array([p.words for p in parts], pa.int32()),
                    pa.array([p.head for p in parts], pa.int32()),
                    pa.array([p.tail for p in parts], pa.int32()),
                    pa.array([p.ids.tobytes() for p in parts], pa.binary()),
                ],
                ["number", "piece", "joined", "goes_on", "words", "head", "tail", "ids"],
            )
        encoder.known.clear()

    def together(table: pa.Table) -> pa.Table:
        encoder = _encoder(path)
        table = table.sort_by("piece")
        rows = table.to_pylist()
        parts = [
            _Part(np.frombuffer(r["ids"], np.int32), r["words"], r["head"], r["tail"], r["goes_on"])
            for r in rows
        ]
        ids = encoder.concatenate(parts, [r["joined"] for r in rows]).ids
        made = _emit(table.select(["number"]).slice(0, 1), [ids], [encoder.decode(ids)])
        return pa.Table.from_batches([made])

    done = short.mapInArrow(whole, beside(rows, "kept", _RESULT))
    # Read twice, so the numbers are written down.
    numbered = stored(long.withColumn("number", F.monotonically_increasing_id()), "long_texts")
    cut_rows = numbered.select("number", "text").mapInArrow(
        cut, "number bigint, piece int, text string, joined boolean, goes_on boolean"
    )
    encoded = cut_rows.repartition("number", "piece").mapInArrow(
        pieces,
        "number bigint, piece int, joined boolean, goes_on boolean, words int, head int, tail int, ids binary",
    )
    joined = per_group(encoded, ["number"], together, f"number bigint, {_RESULT}")
    of_long = numbered.select("number", "kept").join(joined, "number").select("kept", "ids", "decoded")
    result = done.unionByName(of_long)
    return result.select(*([F.col(f"kept.{quoted(name)}") for name in kept] if kept else []), "ids", "decoded")
