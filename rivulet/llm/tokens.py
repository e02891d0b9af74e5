"""Tokens of whole texts, exactly as the tokenizers library gives them, each piece once.

A byte-pair tokenizer first cuts a text into pieces by a pattern and then merges inside
each piece alone, so a piece has the same ids wherever it stands. Prose repeats its
pieces: a task cuts texts with the tokenizer's own pattern, has the library encode each
distinct piece once, and puts the ids together. The shortcut is taken only for the two
layouts of tokenizer files named below and for texts of Latin letters, where the
pattern's letter classes are beyond doubt; every other text, any text that holds a
special token's string, and any other tokenizer file go to the library whole.

What is known of the pieces is one array of ids with each piece's place in it, so the ids
of a batch of texts are gathered by index. New pieces are put to the tokenizer's own model
many at a time, already in the model's spelling of bytes, so it need not cut them again.
What a process knows is bounded; when it is too much, the pieces met first stay, which are
the most frequent ones by and large.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import regex

# fixed values: the patterns of the public tokenizer files
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_PLAIN = {"normalizer": None, "pre_tokenizer": _BYTE_LEVEL | {"use_regex": True}}
_FOLDED = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": WORD_PATTERN},
                "behavior": "Removed",
                "invert": True,
            },
            _BYTE_LEVEL | {"use_regex": False},
        ],
    },
}

#: Texts outside this range, or with separators that libraries class differently, go to
#: the library whole. U+0130 has a lower case of two characters.
_UNSURE = regex.compile("[\x1c-\x1f\x85İɐ-\U0010ffff]")


#: What an encoder remembers between batches: pieces, and characters of them.
MOST = 400_000
CHARS = 16_000_000
SLICE_BYTES = 1 << 20  # of texts encoded at a time


def _class(kind: str) -> str:
    """The characters of a class among those of texts that are cut here, for a set in `re`.

    Some of them have a lower case beyond.
    """
    found = {c for code in range(0x250) for c in chr(code) + chr(code).lower()}
    return "".join(re.escape(c) for c in sorted(found) if regex.fullmatch(kind, c))


@lru_cache(maxsize=2)
def _spelled(pattern: str) -> re.Pattern:
    """The pattern with its letter classes spelled out, which `re` searches faster."""
    for kind in (r"\p{L}", r"\p{N}"):
        inside = _class(kind)
        pattern = re.sub(  # inside a set the characters, elsewhere a set of them
            r"\[[^]]*\]|" + re.escape(kind),
            lambda m: f"[{inside}]" if m[0] == kind else m[0].replace(kind, inside),
            pattern,
        )
    return re.compile(pattern)


def path(name: str) -> str:
    """Where a file of the public tokenizers is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> np.ndarray:
    """The letter for each byte in byte-level vocabularies; a line break stays as it is."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = np.zeros(256, "<u2")
    letters[shown] = shown
    hidden = np.flatnonzero(letters == 0)
    letters[hidden] = 256 + np.arange(len(hidden))
    letters[10] = 10  # stands between pieces
    return letters


_BYTE_LETTERS = _byte_letters()


class _Numbers(dict):
    """Pieces by number, in the order in which they are first asked for."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


@lru_cache(maxsize=2)
def encoder(file: str) -> "Encoder":
    """The encoder of this process: a Python worker keeps what it knows between tasks."""
    return Encoder(file)


class Encoder:
    """Ids of texts under one tokenizer file; remembers a bounded number of pieces."""

    def __init__(self, file: str, most: int = MOST, chars: int = CHARS):
        from tokenizers import Tokenizer

        with open(file, encoding="utf-8") as source:
            text = source.read()
        layout = json.loads(text)
        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in layout["added_tokens"]]
        head = {k: layout[k] for k in ("normalizer", "pre_tokenizer")}
        self.fold = head == _FOLDED
        self.fast = (self.fold or head == _PLAIN) and layout["model"].get("dropout") is None
        self.pattern = _spelled(WORD_PATTERN if self.fold else PATTERN)
        self.model = self.tokenizer.model
        self.most, self.chars = most, chars
        self._clear()

    def _clear(self) -> None:
        """Piece k is known[...] = k and has ids[start[k] : start[k + 1]]."""
        self.known = _Numbers()
        self.held = 0  # characters of the known pieces
        self.ids = np.empty(1 << 16, self.dtype)
        self.start = np.zeros(1 << 14, np.int64)

    def _forget(self) -> None:
        """Keeps the pieces met first, as half of what may be remembered."""
        lengths = np.cumsum(np.fromiter(map(len, self.known), np.int64, len(self.known)))
        n = min(self.most // 2, int(np.searchsorted(lengths, self.chars // 2, "right")))
        self.known = _Numbers(islice(self.known.items(), n))
        self.held = int(lengths[n - 1]) if n else 0
        self.start = self.start[: n + 1].copy()
        self.ids = self.ids[: self.start[n]].copy()

    def _gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by number, and their bounds."""
        first = self.start[which]
        counts = self.start[which + 1] - first
        ends = np.concatenate(([0], np.cumsum(counts)))
        return self.ids[np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])], ends

    def sure(self, text: str) -> bool:
        """Whether the text may be cut into pieces here."""
        if not self.fast or any(s in text for s in self.special):
            return False
        return text.isascii() and not _ASCII_UNSURE.search(text) or not _UNSURE.search(text)

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text.lower() if self.fold else text)

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, little-endian; a null counts as empty."""
        texts = [t or "" for t in texts]
        cut = [self.pieces(t) if self.sure(t) else None for t in texts]
        sizes = np.array([len(pieces or ()) for pieces in cut], np.int64)
        which = self.numbers(list(chain.from_iterable(pieces or () for pieces in cut)))
        found, ends = self._gathered(which)
        bounds = ends[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        return [
            self._whole(t) if pieces is None else found[low:high].tobytes()
            for t, pieces, low, high in zip(texts, cut, bounds[:-1], bounds[1:], strict=True)
        ]

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, valid until the next call; new ones are learned together."""
        if len(self.known) > self.most or self.held > self.chars:
            self._forget()
        found = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if self.known.new:
            try:
                self._learn(self.known.new)
            except BaseException:
                self._clear()  # no number without ids
                raise
            self.known.new = []
        return found

    def _learn(self, new: list[str]) -> None:
        ids, counts = [], []
        for at in range(0, len(new), 4096):
            for piece, letters in self._letters(new[at : at + 4096]):
                if piece.isspace():  # may hold line breaks
                    found = self.tokenizer.encode(piece, add_special_tokens=False).ids
                else:
                    found = [token.id for token in self.model.tokenize(letters)]
                ids += found
                counts.append(len(found))
        n = len(self.known) - len(new)
        end = self.start[n] + len(ids)
        if len(self.known) >= len(self.start):
            self.start = np.resize(self.start, 2 * len(self.known))
        if end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * end)
        self.ids[self.start[n] : end] = ids
        self.start[n + 1 : len(self.known) + 1] = self.start[n] + np.cumsum(counts)
        self.held += sum(map(len, new))

    def _letters(self, part: list[str]) -> Iterable[tuple[str, str]]:
        """Pieces with their bytes as letters; none for white space."""
        plain = ["" if piece.isspace() else piece for piece in part]
        raw = np.frombuffer("\n".join(plain).encode(), np.uint8)
        letters = _BYTE_LETTERS[raw].tobytes().decode("utf-16-le").split("\n")
        return zip(part, letters, strict=True)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ends, in characters, of the pieces of a text, and the ids up to each end.

        Only for tokenizers without a normalizer, whose offsets are those of the text.
        """
        if self.sure(text):
            pieces = self.pieces(text)
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            which = self.numbers(pieces)
            return ends, np.cumsum(self.start[which + 1] - self.start[which])
        found = self.tokenizer.encode(text, add_special_tokens=False)
        if not found.ids:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
        last = np.append(words[1:] != words[:-1], True)
        ends = np.array([end for _, end in found.offsets], np.int64)
        return ends[last], np.flatnonzero(last) + 1


_ASCII_UNSURE = regex.compile("[\x1c-\x1f]")
