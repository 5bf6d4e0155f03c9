"""BPE encoding by backtracking over longest matches, decoding by offsets.

The tokenizer file is a parameter. A word is a string over a base alphabet of
bytes, the last of them marked as the word's end. An Aho-Corasick automaton
over the vocabulary gives every token that occurs in the word; from the left,
the longest token is taken whose pair with the token before it is compatible,
and a dead end steps back to the next shorter one. Two tokens are compatible
if merging their concatenation by rank leaves exactly these two, which is read
off the pair and split tables. The sequence in which all neighbours are
compatible is the one the merges give, and each position is left as a dead end
at most once, so a word costs linear time.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import text_list, text_slices

#: Members of the patterns' classes among Latin-1 characters in lower case.
LATIN = {r"\p{L}": "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"\p{N}": "0-9\xb2\xb3\xb9\xbc-\xbe", r"\s": " \t-\r\x85\xa0"}
CACHED_WORDS = 250_000   # words in each half of a worker's memory


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    the byte itself where it is printable Latin-1, the others from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Words:
    """Special tokens and words of a text, as a tokenizer file of this kind
    asks: NFC, white space to one space, lower case; words by pattern."""

    def __init__(self, spec: dict):
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._pattern = regex.compile(pattern)
        # the same over Latin-1 in lower case, for the faster standard module
        for kind, members in LATIN.items():
            pattern = pattern.replace(kind, members)
        self._latin = re.compile(pattern)

    def of(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        try:
            text.encode("latin-1")
            return self._latin.findall(text.lower())   # in NFC as it is
        except UnicodeEncodeError:
            text = unicodedata.normalize("NFC", text)
        if "Σ" in text:   # lower() looks at its neighbours, the tokenizer doesn't
            return self._pattern.findall("".join(map(str.lower, text)))
        return self._pattern.findall(text.lower())

    def parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of plain text, each with the special token after it."""
        at = 0
        for m in self._special.finditer(text):
            yield text[at:m.start()], self.special[m.group()]
            at = m.end()
        yield text[at:], None


class Bpe:
    """Encoder and decoder for one tokenizer file of kind BPE with a word-end
    suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.words = Words(spec)
        self._latin = str.maketrans(byte_letters())
        self._merge_tables(model["merges"])
        self._match_tables()
        self._offset_table()
        self._bytes: dict[str, bytes] = {}
        self._decimal: dict[str, str] = {}
        self._old_bytes: dict[str, bytes] = {}
        self._old_decimal: dict[str, str] = {}

    # tables -----------------------------------------------------------
    def _symbols(self, token: str) -> str:
        """The token with its word-end suffix, if any, folded into the last
        letter, so that a prefix of the string is a prefix in symbols."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + 0x1000)
        return token

    def _merge_tables(self, merges) -> None:
        """rank: of the merge that makes a token (base letters: -1); split: the
        two tokens it is made of; pairs: rank of the merge of two tokens."""
        self.rank = {i: -1 for i in self.vocab.values()}
        self.split: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in merges):
            left, right, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.pairs[left, right] = rank
            if made not in self.split:
                self.split[made], self.rank[made] = (left, right), rank
        self._known: dict[tuple[int, int], bool] = {}

    def _match_tables(self) -> None:
        """The automaton over tokens that their own merges give, and of each
        token the longest shorter one that begins it."""
        strings = {i: self._symbols(t) for t, i in self.vocab.items()}
        sound = set()
        for i in sorted(strings, key=lambda i: self.rank[i]):
            if i not in self.split:
                if len(strings[i]) == 1:
                    sound.add(i)
            elif sound.issuperset(self.split[i]) and self._fits(*self.split[i], below=self.rank[i]):
                sound.add(i)
        self.length = {i: len(strings[i]) for i in sound}
        self._automaton = ahocorasick.Automaton()
        by_string = {strings[i]: i for i in sound}
        for s, i in by_string.items():
            self._automaton.add_word(s, i)
        self._automaton.make_automaton()
        self._shorter = {}
        for s, i in by_string.items():
            cut = next((n for n in range(len(s) - 1, 0, -1) if s[:n] in by_string), 0)
            self._shorter[i] = by_string[s[:cut]] if cut else None

    def _offset_table(self) -> None:
        """Strings of all ids, each with a space after it, in one byte array,
        and where each begins."""
        strings = {i: t.encode() for t, i in chain(self.vocab.items(), self.words.special.items())}
        parts = [strings.get(i, b"") + b" " for i in range(max(strings) + 1)]
        self._offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        self._strings = np.frombuffer(b"".join(parts), np.uint8)

    # encoding ---------------------------------------------------------
    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two tokens' concatenation by rank gives them."""
        got = self._known.get((left, right))
        if got is None:
            got = self._fits(left, right)
            if len(self._known) < 2_000_000:
                self._known[left, right] = got
        return got

    def _fits(self, left: int, right: int, below: int | None = None) -> bool:
        """Undo merges, the latest first, on the two sides of the boundary; no
        merge across it may come before the one undone. ``below``: only
        merges before this rank count."""
        bound = below if below is not None else len(self.pairs) + 1
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < bound:
                return False
            # the side merged later is undone; at equal ranks the left one was merged first
            if self.rank[left] > self.rank[right]:
                bound, left = self.rank[left], self.split[left][1]
            elif self.rank[right] >= 0:
                bound, right = self.rank[right] + 1, self.split[right][0]
            else:
                return True

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word: a string of symbols."""
        longest: list[int | None] = [None] * len(word)
        for end, token in self._automaton.iter(word):
            start = end + 1 - self.length[token]
            if longest[start] is None or self.length[token] > self.length[longest[start]]:
                longest[start] = token
        out: list[int] = []
        dead = [False] * (len(word) + 1)
        at, token = 0, longest[0] if word else None
        while at < len(word):
            while token is not None and (dead[at + self.length[token]]
                                         or out and not self.compatible(out[-1], token)):
                token = self._shorter[token]
            if token is not None:
                out.append(token)
                at += self.length[token]
                token = longest[at] if at < len(word) else None
            elif out:
                dead[at] = True
                token = out.pop()
                at -= self.length[token]
            else:
                raise ValueError(f"no tokens for {word!r}")
        return out

    def _learn(self, words: set[str], new: set[str]) -> None:
        """Ids of new words of a text into the worker's memory. It has two
        halves: when the younger is full it becomes the older, so words in
        use stay and the memory is bounded."""
        if len(self._bytes) + len(new) > CACHED_WORDS:
            self._old_bytes, self._old_decimal = self._bytes, self._decimal
            self._bytes, self._decimal = {}, {}
            new = words
        for piece in new:
            if piece in self._old_bytes:
                self._bytes[piece], self._decimal[piece] = self._old_bytes[piece], self._old_decimal[piece]
                continue
            symbols = piece.encode().decode("latin-1").translate(self._latin)
            if self.suffix:
                symbols = symbols[:-1] + chr(ord(symbols[-1]) + 0x1000)
            ids = self.word_ids(symbols)
            self._bytes[piece], self._decimal[piece] = array("I", ids).tobytes(), " ".join(map(str, ids))

    def _part(self, text: str) -> tuple[bytes, str]:
        """Ids of a text without special tokens, as bytes and as text."""
        pieces = self.words.of(text)
        words = set(pieces)
        new = words.difference(self._bytes)
        if new:
            self._learn(words, new)
        return (b"".join(map(self._bytes.__getitem__, pieces)), " ".join(map(self._decimal.__getitem__, pieces)))

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """Ids, and as decimal numbers joined by a space."""
        parts = []
        for plain, special in self.words.parts(text):
            parts.append(self._part(plain))
            if special is not None:
                parts.append((np.uint32(special).tobytes(), str(special)))
        return np.frombuffer(b"".join(p[0] for p in parts), np.uint32), " ".join(p[1] for p in parts if p[1])

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the ids' strings joined by a space (the file names no
        decoder), gathered through the offset table."""
        start = self._offsets[ids]
        size = self._offsets[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        if not len(ends):
            return b""
        at = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self._strings[at][:-1].tobytes()


_loaded: dict[str, Bpe] = {}


def bpe(path: str) -> Bpe:
    """One instance for each file and worker."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, sha256 of the ids as text and of the
    decoded text. A narrow pass: no shuffle. Null text counts as empty (no
    ids); repeated rows and null ids give a row each; other columns are
    ignored. The whole text is encoded, however long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        for batch in batches:
            for part in text_slices(batch):
                n, of_ids, of_text = [], [], []
                for text in text_list(part):
                    ids, decimal = model.encode(text)
                    n.append(len(ids))
                    of_ids.append(hashlib.sha256(decimal.encode()).hexdigest())
                    of_text.append(hashlib.sha256(model.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()),
                     pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
