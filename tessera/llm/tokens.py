"""Token ids of whole text columns with a tokenizer file of the ``tokenizers`` library.

The tokenizer used here (byte-level BPE) cuts a text at white space and into runs of
letters, single numerals and runs of other signs, and encodes each such piece by
itself. A column is therefore encoded by words: texts are cut at blanks, tabs
and line ends (``BLANKS``), each distinct word that the worker has not met before is
encoded, and its ids are remembered under its raw bytes; texts are put together by
array indexing. A full memory forgets the words that were not met again.

New words of plain characters (``PLAIN``: printable ASCII and precomposed Latin
letters, for which every version of Unicode gives the same classes and lower case) are
cut into pieces here, so that a word met again with a comma or a capital costs
nothing. All other words go to the library as they are. A tokenizer whose
cutter or normaliser is of another kind is refused.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
import regex

from tessera.llm import words as W

# the tokenizer's own rules for cutting (fixed values)
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPECIAL_START = "<|"
# fixed values: the normaliser and cutter, as the tokenizer file spells them
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
CUTTERS = ["Split", "ByteLevel"]
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STOPS = (b".", b",")
STOP = "."
# printable ASCII and Latin letters without the dotted capital I, whose lower case is two characters
PLAIN = regex.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")

BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, 0x09, 0x0A, 0x0D]] = True
MAX_PIECES = 250_000  # words, and pieces, remembered by one Python worker
JOINED = 256


class Ids:
    """Ids of keys seen so far, in one flat array."""

    def __init__(self):
        self.code: dict = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)
        self.again = np.zeros(1 << 16, dtype=bool)  # asked for again after they came
        self.n_ids = 0

    def add(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        n, at = len(keys), len(self.code)
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while at + n + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.starts[at + 1:at + n + 1] = self.n_ids + np.cumsum(lengths)
        self.n_ids += len(ids)
        self.code.update(zip(keys, range(at, at + n)))

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the keys one after another, number of ids of each)."""
        first = self.starts[codes]
        lengths = self.starts[codes + 1] - first
        return self.ids[W.expand(first, lengths)], lengths

    def met(self, codes: np.ndarray, before: int) -> None:
        """Mark those of ``codes`` that were among the first ``before`` keys as asked for again."""
        self.again[codes[codes < before]] = True

    def kept(self, most: int) -> Ids:
        """The keys that were asked for again, unmarked; none if they are more than ``most``."""
        again = self.again[:len(self.code)]
        at, out = np.flatnonzero(again), Ids()
        if 0 < len(at) <= most:
            out.add(list(compress(self.code, again.tolist())), *self.take(at))
        return out


def _lowered(words: list[bytes]) -> list[str]:
    """Words of ASCII letters in lower case."""
    return b" ".join(words).lower().decode("ascii").split()


class PieceTable:
    """Ids of every word and piece seen so far."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        steps = [[x["type"] for x in (rules[k] or {}).get("normalizers" if k == "normalizer" else "pretokenizers", [])]
                 for k in ("normalizer", "pre_tokenizer")]
        if steps != [NORMALIZERS, CUTTERS] or rules["pre_tokenizer"]["pretokenizers"][0]["pattern"] != {"Regex": CUT}:
            raise ValueError(f"{path} does not cut texts at white space into runs of letters, numerals and signs")
        stop = self.tokenizer.encode(STOP, add_special_tokens=False).ids
        self.stop = stop[0] if len(stop) == 1 else -1
        # the same model for lower-case ASCII letters, which normaliser and cutter leave as they are
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Split(STOP, "isolated")
        self.clear()

    def clear(self) -> None:
        self.words, self.pieces = Ids(), Ids()

    def _encode_alone(self, keys: list, texts: list[str], into: Ids) -> None:
        for i in range(0, len(texts), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i:i + 4096], add_special_tokens=False)]
            into.add(keys[i:i + 4096], np.fromiter(chain.from_iterable(found), np.uint32),
                     np.fromiter(map(len, found), np.int64, len(found)))

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Encode new pieces, in lower case. Runs of ASCII letters go joined by full stops, whose one id no run of letters has."""
        plain = [x.isascii() and x.isalpha() for x in pieces]
        alone = list(compress(pieces, map(not_, plain)))
        letters = list(compress(pieces, plain))
        groups = [letters[i:i + JOINED] for i in range(0, len(letters), JOINED)]
        for at in range(0, len(groups), 64):
            part = groups[at:at + 64]
            found = self.letters.encode_batch_fast([STOP.join(g) for g in part], add_special_tokens=False)
            for group, enc in zip(part, found):
                ids = np.array(enc.ids, dtype=np.uint32)
                stops = ids == self.stop
                lengths = np.diff(np.flatnonzero(stops), prepend=-1, append=len(ids)) - 1
                if len(lengths) == len(group) and (lengths > 0).all():
                    self.pieces.add(group, ids[~stops], lengths)
                else:  # a full stop that is no id of its own
                    alone.extend(group)
        self._encode_alone(alone, alone, self.pieces)

    def _learn_words(self, new: list[bytes]) -> None:
        # most words are ASCII letters, with a stop or without: lowered and decoded all at once
        letters = list(map(bytes.isalpha, new))
        plain = list(compress(new, letters))
        lone = _lowered(plain)
        stopped, mixed, cuts, others, raw = [], [], [], [], []
        for key in compress(new, map(not_, letters)):
            if key[-1:] in STOPS and key[:-1].isalpha():
                stopped.append(key)
                continue
            word = key.decode("utf-8")
            if PLAIN.fullmatch(word) and SPECIAL_START not in word:
                low = word.lower()
                mixed.append(key)
                cuts.append([low] if low.isalpha() else PIECES.findall(low))
            else:
                others.append(key)
                raw.append(word)
        stems, ends = _lowered([key[:-1] for key in stopped]), [key[-1:].decode() for key in stopped]
        if len(self.pieces.code) > MAX_PIECES:
            self.pieces = self.pieces.kept(MAX_PIECES // 2)
        known = self.pieces.code
        before = len(known)
        asked = chain(lone, stems, dict.fromkeys(ends), chain.from_iterable(cuts))
        self._learn_pieces([x for x in dict.fromkeys(asked) if x not in known])
        pairs = np.empty(2 * len(stopped), np.int64)
        pairs[::2] = np.fromiter(map(known.__getitem__, stems), np.int64, len(stems))
        pairs[1::2] = np.fromiter(map(known.__getitem__, ends), np.int64, len(ends))
        stream = np.concatenate([np.fromiter(map(known.__getitem__, lone), np.int64, len(lone)), pairs,
                                 np.fromiter(map(known.__getitem__, chain.from_iterable(cuts)), np.int64)])
        self.pieces.met(stream, before)
        ids, lengths = self.pieces.take(stream)
        n_pieces = np.concatenate([np.full(len(lone), 1), np.full(len(stopped), 2), np.fromiter(map(len, cuts), np.int64, len(cuts))])
        total = np.r_[0, np.cumsum(lengths)]
        ends = np.cumsum(n_pieces)
        self.words.add(plain + stopped + mixed, ids, total[ends] - total[ends - n_pieces])
        self._encode_alone(others, raw, self.words)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, id bounds of each text)."""
        words = W.split_words(texts, BLANKS)
        codes, distinct = words.distinct()
        if len(self.words.code) > MAX_PIECES:
            self.words = self.words.kept(MAX_PIECES // 2)
        known = self.words.code
        before = len(known)
        self._learn_words([x for x in distinct if x not in known])
        number = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        self.words.met(number, before)
        ids, lengths = self.words.take(number[codes])
        bounds = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])
        return ids, bounds[words.bounds]


@lru_cache(maxsize=2)
def piece_table(path: str) -> PieceTable:
    """One table per Python worker and tokenizer file; it outlives a task."""
    return PieceTable(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
