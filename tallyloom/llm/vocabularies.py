"""Public tokenizers inside tasks, with a word's tokens remembered for the life of a Python worker.

Both tokenizers keep tokens inside words, so a text's tokens are those of its
words in turn, and a word that a worker has met before is only looked up.
Where that does not hold for a text, the library encodes the whole of it.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tallyloom.llm.words import located_words, raw_bytes

REMEMBERED = 1_000_000  # words a worker keeps; beyond that it starts anew


class _Memory(dict):
    def learn(self, words, encode) -> None:
        unknown = list(set(words).difference(self))
        if unknown:
            if len(self) + len(unknown) > REMEMBERED:
                self.clear()
                unknown = list(set(words))
            self.update(zip(unknown, encode(unknown)))


class PieceCounter:
    """Number of tokens of whole texts under a sentencepiece model.

    A piece holds the space sign only at its begin (checked once), so a text
    falls apart before each space.  Texts with runs of spaces, spaces at an
    end or the sign itself are encoded whole.
    """

    SIGN = "▁"

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.apart = not any(self.SIGN in p.lstrip(self.SIGN) for p in pieces) and self._adds_space()
        self.memory = _Memory()

    def _adds_space(self) -> bool:
        """Whether each word alone gets the space sign that it gets inside a text."""
        probe = "one two\nthree\tfour five"
        return self.model.normalize(probe) == "".join(self.SIGN + w for w in probe.split(" "))

    def _encode(self, words: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(words, num_threads=1)]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.apart:
            return [len(self.model.encode(t, num_threads=1)) for t in texts]
        split = []
        for t in texts:
            words = t.split(" ") if self.SIGN not in t else [""]
            split.append(None if "" in words else words)
        self.memory.learn([w for words in split if words for w in words], self._encode)
        get = self.memory.__getitem__
        return [sum(map(get, words)) if words else len(self.model.encode(t, num_threads=1)) if t else 0
                for t, words in zip(texts, split)]


class WordIds:
    """Ids of whole texts under a byte-level tokenizer that lowers case and drops white space.

    White space is never part of a token, so a text falls apart at it.  A
    word is found again by its 64-bit hash (see ``words``); a new word of
    letters, with or without marks behind it, goes straight to the merges,
    any other to the whole tokenizer.  Texts that might spell a special token
    are encoded whole.
    """

    MARKS = ".,!?;:*#$%&|-()"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.merges = self.model.model
        self.opens = [t.content[:2].lower().encode() for t in self.model.get_added_tokens_decoder().values()]
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = (b for b in range(256) if b not in same)
        self.written = {b: chr(256 + n) for n, b in enumerate(rest)}  # how the tokenizer writes single bytes
        probe = "One two,\nTHREE  four's schön naïve?! 12a"
        self.apart = self._whole(probe) == [i for w in probe.lower().split() for i in self._whole(w)]
        self.direct = all(self._word(w) == self._whole(w.decode()) for w in probe.lower().encode().split())
        self._forget()

    def _forget(self) -> None:
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes in order, place of each word
        self.flat, self.length = array("I"), array("I")

    def _numbers(self, distinct: np.ndarray, new_word) -> np.ndarray:
        """Places of words by their ``distinct`` hashes in order; ``new_word`` adds one that is not known."""
        at = np.searchsorted(self.known, distinct)
        found = np.zeros(len(distinct), bool)
        inside = at < len(self.known)
        found[inside] = self.known[at[inside]] == distinct[inside]
        numbers = np.empty(len(distinct), np.int32)
        numbers[found] = self.number[at[found]]
        new = np.flatnonzero(~found)
        for i in new:
            numbers[i] = len(self.length)
            new_word(i)
        if len(new):
            self.known = np.insert(self.known, at[new], distinct[new])
            self.number = np.insert(self.number, at[new], numbers[new])
        return numbers

    def _whole(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def _merged(self, part: str) -> list[int]:
        return [t.id for t in self.merges.tokenize(part.encode().decode("latin-1").translate(self.written))]

    def _word(self, word: bytes) -> list[int]:
        text = word.decode()
        base = text.rstrip(self.MARKS)
        if base.isalpha() and base == base.lower() and unicodedata.is_normalized("NFC", text):
            return self._merged(base) + (self._merged(text[len(base):]) if len(base) < len(text) else [])
        return self._whole(text)

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        data, cuts = raw_bytes(texts)
        for at, to, hashes, counts, begins, ends in located_words(data, cuts):
            if len(self.known) > REMEMBERED:
                self._forget()
            distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)

            def new_word(i: int) -> None:
                word = data[begins[first[i]]: ends[first[i]]].tobytes().lower()
                found = self._word(word) if self.direct else self._whole(word.decode())
                self.length.append(len(found))
                self.flat.extend(found)

            numbers = self._numbers(distinct, new_word)
            lengths = np.frombuffer(self.length, np.uint32).astype(np.int64) if self.length else np.zeros(0, np.int64)
            flat = np.frombuffer(self.flat, np.uint32) if self.flat else np.zeros(0, np.uint32)
            start = np.cumsum(lengths) - lengths
            of = numbers[which]
            size = lengths[of]
            upto = np.cumsum(size)
            ids = flat[np.repeat(start[of] - upto + size, size) + np.arange(int(upto[-1]) if len(upto) else 0)]
            bounds = np.concatenate([[0], upto])[np.concatenate([[0], np.cumsum(counts)])]
            del lengths, flat  # else the arrays cannot grow
            for i in range(to - at):
                text = data[cuts[at + i]: cuts[at + i + 1]].tobytes()
                if not self.apart or any(o in text.lower() for o in self.opens):
                    yield np.array(self._whole(text.decode()), np.uint32)
                else:
                    yield ids[bounds[i]: bounds[i + 1]]


@lru_cache(2)
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


@lru_cache(2)
def word_ids(path: str) -> WordIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def runs(texts: list, most: int = 4 << 20):
    """Slices of ``texts`` of about ``most`` characters or bytes."""
    begin = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= most:
            yield texts[begin: i + 1]
            begin, held = i + 1, 0
    if begin < len(texts):
        yield texts[begin:]
