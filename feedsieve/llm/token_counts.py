"""Token counts by two finite-state transducers, without building the tokens.

The first reads classes of characters and writes where pre-tokens begin; the state
maps of its chunks compose through a parallel prefix scan (see ``pretokens``).

The second reads the bytes of one pre-token and writes, on each transition, by how
much the number of tokens grows. In byte-level BPE the last token of any prefix is
unique: it is the suffix that is a token and may follow the last token of what
comes before it, where two tokens may be neighbours if encoding their bytes gives the two
again. A state is thus what later bytes can still refer to: the bytes that may begin a
token to come, with the last token and the relative count at each place in them.
There are finitely many; they are compiled as they are met and remembered up to
a bound. Pre-tokens of any length take one transition per byte.

Null text is the empty text and has no tokens. Special strings inside a text are
one token each. Rows are independent: repeated rows give equal results, an empty
table an empty one. Only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsieve.llm.byte_level import read_json
from feedsieve.llm.common import slices, whole_text
from feedsieve.llm.pretokens import FENCE, split

SLICE_BYTES = 4 << 20
REMEMBERED = 300_000
LONG_WORD = 64
STATES_KEPT = 200_000

class WordTransducer:
    """Counts the tokens of one pre-token, a byte a transition."""

    START = -1

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.vocab = vocab
        self.token = {i: t for t, i in vocab.items()}
        self.merge_rank = {
            (vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)
        }
        self.prefixes = {t[:n] for t in vocab for n in range(1, len(t))}
        # When each token is made and of what; single bytes are there from the start.
        self.made = dict.fromkeys(vocab.values(), -1)
        self.parts = {}
        for (a, b), (rank, new) in self.merge_rank.items():
            self.made[new], self.parts[new] = rank, (a, b)
        self.neighbours: dict[int, bool] = {}
        self.whole = {t: i for t, i in vocab.items() if self.encode(t) == [i]}
        self._forget()

    def _forget(self) -> None:
        self.states = [(b"", ((0, self.START, 0),))]
        self.numbers = {self.states[0]: 0}
        self.step: dict[int, tuple[int, int]] = {}

    def encode(self, raw: bytes) -> list[int]:
        """Plain merging, for the few bytes of a token."""
        ids = [self.vocab[raw[i : i + 1]] for i in range(len(raw))]
        while len(ids) > 1:
            ranked = [
                (*self.merge_rank[p], i)
                for i, p in enumerate(zip(ids, ids[1:], strict=False))
                if p in self.merge_rank
            ]
            if not ranked:
                break
            _, new, i = min(ranked, key=lambda m: (m[0], m[2]))
            ids[i : i + 2] = [new]
        return ids

    def _may_follow(self, left: int, right: int) -> bool:
        if left == self.START:
            return True
        key = left << 20 | right
        known = self.neighbours.get(key)
        if known is None:
            if len(self.neighbours) > 1_000_000:
                self.neighbours.clear()
            known = self.neighbours[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether no merge joins the two across their border.

        Walks back in time: whichever of the two at the border was made later is
        replaced by its part at the border, which lived until then. Equal merges
        apply from the left.
        """
        made, parts, never = self.made, self.parts, len(self.merge_rank)
        left_until = right_until = never
        while True:
            joined = self.merge_rank.get((left, right))
            if joined is not None and joined[0] < left_until and joined[0] <= right_until:
                return False
            if made[left] > made[right]:
                left_until, left = made[left], parts[left][1]
            elif made[right] >= 0:
                right_until, right = made[right], parts[right][0]
            else:
                return True

    def _compile(self, number: int, byte: int) -> tuple[int, int]:
        tail, places = self.states[number]
        tail += bytes((byte,))
        last = grown = None
        still = []
        for back, before, count in places:
            begun = tail[len(tail) - back - 1 :]
            token = self.whole.get(begun)
            if last is None and token is not None and self._may_follow(before, token):
                last, grown = token, count + 1
            if begun in self.prefixes:
                still.append((back + 1, before, count))
        longest = max((s[0] for s in still), default=0)
        state = (
            tail[len(tail) - longest :],
            (*((b, t, c - grown) for b, t, c in still), (0, last, 0)),
        )
        to = self.numbers.get(state)
        if to is None:
            to = self.numbers[state] = len(self.states)
            self.states.append(state)
        self.step[number << 8 | byte] = found = (to, grown)
        return found

    def count(self, raw: bytes) -> int:
        if len(self.states) > STATES_KEPT:
            self._forget()
        state = total = 0
        step = self.step
        for byte in raw:
            found = step.get(state << 8 | byte)
            state, grown = found or self._compile(state, byte)
            total += grown
        return total


class Counter(dict):
    """Tokens by pre-token; what is not remembered runs through the transducer."""

    def __init__(self, path: str):
        vocab, merges, self.special = read_json(path)
        self.words = WordTransducer(vocab, merges)
        self[FENCE] = 0

    def __missing__(self, word: str) -> int:
        n = self.words.count(word.encode())
        if len(word) <= LONG_WORD:
            self[word] = n
        return n

    def texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self) > REMEMBERED:
            self.clear()
            self[FENCE] = 0
        extra = np.zeros(len(texts), np.int64)
        if any(s in t for s in self.special for t in texts):
            either = regex.compile("|".join(map(regex.escape, self.special)))
            parted = [either.subn(FENCE, t) for t in texts]
            texts, extra = [t for t, _ in parted], np.array([n for _, n in parted], np.int64)
        words, ends = split(texts, "tokenizers")
        counts = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        running = np.append(0, np.cumsum(counts))
        return np.diff(np.append(0, running[ends])) + extra


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(
    docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes and n_tokens of every text."""
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_json)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                size = pc.binary_length(part.column(1)).cast(pa.int64())
                tokens = pa.array(count.texts(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), size, tokens], names=schema.names)

    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    return texts.mapInArrow(run, schema)
