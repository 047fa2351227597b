"""Encoding a corpus with a public byte-level BPE vocabulary (problem 8).

Corpus-level merge replay. A block of documents is cut into words by the vocabulary's
pattern; each distinct word is kept once as a chain of byte symbols. An inverted index
from symbol pair to word positions lists where each pair stands. The merges of the
vocabulary are then applied in rank order to all words of the block together: a merge
visits just the positions its pair is listed at, and enters just the two new neighbour
pairs into the index. Words do not depend on each other, so replaying a block gives the
same ids as replaying the whole corpus, and no shuffle is needed.

Defined results: null and empty text both give an empty list; text that looks like a
special token is plain text; blanks, control characters and any other code point are
encoded by their bytes; a word of any length is handled whole; repeated rows give
repeated results; an empty table gives an empty table. Further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the vocabulary files are; a parameter of every function that needs one.
VOCABULARY_DIR = "/opt/tokenizers"
#: Words kept with their ids by a task before it starts over.
MAX_WORDS = 1_000_000

# Fixed value: the pattern by which byte-level BPE vocabularies of this family cut words.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary file: printable
    Latin-1 characters stand for themselves, the other bytes for code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Byte symbols, and for each mergeable pair of ids its rank and the id it becomes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids = model["vocab"]
        letters = byte_letters()
        self.bytes = [ids[letters[b]] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self.by_rank = {rank: (pair, new) for pair, (rank, new) in self.merges.items()}
        self.words = regex.compile(PATTERN)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def replay(words: list[str], vocab: Vocabulary) -> list[np.ndarray]:
    """Ids of each word by replaying the merges in rank order over all words at once."""
    symbols: list[int] = []
    starts = [0]
    table = vocab.bytes
    for w in words:
        symbols += [table[b] for b in w.encode("utf-8", "surrogatepass")]
        starts.append(len(symbols))
    n = len(symbols)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    for s, e in zip(starts, starts[1:], strict=False):
        if e > s:
            before[s] = -1
            after[e - 1] = -1
    merges = vocab.merges
    index: dict[int, list[int]] = {}  # rank of a pair -> positions of its left symbol
    for i in range(n):
        j = after[i]
        if j > 0:
            hit = merges.get((symbols[i], symbols[j]))
            if hit is not None:
                index.setdefault(hit[0], []).append(i)
    queue = list(index)
    heapq.heapify(queue)
    while queue:
        rank = heapq.heappop(queue)
        positions = index.pop(rank, None)
        if positions is None:
            continue
        (a, b), new = vocab.by_rank[rank]
        positions.sort()
        for i in positions:
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # a neighbour was merged since
            symbols[i], symbols[j] = new, -1
            k, h = after[j], before[i]
            after[i] = k
            if k > 0:
                before[k] = i
                hit = merges.get((new, symbols[k]))
                if hit is not None:
                    if hit[0] not in index:
                        index[hit[0]] = []
                        heapq.heappush(queue, hit[0])
                    index[hit[0]].append(i)
            if h >= 0:
                hit = merges.get((symbols[h], new))
                if hit is not None:
                    if hit[0] not in index:
                        index[hit[0]] = []
                        heapq.heappush(queue, hit[0])
                    index[hit[0]].append(h)
    out = np.array(symbols, dtype=np.int32)
    keep = out >= 0
    ends = np.concatenate([[0], np.cumsum(keep)])
    flat = out[keep]
    return [flat[ends[s] : ends[e]] for s, e in zip(starts, starts[1:], strict=False)]


class BlockEncoder:
    """Encodes blocks of texts; words met in earlier blocks keep their ids."""

    def __init__(self, path: str, max_words: int = MAX_WORDS) -> None:
        self.vocab = vocabulary(path)
        self.max_words = max_words
        self._reset()

    def _reset(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.empty(0, dtype=np.int32)
        self.ends = np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        if len(self.number) > self.max_words:
            self._reset()
        number, find = self.number, self.vocab.words.findall
        chains, counts, new = [], [0], []
        for t in texts:
            words = find(t) if t else []
            for w in words:
                if w not in number:
                    number[w] = len(number)
                    new.append(w)
            chains.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
            counts.append(len(words))
        if new:
            got = replay(new, self.vocab)
            self.ids = np.concatenate([self.ids, *got])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(g) for g in got])])
        chain = np.concatenate(chains) if chains else np.empty(0, dtype=np.int64)
        first, size = self.ends[chain], self.ends[chain + 1] - self.ends[chain]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        where = np.arange(total) + np.repeat(first - (stop - size), size)
        bounds = np.concatenate([[0], stop])[np.cumsum(counts)]
        return bounds.astype(np.int64), self.ids[where]


def encode_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary_dir: str = VOCABULARY_DIR,
                  name: str = "byte_bpe_50k.json") -> DataFrame:
    """(key, ids array<int>) of every row of ``docs``."""
    path = f"{vocabulary_dir}/{name}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BlockEncoder(path)
        for batch in batches:
            bounds, ids = encoder.encode(batch.column(1).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(ids, type=pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def count_tokens(docs: DataFrame, keys: list[str], text: str = "text", vocabulary_dir: str = VOCABULARY_DIR,
                 name: str = "byte_bpe_50k.json") -> DataFrame:
    """(keys..., n_tokens int) of every row: sizes by the same replay, without the ids."""
    path = f"{vocabulary_dir}/{name}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BlockEncoder(path)
        for batch in batches:
            bounds, _ = encoder.encode(batch.column(len(keys)).to_pylist())
            sizes = pa.array(np.diff(bounds), type=pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), sizes],
                                             names=[*keys, "n_tokens"])

    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, text).mapInArrow(run, f"{fields}, n_tokens int")
