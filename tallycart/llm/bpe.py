"""Byte-level BPE by corpus-level merge replay, and decoding.

The texts of a batch are cut into words by the tokenizer's pattern and each distinct word is encoded once for all its
places. All new words stand in one token array. An inverted index leads from a rank to the positions of the token pairs
that merge to it; ranks are taken from a heap, lowest first, every pair of that rank is merged in one numpy step, and only
the pairs with the neighbours of merged tokens are looked up anew. A rank that could give rise to a pair of lower rank
merges the leftmost place of a word at a time, so the result is that of the usual one-word-at-a-time loop for any rank file.

Encoded words are kept in a bounded memory per task. Texts are read whole; null counts as empty and has no ids. Special
tokens are plain text. Rows are independent: repeated ids and extra columns do no harm.
An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.common import pieces, texts_of

#: The pattern's class of everything else, the one place where classes stand in brackets.
OTHER = r"[^\s\p{L}\p{N}]"
#: Words whose ids a task keeps; beyond it the memory is emptied and filled anew.
KEPT_WORDS = 200_000
#: Characters of text in one replay.
STEP = 6 << 20
#: Up to so many positions of a rank are merged one by one.
FEW = 24


class Ranks:
    """A rank file: token bytes by id, and the rank that a pair of tokens merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
        ids = {token: rank for rank, token in self.tokens.items()}
        if len(ids) != len(pairs) or any(bytes([b]) not in ids for b in range(256)):
            raise ValueError(f"{path} isn't a byte-level rank file")
        self.byte_ids = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int64)
        left, right, merged = [], [], []
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                a, b = ids.get(token[:cut]), ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.size = max(self.tokens) + 1
        left_, right_, merged_ = (np.array(x, dtype=np.int64) for x in (left, right, merged))
        keys = left_ * self.size + right_
        order = np.argsort(keys)
        self.keys, self.merged = np.append(keys[order], np.iinfo(np.int64).max), np.append(merged_[order], -1)
        #: Ranks whose merge can make a pair of lower rank possible.
        self.turns_back = np.zeros(self.size, dtype=bool)
        self.turns_back[left_[merged_ < left_]] = True
        self.turns_back[right_[merged_ < right_]] = True
        self.turns_back_list = self.turns_back.tolist()

        self.of_pair = dict(zip(keys.tolist(), merged, strict=True))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, -1 if none."""
        keys = left * self.size + right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.merged[at], -1)


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


def replay(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and where each word's ids end."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    token = ranks.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    size = len(token)
    word = np.repeat(np.arange(len(words)), lengths)
    right = np.arange(1, size + 1)
    right[np.cumsum(lengths)[lengths > 0] - 1] = -1  # the last token of a word has no right neighbour
    left = np.arange(-1, size - 1)
    left[(np.cumsum(lengths) - lengths)[lengths > 0]] = -1
    alive = np.ones(size, dtype=bool)

    first = np.flatnonzero(right >= 0)
    found = ranks.pair_ranks(token[first], token[right[first]])
    first, found = first[found >= 0], found[found >= 0]
    order = np.argsort(found, kind="stable")
    first, found = first[order], found[order]
    edges = [*np.flatnonzero(np.diff(found, prepend=-1)).tolist(), len(found)]
    index: dict[int, list[np.ndarray]] = {int(found[a]): [first[a:b]] for a, b in zip(edges, edges[1:], strict=False)}
    heap = list(index)
    heapq.heapify(heap)
    few: dict[int, list[int]] = {}  # single positions, beside the arrays of the index
    tokens_, right_, left_, alive_, word_ = map(memoryview, (token, right, left, alive, word))

    def one_by_one(rank: int, places: list[int]) -> None:
        """Merge a handful of positions without numpy."""
        done = -1
        for p in places:
            q = right_[p]
            if not alive_[p] or q < 0 or ranks.of_pair.get(tokens_[p] * ranks.size + tokens_[q]) != rank:
                continue
            if ranks.turns_back_list[rank]:
                if word_[p] == done:
                    put(rank, p)
                    continue
                done = word_[p]
            tokens_[p], alive_[q] = rank, False
            after, before = right_[q], left_[p]
            right_[p] = after
            if after >= 0:
                left_[after] = p
                r = ranks.of_pair.get(rank * ranks.size + tokens_[after])
                if r is not None:
                    put(r, p)
            if before >= 0:
                r = ranks.of_pair.get(tokens_[before] * ranks.size + rank)
                if r is not None:
                    put(r, before)

    def put(rank: int, at: int) -> None:
        if rank in few:
            few[rank].append(at)
        else:
            few[rank] = [at]
            if rank not in index:
                heapq.heappush(heap, rank)

    def enter(at: np.ndarray) -> None:
        """Look up the pairs that start at these positions."""
        new = ranks.pair_ranks(token[at], token[right[at]])
        at, new = at[new >= 0], new[new >= 0]
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(new, kind="stable")
            at, new = at[order], new[order]
        cuts = [0, *(np.flatnonzero(new[1:] != new[:-1]) + 1).tolist(), len(new)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            rank = int(new[a])
            if rank in index:
                index[rank].append(at[a:b])
            else:
                index[rank] = [at[a:b]]
                if rank not in few:
                    heapq.heappush(heap, rank)

    while heap:
        rank = heapq.heappop(heap)
        lists, single = index.pop(rank, []), few.pop(rank, [])
        if len(single) + sum(map(len, lists)) <= FEW:
            one_by_one(rank, sorted({*single, *(p for x in lists for p in x.tolist())}))
            continue
        if single:
            lists.append(np.array(single))
        at = lists[0] if len(lists) == 1 and not single else np.unique(np.concatenate(lists))
        at = at[alive[at]]
        at = at[right[at] >= 0]
        at = at[ranks.pair_ranks(token[at], token[right[at]]) == rank]  # else a neighbour has changed since
        if not len(at):
            continue
        if ranks.turns_back[rank]:
            leading = np.append(True, word[at[1:]] != word[at[:-1]])
            if not leading.all():
                index[rank] = [at[~leading]]
                heapq.heappush(heap, rank)
                at = at[leading]
        elif len(at) > 1:
            joined = np.append(False, right[at[:-1]] == at[1:])  # a run of overlapping pairs: every other one, from the left
            if joined.any():
                place = np.arange(len(at))
                begin = np.maximum.accumulate(np.where(joined, 0, place))
                at = at[(place - begin) % 2 == 0]
        gone = right[at]
        token[at] = rank
        alive[gone] = False
        after = right[gone]
        right[at] = after
        has = after >= 0
        left[after[has]] = at[has]
        before = left[at]
        enter(np.unique(np.concatenate((before[before >= 0], at[has]))))
    kept = np.flatnonzero(alive)
    ends = np.cumsum(np.bincount(word[kept], minlength=len(words)))
    return token[kept], ends


class Splitter:
    """Cuts texts by the tokenizer's pattern. Texts of Latin-1 letters only take the standard engine with its classes of
    letters, numbers and spaces written out, which is faster and finds the same words."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern)
        self.latin = None
        if not re.search(r"\\[^sSpn]|\\p\{[^LN]|\[[^\]^]*\\", pattern.replace(OTHER, "")):
            own = {c: "".join(re.escape(chr(k)) for k in range(256) if regex.match(c, chr(k))) for c in (r"\s", r"\p{L}", r"\p{N}")}
            latin = pattern.replace(OTHER, f"[^{''.join(own.values())}]").replace(r"\S", f"[^{own[chr(92) + 's']}]")
            for c, members in own.items():
                latin = latin.replace(c, f"[{members}]")
            self.latin = re.compile(latin)

    def findall(self, text: str) -> list[str]:
        if self.latin is None:
            return self.any.findall(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any.findall(text)
        return self.latin.findall(text)


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Splitter:
    return Splitter(pattern)


class Encoder:
    """Encodes words and remembers them: for each, its ids as text, how many, and their bytes as decoded."""

    def __init__(self, path: str, pattern: str):
        self.ranks, self.split = load_ranks(path), splitter(pattern).findall
        self.known: dict[str, tuple[str, int, bytes]] = {}

    def learn(self, words: Iterable[str]) -> None:
        new = [w for w in set(words) if w not in self.known]
        if not new:
            return
        ids, ends = replay([w.encode("utf-8", "surrogatepass") for w in new], self.ranks)
        texts, tokens = list(map(str, ids.tolist())), [self.ranks.tokens[i] for i in ids.tolist()]
        begin = 0
        for word, end in zip(new, ends.tolist(), strict=True):
            self.known[word] = (",".join(texts[begin:end]), end - begin, b"".join(tokens[begin:end]))
            begin = end

    def encoded(self, texts: list[str]) -> Iterator[tuple[list[tuple[str, int, bytes]], str]]:
        cut = [self.split(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        self.learn(w for words in cut for w in words)
        for words, text in zip(cut, texts, strict=True):
            yield [self.known[w] for w in words], text

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.ranks.tokens.__getitem__, ids))


def tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, step: int = STEP) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the bytes they decode to, and the ids if wanted. ``path``
    is a rank file that every executor can open; a task holds the words of ``step`` characters at once."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {dict(slim.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in pieces(texts, step):
                counts, id_hashes, hashes, ids = [], [], [], []
                for words, _ in encoder.encoded(texts[a:b]):
                    listed = ",".join([w[0] for w in words])
                    counts.append(sum(w[1] for w in words))
                    id_hashes.append(hashlib.sha256(listed.encode()).hexdigest())
                    hashes.append(hashlib.sha256(b"".join([w[2] for w in words])).hexdigest())
                    if with_ids:
                        ids.append(np.array(listed.split(",") if listed else [], dtype=np.int32))
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(hashes, pa.string())]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else [], pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    return slim.mapInArrow(run, schema)
