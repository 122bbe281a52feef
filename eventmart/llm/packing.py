"""Best-fit packing of tokenised documents into sequences of bounded length.

Tokenising and packing run in Arrow batches: the tokenizer is a library, and the packing rule
takes one bin after another.  Packing works on lengths alone, in partitions of bounded size, so
neither texts nor ids are shuffled.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import stored

CACHED_WORDS = 600_000  # entries that a worker keeps of each kind; then it starts anew

_CHUNK = re.compile(r"[^ \t\n\r\x0b\x0c]+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space for str.split alone
# One run of letters that every normalisation leaves alone but for case, then signs without an apostrophe.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch


class WordIds:
    """Ids of texts by a tokenizer that never joins across white space, with bounded caches of word forms.

    Most chunks between white space are a run of letters and perhaps signs behind it, which the
    tokenizer takes apart: the letters, in lower case, are looked up or encoded many at a time, and
    the ids are dealt back by the tokens that end a word.  Any other chunk is encoded as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self._tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocab = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self._cuts = bool(self._ends.any())
        self._chunks: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = [t.split() if _ODD_SPACE.search(t) is None else _CHUNK.findall(t) for t in texts]
        if len(self._chunks) > CACHED_WORDS:
            self._chunks = {}
        if len(self._words) > CACHED_WORDS:
            self._words = {}
        known = self._chunks
        self._learn([c for c in set().union(*split) if c not in known])
        return [b"".join(map(known.__getitem__, row)) for row in split]

    def _learn(self, chunks: list[str]) -> None:
        plain, parts = [], set()
        for c in chunks:
            if self._cuts and (m := _PLAIN(c)):
                letters, signs = m.groups()
                letters = letters.lower()
                plain.append((c, letters, signs))
                parts.add(letters)
                parts.add(signs)
            else:
                self._chunks[c] = self._ids(c).tobytes()
        parts.discard("")
        new = [p for p in parts if p not in self._words]
        for low in range(0, len(new), 2000):
            part = new[low : low + 2000]
            ids = self._ids(" ".join(part))
            cuts = (4 * (np.flatnonzero(self._ends[ids]) + 1)).tolist()
            if len(cuts) != len(part) or cuts[-1] != 4 * len(ids):
                raise ValueError("the tokenizer does not end each word by one token")
            data, start = ids.tobytes(), 0
            for word, stop in zip(part, cuts):
                self._words[word] = data[start:stop]
                start = stop
        self._words[""] = b""
        for c, letters, signs in plain:
            self._chunks[c] = self._words[letters] + self._words[signs]

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The word ids of a tokenizer, kept by a Python worker from task to task, so that it learns a word form once."""
    return WordIds(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows ``(doc_id, piece, start, length, ids)``: the ids of each document and an end id, cut at the capacity.

    A document that fits is one piece; a longer one is cut into full pieces and a last one.  A null
    text counts as empty (one piece with the end id alone).  Repeated rows give repeated pieces, a
    null id is kept.  ``ids`` are little-endian unsigned 32-bit numbers.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, end = word_ids(tokenizer), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.iloc[low : low + 256]
                out = []
                for doc_id, ids in zip(part["doc_id"], words.encode(part["text"].fillna("").tolist())):
                    ids += end
                    n = len(ids) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        out.append((doc_id, piece, start, min(capacity, n - start), ids[4 * start : 4 * (start + capacity)]))
                yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"]).astype({"doc_id": "Int64"})

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids binary")


def best_two_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """The bin and the place in it of each item.

    A bin is filled greedily with the largest items that fit.  Then its smallest item is replaced by
    the two unpacked items that fill the gap it leaves most tightly, if they fill it better than it
    did; this repeats while it helps.  Items of no length, or longer than the capacity, are refused.
    """
    if lengths and (min(lengths) < 1 or max(lengths) > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    for item in range(len(lengths) - 1, -1, -1):
        waiting[lengths[item]].append(item)
    open_sizes = 0  # bit n is set while an item of length n waits
    for n in range(capacity + 1):
        if waiting[n]:
            open_sizes |= 1 << n

    def largest(limit: int) -> int:
        return (open_sizes & ((2 << limit) - 1)).bit_length() - 1 if limit > 0 else 0

    def pair(limit: int) -> tuple[int, int]:
        best, found = 0, (0, 0)
        a = largest(limit - 1)
        while a > 0 and 2 * a > best:
            b = largest(min(a, limit - a))
            if b == a and len(waiting[a]) < 2:
                b = largest(a - 1)
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == limit:
                    break
            a = largest(a - 1)
        return found

    def take(n: int) -> int:
        nonlocal open_sizes
        item = waiting[n].pop()
        if not waiting[n]:
            open_sizes &= ~(1 << n)
        return item

    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    number = 0
    while open_sizes:
        held, gap = [], capacity
        while (n := largest(gap)) > 0:
            held.append((n, take(n)))
            gap -= n
        while gap:  # the greedy fill leaves the smallest item last; replacements keep that order
            smallest, item = held[-1]
            a, b = pair(gap + smallest)
            if a + b <= smallest:
                break
            held.pop()
            held += [(a, take(a)), (b, take(b))]
            waiting[smallest].append(item)
            open_sizes |= 1 << smallest
            held.sort(key=lambda x: -x[0])
            gap += smallest - a - b
        at = 0
        for n, item in held:
            bins[item], offsets[item] = number, at
            at += n
        number += 1
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    group_rows: int = 50_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents: rows ``(doc_id, piece, start, length, ids, sequence_id, offset)``.

    The pieces are dealt evenly, whatever their keys, into partitions of about ``group_rows``, and
    each partition is packed by ``best_two_fit``; that costs one partly filled sequence a
    partition.  Sequences are numbered by partition and bin.  An empty table gives no rows;
    null texts and repeated rows are handled as ``token_pieces`` says.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("key", F.monotonically_increasing_id()))
    groups = max(1, math.ceil(pieces.count() / group_rows))
    placed = pieces.select("key", "length").repartition(groups).mapInPandas(_packed(capacity, ["key"]), "key long, sequence_id long, offset long")
    return pieces.join(placed, "key").drop("key")


def pack_lengths(pieces: DataFrame, capacity: int = 2048, group_rows: int = 50_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to narrow rows with a ``length``, with no join: for pieces without ids."""
    groups = max(1, math.ceil(pieces.count() / group_rows))
    dealt = pieces.repartition(groups)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInPandas(_packed(capacity, dealt.columns), f"{schema}, sequence_id long, offset long")


def _packed(capacity: int, columns: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        rows = list(batches)
        if rows:
            table = pd.concat(rows, ignore_index=True)
            bins, offsets = best_two_fit(table["length"].tolist(), capacity)
            first = TaskContext.get().partitionId() << 32
            table["sequence_id"] = np.asarray(bins, "int64") + first
            table["offset"] = np.asarray(offsets, "int64")
            yield table[[*columns, "sequence_id", "offset"]]

    return run


def checksum(pieces: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``, their unsigned CRC-32."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
