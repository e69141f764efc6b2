"""Sum-of-squares packing of tokenised documents into fixed windows.

Each task packs the documents of its own part of the table as they come, so nothing is
shuffled and no state outlives a task; a repeated task gives the same windows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Window length, and the id that ends every document.
WINDOW, END_ID = 2048, 1
#: Words whose ids a worker remembers, and the longest such word in bytes.
REMEMBERED, LONGEST = 600_000, 48
#: Documents that go to a worker at once: of whole texts, a batch is held several times over by the executor and the worker.
BATCH_ROWS = 1000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


class WordEncoder(dict):
    """Word (UTF-8 bytes) to its ids as little-endian 32-bit bytes, for tokenizers that drop white space.

    Such a tokenizer treats the words between white space one by one, so ids are looked up
    by word and only new words are encoded. Words of Latin letters, with a full stop or
    comma at most, go to the tokenizer's model directly, if probes show that this gives
    the ids of the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.byte_chars = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.tail = {"": b"", ".": self._whole("."), ",": self._whole(",")}
        probes = ["reading", "Straße", "éCOLE", "ñandú", "ÜBER", "x", "WORTHLESSNESS", "don"]
        self.direct = all(self._letters(p) + self.tail[t] == self._whole(p + t) for p in probes for t in self.tail)

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        word = word.lower()
        if not word.isascii():
            word = "".join(self.byte_chars[b] for b in word.encode())
        return self._pack([t.id for t in self.tokenizer.model.tokenize(word)])

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        plain = _PLAIN.fullmatch(text) if self.direct else None
        if plain:
            body = plain[1].encode()
            known = self.get(body) or self._letters(plain[1])
            ids = known + self.tail[plain[2]]
        else:
            body, known, ids = word, b"", self._whole(text)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[body] = known or ids
            self[word] = ids
        return ids

    def text_ids(self, text: bytes) -> bytes:
        """The ids of a whole text; white space is what ASCII calls so, other kinds are left to the tokenizer."""
        return b"".join(map(self.__getitem__, text.split()))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class LevelPacker:
    """Open windows by fill level; ``counts[h]`` windows are filled up to h.

    An item of s ids goes to the level h for which the sum of squared counts is least
    afterwards: moving a window from h to h+s changes it by 2(counts[h+s] - counts[h]) + 2,
    filling one up by 1 - 2 counts[h], opening one by 2 counts[s] + 1. Ties go to the
    fullest level.
    """

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list]] = {}

    def place(self, size: int, item) -> list | None:
        """Put an item of 1..window-1 ids into a window; the window's items if that fills it."""
        counts, window = self.counts, self.window
        levels = np.flatnonzero(counts[1:window - size + 1]) + 1
        best, level = 2 * counts[size] + 1, 0
        if levels.size:
            after = levels + size
            change = 2 * (counts[after] - counts[levels]) + 2
            change[after == window] -= 1
            k = change.size - 1 - int(np.argmin(change[::-1]))
            if change[k] <= best:
                level = int(levels[k])
        if level:
            held = self.open[level].pop()
            counts[level] -= 1
        else:
            held = []
        held.append(item)
        if level + size == window:
            return held
        counts[level + size] += 1
        self.open.setdefault(level + size, []).append(held)
        return None

    def rest(self) -> Iterator[list]:
        """The windows that stayed open, the fullest first."""
        for level in sorted(self.open, reverse=True):
            yield from self.open[level]


def pack_stream(docs: Iterator[tuple], window: int, first: int) -> Iterator[tuple]:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for (doc_id, ids) in turn.

    A document's full windows stand alone, the rest of it is placed by LevelPacker. What is
    still open at the end is laid end to end and cut into full windows; the last ids are cut
    into powers of two, which need no padding.
    """
    packer, number = LevelPacker(window), first

    def row(item, length, at, sequence, offset):
        doc_id, ids, start, total = item
        part = ids[4 * at:4 * (at + length)]
        return doc_id, start + at, length, zlib.crc32(part), total, sequence, offset

    for doc_id, ids in docs:
        total = len(ids) // 4
        cut = total - total % window
        for at in range(0, cut, window):
            yield row((doc_id, ids, 0, total), window, at, number, 0)
            number += 1
        if total > cut:
            full = packer.place(total - cut, (doc_id, ids[4 * cut:], cut, total))
            if full:
                offset = 0
                for item in full:
                    n = len(item[1]) // 4
                    yield row(item, n, 0, number, offset)
                    offset += n
                number += 1
    items = [item for held in packer.rest() for item in held]
    left = sum(len(item[1]) // 4 for item in items)
    room, used = 0, 0
    for item in items:
        at, n = 0, len(item[1]) // 4
        while at < n:
            if used == room:
                room, used = (window if left >= window else 1 << (left.bit_length() - 1)), 0
                number += 1
            take = min(n - at, room - used)
            yield row(item, take, at, number - 1, used)
            at, used, left = at + take, used + take, left - take


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the end id alone. Repeated rows are packed each for itself; null
    ids are kept; an empty table gives an empty result. ``tokenizer`` is the path of a
    tokenizer file that drops white space and can be read on every executor. Only doc_id
    and text are read. Memory holds the open windows of a task, whose number does not grow
    with the table, and a few batches: the session's Arrow batches are lowered to ``BATCH_ROWS``
    rows if they are larger, and stay so, as the rows are packed when the result is read.
    """
    conf, rows_at_once = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(rows_at_once)) <= BATCH_ROWS:
        conf.set(rows_at_once, str(BATCH_ROWS))

    def run(batches):
        pa.default_memory_pool().release_unused()  # what earlier stages left behind in this worker
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 40

        def ids():
            for batch in batches:
                texts = batch.column("text").cast(pa.binary())
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                    text = text.as_py()
                    yield doc_id, (encode.text_ids(text) if text else b"") + end

        names = [x.split()[0] for x in SCHEMA.split(", ")]
        rows = []
        for r in pack_stream(ids(), window, first):
            rows.append(r)
            if len(rows) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(run, SCHEMA)
