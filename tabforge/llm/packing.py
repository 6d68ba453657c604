"""Packing documents into fixed windows by online sum-of-squares placement."""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tabforge.llm.common import text_bytes

WINDOW = 1024
END_ID = 0
#: Open windows a task may hold; beyond it they are completed by cutting.
MAX_OPEN = 2048
OUT = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
       "offset long")
#: Fixed value: the public pattern of byte-level BPE's words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letter by which a vocabulary file of byte-level BPE writes each byte: printable
    Latin-1 stands for itself, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_encoder(path: str):
    """The byte-level BPE of a tokenizers JSON file, run by tiktoken, which gives the same ids
    (tested) at several times the speed."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in word): i for word, i in spec["model"]["vocab"].items()
             if word not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


class Packer:
    """Places pieces ``(doc, start, ids, doc_tokens)`` online; hands back finished windows.

    ``level[f]`` counts the open windows filled to ``f``.  A piece of ``s`` ids goes to the fill
    level (0: a new window) for which the sum of squared counts grows least, the fullest of equal
    ones.  Full windows are handed back at once.  When more than ``max_open`` are open, or at the
    end, the fullest windows are completed with ids cut from the emptiest, so at most one stays.
    """

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.n_open = 0

    def add(self, piece: tuple) -> list[list]:
        size, window = len(piece[2]), self.window
        if size == window:
            return [[piece]]
        fills = np.flatnonzero(self.level[:window - size + 1])
        fills = np.concatenate([[0], fills[fills > 0]])
        grown = fills + size
        cost = np.where(grown < window, 2 * self.level[grown] + 1, 0)
        cost = cost + np.where(fills > 0, 1 - 2 * self.level[fills], 0)
        fill = int(fills[len(fills) - 1 - np.argmin(cost[::-1])])
        held = []
        if fill:
            held = self.open[fill].pop()
            self.level[fill] -= 1
            self.n_open -= 1
        held.append(piece)
        return self._put(held, fill + size)

    def _put(self, held: list, fill: int) -> list[list]:
        if fill == self.window:
            return [held]
        self.open[fill].append(held)
        self.level[fill] += 1
        self.n_open += 1
        return self.complete() if self.n_open > self.max_open else []

    def complete(self) -> list[list]:
        """Fill the fullest open windows with ids cut from the emptiest."""
        row = [(f, held) for f in range(self.window - 1, 0, -1) for held in self.open[f]]
        self.level[:] = 0
        self.open = [[] for _ in range(self.window + 1)]
        self.n_open, done, j = 0, [], len(row) - 1
        i = 0
        while i < j:
            fill, held = row[i]
            while fill < self.window and i < j:
                less, donor = row[j]
                doc, start, ids, total = donor.pop()
                gap = self.window - fill
                held.append((doc, start, ids[:gap], total))
                fill += min(gap, len(ids))
                if len(ids) > gap:
                    donor.append((doc, start + gap, ids[gap:], total))
                row[j] = (less - min(gap, len(ids)), donor)
                if not donor:
                    j -= 1
            if fill == self.window:
                done.append(held)
                i += 1
            else:
                row[i] = (fill, held)
        if i == j and row[i][1]:
            fill, held = row[i]
            self.open[fill].append(held)
            self.level[fill] += 1
            self.n_open += 1
        return done

    def finish(self) -> list[list]:
        """All that is left: full windows, then the last one cut to powers of two, which need no
        padding."""
        done = self.complete()
        left = [p for f in range(self.window) for held in self.open[f] for p in held]
        total = sum(len(p[2]) for p in left)
        while total:
            room, part = 1 << (total.bit_length() - 1), []
            total -= room
            while room:
                doc, start, ids, n = left.pop(0)
                part.append((doc, start, ids[:room], n))
                if len(ids) > room:
                    left.insert(0, (doc, start + room, ids[room:], n))
                room -= min(room, len(ids))
            done.append(part)
        return done


def _encode(encoder, path: str, text: str) -> list[int]:
    """Ids of a text.  White space of a length that exhausts the encoder's pattern matcher goes to
    ``tokenizers``, which gives the same ids more slowly."""
    try:
        return encoder.encode(text, allowed_special="all")
    except ValueError:
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def _pack_task(path: str, window: int, end_id: int, max_open: int, id_type):
    def run(batches):
        encoder, packer = load_encoder(path), Packer(window, max_open)
        task = TaskContext.get()
        base, made = (task.partitionId() if task else 0) << 33, 0
        rows: list[tuple] = []

        def note(windows):
            nonlocal made
            for held in windows:
                offset = 0
                for doc, start, ids, total in held:
                    rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total,
                                 base + made, offset))
                    offset += len(ids)
                made += 1

        def take():
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = [id_type] + [pa.int64()] * 6
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            rows.clear()
            return batch

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                found = _encode(encoder, path, raw.decode())
                found.append(end_id)
                ids = np.array(found, "<u4")
                for start in range(0, len(ids), window):
                    note(packer.add((doc, start, ids[start:start + window], len(ids))))
                if len(rows) >= 8192:
                    yield take()
        note(packer.finish())
        yield take()

    return run


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
         max_open: int = MAX_OPEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    A document is its ids and then ``end_id``.  Documents over a window are cut at whole windows;
    what is left of each is placed by the sum-of-squares rule of :class:`Packer`.  Every task
    packs its own rows as they stream by, in one scan and without a shuffle; it holds the level
    array and at most ``max_open`` open windows.  A sequence id is the partition and a count
    within it, so a task that is run again after a loss gives the same rows.  Sequences shorter
    than ``window`` have a power of two of ids and are not padded.

    Null and empty texts are the end id alone; null ids and repeated rows are documents like any
    other; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    return docs.select(id_col, text_col).mapInArrow(
        _pack_task(tokenizer_path, window, end_id, max_open, id_type), f"doc {kind}, {OUT}"
    ).withColumnRenamed("doc", id_col)
