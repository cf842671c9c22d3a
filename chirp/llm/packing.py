"""Packing by Karmarkar-Karp multiway differencing.

A document is its token ids by the tokenizers library plus the end id.
Documents are cut into pieces: windows of ``capacity`` ids as long as they
last, the rest into near-equal pieces of at most ``piece`` ids. Pieces are
dealt at random (by a stored row number, so copies spread as well) to groups
of about GROUP_WINDOWS windows; inside a group the differencing method
merges partial partitions, largest with smallest load against each other,
until all windows are near-equal; while the fullest exceeds the capacity the
window count rises and the group is partitioned anew. Groups are
independent, so the work is spread over any number of tasks, and a group's
size is bounded by its tokens and by its pieces (GROUP_PIECES).

Ids by word: a word's ids do not depend on its neighbours, so each word met
for the first time by a Python worker is encoded by the library's model and
remembered. A chunk of texts is cut at white space and its distinct pieces
are found by Arrow; only they are looked up, and numpy gathers their ids into
the order of the texts.

Defined cases: a null or empty text is its end id alone; repeated rows are
packed each; an empty table gives an empty result; a null doc_id is packed
like any other; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from sys import byteorder

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirp.llm.bpe import Splitter, gathered, public_vocabulary
from chirp.llm.common import stored

CAPACITY = 4096
PIECE = 512
END_ID = 2
GROUP_WINDOWS = 256
GROUP_PIECES = 32_768
CHUNK_CHARS = 8_000_000
CACHE_WORDS = 400_000      # words, and pieces, a Python worker remembers; then it starts anew
SIGNS = ".,;:!?)(\"'-"      # signs that often end a piece


class _WordIds(dict):
    """word -> its ids as bytes, by the library's model on first use."""

    def __init__(self, split: Splitter):
        super().__init__()
        self.model, self.alphabet = split.library.model, split.from_bytes

    def __missing__(self, word: str) -> bytes:
        plain = word.isascii() and word.isprintable()
        spelled = word if plain else "".join(map(self.alphabet.__getitem__, word.encode("utf-8")))
        ids = array("I", [t.id for t in self.model.tokenize(spelled)])
        if byteorder == "big":
            ids.byteswap()
        self[word] = out = ids.tobytes()
        return out


class _PieceIds(dict):
    """What stands between white space -> its ids as bytes: one word, a word
    and the signs behind it, or words still to be cut."""

    def __init__(self, split: Splitter):
        super().__init__()
        self.words, self.cut = _WordIds(split), split.WORDS.findall

    def __missing__(self, piece: str) -> bytes:
        words = self.words
        word = piece.rstrip(SIGNS)
        if word.isalpha():
            out = words[word] + words[piece[len(word):]] if len(word) < len(piece) else words[word]
        else:
            out = b"".join(map(words.__getitem__, self.cut(piece)))
        self[piece] = out
        return out


class LibraryIds:
    """Token ids (little-endian unsigned 32 bit) of texts by the library."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.common = "\\A(?:" + self.split.COMMON.pattern + ")\\z"
        self.pieces = _PieceIds(self.split)

    def rare(self, text: str) -> bytes:
        """A text with characters or special tokens that the library cuts."""
        special = self.split.special
        return b"".join([np.array([special[w]], "<u4").tobytes() if w in special else self.pieces.words[w]
                         for w in self.split.words(text)])

    def texts(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: none). The pieces of all texts are
        found at once, each distinct piece is encoded once, and the ids are
        gathered into the order of the texts."""
        for known in (self.pieces, self.pieces.words):
            if len(known) > CACHE_WORDS:
                known.clear()
        common = pc.fill_null(pc.and_not(pc.match_substring_regex(texts, self.common), pc.match_substring(texts, "<|")), False)
        at = np.flatnonzero(common.to_numpy(zero_copy_only=False))
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts.take(pa.array(at))))
        pieces = lists.flatten().dictionary_encode()
        ids = list(map(self.pieces.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        known, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        code = pieces.indices.to_numpy(zero_copy_only=False)
        n = size[code]
        end = np.cumsum(n)
        flat = known[np.repeat(first[code] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
        bounds = np.r_[0, end][lists.offsets.to_numpy()]  # of the texts, in ids
        out = [None] * len(texts)
        for i, s, e in zip(at.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = flat[s:e].tobytes()
        for i, text in enumerate(out):
            if text is None:
                text = texts[i].as_py()
                out[i] = self.rare(text) if text else b""
        return out


_LIBRARIES: dict[str, LibraryIds] = {}


def _library(path: str) -> LibraryIds:
    """The Python worker's, kept from task to task."""
    if path not in _LIBRARIES:
        _LIBRARIES[path] = LibraryIds(path)
    return _LIBRARIES[path]


def _cuts(n: int, capacity: int, piece: int) -> list[int]:
    """Where a document of ``n`` ids is cut, 0 and n included."""
    full = n // capacity
    rest = n - full * capacity
    cuts = [i * capacity for i in range(full + 1)]
    k = -(-rest // piece)
    return cuts + [full * capacity + rest * i // k for i in range(1, k + 1)] if rest else cuts


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           piece: int = PIECE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, row, start, length, ids_crc32, doc_tokens[, ids]), a row for
    each piece; ``row`` numbers the pieces of all tasks."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        lib = _library(path)
        row = TaskContext.get().partitionId() << 33
        for b in gathered(batches, "text", CHUNK_CHARS):
            out = [[] for _ in range(6)]
            which, ids = [], []
            for n, data in enumerate(lib.texts(b.column("text"))):
                data += end
                total = len(data) // 4
                cuts = _cuts(total, capacity, piece)
                for s, e in zip(cuts[:-1], cuts[1:]):
                    which.append(n)
                    for o, v in zip(out, (row, s, e - s, zlib.crc32(data[4 * s:4 * e]), total)):
                        o.append(v)
                    row += 1
                    if with_ids:
                        ids.append(np.frombuffer(data[4 * s:4 * e], "<u4").astype(np.int32))
            cols = [b.column("doc_id").take(pa.array(which, pa.int64()))] + [pa.array(o, pa.int64()) for o in out[:5]]
            names = ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, row long, start long, length long, ids_crc32 long, doc_tokens long"
                           + (", ids array<int>" if with_ids else ""))


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size, by Karmarkar-Karp differencing into ``windows``
    parts. A partial partition is a vector of loads, largest first, with the
    items behind each load as a tree; the two partitions of largest spread
    are merged with opposing order until one is left."""
    n = len(sizes)
    heap = []
    for i in range(n):
        load, slot = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        load[0], slot[0] = sizes[i], i
        heap.append((-int(sizes[i]) if windows > 1 else 0, i, load, slot))
    heapq.heapify(heap)
    merges, made = [], n
    while len(heap) > 1:
        _, _, la, sa = heapq.heappop(heap)
        _, _, lb, sb = heapq.heappop(heap)
        load, b = la + lb[::-1], sb[::-1]
        slot = np.where(sa >= 0, sa, b)
        both = np.flatnonzero((sa >= 0) & (b >= 0))
        if len(both):
            new = np.arange(made, made + len(both))
            merges.append((new, sa[both], b[both]))
            slot[both] = new
        order = np.argsort(-load, kind="stable")
        load, slot = load[order], slot[order]
        load -= load[-1]  # only differences matter
        heapq.heappush(heap, (-int(load[0]), made, load, slot))
        made += max(1, len(both))
    owner = np.full(made + 1, -1, np.int64)
    last = heap[0][3]
    owner[last[last >= 0]] = np.flatnonzero(last >= 0)
    for new, a, b in reversed(merges):
        owner[a] = owner[new]
        owner[b] = owner[new]
    return owner[:n]


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each piece; no window exceeds ``capacity``. Full pieces are
    windows of their own."""
    full = sizes >= capacity
    out = np.empty(len(sizes), np.int64)
    out[full] = np.arange(full.sum())
    rest = sizes[~full]
    if len(rest):
        m = -(-int(rest.sum()) // capacity)
        while True:
            part = differencing(rest, m)
            load = np.bincount(part, rest, m)
            if load.max() <= capacity:
                break
            m += max(1, int((load.max() - capacity) * m // (4 * capacity)))
        out[~full] = part + full.sum()
    return out


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
         capacity: int = CAPACITY, piece: int = PIECE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[,
    ids]), a row for each piece."""
    cut = stored(pieces(docs, path or public_vocabulary(), doc_id, text, capacity, piece, end_id, with_ids), "pack_pieces")
    n, total = cut.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    groups = max(1, -(-total // (GROUP_WINDOWS * capacity)), -(-n // GROUP_PIECES))
    kind = cut.schema["doc_id"].dataType.simpleString()

    def run(key, pdf):
        pdf = pdf.sort_values("row", kind="stable").reset_index(drop=True)
        window = windows_of(pdf["length"].to_numpy(), capacity)
        pdf["sequence_id"] = (int(key[0]) << 32) + window
        pdf = pdf.iloc[np.argsort(window, kind="stable")]
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf.drop(columns=["g", "row"])

    more = ", ids array<int>" if with_ids else ""
    dealt = cut.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))
    out = dealt.groupBy("g").applyInPandas(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{more}, sequence_id long, offset long")
    return out


