"""BPE encoding and decoding with a pair occurrence index.

A text is normalised and cut into words (the merges of byte-pair encoding
never cross words), and each word met for the first time in a chunk of a
partition is encoded once, all new words together: an index maps each
mergeable pair to all its positions; the ranks that are active are applied
in ascending order, each to all its positions at once, and the lists of the
pairs that come into being are updated. A text's ids are its words' ids in
order. Decoding joins the ids' tokens as the tokenizers library does for a
tokenizer without decoder: with one space between them.

The vocabulary is a file of the tokenizers library, given by path (never
copied here), read once per Python worker. Texts of common Latin letters
take a path of Python's own string functions; any other text is normalised
and cut by the library's normalizer and pre-tokenizer. Special tokens in a
text become their ids, as the library does.

Defined cases: a null or empty text has no ids and decodes to the empty
text; ids, texts and rows repeat as they come; an empty table gives an empty
result; extra columns are carried by ``keep`` only.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 12_000_000   # texts held at a time by one task
CACHE_WORDS = 300_000      # words a Python worker remembers; then it starts anew


def public_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Splitter:
    """Normaliser and word splitter of a tokenizers file with the steps NFC,
    white space to one space, lower case; words by the pattern in the file."""

    # Letters whose lower case, NFC form and class agree between Python and
    # the library; any other character sends the text to the library.
    COMMON = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ¡«»¿–—‘’“”„…€]*")
    WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.spec = spec
        steps = spec["normalizer"]["normalizers"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        if ([s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or spec.get("decoder")
                or pattern != "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"):
            raise ValueError(f"{path}: not a vocabulary of the kind this splitter reads")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.from_bytes = byte_alphabet()
        self.to_bytes = {c: b for b, c in enumerate(self.from_bytes)}

    def _library_words(self, text: str) -> list[str]:
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.to_bytes.__getitem__, p)).decode("utf-8") for p, _ in pieces]

    def words(self, text: str | None) -> list[str]:
        """Words in order; a special token stands as its own string."""
        if not text:
            return []
        if "<|" in text and self.cut_special.search(text):
            out = []
            for part in self.cut_special.split(text):
                out += [part] if part in self.special else self.words(part)
            return out
        if self.COMMON.fullmatch(text):
            return self.WORDS.findall(text.lower())
        return self._library_words(text)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if (33 <= b <= 126) or (161 <= b <= 172) or (174 <= b <= 255)]
    out, extra = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]]


class PairIndex:
    """Encodes many words at once by ascending active ranks."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab = model["vocab"]
        suffix = model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        self.start = np.array([self.vocab[c] for c in alphabet], dtype=np.int64)
        self.start_last = np.array([self.vocab[c + suffix] for c in alphabet], dtype=np.int64)
        self.base = max(self.vocab.values()) + 2
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        code = np.array([self.vocab[a] * self.base + self.vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.pair = code                                   # by rank
        self.made = made
        order = np.argsort(code, kind="stable")
        self.codes, self.ranks = code[order], order

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for none; ids below 0 stand for no symbol."""
        code = a * self.base + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((self.codes[at] == code) & (a >= 0) & (b >= 0), self.ranks[at], -1)

    def encode(self, words: list[str]) -> list[np.ndarray]:
        if not words:
            return []
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        # one list of symbols, a gap (-1) before, between and after the words
        last = np.cumsum(size + 1)
        n = int(last[-1]) + 1
        gap = np.r_[0, last]
        is_symbol = np.ones(n, dtype=bool)
        is_symbol[gap] = False
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym = np.full(n, -1, dtype=np.int64)
        sym[is_symbol] = self.start[data]
        ends = (last - 1)[size > 0]
        sym[ends] = self.start_last[data[np.cumsum(size)[size > 0] - 1]]
        nxt, prv = np.arange(n) + 1, np.arange(n) - 1
        nxt[-1] = n - 1
        prv[0] = 0

        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def file(at: np.ndarray) -> None:
            """Puts positions into the lists of the pairs that start there."""
            rank = self._rank(sym[at], sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.r_[0, cut]].tolist(), np.split(at, cut)):
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(heap, r)
                lists[r].append(part)

        file(np.flatnonzero(is_symbol))
        while heap:
            r = heapq.heappop(heap)
            at = lists.pop(r)
            at = _distinct(np.concatenate(at) if len(at) > 1 else at[0])
            a, b = divmod(int(self.pair[r]), self.base)
            at = at[(sym[at] == a) & (sym[nxt[at]] == b)]
            if a == b and len(at) > 1:  # in a run like a a a every other pair merges, from the left
                joined = np.r_[False, nxt[at[:-1]] == at[1:]]
                run = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
                at = at[(np.arange(len(at)) - run) % 2 == 0]
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            sym[at] = self.made[r]
            sym[gone] = -2
            nxt[at] = after
            prv[after] = at
            before = prv[at]
            file(np.concatenate([before, at]))
        keep = np.flatnonzero(sym != -2)
        ids = sym[keep]
        cut = np.flatnonzero(ids == -1)
        return [ids[s + 1:e] for s, e in zip(cut[:-1], cut[1:])]


class _Words(dict):
    """word -> number, in the order of first use."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Encoder:
    """Encodes chunks of texts; remembers about CACHE_WORDS words."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.index = PairIndex(self.split.spec)
        self.tokens = {i: t for t, i in self.index.vocab.items()} | {i: t for t, i in self.split.special.items()}
        self.reset()

    def reset(self) -> None:
        self.numbers, self.ids, self.spelled, self.decoded, self.counts = _Words(), [], [], [], []

    def decode(self, ids) -> str:
        return " ".join(self.tokens[i] for i in ids)

    def _learn(self) -> None:
        new = list(self.numbers)[len(self.ids):]
        plain = self.index.encode([w for w in new if w not in self.split.special])
        plain = iter(plain)
        for w in new:
            ids = [self.split.special[w]] if w in self.split.special else next(plain).tolist()
            self.ids.append(ids)
            self.spelled.append(" ".join(map(str, ids)))
            self.decoded.append(self.decode(ids))
            self.counts.append(len(ids))

    def encode_chunk(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text the numbers of its words; all of them are learnt."""
        if len(self.numbers) > CACHE_WORDS:
            self.reset()
        numbers = [np.fromiter(map(self.numbers.__getitem__, self.split.words(t)), dtype=np.int64) for t in texts]
        self._learn()
        return numbers

    def encode(self, text: str | None) -> list[int]:
        return [i for n in self.encode_chunk([text])[0] for i in self.ids[n]]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The Python worker's encoder: later tasks find its words learnt."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def chunks(batches, column: str, chars: int = CHUNK_CHARS):
    """Record batches cut or joined to about ``chars`` characters of text."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < b.num_rows:
            done = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, done + chars, side="right")))
            yield b.slice(start, end - start)
            start = end


def gathered(batches, column: str, chars: int = CHUNK_CHARS):
    """Small record batches joined up to about ``chars``, as tables' batches."""
    held, size = [], 0
    for b in chunks(batches, column, chars):
        n = pc.sum(pc.binary_length(b.column(column))).as_py() or 0
        if held and size + n > chars:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if b.num_rows:
            held.append(b)
            size += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def encode_decode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
                  with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded])."""
    path = path or public_vocabulary()
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        import hashlib
        enc = encoder(path)
        for b in gathered(batches, "text"):
            numbers = enc.encode_chunk(b.column("text").to_pylist())
            counts = np.array(enc.counts, dtype=np.int64)
            sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
            n_tokens, ids_sha, dec_sha, ids, dec = [], [], [], [], []
            for n in numbers:
                at = n.tolist()
                n_tokens.append(int(counts[n].sum()))
                ids_sha.append(sha(" ".join(map(enc.spelled.__getitem__, at))))
                decoded = " ".join(map(enc.decoded.__getitem__, at))
                dec_sha.append(sha(decoded))
                if with_ids:
                    ids.append([i for w in at for i in enc.ids[w]])
                    dec.append(decoded)
            cols = [b.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(dec_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(dec, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>, decoded string" if with_ids else ""
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")


