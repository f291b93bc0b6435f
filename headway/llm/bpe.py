"""Byte-pair encoding and decoding with the vocabularies of public tokenizers.

A pre-token is a doubly linked list of symbols. A priority queue holds the merges that are
possible, by rank and then position; an entry whose pair is gone by the time it is taken is
stale and skipped. Decoding concatenates the vocabulary's strings.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import appended, chunks, mapped, read_small

#: Entries of a worker's cache; it starts anew beyond that, so memory is bounded.
CACHE_ENTRIES = 400_000
#: Longer pre-tokens are encoded each time.
CACHED_CHARS = 64


# Code points that this module's regular expressions take for letters, or for numbers, and the library takes for neither, as its
# tables are of an earlier Unicode version.
NOT_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 "
    "16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 "
    "1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NOT_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
# Capitals whose small letter the library knows and Python doesn't, as (first, last, distance).
CAPITALS = ((0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, -42343), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, -42561), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27))
SMALL = {c: c + step for first, last, step in CAPITALS for c in range(first, last + 1)}


def _members(ranges: str) -> str:
    """The inside of a character class."""
    return "".join("-".join(f"\\U{int(x, 16):08X}" for x in part.split("-")) for part in ranges.split())


#: Texts without any of these need no narrower classes.
RARE = regex.compile(f"[{_members(NOT_LETTERS)}{_members(NOT_NUMBERS)}]")
RARE_CAPITALS = regex.compile("[" + "".join(f"\\U{c:08X}" for c in SMALL) + "]")


def _latin(text: str) -> bool:
    """Has it only code points below 256, and so none of those above? This takes far less time than to look for them."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def narrowed(pattern: str) -> str:
    """The pattern with the library's letters and numbers."""
    letters, numbers = (f"[\\p{{{k}}}--[{_members(r)}]]" for k, r in (("L", NOT_LETTERS), ("N", NOT_NUMBERS)))
    return "(?V1)" + pattern.replace(r"\p{L}", letters).replace(r"\p{N}", numbers)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it is visible Latin-1, else the next code point from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 256
    for b in visible:
        out[b] = chr(b)
    for b in range(256):
        if not out[b]:
            out[b], spare = chr(spare), spare + 1
    return out


class Bpe:
    """A tokenizer read from the bytes of its JSON file.

    It holds what that format says: added tokens, the normaliser's NFC and lower-casing steps, the
    splitting pattern, the vocabulary and its merges, and an optional end-of-word mark.
    """

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        value = {c: b for b, c in enumerate(symbols)}
        self.end = model.get("end_of_word_suffix") or ""
        steps = self._types(spec.get("normalizer"))
        self.nfc, self.lower = "NFC" in steps, "Lowercase" in steps
        self.pattern = regex.compile(self._split(spec["pre_tokenizer"]))
        self.narrow = regex.compile(narrowed(self.pattern.pattern))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.single = [vocab[c] for c in symbols]
        self.last = [vocab[c + self.end] for c in symbols]
        #: (left id, right id) as one number -> rank and merged id as one number
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.strings: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for s, i in vocab.items():
            self.strings[i] = bytes(value[c] for c in s.removesuffix(self.end)) + b" " * bool(self.end and s.endswith(self.end))
        for s, i in self.special.items():
            self.strings[i] = s.encode()

    @staticmethod
    def _types(node: dict | None) -> set[str]:
        if not node:
            return set()
        return {node["type"]}.union(*(Bpe._types(x) for x in node.get("normalizers", [])))

    @staticmethod
    def _split(node: dict) -> str:
        for x in node.get("pretokenizers", [node]):
            if x["type"] == "Split":
                return x["pattern"]["Regex"]
            if x["type"] == "ByteLevel" and x.get("use_regex"):
                return r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        raise ValueError("no splitting pattern")

    def pieces(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """The text as (special token's id, []) and (None, pre-tokens), in order."""
        parts = [text]
        if self.special_pattern is not None and any(s in text for s in self.special):
            parts = self.special_pattern.split(text)
        for k, part in enumerate(parts):
            if k % 2:
                yield self.special[part], []
            elif part:
                if self.nfc:
                    part = unicodedata.normalize("NFC", part)
                if self.lower:  # code point by code point: a final sigma is no special case
                    part = part.replace("Σ", "σ").lower()
                rare = not _latin(part)
                if rare and self.lower and RARE_CAPITALS.search(part):
                    part = part.translate(SMALL)
                yield None, (self.narrow if rare and RARE.search(part) else self.pattern).findall(part)

    def merge(self, token: str) -> list[int]:
        """The ids of one pre-token."""
        raw = token.encode("utf-8", "surrogatepass")
        sym = [self.single[b] for b in raw]
        if not sym:
            return sym
        sym[-1] = self.last[raw[-1]]
        n, get = len(sym), self.merges.get
        heap = [found >> 20 << 32 | i for i in range(n - 1) if (found := get(sym[i] << 20 | sym[i + 1])) is not None]
        if not heap:
            return sym
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            left = sym[i]
            j = after[i]
            if left < 0 or j >= n:
                continue  # stale: this symbol went into another, or is the last now
            found = get(left << 20 | sym[j])
            if found is None or found >> 20 != top >> 32:
                continue  # stale: the pair here is another by now
            sym[i], sym[j] = found & 0xFFFFF, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := get(sym[i] << 20 | sym[k])) is not None:
                    heappush(heap, found >> 20 << 32 | i)
            h = before[i]
            if h >= 0 and (found := get(sym[h] << 20 | sym[i])) is not None:
                heappush(heap, found >> 20 << 32 | h)
        return [s for s in sym if s >= 0]

    def encode(self, text: str, cache: Cache | None = None) -> np.ndarray:
        cache = self.cache() if cache is None else cache
        out = [b"".join(map(cache.__getitem__, toks)) if special is None else np.int32(special).tobytes() for special, toks in self.pieces(text)]
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")

    def cache(self) -> Cache:
        return Cache(self)


class Cache(dict):
    """Pre-token -> its ids as the bytes of an int32 array; misses are encoded and kept up to a bound."""

    def __init__(self, model: Bpe):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> bytes:
        ids = np.array(self.model.merge(token), np.int32).tobytes()
        if len(token) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[token] = ids
        return ids


_loaded: dict[int, tuple[Bpe, Cache]] = {}


def loaded(data: bytes) -> tuple[Bpe, Cache]:
    """The tokenizer and its cache, kept for the life of this worker (it may serve many tasks)."""
    key = hash(data)
    if key not in _loaded:
        _loaded.clear()
        model = Bpe(data)
        _loaded[key] = model, model.cache()
    return _loaded[key]


def encode(df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids", keep_text: bool = True, decoded: str | None = None) -> DataFrame:
    """Append ``out``, the array of token ids of each whole ``text``; null and empty texts give an empty array.

    ``vocabulary`` is the path of a tokenizer's JSON file on the driver; its bytes (64 MB at most) are
    broadcast. Every row stays, with all its columns (``keep_text=False`` leaves the text out), so repeated
    rows give repeated results; a column named ``out`` is replaced. Special strings in a text are their special token, as in the library.
    With ``decoded``, a last column of that name has the text that the ids decode to, from the same worker.
    It is one map over partitions: no shuffle, and a lost task is run again.
    """
    data = df.sparkSession.sparkContext.broadcast(read_small(vocabulary))
    rest = df if keep_text else df.drop(text)
    schema, names = appended(rest.drop(decoded) if decoded else rest, out, T.ArrayType(T.IntegerType(), False))
    if decoded:
        schema.add(decoded, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = loaded(data.value)
        for batch in chunks(batches, text, 4 << 20):
            ids = [model.encode(t, cache) if t else np.empty(0, np.int32) for t in batch.column(text).to_pylist()]
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int64).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
            columns = [*(batch.column(c) for c in names), lists]
            if decoded:
                columns.append(pa.array([model.decode(x.tolist()) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return mapped(df, run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """Append ``out``, the text of each array of token ids: the vocabulary's strings one after the other.

    A null array gives a null text, an empty one an empty text; an id that the vocabulary lacks fails the
    query. Bytes that are no UTF-8 become U+FFFD. No shuffle.
    """
    data = df.sparkSession.sparkContext.broadcast(read_small(vocabulary))
    schema, names = appended(df if keep_ids else df.drop(ids), out, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = loaded(data.value)
        for batch in batches:
            column = batch.column(ids)
            flat = column.values.to_numpy(zero_copy_only=False)
            ends = column.offsets.to_numpy()
            null = column.is_null().to_pylist()
            texts = [None if null[i] else model.decode(flat[ends[i] : ends[i + 1]].tolist()) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, out])

    return mapped(df, run, schema)
