"""Byte-level BPE, encoding and decoding, with the vocabulary of a public tokenizer file.

A text is cut into words by the file's pre-tokenizer pattern. A short word holds its part boundaries and the ranks of
adjacent parts in one contiguous array: the smallest rank is found by scanning, its boundary deleted and the two ranks
beside it looked up anew, until no adjacent parts merge. Long words (over `LONG` bytes), where scanning would take the
square of the length, use a heap over the same ranks and give the same parts. Words that come again in a task are
taken from a table of bounded size. The special token's own text becomes its single id, as the library does by default.

Defined results: a null text is an empty one, with no tokens; decoding gives the text back, with U+FFFD for bytes that
are not UTF-8. Other columns pass through, but for names that start with `_bpe_`, which are the operator's own and replaced;
repeated rows give the same values; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.arrow import appended
from docloom.llm.common import own, tidy

#: The byte-level pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 128
#: Texts whose words are merged together.
STEP = 512
#: Where ids and texts go back to Spark, so many texts are merged together and so many words kept: less of a worker's memory.
LEAN_STEP, LEAN_TABLE = 128, 50_000
NONE = (1 << 31) - 1


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """A tokenizer read from the JSON text of its file."""

    def __init__(self, spec: str, table: int = 200_000):
        import regex

        read, letters = json.loads(spec), byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab = read["model"]["vocab"]
        self.pieces = {i: raw(t) for t, i in vocab.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in read["model"]["merges"]]
        self.rank = {}
        for r, (a, b) in enumerate(merges):
            self.rank.setdefault(raw(a + b), r)
        self.id = {raw(t): i for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in read.get("added_tokens", [])}
        self.pieces |= {i: t.encode() for t, i in self.special.items()}
        self.piece_list = [self.pieces.get(i, b"") for i in range(max(self.pieces) + 1)]
        self.byte_ids = np.array([self.id[bytes([b])] for b in range(256)], "<u4")
        pairs = {(self.id[raw(a)] << 20) | self.id[raw(b)]: r for r, (a, b) in reversed([*enumerate(merges)])}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[int(k)] for k in self.pair_keys], np.int32)
        self.merged = np.array([self.id[raw(a + b)] for a, b in merges], "<u4")
        self.cut = regex.compile(PATTERN).findall
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.table, self.most = {}, table

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank at which two adjacent parts merge, or NONE."""
        key = (left.astype(np.int64) << 20) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def _short(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of about one length, each a row of a contiguous array; all rows take their next merge at once."""
        n = np.array([len(w) for w in words])
        width, rows = int(n.max()), len(words)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(rows, width)
        ids, cols = self.byte_ids[raw], np.arange(width)
        ranks = np.full((rows, width), NONE, np.int32)
        ranks[:, :-1] = np.where(cols[1:] < n[:, None], self._ranks(ids[:, :-1], ids[:, 1:]), NONE)
        done, live = [b""] * rows, np.arange(rows)
        while len(live):
            k = ranks.argmin(1)
            least = ranks[np.arange(len(live)), k]
            for i in np.flatnonzero(least == NONE):
                done[live[i]] = ids[i, : n[i]].tobytes()
            go = least < NONE
            live, ids, ranks, n, k, least = live[go], ids[go], ranks[go], n[go] - 1, k[go], least[go]
            if not len(live):
                break
            at = np.arange(len(live))
            after = cols > k[:, None]
            ids[:, :-1] = np.where(after[:, :-1], ids[:, 1:], ids[:, :-1])  # the boundary after part k goes
            ranks[:, :-1] = np.where(after[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ids[at, k] = self.merged[least]
            last = np.minimum(k + 1, width - 1)
            ranks[at, k] = np.where(k + 1 < n, self._ranks(ids[at, k], ids[at, last]), NONE)
            left = np.flatnonzero(k > 0)
            ranks[left, k[left] - 1] = self._ranks(ids[left, k[left] - 1], ids[left, k[left]])
        return done

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of words that the table lacks."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out, order = [b""] * len(raw), sorted(range(len(raw)), key=lambda i: len(raw[i]))
        i = 0
        while i < len(order):
            size = len(raw[order[i]])
            if size > LONG:
                out[order[i]] = b"".join(self.id[p].to_bytes(4, "little") for p in self._long(raw[order[i]]))
                i += 1
                continue
            j = i
            while j < len(order) and j - i < 8192 and len(raw[order[j]]) <= min(LONG, size + size // 4 + 1):
                j += 1
            for k, ids in zip(order[i:j], self._short([raw[k] for k in order[i:j]]), strict=True):
                out[k] = ids
            i = j
        return out

    def _long(self, word: bytes) -> list[bytes]:
        get, n = self.rank.get, len(word)
        end, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2], NONE)) != NONE]
        heapq.heapify(heap)
        live = [True] * n
        while heap:
            r, i, to = heapq.heappop(heap)
            if not live[i] or end[i] >= n or end[end[i]] != to:
                continue
            live[end[i]] = False
            end[i] = to
            if to < n:
                before[to] = i
                if (r := get(word[i : end[to]], NONE)) != NONE:
                    heapq.heappush(heap, (r, i, end[to]))
            if i and (r := get(word[before[i] : to], NONE)) != NONE:
                heapq.heappush(heap, (r, before[i], to))
        out, i = [], 0
        while i < n:
            out.append(word[i : end[i]])
            i = end[i]
        return out

    def cuts(self, text: str) -> list[list[str]]:
        """The words of each stretch between special tokens; a special token is a stretch of its own, of one word."""
        if not self.special or not any(s in text for s in self.special):
            return [self.cut(text)]
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [self.cut(text[at : m.start()]), [m[0]]]
            at = m.end()
        return [*out, self.cut(text[at:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        stretches = [self.cuts(t) for t in texts]
        table = self.table
        if len(table) > self.most:
            table.clear()
        fresh = list({w for s in stretches for k, words in enumerate(s) if k % 2 == 0 for w in words if w not in table})
        table.update(zip(fresh, self.learn(fresh), strict=True))
        get, out = table.__getitem__, []
        for s in stretches:
            out.append(b"".join(self.special[words[0]].to_bytes(4, "little") if k % 2 else b"".join(map(get, words)) for k, words in enumerate(s)))
        for w in fresh:
            if len(w) > LONG:
                del table[w]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of such ids."""
        return b"".join(map(self.piece_list.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def load(spec: str, table: int = 200_000) -> BytePairs:
    return BytePairs(spec, table)


def encode_texts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The documents with `_bpe_ids` (binary, little-endian unsigned 32-bit) and `_bpe_text` (what the ids decode to).

    `tokenizer`: path of the JSON file as the driver sees it; its text (1.6 MB, whatever the corpus) is broadcast.
    """
    docs = own(docs, "_bpe_")
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        pairs = load(spec.value, LEAN_TABLE)
        for batch in batches:
            for start in range(0, batch.num_rows, LEAN_STEP):
                part = batch.slice(start, LEAN_STEP)
                ids = pairs.encode([t or "" for t in part.column(part.schema.names.index("text")).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary()), pa.array([pairs.decode(i) for i in ids], pa.string())], names=[*part.schema.names, "_bpe_ids", "_bpe_text"])
        pairs.table.clear()

    return docs.mapInArrow(tidy(run), appended(docs, "_bpe_ids binary, _bpe_text string"))


def token_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Counts and digests of ids and decoded text; only these leave the Python workers, never the ids themselves."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        pairs = load(spec.value)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for ids in (i for start in range(0, batch.num_rows, STEP) for i in pairs.encode([t or "" for t in batch.column(1).slice(start, STEP).to_pylist()])):
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(pairs.decode(ids).encode("utf-8", "replace")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        pairs.table.clear()

    return docs.select("doc_id", "text").mapInArrow(tidy(run), appended(docs.select("doc_id"), "n_tokens bigint, ids_sha256 string, decoded_sha256 string"))


def op7_bpe(docs: DataFrame) -> DataFrame:
    """The contract's view."""
    return token_digests(docs)
