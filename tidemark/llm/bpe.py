"""BPE encoding and decoding (operator 10) for tokenizer files whose words end
in a suffix and whose white space is dropped.

A text is normalised, cut into words, and each distinct word is merged once:

* Short words (up to ``SHORT`` bytes) of one length are encoded together. Each
  holds a contiguous row of parts (the boundaries) and a contiguous row of the
  ranks of adjacent parts. The row's minimum is found by scanning, its boundary
  deleted, and the two neighbouring ranks looked up again, until no adjacent
  pair has a rank. The leftmost minimum goes first.
* A longer word has a heap over a linked list of parts, so a text that is one
  word of megabytes stays n log n.

Ids are kept as little-endian unsigned 32-bit bytes per word, and a text's ids
are its words' bytes joined. White space between words never changes a word's
ids, so a bounded cache of words serves all texts of a worker.

Defined results: a null text counts as empty and has no ids, and its decoded
text is empty; strings of special tokens in a text are their ids; repeated rows
give repeated results; an empty table gives an empty result; only doc_id and
text are read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import flat

SHORT = 48
GROUP = 4096
CACHE_WORDS = 600_000
NO_RANK = np.int32(2**31 - 1)
END = b"\xff\xff\xff\xff"  # after each word's ids while words are learned; no id is that large

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a
    visible Latin-1 character, else the next free one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(free)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if not (split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]):
            raise ValueError("the file's words are not those its pattern matches")
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalizer steps {steps}")
        self.pieces_of = regex.compile(
            r"\n|" + split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_bytes = [t.encode() for t in self.special]
        self.special_at = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        names = dict.fromkeys(vocab.values())
        names.update((i, s.encode()) for s, i in vocab.items())
        names.update((i, s.encode()) for s, i in self.special.items())
        self.names = names
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {"\n": END}

    # ---- words

    def split(self, words: list[bytes]) -> list[str]:
        """The normalised pieces of words without ASCII white space, in order,
        a line feed after each word. All words go through one string: no step
        of the normalizer reaches across a line feed."""
        text = unicodedata.normalize("NFC", b"\n".join(words).decode() + "\n")
        # a lower-case sigma does not depend on its neighbours here
        return self.pieces_of.findall(text.replace("\u03a3", "\u03c3").lower())

    def split_special(self, word: bytes) -> bytes:
        """Ids of a word that has strings of special tokens in it."""
        out = []
        for k, part in enumerate(self.special_at.split(word.decode())):
            if k % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                out += self.learn_pieces(self.split([part.encode()]))[:-1]
        return b"".join(out)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def _short(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces that have one length, merged together."""
        n, m = len(pieces[0]), len(pieces)
        raw = np.frombuffer(b"".join(pieces), np.uint8).reshape(m, n)
        parts = self.inner[raw]
        parts[:, -1] = self.last[raw[:, -1]]
        out: list[bytes] = [b""] * m
        row = np.arange(m)
        rank = self.rank(parts[:, :-1], parts[:, 1:])
        while True:
            width = parts.shape[1]
            if width > 1:
                at = rank.argmin(1)
                best = rank[np.arange(len(row)), at]
                ended = best == NO_RANK
            else:
                ended = np.ones(len(row), bool)
            if ended.any():
                ids = parts[ended].astype("<u4")
                for r, one in zip(row[ended].tolist(), ids):
                    out[r] = one.tobytes()
                going = ~ended
                if not going.any():
                    return out
                row, parts, rank, at, best = (row[going], parts[going], rank[going], at[going],
                                              best[going])
            # every row loses one boundary, so rows keep one common width
            lines, col = np.arange(len(row)), np.arange(width - 1)
            after = col[None, :] > at[:, None]
            parts[lines, at] = self.merged[best]
            parts = np.where(after, parts[:, 1:], parts[:, :-1])
            if width == 2:
                continue
            rank = np.where(after[:, :-1] | (col[None, :-1] == at[:, None]),
                            rank[:, 1:], rank[:, :-1])
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.rank(parts[has, at[has] - 1], parts[has, at[has]])
            has = np.flatnonzero(at < width - 2)
            rank[has, at[has]] = self.rank(parts[has, at[has]], parts[has, at[has] + 1])

    def _long(self, piece: bytes) -> bytes:
        """Ids of one long piece: a heap of (rank, position) over linked parts."""
        raw = np.frombuffer(piece, np.uint8)
        part = self.inner[raw].tolist()
        part[-1] = int(self.last[raw[-1]])
        n = len(part)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        get = self.rank_of.get
        heap = [(r, i, part[i], part[i + 1]) for i in range(n - 1)
                if (r := get(part[i] << 32 | part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue
            part[i], part[j] = int(self.merged[r]), -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if (s := get(part[i] << 32 | part[k])) is not None:
                    heapq.heappush(heap, (s, i, part[i], part[k]))
            h = before[i]
            if h >= 0 and (s := get(part[h] << 32 | part[i])) is not None:
                heapq.heappush(heap, (s, h, part[h], part[i]))
        return np.array([p for p in part if p >= 0], "<u4").tobytes()

    def learn_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; those of new ones are merged and cached."""
        new = sorted((p.encode() for p in set(pieces).difference(self.pieces)), key=len)
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        lo = 0
        while lo < len(new):
            length = int(lengths[lo])
            hi = min(lo + GROUP, int(np.searchsorted(lengths, length, side="right")))
            some = new[lo:hi]
            ids = self._short(some) if length <= SHORT else map(self._long, some)
            self.pieces.update(zip([x.decode() for x in some], ids))
            lo = hi
        return list(map(self.pieces.__getitem__, pieces))

    def learn(self, words: set[bytes]) -> None:
        """Put the ids of new words into the cache."""
        if len(self.words) + len(words) > CACHE_WORDS:
            self.words.clear()
        if len(self.pieces) > CACHE_WORDS:
            self.pieces = {"\n": END}
        plain, marked = list(words), []
        if any(s in b"\n".join(plain) for s in self.special_bytes):
            marked = [w for w in plain if any(s in w for s in self.special_bytes)]
            plain = list(words.difference(marked))
        ids = b"".join(self.learn_pieces(self.split(plain)))
        ends = (4 * np.flatnonzero(np.frombuffer(ids, "<u4") == 0xFFFFFFFF)).tolist()
        starts = [0, *[e + 4 for e in ends]]
        self.words.update((w, ids[a:b]) for w, a, b in zip(plain, starts, ends))
        for w in marked:
            self.words[w] = self.split_special(w)

    # ---- texts

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts, each as little-endian unsigned 32-bit bytes."""
        cut = [t.split() for t in texts]
        new = set().union(*cut).difference(self.words)
        if new:
            if len(self.words) + len(new) > CACHE_WORDS:
                new = set().union(*cut)  # the cache is emptied first
            self.learn(new)
        get = self.words.__getitem__
        return [b"".join(map(get, c)) for c in cut]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids: the tokens' strings separated by spaces, as a
        file without a decoder has it; ids without a token are left out."""
        names = map(self.names.get, np.frombuffer(ids, "<u4").tolist())
        return b" ".join([s for s in names if s is not None])


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """The worker's tokenizer of a file."""
    return WordBpe(path)


def text_list(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    data, offsets = flat(texts)
    raw, at = data.tobytes(), offsets.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


GROUP_TEXTS = 512


def _round_trip(path: str):
    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = text_list(batch.column(1))
            n_tokens, encoded, decoded = [], [], []
            for lo in range(0, len(texts), GROUP_TEXTS):
                for ids in bpe.encode(texts[lo: lo + GROUP_TEXTS]):
                    n_tokens.append(len(ids) // 4)
                    encoded.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_tokens, pa.int64()), pa.array(encoded, pa.string()),
                 pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def _encode(path: str):
    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = text_list(batch.column(1))
            for lo in range(0, len(texts), GROUP_TEXTS):
                ids = [np.frombuffer(x, "<u4").astype(np.int32)
                       for x in bpe.encode(texts[lo: lo + GROUP_TEXTS])]
                sizes = np.cumsum([0, *map(len, ids)])
                values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(ids)),
                     pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)],
                    names=["doc_id", "ids"])
    return run


def _decode(path: str):
    def run(batches):
        bpe = tokenizer(path)
        for batch in batches:
            texts = [bpe.decode(np.array(ids or [], "<u4").tobytes()).decode()
                     for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return run


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of each document."""
    return _input(docs).mapInArrow(_encode(path), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them."""
    return _input(docs).mapInArrow(_round_trip(path), SCHEMA)
