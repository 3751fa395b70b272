"""Byte-level BPE encoding with a pair occurrence index, and decoding.

The different pretokens of a slice of documents lie in one array of symbols. An index maps
each mergeable pair (by its rank) to all its positions. Active ranks are applied in
ascending order; each merge updates the lists of the pairs to its left and right.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import ship_package

# Fixed values of the byte-level format: the pattern that cuts texts into pretokens.
PRETOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
            r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
# A text may be cut before a single space between two other characters: no pretoken spans it.
CUT = r"(?<=\P{White_Space})(?= \P{White_Space})"

SLICE_CHARS = 2_000_000
# Ranks below this are applied to all their positions as arrays, the others one by one.
LONG_LISTS = 500
# Pretokens that a worker remembers (about 200 bytes each).
CACHE_WORDS = 700_000


def _byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    spare = iter(range(256, 512))
    out.update({chr(next(spare)): b for b in range(256) if b not in set(plain)})
    return out


class BpeTables:
    """Vocabulary and merges of a byte-level BPE file, read on the driver and broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = _byte_symbols()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces: dict[int, bytes] = {}
        for s, i in vocab.items():
            pieces[i] = bytes(symbols[c] for c in s) if all(c in symbols for c in s) else s.encode()
        for s, i in self.special.items():
            pieces[i] = s.encode()
        parts = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.byte_ids = np.zeros(256, np.int64)
        for c, b in symbols.items():
            self.byte_ids[b] = vocab[c]
        left, right, new = [], [], []
        for merge in spec["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            new.append(vocab[a + b])
        self.left, self.right, self.new = left, right, new
        keys = np.array(left, np.int64) << 20 | np.array(right, np.int64)
        self.ranks = {int(k): r for r, k in reversed(list(enumerate(keys.tolist())))}
        self.keys = np.array(sorted(self.ranks), np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], np.int64)
        self.piece_bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.piece_size = np.array([len(p) for p in parts], np.int64)
        self.piece_at = np.cumsum(self.piece_size) - self.piece_size


def merge_words(words: list[bytes], t: BpeTables) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all ``words`` in one array, and how many each word has."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    # One symbol per byte, with a -1 before, between and after the words.
    at = np.arange(len(raw)) + np.repeat(np.arange(1, len(words) + 1), sizes)
    symbols = np.full(len(raw) + len(words) + 1, -1, np.int64)
    symbols[at] = t.byte_ids[raw]

    pair = symbols[:-1] << 20 | symbols[1:]
    place = np.minimum(np.searchsorted(t.keys, pair), len(t.keys) - 1)
    hit = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0) & (t.keys[place] == pair)) \
        if len(t.keys) else np.zeros(0, np.int64)
    rank = t.key_ranks[place[hit]] if len(hit) else hit
    # The index: positions of each rank, as a list of arrays.
    index: list[list | None] = [None] * len(t.new)

    def post(rank: np.ndarray, place: np.ndarray) -> int:
        """Add positions to the lists of their ranks; returns the least rank."""
        order = np.argsort(rank, kind="stable")
        rank, place = rank[order], place[order]
        edges = (np.flatnonzero(np.diff(rank)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, len(rank)], strict=True):
            r = int(rank[lo])
            if index[r] is None:
                index[r] = [place[lo:hi]]
            else:
                index[r].append(place[lo:hi])
        return int(rank[0])

    if len(hit):
        post(rank, hit)
    nxt = np.arange(1, len(symbols) + 1)
    prv = np.arange(-1, len(symbols) - 1)
    r = 0
    # Low ranks have long lists: each is applied to all its positions at once.
    while r < min(LONG_LISTS, len(index)):
        if index[r] is None:
            r += 1
            continue
        p = np.unique(np.concatenate(index[r]))
        index[r] = None
        a, b, c = t.left[r], t.right[r], t.new[r]
        p = p[symbols[p] == a]
        q = nxt[p]
        live = symbols[q] == b
        p, q = p[live], q[live]
        if a == b and len(p):       # overlapping pairs: every other one of a run, from the left
            begins = np.concatenate([[True], p[1:] != q[:-1]])
            first = np.maximum.accumulate(np.where(begins, np.arange(len(p)), 0))
            even = (np.arange(len(p)) - first) % 2 == 0
            p, q = p[even], q[even]
        n = nxt[q]
        symbols[p], symbols[q] = c, -2
        nxt[p], prv[n] = n, p
        m = prv[p]
        keys = np.concatenate([symbols[m] << 20 | c, c << 20 | symbols[n]])
        at = np.concatenate([m, p])
        place = np.minimum(np.searchsorted(t.keys, keys), len(t.keys) - 1)
        found = (t.keys[place] == keys) & np.concatenate([symbols[m] >= 0, symbols[n] >= 0])
        r += 1
        if found.any():
            r = min(r, post(t.key_ranks[place[found]], at[found]))

    active = [r for r, own in enumerate(index) if own]
    for r in active:
        index[r] = np.concatenate(index[r]).tolist()
    heapq.heapify(active)
    sym, nxt, prv = symbols.tolist(), nxt.tolist(), prv.tolist()
    ranks, left, right, new = t.ranks, t.left, t.right, t.new
    while active:
        r = heapq.heappop(active)
        a, b, c = left[r], right[r], new[r]
        places, index[r] = index[r], None
        places.sort()
        for p in places:
            if sym[p] != a:
                continue
            q = nxt[p]
            if sym[q] != b:
                continue
            n = nxt[q]
            sym[p], sym[q] = c, -2
            nxt[p] = n
            prv[n] = p
            if (y := sym[n]) >= 0 and (k := ranks.get(c << 20 | y)) is not None:
                if (own := index[k]) is None:
                    index[k] = [p]
                    heapq.heappush(active, k)
                else:
                    own.append(p)
            m = prv[p]
            if (y := sym[m]) >= 0 and (k := ranks.get(y << 20 | c)) is not None:
                if (own := index[k]) is None:
                    index[k] = [m]
                    heapq.heappush(active, k)
                else:
                    own.append(m)
    done = np.array(sym, np.int64)
    word_of = np.cumsum(done == -1)
    live = done >= 0
    return done[live], np.bincount(word_of[live] - 1, minlength=len(words))


def gather(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of several runs laid end to end."""
    total = int(size.sum())
    first = np.cumsum(size) - size
    return np.arange(total) - np.repeat(first - at, size)


class Encoder:
    """Encodes texts of one worker; remembers a bounded number of pretokens."""

    def __init__(self, tables: BpeTables):
        self.t = tables
        self.pretoken = regex.compile(PRETOKEN)
        self.cut = regex.compile(CUT)
        names = sorted(tables.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") \
            if names else None
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is special, text) in order; long texts come in slices cut between pretokens."""
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                yield True, part
                continue
            at = 0
            while len(part) - at > SLICE_CHARS:
                m = self.cut.search(part, at + SLICE_CHARS)
                if not m:
                    break
                yield False, part[at:m.start()]
                at = m.start()
            if at < len(part):
                yield False, part[at:]

    def learn(self, fresh: set[str]) -> None:
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self._clear()
        order = sorted(fresh)
        ids, sizes = merge_words([w.encode("utf-8", "surrogatepass") for w in order], self.t)
        base = len(self.known)
        self.known.update(zip(order, range(base, base + len(order)), strict=True))
        self.at = np.concatenate([self.at, np.cumsum(sizes) - sizes + len(self.ids)])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. The pretokens of all texts are merged through one index."""
        cut = [[(s, p if s else self.pretoken.findall(p)) for s, p in self.pieces(x)]
               for x in texts]
        seen: set[str] = set()
        for parts in cut:
            for special, p in parts:
                if not special:
                    seen.update(p)
        fresh = seen.difference(self.known)
        if fresh:
            if len(self.known) + len(fresh) > CACHE_WORDS:
                fresh = seen
            self.learn(fresh)
        out = []
        for parts in cut:
            got = [np.zeros(0, np.int32)]
            for special, p in parts:
                if special:
                    got.append(np.array([self.t.special[p]], np.int32))
                else:
                    w = np.fromiter(map(self.known.__getitem__, p), np.int64, len(p))
                    got.append(self.ids[gather(self.at[w], self.size[w])])
            out.append(np.concatenate(got))
        return out

    def encode_long(self, text: str) -> np.ndarray:
        """As ``encode_many``, slice by slice, so that the pretokens of a slice suffice."""
        return np.concatenate([np.zeros(0, np.int32), *[
            np.array([self.t.special[p]], np.int32) if s else self.encode_many([p])[0]
            for s, p in self.pieces(text)]])


def decode(ids: np.ndarray, t: BpeTables) -> str:
    """The text of token ids: their bytes end to end, read as UTF-8."""
    raw = t.piece_bytes[gather(t.piece_at[ids], t.piece_size[ids])].tobytes()
    return raw.decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``token_ids`` (array<int>) and ``decoded``.

    ``tokenizer`` names a byte-level BPE file on the driver. Its special tokens are matched
    in the text. Null texts count as empty and have no ids. Repeated rows are each encoded;
    an empty table gives no rows; other columns are not read. There is no shuffle: a task
    holds one slice of about two million characters (or one longer text) at a time.
    """
    spark = docs.sparkSession
    ship_package(spark)
    tables = spark.sparkContext.broadcast(BpeTables(tokenizer))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        encoder = Encoder(t)

        def emit(ids_of: list, texts: list[str], arrow_type) -> pa.RecordBatch:
            got = [encoder.encode_long(texts[0])] if len(texts) == 1 else \
                encoder.encode_many(texts)
            ends = np.cumsum([0, *map(len, got)]).astype(np.int32)
            flat = pa.array(np.concatenate(got), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(ids_of, arrow_type), pa.ListArray.from_arrays(pa.array(ends), flat),
                 pa.array([decode(x, t) for x in got], pa.string())],
                ["_id", "token_ids", "decoded"])

        for batch in batches:
            ids, texts, chars = [], [], 0
            for i, x in zip(batch.column(0), batch.column(1), strict=True):
                text = x.as_py() or ""
                if texts and chars + len(text) > SLICE_CHARS:
                    yield emit(ids, texts, batch.column(0).type)
                    ids, texts, chars = [], [], 0
                ids.append(i.as_py())
                texts.append(text)
                chars += len(text)
            if texts:
                yield emit(ids, texts, batch.column(0).type)

    return docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")
                       ).mapInArrow(run, f"_id {id_type}, token_ids array<int>, decoded string"
                                    ).withColumnRenamed("_id", id_col)
