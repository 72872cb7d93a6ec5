"""Packing token sequences by cutting-stock column generation.

Documents are tokenized in the tasks and cut into pieces of at most one sequence. Piece
lengths, rounded up to a small unit, give a histogram of bounded size. On it a linear program
is solved by column generation: each column is a pattern (how many pieces of each length fill
a sequence), and the next column comes from a knapsack solved by dynamic programming over the
program's dual prices. The solution is rounded down, the few pieces left over are packed best
fit, and the patterns are dealt to the pieces by their rank among pieces of their length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veclode.llm.common import blocks, column, raw_bytes, stored, with_rank
from veclode.session import bounded_batches

# Words whose ids a task remembers, in both generations together.
REMEMBERED = 300_000
# Text cut into words at once inside a task; a longer text is cut alone. Cutting and encoding
# hold some forty times as much, and a worker process keeps most of that when it is done.
TOKENIZED_BYTES = 1 << 20
# Texts the library encodes at once: it holds about a hundred bytes a token.
ENCODED = 256


# The vocabulary's own word pattern, for text of ASCII and Latin letters up to U+024F folded
# to lower case. Parts with other characters are left to the tokenizer itself.
_UNIT = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xc9]+|[0-9]|[^\x09-\x0d\x20a-z0-9\x80-\xff]+"
)
_PLAIN = bytes(b for b in range(256) if b < 0xC0 or 0xC3 <= b <= 0xC9)
_OTHER = ("\u00d7".encode(), "\u00f7".encode(), "\u0130".encode())  # no letters, or fold to two
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


# What a byte is to the pattern: white space, letter, digit or symbol.
_SPACE, _LETTER, _DIGIT, _SYMBOL = range(4)
_KIND = np.full(256, _SYMBOL, np.uint8)
_KIND[[*range(0x09, 0x0E), 0x20]] = _SPACE
_KIND[[*range(0x61, 0x7B), *range(0x80, 0xCA)]] = _LETTER
_KIND[range(0x30, 0x3A)] = _DIGIT


def _plain(text: bytes) -> bool:
    return not text.translate(None, _PLAIN) and not any(x in text for x in _OTHER)


def _cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of folded plain texts, as the pattern finds them, and where each text's begin."""
    data = np.frombuffer(b" ".join([b"", *texts, b"   "]), np.uint8)
    kind = _KIND[data]
    starts = np.empty(len(kind), bool)
    starts[0] = False
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    starts |= kind == _DIGIT
    # 's and the like are words where no symbol stands before them; letters may follow
    marks = np.flatnonzero(data == ord("'"))
    marks = marks[kind[marks - 1] != _SYMBOL]
    first, second = data[marks + 1], data[marks + 2]
    short = np.isin(first, np.frombuffer(b"stmd", np.uint8))
    pairs = first.astype(np.int64) * 256 + second
    long = np.isin(pairs, [x[0] * 256 + x[1] for x in (b"re", b"ve", b"ll")])
    starts[marks[short | long] + 1] = False
    for ends in (marks[short] + 2, marks[long] + 3):
        starts[ends] = kind[ends] != _SPACE
    filled = kind != _SPACE
    starts &= filled
    at = np.flatnonzero(starts)
    kept = np.cumsum(filled)
    offsets = np.append(kept[at] - 1, kept[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[filled])]
    )
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return words, np.searchsorted(at, begins)


class WordTokenizer:
    """Token ids of whole texts, as little-endian 32-bit numbers.

    For a vocabulary of lower-case words whose tokens never hold white space and end with
    ``</w>``: a text's ids are those of its words. Each distinct word is encoded once; words are
    encoded together and told apart by their word-final tokens. Blank-separated parts with
    other characters are encoded as they are, and a text that spells out a special token is
    encoded whole. Words are remembered in two generations: when the younger is full it
    becomes the older, and of the older one only the words that are met again are taken over.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.encode() for t in added]
        self.final = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.final[i] = token.endswith("</w>")
        # for words that are folded and cut already; the vocabulary is held once
        self.words_only = Tokenizer(self.tokenizer.model)
        self.words_only.normalizer = normalizers.Sequence([])
        self.words_only.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, texts: list[bytes], tokenizer=None) -> Iterator[np.ndarray]:
        encode = (tokenizer or self.tokenizer).encode_batch_fast
        for at in range(0, len(texts), ENCODED):
            some = [t.decode() for t in texts[at : at + ENCODED]]
            yield from [np.array(e.ids, "<u4") for e in encode(some, add_special_tokens=False)]

    def _learn(self, units: list[bytes]) -> None:
        if not _plain(b" ".join(units)):
            other = [u for u in units if not _plain(u)]
            self.young.update(zip(other, (x.tobytes() for x in self._encode(other))))
            units = [u for u in units if u not in self.young]
        groups = [units[i : i + 64] for i in range(0, len(units), 64)]
        joined = [b" ".join(g).decode().lower().encode() for g in groups]
        for group, ids in zip(groups, self._encode(joined, self.words_only)):
            stops = np.flatnonzero(self.final[ids]) + 1
            if len(stops) != len(group):
                raise ValueError("not a vocabulary of whole words")
            raw, start = ids.tobytes(), 0
            for unit, stop in zip(group, (4 * stops).tolist()):
                self.young[unit] = raw[start:stop]
                start = stop

    def _ids(self, units: list[bytes]) -> list[bytes]:
        """The ids of distinct words, and of parts that are left to the tokenizer."""
        new = [u for u in units if u not in self.young]
        if new and 2 * (len(self.young) + len(new)) > REMEMBERED:
            self.young, self.old = {}, self.young
            new = units
        again = [u for u in new if u in self.old]
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        self._learn([u for u in new if u not in self.young] if again else new)
        return [self.young[u] for u in units]

    def _plain_texts(self, texts: list[bytes]) -> list[bytes]:
        words, begins = _cut([t.translate(_LOWER) for t in texts])
        coded = words.dictionary_encode()
        known = pa.array(self._ids(coded.dictionary.to_pylist()), pa.large_binary())
        ids = known.take(coded.indices)
        offsets = np.frombuffer(ids.buffers()[1], np.int64)[begins].tolist()
        raw = ids.buffers()[2].to_pybytes() if len(ids) else b""
        return [raw[a:b] for a, b in zip(offsets, offsets[1:])]

    def _spells_special(self, text: bytes) -> bool:
        # a single byte is found much faster than a token
        return any(s[:1] in text and s in text for s in self.special)

    def _other_text(self, text: bytes) -> bytes:
        if self._spells_special(text):
            return next(self._encode([text])).tobytes()
        units = []
        for part in text.split():
            units.extend(_UNIT.findall(part.translate(_LOWER)) if _plain(part) else [part])
        distinct = list(dict.fromkeys(units))
        ids = dict(zip(distinct, self._ids(distinct)))
        return b"".join(map(ids.__getitem__, units))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        plain = [_plain(t) and not self._spells_special(t) for t in texts]
        found = iter(self._plain_texts([t for t, p in zip(texts, plain) if p]))
        return [next(found) if p else self._other_text(t) for t, p in zip(texts, plain)]


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    """One for each worker process: tasks that follow each other go on with what it knows."""
    return WordTokenizer(path)


def token_pieces(
    docs: DataFrame, path: str, size: int, end: int, key: str, text: str, with_ids: bool
) -> DataFrame:
    """Pieces of at most ``size`` tokens of every document, its ``end`` token included."""
    fields = (
        "row bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
        + ", ids binary" * with_ids
    )
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [T.StructField("key", kind), *T._parse_datatype_string(fields).fields]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        last = np.array([end], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = [t or b"" for t in raw_bytes(batch.column(1))]
            for a, b in blocks(texts, TOKENIZED_BYTES):
                rows, docs_ = [], []
                for i, ids in enumerate(tokenizer(texts[a:b]), a):
                    ids += last
                    for at in range(0, len(ids), 4 * size):
                        piece = ids[at : at + 4 * size]
                        rows.append((row, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                        rows[-1] += (piece,) * with_ids
                        docs_.append(i)
                        row += 1
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(docs_)), *columns], names=schema.names
                )

    return docs.select(column(docs, key), column(docs, text)).mapInArrow(cut, schema)


def best_pattern(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The worthiest multiset of sizes that fits into ``room`` (unbounded knapsack)."""
    best, taken = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for u in range(1, room + 1):
        best[u] = best[u - 1]
        if k := fits[u]:
            worth = best[u - sizes[:k]] + prices[:k]
            j = int(worth.argmax())
            if worth[j] > best[u] + 1e-12:
                best[u], taken[u] = worth[j], j
    pattern, u = np.zeros(len(sizes), np.int64), room
    while u > 0:
        if (j := taken[u]) < 0:
            u -= 1
        else:
            pattern[j] += 1
            u -= sizes[j]
    return float(best[room]), pattern


def _inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan with row pivots. Row operations alone: the threaded solvers behind numpy's
    own inverse have been seen to block in a process that runs Spark beside them."""
    n = len(matrix)
    work = np.hstack([matrix.astype(float), np.eye(n)])
    for i in range(n):
        pivot = i + int(np.abs(work[i:, i]).argmax())
        work[[i, pivot]] = work[[pivot, i]]
        work[i] /= work[i, i]
        factors = work[:, i].copy()
        factors[i] = 0
        touched = np.flatnonzero(factors)
        work[touched] -= factors[touched, None] * work[i]
    return work[:, n:]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """``matrix @ vector`` over the vector's non-zeros."""
    held = np.flatnonzero(vector)
    return (matrix[:, held] * vector[held]).sum(axis=1)


def fractional_patterns(sizes: np.ndarray, wanted: np.ndarray, room: int, gap: float = 5e-4):
    """Patterns (rows) and how often each is used, within ``gap`` of the least sequences.

    Revised simplex with column generation. Prices bound the optimum from below by value /
    worth of the best pattern, which is the stopping rule; every basis on the way is a
    packing, so stopping early only costs room.
    """
    m = len(sizes)
    patterns = np.diag(room // sizes).astype(float)  # columns of the basis, here as rows
    inverse = np.diag(1 / np.diag(patterns))
    used = _times(inverse, wanted)
    for step in range(40 * m + 100):
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(sizes, prices, room)
        if worth <= 1 + gap:
            break
        entering = _times(inverse, pattern)
        rising = entering > 1e-9
        if not rising.any():
            break
        ratios = np.where(rising, used / np.where(rising, entering, 1), np.inf)
        out = int(ratios.argmin())
        used = np.maximum(used - ratios[out] * entering, 0)
        used[out] = ratios[out] if ratios[out] > 0 else 0.0
        patterns[out] = pattern
        pivot = inverse[out] / entering[out]
        touched = np.flatnonzero(entering)
        inverse[touched] -= entering[touched, None] * pivot
        inverse[out] = pivot
        if step % 200 == 199:  # rounding errors add up
            inverse = _inverted(patterns.T)
            used = np.maximum(_times(inverse, wanted), 0)
    return patterns.astype(np.int64), used


def best_fit(sizes: list[int], room: int) -> list[tuple[int, ...]]:
    """Bins for the given sizes, each put where it leaves the least room, largest first."""
    open_bins: dict[int, list[list[int]]] = {}
    bins = []
    for size in sorted(sizes, reverse=True):
        left = next((r for r in range(size, room) if open_bins.get(r)), room)
        own = open_bins[left].pop() if left < room else []
        if left == room:
            bins.append(own)
        own.append(size)
        open_bins.setdefault(left - size, []).append(own)
    return [tuple(b) for b in bins]


def whole_patterns(histogram: dict[int, int], room: int) -> Counter:
    """How often each pattern (sorted sizes) is used; together they hold every piece once."""
    if not histogram:
        return Counter()
    sizes = np.array(sorted(histogram))
    wanted = np.array([histogram[s] for s in sizes.tolist()], float)
    patterns, used = fractional_patterns(sizes, wanted, room)
    out: Counter = Counter()
    left = wanted.astype(np.int64)
    for pattern, times in zip(patterns, np.floor(used + 1e-9).astype(np.int64)):
        # rounding errors must not use a piece twice
        held = pattern > 0
        times = int(min(times, (left[held] // pattern[held]).min())) if held.any() else 0
        if times:
            left -= times * pattern
            out[tuple(np.repeat(sizes, pattern).tolist())] += times
    rest = [s for s, n in zip(sizes.tolist(), left.tolist()) for _ in range(n)]
    out.update(best_fit(rest, room))
    return out


def pattern_runs(patterns: Counter) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, last rank, pieces in each sequence, first sequence) of every use."""
    runs, upto, sequence = [], Counter(), 0
    for pattern, times in sorted(patterns.items(), reverse=True):
        for size, each in Counter(pattern).items():
            runs.append((size, upto[size], upto[size] + times * each - 1, each, sequence))
            upto[size] += times * each
        sequence += times
    return runs


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 4096,
    end: int = 2,
    unit: int = 16,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Where every piece of every document lies: one row per piece.

    ``start`` and ``length`` place a piece in its document's ids (``end`` appended),
    ``sequence_id`` and ``offset`` in the sequences; offsets have no gaps. A null or empty text
    is its ``end`` token alone. Repeated rows are packed one by one. An empty table gives an
    empty table. ``with_ids`` adds the ids as little-endian 32-bit numbers.
    """
    bounded_batches(docs.sparkSession)
    pieces = stored(token_pieces(docs, tokenizer_path, size, end, key, text, with_ids))
    pieces = pieces.withColumn("units", F.ceil(F.col("length") / unit).cast("int"))
    # at most size / unit rows
    histogram = {r["units"]: r["count"] for r in pieces.groupBy("units").count().collect()}
    runs = pieces.sparkSession.createDataFrame(
        pattern_runs(whole_patterns(histogram, size // unit)),
        "of int, first bigint, last bigint, each bigint, base bigint",
    )
    # a few runs for each pattern, whose number depends on size / unit alone
    placed = with_rank(pieces, "units", "row", "rank").join(
        F.broadcast(runs),
        (F.col("units") == F.col("of")) & F.col("rank").between(F.col("first"), F.col("last")),
    )
    sequence = F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("length"), "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return placed.withColumn("sequence_id", sequence.cast("bigint")).select(
        F.col("key").alias(key),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint").alias("offset"),
        *["ids"] * with_ids,
    )
