"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A three-letter
window is the product of its letters' vectors, shifted by their places; the vectors of all
windows of a text are bundled by addition. A language's prototype bundles all its texts. A
text goes to the language whose prototype has the greatest cosine with its own vector.

A task bundles a few hundred texts at once: their window counts times the vectors of the
windows that occur in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veclode.llm.common import blocks, column

DIM = 2048
# Texts bundled at once, and windows whose vectors are held at once.
TEXTS, WINDOWS = 256, 4096
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or a blank for what is no letter."""
    table = np.full(0x110000, 0x20, np.int64)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


@lru_cache(maxsize=20_000)
def letter_vector(point: int) -> np.ndarray:
    return np.random.default_rng(point).integers(0, 2, DIM, dtype=np.int8) * 2 - 1


def window_vectors(windows: np.ndarray) -> np.ndarray:
    """The vectors of windows (rows of three code points): shifted letters, multiplied."""
    points, at = np.unique(windows, return_inverse=True)
    table = np.array([letter_vector(int(p)) for p in points], np.int8)
    at = at.reshape(windows.shape)
    return (
        np.roll(table, 2, axis=1)[at[:, 0]] * np.roll(table, 1, axis=1)[at[:, 1]] * table[at[:, 2]]
    )


def numbered(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values below ``bound``, and each value's place among them."""
    if bound > 1 << 22:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(bound, bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(bound, np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def text_windows(texts: list[str | None]):
    """For every text and window: text number, count and place in the list of distinct windows
    (three packed code points each); that list; and which texts have a letter. Letters are
    folded, everything between letters is one blank."""
    joined = "".join(f" {t} " if t else " " for t in texts)
    lengths = np.array([len(t) + 2 if t else 1 for t in texts], np.int64)
    seq = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    doc = np.repeat(np.arange(len(texts)), lengths)
    letter = seq != 0x20
    has = np.zeros(len(texts), bool)
    has[doc[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (doc[1:] != doc[:-1])
    keep[:1] = True
    seq, doc = seq[keep], doc[keep]
    points, small = numbered(seq, 0x110000)
    n = len(points)
    same = doc[2:] == doc[:-2]
    code = ((doc[2:] * n + small[:-2]) * n + small[1:-1]) * n + small[2:]
    code = np.sort(code[same])
    first = np.flatnonzero(np.diff(code, prepend=-1))
    count = np.diff(first, append=len(code))
    code = code[first]
    windows, place = numbered(code % n**3, n**3)
    packed = (points[windows // n**2] << 42) | (points[windows // n % n] << 21) | points[windows % n]
    return code // n**3, count, place, packed, has


def _unpacked(packed: np.ndarray) -> np.ndarray:
    mask = (1 << 21) - 1
    return np.stack([packed >> 42, (packed >> 21) & mask, packed & mask], axis=1)


def _bundled(row: np.ndarray, count: np.ndarray, at: np.ndarray, windows: np.ndarray, rows: int) -> np.ndarray:
    """Rows x ``DIM``: for every row the sum of its windows' vectors, as often as they occur."""
    out = np.zeros((rows, DIM))
    own, place = np.unique(at, return_inverse=True)
    counts = np.zeros((rows, len(own)), np.float32)
    np.add.at(counts, (row, place), count)
    for start in range(0, len(own), WINDOWS):
        vectors = window_vectors(_unpacked(windows[own[start : start + WINDOWS]]))
        out += counts[:, start : start + WINDOWS] @ vectors.astype(np.float32)
    return out


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector per language, summed over the task's texts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in blocks(texts):
            names = sorted(set(langs[a:b]))
            doc, count, at, windows, _ = text_windows(texts[a:b])
            lang = np.array([names.index(x) for x in langs[a:b]])[doc]
            for name, vector in zip(names, _bundled(lang, count, at, windows, len(names))):
                sums[name] = sums.get(name, 0) + vector
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))],
        names=["lang", "sums"],
    )


@dataclass(frozen=True)
class Prototypes:
    langs: tuple[str, ...]
    vectors: np.ndarray  # languages x DIM, of length 1


def fit_prototypes(docs: DataFrame, text: str = "text", lang: str = "lang") -> Prototypes:
    """The prototype of every language in ``docs``; rows without a language are left out.

    Every task adds up its texts to one vector per language; only their sums, languages x
    ``DIM`` numbers, reach the driver. No rows give no languages.
    """
    rows = docs.select(column(docs, lang).alias("lang"), column(docs, text).alias("text"))
    parts = rows.where("lang IS NOT NULL").mapInArrow(_bundles, "lang string, sums array<double>")
    sums = (
        parts.select("lang", F.posexplode("sums").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
        .select("lang", F.col("v.x").alias("v"))
        .orderBy("lang")
        .collect()
    )
    vectors = np.array([r["v"] for r in sums], float).reshape(len(sums), DIM)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Prototypes(tuple(r["lang"] for r in sums), vectors / np.where(norms > 0, norms, 1))


def cosines(texts: list[str | None], vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts x languages: cosines of the texts' own vectors with the prototypes (of length 1);
    and which texts have a letter. A text without windows has cosines of 0."""
    doc, count, at, windows, has = text_windows(texts)
    out = np.zeros((len(texts), len(vectors)))
    for start in range(0, len(texts), TEXTS):
        rows = min(TEXTS, len(texts) - start)
        a, b = np.searchsorted(doc, [start, start + rows])
        own = _bundled(doc[a:b] - start, count[a:b], at[a:b], windows, rows)
        norms = np.sqrt((own * own).sum(axis=1, keepdims=True))
        out[start : start + rows] = own @ vectors.T / np.where(norms > 0, norms, 1)
    return out, has


def predict_language(text: Column, prototypes: Prototypes) -> Column:
    """A struct (lang_pred, score): the language with the greatest cosine and that cosine,
    between 0 and 1. A null text, one without a letter, or no prototypes: ``und`` and 0.
    Of equally near languages the first by name wins."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, found = batch.to_pylist(), []
            for a, b in blocks(texts):
                near, has = cosines(texts[a:b], prototypes.vectors)
                for row, ok in zip(near, has.tolist()):
                    if ok and len(row):
                        best = int(row.argmax())
                        score = float(min(max(row[best], 0.0), 1.0))
                        found.append({"lang_pred": prototypes.langs[best], "score": score})
                    else:
                        found.append({"lang_pred": UNDETERMINED, "score": 0.0})
            yield pa.array(found, kind)

    return predict(text)
