"""Toxicity scores from a convolutional text classifier trained in numpy.

A word's embedding is the sum of those its letters and its first letters hash to; filters of several widths run over them, the greatest answer
of each filter is pooled over the whole text, and a logistic layer weighs the pooled answers.
Only buckets that several training texts hold get an embedding: words that are rare or never
seen in training say nothing, and single texts cannot be learned by heart.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veclode.llm.common import blocks, column, held_out, raw_bytes, stored
from veclode.llm.decontamination import split_words
from veclode.operators.lookup import BROADCAST_BYTES
from veclode.session import table_bytes

BUCKETS = 1 << 15  # the last one is padding
PREFIX = 4  # letters
# A word is one number: its own bucket, shifted, and that of its first letters.
SHIFT, MASK = 15, (1 << 15) - 1
PADDING = (BUCKETS - 1) << SHIFT | (BUCKETS - 1)
WIDTHS = (1, 2, 3)
DECISION = 0.3


class _Buckets(dict):
    """The buckets of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 500_000:
            self.clear()
        prefix = b"^" + word.decode(errors="replace")[:PREFIX].encode()
        own, first = (zlib.crc32(x) % (BUCKETS - 1) for x in (word, prefix))
        both = self[word] = own << SHIFT | first
        return both


def word_buckets(text: bytes | None, known: _Buckets) -> np.ndarray:
    words = split_words(text)
    return np.fromiter(map(known.__getitem__, words), np.int32, len(words))


@dataclass
class Network:
    embed: np.ndarray  # buckets x d
    filters: list[np.ndarray]  # for each width w: w x d x f
    bias: list[np.ndarray]
    weights: np.ndarray  # over all pooled answers
    intercept: float
    shift: float = 0.0  # calibration: the logit that gets the score DECISION
    scale: float = 1.0
    thresholds: tuple[tuple[str, float], ...] = ()  # score from which a language is flagged

    def score(self, logit: np.ndarray) -> np.ndarray:
        z = self.scale * (logit - self.shift) + np.log(DECISION / (1 - DECISION))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each followed by padding as long as the widest filter."""
    gap = np.full(max(WIDTHS), PADDING, np.int32)
    lengths = np.array([len(r) for r in rows])
    starts = np.cumsum(lengths + len(gap)) - lengths - len(gap)
    return np.concatenate([x for r in rows for x in (r, gap)]), starts


class _Adam:
    def __init__(self, shape, rate):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, value, gradient):
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        value -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def bucket_texts(rows: list[np.ndarray]) -> np.ndarray:
    """In how many texts each bucket occurs."""
    own = [np.unique(np.concatenate([r >> SHIFT, r & MASK])) for r in rows]
    return np.bincount(np.concatenate(own), minlength=BUCKETS)


def start(
    rng: np.random.Generator,
    texts: np.ndarray,
    n_rows: int,
    n_toxic: int,
    d: int = 16,
    each: int = 12,
    min_texts: int = 4,
) -> tuple[Network, np.ndarray]:
    """The network before training, and the buckets that say nothing."""
    net = Network(
        np.zeros((BUCKETS, d), np.float32),
        [rng.normal(0, 0.5, (w, d, each)).astype(np.float32) for w in WIDTHS],
        [np.zeros(each, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.3, each * len(WIDTHS)).astype(np.float32),
        float(np.log((n_toxic + 1) / (n_rows - n_toxic + 1))),
    )
    seen = np.flatnonzero(texts >= min(min_texts, n_rows))
    net.embed[seen] = rng.normal(0, 0.05, (len(seen), d))
    return net, np.setdiff1d(np.arange(BUCKETS), seen)


def fit(
    net: Network,
    silent: np.ndarray,
    rows: list[np.ndarray],
    toxic: np.ndarray,
    rng: np.random.Generator,
    epochs: int,
    batch: int = 64,
    rate: float = 0.01,
) -> None:
    """Go on training the network in place, by Adam on the logistic loss."""
    each, n_filters = len(net.bias[0]), len(WIDTHS)
    params = [net.embed, *net.filters, *net.bias, net.weights]
    adam = [_Adam(p.shape, rate) for p in params]
    bias0, adam0 = np.array([net.intercept], np.float32), _Adam((1,), rate)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            chosen = order[at : at + batch]
            ids, starts = _joined([rows[i] for i in chosen])
            x = net.embed[ids >> SHIFT] + net.embed[ids & MASK]
            stops = np.append(starts[1:], len(ids))
            lengths = stops - starts - max(WIDTHS)
            pooled, places = [], []
            for w, filt, b in zip(WIDTHS, net.filters, net.bias):
                conv = sum(x[j : len(x) - w + 1 + j] @ filt[j] for j in range(w)) + b
                # a text shorter than the filter still has one place, over its padding
                best = np.array([s + conv[s : s + max(n - w + 1, 1)].argmax(axis=0) for s, n in zip(starts, lengths)])
                pooled.append(np.take_along_axis(conv, best, 0))
                places.append(best)
            answers = np.concatenate(pooled, axis=1)
            on = answers > 0
            logit = (answers * on) @ net.weights + bias0[0]
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - toxic[chosen]) / len(chosen)
            error = error * np.where(toxic[chosen] == 1, 2.0, 1.0)
            grads = [np.zeros_like(p) for p in params[1:]]
            grads[-1] += (answers * on).T @ error
            back = on * error[:, None] * net.weights
            embed_grad = np.zeros_like(net.embed)
            for k, w in enumerate(WIDTHS):
                g = back[:, k * each : (k + 1) * each]
                grads[n_filters + k] += g.sum(axis=0)
                for j in range(w):
                    p = places[k] + j  # texts x filters
                    grads[k][j] += np.einsum("tf,tfd->df", g, x[p])
                    back_x = g[:, :, None] * net.filters[k][j].T[None]
                    np.add.at(embed_grad, ids[p] >> SHIFT, back_x)
                    np.add.at(embed_grad, ids[p] & MASK, back_x)
            embed_grad[silent] = 0
            for p, a, g in zip(params, adam, [embed_grad, *grads]):
                a.step(p, g)
            adam0.step(bias0, np.array([error.sum()], np.float32))
    net.intercept = float(bias0[0])


def train(
    rows: list[np.ndarray],
    toxic: np.ndarray,
    d: int = 16,
    each: int = 12,
    epochs: int = 6,
    batch: int = 64,
    rate: float = 0.01,
    min_texts: int = 4,
    seed: int = 3,
) -> Network:
    """Fit the network to texts given as buckets."""
    rng = np.random.default_rng(seed)
    net, silent = start(rng, bucket_texts(rows), len(rows), toxic.sum(), d, each, min_texts)
    fit(net, silent, rows, toxic, rng, epochs, batch, rate)
    return net


class Scorer:
    """Logits of whole texts. Filter answers are sums of rows of per-bucket tables."""

    def __init__(self, net: Network):
        self.net, self.known = net, _Buckets()
        self.tables = [
            np.concatenate([net.embed @ f[j] for w, f in zip(WIDTHS, net.filters) if w > j], axis=1)
            for j in range(max(WIDTHS))
        ]
        self.bias = np.concatenate(net.bias)

    def logits_of(self, rows: list[np.ndarray]) -> np.ndarray:
        """All answers over a text and its padding; those that reach into the padding from a
        text at least as wide as the filter are left out."""
        ids, starts = _joined(rows)
        lengths = np.array([len(r) for r in rows])
        each = len(self.net.bias[0])
        own, first = ids >> SHIFT, ids & MASK
        answers = self.tables[0][own] + self.tables[0][first]
        for j in range(1, max(WIDTHS)):
            answers[: len(ids) - j, each * j :] += self.tables[j][own[j:]] + self.tables[j][first[j:]]
        for k, w in enumerate(WIDTHS):
            part = answers[:, k * each : (k + 1) * each]
            for past in range(max(WIDTHS)):  # places from the end of the text on, and w - 1 before
                part[starts + lengths + past] = -np.inf
            for before in range(1, w):
                rows_ = starts + lengths - before
                part[rows_[lengths >= w]] = -np.inf
            short = lengths < w
            if short.any():
                at, embed = starts[short], self.net.embed
                part[at] = sum(
                    (embed[own[at + j]] + embed[first[at + j]]) @ self.net.filters[k][j] for j in range(w)
                )
                for past in range(1, max(WIDTHS)):
                    part[at + past] = -np.inf
        pooled = np.maximum.reduceat(answers, starts, axis=0) + self.bias
        return np.maximum(pooled, 0) @ self.net.weights + self.net.intercept

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        out = [np.zeros(0)]
        for a, b in blocks(texts):
            out.append(self.logits_of([word_buckets(t, self.known) for t in texts[a:b]]))
        return np.concatenate(out)


def best_cut(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The cut between two logits with the best F1; the middle of the best ones."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + toxic.sum())
    f1[:-1][np.diff(logits[order]) == 0] = -1  # no cut between equal logits
    k = int(f1.argmax())
    after = logits[order[k + 1]] if k + 1 < len(order) else logits[order[k]] - 1
    return float((logits[order[k]] + after) / 2)


def _labels(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One ``label_key, label`` for every key that training may see."""
    k, y = column(labels, key), column(labels, label)
    known = labels.where(k.isNotNull() & y.isNotNull() & ~held_out(k))
    return known.groupBy(k.alias("label_key")).agg(F.max(y).alias("label"))


def _buckets_of(text: Column) -> Column:
    """The buckets of a text's words, as the bytes of 32-bit numbers."""

    @F.arrow_udf("binary")
    def buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Buckets()
        for batch in batches:
            texts = raw_bytes(batch)
            for a, b in blocks(texts):
                yield pa.array([word_buckets(t, known).tobytes() for t in texts[a:b]], pa.binary())

    return buckets(text)


def sample(docs, labels, key, text, lang, label, max_rows, max_words):
    """At most ``max_rows`` labelled texts as buckets, of at most ``max_words`` words in all.

    Rows are taken by the hash of their key; one that no longer fits is passed over.
    """
    chosen = _labels(labels, key, label).orderBy(F.xxhash64("label_key"), "label_key").limit(max_rows)
    rows = docs.select(
        column(docs, key).alias("key"), column(docs, lang).alias("lang"), column(docs, text).alias("text")
    ).join(F.broadcast(chosen), F.col("key") == F.col("label_key"))
    rows = rows.orderBy(F.xxhash64("label_key"), "label_key", F.xxhash64("text", "lang"))
    rows = rows.select("key", "lang", "label", _buckets_of(F.col("text")).alias("ids"))
    found, total = [], 0
    for r in rows.toLocalIterator():
        if len(found) == max_rows:
            break
        n = len(r["ids"]) // 4
        if total + n > max_words:
            continue
        total += n
        found.append((r["key"], r["lang"] or "", int(r["label"] == 1), np.frombuffer(r["ids"], np.int32)))
    return sorted(found, key=lambda r: (str(r[0]), len(r[3])))


# Training on more rows than one task holds: every shard is trained on by itself for an epoch,
# then the shards' networks are averaged. Networks travel in parts, so that no task meets more
# than one part of each.
PARTS = 64
PART_ROWS = "part int, weight double, value binary"
# Logits are counted in bins this wide to find cuts.
BIN = 1 / 256
# A fifth of the rows calibrates.
CHECK = 5


def _shards(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray]]:
    """The hashes, buckets and labels of one shard after the other."""

    def each():
        for batch in rows:
            yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "place", "ids", "toxic")))

    for shard, members in groupby(each(), key=lambda r: r[0]):
        members = sorted(members, key=lambda r: r[1])
        ids = [np.frombuffer(r[2], np.int32) for r in members]
        yield shard, ids, np.array([r[3] for r in members])


def _parts(value: np.ndarray, weight: float) -> pa.RecordBatch:
    parts = [p.astype(np.float32).tobytes() for p in np.array_split(value, PARTS)]
    columns = [pa.array(range(PARTS), pa.int32()), pa.array([float(weight)] * PARTS), pa.array(parts, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "weight", "value"])


def _mean(parts: DataFrame) -> np.ndarray:
    """The weighted mean of vectors that lie in parts."""

    def add(table: pa.Table) -> pa.Table:
        # in a fixed order, whichever task wrote first
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("weight", "value"))))
        total = sum(w for w, _ in rows)
        value = sum(w / total * np.frombuffer(v, np.float32).astype(np.float64) for w, v in rows)
        return pa.table(
            {"part": table.column("part")[:1], "weight": pa.array([total]), "value": pa.array([value.astype(np.float32).tobytes()], pa.binary())}
        )

    rows = sorted(parts.groupBy("part").applyInArrow(add, PART_ROWS).collect())
    return np.concatenate([np.frombuffer(r["value"], np.float32) for r in rows])


def _flat(net: Network) -> np.ndarray:
    params = [net.embed, *net.filters, *net.bias, net.weights, np.array([net.intercept])]
    return np.concatenate([p.ravel() for p in params])


def _unflat(net: Network, flat: np.ndarray) -> None:
    at = 0
    for p in (net.embed, *net.filters, *net.bias, net.weights):
        p[...] = flat[at : at + p.size].reshape(p.shape)
        at += p.size
    net.intercept = float(flat[at])


def train_shards(
    rows: DataFrame,
    n_rows: int,
    n_toxic: int,
    d: int = 16,
    each: int = 12,
    epochs: int = 6,
    batch: int = 64,
    rate: float = 0.01,
    min_texts: int = 4,
    seed: int = 3,
) -> Network:
    """:func:`train` on all rows of a stored table, whose shards (``shard, place, ids, toxic``) lie
    one after the other, each in one file."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, _ in _shards(batches):
            yield _parts(bucket_texts(ids) / len(ids), len(ids))

    texts = np.rint(_mean(rows.mapInArrow(count, PART_ROWS)) * n_rows)
    net, silent = start(np.random.default_rng(seed), texts, n_rows, n_toxic, d, each, min_texts)
    for epoch in range(epochs):

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, ids, toxic in _shards(batches):
                own = deepcopy(net)
                fit(own, silent, ids, toxic, np.random.default_rng((seed, epoch, shard)), 1, batch, rate)
                yield _parts(_flat(own), len(ids))

        _unflat(net, _mean(rows.mapInArrow(run, PART_ROWS)))
    return net


def counted_cut(bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """:func:`best_cut` from the counts of logits by bin; it falls between two bins."""
    order = np.argsort(-bins)
    bins, toxic, clean = bins[order], toxic[order], clean[order]
    f1 = 2 * np.cumsum(toxic) / (np.cumsum(toxic + clean) + toxic.sum())
    k = int(f1.argmax())
    below = bins[k + 1] + 1 if k + 1 < len(bins) else bins[k]
    return float((bins[k] + below) / 2 * BIN)


def _logit_counts(rows: DataFrame, net: Network) -> pa.Table:
    """Rows of ``lang, bin, toxic, clean``: how many texts' logits lie in each bin."""

    @F.arrow_udf("bigint")
    def bins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(net)
        for batch in batches:
            rows = batch.to_pylist()
            for a, b in blocks(rows):
                logits = scorer.logits_of([np.frombuffer(x, np.int32) for x in rows[a:b]])
                yield pa.array(np.floor(np.clip(logits, -128, 128) / BIN).astype(np.int64))

    counts = rows.select("lang", "toxic", bins("ids").alias("bin")).groupBy("lang", "bin")
    return counts.agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).toArrow()


def _calibrate(net: Network, rows: DataFrame) -> None:
    counts = _logit_counts(rows, net)
    langs, bins, toxic, clean = (
        np.array(counts.column(c).to_pylist()) for c in ("lang", "bin", "toxic", "clean")
    )

    def by_bin(own):
        distinct, place = np.unique(bins[own], return_inverse=True)
        return distinct, *(np.bincount(place, x[own]) for x in (toxic, clean))

    net.shift = counted_cut(*by_bin(slice(None)))
    middle = (bins + 0.5) * BIN
    spread = abs(np.average(middle, weights=toxic) - np.average(middle, weights=clean))
    net.scale = float(4 / max(spread, 1e-6))
    cuts = []
    for name in sorted(set(langs.tolist())):
        own = langs == name
        enough = min(toxic[own].sum(), clean[own].sum()) >= 20
        cut = counted_cut(*by_bin(own)) if enough else net.shift
        cuts.append((name, float(net.score(np.array([cut]))[0])))
    net.thresholds = tuple(cuts)


def _fit_shards(texts: DataFrame, shard_rows: int, shard_words: int, **options) -> Network | None:
    """Train and calibrate on all of ``key, lang, toxic, text``, however many they are."""
    check = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(CHECK)) == 0
    rows = stored(texts.select("key", "lang", "toxic", _buckets_of(F.col("text")).alias("ids")).withColumn("check", check))
    counts = rows.groupBy("check").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("toxic").alias("toxic"), F.sum(F.octet_length("ids") / 4).alias("words")
    )
    found = {r["check"]: r for r in counts.collect()}
    if not 0 < sum(r["toxic"] for r in found.values()) < sum(r["rows"] for r in found.values()):
        return None
    apart = len(found) == 2 and all(0 < r["toxic"] < r["rows"] for r in found.values())
    used = [found[False]] if apart else list(found.values())  # too few of a kind to set any aside
    n_rows, n_toxic, words = (sum(r[c] for r in used) for c in ("rows", "toxic", "words"))
    shards = int(max(-(-n_rows // shard_rows), -(-words // shard_words)))
    place = F.xxhash64("key", "ids")
    chosen = rows.where("NOT check") if apart else rows
    sharded = chosen.select("toxic", "ids", place.alias("place")).withColumn(
        "shard", F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int")
    )
    kept = stored(sharded.repartitionById(shards, F.col("shard")))
    net = train_shards(kept, n_rows, n_toxic, **options)
    _calibrate(net, rows.where("check") if apart else rows)
    return net


def fit_network(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
    max_rows: int = 10_000,
    max_words: int = 8_000_000,
    **options,
) -> Network | None:
    """Train on all labelled rows that are not held out.

    A fifth of them calibrates: the cut with the best F1 becomes the score 0.3, and
    each language gets a threshold of its own (the common one if it has too few rows).
    Without labelled rows of both kinds there is no network. Up to ``max_rows`` rows of
    ``max_words`` words in all are trained on here; more than that in shards of about that
    size, in the tasks.
    """
    known = _labels(labels, key, label)
    small = table_bytes(known) <= BROADCAST_BYTES
    texts = docs.select(
        column(docs, key).alias("key"), column(docs, lang).alias("lang"), column(docs, text).alias("text")
    ).join(F.broadcast(known) if small else known, F.col("key") == F.col("label_key"))
    texts = texts.select(
        "key", F.coalesce("lang", F.lit("")).alias("lang"), (F.col("label") == 1).cast("int").alias("toxic"), "text"
    )
    total = texts.count()
    rows = sample(docs, labels, key, text, lang, label, max_rows, max_words) if total <= max_rows else []
    if len(rows) < total:
        return _fit_shards(texts, max_rows, max_words, **options)
    toxic = np.array([r[2] for r in rows])
    if not len(rows) or not 0 < toxic.sum() < len(rows):
        return None
    ids = [r[3] for r in rows]
    check = np.random.default_rng(1).random(len(rows)) < 0.2
    if not 0 < toxic[check].sum() < check.sum() or not 0 < toxic[~check].sum() < (~check).sum():
        check = np.ones(len(rows), bool)  # too few rows to set any aside
        net = train(ids, toxic, **options)
    else:
        net = train([x for x, c in zip(ids, check) if not c], toxic[~check], **options)
    scorer, of = Scorer(net), np.flatnonzero(check)
    logits = np.concatenate(
        [scorer.logits_of([ids[i] for i in of[a : a + 64]]) for a in range(0, len(of), 64)]
    )
    net.shift = best_cut(logits, toxic[check])
    spread = abs(logits[toxic[check] == 1].mean() - logits[toxic[check] == 0].mean())
    net.scale = float(4 / max(spread, 1e-6))
    langs = np.array([rows[i][1] for i in of])
    cuts = []
    for name in sorted(set(langs.tolist())):
        own = langs == name
        enough = min(toxic[check][own].sum(), (1 - toxic[check][own]).sum()) >= 20
        cut = best_cut(logits[own], toxic[check][own]) if enough else net.shift
        cuts.append((name, float(net.score(np.array([cut]))[0])))
    net.thresholds = tuple(cuts)
    return net


def toxicity_score(text: Column, net: Network | None) -> Column:
    """The score of every whole text, 0 to 1; null and empty texts have no words and get the
    score of silence. Without a network every score is 0."""
    if net is None:
        return F.lit(0.0)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(net)
        for batch in batches:
            yield pa.array(net.score(scorer.logits(raw_bytes(batch))), pa.float64())

    return score(text)


def language_threshold(lang: Column, net: Network | None) -> Column:
    """The score from which a text of this language is flagged."""
    out = F.lit(DECISION)
    for name, cut in net.thresholds if net else ():
        out = F.when(lang == name, F.lit(cut)).otherwise(out)
    return out
