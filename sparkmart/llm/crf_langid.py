"""Language identification: a linear-chain conditional random field over words.

A word's features are its affixes, its character n-grams and, if it stands in
the lexicon of the training words, itself; they are hashed to ``BUCKETS``
weights per language.  Learned transitions tie neighbours together, and
forward-backward gives every word's language probabilities, so a text may
switch languages.  A document's language is the one with the largest share of
probability over all its words; its score is that share.

The model is fitted on a bounded sample: of each of the ``LABELS`` commonest label
values ``PER_LABEL`` whole documents with the least hashes, those of up to
``LONGEST`` characters first, and ``CHARACTERS`` of them in all (one at least).  Segments
of different documents are strung together, so transitions are learned from text
that switches.  Everything else runs over all rows and whole texts, next to the
scan, without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
without labelled documents everything is ``und``; of equally likely languages the
first in the order of labels is taken; a very long text is labelled whole, about 100
bytes a word; null keys and repeated rows are labelled like any other; an empty
table gives an empty result; only key, text and (for the fit) label are read.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import CHUNK_BYTES, slices, tidy

#: the bound of the training sample, and the size of the model
LABELS, PER_LABEL, LONGEST, CHARACTERS, BUCKETS = 256, 150, 1500, 1 << 20, 1 << 16
EPOCHS, RATE, SEQUENCE = 6, 0.5, 60
#: words whose scores a worker remembers at most
CACHE_WORDS = 200_000
#: words whose features stand side by side
SCORED = 1 << 14

WORD = re.compile(r"[^\W\d_]+")


def features(word: str, lexicon: frozenset) -> list[int]:
    """Hashed features of a lower-case word, cut from its UTF-8 bytes."""
    w, crc = b"^" + word.encode() + b"$", zlib.crc32
    found = [crc(w[:n], 1) for n in (2, 3, 4)] + [crc(w[-n:], 2) for n in (2, 3, 4, 5)]
    found += [crc(w[i:i + n]) for n in (2, 3) for i in range(len(w) - n + 1)]
    if word in lexicon:
        found.append(crc(w, 3))
    return [f % BUCKETS for f in found]


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def _crc(c: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The running (inverted) crc32 ``c`` with another byte."""
    return _CRC[(c ^ byte) & 255] ^ (c >> np.uint32(8))


def all_features(words: list[str], lexicon: frozenset) -> tuple[np.ndarray, np.ndarray]:
    """``features`` of at least one word, one after the other, and how many each word has.  Words hold neither ^ nor $."""
    data = np.frombuffer(f"^{'$^'.join(words)}$".encode(), np.uint8).astype(np.uint32)
    start = np.flatnonzero(data == ord("^"))
    end = np.append(start[1:], len(data))
    size = end - start                                         # 3 at least
    inside = [w in lexicon for w in words]
    n = 2 * size + 4 + inside
    at = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint32)
    c = np.full(len(start), 1 ^ 0xFFFFFFFF, np.uint32)
    for i in range(4):                                         # beginnings of 2, 3, 4 bytes; the whole, where it is shorter
        c = np.where(size > i, _crc(c, data[np.minimum(start + i, end - 1)]), c)
        if i:
            out[at + i - 1] = c
    whole = None
    for k in range(2, 6):                                      # ends
        c = np.full(len(start), 2 ^ 0xFFFFFFFF, np.uint32)
        for i in range(k):
            c = _crc(c, data[np.maximum(end - k + i, start)])
        whole = c if whole is None else np.where(size >= k, c, whole)
        out[at + 1 + k] = whole
    two = _crc(_crc(np.uint32(0xFFFFFFFF), data[:-1]), data[1:])
    three = _crc(two[:-1], data[2:])
    word = np.repeat(np.arange(len(start)), size)
    place = np.arange(len(data)) - start[word]
    head = at[word] + 7 + place
    left = size[word] - place                                  # bytes from here to the word's end
    two_at, three_at = np.flatnonzero(left >= 2), np.flatnonzero(left >= 3)
    out[head[two_at]] = two[two_at]
    out[head[three_at] + size[word[three_at]] - 1] = three[three_at]
    out = ~out
    for i in np.flatnonzero(inside):
        out[at[i] + n[i] - 1] = zlib.crc32(b"^" + words[i].encode() + b"$", 3)
    return (out % np.uint32(BUCKETS)).astype(np.int64), n


def forward_backward(score: np.ndarray, begin: np.ndarray, size: np.ndarray, move: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities of every element of several chains at once.

    Chain i is rows begin[i] .. begin[i] + size[i] of ``score`` (log scores);
    ``move`` has log transition scores.  With ``pairs`` also the expected
    number of transitions.  Chains advance together, the longest first."""
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than step
    # rows by step, then chain: a step's rows are neighbours
    lead = np.cumsum(active) - active
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    source, place = np.repeat(begin, size) + step, np.repeat(np.arange(len(size)), size)
    place += lead[step]
    e, t = np.empty((len(source), score.shape[1])), np.exp(move - move.max())
    e[place] = np.exp(score - score.max(1, keepdims=True))[source]
    alpha, beta = np.empty_like(e), np.empty_like(e)
    a = None
    for lo, n in zip(lead.tolist(), active.tolist()):
        a = e[:n] if a is None else (a[:n] @ t) * e[lo:lo + n]
        a = np.divide(a, a.sum(1, keepdims=True), out=alpha[lo:lo + n])
    both = np.zeros_like(t)
    b = np.ones((0, e.shape[1]))
    for i in range(longest - 1, -1, -1):
        lo, n = int(lead[i]), int(active[i])
        if n > len(b):
            b = np.concatenate((b, np.ones((n - len(b), e.shape[1]))))  # chains that end here
        beta[lo:lo + n] = b
        if i:
            eb = e[lo:lo + n] * b
            if pairs:
                before = alpha[lead[i - 1]:lead[i - 1] + n]
                x = before[:, :, None] * t[None] * eb[:, None, :]
                both += (x / x.sum((1, 2), keepdims=True)).sum(0)
            b = eb @ t.T
            b /= b.sum(1, keepdims=True)
    alpha *= beta
    alpha /= alpha.sum(1, keepdims=True)
    out = np.empty(score.shape)
    out[source] = alpha[place]
    return out, both if pairs else None


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray   # BUCKETS x labels
    move: np.ndarray      # labels x labels
    lexicon: frozenset

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission scores of distinct words."""
        parts = [np.empty((0, len(self.labels)), self.weights.dtype)]
        for lo in range(0, len(words), SCORED):
            flat, n = all_features(words[lo:lo + SCORED], self.lexicon)
            parts.append(np.add.reduceat(self.weights[flat], np.cumsum(n) - n, 0))
        return np.concatenate(parts)


def fit(rows: list[tuple[str, str]], seed: int = 5) -> Model:
    """A model from (label, text) rows, by AdaGrad on the chains' likelihood."""
    rows = sorted(rows)
    labels = sorted({lab for lab, _ in rows})
    docs = [(labels.index(lab), WORD.findall(text.lower())) for lab, text in rows]
    counts = Counter(w for _, words in docs for w in words)
    lexicon = frozenset(w for w, n in counts.items() if n > 1)
    model = Model(labels, np.zeros((BUCKETS, len(labels))), np.zeros((len(labels),) * 2), lexicon)
    rng = np.random.default_rng(seed)
    pieces = []
    for lab, words in docs:
        at = 0
        while at < len(words):
            n = int(rng.integers(3, 26))
            pieces.append((lab, words[at:at + n]))
            at += n
    known = {w: i for i, w in enumerate(counts)}
    ids = [features(w, lexicon) for w in counts]
    width = max(map(len, ids), default=1)
    table = np.full((len(ids), width), BUCKETS)   # the last row of the weights stays 0
    for i, x in enumerate(ids):
        table[i, :len(x)] = x
    weights = np.zeros((BUCKETS + 1, len(labels)))
    seen, seen_move = np.full((BUCKETS + 1, len(labels)), 1e-8), np.full_like(model.move, 1e-8)
    for _ in range(EPOCHS):
        chains: list[list[tuple[int, int]]] = [[]]
        for p in rng.permutation(len(pieces)):
            if len(chains[-1]) >= SEQUENCE:
                chains.append([])
            chains[-1] += [(known[w], pieces[p][0]) for w in pieces[p][1]]
        chains = [c for c in chains if c]
        for lo in range(0, len(chains), 16):
            part = chains[lo:lo + 16]
            size = np.array([len(c) for c in part])
            word, gold = np.array([x for c in part for x in c]).T
            begin = np.cumsum(size) - size
            f = table[word]
            p, both = forward_backward(weights[f].sum(1), begin, size, model.move, pairs=True)
            want = np.zeros_like(p)
            want[np.arange(len(gold)), gold] = 1
            grad = np.zeros_like(weights)
            np.add.at(grad, f, (want - p)[:, None, :])
            step = -both
            inner = np.ones(len(gold), bool)
            inner[begin] = False
            np.add.at(step, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            touched = np.unique(f)
            g = grad[touched]
            seen[touched] += g * g
            weights[touched] += RATE * g / np.sqrt(seen[touched])
            weights[BUCKETS] = 0
            seen_move += step * step
            model.move += RATE * step / np.sqrt(seen_move)
    model.weights = weights[:BUCKETS].astype(np.float32)
    return model


def sample(df: DataFrame, *, key: str, text: str, label: str, per_label: int = PER_LABEL) -> list[tuple[str, str]]:
    """At most ``per_label`` rows of each label value, as the module's docstring says."""
    rows = df.where(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(label).cast("string").alias("_l"), F.col(text).cast("string").alias("_t"),
        F.xxhash64(F.col(key), F.col(text)).alias("_h"))
    common = rows.groupBy("_l").count().orderBy(F.desc("count"), "_l").limit(LABELS).collect()
    if not common:
        return []
    # a share of each label's hashes that holds several times as many rows as are wanted
    share = F.create_map(*[F.lit(x) for r in common for x in (r["_l"], min(1.0, 8 * per_label / r["count"]))])
    some = rows.where(F.col("_l").isin([r["_l"] for r in common])) \
        .where(F.pmod("_h", F.lit(1 << 30)) < F.element_at(share, F.col("_l")) * (1 << 30))
    some = some.groupBy("_l", "_h").agg(F.min("_t").alias("_t"))     # repeated rows count once
    w = Window.partitionBy("_l").orderBy(F.length("_t") > LONGEST, "_h", "_t")
    some = some.withColumns({"_n": F.row_number().over(w), "_c": F.sum(F.length("_t")).over(w)})
    got = some.where((F.col("_n") <= per_label) & ((F.col("_c") <= CHARACTERS) | (F.col("_n") == 1))).select("_l", "_t").collect()
    return [(r[0], r[1]) for r in got if WORD.search(r[1])]


def label_words(df: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``df``: the key, ``lang``, ``score``, ``words`` and
    ``parts``, the runs of words of one language (first word, words, language)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        part = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64()), ("lang", pa.string())]))
        cache: dict[str, int] = {}
        stock = np.empty((0, len(model.labels)))
        names = model.labels
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for lo, hi in slices(sizes, 2 * CHUNK_BYTES):
                texts = b.column(1).slice(lo, hi - lo).to_pylist()
                found = [WORD.findall(t.lower()) if t else [] for t in texts]
                coded = pa.array([w for f in found for w in f], pa.string()).dictionary_encode()
                distinct = coded.dictionary.to_pylist()
                if len(cache) + len(distinct) > CACHE_WORDS:
                    cache, stock = {}, stock[:0]
                new = [w for w in distinct if w not in cache]
                cache.update(zip(new, range(len(cache), len(cache) + len(new))))
                stock = np.concatenate((stock, model.scores(new)))
                # numerals such as superscripts match WORD but are no letters
                letter = np.fromiter((w.isalpha() or any(map(str.isalpha, w)) for w in distinct), bool, len(distinct))
                at = coded.indices.to_numpy()
                doc = np.repeat(np.arange(len(found)), [len(f) for f in found])
                keep = letter[at] if len(at) else np.empty(0, bool)
                at, doc = at[keep], doc[keep]
                size = np.bincount(doc, minlength=len(found))
                begin = np.cumsum(size) - size
                lang, score = ["und"] * len(found), [0.0] * len(found)
                first = count = tongue = held = np.empty(0, np.int64)
                if len(at) and names:
                    row = np.fromiter((cache[w] for w in distinct), np.int64, len(distinct))
                    p, _ = forward_backward(stock[row[at]], begin[size > 0], size[size > 0], model.move)
                    best = p.argmax(1)
                    share = np.add.reduceat(p, begin[size > 0], 0) / size[size > 0][:, None]
                    for i, s in zip(np.flatnonzero(size), share):
                        lang[i], score[i] = names[int(s.argmax())], min(1.0, float(s.max()))
                    cut = np.flatnonzero(np.concatenate(([True], (best[1:] != best[:-1]) | (doc[1:] != doc[:-1]))))
                    held, tongue = doc[cut], best[cut]
                    first, count = cut - begin[held], np.diff(np.append(cut, len(best)))
                spans = pa.StructArray.from_arrays(
                    [pa.array(first), pa.array(count), pa.array(names, pa.string()).take(pa.array(tongue))], fields=list(part.value_type))
                bounds = np.searchsorted(held, np.arange(len(found) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(lang), pa.array(score, pa.float64()),
                     pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), spans, type=part)],
                    names=[key, "lang", "score", "words", "parts"])

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        tidy(run), f"`{key}` {kind}, lang string, score double, words long, "
             "parts array<struct<first: long, words: long, lang: string>>")


def held_out(key: str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the key as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def identify(df: DataFrame, labelled: DataFrame | None = None, *, key: str = "doc_id", text: str = "text",
             label: str = "lang", row: str | None = None) -> DataFrame:
    """``label_words`` with a model fitted on ``labelled`` (default: ``df``) outside the held-out fold;
    ``row``: a column that is returned in place of the key."""
    train = (df if labelled is None else labelled).where(F.crc32(F.col(key).cast("string")) % 5 != 0)
    return label_words(df, fit(sample(train, key=key, text=text, label=label)), key=row or key, text=text)
