"""Personal data: fixed patterns, and a skip-chain conditional random field.

Four patterns give the base spans.  The field labels a text's candidate tokens,
the words that hold a digit or ``@`` (no other word can be part of an entity, so
a word between them cuts the chain, which is exact): O, or the begin or inside of
a kind.  Its potentials are

* unary: a token's shape, digit groups, checks (Luhn, parts up to 255), and the
  kind of word around it;
* chain: learned transitions between neighbouring candidates;
* skip: tokens that repeat, or that end in the same four digits or share the part
  before ``@``, are tied to the previous such token of the document, however far
  off.  A token has one tie back and one ahead, so a document with thousands of
  repeats has as many ties.  Learned weights reward equal kinds, for equal and
  for similar tokens.

Loopy message passing gives each token's marginals; so a number that is plainly a
card or a phone once carries its label to its odder repeats.  A run of tokens
with a kind of probability ``KEEP`` or more is a span, unless it overlaps a base
span; base spans always stay.

Learning is on a bounded sample, ``SAMPLE`` distinct texts of up to
``LONGEST`` characters (longer texts are left out, not cut), labelled by the
patterns, and on ``PRACTICE`` documents written by rule from their words: numbers
of all sorts, and entities that come again in other forms.  Everything else runs
over all rows and whole texts, next to the scan, without a shuffle.  All
documents of a slice pass messages together; a text's candidates take about 500
bytes each.

Defined cases: a null or empty text has no spans and the hash of the empty string;
offsets are code points; a very long text is read in linear time; where runs tie,
the leftmost and longest is taken, and equal probabilities go to the label listed first;
rows with null or repeated keys are reported row by row; without texts to learn
from the practice alone is used; an empty table gives an empty result; other
columns are not read.
"""
from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import CHUNK_BYTES, slices, tidy

# fixed values: kinds in their order, characters of words and local parts, and patterns
KINDS = ("email", "ip", "card", "phone")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?=@)")      # a whole run before @
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")      # elsewhere in a run of digits it cannot match either
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: our parameters: probability of a span, the sample, rounds of messages and of learning
KEEP, SAMPLE, LONGEST, PRACTICE = 0.9, 400, 20_000, 600
ROUNDS, EPOCHS, RATE, BUCKETS = 12, 8, 0.5, 1 << 12
CANDIDATE = "[0-9@]"
#: words that announce a kind (ours)
CUES = {"mail": 0, "email": 0, "contact": 0, "ip": 1, "host": 1, "server": 1, "address": 1, "card": 2, "visa": 2, "credit": 2,
        "phone": 3, "tel": 3, "call": 3, "mobile": 3, "fax": 3}

#: labels: O, then begin and inside of each kind
LABELS = 1 + 2 * len(KINDS)
KIND_OF = np.array([-1, *(i // 2 for i in range(2 * len(KINDS)))])
_NEVER = -30.0
_ALLOWED = np.array([[y == 0 or y % 2 == 1 or KIND_OF[x] == KIND_OF[y] for y in range(LABELS)] for x in range(LABELS)])

_HAS, _CORE = re.compile(CANDIDATE), re.compile(r"[A-Za-z0-9+(*].*[A-Za-z0-9)]|[A-Za-z0-9]", re.S)
_DIGITS, _LETTERS = re.compile("[0-9]+"), re.compile("[A-Za-z]+")

Span = tuple[int, int, int]     # kind, start, end


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    return (sum(map(int, odd)) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    for run in LOCAL.finditer(text):
        lo, domain = max(end, run.start()), DOMAIN.match(text, run.end())
        if domain and lo < run.end():
            end = domain.end()
            yield lo, end


def base_spans(text: str) -> list[Span]:
    """The patterns' matches by kind, then start."""
    out = [(0, a, z) for a, z in emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if _is_ip(m[0])]
    for kind, pattern, low, high in (2, CARD, 13, 19), (3, PHONE, 9, 15):
        for m in pattern.finditer(text):
            d = _digits(m[0])
            if low <= len(d) <= high and (kind == 3 or luhn(d)):
                out.append((kind, m.start(), m.end()))
    return out


def features(token: str, before: str, after: str) -> list[int]:
    """Hashed features of a token's core and of the words beside it."""
    runs = _DIGITS.findall(token)
    digits = sum(map(len, runs))
    shape = re.sub("[a-z]+", "a", re.sub("[A-Z]+", "A", _DIGITS.sub("9", token[:64])))
    found = ["one", "s" + shape[:16], f"d{min(digits, 21)}", "g" + "-".join(str(min(len(r), 9)) for r in runs[:5]),
             f"l{min(len(token) - digits, 12)}", f"r{min(len(runs), 6)}"]
    if "@" in token:
        found += ["@", "@." if "." in token[token.rindex("@"):] else "@-", "@0" if token[0] == "@" or token[-1] == "@" else "@1"]
    if token[0] in "+(*":
        found.append("^" + token[0])
    if digits == len(token) and 13 <= digits <= 19:
        found.append("luhn" if luhn(token) else "no luhn")
    if len(runs) == 4 and _IPLIKE.fullmatch(token):
        found.append("ip" if _is_ip(token) else "no ip")
    for side, word in ("<", before), (">", after):
        word = "".join(_LETTERS.findall(word[:32])).lower()
        found.append(side + str(CUES.get(word, "-")))
    return [zlib.crc32(f.encode()) % BUCKETS for f in found]


_IPLIKE = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")


def tie(token: str) -> str | None:
    """What similar tokens have in common: the part before ``@``, or the last four digits."""
    if "@" in token[1:]:
        return token[:token.index("@", 1)].lower()
    d = _digits(token[-32:])
    return d[-4:] if len(d) >= 4 else None


@dataclass
class Graph:
    """Candidate tokens of several documents: cores, features, chain and skip edges."""
    doc: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    end: list[int] = field(default_factory=list)
    ids: list[list[int]] = field(default_factory=list)
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int, int]] = field(default_factory=list)   # earlier, later, 0: equal, 1: similar

    def add(self, doc: int, text: str) -> None:
        seen: dict[str, tuple[int, str]] = {}
        words = [m.span() for m in WORD.finditer(text)]
        last = -2
        for i, (a, z) in enumerate(words):
            if not _HAS.search(text, a, z):
                continue
            m = _CORE.search(text, a, z)
            a, z = m.span() if m else (a, z)
            token, node = text[a:z], len(self.doc)
            before = text[slice(*words[i - 1])] if i else ""
            after = text[slice(*words[i + 1])] if i + 1 < len(words) else ""
            self.doc.append(doc)
            self.start.append(a)
            self.end.append(z)
            self.ids.append(features(token, before, after))
            if last == i - 1:
                self.chain.append((node - 1, node))
            last = i
            key = tie(token)
            if key is not None:
                if key in seen:
                    self.skip.append((seen[key][0], node, int(seen[key][1] != token)))
                seen[key] = node, token


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, LABELS)))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(LABELS))
    move: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    agree: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))     # equal or similar x both O or both a kind

    def edges(self, g: Graph) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(earlier, later, log potential) of the chain and of both sorts of ties."""
        chain = np.array(g.chain, np.int64).reshape(-1, 2)
        skip = np.array(g.skip, np.int64).reshape(-1, 3)
        out = [(chain[:, 0], chain[:, 1], np.where(_ALLOWED, self.move, _NEVER))]
        same = (KIND_OF[:, None] == KIND_OF[None]).astype(float)
        for sort in range(2):
            e = skip[skip[:, 2] == sort]
            out.append((e[:, 0], e[:, 1], same * np.where(KIND_OF[:, None] < 0, *self.agree[sort])))
        return out

    def unary(self, g: Graph) -> np.ndarray:
        n = np.array([len(x) for x in g.ids], np.int64)
        flat = np.fromiter((f for x in g.ids for f in x), np.int64, int(n.sum()))
        score = np.add.reduceat(self.weights[flat], np.cumsum(n) - n, 0)
        first = np.ones(len(n), bool)
        first[[b for _, b in g.chain]] = False
        return score + np.where(first[:, None], np.where(np.arange(LABELS) % 2 | (np.arange(LABELS) == 0), self.begin, _NEVER), 0)


def _scaled(log: np.ndarray) -> np.ndarray:
    return np.exp(log - log.max(1, keepdims=True))


def beliefs(unary: np.ndarray, edges: list, rounds: int = ROUNDS) -> tuple[np.ndarray, list[np.ndarray]]:
    """Marginals of all nodes, and pair marginals summed over each group of edges, by loopy
    message passing: exact on trees that ``rounds`` reach across."""
    sent = [[np.zeros((len(a), unary.shape[1])) for _ in range(2)] for a, _, _ in edges]

    def total():
        t = unary.copy()
        for (a, b, _), (ahead, back) in zip(edges, sent):   # a node has one edge of a group and side at most
            t[b] += ahead
            t[a] += back
        return t

    for _ in range(rounds):
        t, change = total(), 0.0
        for i, (a, b, pot) in enumerate(edges):
            if not len(a):
                continue
            p = np.exp(pot)
            ahead = np.log(np.maximum(_scaled(t[a] - sent[i][1]) @ p, 1e-300))
            back = np.log(np.maximum(_scaled(t[b] - sent[i][0]) @ p.T, 1e-300))
            new = [m - m.max(1, keepdims=True) for m in (ahead, back)]
            if i:                                           # ties close loops: half a step
                new = [(m + o) / 2 for m, o in zip(new, sent[i])]
            change = max(change, *(float(np.abs(np.exp(m) - np.exp(o)).max()) for m, o in zip(new, sent[i])))
            sent[i] = new
        if change < 1e-4:
            break
    t, pairs = total(), []
    for (a, b, pot), (ahead, back) in zip(edges, sent):
        p = _scaled(t[a] - back)[:, :, None] * np.exp(pot) * _scaled(t[b] - ahead)[:, None, :]
        pairs.append((p / p.sum((1, 2), keepdims=True)).sum(0))
    node = _scaled(t)
    return node / node.sum(1, keepdims=True), pairs


def gold(g: Graph, spans: dict[int, list[Span]]) -> np.ndarray:
    """Labels of the nodes that the documents' spans give (of overlapping ones the first kind)."""
    out, before = np.zeros(len(g.doc), np.int64), None
    for i, (d, a, z) in enumerate(zip(g.doc, g.start, g.end)):
        hit = min((s for s in spans.get(d, ()) if s[1] < z and a < s[2]), default=None)
        if hit:
            out[i] = 1 + 2 * hit[0] + (before == (d, hit))
        before = (d, hit)
    return out


def fit(documents: list[tuple[str, list[Span]]], seed: int = 3) -> Model:
    """A model from (text, spans), by AdaGrad on the likelihood that message passing gives."""
    model, rng = Model(), np.random.default_rng(seed)
    seen = [np.full(x.shape, 1e-6) for x in (model.weights, model.begin, model.move, model.agree)]
    batches = []
    for lo in range(0, len(documents), 8):
        g = Graph()
        for d, (text, _) in enumerate(documents[lo:lo + 8]):
            g.add(d, text)
        if g.doc:
            batches.append((g, gold(g, {d: s for d, (_, s) in enumerate(documents[lo:lo + 8])})))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(batches)):
            g, want = batches[i]
            edges = model.edges(g)
            p, pairs = beliefs(model.unary(g), edges)
            hit = np.zeros_like(p)
            hit[np.arange(len(want)), want] = 1
            step = [np.zeros_like(x) for x in seen]
            flat = np.fromiter((f for x in g.ids for f in x), np.int64)
            np.add.at(step[0], flat, np.repeat(hit - p, [len(x) for x in g.ids], axis=0))
            first = np.ones(len(want), bool)
            first[edges[0][1]] = False
            step[1] += (hit - p)[first].sum(0)
            step[2] -= pairs[0]
            np.add.at(step[2], (want[edges[0][0]], want[edges[0][1]]), 1)
            for sort in range(2):
                a, b, _ = edges[1 + sort]
                for kind, of in enumerate((KIND_OF < 0, KIND_OF >= 0)):
                    same = (KIND_OF[:, None] == KIND_OF[None]) & of[:, None]
                    step[3][sort, kind] = same[want[a], want[b]].sum() - pairs[1 + sort][same].sum()
            for x, s, d in zip((model.weights, model.begin, model.move, model.agree), seen, step):
                d -= 0.002 * x * (d != 0)
                s += d * d
                x += RATE * d / np.sqrt(s)
    return model


def found(base: list[Span], g: Graph, nodes: range, kind: np.ndarray, goes_on: np.ndarray, sure: np.ndarray,
          keep: float) -> list[tuple[int, int, int, float]]:
    """The spans of one document's nodes, without those that overlap ``base``."""
    taken, at = sorted((a, z) for _, a, z in base), 0
    out, i = [], nodes.start
    while i < nodes.stop:
        j = i + 1
        while j < nodes.stop and goes_on[j] and kind[j] == kind[i]:
            j += 1
        a, z, p = g.start[i], g.end[j - 1], float(sure[i:j].min())
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        near = at
        while near < len(taken) and taken[near][0] < z and taken[near][1] <= a:
            near += 1
        if kind[i] >= 0 and p >= keep and not (near < len(taken) and taken[near][0] < z):
            out.append((int(kind[i]), a, z, p))
        i = j
    return out


def detect(texts: list[str], model: Model, keep: float = KEEP) -> list[tuple[list[Span], list[tuple[int, int, int, float]]]]:
    """Of each text: base spans, and added spans with their probability."""
    g, base = Graph(), [base_spans(t) for t in texts]
    cut = [0]
    for d, t in enumerate(texts):
        g.add(d, t)
        cut.append(len(g.doc))
    if not g.doc:
        return [(b, []) for b in base]
    p, _ = beliefs(model.unary(g), model.edges(g))
    by_kind = np.stack([p[:, KIND_OF == k].sum(1) for k in range(-1, len(KINDS))], 1)
    kind = by_kind.argmax(1) - 1
    goes_on = np.zeros(len(kind), bool)
    goes_on[[b for _, b in g.chain]] = True
    goes_on &= p[:, 2::2].max(1) > p[:, 1::2].max(1)       # inside rather than begin
    sure = by_kind.max(1)
    return [(b, found(b, g, range(lo, hi), kind, goes_on, sure, keep)) for b, lo, hi in zip(base, cut, cut[1:])]


# ------------------------------------------------------------------ learning

def _number(rng: random.Random, n: int) -> str:
    return str(rng.randint(1, 9)) + "".join(str(rng.randint(0, 9)) for _ in range(n - 1))


def _other(rng: random.Random) -> str:
    """A number or code that is no entity."""
    n = lambda k: _number(rng, k)
    hexa = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((8, 24, 40))))
    return rng.choice((str(rng.randint(1900, 2030)), n(1), n(2), n(3), n(4), n(5), n(6), n(8), n(10), n(12), n(25), n(40), f"{n(1)}.{n(2)}",
                       f"{n(2)}.{n(3)}", f"${n(2)}.{n(2)}", f"{n(2)}%", f"12:{n(2)}", f"20{n(2)}-0{n(1)}-{n(2)}", f"0{n(1)}/{n(2)}/20{n(2)}",
                       f"{n(1)}.{n(1)}.{n(1)}", f"v{n(1)}.{n(2)}", f"978-3-{n(2)}-{n(6)}-{n(1)}", hexa, f'"{hexa}"', f"AB{n(2)}CD{n(3)}",
                       f"#{n(4)}", f"({n(1)})", f"[{n(2)}]", f"{n(3)},{n(3)}", f"{n(2)}-{n(2)}", f"@{rng.choice('abc')}{n(2)}", f"{n(4)}-{n(4)}",
                       f"{n(3)}.{n(3)}.{n(3)}.999", f"{n(3)}-{n(4)}", f"****{n(4)}", "@"))


def _forms(rng: random.Random, words: list[str]) -> tuple[int, list[str], list[str]]:
    """An entity: its kind, forms that show what it is, and forms that are plain only as repeats of these."""
    kind = rng.randrange(len(KINDS))
    n = lambda k: _number(rng, k)
    if kind == 0:
        name, host = f"{rng.choice(words)}.{n(2)}", f"mail{n(1)}.example.com"
        return kind, [f"{name}@{host}"], [f"{name}@mail{n(1)}", f"{name}@{host}:{n(2)}", f"<{name}@localhost>"]
    if kind == 1:
        ip = ".".join(str(rng.randint(1, 255)) for _ in range(4))
        return kind, [ip], [f"{ip}:{n(4)}", f"{ip}/24", f"http://{ip}/"]
    if kind == 2:
        body = rng.choice("3456") + n(14)
        card = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        four = [card[i:i + 4] for i in range(0, 16, 4)]
        wrong = card[:5] + str((int(card[5]) + 1) % 10) + card[6:]
        return kind, [card, " ".join(four), "-".join(four)], [wrong, f"****{card[-4:]}", f"XXXX-XXXX-XXXX-{card[-4:]}", f"****-{card[-4:]}"]
    a, b, c = n(3), n(3), n(4)
    return kind, [f"+1 ({a}) {b}-{c}", f"+1-{a}-{b}-{c}", f"+49 {a} {b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}"], [f"{b}-{c}", f"{a}{b}{c}", f"1{a}{b}{c}", f"{b}{c}"]


def practice(n: int, words: list[str], seed: int) -> list[tuple[str, list[Span]]]:
    """Documents of corpus words, numbers, and entities in their forms, with the spans meant.
    A form that is plain only as a repeat is meant where a plain form stands in the document."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        items: list[tuple[str, int]] = []
        for _ in range(rng.randint(0, 2)):
            kind, plain, odd = _forms(rng, words)
            forms = [(rng.choice(plain), kind) for _ in range(rng.randint(1, 2))]
            if rng.random() < .3:
                forms = [(rng.choice(odd), -1)]
                if kind < 2:
                    forms = []
            else:
                forms += [(rng.choice(odd), kind) for _ in range(rng.randint(0, 2))]
                if rng.random() < .1:
                    forms += [forms[0]]
            items += forms
        items += [(_other(rng), -1) for _ in range(rng.randint(0, 6))]
        rng.shuffle(items)
        text, spans = "", []
        for item, kind in items:
            text += " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 1, 2, 5)))) + " "
            text += rng.choice(("", "", "", "(", '"'))
            if kind >= 0:
                spans.append((kind, len(text), len(text) + len(item)))
            text += item + rng.choice(("", "", "", ",", ".", "###", "!!")) + rng.choice((" ", " ", "\n"))
        out.append((text, spans))
    return out


def sample(df: DataFrame, text: str = "text", n: int = SAMPLE) -> list[str]:
    """``n`` distinct texts with candidates, of ``LONGEST`` characters at most, by their hashes."""
    t = df.select(F.col(text).cast("string").alias("t")).where(F.col("t").rlike(CANDIDATE) & (F.length("t") <= LONGEST)) \
        .withColumn("h", F.xxhash64("t"))
    least = [r[0] for r in t.select("h").distinct().orderBy("h").limit(n).collect()]
    got = t.where(F.col("h").isin(least)).groupBy("h").agg(F.min("t").alias("t")).collect() if least else []
    return [r["t"] for r in sorted(got)]


def train(df: DataFrame, *, text: str = "text") -> Model:
    texts = sample(df, text)
    words = sorted({w for t in texts[:50] for w in t.split() if w.isalpha()})[:2000] or ["so", "it", "goes"]
    return fit([(t, base_spans(t)) for t in texts] + practice(PRACTICE, words, 11))


# ------------------------------------------------------------------ all rows

SPANS = "array<struct<kind: string, start: long, end: long, score: double, text: string>>"


def find(df: DataFrame, model: Model | None = None, *, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """A row per row of ``df``: the key, ``base`` (``kind:start:end``), and ``spans``, base and
    added ones by kind, then start (``score``: 1 for base spans)."""
    model = model or train(df, text=text)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("text", pa.string())]))
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for lo, hi in slices(sizes, CHUNK_BYTES):
                part = b.slice(lo, hi - lo)
                may = pc.fill_null(pc.match_substring_regex(part.column(1), CANDIDATE), False)
                texts = part.column(1).filter(may).to_pylist()      # others have no spans at all
                got = detect(texts, model, keep) if texts else []
                base, spans = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                for row, t, (fixed, more) in zip(np.flatnonzero(may.to_numpy(zero_copy_only=False)), texts, got):
                    base[row] = [f"{KINDS[k]}:{a}:{z}" for k, a, z in fixed]
                    spans[row] = [{"kind": KINDS[k], "start": a, "end": z, "score": p, "text": t[a:z]}
                                  for k, a, z, p in sorted([(*s, 1.0) for s in fixed] + more)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(base, pa.list_(pa.string())), pa.array(spans, struct)],
                                                 names=[key, "base", "spans"])

    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(tidy(run), f"`{key}` {kind}, base array<string>, spans {SPANS}")
