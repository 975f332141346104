"""Language identification by segmentation-marginalised unigrams.

The vocabulary is that of a public tokenizer, fixed; each language has a probability for each
of its pieces.  A word's probability in a language is the sum over all its segmentations into
pieces, by the forward algorithm; a text's score is the sum of its words' logarithms.  The
probabilities are fitted with expectation-maximisation (forward-backward) on at most SAMPLE
labelled texts of each language, taken by the hash of their id.

Words start with a marker byte and end where `textkit` ends them; single bytes are pieces too,
so that every text has a score.  Forward runs over the distinct words of a batch at once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import textkit as tk
from tidemark.llm.common import sized

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE, ROUNDS, SMOOTH = 1000, 4, 0.05
MARK = 0x20
SCALE = 64.0  # probabilities are kept times SCALE per byte, so that products stay in range
LONG_WORD = 64  # bytes from which words need rescaling
LONG_CELLS = 1 << 19
BATCH_BYTES = 4 << 20
UNKNOWN = "und"

_M = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 18


class Pieces:
    """The pieces as bytes, and a hash table of all their prefixes."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces])
        self.longest = int(self.sizes.max(initial=1))
        ids = {p: k for k, p in enumerate(pieces)}
        prefixes = sorted({p[:n] for p in pieces for n in range(1, len(p) + 1)})
        h = np.array([self._hash(p) for p in prefixes], np.uint64)
        self.keys = h
        self.ids = np.array([ids.get(p, -1) for p in prefixes], np.int32)
        self.tables: list[np.ndarray] = []
        left = np.arange(len(h), dtype=np.int32)
        while len(left):
            slots = (h[left] * _M) >> np.uint64(64 - _SLOTS)
            table = np.full(1 << _SLOTS, -1, np.int32)
            table[slots] = left
            self.tables.append(table)
            left = left[table[slots] != left]

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(_M) + int(tk._BYTE_CODE[b])) & 0xFFFFFFFFFFFFFFFF
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Prefix numbers, or -1."""
        slots = (h * _M) >> np.uint64(64 - _SLOTS)
        out = np.full(len(h), -1, np.int32)
        for table in self.tables:
            k = table[slots]
            ok = (k >= 0) & (self.keys[k] == h)
            out[ok] = k[ok]
        return out

    def edges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every place where a piece matches in the words data[start:end]: (word, from, to, piece), by to."""
        lens = end - start
        n = lens + 1
        head = np.cumsum(n) - n
        buf = np.full(int(n.sum()), MARK, np.uint8)
        body = np.ones(len(buf), bool)
        body[head] = False
        buf[body] = data[np.repeat(start - np.cumsum(lens) + lens, lens) + np.arange(int(lens.sum()))]
        word = np.repeat(np.arange(len(n)), n)
        left = np.repeat(head + n, n) - np.arange(len(buf))
        at, h = np.arange(len(buf)), np.zeros(len(buf), np.uint64)
        out = []
        for size in range(1, self.longest + 1):
            keep = left[at] >= size
            at, h = at[keep], h[keep]
            h = h * _M + tk._BYTE_CODE[buf[at + size - 1]]
            k = self.find(h)
            at, h, k = at[k >= 0], h[k >= 0], k[k >= 0]
            if not len(at):
                break
            hit = self.ids[k] >= 0
            s = at[hit] - head[word[at[hit]]]
            out.append((word[at[hit]], s, s + size, self.ids[k[hit]]))
        w, s, e, p = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(e, kind="stable")
        return w[order], s[order], e[order], p[order]


def load(path: str = VOCABULARY) -> list[bytes]:
    """The pieces that can occur in words, lower-cased as texts are, with the marker for a word's start, and the single bytes of words."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([b]) for b in np.flatnonzero(tk._WORD_BYTE)} | {bytes([MARK])}
    for k in range(sp.get_piece_size()):
        if sp.is_control(k) or sp.is_unknown(k) or sp.is_byte(k):
            continue
        raw = sp.id_to_piece(k).lower().replace("▁", chr(MARK)).encode()
        if raw and raw.rfind(b" ") < 1 and all(tk._WORD_BYTE[b] for b in raw.lstrip(b" ")):
            out.add(raw)
    return sorted(out)


def forward(edges: tuple[np.ndarray, ...], n: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(alpha, log scale): sums over the segmentations of each word's first t bytes, by language.
    p: pieces x languages, times SCALE per byte.  n: bytes of each word with its marker."""
    w, s, e, k = edges
    longest, reach = int(n.max(initial=0)), int((e - s).max(initial=1))
    alpha = np.zeros((len(n), longest + 1, p.shape[1]))
    alpha[:, 0] = 1.0
    log = np.zeros((len(n), p.shape[1]))
    cut = np.searchsorted(e, np.arange(longest + 2))
    for t in range(1, longest + 1):
        i = slice(cut[t], cut[t + 1])
        c = alpha[w[i], s[i]] * p[k[i]]
        for x in range(p.shape[1]):
            alpha[:, t, x] = np.bincount(w[i], weights=c[:, x], minlength=len(n))
        if longest > LONG_WORD + 1:
            # rescale words that leave the range of floats; the next values need those of a piece's length back
            far = (n >= t)[:, None] & (alpha[:, t] > 0) & ((alpha[:, t] < 1e-60) | (alpha[:, t] > 1e60))
            if far.any():
                f = np.where(far, alpha[:, t], 1.0)
                alpha[:, max(0, t - reach) : t + 1] /= f[:, None, :]
                log += np.log(f)
    return alpha, log


def word_logs(pieces: Pieces, p: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.zeros((len(start), p.shape[1]))
    size = end - start
    order = np.argsort(size, kind="stable")
    cuts = np.searchsorted(size[order], [8, 16, 32, LONG_WORD])
    groups = [g[i : i + 100_000] for g in np.split(order, cuts) for i in range(0, len(g), 100_000)]
    big = [[i] for i in order[cuts[-1] :]]
    for g in [*(x for x in groups if len(x) and size[x[0]] < LONG_WORD), *map(np.array, big)]:
        n = size[g] + 1
        alpha, log = forward(pieces.edges(data, start[g], end[g]), n, p)
        with np.errstate(divide="ignore"):
            out[g] = np.log(alpha[np.arange(len(g)), n]) + log - n[:, None] * np.log(SCALE)
    return out


def _sums(place: np.ndarray, other: np.ndarray, w: np.ndarray, logq: np.ndarray, steps: range, out: np.ndarray) -> None:
    """Fill out (words x places, logarithms) step by step from the edges that end in each place."""
    by = np.argsort(place, kind="stable")
    cut = np.searchsorted(place[by], np.arange(out.shape[1] + 1))
    ref = np.zeros(len(out))
    for t in steps:
        i = by[cut[t] : cut[t + 1]]
        if not len(i):
            continue
        # a word's sum so far is its reference, so that no term leaves the range of floats
        total = np.bincount(w[i], weights=np.exp(out[w[i], other[i]] - ref[w[i]] + logq[i]), minlength=len(out))
        full = total > 0
        out[full, t] = ref[full] = ref[full] + np.log(total[full])


def long_counts(edges: tuple[np.ndarray, ...], n: np.ndarray, q: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in words of any length: forward-backward in logarithms."""
    w, s, e, k = edges
    with np.errstate(divide="ignore"):
        logq = np.log(q[k])
    longest = int(n.max())
    alpha, beta = (np.full((len(n), longest + 1), -np.inf) for _ in range(2))
    alpha[:, 0] = beta[np.arange(len(n)), n] = 0.0
    _sums(e, s, w, logq, range(1, longest + 1), alpha)
    _sums(s, e, w, logq, range(longest - 1, -1, -1), beta)
    z = alpha[np.arange(len(n)), n]
    i = np.flatnonzero(np.isfinite(z[w]))
    part = np.exp(alpha[w[i], s[i]] + logq[i] + beta[w[i], e[i]] - z[w[i]]) * weight[w[i]]
    return np.bincount(k[i], weights=part, minlength=len(q))


def fit(pieces: Pieces, texts: pa.Array, rounds: int, smooth: float) -> np.ndarray:
    """Piece probabilities of one language, by expectation-maximisation over the distinct words."""
    data, start, end, weight = [], [], [], []
    for _, part in tk.chunked(texts, BATCH_BYTES):
        w = tk.words_of(part)
        u, first, count = np.unique(w.hash, return_index=True, return_counts=True)
        base = sum(len(d) for d in data)
        data.append(w.data)
        start.append(w.start[first] + base)
        end.append(w.end[first] + base)
        weight.append(count)
    p = np.full((len(pieces.pieces), 1), 1.0 / len(pieces.pieces))
    scale = (SCALE**pieces.sizes)[:, None]
    if not data:
        return p[:, 0]
    buf, a, b, c = (np.concatenate(x) for x in (data, start, end, weight))
    order = np.argsort(b - a, kind="stable")
    order, far = np.split(order, [np.searchsorted((b - a)[order], LONG_WORD)])
    groups = [order[i : i + 50_000] for i in range(0, len(order), 50_000)]
    long = []
    while len(far):
        # words of similar length together, about LONG_CELLS places, at least one word
        size = (b - a)[far]
        m = max(1, int(np.searchsorted(size * np.arange(1, len(far) + 1), LONG_CELLS, side="right")))
        long.append(far[:m])
        far = far[m:]
    edges = [pieces.edges(buf, a[g], b[g]) for g in groups]
    for _ in range(rounds):
        got = np.zeros(len(p))
        for g, (w, s, e, k) in zip(groups, edges):
            n = b[g] - a[g] + 1
            q = p * scale
            alpha, _ = forward((w, s, e, k), n, q)
            beta = np.zeros(alpha.shape[:2])
            beta[np.arange(len(g)), n] = 1.0
            by = np.argsort(s, kind="stable")
            cut = np.searchsorted(s[by], np.arange(int(n.max(initial=0)) + 2))
            for t in range(int(n.max(initial=0)) - 1, -1, -1):
                i = by[cut[t] : cut[t + 1]]
                beta[:, t] += np.bincount(w[i], weights=beta[w[i], e[i]] * q[k[i], 0], minlength=len(g))
            z = alpha[np.arange(len(g)), n, 0]
            part = alpha[w, s, 0] * q[k, 0] * beta[w, e] / z[w] * c[g][w]
            got += np.bincount(k, weights=part, minlength=len(p))
        for g in long:  # their edges are found again each round, not kept
            got += long_counts(pieces.edges(buf, a[g], b[g]), b[g] - a[g] + 1, (p * scale)[:, 0], c[g])
        p = ((got + smooth) / (got + smooth).sum())[:, None]
    return p[:, 0]


@dataclass
class Model:
    languages: list[str]
    pieces: list[bytes]
    p: np.ndarray  # pieces x languages

    def name(self) -> bytes:
        return hashlib.blake2b(b"\0".join(self.pieces) + self.p.tobytes()).digest()


#: The tables of the model in use; a Python worker keeps them from task to task.
_TABLES: dict[bytes, tuple[Pieces, np.ndarray]] = {}


def _tables(name: bytes, model: Model) -> tuple[Pieces, np.ndarray]:
    if name not in _TABLES:
        known = Pieces(model.pieces)
        _TABLES.clear()
        _TABLES[name] = known, model.p * (SCALE**known.sizes)[:, None]
    return _TABLES[name]


def train(docs: DataFrame, vocabulary: str = VOCABULARY, sample: int = SAMPLE, rounds: int = ROUNDS, smooth: float = SMOOTH, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fitted to rows with a language and a text; each language in a task of its own."""
    pieces = load(vocabulary)
    lang, key = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{id_col}`")
    own = docs.select(key.alias("id"), lang.alias("lang")).where("id IS NOT NULL AND lang IS NOT NULL AND lang <> ''")
    # each partition keeps its first `sample` rows of a language before the shuffle (WindowGroupLimit)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = own.withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample).select("id", "lang").distinct()
    rows = docs.select(key.alias("id"), lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL").join(sized(chosen), ["id", "lang"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "text"])
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "p": [fit(Pieces(pieces), pa.array(pdf["text"], pa.string()), rounds, smooth)]})

    found = {r["lang"]: r["p"] for r in rows.groupBy("lang").applyInPandas(run, "lang string, p array<double>").collect()}
    languages = sorted(found)
    return Model(languages, pieces, np.array([found[x] for x in languages]).T.reshape(len(pieces), len(languages)))


def identify(model: Model, text: Column) -> Column:
    """struct(language, margin) of a text: the likeliest language and its lead over the next, in nats a word.
    Null texts, texts without words and models without languages give 'und' and 0; ties go to the first by name."""
    name = model.name()

    @F.arrow_udf("struct<language string, margin double>")
    def judge(texts: pa.Array) -> pa.Array:
        tables = _tables(name, model)
        names, margins = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        for at, part in tk.chunked(texts, BATCH_BYTES) if model.languages else ():
            w = tk.words_of(part)
            if not len(w.hash):
                continue
            _, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
            logs = word_logs(*tables, w.data, w.start[first], w.end[first])
            total = np.stack([np.bincount(w.doc, weights=logs[back, x], minlength=len(part)) for x in range(len(model.languages))], 1)
            best = np.argmax(total, 1)
            ranked = np.sort(total, 1)
            n = np.diff(w.first)
            some = np.flatnonzero(n)
            names[at + some] = np.array(model.languages, object)[best[some]]
            if len(model.languages) > 1:
                margins[at + some] = (ranked[some, -1] - ranked[some, -2]) / n[some]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(margins)], ["language", "margin"])

    return judge(text.cast("string"))


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """(doc_id, language, margin) for every row of docs, repeated rows and rows without an id too.

    Null, empty and word-free texts are 'und' with margin 0; others are read whole, however long.  Ties go to the first
    language by name.  Rows without a language are judged, not fitted to; ids may be of any type.  An empty table gives
    an empty result; columns other than the three named aren't read, whatever their names."""
    model = train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, **options)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), identify(model, F.col(f"`{text_col}`")).alias("s")).select("doc_id", "s.language", "s.margin")
