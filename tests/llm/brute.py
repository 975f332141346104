"""Independent versions of operators, in plain Python, for small corpora."""

import itertools
import math
import re

from tidemark.llm import toxicity


def tokens(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", (text or "").lower())


def toxic_scores(texts, labels, order, epochs=toxicity.EPOCHS, l1=toxicity.L1):
    """{id: (score, toxic)}: FTRL-proximal over sets of words, word pairs and pairs with one word skipped, in the
    order given (a number for each id; every fifth is held out), and the threshold of the best F1 on those held out."""

    def features(text):
        w = tokens(text)
        return {(1, x) for x in w} | {(2, *x) for x in zip(w, w[1:])} | {(3, *x) for x in zip(w, w[2:])} | {"bias"}

    z, n = {}, {}

    def weight(f):
        root = toxicity.BETA + math.sqrt(n.get(f, 0.0))
        zf = z.get(f, 0.0)
        if f == "bias":
            return -zf * toxicity.ALPHA / root
        return 0.0 if abs(zf) <= l1 else -(zf - math.copysign(l1, zf)) / (root / toxicity.ALPHA + toxicity.L2)

    ids = sorted(labels, key=lambda i: order[i])
    fit, held = [i for i in ids if order[i] % 5], [i for i in ids if not order[i] % 5]
    for _ in range(epochs):
        for i in fit:
            fs = features(texts[i])
            w = {f: weight(f) for f in fs}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - labels[i]
            for f in fs:
                old = n.get(f, 0.0)
                n[f] = old + g * g
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n[f]) - math.sqrt(old)) / toxicity.ALPHA * w[f]
    margin = {i: sum(weight(f) for f in features(t)) for i, t in texts.items()}
    test = sorted((margin[i] for i in held), reverse=True)
    best = (-1.0, math.inf)
    for k, m in enumerate(test):
        if k + 1 < len(test) and test[k + 1] == m:
            continue
        hit = sum(labels[i] for i in held if margin[i] >= m)
        if hit <= k + 1 - hit:
            continue
        f1 = 2 * hit / (k + 1 + sum(labels[i] for i in held))
        if f1 > best[0] + 1e-12:
            best = (f1, (m + test[k + 1]) / 2 if k + 1 < len(test) else m - 1e-6)
    return {i: (1 / (1 + math.exp(-margin[i])), margin[i] >= best[1]) if tokens(t) else (0.0, False) for i, t in texts.items()}


def shared_lines(data, least=50):
    """{id: lines in a run of `least` bytes that an earlier text has too}, over all pairs of texts."""
    seq = {i: [x.strip() for x in t.split("\n")] for i, t in data}
    cut = {i: set() for i in seq}
    for b, a in itertools.product(seq, seq):
        for i, j in itertools.product(range(len(seq[b])), range(len(seq[a]))) if a < b else ():
            n = 0
            while i + n < len(seq[b]) and j + n < len(seq[a]) and seq[b][i + n] == seq[a][j + n]:
                n += 1
            if sum(len(x.encode()) for x in seq[b][i : i + n]) >= least:
                cut[b].update(range(i, i + n))
    return cut


def without_lines(data, cut):
    out = {}
    for i, t in data:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut.get(i, ()))
        if left.strip() or not cut.get(i):
            out[i] = left
    return out


def near_groups(data, threshold=0.6, size=3):
    """{id: least id of its group}: components of all pairs of similar shingle sets."""
    sets = {}
    for i, t in data:
        w = tokens(t)
        if w:
            sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or {tuple(w)}
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in itertools.combinations(sets, 2):
            if label[a] != label[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                label[a] = label[b] = min(label[a], label[b])
    return label


def uses(supply):
    """{source: how many of its tokens are due}: weights go from the natural shares to those by square root."""
    total = sum(supply.values())
    root = sum(math.sqrt(n / total) for n in supply.values())
    share = {s: (n / total + math.sqrt(n / total) / root) / 2 for s, n in supply.items()}
    run = max(supply[s] / share[s] for s in supply)
    return {s: max(supply[s], round(run * share[s])) for s in supply}


def least_bins(sizes, capacity):
    """The least number of bins, over all ways to fill them."""
    full = (1 << len(sizes)) - 1
    total = [sum(x for k, x in enumerate(sizes) if m >> k & 1) for m in range(full + 1)]
    best = [0] + [len(sizes)] * full
    for m in range(1, full + 1):
        sub = m
        while sub:
            if total[sub] <= capacity and best[m ^ sub] + 1 < best[m]:
                best[m] = best[m ^ sub] + 1
            sub = (sub - 1) & m
    return best[full]


def segmentations(word, pieces):
    """Every way to cut the word (bytes) into pieces."""
    return [[]] if not word else [[p, *rest] for p in pieces if word.startswith(p) for rest in segmentations(word[len(p) :], pieces)]


def language_model(texts, pieces, rounds, smooth):
    """Piece probabilities by expectation-maximisation over all segmentations of the words."""
    p = dict.fromkeys(pieces, 1 / len(pieces))
    for _ in range(rounds):
        got = dict.fromkeys(pieces, smooth)
        for t in texts:
            for w in tokens(t):
                ways = segmentations(b" " + w.encode(), pieces)
                weight = [math.prod(p[x] for x in way) for way in ways]
                for way, v in zip(ways, weight):
                    for x in way:
                        got[x] += v / sum(weight)
        p = {x: v / sum(got.values()) for x, v in got.items()}
    return p


def language_of(text, models, pieces):
    """(language, margin): the likeliest model and its lead over the next, in nats a word."""
    words = tokens(text)
    total = {name: sum(math.log(sum(math.prod(p[x] for x in way) for way in segmentations(b" " + w.encode(), pieces))) for w in words) for name, p in models.items()}
    first, second = sorted(total.values(), reverse=True)[:2]
    return max(sorted(total), key=total.get), (first - second) / len(words)
