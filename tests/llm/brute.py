"""Plain Python answers that the operators are held against."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np

from tripline.llm import toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def classes(docs):
    """[(n_shingles, component id)] of (id, text) rows, all pairs."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x]).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (doc, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return [(len(sets[i]), least[find(i)]) for i in range(len(docs))]


def without_repeats(texts, length):
    """[(bytes, removed, spans, sha256 of the rest)]."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def toxicity_scores(rows, labels):
    """{id: score} of (id, text) rows with distinct ids, learned from all ``labels`` {id: 0 or 1}, by counting every gram."""
    counts = np.full((32, 32, 32), 0.1)
    for _, t in rows:
        c = toxicity._CLASS[np.frombuffer((t or "").encode(), np.uint8)]
        for x in zip(c, c[1:], c[2:]):
            counts[x] += 1
    texts = dict(zip([i for i, _ in rows], toxicity.restore([t for _, t in rows], np.log(counts / counts.sum(2, keepdims=True)))))
    fold = bytes.maketrans(bytes([*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]), b" " * 66)

    def grams(text):
        b = f" {text} ".encode().translate(fold)
        return [b[i : i + 5] for i in range(len(b) - 4)]

    seen = [Counter(g for i, y in labels.items() if y == kind and i in texts for g in set(grams(texts[i]))) for kind in (0, 1)]
    n = [sum(y == kind for i, y in labels.items() if i in texts) for kind in (0, 1)]
    weights = {}
    for g, b in seen[1].items():
        a, share = seen[0][g], (seen[0][g] + b) / sum(n)
        odds = np.log((b + 0.5) / (n[1] + 1)) - np.log((a + 0.5) / (n[0] + 1))
        g2 = 2 * (b * np.log(b / (n[1] * share)) + (a * np.log(a / (n[0] * share)) if a else 0))
        if b >= 5 and odds >= toxicity.LEAST_ODDS and g2 >= toxicity.LEAST_G2:
            weights[g] = odds
    assert weights
    told = {i: [weights[g] for g in grams(t) if g in weights] for i, t in texts.items()}
    evidence = {i: [max(w, default=0), np.log1p(len(w))] for i, w in told.items()}
    known = sorted(i for i in labels if i in texts)
    curve = toxicity._logistic(np.array([evidence[i] for i in known]), np.array([labels[i] for i in known], float))
    return {i: 1 / (1 + np.exp(-(e[0] * curve[0] + e[1] * curve[1] + curve[2]))) for i, e in evidence.items()}


def weighted_jaccard(a, b):
    a, b = ([tuple(x[i : i + 5]) for i in range(max(len(x) - 4, 1))] for x in (a, b))
    both = sum((Counter(a) & Counter(b)).values())
    return both / (len(a) + len(b) - both)


def similar_windows(docs, items, similar=0.75, lengths=None):
    """{(doc_id, item_id): best similarity} over every window as long as the item, or of any of ``lengths``."""
    out = {}
    for (i, t), (j, x) in itertools.product(docs, items):
        words, item = (re.findall(r"[^\W_]+", (y or "").lower()) for y in (t, x))
        if words and item and {tuple(item[o : o + 5]) for o in range(len(item))} & {tuple(words[o : o + 5]) for o in range(len(words))}:
            starts = range(max(len(words) - min(len(item), 5) + 1, 1))
            windows = (words[s : s + n] for n in lengths or [len(item)] for s in starts)
            best = max(weighted_jaccard(w, item) for w in windows)
            if best >= similar:
                out[i, j] = best
    return out


def refilled(sizes, weights, most):
    """Targets of a mix by turns: give by weight, fix those above their limit, deal again."""
    fixed, total = {}, float(sum(sizes))
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        level = (total - sum(fixed.values())) / sum(weights[i] for i in free) if free else 0
        above = [i for i in free if level * weights[i] > most * sizes[i]]
        if not above:
            return [fixed.get(i, level * weights[i]) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in above}
