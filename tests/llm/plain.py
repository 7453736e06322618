"""Plain Python versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEST_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=WORD, lower=False):
    data = (text or "").encode()
    return pattern.findall(data.lower() if lower else data)


def shingles(text):
    w = words(text, lower=True)
    if 0 < len(w) < 5:
        return {tuple(w)}
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def near_duplicates(docs):
    """{(doc_id, n_shingles, component_id, kept)}"""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in ids}


def repeats(docs):
    """{(doc_id, n_words, n_removed, kept_sha256)}"""
    lists = {i: words(t) for i, t in docs}
    seen, gone = set(), {i: set() for i in lists}
    for i in sorted(lists):
        for k in range(len(lists[i]) - 19):
            window = tuple(lists[i][k:k + 20])
            if window in seen:
                gone[i].update(range(k, k + 20))
            seen.add(window)
    out = set()
    for i, w in lists.items():
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone[i])
        out.add((i, len(w), len(gone[i]), hashlib.sha256(kept).hexdigest()))
    return out


def decontamination(docs, items):
    """{(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = {}
    for name, text in items:
        w = words(text, TEST_WORD, lower=True)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(name))
    out = set()
    for i, text in docs:
        w = words(text, TEST_WORD, lower=True)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                names = windows.get(tuple(w[k:k + n]))
                if names:
                    hit.update(range(k, k + n))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.add((i, len(w), len(hit), len(found), digest, bool(hit)))
    return out


PERSONAL = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    """[(kind, start, end)] of the base kinds, in order."""
    found = []
    for rank, (kind, pattern) in enumerate(PERSONAL.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split("."))
                    if kind == "ip" else True,
                    "card": 14 <= len(digits) <= 19 and luhn(digits),
                    "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(found)]


def top_k(vectors, k=10, every=100):
    """{(query_id, rank, vec_id, score)}"""
    import math
    good = {i: [math.floor(1024 * x) for x in v] for i, v in vectors if v is not None
            and i is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, v in good.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i)
                            for i, w in good.items() if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    return out


def sections_of(lengths, spans, rule):
    """Tokens of each section and outside, one token at a time."""
    counts, at = [0.0] * (len(spans) + 1), 0
    for n in lengths:
        held = [max(0, min(at + n, e) - max(at, s)) for s, e in spans]
        at += n
        touched = [i for i, h in enumerate(held) if h]
        if not touched:
            counts[-1] += 1
        elif rule == "share":
            for i in touched:
                counts[i] += held[i] / sum(held)
        elif rule == "first":
            counts[touched[0]] += 1
        else:
            counts[max(touched, key=lambda i: (held[i], -i))] += 1
    return counts


def runs(values):
    return [(k, len(list(g))) for k, g in groupby(values)]


def scaled(tokens, codes, goals, rounds=200, close=1e-7):
    """Scales cells until their sums meet each dimension's goals.

    codes has each cell's category, a number, in each dimension; a dimension without
    goals is left as it is.
    """
    fitted, total = tokens.astype(float), float(tokens.sum())
    for _ in range(rounds):
        before = fitted
        for code, goal in zip(codes, goals, strict=True):
            if goal is not None:
                now = np.bincount(code, fitted, len(goal))
                factor = np.divide(goal, now, out=np.zeros_like(goal), where=now > 0)
                fitted = np.minimum(fitted * factor[code], tokens)
        if float(np.abs(fitted - before).max(initial=0)) <= close * total:
            break
    return fitted


def raked(tokens, targets, fraction=1.0):
    """Scales a table until its sums along each axis are in the targets' shares.

    The sums are `fraction` of all tokens; no cell exceeds what it has, so a target
    beyond what there is takes all of it. Only categories that have tokens count;
    their shares are taken over them. Targets that contradict each other, as empty
    cells can make them, end with the last scaling.
    """
    total = float(tokens.sum())
    codes = [code.ravel() for code in np.indices(tokens.shape)]
    goals = []
    for code, share, size in zip(codes, targets, tokens.shape, strict=True):
        share = np.where(np.bincount(code, tokens.ravel(), size) > 0, share, 0.0)
        goals.append(fraction * total * share / share.sum() if share.sum() else None)
    return scaled(tokens.ravel(), codes, goals).reshape(tokens.shape)


def chances(cells, targets, fraction, evening, rounds=200):
    """{(source, lang, topic): chance} of cells {(source, lang, topic): tokens}."""
    keys = sorted(cells)
    tokens = np.array([cells[k] for k in keys], float)
    total = max(float(tokens.sum()), 1.0)
    codes, goals = [], []
    for i, dimension in enumerate(("source", "lang", "topic")):
        names, code = np.unique(np.array([k[i] for k in keys], object), return_inverse=True)
        present = np.bincount(code, tokens, len(names)) / total
        wanted = targets.get(dimension)
        share = (present ** evening if not wanted else
                 np.array([wanted.get(n, p) for n, p in zip(names, present, strict=True)]))
        share = np.where(present > 0, share, 0.0)
        codes.append(code)
        goals.append(fraction * tokens.sum() * share / share.sum() if share.sum() else None)
    fitted = scaled(tokens, codes, goals, rounds)
    return {k: f / t if t else 1.0 for k, f, t in zip(keys, fitted, tokens, strict=True)}
