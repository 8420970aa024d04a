"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = str.maketrans(UPPER, LOWER)


def fold(text: str | None) -> str:
    return (text or "").translate(_FOLD)


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def contamination(text, items: list[tuple], window: int = 10):
    """(words, hit words, names of items that occur)."""
    words, hit, names = alnum_words(text), set(), set()
    for name, item in items:
        w = alnum_words(item)
        n = min(window, len(w))
        if name is None or not n:
            continue
        wins = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}
        for k in range(len(words) - n + 1):
            if tuple(words[k:k + n]) in wins:
                hit |= set(range(k, k + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def shingles(text, n: int) -> set:
    w = space_words(text)
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def groups(rows: list[tuple], n: int, percent: int) -> dict:
    """Smallest id reachable, for (id, text) rows with ids of their own."""
    sets = {i: shingles(t, n) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if 100 * min(len(sets[a]), len(sets[b])) < percent * max(len(sets[a]), len(sets[b])):
                continue
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def targets(sizes: dict, weights=(5, 2, 1), share=1.5, cap=2) -> dict:
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not above:
            break
        for s in above:
            out[s] = float(cap * sizes[s])
            free.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    for s in free:
        out[s] = left * weight[s] / sum(weight[s] for s in free)
    return out


def backoff(texts: list, alpha: float = 0.4, unseen: float = 0.5, order: int = 3) -> list[tuple]:
    """(words, backed off, log-probability) of each text under all others; n-grams up to that order."""
    docs = [alnum_words(t) for t in texts]
    grams = lambda w: Counter(tuple(w[k:k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1))
    all_, total = Counter(), 0
    for w in docs:
        all_.update(grams(w))
        total += len(w)
    out = []
    for w in docs:
        own, lp, backed = grams(w), 0.0, 0
        c = lambda g: all_[g] - own[g]
        for k, x in enumerate(w):
            context = tuple(w[max(0, k - order + 1):k])
            backed += bool(context) and not c((*context, x))
            while context and not c((*context, x)):
                lp += math.log(alpha)
                context = context[1:]
            lp += math.log(c((*context, x)) / c(context)) if context else math.log((c((x,)) or unseen) / max(total - len(w), 1))
        out.append((len(w), backed, lp))
    return out


_ANY_CASE = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "(password|passwd|secret|token|api_?key)")
SECRETS = (("assign", re.compile(_ANY_CASE + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
           ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
           ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32))


def secrets(text: str | None) -> list[str]:
    found = [(m.start(), k, m.end()) for k, (_, rule, ok) in enumerate(SECRETS) for m in rule.finditer(text or "") if ok(m)]
    return [f"{SECRETS[k][0]}:{s}:{e}" for s, k, e in sorted(found)]


def turns(rows: list[tuple]) -> dict:
    """conv -> [(role, text)], rows being (conv, turn, role, text)."""
    first = lambda v: (v is not None, v if v is not None else 0)  # noqa: E731  nulls first
    out = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (first(r[0]), first(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        out[conv].append((role or "", text or ""))
    return out
