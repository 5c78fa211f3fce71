"""Brute-force neighbourhood CF in plain Python, for small inputs only.

Written from the semantics (not from the Spark code): exact rational sums via
``Fraction`` so that zero numerators and ties are exact, a float only at the
final square root and division.
"""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction


def _by_user(train):
    d = defaultdict(dict)
    for u, i, r in train:
        d[u][i] = Fraction(r)
    return d


def _by_item(train):
    d = defaultdict(dict)
    for u, i, r in train:
        d[i][u] = Fraction(r)
    return d


def item_pearson(train, a, b):
    """(exact sort key, float value) of the Pearson similarity of items a, b."""
    bi = _by_item(train)
    co = sorted(set(bi.get(a, {})) & set(bi.get(b, {})))
    if not co:
        return Fraction(0), 0.0
    xs = [bi[a][u] for u in co]
    ys = [bi[b][u] for u in co]
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    num = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    dx = sum((x - mx) ** 2 for x in xs)
    dy = sum((y - my) ** 2 for y in ys)
    if num == 0 or dx == 0 or dy == 0:
        return Fraction(0), 0.0
    key = (1 if num > 0 else -1) * num * num / (dx * dy)
    return key, float(num) / (math.sqrt(float(dx)) * math.sqrt(float(dy)))


def item_sum_normalized(train, a, b):
    bi = _by_item(train)
    co = sorted(set(bi.get(a, {})) & set(bi.get(b, {})))
    sxy = sum((bi[a][u] * bi[b][u] for u in co), Fraction(0))
    sx = sum((bi[a][u] for u in co), Fraction(0))
    sy = sum((bi[b][u] for u in co), Fraction(0))
    if sxy == 0 or sx * sy == 0:
        return Fraction(0), 0.0
    v = sxy / (sx * sy)
    return v, float(v)


def user_pearson(train, u, v):
    bu = _by_user(train)
    mu = sum(bu[u].values()) / len(bu[u]) if bu.get(u) else None
    mv = sum(bu[v].values()) / len(bu[v]) if bu.get(v) else None
    co = sorted(set(bu.get(u, {})) & set(bu.get(v, {})))
    if not co:
        return Fraction(0), 0.0
    num = sum((bu[u][i] - mu) * (bu[v][i] - mv) for i in co)
    du = sum((bu[u][i] - mu) ** 2 for i in co)
    dv = sum((bu[v][i] - mv) ** 2 for i in co)
    if num == 0 or du == 0 or dv == 0:
        return Fraction(0), 0.0
    key = (1 if num > 0 else -1) * num * num / (du * dv)
    return key, float(num) / (math.sqrt(float(du)) * math.sqrt(float(dv)))


def _user_mean(bu, u):
    return float(sum(bu[u].values()) / len(bu[u])) if bu.get(u) else None


def item_based(train, truth, k=10, metric="pearson"):
    """{(u, i): (prediction, source)} for the answered test pairs."""
    bu = _by_user(train)
    g = float(sum(Fraction(r) for _, _, r in train) / len(train)) if train else None
    simf = item_pearson if metric == "pearson" else item_sum_normalized
    out = {}
    for u, i, _ in truth:
        mean = _user_mean(bu, u)
        if mean is None:
            out[(u, i)] = (g, "global_mean")
            continue
        cands = []
        for j, r in bu[u].items():
            key, val = simf(train, i, j)
            cands.append((-key, j, val, float(r)))
        cands.sort()
        top = cands[:k]
        num = 0.0
        den = 0.0
        for _, _, val, r in top:
            num += r * val
            den += abs(val)
        if num != 0 and den != 0:
            out[(u, i)] = (num / den, "neighbors")
        else:
            out[(u, i)] = (mean, "user_mean")
    return out


def user_based(train, truth, k=1, loo="literal"):
    bu = _by_user(train)
    bi = _by_item(train)
    g = float(sum(Fraction(r) for _, _, r in train) / len(train)) if train else None
    out = {}
    for u, i, _ in truth:
        mean = _user_mean(bu, u)
        raters = bi.get(i, {})
        if mean is None:
            out[(u, i)] = (g, "global_mean")
            continue
        cands = []
        for v, r in raters.items():
            key, val = user_pearson(train, u, v)
            cands.append((-key, v, val, r))
        cands.sort()
        num = 0.0
        den = 0.0
        for _, v, val, r in cands[:k]:
            n, s = len(bu[v]), sum(bu[v].values())
            if loo == "literal":
                dev = r - ((s - r) / n - 1)
            else:
                dev = r - (s - r) / (n - 1) if n > 1 else Fraction(0)
            num += float(dev) * val
            den += abs(val)
        if num != 0 and den != 0:
            out[(u, i)] = (mean + num / den, "neighbors")
        else:
            out[(u, i)] = (mean, "user_mean")
    return out
