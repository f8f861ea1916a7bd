"""Plain versions of operators, one text or row at a time, that the tests compare with."""

import hashlib
import math
import re
from collections import Counter

import numpy as np

from tallyspark.llm import quality_rules as Q


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_upper, base_failed."""
    w = words(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(tri)
    again = {i + k for i, t in enumerate(tri) if times[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    upper = sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÈÉÊËÎÏÔÖÙÛÜÑÁÍÓÚ" for c in text or "")
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again), upper, len(w) < 50 or 100 * len(again) > 50 * len(w)


def vector(b):
    n, chars, symbols, _, again, upper, _ = b
    n1, c1 = max(n, 1), max(chars, 1)
    return [math.log1p(n), 3 * math.log(chars / n1 + 1), math.sqrt(symbols / c1), math.sqrt(upper / c1), math.sqrt(again / n1)]


def _middle(x):
    """The least value that half of the values don't exceed."""
    return np.sort(x, axis=0)[math.ceil(len(x) / 2) - 1]


def _factor(cov):
    out = np.zeros((5, 5))
    cov = cov + np.diag([v * v for v in Q.VECTOR.values()])
    for i in range(5):
        for j in range(i + 1):
            rest = cov[i, j] - sum(out[i, k] * out[j, k] for k in range(j))
            out[i, j] = round(math.sqrt(max(rest, 1e-9)), 9) if i == j else round(rest / out[j, j], 9)
    return out


def _distance(x, mean, factor):
    z = np.zeros_like(x)
    for i in range(5):
        z[:, i] = (x[:, i] - mean[i] - z[:, :i] @ factor[i, :i]) / factor[i, i]
    return (z * z).sum(axis=1)


def _cut(d2, share):
    b = np.floor(np.log(d2 + 1e-6) * 40).astype(int)
    return b, next(int(k) for k in np.unique(b) if (b <= k).sum() >= len(b) * share)


def estimate(x):
    """Mean, factor and scale of one group by concentration steps from two starts."""
    middle = np.round(_middle(x), 2)
    spread = np.round(1.4826 * _middle(np.abs(x - middle)), 2)
    both = []
    for mean, cov in ((middle, np.diag(spread**2)), (np.round(x.mean(axis=0), 9), np.round(np.cov(x.T, bias=True), 9))):
        factor = _factor(cov)
        for _ in range(Q.STEPS):
            b, cut = _cut(_distance(x, mean, factor), Q.SUBSET)
            core = x[b <= cut]
            mean, factor = np.round(core.mean(axis=0), 9), _factor(np.round(np.cov(core.T, bias=True), 9))
        both.append((np.log(np.diag(factor)).sum(), len(both), mean, factor))
    _, _, mean, factor = min(both, key=lambda r: r[:2])
    _, cut = _cut(_distance(x, mean, factor), 0.5)
    return mean, factor, min(1.0, Q.MEDIAN / math.exp((cut + 0.5) / 40))


def judge(rows):
    """``rows``: (text, lang, source). Base statistics, distance and kept of each."""
    found = [base(t) for t, _, _ in rows]
    keys = [(lang, source) for _, lang, source in rows]
    passed = [i for i, b in enumerate(found) if not b[-1]]
    size = Counter(keys[i] for i in passed)
    rest = Counter()
    for (lang, _), n in size.items():
        rest[lang] += n if n < Q.GROUP_ROWS else 0
    group = {k: ("1", *k) if n >= Q.GROUP_ROWS else ("2", k[0]) if rest[k[0]] >= Q.GROUP_ROWS else ("3",) for k, n in size.items()}
    learn = {}
    for i in passed:
        learn.setdefault(group[keys[i]], []).append(vector(found[i]))
    if 0 < len(learn.get(("3",), ())) < Q.GROUP_ROWS:
        learn[("3",)] = [vector(found[i]) for i in passed]
    made = {g: estimate(np.array(x)) for g, x in learn.items()}
    out = []
    for i, b in enumerate(found):
        g = group.get(keys[i])
        d = None
        if g is not None:
            mean, factor, scale = made[g]
            d = float(_distance(np.array([vector(b)]), mean, factor)[0] * scale)
        out.append((b, d, not b[-1] and (d is None or d <= Q.CUTOFF)))
    return out


def drop_lines(rows, least):
    """``rows``: (id, text, site). The texts without lines on ``least`` sites or more, but in the least id that has them."""
    sites, first = {}, {}
    for i, text, site in rows:
        for line in (text or "").split("\n") if text is not None else ():
            if words(line):
                sites.setdefault(line, set()).add(site)
                if i is not None:
                    first[line] = min(i, first.get(line, i))
    gone = {x for x, s in sites.items() if len(s) >= least}
    return [None if t is None else "\n".join(x for x in t.split("\n") if x not in gone or first.get(x) == i) for i, t, _ in rows]


def components(texts, k=5, similar=0.8):
    """Of each text the first text that links of Jaccard similarity reach."""

    def shingles(text):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}

    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for j in range(len(sets)):
        for i in range(j):
            if len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def hits(text, items, window=10):
    """op2's digest columns of one text."""
    w, hit, found = item_words(text), set(), set()
    for name, item in items:
        v = item_words(item)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == v[i : i + n]:
                    hit |= set(range(p, p + n))
                    found.add(str(name))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)
