"""Plain forms of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, size=5):
    w = words(text, True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1)))


def linked(rows, size=5, percent=80):
    """[(id, set size, component)] in the order of rows; components name their smallest id, null only if there is no other."""
    sets = [shingles(t, size) for _, t in rows]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    up = list(range(len(rows)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k
    for k, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j > k).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                up[max(top(k), top(j))] = min(top(k), top(j))
    names = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            names[top(k)].append(i)
    return [(i, len(sets[k]), min(names[top(k)], default=None)) for k, (i, _) in enumerate(rows)]


def without_repeats(rows, length=35):
    """[(id, words, removed, kept text)] in the order of rows."""
    split = [words(t) for _, t in rows]
    times = Counter(tuple(w[i: i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, split):
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if times[tuple(w[s: s + length])] > 1:
                gone[s: s + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def language_model(rows, learn, discount=0.75):
    """[(id, tokens, known, N, base, score)] in the order of rows; probabilities aren't quantised."""
    uni, pairs, after, kinds = Counter(), Counter(), Counter(), Counter()
    texts = [words(t, True) + [" end"] for _, t in rows]
    for (i, _), w in zip(rows, texts):
        if learn(i):
            uni.update(w)
            pairs.update(zip([" start", *w], w))
    for (b, _), n in pairs.items():
        after[b] += n
        kinds[b] += 1
    n_all, bottom = sum(uni.values()), math.log10(sum(uni.values()) + len(uni) + 1)

    def one(b, c):
        if pairs[b, c]:
            return math.log10((pairs[b, c] - discount) / after[b])
        return (math.log10(discount * kinds[b] / after[b]) if after[b] else 0) + math.log10(uni[c] + 1) - bottom
    return [(i, len(w), sum(uni[x] > 0 for x in w), n_all, sum(math.log10(uni[x] + 1) - bottom for x in w),
             sum(one(b, c) for b, c in zip([" start", *w], w))) for (i, _), w in zip(rows, texts)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
