"""Plain restatements of the operators' contracts."""

import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def low(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def contamination(docs, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(low(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for d, text in docs:
        w = WORD.findall(low(text))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    hit |= set(range(i, i + n))
                    found |= ids
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text):
    w = WORD.findall(low(text))
    return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None


def overlap(a, b):
    both = sum(min(c, b.get(k, 0)) for k, c in a.items())
    return both / (sum(a.values()) + sum(b.values()) - both)


def near_classes(docs, threshold=0.8):
    """docs: (id, text) with ids; the least id of each row's class."""
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(t) for _, t in docs]
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and overlap(sets[a], sets[b]) >= threshold:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for a, (i, _) in enumerate(docs):
        least[find(a)] = min(i, least.get(find(a), i))
    return [(i, least[find(a)]) for a, (i, _) in enumerate(docs)]


def without_repeats(docs, min_words=50):
    """docs: (id, text), ids distinct; (id, text, removed) after deleting later copies of long line runs."""
    lines, owner = [], []
    for d, t in sorted(docs):
        for line in t.split("\n"):
            lines.append(line)
            owner.append(d)
    at, gone = collections.defaultdict(list), set()
    for i, line in enumerate(lines):
        best = 0
        for q in at[line]:
            k = n = 0
            while i + k < len(lines) and owner[i + k] == owner[i] and owner[q + k] == owner[q] and lines[i + k] == lines[q + k]:
                n += len(lines[i + k].split())
                k += 1
            if n >= min_words:
                best = max(best, k)
        at[line].append(i)
        gone.update(range(i, i + best))
    out = []
    for d, _ in docs:
        own = [i for i in range(len(lines)) if owner[i] == d]
        out.append((d, "\n".join(lines[i] for i in own if i not in gone), sum(i in gone for i in own)))
    return out


def ppm(train, text, order):
    counts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in train:
        s = b"\xff" * order + low(t).encode() + b"\xff"
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[k][s[i - k : i]][s[i]] += 1
    s, total = b"\xff" * order + low(text).encode() + b"\xff", 0.0
    for i in range(order, len(s)):
        excluded = set()
        for k in range(order, -2, -1):
            if k < 0:
                total -= math.log10(256 - len(excluded))
                break
            seen = counts[k].get(s[i - k : i])
            if not seen:
                continue
            n = sum(v for a, v in seen.items() if a not in excluded)
            d = sum(a not in excluded for a in seen)
            if s[i] in seen and s[i] not in excluded:
                total += math.log10(seen[s[i]] / (n + d))
                break
            if n + d:
                total += math.log10(d / (n + d))
            excluded |= set(seen)
    return total


def profile(text, size=300):
    """The most frequent n-grams of 1 to 3 characters, as integers, ties by value."""
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else "\x01" for c in text or "")
    s = "\x01" + re.sub("\x01+", "\x01", letters + "\x01").removeprefix("\x01")
    counts = collections.Counter()
    for i in range(1, len(s)):
        for n in (1, 2, 3):
            gram = s[max(0, i - n + 1) : i + 1]
            if len(gram) == n and (gram != "\x01" if n == 1 else "\x01" not in gram[1:-1] and gram != "\x01\x01"):
                counts[sum(ord(c) << 21 * k for k, c in enumerate(reversed(gram)))] += 1
    return counts


def language(docs, taught, size=300):
    """docs: (id, text); taught: (text, lang); (id, prediction, score)."""
    totals = collections.defaultdict(collections.Counter)
    for t, lang in taught:
        totals[lang].update(profile(t))
    top = lambda counts: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]
    ranks = {lang: {g: r for r, g in enumerate(top(c))} for lang, c in totals.items()}
    out = []
    for i, t in docs:
        own = top(profile(t))
        if not own:
            out.append((i, "und", 0.0))
            continue
        far = sorted((sum(abs(r - ranks[lang][g]) if g in ranks[lang] else size for r, g in enumerate(own)) / (len(own) * size), lang) for lang in ranks)
        out.append((i, far[0][1], far[1][0] / (far[0][0] + far[1][0])))
    return out
