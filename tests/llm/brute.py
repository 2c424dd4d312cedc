"""Plain-Python versions of the operators, one document at a time."""

import re
from collections import Counter

import regex
import xxhash


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def fingerprint(text):
    ws = split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(ids_prints, radius=3):
    """The smallest id that links reach, for every fingerprint."""
    prints = sorted({p for _, p in ids_prints})
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for i, p in ids_prints:
        r = find(p)
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return {p: least.get(find(p)) for p in prints}


def norm_words(text):
    return regex.findall(r"[\p{L}\p{M}\p{N}]+", (text or "").lower())


def shingles(words, k):
    return [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]


def similarity(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def best_window(text, item):
    """The highest similarity of any item-sized window, or None."""
    words, goal = norm_words(text), norm_words(item)
    if not words or not goal:
        return None
    k = min(5, len(goal))
    wanted = shingles(goal, k)
    if not set(wanted) & set(shingles(words, k)):
        return 0.0
    return max(similarity(shingles(words[i:i + len(goal)], k), wanted) for i in range(max(1, len(words) - len(goal) + 1)))
