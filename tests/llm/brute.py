"""Plain versions of the operators, for small tables."""

import re
from collections import Counter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    words = SPACES.findall(lowered(text))
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


def components(ids, links):
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {i: top(i) for i in ids}


def jaccard(documents):
    """{doc_id: (n, component)} of (doc_id, text) pairs."""
    sets = {}
    for i, text in documents:
        sets[i] = shingles(text)
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    root = components(ids, links)
    return {i: (len(sets[i]), root[i]) for i in ids}


def contamination(text, items, window=13):
    words = LETTERS.findall(lowered(text))
    hit, named = set(), set()
    for item, other in items:
        own = LETTERS.findall(lowered(other))
        size = min(window, len(own))
        patterns = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if size else set()
        for i in range(len(words) - size + 1 if size else 0):
            if tuple(words[i:i + size]) in patterns:
                hit |= set(range(i, i + size))
                named.add(str(item))
    return len(words), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(words)


def patience(a, b, low_a, high_a, low_b, high_b):
    """Set of matched pairs, by recursion and a quadratic longest increasing subsequence."""
    found = set()
    while low_a < high_a and low_b < high_b and a[low_a] == b[low_b]:
        found.add((low_a, low_b))
        low_a, low_b = low_a + 1, low_b + 1
    while low_a < high_a and low_b < high_b and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
        found.add((high_a, high_b))
    in_a, in_b = Counter(a[low_a:high_a]), Counter(b[low_b:high_b])
    once = [(i, j) for i in range(low_a, high_a) for j in range(low_b, high_b)
            if a[i] == b[j] and in_a[a[i]] == 1 == in_b[b[j]]]
    if not once:
        return found
    best = [1] * len(once)
    back = [-1] * len(once)
    for k, (_, j) in enumerate(once):
        for m in range(k):
            if once[m][1] < j and best[m] + 1 > best[k]:
                best[k], back[k] = best[m] + 1, m
    k = max(range(len(once)), key=lambda x: best[x])
    chain = []
    while k >= 0:
        chain.append(once[k])
        k = back[k]
    chain.reverse()
    found |= set(chain)
    edges = [(low_a - 1, low_b - 1), *chain, (high_a, high_b)]
    for (i, j), (p, q) in zip(edges, edges[1:]):
        found |= patience(a, b, i + 1, p, j + 1, q)
    return found


def feistel(x, n, a, b, keys, prime=2_147_483_647):
    def turn(value, key):
        y = (value + key) % prime
        y = (y * y + key) % prime
        return (y * 48_271 + value) % prime

    while True:
        left, right = divmod(x, b)
        for p, q in keys:
            left = (left + turn(right, p)) % a
            right = (right + turn(left, q)) % b
        x = left * b + right
        if x < n:
            return x
