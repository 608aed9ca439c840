"""Plain Python versions of definitions that the operators compute on tables."""

import re

import xxhash


def fingerprint_of(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component(prints, bits=2):
    """Smallest id reachable over pairs of fingerprints at most ``bits`` apart."""
    ids = sorted(prints)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def hits(text, items, size=13):
    """Places of words that windows of the items cover, and the items found."""
    words, places, found = words_of(text), set(), set()
    for n, item in enumerate(items):
        w = words_of(item)
        k = min(size, len(w))
        grams = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(words) - k + 1 if k else 0):
            if tuple(words[i:i + k]) in grams:
                places |= set(range(i, i + k))
                found.add(n)
    return words, places, found


def clean(text, items):
    words, places, _ = hits(text, items)
    return not (places and 20 * len(places) >= len(words))
