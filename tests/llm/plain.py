"""Brute-force versions of the text operators, in plain Python over lists of rows."""

import re
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def fingerprint(text, width=3):
    found = [w.translate(LOWER) for w in words(text)]
    if not found:
        return 0
    grams = [" ".join(found[i:i + width]) for i in range(max(1, len(found) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=2):
    """Component number of each fingerprint, by looking at every pair."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if ((a ^ prints[j]) & (1 << 64) - 1).bit_count() <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def repeat_words(text):
    w = words(text)
    places = defaultdict(list)
    for i in range(len(w) - 2):
        places[tuple(w[i:i + 3])].append(i)
    return len({p + d for at in places.values() if len(at) > 1 for p in at for d in range(3)})


def base_failed(text):
    n = len(words(text))
    return n < 50 or 100 * repeat_words(text) > 50 * n


def normal(line):
    return " ".join(words(line)).translate(LOWER)


def frequent(rows, most=20):
    """(host, line) in more than ``most`` distinct texts of a host; ``rows``: (id, text, host)."""
    docs = defaultdict(set)
    for _, text, host in rows:
        for line in (text or "").split("\n"):
            if words(line):
                docs[host, normal(line)].add(text)
    return {k for k, v in docs.items() if len(v) > most}


def quality(rows, most=20):
    """{(id, text, host): (kept, text without frequent lines)}"""
    many, out = frequent(rows, most), {}
    for doc, text, host in rows:
        lines = (text or "").split("\n")
        gone = [x for x in lines if words(x) and (host, normal(x)) in many]
        n, lost = len(words(text)), sum(len(words(x)) for x in gone)
        out[doc, text, host] = (not base_failed(text) and 100 * (n - lost) >= 30 * n, "\n".join(x for x in lines if x not in gone))
    return out


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(text, items, window=10):
    """(n_words, n_hit, sorted ids) of a text; ``items``: (id, text)."""
    w, hit, ids = terms(text), set(), set()
    for item, body in items:
        t = terms(body)
        size = min(window, len(t))
        grams = {tuple(t[i:i + size]) for i in range(len(t) - size + 1)} if t else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in grams:
                hit.update(range(i, i + size))
                ids.add(item)
    return len(w), len(hit), sorted(map(str, ids))


def near(text, items, window=10, times=2):
    """Sorted ids of the items of which a window's words all stand within ``times`` windows, or that occur; ``items``: (id, text)."""
    w, ids = terms(text), set(contamination(text, items, window)[2])
    for item, body in items:
        t = terms(body)
        wanted = [Counter(t[i:i + window]) for i in range(len(t) - window + 1)]
        for i in range(max(1, len(w) - times * window + 1)):
            held = Counter(w[i:i + times * window])
            if any(all(held[x] >= n for x, n in need.items()) for need in wanted):
                ids.add(str(item))
                break
    return sorted(ids)


def secrets(text):
    """(start, kind number, end) of the fixed patterns."""
    text, found = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" for c in k) for k in ("password", "passwd", "secret", "token", "api")).replace(
        "[aA][pP][iI]", "[aA][pP][iI]_?[kK][eE][yY]")
    for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def seats(weights, n, caps):
    """Sainte-Laguë seat by seat."""
    given = [0] * len(weights)
    for _ in range(min(n, sum(c for w, c in zip(weights, caps) if w > 0))):
        best = max((i for i in range(len(weights)) if weights[i] > 0 and given[i] < caps[i]),
                   key=lambda i: (weights[i] / (2 * given[i] + 1), -i))
        given[best] += 1
    return given


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets of {source: words}: shared by weight, cut at the most, the excess shared again until none is above."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total = sum(sizes.values())
    out = {s: total * weight[s] / sum(weight.values()) for s in order}
    while any(out[s] > most * sizes[s] * (1 + 1e-12) + 1e-9 for s in order):
        excess = sum(max(0.0, out[s] - most * sizes[s]) for s in order)
        out = {s: min(out[s], float(most * sizes[s])) for s in order}
        free = [s for s in order if out[s] < most * sizes[s]]
        for s in free:
            out[s] += excess * weight[s] / sum(weight[x] for x in free)
    return out


def phrases(symbols, known):
    """Greedy longest matches: ``known`` is the learnt text."""
    n, at = 0, 0
    while at < len(symbols):
        size = 1
        while at + size < len(symbols) and symbols[at:at + size + 1] in known:
            size += 1
        at, n = at + size, n + 1
    return n
