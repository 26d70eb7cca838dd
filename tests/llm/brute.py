"""Plain versions of the operators, for small inputs."""

import hashlib


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def fingerprint(text, size):
    import xxhash

    words = [w for w in (text or "").encode().lower().split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def later(docs, tokens, length):
    """docs: (id, text); tokens: text to list. Per row of docs: kept flags."""
    places = {}
    for i, t in docs:
        x = tokens(t)
        for p in range(len(x) - length + 1):
            key = tuple(x[p : p + length])
            places[key] = min(places.get(key, (i, p)), (i, p))
    out = []
    for i, t in docs:
        x = tokens(t)
        kept = [True] * len(x)
        for p in range(len(x) - length + 1):
            if places[tuple(x[p : p + length])] < (i, p):
                kept[p : p + length] = [False] * length
        out.append((x, kept))
    return out


def digest(parts):
    return hashlib.sha256(parts).hexdigest()


def gif_samples(data):
    """The samples of each frame of a GIF, by the plainest reading of the format."""
    flags = data[10]
    at = 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)
    out = []
    while data[at] != 0x3B:
        depth = None
        if data[at] == 0x21:
            at += 2
        else:
            flags = data[at + 9]
            at += 10 + (3 << (flags & 7) + 1 if flags & 128 else 0)
            depth = data[at]
            at += 1
        body = b""
        while data[at]:
            body += data[at + 1 : at + 1 + data[at]]
            at += 1 + data[at]
        at += 1
        if depth is not None:
            out.append(_unlzw(body, depth))
    return out


def _unlzw(body, depth):
    clear, end = 1 << depth, (1 << depth) + 1
    value, have, at, width = 0, 0, 0, depth + 1
    table, before, out = [], None, []
    while True:
        while have < width:
            value |= body[at] << have
            have += 8
            at += 1
        code = value & (1 << width) - 1
        value >>= width
        have -= width
        if code == clear:
            table = [bytes((i,)) for i in range(clear)] + [b"", b""]
            before, width = None, depth + 1
            continue
        if code == end:
            return b"".join(out)
        entry = table[code] if code < len(table) else before + before[:1]
        out.append(entry)
        if before is not None and len(table) < 4096:
            table.append(before + entry[:1])
        before = entry
        if len(table) == 1 << width and width < 12:
            width += 1


def near_copies(docs, size, similarity):
    """docs: (id, text). The smallest id of each group of texts whose sets of word shingles are as similar, directly or in steps."""
    sets = {}
    for i, t in docs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))}
    root = components(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9)
    return {i for i, r in root.items() if i == r}


def best_fit(sizes, caps, weights):
    """The bin of each item: the open bin that leaves the smallest weighted sum of squared rests; the largest weighted item first."""
    need = [tuple(x / c for x, c in zip(s, caps, strict=True)) for s in sizes]
    left, bins = [], [0] * len(need)
    for i in sorted(range(len(need)), key=lambda i: (-sum(a * b for a, b in zip(need[i], weights, strict=True)), i)):
        rests = {j: [x - y for x, y in zip(b, need[i], strict=True)] for j, b in enumerate(left)}
        fits = [j for j, r in rests.items() if min(r) >= -1e-9]
        if fits:
            j = max(fits, key=lambda j: (round(-sum(k * x * x for k, x in zip(weights, rests[j], strict=True)), 12), -j))
        else:
            j = len(left)
            left.append((1.0,) * len(caps))
            rests[j] = [1 - y for y in need[i]]
        left[j] = tuple(rests[j])
        bins[i] = j
    return bins
