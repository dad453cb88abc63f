"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import defaultdict

import xxhash


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def banded(a, b, t):
    """The edit distance of two texts if it is at most t, else None, of any length."""
    if abs(len(a) - len(b)) > t:
        return None
    row = {j: j for j in range(min(len(b), t) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - t), min(len(b), i + t) + 1):
            new[j] = i if j == 0 else min(row.get(j, t) + 1, new.get(j - 1, t) + 1, row.get(j - 1, t) + (x != b[j - 1]))
        row = new
    return row[len(b)] if row[len(b)] <= t else None


def groups(nodes, links):
    """node -> smallest node reachable."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def simhash(text, n=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(rows, bits=4):
    """(id, text) rows -> {id: (fingerprint, smallest id of its group)}; ids are unique."""
    prints = {i: simhash(t) for i, t in rows}
    ids = sorted(prints)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= bits]
    named = groups(ids, links)
    return {i: (f"{prints[i]:016x}", named[i]) for i in ids}


def near(a, b, t):
    if abs(len(a) - len(b)) > t:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    a, b = a[p:], b[p:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return banded(a, b, t) is not None


def drop_lines(rows, t, least, grow=(), copies=None):
    """(id, text) rows -> {id: text of the kept lines}; ids are unique.

    ``grow`` (lowest length, edits) allows more edits by the length of the shorter
    line; equal lines are one class from ``copies`` characters on.
    """
    copies = least if copies is None else copies
    lines = [(i, n, x.strip(" ")) for i, text in sorted(rows) if text is not None for n, x in enumerate(text.split("\n"))]
    kinds = sorted({x for _, _, x in lines if len(x) >= least}, key=lambda x: (len(x), x))
    links = []
    for k, a in enumerate(kinds):
        own = max([t, *(e for low, e in grow if len(a) >= low)])
        # two texts within that many edits share one of one more parts, so most pairs need no table
        size = len(a) // (own + 1)
        parts = [a[s : s + size] for s in range(0, size * own + 1, size)]
        for b in kinds[k + 1 :]:
            if len(b) - len(a) > own:
                break
            if any(p in b for p in parts) and near(a, b, own):
                links.append((a, b))
    cls = groups({x for _, _, x in lines if x and len(x) >= min(copies, least)}, links)
    first, out = {}, defaultdict(list)
    for i, n, x in lines:
        if x in cls:
            first.setdefault(cls[x], (i, n))
    for i, text in rows:
        if text is not None:
            out[i] = "\n".join(x for n, x in enumerate(text.split("\n")) if x.strip(" ") not in cls or first[cls[x.strip(" ")]] == (i, n))
    return dict(out)


def auc(scores, labels):
    order = sorted(zip(scores, labels))
    pos = sum(y for _, y in order)
    rank, k = 0.0, 0
    while k < len(order):
        j = k
        while j < len(order) and order[j][0] == order[k][0]:
            j += 1
        rank += sum(y for _, y in order[k:j]) * (k + j + 1) / 2
        k = j
    return (rank - pos * (pos + 1) / 2) / (pos * (len(order) - pos))
