"""Plain statements of what the operators return, over lists in memory."""

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def smallest_linked(ids, linked):
    """Smallest id reachable from each id over ``linked(a, b)``."""
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    order = sorted(ids)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def simhash(text):
    own = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(own[i : i + 3]) for i in range(len(own) - 2)] if len(own) >= 3 else [" ".join(own)] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def winnow(text, gram=16, span=8):
    """``(hash, place)`` of the hashes of every ``gram`` code points, white space left out, that winnowing chooses."""
    solid = "".join(words(text))
    code = lambda x: xxhash.xxh64_intdigest(x.encode("utf-32-be"), 42)
    hashes = [code(solid[i : i + gram]) for i in range(len(solid) - gram + 1)] or ([code(solid)] if solid else [])
    out, wide = [], min(span, len(hashes))
    for i in range(len(hashes) - wide + 1 if hashes else 0):
        j = min(range(i, i + wide), key=lambda n: (hashes[n] >> 31, -n))
        if not out or out[-1] != j:
            out.append(j)
    return [(hashes[j], j) for j in out]


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def substrings(docs, width=13):
    """``doc_id: (n_words, n_removed, sha256)`` for ``doc_id: text``."""
    split = {d: words(t) for d, t in docs.items()}
    first = {}
    for d in sorted(split):
        for i in range(len(split[d]) - width + 1):
            first.setdefault(tuple(split[d][i : i + width]), d)
    out = {}
    for d, own in split.items():
        gone = [False] * len(own)
        for i in range(len(own) - width + 1):
            if first[tuple(own[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out[d] = (len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_spans(text):
    """``(kind, start, end)`` of the known secrets."""
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(0, m) for m in re.finditer(assign, text or "") if len(m[2]) >= 8]
    out += [(1, m) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    out += [(2, m) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    kinds = ("assign", "access", "hex")
    return [(kinds[k], i, j) for i, k, j in sorted((m.start(), k, m.end()) for k, m in out)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]
