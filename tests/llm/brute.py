"""Plain Python versions of the queries' results, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

W = re.compile(r"[^\x20\x09-\x0D]+")


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def secrets(rows):
    """doc_id -> (n_assign, n_access, n_hex, base_sha256)"""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = {}
    for d, t in rows:
        t = t or ""
        a = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 12]
        b = [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        c = [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        out[d] = (len(a), len(b), len(c), sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(a + b + c))))
    return out


def targets(sizes, weights=(5, 2, 1), limit=3):
    """source -> target, by sharing again and again"""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, free = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(full.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > limit * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = limit * sizes[s]
            free.discard(s)
        if not free:
            return full


def measures(t):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    t = t or ""
    w = W.findall(t)
    lines = [x for x in t.split("\n") if W.search(x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def edited(rows):
    """doc_id -> edited text"""
    rows = sorted((d, t or "") for d, t in rows)
    out = {}
    for i, (d, t) in enumerate(rows):
        m = len(t) // 4
        out[d] = t[:len(t) - m] + rows[(i + 1) % len(rows)][1][:m]
    return out


def simhashes(rows):
    import xxhash

    out = {}
    for d, t in rows:
        w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        out[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    return out


def components(fps):
    """doc_id -> smallest doc_id reachable over links of four bits"""
    ids = sorted(fps)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def similar(rows, n, similarity):
    """pairs of at least the similarity of their sets of n words, and doc_id -> smallest doc_id reachable over them"""
    sets = {}
    for d, t in rows:
        w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
    root = {d: d for d in ids}
    for _ in ids:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    return links, root


def removed(sequences, n):
    """doc -> flags of the items covered by an n-window that also starts in a smaller doc"""
    first = {}
    for d in sorted(sequences):
        s = sequences[d]
        for i in range(len(s) - n + 1):
            first.setdefault(tuple(s[i:i + n]) if isinstance(s, list) else s[i:i + n], d)
    out = {}
    for d, s in sequences.items():
        flags = [False] * len(s)
        for i in range(len(s) - n + 1):
            if first[tuple(s[i:i + n]) if isinstance(s, list) else s[i:i + n]] < d:
                flags[i:i + n] = [True] * n
        out[d] = flags
    return out


def spans(flags):
    return sum(1 for i, f in enumerate(flags) if f and not (i and flags[i - 1]))


def piece_crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def groups(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def negatives(rows, positives=5, negatives=3, low=50, high=95):
    """(vec, label, vector, anchor) rows to (anchor_id, positive_id, rank, negative_id, positive_score, negative_score), sorted"""
    from math import floor, isfinite

    kept = [(k, y, [floor(256 * x) for x in v], a) for k, y, v, a in rows
            if y is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    kept = [r for r in kept if sum(x * x for x in r[2]) < 2 ** 62]
    out = []
    for i, (k, y, v, anchor) in enumerate(kept):
        if not anchor:
            continue
        score = {j: sum(a * b for a, b in zip(v, r[2])) for j, r in enumerate(kept)}
        ranked = sorted(score, key=lambda j: (-score[j], kept[j][0] is None, kept[j][0] or 0, j))
        for p in [j for j in ranked if kept[j][1] == y and j != i][:positives]:
            far = [j for j in ranked if kept[j][1] != y and low * score[p] <= 100 * score[j] <= high * score[p]][:negatives]
            out += [(k, kept[p][0], n + 1, kept[j][0], score[p], score[j]) for n, j in enumerate(far)]
    return sorted(out, key=str)


def middle(key, text):
    """n, form, prefix_chars, middle_chars, output"""
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text or ""
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def linked_sets(rows, n=3, percent=85):
    """doc_id -> (set size, component id) over links of sets of n words"""
    sets = {}
    for d, t in rows:
        w = W.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[d] = {" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    where = defaultdict(list)
    for d in sorted(sets):
        for x in sets[d]:
            where[x].append(d)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for d in sorted(sets):
        shared = Counter(e for x in sets[d] for e in where[x] if e < d)
        for e, both in shared.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[e]) - both):
                x, y = find(d), find(e)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}
