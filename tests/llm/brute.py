"""Plain restatements of the contracts, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict

import numpy as np


def shingle_set(text, size):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_dup(docs, size, percent):
    """{doc_id: (n_shingles, component_id)} of [(doc_id, text)]."""
    sets = {d: shingle_set(t, size) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_shingle = defaultdict(list)
    for d in sorted(sets):
        shared = defaultdict(int)
        for s in sets[d]:
            for e in by_shingle[s]:
                shared[e] += 1
            by_shingle[s].append(d)
        for e, n in shared.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def suffix_dedup(docs, length):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}."""
    first = {}
    data = {d: (t or "").encode() for d, t in docs}
    for d in sorted(data):
        for i in range(len(data[d]) - length + 1):
            first.setdefault(data[d][i : i + length], d)
    out = {}
    for d, b in data.items():
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(b) else 0
        out[d] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def warc(pages, least=0):
    """{page_id: (payload_bytes, digest, record_type, refers_to)}."""
    digest = {p: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for p, h in pages}
    size = {p: len((h or "").encode()) for p, h in pages}
    last = {}
    for p, d in digest.items():
        known = [x for x in (last.get(d), p) if x is not None]
        last[d] = max(known) if known else None
    return {
        p: (size[p], d, "response", None) if size[p] < least or last[d] == p else (size[p], d, "revisit", last[d])
        for p, d in digest.items()
    }


def nearest(vectors, query, k):
    """[(query_id, rank, vec_id)] and scores of {id: vector}."""
    out = {}
    good = {i: np.array(v, dtype=float) for i, v in vectors.items() if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    for q in good:
        if query(q):
            scored = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q and len(good[c]) == len(good[q]))
            for rank, (s, c) in enumerate(scored[:k], 1):
                out[(q, rank)] = (c, -s)
    return out


def prefix_trie(rows, graft=True, group=20, most=4):
    """Nodes of the contract of op11 from (conv_id, turn, role, text) rows, as a set of tuples."""
    from zlib import crc32

    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn if turn is not None else 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in convs.items()}
    if graft:
        built = {}
        for c, turns in own.items():
            h = crc32(str(c).encode()) % most
            # The remainder takes the sign of c, as in SQL.
            base = own.get(c - (abs(c) % group) * (1 if c >= 0 else -1), [])
            built[c] = base[:h] + turns[h:]
        own = built
    nodes = {}
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            key = tuple(turns[:d])
            node = nodes.setdefault(key, {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(turns):
                node["ends"].append(c)
    children = defaultdict(list)
    for key in nodes:
        if key:
            children[key[:-1]].append(key)

    def words(key):
        return len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0

    memo = {}

    def sub(key):
        if key not in memo:
            leaves, saved = (0 if children[key] else 1), (len(nodes[key]["members"]) - 1) * words(key)
            for child in children[key]:
                a, b = sub(child)
                leaves, saved = leaves + a, saved + b
            memo[key] = (leaves, saved)
        return memo[key]

    out = set()
    for key, node in sorted(nodes.items(), key=lambda kv: len(kv[0])):
        leaves, saved = sub(key)
        parent = min(nodes[key[:-1]]["members"]) if key else None
        ends = hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest()
        out.add((min(node["members"]), len(key), parent, len(node["members"]), len(children[key]), leaves, saved, ends))
    return out


def spelling(docs, least_length=6, least_count=5, factor=5):
    """Rows (word, form, root, n, n_near, form_n) of the contract of op13 from (doc_id, text) pairs."""
    from collections import Counter
    from zlib import crc32

    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}

    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    words = sorted(vocab)
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= factor * vocab[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return out
