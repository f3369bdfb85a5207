"""Plain single-machine versions of the operators' contracts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict


def words(text):
    return (text or "").encode().split()


def order(doc):
    return (doc["doc_id"] is not None, doc["doc_id"] if doc["doc_id"] is not None else 0)


def first_starts(docs, width, tokens):
    """The first (document, start) of every run of ``width`` tokens."""
    first = {}
    for d in sorted(docs, key=order):
        t = tokens(d["text"])
        for i in range(len(t) - width + 1):
            first.setdefault(tuple(t[i : i + width]), (order(d), i))
    return first


def removed(doc, width, tokens, first):
    t = tokens(doc["text"])
    gone = set()
    for i in range(len(t) - width + 1):
        if first[tuple(t[i : i + width])] != (order(doc), i):
            gone.update(range(i, i + width))
    return t, gone


def substring_dedup(docs, width=20):
    first = first_starts(docs, width, words)
    out = []
    for d in docs:
        t, gone = removed(d, width, words, first)
        kept = b" ".join(w for i, w in enumerate(t) if i not in gone)
        out.append((d["doc_id"], len(t), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def line_dedup(docs, width=3):
    split = lambda text: [] if text is None else text.split("\n")
    first = first_starts(docs, width, split)
    out = []
    for d in docs:
        t, gone = removed(d, width, split, first)
        text = None if d["text"] is None else "\n".join(x for i, x in enumerate(t) if i not in gone)
        out.append((d["doc_id"], text, len(t), len(gone)))
    return out


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def similar_groups(docs, similar=80):
    sets = [shingle_set(d["text"]) for d in docs]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter()
    for ids in holders.values():
        for a in range(len(ids)):
            for b in range(a):
                shared[ids[b], ids[a]] += 1
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, j), n in shared.items():
        if (100 + similar) * n >= similar * (len(sets[i]) + len(sets[j])):
            root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(docs):
        if d["doc_id"] is not None:
            r = find(i)
            least[r] = min(least.get(r, d["doc_id"]), d["doc_id"])
    return [(d["doc_id"], len(s), least.get(find(i))) for i, (d, s) in enumerate(zip(docs, sets))]


def leaks(docs, items, contained=80):
    split = lambda text: (text or "").lower().encode().split()
    runs = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    out = []
    wanted = [(i["item_id"], split(i["text"])) for i in items]
    wanted = [(item, min(5, len(w)), runs(w, min(5, len(w)))) for item, w in wanted if w]
    for d in docs:
        has = {k: runs(split(d["text"]), k) for k in {k for _, k, _ in wanted}}
        for item, k, all_of in wanted:
            n = len(all_of & has[k])
            if 100 * n >= contained * len(all_of):
                out.append((d["doc_id"], item, len(all_of), n))
    return out


def text_counts(text):
    w = words(text)
    text = text or ""
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = Counter(tri)
    again = {k for i, t in enumerate(tri) if many[t] > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(w),
        sum(len(x.decode()) for x in w),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(again),
    )
