"""Plain Python versions of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD9 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD10 = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def held(doc_id, parts: int, part: int) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == part


def exact(rows):
    """rows: (doc_id, text) -> sorted (doc_id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        text = text or ""
        groups[SPACE.sub("", text)].append((-len(text), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: m[:3])
        out += [(m[3], best[3], len(members), m[3] == best[3] and m[0] == best[0], sha(norm)) for m in members]
    return sorted(out, key=str)


def contamination(rows, items, size=10):
    """-> {doc_id: (n_words, n_hit, items)}."""
    windows = defaultdict(set)
    for item, text in items:
        w = WORD9.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    by_size = defaultdict(dict)
    for w, ids in windows.items():
        by_size[len(w)][w] = ids
    out = {}
    for doc_id, text in rows:
        w, hit, found = WORD9.findall((text or "").translate(LOWER)), set(), set()
        for n, table in by_size.items():
            for i in range(len(w) - n + 1):
                ids = table.get(tuple(w[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in ids if x is not None}
        out[doc_id] = (len(w), len(hit), sorted(found))
    return out


def shingles(text, size):
    w = WORD10.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)])


def near(rows, size, percent=80):
    """-> {doc_id: (n_shingles, component)}; ids distinct."""
    sets = {d: shingles(t, size) for d, t in rows}
    index = defaultdict(list)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for d in sorted(sets):
        shared = defaultdict(int)
        for s in sets[d]:
            for e in index[s]:
                shared[e] += 1
        for e, both in shared.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[e]) - both):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            index[s].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(rows, length=400):
    """-> list of (doc_id, n_bytes, n_removed, n_spans, kept sha), in row order."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = defaultdict(int)
    for _, b in texts:
        for i in range(len(b) - length + 1):
            seen[hash(b[i : i + length])] += 1
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[hash(b[i : i + length])] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), runs, sha(kept)))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def personal(text):
    """Base spans (kind, start, end) by start, then kind as listed."""
    text = text or ""
    out = []
    for rank, (kind, pattern) in enumerate([("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)]):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                  "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def middle_filled(doc_id, text):
    """-> (n, form, prefix length, middle length, output)."""
    text = text or ""
    digest = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


RUN = re.compile(r"[A-Za-z\u00C0-\u00FF]+")


def corpus_words(rows, every=199):
    """Counts of the runs, some with a code point deleted."""
    counts = defaultdict(int)
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def spelling(counts, ratio=5):
    """{word: n} -> sorted (word, form, root, n, n_near, form_n)."""
    masks = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            masks[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = {w: set() for w in counts}
    for w in counts:
        for i in range(len(w)):
            near[w] |= masks[w[:i] + "\0" + w[i + 1 :]] - {w}
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), None if form[w] is None else counts[form[w]]))
    return sorted(out, key=str)
