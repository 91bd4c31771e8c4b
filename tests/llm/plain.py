"""The queries' results by plain loops over all documents, without hashes or shuffles."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = {
    "assign": (
        re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def secrets(docs):
    out = {}
    for doc, text in docs:
        spans = []
        for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
            for m in pattern.finditer(text or ""):
                # Ignoring case must not reach beyond A to Z.
                if len(m.group(group)) >= least and m.group(0).isascii():
                    spans.append((m.start(), rank, kind, m.end()))
        spans.sort()
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)
        count = Counter(k for _, _, k, _ in spans)
        out[doc] = (count["assign"], count["access"], count["hex"], sha(listed), listed)
    return out


def passages(docs, window=50):
    first = {}
    split = [(d, words(t)) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(d, first.get(key, d))
    out = {}
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def lines(docs, window=3):
    first = {}
    split = {}
    for d, text in sorted(docs):
        raw = (text or "").split("\n")
        full = [i for i, line in enumerate(raw) if line]
        split[d] = (raw, full)
        for k in range(len(full) - window + 1):
            first.setdefault(tuple(raw[i] for i in full[k : k + window]), (d, k))
    out = {}
    for d, (raw, full) in split.items():
        gone = set()
        for k in range(len(full) - window + 1):
            if first[tuple(raw[i] for i in full[k : k + window])] != (d, k):
                gone.update(full[k : k + window])
        out[d] = (len(full), len(gone), sha("\n".join(x for i, x in enumerate(raw) if i not in gone)))
    return out


def quality_counts(docs):
    out = {}
    for d, text in docs:
        w = words(text)
        seen = Counter(zip(w, w[1:], w[2:]))
        covered = set()
        for i in range(len(w) - 2):
            if seen[tuple(w[i : i + 3])] > 1:
                covered.update((i, i + 1, i + 2))
        earlier, dup = set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in earlier
                earlier.add(line)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out[d] = (len(w), sum(map(len, w)), symbols, dup, len(covered), failed)
    return out


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def jaccard_components(docs):
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for d, s in sets.items():
        shared = Counter(o for x in s for o in holders[x] if o < d)
        for o, k in shared.items():
            if 100 * k >= 80 * (len(s) + len(sets[o]) - k):
                a, b = top(d), top(o)
                up[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), top(d)) for d in sets}


def leaks(docs, items, size=5, percent=80):
    def cut(text):
        return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER)) if w]

    def grams(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    found = []
    for item, text in items:
        w = cut(text)
        if not w:
            continue
        n = min(size, len(w))
        wanted = grams(w, n)
        for d, body in docs:
            shared = len(wanted & grams(cut(body), n))
            if 100 * shared >= percent * len(wanted):
                found.append((d, item, len(wanted), shared))
    return sorted(found)


def conversations(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, listed in turns.items():
        listed.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in listed)
        loss = "".join(t for _, r, t in listed if r == "assistant")
        out[conv] = (len(listed), sha(said), len(loss), sha(loss))
    return out


def held_out(doc):
    return zlib.crc32(str(doc).encode()) % 5 == 0


def trie(rows, family=20):
    """Nodes of the trie of forked conversations."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + said[h:])
    return nodes_of(built)


def nodes_of(built):
    members = defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        gain = (len(m) - 1) * len(words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += not children[p]
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))))
            for p, m in members.items()
        ),
        key=lambda r: r[:2],
    )


def ranks(docs, items, top=50):
    from math import floor, log

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    counted = [(d, Counter(terms(t))) for d, t in docs]
    full = sum(1 for _, c in counted if c)
    total = sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in counted:
            m = 50 + (50 * sum(c.values()) * full) // max(1, total)
            score = 0
            for t in set(terms(text)) & set(c):
                score += floor(1000 * log((2 * full + 2) / (2 * held[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort()
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(scored[:top], 1)]
    return out
