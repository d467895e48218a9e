"""Plain one-machine versions of the queries' contracts, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"

NORMAL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def normal(text):
    return NORMAL.findall((text or "").translate(LOWER))


def contamination(docs, items, window=13):
    grams = {}
    for item_id, text in items:
        words = normal(text)
        for i in range(max(1, len(words) - window + 1)) if words else ():
            grams.setdefault(tuple(words[i : i + window]), set()).add(item_id)
    sizes = {len(g) for g in grams}
    for doc_id, text in docs:
        words, hit, found = normal(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                ids = grams.get(tuple(words[i : i + size]))
                if ids:
                    hit.update(range(i, i + size))
                    found |= ids
        ids = ",".join(sorted(map(str, found)))
        yield doc_id, len(words), len(hit), len(found), sha(ids), bool(hit) and 20 * len(hit) >= len(words)


def without_repeats(docs, window):
    first, rows = {}, []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        words = PLAIN.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if first.setdefault(key, (doc_id, i)) != (doc_id, i):
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(words) if i not in gone]
        rows.append((doc_id, len(words), len(gone), sha(" ".join(kept))))
    return rows


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def licenses(docs):
    for doc_id, text in docs:
        words, places, labels = normal(text), [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    places.append(i)
                    labels.add(label)
        yield (
            doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
        )


def quality(docs):
    for doc_id, text in docs:
        text = text or ""
        words = PLAIN.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if PLAIN.search(line):
                dup += line in seen
                seen.add(line)
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        count = {}
        for w in windows:
            count[w] = count.get(w, 0) + 1
        hit = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 3)}
        failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
        yield doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


SECRETS = {
    "assign": (re.compile(r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def secrets(docs):
    for doc_id, text in docs:
        spans = []
        for k, (pattern, group, least) in enumerate(SECRETS.values()):
            spans += [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
        names = list(SECRETS)
        base = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
        yield (doc_id, *(sum(s[1] == k for s in spans) for k in range(3)), sha(base), base)


def fingerprint(text):
    words = PLAIN.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles)) if shingles else 0


def near_duplicates(docs):
    prints = [(d, fingerprint(t)) for d, t in docs]
    distinct = np.array(sorted({p for _, p in prints}), dtype=np.uint64)
    root = list(range(len(distinct)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(distinct[i + 1 :] ^ distinct[i]) <= 3) + i + 1:
            root[find(int(j))] = find(i)
    place = {int(p): i for i, p in enumerate(distinct)}
    least = {}
    for d, p in prints:
        r = find(place[p])
        if d is not None:
            least[r] = min(least.get(r, d), d)
    for d, p in prints:
        yield d, f"{p:016x}", least.get(find(place[p]))


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(m):
    d = [int(c) for c in m if c in "0123456789"]
    total = 0
    for i, x in enumerate(reversed(d)):
        x = x * 2 if i % 2 else x
        total += x - 9 if x > 9 else x
    return 13 <= len(d) <= 19 and total % 10 == 0


def personal_data(docs):
    for doc_id, text in docs:
        text = text or ""
        spans = {
            "email": [m.span() for m in EMAIL.finditer(text)],
            "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
            "card": [m.span() for m in CARD.finditer(text) if _luhn(m[0])],
            "phone": [m.span() for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15],
        }
        base = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        yield (doc_id, *map(len, spans.values()), sha(base), base)


def _usable(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector)


def clusters(rows, k=8, rounds=10, size=64, scale=1024, seed=3):
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows if _usable(v) and len(v) == size]
    kept.sort(key=lambda r: (r[0] is None, sha(f"{seed}:{r[0]}"), r[1]))
    centroids = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, members in groups.items():
            centroids[n] = [sum(x) // len(members) for x in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = {n: sum(d for _, d, m in found if m == n) for n in range(k)}
    return [(i, n, d, total[n], sum(total.values()), sha(",".join(map(str, centroids[n])))) for i, d, n in found]


def top_products(rows, k=5, scale=256, every=50):
    whole = {(i, tuple(int(np.floor(np.float64(x) * scale)) for x in v)) for i, v in rows if _usable(v)}
    out = []
    for query, q in whole:
        if query is not None and query % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i or 0, i) for i, v in whole if i != query)
            out += [(query, n + 1, s[3], -s[0]) for n, s in enumerate(scores[:k])]
    return out


def trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def order(t):
        return t[:2], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).digest()

    own = {c: [t[2:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(int(np.fix(c / 100)) * 100, [])[:h] + turns[h:])
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        saved[node] = sum(saved[b] for b in below) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return [
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node],
         sha(",".join(map(str, sorted(ends.get(node, []))))))
        for node, m in members.items()
    ]
