"""Plain versions of the operators, one row after another, and awkward tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

BLANK = " \t\n\v\f\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(docs):
    key = lambda line: line.strip(BLANK).translate(LOWER)
    held = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                held[key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or i == min(held.get(key(x)) or {i})]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def substring_dedup(docs, window=20):
    first = {}
    known = sorted({(i, t) for i, t in docs if i is not None}, key=lambda x: x[0])
    for i, t in known:
        w = words(t)
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] != (i, p):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    n = min(3, len(w))
    shingles = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, near):
    """The smallest position linked to each position."""
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if near(values[a], values[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(values))]


def simhash_dups(docs):
    docs = sorted(docs, key=lambda d: d[0])
    prints = [fingerprint(t) for _, t in docs]
    roots = groups(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    return [(i, f"{f:016x}", docs[r][0]) for (i, _), f, r in zip(docs, prints, roots)]


def crc(text):
    return zlib.crc32((text or "").encode())


def edit_distance_inside(item, text):
    """Fewest edits that turn the item into some part of the text."""
    row = [0] * (len(text) + 1)
    for j, c in enumerate(item):
        new = [j + 1]
        for p, d in enumerate(text):
            new.append(min(row[p] + (c != d), row[p + 1] + 1, new[p] + 1))
        row = new
    return min(row)


#: Names that the operators use themselves.
CLASHES = (
    "hash", "lost", "n_lines", "n_dropped", "kept_sha256", "packed", "places", "place", "anchor",
    "path", "edge", "first", "n", "count", "fingerprint", "component_id", "a", "b", "node", "root",
    "item_id", "start", "end", "key", "size", "range", "part", "parts", "shard", "slot", "tie",
    "next", "to", "score", "predicted", "toxic", "grams", "_n", "_line", "_found", "rules",
    "word", "prefix", "at", "bytes", "number", "tree_id", "node_id", "depth", "rank", "up",
)


def frame(spark, rows, extra=CLASHES):
    """Documents with further columns whose names clash; their values are null or odd."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(i, t, None, "src", len(t or "")) for i, t in rows]
    df = spark.createDataFrame(full, schema)
    return df.selectExpr("*", *(f"CAST(NULL AS STRING) AS `{c}`" for c in extra))


LONG = " ".join(f"w{i % 977}x{i * i % 1009}" for i in range(30_000))

AWKWARD = [
    (1, "A shared line of text\nown line number one\n  short \n"),
    (2, "  a SHARED line of text\t\nown line number two"),
    (3, None),
    (4, ""),
    (5, " \t\n\r\n "),
    (6, "word"),
    (7, "Ünïcödé 漢字 line that is ours\nA shared line of text"),
    (8, LONG),
    (9, LONG + " and a tail"),
    (10, "head " + LONG[:2000]),
    (None, "A shared line of text\nnobody's line here"),
    (11, "under the MIT License, see CC-BY-NC and Apache License, Version 2.0"),
    (11, "under the MIT License, see CC-BY-NC and Apache License, Version 2.0"),
    (12, "under the MIT License, see CC-BY-NC and Apache License, Version 2.0"),
]


def exact_dedup(docs):
    """(doc_id, keep_id, group_size, sha) per row; which row of a group stays is told by
    the longest text, then the smallest id."""
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    held = defaultdict(list)
    for i, t in docs:
        held[plain(t)].append((-len(t or ""), i is None, i or 0, i))
    return [(i, min(held[plain(t)])[3], len(held[plain(t)]), sha(plain(t))) for i, t in docs]


def ranked_search(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, c.total()) for i, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
            )
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def rebuilt(rows):
    """(conv_id, turn, role, text) rows to the turns of every conversation, borrowed ones
    first."""
    held = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            key = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            held[c].append((turn is not None, turn or 0, key, (role or "", text or "")))
    own = {c: [t[3] for t in sorted(v)] for c, v in held.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        out[c] = tuple(own.get(base, [])[:h] + mine[h:])
    return out


def prefix_trie(convs):
    """The nodes of {conv_id: turns}, as the rows of the query."""
    nodes = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, members in nodes.items():
        own = (len(members) - 1) * len(words(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += own
    return [
        (
            m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
            sha(",".join(str(c) for c in m if convs[c] == k)),
        )
        for k, m in nodes.items()
    ]
