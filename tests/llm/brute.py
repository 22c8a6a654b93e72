"""Plain Python versions of what the operators compute, and small awkward tables."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text, pattern=WORD):
    return pattern.findall((text or "").translate(LOWER))


def jaccard_components(rows, n=3, percent=90):
    sets = []
    for doc, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    post = {}
    for i, s in enumerate(sets):
        seen = {}
        for g in s:
            for j in post.get(g, ()):
                seen[j] = seen.get(j, 0) + 1
            post.setdefault(g, []).append(i)
        for j, inter in seen.items():
            if 100 * inter >= percent * (len(s) + len(sets[j]) - inter):
                a, b = find(i), find(j)
                if a != b:
                    root[max(a, b)] = min(a, b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = find(i)
            low[r] = min(low.get(r, doc), doc)
    return [(doc, len(sets[i]), low.get(find(i))) for i, (doc, _) in enumerate(rows)]


def awkward_documents(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    near = " ".join(f"w{i}" if i != 2000 else "changed" for i in range(4000))
    rows = [(1, "a b c d", "en", "s1"), (1, "a b c d", "en", "s1"), (2, None, None, None), (3, "", "en", "s1"), (4, " \t\n ", "de", None),
            (None, "a b c d", "en", "s2"), (5, "One", "en", "s2"), (6, "one", "en", "s2"), (7, long, "en", "s3"), (8, near, "en", "s3"),
            (9, "x y z\x00q été", "fr", "s1"), (10, "A B  C\nD", None, "s1")]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 1, "x") for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, size int, word string")


def contamination(rows, items, span=13):
    import hashlib
    from collections import defaultdict
    windows = defaultdict(set)
    for item, text in items:
        w = words(text, ALNUM)
        if w and len(w) < span:
            windows[tuple(w)].add(item)
        for i in range(len(w) - span + 1):
            windows[tuple(w[i:i + span])].add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc, text in rows:
        w = words(text, ALNUM)
        hit, named = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                got = windows.get(tuple(w[i:i + m]))
                if got:
                    hit.update(range(i, i + m))
                    named |= {x for x in got if x is not None}
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out
