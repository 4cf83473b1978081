"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substrings(rows, window):
    """Per row (n_words, n_removed, digest); rows: (id, text). A null id comes first."""
    rank = lambda i: (i is not None, i or 0)
    seen = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for p in range(len(w) - window + 1):
            k, v = tuple(w[p:p + window]), (rank(i), p)
            seen[k] = min(seen.get(k, v), v)
    out = []
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p:p + window])] < (rank(i), p):
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def repeated_bytes(rows, depth):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[p:p + depth] for t in texts for p in range(len(t) - depth + 1))
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - depth + 1):
            if count[t[p:p + depth]] > 1:
                gone[p:p + depth] = b"\1" * depth
        spans = sum(1 for p in range(len(t)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(t), sum(gone), spans, sha(bytes(x for x, y in zip(t, gone) if not y))))
    return out


def benchmark(docs, items, window):
    found = {}
    for i, t in items:
        if i is None or t is None:
            continue
        w = ITEM_WORD.findall(lower(t))
        for p in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[p:p + window]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, names = ITEM_WORD.findall(lower(t)), set(), set()
        for size in {len(k) for k in found}:
            for p in range(len(w) - size + 1):
                if (k := tuple(w[p:p + size])) in found:
                    hit |= set(range(p, p + size))
                    names |= found[k]
        out.append((i, len(w), len(hit), sorted(names), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def near(docs, items, window, slop):
    """The items with a window whose terms are all within ``slop`` of their offsets from some place."""
    out = []
    for i, t in docs:
        w, names = ITEM_WORD.findall(lower(t)), set()
        for item, text in items:
            if item is None or text is None:
                continue
            v = ITEM_WORD.findall(lower(text))
            for p in range(max(1, len(v) - window + 1) if v else 0):
                terms = v[p:p + window]
                if any(all(any(0 <= s + k + d < len(w) and w[s + k + d] == x for d in range(-slop, slop + 1)) for k, x in enumerate(terms))
                       for s in range(-window - slop, len(w) + slop)):
                    names.add(str(item))
        out.append((i, sorted(names)))
    return out


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    count = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def frequent_lines(rows, line_words, limit, share):
    """Words in lines over the limits, for each row (host, text)."""
    digits = str.maketrans("0123456789", "0" * 10)
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", lower(x).translate(digits)).strip(" ")
    lines = {(h, t): [n for x in (t or "").split("\n") if (n := norm(x)) and len(n.split(" ")) <= line_words] for h, t in rows}
    docs, count = Counter(h for h, _ in lines), Counter((h, x) for (h, _), xs in lines.items() for x in set(xs))
    over = {k for k, n in count.items() if n > limit and n > share * docs[k[0]]}
    return [sum(len(x.split(" ")) for x in lines[h, t] if (h, x) in over) for h, t in rows]


def bag(text, k):
    w = (text or "").encode().split()
    return Counter(tuple(w[p:p + k]) for p in range(max(1, len(w) - k + 1))) if w else Counter()


def similarity(a, b):
    least = sum(min(n, b.get(s, 0)) for s, n in a.items())
    most = sum(a.values()) + sum(b.values()) - least
    return least / most if most else 0.0


def classes(rows, k=5, least=0.8):
    """The smallest id of each row's class; rows: (id, text) with ids that differ."""
    bags = [bag(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def of(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or (bags[i] and similarity(bags[i], bags[j]) >= least):
                a, b = sorted((of(i), of(j)))
                root[b] = a
    smallest = {}
    for i, (key, _) in enumerate(rows):
        smallest[of(i)] = min(smallest.get(of(i), key), key)
    return {key: smallest[of(i)] for i, (key, _) in enumerate(rows)}


def unigram(rows):
    """(n_tokens, n_known, train_tokens, base) of each (learn, text)."""
    split = lambda t: [*lower(t).encode().split(), None]
    count = Counter(x for learn, t in rows if learn for x in split(t))
    n, v = sum(count.values()), len(count)
    return [(len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)) for w in (split(t) for _, t in rows)]


def url(u, rules_):
    u = u or ""
    host = path = ""
    if "://" in u:
        m = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1], re.S)
        host, path = lower(m[1]), m[2]
    best = None
    for r in rules_:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best)):
            best = r
    return host, path, best


def crc(i):
    return zlib.crc32(str(i).encode())


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests, fanout):
    """The top of a tree, and for each leaf the (left, right) siblings from the leaf up."""
    paths, cover, now = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(now) > 1:
        runs = [(now[a:a + fanout], cover[a:a + fanout]) for a in range(0, len(now), fanout)]
        for run, below in runs:
            for k, leaves in enumerate(below):
                for i in leaves:
                    paths[i].append((run[:k], run[k + 1:]))
        now, cover = [sha("".join(run)) for run, _ in runs], [sum(below, []) for _, below in runs]
    return now[0], paths


def merkle(rows, forge, fanout=8):
    """Per row (id, leaf, subroot, root, proof, folded, verified); rows: (id, lang, other values...), ``forge(row)``: the row that is there later."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    low = {}
    for v in langs:
        groups[v].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        low[v] = tree([leaf(r) for r in groups[v]], fanout)
    root, high = tree([low[v][0] for v in langs], fanout)
    out = []
    for v, up in zip(langs, high):
        for r, path in zip(groups[v], low[v][1]):
            folded = leaf(forge(r))
            for left, right in path + up:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join(d for left, right in path + up for d in left + right))
            out.append((r[0], leaf(r), low[v][0], root, proof, folded, folded == root))
    return out


def clusters(rows, k, rounds, dims, scale, seed):
    """Per kept row (id, cluster, squared distance), and the centroids; rows: (id, vector)."""
    good = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(good, key=lambda r: (sha(f"{seed}:{'null' if r[0] is None else r[0]}"), r[1]))[:k]
    centroids = [list(v) for _, v in start]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for n in range(rounds + 1):
        found = [min((away(v, c), j) for j, c in enumerate(centroids)) for _, v in good] if centroids else []
        if n < rounds:
            for j in range(len(centroids)):
                mine = [v for (_, v), (_, c) in zip(good, found) if c == j]
                if mine:
                    centroids[j] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, c, d) for (i, _), (d, c) in zip(good, found)], centroids


def shape(text):
    return re.sub(r"[^0-9/._-]+", "a", re.sub(r"[0-9]+", "0", text))


def templates(rows, support=5, spread=0.2, names=20):
    """The template of each (host, path); rows: {(host, path): (pages, labelled, bad)}."""
    segments = {k: [s for s in k[1].split("/") if s] for k in rows}
    out, level = dict.fromkeys(rows, ""), 0
    while True:
        deeper = Counter()
        for k, (n, _, _) in rows.items():
            if len(segments[k]) > level:
                deeper[k[0], out[k]] += n
        if not any(n >= support for n in deeper.values()):
            return {k: t + ("/**" if len(segments[k]) > level else "") for k, t in out.items()}
        kids, tails = {}, {}
        for k, counts in rows.items():
            if len(segments[k]) > level:
                at = k[0], out[k], segments[k][level]
                kids[at] = [a + b for a, b in zip(kids.get(at, (0, 0, 0)), counts)]
                tails.setdefault(at, Counter())[shape("/".join(segments[k][level + 1:]))] += counts[0]
        kids = {at: v for at, v in kids.items() if v[0] >= support}
        half = lambda x: math.floor(x + 0.5)
        band = {at: half(bad / labelled * 2) if labelled else -1 for at, (_, labelled, bad) in kids.items()}
        chief = {}
        for at, v in kids.items():
            key = (*at[:2], band[at])
            chief[key] = max(chief.get(key, (0, "")), (v[0], at[2]))
        merged, joins = {}, {}
        for at, v in kids.items():
            first = (*at[:2], chief[(*at[:2], band[at])][1])
            common = sum(min(c / v[0], tails[first][s] / kids[first][0]) for s, c in tails[at].items())
            joins[at] = first[2] if common >= 1 - spread else at[2]
            merged.setdefault((*at[:2], joins[at]), []).append(at[2])
        def name(at):
            group = sorted(merged[(*at[:2], joins[at])])
            if len(group) == 1:
                return group[0]
            return "{" + ("|".join(group) if len(group) <= names else f"{joins[at]}|+{len(group) - 1}") + "}"
        out = {k: t + ("" if len(segments[k]) <= level else "/" + (name(at) if (at := (k[0], t, segments[k][level])) in kids else "*")) for k, t in out.items()}
        level += 1


def url_verdicts(urls, rules_, weight=10.0, limit=0.8):
    """(template, verdict) of each URL."""
    rows, at = Counter(), {}
    for u in urls:
        host, path, rule = url(u, rules_)
        at[u] = host, path, rule
        rows[host, path] += 1
    counted = {}
    for host, path, rule in at.values():
        n, known = rows[host, path], rules_.get(rule)
        counted[host, path] = (n, n if known else 0, n if known == "block" else 0)
    named = templates(counted)
    labelled, bad = Counter(), Counter()
    for (host, path), (_, x, y) in counted.items():
        labelled[host, named[host, path]] += x
        bad[host, named[host, path]] += y
    out = {}
    for u, (host, path, rule) in at.items():
        t = host, named[host, path]
        out[u] = t[1], rules_[rule] if rule else "block" if (bad[t] + weight / 2) / (labelled[t] + weight) > limit else "allow"
    return out
