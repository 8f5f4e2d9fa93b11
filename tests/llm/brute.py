"""Plain Python versions of the operators' contracts, for small inputs."""

import collections
import hashlib
import re
import zlib

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text, shingle=4):
    w = SPACED.findall((text or "").translate(LOWER))
    parts = [" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(rows, distance=4):
    """[(doc_id, fingerprint hex, component)] of [(doc_id, text)]."""
    fps = [(i, simhash(t)) for i, t in rows]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for n, a in enumerate(distinct):
        for b in distinct[n + 1:]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [(i, f"{f:016x}", least.get(find(f))) for i, f in fps]


def repeats(rows, window=13):
    """[(doc_id, n_words, n_removed, sha of the kept words)]."""
    first = {}
    for i, t in rows:
        w = SPACED.findall(t or "")
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = SPACED.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def leaks(rows, items, size=10):
    """[(doc_id, n_words, n_hit, n_items, sha of the items)]."""
    windows = collections.defaultdict(set)
    for name, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if m and name is not None else 0):
            windows[tuple(w[k:k + m])].add(name)
    out = []
    for i, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for m in {len(k) for k in windows}:
            for k in range(len(w) - m + 1):
                if names := windows.get(tuple(w[k:k + m])):
                    hit.update(range(k, k + m))
                    found |= names
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found))))))
    return out


def template(line, lead=4, tail=2, share=0.6):
    t = [re.sub(r"[^ \t\r\f\x0B]*[0-9][^ \t\r\f\x0B]*", "<*>", x) for x in re.split(r"[ \t\r\f\x0B]+", line) if x]
    if not t:
        return None
    if min(len(t), lead + tail) >= len(t) * share and len(t) > lead + tail:
        return (len(t), *t[:lead], *t[-tail:])
    return (len(t), *t)


def lines(rows, min_docs=10):
    """[(doc_id, text left)]."""
    texts, keeper = collections.defaultdict(set), {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if k := template(x):
                texts[k].add(t)
                if i is not None:
                    keeper[k] = min(keeper.get(k, i), i)
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        kept = [x for x in t.split("\n") if not (k := template(x)) or len(texts[k]) < min_docs
                or (i is not None and keeper.get(k) == i)]
        out.append((i, "\n".join(kept)))
    return out


def template_lines(rows, copies_once=False, keys=None):
    """[(doc_id, text left)] by the fixed-depth tree: count, block, majority token of each position."""
    def masked(line):
        return tuple(re.sub(r"[^ \t\r\f\x0B]*[0-9][^ \t\r\f\x0B]*", "<*>", x)
                     for x in re.split(r"[ \t\r\f\x0B]+", line) if x)

    whos, holders = collections.defaultdict(set), collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if k := masked(x):
                whos[k].add(t if copies_once or i is None else i)
                if copies_once or i is not None:
                    holders[k].add(keys[t] if copies_once else i)
    leaves = collections.defaultdict(list)
    for k in whos:
        n = len(k)
        b = 3 if n >= 9 else 2 if n >= 6 else 0
        for j in range(b):
            leaves[n, j, k[n * j // b:n * (j + 1) // b]].append(k)
    group = {k: (0, 0, k) for k in whos}  # (lines, -block, leaf), the largest wins
    for leaf, ks in leaves.items():
        if len(ks) < 2:
            continue
        common = [next((t for t, c in collections.Counter(col).items() if 2 * c > len(ks)), None) for col in zip(*ks)]
        for k in ks:
            if sum(a == b for a, b in zip(k, common)) >= 0.6 * len(k):
                group[k] = max(group[k], (len(ks), -leaf[1], leaf), key=lambda g: g[:2])
    members = collections.defaultdict(list)
    for k, g in group.items():
        members[g].append(k)
    keeper = {}
    for g, ks in members.items():
        if len(set().union(*(whos[k] for k in ks))) > 1:
            held = set().union(*(holders[k] for k in ks))
            keeper.update(dict.fromkeys(ks, min(held) if held else None))
    out = []
    for i, t in rows:
        own = keys[t] if copies_once and t is not None else i
        out.append((i, None if t is None else "\n".join(
            x for x in t.split("\n") if (k := masked(x)) not in keeper or (own is not None and keeper[k] == own))))
    return out


def token_ids(texts, path):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in found]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def top_k(vectors, queries, k=10):
    """{query: [(vec_id, score)]} of [(vec_id, ints)]."""
    out = {}
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q)[:k]
        out[q] = [(i, -s) for s, i in scored]
    return out
