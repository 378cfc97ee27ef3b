"""Plain versions of what the operators compute."""

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
KINDS = ("email", "ip", "card", "phone")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def pii(text):
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return [f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


def repeat_words(words, k=8):
    at = defaultdict(list)
    for i in range(len(words) - k + 1):
        at[tuple(words[i : i + k])].append(i)
    return len({i + j for v in at.values() if len(v) > 1 for i in v for j in range(k)})


def quality(text):
    t = text or ""
    w = SPACED.findall(t)
    lines = [x for x in t.split("\n") if SPACED.search(x)]
    r = repeat_words(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), r, len(w) < 20 or 100 * r > 30 * len(w))


def decontaminate(docs, items):
    wins = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(lower(t or ""))
        if w:
            for j in range(max(1, len(w) - 9)):
                wins[tuple(w[j : j + 10])].add(i)
    sizes = {len(x) for x in wins}
    out = {}
    for d, t in docs:
        w = ALNUM.findall(lower(t or ""))
        hit, found = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if x := wins.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= x
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def shingles(text, k):
    w = SPACED.findall(lower(text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(docs, k=4, percent=85):
    sets = {d: shingles(t, k) for d, t in docs}
    seen, pairs = defaultdict(set), Counter()
    for d, s in sets.items():
        for x in s:
            seen[x].add(d)
    for v in seen.values():
        v = sorted(v)
        for i, a in enumerate(v):
            for b in v[i + 1 :]:
                pairs[a, b] += 1
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def substrings(docs, size=200):
    data = {d: (t or "").encode() for d, t in docs}
    count = Counter(hashlib.md5(b[i : i + size]).digest() for b in data.values() for i in range(len(b) - size + 1))
    out = {}
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[hashlib.md5(b[i : i + size]).digest()] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept))
    return out


def phrases(rows, least, longest, top):
    """rows: (lang, text)."""
    counts, words_of = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            words_of[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        mine = []
        for p, a in held.items():
            inside = (q for q in held if len(q) > len(p) and held[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q))))
            if next(inside, None) is None:
                score, k = min((1000 * a * words_of[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                mine.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, lo, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, lo, r, words_of[lang], -score))
    return sorted(out)


def search(docs, items, k):
    """docs: (doc_id, text); items: (item_id, text). Rows of item, rank, doc, score."""
    import math

    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    held = [(d, Counter(cut.findall(lower(t or "")))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        asked, scored = Counter(cut.findall(lower(text or ""))), []
        for d, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, r in asked.items() if c[t])
            if s > 0:
                scored.append((-s, d))
        out += [(item, rank, d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)
