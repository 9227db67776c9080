"""Plain Python versions that the operators are held against."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def groups(ids, links):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def near_groups(docs, k, percent=80):
    """docs: (id, text) with distinct ids -> id -> (set size, component)."""
    sets = {i: shingles(t, k) for i, t in docs}
    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    links, seen = [], set()
    for members in where.values():
        for b in members[1:]:
            for a in members:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    same = len(sets[a] & sets[b])
                    if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                        links.append((a, b))
    root = groups(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


def cut_passages(docs, length=50):
    """docs: (id, text) -> id -> (bytes, removed, spans, sha256 of the rest)."""
    import hashlib

    raw = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in raw:
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def quality_counts(text):
    """(words, word_chars, symbols, dup_lines, repeat_words, base_failed)"""
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i:i + 8]), []).append(i)
    cover = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(cover),
            len(w) < 20 or 100 * len(cover) > 30 * len(w))


def line_verdict(text):
    """The line rules in plain Python: (kept, text without failing lines)."""
    from tracelake.llm.quality import BOILERPLATE, MENU_MARKS

    text = text or ""
    seen, lost, parts = set(), 0, []
    for line in text.split("\n"):
        w = WORD.findall(line)
        low = lower(line).encode()
        bad = bool(w) and (
            (len(w) <= 5 and not line.rstrip(" \t\x0b\x0c\r").endswith(tuple(".!?:;,\"')]}…。！？”’")))
            or (len(w) <= 12 and sum(low.count(m) for m in MENU_MARKS) > 1)
            or (len(w) <= 30 and any(b in low for b in BOILERPLATE))
            or sum(c in "#*$%&|<>" for c in line) > 0.5 * len(w)
            or line in seen)
        seen.add(line)
        lost += len(w) if bad else 0
        parts.append((line, bad))
    words, *_, failed = quality_counts(text)
    out = "".join((line + ("\n" if i + 1 < len(parts) else "")) for i, (line, bad) in enumerate(parts) if not bad)
    return not failed and 2 * lost <= words, out


def poisson_copies(rows, seed=0):
    """rows: (id, source) -> id -> copies, for weights by the square root of source sizes."""
    import hashlib
    import math

    size = {}
    for _, s in rows:
        size[s or ""] = size.get(s or "", 0) + 1
    total = sum(math.sqrt(n) for n in size.values())
    out = {}
    for i, s in rows:
        rate = math.sqrt(size[s or ""]) / total * len(rows) / size[s or ""]
        u = int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        k, p, c = 0, math.exp(-rate), math.exp(-rate)
        while c <= u and k < 1000:
            k += 1
            p *= rate / k
            c += p
        out[i] = k
    return out
