"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACES = " \t\n\x0b\x0c\r"


def spaced_words(text):
    return SPACED.findall((text or "").translate(LOW))


def shingles(text, width):
    words = spaced_words(text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1)))


def groups(texts: dict, width: int) -> dict:
    """The smallest id of each id's component."""
    sets = {k: shingles(v, width) for k, v in texts.items()}
    parent = {k: k for k in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in texts}


def windows(items: dict, width: int = 10) -> dict:
    out = {}
    for item, text in items.items():
        words = ALNUM.findall((text or "").translate(LOW))
        for i in range(max(len(words) - width + 1, 1) if words else 0):
            out.setdefault(tuple(words[i:i + width]), set()).add(str(item))
    return out


def leaks(text, found: dict):
    """Word spans, hit words and items of a text."""
    spans = [m.span() for m in ALNUM.finditer((text or "").translate(LOW))]
    words = [(text or "").translate(LOW)[a:b] for a, b in spans]
    hit, items = set(), set()
    for n in {len(w) for w in found}:
        for i in range(len(words) - n + 1):
            names = found.get(tuple(words[i:i + n]))
            if names:
                hit |= set(range(i, i + n))
                items |= names
    return spans, hit, items


def without(text, spans, hit):
    out, at, i = [], 0, 0
    while i < len(spans):
        if i in hit:
            j = i
            while j + 1 in hit:
                j += 1
            out.append(text[at:spans[i][0]])
            at = spans[j][1]
            i = j
        i += 1
    return "".join(out) + text[at:] if text is not None else None


def site_lines(rows, ratio, least, whole=1.0):
    """Cleaned text by id for rows of (id, host, text)."""
    pages, seen = {}, {}
    for host, text in {(host, text) for _, host, text in rows if host is not None and text is not None}:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(SPACES) for x in text.split("\n")} - {""}:
            seen[host, line] = seen.get((host, line), 0) + 1
    out = {}
    for key, host, text in rows:
        if host is None or text is None:
            out[key] = text
            continue

        def bad(line, host=host):
            n = seen.get((host, line.strip(SPACES)), 0)
            return n >= least and n > ratio * pages[host]
        kept = "\n".join(x for x in text.split("\n") if not bad(x))
        small = len(kept.strip(SPACES)) < (1 - whole) * len(text.strip(SPACES))
        out[key] = text if small else kept
    return out


def quality(text, stops):
    words = SPACED.findall(text or "")
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    runs = {}
    for i in range(len(words) - 7):
        runs.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeated = {i + k for at in runs.values() if len(at) > 1 for i in at for k in range(8)}
    n = len(words)
    counts = (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
              len(repeated))
    base = n < 20 or 100 * len(repeated) > 30 * n
    method = not base and (
        2 <= counts[1] / n <= 18 and counts[2] / n <= 0.1 and sum(w.lower() in stops for w in words) / n >= 0.02
        and counts[3] / len(lines) <= 0.5 and sum(x.rstrip(" ").endswith("...") for x in lines) / len(lines) <= 0.7
        and sum(any(c.isalpha() for c in w) for w in words) / n >= 0.7)
    return counts, base, method
