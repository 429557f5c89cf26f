"""Plain Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = " \t\n\x0b\x0c\r"


def shingle_set(text, size=5):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows, percent=80):
    """(id, text) rows: size of the set and least linked id of each row."""
    sets = [shingle_set(text) for _, text in rows]
    holders = defaultdict(list)
    for k, found in enumerate(sets):
        for shingle in found if rows[k][0] is not None else ():
            holders[shingle].append(k)
    up = list(range(len(rows)))

    def top(k):
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    for k, found in enumerate(sets):
        if rows[k][0] is None:
            continue
        shared = Counter(j for shingle in found for j in holders[shingle] if j < k)
        for j, n in shared.items():
            if 100 * n >= percent * (len(found) + len(sets[j]) - n):
                up[top(k)] = top(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(k)] = min(least.get(top(k), doc), doc)
    return [(doc, len(sets[k]), least.get(top(k))) for k, (doc, _) in enumerate(rows)]


def dedup_lines(rows, min_chars=10):
    """(id, text) rows: id, number of lines, dropped ones and the text that stays."""
    key = lambda line: line.strip(BLANKS).translate(LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if doc is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == doc
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def leaks(text, items, size=10):
    """Words, hit words and items of one text."""
    words = bench_words(text)
    hit, named = set(), set()
    for item, content in items:
        found = bench_words(content)
        k = min(size, len(found))
        windows = {tuple(found[i : i + k]) for i in range(len(found) - k + 1)} if k else set()
        for i in range(len(words) - k + 1) if k else ():
            if tuple(words[i : i + k]) in windows:
                hit.update(range(i, i + k))
                named.add(str(item))
    return len(words), len(hit), sorted(named)


def best_score(text, score, unknown, longest):
    """Score of the best path through the pieces, by the plain recurrence over characters."""
    best = [0.0] + [float("-inf")] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece in score:
                best[end] = max(best[end], best[start] + score[piece])
        if text[end - 1] not in score:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]
