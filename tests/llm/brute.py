"""Plain Python versions of the operators."""

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def substring(rows, order, k=20):
    """Words, removed words and hash of what is kept, for documents in reading order."""
    seen, out = set(), {}
    for row in sorted(rows, key=order):
        own = words(row[1])
        gone = [False] * len(own)
        for j in range(len(own) - k + 1):
            window = tuple(own[j : j + k])
            if window in seen:
                gone[j : j + k] = [True] * k
            seen.add(window)
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out[row] = len(own), sum(gone), hashlib.sha256(kept).hexdigest()
    return out


def lines(rows, percent=80):
    """The text without later similar lines, for rows of (id, text, ...); rows that share an id are one document."""
    places = {(row[0], n, frozenset(words(x))) for row in rows for n, x in enumerate((row[1] or "").split("\n"))}
    earlier, gone = [], set()
    for place in sorted((p for p in places if p[2]), key=lambda p: p[:2]):
        if any(100 * len(place[2] & x) >= percent * len(place[2] | x) for x in earlier):
            gone.add(place)
        earlier.append(place[2])
    out = {}
    for row in rows:
        own = (row[1] or "").split("\n")
        kept = [x for n, x in enumerate(own) if (row[0], n, frozenset(words(x))) not in gone]
        out[row] = (None if row[1] is None else "\n".join(kept)), len(own) - len(kept)
    return out


LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text, k=3):
    own = words((text or "").encode().translate(LOWER).decode())
    return frozenset(tuple(own[j : j + k]) for j in range(len(own) - k + 1)) if len(own) >= k else frozenset([tuple(own)] if own else [])


def components(rows, percent=90, k=3):
    """Size of the set and the rows reachable by links, for each row."""
    sets = [shingles(t, k) for _, t in rows]
    label = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if x and 100 * len(x & y) >= percent * len(x | y):
                a, b = label[i], label[j]
                label = [b if v == a else v for v in label]
    return [(len(s), [rows[j] for j in range(len(rows)) if label[j] == label[i]]) for i, s in enumerate(sets)]


def edited(texts):
    """Edited text of each, texts in order, the first after the last."""
    out = []
    for i, t in enumerate(texts):
        half = len(t) // 2
        out.append(t[: len(t) - half] + texts[(i + 1) % len(texts)][:half])
    return out
