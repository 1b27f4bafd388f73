"""Plain versions of the operators, for small tables: written from the contracts, without the operators' code."""

import re
import zlib
from hashlib import sha256

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def licenses(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    w, places, labels = words(text), [], set()
    for phrase, label in phrases.items():
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def contamination(text, items, length=13):
    """(n_words, n_hit, n_items, items_sha256, contaminated)."""
    w, hit, ids = words(text), set(), set()
    for item, item_text in items:
        v = words(item_text)
        n = min(length, len(v))
        for k in range(len(v) - n + 1) if n else ():
            for i in range(len(w) - n + 1):
                if w[i : i + n] == v[k : k + n]:
                    hit |= set(range(i, i + n))
                    ids |= {item}
    named = ",".join(sorted(str(i) for i in ids if i is not None))
    return len(w), len(hit), len({i for i in ids if i is not None}), sha256(named.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


def shingles(text):
    w = TOKEN.findall((text or "").translate(AZ))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    """doc_id -> (n_shingles, component_id), for distinct ids."""
    sets = {d: shingles(t) for d, t in rows}
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                x = len(sets[a] & sets[b])
                if 100 * x >= 85 * (len(sets[a]) + len(sets[b]) - x):
                    p, q = root(a), root(b)
                    label[max(p, q)] = min(p, q)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def personal(text):
    """[(kind, start, end)] of the base kinds."""
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(PII) for m in re.finditer(p, text or "") if ok(m[0])]
    return [(k, s, e) for s, _, k, e in sorted(found)]


def crc(text):
    return zlib.crc32((text or "").encode())
