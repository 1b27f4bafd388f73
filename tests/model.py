"""Plain statements of the text rules, one text at a time, to compare the column expressions with."""

import math
import re


def words(text, stopwords):
    text = re.sub("[0-9#*]️?⃣", " ", text)
    return [w for w in re.sub(r"[^A-Za-z0-9\s]", " ", text).lower().split() if w not in stopwords]


def topics(cleaned, table):
    return [t for t, keywords in table.items() if any(k in cleaned for k in keywords)]


def compound(tokens, valences, rules, repeats):
    tokens = [t for t in tokens if len(t) > 1]
    total = 0.0
    for at, token in enumerate(tokens):
        i = tokens.index(token) if repeats == "first" else at
        total += _valence(i, tokens, valences, rules)
    return round(total / math.sqrt(total * total + 15), 4)


def _valence(i, tokens, valences, rules):
    def at(n):
        return tokens[i + n] if 0 <= i + n < len(tokens) else None

    def plain(n):
        return at(n) is not None and at(n) not in valences

    def group(first, length):
        found = [at(first + k) for k in range(length)]
        return None if None in found else " ".join(found)

    if at(0) not in valences or at(0) in rules.boosters:
        return 0.0
    if "kind of" in rules.booster_pairs and group(0, 2) == "kind of":
        return 0.0
    value = valences[at(0)]
    for n, weight in ((1, 1.0), (2, 0.95), (3, 0.9)):
        if not plain(-n):
            continue
        boost = rules.boosters.get(at(-n), 0.0) * weight
        value += -boost if value < 0 else boost
        strong = rules.emphatic
        if n == 2 and at(-2) == "never" and at(-1) in strong:
            value *= 1.5
        elif n == 3 and ((at(-3) == "never" and at(-2) in strong) or at(-1) in strong):
            value *= 1.25
        elif at(-n) in rules.negators:
            value *= -0.74
    if plain(-3):
        behind = [group(-1, 2), group(-2, 3), group(-2, 2), group(-3, 3), group(-3, 2)]
        for phrase in behind:
            if phrase in rules.idioms:
                value = rules.idioms[phrase]
                break
        for phrase in (group(0, 2), group(0, 3)):
            if phrase in rules.idioms:
                value = rules.idioms[phrase]
        if group(-3, 2) in rules.booster_pairs or group(-2, 2) in rules.booster_pairs:
            value -= 0.293
    if at(-1) == "least" and plain(-1) and at(-2) not in ("at", "very"):
        value *= -0.74
    return value
