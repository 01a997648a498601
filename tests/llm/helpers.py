"""Small inputs and plain re-computations for the training-data tests."""

import random
import re

WORDS = "the of and data spark engine table query river stone green light under over from with plan join group window".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", ","]) for _ in range(n))


def near_copy(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=1, bases=12, copies=6, words=120):
    """Texts with exact copies, near copies at several distances, and a passage that many share."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    texts = []
    for _ in range(bases):
        base = prose(rng, words)
        texts += [base, base.upper()]
        texts += [near_copy(rng, base, e) for e in range(1, copies)]
        texts.append(prose(rng, words) + " " + passage)
    rng.shuffle(texts)
    return texts


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute_components(texts, percent=85, words=4):
    """Smallest reachable index of each text, from all pairs."""
    sets = [shingle_set(t, words) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [(len(sets[i]), find(i)) for i in range(len(texts))]
