"""Plain-Python counterparts that the operators are held against."""

import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [word for word in re.split("[ \t-\r]+", (text or "").translate(LOWER)) if word]


def shingles(text):
    found = words(text)
    return [tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))] if found else []


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def union(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def jaccard_groups(rows):
    """key -> (set size, smallest key reachable), from all pairs that share a shingle."""
    sets, groups, holders = {}, Groups(), {}
    for key, text in rows:
        sets[key] = set(shingles(text))
        groups.find(key)
    for key, own in sets.items():
        near = {other for shingle in own for other in holders.get(shingle, ())}
        for other in near:
            common = len(own & sets[other])
            if 100 * common >= 75 * (len(own) + len(sets[other]) - common):
                groups.union(key, other)
        for shingle in own:
            holders.setdefault(shingle, []).append(key)
    return {key: (len(own), groups.find(key)) for key, own in sets.items()}


def leaked(docs, items):
    """(doc, item) -> best weighted similarity over all item-sized windows, where it reaches 0.75."""
    found = {}
    for doc, text in docs:
        have = words(text)
        for item, item_text in items:
            want = words(item_text)
            if not want or not have:
                continue
            width = min(5, len(want))
            grams = [tuple(have[i:i + width]) for i in range(len(have) - width + 1)]
            wanted = Counter(tuple(want[i:i + width]) for i in range(len(want) - width + 1))
            if not any(gram in wanted for gram in grams):
                continue
            n = sum(wanted.values())
            best = 0.0
            for start in range(max(1, len(grams) - n + 1)):
                window = Counter(grams[start:start + n])
                common = sum((window & wanted).values())
                best = max(best, common / (n + sum(window.values()) - common))
            if best >= 0.75:
                found[doc, item] = best
    return found
