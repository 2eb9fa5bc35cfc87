"""Plain-Python answers for small inputs, written from the definitions."""

import math
import re
from collections import Counter


def words(text):
    return [w for w in re.findall(r"\w+", (text or "").lower()) if len(w) > 2]


class Corpus:
    def __init__(self, texts):
        self.counts = {d: Counter(words(t)) for d, t in texts.items()}
        self.length = {d: sum(c.values()) for d, c in self.counts.items()}
        self.df = Counter(t for c in self.counts.values() for t in c)
        self.n = len(texts)

    def idf(self, term, method):
        df = self.df[term]
        if method == "smooth":
            return math.log((self.n + 1) / (df + 1)) + 1
        return math.log(self.n / df) if df else 0.0

    def ranking(self, query, method):
        """(doc, score), best first; ties by the first matching query word, then by document."""
        terms = words(query)
        found = []
        for d, c in self.counts.items():
            at = [i for i, t in enumerate(terms) if c[t]]
            if at:
                score = 0.0
                for i in at:
                    score += c[terms[i]] / self.length[d] * self.idf(terms[i], method)
                found.append((-score, at[0], d))
        return [(d, -s) for s, _, d in sorted(found)]
