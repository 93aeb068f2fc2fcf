"""Plain re-computations that the operators are held against."""

import itertools
import re

import numpy as np

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def luhn(digits):
    values = [int(c) for c in reversed(digits)]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def base_spans(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                  if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def shingle_set(text):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall("[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def near_components(rows):
    """{doc_id: smallest id reachable} over texts linked at 85 percent; all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    union = Union({i for i, _ in sets})
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            union.join(i, j)
    return {i: union.find(i) for i, _ in sets}


def vector_links(rows, d, cosine=0.95):
    """([(vec_id, links)], {vec_id: component}) of the vectors that can link; all pairs."""
    ok = [(i, np.array(v, float)) for i, v in rows
          if i is not None and v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    if not ok:
        return [], {}
    x = np.array([v / np.sqrt((v ** 2).sum()) for _, v in ok])
    hit = x @ x.T >= cosine
    np.fill_diagonal(hit, False)
    union = Union({i for i, _ in ok})
    for a, b in zip(*np.nonzero(hit)):
        union.join(ok[a][0], ok[b][0])
    return [(ok[k][0], int(hit[k].sum())) for k in range(len(ok))], {i: union.find(i) for i, _ in ok}
