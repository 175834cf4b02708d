"""Plain models of the operators' contracts, for small inputs."""

import collections
import math
import re

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))


def decontaminated(docs, items, window=13):
    """{id: (n_words, n_hit, item names, contaminated)} of (id, text) rows."""
    wanted = collections.defaultdict(set)
    for name, text in items:
        w = PLAIN.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wanted[tuple(w[i:i + window])].add(name)
    out = {}
    for d, text in docs:
        w, hit, names = PLAIN.findall(lower(text)), set(), set()
        for size in {len(k) for k in wanted}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in wanted:
                    hit.update(range(i, i + size))
                    names |= wanted[tuple(w[i:i + size])]
        out[d] = (len(w), len(hit), sorted(n for n in names if n is not None), bool(hit) and 20 * len(hit) >= len(w))
    return out


def shingles(text, k):
    w = BLANK.findall(lower(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(docs, k=4, percent=80):
    """{id: (set size, smallest id reachable)}; ids are distinct."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= percent * (len(sets[a]) + len(sets[b]) - inter):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def without_repeats(docs, window=50):
    """{id: (n_words, n_removed, kept words)}; ids are distinct."""
    words, first = {d: BLANK.findall(t or "") for d, t in docs}, {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), d)
    out = {}
    for d, w in words.items():
        gone = {p for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for p in range(i, i + window)}
        out[d] = (len(w), len(gone), [x for p, x in enumerate(w) if p not in gone])
    return out


def rule_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = BLANK.findall(text)
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(windows)
    repeated = {p for i, x in enumerate(windows) if n[x] > 1 for p in range(i, i + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


class KneserNey:
    """log P(word | before, toxic) - log P(word | before, ordinary), from (text, label) rows and all texts of the corpus."""

    def __init__(self, labelled, corpus, discount=1.5, stem_bytes=6):
        self.d, self.stem_bytes = discount, stem_bytes
        self.shared_word = collections.Counter(w for t in corpus for w in self.words(t))
        self.shared_stem = collections.Counter()
        for w, n in self.shared_word.items():
            self.shared_stem[self.stem(w)] += n
        self.mass = sum(n + 0.5 for n in self.shared_stem.values()) + 0.5
        self.within = collections.Counter()
        for w, n in self.shared_word.items():
            self.within[self.stem(w)] += n + 0.5
        self.pairs = [collections.Counter(), collections.Counter()]
        for text, label in labelled:
            w = self.words(text)
            self.pairs[int(label != 0)].update(zip([None, *w], w))

    @staticmethod
    def words(text):
        return PLAIN.findall(lower(text))

    def stem(self, w):
        return w.encode()[:self.stem_bytes]

    def discounted(self, counts, unit, total):
        """(discounted share of the unit, share left to the backoff)."""
        left = sum(min(n, self.d) for n in counts.values()) / max(1, total)
        return max(counts.get(unit, 0) - self.d, 0) / max(1, total), max(1e-9, left)

    def p(self, c, before, word):
        pairs, stem = self.pairs[c], self.stem(word)
        stems = collections.Counter(s for s, _ in {(self.stem(w), b) for b, w in pairs})
        words = collections.Counter(w for _, w in pairs)
        own, left = self.discounted(stems, stem, sum(stems.values()))
        p = own + left * (self.shared_stem[stem] + 0.5) / self.mass
        own, left = self.discounted(words, word, sum(words.values()))
        within = (self.shared_word[word] + 0.5) / self.within[stem] if self.within[stem] else 1
        p = own + left * p * within
        history = {w: n for (b, w), n in pairs.items() if b == before}
        total = max(1, sum(history.values()))
        kept = sum(max(n - self.d, 0) for n in history.values())
        return max(history.get(word, 0) - self.d, 0) / total + min(1, max(1e-3, 1 - kept / total)) * p

    def ratios(self, text):
        w = self.words(text)
        return [math.log(self.p(1, b, x) / self.p(0, b, x)) for b, x in zip([None, *w], w)]
