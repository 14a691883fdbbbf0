"""Plain versions of the operators, for small tables."""

import collections

import duckdb
import numpy as np
import pyarrow as pa
import regex

WORD = regex.compile(r"[^\x20\x09-\x0D]+")
NAME = regex.compile(r"[\p{L}\p{N}]+")


class Groups:
    def __init__(self, nodes):
        self.of = {n: n for n in nodes}

    def root(self, a):
        while self.of[a] != a:
            a = self.of[a]
        return a

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.of[max(a, b)] = min(a, b)


def near_duplicates(texts, similarity=0.8):
    sets = {}
    for d, x in texts.items():
        w = WORD.findall((x or "").lower())
        sets[d] = {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    groups, links, ids = Groups(sets), collections.Counter(), sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and shared >= similarity * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    return {d: (groups.root(d), links[d]) for d in ids}


def removed_words(texts, window=50):
    first, out = {}, {}
    for d in sorted(texts):
        w = WORD.findall(texts[d] or "")
        gone = [False] * len(w)
        runs = [tuple(w[i: i + window]) for i in range(len(w) - window + 1)]
        for i, run in enumerate(runs):
            if run in first and first[run] < d:
                gone[i: i + window] = [True] * window
        for run in runs:
            first.setdefault(run, d)
        out[d] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


def overlaps(texts, items, window=12, equal=10):
    numbers = {}

    def coded(x):
        return np.array([numbers.setdefault(w, len(numbers)) for w in NAME.findall((x or "").lower())], dtype=int)

    items = {i: coded(x) for i, x in items.items()}
    out = collections.defaultdict(set)
    for d, x in texts.items():
        a = coded(x)
        if len(a) < window:
            continue
        mine = np.lib.stride_tricks.sliding_window_view(a, window)
        for i, b in items.items():
            if len(b) >= window:
                theirs = np.lib.stride_tricks.sliding_window_view(b, window)
                same = sum((mine[:, k][:, None] == theirs[:, k][None, :]).astype(int) for k in range(window))
                for at in np.flatnonzero((same >= equal).any(axis=1)):
                    out[(d, i)].add(int(at))
    return {k: (len(v), min(v), max(v) + window) for k, v in out.items()}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def similar_pairs(lines, similarity=0.8):
    """All pairs (indices) of lines with that edit similarity, by edit distances alone.

    Two lines that are ``k`` edits apart differ in at most ``4 k`` pairs of letters, so most pairs need no distance.
    """
    if not lines:
        return []
    counts = np.zeros((len(lines), 512), dtype=np.int16)
    for i, line in enumerate(lines):
        for a, b in zip(line, line[1:]):
            counts[i, (ord(a) * 31 + ord(b)) % 512] += 1
    length, found = np.array([len(x) for x in lines]), []
    for i in range(len(lines) - 1):
        most = (np.maximum(length[i + 1:], length[i]) * (1 - similarity) + 1e-9).astype(int)
        likely = np.flatnonzero(np.abs(length[i + 1:] - length[i]) <= most)
        differ = np.abs(counts[i + 1 + likely] - counts[i]).sum(axis=1, dtype=np.int64)
        found += [(i, int(i + 1 + j)) for j in likely[differ <= 4 * most[likely]]]
    # The distance of the SQL engine counts bytes: each letter is given one of its own.
    letters = sorted({c for line in lines for c in line})
    assert len(letters) < 120
    lines = [line.translate({ord(c): i + 1 for i, c in enumerate(letters)}) for line in lines]
    table = pa.table({"a": [a for a, _ in found], "b": [b for _, b in found],
                      "x": [lines[a] for a, _ in found], "y": [lines[b] for _, b in found]})
    sql = f"SELECT a, b FROM t WHERE levenshtein(x, y) <= floor(greatest(length(x), length(y)) * {1 - similarity} + 1e-9)"
    return duckdb.connect().register("t", table).sql(sql).fetchall()


def normal_lines(texts):
    """Places of the lines that hold letters or digits, and the first place of each distinct one."""
    blank = regex.compile(r"[^\p{L}\p{N}\n]+")
    places, first = [], {}
    for d in sorted(texts):
        for i, line in enumerate(blank.sub(" ", (texts[d] or "").lower()).split("\n")):
            if line := line.strip(" "):
                places.append((d, i, line))
                first.setdefault(line, (d, i))
    return places, first


def removed_lines(texts, similarity=0.8):
    """Line numbers by document: all but the first occurrence of each group connected by edit similarity."""
    places, first = normal_lines(texts)
    lines = list(first)
    groups = Groups(range(len(lines)))
    for i, j in similar_pairs(lines, similarity):
        groups.join(i, j)
    stays, index = {}, {x: i for i, x in enumerate(lines)}
    for x, place in first.items():
        root = groups.root(index[x])
        stays[root] = min(stays.get(root, place), place)
    out = collections.defaultdict(set)
    for d, i, x in places:
        if stays[groups.root(index[x])] != (d, i):
            out[d].add(i)
    return out
