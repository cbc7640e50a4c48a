"""Plain-Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name: str, columns: str):
    return duckdb.sql(f"SELECT {columns} FROM '{SF}/{name}.parquet'").fetchall()


def words(text):
    return WORD.findall(text or "")


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.root(a)] = self.root(b)


def near_groups(rows, n=4, percent=85):
    """Sorted (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    groups = Groups(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                groups.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            r = groups.root(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[i]), least.get(groups.root(i))) for i, (d, _) in enumerate(rows)), key=str)


def without_repeats(rows, window=35):
    """Sorted (doc_id, n_words, n_removed, kept_sha256) from counts of all windows."""
    texts = [words(t) for _, t in rows]
    times = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        left = [x for x, k in zip(w, keep) if k]
        out.append((d, len(w), len(w) - len(left), hashlib.sha256(" ".join(left).encode()).hexdigest()))
    return sorted(out, key=str)


def plain(df):
    return sorted([tuple(r) for r in df.collect()], key=str)
