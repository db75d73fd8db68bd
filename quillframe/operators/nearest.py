"""Nearest texts by edits: a tree of texts walked for many queries at once, and one-to-one matches that ask it for what they need."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEAM = 3  # branches of the trial walk, whose find prunes the full one
CELLS = 4_000_000  # of the distance tables of one step
BATCH = 2048  # queries of one walk
ROWS = 1 << 23  # scores of whole rows that are kept


def _similarity(distance: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """1 - distance / longer length; two empty texts are equal."""
    return np.where(longest == 0, 1.0, 1 - distance / np.maximum(longest, 1))


def _matrix(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' code points, a row each, -1 behind their ends, and their lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.full((len(texts), int(lengths.max(initial=0))), -1, np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)
    return out, lengths


class Tree:
    """A prefix tree of texts, each with owners (numbers from 0), that finds by likeness: 1 - edits / longer length.

    A branch is left when no text below it can reach what its query needs: the
    least entry of its distance table, with the edits that the lengths left
    force, never exceeds the distance to a text below. So finds are exact.
    """

    def __init__(self, texts: Sequence[str], owners: Sequence[int]):
        self.texts, inverse = np.unique(np.array(texts, object), return_inverse=True)
        self.owners = np.asarray(owners, np.int64)
        order = np.lexsort((self.owners, inverse))
        self.by_text, self.at = self.owners[order], np.searchsorted(inverse[order], np.arange(len(self.texts) + 1))
        self.first = self.by_text[self.at[:-1]]  # the lowest owner that is left
        self.n = int(self.owners.max(initial=-1)) + 1
        chars, lengths = _matrix(self.texts)
        self.lengths, count = lengths, len(lengths)
        differ = np.ones((count, chars.shape[1] + 1), bool)
        differ[1:, :-1] = chars[1:] != chars[:-1]
        common = differ.argmax(1)
        common[0] = -1
        self.levels, starts, self.live, self.under = [], np.zeros(1, np.int64), None, None
        self.root = 0 if count and lengths[0] == 0 else -1
        for d in range(1, chars.shape[1] + 1):
            cut = np.flatnonzero(common < d)
            keep = lengths[cut] >= d
            below = cut[keep]
            parent = np.searchsorted(starts, below, "right") - 1
            self.levels.append({
                "first": np.searchsorted(parent, np.arange(len(starts) + 1)), "char": chars[below, d - 1], "text": np.where(lengths[below] == d, below, -1), "start": below,
                "most": np.maximum.reduceat(lengths, cut)[keep], "least": np.minimum.reduceat(lengths, cut)[keep],
            })
            starts = below

    def remove(self, owner: int, texts: Sequence[int], gone: np.ndarray) -> None:
        """Finds leave this owner out from now on; ``gone`` marks those removed."""
        if self.live is None:
            ends = [np.append(v["start"], len(self.texts)) for v in self.levels]
            self.under = [np.searchsorted(e, np.arange(len(self.texts)), "right") - 1 for e in ends]
            for d, under in enumerate(self.under, 1):
                under[self.lengths < d] = -1
            left = self.first < self.n
            self.live = [np.bincount(u[(u >= 0) & left], minlength=len(v["char"])) for u, v in zip(self.under, self.levels)]
        for t in texts:
            if self.first[t] == owner:
                rest = self.by_text[self.at[t]:self.at[t + 1]]
                rest = rest[~gone[rest]]
                self.first[t] = rest[0] if len(rest) else self.n
                if not len(rest):
                    for d in range(self.lengths[t]):
                        self.live[d][self.under[d][t]] -= 1

    def _walk(self, d: int, query: np.ndarray, node: np.ndarray, table: np.ndarray, chars: np.ndarray, need: np.ndarray, found, beam: int = 0) -> None:
        """Calls ``found(queries, texts, similarities)`` for texts below the nodes of depth d."""
        width, todo = chars.shape[1], [(d, query, node, table)]
        j = np.arange(width + 1, dtype=table.dtype)
        rest = j[::-1]
        while todo:
            d, query, node, table = todo.pop()
            if d == len(self.levels) or not len(query):
                continue
            level = self.levels[d]
            n = level["first"][node + 1] - level["first"][node]
            if not beam and len(query) > 1 and n.sum() * (width + 1) > CELLS:
                half = len(query) // 2
                todo += [(d, query[half:], node[half:], table[half:]), (d, query[:half], node[:half], table[:half])]
                continue
            above = np.repeat(np.arange(len(query)), n)
            child = np.repeat(level["first"][node] - np.cumsum(n) + n, n) + np.arange(len(above))
            if self.live is not None:
                above, child = (x[self.live[d][child] > 0] for x in (above, child))
            q = query[above]
            old = table[above]
            new = old + 1
            np.minimum(new[:, 1:], old[:, :-1] + (chars[q] != level["char"][child][:, None]), out=new[:, 1:])
            new = np.minimum.accumulate(new - j, 1) + j
            end = level["text"][child]
            hit = np.flatnonzero(end >= 0)
            hit = hit[self.first[end[hit]] < self.n]
            if len(hit):
                found(q[hit], end[hit], _similarity(new[hit, -1], np.maximum(width, d + 1)))
            more, less = ((level[k][child] - (d + 1)).astype(table.dtype)[:, None] for k in ("most", "least"))
            low = (new + np.maximum(0, np.maximum(rest - more, less - rest))).min(1)
            keep = np.flatnonzero(_similarity(low, np.maximum(width, level["most"][child])) >= need[q])
            if beam:
                order = keep[np.lexsort((low[keep], q[keep]))]
                keep = order[np.arange(len(order)) - np.searchsorted(q[order], q[order]) < beam]
            todo.append((d + 1, q[keep], child[keep], new[keep]))

    def _each(self, texts: Sequence[str], walk) -> None:
        """Calls ``walk(rows, characters, start)`` for batches of texts of one length."""
        chars, lengths = _matrix(texts)
        kind = np.int16 if len(self.levels) + lengths.max(initial=0) < 1 << 14 else np.int32
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            for k in range(0, len(rows), BATCH):
                part = rows[k:k + BATCH]
                start = lambda part=part, n=n: (0, np.arange(len(part)), np.zeros(len(part), np.int64), np.tile(np.arange(n + 1, dtype=kind), (len(part), 1)))
                walk(part, np.ascontiguousarray(chars[part, :n]), start)

    def _at_root(self, n: int, count: int, found) -> None:
        if self.root == 0 and self.first[0] < self.n:
            found(np.arange(count), np.zeros(count, np.int64), _similarity(np.full(count, n), np.full(count, n)))

    def best(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the owner with the likest text, the lowest on a tie, and the similarity; the number of owners and -1 if none is left."""
        owner, most = np.full(len(texts), self.n), np.full(len(texts), -1.0)

        def walk(rows, chars, start):
            need, who = np.full(len(rows), -1.0), np.full(len(rows), self.n)

            def found(q, text, s):
                before = need.copy()
                np.maximum.at(need, q, s)
                who[need > before] = self.n
                tie = s == need[q]
                np.minimum.at(who, q[tie], self.first[text[tie]])

            self._at_root(chars.shape[1], len(rows), found)
            self._walk(*start(), chars, need, found, BEAM)
            self._walk(*start(), chars, need, found)
            owner[rows], most[rows] = who, need

        self._each(texts, walk)
        return owner, most

    def within(self, texts: Sequence[str], need: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, texts of the tree, similarities) of all pairs that reach what each row needs."""
        need, out = np.asarray(need, float), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

        def walk(rows, chars, start):
            def found(q, text, s):
                ok = s >= need[rows][q]
                out.append((rows[q[ok]], text[ok], s[ok]))

            self._at_root(chars.shape[1], len(rows), found)
            self._walk(*start(), chars, need[rows], found)

        self._each(texts, walk)
        return tuple(map(np.concatenate, zip(*out)))


class _Side:
    """Ids in order, and their different texts."""

    def __init__(self, ids: pd.Series, texts: pd.Series):
        self.ids, owner = np.unique(ids.to_numpy(), return_inverse=True)
        pairs = pd.DataFrame({"owner": owner, "text": texts.to_numpy()}).drop_duplicates().sort_values("owner", kind="stable")
        self.owner, self.text = pairs.owner.to_numpy(), pairs.text.to_numpy()
        self.at = np.searchsorted(self.owner, np.arange(len(self.ids) + 1))

    def of(self, i: int) -> np.ndarray:
        return self.text[self.at[i]:self.at[i + 1]]


def _firsts(rows: _Side, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Of each row its best column, the lowest on a tie, and the score."""
    column, score = tree.best(rows.text)
    order = np.lexsort((column, -score, rows.owner))[rows.at[:-1]]
    return column[order], score[order]


def greedy(rows: _Side, columns: _Side) -> list[tuple[int, int, float]]:
    """(row, column, score): rows in order take the best column left, the lower one on a tie."""
    tree, out = Tree(columns.text, columns.owner), []
    first, score = _firsts(rows, tree)
    taken = np.zeros(len(columns.ids), bool)
    pending: list[int] = []
    for i in range(min(len(rows.ids), len(columns.ids))):
        j, s = first[i], score[i]
        if taken[j]:
            for k in pending:
                tree.remove(k, np.searchsorted(tree.texts, columns.of(k)), taken)
            pending = []
            found = sorted((-s, j) for j, s in zip(*tree.best(rows.of(i))))
            s, j = -found[0][0], found[0][1]
        taken[j] = True
        pending.append(j)
        out.append((i, int(j), float(s)))
    return out


def hungarian(rows: _Side, columns: _Side) -> list[tuple[int, int, float]]:
    """(row, column, score) of the assignment with the largest sum, as ``linkage.hungarian`` finds it over all scores.

    A row whose best column is free, and has never been in another row's
    search, takes it as that search would; the others' searches ask for whole
    rows of scores as they reach them.
    """
    if turned := len(rows.ids) > len(columns.ids):
        rows, columns = columns, rows
    n, m = len(rows.ids), len(columns.ids)
    if not n:
        return []
    tree, kept = Tree(columns.text, columns.owner), {}
    first, score = _firsts(rows, tree)

    def cost(i: int) -> np.ndarray:
        if i not in kept:
            if len(kept) * m > ROWS:
                kept.clear()
            own = np.zeros(m)
            texts = rows.of(i)
            _, text, s = tree.within(texts, np.full(len(texts), -1.0))
            size = np.diff(tree.at)[text]
            np.maximum.at(own, tree.by_text[np.repeat(tree.at[text] - np.cumsum(size) + size, size) + np.arange(size.sum())], np.repeat(s, size))
            kept[i] = -own
        return kept[i]

    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        j = first[i - 1] + 1
        if not match[j] and v[j] == 0:
            match[j], u[i] = i, -score[i - 1]
            continue
        match[0], j0 = i, 0
        least, way, used = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = match[j0]
            slack = cost(i0 - 1) - u[i0] - v[1:]
            better = ~used[1:] & (slack < least[1:])
            least[1:][better] = slack[better]
            way[1:][better] = j0
            j1 = int(np.where(used[1:], np.inf, least[1:]).argmin()) + 1
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    pairs = [(match[j] - 1, j - 1) for j in range(1, m + 1) if match[j]]
    scored = [(i, j, float(score[i] if first[i] == j else -cost(i)[j])) for i, j in pairs]
    return sorted((j, i, s) if turned else (i, j, s) for i, j, s in scored)


def _sides(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, left_text: str, right_text: str):
    """Both sides' rows that have a block, an id and a text, by block; no other can be in a pair."""
    full = lambda df, *names: df.select(*names).dropna(subset=list(names[:3]))
    return full(left, block, left_id, left_text), full(right, block, right_id, right_text)


def assign_texts(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, left_text: str, right_text: str, least: float, method=hungarian, strict: bool = False) -> DataFrame:
    """(block, left_id, right_id, score): ``linkage.assign`` of all a block's pairs by the likeness of their texts, without making the pairs.

    A block's texts fit a task. Work grows with the texts where most rows like
    different columns best, and with the pairs of those that do not.
    """
    a, b = _sides(left, right, block, left_id, right_id, left_text, right_text)

    def of(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({block: [], left_id: [], right_id: [], "score": []})
        rows, columns = _Side(x[left_id], x[left_text]), _Side(y[right_id], y[right_text])
        got = [(i, j, s) for i, j, s in method(rows, columns) if (s > least if strict else s >= least)]
        i, j, s = (list(k) for k in zip(*got)) if got else ([], [], [])
        return pd.DataFrame({block: [x[block].iat[0]] * len(s), left_id: rows.ids[i] if i else [], right_id: columns.ids[j] if j else [], "score": s})

    kind = {c: df.schema[c].dataType.simpleString() for df, c in ((a, block), (a, left_id), (b, right_id))}
    schema = ", ".join(f"`{c}` {k}" for c, k in kind.items()) + ", score double"
    return a.groupBy(block).cogroup(b.groupBy(block)).applyInPandas(of, schema)


def alike_in_block(left: DataFrame, right: DataFrame, block: str, left_id: str, right_id: str, left_text: str, right_text: str, need: str | None = None) -> DataFrame:
    """(block, left_id, right_id) of the pairs of a block that are as alike as the left row's ``need`` asks; without it each row's likest, the smaller id on a tie."""
    a, b = _sides(left, right, block, left_id, right_id, left_text, right_text)
    if need:
        a = left.select(block, left_id, left_text, need).dropna()

    def of(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({block: [], left_id: [], right_id: []})
        columns = _Side(y[right_id], y[right_text])
        tree, ids = Tree(columns.text, columns.owner), x[left_id].to_numpy()
        if need:
            row, text, _ = tree.within(x[left_text].to_numpy(), x[need].to_numpy())
            size = np.diff(tree.at)[text]
            column = tree.by_text[np.repeat(tree.at[text] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            ids = ids[np.repeat(row, size)]
        else:
            column, _ = tree.best(x[left_text].to_numpy())
        return pd.DataFrame({block: [x[block].iat[0]] * len(ids), left_id: ids, right_id: columns.ids[column]})

    kind = {c: df.schema[c].dataType.simpleString() for df, c in ((a, block), (a, left_id), (b, right_id))}
    schema = ", ".join(f"`{c}` {k}" for c, k in kind.items())
    return a.groupBy(block).cogroup(b.groupBy(block)).applyInPandas(of, schema)
